"""Readers: CSV logs with any mix of headers, the parsed log table and incremental ingest."""
