"""Spark-native log analytics: ingest, clean, query, alert and report on logs.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``) function over Spark built-ins,
so a whole pipeline stays one lazy plan until something is written.
"""

from emberlog.config import BATCH, INTERACTIVE, ParseProfile, Thresholds

__all__ = ["BATCH", "INTERACTIVE", "ParseProfile", "Thresholds"]
