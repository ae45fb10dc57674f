"""Column expressions: timestamps, levels and facts derived from message text."""
