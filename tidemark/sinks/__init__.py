"""Sinks: merge into stored tables, layout and sizing, catalog registration, partition-wise export."""
