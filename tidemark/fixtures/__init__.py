"""Test inputs derived from the driver tables (see FIXTURES.md).

``frames`` builds them with Spark; ``sql`` holds the same derivations as DuckDB CTEs for the
oracle. Both read the given tables only, so the work grows with them.
"""
