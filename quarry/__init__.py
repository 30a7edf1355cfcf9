"""PySpark engine for file and domain reputation data."""
