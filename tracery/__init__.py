"""tracery: table-level lineage extraction and catalog maintenance on Spark."""

__version__ = "0.1.0"
