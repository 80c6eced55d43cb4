"""candor: Spark DataFrame operators for tables of candidate model responses."""

__version__ = "0.1.0"
