"""Usage metering, quota replay and change history as Spark jobs."""

__version__ = "0.1.0"
