"""rosterlake: Spark jobs and DataFrame operators for class-booking and membership data."""

__version__ = "0.1.0"
