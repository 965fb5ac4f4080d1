"""trustfold: trusted batches and point-in-time profiles as Spark DataFrame operators."""

__version__ = "0.1.0"
