"""formtide: rolling form features and win probabilities as Spark DataFrame jobs."""

__version__ = "0.1.0"
