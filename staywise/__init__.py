"""Customer retention analytics on Spark: features, scoring, training, drift and promotion as DataFrame jobs."""

__version__ = "1.0.0"
