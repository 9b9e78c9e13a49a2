"""Hot ranking on Spark: decaying popularity scores and top-N boards per category."""

__version__ = "0.1.0"
