"""viewlog: session-log analytics on Spark (DataFrame API, Catalyst, AQE)."""

__version__ = "0.1.0"
