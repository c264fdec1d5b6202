"""slotwise: intraday service-level analytics and forecasting on PySpark."""

__version__ = "0.1.0"
