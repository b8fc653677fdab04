"""PySpark-native analytics for electricity-distribution network data."""

from gridspark.session import get_session

__all__ = ["get_session"]
