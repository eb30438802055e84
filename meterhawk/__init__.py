"""meterhawk: Spark-native analytics and anomaly detection for metered trips."""

from meterhawk.session import build_session

__all__ = ["build_session"]
