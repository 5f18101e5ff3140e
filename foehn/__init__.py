"""foehn: a Spark-native pipeline and query library for station-based,
10-minute weather measurements (bronze -> silver -> gold)."""

__version__ = "0.1.0"
