"""quarry: a Spark-native engine for curating labelled media and text collections."""

__version__ = "0.1.0"
