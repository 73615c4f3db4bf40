"""corelode: a PySpark-native engine for catalogues of physical samples."""

__version__ = "0.1.0"
