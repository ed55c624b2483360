"""weftline: a PySpark-native engine for profiling, cleaning and curating short multilingual posts."""

__version__ = "0.1.0"
