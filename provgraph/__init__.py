"""PySpark-native engine for software supply-chain property graphs."""
