"""inkwell: a PySpark-native engine for text archives and their delivery, subscriber and asset data."""
