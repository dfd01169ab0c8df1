"""loomtext: a PySpark-native engine for curating large text collections."""
