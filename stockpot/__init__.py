"""Spark-native processing of versioned catalogs of nested recipe documents."""
