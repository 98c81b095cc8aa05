"""Spark-native building of tiled object-detection training sets."""
