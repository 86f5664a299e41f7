"""Tidewell: a Spark-native library for annotation tables, dataset curation and edge-camera analytics."""
