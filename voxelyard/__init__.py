"""Spark-native analytics over labelled segmentation data; see README.md."""
