"""A Spark-native analytics engine for annotation corpora, detections and track events."""
