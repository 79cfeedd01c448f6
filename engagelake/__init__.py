"""Spark-native analytics over engagement data: keyed entities, posts, edges, queues and vectors."""
