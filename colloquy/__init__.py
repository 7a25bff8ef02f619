"""Chat-data and post-training data jobs for Spark."""
