"""Text-provenance analytics on Spark: cleaning, statistics, features, models, streams."""
