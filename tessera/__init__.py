"""A Spark-native engine that turns annotated short texts into an explainable concept graph and countable tables."""
