"""tidemark: point-in-time analytics and training-data operators on Spark."""
