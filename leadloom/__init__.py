"""Lead-list analytics and training-data operators on Spark."""
