"""Feature stages, model search and evaluation on Spark ML."""
