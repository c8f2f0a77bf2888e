"""Point and interval models on Spark ML, search, training."""
