"""Training-corpus and training-run analytics on Spark."""
