"""Transaction-risk analytics as plain DataFrame-in, DataFrame-out Spark functions."""
