"""feedloom: content-feed analytics as Spark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame; ``now`` is always a
parameter, so the same input gives the same output on every run.
"""
