"""Change-data and telemetry pipelines on Spark DataFrames."""
