"""Change-feed materialization on Spark.

Row changes and table snapshots go in as DataFrames; by a table of rules they
become message rows, key-value commands, the key-value state those commands
lead to, and log positions.
"""
