"""Checks against the driver's test tables: views, Spark queries and their SQL twins."""
