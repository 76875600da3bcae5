"""Registered queries: input views over the driver tables, Spark queries, oracle SQL."""
