"""Registered queries: derived inputs, the Spark queries and their SQL oracles."""
