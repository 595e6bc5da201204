"""Layered retail analytics as PySpark DataFrame transformations."""
