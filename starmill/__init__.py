"""Dimensional warehouse loads written as Spark DataFrame transformations."""
