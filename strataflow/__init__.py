"""Layered warehouse analytics expressed as Spark DataFrame jobs."""
