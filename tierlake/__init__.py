"""Dated bronze, silver and gold layers as PySpark DataFrame jobs."""
