"""Retail analytics warehouse built from PySpark DataFrame jobs."""
