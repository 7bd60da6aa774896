"""Shopgrain: retail medallion tables, analyses and models as Spark DataFrame jobs."""
