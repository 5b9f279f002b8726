"""Adjudica: healthcare-claims analytics as Spark DataFrame jobs."""
