"""Mercato: marketplace analytics as Spark DataFrame jobs."""
