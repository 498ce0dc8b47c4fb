"""Listening analytics on Spark: cleaning, enrichment, dimensions, facts and KPIs."""
