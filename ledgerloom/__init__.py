"""Retail data-quality and analytics engine written on the Spark DataFrame API."""
