"""Billing, usage and inventory analytics as Spark DataFrame plans."""
