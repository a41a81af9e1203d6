"""Retail sales and refund analytics expressed as Spark DataFrame plans."""
