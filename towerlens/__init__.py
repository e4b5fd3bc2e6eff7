"""Subscriber and cell analytics for mobile networks, as PySpark DataFrame operators."""
