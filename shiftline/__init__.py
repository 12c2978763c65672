"""Shift and interval analytics on shop-floor data, as Spark DataFrame operators."""
