"""Retail order analytics on Spark: cleaning, star schema, order stream and live metrics."""
