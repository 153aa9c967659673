"""Marketplace sales and fulfilment analytics as composable Spark DataFrame functions."""
