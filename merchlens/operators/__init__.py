"""Profiling, cleaning, rule evaluation and data quality over whole tables."""
