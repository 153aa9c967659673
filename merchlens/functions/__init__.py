"""Column expressions shared by every operator: exact numbers, dates, text, order metrics."""
