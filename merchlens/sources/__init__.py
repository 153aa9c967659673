"""Reading raw, clean and driver tables; publishing and exporting results."""
