"""Order facts, business metrics, dashboards and the end-to-end run."""
