"""Reading tables and logs, writing results."""
