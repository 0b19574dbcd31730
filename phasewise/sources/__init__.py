"""Reading study tables and writing results."""
