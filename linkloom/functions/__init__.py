"""Column expressions used inside the table jobs."""
