"""Column expressions, kept as SQL text so DataFrame jobs and SQL functions share one source."""
