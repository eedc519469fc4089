"""DataFrame to DataFrame jobs."""
