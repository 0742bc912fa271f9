"""Column functions: URLs, titles, scores."""
