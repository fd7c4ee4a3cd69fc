"""Column functions: text, time, scores."""
