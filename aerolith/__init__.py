"""aerolith package."""
