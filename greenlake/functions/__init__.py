"""Column functions: text, geometry, classification and range arithmetic."""
