"""Column functions: keys, numbers, distances, labels."""
