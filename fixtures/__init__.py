"""Feed-shaped inputs derived from the given tables."""
