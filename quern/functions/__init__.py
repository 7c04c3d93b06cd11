"""Column helpers that several operators share."""
