"""Composed plans: the flagship query and the registered query of every operator with its SQL."""
