"""Queries over the given tables that exercise every operator, and their SQL twins."""
