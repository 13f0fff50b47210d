"""The operators: fit with one small aggregate per pass, apply with column expressions."""
