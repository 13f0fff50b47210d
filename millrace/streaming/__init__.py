"""The same fitted steps on streaming tables."""
