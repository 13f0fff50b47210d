"""Reusable plan shapes: one-pass statistics, exact quantiles, global order, value counts."""
