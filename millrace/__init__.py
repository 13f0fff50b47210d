"""Preparation and evaluation of time-ordered tables as plain Spark DataFrame jobs."""
