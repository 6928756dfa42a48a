"""Composite analyses and the batch jobs that run them."""
