"""Composed plans: pipelines and the driver queries over the test tables."""
