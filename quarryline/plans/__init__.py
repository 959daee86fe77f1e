"""Extraction plans: templates, inheritance, freshness, and the job that runs them."""
