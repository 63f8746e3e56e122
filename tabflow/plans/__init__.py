"""Composite plans: the fitted feature pipeline and end-to-end runs."""
