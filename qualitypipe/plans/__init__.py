"""Configured end-to-end runs."""
