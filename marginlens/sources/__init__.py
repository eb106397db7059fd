"""Readers for the three source tables and the view registry."""
