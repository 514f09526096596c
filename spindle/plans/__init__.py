"""Whole-script jobs, stand-in tables and the query registry."""
