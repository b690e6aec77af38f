"""Waymark: place analytics and corpus preparation as plain Spark plans."""
