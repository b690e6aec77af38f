"""Readers: derived tables, JSON arrays, KML, catalogs, files."""
