"""Operators over places, users, preferences and ledgers: pure DataFrame -> DataFrame functions."""
