"""Operators on the event log and its derived tables."""
