"""Readers and writers for loan files and derived tables."""
