"""Readers, stand-in tables, the holiday calendar and writers."""
