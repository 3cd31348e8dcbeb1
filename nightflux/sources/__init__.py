"""Readers of frame headers, tables and logs, and writers of the products."""
