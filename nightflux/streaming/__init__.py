"""Incremental form of the nightly append."""
