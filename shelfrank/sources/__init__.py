"""Readers, parsers, writers and test-table adapters."""
