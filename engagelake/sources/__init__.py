"""Readers and writers of nested records and bundles."""
