"""Schemas and fixed values, raw-record shaping, test-table fixtures, storage readers and writers."""
