"""Readers and writers of the record tables and result files."""
