"""Readers and writers: monthly files, layer tables, JDBC."""
