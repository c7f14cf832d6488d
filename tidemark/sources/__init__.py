"""Readers and writers for change feeds, topics, tables and JDBC."""
