"""Readers and writers: CSV landing, sectioned exports, API responses, table and JDBC sinks."""
