"""Readers that turn files, archives and tables into document rows."""
