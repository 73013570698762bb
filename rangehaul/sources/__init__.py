"""Readers: JDBC ranges, Arrow ranges, run documents, file inventory, generated tables."""
