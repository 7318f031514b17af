"""Queries over the project's tables and the SQL that states the same."""
