"""Queries over the provided tables, one per operator, with the SQL each result must equal."""
