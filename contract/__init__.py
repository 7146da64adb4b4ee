"""Registered queries over the star-schema tables, and the SQL each one is checked against."""
