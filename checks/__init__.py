"""Registered queries over the test tables, and the SQL to compare them with."""
