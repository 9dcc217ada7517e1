"""Registered queries on the test tables, most with a SQL statement that must give the same rows."""
