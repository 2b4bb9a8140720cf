"""Registered queries, each next to the SQL that must give the same rows."""
