"""Registered queries over the test tables, each beside the SQL it is checked against."""
