"""Registered queries and the SQL they are checked against, one module per area."""
