"""Registered queries: each runs an operator over a whole test table, and most
carry the SQL that another engine runs to check the result."""
