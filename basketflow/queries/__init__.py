"""Registered queries, each with the SQL it has to agree with."""
