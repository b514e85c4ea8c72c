"""Registered queries: each Spark plan next to the SQL that checks it."""
