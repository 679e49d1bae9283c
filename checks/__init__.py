"""Registered queries: each library operator on the driver tables, with its SQL oracle."""
