"""Registered queries: each operator on the driver tables, with SQL that gives the same rows."""
