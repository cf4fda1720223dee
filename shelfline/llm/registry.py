"""Queries and comparison SQL of this subpackage."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register
