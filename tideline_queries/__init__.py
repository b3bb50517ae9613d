"""Every operator run over whole tables, with the same question in SQL."""

from tideline_queries import drift, loads, nested, sequences, times, typed, versions

_MODULES = (nested, typed, times, sequences, loads, versions, drift)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}
