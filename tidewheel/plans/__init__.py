"""The query catalogue: each entry runs one operator over whole input tables."""

from . import cleaning, learning, profiling, reports

_MODULES = (reports, profiling, cleaning, learning)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
