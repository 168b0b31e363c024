"""Registered queries of the library over the given tables, and SQL for each."""

from veleta.registry import gold, observation, quality, report, runs, sources

MODULES = (report, gold, quality, observation, sources, runs)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLES = {name: s for m in MODULES for name, s in m.ORACLES.items()}
