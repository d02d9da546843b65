"""Registered queries over the test tables, each with its SQL counterpart."""

from tracklane.plans import cells, feeds, grids, names, sets

MODULES = (cells, names, sets, grids, feeds)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: sql for m in MODULES for k, sql in m.ORACLES.items()}
