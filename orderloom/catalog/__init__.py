"""Every operator as a query over the given tables, with the SQL it must agree with."""

from __future__ import annotations

from orderloom.catalog import fees, loads, marketplace, quality, state, storefront, streams

MODULES = [fees, storefront, marketplace, state, quality, streams, loads]

QUERIES = {name: run for module in MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
