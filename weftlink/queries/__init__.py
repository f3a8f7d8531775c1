"""Registry of the core queries and their SQL."""

from weftlink.queries import evaluation, people, records, registers, variants

MODULES = (records, people, registers, evaluation, variants)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
