"""Registered queries over the supplied tables, each with the SQL it is checked against."""

from tidewatch.plans import contract, features, logs, models, profiles, round_trips, sketches, streams

_MODULES = (logs, contract, features, profiles, models, streams, round_trips, sketches)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
