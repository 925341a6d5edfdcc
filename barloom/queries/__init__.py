"""Query registry: importing the package registers every query."""
from barloom.queries import analysis, features, ingest, learning  # noqa: F401
from barloom.queries.registry import ORACLES, QUERIES  # noqa: F401
