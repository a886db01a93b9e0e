"""The registered queries with the SQL that checks them."""

from catalog import features, health, insight, models, profile, risk, stumps, tables_io, trees  # noqa: F401
from catalog.registry import ORACLES, QUERIES  # noqa: F401
