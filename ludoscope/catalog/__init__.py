"""The registered queries and their checks, by part of the inventory."""

from ludoscope.catalog import landing, shaping, recs, texts, groups  # noqa: F401
from ludoscope.catalog.base import ORACLES, QUERIES  # noqa: F401
