"""The registered queries over the supplied tables."""

from venue_queries import (  # noqa: F401  (importing registers the queries)
    activity,
    charts,
    encoders,
    growth,
    io,
    modelling,
    places,
    profiles,
)
from venue_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
