"""Named queries over the tables, one module per family; importing this package registers all."""

from helixtab.plans import (  # noqa: F401
    audits,
    classes,
    deltas,
    enrichment,
    files,
    interactions,
    profiles,
    selection,
    sequences,
    tracks,
    verification,
)
from helixtab.plans.registry import QUERIES, SQL  # noqa: F401
