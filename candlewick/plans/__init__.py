"""The registered queries and their SQL counterparts."""

from candlewick.plans import (  # noqa: F401  (importing a module registers its queries)
    governance,
    groups,
    models,
    monitoring,
    rows,
    streams,
    tables,
    windows,
)
from candlewick.plans.registry import ORACLES, QUERIES  # noqa: F401
