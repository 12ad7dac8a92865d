"""Every operator as a query over the given tables, most with an equivalent SQL text."""

from plumbline.plans.catalog import (  # noqa: F401  (importing a module registers its queries)
    encoding,
    evaluation,
    explanation,
    modelling,
    profiling,
    ranking,
    tables,
)
from plumbline.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
