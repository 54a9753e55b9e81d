"""The jobs bound to the test tables, each with an SQL twin where SQL can say it."""

from limnospark.bindings.registry import ORACLES, QUERIES
from limnospark.bindings import (  # noqa: F401  (each module registers its queries)
    analysis, checks, consolidation, correlations, exports, forms, gauge_files, parsing, smaller, specs, stores,
)

__all__ = ["ORACLES", "QUERIES"]
