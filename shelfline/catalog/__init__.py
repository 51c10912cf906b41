"""The registered queries, one module per inventory section."""

from shelfline.catalog import (  # noqa: F401
    aggregates,
    columns,
    enrichment,
    features,
    files,
    filters,
    incremental,
    joins,
    series,
    sets_and_samples,
    texts,
    windows,
)
from shelfline.catalog.registry import QUERIES, SQL, runnable  # noqa: F401
