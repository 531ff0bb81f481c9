"""Query catalog: importing this package registers every named query."""

from ledgerlake.plans.queries import (  # noqa: F401
    aggregates,
    filters,
    joins,
    windows,
    quality,
    drift,
    observability,
    scalars,
    sources,
    streaming,
)
