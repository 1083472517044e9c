from tidemark.queries import (  # noqa: F401
    documents,
    expressions,
    maintenance,
    pipelines,
    relational,
    sources,
    streams,
    threads,
)
from tidemark.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
