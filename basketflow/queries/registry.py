"""Name -> (query, SQL or None)."""

from . import aggregation, incremental, learning, serving

REGISTRY = {
    **aggregation.QUERIES,
    **incremental.QUERIES,
    **learning.QUERIES,
    **serving.QUERIES,
}
