"""All registered queries of the entity-resolution engine and their SQL twins."""

from kinlink.plans.queries import ORACLES, QUERIES

FLAGSHIP = "recall_token_sort"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
