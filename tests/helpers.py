"""Small tables and comparisons for tests."""

from __future__ import annotations

import math

ENTITY = "entity_id string, business_name string, business_address string, country string"
NORMALIZED = "entity_id string, normalized_name string, token_sorted_name string, normalized_address string, address_missing boolean, country string"
CANDIDATES = "entity_id_left string, entity_id_right string, blocking_score double, blocking_method string"
TRUTH = "source1_entity_id string, matched_entity_ids string"


def entity(i, name, address=None, country="US"):
    """A normalised entity."""
    sort = " ".join(sorted(name.split())) if name else None
    return (i, name, sort, address, address is None, country)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isnan(a) and math.isnan(b)
    return a == b
