import gzip
import hashlib
import io

import pytest

from kinlink.llm import warc
from kinlink.llm.common import fresh_path

SCHEMA = "page_id bigint, url string, html string, revisit string, digest string"
BIG, OTHER = "é" * 600, "<p>" + "x" * 2000
PAGES = [(1, "http://a.b/c d\n", BIG), (7, "http://a.b/", BIG), (3, None, BIG), (2, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (9, "u", OTHER), (None, "u", OTHER), (8, "u", "y" * 999)]


def _pages(spark):
    return spark.createDataFrame([(*p, "a", "b") for p in PAGES], SCHEMA).repartition(3)


def _want(pages):
    by = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 1000:
            by.setdefault(raw, []).append(i)
    keeper = {k: max((x for x in v if x is not None), default=None) for k, v in by.items()}
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        k = keeper.get(raw, i) if len(by.get(raw, [])) > 1 else i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if i == k else "revisit", None if i == k else k))
    return sorted(out, key=repr)


def test_round_trip(spark):
    manifest = warc.write_archives(_pages(spark), fresh_path(spark, "warc"), file_bytes=800)
    assert sum(r["n_records"] for r in manifest.collect()) == len(PAGES) and manifest.count() > 3
    records = warc.read_archives(manifest)
    assert sorted((tuple(r) for r in records.collect()), key=repr) == _want(PAGES)
    assert warc.unresolved(records).count() == 0 and warc.unresolved(records.where("page_id <> 7")).count() == 2


def test_a_hot_payload_can_be_split(spark):
    """Small pages bypass the join, and its sides are plain exchanges."""
    plan = warc.with_record_types(_pages(spark))._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin") :] if "SortMergeJoin" in plan else plan[plan.index("BroadcastHashJoin") :]
    assert "HashAggregate" not in join and plan.index("Union") < plan.index("Join")


def test_members_and_payloads(spark):
    raw = warc.make_record(5, "http://x", b"hello") + warc.make_record(6, None, b"z" * 200_000) + warc.make_record(7, "u", b"hello", 5, True)
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == 3
    got = list(warc.read_records(io.BytesIO(raw).read, keep_payload=True))
    assert [(h["WARC-Type"], n, p) for h, n, _, p in got] == [("response", 5, b"hello"), ("response", 200_000, b"z" * 200_000), ("revisit", 0, b"")]
    assert got[2][2] == hashlib.sha1(b"hello").hexdigest()


@pytest.mark.parametrize("damage", ["cut", "digest", "length"])
def test_damage_is_found(damage):
    raw = gzip.decompress(warc.make_record(5, "http://x", b"hello"))
    if damage == "cut":
        data = warc.make_record(5, "http://x", b"hello")[:-12]
    elif damage == "digest":
        data = gzip.compress(raw.replace(b"hello", b"hullo"))
    else:
        data = gzip.compress(raw.replace(b"\r\nhello", b"\r\nhellohello"))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data).read))


def test_empty(spark):
    manifest = warc.write_archives(_pages(spark).where("false"), fresh_path(spark, "warc"))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def test_query(spark, small_dir):
    from kinlink.llm.queries import QUERIES

    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op8_warc"](spark, small_dir).collect()), key=repr) == _want(pages)
