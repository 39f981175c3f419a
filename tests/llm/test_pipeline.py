import corpus_pipeline
from kinlink.llm import line_crf
from kinlink.llm.common import materialize
from kinlink.llm.queries import ORACLES, QUERIES
from tests.llm import test_decontaminate, test_line_crf


def test_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, small_dir), name)
        after = {r["doc_id"] for r in docs.collect()}
        assert docs.columns == columns and after < before and len(after) > 0.7 * len(before)
        before = after
    mixed = corpus_pipeline.mixing(spark, docs, small_dir)
    assert {r["doc_id"] for r in mixed.collect()} <= before
    assert sorted(map(tuple, corpus_pipeline.run(spark, small_dir).collect())) == sorted(map(tuple, mixed.collect()))


def test_quality_and_decontamination_by_brute_force(spark, small_dir):
    """Each stage keeps the rows that the plain versions of its operator keep."""
    docs, labels = spark.read.parquet(f"{small_dir}/documents.parquet"), spark.read.parquet(f"{small_dir}/labels.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    model = line_crf.train(docs, labels)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    short = [(i, test_line_crf._plain_score(model, t)) for i, t in texts if t.count("\n") < 8]
    sure = {i: p >= 0.5 for i, p in short if abs(p - 0.5) > 1e-3}
    stayed = set(ids(corpus_pipeline.quality(spark, docs, small_dir)))
    assert len(sure) > 50 and all((i in stayed) == good for i, good in sure.items())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert ids(corpus_pipeline.decontaminate(spark, docs, small_dir)) == sorted(i for i, t in texts if not test_decontaminate._plain(t, items))


def test_stages_on_edges(spark, edge_docs, no_docs, small_dir):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, small_dir), name)
        assert set(edge_docs.columns) <= set(docs.columns)


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
