import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinlink.llm import token_cache as t
from kinlink.llm.common import fresh_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_are_the_librarys(spark, edge_docs, no_docs):
    extra = spark.createDataFrame([(50, "<s> special </s> <unk>"), (51, "x" * 20_000), (52, "  spaces\n\n"), (53, None)], "doc_id bigint, text string")
    docs = edge_docs.select("doc_id", "text").unionByName(extra).withColumn("content", F.lit(1)).withColumn("n_tokens", F.lit(1))
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), n := len(model.encode(r["text"] or "")), n > 4096) for r in docs.collect()), key=repr)
    cache = fresh_path(spark, "tokens")
    for _ in range(2):  # from an empty cache, then from a full one
        assert sorted(map(tuple, t.count_tokens(docs, PIECES, cache).collect()), key=repr) == want
    assert t.count_tokens(no_docs, PIECES, fresh_path(spark, "tokens")).count() == 0


@pytest.mark.parametrize("sent", [0, 1000])
def test_only_misses_are_encoded(spark, monkeypatch, sent):
    monkeypatch.setattr(t, "SENT", sent)
    docs = spark.createDataFrame([(i, f"text {i % 3}") for i in range(30)], "doc_id bigint, text string")
    cache = fresh_path(spark, "tokens")
    assert t.fill_cache(docs, PIECES, cache) == 3 and spark.read.parquet(cache).count() == 3
    assert t.fill_cache(docs.unionByName(spark.createDataFrame([(99, "new")], docs.schema)), PIECES, cache) == 1
    assert spark.read.parquet(cache).count() == 4 and t.fill_cache(docs, PIECES, cache) == 0
    other = public_tokenizers.path("byte_bpe_50k.json")
    t.fill_cache(docs, other, cache)
    assert spark.read.parquet(cache).count() == 7 and t.tokenizer_digest(other) != t.tokenizer_digest(PIECES)


def test_json_tokenizers(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "Hello <|endoftext|> world"), (2, "été")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in t.count_tokens(docs, path, fresh_path(spark, "tokens")).collect()}
    model = Tokenizer.from_file(path)
    assert got == {r["doc_id"]: len(model.encode(r["text"], add_special_tokens=False).ids) for r in docs.collect()}


def test_query(spark, small_dir):
    from kinlink.llm.queries import QUERIES

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = QUERIES["op5_token_counts"](spark, small_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(model.encode(x)) for i, x in texts.items()}


def test_unknown_model():
    with pytest.raises(OSError):
        t.tokenizer_digest("/nowhere.model")
