"""Token counts through a digest cache.

A text's count is stored under the digest of its content (SHA-256 of the UTF-8 bytes, null as empty;
nothing else is normalised, as any other change could change the count) and of the tokenizer (SHA-256 of
its file, and the library's version). Digests alone are looked up first; only texts whose digest the cache lacks are
shuffled, one for each digest, encoded in Arrow batches and appended to the cache, and all
counts are then joined from it. The cache is a Parquet folder that any number of runs may append to;
should two runs store one digest, the equal counts are merged on reading.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm.common import blank_null, materialize, release, small_batches

CACHE_SCHEMA = "tokenizer string, content binary, n_tokens bigint"
LIMIT = 4096
SENT = 200_000  # so many missing digests at most (6.4 MB) are sent to the texts; more are joined with them


@lru_cache(maxsize=2)
def _encoder(path: str):
    """A function from texts to token counts, for a ``.model`` (sentencepiece) or ``.json`` (tokenizers) file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_padding()
    model.no_truncation()
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    if path.endswith(".model"):
        from sentencepiece import __version__ as version
    else:
        from tokenizers import __version__ as version
    return f"{hashlib.sha256(Path(path).read_bytes()).hexdigest()}-{version}"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """``(content, n_tokens)`` of one tokenizer; empty where there is no cache yet."""
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache) if _exists(spark, cache) else spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _content(text_col: str):
    return F.unhex(F.sha2(blank_null(text_col), 256)).alias("content")


def fill_cache(docs: DataFrame, model: str, cache: str, text_col: str = "text", digests: DataFrame | None = None) -> int:
    """Encode the distinct texts of ``docs`` that ``cache`` lacks, append their counts to it, and return how many they were.

    ``digests``: the distinct ``content`` of ``docs``, if made already.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokenizer = tokenizer_digest(model)
    digests = docs.select(_content(text_col)).distinct() if digests is None else digests
    misses = materialize(digests.join(read_cache(spark, cache, tokenizer), "content", "left_anti"), "missing-digests")
    n = misses.count()
    if not n:
        return 0
    texts = docs.select(_content(text_col), blank_null(text_col).alias("text"))
    if n <= SENT:
        texts = texts.join(F.broadcast(misses), "content", "left_semi")
    texts = texts.groupBy("content").agg(F.first("text").alias("text"))
    if n > SENT:
        texts = texts.join(misses.hint("merge"), "content", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _encoder(model)
        for b in batches:
            counts = count(b.column(1).to_pylist()) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    made = texts.select("content", "text").mapInArrow(run, "content binary, n_tokens bigint")
    made.select(F.lit(tokenizer).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache)
    release(misses)
    return n


def count_tokens(docs: DataFrame, model: str, cache: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``, in whole texts.

    ``model``: the tokenizer's file, at the same place on every machine; ``cache``: a folder that all share. Null text counts
    as empty (no tokens), repeated rows are kept, an empty table gives an empty result, other columns are ignored.
    """
    digests = materialize(docs.select(_content(text_col)).distinct(), "digests")
    fill_cache(docs, model, cache, text_col, digests)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(blank_null(text_col)).cast("bigint").alias("n_bytes"), _content(text_col))
    # written first, so that the join's sides are plain exchanges and the rows of a very common text can be split
    counts = materialize(read_cache(docs.sparkSession, cache, tokenizer_digest(model)).join(digests, "content", "left_semi"), "token-counts")
    release(digests)
    return rows.join(counts, "content", "left").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
