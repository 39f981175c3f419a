"""Reading and writing tables and reports on any Hadoop file system."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinlink.operators.features import FEATURES
from kinlink.schemas import CANDIDATE_SOURCE, ENTITY_ID, PAIR_TARGETS, RAW_SCHEMA, TRUTH_SCHEMA, require_columns


def read_tsv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, rows: int | None = None) -> DataFrame:
    """A tab-separated file with header; empty fields are null; ``rows``: only so many."""
    df = spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", escape="\\", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return df if rows is None else df.limit(rows)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder all machines share: below ``spark.checkpoint.dir``, or, with a local master only, the warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/kinlink-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def write_scratch_tsv(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    write_tsv(df, path)
    return path


def read_truth(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """The wide ground truth; an empty list of matches is '', not null."""
    return read_tsv(spark, path, TRUTH_SCHEMA, rows).withColumn("matched_entity_ids", F.coalesce("matched_entity_ids", F.lit("")))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Snappy Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def keep_ids(df: DataFrame, ids: DataFrame, column: str = ENTITY_ID) -> DataFrame:
    """Rows whose id is listed."""
    return df.join(ids.select(column), column, "left_semi")


def load_features(spark: SparkSession, paths: Iterable[str], pair_type: str = "both", features: Iterable[str] = FEATURES) -> DataFrame:
    """All feature tables together, of one pair type or of both; absent columns are an error."""
    parts = []
    for p in paths:
        df = spark.read.parquet(p)
        require_columns(df, [*features, "label", CANDIDATE_SOURCE], p)
        parts.append(df)
    rows = reduce(DataFrame.unionByName, parts)
    return rows if pair_type == "both" else rows.where(F.col(CANDIDATE_SOURCE) == PAIR_TARGETS[pair_type])


def roundtrip_differences(df: DataFrame, path: str) -> DataFrame:
    """Rows that differ after writing and reading ``df``; empty if all is well."""
    write_parquet(df, path)
    back = df.sparkSession.read.parquet(path)
    return df.exceptAll(back).unionByName(back.exceptAll(df))


def _fs(spark: SparkSession, path: str) -> tuple[Any, Any]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 if there is nothing."""
    fs, at = _fs(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return sorted(str(s.getPath()) for s in fs.listStatus(at)) if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a path if it is there, such as a stale output."""
    fs, at = _fs(spark, path)
    return fs.exists(at) and fs.delete(at, True)


def write_report(spark: SparkSession, report: Mapping[str, Any], path: str) -> None:
    """A JSON report as one file; values JSON lacks are written as text."""
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(report, indent=2, default=str).encode()))
    out.close()


def read_report(spark: SparkSession, path: str) -> Any:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def table_report(df: DataFrame) -> list[dict[str, Any]]:
    """A small table (a report's, of a row for each column, run or group) as JSON-ready rows."""
    return [r.asDict(recursive=True) for r in df.collect()]
