"""Helpers shared by the training-data operators: shared storage, Arrow batch size, id ranges."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows travel to Python workers in Arrow batches of so many rows and (a batch ends with the row that goes beyond) so many bytes.
ARROW_ROWS, ARROW_BYTES = 2048, 4 << 20

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset (local tests) a temporary folder of this machine is used, which only a
    local master may do.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="kinlink-")
    return _own_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call uses; grouped by application for clean-up."""
    return f"{shared_dir(spark)}/kinlink-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def sized(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """``df``, of narrow rows and about so many of them, in as many partitions as they need rather than one for each shuffle partition."""
    return df.coalesce(rows // per_task + 1)


def materialize(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    ``rows``: about how many narrow rows there are, if known, so that a small table isn't scattered over many files.
    ``release`` deletes the table once nothing reads it any more; the rest go with the application's folder.
    """
    path = fresh_path(df.sparkSession, label)
    df = df if rows is None else sized(df, rows)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` wrote and that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df._written_to)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch. All operators set the same two values, so it doesn't matter which of their lazy plans runs when."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def blank_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def split_points(ids: DataFrame, column: str, pieces: int) -> list[int]:
    """At most ``pieces - 1`` ascending cut points of an integer column, from one mergeable quantile sketch."""
    if pieces < 2:
        return []
    shares = ",".join(f"{i / pieces:.9f}" for i in range(1, pieces))
    row = ids.agg(F.expr(f"percentile_approx(`{column}`, cast(split('{shares}', ',') as array<double>), {max(10000, pieces * 4)})").alias("p")).first()
    return sorted(set(row["p"] or []))


def piece_of(column: str, points: list[int]) -> Column:
    """How many cut points are below or equal to the value: a branch-free binary search over a constant array."""
    if not points:
        return F.lit(0)
    levels = max(1, (len(points)).bit_length())
    full = (1 << levels) - 1
    padded = points + [2**63 - 1] * (full - len(points))
    table = f"cast(split('{','.join(map(str, padded))}', ',') as array<bigint>)"
    steps = f"sequence({levels - 1}, 0, -1)" if levels > 1 else "array(0)"
    found = f"aggregate({steps}, 0, (at, k) -> if(get({table}, at + shiftleft(1, k) - 1) <= `{column}`, at + shiftleft(1, k), at))"
    return F.least(F.expr(found), F.lit(len(points)))
