"""Keyed upsert without a table format (merge-on-read).

A writer reduces each micro-batch to one row per key and writes it to
``<table>/gen=<n>-<writer>/[<date>=<d>/]batch_id=<b>/`` in overwrite mode. ``writer`` is the id of the
streaming query, which lives as long as its checkpoint: a batch that is replayed rewrites
its own folder, while a query with a fresh checkpoint, whose batch numbers start anew, gets
the next generation and can overwrite nothing. Readers keep the row with the highest
``(gen, batch_id, order...)`` per key, or, where rows carry the time of their change, ``(order..., gen, batch_id)``.

``compact`` folds all of it into a snapshot, a generation that no query can reuse, in a new
table folder; streams then write to the new folder, or go on in a folder of their own that is read
together with the snapshot (``read_latest`` takes several folders, the later ones win). Rows whose key is null are
documents without an id: each gets a generated id and is always appended. When a table format
with ``MERGE`` is available, use it instead; the reduction step is the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.operators.dedup import first_per_key, latest_per_key

__all__ = ["latest_per_key", "first_per_key", "assign_missing_keys", "generation", "path_exists",
           "query_id", "write_batch", "read_latest", "compact"]

BATCH_COL = "batch_id"
GEN_COL = "gen"
_PLACE = "_place"


def file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = file_system(spark, path)
    return fs.exists(hadoop)


def query_id(df: DataFrame) -> str:
    """Id of the streaming query that runs this micro-batch (kept in its checkpoint)."""
    found = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("not inside a streaming micro-batch: name the writer")
    return found


def generations(spark: SparkSession, path: str) -> list[str]:
    """Folder names of all generations under ``path``, oldest first."""
    fs, hadoop = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    return sorted(n for n in names if n.startswith(f"{GEN_COL}="))


def generation(spark: SparkSession, path: str, writer: str) -> str:
    """Folder name of the writer's generation: the one it has, or the next number."""
    taken = [n.removeprefix(f"{GEN_COL}=") for n in generations(spark, path)]
    for g in taken:
        if g.partition("-")[2] == writer:
            return g
    last = int(taken[-1].partition("-")[0]) if taken else -1
    return f"{last + 1:08d}-{writer}"


def assign_missing_keys(df: DataFrame, *keys: str) -> DataFrame:
    """A null text key becomes a generated id, so the row is appended, never merged."""
    for key in keys:
        if isinstance(df.schema[key].dataType, T.StringType):
            df = df.withColumn(key, F.coalesce(F.col(key), F.concat(F.lit("auto-"), F.uuid())))
    return df


def _reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str) -> DataFrame:
    pick = latest_per_key if keep == "last" else first_per_key
    return pick(df, list(keys), list(order)) if order else df.dropDuplicates(list(keys))


def write_batch(df: DataFrame, path: str, batch_id: int, keys: Sequence[str],
                order: Sequence[str] = (), keep: str = "last",
                partition_by: Sequence[str] = (), writer: str = "batch") -> None:
    """Write one micro-batch, reduced to one row per key (the ``last`` or ``first`` by
    ``order``), into the writer's generation (overwrite: a replay replaces the same folders).

    With ``partition_by`` (e.g. the report date) readers filtering on the date prune
    folders; the batch is written with dynamic partition overwrite, so a replay
    replaces exactly the folders of that batch. Partition columns must be fixed by
    the key (an order's create date never changes)."""
    keys = list(keys)
    df = assign_missing_keys(df, *(k for k in keys if k not in partition_by))
    folder = f"{path.rstrip('/')}/{GEN_COL}={generation(df.sparkSession, path, writer)}"
    (_reduce(df, keys, order, keep).withColumn(BATCH_COL, F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, BATCH_COL).parquet(folder))


def table_schema(columns: T.StructType, partition_by: Sequence[str] = ()) -> T.StructType:
    """Columns of a stored table: those of its rows, then the partition columns."""
    own = [f for f in columns.fields if f.name not in partition_by]
    return T.StructType([*own, *(T.StructField(c, T.StringType()) for c in [GEN_COL, *partition_by]), T.StructField(BATCH_COL, T.IntegerType())])


def _rows(spark: SparkSession, path: str, place: int, partition_by: Sequence[str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(table_schema(schema, partition_by))
    rows = reader.parquet(path).withColumn(_PLACE, F.lit(place))
    for c in [GEN_COL, *partition_by]:
        rows = rows.withColumn(c, F.col(c).cast("string"))
    return rows


def read_latest(spark: SparkSession, path: str | Sequence[str], keys: Sequence[str],
                order: Sequence[str] = (), keep: str = "last", where=None,
                batch_first: bool = True, partition_by: Sequence[str] = (),
                only: DataFrame | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Current table state. ``keep="last"``: the row from the highest generation and batch per key
    (then ``order``), i.e. later writes overwrite. ``keep="first"``: the row from the
    lowest, i.e. a key once written is never replaced. ``batch_first=False``
    ranks by ``order`` first: the earliest record wins whatever batch wrote it (the DAU table), or the latest
    change (orders and users), also if a job that was set back to an older checkpoint wrote it. Several folders are one table, the later ones written later (a snapshot, then
    what came after it).

    ``partition_by`` names string partition columns (read back as strings, not as
    inferred dates). ``where`` is applied before the per-key reduction, so a
    predicate on partition columns prunes folders; it must only use columns fixed
    by the key. ``only`` has the keys to be looked up (a semi-join before the reduction). ``schema``: columns of
    the rows; with it nothing is inferred from files, and a table whose batches were all empty is an empty table."""
    paths = [path] if isinstance(path, str) else list(path)
    rows = _rows(spark, paths[0], 0, partition_by, schema)
    for i, p in enumerate(paths[1:], 1):
        rows = rows.unionByName(_rows(spark, p, i, partition_by, schema))
    if where is not None:
        rows = rows.filter(where)
    if only is not None:
        rows = rows.join(only, list(keys), "left_semi")
    written = [_PLACE, GEN_COL, BATCH_COL]
    rank = [*written, *order] if batch_first else [*order, *written]
    return _reduce(rows, keys, rank, keep).drop(*written)


def compact(spark: SparkSession, path: str | Sequence[str], snapshot_path: str, keys: Sequence[str],
            order: Sequence[str] = (), keep: str = "last", partition_by: Sequence[str] = (),
            batch_first: bool = True) -> None:
    """Fold a table into a snapshot in ``snapshot_path`` (keeping the date partitioning of a
    partitioned table): a generation of its own, after those that are there, so nothing is overwritten
    and later writers outrank it."""
    state = read_latest(spark, path, keys, order, keep, partition_by=partition_by,
                        batch_first=batch_first)
    name = generation(spark, snapshot_path, f"snapshot-{uuid.uuid4()}")
    (state.withColumn(BATCH_COL, F.lit(0)).write.mode("errorifexists")
     .partitionBy(*partition_by, BATCH_COL).parquet(f"{snapshot_path.rstrip('/')}/{GEN_COL}={name}"))
