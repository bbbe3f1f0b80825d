"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: the separators of words, and what line keys are stripped of.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def scratch_root(spark: SparkSession) -> str:
    """Folder that all executors share (``spark.checkpoint.dir``).

    Only a session of one machine without that setting (tests) gets a folder of its own; a cluster without it is an error, because
    its executors would write to folders that the others don't see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to shared storage")
        root = "file://" + tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage,
    survives lost executors, and keeps the later readers' column pruning."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discarded(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        root = f"{scratch_root(spark)}/llm-"
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if files.makeQualified(path).getParent().equals(files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root + "x")).getParent()):
                files.delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for small iterated tables."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids belong to no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


#: Rows of an Arrow batch: a batch of long texts must fit the memory of a task on either side.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the UTF-8 bytes of the text (null: empty), under names of our own, so that
    extra or clashing columns never meet those of an operator.

    Lowers the session's Arrow batches to BATCH_ROWS rows, if they are larger or without a limit."""
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def chunks(batches: Iterable[pa.RecordBatch], max_bytes: int = 1 << 20, max_docs: int = 20_000):
    """(ids, bodies) of columns ``id`` and ``body``, a bounded number of text bytes and documents at a time (a
    longer text is alone), so that a task's memory doesn't follow the size of Arrow's batches."""
    ids, bodies, size = [], [], 0
    for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
        for i, body in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist(), strict=True):
            if bodies and (size + len(body or b"") > max_bytes or len(bodies) >= max_docs):
                yield ids, bodies
                ids, bodies, size = [], [], 0
            ids.append(i)
            bodies.append(body or b"")
            size += len(bodies[-1])
    if bodies:
        yield ids, bodies


class Memo(dict):
    """Values by key, computed when first asked for; forgets all beyond ``most`` keys."""

    def __init__(self, make, most: int = 1 << 19):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


#: Lower-cases A-Z and turns every other ASCII byte but digits and letters into a space.
ALNUM = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

FILTER_CHUNK = 17


def bit_filter(keys: DataFrame, bits: int) -> bytes:
    """Bit map of 2**``bits`` bits (a fixed size) with a bit set for the top bits of each long ``key``.
    It has no false negatives; more keys only mean more false positives."""
    at = F.shiftrightunsigned("key", 64 - bits)
    chunk = min(bits, FILTER_CHUNK)
    rows = keys.select(F.shiftright(at, chunk).alias("chunk"), at.bitwiseAND(F.lit((1 << chunk) - 1)).cast("int").alias("bit"))
    out = np.zeros(1 << bits, bool)
    for row in rows.groupBy("chunk").agg(F.collect_set("bit").alias("bits")).toLocalIterator():
        out[(row["chunk"] << chunk) + np.asarray(row["bits"], np.int64)] = True
    return np.packbits(out).tobytes()


def in_filter(packed: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    at = keys >> np.uint64(64 - bits)
    return (packed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (two multiply-xorshift rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def binary_views(column: pa.Array) -> list[bytes]:
    """Values of a binary column as bytes (nulls: empty)."""
    return [b"" if v is None else v for v in column.to_pylist()]
