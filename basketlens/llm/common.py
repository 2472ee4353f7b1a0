"""Helpers shared by the operators: Arrow batches in tasks, words, durable cuts."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: White space between words, for Spark's (Java) and Python's patterns alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a Python worker handles at a time.
CHUNK_BYTES = 4 << 20
#: What str.split() takes for white space besides WORD's: the patterns decide there.
ODD_SPACE = "\x1c\x1d\x1e\x1f\x85\xa0                　"
_TO_SPACE = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: str | None) -> list[str]:
    """The matches of WORD, in order; none for null."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass").translate(_TO_SPACE)
    return [w for w in data.decode("utf-8", "surrogatepass").split(" ") if w]


def word_bytes(text: str | None) -> list[bytes]:
    """As words_of, each word in UTF-8; bytes.split() knows exactly WORD's white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def slices(batch: pa.RecordBatch, column: str | None = None, chunk: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``chunk`` bytes each; a longer row is alone."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * chunk // max(batch.nbytes, 1)))
    start = 0
    while start < batch.num_rows:
        yield batch.slice(start, rows)
        start += rows


def append_columns(
    df: DataFrame, read: list[str], fields: list[tuple[str, T.DataType]], function: Callable[..., list], arrow: bool = False,
    chunk: int = CHUNK_BYTES,
) -> DataFrame:
    """df with new columns: ``function(*columns as Python lists) -> one list per field``, per run of rows of ``chunk`` bytes.

    A column of df with the name of a new one is replaced. ``arrow``: the function takes Arrow arrays.
    """
    names = {name for name, _ in fields}
    kept = [c for c in df.columns if c not in names]
    # what is kept is read where it is: a text goes to the worker once
    hidden = {c: f"__read_{i}" for i, c in enumerate(read) if c not in kept}
    source = df.select(*[df[c] for c in kept], *[df[c].alias(h) for c, h in hidden.items()])
    places = [source.columns.index(hidden.get(c, c)) for c in read]
    schema = T.StructType([source.schema[c] for c in kept] + [T.StructField(n, t) for n, t in fields])
    kinds = [to_arrow_type(t) for _, t in fields]

    def run(batches):
        for whole in batches:
            for batch in slices(whole, chunk=chunk):
                table_in = [batch.column(i) for i in places]
                out = function(*(table_in if arrow else [c.to_pylist() for c in table_in]))
                columns = [batch.column(i) for i in range(len(kept))] + [
                    x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(out, kinds)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])
        # workers wait between tasks: they shall not keep what the largest batch took
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one where that is unset on a local master (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = getattr(shared_folder, "own", None) or tempfile.mkdtemp(prefix="llm-")
        shared_folder.own = folder
    return folder.rstrip("/")


#: Scratch paths of the stage that runs, and of stages before whose results have been written since.
_scope: list[str] | None = None
_finished: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if _scope is not None:
        _scope.append(path)
    return path


def stage(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage of a pipeline that writes each stage's result before it starts the next.

    The scratch tables that a stage leaves (its result reads them) are deleted when the
    next stage starts, and only those.
    """

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        global _scope
        while _finished:
            path = spark._jvm.org.apache.hadoop.fs.Path(_finished.pop())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _scope = []
        try:
            return function(spark, docs, folder)
        finally:
            _finished.extend(_scope)
            _scope = None

    return run


def written(df: DataFrame) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: a durable cut of the lineage."""
    spark = df.sparkSession
    path = shared_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (multiply and shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def crc_fold(column) -> F.Column:
    """crc32 of the column's text, modulo 5."""
    return F.crc32(column.cast("string")) % 5
