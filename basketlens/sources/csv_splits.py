"""CSV files cut at any byte: records that hold line breaks, read by as many tasks as there are splits.

A line break ends a record unless it stands in a quoted field, and only the text before
tells which is the case. So the files are read as plain lines, split by split, twice:

1. Each split reports what it does to the two states that a line can start in (outside or
   inside a quoted field): it keeps, swaps or fixes them. These few rows are put together
   along each file by window functions, which gives the state at the start of each split.
2. Each split cuts its lines into records from that state. A record that crosses the edge
   of a split comes out in pieces, at most two per split, which are joined afterwards.

A quote opens a field at its start only; elsewhere it is text, as for the CSV parser.
Compressed files are one split each. Empty lines between records are no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketlens.session import shared_dir

#: Splits whose states (some 30 bytes each) are sent to all tasks; beyond that the lines are dealt out by split.
BROADCAST_SPLITS = 1_000_000
# A closing quote is the first one that no other quote follows; what stands behind it up to the comma is text.
_AFTER_QUOTE = r'"(?:[^",][^,]*)?'
_FIELD = rf'(?:"(?:[^"]|"")*{_AFTER_QUOTE}|[^",][^,]*)?'
#: Lines that end outside of a quoted field, if they start outside or inside of one.
_CLOSED = (rf"^(?:{_FIELD},)*{_FIELD}$", rf'^(?:[^"]|"")*{_AFTER_QUOTE}(?:,(?:{_FIELD},)*{_FIELD})?$')
#: Pieces of a split: whole records; what ends a record of an earlier split, opens one, or is all of a split inside one.
RECORD, END, START, THROUGH = range(4)

_SPLIT = [T.StructField("file", T.LongType()), T.StructField("split", T.LongType())]
_EFFECT = T.StructType([*_SPLIT, T.StructField("from_outside", T.IntegerType()), T.StructField("from_inside", T.IntegerType())])
_PIECE = T.StructType(
    [*_SPLIT, T.StructField("kind", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("record", T.StringType())]
)


def states_behind(lines: pa.Array, inside: int) -> np.ndarray:
    """Whether a quoted field is open behind each line (0 or 1), given whether one is open before the first."""
    n = len(lines)
    swaps, fixes = np.zeros(n, np.int64), np.full(n, -1)
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quoted):
        some = lines.take(pa.array(quoted))
        outside, within = (1 - pc.match_substring_regex(some, p).to_numpy(zero_copy_only=False).astype(np.int64) for p in _CLOSED)
        swaps[quoted] = (outside == 1) & (within == 0)
        fixes[quoted] = np.where(outside == within, outside, -1)
    # the last line that fixes the state counts, and the swaps since
    total = np.cumsum(swaps)
    last = np.maximum.accumulate(np.where(fixes >= 0, np.arange(n), -1))
    return np.where(last >= 0, (fixes[last] + total - total[last]) & 1, (inside + total) & 1)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The rows of each batch by split; a split's rows come one after the other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split = (batch.column(i).to_numpy() for i in range(2))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (int(file[a]), int(split[a])), batch.slice(a, b - a)


def _batch(key: tuple[int, int], schema: T.StructType, *columns: list) -> pa.RecordBatch:
    """Rows of one split."""
    arrays = [pa.array([k] * len(columns[0]), pa.int64()) for k in key]
    kinds = {"place": pa.int64(), "record": pa.string()}
    arrays += [c if isinstance(c, pa.Array) else pa.array(c, kinds.get(n, pa.int32())) for n, c in zip(schema.names[2:], columns)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, states = None, (0, 1)
    for key, rows in _runs(batches):
        if key != now:
            if now is not None:
                yield _batch(now, _EFFECT, [states[0]], [states[1]])
            now, states = key, (0, 1)
        states = tuple(int(states_behind(rows.column(2), s)[-1]) for s in states)
    if now is not None:
        yield _batch(now, _EFFECT, [states[0]], [states[1]])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split, and the pieces of those that cross its edges. ``place`` counts them."""
    now, kept, inside, kind, place = None, None, 0, RECORD, 0

    def rest():
        return _batch(now, _PIECE, [START if kind == RECORD else THROUGH], [place], [kept])

    for key, rows in _runs(batches):
        if key != now:
            if kept is not None:
                yield rest()
            now, kept, place, inside = key, None, 0, rows.column(3)[0].as_py()
            kind = END if inside else RECORD
        lines = rows.column(2)
        behind = states_behind(lines, inside)
        inside, ends = int(behind[-1]), np.flatnonzero(behind == 0) + 1
        n = int(ends[-1]) if len(ends) else 0
        made = lines.slice(0, n)
        if len(ends) < n:
            made = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), made), "\n")
        if kept is not None and len(ends):
            made, kept = pa.concat_arrays([pa.array([kept + "\n" + made[0].as_py()]), made.slice(1)]), None
        if len(ends):
            kinds = np.zeros(len(ends), np.int32)
            kinds[0], kind = kind, RECORD
            yield _batch(now, _PIECE, pa.array(kinds), pa.array(place + np.arange(len(ends))), made)
            place += len(ends)
        if n < len(lines):
            kept = "\n".join([*([] if kept is None else [kept]), *lines.slice(n).to_pylist()])
    if kept is not None:
        yield rest()


def _split_states(effects: DataFrame) -> DataFrame:
    """Per split: file, split, ``inside`` at its start and ``open`` at its end (0 or 1).

    A split that fixes the state starts anew; behind it, swaps count. Windows see the splits of one file.
    """
    along = Window.partitionBy("file").orderBy("split")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.when((F.col("from_outside") == 1) & (F.col("from_inside") == 0), 1).otherwise(0)
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.struct("from_outside", "swaps"))
    counted = effects.withColumn("swaps", F.sum(swap).over(along))
    found = counted.withColumns({"last": F.last(fixed, ignorenulls=True).over(before), "now": F.coalesce(F.sum(swap).over(before), F.lit(0))})
    inside = (F.coalesce("last.from_outside", F.lit(0)) + F.col("now") - F.coalesce("last.swaps", F.lit(0))) % 2
    found = found.withColumn("inside", inside.cast("int"))
    after = F.when(F.col("inside") == 1, F.col("from_inside")).otherwise(F.col("from_outside"))
    return found.select("file", "split", "inside", after.alias("open"))


def _cut(lines: DataFrame, states: DataFrame, few: bool) -> DataFrame:
    """The pieces of the splits that are ``wanted``. Lines reach the tasks in the order of their file."""
    states = states.select(F.col("file").alias("__f"), F.col("split").alias("__s"), "inside", "wanted")
    numbered = lines if few else lines.withColumn("__line", F.monotonically_increasing_id())
    same = (F.col("file") == F.col("__f")) & (F.col("split") == F.col("__s"))
    met = numbered.join(F.broadcast(states) if few else states, same, "left")
    unknown = F.raise_error(F.lit("a file is cut otherwise than when its quotes were counted")).cast("boolean")
    met = met.where(F.coalesce("wanted", unknown))
    if not few:
        met = met.repartition("file", "split").sortWithinPartitions("file", "split", "__line")
    return met.select("file", "split", "line", "inside").mapInArrow(_pieces, _PIECE)


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The records of all CSV files of a path, as text without their line end: one column ``record``.

    With ``header``, the first record of each file is left out. The first pass runs at once,
    the second with the query; a file that is cut otherwise by then fails the query.
    """
    shared_dir(spark)
    source = spark.read.option("lineSep", "\n").text(path)
    lines = source.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line")
    )
    # lines without a quote leave the state as it is
    effects = lines.where(F.contains("line", F.lit('"'))).mapInArrow(_effects, _EFFECT)
    every = lines.select("file", "split").distinct().join(effects, ["file", "split"], "left")
    states = _split_states(every.na.fill({"from_outside": 0, "from_inside": 1})).checkpoint()
    few = states.count() <= BROADCAST_SPLITS
    whole = _cut(lines, states.withColumn("wanted", F.lit(True)), few).where(F.col("kind") == RECORD)
    if header:
        whole = whole.where("not (split = 0 and place = 0)")
    whole = whole.select("record")
    edge = F.expr("inside = 1 or open = 1")
    if not states.where(edge).isEmpty():
        whole = whole.unionByName(_crossing(_cut(lines, states.withColumn("wanted", edge), few), header))
    text = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return whole.select(text.alias("record")).where("record <> ''")


def _crossing(pieces: DataFrame, header: bool) -> DataFrame:
    """Records in pieces, put together: each piece belongs to the last start before it."""
    order = Window.partitionBy("file").orderBy("split", "place")
    opened = F.last(F.when(F.col("kind") == START, F.struct("split", "place")), ignorenulls=True).over(order)
    parts = pieces.where(F.col("kind") != RECORD).withColumn("opened", opened)
    parts = parts.groupBy("file", "opened").agg(F.array_sort(F.collect_list(F.struct("split", "place", "record"))).alias("parts"))
    if header:
        parts = parts.where("not (opened.split = 0 and opened.place = 0)")
    return parts.select(F.array_join("parts.record", "\n").alias("record"))
