"""Token-id output: one concatenated id array with Elias-Fano coded document boundaries.

File format: a Parquet folder, one row per segment, segments in ascending order of
(part, seg). A segment holds whole documents in ascending doc_id order, about
SEGMENT_IDS ids of them (a longer document is a segment of its own):

- ``ids``: all ids, little-endian, ``width`` bytes each (2 where the vocabulary allows it);
- ``ends_*``: the boundaries (ids up to the end of each document), Elias-Fano coded:
  low bits packed, high bits in unary, and the place of every SAMPLE-th set bit, from
  which a boundary is selected without a table of 64-bit offsets;
- ``docs_*``: the doc_ids minus ``first_doc``, coded in the same way; the first
  ``null_docs`` documents have no id.

Rows: null and empty texts hold the end id only. Equal doc_ids stay next to each other,
ordered by text. An empty table gives a file without segments. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketlens.llm.bpe import vocabulary
from basketlens.llm.common import slices

SEGMENT_IDS = 1 << 21
#: Set bits between two stored places.
SAMPLE = 256
#: Documents whose boundaries are decoded at a time.
READ_DOCS = 4096

_EF = [("low", T.BinaryType()), ("high", T.BinaryType()), ("places", T.BinaryType()), ("bits", T.IntegerType())]
SEGMENT = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("seg", T.IntegerType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("null_docs", T.LongType()),
        T.StructField("first_doc", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("ids", T.BinaryType()),
    ]
    + [T.StructField(f"{which}_{name}", kind) for which in ("ends", "docs") for name, kind in _EF]
)
DOCUMENT = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("seg", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing sequence of non-negative integers in about 2 + log2(last / n) bits each."""

    low: bytes
    high: bytes
    places: bytes
    bits: int
    n: int

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if n == 0:
            return cls(b"", b"", b"", 0, 0)
        values = values.astype(np.uint64)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1, np.uint8)
        unary[ones] = 1
        return cls(
            np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(unary, bitorder="little").tobytes(),
            ones[::SAMPLE].astype("<u4").tobytes(),
            bits,
            n,
        )

    def select(self, i: int) -> int:
        """The i-th value, read from the bits behind the last stored place before it."""
        place = int(np.frombuffer(self.places, "<u4")[i // SAMPLE])
        skip, byte = i % SAMPLE, place // 8
        window = 64
        while True:
            flags = np.unpackbits(np.frombuffer(self.high[byte : byte + window], np.uint8), bitorder="little")
            ones = np.flatnonzero(flags[place % 8 :])
            if len(ones) > skip:
                break
            window *= 2
        high = place + int(ones[skip]) - i
        start = i * self.bits
        raw = int.from_bytes(self.low[start // 8 : (start + self.bits + 7) // 8], "little")
        return (high << self.bits) | ((raw >> (start % 8)) & ((1 << self.bits) - 1))

    def span(self, i: int, j: int) -> np.ndarray:
        """The values from the i-th to before the j-th, from the bits between two stored places."""
        if j <= i:
            return np.zeros(0, np.int64)
        places = np.frombuffer(self.places, "<u4")
        first, behind = i - i % SAMPLE, -(-j // SAMPLE)
        start, end = int(places[first // SAMPLE]), int(places[behind]) if behind < len(places) else 8 * len(self.high)
        flags = np.unpackbits(np.frombuffer(self.high[start // 8 : (end + 7) // 8], np.uint8), bitorder="little")
        ones = start - start % 8 + np.flatnonzero(flags)
        at = np.arange(i, j)
        high = ones[ones >= start][at - first] - at
        if not self.bits:
            return high
        bit = i * self.bits
        low = np.unpackbits(np.frombuffer(self.low[bit // 8 : (j * self.bits + 7) // 8], np.uint8), bitorder="little")
        low = low[bit % 8 : bit % 8 + (j - i) * self.bits].reshape(j - i, self.bits)
        return (high << self.bits) | (low.astype(np.int64) @ (1 << np.arange(self.bits, dtype=np.int64)))

    def values(self) -> np.ndarray:
        return self.span(0, self.n)


def _segment(part: int, seg: int, docs: list[int | None], rows: list[bytes], width: int) -> dict:
    ids = np.frombuffer(b"".join(rows), "<u4").astype("<u2" if width == 2 else "<u4")
    ends = np.cumsum([len(r) // 4 for r in rows])
    named = np.array([d for d in docs if d is not None], np.int64)
    first = int(named[0]) if len(named) else 0
    out = {
        "part": part,
        "seg": seg,
        "n_docs": len(docs),
        "null_docs": len(docs) - len(named),
        "first_doc": first,
        "n_ids": len(ids),
        "width": width,
        "ids": ids.tobytes(),
    }
    for which, code in (("ends", EliasFano.build(ends)), ("docs", EliasFano.build(named - first))):
        out |= {f"{which}_{name}": getattr(code, name) for name, _ in _EF}
    return out


def write(docs: DataFrame, path: str, vocabulary_path: str, end_id: int) -> None:
    """Encode every text, append ``end_id``, and write all in ascending doc_id order to ``path``.

    The texts are dealt out by ranges of doc_id and sorted within them, so each task
    encodes and writes a run of the order on its own; a lost task is run again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(vocabulary_path)
        width = 2 if max(len(known.tokens) - 1, end_id) < 1 << 16 else 4
        part, seg = TaskContext.get().partitionId(), 0
        ids, rows, held = [], [], 0
        end = end_id.to_bytes(4, "little")
        names = SEGMENT.names

        def out():
            row = _segment(part, seg, ids, rows, width)
            kinds = {"part": pa.int32(), "seg": pa.int32(), "width": pa.int32(), "ends_bits": pa.int32(), "docs_bits": pa.int32()}
            return pa.RecordBatch.from_arrays([pa.array([row[n]], kinds.get(n)) for n in names], names=names)

        for whole in batches:
            for batch in slices(whole):
                for doc, code in zip(batch.column(0).to_pylist(), known.encode_array(batch.column(1)).to_pylist()):
                    if rows and held + len(code) // 4 + 1 > SEGMENT_IDS:
                        yield out()
                        ids, rows, held, seg = [], [], 0, seg + 1
                    ids.append(doc)
                    rows.append(code + end)
                    held += len(code) // 4 + 1
        if rows:
            yield out()

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(run, SEGMENT).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Starts add three parts: inside the segment (from its boundaries), of the segment in
    its part, and of the part; only the last is a sum over all parts, one row each.
    """
    stored = spark.read.schema(SEGMENT).parquet(path)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in SEGMENT.names}
                n, nulls = row["n_docs"], row["null_docs"]
                bounds = EliasFano(*(row[f"ends_{x}"] for x, _ in _EF), n)
                named = EliasFano(*(row[f"docs_{x}"] for x, _ in _EF), n - nulls)
                stored_ids, before = np.frombuffer(row["ids"], f"<u{row['width']}"), 0
                for s in range(0, n, READ_DOCS):
                    ends = bounds.span(s, min(n, s + READ_DOCS))
                    starts = np.append(before, ends[:-1])
                    ids = memoryview(stored_ids[before : int(ends[-1])].astype("<u4").tobytes())
                    at = ((np.append(starts, ends[-1]) - before) * 4).tolist()
                    docs = named.span(max(s - nulls, 0), max(s + len(ends) - nulls, 0)) + row["first_doc"]
                    before = int(ends[-1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["part"]] * len(ends), pa.int32()),
                            pa.array([row["seg"]] * len(ends), pa.int32()),
                            pa.array([None] * (len(ends) - len(docs)) + docs.tolist(), pa.int64()),
                            pa.array(starts, pa.int64()),
                            pa.array(ends - starts, pa.int64()),
                            pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                        ],
                        names=DOCUMENT.names,
                    )

    inside = stored.mapInArrow(run, DOCUMENT)
    sizes = stored.select("part", "seg", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    before = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    segments = sizes.withColumn("seg_start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(parts, "part")
    segments = segments.select("part", "seg", (F.col("part_start") + F.col("seg_start")).alias("base"))
    return inside.join(segments, ["part", "seg"]).select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )
