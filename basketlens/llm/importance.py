"""Importance resampling of documents towards a target corpus.

1. Words: an untrained Regex Split of the tokenizers library cuts the text (A-Z in lower
   case) into words with their offsets. Windows over neighbouring offset pairs are the
   features: all runs of 1 to ``longest`` words, joined by one space, repeats counted. The
   crc32 of a run follows from those of its words, so no run is put together as a text.
2. Counts: each task adds up how many features of its texts fall into each bucket of the
   checksum; only ``buckets`` sums per task are shuffled.
3. Gains: per bucket a smoothed log ratio of target and corpus, in whole thousandths. A
   document's weight is the floored mean gain of its features.
4. Draw: each document adds a Gumbel number of its own, which depends on seed and doc_id
   only; the highest scores among documents of ``least_words`` or more are drawn (sampling
   without replacement by weight). Scores are whole numbers in a narrow range, so ranks
   come from counts per score and a short order inside each score, never from one task.

Rows: null texts are empty: no features, weight 0, not drawn unless ``least_words`` is 0.
Texts of any length are read whole, in pieces that end between words. Repeated rows count
as often as they stand; rows of one doc_id get the same number and are ordered by
n_features. A null doc_id counts as an empty name and comes last among ties. An empty
corpus gives an empty result, an empty target one of target counts 0. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketlens.llm.common import slices, written

#: Letters outside ASCII, digits and lower-case letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Characters that are cut into words at a time.
PIECE = 1 << 20
#: Lengths (bytes) up to which a checksum is moved on by table.
TABLE_BYTES = 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BETWEEN = regex.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

_FEATURES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_features", T.LongType()),
        T.StructField("buckets", T.BinaryType()),
    ]
)
_COUNTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
_SCORED = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "n_words", "n_features", "weight", "score")]
)


@lru_cache(maxsize=1)
def splitter():
    """The library's split: words stay, what lies between them goes."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def words_with_offsets(text: str | None) -> Iterator[tuple[str, tuple[int, int]]]:
    """The words of a text and where they start and end (in characters)."""
    if not text:
        return
    low, start = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"), 0
    while start < len(low):
        cut = _BETWEEN.search(low, start + PIECE) if len(low) - start > PIECE else None
        end = cut.start() if cut else len(low)
        for word, (a, b) in splitter().pre_tokenize_str(low[start:end]):
            yield word, (start + a, start + b)
        start = end


@lru_cache(maxsize=1)
def _moves() -> np.ndarray:
    """[length, byte place, byte]: what a checksum's byte becomes when ``length`` zero bytes follow."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = (byte >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (byte & np.uint32(1)))
    now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [now]
    for _ in range(TABLE_BYTES):
        now = (now >> np.uint32(8)) ^ byte[now & np.uint32(255)]
        out.append(now)
    return np.stack(out)


def joined(left: np.ndarray, right: np.ndarray, tails: list[bytes], at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of texts put together: ``left`` of the first part; the second, ``tails[at]``, has ``right`` and ``sizes`` bytes."""
    move, n = _moves(), np.minimum(sizes, TABLE_BYTES)
    out = right.copy()
    for place in range(4):
        out ^= move[n, place, (left >> np.uint32(8 * place)) & np.uint32(255)]
    for i in np.flatnonzero(sizes > TABLE_BYTES).tolist():
        out[i] = zlib.crc32(tails[at[i]], int(left[i]))
    return out


def features_of(texts: list[str | None], longest: int, buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words of each text, and the buckets of all its features."""
    known: dict[str, int] = {}
    flat: list[int] = []
    bounds = [0]
    for text in texts:
        flat += [known.setdefault(word, len(known)) for word, _ in words_with_offsets(text)]
        bounds.append(len(flat))
    tails = [b" " + w.encode("utf-8", "surrogatepass") for w in known]
    alone = np.fromiter((zlib.crc32(t[1:]) for t in tails), np.uint32, len(tails))
    spaced = np.fromiter(map(zlib.crc32, tails), np.uint32, len(tails))
    sizes = np.fromiter(map(len, tails), np.int64, len(tails))
    at, ends = np.array(flat, np.int64), np.array(bounds)
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    # windows over neighbouring words of one text, one word longer each time
    runs, owners, crc, start = [], [], alone[at], np.arange(len(at))
    for length in range(1, longest + 1):
        if length > 1:
            start = start[start + length - 1 < ends[row[start] + 1]]
            last = at[start + length - 1]
            crc = joined(previous[start], spaced[last], tails, last, sizes[last])
        runs.append((crc % np.uint32(buckets)).astype(_kind(buckets)))
        owners.append(row[start])
        previous = np.zeros(len(at), np.uint32)
        previous[start] = crc
    every, owner = np.concatenate(runs), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(texts)))
    return np.diff(ends), np.split(every[order], cuts)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, key: str = "doc_id", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_features and the buckets of all features (packed numbers)."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                n_words, rows = features_of(batch.column(1).to_pylist(), longest, buckets)
                columns = [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_FEATURES.names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), "text").mapInArrow(run, _FEATURES)


def histogram(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket: ``buckets`` numbers, whatever the size of the corpus."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column(0):
                total += np.bincount(np.frombuffer(row.as_buffer(), _kind(buckets)), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=_COUNTS.names)

    out = np.zeros(buckets, np.int64)
    for bucket, n in featured.select("buckets").mapInArrow(run, _COUNTS).groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, the log of its smoothed share in the target over that in the corpus, in floored thousandths."""
    n = len(corpus)
    every, wanted = float(corpus.sum() + n), float(target.sum() + n)
    ratio = ((t + 1.0) * every / ((s + 1.0) * wanted) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A Gumbel number of the document's own, in floored thousandths."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(featured: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score."""

    def run(batches):
        kind = _kind(len(gain))
        for batch in batches:
            docs, n = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            sums = [int(gain[np.frombuffer(row.as_buffer(), kind)].sum()) for row in batch.column(3)]
            weight = [total // many if many else 0 for total, many in zip(sums, n)]
            total = [w + noise(doc, seed) for w, doc in zip(weight, docs)]
            columns = [*batch.columns[:3], pa.array(weight, pa.int64()), pa.array(total, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=_SCORED.names)

    return featured.select(*_FEATURES.names).mapInArrow(run, _SCORED)


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """scored with ``rank``: 1, 2, 3... by falling score, ties to the smaller doc_id; null where not drawn."""
    able = scored.where(F.col("n_words") >= least_words)
    # one row per score: scores are whole numbers between the least gain and the largest noise
    falling = Window.orderBy(F.desc("score"))
    counts = able.groupBy("score").agg(F.count("*").alias("n"))
    counts = counts.select(
        "score",
        (F.sum("n").over(falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("above"),
        F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).alias("drawn"),
    )
    inside = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features"))
    rank = F.col("above") + F.col("place")
    numbered = able.withColumn("place", inside).join(counts, "score")
    numbered = numbered.select(*scored.columns, F.when(rank <= F.col("drawn"), rank).alias("rank"))
    rest = scored.where(~(F.col("n_words") >= least_words)).select("*", F.lit(None).cast("long").alias("rank"))
    return numbered.unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank (null where not drawn).

    ``target`` needs a column ``text`` only. Buckets are written once, so no text is cut twice.
    """
    featured = written(features(docs, longest=longest, buckets=buckets))
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest=longest, buckets=buckets)
    gain = gains(histogram(featured, buckets), histogram(wanted, buckets))
    return ranked(written(score(featured, gain, seed)), percent, least_words)
