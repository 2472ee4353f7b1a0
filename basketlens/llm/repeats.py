"""Passages of at least ``length`` units that also stand in a document of smaller id: the exchange.

Documents are dealt once into groups by a digest of their id; the groups keep their
texts, and only what is needed to compare them travels, packed per (group, bucket):

1. ``_fingerprints``: each group names the anchors (anchors.py) of its windows by
   fingerprint. Buckets find those named for two documents or more; false coincidences
   cost work only.
2. ``_spans``: for these anchors each group sends the distinct spans (the text of a run
   of windows with one anchor) with the least and greatest doc_id that holds them. A
   passage that thousands of documents share is one span per group.
3. ``_compared``: all windows with one anchor meet in one bucket. Spans that are all alike
   are settled by their least doc_id; others go to a solver, which finds all maximal
   repeats among them. Groups get back the parts of their spans that stand in a
   document of smaller id, and that id.
4. ``_cleaned``: each group marks these parts in its texts and removes them.

The three uses of the dealt texts are one exchange in one plan (reused). Nothing is
collected, and a lost executor's work is repeated from its inputs. Number of groups and
buckets follows spark.sql.shuffle.partitions. A null doc_id counts as larger than any.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.anchors import Rolling, runs
from basketlens.llm.common import mix64, partitions

#: Units that are hashed at a time; longer documents are taken in pieces that overlap by a window.
PIECE = 1 << 20
NULL_ID = np.iinfo(np.int64).max
_BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

#: solver(span contents, group of each, least doc_id of each) -> span, start, end (units), least doc_id
Solver = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Units:
    """What a text is a sequence of: "bytes" or "words"; windows of ``length``, anchors of ``gram`` units."""

    kind: str
    length: int
    gram: int

    def sequences(self, texts: list[str | None]) -> Sequences:
        return Sequences(self, [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts])


class Sequences:
    """Some documents as one row of units: hashes, and where each document's begin."""

    def __init__(self, units: Units, texts: list[bytes]) -> None:
        self.units, self.texts = units, texts
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        if units.kind == "bytes":
            self.raw = b"".join(texts)
            data = np.frombuffer(self.raw, np.uint8)
            self.hashes = _BYTE_HASH[data]
            self.bounds = np.append(0, np.cumsum(sizes))
        else:
            self.raw = b" ".join([*texts, b""])
            data = np.frombuffer(self.raw, np.uint8)
            word = np.concatenate([[False], ~_IS_SPACE[data], [False]])
            edge = np.flatnonzero(word[1:] != word[:-1])
            self.starts, self.ends = edge[::2], edge[1::2]
            self.hashes = Rolling(_BYTE_HASH[data]).of(self.starts, self.ends)
            self.bounds = np.searchsorted(self.starts, np.append(0, np.cumsum(sizes + 1)))

    def content(self, a: int, b: int) -> bytes:
        """Units a to b, words with one space between."""
        if self.units.kind == "bytes":
            return self.raw[a:b]
        return b" ".join(self.raw[self.starts[a] : self.ends[b - 1]].split())

    def kept(self, doc: int, removed: np.ndarray) -> bytes:
        """What is left of a document without the units that are removed."""
        a, b = self.bounds[doc], self.bounds[doc + 1]
        gone = removed[a:b]
        if self.units.kind == "bytes":
            return np.frombuffer(self.texts[doc], np.uint8)[~gone].tobytes() if gone.any() else self.texts[doc]
        words = self.texts[doc].split()
        return b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)

    def runs(self):
        """Runs of windows (anchors.runs) in all documents, taken piece by piece; and the key of each one's span."""
        length, out, offset = self.units.length, [], 0
        whole = self.bounds
        cuts = [0]
        for i in range(1, len(whole)):
            if whole[i] - whole[cuts[-1]] > PIECE and i - 1 > cuts[-1]:
                cuts.append(i - 1)
        cuts.append(len(whole) - 1)
        for i, j in zip(cuts, cuts[1:]):
            lo, hi = int(whole[i]), int(whole[j])
            for start in range(lo, max(hi, lo + 1), PIECE):
                end = min(hi, start + PIECE + length - 1)
                inner = whole[i : j + 1]
                bounds = np.unique(np.clip(inner, start, end))
                if len(bounds) < 2:
                    continue
                anchor, first, last, _, code, rolling = runs(self.hashes[start:end], bounds - start, length, self.units.gram)
                key = rolling.of(first, last + length) ^ mix64((anchor - first + 1).astype(np.uint64))
                out.append((code, key, first + start, last + start))
        if not out:
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none.astype(np.uint64), none, none
        return tuple(np.concatenate(x) for x in zip(*out))


def _pack(**columns) -> bytes:
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


BLOCK = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("grp", T.IntegerType()), T.StructField("block", T.BinaryType())]
)
_BLOCK = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("block", pa.binary())])


def _blocks(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _BLOCK)], schema=_BLOCK)


def _ids(table: pa.Table) -> np.ndarray:
    return np.array([NULL_ID if d is None else d for d in table.column("doc_id").to_pylist()], np.int64)


def _parts(table: pa.Table):
    """The documents of a group, some at a time."""
    step = max(1, int(table.num_rows * (2 * PIECE) // max(table.nbytes, 1)))
    for start in range(0, table.num_rows, step):
        yield table.slice(start, step)


def _bucket(code: np.ndarray, buckets: int) -> np.ndarray:
    return ((code >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _name(code: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of an anchor in one number."""
    return (_bucket(code, buckets).astype(np.uint64) << np.uint64(32)) | (code & np.uint64(0xFFFFFFFF))


def _by_bucket(bucket: np.ndarray):
    """For entries sorted by bucket: (bucket, slice)."""
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(cuts, np.append(cuts[1:], len(bucket)))]


def _fingerprints(units: Units, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        names, docs = [], []
        for part in _parts(table):
            seqs, ids = units.sequences(part.column("text").to_pylist()), _ids(part)
            code, _, first, _ = seqs.runs()
            names.append(_name(code, buckets))
            docs.append(ids[np.searchsorted(seqs.bounds, first, side="right") - 1])
        name, doc = np.concatenate(names), np.concatenate(docs)
        order = np.argsort(name, kind="stable")
        name, doc = name[order], doc[order]
        starts = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
        if not len(starts):
            return _blocks([])
        several = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
        name = name[starts]
        grp = table.column("grp")[0].as_py()
        low = (name & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        rows = []
        for bucket, part in _by_bucket((name >> np.uint64(32)).astype(np.int64)):
            rows.append((bucket, grp, _pack(name=low[part], several=several[part])))
        return _blocks(rows)

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Per group, the fingerprints that two documents or more have."""
    blocks = [_unpack(b) for b in table.column("block").to_pylist()]
    names = [b.column("name").to_numpy() for b in blocks]
    every = np.sort(np.concatenate(names))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    several = [n[b.column("several").to_numpy(zero_copy_only=False)] for n, b in zip(names, blocks)]
    found = np.union1d(twice, np.concatenate(several)) if len(every) else every
    rows = []
    if len(found):
        for bucket, grp, name in zip(table.column("bucket").to_pylist(), table.column("grp").to_pylist(), names):
            at = np.minimum(np.searchsorted(found, name), len(found) - 1)
            own = name[found[at] == name]
            if len(own):
                rows.append((bucket, grp, _pack(name=own)))
    return _blocks(rows)


def _spans(units: Units, buckets: int):
    def run(table: pa.Table, repeated: pa.Table) -> pa.Table:
        if not table.num_rows or not repeated.num_rows:
            return _blocks([])
        found = [
            (np.uint64(bucket) << np.uint64(32)) | _unpack(block).column("name").to_numpy().astype(np.uint64)
            for bucket, block in zip(repeated.column("bucket").to_pylist(), repeated.column("block").to_pylist())
        ]
        wanted = np.sort(np.concatenate(found))
        codes, keys, least, most, contents = [], [], [], [], []
        for part in _parts(table):
            seqs, ids = units.sequences(part.column("text").to_pylist()), _ids(part)
            code, key, first, last = seqs.runs()
            name = _name(code, buckets)
            at = np.minimum(np.searchsorted(wanted, name), len(wanted) - 1)
            hit = np.flatnonzero(wanted[at] == name)
            if not len(hit):
                continue
            hit = hit[np.argsort(key[hit], kind="stable")]
            code, key, first, last = code[hit], key[hit], first[hit], last[hit]
            doc = ids[np.searchsorted(seqs.bounds, first, side="right") - 1]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            codes.append(code[starts])
            keys.append(key[starts])
            least.append(np.minimum.reduceat(doc, starts))
            most.append(np.maximum.reduceat(doc, starts))
            contents += [seqs.content(a, b + units.length) for a, b in zip(first[starts].tolist(), last[starts].tolist())]
        if not keys:
            return _blocks([])
        code, key, lo, hi = map(np.concatenate, (codes, keys, least, most))
        # merge what several parts of the group have alike
        order = np.lexsort((key, _bucket(code, buckets)))
        code, key, lo, hi = code[order], key[order], lo[order], hi[order]
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (code[1:] != code[:-1])))
        lo, hi = np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)
        code, key, order = code[starts], key[starts], order[starts]
        grp = table.column("grp")[0].as_py()
        rows = []
        for bucket, part in _by_bucket(_bucket(code, buckets)):
            text = pa.array([contents[i] for i in order[part].tolist()], pa.binary())
            rows.append((bucket, grp, _pack(code=code[part], key=key[part], least=lo[part], most=hi[part], text=text)))
        return _blocks(rows)

    return run


def _compared(units: Units, solver: Solver):
    def run(table: pa.Table) -> pa.Table:
        blocks = [_unpack(b) for b in table.column("block").to_pylist()]
        if not blocks:
            return _blocks([])
        every = pa.concat_tables(blocks)
        size = np.cumsum([0, *[b.num_rows for b in blocks]])
        code, key = every.column("code").to_numpy(), every.column("key").to_numpy()
        least, most, text = every.column("least").to_numpy(), every.column("most").to_numpy(), every.column("text")
        order = np.lexsort((key, code))
        starts = np.flatnonzero(np.append(True, (key[order][1:] != key[order][:-1]) | (code[order][1:] != code[order][:-1])))
        one, own_min = order[starts], np.minimum.reduceat(least[order], starts)  # a span each
        span_of = np.empty(len(order), np.int64)
        span_of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        anchor = code[one]
        cuts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        count = np.diff(np.append(cuts, len(anchor)))
        group = np.repeat(np.arange(len(cuts)), count)
        alone = np.repeat(count, count) == 1
        contents = text.combine_chunks().take(pa.array(one))
        several = np.flatnonzero(~alone)
        span, begin, end, doc = solver(contents.take(pa.array(several)).to_pylist(), group[several], own_min[several])
        better = doc < own_min[several[span]]
        span, begin, end, doc = span[better], begin[better], end[better], doc[better]
        # every span is a repeat of itself, against its own least doc_id; an end of -1: the whole span
        span = np.concatenate([np.arange(len(one)), several[span]])
        begin = np.concatenate([np.zeros(len(one), np.int64), begin])
        end = np.concatenate([np.full(len(one), -1), end])
        doc = np.concatenate([own_min, doc])
        order = np.argsort(span, kind="stable")
        span, begin, end, doc = span[order], begin[order], end[order], doc[order]
        first = np.searchsorted(span, np.arange(len(one) + 1))
        rows = []
        for i, grp in enumerate(table.column("grp").to_pylist()):
            own = np.arange(size[i], size[i + 1])
            n = np.diff(first)[span_of[own]]
            who = np.repeat(own, n)
            at = np.repeat(first[span_of[own]], n) + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            later = most[who] > doc[at]
            who, at = who[later], at[later]
            if len(who):
                block = _pack(key=key[who], begin=begin[at].astype(np.int32), end=end[at].astype(np.int32), doc=doc[at])
                rows.append((0, grp, block))
        return _blocks(rows)

    return run


def _cleaned(units: Units):
    def run(table: pa.Table, parts: pa.Table) -> pa.Table:
        blocks = [_unpack(b) for b in parts.column("block").to_pylist()] if parts.num_rows else []
        if blocks:
            every = pa.concat_tables(blocks)
            key, begin, end, doc = (every.column(c).to_numpy() for c in ("key", "begin", "end", "doc"))
            order = np.argsort(key, kind="stable")
            key, begin, end, doc = key[order], begin[order].astype(np.int64), end[order].astype(np.int64), doc[order]
        out = []
        for part in _parts(table):
            seqs, ids = units.sequences(part.column("text").to_pylist()), _ids(part)
            change = np.zeros(len(seqs.hashes) + 1, np.int64)
            if blocks:
                _, own, first, last = seqs.runs()
                lo, hi = np.searchsorted(key, own), np.searchsorted(key, own, side="right")
                n = hi - lo
                run_of = np.repeat(np.arange(len(own)), n)
                at = np.repeat(lo, n) + np.arange(len(run_of)) - np.repeat(np.cumsum(n) - n, n)
                owner = np.searchsorted(seqs.bounds, first[run_of], side="right") - 1
                later = ids[owner] > doc[at]
                run_of, at = run_of[later], at[later]
                to = np.where(end[at] < 0, last[run_of] + units.length, first[run_of] + end[at])
                np.add.at(change, first[run_of] + begin[at], 1)
                np.add.at(change, to, -1)
            removed = np.cumsum(change[:-1]) > 0
            total = np.append(0, np.cumsum(removed))
            begins = removed & ~np.append(False, removed[:-1])
            begins[seqs.bounds[:-1][seqs.bounds[:-1] < len(removed)]] |= removed[seqs.bounds[:-1][seqs.bounds[:-1] < len(removed)]]
            spans = np.append(0, np.cumsum(begins))
            a, b = seqs.bounds[:-1], seqs.bounds[1:]
            out.append(
                pa.table(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_units": pa.array(b - a, pa.int64()),
                        "n_removed": pa.array(total[b] - total[a], pa.int64()),
                        "n_spans": pa.array(spans[b] - spans[a], pa.int64()),
                        "kept": pa.array([seqs.kept(i, removed) for i in range(len(a))], pa.binary()),
                    }
                )
            )
        return pa.concat_tables(out) if out else _CLEAN_ARROW.empty_table()

    return run


CLEAN = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_units", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)
_CLEAN_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_units", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)


def without_repeats(docs: DataFrame, units: Units, solver: Solver) -> DataFrame:
    """Per row of docs: doc_id, n_units, n_removed, n_spans (removed runs) and kept (what is left, UTF-8)."""
    n = partitions(docs.sparkSession)
    groups, buckets = 2 * n, 2 * n
    grp = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(groups)).cast("int")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("grp", grp)
    names = dealt.groupBy("grp").applyInArrow(_fingerprints(units, buckets), BLOCK)
    repeated = names.groupBy("bucket").applyInArrow(_repeated, BLOCK)
    spans = dealt.groupBy("grp").cogroup(repeated.groupBy("grp")).applyInArrow(_spans(units, buckets), BLOCK)
    found = spans.groupBy("bucket").applyInArrow(_compared(units, solver), BLOCK)
    return dealt.groupBy("grp").cogroup(found.groupBy("grp")).applyInArrow(_cleaned(units), CLEAN)
