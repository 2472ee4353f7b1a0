"""BPE encoding and decoding with a public word-level BPE vocabulary.

Encoding merges many words at once: the symbols of all new words of a batch stand in
one flat numpy array; each round looks every adjacent pair up by binary search over
the sorted pair keys, takes per word the pair of lowest rank, and merges all its
places. A worker remembers the chunks (texts between white space) and the words that it
saw last, so that a word is merged once, whatever stands beside it; texts are cut, counted
and put together again as Arrow and numpy arrays.

The result equals that of the tokenizers library (no added special tokens, unused
truncation and padding): added tokens found in the raw text, NFC, white space, lower
case, split, byte-level symbols, merges; decoding joins the tokens by spaces.

Rows: null text counts as empty (no ids). Texts of any length are read whole. Equal
rows get equal results, empty tables give empty ones, other columns stay unless they
have the name of a result.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from basketlens.llm.common import append_columns

#: Distinct chunks, and distinct words, that a worker remembers; beyond it, the older half goes.
CACHE_ENTRIES = 400_000
#: Unicode's White_Space: the library's \s. Fixed values.
_WHITE = "\t-\r \x85\xa0  -     　"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shown = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in shown):
        shown[b] = chr(256 + i)
    return [shown[b] for b in range(256)]


def gathered(ids: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``at`` of a pool of ids (piece i ends at ``ends[i]``), put together, and where each of them ends."""
    sizes = np.diff(ends, prepend=0)[at]
    out = np.cumsum(sizes)
    total = int(out[-1]) if len(out) else 0
    return ids[np.repeat(ends[at] - out, sizes) + np.arange(total)], out


class Known:
    """Texts with their ids: texts as an Arrow array, ids in one pool. Beyond ``entries``, the half that was asked for last stays."""

    def __init__(self, entries: int) -> None:
        self.entries, self.round = entries, 0
        self.texts, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.asked = np.zeros(0, np.int64)

    def find(self, texts: pa.Array) -> np.ndarray:
        """The place of each text, -1 where it is not known."""
        self.round += 1
        if len(self.texts) > self.entries:
            keep = np.sort(np.argsort(-self.asked, kind="stable")[: self.entries // 2])
            self.ids, self.ends = gathered(self.ids, self.ends, keep)
            self.texts, self.asked = self.texts.take(pa.array(keep)), self.asked[keep]
        at = pc.fill_null(pc.index_in(texts, value_set=self.texts), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.asked[at[at >= 0]] = self.round
        return at

    def add(self, texts: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        self.texts = pa.concat_arrays([self.texts, texts])
        self.ends = np.concatenate([self.ends, ends + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        self.asked = np.append(self.asked, np.full(len(texts), self.round))

    def places(self, texts: pa.Array, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of each of the distinct texts; ``learn`` gives ids and their ends for those that are new."""
        at = self.find(texts)
        new = np.flatnonzero(at < 0)
        if len(new):
            some = texts.take(pa.array(new))
            ids, ends = learn(some)
            at[new] = len(self.texts) + np.arange(len(new))
            self.add(some, ids, ends)
        return at


class WordBpe:
    """One vocabulary file, ready for encoding and decoding."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        pattern = split["pattern"]["Regex"].replace(r"[^\s", f"[^{_WHITE}")
        #: Pretokens, and the line breaks that stand between chunks.
        self.marked = regex.compile(rf"\n|{pattern}")
        self.white = regex.compile(f"[{_WHITE}]+")
        self.added = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        # a pair's key is one number, in 32 bits where the vocabulary allows it
        self.kind, self.size = (np.uint32 if size < 1 << 16 else np.int64), size
        # byte -> id of its symbol, inside a word and at its end
        shown = byte_symbols()
        self.inner = np.array([vocab[c] for c in shown], self.kind)
        self.last = np.array([vocab[c + self.suffix] for c in shown], self.kind)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], self.kind)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.by_rank = np.array([vocab[a + b] for a, b in pairs], self.kind)
        self.shown = pa.array(self.tokens)
        self.known_chunks, self.known_words = Known(CACHE_ENTRIES), Known(CACHE_ENTRIES)

    # -- merging -------------------------------------------------------------------------

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray, look: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each place looked at; one beyond all where there is none."""
        last = len(symbols) - 1
        after = np.minimum(look + 1, last)
        key = symbols[look] * self.kind(self.size) + symbols[after]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (owner[look] == owner[after]) & (look < last)
        return np.where(found, self.rank[at], np.int32(len(self.keys)))

    def merge(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the bytes of words and their lengths: ids of all words in one array, and where each word ends. No word is empty."""
        n = len(lengths)
        ends = np.cumsum(lengths)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(n, dtype=np.int32), lengths)
        done_symbols, done_owner = [np.zeros(0, self.kind)], [np.zeros(0, np.int32)]
        none = np.int32(len(self.keys))
        rank = np.full(len(symbols), none)
        look = np.arange(len(symbols))
        while len(symbols):
            rank[look] = self._ranks(symbols, owner, look)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(symbols)))
            more = np.repeat(best < none, size)
            if not more.all():
                done_symbols.append(symbols[~more])
                done_owner.append(owner[~more])
                symbols, owner, rank = symbols[more], owner[more], rank[more]
                size, best = size[best < none], best[best < none]
                if not len(symbols):
                    break
            # of overlapping places (a a a), every other one from the left
            places = np.flatnonzero(rank == np.repeat(best, size))
            start = np.append(True, (places[1:] != places[:-1] + 1) | (owner[places[1:]] != owner[places[:-1]]))
            run = np.maximum.accumulate(np.where(start, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbols[places] = self.by_rank[rank[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            moved = places - np.arange(len(places))
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            look = np.concatenate([moved, np.maximum(moved - 1, 0)])
        who = np.concatenate(done_owner)
        order = np.argsort(who, kind="stable")
        return np.concatenate(done_symbols)[order].astype("<u4"), np.cumsum(np.bincount(who, minlength=n))

    # -- texts ---------------------------------------------------------------------------

    def _lower(self, text: str) -> str:
        if not text.isascii():
            # character by character: no final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """merge() of an Arrow array."""
        bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        return self.merge(raw, np.diff(bounds))

    def _plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks without added tokens, and where each chunk ends."""
        tokens = self.marked.findall(self._lower("\n".join(chunks)) + "\n")
        number: dict[str, int] = {"\n": 0}
        at = np.array([number.setdefault(t, len(number)) for t in tokens])
        words = self.known_words.places(pa.array(list(number)[1:], pa.string()), self._merged)
        ids, ends = gathered(self.known_words.ids, self.known_words.ends, words[at[at > 0] - 1])
        return ids, np.append(0, ends)[np.cumsum(at > 0)[at == 0]]

    def _special(self, chunk: str) -> tuple[np.ndarray, np.ndarray]:
        """As _plain, of one chunk that holds added tokens."""
        pieces, start = [], 0
        for m in [*self.added.finditer(chunk), None]:
            piece = chunk[start : m.start() if m else len(chunk)]
            pieces.append(self._plain([piece])[0] if piece else np.zeros(0, "<u4"))
            if m:
                pieces.append(np.array([self.special[m.group()]], "<u4"))
                start = m.end()
        return (ids := np.concatenate(pieces)), np.array([len(ids)])

    def learn(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks (texts between white space), and where each chunk ends."""
        texts = chunks.to_pylist()
        if self.added is None or not self.added.search("\n".join(texts)):
            return self._plain(texts)
        runs, start = [], 0
        for i in [*(i for i, c in enumerate(texts) if self.added.search(c)), len(texts)]:
            runs += [self._plain(texts[start:i])] if i > start else []
            runs += [self._special(texts[i])] if i < len(texts) else []
            start = i + 1
        before = np.cumsum([0, *[len(ids) for ids, _ in runs]])
        return np.concatenate([ids for ids, _ in runs]), np.concatenate([ends + b for (_, ends), b in zip(runs, before)])

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All chunks of the texts, and where those of each text start (and the last end)."""
        parts = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        flat, bounds = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
        odd = pc.match_substring_regex(texts, "[\x1c-\x1f]")
        if pc.any(odd).as_py():
            # white space for Arrow and Python, but not for the library: split by pattern
            rows = [self.white.split(t) if t else [] for t in texts.to_pylist()]
            flat, bounds = pa.array([c for row in rows for c in row], pa.string()), np.cumsum([0, *map(len, rows)])
        empty = pc.equal(flat, "")
        if pc.any(empty).as_py():  # before leading and behind trailing white space
            keep = np.asarray(pc.invert(empty))
            flat, bounds = flat.filter(pa.array(keep)), np.append(0, np.cumsum(keep))[bounds]
        return flat, bounds

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit integers, in one binary a text."""
        flat, bounds = self.split(texts)
        coded = flat.dictionary_encode()
        places = self.known_chunks.places(coded.dictionary, self.learn)
        ids, ends = gathered(self.known_chunks.ids, self.known_chunks.ends, places[coded.indices.to_numpy()])
        offsets = np.append(0, ends)[bounds] * 4
        kind, width = (pa.binary(), np.int32) if offsets[-1] < 1 << 31 else (pa.large_binary(), np.int64)
        out = pa.Array.from_buffers(kind, len(texts), [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(ids.astype("<u4"))])
        return out.cast(pa.binary())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """As encode_array, of Python texts."""
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()

    def decode_array(self, ids: pa.Array) -> pa.Array:
        """Of each row of ids, the tokens joined by spaces, special ones too."""
        rows = ids.to_pylist()
        bounds = np.cumsum([0, *[len(r) // 4 if r else 0 for r in rows]])
        flat = np.frombuffer(b"".join(r or b"" for r in rows), "<u4")
        tokens = self.shown.take(pa.array(flat.astype(np.int64)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), tokens), " ")

    def decode(self, ids: bytes | None) -> str:
        """The tokens joined by spaces, special ones too."""
        return self.decode_array(pa.array([ids], pa.binary()))[0].as_py()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> WordBpe:
    """The vocabulary, once per Python worker."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """docs with the column ``into``: ids as little-endian unsigned 32-bit integers, in one binary."""
    return append_columns(docs, [text], [(into, T.BinaryType())], lambda texts: [vocabulary(path).encode_array(texts)], arrow=True)


def decode(tokens: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """tokens with the column ``into``: the text that the ids stand for."""
    return append_columns(tokens, [ids], [(into, T.StringType())], lambda rows: [vocabulary(path).decode_array(rows)], arrow=True)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """encode and decode in one pass of the workers: docs with ``ids`` and ``decoded``."""

    def run(texts):
        ids = vocabulary(path).encode_array(texts)
        return [ids, vocabulary(path).decode_array(ids)]

    return append_columns(docs, [text], [("ids", T.BinaryType()), ("decoded", T.StringType())], run, arrow=True)
