"""K-d shards, conversation trie and importance resampling against SQL and plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from basketlens.llm import importance, kd_shards, prefix_trie
from basketlens.llm.oracle import IMPORTANCE_SQL, KD_SHARDS_SQL, TRIE_SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc_rows():
    rng = random.Random(3)
    rows = [(i, "w%d " % i * rng.randrange(1, 60), rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", "b", None]), 1) for i in range(300)]
    rows += [(1000 + i, "the same footer", "en", rng.choice("ab"), 15) for i in range(400)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "a", 0), (2002, "é" * 9000, "fr", "", 9000), (None, "no id", "en", "a", 5)]
    return rows + [(7, "w7 again", "en", "a", 8), (7, "w7 again", "en", "a", 8), (2003, "last", "zh", "source-of-a-long-name", 4)]


def in_duck(rows, columns, name):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE {name} ({columns})")
    if rows:
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con


def by_value(rows):
    return sorted((tuple(r) for r in rows), key=str)


def listed(docs, shards=8):
    out = kd_shards.listed(docs, shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes"), "shard", "slot", F.lit(None))


def test_shards_equal_sql(spark):
    docs = spark.createDataFrame(doc_rows(), DOCS)
    con = in_duck(doc_rows(), "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT", "documents")
    assert by_value(listed(docs).collect()) == by_value(con.execute(KD_SHARDS_SQL).fetchall())


def test_shards_are_equal_and_gapless(spark):
    rows = [r for r in doc_rows() if r[0] != 2002]
    clash = spark.createDataFrame(rows, DOCS).withColumns({"shard": F.lit("x"), "__size": F.lit(1), "slot": F.lit(2)})
    got = listed(clash).collect()
    assert len(got) == len(rows)
    assert Counter((r[0], r[2]) for r in got) == Counter((d, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    weight, slots = Counter(), {}
    for r in got:
        weight[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    mean = sum(weight.values()) / 8
    assert len(weight) == 8 and max(weight.values()) - min(weight.values()) < 0.12 * mean + 240
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_copies_share_a_shard_unless_a_cut_needs_them(spark):
    pairs = [(i, f"text number {i // 2} " * 40, "en", "ab"[i % 2], 1) for i in range(2000)]
    got = listed(spark.createDataFrame(pairs, DOCS)).collect()
    shards = {}
    for r in got:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert len(shards) == 1000 and all(len(s) == 1 for s in shards.values())
    hot = [(i, "copy", "en", "a", 4) for i in range(4000)]
    assert sorted(Counter(r["shard"] for r in listed(spark.createDataFrame(hot, DOCS)).collect()).values())[0] > 440


def test_shards_by_bytes_files_and_edges(spark, tmp_path):
    assert listed(spark.createDataFrame([], DOCS)).collect() == []
    few = spark.createDataFrame([(1, "a", None, None, 1), (2, "b" * 100_000, None, None, 1)], DOCS)
    assert len({r["shard"] for r in listed(few).collect()}) == 2
    docs = spark.createDataFrame(doc_rows(), DOCS)
    n = round(sum(len((r[1] or "").encode()) + 1 for r in doc_rows()) / 10_000)
    assert {r["shard"] for r in kd_shards.assign(docs, target_bytes=10_000).select("shard").collect()} <= set(range(n))
    kd_shards.write_shards(docs, str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 5


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def conversation_rows():
    rng, rows = random.Random(5), []
    for c in [*range(-25, 130), 1000, 1001, 5003]:
        if c % 20 == 0 and rng.random() < 0.3:
            continue
        for turn in range(rng.randrange(1, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", ""]) if turn else "hello there"))
    rows += [(40, 2500, "user", "late"), (41, None, None, "first"), (41, 0, "user", None), (42, 3, "b", "tie"), (42, 3, "a", "tie"), (42, 3, "a", "tie")]
    rows += [(None, 1, "user", "nobody"), (5003, -5, "user", "x " * 40_000)]
    rows += [(300 + i, t, "user", f"common {t}") for i in range(60) for t in range(2)]
    rng.shuffle(rows)
    return rows


def plain_trie(rows):
    """Every prefix of every rebuilt conversation in one dictionary."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, len(path)))
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1].decode())) for p in below if p)
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in below)]
        ends = ",".join(str(c) for c, n in sorted(members) if n == len(path))
        parent = min(c for c, _ in nodes[path[:-1]]) if path else None
        out.append((min(members)[0], len(path), parent, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


_TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_equals_plain_trie_and_sql(spark, monkeypatch):
    rows = conversation_rows()
    table = spark.createDataFrame(rows, CONVERSATIONS).withColumns({"place": F.lit("clash"), "n": F.lit(0), "s0": F.lit(1)})
    got = by_value(prefix_trie.nodes_with_ends(table).select(*_TRIE).collect())
    assert got == by_value(plain_trie(rows))
    con = in_duck(rows, "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", "conversations")
    assert got == by_value(con.execute(TRIE_SQL).fetchall())
    # runs of two turns and blocks of four ids: everything is carried over
    monkeypatch.setattr(prefix_trie, "RUN", 2)
    monkeypatch.setattr(prefix_trie, "END_BLOCK", 4)
    assert by_value(prefix_trie.nodes_with_ends(table).select(*_TRIE).collect()) == got


def test_trie_gives_turns_back_and_bears_an_empty_table(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert prefix_trie.nodes_with_ends(empty).count() == 0
    rows = [(20, 0, "user", "a"), (21, 0, "user", "a"), (21, 1, "bot", "b"), (22, 0, None, None), (22, 1, "user", "c"), (22, 2, "user", "d"), (22, 3, "user", "e"), (22, 4, "user", "f")]
    table = spark.createDataFrame(rows, CONVERSATIONS)
    nodes, ends = prefix_trie.trie(table)
    assert ends.count() == 3
    said = {(r["conv_id"], r["depth"]): (r["role"], r["text"]) for r in prefix_trie.turns_of_nodes(table, nodes).collect()}
    for (conv, depth), turn in said.items():
        assert turn == (None, None) if depth == 0 else turn in [("user", t) for t in "acdef"] + [("bot", "b"), ("", "")]


BENCH = "item_id long, text string"


def importance_rows():
    rng = random.Random(9)
    words = ["Straße", "data", "a1", "x_y", "É", "日本", "end.", "0", "mixed-Case", "z" * 70]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 45))), None, "s", 1) for i in range(200)]
    rows += [(300 + i, "a common line of text " * 8, "en", "hot", 1) for i in range(90)]
    rows += [(500, None, None, None, None), (501, "", None, None, 0), (502, "One", None, None, 3), (503, "word " * 30_000, None, None, 1)]
    return rows + [(1, rows[1][1], None, "s", 1), (None, "no id at all " * 9, None, None, 1)]


TARGET = [(1, "a common line of Data"), (2, None), (3, "É 日本 end"), (4, "mixed Case 0")]


def test_importance_equals_sql(spark):
    con = in_duck(importance_rows(), "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT", "documents")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", TARGET)
    docs = spark.createDataFrame(importance_rows(), DOCS).withColumns({"score": F.lit("clash"), "buckets": F.lit(1)})
    got = importance.resample(docs, spark.createDataFrame(TARGET, BENCH))
    assert by_value(got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == by_value(con.execute(IMPORTANCE_SQL).fetchall())


@pytest.mark.parametrize(("longest", "buckets", "piece"), [(1, 97, 1 << 20), (3, 70_000, 7)])
def test_features_are_the_checksums_of_runs(monkeypatch, longest, buckets, piece):
    monkeypatch.setattr(importance, "PIECE", piece)
    texts = [r[1] for r in importance_rows()[:60]] + [None, "", "Ünï-Code\x00 a", "y" * 300 + " " + "w" * 200]
    n_words, got = importance.features_of(texts, longest, buckets)
    for text, n, row in zip(texts, n_words, got):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
        assert n == len(words)
        assert Counter(row.tolist()) == Counter(zlib.crc32(r.encode()) % buckets for r in runs)
        for word, (a, b) in importance.words_with_offsets(text):
            assert low[a:b] == word


def test_importance_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert importance.resample(none, spark.createDataFrame(TARGET, BENCH)).count() == 0
    got = importance.resample(spark.createDataFrame(importance_rows(), DOCS), spark.createDataFrame([], BENCH))
    able = got.where("n_words >= 20").count()
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, able // 4 + 1))
