"""Mixing against its SQL and plain loops; personal data against plain patterns."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from basketlens.llm import mixing, pii
from basketlens.llm.oracle import MIXING_SQL

DOCS = "doc_id long, text string, source string, n_chars long"


def mix_rows():
    rows = [(i, "w " * (i * 37 % 90), f"s{i % 5}", 1) for i in range(200)]
    rows += [(300 + i, "hot " * 300, "s0", 1) for i in range(40)] + [(400, None, "s1", 0), (401, "", None, 0), (402, "x y", None, 3)]
    return rows + [(500, "tiny", "zz", 4), (501, None, "empty", 0), (1, "w " * 37, "s1", 1)]


@pytest.mark.parametrize("block", [7, 256])
def test_mix_equals_sql_and_meets_targets(spark, block):
    docs = spark.createDataFrame(mix_rows(), DOCS).withColumn("key", F.lit("clash"))
    columns = ["doc_id", "size", "source_size", "target", "taken", *(["first_slot"] if block == 256 else [])]
    got = mixing.mix(docs, block_words=block).select(*columns).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", mix_rows())
    expected = [r[: len(columns)] for r in con.execute(MIXING_SQL).fetchall()]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    by = {}
    for _, size, source_size, target, taken, *_ in expected:
        assert taken <= 3 * size
        by[(source_size, target)] = by.get((source_size, target), 0) + taken
    assert all(abs(taken - target) <= 1 for (_, target), taken in by.items())


def test_schedule_prefixes_are_near_targets(spark):
    sources = spark.createDataFrame([("sa", 60_000, 1.0e5), ("sb", 60_000, 5.0e4), ("", 60_000, 3.0e4)], "key string, source_size long, target double")
    quota = mixing.quotas(sources, 100)
    slots = mixing.schedule(spark, quota, 180_000, 100).where("slot < 600").groupBy("key").count().collect()
    shares = {r["key"]: r["count"] / 600 for r in slots}
    assert abs(shares["sa"] - 100 / 180) < 0.02 and abs(shares["sb"] - 50 / 180) < 0.02


def test_mixed_documents_hold_the_taken_words(spark):
    docs = spark.createDataFrame(mix_rows(), DOCS)
    taken = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("n")).collect()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in words} == {r["source"]: r["n"] for r in taken if r["n"]}


def test_rows_without_id_and_repeated_rows_meet_their_targets(spark):
    """Rows that agree in id and size are told apart, within a source and between sources."""
    rows = [(None, "w " * 11, s, 1) for s in ("a", "b") for _ in range(30)] + [(7, "x " * 300, "c", 1), (7, "y " * 300, "c", 1), (None, None, "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    taken = {r["source"]: r["n"] for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    mixed = mixing.mixed_documents(docs).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in mixed} == taken


def test_slots_follow_the_reversed_bits(spark):
    """The first slot of one source of two equal ones is slot 0 or 1, and its documents come in steps of two."""
    rows = [(i, "w " * 256, "ab"[i % 2], 1) for i in range(64)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    firsts = {s: sorted(r["first_slot"] for r in got if r["source"] == s and r["first_slot"] is not None) for s in "ab"}
    assert firsts["a"][0] == 0 and firsts["b"][0] == 1
    assert max(b - a for f in firsts.values() for a, b in zip(f, f[1:])) <= 4


def test_mix_of_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], DOCS)).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    None, "", "none here", "a@b.c_d@e.f x@y", "mail me: é漢😀 jo.do+x%1@host-1.example.com, or a@b", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.3.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 5", "1  4111111111111111", "5 -4111111111111111 12", "+1 (988) 555-2485 x",
    "+1 (269) 555-3296 4524132264652876", "call +49 30 1234567 or +1 2", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "9" * 30, "1-" * 4000 + "1",
    "." * 2000 + "@" + "a." * 3000, "a" * 30000 + " @ " + "1." * 9000, "+1" + " " * 5000, "joe (at) example (dot) com 202-555-0147", "5555 5555 5555 4444 9",
]


def test_base_spans_equal_plain_patterns(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string").select("doc_id", "text")
    got = [(r.doc_id, r.b, r.s) for r in pii.find(docs).select("doc_id", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect()]
    assert sorted(g[:2] for g in got) == sorted((i, plain_spans(t)) for i, t, _ in rows)
    assert all(b == s for _, b, s in got)  # too few examples for a model


@pytest.fixture(scope="module")
def many():
    rows = []
    for i in range(120):
        body = f"{i:012d}"
        check = next(c for c in "0123456789" if luhn(f"4{i:014d}{c}"))
        rows.append((i, f"pay with card 4{i:014d}{check} now", 0))
        rows.append((1000 + i, f"number 4{i:014d}{(int(check) + 3) % 10} is none", 0))
        rows.append((2000 + i, f"ip 10.0.{i}.7 and version {300 + i}.1.2.3", 0))
        rows.append((3000 + i, f"phone +1 (202) 555-{1000 + i}, call or +1 2{body}{body}", 0))
    return rows


def test_model_adds_spans_and_keeps_base(spark, many):
    rows = [*many, (9000, "tel 202-555-0147 please", 0), (9001, "phone +1 (269) 555-3296 4524132264652876 x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: (r.b, r.s) for r in pii.find(docs.drop("n_chars")).select("doc_id", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect()}
    assert all(found[i][0] == plain_spans(t) for i, t, _ in rows)
    assert all(set(filter(None, b.split(","))) <= set(s.split(",")) for b, s in found.values())
    proposed = pii.proposals(docs)
    selector = pii.fit(proposed.drop("text"))
    spans = proposed.select(F.explode(F.concat(F.transform("__base", lambda s: s.dropFields("valid")), "__loose")).alias("span"))
    values = spans.withColumns(pii.features(F.col("span"))).withColumn("f", F.struct(*pii.FEATURES)).withColumn("score", selector.score(F.col("f")))
    assert values.where("score < 0 or score > 1").count() == 0
    assert values.where("span.generator = 'base'").agg(F.max("score") - F.min("score")).first()[0] > 0.5
    redacted = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert redacted[5].text == "pay with card [CARD] now" and redacted[5].n_chars == len(redacted[5].text)
    assert redacted[1005].text == many[5 * 4 + 1][1]
    assert "[IP] and version 305.1.2.3" in redacted[2005].text


def test_rare_kinds_go_by_rule(spark):
    rows = [(1, "tel 202-555-0147 please"), (2, "code 202-555-0147 x"), (3, "card 1-4111111111111111 2"), (4, "card 1-4111111111111112 2"), (5, "write to joe (at) example (dot) com")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.b, r.s) for r in pii.find(docs).select("doc_id", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect()}
    assert got == {1: ("", "phone:4:16"), 2: ("", ""), 3: ("", "card:7:23"), 4: ("", ""), 5: ("", "email:9:35")}


def test_hold_out_of_the_least_digests(spark):
    # a sample from very many matches: all digests begin alike
    digests = spark.range(5000).select(F.concat(F.lit("0000"), F.right(F.md5(F.col("id").cast("string")), F.lit(28))).alias("order"))
    assert 0.17 < digests.where(pii.held_out(F.col("order"))).count() / 5000 < 0.23


def test_fit_learns_from_all_matches(spark):
    # more of one kind and class than a sample used to take, twice each
    rows = [(i, f"host 10.{i // 250}.{i % 250}.7 end") for i in range(3000)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    seen = pii.examples(pii.proposals(docs).drop("text"))
    assert {(r.kind, r.label): r.n for r in seen.groupBy("kind", "label").agg(F.sum("n").alias("n")).collect()} == {("ip", 1.0): 3000}
    assert seen.count() < 100  # equal features are one row


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(docs).count() == 0 and pii.redact(docs).count() == 0
