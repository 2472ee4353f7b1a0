"""Personal data: high-recall generators propose spans, boosted trees select among them.

Everything runs in Spark SQL expressions and Spark ML; no Python on the executors.

1. Base matches per kind (email, ip, card, phone), leftmost and not overlapping, with
   their rules (octets, Luhn, digit counts). Failing matches are dropped, not retried.
   These spans are always in the result.
2. Generators propose further spans of looser formats, overlapping ones too (addresses
   written out, telephone numbers without a plus or inside a longer run of digits,
   digit groups of a card, strict octets inside longer dotted numbers).
3. Gradient-boosted trees score all proposals by format and context (digit and
   separator counts, check sums, neighbouring characters, words before). They learn
   from proposals that equal a base match (1) or a match that failed its rule (0): all
   distinct ones of all documents, but for a fifth that is held out. Matches of equal
   features are one row with their number; those of one kind and class weigh
   STRATUM_WEIGHT together at most. With fewer than LEAST_ROWS of either class there is
   no model.
4. Per kind the threshold is calibrated on all of the held-out fifth: the
   lowest score from which up the held-out precision reaches PRECISION. A kind without
   a threshold that has fewer than LEAST_ROWS held-out rows goes by a fixed rule
   (``by_rule``), as do all kinds without a model: a word for the kind stands before the
   span, and a card's check sum holds.

Patterns are possessive and start only where a match can start, so long runs of
digits or letters cost linear time and no stack.

Rows: null and empty texts have no spans. Repeated rows and equal doc_ids stay rows of
their own. Positions count code points. Empty tables give empty results; other columns
are ignored (find) or kept (redact).
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import written

KINDS = ["email", "ip", "card", "phone"]
#: What the matches of a kind and class weigh together at most, however many they are.
STRATUM_WEIGHT = 2_500
#: Rows of different features in a task of the fit.
ROWS_PER_TASK = 20_000
LEAST_ROWS = 20
PRECISION = 0.95
TREES, DEPTH = 20, 4
LEAST_BINS = 32
#: Code points of context kept on either side.
CONTEXT = 32

_LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns, as the contract has them, in a form that never backtracks far.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # only maximal runs of at least 13 digits: shorter ones fail the rule anyway
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Strings that a text must hold for a pattern to match at all.
_HINT = {"email": "@", "ip": ".", "phone": "+"}
#: (kind, name, pattern) of the further generators.
GENERATORS = [
    ("email", "spelled", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{{1,63}}+(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]{{1,63}}+){{1,4}}"),
    ("ip", "octets", r"(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?![0-9])"),
    ("card", "digits", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", "groups", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    ("phone", "national", r"(?<![0-9])(?:\+?1[ .-]?)?\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
]
#: Words before a span that speak for a kind. Fixed values.
HINT_WORDS = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|pay",
    "phone": "phone|tel|call|fax|mobile",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits holds."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    weighed = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.split(match, r"\.")
        return F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            parts, lambda p: F.when(F.length(F.regexp_replace(p, "^0+", "")) <= 3, F.right(p, F.lit(3)).try_cast("int")).otherwise(999) <= 255
        )
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    return F.length(digits).between(9, 15)


def _spans(text: Column, kind: str, generator: str, pattern: str) -> Column:
    """All matches of a pattern in order: kind, generator, match, start, end, before, after.

    The pieces between the matches give the positions: a running sum of lengths.
    """
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    rows = F.arrays_zip(found.alias("m"), F.slice(pieces, F.lit(1), F.size(found)).alias("g"), F.slice(pieces, F.lit(2), F.size(found)).alias("n"))
    empty = F.array().cast("array<struct<kind:string,generator:string,match:string,start:int,end:int,before:string,after:string>>")

    def step(state, row):
        start = state["at"] + F.length(row["1"])
        end = start + F.length(row["0"])
        span = F.struct(
            F.lit(kind).alias("kind"), F.lit(generator).alias("generator"), row["0"].alias("match"), start.alias("start"),
            end.alias("end"), F.right(row["1"], F.lit(CONTEXT)).alias("before"), F.left(row["2"], F.lit(CONTEXT)).alias("after"),
        )
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    numbered = F.transform(rows, lambda r: F.struct(r["m"].alias("0"), r["g"].alias("1"), r["n"].alias("2")))
    out = F.aggregate(numbered, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda s: s["spans"])
    hint = _HINT.get(kind) if generator == "base" else None
    some = text.isNotNull() & (F.contains(text, F.lit(hint)) if hint else text.rlike("[0-9]" if kind != "email" else r"[\[(] ?at ?[\])]"))
    return F.when(some, out).otherwise(empty)


def proposals(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``__base`` (all base matches, with ``valid``) and ``__loose`` (what the generators propose)."""
    t = F.col(text)

    def judged(kind: str) -> Column:
        return F.transform(_spans(t, kind, "base", BASE[kind]), lambda s: s.withField("valid", _valid(kind, s["match"])))

    base = F.concat(*map(judged, KINDS))
    loose = F.concat(*[_spans(t, k, g, p) for k, g, p in GENERATORS])
    return docs.withColumns({"__base": base, "__loose": loose})


FEATURES = [
    "n_digits", "n_chars", "n_separators", "luhn", "distinct_digits", "plus", "parens", "dots",
    "letter_before", "letter_after", "digit_before", "digit_after", "assigned", *[f"word_{k}" for k in KINDS], *[f"is_{k}" for k in KINDS],
]


def features(s: Column) -> dict[str, Column]:
    """Format and context of a span (a struct) as numbers, in the order of FEATURES."""
    digits = _digits(s["match"])
    flag = lambda c: c.cast("double")
    before, after = F.coalesce(s["before"], F.lit("")), F.coalesce(s["after"], F.lit(""))
    return {
        "n_digits": F.length(digits).cast("double"),
        "n_chars": F.length(s["match"]).cast("double"),
        "n_separators": F.length(F.regexp_replace(s["match"], "[A-Za-z0-9]", "")).cast("double"),
        "luhn": flag(F.when(F.length(digits).between(1, 40), _luhn(digits)).otherwise(False)),
        "distinct_digits": F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        "plus": flag(F.startswith(s["match"], F.lit("+"))),
        "parens": flag(F.contains(s["match"], F.lit("("))),
        "dots": F.length(F.regexp_replace(s["match"], r"[^.]", "")).cast("double"),
        "letter_before": flag(before.rlike(r"\p{L}$")),
        "letter_after": flag(after.rlike(r"^\p{L}")),
        "digit_before": flag(before.rlike("[0-9][ .-]?$")),
        "digit_after": flag(after.rlike("^[ .-]?[0-9]")),
        "assigned": flag(before.rlike("[=:\"']$")),
        **{f"word_{k}": flag(F.lower(before).rlike(HINT_WORDS[k])) for k in KINDS},
        **{f"is_{k}": flag(s["kind"] == k) for k in KINDS},
    }


def by_rule(kind: str, s: Column) -> Column:
    """Whether a proposal (its generator has seen to its octets or digit groups) counts without examples to learn from."""
    hinted = F.lower(F.coalesce(s["before"], F.lit(""))).rlike(HINT_WORDS[kind])
    return hinted & _valid("card", s["match"]) if kind == "card" else hinted


class Selector:
    """The boosted trees and the threshold of each kind, or its rule, as one expression over a span's features.

    Inside an expression, spans need not leave the row of their text to be scored.
    """

    def __init__(self, model: GBTClassificationModel | None, thresholds: dict[str, float], ruled: list[str]) -> None:
        self.trees = [(w, self._read(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees)] if model else []
        self.thresholds, self.ruled = thresholds, ruled

    def _read(self, node) -> tuple:
        if node.getClass().getSimpleName() == "LeafNode":
            return (node.prediction(),)
        split = node.split()
        return FEATURES[split.featureIndex()], split.threshold(), self._read(node.leftChild()), self._read(node.rightChild())

    def score(self, values: Column) -> Column:
        """Probability that a span is personal data, from the struct of its features."""

        def walk(node: tuple) -> Column:
            if len(node) == 1:
                return F.lit(node[0])
            name, limit, low, high = node
            return F.when(values[name] <= limit, walk(low)).otherwise(walk(high))

        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + weight * walk(tree)
        return 1 / (1 + F.exp(-2 * margin))

    def accepted(self, spans: Column) -> Column:
        """The spans of an array whose score reaches the threshold of their kind, or that the rule of their kind takes."""

        def ruled(s: Column) -> Column:
            return F.exists(F.array(F.lit(False), *[(s["kind"] == k) & by_rule(k, s) for k in self.ruled]), lambda x: x)

        if not self.thresholds:
            return F.filter(spans, ruled)
        scored = F.transform(spans, lambda s: F.struct(s.alias("span"), F.struct(*[c.alias(n) for n, c in features(s).items()]).alias("f")))
        scored = F.transform(scored, lambda x: F.struct(x["span"].alias("span"), self.score(x["f"]).alias("score")))

        def good(x: Column) -> Column:
            out = ruled(x["span"])
            for kind, least in self.thresholds.items():
                out = out | ((x["span"]["kind"] == kind) & (x["score"] >= least))
            return out

        return F.transform(F.filter(scored, good), lambda x: x["span"])


def held_out(order: Column) -> Column:
    """A fifth of the rows, by the last digits of their digest."""
    return F.conv(F.right(order, F.lit(4)), 16, 10).cast("int") % 5 == 0


def examples(proposed: DataFrame) -> DataFrame:
    """All distinct base matches with what stands around them, those of equal features as one row: kind, label, held, FEATURES, n.

    A match that copies repeat, with what stands around it, counts once.
    """
    found = proposed.select(F.explode("__base").alias("b"))
    parts = ["kind", "match", "before", "after"]
    each = found.select(*[F.col(f"b.{c}").alias(c) for c in parts], F.col("b.valid").cast("double").alias("label")).distinct()
    held = held_out(F.md5(F.concat_ws("\t", *parts)))
    named = each.select("kind", "label", held.alias("held"), *[c.alias(n) for n, c in features(F.struct(*parts)).items()])
    return named.groupBy("kind", "label", "held", *FEATURES).agg(F.count("*").alias("n"))


def fit(proposed: DataFrame) -> Selector:
    """Learn from the base matches of all documents; by rule where there are too few of a class."""
    rows = written(examples(proposed))
    sizes = rows.groupBy("kind", "label").agg(F.sum("n").alias("n"), F.sum(F.lit(1)).alias("rows")).collect()  # 7 at most
    if min(sum(r["n"] for r in sizes if r["label"] == label) for label in (0.0, 1.0)) < LEAST_ROWS:
        return Selector(None, {}, KINDS)
    # so that a rare kind or class is not crowded out, the rows of a frequent one weigh less each
    least = F.lit(1.0)
    for r in sizes:
        if r["n"] > STRATUM_WEIGHT:
            least = F.when((F.col("kind") == r["kind"]) & (F.col("label") == r["label"]), STRATUM_WEIGHT / r["n"]).otherwise(least)
    n = sum(r["rows"] for r in sizes)
    rows = rows.coalesce(1 + n // ROWS_PER_TASK).withColumn("weight", F.col("n") * least)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    # up to the square of maxBins, rows are all looked at for cut points
    trees = GBTClassifier(
        labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=max(LEAST_BINS, math.isqrt(n) + 1), seed=7
    )
    model = trees.fit(rows.where(~F.col("held")).select("features", "label", "weight"))
    grid = F.floor(vector_to_array("probability")[1] * 50)
    scored = model.transform(rows.where("held")).groupBy("kind", grid.alias("bin"))
    bins = scored.agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()  # 4 kinds x 51 bins at most
    thresholds, ruled = {}, []
    for kind in KINDS:
        own, good, n = sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]), 0.0, 0
        for r in own:
            good, n = good + r["good"], n + r["n"]
            if good / n >= PRECISION:
                thresholds[kind] = r["bin"] / 50
        if kind not in thresholds and n < LEAST_ROWS:
            ruled.append(kind)
    return Selector(model, thresholds, ruled)


def _plain(spans: Column) -> Column:
    order = {k: i for i, k in enumerate(KINDS)}
    rank = lambda s: F.element_at(F.create_map(*[F.lit(x) for p in order.items() for x in p]), s["kind"])
    listed = F.transform(spans, lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(F.array_distinct(listed))


def selected(proposed: DataFrame, selector: Selector) -> DataFrame:
    """proposed with ``base`` and ``spans`` in place of all matches and proposals."""
    base = _plain(F.filter("__base", lambda s: s["valid"]))
    rows = proposed.withColumn("base", base)

    def clear(s: Column) -> Column:
        return ~F.exists("base", lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (b["end"] > s["start"]))

    more = _plain(selector.accepted(F.filter("__loose", clear)))
    return rows.withColumn("spans", F.array_sort(F.array_distinct(F.concat("base", more)))).drop("__base", "__loose")


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' columns but for the text, with ``base`` and ``spans``: arrays of (rank, start, end, kind), in order.

    ``base`` holds the valid base matches; ``spans`` those and the accepted proposals, but
    for proposals that overlap a base span of their kind.
    """
    proposed = written(proposals(docs, text).drop(text))
    return selected(proposed, fit(proposed))


def listed(spans: str | Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    # texts are not shuffled: the fit reads written proposals, then each text is searched again in its row
    selector = fit(written(proposals(docs.select(text), text).drop(text)))
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], (-s["end"]).alias("stop"), s["kind"])))

    def step(state, s):
        end = -s["stop"]
        apart = s["start"] >= state["at"]
        piece = F.concat(state["out"], F.substring(F.col(text), state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], end).alias("at"), F.when(apart, piece).otherwise(state["out"]).alias("out"))

    named = docs.select(*[docs[c].alias(f"__in_{c}") for c in docs.columns], docs[text].alias(text))
    rows = selected(proposals(named, text), selector)
    whole = F.aggregate(
        by_start, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.length(text))),
    )
    changed = F.size("spans") > 0
    rows = rows.withColumn("__text", F.when(changed, whole).otherwise(F.col(text)))
    out = {c: F.col(f"__in_{c}") for c in docs.columns} | {text: F.col("__text")}
    if "n_chars" in docs.columns:
        chars = F.length("__text").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(changed, chars).otherwise(F.col("__in_n_chars"))
    return rows.select(*[column.alias(c) for c, column in out.items()])
