"""Toxicity: a counterfactual-regularised linear classifier over the words of whole texts.

Logistic regression on the presence of words and word stems (first letters), with an L1
penalty, so that a few hundred telling ones remain and long texts do not add up noise. Counterfactual penalty: in
every labelled text that names a group, the name is swapped for another of its family,
and the squared change of the score (as log odds) is added to the loss. What the
model learns from mere mentions of groups is taken back by that, so neutral mentions
stay clean.

Fitted on at most TRAIN_ROWS labelled rows (the first by md5 of doc_id, never a row
whose crc32(doc_id) mod 5 is 0) and at most MAX_WORDS words and stems seen in MIN_ROWS of
them, those whose share of toxic rows is the least likely by chance; both bound what the
driver holds. Every text is scored whole.

Rows: null and empty texts get the score of a text without telling words. Several
labels of one doc_id count as toxic if one is. Without labels of both kinds, the score
is their share of toxic rows (0 without labels). Repeated rows are scored alike; an
empty table gives an empty result; columns named like results are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import append_columns, crc_fold, written

TRAIN_ROWS = 20_000
#: The training rows are few: at most so many tasks and files hold them, whatever the shuffle partitions.
TRAIN_TASKS = 8
#: Bytes of text whose words a worker holds as Python strings at a time.
WORDS_CHUNK = 512 << 10
MAX_WORDS = 6_000
#: Letters of the stems of longer words.
STEMS = (4, 5, 6)
MIN_ROWS = 5
L1 = 2e-4
COUNTERFACTUAL = 1.0
STEPS = 250

_LETTERS = re.compile(r"[^\W\d_]+")
#: Families of group names; a swap stays in its family. Fixed values.
IDENTITY = [
    ["women", "men", "girls", "boys", "woman", "man", "transgender", "female", "male"],
    ["gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"],
    ["black", "white", "asian", "african", "european", "latino", "arab", "hispanic", "indian"],
    ["immigrants", "refugees", "foreigners", "migrants", "natives"],
    ["disabled", "blind", "deaf", "old", "young", "elderly"],
    ["femmes", "hommes", "filles", "garçons"],
    ["musulmans", "chrétiens", "juifs", "athées"],
    ["frauen", "männer", "mädchen", "jungen"],
    ["muslime", "christen", "juden", "atheisten"],
    ["mujeres", "hombres", "niñas", "niños"],
    ["musulmanes", "cristianos", "judíos", "ateos"],
]
_SWAP = {w: family[(i + 1) % len(family)] for family in IDENTITY for i, w in enumerate(family)}


def words(text: str | None) -> set[str]:
    """The distinct runs of letters of a text, lower case, and their stems (with a hyphen)."""
    if not text:
        return set()
    whole = set(_LETTERS.findall(text.lower()))
    stems = set()
    for n in STEMS:
        stems.update([w[:n] for w in whole if len(w) > n])
    return whole.union([s + "-" for s in stems])


class Model:
    """Weights of words, and the intercept."""

    def __init__(self, weights: dict[str, float], intercept: float) -> None:
        self.weights, self.intercept = weights, intercept

    def score(self, text: str | None) -> float:
        known = self.weights
        z = self.intercept + sum(sorted(known[w] for w in known.keys() & words(text)))
        return float(1.0 / (1.0 + np.exp(-min(max(z, -40.0), 40.0))))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded training sample."""
    known = labels.where(F.col("toxic").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    picked = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(TRAIN_ROWS)
    # at most TRAIN_ROWS rows of two numbers
    met = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # one row per document, whatever repeats its id: the text of least digest
    digest = F.md5(F.coalesce("text", F.lit("")))
    return met.groupBy("doc_id").agg(F.min_by("text", digest).alias("text"), F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled(docs, labels).coalesce(TRAIN_TASKS)
    bags = append_columns(
        rows, ["text"], [("words", T.ArrayType(T.StringType()))], lambda texts: [[sorted(words(t)) for t in texts]], chunk=WORDS_CHUNK
    )
    bags = written(bags.select("doc_id", "toxic", "words"))
    n, positive = bags.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not 0 < positive < n:
        share = (positive or 0.0) / n if n else 0.0
        return Model({}, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    counts = bags.select(F.explode("words").alias("w"), "toxic").groupBy("w").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    counts = counts.where(F.col("n") >= MIN_ROWS)
    share = positive / n
    surprise = F.abs(F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    vocabulary = sorted(r["w"] for r in counts.orderBy(F.desc(surprise), "w").limit(MAX_WORDS).collect())
    index = {w: i for i, w in enumerate(vocabulary)}
    for w in list(_SWAP):
        index.setdefault(w, len(index))
    numbered = append_columns(
        bags, ["words"], [("at", T.ArrayType(T.IntegerType()))], lambda rows: [[[index[w] for w in r if w in index] for r in rows]],
        chunk=WORDS_CHUNK,
    )
    held = numbered.select("doc_id", "toxic", "at").toArrow().sort_by([("doc_id", "ascending")])
    bags_of = held.column("at").combine_chunks()
    y = np.array(held.column("toxic").to_pylist())
    names = list(index)
    comes = np.full(len(names), -1)
    for w, v in _SWAP.items():
        comes[index[w]] = index[v]
    goes = bags_of.flatten().to_numpy()
    goes = goes[comes[goes] >= 0].astype(np.int64)
    weights, intercept = solve(bags_of, y, len(names), np.stack([goes, comes[goes]], axis=1))
    return Model({names[i]: float(weights[i]) for i in np.flatnonzero(weights)}, float(intercept))


def solve(bags: list[list[int]] | pa.ListArray, y: np.ndarray, n_words: int, pairs: np.ndarray) -> tuple[np.ndarray, float]:
    """Minimise mean log loss + counterfactual penalty + L1, by accelerated proximal gradient steps.

    ``bags``: the words of each row; as an Arrow array they take no Python objects on the driver.
    ``pairs``: for each swap in a labelled text, the word that goes and the word that comes.
    Columns are scaled by their frequency, which evens out the steps of rare and common words.
    """
    bags, n = pa.array(bags, pa.list_(pa.int32())) if isinstance(bags, list) else bags, len(bags)
    row = np.repeat(np.arange(n), bags.value_lengths().to_numpy())
    col = bags.flatten().to_numpy().astype(np.int64)
    seen = np.maximum(np.bincount(col, minlength=n_words), 1.0)
    scale = np.sqrt(n / seen) / 4.0
    value = scale[col]
    swap = COUNTERFACTUAL / n

    def margins(u, b):
        return np.bincount(row, weights=value * u[col], minlength=n) + b

    def loss(u, b):
        z = margins(u, b)
        d = (u * scale)[pairs[:, 0]] - (u * scale)[pairs[:, 1]]
        return np.mean(np.logaddexp(0, z) - y * z) + swap * (d @ d), z

    def gradient(u, z):
        r = (1 / (1 + np.exp(-z)) - y) / n
        g = np.bincount(col, weights=value * r[row], minlength=n_words)
        d = 2 * swap * ((u * scale)[pairs[:, 0]] - (u * scale)[pairs[:, 1]])
        g += scale * (np.bincount(pairs[:, 0], weights=d, minlength=n_words) - np.bincount(pairs[:, 1], weights=d, minlength=n_words))
        return g, r.sum()

    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    u, b = np.zeros(n_words), float(np.log(share / (1 - share)))
    v, c, t, step = u.copy(), b, 1.0, 4.0
    for _ in range(STEPS):
        now, z = loss(v, c)
        gu, gb = gradient(v, z)
        while True:
            moved = v - step * gu
            new_u = np.sign(moved) * np.maximum(np.abs(moved) - step * L1 * scale, 0.0)
            new_b = c - step * gb
            du, db = new_u - v, new_b - c
            if loss(new_u, new_b)[0] <= now + gu @ du + gb * db + (du @ du + db * db) / (2 * step) + 1e-12:
                break
            step /= 2
        next_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new_u + (t - 1) / next_t * (new_u - u), new_b + (t - 1) / next_t * (new_b - b)
        u, b, t, step = new_u, new_b, next_t, step * 1.1
    return u * scale, b


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """docs with the column ``into``: probability of label 1."""
    return append_columns(docs, [text], [(into, T.DoubleType())], lambda texts: [[model.score(t) for t in texts]])
