"""Toxicity scores from a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, stage
from .language_id import held_out, in_groups
from .registry import query

#: Terms are words and the first letters of longer ones, hashed.
BINS = 1 << 18
PREFIXES = (4, 5)
#: About so many labelled rows train the machine: the documented bound of the sample.
SAMPLE = 20_000
#: Terms of the machine: in at least LEAST_DOCS rows of the sample, and so many standard deviations off the base rate.
LEAST_DOCS, LEAST_Z, MOST_TERMS = 3, 3.0, 16_384
FACTORS = 8
EPOCHS, BATCH, RATE = 30, 256, 0.05
SHRINK_WEIGHT, SHRINK_FACTOR = 1e-4, 1e-3
#: Scores from here on are predicted as toxic.
THRESHOLD = 0.3
MEMO = 200_000
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


class Model(NamedTuple):
    """Place of each bin among the terms (-1: none), bias, weight and factors of each term."""

    place: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray


class Terms(dict):
    """Bins of a word: its own and those of its prefixes; with ``place``, terms of the machine instead of bins."""

    def __init__(self, place: np.ndarray | None = None):
        super().__init__()
        self.place = place

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MEMO:
            self.clear()
        terms = [word, *["^" + word[:k] for k in PREFIXES if len(word) >= k]]
        bins = {zlib.crc32(t.encode("utf-8", "replace")) % BINS for t in terms}
        if self.place is not None:
            bins = {int(p) for b in bins if (p := self.place[b]) >= 0}
        found = self[word] = tuple(bins)
        return found

    def of(self, text: str | None) -> set[int]:
        """All terms of a whole text."""
        found: set[int] = set()
        for word in set(WORD.findall((text or "").lower())):
            found.update(self[word])
        return found


def raw_scores(rows: list[np.ndarray], bias: float, weight: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """bias + sum of weights + sum over pairs of terms of the products of their factors, for each row of terms."""
    sizes = np.array([len(r) for r in rows])
    out = np.full(len(rows), float(bias))
    some = np.flatnonzero(sizes)
    if len(some):
        at = np.concatenate([rows[i] for i in some])
        first = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        v = factor[at]
        both = np.add.reduceat(v, first) ** 2 - np.add.reduceat(v * v, first)
        out[some] += np.add.reduceat(weight[at], first) + 0.5 * both.sum(axis=1)
    return out


def probability(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(rows: list[np.ndarray], labels: np.ndarray, n_terms: int, seed: int = 11) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by Adam steps on the logistic loss with squared shrinkage."""
    rng = np.random.default_rng(seed)
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    theta = [np.array([np.log(rate / (1 - rate))]), np.zeros(n_terms), rng.normal(0, 0.03, (n_terms, FACTORS))]
    shrink = (0.0, SHRINK_WEIGHT, SHRINK_FACTOR)
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            chosen = [rows[i] for i in part]
            pull = (probability(raw_scores(chosen, theta[0][0], theta[1], theta[2])) - labels[part]) / len(part)
            sizes = np.array([len(r) for r in chosen])
            at = np.concatenate([*chosen, np.zeros(0, np.int64)]).astype(np.int64)
            owner = np.repeat(np.arange(len(chosen)), sizes)
            v = theta[2][at]
            total = np.zeros((len(chosen), FACTORS))
            np.add.at(total, owner, v)
            grads = [np.array([pull.sum()]), np.zeros(n_terms), np.zeros((n_terms, FACTORS))]
            np.add.at(grads[1], at, pull[owner])
            np.add.at(grads[2], at, pull[owner][:, None] * (total[owner] - v))
            step += 1
            for t, g, a, b, s in zip(theta, grads, first, second, shrink, strict=True):
                g += s * t
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                t -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return float(theta[0][0]), theta[1], theta[2]


def _bin_counts(batches):
    """Rows and toxic rows of each bin over a task's rows."""
    terms, n, toxic = Terms(), np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
    for batch in batches:
        for lo, texts in in_groups(batch, 1):
            for label, text in zip(batch.column(0).slice(lo, len(texts)).to_pylist(), texts, strict=True):
                at = np.fromiter(terms.of(text), np.int64)
                n[at] += 1
                toxic[at] += label
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_pydict({"bin": at.astype(np.int32), "n": n[at], "toxic": toxic[at]})


def _as_terms(shared):
    """(toxic, terms) of each row."""

    def run(batches):
        terms = Terms(shared.value)
        for batch in batches:
            for lo, texts in in_groups(batch, 1):
                found = [sorted(terms.of(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "terms"])

    return run


def drawn(rows: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` of ``rows``, by a hash of key; all of them if there are no more."""
    share = min(1.0, sample / max(rows.count(), 1))
    return rows.filter(F.pmod(F.xxhash64(F.lit("toxicity"), "key"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` rows of ``labelled`` (key, toxic, text), drawn by a hash of key; one row per key.

    The sample's terms are counted in Spark; those in enough rows and far enough off the base rate become the
    terms of the machine, and only they (MOST_TERMS a row at most) reach the driver, where it is fitted.
    Rows are taken in the order of their terms, so reruns agree.  Without rows every score is 0.5.
    """
    spark = labelled.sparkSession
    chosen = drawn(labelled.filter("key is not null and toxic is not null"), sample)
    chosen = chosen.groupBy("key").agg(F.max("toxic").cast("int").alias("toxic"), F.min("text").alias("text"))
    chosen = stage(chosen.select("toxic", "text"), "toxic_sample")
    base = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    place = np.full(BINS, -1, np.int32)
    if not base["n"]:
        return Model(place, 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    rate = (base["t"] + 0.5) / (base["n"] + 1)
    z = F.abs(F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    counts = chosen.mapInArrow(_bin_counts, "bin int, n long, toxic long").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    kept = counts.filter((F.col("n") >= LEAST_DOCS) & (z >= LEAST_Z)).orderBy(z.desc(), "bin").limit(MOST_TERMS).select("bin").collect()
    for i, r in enumerate(kept):
        place[r["bin"]] = i
    shared = spark.sparkContext.broadcast(place)
    told = sorted((r["terms"], r["toxic"]) for r in chosen.mapInArrow(_as_terms(shared), "toxic int, terms array<int>").collect())
    bias, weight, factor = fit([np.array(t, np.int64) for t, _ in told], np.array([x for _, x in told], float), len(kept))
    return Model(place, bias, weight, factor)


def _score(shared):
    def run(batches):
        model: Model = shared.value
        terms = Terms(model.place)
        for batch in batches:
            scores = []
            for _, texts in in_groups(batch, batch.num_columns - 1):
                rows = [np.fromiter(terms.of(t), np.int64) for t in texts]
                scores.append(probability(raw_scores([np.sort(r) for r in rows], model.bias, model.weight, model.factor)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate([*scores, np.zeros(0)]))], names=[*batch.schema.names[:-1], "score"]
            )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text.

    A null or empty text has no terms and gets the score of the bias; repeated rows get equal scores; an
    empty table gives no rows; ids may be null or of any type; other columns are left behind.  A very long
    text is one row of one task, which holds its set of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return given.mapInArrow(_score(shared), schema)


def train_on_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents that are not held out; of several labels of a document the greatest counts.

    Labels are drawn first, so the broadcast side has about ``sample`` rows and texts are read once, where they lie.
    """
    marked = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marked = stage(marked.groupBy(F.col("doc_id").alias("key")).agg(F.max("toxic").alias("toxic")), "labels")
    texts = docs.select(F.col("doc_id").alias("key"), "text")
    return train(stage(texts.join(F.broadcast(drawn(marked, sample)), "key"), "labelled"), sample)


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = read_table(spark, folder, "documents")
    model = train_on_labels(docs, read_table(spark, folder, "labels"))
    found = score(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
