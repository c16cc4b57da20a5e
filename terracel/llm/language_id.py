"""Language identification by error-correcting output codes over n-gram classifiers."""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, stage
from .registry import query

UNKNOWN = "und"
#: Hashed features: byte bigrams and trigrams of the lower-cased text, other than letters blanked.
BINS = 1 << 14
#: About so many labelled rows of each language train the classifiers: the documented bound of the sample.
SAMPLE_PER_LANGUAGE = 3_000
#: The most frequent languages that are learnt.
MAX_LANGUAGES = 256
#: A text whose two nearest codewords differ in loss by less than this share of the larger is ambiguous.
AMBIGUOUS = 0.05
TEXTS_AT_ONCE = 64
LETTER = regex.compile(r"\p{L}")
BLANK = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


class Model(NamedTuple):
    """Languages, their codewords (+1, -1), weights of features for each bit, scale and weight of each bit."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A codeword of +1 and -1 for each of ``n`` classes: all two-sided splits up to 5 classes, else random splits far apart."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= 5:
        splits = [[1 if 0 in s or i in s else -1 for i in range(n)] for k in range(n - 1) for s in combinations(range(1, n), k)]
        return np.array([[1 if i == 0 else v for i, v in enumerate(s)] for s in splits], np.int8).T
    bits = int(np.ceil(12 * np.log2(n)))
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(axis=0, dtype=int)) < n]
        gap = min(int((code[i] != code[j]).sum()) for i, j in combinations(range(n), 2))
        if gap > far:
            best, far = code, gap
    return best


def count_features(texts: list[str]) -> np.ndarray:
    """Feature counts of each text, a row of BINS numbers."""
    out = np.zeros((len(texts), BINS), np.float32)
    raws = [t.lower().encode("utf-8", "replace").translate(BLANK) for t in texts]
    lengths = np.array([len(r) + 3 for r in raws])
    # two blanks and a break between texts: no feature crosses it
    joined = np.frombuffer(b"".join(b" " + r + b" \x00" for r in raws), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    for k, step in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        if len(joined) < k:
            continue
        m = len(joined) - k + 1
        code, clean = np.zeros(m, np.uint32), np.ones(m, bool)
        for i in range(k):
            part = joined[i : i + m]
            code = code << np.uint32(8) | part
            clean &= part != 0
        slot = (code * np.uint32(step)) >> np.uint32(32 - 14)
        at = owner[:m][clean] * BINS + slot[clean]
        out += np.bincount(at, minlength=out.size).reshape(out.shape).astype(np.float32)
    return out


def in_groups(batch: pa.RecordBatch, column: int):
    """(offset, texts) of TEXTS_AT_ONCE rows at a time; null as None."""
    for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
        yield lo, batch.column(column).slice(lo, TEXTS_AT_ONCE).to_pylist()


def _language_counts(batches):
    """Feature counts of each language over a task's rows."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lo, texts in in_groups(batch, 1):
            languages = batch.column(0).slice(lo, len(texts)).to_pylist()
            # each text counts alike, whatever its length
            counts = count_features([t or "" for t in texts])
            counts /= np.maximum(counts.sum(axis=1, keepdims=True), 1)
            for language, row in zip(languages, counts, strict=True):
                total.setdefault(language, np.zeros(BINS))
                total[language] += row
    for language, row in total.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_pydict({"lang": [language] * len(at), "bin": at.astype(np.int32), "n": row[at]})


def margins(counts: np.ndarray, model: Model) -> np.ndarray:
    """Score of each bit for each text, in units of the bit's spread."""
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return share @ model.weights / model.scale


def decode(z: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword, its score and whether it is ambiguous, by weighted logistic loss."""
    loss = np.logaddexp(0, -z[:, None, :] * model.codes[None, :, :]) @ model.trust
    best = loss.argmin(axis=1)
    score = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    score = 1 / score.sum(axis=1)
    if loss.shape[1] < 2:
        return best, score, np.zeros(len(best), bool)
    two = np.sort(loss, axis=1)[:, :2]
    return best, score, (two[:, 1] - two[:, 0]) < AMBIGUOUS * two[:, 1]


def _bit_results(shared):
    """Margins of a task's rows summed up for each bit: rows, signed sum, sum of squares, right ones."""

    def run(batches):
        model: Model = shared.value
        place = {x: i for i, x in enumerate(model.languages)}
        sums = np.zeros((4, model.codes.shape[1]))
        for batch in batches:
            for lo, texts in in_groups(batch, 1):
                truth = [place[x] for x in batch.column(0).slice(lo, len(texts)).to_pylist()]
                z = margins(count_features([t or "" for t in texts]), model) * model.codes[truth]
                sums += np.stack([np.full(z.shape[1], len(z)), z.sum(axis=0), (z * z).sum(axis=0), (z > 0).sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"bit": np.arange(sums.shape[1], dtype=np.int32)} | dict(zip("nsqr", sums, strict=True)))

    return run


def train(labelled: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on about ``sample_per_language`` rows of each language of ``labelled`` (lang, text, key), drawn by a hash of key.

    Of more than ``max_languages`` languages the most frequent are learnt, the first by name of equally frequent
    ones; rows of the others, mostly errors in the column, are left out of the sample.

    Each bit of the code is a naive-Bayes classifier of the languages on its one side against those on the
    other.  Its margins over the sample give its scale and, by its accuracy, its weight in decoding.  What reaches
    the driver is bounded by the languages, features and bits, and the sample by the parameter.
    """
    spark = labelled.sparkSession
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], codewords(0), np.zeros((BINS, 0)), np.ones(0), np.ones(0))
    share = spark.createDataFrame([(r["lang"], min(1.0, sample_per_language / r["n"])) for r in sizes], "lang string, share double")
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1 << 30)) / float(1 << 30)
    sample = stage(labelled.join(F.broadcast(share), "lang").filter(drawn < F.col("share")).select("lang", "text"), "sample")
    rows = sample.mapInArrow(_language_counts, "lang string, bin int, n double").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), BINS))
    place = {x: i for i, x in enumerate(languages)}
    for r in rows.collect():
        counts[place[r["lang"]], r["bin"]] = r["n"]
    codes = codewords(len(languages))
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-12) + 0.5 / BINS
    p /= p.sum(axis=1, keepdims=True)
    weights = np.stack([np.log(p[c > 0].mean(axis=0)) - np.log(p[c < 0].mean(axis=0)) for c in codes.T], axis=1) if codes.size else np.zeros((BINS, 0))
    model = Model(languages, codes, weights, np.ones(codes.shape[1]), np.ones(codes.shape[1]))
    if not codes.size:
        return model
    shared = spark.sparkContext.broadcast(model)
    told = sample.mapInArrow(_bit_results(shared), "bit int, n double, s double, q double, r double").groupBy("bit").agg(
        *[F.sum(c).alias(c) for c in "nsqr"]
    )
    scale, trust = np.ones(codes.shape[1]), np.ones(codes.shape[1])
    for r in told.collect():
        scale[r["bit"]] = max((r["q"] / max(r["n"], 1)) ** 0.5, 1e-9) / 3
        right = (r["r"] + 1) / (r["n"] + 2)
        trust[r["bit"]] = max(np.log(right / (1 - right)), 0.05)
    return model._replace(scale=scale, trust=trust / trust.mean())


def _predict(shared):
    def run(batches):
        model: Model = shared.value
        for batch in batches:
            names, scores, flags = [], [], []
            for _, texts in in_groups(batch, batch.num_columns - 1):
                known = [bool(t) and LETTER.search(t) is not None for t in texts]
                if not model.languages:
                    known = [False] * len(texts)
                best = iter(zip(*decode(margins(count_features([t for t, k in zip(texts, known, strict=True) if k]), model), model), strict=True)) if any(known) else iter(())
                for k in known:
                    b, s, a = next(best) if k else (-1, 0.0, False)
                    names.append(model.languages[b] if k else UNKNOWN)
                    scores.append(float(s))
                    flags.append(bool(a))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "ambiguous"],
            )

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and ambiguous, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0; repeated rows get equal answers; very long texts
    are counted whole; an empty table gives no rows; other columns pass through, but those named like the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in (text_col, "lang_pred", "score", "ambiguous")]
    given = docs.select(*rest, text_col)
    new = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType())]
    schema = T.StructType([*given.schema.fields, *[T.StructField(*x) for x in new]])
    return given.mapInArrow(_predict(shared), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def train_on_documents(docs: DataFrame) -> Model:
    """Fit on the documents with a lang that are not held out."""
    return train(docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.col("doc_id").alias("key")))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of all documents."""
    docs = read_table(spark, folder, "documents")
    found = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), train_on_documents(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
