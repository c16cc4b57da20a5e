"""Periodic run detection: stretches of words that repeat at a fixed distance, found by multi-scale minimizers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, words_of
from .hashing import Powers, mix, window_hashes
from .registry import query

#: A run has at least so many words and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Periods up to LEAST_WORDS / LEAST_PERIODS are found by comparing all words at that distance.
SHORT = LEAST_WORDS // LEAST_PERIODS
#: Bytes of text whose words are searched together, so that short texts share the cost of each step.
BYTES_AT_ONCE = 2_000_000
#: Distinct words that a task numbers before it starts anew.
MEMO = 300_000

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
ARROW_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


class WordNumbers(dict):
    """A number of its own for each word."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def sliding(op, x: np.ndarray, size: int) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``size`` consecutive numbers."""
    span = 1
    while 2 * span <= size:
        x, span = op(x[:-span], x[span:]), 2 * span
    return op(x[: span - size], x[size - span :]) if span < size else x


def minimizers(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places that hold the least hash of some window of ``size`` hashes; of equal ones all do."""
    if len(hashes) < size:
        return np.zeros(0, np.int64)
    edge = np.zeros(size - 1, hashes.dtype)
    least = np.concatenate([edge, sliding(np.minimum, hashes, size), edge])
    return np.flatnonzero(sliding(np.maximum, least, size) == hashes)


def extend(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch [start, end) of places around ``at`` whose words equal those ``lag`` later; empty if ``at``'s does not."""
    lo, hi, step = at, at, 4 * lag
    while hi < len(words) - lag:
        top = min(hi + step, len(words) - lag)
        differ = np.flatnonzero(words[hi:top] != words[hi + lag : top + lag])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = top, 2 * step
    step = 4 * lag
    while lo > 0 and hi > at:
        low = max(lo - step, 0)
        differ = np.flatnonzero(words[low:lo] != words[low + lag : lo + lag])
        if len(differ):
            lo = low + int(differ[-1]) + 1
            break
        lo, step = low, 2 * step
    return lo, hi


class Concatenated:
    """Texts as one array of word numbers, longest first, with SHORT numbers of their own after each: no run crosses them."""

    def __init__(self, texts: list[np.ndarray]):
        self.order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        self.texts = [texts[i] for i in self.order]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.lengths + SHORT)])
        self.words = -1 - np.arange(self.base[-1], dtype=np.int64)
        for at, text in zip(self.base, self.texts, strict=False):
            self.words[at : at + len(text)] = text

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, places, "right") - 1


def with_repeats(texts: list[np.ndarray], powers: Powers) -> list[int]:
    """Texts in which SHORT consecutive words occur twice; a text with a run is one of them, whatever its period."""
    long_ones = [i for i, t in enumerate(texts) if len(t) >= LEAST_WORDS]
    if not long_ones:
        return []
    all_words = Concatenated([texts[i] for i in long_ones])
    hashes = window_hashes(mix(all_words.words.view(np.uint64)), SHORT, powers)
    owner = all_words.owner(np.arange(len(hashes)))
    keys = mix(hashes + mix(owner.astype(np.uint64)))
    order = np.argsort(keys)
    keys = keys[order]
    found = np.unique(owner[order[1:][keys[1:] == keys[:-1]]])
    return [long_ones[all_words.order[i]] for i in found]


def find_runs(texts: list[np.ndarray], powers: Powers) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text that has any, by start, then period; texts are arrays of word numbers.

    Periods up to SHORT come from comparing the words at every such distance.  Longer ones go by scales of
    periods (low, high], high = 1.5 * low.  A run with such a period p holds two windows of ``2 * low + 3 - high``
    grams of ``high`` words that lie p apart and are equal, so their minimizers are p apart too; grams of p
    words or more recur in a run at multiples of p only, so two such minimizers are neighbours among equal
    ones.  Each pair is extended word by word in both directions, which also decides; no hash does.
    A stretch that has a smaller period was found with that one before, as both have the same ends.
    """
    out: dict[int, list[tuple[int, int, int]]] = {}
    chosen = with_repeats(texts, powers)
    if not chosen:
        return out
    c = Concatenated([texts[i] for i in chosen])
    found: list[dict[tuple[int, int], int]] = [{} for _ in chosen]

    def keep(text: int, start: int, end: int, period: int) -> None:
        least = found[text].setdefault((start, end - start), period)
        if period < least:
            found[text][(start, end - start)] = period

    for lag in range(1, SHORT + 1):
        same = np.zeros(max(len(c.words) - lag, 0) + 2, np.int8)
        same[1:-1] = c.words[:-lag] == c.words[lag:]
        turns = np.flatnonzero(np.diff(same))
        starts, ends = turns[::2], turns[1::2] + lag
        long_enough = ends - starts >= LEAST_WORDS
        starts, ends = starts[long_enough], ends[long_enough]
        for text, start, end in zip(c.owner(starts).tolist(), starts.tolist(), ends.tolist(), strict=True):
            keep(text, start - int(c.base[text]), end - int(c.base[text]), lag)

    low = SHORT
    while LEAST_PERIODS * (low + 1) <= c.lengths[0]:
        high = low * 3 // 2
        n = int(np.searchsorted(-c.lengths, -LEAST_PERIODS * (low + 1), "right"))  # texts long enough for this scale
        grams = window_hashes(mix(c.words[: c.base[n]].view(np.uint64)), high, powers)
        places = minimizers(grams, 2 * low + 3 - high)
        keys = grams[places]
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        lags = np.diff(places)
        seeds = np.flatnonzero((keys[1:] == keys[:-1]) & (lags > low) & (lags <= high))
        starts, lags = places[seeds], lags[seeds]
        owners = c.owner(starts)
        by_lag = np.lexsort((starts, lags, owners))
        last = (-1, -1, -1)
        for text, lag, at in zip(owners[by_lag].tolist(), lags[by_lag].tolist(), (starts - c.base[owners])[by_lag].tolist(), strict=True):
            if last[0] == text and last[1] == lag and at < last[2]:
                continue  # the stretch of an earlier seed goes on here
            lo, hi = extend(c.texts[text], at, lag)
            last = (text, lag, hi)
            if hi > lo and hi + lag - lo >= LEAST_PERIODS * lag:
                keep(text, lo, hi + lag, lag)
        low = high
    for text, runs in enumerate(found):
        if runs:
            out[chosen[c.order[text]]] = sorted(((s, n, p) for (s, n), p in runs.items()), key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """``words`` without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _search(batches):
    numbers, powers = WordNumbers(), Powers()
    for batch in batches:
        column = batch.column(1).cast(pa.binary())
        lo = 0
        while lo < batch.num_rows:
            texts, size = [], 0
            for i in range(lo, batch.num_rows):
                texts.append((column[i].as_py() or b"").split())  # bytes split at the six white-space characters
                size += len(column[i].as_py() or b"")
                if size >= BYTES_AT_ONCE:
                    break
            if len(numbers) > MEMO:
                numbers.clear()
            found = find_runs([np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)) for t in texts], powers)
            runs = [found.get(i, []) for i in range(len(texts))]
            flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, len(texts)), pa.array([len(t) for t in texts], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()),
                        pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(ARROW_RUN)),
                    ),
                    pa.array([collapse(t, r) for t, r in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string()),
                ],
                names=[batch.schema.names[0], "n_words", "runs", "collapsed"],
            )
            lo += len(texts)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of every text: doc_id, n_words, runs (array of start, length, period), collapsed.

    A run is a stretch of words with smallest period q that no neighbouring word extends, of at least
    LEAST_WORDS words and LEAST_PERIODS periods; overlapping runs are all reported, by start, then period.
    ``collapsed`` has the words that no run holds after its first period, joined by one space.

    Every row is judged alone, without a shuffle: repeated rows get equal answers, null and empty texts have no
    words and no runs, an empty table gives no rows, ids may be null or of any type, and other columns,
    whatever their names, are left behind.  A very long text is one row of one task: memory is some 100 bytes a
    word and time grows as words times the logarithm of the longest period.  64-bit hashes choose candidates.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_search, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equal ones; null without runs."""
    none = F.lit(None).cast(RUN)
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; for ids whose crc32 ends in 0 the words are repeated in turn from a place and with a period that the id sets.

    A null id leaves its text as it is.
    """
    h, n, a, p = (F.col(c) for c in ("_h", "_n", "_a", "_p"))
    # step by step: in one expression the words would be split again for each of them
    d = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("_h"))
    d = d.withColumn("_words", F.when(h % 10 == 0, words_of(F.col("text"))))
    d = d.withColumn("_n", F.nullif(F.size("_words").cast("long"), F.lit(0))).withColumn("_a", F.floor(h / 10) % n)
    d = d.withColumn("_p", 1 + F.floor((n - a) / (3 + F.floor(h / 10) % 8)))
    turned = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("_words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return d.select("doc_id", F.when(n > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all documents, a tenth of them with planted ones."""
    found = periodic_runs(planted(read_table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    told = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
