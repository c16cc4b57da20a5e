"""Substring dedup by level-wise doubling: only windows repeated at one length are looked at with twice that length."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_join, read_table, stage
from .hashing import Powers, WordHashes, anchors, window_hashes
from .registry import query

WINDOW = 50
TEXTS_AT_ONCE = 128
NOTHING = hashlib.sha256(b"").digest()
#: Ids order documents; a null id comes before all others.
NULL_ID = -(1 << 63)


def rows_of(batch: pa.RecordBatch, at_once: int = TEXTS_AT_ONCE):
    """Slices of a batch, to hold few texts as Python objects."""
    for lo in range(0, batch.num_rows, at_once):
        yield batch.slice(lo, at_once)


def _sketch(window: int):
    """First level: words, digest of the word sequence, and anchored windows of half the length."""
    half = window // 2

    def run(batches):
        memo, powers = WordHashes(), Powers()
        for batch in batches:
            for part in rows_of(batch):
                n_words, digests, hashes, places = [], [], [], []
                for text in part.column(2).to_pylist():
                    words = (text or "").encode().split()
                    n_words.append(len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).digest())
                    at, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
                    if len(words) >= window:
                        h = window_hashes(memo.of(words)[:, 0], half, powers)
                        at = anchors(h, window - half + 1)
                        h = h[at]
                    hashes.append(h.view(np.int64))
                    places.append(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(n_words, pa.int64()), pa.array(digests, pa.binary()),
                        pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "text_hash", "n_words", "digest", "hashes", "places"],
                )

    return run


def starts_around(places: np.ndarray, half: int, window: int, n_words: int) -> np.ndarray:
    """Starts of all windows of a text that hold a window of half the length at one of ``places``."""
    mark = np.zeros(n_words + 2, np.int32)
    lo = np.maximum(places - (window - half), 0)
    hi = np.minimum(places, n_words - window)
    good = lo <= hi
    np.add.at(mark, lo[good], 1)
    np.add.at(mark, hi[good] + 1, -1)
    return np.flatnonzero(np.cumsum(mark) > 0)


def around(half: int, window: int):
    """Starts of the second level: every window that holds a repeated half."""
    return lambda places, n_words: starts_around(places, half, window, n_words)


def doubled(size: int):
    """Starts of a level beyond: a window is looked at only if both of its halves were repeated."""
    return lambda starts, n_words: np.intersect1d(starts, starts - size)


def _extend(window: int, starts_of):
    """One level: 128-bit hashes of the windows of ``window`` words whose starts follow from what the level before found."""

    def run(batches):
        memo, powers = WordHashes(), Powers()
        for batch in batches:
            for part in rows_of(batch):
                rows, ids, starts, one, other = [], [], [], [], []
                columns = [c.to_pylist() for c in part.columns]
                for row, id_, text, places in zip(*columns, strict=True):
                    words = text.encode().split()
                    numbers = memo.of(words)
                    at = starts_of(np.array(places), len(words))
                    rows.append(np.full(len(at), row))
                    ids.append(np.full(len(at), id_))
                    starts.append(at.astype(np.int32))
                    one.append(window_hashes(numbers[:, 0], window, powers)[at] if len(at) else np.zeros(0, np.uint64))
                    other.append(window_hashes(numbers[:, 1], window, powers)[at] if len(at) else np.zeros(0, np.uint64))
                flat = [np.concatenate(x) for x in (rows, ids, starts, one, other)]
                for lo in range(0, len(flat[0]), 20_000):
                    some = [x[lo : lo + 20_000] for x in flat]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in some], names=["row", "id", "start", "h1", "h2"]
                    )

    return run


def _remove(window: int):
    """Words outside the removed windows, their digest and, if asked for, their text."""

    def run(batches):
        for batch in batches:
            for part in rows_of(batch):
                rows, removed, digests, texts = [], [], [], []
                for row, text, starts in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    words = text.encode().split()
                    mark = np.zeros(len(words) + 1, np.int32)
                    np.add.at(mark, starts, 1)
                    np.add.at(mark, np.array(starts) + window, -1)
                    out = np.cumsum(mark)[:-1] > 0
                    kept = b" ".join([w for w, gone in zip(words, out.tolist(), strict=True) if not gone])
                    rows.append(row)
                    removed.append(int(out.sum()))
                    digests.append(hashlib.sha256(kept).digest())
                    texts.append(kept.decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.binary()), pa.array(texts, pa.string())],
                    names=["row", "n_removed", "kept", "kept_text"],
                )

    return run


def repeated(windows: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose windows start in at least two documents, with the smallest id among them."""
    found = windows.groupBy(*key).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    return found.filter("least < most").select(*key, "least")


WINDOWS = "row long, id long, start int, h1 long, h2 long"


def first_level(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketch, same, texts): every row, classes of equal word sequences, and texts that share half a window.

    ``texts`` has row, id, text and the places of their shared anchors; one row stands for each class.
    """
    half = window // 2
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    sketch = given.mapInArrow(
        _sketch(window), f"doc_id {kind}, text_hash long, n_words long, digest binary, hashes array<long>, places array<int>"
    )
    sketch = stage(
        sketch.withColumn("row", F.monotonically_increasing_id()).withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))),
        "sketch",
    )
    same = stage(
        sketch.groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("id", "row")).alias("first")), "same"
    )
    firsts = same.select(F.col("first.row").alias("row"))
    halves = sketch.filter(F.size("hashes") > 0).join(firsts, "row", "left_semi")
    halves = halves.select("row", "id", F.explode(F.arrays_zip("hashes", "places")).alias("x")).select(
        "row", "id", F.col("x.hashes").alias("h"), F.col("x.places").alias("place")
    )
    halves = stage(halves, "halves")
    both = stage(repeated(halves, ["h"]).select("h"), "repeated")
    # both sides of these joins are dealt out by them alone, so a very frequent passage is split at run time
    open_ = halves.join(both, "h").groupBy("row").agg(F.collect_list("place").alias("places"))
    open_ = open_.join(sketch.select("row", "id", "doc_id", "text_hash"), "row")
    texts = given.join(
        open_.select("row", "id", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "places"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")),
    )
    return sketch, same, stage(texts.select("row", "id", "text", "places"), "open")


def substring_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Remove words covered by windows of ``window`` words that also start in a document with a smaller id.

    Returns one row per input row: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (the
    kept words joined by spaces; null where nothing was removed).

    Documents with equal word sequences are one: the smallest id stands for them, the others lose all words if
    they have a whole window.  First level: windows of half the length, of which each text keeps the least
    hash in every run of window - half + 1; two texts that share a whole window share such an anchor in it, so none is
    missed.  Anchors of one document alone end there.  Second level: only the whole windows around a
    repeated anchor are hashed (128 bits) and compared, which settles every removal; the levels beyond, which
    ``longest_repeats`` goes on with, cover no other word.

    Null and empty texts have no words; a null id is smaller than any other; rows repeated with the
    smallest id all stay; an empty table gives no rows; other columns are ignored.  Long texts are read whole.
    """
    sketch, same, texts = first_level(docs, window)
    whole = texts.mapInArrow(_extend(window, around(window // 2, window)), WINDOWS)
    later = stage(repeated(whole, ["h1", "h2"]), "windows")
    gone = whole.join(later, ["h1", "h2"]).filter("id > least").groupBy("row").agg(F.collect_set("start").alias("starts"))
    cut = texts.select("row", "text").join(gone, "row").mapInArrow(
        _remove(window), "row long, n_removed long, kept binary, kept_text string"
    )
    cut = cut if with_text else cut.drop("kept_text")
    # rows repeated with one id and text meet here again
    cut = cut.groupBy("row").agg(*[F.first(c).alias(c) for c in cut.columns if c != "row"])
    same = stage(same.join(cut, same["first"]["row"] == cut["row"], "left").drop("row"), "cut")
    n_rows = sketch.count()
    out = hot_join(sketch.select("row", "doc_id", "id", "n_words", "digest"), same, ["digest"], "n_docs", n_rows, ["row"])
    copy = (F.col("id") > F.col("first.id")) & (F.col("n_words") >= window)
    result = [
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.lower(F.hex(F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept", "digest")))).alias("kept_sha256"),
    ]
    if with_text:
        result.append(F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return out.select("doc_id", "n_words", *result)


def longest_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """How far repeats reach: doc_id, length, n_starts for each length at which a document shares windows with others.

    Lengths are ``window``, twice that, and so on until no candidate survives.  A window of twice the length
    is hashed only where both of its halves were repeated.  One document stands for all with the same words.
    """
    sketch, _, texts = first_level(docs, window)
    size, starts_of, levels = window, around(window // 2, window), []
    while True:
        found = texts.mapInArrow(_extend(size, starts_of), WINDOWS)
        shared = stage(repeated(found, ["h1", "h2"]).select("h1", "h2"), "shared")
        level = stage(found.join(shared, ["h1", "h2"]).groupBy("row").agg(F.collect_set("start").alias("places")), "level")
        if level.isEmpty():
            break
        levels.append(level.select("row", F.lit(size).alias("length"), F.size("places").alias("n_starts")))
        texts, starts_of, size = texts.select("row", "id", "text").join(level, "row"), doubled(size), size * 2
    if not levels:
        return sketch.limit(0).select("doc_id", F.lit(0).alias("length"), F.lit(0).alias("n_starts"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.join(sketch.select("row", "doc_id"), "row").select("doc_id", "length", "n_starts")


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Substring dedup of all documents."""
    return substring_dedup(read_table(spark, folder, "documents"))
