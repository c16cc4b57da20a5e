"""Near-duplicate documents by min-max hashing, links confirmed on full shingle sets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, hot_join, read_table, stage
from .hashing import Powers, WordHashes, mix, window_hashes
from .registry import query
from .substring_dedup import NULL_ID, rows_of

#: Signature: BANDS bands of ROWS values; half of the bands are cut from minima, half from maxima.
BANDS, ROWS = 32, 5
#: Shingles that are permuted at once.
CHUNK = 2048


def shingles(text: str | None, k: int, memo: WordHashes, powers: Powers) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of the lower-cased text; of all its words if they are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(memo.of(words)[:, 0], min(k, len(words)), powers))


class MinMax:
    """Minimum and maximum of a set under each of bands * rows / 2 permutations: one evaluation gives two values."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = bands // 2 * rows
        self.bands, self.rows = bands, rows
        self.factor = rng.integers(1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = rng.integers(1 << 63, size=n, dtype=np.uint64)
        self.salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))

    def band_hashes(self, values: np.ndarray) -> np.ndarray:
        low = np.full(len(self.factor), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.factor), np.uint64)
        for lo in range(0, len(values), CHUNK):
            x = values[None, lo : lo + CHUNK] * self.factor[:, None] + self.shift[:, None]
            x ^= x >> np.uint64(31)
            x *= np.uint64(0x9FB21C651E98DF25)
            low, high = np.minimum(low, x.min(axis=1)), np.maximum(high, x.max(axis=1))
        cells = np.concatenate([low, high]).reshape(self.bands, self.rows)
        out = self.salt.copy()
        for i in range(self.rows):
            out = mix(out ^ cells[:, i])
        return out


def _sketch(k: int, bands: int, rows: int):
    def run(batches):
        memo, powers, hashing = WordHashes(), Powers(), MinMax(bands, rows)
        for batch in batches:
            for part in rows_of(batch):
                sizes, digests, found = [], [], []
                for text in part.column(2).to_pylist():
                    s = shingles(text, k, memo, powers)
                    sizes.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    found.append(hashing.band_hashes(s).view(np.int64) if len(s) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                        pa.array(found, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "digest", "bands"],
                )

    return run


def _sets(k: int):
    def run(batches):
        memo, powers = WordHashes(), Powers()
        for batch in batches:
            for part in rows_of(batch):
                found = [shingles(t, k, memo, powers) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in found], pa.int64()),
                        pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())), part.column(2),
                    ],
                    names=["node", "size", "items", "several"],
                )

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets have 100 * intersection >= per_cent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    joined = pairs.join(right, "b").join(left, "a")
    both = F.size(F.array_intersect("x", "y"))
    joined = joined.select("a", "b", both.alias("n"), (F.size("x") + F.size("y") - both).alias("m"))
    return joined.filter(F.col("n") * 100 >= F.col("m") * per_cent).select("a", "b")


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): every member of a bucket with the bucket's centre, the member that shares most with others in all bands.

    ``members`` is staged: band, node, m (members of the band's bucket).
    """
    weight = members.groupBy("node").agg(F.sum("m").alias("w"))
    centre = members.join(weight, "node").groupBy("band").agg(F.max(F.struct("w", (-F.col("node")).alias("node"))).alias("c"))
    centre = stage(centre.select("band", (-F.col("c.node")).alias("a")), "centres")
    return members.join(centre, "band").filter("node <> a").select("a", F.col("node").alias("b")).distinct()


def rest_pairs(open_sets: DataFrame, per_cent: int) -> DataFrame:
    """Every pair of ``open_sets`` (node, component, size, items) of different components that may reach ``per_cent``.

    Exact prefix filter: with items ordered from rare to frequent, two sets of sizes s and t that reach the
    similarity share one of the first s - o + 1 and t - o + 1 items, o being the overlap they need.  An item
    whose holders are one component already pairs nobody.
    """
    items = open_sets.select("node", "component", "size", F.explode("items").alias("item"))
    df = items.groupBy("item").agg(F.count(F.lit(1)).alias("df"), (F.min("component") < F.max("component")).alias("mixed"))
    known = items.join(df, "item").groupBy("node", "component", "size").agg(
        F.sort_array(F.collect_list(F.struct("df", "item", "mixed"))).alias("order")
    )
    least = F.ceil(F.col("size") * per_cent / 100)
    head = F.slice("order", F.lit(1), (F.col("size") - least + 1).cast("int"))
    rows = known.select("node", "component", "size", F.posexplode(head).alias("pos", "x")).filter("x.mixed")
    rows = stage(rows.select(F.col("x.item").alias("item"), "node", "component", "size", "pos"), "heads")
    a, b = (rows.select("item", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "size", "pos")]) for s in "ab")
    need = F.ceil((F.col("size_a") + F.col("size_b")) * per_cent / (100 + per_cent))
    may = (
        (F.col("component_a") != F.col("component_b"))
        & (F.struct("size_a", "node_a") < F.struct("size_b", "node_b"))
        & (F.col("size_a") * 100 >= F.col("size_b") * per_cent)
        & (F.col("pos_a") <= F.col("size_a") - need) & (F.col("pos_b") <= F.col("size_b") - need)
    )
    return a.join(b, "item").filter(may).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, k: int = 5, per_cent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Groups of near duplicates: doc_id, text_hash, n_shingles, component_id, kept, keeper; a row per input row.

    Documents whose sets of ``k``-word shingles (A-Z lower-cased) have 100 * intersection >= per_cent * union are
    linked; component_id is the smallest doc_id reachable, kept says whether it is the row's own and keeper is true for
    one row of each component.

    Equal sets are one node.  Bands of minima and maxima put nodes in buckets; each bucket is compared with its
    centre, on full sets.  Buckets that are not one component after that are open: their nodes are compared by an
    exact prefix filter, so no link inside a bucket is lost and no group is written out in pairs.  A pair at
    the threshold s misses every bucket with probability (1 - s**rows)**bands: below 1e-5 for 0.8 and 1e-8 for 0.85.

    Texts without words have no shingles and are linked with nothing; with fewer than ``k`` words the whole sequence is the
    one shingle; a null id is smaller than any other; repeated rows form a component; an empty table
    gives no rows; other columns are ignored.  Long texts are read whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    sketch = given.mapInArrow(
        _sketch(k, bands, rows), f"doc_id {kind}, text_hash long, n_shingles long, digest binary, bands array<long>"
    )
    sketch = stage(
        sketch.withColumn("row", F.monotonically_increasing_id()).withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))),
        "sketch",
    )
    n_rows = sketch.count()
    filled = sketch.filter("n_shingles > 0")
    same = stage(
        filled.groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("id", "row")).alias("first")), "same"
    )
    nodes = filled.join(same.select(F.col("first.row").alias("row")), "row", "left_semi")
    in_bands = stage(nodes.select(F.explode("bands").alias("band"), F.col("row").alias("node")), "bands")
    shared = stage(in_bands.groupBy("band").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "buckets")
    members = stage(in_bands.join(shared, "band"), "members")
    pairs = stage(star_pairs(members), "stars")
    wanted = members.select(F.col("node").alias("row")).distinct()
    found = sketch.select("row", "doc_id", "text_hash").join(wanted, "row", "left_semi")
    found = found.join(same.select(F.col("first.row").alias("row"), (F.col("n_docs") > 1).alias("several")), "row")
    found = found.select(F.col("row").alias("node"), "several", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    texts = given.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    read = texts.select("node", "text", "several").mapInArrow(_sets(k), "node long, size long, items array<long>, several boolean")
    read = stage(read, "sets")
    # a row given twice is read twice under one node; only digests of several rows can hold such rows
    once = stage(read.filter("several").dropDuplicates(["node"]), "sets_once")
    sets = read.filter("NOT several").unionByName(once).select("node", "size", "items")
    links = stage(confirmed(pairs, sets, per_cent), "links")
    first = stage(components(links), "first_components")
    at = members.join(first, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    at = stage(at, "placed")
    split = at.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("band")
    open_nodes = at.join(split, "band", "left_semi").select("node", "component").distinct()
    more = stage(rest_pairs(sets.join(open_nodes, "node"), per_cent), "rest")
    links2 = stage(confirmed(more, sets, per_cent), "more_links")
    final = stage(components(links.unionByName(links2)), "components") if links2.head(1) else first
    placed = same.join(final, same["first"]["row"] == final["node"], "left").select(
        "digest", "n_docs", "first", F.coalesce("component", F.col("first.row")).alias("component")
    )
    placed = stage(placed, "classes")
    roots = placed.groupBy("component").agg(F.min("first").alias("root"))
    placed = stage(placed.join(roots, "component").select("digest", "n_docs", "root"), "roots")
    out = hot_join(sketch.select("doc_id", "text_hash", "row", "id", "n_shingles", "digest"), placed, ["digest"], "n_docs", n_rows, ["row"], "left")
    least = F.coalesce("root.id", "id")
    return out.select(
        "doc_id", "text_hash", "n_shingles", unnull(least).alias("component_id"), (F.col("id") == least).alias("kept"),
        (F.coalesce("root.row", "row") == F.col("row")).alias("keeper"),
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, ...) that are the keeper of their group, every column as it was.

    Null and empty texts are groups of their own and stay, once for rows repeated with one id; of equal ids the
    least text hash decides; null ids count as the largest; doc_id must be a whole number; an empty table
    gives no rows.
    """
    found = near_duplicates(docs.select("doc_id", "text"), **options).filter("keeper")
    keys = ["id", "hash"]
    found = found.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("text_hash").alias("hash"))
    # the given columns travel inside one, so no name of theirs is touched
    given = docs.select(
        F.struct("*").alias("doc"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")
    )
    # rows repeated with one id and text share a keeper: one of them stays; partitioned like the join, so texts move once
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("doc.doc_id"))
    return given.join(found.distinct(), keys).withColumn("nth", first).filter("nth = 1").select("doc.*")


def unnull(id_: Column) -> Column:
    """The id that ``id_`` stands for."""
    return F.when(id_ != NULL_ID, id_)


OP2_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS items
  FROM w
), n AS (SELECT doc_id, len(items) AS n_shingles FROM s
), e AS (SELECT doc_id, unnest(items) AS item FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM e a JOIN e b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS MATERIALIZED (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * n_both >= 85 * (x.n_shingles + y.n_shingles - n_both)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""


@query("op2_near_dedup", OP2_SQL)
def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates of all documents."""
    found = near_duplicates(read_table(spark, folder, "documents"), k=3, per_cent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
