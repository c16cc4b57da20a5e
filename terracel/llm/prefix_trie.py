"""Conversation prefix trie: shared prefixes as nodes, subtree totals rolled up in bands of depths."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracel.core.numbering import range_slices

from .common import hot_join, read_table, running_sums, stage, word_count
from .registry import query

#: Depths of a band: a node explodes to so many ancestors at most, and every level of bands divides depths by it.
BAND = 16
PARTS = ("a", "b", "c", "d")
EMPTY_SHA = hashlib.sha256().hexdigest()


def number_turns(turns: DataFrame) -> DataFrame:
    """conv_id, depth (1, 2, ...), role, text: the turns of each conversation by turn (nulls first), then role and text.

    Null role and text are empty, rows without a conv_id are left out, repeated rows are turns of their own.
    Positions come from ranges of the whole table, so a conversation may hold most rows and its turn
    numbers may all be equal.
    """
    plain = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(1).alias("one")
    )
    order = ["turn", "role", "text"]
    placed = running_sums(range_slices(plain, ["conv_id", *order]), ["conv_id"], "_slice", order, {"before": "one"})
    return placed.select("conv_id", (F.col("before") + 1).alias("depth"), "role", "text")


def _node(depth: Column, *sums: Column) -> Column:
    return F.md5(F.concat_ws(",", depth, *sums).cast("binary"))


ROOT = hashlib.md5(b"0,0,0,0,0").hexdigest()


def steps_of(numbered: DataFrame) -> DataFrame:
    """A row per turn with the ids of the node it leads to and of that node's parent, and the words of its text.

    A node is the sequence of turns that leads to it.  Its id is made from sums, over these turns, of four 32-bit
    parts of a digest of (depth, role, text): sums of slices add up, so no conversation is read in one
    piece.  Ids have 128 bits.
    """
    said = F.sha2(F.concat(F.concat_ws(":", "depth", F.length("role")), F.lit(":"), "role", F.lit(":"), "text").cast("binary"), 256)
    parts = [F.conv(F.substring("_said", 8 * i + 1, 8), 16, 10).cast("long").alias(p) for i, p in enumerate(PARTS)]
    t = numbered.select("conv_id", "depth", word_count(F.col("text")).alias("n_words"), said.alias("_said"))
    t = range_slices(t.select("conv_id", "depth", "n_words", *parts), ["conv_id", "depth"])
    summed = running_sums(t, ["conv_id"], "_slice", ["depth"], {f"before_{p}": p for p in PARTS})
    before = [F.col(f"before_{p}") for p in PARTS]
    now = [F.col(f"before_{p}") + F.col(p) for p in PARTS]
    return summed.select("conv_id", "depth", "n_words", _node(F.col("depth"), *now).alias("node"), _node(F.col("depth") - 1, *before).alias("parent"))


def _hash_joined(batches):
    """SHA-256 of each node's pieces in order, joined by commas; holds one piece at a time."""
    now, digest, done = None, None, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["node", "ends_sha256"])

    for batch in batches:
        for node, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if len(done) > 10_000:
            yield batch_of(done)
            done = []
    if now is not None:
        done.append((now, digest.hexdigest()))
    if done:
        yield batch_of(done)


def ends_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: hash of the ascending conv_ids of ``ends`` (conv_id, node), joined by commas.

    The ids of a node are joined inside ranges of (node, conv_id); one hash then passes over a row per range,
    so a node at which most conversations end has no task with all of them.
    """
    pieces = range_slices(ends.select("node", "conv_id"), ["node", "conv_id"]).groupBy("node", "_slice").agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("piece")
    )
    dealt = pieces.repartition("node").sortWithinPartitions("node", "_slice")
    return dealt.select("node", "piece").mapInArrow(_hash_joined, "node string, ends_sha256 string")


def subtree_sums(nodes: DataFrame, steps: DataFrame, sums: Sequence[str], max_depth: int, band: int = BAND) -> DataFrame:
    """node and, for each of ``sums``, its total over the node's subtree, the node included.

    ``nodes`` has node, depth, conv_id (of a conversation through it) and the values, ``steps`` every (conv_id, depth,
    node), depth 0 included.  A node adds to its ancestors inside its band of depths.  The roots of bands
    are then a tree of depth / ``band``, rolled up in the same way, level by level; on the way back the
    total of each band's root is added to its ancestors in the band above.  There are as many levels as
    digits of ``max_depth`` to the base ``band``, and no row explodes to more than ``band`` rows.
    """

    def chains(unit: int) -> DataFrame:
        """Nodes at multiples of ``unit`` of each conversation and band."""
        k = F.floor(F.col("depth") / unit)
        at_unit = steps.filter(F.col("depth") % unit == 0)
        return at_unit.groupBy("conv_id", F.floor(k / band).alias("_band")).agg(F.collect_list(F.struct(k.alias("k"), "node")).alias("_chain"))

    def spread(rows: DataFrame, chain: DataFrame, band_no: Column, upto: Column) -> DataFrame:
        """Values of each row for every node of its conversation in that band, up to that place."""
        found = rows.withColumns({"_band": band_no, "_upto": upto}).drop("node").join(chain, ["conv_id", "_band"])
        above = F.filter("_chain", lambda x: x["k"] <= F.col("_upto"))
        return found.withColumn("_above", F.explode(above)).select(F.col("_above.node").alias("node"), *sums)

    def add_up(rows: DataFrame) -> DataFrame:
        return rows.groupBy("node").agg(*[F.sum(c).cast("long").alias(c) for c in sums])

    place = nodes.select("node", "depth", "conv_id")
    levels, unit, rows = [], 1, nodes.select("node", "depth", "conv_id", *sums)
    while True:
        chain = stage(chains(unit), "chains")
        k = F.floor(F.col("depth") / unit)
        inside = stage(add_up(spread(rows, chain, F.floor(k / band), k)), "band_sums")
        levels.append((unit, chain, inside))
        unit *= band
        if unit > max_depth:
            break
        rows = stage(inside.join(place.filter(F.col("depth") % unit == 0), "node"), "band_roots").select("node", "depth", "conv_id", *sums)
    totals = levels[-1][2]
    for unit, chain, inside in reversed(levels[:-1]):
        roots = totals.join(place.filter("depth > 0"), "node")
        band_above = F.floor(F.col("depth") / (unit * band)) - 1
        raised = spread(roots, chain, band_above, F.floor(F.col("depth") / unit))
        totals = stage(add_up(inside.unionByName(raised)), "totals")
    return totals


def trie_of(numbered: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """``prefix_trie`` of turns that are already numbered (conv_id, depth, role, text)."""
    steps = stage(steps_of(numbered), "steps")
    ids = stage(convs.select("conv_id").filter(F.col("conv_id").isNotNull()).unionByName(steps.select("conv_id")).distinct(), "convs")
    root = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_words"), F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"))
    walks = steps.select(*root.columns).unionByName(root)
    last = walks.groupBy("conv_id").agg(F.max(F.struct("depth", "node")).alias("last"))
    ends = stage(last.select("conv_id", "last.node", "last.depth"), "ends")
    max_depth = ends.agg(F.max("depth")).first()[0] or 0
    n_ends = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_ends"))
    # members of a node agree in its depth, parent and last text
    nodes = walks.groupBy("node", "depth", "parent").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("n_words").alias("n_words"))
    nodes = nodes.join(n_ends, "node", "left").select(
        "node", "depth", "parent", "n_convs", "conv_id",
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
        # a node is childless if all of its members end there
        (F.col("n_convs") == F.coalesce("n_ends", F.lit(0))).cast("long").alias("n_leaves"),
    )
    nodes = stage(nodes, "nodes")
    totals = subtree_sums(nodes, walks.select("conv_id", "depth", "node"), ["n_leaves", "saved_tokens"], max_depth, band)
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    told = nodes.drop("n_leaves", "saved_tokens").join(totals, "node").join(children, "node", "left").join(ends_digests(ends), "node", "left")
    told = stage(told, "told")
    parents = told.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_siblings"))
    told = hot_join(told, parents, ["parent"], "n_siblings", told.count(), ["node"], "left")
    return told.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None, band: int = BAND) -> DataFrame:
    """A row per distinct sequence of first turns of the conversations in ``turns`` (conv_id, turn, role, text).

    conv_id (smallest member: conversation that starts with the sequence), depth, parent_conv_id (null for the
    root), n_convs (members), n_children, n_leaves (childless nodes of the subtree), saved_tokens (over the
    subtree, words of a node's last text times members but one), ends_sha256 (of the ids that end at the
    node).  ``convs`` may name conversations that have no turn; they are members of the root.

    Turns go by turn (nulls first), then role and text; null role and text are empty; repeated rows are
    turns of their own; rows without a conv_id are left out; an empty table gives no rows; other columns
    are ignored.  Very long texts enter as digests and word counts.
    """
    return trie_of(number_turns(turns), turns.select("conv_id") if convs is None else convs, band)


#: Conversations of a block of so many ids take their first turns from the first of them.
BLOCK = 20


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns of conversations whose first turns are those of their block's first conversation, and all ids."""
    own = stage(number_turns(turns), "numbered")
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    convs = convs.select("conv_id", "n_turns", (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % 4).alias("h"))
    convs = stage(convs, "sizes")
    base = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    convs = stage(convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "taken")
    heads = own.filter("depth <= 3").withColumnRenamed("conv_id", "base")
    first = convs.select("conv_id", "base", "h").join(heads, "base").filter("depth <= h")
    # conversations are groups of rows of any size
    rest = hot_join(own, convs.select("conv_id", "n_turns", "h", "taken"), ["conv_id"], "n_turns", own.count(), ["depth"]).filter("depth > h")
    rest = rest.withColumn("depth", F.col("depth") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "depth", "role", "text"]
    return first.select(*columns).unionByName(rest.select(*columns)), convs.select("conv_id")


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS at,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST(range(8) AS BIGINT[])),
               lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END))), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM t GROUP BY conv_id
), m AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base
), r AS (
  SELECT m.conv_id, t.at AS depth, t.role, t.text FROM m JOIN t ON t.conv_id = m.base WHERE t.at <= m.h
  UNION ALL SELECT m.conv_id, t.at - m.h + m.taken, t.role, t.text FROM m JOIN t ON t.conv_id = m.conv_id WHERE t.at > m.h
), p AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
         string_agg(sha256(concat(length(role), ':', role, ':', text)), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM m
), e AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, path FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY path
), n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_words) AS saved,
         CASE WHEN depth > 0 THEN substr(path, 1, 64 * (depth - 1)) END AS parent
  FROM p GROUP BY path, depth
), k AS (
  SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent
), s AS (
  SELECT substr(u.path, 1, 64 * u.above) AS path, sum(CASE WHEN k.parent IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(u.saved) AS saved_tokens
  FROM (SELECT path, saved, unnest(range(0, depth + 1)) AS above FROM n) u LEFT JOIN k ON k.parent = u.path GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM n JOIN s ON s.path = n.path LEFT JOIN n q ON q.path = n.parent LEFT JOIN k ON k.parent = n.path LEFT JOIN e ON e.path = n.path
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Trie of all conversations, rebuilt to share the first turns of their block."""
    turns, convs = rebuilt(read_table(spark, folder, "conversations"))
    return trie_of(turns, convs)
