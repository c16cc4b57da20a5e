"""Exact deduplication: a Bloom filter of repeated hashes decides which rows have to move at all."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_join, lower_ascii, read_table, stage
from .registry import query

#: Bits of one filter block; a row's two bits lie in one block.
BLOCK_BITS = 1 << 16
BITS_PER_ROW = 16
#: A filter never grows beyond this; with more rows there are several, each for a part of the digests.
MAX_FILTER_BYTES = 32 << 20


def _slots(digests, n_blocks: int):
    """Block and the two bit numbers in it, from the first 16 bytes of each digest."""
    raw = np.frombuffer(b"".join(digests), dtype="<u8").reshape(len(digests), -1)
    block = (raw[:, 0] % np.uint64(n_blocks)).astype(np.int64)
    one = (raw[:, 1] & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
    other = ((raw[:, 1] >> np.uint64(16)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
    return block, one, np.where(other == one, (other + 1) % BLOCK_BITS, other)


def _mark(n_blocks: int):
    """Map step of pass one: the bits that a task's rows set, each at most twice, by block."""

    def run(batches):
        seen = np.zeros(0, np.int64)
        twice = np.zeros(0, np.int64)
        fresh: list[np.ndarray] = []

        def settle():
            nonlocal seen, twice
            at, n = np.unique(np.concatenate([seen, *fresh]), return_counts=True)
            twice = np.union1d(twice, at[n > 1])
            seen = at
            fresh.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            block, one, other = _slots(batch.column("digest").to_pylist(), n_blocks)
            fresh += [block * BLOCK_BITS + one, block * BLOCK_BITS + other]
            # sorting what has come since only once it is as much as what was sorted before
            if sum(map(len, fresh)) > max(1 << 18, len(seen)):
                settle()
        if fresh:
            settle()
        for block in np.unique(seen // BLOCK_BITS):
            lo, hi = np.searchsorted(seen, [block * BLOCK_BITS, (block + 1) * BLOCK_BITS])
            lo2, hi2 = np.searchsorted(twice, [block * BLOCK_BITS, (block + 1) * BLOCK_BITS])
            pack = lambda x: (x % BLOCK_BITS).astype("<u2").tobytes()
            yield pa.RecordBatch.from_pydict({"block": [int(block)], "seen": [pack(seen[lo:hi])], "twice": [pack(twice[lo2:hi2])]})

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Reduce step of pass one: a block's bits that were set more than once, over all tasks."""
    count = np.zeros(BLOCK_BITS, np.int32)
    for name in ("seen", "twice"):
        for raw in table.column(name).to_pylist():
            count[np.frombuffer(raw, "<u2")] += 1
    bits = np.packbits(count > 1, bitorder="little").tobytes()
    return pa.table({"block": [table.column("block")[0].as_py()], "bits": [bits]})


def _probe(n_blocks: int, shared):
    """Pass two: whether both bits of a row were set more than once."""

    def run(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            block, one, other = _slots(batch.column("digest").to_pylist(), n_blocks)
            hit = np.ones(batch.num_rows, bool)
            for slot in (one, other):
                at = block * BLOCK_BITS + slot
                hit &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=[*batch.schema.names, "maybe"])

    return run


def _probed(keys: DataFrame, n_blocks: int) -> DataFrame:
    """``keys`` (id, digest, row) with ``maybe``: whether another row may have that digest."""
    spark = keys.sparkSession
    marks = keys.select("digest").mapInArrow(_mark(n_blocks), "block long, seen binary, twice binary")
    blocks = marks.groupBy("block").applyInArrow(_merge, "block long, bits binary")
    held = np.zeros(n_blocks * BLOCK_BITS // 8, np.uint8)
    for row in blocks.toLocalIterator():
        at = row["block"] * BLOCK_BITS // 8
        held[at : at + BLOCK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(held.tobytes())
    id_type = keys.schema["id"].dataType.simpleString()
    return stage(keys.mapInArrow(_probe(n_blocks, shared), f"id {id_type}, digest binary, row long, maybe boolean"), "probed")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = BITS_PER_ROW,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """Group equal texts (A-Z lower-cased) and keep the row with the largest id of each group.

    Returns one row per input row: id, keep_id, group_size, kept, text_sha256.  Texts are read once and
    never move: digests (32 bytes a row) are staged, pass one fills a Bloom filter of bits set more than
    once, pass two sends only rows whose two bits are both such bits to the shuffle.  A filter has at
    most ``max_filter_bytes``, so its broadcast is bounded; with more rows than it has room for, digests are dealt by a
    hash into parts with a filter each, so that ``bits_per_row`` hold at any size.  False hits cost a shuffled digest,
    never a wrong answer.  Very long texts enter as digests.

    Null text counts as empty; a null id is smaller than any other; rows repeated with the same id and
    text form a group in which one of them stays; an empty table gives no rows; other columns are ignored.
    """
    digest = F.unhex(F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), 256))
    keys = docs.select(F.col(id_col).alias("id"), digest.alias("digest"))
    keys = stage(keys.withColumn("row", F.monotonically_increasing_id()), "digests")
    n_rows = keys.count()
    n_parts = max(1, -(-n_rows * bits_per_row // (8 * max_filter_bytes)))
    parts = [keys]
    if n_parts > 1:
        dealt = stage(keys.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(n_parts)).cast("int")), "parts", by=["part"])
        parts = [dealt.filter(F.col("part") == k).drop("part") for k in range(n_parts)]
    n_blocks = max(1, -(-n_rows * bits_per_row // (n_parts * BLOCK_BITS)))
    probed = None
    for part in parts:
        found = _probed(part, n_blocks)
        probed = found if probed is None else probed.unionByName(found)
    maybe = probed.filter("maybe").drop("maybe")
    groups = maybe.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("best")
    )
    grouped = hot_join(maybe, stage(groups, "groups"), ["digest"], "group_size", n_rows, ["row"]).select(
        "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "digest"
    )
    alone = probed.filter("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP4_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.text_sha256 = g.text_sha256
"""


@query("op4_exact_dedup", OP4_SQL)
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact dedup of all documents."""
    return exact_dedup(read_table(spark, folder, "documents"))
