"""Line dedup: levelled sorted runs of line hashes that each new batch of documents anti-joins and extends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, lower_ascii, read_table, scratch_path, stage
from .registry import query

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2


class SortedRuns:
    """Runs of (key, n, top), each hashed into the same buckets and sorted in them, in levels.

    A run holds a key once, with a number of documents and the largest id among them.  ``add`` writes a run to
    level 0; a level that is full is merged into one run of the next.  Runs share their buckets, so joining
    and merging them moves no row.
    """

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[DataFrame]] = []

    def write(self, rows: DataFrame) -> DataFrame:
        """One bucketed, sorted table in the shared folder."""
        name = f"llm_run_{uuid.uuid4().hex}"
        writer = rows.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
        writer.option("path", scratch_path(self.spark, "run")).option("compression", "zstd").saveAsTable(name)
        found = self.spark.table(name)
        # the name is not needed beyond the reader; the files stay
        self.spark.sql(f"DROP TABLE {name}")
        return found

    @staticmethod
    def merge(one: DataFrame, other: DataFrame) -> DataFrame:
        """Two runs as one: counts added up, largest ids kept."""
        b = other.select("key", F.col("n").alias("n2"), F.col("top").alias("top2"))
        zero = F.lit(0).cast("long")
        return one.join(b, "key", "full_outer").select(
            "key", (F.coalesce("n", zero) + F.coalesce("n2", zero)).alias("n"), F.greatest("top", "top2").alias("top")
        )

    def add(self, rows: DataFrame, level: int = 0) -> None:
        """Put a run on ``level`` and merge levels that are full."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self.write(rows))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self.add(self.merged(full), level + 1)

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        """All ``runs`` as one."""
        out = runs[0]
        for run in runs[1:]:
            out = self.merge(out, run)
        return out

    def runs(self) -> list[DataFrame]:
        """All runs, the oldest first."""
        return [run for level in reversed(self.levels) for run in level]


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Keyed lines: id, text_hash, key (16-byte digest), pos (1, 2, ...), first (its first place in the text).

    Equal keys of a text meet by sorting its lines, which also tells the first of them.
    """
    # the whole text is lower-cased once, its lines are trimmed one by one
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = F.split(lower_ascii(text), "\n")
    trimmed = F.transform(parts, lambda x, i: F.struct(F.btrim(x, F.lit(SPACE)).alias("k"), (i + 1).alias("pos")))
    kept = F.filter(trimmed, lambda x: F.length(x["k"]) >= min_chars)
    keyed = F.array_sort(F.transform(kept, lambda x: F.struct(F.unhex(F.md5(x["k"])).alias("key"), x["pos"].alias("pos"))))
    d = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("text_hash"), keyed.alias("keyed"))
    keys = F.transform("keyed", lambda x: x["key"])
    before = F.concat(F.array(F.lit(None).cast("binary")), F.slice(keys, 1, F.greatest(F.size(keys) - 1, F.lit(0))))
    d = d.filter(F.size("keyed") > 0).select("id", "text_hash", "keyed", before.alias("before"))
    rows = F.zip_with(
        "keyed", "before", lambda x, b: F.struct(x["key"].alias("key"), x["pos"].alias("pos"), (~x["key"].eqNullSafe(b)).alias("first"))
    )
    return d.select("id", "text_hash", F.explode(rows).alias("row")).select("id", "text_hash", "row.key", "row.pos", "row.first")


def repeated_lines(lines: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS, buckets: int | None = None) -> DataFrame:
    """(key, top) of the keys in at least ``min_docs`` documents; top is the largest id among them.

    ``lines`` is staged with a column batch, batch 0 holding the largest ids.  Each batch counts its own keys,
    anti-joins the keys that the runs already settled (enough documents, and their largest id, since later batches
    hold smaller ids), and adds the rest as a run.
    """
    spark = lines.sparkSession
    store = SortedRuns(spark, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    for batch in range(batches):
        own = lines.filter((F.col("batch") == batch) & F.col("first"))
        own = own.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        for run in store.runs():
            own = own.join(run.filter(F.col("n") >= min_docs).select("key"), "key", "left_anti")
        store.add(own)
    return store.merged(store.runs()).filter(F.col("n") >= min_docs).select("key", "top")


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated lines taken out of text, and n_lines, n_dropped.

    A line's key is the line without white space at its ends and with A-Z lower-cased.  Keys of at least ``min_chars``
    code points found in at least ``min_docs`` rows lose all their lines except in the rows with the largest id
    holding them.  Built-in functions only.

    Null and empty texts are one empty line and stay empty; each row counts as a document, rows repeated with the
    largest id all keep their lines, and a null id is smaller than any other; an empty table gives no rows; other
    columns pass through, but for columns named n_lines and n_dropped, which are replaced.
    """
    ends = [k / batches for k in range(1, batches)]
    at = docs.agg(F.percentile_approx("doc_id", [float(x) for x in ends], 10_000)).first()[0] if ends else []
    batch = F.lit(0)
    for bound in at or []:
        batch = batch + F.when(F.col("id") > bound, 0).otherwise(1)
    lines = stage(line_table(docs.select("doc_id", "text"), min_chars).withColumn("batch", batch.cast("int")), "lines", by=["batch"])
    spent = stage(repeated_lines(lines, batches, min_docs), "spent")
    # both sides are dealt out by this join alone, so a very frequent line is split at run time
    hits = lines.select("id", "text_hash", "key", "pos").join(spent, "key").filter(~F.col("id").eqNullSafe(F.col("top")))
    drops = hits.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("_ld_pos"))
    drops = drops.select(F.col("id").alias("_ld_id"), F.col("text_hash").alias("_ld_hash"), "_ld_pos")
    text = F.coalesce(F.col("text"), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col("_ld_id")) & (F.xxhash64(text) == F.col("_ld_hash"))
    d = docs.join(drops, same, "left").withColumn("_ld_lines", F.split(text, "\n"))
    d = d.withColumn("_ld_cuts", F.concat(F.array(F.lit(0)), F.coalesce("_ld_pos", F.array().cast("array<int>")), F.array(F.size("_ld_lines") + 1)))
    between = F.transform(
        F.sequence(F.lit(1), F.size("_ld_cuts") - 1),
        lambda k: F.slice("_ld_lines", F.get("_ld_cuts", k - 1) + 1, F.get("_ld_cuts", k) - F.get("_ld_cuts", k - 1) - 1),
    )
    left = F.when(F.col("_ld_pos").isNull(), text).otherwise(F.array_join(F.flatten(between), "\n"))
    return d.withColumns({
        "text": left, "n_lines": F.size("_ld_lines").cast("long"), "n_dropped": F.coalesce(F.size("_ld_pos"), F.lit(0)).cast("long"),
    }).drop("_ld_id", "_ld_hash", "_ld_pos", "_ld_lines", "_ld_cuts")


OP1_SQL = """
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), g AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, k.pos, k.line, g.top IS NOT NULL AND k.doc_id <> g.top AS dropped FROM k LEFT JOIN g ON k.key = g.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op1_line_dedup", OP1_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Line dedup of all documents."""
    kept = dedup_lines(read_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
