"""Exact, line, near and substring dedup against plain versions."""

import brute
import pytest
from pyspark.sql import functions as F

from terracel.llm import common, exact_dedup, line_dedup, near_dedup, substring_dedup


@pytest.fixture(scope="module")
def rows():
    return brute.documents(3)


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns that operators do not ask for, named like some of theirs
    return spark.createDataFrame(rows, brute.SCHEMA).selectExpr("*", "'x' AS digest", "1 AS row", "2 AS id", "3 AS n_docs", "'k' AS key", "9 AS pos").repartition(5)


def found(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize("filter_bytes", [1 << 20, 8192])
def test_exact(docs, rows, filter_bytes):
    out = exact_dedup.exact_dedup(docs, max_filter_bytes=filter_bytes, bits_per_row=16)
    assert sorted(found(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256")) == sorted(brute.exact(rows))


def test_exact_ties_and_nulls(spark):
    d = spark.createDataFrame([(1, "A"), (1, "a"), (None, "a"), (None, "b"), (2, None), (3, "")], "doc_id long, text string")
    out = found(exact_dedup.exact_dedup(d), "doc_id", "keep_id", "group_size", "kept")
    assert sorted(out, key=str) == sorted(
        [(1, 1, 3, False), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True), (2, 3, 2, False), (3, 3, 2, True)], key=str
    )
    assert exact_dedup.exact_dedup(d.limit(0)).count() == 0


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_lines(docs, rows, batches):
    out = line_dedup.dedup_lines(docs, batches=batches)
    assert {r[0]: r[1:] for r in found(out, "doc_id", "n_lines", "n_dropped", "text")} == brute.line_dedup(rows)
    assert set(out.columns) == {*docs.columns, "n_lines", "n_dropped"}


def test_lines_ties_and_nulls(spark):
    line = "a line that is long enough"
    d = spark.createDataFrame([(1, line), (2, line + "\nx\n" + line), (2, line), (None, line), (None, None)], "doc_id long, text string")
    out = found(line_dedup.dedup_lines(d), "doc_id", "n_lines", "n_dropped", "text")
    assert sorted(out, key=str) == sorted(
        [(1, 1, 1, ""), (2, 3, 0, line + "\nx\n" + line), (2, 1, 0, line), (None, 1, 1, ""), (None, 1, 0, "")], key=str
    )
    assert line_dedup.dedup_lines(d.limit(0)).count() == 0
    only_null = spark.createDataFrame([(None, line)] * 3, "doc_id long, text string")
    assert [r[0] for r in found(line_dedup.dedup_lines(only_null), "n_dropped")] == [0, 0, 0]


@pytest.mark.parametrize(("k", "per_cent"), [(3, 85), (5, 80)])
def test_near(docs, rows, k, per_cent):
    out = near_dedup.near_duplicates(docs, k=k, per_cent=per_cent)
    assert {r[0]: r[1:] for r in found(out, "doc_id", "n_shingles", "component_id", "kept")} == brute.near(rows, k, per_cent)


def test_near_hard_family(spark):
    """Copies of one text with ever more changes, around the threshold, and copies of such copies."""
    import random

    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(120):
        w = list(base)
        for _ in range(i // 6):
            w[rng.randrange(150)] = f"c{rng.randrange(10**6)}"
        texts.append(w)
        if i % 4 == 0:
            v = list(w)
            v[rng.randrange(150)] = "again"
            texts.append(v)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    out = near_dedup.near_duplicates(d, k=3, per_cent=85)
    assert {r[0]: r[1:] for r in found(out, "doc_id", "n_shingles", "component_id", "kept")} == brute.near(rows, 3, 85)


def test_near_repeated_rows_in_an_open_bucket(spark):
    # the centre is like none of its bucket, so the two that are alike meet in the prefix filter only
    hashing = near_dedup.MinMax(2, 1)

    def bands(words):
        s = near_dedup.shingles(" ".join(words), 1, near_dedup.WordHashes(), near_dedup.Powers())
        return hashing.band_hashes(s).tolist()

    for i in range(200):
        shared = [f"s{i}x{j}" for j in range(95)]
        a, b = (shared + [f"{c}{i}x{j}" for j in range(5)] for c in "ab")
        centre = shared[:40]
        if bands(a) == bands(b) == bands(centre):
            break
    else:
        raise AssertionError("no words found")
    rows = [(0, " ".join(centre))] + [(1, " ".join(a))] * 2 + [(2, " ".join(b))]
    for given in (rows, rows + rows[-1:], [rows[0], *[(None, t) for _, t in rows[1:3]], rows[3]]):
        d = spark.createDataFrame(given, "doc_id long, text string").coalesce(1)
        out = found(near_dedup.near_duplicates(d, k=1, per_cent=85, bands=2, rows=1), "doc_id", "component_id", "keeper")
        least = given[1][0]
        assert sorted((o[:2] for o in out), key=str) == sorted(((i, 0 if i == 0 else least) for i, _ in given), key=str)
        assert sum(o[2] for o in out) == 2


def test_near_ties_and_nulls(spark):
    d = spark.createDataFrame([(4, "a b c d"), (4, "a b c d"), (None, "A b c d"), (5, None), (6, ""), (7, "x")], "doc_id long, text string")
    out = near_dedup.near_duplicates(d, k=3, per_cent=85)
    assert sorted(found(out, "doc_id", "n_shingles", "component_id"), key=str) == sorted(
        [(4, 2, None), (4, 2, None), (None, 2, None), (5, 0, 5), (6, 0, 6), (7, 1, 7)], key=str
    )
    assert out.filter("keeper").count() == 4
    assert sorted(found(near_dedup.drop_near_duplicates(d), "doc_id"), key=str) == [(5,), (6,), (7,), (None,)]
    twice = spark.createDataFrame([(4, "a b c d")] * 3, "doc_id long, text string")
    assert near_dedup.drop_near_duplicates(twice).count() == 1
    assert near_dedup.near_duplicates(d.limit(0)).count() == 0


def test_substring(docs, rows):
    out = substring_dedup.substring_dedup(docs)
    want = brute.substring(rows)
    assert sum(x[1] for x in want.values()) > 500
    assert {r[0]: r[1:] for r in found(out, "doc_id", "n_words", "n_removed", "kept_sha256")} == want


def test_substring_ties_and_nulls(spark):
    same, other = " ".join(["w"] * 60), " ".join(f"v{i}" for i in range(80))
    d = spark.createDataFrame(
        [(3, same), (3, same), (4, same + " tail"), (None, other), (9, "head " + other + " tail"), (5, None), (6, "few words")], "doc_id long, text string"
    )
    out = found(substring_dedup.substring_dedup(d, with_text=True), "doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(out, key=str) == sorted(
        [(3, 60, 0, None), (3, 60, 0, None), (4, 61, 60, "tail"), (None, 80, 0, None), (9, 82, 80, "head tail"), (5, 0, 0, None), (6, 2, 0, None)], key=str
    )
    assert substring_dedup.substring_dedup(d.limit(0)).count() == 0


def test_longest_repeats(spark):
    import random

    rng = random.Random(3)
    shared = [f"s{i}" for i in range(230)]
    own = lambda n: [f"o{rng.randrange(10**9)}" for _ in range(n)]
    texts = [own(30) + shared, shared + own(7), own(5) + shared[:120], own(90), shared[:60] + own(40), shared[:60] + own(40)]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc_id"], r["length"]): r["n_starts"] for r in substring_dedup.longest_repeats(d, 50).collect()}
    want = {}
    for size in (50, 100, 200):
        for i, w in enumerate(texts):
            windows = [tuple(w[k : k + size]) for k in range(len(w) - size + 1)]
            others = {tuple(v[k : k + size]) for j, v in enumerate(texts) if j != i for k in range(len(v) - size + 1)}
            n = sum(x in others for x in windows)
            want |= {(i, size): n} if n else {}
    assert got == want and (0, 200) in got


def test_components_of_a_chain(spark):
    n = 200
    edges = spark.range(n).select(((F.col("id") * 73) % 211).alias("a"), (((F.col("id") + 1) * 73) % 211).alias("b"))
    assert {r["component"] for r in common.components(edges).collect()} == {0}


def test_hot_join_and_running_sum(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    out = common.hot_join(rows, groups, ["k"], "n", 5000, ["id"])
    assert sorted(found(out, "id", "top")) == sorted(found(rows.join(groups, "k"), "id", "top"))
    s = rows.withColumn("slice", F.floor(F.col("id") / 100))
    got = {r["id"]: r["before"] for r in common.running_sum(s, ["k"], "slice", ["id"], "id", "before").collect()}
    total, want = {}, {}
    for k, i in sorted(found(rows, "k", "id"), key=lambda x: x[1]):
        want[i] = total.get(k, 0)
        total[k] = want[i] + i
    assert got == want
