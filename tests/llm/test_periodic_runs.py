"""Periodic runs against a plain lag-by-lag search."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracel.llm.hashing import Powers
from terracel.llm.periodic_runs import find_runs, op13_periodic_runs, periodic_runs

from brute import SCHEMA, documents, sha, words


def plain_runs(ws):
    """Every lag, every stretch; the least lag of equal stretches is the period."""
    out = {}
    for p in range(1, len(ws) // 3 + 1):
        i = 0
        while i + p < len(ws):
            j = i
            while j + p < len(ws) and ws[j] == ws[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p):
                out.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def plain_row(doc_id, text):
    ws = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and ws:
        g, n = h // 10, len(ws)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = plain_runs(ws)
    best = (None,) * 4
    if runs:
        top = runs[0]
        for r in runs:
            if r[1] * top[2] > top[1] * r[2]:
                top = r
        best = (*top, 1000 * top[1] // top[2])
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(plain_collapsed(ws, runs)))


def periodic_text(rng):
    """Stretches with periods of 1 to 120 words, some of them powers, some cut short."""
    ws = []
    for _ in range(rng.randrange(8)):
        vocab = rng.choice([1, 2, 3, 6, 1000])
        unit = [f"w{rng.randrange(vocab)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 10, 12, 13, 17, 25, 40, 77, 120]))]
        if rng.random() < 0.3:
            unit = unit * rng.randrange(1, 4) + unit[: rng.randrange(len(unit) + 1)]
        n = int(len(unit) * rng.choice([1, 1, 2, 2.5, 3, 3.2, 4, 7.7]))
        ws += [unit[i % len(unit)] for i in range(n)] + [f"x{rng.randrange(999)}" for _ in range(rng.choice([0, 0, 3]))]
    return ws


@pytest.mark.parametrize("seed", range(6))
def test_find_runs(seed):
    rng = random.Random(seed)
    for _ in range(20):
        texts = [periodic_text(rng) for _ in range(rng.randrange(1, 12))]
        number = {w: i for i, w in enumerate({w for t in texts for w in t})}
        found = find_runs([np.array([number[w] for w in t], np.int64) for t in texts], Powers())
        assert [found.get(i, []) for i in range(len(texts))] == [plain_runs(t) for t in texts]


def test_limits():
    """24 words or three periods are enough, one less is not; copies of a power have the smaller period."""
    for unit, n, told in ((1, 24, 1), (1, 23, 0), (8, 24, 1), (8, 23, 0), (9, 27, 1), (9, 26, 0), (50, 150, 1), (50, 149, 0)):
        ws = [i % unit for i in range(n)]
        assert len(find_runs([np.array(ws)], Powers())) == told
    assert find_runs([np.array([0, 1] * 40)], Powers()) == {0: [(0, 80, 2)]}


def test_query(spark, tmp_path):
    rng = random.Random(3)
    rows = documents(4, 40) + [(1000 + i, "\n".join(periodic_text(rng)), "en", "s", 1) for i in range(80)]
    rows += [rows[3], rows[3], (None, "a " * 40, None, None, None), (None, None, None, None, None), (5000, " ", "x", "y", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(str(plain_row(r[0], r[1])) for r in rows)
    assert any(r[1] > 1 for r in got) and any(r[1] == 0 for r in got)


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([("k", "a b " * 20, 7, "x"), (None, None, 8, "y")], "id string, body string, runs int, collapsed string")
    got = periodic_runs(docs, "id", "body").orderBy(F.col("doc_id").desc_nulls_last()).collect()
    assert [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got] == [("k", 40, [(0, 40, 2)], "a b"), (None, 0, [], "")]
    none = periodic_runs(docs.limit(0), "id", "body")
    assert none.count() == 0 and none.columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_very_long_text(spark):
    """A text of 600,000 words with one long period and one crowd of a single word."""
    rng = random.Random(1)
    unit = [f"u{rng.randrange(10**6)}" for _ in range(60_000)]
    ws = unit * 4 + ["z"] * 360_000
    row = periodic_runs(spark.createDataFrame([(1, " ".join(ws))], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 240_000, 60_000), (240_000, 360_000, 1)]
    assert hashlib.sha256(row["collapsed"].encode()).hexdigest() == sha(plain_collapsed(ws, [(0, 240_000, 60_000), (240_000, 360_000, 1)]))
