"""The prefix trie against dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from terracel.llm.prefix_trie import op11_prefix_trie, prefix_trie

from brute import words

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_numbered(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in out.items()}


def plain_rebuilt(rows):
    own = plain_numbered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(words(p[-1][1])) if p else 0
    return sorted(
        (min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, cs in members.items()
    )


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def chats(seed, n=70, longest=6):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for i in range(rng.randrange(1, longest + 1)):
            text = rng.choice(["", None, "hello there", "a b\tc", "a b c", "ok"])
            rows.append((c, rng.choice([i, i, i, None, 3]), rng.choice(["user", "assistant", "assistant", None]), text))
    rows += rows[5:15] + [(None, 0, "user", "x"), (1000, None, None, None), (1001, 0, "user", "hello there")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_query(spark, tmp_path, seed):
    rows = chats(seed)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert sorted_rows(op11_prefix_trie(spark, str(tmp_path))) == plain_trie(plain_rebuilt(rows))


def test_bands(spark):
    """Shared and own stretches deeper than two levels of bands of three depths."""
    rng = random.Random(2)
    rows = []
    for c in range(12):
        for i in range(rng.choice([0, 1, 5, 27, 30, 31, 40])):
            rows.append((c, i, "user", "same words" if i < 28 or c % 3 else f"own {c} {i}"))
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA), band=3)
    assert sorted_rows(got) == plain_trie(plain_numbered(rows))


def test_turnless_clashing_and_empty(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x y", 9, 9)], SCHEMA + ", node long, depth long")
    convs = spark.createDataFrame([(1,), (2,), (2,), (None,)], "conv_id long")
    assert sorted_rows(prefix_trie(turns, convs)) == plain_trie({1: [("user", "x y")], 2: []})
    assert prefix_trie(turns.limit(0)).count() == 0
    assert sorted_rows(prefix_trie(turns.limit(0), convs)) == plain_trie({1: [], 2: []})


def test_one_conversation_holds_most_turns(spark):
    rows = [(1, i, "user", f"t{i} " * 3) for i in range(3000)] + [(c, 0, "user", "t0 " * 3) for c in range(2, 400)]
    got = {(r[0], r[1]): r for r in (tuple(x) for x in prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect())}
    assert len(got) == 3001
    assert got[1, 0][3:7] == (399, 1, 1, 398 * 3) and got[1, 1][3:7] == (399, 1, 1, 398 * 3) and got[1, 2][3:7] == (1, 1, 1, 0)
    assert got[1, 1][7] == hashlib.sha256(",".join(map(str, range(2, 400))).encode()).hexdigest() and got[1, 3000][4] == 0


def test_very_long_text(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long), (2, 0, "user", long), (2, 1, "assistant", "b"), (3, 0, "user", long + "x")]
    assert sorted_rows(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(plain_numbered(rows))
