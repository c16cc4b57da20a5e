"""Mixing, archives, packing and the pipeline."""

import random
import zlib
from base64 import b32encode
from collections import defaultdict
from hashlib import sha1

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terracel.llm import mixing, near_dedup, packing, warc
from terracel.llm.common import scratch_path, stage


def mix_rows(shares, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for source, n in shares.items():
        for _ in range(n):
            rows.append((i, " ".join(f"w{k}" for k in range(rng.randrange(0, 120))), "en", source, 0))
            i += 1
    return rows


@pytest.mark.parametrize("shares", [{"a": 200, "b": 5, "c": 9, None: 40}, {"a": 50, "b": 50, "ä": 50}, {"only": 30}])
def test_mix(spark, shares):
    rows = mix_rows(shares)
    rows += [(9_000, None, "en", "a", 0), (9_001, "", "en", "only", 0)] if "only" in shares or "a" in shares else []
    d = spark.createDataFrame(rows, brute.SCHEMA).selectExpr("*", "1 AS block", "2 AS slot", "'q' AS name").repartition(4)
    out = mixing.mix_sizes(d, block_words=16).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    target = brute.mix_targets(sizes)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(out) == len(rows)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 16 * 4, (s, taken[s], t)
    again = mixing.mix_sizes(d.repartition(7), block_words=16).collect()
    assert sorted(out, key=lambda r: r["doc_id"]) == sorted(again, key=lambda r: r["doc_id"])
    texts = mixing.mix(d, block_words=16)
    assert texts.columns == d.columns
    # texts are whole: each pass but the last of a source takes them in full, and the last one is rounded
    given, times = {r[0]: r[1] for r in rows}, defaultdict(int)
    for r in texts.collect():
        assert r["text"] == given[r["doc_id"]] and r["n_chars"] == 0 and (r["block"], r["slot"], r["name"]) == (1, 2, "q")
        times[r["doc_id"]] += 1
    for r in out:
        assert times[r["doc_id"]] == int(r["taken"] / r["size"] + 0.5) if r["size"] else not times[r["doc_id"]]


def test_mix_schedule_is_even(spark):
    rows = mix_rows({"a": 80, "b": 80, "c": 80})
    _, segments = mixing.mix_plan(spark.createDataFrame(rows, brute.SCHEMA), block_words=16)
    slots = segments.select("slot").distinct().orderBy("slot")
    assert slots.count() == slots.agg(F.max("slot")).first()[0] + 1
    # every slot is filled with one whole block, but for the last ones of a stream
    full = segments.groupBy("slot").agg(F.sum("words").alias("n")).filter("n = 16").count()
    assert full >= slots.count() - 3


def test_mix_ties_and_empty(spark):
    d = spark.createDataFrame([(1, "a b c", "en", "s", 5)] * 3 + [(None, "d e", "en", "s", 3), (2, None, None, None, 0)], brute.SCHEMA)
    out = mixing.mix_sizes(d, block_words=1).collect()
    assert sum(r["taken"] for r in out) == 11 and len(out) == 5
    assert mixing.mix(d, block_words=1).count() >= 4
    assert mixing.mix_sizes(d.limit(0)).count() == 0 and mixing.mix(d.limit(0)).count() == 0
    assert mixing.mix_sizes(d.filter("text is null")).first()["taken"] == 0


PAGES = [
    (5, "http://a.example/x?y#z", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, "http://b.example", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (9, None, None), (1, "bad url\r\nX: y", ""),
    (3, "http://c.example/" + "p" * 200, "long " * 40_000), (4, "http://c.example/q", "long " * 40_000), (7, "http://d.example/", "one"),
]


@pytest.mark.parametrize("least", [0, 10])
def test_warc(spark, least):
    d = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    path = scratch_path(spark, "test-warc")
    warc.write_warc(d, path, min_revisit_bytes=least, records_per_file=2)
    records = warc.read_records(spark, path)
    assert records.groupBy("kind").count().count() == 4
    captures = warc.assemble(records)
    pages = {r["page_id"]: r for r in warc.capture_pages(captures).collect()}
    first = {}
    for i, _, html in sorted(PAGES):
        first.setdefault(html or "", i)
    for i, _, html in PAGES:
        raw, r = (html or "").encode(), pages[i]
        revisit = len(raw) >= least and first[html or ""] != i
        want = (len(raw), b32encode(sha1(raw).digest()).decode(), "revisit" if revisit else "response", first[html or ""] if revisit else None)
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == want
    assert len(pages) == len(PAGES)
    nested = {warc_page(r): r for r in captures.collect()}
    assert bytes(nested[2]["response"]["payload"]).decode() == PAGES[1][2]
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 for r in nested.values())
    assert nested[5]["requests"][0]["head"].startswith("GET /x?y HTTP/1.1\r\nHost: a.example")
    assert nested[1]["target_uri"] == "bad url%0D%0AX: y" and nested[9]["target_uri"] is None


def warc_page(row):
    return int(row["metadata"][0]["head"].split("page-id: ")[1].split("\r")[0])


RECORDS = "kind string, record_id string, target_uri string, concurrent_to array<string>, refers_to string, stated_digest string, head string, payload binary, payload_bytes long, payload_digest string"


def test_assemble_keeps_every_side(spark):
    """Several sides of a capture, a side of several captures, links in either direction, nulls and repeated rows."""
    rows = [
        ("response", "r1", ["q2"], "h"), ("revisit", "r2", [], "h"), ("response", "r3", [], "h"), ("response", None, [], "h"),
        ("request", "q1", ["r1", "r2"], "a"), ("request", "q2", [], "b"), ("metadata", "m1", ["r1"], "c"), ("metadata", "m2", ["r1"], "d"),
        ("metadata", "m2", ["r1"], "d"), ("metadata", "m3", ["nobody"], "e"), ("metadata", "m4", [], "f"), ("warcinfo", "i", ["r1"], "g"), (None, None, None, None),
    ]
    d = spark.createDataFrame([(k, i, None, c, None, None, h, None, None, None) for k, i, c, h in rows], RECORDS)
    got = {r["record_id"]: ([x["record_id"] for x in r["requests"]], [x["record_id"] for x in r["metadata"]]) for r in warc.assemble(d.withColumn("requests", F.lit(1))).collect()}
    assert got == {"r1": (["q1", "q2"], ["m1", "m2"]), "r2": (["q1"], []), "r3": ([], []), None: ([], [])}
    assert warc.assemble(d.limit(0)).count() == 0


def test_repeated_header_fields():
    block = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Concurrent-To: <a>\r\nwarc-concurrent-to: <b>\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    import io
    (head, body), = warc.parse_records(io.BytesIO(block))
    assert head["warc-concurrent-to"] == ["<a>", "<b>"] and body == b"x"


def test_warc_ties_and_empty(spark):
    d = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (2, "u", "x"), (None, "u", "x"), (None, "u", "y")], "page_id long, url string, html string")
    path = scratch_path(spark, "test-warc")
    warc.write_warc(d, path)
    out = [tuple(r) for r in warc.capture_pages(warc.assemble(warc.read_records(spark, path, False))).select("page_id", "record_type", "refers_to").collect()]
    assert sorted(out, key=str) == sorted([(1, "response", None)] * 2 + [(2, "revisit", 1), (None, "revisit", 1), (None, "response", None)], key=str)
    empty = scratch_path(spark, "test-warc")
    warc.write_warc(d.limit(0), empty)
    assert warc.capture_pages(warc.assemble(warc.read_records(spark, empty, False))).count() == 0


def test_reading_other_archives(spark):
    """Plain files and members gzipped one by one, with records of other kinds."""
    import gzip
    import os

    path = scratch_path(spark, "test-warc").removeprefix("file://")
    os.makedirs(path)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nContent-Length: 3\r\n\r\na:b\r\n\r\n"
    resp = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 22\r\n\r\nHTTP/1.1 200\r\n\r\nab\r\n\r\n\r\n"
    resp = resp.replace(b"Content-Length: 22", b"Content-Length: 20")
    with open(f"{path}/a.warc", "wb") as f:
        f.write(info + resp)
    with open(f"{path}/b.warc.gz", "wb") as f:
        f.write(gzip.compress(info) + gzip.compress(resp))
    rows = warc.read_records(spark, path).filter("kind = 'response'").collect()
    assert [bytes(r["payload"]) for r in rows] == [b"ab\r\n", b"ab\r\n"] or [bytes(r["payload"]) for r in rows] == [b"ab\r\n"[:4]] * 2


def check_plan(lengths, capacity):
    plan = packing.plan_sequences(lengths, capacity)
    used = defaultdict(int)
    for pattern, times in plan:
        assert sum(pattern) <= capacity and times > 0
        for x in pattern:
            used[x] += times
    assert dict(used) == {k: v for k, v in lengths.items() if v}
    return sum(t for _, t in plan)


def best_possible(items, capacity):
    """Fewest sequences, by trying everything."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in set(rooms):
            if r >= items[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def lower_bound(lengths, capacity):
    """Sequences that long pieces need, and what short ones need beyond the room beside them."""
    best = 0
    for k in range(capacity // 2 + 1):
        one = sum(n for x, n in lengths.items() if x > capacity - k)
        two = {x: n for x, n in lengths.items() if capacity / 2 < x <= capacity - k}
        three = sum(x * n for x, n in lengths.items() if k <= x <= capacity / 2)
        room = sum((capacity - x) * n for x, n in two.items())
        best = max(best, one + sum(two.values()) + max(0, -(-(three - room) // capacity)))
    return best


def test_plans_are_near_the_best():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))]
        lengths = {x: items.count(x) for x in items}
        best = best_possible(items, capacity)
        assert best <= check_plan(lengths, capacity) <= best + 1
        fixed = packing.Counts(lengths)
        n = sum(t for _, t in packing.reduce_by_dominance(fixed, capacity))
        left = [x for x, k in fixed.n.items() for _ in range(k)]
        # what dominance fixes is part of some best packing
        assert n + best_possible(left, capacity) == best
    big = {x: rng.randrange(1, 3000) for x in range(1, 1025)}
    assert check_plan(big, 1024) <= lower_bound(big, 1024) * 1.002 + 1


def test_packing(spark):
    rows = brute.documents(9, 30) + [(500, "word " * 3000, "en", "a", 0), (501, "<|endoftext|> x  y\n\n z", None, None, 0)]
    d = spark.createDataFrame(rows, brute.SCHEMA).selectExpr("*", "1 AS piece", "2 AS rank").repartition(4)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    packed = packing.pack_documents(d, capacity=256, with_ids=True).cache()
    docs = defaultdict(list)
    places = defaultdict(list)
    for r in packed.collect():
        docs[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted(docs[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // 256)))
        at = 0
        for r in pieces:
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part.tobytes()) and bytes(r["ids"]) == part.tobytes()
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 256 for r in pieces[1:])
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 256
    joined = {r["sequence_id"]: len(r["ids"]) // 4 for r in packing.sequences(packed).collect()}
    assert joined == {s: sum(n for _, n in x) for s, x in places.items()}
    assert packing.pack_documents(d.limit(0)).count() == 0


def test_fast_encoding_gives_the_same_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    assert encoder.fast is not None and packing.fast_encoding(public_tokenizers.path("word_bpe_49k.json")) is None
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "é", "1", "'s", "'LL", ".", "<|endoftext|>", "<|", "　", "日本", "😀", "\x1c", "\x85", "\r\n", "\u200b", "_", "’", "½", "²", "\xa0", "ǅ", "\xad", "ª"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(20)))
        assert encoder.encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    for lo in range(0, 0x250, 16):
        t = " ".join("a" + chr(c) + "b" + chr(c) for c in range(lo, lo + 16))
        assert encoder.encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_clashing_columns_stay(spark):
    """Columns named like internal ones come back as they were from both row filters."""
    rows = [(i, f"alpha beta gamma delta epsilon zeta {i % 3} " * 5, "s", f"own{i}") for i in range(9)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, _id string")
    d = d.withColumns({c: F.col("_id") for c in ("_hash", "_source", "_nth", "_part", "id", "hash", "nth", "doc", "times", "row", "dotted.name")})
    for out in (mixing.mix(d, block_words=4), near_dedup.drop_near_duplicates(d, k=5, per_cent=80)):
        got = out.collect()
        assert out.columns == d.columns and got
        assert all(r[c] == f"own{r['doc_id']}" for r in got for c in d.columns[3:])


def test_texts_beyond_the_rank_encoder(spark):
    """Runs of two million blanks and of two million letters take the tokenizer itself."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = {1: "x" + " " * 2_000_000 + "y", 2: "a" * 2_000_000, 3: "short"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = defaultdict(bytes)
    for r in packing.pack_documents(d, with_ids=True).orderBy("doc_id", "piece").collect():
        got[r["doc_id"]] += bytes(r["ids"])
    tokenizer = Tokenizer.from_file(path)
    for i, t in texts.items():
        assert got[i] == np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()


def test_pipeline(spark, tmp_path):
    """Stages chained as in run(), each held against the plain version of its operator on what the one before kept."""
    rng = random.Random(1)
    rows = [r for r in brute.documents(12, 50)]
    rows = [(i, t, "en" if rng.random() < 0.5 else "de", s, n) for i, t, _, s, n in rows]
    rows = [(i, (t or "").replace("alpha", "der die") if lang == "de" and t else t, lang, s, n) for i, t, lang, s, n in rows]
    spark.createDataFrame(rows, brute.SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(tmp_path)), f"test-{name}")
        kept[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    of = lambda name: [tuple(r) for r in kept[name]]
    # language ID: documents as they were but for lang; those without a letter go, few others do
    given = {r[0]: r for r in rows}
    no_letter = {r[0] for r in rows if not any(c.isalpha() for c in r[1] or "")}
    assert all(r[1] == given[r[0]][1] and r[3:] == given[r[0]][3:] for r in of("language_id"))
    assert not {r[0] for r in of("language_id")} & no_letter and len(of("language_id")) >= 0.9 * (len(rows) - len(no_letter))
    # line dedup: all documents, their other lines
    want = {i: x[2] for i, x in brute.line_dedup(of("language_id")).items()}
    assert {r[0]: r[1] for r in of("line_dedup")} == want and all(r[4] == len(r[1]) for r in of("line_dedup"))
    # near dedup: the keepers, unchanged
    keepers = {i for i, x in brute.near(of("line_dedup"), 5, 80).items() if x[2]}
    assert sorted(of("near_dedup"), key=str) == sorted((r for r in of("line_dedup") if r[0] in keepers), key=str)
    # mixing: whole rows, three times at most, each source near its target
    times = defaultdict(int)
    for r in of("mixing"):
        times[r] += 1
    before, sizes, longest = set(of("near_dedup")), defaultdict(int), defaultdict(int)
    assert set(times) <= before and max(times.values()) <= 3
    for r in before:
        n = len(brute.words(r[1]))
        sizes[r[3]] += n
        longest[r[3]] = max(longest[r[3]], n)
    for s, t in brute.mix_targets(sizes).items():
        taken = sum(k * len(brute.words(r[1])) for r, k in times.items() if r[3] == s)
        assert abs(taken - t) <= 64 * 2 + longest[s] / 2
    # packing: every row of the mix in full, sequences without gaps
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens, packed, spans = defaultdict(int), defaultdict(int), defaultdict(list)
    for r in of("mixing"):
        tokens[r[0]] += len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1
    for r in kept["packing"]:
        packed[r["doc_id"]] += r["length"]
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    assert packed == tokens
    for places in spans.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    # run() does the same
    again = corpus_pipeline.run(spark, str(tmp_path))
    plain = lambda rs: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rs)
    assert plain(again.collect()) == plain(kept["packing"])


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], brute.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
