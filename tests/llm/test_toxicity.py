"""Toxicity: the machine's formula, pairs that weights alone cannot tell, and held-out accuracy."""

import random

import numpy as np
import pytest
from terracel.llm import toxicity
from terracel.llm.toxicity import BINS, FACTORS, Model, Terms, fit, op12_toxicity, probability, raw_scores, score, train

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_formula():
    """Sum over all pairs, written out."""
    rng = np.random.default_rng(0)
    weight, factor = rng.normal(size=20), rng.normal(size=(20, FACTORS))
    rows = [rng.choice(20, k, replace=False) for k in (0, 1, 2, 7)]
    plain = [0.3 + sum(weight[i] for i in r) + sum(factor[i] @ factor[j] for a, i in enumerate(r) for j in r[a + 1 :]) for r in rows]
    assert np.allclose(raw_scores(rows, 0.3, weight, factor), plain)


def test_pairs_beyond_weights():
    """Toxic where an insult meets a group: each alone is common and clean."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.array([0] * insult + [1] * group + [2 + rng.integers(5)], np.int64))
        labels.append(float(insult and group))
    bias, weight, factor = fit(rows, np.array(labels), 7)
    p = probability(raw_scores([np.array([0, 1, 2]), np.array([0, 2]), np.array([1, 2]), np.array([2])], bias, weight, factor))
    assert p[0] > 0.9 and max(p[1:]) < 0.1
    assert factor[0] @ factor[1] > 1


def test_terms():
    assert Terms().of(None) == Terms().of("") == Terms().of("12 .,!") == set()
    assert Terms().of("Scum scum, SCUM!") == Terms().of("scum") and len(Terms().of("scum")) == 2
    assert Terms().of("lowei") & Terms().of("loweizer") and max(Terms().of("x y z")) < BINS
    long = "word " * 500_000 + "end"
    assert Terms().of(long) == Terms().of("word end")


def corpus(n, seed):
    """Clean texts and texts with one to three words of an invented list; every tenth id has no label."""
    rng = random.Random(seed)
    vocab = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrs')}{rng.choice('aeiou')}{rng.choice('tpk')}" for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.12
        ws = [rng.choice(vocab) for _ in range(rng.randrange(5, 60))]
        for _ in range(rng.randrange(1, 4) * toxic):
            ws.insert(rng.randrange(len(ws) + 1), rng.choice(["zurgh", "Zurghix", "quavv,", "vlonk"]))
        docs.append((i, " ".join(ws), "en", "s", 1))
        if i % 10:
            labels.append((i, 1, int(toxic)))
    truth = {d[0]: any(w in d[1].lower() for w in ("zurgh", "quavv", "vlonk")) for d in docs}
    return docs, labels, truth


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("toxic"))
    docs, labels, truth = corpus(3000, 2)
    docs += [(5000, None, None, None, None), (5001, "", "", "", 0), (None, "vlonk quavv", None, None, None), docs[7], docs[7]]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([*labels, labels[0], (None, 1, 1), (3, None, None), (9999, 1, 1)], LABELS).write.parquet(f"{path}/labels.parquet")
    return path, truth


def test_held_out_accuracy(spark, folder):
    path, truth = folder
    got = op12_toxicity(spark, path).collect()
    assert len(got) == 3005 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    right = sum(truth[r["doc_id"]] == bool(r["predicted"]) for r in held)
    assert len(held) > 500 and right / len(held) > 0.99
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5000]["score"] == by_id[5001]["score"] < 0.3 and by_id[None]["predicted"] == 1
    assert sorted(map(str, op12_toxicity(spark, path).collect())) == sorted(map(str, got))


def test_labels_of_held_out_rows_are_not_learnt(spark, folder, tmp_path):
    """Turning round every held-out label changes no score."""
    path, _ = folder
    labels = spark.read.parquet(f"{path}/labels.parquet")
    turned = labels.selectExpr("doc_id", "quality", "case when crc32(coalesce(string(doc_id), '')) % 4 = 2 then 1 - toxic else toxic end as toxic")
    turned.write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{path}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(str, op12_toxicity(spark, str(tmp_path)).collect())) == sorted(map(str, op12_toxicity(spark, path).collect()))


def test_scores_match_the_plain_machine(spark):
    rng = np.random.default_rng(4)
    place = np.full(BINS, -1, np.int32)
    known = sorted(Terms().of("alpha beta gamma delta"))
    place[known] = np.arange(len(known))
    model = Model(place, -0.5, rng.normal(size=len(known)), rng.normal(size=(len(known), FACTORS)))
    texts = ["alpha beta", "", None, "delta, gamma alpha unknown", "unknown"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, body string").selectExpr("id", "body", "7 as score", "8 as text")
    got = {r["doc_id"]: r["score"] for r in score(docs, model, "id", "body").collect()}
    for i, text in enumerate(texts):
        at = sorted(int(place[b]) for b in Terms().of(text) if place[b] >= 0)
        raw = model.bias + sum(model.weight[a] for a in at) + sum(model.factor[a] @ model.factor[b] for k, a in enumerate(at) for b in at[k + 1 :])
        assert got[i] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "key long, toxic int, text string")
    model = train(none)
    assert toxicity.score(spark.createDataFrame([(1, "x")], "doc_id long, text string"), model).first()["score"] == 0.5
    assert score(none.selectExpr("key as doc_id", "text"), model).count() == 0
