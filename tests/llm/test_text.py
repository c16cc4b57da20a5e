"""Quality rules, chat formatting and language ID."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from terracel.llm import chat_format, language_id, quality_rules


def test_quality_counts(spark):
    rows = brute.documents(8, 30)
    words = ["a", "b", "c", "d", "e", "f"]
    rng = random.Random(2)
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(40))) + "\n#*x\n #*x\n#*x", None, None, 0) for i in range(40)]
    rows += [(2000, "The " * 30, "en", "s", 1), (2001, "a b c d e x a b c d e y a b c d e", "en", "s", 1)]
    d = spark.createDataFrame(rows, brute.SCHEMA).withColumn("n_words", F.lit(5))
    out = quality_rules.quality(d)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    texts = {r[0]: r[1] for r in rows}
    for r in out.collect():
        want = brute.base_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in names) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"] and not r["broken"])
    assert quality_rules.quality(d.limit(0)).count() == 0


def test_quality_verdicts(spark):
    clean = "The house of the old man is on the hill and it was built with stone. " * 2 + "Nobody knows who lived there for all those years."
    rows = [(1, clean), (2, clean.upper()), (3, " | ".join(clean.split())), (4, "qwe rty uio pas dfg hjk lzx cvb nmq wer tyu iop"), (5, None), (6, "12 34 " * 20)]
    out = {r["doc_id"]: r for r in quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["broken"] == ["repeated_words"] or out[1]["kept"]
    assert "capitals" in out[2]["broken"] and "symbols" in out[3]["broken"] and "stop_words" in out[4]["broken"]
    assert not out[5]["kept"] and "letters" in out[6]["broken"]
    plan = quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


TURNS = [
    (1, 0, "system", "be <|im_start|> kind"), (1, 1, "user", None), (1, 2, "assistant", "<\\|x <|im_end|>\nok<"), (1, 3, "user", "|"),
    (1, 4, "assistant", ""), (1, 5, "assistant", "日本 \\n"), (2, 7, "user", "no answer"), (None, 1, "assistant", "a"), (None, None, "user", "first"),
    (3, 0, "assistant\n<|im_end|>\\n", "odd role"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"), (3, 5000, None, "late"),
]


def test_chat(spark):
    d = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("index", F.lit(1)).repartition(3)
    formatted = chat_format.format_chat(d)
    out = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    order = lambda t: tuple((x is not None, x if x is not None else 0) for x in t[1:])
    for conv in {t[0] for t in TURNS}:
        turns = sorted([t for t in TURNS if t[0] == conv], key=order)
        text = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in turns)
        loss = "".join(x or "" for _, _, r, x in turns if r == "assistant")
        r = out[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), brute.sha(text))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), brute.sha(loss))
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: (str(r["conv_id"]), r["index"])):
        assert r["start"] == len(whole.get(r["conv_id"], ""))
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["piece"]
        assert "<|im_" not in r["piece"].replace("<|im_start|>", "", 1).replace("<|im_end|>", "", 1)
    assert {c: len(t) for c, t in whole.items()} == {c: r["formatted_chars"] for c, r in out.items()}
    examples = chat_format.render(formatted).collect()
    assert len(examples) == sum(t[2] == "assistant" for t in TURNS)
    for e in examples:
        assert whole[e["conv_id"]].startswith(e["text"]) and e["text"].endswith("<|im_end|>\n")
        assert chat_format.unescape_text(e["text"][e["loss_start"] : e["loss_end"]]) in {t[3] or "" for t in TURNS if t[2] == "assistant"}
    assert chat_format.read_back(chat_format.format_chat(d.limit(0))).count() == 0


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("<|\\\nnim_") for _ in range(rng.randrange(12))) for _ in range(400)]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, a, b in d.select("t", chat_format.escape_text(F.col("t")), chat_format.escape_role(F.col("t"))).collect():
        assert "<|" not in a and "<|" not in b and "\n" not in b
        assert chat_format.unescape_text(a) == t and chat_format.unescape_role(b) == t


def test_codewords():
    for n in (2, 3, 4, 5, 9, 40):
        code = language_id.codewords(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= 1 and (np.abs(code.sum(axis=0)) < n).all()
    assert language_id.codewords(4).shape == (4, 7)
    assert language_id.codewords(1).shape == (1, 0)


STEMS = {"xx": "bar dol kim", "yy": "çé ûra ñío", "zz": "thu wha oug", "vv": "мир дом год", "uu": "ssa ttu ppe", "ww": "qx zj vk"}


def language_rows(languages, n=60, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(languages)
        stems = STEMS[lang].split()
        rows.append((i, " ".join(rng.choice(stems) + rng.choice(stems) for _ in range(rng.randrange(3, 40))), lang))
    return rows


@pytest.mark.parametrize("languages", [["xx"], ["xx", "yy", "zz", "vv"], list(STEMS)])
def test_language(spark, languages):
    rows = language_rows(languages)
    odd = [(900, None, "xx"), (901, "", "xx"), (902, "12 34 ½ !", "xx"), (903, "a", None), (None, rows[0][1], rows[0][2]), (904, rows[0][1] * 300, None)]
    d = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).repartition(3)
    model = language_id.train_on_documents(d)
    out = {r["doc_id"]: r for r in language_id.predict(d, model).withColumn("held_out", language_id.held_out()).collect()}
    held = [x for x in rows if hashlib_crc(x[0])]
    assert held and all(out[i]["lang_pred"] == lang for i, _, lang in held)
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {*languages, "und"} for r in out.values())
    assert [out[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and out[903]["lang_pred"] != "und"
    assert out[904]["lang_pred"] == out[None]["lang_pred"] == rows[0][2]
    assert language_id.predict(d.limit(0), model).count() == 0


def hashlib_crc(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_language_without_training_rows(spark):
    d = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language_id.predict(d, language_id.train_on_documents(d)).collect()] == ["und"]


def test_features_do_not_cross_texts():
    one = language_id.count_features(["abc"])[0]
    two = language_id.count_features(["zzz", "abc", "zzz"])[1]
    assert (one == two).all()
    assert hashlib.sha256(one.tobytes()).hexdigest() == hashlib.sha256(language_id.count_features(["ABC"])[0].tobytes()).hexdigest()


def test_more_languages_than_are_learnt(spark):
    """The most frequent languages are learnt, rows of the others are left out."""
    rows = [("en", "the and of", i) for i in range(9)] + [("de", "der und die", i) for i in range(8)] + [(f"x{i}", "zzz", i) for i in range(300)]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string, key long"), max_languages=2)
    assert model.languages == ["de", "en"]
    assert len(language_id.train(spark.createDataFrame(rows, "lang string, text string, key long")).languages) == 256


def test_wrong_context_is_seen(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes")], "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_chat(turns)
    wrong = formatted.withColumn("example", F.when(F.col("example").isNotNull(), F.col("example").withField("context_end", F.col("example.context_end") - 1)))
    assert chat_format.read_back(formatted).count() == 1
    with pytest.raises(Exception, match="does not hold all turns"):
        chat_format.read_back(wrong).collect()
