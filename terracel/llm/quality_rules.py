"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, read_table, words_of
from .registry import query

SYMBOLS = "[#*$%&|<>]"
MARKS = ".,;:!?"
WINDOW = 5

#: Frequent function words of the languages in the tables.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "was", "for", "on", "are", "with", "as", "this", "by", "at", "or", "from", "an", "a",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "dans", "pour", "ou",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "su", "al",
    "der", "die", "und", "das", "ist", "zu", "den", "von", "mit", "ein", "eine", "nicht", "auf", "im",
)


class Rule(NamedTuple):
    """``low * of <= 100 * metric <= high * of``, in whole numbers; an open side is None."""

    name: str
    metric: str
    of: str
    low: int | None
    high: int | None


#: The threshold table: each ratio in per cent of the column ``of``.
RULES = (
    Rule("length", "n_words", "one", 1_000, None),
    Rule("word_length", "word_chars", "n_words", 250, 1_200),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("stop_words", "n_stop_words", "n_words", 4, None),
    Rule("letters", "n_letter_words", "n_words", 60, None),
    Rule("capitals", "n_capitals", "word_chars", None, 35),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 40),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 20),
)


def any_of(words) -> str:
    """Pattern of ``words``, which are letters only: words with a first part in common branch after it."""
    branches: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        branches.setdefault(w[:1], []).append(w[1:])
    one = [head + any_of(tails) for head, tails in branches.items() if head]
    whole = one[0] if len(one) == 1 else f"(?:{'|'.join(one)})"
    if "" not in branches:
        return whole
    return f"(?:{whole})?" if one else ""


def window_keys(df: DataFrame, hashes: str, size: int, out: str) -> DataFrame:
    """``out``: one number per window of ``size`` consecutive ``hashes``, each shifted by its place, all combined bit by bit.

    Windows of two, four, ... are made from those of half their size, and the rest is put together
    from windows of such sizes.  Texts with fewer words have no window.
    """

    def joined(first: str, then: str, by: int):
        n = F.greatest(F.size(then) - by, F.lit(0))
        return F.zip_with(F.slice(first, F.lit(1), n), F.slice(then, F.lit(by + 1), n), lambda x, y: x.bitwiseXOR(F.shiftleft(y, by)))

    keys, done, part, span = None, 0, hashes, 1
    while size:
        if size & 1:
            if keys is None:
                df = df.withColumn(out, F.col(part))
            else:
                df = df.withColumn(out, joined(out, part, done))
            keys, done = out, done + span
        size >>= 1
        if size:
            df = df.withColumn(f"{out}_{2 * span}", joined(part, part, span))
            part, span = f"{out}_{2 * span}", 2 * span
    return df


def repeated_window_words(df: DataFrame, keys: str, out: str) -> DataFrame:
    """``out``: words in windows of WINDOW words found at least twice; ``keys`` holds one number per window, in order.

    Texts without a repeated key stop at a hash set; in the others equal keys meet by sorting, and
    each repeated window adds the words that the one before it does not hold.
    """
    none = F.array().cast("array<int>")
    pairs = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    no_pair = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_pairs", F.when(F.size(F.array_distinct(keys)) == F.size(keys), no_pair).otherwise(pairs))
    both = F.zip_with(
        "_pairs", F.slice("_pairs", F.lit(2), F.size("_pairs")), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(none)
    )
    df = df.withColumn("_at", F.sort_array(F.array_distinct(F.flatten(both))))
    grown = F.aggregate(
        "_at", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return df.withColumn(out, grown)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every text, in one projection of built-in functions: the columns that RULES name."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), words_of(F.col(text_col)).alias("_words"))
    n = F.size("_words")
    split = split.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    split = repeated_window_words(window_keys(split, "_hashes", WINDOW, "_windows"), "_windows", "_repeats")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    split = split.select("*", lines.alias("_lines"))
    count = lambda pattern: F.regexp_count("_text", F.lit(pattern)).cast("long")
    # whole words by what stands around them: a blank in front of the text spares looking back at every character
    in_words = lambda pattern: F.regexp_count(F.concat(F.lit(" "), "_text"), F.lit(rf"[ \t-\r]{pattern}(?![^ \t-\r])")).cast("long")
    # a stop word counts in any case and with marks after it
    stop_words = in_words(rf"(?i:{any_of(STOP_WORDS)})[{MARKS}]*+")
    letterless = in_words(r"[^\p{L} \t-\r]++")
    return split.select(
        "doc_id", n.cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeats").cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        stop_words.alias("n_stop_words"),
        (n - letterless).cast("long").alias("n_letter_words"),
        count(r"\p{Lu}").alias("n_capitals"),
        F.lit(1).cast("long").alias("one"),
    )


def compile_rules(rules=RULES) -> Column:
    """Names of the rules that a row of ``measure`` breaks, as one array expression."""

    def broken(rule: Rule) -> Column:
        value, of = F.col(rule.metric) * 100, F.col(rule.of)
        low = F.lit(False) if rule.low is None else value < of * rule.low
        high = F.lit(False) if rule.high is None else value > of * rule.high
        return F.when(low | high, F.lit(rule.name))

    return F.array_compact(F.array(*[broken(r) for r in rules]))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Metrics and verdict of every text: doc_id, the counts, base_failed, broken (rule names), kept.

    No shuffle and no user function.  Null and empty texts have no words and fail; repeated rows are
    judged alike; an empty table gives no rows; other columns are ignored.  Long texts are read whole:
    every step is linear but for one sort of the windows of texts that repeat one.
    """
    m = measure(docs, id_col, text_col)
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    m = m.select("*", base.alias("base_failed"), compile_rules(rules).alias("broken"))
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)).drop("one")


def rules_sql(rules=RULES) -> str:
    """The rule table as one SQL expression: names of broken rules, joined by commas."""
    cases = []
    for r in rules:
        sides = [f"{r.metric} * 100 < {r.of} * {r.low}"] * (r.low is not None) + [f"{r.metric} * 100 > {r.of} * {r.high}"] * (r.high is not None)
        cases.append(f"CASE WHEN {' OR '.join(sides)} THEN '{r.name}' END")
    return f"concat_ws(',', {', '.join(cases)})"


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), v AS (
  SELECT doc_id, unnest(windows) AS win, generate_subscripts(windows, 1) AS i
  FROM (SELECT doc_id, list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) AS windows FROM w WHERE len(words) >= 5)
), r AS (
  SELECT doc_id, i FROM v QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(5) t(k) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(words, lambda x: list_contains({stop}, lower(rtrim(x, '.,:;!?'))))) AS BIGINT) AS n_stop_words,
         CAST(len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS BIGINT) AS n_letter_words,
         CAST(len(regexp_extract_all(text, '\p{Lu}')) AS BIGINT) AS n_capitals, 1 AS one
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {rules} AS broken FROM m
)
SELECT * EXCLUDE (one), NOT base_failed AND broken = '' AS kept FROM b
""".replace("{stop}", str(sorted(set(STOP_WORDS)))).replace("{rules}", rules_sql())


@query("op3_quality_rules", OP3_SQL)
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality rules on all documents."""
    return quality(read_table(spark, folder, "documents")).withColumn("broken", F.array_join("broken", ","))
