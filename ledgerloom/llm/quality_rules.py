"""Quality rules: a threshold table compiled into one projection over each document.

Everything is a built-in expression on the row at hand: no join, no shuffle, no user function.

Defined results: a null or empty text has no words, fails the length rule and has 0 in every
count; any number of equal rows gives as many equal results; an empty table gives no rows.
Window equality is decided by a 64-bit hash of the window's three words, within one text only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the and of to in is that for it was on are as with be by at from this an or not "
    "le la les de des et un une en du est que qui dans pour pas sur au par ce "
    "der die das und ist von zu den mit ein eine nicht auf sich dem es im auch als "
    "el los las y del se por con para su al lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if ``amount`` * 100 is over ``percent`` of ``whole`` (or under
    it, for a floor). ``amount`` and ``whole`` name metrics."""

    name: str
    amount: str
    percent: int
    whole: str
    floor: bool = False

    def broken(self) -> str:
        """SQL text that Spark and DuckDB read alike."""
        return f"100 * {self.amount} {'<' if self.floor else '>'} {self.percent} * {self.whole}"


#: Under this many words, or with over half of them in repeated 3-word windows, a text fails anyway.
MIN_WORDS = 50
BASE = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"
RULES = (
    Rule("long_words", "word_chars", 1500, "n_words"),
    Rule("short_words", "word_chars", 200, "n_words", floor=True),
    Rule("symbols", "n_symbols", 25, "n_words"),
    Rule("shouts", "n_shouts", 25, "n_words"),
    Rule("stop_words", "n_stop_words", 2, "n_words", floor=True),
    Rule("repeated_lines", "n_dup_lines", 50, "n_lines"),
)
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE_METRICS = ["n_lines", "n_stop_words", "n_shouts"]


def _both_cases(words: list[str]) -> list[str]:
    return sorted({form for w in words for form in (w, w.capitalize())})


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with a struct column ``_m`` of all metrics, the input's columns in ``_row``.

    Arrays that a lambda looks into are columns of a step before, never expressions in place:
    each is read more than once, so Spark keeps the steps apart and builds it once per row.
    """
    get, zero = F.get, F.lit(0).cast("long")
    df = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    df = df.select(
        "_row", "text",
        F.filter(F.split("text", GAP), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    df = df.select(
        "_row", "lines", "words",
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^!]+", "")).cast("long").alias("n_shouts"),
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w, i: F.xxhash64(w, get("words", i + 1), get("words", i + 2))).alias("hashes"),
    )
    df = df.select(
        "_row", "n_symbols", "n_shouts", "n_words",
        F.aggregate("words", zero, lambda a, w: a + F.length(w)).alias("word_chars"),
        F.size(F.filter("words", lambda w: w.isin(_both_cases(STOP_WORDS)))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # the last two hashes cover fewer than three words
        F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - 2, F.lit(0))).alias("windows"),
    )
    # windows found twice are looked for only in texts that have any
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn(
        "windows", F.when(twice, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    )
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    df = df.withColumn("repeats", F.when(F.col("windows").isNotNull(), F.array_sort(F.transform(
        F.filter("windows", lambda x, i: same(x, get("windows", i + 1)) | ((i > 0) & same(x, get("windows", F.greatest(i - 1, F.lit(0)))))),
        lambda x: x["i"],
    ))))
    # a repeated window adds the words that the repeated window before it doesn't cover
    new = F.transform("repeats", lambda p, i: F.when(i == 0, 3).otherwise(
        F.least(F.lit(3), p - get("repeats", F.greatest(i - 1, F.lit(0))))))
    df = df.withColumn("n_repeat_words", F.coalesce(F.aggregate(new, zero, lambda a, x: a + x), zero))
    return df.select("_row", F.struct(*METRICS, *MORE_METRICS).alias("_m"))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``_row`` (all columns of ``docs``), the metrics, ``base_failed``, ``broken`` (names of the
    rules that the text breaks) and ``kept``."""
    df = _measured(docs, text).select("_row", "_m.*")
    df = df.withColumn("base_failed", F.expr(BASE))
    broken: list[Column] = [F.when(F.expr(r.broken()), F.lit(r.name)) for r in rules]
    df = df.withColumn("broken", F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def report(docs: DataFrame) -> DataFrame:
    """One row per document with its counts and verdict."""
    return judged(docs).select(
        F.col("_row.doc_id").alias("doc_id"), *METRICS, "base_failed", "kept", *MORE_METRICS,
        F.array_join("broken", ",").alias("broken"),
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns they came with.

    Spark would move the filter below the steps that measure, spelling out every measure anew
    wherever a rule names it, so that planning alone never ends. A condition on a row's number
    may not move.
    """
    rows = judged(docs).withColumn("_at", F.monotonically_increasing_id())
    return rows.where(F.col("kept") & (F.col("_at") >= 0)).select("_row.*")


def oracle_sql() -> str:
    """The same report over the table ``documents``, for DuckDB."""
    stop = ", ".join(f"'{w}'" for w in _both_cases(STOP_WORDS))
    broken = ", ".join(f"CASE WHEN {r.broken()} THEN '{r.name}' END" for r in RULES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM d
), p AS (
  SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), q AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM p) WHERE c > 1
), n AS (
  SELECT r, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM q) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(list_filter(ws, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop_words,
         CAST(length(regexp_replace(text, '[^!]+', '', 'g')) AS BIGINT) AS n_shouts
  FROM w LEFT JOIN n USING (r)
), v AS (
  SELECT *, ({BASE}) AS base_failed, concat_ws(',', {broken}) AS broken FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND broken = '') AS kept, n_lines, n_stop_words, n_shouts, broken
FROM v"""
