"""Line-first cleaning and document rules, in DataFrame functions only.

Each line that holds a word is judged by itself:

* punctuation: marks other than ordinary sentence punctuation are over ``mark_percent`` of
  its non-blank characters;
* navigation: ``separators`` or more menu separators;
* boilerplate: it names a cookie notice, a policy, a licence, a prompt to subscribe or to
  switch something on.

Failing lines are removed. A document is rejected if its base figures fail (under
``min_words`` words, or over ``repeat_percent`` of its words in repeated 8-word windows), or
if the removed lines hold over ``loss_percent`` of its word characters.

Everything is computed within a row: no shuffle. Equal windows are told by 64-bit hashes of
their words within one text (a collision among a text's n windows has odds n**2 / 2**65);
only texts with an equal pair sort their windows.

Defined results: a null text has no words and no lines and fails; an empty one too;
repeated rows are judged each; null doc_ids stay; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import table

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
NOT_MARK = r"[^#*$%&|<>!?=+~^{}\[\]\\/_@`•·»«]+"
NOT_SEPARATOR = r"[^|•·»«>]+"
# fixed values: phrases of boilerplate lines
BOILERPLATE = ("(?i)(cookie|privacy policy|terms of (use|service)|all rights reserved|subscribe|sign up|sign in|"
               "log in|click here|read more|lorem ipsum|enable javascript|licensed under|released under the|"
               "powered by|follow us|share this|skip to content|back to top)")
WINDOW = 8


def chars(text: Column, without: str) -> Column:
    return F.length(F.regexp_replace(text, without, ""))


def line_fails(line: Column, mark_percent: int, separators: int) -> Column:
    return ((chars(line, NOT_MARK) * 100 > chars(line, BLANK) * mark_percent)
            | (chars(line, NOT_SEPARATOR) >= separators) | line.rlike(BOILERPLATE))


def repeated_words(df: DataFrame) -> DataFrame:
    """``df`` (column ``_words``) with n_repeat_words. A column that a lambda reads is
    computed in a step of its own, so it is computed once per row."""
    none = F.array().cast("array<bigint>")
    windows = F.transform(F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))
    df = df.withColumn("_hashes", F.when(F.size("_words") > WINDOW, windows).otherwise(none))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    pairs = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(pairs))
                       .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))

    def shared(s: Column, k: Column) -> Column:
        same = lambda other: F.coalesce(F.get("_sorted", other)["h"] == s["h"], F.lit(False))
        return same(k - 1) | same(k + 1)

    df = df.withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", shared), lambda s: s["i"])))
    covered = F.transform("_at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - p, F.lit(WINDOW))))
    return (df.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long"))
            .drop("_hashes", "_sorted", "_at"))


def judged(docs: DataFrame, min_words: int = 20, repeat_percent: int = 30, mark_percent: int = 12,
           separators: int = 4, loss_percent: int = 40) -> DataFrame:
    """doc_id, the base figures, n_lines, n_removed_lines, removed_chars, base_failed, kept
    and clean_text (the lines that pass, joined by a line feed) of ``docs`` (doc_id, text)."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    df = df.withColumn("_words", F.array_remove(F.split("_text", BLANK), ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)))
    df = df.withColumn("_bad", F.filter("_lines", lambda line: line_fails(line, mark_percent, separators)))
    df = repeated_words(df)
    df = df.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        chars(F.col("_text"), NOT_SYMBOL).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_bad").cast("long").alias("n_removed_lines"),
        chars(F.array_join("_bad", "\n"), BLANK).cast("long").alias("removed_chars"),
        F.array_join(F.filter("_lines", lambda line: ~line_fails(line, mark_percent, separators)), "\n").alias("clean_text"))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent)
    lost = F.col("removed_chars") * 100 > F.col("word_chars") * loss_percent
    return df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~lost)


def op1_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).drop("clean_text")


#: The same in DuckDB's SQL.
OP1_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM t),
b AS (SELECT *, list_filter(lines, lambda x:
        length(regexp_replace(x, '[^#*$%&|<>!?=+~^{}\[\]\\/_@`•·»«]+', '', 'g')) * 100
          > length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) * 12
        OR length(regexp_replace(x, '[^|•·»«>]+', '', 'g')) >= 4
        OR regexp_matches(x, '(?i)(cookie|privacy policy|terms of (use|service)|all rights reserved|subscribe|sign up|sign in|log in|click here|read more|lorem ipsum|enable javascript|licensed under|released under the|powered by|follow us|share this|skip to content|back to top)')) AS bad
      FROM w),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 8),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i + 7]) AS n FROM p),
c AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS cover FROM g WHERE n > 1),
r AS (SELECT doc_id, sum(cover) AS n_repeat_words FROM c GROUP BY doc_id),
f AS (SELECT b.doc_id, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(lines)::BIGINT AS n_lines, len(bad)::BIGINT AS n_removed_lines,
        length(regexp_replace(array_to_string(bad, chr(10)), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS removed_chars
      FROM b LEFT JOIN r ON b.doc_id = r.doc_id)
SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed,
  NOT (n_words < 20 OR n_repeat_words * 100 > n_words * 30) AND NOT removed_chars * 100 > word_chars * 40 AS kept
FROM f
"""
