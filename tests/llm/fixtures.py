"""Small awkward tables for the tests of the training-data operators."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

LONG = "the quick brown fox jumps over the lazy dog near the river bank " * 3000

TEXTS = [
    "The quick brown fox. It jumps over the lazy dog near the old river bank, and then it rests a while.",
    "The quick brown fox. It jumps over the lazy dog near the old river bank, and then it rests a while.",
    None, "", " \t\n\r\x0b\x0c ", "a", "...", "\x1c\x85\xa0 ​", "eins zwei drei vier fünf ß 你好 \U0001f600 café",
    "don't I'S 'tis we'll İstanbul ΣΑΣ", "x" * 30000, LONG, "one two three four five six seven eight " * 4,
    "<|endoftext|> \x00 null", "Line one\nLine one\n\nLine two",
]


def documents(spark, texts=TEXTS, extra=True):
    """Rows with repeated ids and a null id, and columns whose names clash with results."""
    rows = [(i, t, None if i % 5 == 4 else "en", f"s{i % 3}", None) for i, t in enumerate(texts)]
    rows += [(0, texts[0], "en", "s0", 1), (None, "no id here but some words to read", None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        for name in ("score", "kept", "simhash", "a.b", "Ids", "n_tokens", "component_id", "lang_pred"):
            df = df.withColumn(name, F.lit(7))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
