"""Tables with everything that operators must take: nulls, empty and long texts, repeats, clashing column names."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
TEXT = "one two three four five six seven eight nine ten eleven twelve"
CLASHES = ["n", "h", "g", "l", "z", "row", "size", "digest", "span", "start", "end", "token", "tokens", "component", "component_id", "rep",
           "score", "lang_pred", "bucket", "target", "taken", "base", "key", "host", "rule", "slice", "counts", "part", "word", "item_id",
           "_text", "_cuts", "_cut_id", "_bin", "_lang_pred", "_lang_score", "_TEXT_", "content", "queries", "first", "lot", "doc", "chunk", "pair", "term", "df"]


def clashing(df):
    """`df` with columns named like those that operators make."""
    return df.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHES if c not in df.columns])


def odd_documents(spark):
    """Rows 1 to 9 and one without an id; 3 and 4 are empty, 5 blank, 6 equals 1, 7 stands twice, 8 is very long."""
    rows = [(1, TEXT, "en", "a"), (2, TEXT + " and something else altogether", None, "b"), (3, None, "en", None), (4, "", None, "a"),
            (5, " \t\n\x0b\f\r ", "fr", "a"), (6, TEXT, "en", "b"), (7, "zwei drei vier", "de", "c"), (7, "zwei drei vier", "de", "c"),
            (8, LONG, "en", "a"), (9, "\0 ퟿ é 漢字 😀 ... !!", "xx", "c"), (None, TEXT, "en", "a")]
    return clashing(spark.createDataFrame([(i, t, g, s, len(t) if t is not None else None) for i, t, g, s in rows],
                                          "doc_id long, text string, lang string, source string, n_chars long"))


def no_documents(spark):
    return odd_documents(spark).limit(0)
