"""Small tables for the tests."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, lang="en", source="s"):
    """Rows of ``documents``; a text may be null, or a pair of identifier and text."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in rows], DOCS)


def clashing(df):
    """The table with columns named like those the operators use."""
    from pyspark.sql import functions as F

    names = ["bucket", "part", "words", "n_words", "key", "spans", "score", "h", "tokens", "fingerprint", "id", "n"]
    return df.select("*", *[F.lit(n).alias(n) for n in names if n not in df.columns])


def alike_words(n):
    """Two words of ``n`` letters (a power of two) that follow the Thue-Morse pattern and its complement.

    From 1024 letters on they have equal polynomial hashes modulo 2**64 for every odd base.
    """
    bits = [i.bit_count() % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
