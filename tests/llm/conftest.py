import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, lang, source), with columns that clash with names used inside."""
    def make(rows, extra=True, parts=3):
        full = [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows]
        df = spark.createDataFrame(full, DOCUMENTS).repartition(parts)
        if extra:
            for name in ("n", "name", "size", "key", "ids", "spans", "n_lines", "sid", "token", "__x", "target", "kept"):
                df = df.selectExpr("*", f"'clash' AS `{name}`")
        return df
    return make


WORDS = [f"w{i:03d}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    import random
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and blank texts, ties, repeated rows, one long text, near copies."""
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join(words[:60] + ["changed"] + words[61:])
    passage = prose(2, 70)
    long = prose(3, 20_000)
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, None, "en", "a"), (5, "", None, None), (6, " \n\t ", "en", "a"),
        (7, "one two", "en", None), (7, "one two", "en", None), (8, "ONE two", "de", "a"), (None, prose(4, 30), None, "b"), (None, None, None, None),
        (9, passage + "\n" + prose(5, 50), "en", "a"), (10, prose(6, 40) + "\n" + passage, "en", "b"), (11, long, "en", "a"), (12, long[:50_000] + " tail", "fr", "a"),
        (13, "same line\nsame line\nsame line\n" + prose(7, 20), "en", "a"), (14, "é ü ﬁ 😀 ▁ 　 " * 30, "en", "a"), (15, "x" * 5000, "en", "a"), (16, "ab " * 700, "en", "a"),
        (2**40, prose(8, 9), "en", "b"), (-3, prose(9, 200), "en", "b"),
    ]
