"""Small documents with the cases that every operator has to stand."""

import random

import pyspark.sql.types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # columns whose names an operator uses for its own results
        T.StructField("n_words", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)


def prose(seed: int, n: int, types: int = 300) -> str:
    rng = random.Random(seed)
    syllables = ["th", "on", "er", "ti", "ha", "ou", "é", "ß", "re", "nd", "la"]
    known = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(types)]
    out = []
    for _ in range(n):
        word = rng.choice(known)
        out.append(word.capitalize() + "." if rng.random() < 0.1 else word)
    return "".join(w + ("\n" if rng.random() < 0.05 else " ") for w in out)


def texts() -> list:
    a, b = prose(1, 400), prose(2, 300)
    edited = a.split(" ")
    edited[100:110] = ["other"] * 10
    return [
        a,
        b,
        a,
        " ".join(edited),
        a[:900] + "\n" + prose(3, 200),
        None,
        "",
        " \n\t ",
        "one",
        "four words in all",
        "same line\n" * 40 + prose(4, 60),
        "ab " * 300,
        "x" * 5000,
        prose(5, 20_000),
        "<|endoftext|> a <|startoftext|>b\xa0c  \u2003d\x1ce 😀 日本語 \x85 it's  we'll\r\n\r\nend  ",
        b.upper(),
        prose(6, 120) + a[300:800] + prose(7, 120),
        a[200:700] + "###$$$ ",
    ]


def documents(spark, values=None):
    values = texts() if values is None else values
    rows = [
        (i, t, "en", "src0", len(t or ""), "clash", "clash", "clash") for i, t in enumerate(values)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def hard_documents(spark):
    """All samples, a row without id, and a row that is there twice."""
    df = documents(spark)
    extra = [
        (None, prose(8, 80), None, None, None, None, None, None),
        (1, texts()[1], "en", "src0", 5, "clash", "clash", "clash"),
    ]
    return df.unionAll(spark.createDataFrame(extra, DOCUMENTS)).repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
