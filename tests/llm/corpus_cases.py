"""Small invented inputs with everything that an operator must survive."""

from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(n, salt=0):
    return " ".join(f"w{(i * 7919 + salt * 104729) % 9973}x" for i in range(n))


def texts():
    long = words(30000)
    near = words(200, 5)
    return [
        (1, "plain words here", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "  \n\t ", "en", None), (5, long, "en", "a"), (6, long + " end", "en", "b"),
        (7, near, "de", "b"), (8, near.replace("w", "W", 3), "de", "b"), (9, near + " tail", "fr", "c"), (9, near + " tail", "fr", "c"), (None, near, "fr", "c"), (None, None, None, None),
        (12, "one", "en", "a"), (13, "One", "en", "a"), (14, "Émile écrit à zoë@exämple.com ou me@site.example.org, +49 (30) 1234567.", "fr", "c"),
        (15, "x" * 20000, "en", "a"), (16, "1 " * 5000, "en", "a"), (17, "same line here\n" * 40, "en", "a"),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(*r[:4], None if r[1] is None else len(r[1])) for r in rows], SCHEMA)


def crowded(docs):
    """With columns named like those the operators make for themselves."""
    names = "_text _base _row _id _raw _k _new token rep row_key n_words kept score hash block words prefix band root u v row spans items".split()
    return docs.select("*", *[F.lit("other").alias(c) for c in names])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
