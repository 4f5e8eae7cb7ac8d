"""Documents that operators tend to trip over."""

from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PASSAGE = "\n".join(" ".join(f"p{line}x{i}" for i in range(15)) for line in range(4))

ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (2, "", "en", "a", 0),
    (None, "one two three four five six", "en", "a", 3),
    (None, None, None, "b", None),
    (3, "Mail me: joe@example.org or +1 (706) 555-3138 now", "en", None, 5),
    (3, "Mail me: joe@example.org or +1 (706) 555-3138 now", "en", None, 5),
    (3, "another text of the same number", "de", "a", 5),
    (4, LONG, "en", "a", len(LONG)),
    (5, LONG + " end", "en", "b", len(LONG) + 4),
    (6, "  \n\t\n ", "fr", "b", 6),
    (7, PASSAGE, "en", "b", 9),
    (8, "intro line\n" + PASSAGE + "\n\noutro", "en", "b", 9),
    (9, "Ünï çødé 🙂🙃 ـعربي 漢字 \u0000 end", "xx", "c", 9),
]

#: Further columns named like what operators add or use.
EXTRA = {
    "kept": "k", "n_lines": 1, "n_deleted": 2, "text_key": 3, "doc": "d", "accepted": False,
    "ids": "i", "component_id": 4, "TEXT": "t", "_0": 5, "lang_": "x", "digest": "y",
}


def frame(spark, rows=tuple(ROWS), extra=False):
    schema = T.StructType.fromDDL(DOCUMENTS)
    docs = spark.createDataFrame(list(rows), schema)
    if not extra:
        return docs
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(value).alias(name) for name, value in EXTRA.items()])


def labels(spark, rows=((3, 1, 0), (4, 1, 0), (5, 1, None), (7, 0, 0), (None, 1, 0), (9, None, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=((1, "one two three four five six"), (2, None), (None, ""), (3, "tiny"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")
