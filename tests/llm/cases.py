"""Small tables with every kind of awkward row, for all operators."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, n int, digest string, scores string, copies int"


def ugly_rows():
    random.seed(3)
    words = ["alpha", "beta", "gamma", "delta", "Été", "naïve", "zug", "don't", "x1"]
    long = " ".join(random.choices(words, k=9000))
    base = " ".join(random.choices(words, k=120)) + "\n" + " ".join(f"w{i}" for i in range(80))
    near = base.replace("w40", "w40x")
    texts = [
        (0, base), (1, base), (2, near), (3, None), (4, ""), (5, "   \n\t "), (6, "one"), (7, "one two three"),
        (8, "ONE two three"), (9, long), (None, base), (None, None), (None, "lonely text with null id here"),
        (10, near.upper()), (11, "a" * 3000), (12, "line one here\nline two here\nline three here\n" * 5), (12, "line one here\nline two here\nline three here\n" * 5),
        (13, "中文 字   é x <|endoftext|>"), (14, long + " tail"), (15, "same id"), (15, "other text"),
    ]
    langs, sources = ["en", None, "fr"], ["src0", "src0", None, "src3"]
    return [(i, t, langs[k % 3], sources[k % 4], len(t or ""), k, "r", 1, "d", "s", 9) for k, (i, t) in enumerate(texts)]


def ugly(spark):
    return spark.createDataFrame(ugly_rows(), COLUMNS).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
