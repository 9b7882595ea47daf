"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""
import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(2, 9))) for _ in range(n))


def rows():
    base = words(1, 120)
    long = words(2, 9_000)
    return [
        (1, base, "en", "s", 1), (2, base, "en", "s", 1), (3, base + " extra", "en", "s", 1),
        (4, None, None, None, None), (5, "", "en", None, 0), (6, "   \n\t ", "en", "s", 3), (7, "!!! ... ---", None, "s", 1),
        (8, long, "de", "s", 1), (9, words(3, 4), "de", "s", 1), (None, words(4, 60), "en", "s", 1),
        (10, words(5, 80), "en", "s", 1), (10, words(5, 80), "en", "s", 1), (None, None, None, None, None),
        (11, "数据 处理 引擎 测试 文本", "zh", "s", 1), (12, "a\x1cb\xa0c İstanbul é don't <|endoftext|>", "en", "s", 1),
    ]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def clashing(spark):
    """The same rows with columns named like the operators' own."""
    df = documents(spark)
    for c in ("id", "row_key", "node", "label", "score", "n", "units", "first", "component", "removed", "bucket",
              "__matches", "__toxicity", "__cut", "a.b"):
        df = df.withColumn(c, F.lit(7))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
