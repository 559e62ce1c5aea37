"""Documents with nulls, empty and long texts, ties, repeated rows and columns whose names the operators use themselves."""

import random

import public_tokenizers
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("source", "n", "class", "digest", "key", "token", "row", "ids", "key_text")]
)
WORDS = "the and of thing over river stone light Água große naïve état 42 x-ray".split()
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".", str(rng.randrange(50))]) for _ in range(n))


def texts() -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(5)
    base = sentence(rng, 120)
    near = base.replace("river", "lake", 1)
    rows = [(i, sentence(rng, rng.randrange(1, 80)), rng.choice(["en", "de", "fr", "es"])) for i in range(30)]
    rows += [(100, base, "en"), (101, base.upper(), None), (102, base, "en"), (103, near, "en"), (104, near + " end", "de")]
    rows += [(200, None, None), (201, "", "en"), (202, " \n\t ", None), (203, None, "fr"), (None, base, None), (None, None, None)]
    rows += [(300, "A", "en"), (301, "a", "en"), (302, "a b c", "en"), (303, "A B C", None), (304, "!!! ???", "en")]
    rows += [(400, sentence(rng, 30_000), "en"), (401, "x" * 50_000, "de"), (402, "日本語のテキスト 🎉 ﬁ ① ▁ İ", "xx"), (403, "\x00 <|endoftext|> don't we'll 's", "en")]
    rows += [(500, "twice", "en"), (500, "twice", "en"), (501, "one id", "en"), (501, "two texts", "en")]
    return rows


def docs(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, lang, *["clash"] * 9) for i, t, lang in rows], SCHEMA).repartition(3)


def path(name: str) -> str:
    return public_tokenizers.path(name)


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
