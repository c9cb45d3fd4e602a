"""Small awkward tables that all tests of this folder share."""

import random

from pyspark.sql import types as T

#: Names that operators add; here they are columns of the input.
CLASHES = ["ids", "decoded", "N_Words", "n_hit", "items", "spans", "fp", "component_id", "licence", "dice", "score", "predicted"]
CLASHES += ["n_tokens", "part", "start", "size", "shard", "slot", "kept", "base_failed", "n_symbols", "bucket", "row"]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        *(T.StructField(name, T.StringType()) for name in CLASHES),
    ]
)

WORDS = "the of and river stone Morning über naïve 漢字 🙂 can't x1 2024 a.b (end) ¿qué? ... --   é".split(" ")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "\n", "  ", ", ", "\t"]) for _ in range(words))


TEXTS = [
    None,
    "",
    " ",
    "\n\n\t ",
    "word",
    "The end.",
    "<unk> </s> <|endoftext|> [PAD]",
    "a" * 5000,
    "  leading and trailing  ",
    "mixed\r\nline\x0bends\x0c\x00nul",
    "same text twice",
    "same text twice",
    prose(1, 40),
    prose(1, 40),
    prose(2, 300),
    prose(3, 30_000),
    "$$$ ### *** && || <b> " * 20,
    "line one here\nline one here\nline two here\n" * 30,
]


def awkward(spark, texts=TEXTS):
    """Nulls, repeated rows and ids, and columns that clash."""
    rows = [(n, t, ["en", None, "de"][n % 3], None if n % 5 == 0 else "web", *("old",) * len(CLASHES)) for n, t in enumerate(texts)]
    if rows:
        rows += [rows[-1], (None, texts[-1], None, None, *("old",) * len(CLASHES))]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
