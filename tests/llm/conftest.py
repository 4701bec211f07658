from __future__ import annotations

import pytest
from pyspark.sql import types as T

LONG = "alpha beta gamma delta " * 9000
CLASHING = (
    "size", "kept", "fp", "shard", "slot", "taken", "node", "spans", "_row", "n_words", "score",
)

EDGE_TEXTS = [
    None,
    "",
    " \n\t ",
    "x",
    "The cat and the dog are of the house.\nIt is here.\n\nIt is here.",
    LONG,
    "y" * 30_000,
    "  two  spaces\n \n and\x1cseparators   é ß 漢字 🙂 <|endoftext|> it's  ",
    "same text for two rows",
    "same text for two rows",
    "mail me@example.com or +1 (555) 010-2030, 10.0.0.1, 4111 1111 1111 1111",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, repeated rows and columns whose names clash."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i else None) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[4], (None, "no id here", None, None), (None, None, None, None)]
    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
    filled = [(*r, len(r[1] or ""), *["other"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(filled, T.StructType(fields))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("false")
