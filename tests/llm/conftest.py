import random

import pytest
from pyspark.sql import functions as F

SF0001 = "/root/testdata/sf0.001"

# names that the operators use inside
CLASHING = [
    "id", "fp", "root", "node", "src", "dst", "leaf", "cell", "first", "digest", "tokenizer", "n_tokens", "place", "extra",
    "payload", "stats", "_stats", "kept", "base_failed", "group", "class", "features", "score", "predicted", "label", "_key",
    "_text", "_group", "_class", "k", "g", "h", "p", "n", "taught", "size", "sig", "line", "lines", "_lines", "k1", "k2", "owner",
    "near", "drops", "_drops", "_order", "_fp", "_digest", "matches", "_matches", "_more", "host", "path", "rule", "verdict",
    "bad", "segs", "template", "purity", "token", "block", "window", "turns", "system", "room", "starts", "behind", "frames",
    "component_id", "n_words", "lang_pred", "cost", "rejected",
]


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "he", "in"]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null id, null, empty and blank texts, a very long text, repeated rows, and every clashing column."""
    rows = [
        (1, ""), (2, None), (3, " \n\t "), (4, words(60_000, 1)), (5, words(40, 2)), (5, words(40, 2)), (None, words(40, 2)),
        (None, None), (6, words(40, 3) + "\n" + words(12, 4)), (7, words(40, 5) + "\n" + words(12, 4)), (8, "a\u0000b 😀 </s>"),
        (9, "été à l'île\n\nété"), (10, "12 345 ###"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text"))
    return df.withColumns({c: F.lit(-1) for c in CLASHING})


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


@pytest.fixture(scope="session")
def model():
    from basketry.llm.queries import tokenizer_path

    return tokenizer_path()
