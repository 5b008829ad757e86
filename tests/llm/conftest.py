import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skyfold.llm import wordpieces as wp

SF_DIR = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{k % 977} and then, {k}." for k in range(12_000))
PROSE = "Some say the river ran dry that year, others that it never had. Nobody kept a record of what the wells gave before the mills came up the valley to stay."
#: Null and empty texts, white space alone, a very long one, repeated rows, ties, other scripts, and an id that is null.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, PROSE), (5, PROSE), (6, PROSE), (7, PROSE.upper() + "!!!"), (8, "x" * 5000),
    (9, "Ünïcode ſtuff İstanbul Σίσυφος ΟΔΟΣ 中文字符 😀👍🏽 it's I'LL"), (10, "a<|endoftext|>b <|startoftext|>"), (11, "one two three"), (None, "nobody's text"), (12, PROSE + "\n" + PROSE),
]
#: Names that operators use for columns of their own.
CLASHES = ["row", "doc", "ids", "fp", "score", "lost", "spans", "base", "unit", "body", "nth", "mix", "rank", "_text", "asked", "key"]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    return odd.select("*", F.length("text").alias("n_chars"), *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def library():
    return wp.load(WORD_BPE)
