"""From raw documents to packed sequences: the stages of the corpus, each over all that the one before kept.

The scorer drops junk, one document of each group of near copies stays, passages that
stand in the corpus before are cut out, personal data gives way to its kind, and what
is left is packed into sequences of 2048 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import copies, packing, paragraphs, pii, quality
from skyfold.llm.common import stored

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text now is, where there is such a column."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The fingerprints and links of op9; five words and 0.8 besides, for which three bits are far too tight.
    return copies.first_of_alike(docs, words=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(paragraphs.cleaned(docs))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.redacted(docs, chains=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.place(packing.pieces(docs, WORD_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_first_copies),
    ("substring dedup", cut_repeats),
    ("PII", redact),
    ("best-fit packing", pack),
]

#: Stages that learn or number as they go have no SQL; their results are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each result stored before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


REGISTRY = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
