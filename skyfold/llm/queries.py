"""The registered queries of this subpackage: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import histogram_topk, packing, paragraphs, pii, quality, rotated_bits, simhash, suffixes, sum_of_squares, token_files, trie_bpe, va_file, vectors, whitening

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less all strings of 200 bytes that occur more than once."""
    found = suffixes.cleaned(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, by a trie of words."""
    coded = trie_bpe.encode_documents(_table(spark, sf_dir, "documents"), WORD_BPE)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    found = token_files.round_trip(_table(spark, sf_dir, "documents"), WORD_BPE)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less the paragraphs and sentences that stand in the corpus before."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # Taken along, the length of the whole text needs no second join.
    found = paragraphs.cleaned(docs.withColumn("n_before", F.coalesce(F.length("text"), F.lit(0))))
    return found.select("doc_id", F.col("n_before").cast("long").alias("n_before"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_after"), "text")


def op10_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, and whether it is kept."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.scored(docs, quality.fit(docs))
    return found.select("row.doc_id", "score", (F.col("score") >= quality.KEEP).alias("keep"))


def op5_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.spans(_table(spark, sf_dir, "documents"), keep=["doc_id"], chains=True)
    counts = [F.size(F.filter("base", pii.is_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("row.doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


def op6_rotated_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth."""
    found = vectors.single(vectors.usable(_table(spark, sf_dir, "embeddings"), zero=False))
    return rotated_bits.nearest(found, found.where("id % 100 = 0"), 10)


def op8_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty highest integer inner products of every twentieth vector; vectors whose scores need not fit a long take no part."""
    found = vectors.single(vectors.usable(_table(spark, sf_dir, "embeddings")))
    whole = found.withColumn("v", F.transform("v", lambda x: F.floor(x * 64).cast("double")))
    whole = histogram_topk.fitting(whole)
    return histogram_topk.top(whole, whole.where("id % 20 = 0"), 20)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    cut = packing.pieces(_table(spark, sf_dir, "documents"), WORD_BPE)
    return packing.place(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op11_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens or a power of two."""
    found = sum_of_squares.packed(_table(spark, sf_dir, "documents"), BYTE_BPE)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector."""
    return va_file.clustered(_table(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array": op1_suffix_array,
    "op2_trie_bpe": op2_trie_bpe,
    "op3_token_files": op3_token_files,
    "op4_paragraph_minhash": op4_paragraph_minhash,
    "op5_pii_votes": op5_pii_votes,
    "op6_rotated_bits": op6_rotated_bits,
    "op8_histogram_topk": op8_histogram_topk,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op9_simhash": op9_simhash,
    "op10_weak_quality": op10_weak_quality,
    "op11_sum_of_squares": op11_sum_of_squares,
    "op12_whitening": op12_whitening,
    "op13_va_file": op13_va_file,
}

#: Vectors that take part, one for each id.
_VECTORS = """
    SELECT vec_id, min(embedding) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
"""



def _clusters_sql(rounds: int = 10, k: int = 8) -> str:
    """Every round of the clustering as tables of its own; a vector's nearest centroid is the least of distance and number in one figure."""
    steps = ["""
        kept AS MATERIALIZED (SELECT row_number() OVER () AS key, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
          FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", f"""
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x AS v FROM kept QUALIFY c < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (SELECT key, vec_id, any_value(x) AS x,
            min(list_sum(list_transform(list_zip(x, v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT * {k} + c) AS code
          FROM kept CROSS JOIN c{r} GROUP BY key, vec_id)""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} AS MATERIALIZED (SELECT c, list(m ORDER BY j) AS v FROM (SELECT c, j, ((s - ((s % n) + n) % n) // n)::BIGINT AS m
            FROM (SELECT code % {k} AS c, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM a{r} CROSS JOIN range(1, 65) t(j) GROUP BY 1, 2) q) q GROUP BY c
          UNION ALL SELECT c, v FROM c{r} WHERE c NOT IN (SELECT code % {k} FROM a{r}))""")
    return f"""
        WITH {','.join(steps)}
        SELECT vec_id, c::INT AS cluster, code // {k} AS distance, sum(code // {k}) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
          sum(code // {k}) OVER ()::BIGINT AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c = code % {k}
    """


ORACLES: dict[str, str] = {
    "op13_va_file": _clusters_sql(),
    "op6_rotated_bits": f"""
        WITH vectors AS ({_VECTORS}),
        kept AS (SELECT vec_id, v::DOUBLE[] AS v FROM vectors WHERE len(list_filter(v, lambda x: x <> 0)) > 0),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
            FROM kept q JOIN kept c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS nth FROM pairs)
        SELECT query_id, nth::INT AS rank, vec_id, score FROM ranked WHERE nth <= 10
    """,
    "op8_histogram_topk": f"""
        WITH vectors AS ({_VECTORS}),
        whole AS (SELECT vec_id, list_transform(v, lambda x: floor(64 * x::DOUBLE)) AS v FROM vectors),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM pairs)
        SELECT query_id, nth::INT AS rank, vec_id, score FROM ranked WHERE nth <= 20
    """,
}
