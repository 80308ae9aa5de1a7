"""One registered query for each operator, over the whole of its table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import chat, decontaminate, html_text, language, neardup, neighbours, packing, pii, quality, toxicity, urls, whitening, zone_clusters
from tidewater.llm.tables import read


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op3_superminhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(read(spark, sf_dir, "documents"), width=3, percent=85)


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts look like markers themselves.
    marked = spark.range(2).select(
        F.lit(-1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.unionByName(marked)))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


# Rules of the query: verdict, host and path.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op12_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(read(spark, sf_dir, "documents")))


def op13_zone_map_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_clusters.cluster(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_importance_resampling,
            op2_best_fit_packing,
            op3_superminhash_groups,
            op4_nn_descent,
            op5_chat_format,
            op6_decontamination,
            op7_tag_path_text,
            op8_url_filter,
            op9_language,
            op10_toxicity,
            op11_whitening,
            op12_pii_spans,
            op13_zone_map_clusters,
        )
    }


def _clusters_sql(clusters: int = 8, rounds: int = 10) -> str:
    """Plain comparison of every vector with every centroid, round by round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        d{i} AS MATERIALIZED (
            SELECT r, k, sum((e.x - c.x) * (e.x - c.x)) AS distance FROM entries e JOIN c{i} c USING (d) GROUP BY r, k),
        a{i} AS MATERIALIZED (
            SELECT r, k, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, k) = 1)""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (SELECT k, d, sum(x) AS s, count(*)::HUGEINT AS n FROM a{i} JOIN entries USING (r) GROUP BY k, d),
        c{i + 1} AS MATERIALIZED (
            SELECT c.k, c.d, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c.x) AS x FROM c{i} c LEFT JOIN m{i} USING (k, d))""")
    return f"""
    WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, [floor(1024 * c::DOUBLE)::BIGINT FOR c IN embedding] AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = 64),
        entries AS MATERIALIZED (SELECT r, unnest(range(64)) AS d, unnest(x) AS x FROM kept),
        start AS (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS k, x FROM kept
            WHERE vec_id IS NOT NULL QUALIFY k < {clusters}),
        c0 AS MATERIALIZED (SELECT k, unnest(range(64)) AS d, unnest(x) AS x FROM start),
        {",".join(steps)},
        hashes AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
    SELECT vec_id, k::INTEGER AS cluster, distance::BIGINT AS distance,
        (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
        (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
    FROM a{rounds} JOIN kept USING (r) JOIN hashes USING (k)"""


def oracle_sql() -> dict[str, str]:
    return {"op13_zone_map_clusters": _clusters_sql()}
