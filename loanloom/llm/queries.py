"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from loanloom.llm import alignment, bit_planes, context_tree, decontaminate, hilbert, keyed_ids, minhash, packing, quality, suffix_dedup, token_counts, toxicity, url_filter
from loanloom.llm.scratch import Scratch
from loanloom.llm.ship import prepare

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(prepare(spark), sf_dir)

    QUERIES[run.__name__] = prepared
    return prepared


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=1)


@query
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judge(documents, labels)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_test_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op7_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("restored")


URL_RULES = (
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


SQL["op9_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
         ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), judged AS (
  SELECT page_id, host, path,
         (SELECT max_by(struct_pack(rule := h || p, verdict := v), length(h || p)) FROM rules
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
  FROM parts
)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict,
                CASE WHEN host = '' OR host LIKE '%adult%' OR host LIKE '%bets%'
                       OR host LIKE '%casino%' OR host LIKE '%porn%'
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""


@query
def op10_keyed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Scratch(spark, "op10").path("store")
    keyed_ids.write_ids(table(spark, sf_dir, "documents"), store, WORD_BPE, end_id=2)
    return keyed_ids.read_ids(spark, store)


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_statistics(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


@query
def op12_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op13_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def _cluster_sql(k: int = 16, rounds: int = 3) -> str:
    """One pair of common table expressions a round."""
    nearest = """
assigned{n} AS (
  SELECT row_no, vec_id, c AS cluster, d AS distance
  FROM (SELECT row_no, vec_id, c, d,
               row_number() OVER (PARTITION BY row_no ORDER BY d, c) AS nth
        FROM (SELECT k.row_no, any_value(k.vec_id) AS vec_id, m.c,
                     CAST(sum((k.x - m.x) * (k.x - m.x)) AS BIGINT) AS d
              FROM parts k JOIN centroids{n} m USING (i) GROUP BY k.row_no, m.c))
  WHERE nth = 1
)"""
    moved = """
means{n} AS (
  SELECT a.cluster AS c, p.i, sum(p.x) AS s, count(*) AS n
  FROM assigned{n} a JOIN parts p USING (row_no) GROUP BY a.cluster, p.i
),
centroids{next} AS (
  SELECT o.c, o.i,
         CASE WHEN m.n IS NULL THEN o.x
              ELSE CAST((m.s - (((m.s % m.n) + m.n) % m.n)) // m.n AS BIGINT) END AS x
  FROM centroids{n} o LEFT JOIN means{n} m ON o.c = m.c AND o.i = m.i
)"""
    steps = [
        """kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_no, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64
)""",
        """parts AS (
  SELECT row_no, vec_id, unnest(range(64)) AS i,
         unnest(list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT))) AS x
  FROM kept
)""",
        f"""firsts AS (
  SELECT row_no, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM kept
  QUALIFY c < {k}
)""",
        "centroids0 AS (SELECT f.c, p.i, p.x FROM firsts f JOIN parts p USING (row_no))",
    ]
    for n in range(rounds):
        steps += [nearest.format(n=n).strip(), moved.format(n=n, next=n + 1).strip()]
    steps += [
        nearest.format(n=rounds).strip(),
        f"""described AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM centroids{rounds} GROUP BY c
)""",
    ]
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, d.centroid_sha256
FROM assigned{rounds} a JOIN described d ON a.cluster = d.c"""
    )


SQL["op13_bit_planes"] = _cluster_sql()
