"""One query per operator over its whole table, and its SQL where SQL can tell it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statewatt.llm import decontaminate, exact, extract, line_dedup, mining, mixing, packing, simhash, substring, topk, toxicity, warc, zones
from statewatt.llm.common import integer_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_line_dedup",
    f"""
    WITH d AS (
      SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
    ), u AS (
      SELECT doc_id, source, unnest(parts) AS line, unnest(range(len(parts))) AS nr FROM d WHERE text IS NOT NULL
    ), l AS (
      SELECT doc_id, source, nr, line, trim(regexp_replace({LOWER.format('line')}, '[\\x09-\\x0D\\x20]+', ' ', 'g')) AS norm FROM u
    ), b AS (
      SELECT norm FROM l WHERE norm <> '' GROUP BY norm HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}
    ), m AS (
      SELECT l.doc_id, l.nr, l.line, b.norm IS NOT NULL AS gone FROM l LEFT JOIN b ON l.norm = b.norm
    ), r AS (
      SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS n_removed,
             coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY nr), '') AS kept
      FROM m GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(coalesce(r.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n_removed, 0) AS BIGINT) AS n_removed,
           CASE WHEN d.text IS NULL THEN NULL ELSE r.kept END AS text
    FROM d LEFT JOIN r ON d.doc_id = r.doc_id
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op3_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    ), r AS (
      SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
    )
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.whole_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


@query(
    "op5_source_mixing",
    """
    WITH d AS (
      SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size FROM documents
    ), s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
    ), p AS (
      SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s
    ), w AS (
      SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, CAST(3 * source_size AS DOUBLE) AS cap FROM p
    ), l AS (
      SELECT max((total - capped) / weights) AS level FROM (
        SELECT CAST(sum(source_size) OVER () AS DOUBLE) AS total,
               coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS capped,
               sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
        FROM w) AS x
    ), t AS (
      SELECT w.*, least(cap, level * weight) AS target, CAST(floor(least(cap, level * weight)) AS BIGINT) AS words FROM w CROSS JOIN l
    ), o AS (
      SELECT doc_id, source, CAST(size AS BIGINT) AS size,
             CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM d
    )
    SELECT o.doc_id, o.size, t.source_size, t.target,
           CASE WHEN t.source_size = 0 THEN 0 ELSE (t.words // t.source_size) * o.size
             + greatest(0, least(o.size, t.words % t.source_size - o.before)) END AS taken
    FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    mixed = mixed.withColumn("at", F.when(F.col("taken") > 0, mixing.position(mixed, F.lit(0).cast("long"))))
    mixed = mixed.repartitionByRange("at", "doc_id").sortWithinPartitions("at", "doc_id")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query(
    "op8_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
    ), g AS (
      SELECT page_id, octet_length(encode(html)) AS bytes, hex, max(page_id) OVER (PARTITION BY html) AS best FROM p
    )
    SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    CAST((CAST('0x' || substr(hex, CAST(i // 4 AS INTEGER) * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
           CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
    FROM g
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op10_exact_dedup",
    f"""
    WITH d AS (
      SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS norm FROM documents
    ), g AS (
      SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d
    )
    SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.membership(table(spark, sf_dir, "documents"))


_WHOLE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"


@query(
    "op11_hard_negatives",
    f"""
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_WHOLE}
    ), s AS MATERIALIZED (
      SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
      FROM v AS a JOIN v AS c ON a.vec_id % 100 = 0 AND a.rid <> c.rid AND len(a.v) = len(c.v)
    ), p AS (
      SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place
      FROM s WHERE alike
    ), n AS (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.rid = s.rid AND NOT s.alike AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
      WHERE p.place <= 5
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), 256.0, "label").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


_TERMS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_NEXT = ", ".join(f"lead(w, {k}) OVER (PARTITION BY rid ORDER BY pos) AS w{k}" for k in range(1, 10))


@query(
    "op12_decontamination",
    f"""
    WITH d AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS words FROM documents
    ), b AS (
      SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_TERMS} AS words FROM benchmark
    ), i AS (
      SELECT item, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS s FROM b WHERE len(words) > 0
    ), g AS MATERIALIZED (
      SELECT DISTINCT item, n, array_to_string(words[s : s + n - 1], ' ') AS gram FROM i
    ), t AS (
      SELECT rid, unnest(words) AS w, unnest(range(len(words))) AS pos FROM d
    ), r AS (
      SELECT rid, pos, w, {_NEXT} FROM t
    ), m AS MATERIALIZED (
      SELECT DISTINCT r.rid, r.pos, g.n, g.item
      FROM r JOIN (SELECT DISTINCT n FROM g) AS l ON true JOIN d ON d.rid = r.rid AND r.pos + l.n <= len(d.words)
      JOIN g ON g.n = l.n AND g.gram = array_to_string([w, w1, w2, w3, w4, w5, w6, w7, w8, w9][1 : l.n], ' ')
    ), h AS (
      SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + n)) AS p FROM m) AS x GROUP BY rid
    ), k AS (
      SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m) AS x GROUP BY rid
    )
    SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(k.n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(k.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN k ON d.rid = k.rid
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), named.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _rounds_sql(k: int, rounds: int, dims: int) -> str:
    """Rounds of exact k-means as one statement: c0 are the first centroids, a
    round assigns (a) and averages (c); the last a is the result."""

    def assigned(r: int) -> str:
        near = "list_sum(list_transform(range(1, {0}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))".format(dims + 1)
        return f"a{r} AS MATERIALIZED (SELECT rid, vec_id, v, arg_min(cluster, [CAST(d AS DOUBLE), CAST(cluster AS DOUBLE)]) AS cluster, min(d) AS distance FROM (SELECT e.*, cluster, {near} AS d FROM e, c{r}) AS x GROUP BY rid, vec_id, v)"

    def averaged(r: int) -> str:
        mean = "list(m ORDER BY i)"
        means = f"SELECT cluster, {mean} AS c FROM (SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) / count(*) AS BIGINT) AS m FROM (SELECT cluster, unnest(v) AS x, unnest(range({dims})) AS i FROM a{r}) AS y GROUP BY cluster, i) AS z GROUP BY cluster"
        return f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(n.c, c{r}.c) AS c FROM c{r} LEFT JOIN ({means}) AS n ON c{r}.cluster = n.cluster)"

    first = f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS cluster, v AS c FROM e ORDER BY sha256('3:' || vec_id) NULLS LAST, v LIMIT {k})"
    return ",\n".join([first] + [f"{assigned(r)},\n{averaged(r)}" for r in range(rounds)] + [assigned(rounds)])


@query(
    "op13_centroid_clusters",
    f"""
    WITH e AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE {_WHOLE} AND len(embedding) = 64
    ), {_rounds_sql(zones.K, zones.ROUNDS, 64)}
    SELECT vec_id, CAST(a{zones.ROUNDS}.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
           CAST(sum(distance) OVER (PARTITION BY a{zones.ROUNDS}.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{zones.ROUNDS} JOIN c{zones.ROUNDS} ON a{zones.ROUNDS}.cluster = c{zones.ROUNDS}.cluster
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), 1024.0)
    return zones.clusters(vectors.where(F.size("v") == 64))
