"""Registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import (chat_format, context_mixing, exact_dedup, license_scan, line_dedup, periodic_runs, pu_quality,
                            quality_rules, sentencepiece_codec, simhash_dedup, source_mixing, subvector_kmeans, toxicity)
from ledgerline.llm.common import WORD_CLASS, text_of


def _documents(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def _labels(spark, d):
    return spark.read.parquet(f"{d}/labels.parquet")


def op1_exact_dedup(spark, d):
    return exact_dedup.exact_dedup(_documents(spark, d)).withColumnRenamed("id", "doc_id")


def op2_chat_format(spark, d):
    turns = spark.read.parquet(f"{d}/conversations.parquet")
    return chat_format.repair_conversations(turns).withColumnRenamed("id", "conv_id")


def op3_sentencepiece(spark, d):
    return sentencepiece_codec.encode(_documents(spark, d)).withColumnRenamed("id", "doc_id")


def op4_lm_scoring(spark, d):
    return context_mixing.score(_documents(spark, d)).withColumnRenamed("id", "doc_id")


def op5_source_mixing(spark, d):
    return source_mixing.mix_sources(_documents(spark, d)).withColumnRenamed("id", "doc_id")


def op6_pu_quality(spark, d):
    docs = _documents(spark, d)
    model = pu_quality.train(docs, _labels(spark, d))
    return pu_quality.score(docs, model).withColumnRenamed("id", "doc_id")


def op7_line_dedup(spark, d):
    return line_dedup.dedup_lines(_documents(spark, d)).withColumnRenamed("id", "doc_id")


def op8_toxicity(spark, d):
    docs = _documents(spark, d)
    return toxicity.score(docs, toxicity.train(docs, _labels(spark, d))).withColumnRenamed("id", "doc_id")


def op9_quality_rules(spark, d):
    docs = _documents(spark, d)
    model = quality_rules.train(docs, _labels(spark, d))
    return quality_rules.apply_rules(docs, model).withColumnRenamed("id", "doc_id")


def op10_simhash_dedup(spark, d):
    out = simhash_dedup.near_duplicates(_documents(spark, d))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def with_planted_runs(docs):
    """The contract's input: with h = crc32 of the id as text and g = h // 10,
    every text of h % 10 = 0 is periodic from its word g % n on."""
    h = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    g, words = F.floor(h / 10), F.regexp_extract_all("text", F.lit(f"({WORD_CLASS})"), F.lit(1))
    n = F.size("_words").cast("long")
    a = F.col("_g") % n
    p = F.floor((n - a) / (F.col("_g") % 8 + 3)) + 1
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
        "_words", place(i).cast("int"))), " ")
    return (docs.select("doc_id", text_of("text").alias("text"), h.alias("_h"), g.alias("_g"))
            .withColumn("_words", F.when(F.col("_h") % 10 == 0, words).otherwise(F.array().cast("array<string>")))
            .withColumns({"_a": F.when(n > 0, a), "_p": F.when(n > 0, p)})
            .select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text")))


def op11_periodic_runs(spark, d):
    out = periodic_runs.periodic_runs(with_planted_runs(_documents(spark, d)))
    # exact comparison of length / period: cross products of whole numbers
    higher = lambda a, b: b["length"] * a["period"] - a["length"] * b["period"]
    top = F.get(F.array_sort("runs", lambda a, b: F.when(higher(a, b) != 0, F.signum(higher(a, b)).cast("int"))
                             .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
                             .otherwise(F.signum(a["period"] - b["period"]).cast("int"))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return out.withColumn("_top", top).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_top.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("_top.length") * 1000 / F.col("_top.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_subvector_kmeans(spark, d):
    return subvector_kmeans.cluster(spark.read.parquet(f"{d}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


def op13_license_scan(spark, d):
    """The base columns from the exact places; labels and score with the fuzzy matches."""
    out = license_scan.scan_licenses(_documents(spark, d))
    starts, base = F.transform("places", lambda p: p["word"]), F.transform("places", lambda p: p["label"])
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("matches", lambda m: m["label"]))).alias("labels"), "score")


def _kmeans_sql() -> str:
    """Lloyd's rounds as one list of CTEs: cN centroids, aN assignments."""
    k = subvector_kmeans
    dist = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    ctes = [f"""
v AS (SELECT row_number() OVER () AS row, vec_id,
             list_transform(embedding, lambda x: CAST(floor({k.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings
      WHERE len(embedding) = {k.DIMENSIONS}
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h, e) - 1 AS cluster, e
       FROM (SELECT e, sha256('{k.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, e LIMIT {k.CLUSTERS}))"""]
    for r in range(k.ROUNDS + 1):
        ctes.append(f"""
a{r} AS (SELECT row, vec_id, e, best.cluster AS cluster, best.d AS distance FROM (
           SELECT v.row, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e,
                  min({{'d': CAST({dist} AS BIGINT), 'cluster': c.cluster}}) AS best
           FROM v, c{r} c GROUP BY v.row))""")
        if r < k.ROUNDS:
            ctes.append(f"""
m{r} AS (SELECT cluster, list(floor_mean ORDER BY place) AS e FROM (
           SELECT cluster, place, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS floor_mean FROM (
             SELECT cluster, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
               SELECT cluster, unnest(e) AS x, unnest(range({k.DIMENSIONS})) AS place FROM a{r}) GROUP BY cluster, place))
         GROUP BY cluster),
c{r + 1} AS (SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.cluster)""")
    last = k.ROUNDS
    return f"""
WITH {','.join(ctes)}
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(list_aggregate(c.e, 'string_agg', ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON c.cluster = a.cluster"""


def _sainte_lague_sql(name: str, rows: str) -> str:
    """Quotas of ``rows`` (grp, item, weight, seats, cap), as CTEs ending in ``name``."""
    return f"""
{name}_a AS (
  SELECT *, CAST(least(floor(coalesce(weight * seats / nullif(sum(weight) OVER (PARTITION BY grp), 0), 0.0) + 0.5), cap)
                 AS BIGINT) AS base FROM {rows}),
{name}_b AS (SELECT *, CAST(seats - sum(base) OVER (PARTITION BY grp) AS BIGINT) AS diff FROM {name}_a),
{name}_c AS (
  SELECT grp, item, diff, weight, unnest(CASE
           WHEN diff > 0 THEN range(base, CAST(least(base + diff, cap) AS BIGINT))
           ELSE range(CAST(greatest(base + diff, 0) AS BIGINT), base) END) AS k
  FROM {name}_b WHERE diff <> 0),
{name}_d AS (
  SELECT grp, item, diff, row_number() OVER (PARTITION BY grp ORDER BY
           CASE WHEN diff > 0 THEN -(weight / (2 * k + 1)) ELSE weight / (2 * k + 1) END,
           CASE WHEN diff > 0 THEN item ELSE -item END, CASE WHEN diff > 0 THEN k ELSE -k END) AS place
  FROM {name}_c),
{name}_e AS (SELECT grp, item, sum(sign(diff)) AS change FROM {name}_d WHERE place <= abs(diff) GROUP BY grp, item),
{name} AS (
  SELECT b.*, CAST(base + coalesce(change, 0) AS BIGINT) AS quota
  FROM {name}_b b LEFT JOIN {name}_e e USING (grp, item))"""


def _op5_sql() -> str:
    seed, block, share, repeats = (source_mixing.SEED, source_mixing.BLOCK_WORDS, source_mixing.SHARE,
                                   source_mixing.MAX_REPEATS)
    return rf"""
WITH sizes AS (
  SELECT doc_id AS id, source, md5(coalesce(text, '')) AS text_hash,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS words, count(*) AS n_docs FROM sizes GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s0),
s2 AS (SELECT *, words * {repeats} AS cap, CAST([{', '.join(map(str, source_mixing.WEIGHTS))}][rank % {len(source_mixing.WEIGHTS)} + 1] AS BIGINT) AS weight
       FROM s1),
s3 AS (SELECT *, sum(words) OVER () * CAST({share} AS DOUBLE) AS total, sum(weight) OVER () AS all_weight,
              coalesce(sum(cap) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before
       FROM s2 WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, cap / weight <= (total - cap_before) / (all_weight - weight_before) AS capped FROM s3),
s5 AS (SELECT *, sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS cap_sum,
              sum(CASE WHEN capped THEN weight ELSE 0 END) OVER () AS cap_weight FROM s4),
s6 AS (SELECT source, rank AS item, words, n_docs, 1 AS grp,
              CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE weight * (total - cap_sum) / (all_weight - cap_weight) END AS target
       FROM s5),
s7 AS (SELECT *, target AS weight, floor(sum(target) OVER () / {block} + 0.5) AS seats,
              CAST(ceil(words / {block}) * {repeats} AS BIGINT) AS cap FROM s6),
{_sainte_lague_sql('src', 's7')},
docs AS (
  SELECT d.id, d.size, q.item AS rank, q.words AS source_size, q.target, q.quota AS source_quota,
         CAST(ceil(sqrt(n_docs)) AS BIGINT) AS n_shards,
         md5('{seed}:' || coalesce(CAST(d.id AS VARCHAR), '') || ':' || d.text_hash) AS place
  FROM sizes d JOIN src q ON d.source IS NOT DISTINCT FROM q.source),
dealt AS (SELECT *, CAST('0x' || substr(place, 1, 12) AS BIGINT) % n_shards AS shard FROM docs),
placed AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY rank, shard ORDER BY place, id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop,
         CAST(sum(size) OVER (PARTITION BY rank, shard) AS BIGINT) AS shard_words FROM dealt),
sh AS (SELECT rank AS grp, shard AS item, CAST(sum(size) AS BIGINT) AS weight, any_value(source_quota) AS seats,
              CAST(ceil(sum(size) / {block}) * {repeats} AS BIGINT) AS cap FROM dealt GROUP BY rank, shard),
{_sainte_lague_sql('quotas', 'sh')},
m AS (SELECT p.*, q.quota, stop - size AS start, CAST(greatest(ceil(shard_words / {block}), 1) AS BIGINT) AS m
      FROM placed p JOIN quotas q ON q.grp = p.rank AND q.item = p.shard),
n AS (SELECT *, quota // m AS passes, quota % m AS extra,
             CAST('0x' || substr(md5('{seed}:' || rank || ':' || shard), 1, 12) AS BIGINT) % m AS first FROM m)
SELECT id AS doc_id, size, source_size, target,
       CAST(passes * size
         + greatest(least(stop, least(first + extra, m) * {block}) - greatest(start, first * {block}), 0)
         + greatest(least(stop, greatest(first + extra - m, 0) * {block}) - greatest(start, 0), 0) AS BIGINT) AS taken
FROM n"""


def pipeline(spark, d):
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_chat_format, op3_sentencepiece, op4_lm_scoring, op5_source_mixing, op6_pu_quality, op7_line_dedup, op8_toxicity, op9_quality_rules,
                                   op10_simhash_dedup, op11_periodic_runs, op12_subvector_kmeans, op13_license_scan, pipeline)}


ORACLE_SQL = {
    "op1_exact_dedup": """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm
  FROM documents),
w AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w""",
    "op5_source_mixing": _op5_sql(),
    "op12_subvector_kmeans": _kmeans_sql(),
}
