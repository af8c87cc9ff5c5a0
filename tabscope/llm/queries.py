"""The operators of this package bound to the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm import (
    bpe, bwtdedup, crosspolytope, exactdedup, fillmiddle, htmltext, langid, linecrf, mixing, secrets, simhash, toxicity,
    walshclusters,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.extract(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


@query(
    "op5_exact_dedup",
    """WITH rows AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM rows JOIN groups USING (text_sha256)""",
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exactdedup.deduplicate(table(spark, sf_dir, "documents"), exactdedup.new_index(spark))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query(
    "op6_mixing",
    r"""WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS place FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(2 * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sizes WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN 2 * source_size <= level * weight THEN (2 * source_size)::DOUBLE
              ELSE max(CASE WHEN 2 * source_size > level * weight THEN level END) OVER () * weight END AS target
  FROM levels),
served AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY place, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       CAST(least(size, greatest(0, floor(target) - before))
            + least(size, greatest(0, floor(target) - source_size - before)) AS BIGINT) AS taken
FROM served""",
)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies, order = mixing.mix(table(spark, sf_dir, "documents"))
    # documents that the mix leaves out have no copy in its order
    none = copies.where("epoch = 0").withColumn("taken", F.lit(0).cast("long"))
    keys = ["row", "id", "size", "source_size", "target"]  # a row of its own, not only its figures
    both = order.select(*keys, "taken").unionByName(none.select(*keys, "taken"))
    taken = both.groupBy(*keys).agg(F.sum("taken").alias("taken"))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def remainder(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def language_model(docs: DataFrame) -> langid.Model:
    """Learns from the documents with a language whose remainder modulo 4 is not 2."""
    rows = docs.where("lang IS NOT NULL").where(remainder("doc_id", 4) != 2)
    return langid.fit(rows.selectExpr("doc_id AS id", "text", "lang"))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, language_model(docs))
    return found.select(
        F.col("id").alias("doc_id"), (remainder("id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def number(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        F.col("id").alias("doc_id"),
        number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = crosspolytope.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(remainder("doc_id", 5) != 0).selectExpr("doc_id AS id", "toxic AS label")
    model = toxicity.fit(docs.selectExpr("doc_id AS id", "text"), known)
    scored = toxicity.score(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"), (remainder("id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op9_repeated_bytes")
def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwtdedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op11_quality")
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(remainder("doc_id", 4) != 2).selectExpr("doc_id AS id", "quality AS label")
    scored = linecrf.score(docs, linecrf.fit(docs.selectExpr("doc_id AS id", "text"), known))
    return scored.select(
        F.col("id").alias("doc_id"), (remainder("id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def cluster_sql(clusters: int = 16, rounds: int = 3) -> str:
    """The rounds written out one after the other, every distance from all components."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS (
  SELECT vec_id, best.k AS k, best.d AS d FROM (
    SELECT vec_id, min({{'d': d, 'k': k}}) AS best FROM (
      SELECT vec_id, k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c USING (pos) GROUP BY vec_id, k)
    GROUP BY vec_id))""")
        steps.append(f"""c{r + 1} AS (
  SELECT k, pos, CASE WHEN n IS NULL THEN old.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{r} old LEFT JOIN (SELECT k, pos, sum(x) AS s, count(*) AS n FROM near{r} JOIN v USING (vec_id)
                           GROUP BY k, pos) USING (k, pos))""")
    return f"""WITH v AS (
  SELECT vec_id, unnest(range(64)) AS pos,
         CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS HUGEINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
c0 AS (
  SELECT k, pos, x FROM (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k FROM (SELECT DISTINCT vec_id FROM v)
  ) JOIN v USING (vec_id) WHERE k < {clusters}),
{",".join(steps[:-1])},
digests AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS digest FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       digest AS centroid_sha256
FROM near{rounds} JOIN digests USING (k)"""


@query("op12_walsh_clusters", cluster_sql())
def op12_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, about = walshclusters.cluster(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    about = about.select("cluster", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))
    joined = found.join(F.broadcast(about), "cluster")  # one row per cluster
    return joined.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


@query(
    "op13_fill_middle",
    r"""WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT *, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS one,
         CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS two,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM docs),
parts AS (
  SELECT *, array_to_string(lines[1:least(one, two)], '') AS prefix,
         array_to_string(lines[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(lines[greatest(one, two) + 1:], '') AS suffix FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts""",
)
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fillmiddle.transform(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fillmiddle.restore("output", "form"), 256).alias("restored_sha256"),
    )


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it builds on this module

    return corpus_pipeline.run(spark, sf_dir)
