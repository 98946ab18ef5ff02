"""The registered queries of the operators, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.llm import (
    byte_bpe,
    chat,
    clustering,
    decontaminate,
    fingerprints,
    language,
    lexical_search,
    line_dedup,
    ngram_join,
    quality,
    suffix_dedup,
    token_counts,
    toxicity,
)
from weatherloom.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]

#: Fixed value: the turns every formatted set holds besides its own.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(documents(spark, sf_dir))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.matches(documents(spark, sf_dir), benchmark)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], given.schema)
    return chat.read_back(chat.windows(given.unionByName(control)))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(documents(spark, sf_dir))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = quality.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.scored(docs, weights)
    return scored.select(
        "doc_id",
        language.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identified(docs, language.dictionaries(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.counted(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights, thresholds = toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.flagged(toxicity.scored(docs, weights), thresholds).select(
        "doc_id",
        language.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_winnowing,
        op3_suffix_dedup,
        op4_decontaminate,
        op5_chat_format,
        op6_line_dedup,
        op7_byte_bpe,
        op8_quality,
        op9_language,
        op10_token_counts,
        op11_toxicity,
        op12_lexical_search,
        op13_centroids,
        pipeline,
    )
}

WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NGRAM_JOIN_SQL = f"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM worded),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (
  SELECT doc_id, doc_id AS r FROM sizes UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r)
SELECT reach.doc_id, n AS n_shingles, min(r) AS component_id FROM reach JOIN sizes ON sizes.doc_id = reach.doc_id
GROUP BY reach.doc_id, n"""

DECONTAMINATE_SQL = f"""WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT 1, item_id, text FROM benchmark WHERE text IS NOT NULL),
worded AS (
  SELECT kind, id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM texts),
shingled AS (
  SELECT kind, id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS s
  FROM worded WHERE len(w) > 0),
grams AS (SELECT kind, id, unnest(s) AS g FROM shingled),
pairs AS (
  SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM grams d JOIN grams i ON d.g = i.g AND d.kind = 0 AND i.kind = 1),
counts AS (SELECT id, g, count(*) AS n FROM grams WHERE kind = 1 GROUP BY 1, 2),
windows AS (
  SELECT doc_id, item_id, len(i.s) AS size, d.s AS s, unnest(range(0, len(d.s) - CAST(ceil(len(i.s) * 75 / 100) AS BIGINT) + 1)) AS word
  FROM pairs JOIN shingled d ON d.kind = 0 AND d.id = doc_id JOIN shingled i ON i.kind = 1 AND i.id = item_id),
held AS (
  SELECT doc_id, item_id, word, size, least(size, len(s) - word) AS own, unnest(s[word + 1:word + size]) AS g FROM windows),
each_gram AS (SELECT doc_id, item_id, word, size, own, g, count(*) AS n FROM held GROUP BY ALL),
common AS (
  SELECT doc_id, item_id, word, size, own, sum(least(e.n, c.n)) AS c
  FROM each_gram e JOIN counts c ON c.id = item_id AND c.g = e.g GROUP BY ALL),
likely AS (SELECT doc_id, item_id, word, CAST(c AS DOUBLE) / CAST(own + size - c AS DOUBLE) AS similarity FROM common)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_max(word, struct_pack(s := similarity, w := -word)) AS word
FROM likely WHERE 100 * similarity >= 75 GROUP BY 1, 2"""

LINE_DEDUP_SQL = f"""WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS p, unnest(l) AS line FROM split),
counted AS (
  SELECT *, sum(len(regexp_extract_all(line, '{WORDS}'))) OVER (PARTITION BY doc_id ORDER BY p) AS upto,
    len(regexp_extract_all(line, '{WORDS}')) AS w FROM lines),
runs AS (
  SELECT a.doc_id, a.p AS f, min(b.p) AS t FROM counted a JOIN counted b
  ON b.doc_id = a.doc_id AND b.p >= a.p AND b.upto - a.upto + a.w >= 50 GROUP BY 1, 2
  UNION SELECT b.doc_id, max(a.p), b.p FROM counted b JOIN counted a
  ON b.doc_id = a.doc_id AND b.p >= a.p AND b.upto - a.upto + a.w >= 50 GROUP BY b.doc_id, b.p),
named AS (
  SELECT r.doc_id, f, t, array_to_string(l[f:t], chr(10)) AS name, min(struct_pack(d := r.doc_id, f := f)) OVER (PARTITION BY array_to_string(l[f:t], chr(10)), t - f) AS earliest
  FROM runs r JOIN split USING (doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(f, t + 1)) AS p FROM named WHERE earliest < struct_pack(d := doc_id, f := f)),
marked AS (
  SELECT c.doc_id, c.p, c.line, g.p IS NOT NULL AS g FROM counted c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.p = c.p),
edges AS (SELECT *, coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY p), false) AS before FROM marked),
done AS (
  SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (g) AS BIGINT) AS n_removed,
    CAST(count(*) FILTER (g AND NOT before) AS BIGINT) AS n_runs,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT g), '')) AS kept_sha256 FROM edges GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
  coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM documents LEFT JOIN done USING (doc_id)"""

TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL_SEARCH_SQL = f"""WITH worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}') AS w FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM worded WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
wanted AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) AS t FROM benchmark WHERE text IS NOT NULL),
items AS (SELECT item_id, t, count(*) AS times FROM wanted GROUP BY ALL),
each_term AS (SELECT doc_id, unnest(w) AS t FROM worded),
held AS (SELECT doc_id, t, count(*) AS tf FROM each_term GROUP BY ALL),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held CROSS JOIN totals GROUP BY t, docs),
impacts AS (
  SELECT doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms))) AS i
  FROM held JOIN lengths USING (doc_id) CROSS JOIN totals),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * i) AS BIGINT) AS score
  FROM items JOIN weights USING (t) JOIN impacts USING (t) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20"""


def _centroids_sql(clusters: int = 40, rounds: int = 5, size: int = 64) -> str:
    gap = "list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v AS m FROM kept QUALIFY c < {clusters})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, min(struct_pack(d := CAST({gap} AS BIGINT), c := c)) AS b FROM kept CROSS JOIN c{i} GROUP BY ALL)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
  SELECT b.c AS c, j, sum(v[j]) AS s, count(*) AS n FROM a{i} CROSS JOIN range(1, {size + 1}) AS g(j) GROUP BY 1, 2),
m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c AS c, coalesce(m{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN m{i} USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, b.d AS distance, CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = b.c"""


SQL: dict[str, str] = {
    "op1_ngram_join": NGRAM_JOIN_SQL,
    "op4_decontaminate": DECONTAMINATE_SQL,
    "op6_line_dedup": LINE_DEDUP_SQL,
    "op12_lexical_search": LEXICAL_SEARCH_SQL,
    "op13_centroids": _centroids_sql(),
}
