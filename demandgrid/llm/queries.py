"""The registered queries of the corpus operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm import (
    decontaminate, fim, fingerprints, langid, mixing, neardup, ngram_lm, quality, repeats, shards, simhash, toxicity, whitening,
)
from demandgrid.llm.common import held_out, table

LANG_HELD, TOXIC_HELD, QUALITY_HELD, MODEL_HELD = (4, 2), (5, 0), (3, 1), (5, 1)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("k1", "k2", "distance")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(*MODEL_HELD).alias("held_out"), "text")
    model = ngram_lm.train_words(docs.where("not held_out"))
    numbered = ngram_lm.number_words(docs, model)
    return ngram_lm.score_numbered(numbered, ngram_lm.train_levels(numbered.where("not held_out"), model, min_count=1))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = langid.learn_dictionaries(docs.where(~held_out(*LANG_HELD)).select("doc_id", "text", "lang"))
    return langid.predict_language(docs.select("doc_id", held_out(*LANG_HELD).alias("held_out"), "text"), learned)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(*TOXIC_HELD)).select("doc_id", "toxic")
    model = toxicity.learn(docs, labels)
    scored = toxicity.score_toxicity(docs.select("doc_id", held_out(*TOXIC_HELD).alias("held_out"), "text"), model, spans=True)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.find_repeats(table(spark, sf_dir, "documents"))
    text = F.array_join(F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["end"])), " ")
    return found.withColumn("spans", text)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(*QUALITY_HELD)).select("doc_id", "quality")
    model = quality.learn(docs, labels)
    scored = quality.score_quality(docs.select("doc_id", held_out(*QUALITY_HELD).alias("held_out"), "text"), model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op9_near_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(table(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = shards.shard_plan(table(spark, sf_dir, "documents"), 24)
    return plan.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


def op12_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_decontaminate, op3_language_model, op4_language_id, op5_toxicity, op6_repeats, op7_quality,
        op8_source_mix, op9_near_classes, op10_shards, op11_fill_in_middle, op12_simhash_components, op13_whitening,
    )
}

ORACLE: dict[str, str] = {
    # Every window that a shared shingle lines up with an item, compared exactly; no fingerprints.
    "op2_decontaminate": r"""
WITH t AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
items AS (
  SELECT item_id, w, len(w) AS n, least(len(w), 5) AS l
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
known AS (
  SELECT DISTINCT n, l, o, array_to_string(list_slice(w, o + 1, o + l), ' ') AS shingle
  FROM (SELECT *, unnest(range(n - l + 1)) AS o FROM items)),
held AS (
  SELECT doc_id, w, l, p, array_to_string(list_slice(w, p + 1, p + l), ' ') AS shingle
  FROM (SELECT t.*, s.l, unnest(range(len(w) - s.l + 1)) AS p FROM t, (SELECT DISTINCT l FROM items) s WHERE len(w) >= s.l)),
windows AS (
  SELECT DISTINCT doc_id, h.w, k.n, greatest(0, least(p - o, len(h.w) - k.n)) AS start
  FROM held h JOIN known k ON k.l = h.l AND k.shingle = h.shingle),
cut AS (SELECT doc_id, start, n, list_slice(w, start + 1, start + n) AS w FROM windows),
a AS (
  SELECT doc_id, start, n, shingle, count(*) AS c FROM (
    SELECT doc_id, start, n, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS shingle
    FROM (SELECT *, unnest(range(greatest(len(w) - 4, 1))) AS i FROM cut)) GROUP BY ALL),
b AS (
  SELECT item_id, n, shingle, count(*) AS c FROM (
    SELECT item_id, n, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS shingle
    FROM (SELECT *, unnest(range(greatest(n - 4, 1))) AS i FROM items)) GROUP BY ALL),
sa AS (SELECT doc_id, start, n, sum(c * len(shingle)) AS s FROM a GROUP BY ALL),
sb AS (SELECT item_id, n, sum(c * len(shingle)) AS s FROM b GROUP BY ALL),
common AS (
  SELECT doc_id, start, a.n, item_id, sum(least(a.c, b.c) * len(a.shingle)) AS s
  FROM a JOIN b ON a.n = b.n AND a.shingle = b.shingle GROUP BY ALL)
SELECT c.doc_id, c.item_id, c.start::INTEGER AS start_word, c.n::INTEGER AS n_words, c.s::DOUBLE / (sa.s + sb.s - c.s) AS similarity
FROM common c JOIN sa USING (doc_id, start, n) JOIN sb USING (item_id, n) WHERE c.s::DOUBLE / (sa.s + sb.s - c.s) >= 0.8
""",
    # Every window of every text, hashed and counted.
    "op6_repeats": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT r, p, md5(substr(x, 2 * p + 1, 800)) AS h FROM (SELECT r, x, unnest(range(n - 399)) AS p FROM d WHERE n >= 400)),
again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hits AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS last FROM w WHERE h IN (SELECT h FROM again)),
runs AS (SELECT r, p, sum((last IS NULL OR p > last + 400)::INTEGER) OVER (PARTITION BY r ORDER BY p) AS run FROM hits),
spans AS (SELECT r, run, min(p) AS lo, max(p) + 400 AS hi FROM runs GROUP BY r, run),
gaps AS (
  SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS lo, lo AS hi FROM spans
  UNION ALL SELECT d.r, coalesce(max(s.hi), 0), any_value(d.n) FROM d LEFT JOIN spans s ON s.r = d.r GROUP BY d.r),
kept AS (SELECT g.r, string_agg(substr(d.x, 2 * g.lo + 1, 2 * (g.hi - g.lo)), '' ORDER BY g.lo) AS x FROM gaps g JOIN d ON d.r = g.r GROUP BY g.r),
cut AS (
  SELECT r, sum(hi - lo) AS n_removed, count(*) AS n_spans, string_agg(lo || '-' || hi, ' ' ORDER BY lo) AS spans FROM spans GROUP BY r)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(c.n_removed, 0)::BIGINT AS n_removed, coalesce(c.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(k.x)) AS kept_sha256, c.spans
FROM d JOIN kept k ON k.r = d.r LEFT JOIN cut c ON c.r = d.r
""",
    "op8_source_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s),
q AS (SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS quotient FROM w),
l AS (
  SELECT *, CAST((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER (ORDER BY quotient, source IS NULL, source
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / sum(weight) OVER (ORDER BY quotient, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM q),
t AS (
  SELECT source, source_size, least(weight * max(own_level) OVER (), 3 * source_size)::DOUBLE AS target
  FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS repeats FROM t),
h AS (
  SELECT h.source, hash, held, row_number() OVER (PARTITION BY h.source ORDER BY hash) AS i,
         target - repeats * source_size AS rest, 0.002::DOUBLE * target AS near
  FROM (SELECT source, hash, sum(size) AS held FROM d WHERE size > 0 GROUP BY source, hash) h
  JOIN r ON h.source IS NOT DISTINCT FROM r.source),
f AS (  -- in the order of the hashes each that fits; a misfit ends it once the rest is near
  SELECT source, i, hash, held <= rest AND rest > near AS fits, rest - CASE WHEN held <= rest AND rest > near THEN held ELSE 0 END AS rest,
         near, rest <= near AS done
  FROM h WHERE i = 1
  UNION ALL
  SELECT h.source, h.i, h.hash, NOT f.done AND h.held <= f.rest, f.rest - CASE WHEN NOT f.done AND h.held <= f.rest THEN h.held ELSE 0 END,
         f.near, f.done OR (h.held > f.rest AND f.rest <= f.near)
  FROM f JOIN h ON h.source IS NOT DISTINCT FROM f.source AND h.i = f.i + 1),
k AS (SELECT source, hash FROM f WHERE fits)
SELECT d.doc_id, d.source, d.size, r.source_size, r.target,
       r.repeats + (k.hash IS NOT NULL AND d.size > 0)::BIGINT AS copies,
       (r.repeats + (k.hash IS NOT NULL AND d.size > 0)::BIGINT) * d.size AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.hash = k.hash
""",
    # Cut and joined text by text; restored by putting the pieces back.
    "op11_fill_in_middle": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents),
h AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
         ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4
  FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle, array_to_string(u[hi + 1:n], '') AS suffix
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM p
""",
    # All pairs of texts with a common shingle, compared exactly.
    "op9_near_classes": r"""
WITH RECURSIVE texts AS (
  SELECT min(doc_id) AS node, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL GROUP BY text),
cells AS (
  SELECT node, shingle, count(*) AS c FROM (
    SELECT node, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS shingle
    FROM (SELECT node, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM texts WHERE len(w) > 0)) GROUP BY ALL),
sizes AS (SELECT node, sum(c) AS n FROM cells GROUP BY node),
pairs AS (
  SELECT a.node AS u, b.node AS v, sum(least(a.c, b.c)) AS s FROM cells a JOIN cells b ON a.shingle = b.shingle AND a.node <> b.node GROUP BY ALL),
links AS (
  SELECT u, v FROM pairs JOIN sizes x ON x.node = u JOIN sizes y ON y.node = v WHERE s >= 0.8 * (x.n + y.n - s)),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
classes AS (SELECT u AS node, min(least(u, v)) AS class_id FROM reach GROUP BY u),
counts AS (SELECT u AS node, count(*) AS n_links FROM links GROUP BY u)
SELECT d.doc_id, coalesce(c.class_id, t.node, d.doc_id) AS class_id, coalesce(n.n_links, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN texts t ON t.text = d.text LEFT JOIN classes c ON c.node = t.node LEFT JOIN counts n ON n.node = t.node
""",
}
