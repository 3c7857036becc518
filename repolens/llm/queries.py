"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.llm import align, bpe, langid, lines, minhash, mixing, phrases, pii, pq, quality, simple8b, warc, winnow
from repolens.llm.common import ship, text_bytes
from repolens.session import shared_scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _tokenizer("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs, ranks)


def bpe_digests(docs: DataFrame, ranks: str) -> DataFrame:
    ids = bpe.encode(docs, ranks, keep_text=False)
    return bpe.decode(ids, ranks, digest="ids_sha256").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = pq.link(_table(spark, sf_dir, "embeddings"))
    return linked.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_scratch(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path, compression="gzip")
    return warc.read(spark, path).select(
        warc.page_number(F.col("id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(_table(spark, sf_dir, "documents"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = max(2, text_bytes(docs, "text") // (4 << 20))
    half = "cast(char_length(text) div 2 as int)"
    pairs = winnow.with_next(docs, "doc_id", ["text"], n).withColumn(
        "edited", F.expr(f"concat(substring(text, 1, char_length(text) - {half}), substring(next_text, 1, {half}))")
    )
    prints = winnow.fingerprint(pairs, {"text": "own", "edited": "edited", "next_text": "next"})
    own, edited, following = (F.col(f"{p}_hashes") for p in ("own", "edited", "next"))
    return prints.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        winnow.as_text(own).alias("fingerprint"),
        winnow.as_text(edited).alias("edited_fingerprint"),
        winnow.likeness(own, edited).alias("near_edited"),
        winnow.likeness(own, following).alias("near_next"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = minhash.link(_table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, percent=80)
    return linked.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs).select("doc_id", "n_entities", "text")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.report(mixing.plan(_table(spark, sf_dir, "documents")))
    first = F.get("positions", F.lit(0)).alias("position")
    return planned.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", first).orderBy("position", "doc_id")


def op10_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_scratch(spark, "simple8b")
    simple8b.write_documents(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), path, added=True)
    return simple8b.index(spark, path)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.apply(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.align(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_table(spark, sf_dir, "documents").select("text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_vectors": op2_vectors,
    "op3_language": op3_language,
    "op4_warc": op4_warc,
    "op5_winnowing": op5_winnowing,
    "op6_line_dedup": op6_line_dedup,
    "op7_minhash": op7_minhash,
    "op8_surrogates": op8_surrogates,
    "op9_mixing": op9_mixing,
    "op10_simple8b": op10_simple8b,
    "op11_quality": op11_quality,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}

OP6_SQL = r"""
WITH l AS (
  SELECT doc_id, u.pos, u.line,
         translate(trim(u.line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents, LATERAL (
    SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos) u
), shared AS (
  SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.k IS NOT NULL AND l.doc_id <> s.first AS gone
  FROM l LEFT JOIN shared s ON l.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM g UNION SELECT r.a, g.b FROM r JOIN g ON r.b = g.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(m.low, n.doc_id)) AS component_id,
       n.doc_id = least(n.doc_id, coalesce(m.low, n.doc_id)) AS kept
FROM n LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) m ON n.doc_id = m.a
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS o,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (
  SELECT *, CAST(rank % 3 + 1 AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS bound, CAST(sum(source_size) OVER () AS DOUBLE) AS total, count(*) OVER () AS n FROM s
), v AS (
  SELECT *, (total - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, CASE WHEN n > 1 THEN (rank * 2 / (n - 1) - 1) * 0.8::DOUBLE ELSE 0.0::DOUBLE END AS tilt, least(bound, weight * coalesce(
    (SELECT arg_min(level, bound / weight) FROM v WHERE level * weight <= bound), bound / weight)) AS target FROM v
), b AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.tilt,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS passes
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, CASE WHEN size > 0 THEN passes + CASE WHEN before + size / 2 <= target - passes * source_size THEN 1 ELSE 0 END ELSE 0 END AS copies,
         least(1.0::DOUBLE, (before + size / 2) / target) AS done
  FROM b
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
       CASE WHEN copies = 0 THEN NULL WHEN abs(tilt) < 1e-9 THEN done
            ELSE 2 * done / ((1 - tilt) + sqrt(greatest(0.0::DOUBLE, (1 - tilt) * (1 - tilt) + 4 * tilt * done))) END AS position
FROM c
"""

OP4_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d
"""

OP2_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), g AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), r AS (SELECT a, b FROM g UNION SELECT r.a, g.b FROM r JOIN g ON r.b = g.a),
n AS (SELECT a, count(*) AS n FROM g GROUP BY a), m AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN m ON vec_id = m.a
"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) AS x FROM d WHERE len(w) > 3
), again AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1
), r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d
), u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(u.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN u USING (doc_id) LEFT JOIN r USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), v AS (
  SELECT doc_id, lang, source, base_failed, unnest(['length', 'symbols', 'dup_lines', 'repeats']) AS measure,
         unnest([1000 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_words, 1000 * n_repeat_words // n_words]) AS value
  FROM b WHERE n_words > 0
), s AS (  -- a value's bucket is known by its smallest value
  SELECT *, CASE WHEN value < 64 THEN value ELSE (value >> CAST(length(bin(value)) - 6 AS BIGINT)) << CAST(length(bin(value)) - 6 AS BIGINT) END AS low_end FROM v
), k AS (
  SELECT 2 AS level, lang, source, measure, low_end FROM s WHERE NOT base_failed UNION ALL
  SELECT 1, lang, NULL, measure, low_end FROM s WHERE NOT base_failed UNION ALL
  SELECT 0, NULL, NULL, measure, low_end FROM s WHERE NOT base_failed
), q AS (
  SELECT level, lang, source, measure, count(*) AS total, quantile_disc(low_end, 0.25) AS a, quantile_disc(low_end, 0.5) AS mid, quantile_disc(low_end, 0.75) AS z
  FROM k GROUP BY ALL HAVING count(*) >= 200 OR level = 0
), f AS (SELECT level, lang, source, measure, a - 8 * (mid - a) - room AS low, z + 8 * (z - mid) + room AS high
  FROM q JOIN (VALUES ('length', 1000), ('symbols', 100), ('dup_lines', 100), ('repeats', 300)) o(measure, room) USING (measure)
), x AS (
  SELECT s.doc_id, s.measure, s.value > coalesce(f2.high, f1.high, f0.high) OR (s.measure = 'length' AND s.value < coalesce(f2.low, f1.low, f0.low)) AS bad
  FROM s LEFT JOIN f f2 ON f2.level = 2 AND f2.measure = s.measure AND f2.lang IS NOT DISTINCT FROM s.lang AND f2.source IS NOT DISTINCT FROM s.source
  LEFT JOIN f f1 ON f1.level = 1 AND f1.measure = s.measure AND f1.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN f f0 ON f0.level = 0 AND f0.measure = s.measure
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce((SELECT bool_or(bad) FROM x WHERE x.doc_id = b.doc_id), false) AS kept
FROM b
"""

OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4, 5], lambda m: list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i+m-1], ' '))))) AS phrase FROM w
), f AS (SELECT lang, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM g GROUP BY lang, phrase HAVING count(*) >= 100
), c AS (SELECT lang, phrase, f AS a, w, unnest(range(1, len(w))) AS k FROM f WHERE len(w) > 1
), s AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k+1:], ' ') JOIN n ON n.lang = c.lang
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), o AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, unnest(flatten(list_transform(range(2, len(w)), lambda m: list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i+m-1], ' '))))) AS phrase
    FROM f WHERE len(w) > 2) GROUP BY lang, phrase
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM b LEFT JOIN o USING (lang, phrase) WHERE o.longer IS NULL OR 100 * o.longer < 100 * a
QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op13_collocations": OP13_SQL,
    "op11_quality": OP11_SQL,
    "op2_vectors": OP2_SQL,
    "op4_warc": OP4_SQL,
    "op9_mixing": OP9_SQL,
    "op7_minhash": OP7_SQL,
    "op6_line_dedup": OP6_SQL}
