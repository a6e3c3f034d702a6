"""The operators as queries over the tables of a folder, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm import (
    decontaminate,
    hard_negatives,
    host_rules,
    jaccard_join,
    language,
    licenses,
    merkle,
    rule_ensemble,
    secret_scan,
    suffix_pieces,
    token_counts,
    toxicity,
    warc,
)
from tillmetrics.llm.tables import in_fold, stored, table
from tillmetrics.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items found in each document."""
    return decontaminate.leaked_rows(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as WARC bundles and read back."""
    pages = table(spark, folder, "pages").select(
        F.col("page_id").cast("bigint").alias("key"), F.col("url").alias("target_uri"), F.col("html").alias("payload")
    )
    records = warc.read_bundles(spark, warc.archive(pages))
    return records.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in each document, by pattern and by the Markov models."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(secret_scan.samples(docs)))
    return found.select(
        "doc_id",
        *[secret_scan.count_of(F.col("base"), k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.as_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op4_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of each document, and whether it is kept given its host."""
    found = host_rules.judged(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and templates found in each document."""
    return licenses.scan(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of each document, learned from two folds of three."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    learned = docs.filter(~held_out & F.col("doc_id").isNotNull())
    net = language.fit(learned)
    found = docs.select("doc_id", held_out.alias("held_out"), language.predict(net, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies on the driver; tasks get its content."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of each document, counted by way of a cache.

    The cache is the session's ``spark.tillmetrics.tokenCache``, a folder that lasts, or else a new one.
    """
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    cache = spark.conf.get("spark.tillmetrics.tokenCache", None) or shared_folder(spark, "token-cache")
    counts = token_counts.token_counts(table(spark, folder, "documents"), definition, cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of each document, learned from three folds of four."""
    measures = stored(rule_ensemble.measured(table(spark, folder, "documents")), "statistics")
    labels = table(spark, folder, "labels").filter(~in_fold(F.col("doc_id"), 4, 2))
    model = rule_ensemble.fit(measures, labels)
    scored = measures.select(
        F.col("key").alias("doc_id"), in_fold(F.col("key"), 4, 2).alias("held_out"), model.score().alias("score")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= rule_ensemble.THRESHOLD, 1).otherwise(0))


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The piece ids of each document, and whether they decode to its text."""
    vocabulary = suffix_pieces.shared(spark, tokenizer_file("piece_bpe_32k.model"))
    found = table(spark, folder, "documents").select(
        "doc_id", suffix_pieces.round_trip(vocabulary, F.col("text")).alias("found")
    )
    return found.select(
        "doc_id",
        F.size("found.ids").cast("bigint").alias("n_tokens"),
        F.col("found.ids").alias("ids"),
        F.col("found.same").alias("round_trip"),
    )


def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles overlap by nine tenths."""
    return jaccard_join.groups_of(table(spark, folder, "documents"), jaccard_join.Rule(words=3, percent=90))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's leaf and witness in a manifest by language, checked after tampering."""
    docs = table(spark, folder, "documents")
    named = ["doc_id", "source", "lang", "n_chars", "text"]
    # A longer n_chars stays null where it is null, so such a leaf is unchanged.
    other = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in named]
    leaves = docs.select(
        "doc_id",
        "lang",
        merkle.leaf_of([F.col(c) for c in named]).alias("digest"),
        F.when(in_fold(F.col("doc_id"), 7, 0), merkle.leaf_of(other)).alias("tampered"),
    )
    path = merkle.witnesses(leaves, "lang", ["doc_id"])
    found = merkle.verified(path, F.coalesce("row.tampered", "digest"))
    return found.select(
        "row.doc_id",
        *[merkle.hex_text(F.col(c)).alias(n) for c, n in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))],
        F.sha2(merkle.hex_text(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
        merkle.hex_text(F.col("folded_root")).alias("folded_root"),
        "verified",
    )


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity score of each document, learned from four folds of five."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels").filter(~in_fold(F.col("doc_id"), 5, 0)))
    found = docs.select("doc_id", toxicity.judge(model, F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        in_fold(F.col("doc_id"), 5, 0).alias("held_out"),
        "found.score",
        F.when(F.col("found.score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
        F.size("found.passages").alias("n_passages"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels in a window of scores below each positive of every hundredth vector."""
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.usable(table(spark, folder, "embeddings"), vec_id, moved, F.col("embedding"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


_PAYLOADS = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first AND first IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

_HOST_RULES = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
u AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
g AS (SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram
      FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
d AS (SELECT r, i FROM g WHERE gram IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM d, range(3) AS x(k) GROUP BY r),
m AS (SELECT t.doc_id, t.source, len(w.words) AS n_words,
             CAST(length(array_to_string(w.words, '')) AS BIGINT) AS word_chars,
             CAST(length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             len(w.lines) AS n_lines, len(w.lines) - len(list_distinct(w.lines)) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words
      FROM t JOIN w USING (r) LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             10 * n_symbols > n_words AS s1, 3 * n_symbols > n_words AS l1,
             100 * n_dup_lines > 15 * n_lines AS s2, 100 * n_dup_lines > 30 * n_lines AS l2,
             100 * n_repeat_words > 35 * n_words AS s3, 100 * n_repeat_words > 50 * n_words AS l3,
             word_chars > 14 * n_words AS s4, word_chars > 20 * n_words AS l4 FROM m),
h AS (SELECT source, count(*) AS n, count_if(s1) AS f1, count_if(s2) AS f2, count_if(s3) AS f3, count_if(s4) AS f4
      FROM b GROUP BY source),
p AS (SELECT avg(f1 / n) AS m1, var_pop(f1 / n) AS v1, avg(f2 / n) AS m2, var_pop(f2 / n) AS v2,
             avg(f3 / n) AS m3, var_pop(f3 / n) AS v3, avg(f4 / n) AS m4, var_pop(f4 / n) AS v4 FROM h),
k AS (SELECT *, CASE WHEN v1 = 0 THEN 1000 ELSE least(greatest(m1 * (1 - m1) / v1 - 1, 1), 1000) END AS k1,
                CASE WHEN v2 = 0 THEN 1000 ELSE least(greatest(m2 * (1 - m2) / v2 - 1, 1), 1000) END AS k2,
                CASE WHEN v3 = 0 THEN 1000 ELSE least(greatest(m3 * (1 - m3) / v3 - 1, 1), 1000) END AS k3,
                CASE WHEN v4 = 0 THEN 1000 ELSE least(greatest(m4 * (1 - m4) / v4 - 1, 1), 1000) END AS k4 FROM p),
z AS (SELECT source, (f1 + m1 * k1) / (n + k1) > 0.3 AS z1, (f2 + m2 * k2) / (n + k2) > 0.3 AS z2,
             (f3 + m3 * k3) / (n + k3) > 0.3 AS z3, (f4 + m4 * k4) / (n + k4) > 0.3 AS z4 FROM h, k)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR if(z1, s1, l1) OR if(z2, s2, l2) OR if(z3, s3, l3) OR if(z4, s4, l4)) AS kept
FROM b JOIN z ON b.source IS NOT DISTINCT FROM z.source
"""

_MERKLE = """
WITH RECURSIVE p AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
            || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
            || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS front,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS behind,
         list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]))), lambda a, x:
           CASE WHEN xor(a, x) % 2 = 1 THEN xor(xor(a, x) // 2, 3988292384) ELSE xor(a, x) // 2 END) AS crc
  FROM documents),
t AS (SELECT doc_id, lang,
             sha256(front || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END
                    || behind) AS leaf,
             sha256(front || CASE WHEN n_chars IS NULL THEN '-'
                    ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) END || behind) AS changed,
             coalesce(xor(crc, 4294967295) % 7 = 0, false) AS tampered FROM p),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY lang) AS n FROM t),
a(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM l
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM a WHERE n > 1
  GROUP BY lang, level, i // 2, n),
s AS (SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i,
             count(*) OVER () AS n FROM a WHERE n = 1),
b(level, i, n, h) AS (
  SELECT 0, i, n, subroot FROM s
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM b WHERE n > 1
  GROUP BY level, i // 2, n),
r AS (SELECT h AS root, level AS height FROM b WHERE n = 1),
f(lang, i, tampered, changed, level, pos, h, proof) AS (
  SELECT lang, i, tampered, changed, 0, i, CASE WHEN tampered THEN changed ELSE leaf END, '' FROM l
  UNION ALL
  SELECT f.lang, f.i, f.tampered, f.changed, f.level + 1, f.pos // 2,
         sha256(CASE WHEN f.pos % 2 = 1 THEN o.h || f.h ELSE f.h || coalesce(o.h, '') END), f.proof || coalesce(o.h, '')
  FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang AND f.level < s.height
  LEFT JOIN a AS o ON o.lang IS NOT DISTINCT FROM f.lang AND o.level = f.level AND o.i = xor(f.pos, 1)),
g(lang, i, level, pos, h, proof) AS (
  SELECT f.lang, f.i, 0, s.i, f.h, f.proof FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang AND f.level = s.height
  UNION ALL
  SELECT g.lang, g.i, g.level + 1, g.pos // 2,
         sha256(CASE WHEN g.pos % 2 = 1 THEN o.h || g.h ELSE g.h || coalesce(o.h, '') END), g.proof || coalesce(o.h, '')
  FROM g JOIN r ON g.level < r.height LEFT JOIN b AS o ON o.level = g.level AND o.i = xor(g.pos, 1))
SELECT l.doc_id, l.leaf, s.subroot, r.root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = r.root AS verified
FROM l JOIN s ON s.lang IS NOT DISTINCT FROM l.lang CROSS JOIN r
JOIN g ON g.lang IS NOT DISTINCT FROM l.lang AND g.i = l.i AND g.level = r.height
"""

_HARD_NEGATIVES = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM s WHERE alike
      QUALIFY place <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.alike
       AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""

_JACCARD = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(len(words) - 2), lambda i: words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])
             END) AS grams FROM w),
x AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM g),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x AS a JOIN x AS b ON a.gram = b.gram AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM g UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT g.doc_id, CAST(len(g.grams) AS BIGINT) AS n_shingles, min(r.reached) AS component_id
FROM g JOIN r USING (doc_id) GROUP BY g.doc_id, g.grams
"""


def _license_sql() -> str:
    """Every template against the block at every place of a word of its, without any filter."""
    templates = ",\n    ".join(
        f"({i}, '{label}', {licenses.width_of(t)}, '{t}')" for i, (label, t) in enumerate(licenses.TEMPLATES)
    )
    phrases = ",\n    ".join(f"('{label}', '{p}')" for p, label in licenses.PHRASES.items())
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {low} AS text FROM
           (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
w AS (SELECT r, doc_id, {words.format("text")} AS words FROM t),
phrases(label, phrase) AS (VALUES
    {phrases}),
j AS (SELECT r, ' ' || array_to_string(words, ' ') || ' ' AS joined FROM w),
s AS (SELECT r, label, len(string_split(phrase, ' ')) AS size, string_split(replace(joined, ' ', '  '),
             ' ' || replace(phrase, ' ', '  ') || ' ') AS parts FROM j, phrases
      WHERE contains(joined, ' ' || phrase || ' ')),
x AS (SELECT r, label, len(parts) - 1 AS n,
             len(list_filter(string_split(parts[1], ' '), lambda y: y <> '')) AS first_word,
             size, len(list_filter(string_split(parts[-1], ' '), lambda y: y <> '')) AS behind FROM s),
base AS (SELECT x.r, CAST(sum(n) AS BIGINT) AS n_base, min(first_word) AS first_word,
                max(len(w.words) - behind - size) AS last_word, list_sort(list_distinct(list(label))) AS labels
         FROM x JOIN w USING (r) GROUP BY x.r),
templates(id, label, width, template) AS (VALUES
    {templates}),
tw AS (SELECT id, label, width, list_distinct(string_split(template, ' ')) AS own FROM templates),
u AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS b FROM w),
s2 AS (SELECT u.r, u.b, id, label, width, len(own) AS size,
              list_intersect(own, w.words[u.b + 1 : u.b + width]) AS shared
       FROM u JOIN tw ON list_contains(own, u.word) JOIN w ON w.r = u.r),
f AS (SELECT *, len(shared) / size AS containment FROM s2
      WHERE len(shared) >= ceil(round({licenses.THRESHOLD} * size, 9))),
best AS (SELECT f.r, f.label, f.containment FROM f WHERE NOT EXISTS (
           SELECT 1 FROM f AS o WHERE o.r = f.r AND f.b < o.b + o.width AND o.b < f.b + f.width
           AND len(list_intersect(f.shared, o.shared)) = len(f.shared)
           AND (o.containment > f.containment OR (o.containment = f.containment AND len(o.shared) > len(f.shared))))),
m AS (SELECT r, list_distinct(list(label)) AS labels, max(containment) AS containment FROM best GROUP BY r)
SELECT w.doc_id, len(w.words) AS n_words, coalesce(base.n_base, 0) AS n_base, base.first_word, base.last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         list_concat(coalesce(base.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       CAST(CASE WHEN base.n_base > 0 THEN 1.0 ELSE coalesce(m.containment, 0.0) END AS DOUBLE) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN m USING (r)
"""


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_warc": op2_warc,
    "op3_secrets": op3_secrets,
    "op4_host_rules": op4_host_rules,
    "op5_licenses": op5_licenses,
    "op6_language": op6_language,
    "op7_token_counts": op7_token_counts,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_quality": op9_quality,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_merkle": op11_merkle,
    "op12_toxicity": op12_toxicity,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc": _PAYLOADS,
    "op4_host_rules": _HOST_RULES,
    "op5_licenses": _license_sql(),
    "op8_ngram_jaccard_join": _JACCARD,
    "op11_merkle": _MERKLE,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
