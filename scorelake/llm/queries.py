"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import (chat, contexttree, decontaminate, divergence, fingerprint, langid, merkle, mixing, ngramjoin,
                           quality, secrets, substrings, toxicity)
from scorelake.llm.store import table


def fold(key: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as empty text)."""
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % parts


def joined_sha(items: Column) -> Column:
    return F.sha2(F.encode(F.concat_ws(",", items), "UTF-8"), 256)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    dictionaries = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs, dictionaries, carry=("held_out",))


CONTROL_CHAT = "</s>[INST] ok [/INST]"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_CHAT).alias("text"))
    back = chat.read_back(chat.format_chats(rows.union(extra)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_items = F.size("items").cast("long") + F.col("unnamed").cast("long")
    return found.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"),
                        joined_sha(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contexttree.score(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, base),
        F.sha2(F.encode(joined(F.filter("spans", lambda s: s["kind"].isin(base))), "UTF-8"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 0
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.classify(docs, machine, carry=("held_out",))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    altered = {"text": merkle.lowered(F.col("text"), tampered)}
    return merkle.verify(merkle.build(table(spark, sf_dir, "documents"), altered=altered))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_language_id, op3_chat_formatting, op4_benchmark_decontamination, op5_lm_scoring,
    op6_source_mixing, op7_secret_scan, op8_document_fingerprints, op9_suffix_array_dedup, op10_quality_classifier,
    op11_toxicity, op12_merkle_manifest, op13_source_divergence)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CONTROL = chat.CONTROL.replace("'", "''")

SQL = {
    "op1_ngram_jaccard_join": rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END
    AS shingles FROM w),
u AS MATERIALIZED (SELECT doc_id, unnest(shingles) AS shingle, len(shingles) AS n FROM s),
e AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM s UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.r = e.a)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON s.doc_id = c.doc_id""",
    "op3_chat_formatting": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_CHAT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_CHAT}'),
o AS (
  SELECT *, row_number() OVER w AS no, lag(role) OVER w AS before,
    length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '{_CONTROL}')) AS chars,
    length(role) + length(role) - length(replace(role, '\', '')) + len(regexp_extract_all(role, '{_CONTROL}')) AS r_chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN no = 1 OR role <> before THEN r_chars + {len(chat.START + chat.SEP + chat.END)}
    ELSE {len(chat.CONT)} END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id""",
    "op4_benchmark_decontamination": rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL),
iw AS MATERIALIZED (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(words), 10) AS width,
    unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1),
      lambda k: array_to_string(words[k:k + 9], ' '))) AS win FROM i WHERE len(words) > 0),
dw AS MATERIALIZED (
  SELECT doc_id, width, k, array_to_string(words[k:k + width - 1], ' ') AS win FROM (
    SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS k
    FROM d, (SELECT DISTINCT width FROM iw) WHERE len(words) >= width)),
h AS MATERIALIZED (SELECT doc_id, k, dw.width, item FROM dw JOIN iw ON dw.win = iw.win AND dw.width = iw.width),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(k, k + width)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.doc_id""",
    "op6_source_mixing": rf"""
WITH z AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
b AS (SELECT source, count(*) AS docs, CAST(sum(size) AS BIGINT) AS source_size,
  CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM z GROUP BY source),
c AS (SELECT *, {mixing.MOST_COPIES} * source_size AS cap FROM b),
o AS (SELECT *, sum(source_size) OVER () AS total,
  coalesce(sum(cap) OVER w, 0) AS cap_before, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM c WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT *, cap * weight_left <= (total - cap_before) * weight AS capped FROM o),
t AS (SELECT *, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
  CAST(total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS DOUBLE) * weight
  / sum(CASE WHEN NOT capped THEN weight END) OVER () END AS target FROM p),
r AS (
  SELECT z.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    floor(CAST(('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT)
      / 4294967296.0 * ceil(docs / {mixing.BUCKET_ROWS}.0)) AS bucket
  FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket, size, doc_id) AS place,
  CAST(('0x' || substr(md5('{mixing.SEED}:offset:' || coalesce(source, '')), 1, 8)) AS BIGINT) / 4294967296.0 AS offs
  FROM r)
SELECT doc_id, size, source_size, target, CAST(size * least(
  floor(place * rate + offs) - floor((place - 1) * rate + offs), {mixing.MOST_COPIES}) AS BIGINT) AS taken FROM k""",
    "op12_merkle_manifest": rf"""
WITH RECURSIVE c AS (
  SELECT doc_id, source, lang, n_chars, text, xor(4294967295, list_reduce(
    [CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda h, i: CASE WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END))) AS crc FROM documents),
e AS (
  SELECT doc_id, coalesce('=' || lang, '') AS home, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text, CASE WHEN crc % 3 = 0 THEN {_LOWER.format("text")} ELSE text END AS altered FROM c),
d AS MATERIALIZED (
  SELECT doc_id, home, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS folded FROM e),
o AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY home ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY home) AS n FROM d),
l AS (
  SELECT home, 0 AS level, idx, n, leaf AS digest FROM o
  UNION ALL
  SELECT home, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM l WHERE n > 1 GROUP BY home, level, idx // 8, n),
s AS MATERIALIZED (
  SELECT home, digest, row_number() OVER (ORDER BY home) - 1 AS idx, count(*) OVER () AS n FROM l WHERE n = 1),
t AS (
  SELECT 0 AS level, idx, n, digest FROM s
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM t WHERE n > 1 GROUP BY level, idx // 8, n),
r AS MATERIALIZED (
  SELECT home, level, idx // 8 AS run, string_agg(digest, '' ORDER BY idx) AS kids FROM l WHERE n > 1
  GROUP BY home, level, idx // 8),
q AS MATERIALIZED (
  SELECT level, idx // 8 AS run, string_agg(digest, '' ORDER BY idx) AS kids FROM t WHERE n > 1 GROUP BY level, idx // 8),
u AS (
  SELECT home, idx AS no, 0 AS level, idx, folded, '' AS proof FROM o
  UNION ALL
  SELECT u.home, no, u.level + 1, idx // 8,
    sha256(left(kids, 64 * (idx % 8)) || folded || substr(kids, 64 * (idx % 8) + 65)),
    proof || left(kids, 64 * (idx % 8)) || substr(kids, 64 * (idx % 8) + 65)
  FROM u JOIN r ON u.home = r.home AND u.level = r.level AND u.idx // 8 = r.run),
v AS (
  SELECT home, no, 0 AS level, s.idx, folded, proof, digest AS subroot FROM (
    SELECT home, no, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM u GROUP BY home, no)
    JOIN s USING (home)
  UNION ALL
  SELECT v.home, no, v.level + 1, idx // 8,
    sha256(left(kids, 64 * (idx % 8)) || folded || substr(kids, 64 * (idx % 8) + 65)),
    proof || left(kids, 64 * (idx % 8)) || substr(kids, 64 * (idx % 8) + 65), subroot
  FROM v JOIN q ON v.level = q.level AND v.idx // 8 = q.run),
w AS (SELECT home, no, arg_max(folded, level) AS folded_root, arg_max(proof, level) AS proof, any_value(subroot) AS subroot
  FROM v GROUP BY home, no),
z AS (SELECT digest AS root FROM t WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM w JOIN o ON w.home = o.home AND w.no = o.idx CROSS JOIN z""",
    "op13_source_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS MATERIALIZED (
  SELECT lang, source, no, term, count(*) AS n FROM (SELECT lang, source, no, unnest(words) AS term FROM d)
  GROUP BY lang, source, no, term),
k AS MATERIALIZED (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS total FROM w GROUP BY lang, term HAVING count(*) >= 10),
c AS MATERIALIZED (
  SELECT w.lang, source, w.term, CAST(sum(n) AS HUGEINT) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term
  GROUP BY w.lang, source, w.term),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(size, 0) AS size FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM c GROUP BY lang, source) USING (lang, source)),
v AS MATERIALIZED (SELECT lang, sum(total) AS size, count(*) AS v FROM k GROUP BY lang),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (g.size + 2 * v.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.total + 2) // (v.size + 2 * v.v) AS q
  FROM g JOIN v ON g.lang = v.lang JOIN k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS f
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM x)
SELECT * FROM r WHERE part = 'pair' OR rank <= 10""",
}
