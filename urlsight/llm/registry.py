"""Registered queries of the text operators (``QUERIES``) and their DuckDB SQL (``ORACLE``)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, collocations, decontaminate, html_extract, license_scan, lm_score, packing, quality_model,
               quality_rules, sharding, simhash, spelling_variants, vector_duplicates)
from .common import table

SHINGLE_WORDS = 3


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), SHINGLE_WORDS)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


POLICY = "v1"
SHARDS = 16
# The conversation that is added to the table.
EXTRA_CONVERSATION = [{"conv_id": -1, "turn": t, "role": r, "text": "</s>[INST] ok [/INST]"} for t, r in enumerate(("user", "assistant"))]


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"), quality_rules.passes(POLICY).alias("kept"), "fail_bits")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.texts(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> quality_model.Model:
    """Fitted on ``documents`` and ``labels.quality``, without the held-out third of the ids."""
    usable = ~quality_model.held_out(F.col("doc_id"), 3, 1)
    return quality_model.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", usable)


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_model.score(docs, quality_classifier(spark, sf_dir))
    return scored.select("doc_id", quality_model.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = sharding.values(spark, EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    made = chat_format.format_trees(chat_format.chains(given.unionByName(extra)))
    found = made.select("tree", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                        chat_format.masked_text(F.col("formatted"), F.col("mask")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), shingle=SHINGLE_WORDS)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), wrapped=True)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = quality_model.held_out(F.col("doc_id"), 7, 2)
    scored = lm_score.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_duplicates.links(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.9)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), threshold=30, top=2000, share=80)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling_variants.runs(table(spark, sf_dir, "documents"), least_chars=7)
    words = runs.select(spelling_variants.thinned(F.col("doc_id"), F.col("run"), 31).alias("word"))
    return spelling_variants.variants(spelling_variants.counted(words, least_chars=7, least_count=2), ratio=10)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality_rules": op2_quality_rules,
    "op3_html_extract": op3_html_extract,
    "op4_sharding": op4_sharding,
    "op5_quality_model": op5_quality_model,
    "op6_chat_format": op6_chat_format,
    "op7_packing": op7_packing,
    "op8_license_scan": op8_license_scan,
    "op9_lm_score": op9_lm_score,
    "op10_decontaminate": op10_decontaminate,
    "op11_vector_duplicates": op11_vector_duplicates,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}

WORD = r"[^\x20\x09-\x0D]+"

OP2_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM documents),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM d, unnest(range(1, len(ws) - 1)) t(i)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1),
m AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words
  FROM d LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_upper_words > n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 32 ELSE 0 END AS fail_bits
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM b"""

# The pages' own markup, block by block; references are decoded as they occur in these tables.
OP3_SQL = r"""
WITH b AS (
  SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1),
                                             '</?(h1|p)( [^>]*)?>') AS parts
  FROM pages),
t AS (
  SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>?', '', 'g')) AS parts FROM b),
u AS (
  SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(replace(replace(replace(replace(replace(replace(
           x, '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;?', '&', 'g')) AS parts
  FROM t),
v AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))),
                                                   lambda x: x <> ''), chr(10)) AS text
  FROM u)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM v"""

OP6_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'))
         + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), chr(10), '&nl;')) AS n
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + length('<|turn|>') + 1 + length('<|end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""


def _op8_sql() -> str:
    """Every line against every template, without any filter."""
    rows = license_scan.template_rows(license_scan.TEMPLATES, license_scan.CONTAINMENT)
    listed = ", ".join("({}, [{}], {})".format(repr(t["label"]), ", ".join(map(repr, t["words"])), t["need"]) for t in rows)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = f"translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}')"
    starts = ", ".join(
        "list_filter(range(len(ws)), lambda i: " + " AND ".join(f"ws[i + {k + 1}] = '{p}'" for k, p in enumerate(phrase.split(" "))) + ")"
        for phrase, _ in license_scan.PHRASES)
    base = ", ".join(f"CASE WHEN len(starts[{k + 1}]) > 0 THEN '{label}' END" for k, (_, label) in enumerate(license_scan.PHRASES))
    return rf"""
WITH t(label, words, need) AS (VALUES {listed}),
d AS (SELECT doc_id, {low} AS low, regexp_extract_all({low}, '{word}') AS ws FROM documents),
l AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(low, chr(10))), '{word}')) AS held FROM d),
m AS (
  SELECT doc_id, label, max(len(list_intersect(held, words)) / len(words)) AS score FROM l, t
  WHERE len(list_intersect(held, words)) >= need GROUP BY 1, 2),
g AS (SELECT doc_id, list(label) AS found, max(score) AS score FROM m GROUP BY 1),
p AS (SELECT doc_id, len(ws) AS n_words, [{starts}] AS starts FROM d),
q AS (SELECT doc_id, n_words, flatten(starts) AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS base FROM p)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
       list_max(places)::BIGINT AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM q LEFT JOIN g USING (doc_id)"""


# Every pair of usable vectors; labels spread along links until none changes.
OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY 1),
c AS (SELECT a, min(b) AS least FROM r GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a"""

# Every phrase of one to four words is counted.
OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY 1),
g AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k FROM w, range(1, 5) ks(k), unnest(range(1, len(ws) - k + 2)) s(i)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS a, string_split(phrase, ' ') AS ws FROM g GROUP BY lang, phrase HAVING count(*) >= 30),
c AS (
  SELECT lang, phrase, f.k, a, ws, c.k AS cut, array_to_string(ws[1:c.k], ' ') AS head, array_to_string(ws[c.k + 1:], ' ') AS tail
  FROM f, range(1, 4) c(k) WHERE c.k < f.k),
s AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, h.a AS l, r.a AS r, 2000000::HUGEINT * c.a // (h.a + r.a) AS score
  FROM c JOIN f h ON c.lang = h.lang AND c.head = h.phrase JOIN f r ON c.lang = r.lang AND c.tail = r.phrase),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (
  SELECT lang, array_to_string(ws[b:b + z - 1], ' ') AS phrase, max(a) AS above
  FROM f, range(2, 4) q(z), unnest(range(1, k - z + 2)) o(b) WHERE k > z GROUP BY 1, 2),
d AS (SELECT m.* FROM m LEFT JOIN i USING (lang, phrase) WHERE above IS NULL OR 100::HUGEINT * above < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM d JOIN t USING (lang) QUALIFY rank <= 2000"""


ORACLE = {"op2_quality_rules": OP2_SQL, "op3_html_extract": OP3_SQL, "op6_chat_format": OP6_SQL, "op8_license_scan": _op8_sql(),
          "op11_vector_duplicates": OP11_SQL, "op12_collocations": OP12_SQL}
