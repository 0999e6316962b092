"""Registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat_format, embedding_dedup, html_extract, language_id, mixing, quality_classifier, quality_rules, simhash, source_audit, spelling, token_counts, toxicity
from .common import read


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source, its path the language section of it."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    found = quality_classifier.classify(docs, labels, host=F.col("source"), path=F.col("lang"))
    return found.withColumnRenamed("id", "doc_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"), keep=["doc_id"])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), size=3, radius=2)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, tokenizer_file("byte_bpe_50k.tiktoken"), split_pattern(), keep=["doc_id"])


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.9)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])


#: Domains of the labelled table, and the share of tokens each shall have.
DOMAINS = "CASE WHEN quality < 1 THEN 'junk' WHEN toxic >= 1 THEN 'toxic' WHEN quality >= 1 THEN 'clean' END"
TARGETS = {"clean": 0.975, "toxic": 0.02, "junk": 0.005}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return mixing.mix(docs, labels, F.expr(DOMAINS), TARGETS, anchor="clean", anchor_floor=1.0, keep=["doc_id", "source"])


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tables = token_counts.prefix_token_counts(docs, tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"])
    return tables.withColumn("n_tokens", F.coalesce(F.try_element_at("prefix_tokens", F.lit(-1)), F.lit(0)).cast("long")).drop("prefix_tokens")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.drop("near_lang", "char_js", "word_js")


def op8_sql(rules: quality_rules.Rules = quality_rules.Rules()) -> str:
    """The same rules over long tables of counts: (document, bin) against (language, bin)."""
    w = rules.window
    known = ", ".join(f"('{lang}', '{word}')" for lang, words in quality_rules.COMMON_WORDS.items() for word in words)
    classes = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "space": r"\x20\x09-\x0D", "stop": r".,;:!?\x27\x22()\-",
               "symbol": "#*$%&|<>", "wide": r"\x{80}-\x{10FFFF}"}
    count = ", ".join(f"length(regexp_replace(text, '[^{kind}]', '', 'g')) AS {name}" for name, kind in classes.items())
    rest = " - ".join(["length(text)", *(f"length(regexp_replace(text, '[^{kind}]', '', 'g'))" for kind in classes.values())])
    return rf"""
WITH known(lang, word) AS (VALUES {known}),
common AS (SELECT DISTINCT word FROM known),
d AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
starts AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + {w - 1}), chr(31)) AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - {w - 1})) AS i FROM d WHERE len(words) >= {w})),
often AS (SELECT doc_id, win FROM starts GROUP BY ALL HAVING count(*) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (
    SELECT doc_id, unnest(generate_series(i, i + {w - 1})) AS pos FROM starts SEMI JOIN often USING (doc_id, win))
  GROUP BY doc_id),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, length(text) AS n_chars, coalesce(r.n, 0) AS n_repeat_words,
         coalesce(u.n, 0) AS n_dup_lines, {count}, {rest} AS other
  FROM d LEFT JOIN repeats r USING (doc_id) LEFT JOIN dups u USING (doc_id)),
judged AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_pct} * n_words AS base_failed FROM base),
hits AS (SELECT doc_id, word, count(*) AS n FROM w SEMI JOIN common USING (word) GROUP BY ALL),
bins AS (
  SELECT doc_id, 'c' AS kind, bin, n FROM (UNPIVOT judged ON {", ".join(classes)}, other INTO NAME bin VALUE n) WHERE n > 0
  UNION ALL SELECT doc_id, 'w', word, n FROM hits
  UNION ALL SELECT doc_id, 'w', ' other', n_words - coalesce((SELECT sum(n) FROM hits h WHERE h.doc_id = j.doc_id), 0) FROM judged j),
own AS (SELECT h.doc_id, sum(h.n) AS n FROM hits h JOIN d USING (doc_id) JOIN known k ON k.lang = d.lang AND k.word = h.word GROUP BY 1),
ordinary AS (
  SELECT doc_id, lang FROM judged JOIN own o USING (doc_id)
  WHERE NOT base_failed AND 100 * o.n >= {rules.reference_common_pct} * n_words),
refs AS (
  SELECT lang, kind, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY lang, kind) AS q FROM bins JOIN ordinary USING (doc_id) GROUP BY lang, kind, bin),
shares AS (SELECT doc_id, kind, bin, n / sum(n) OVER (PARTITION BY doc_id, kind) AS p FROM bins WHERE n > 0),
js AS (
  SELECT doc_id, l.lang, s.kind, sqrt(greatest(0, (sum(p * log2(2 * p / (p + coalesce(q, 0)))
           + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) + 1 - sum(coalesce(q, 0))) / 2)) AS js
  FROM shares s CROSS JOIN (SELECT DISTINCT lang FROM refs) l LEFT JOIN refs r ON r.lang = l.lang AND r.kind = s.kind AND r.bin = s.bin
  GROUP BY ALL),
near AS (
  SELECT j.doc_id, bool_or(c.js <= {rules.max_char_js} + {rules.slack} / sqrt(greatest(1, n_chars))
      AND (n_words < {rules.judge_words_from} OR v.js <= {rules.max_word_js} + {rules.slack} / sqrt(greatest(1, n_words)))) AS ok
  FROM judged j JOIN js c ON c.doc_id = j.doc_id AND c.kind = 'c' JOIN js v ON v.doc_id = j.doc_id AND v.lang = c.lang AND v.kind = 'w'
  GROUP BY j.doc_id)
SELECT doc_id, n_words, CAST(n_chars - space AS BIGINT) AS word_chars, CAST(symbol AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(ok, NOT EXISTS (SELECT 1 FROM refs)) AS kept
FROM judged LEFT JOIN near USING (doc_id)
"""


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') "
                    "AS t(conv_id, turn, role, text)")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    messages = chat_format.fold(chat_format.as_events(turns))
    return chat_format.digests(chat_format.read_back(chat_format.render(messages)))


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), marks(mark) AS (VALUES ('\'), ('<|'), ('<s>'), ('</s>'), ('[INST]'), ('[/INST]'), ('<<SYS>>'), ('<</SYS>>')),
k AS (
  SELECT *, length(role) + length(text) + 8 + 1 + 7 + 1
    + (SELECT sum((length(role) - length(replace(role, mark, ''))) // length(mark)
                + (length(text) - length(replace(text, mark, ''))) // length(mark)) FROM marks) AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM k GROUP BY conv_id
"""


#: All pairs compared; for tables of a few thousand vectors.
OP5_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM good),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / a.size / b.size >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS top FROM embeddings
  UNION
  SELECT l.b, r.top FROM reach r JOIN links l ON l.a = r.a AND r.top < l.b)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(top) AS component_id FROM reach GROUP BY a)
"""

#: For pages whose text is an article of headings and paragraphs, as in all test tables.
OP10_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|<footer>|$)', 1) AS body FROM pages),
b AS (
  SELECT page_id, url, list_filter(list_transform(string_split(regexp_replace(body, '(?s)<h1>|</h1>|</?p>', chr(1), 'g'), chr(1)),
         lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x,
           '(?s)<!--.*?-->|<[^>]*>', '', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM a)
SELECT page_id, url, array_to_string(blocks, chr(10)) AS text, CAST(length(array_to_string(blocks, chr(10))) AS BIGINT) AS n_chars FROM b
"""


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted", F.col("evidence.id").alias("nearest"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read(spark, sf_dir, "documents"))


#: Every term of every pair of sources; for small tables.
OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents),
w AS (
  SELECT id, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce((SELECT sum(n) FROM own o WHERE o.lang = g.lang AND o.source = g.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l USING (lang)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (g.total + 2 * g.v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
over AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM (SELECT s.*, 1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
        FROM shares s JOIN kept k USING (lang, term) JOIN langs l USING (lang) WHERE s.n > 0) WHERE p > q),
ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every
  UNION ALL
  SELECT 'term', *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM over QUALIFY
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_simhash": op2_simhash,
        "op3_language_id": op3_language_id,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op6_mixing": op6_mixing,
        "op7_token_counts": op7_token_counts,
        "op8_quality_rules": op8_quality_rules,
        "op9_chat_format": op9_chat_format,
        "op10_html_extract": op10_html_extract,
        "op11_toxicity": op11_toxicity,
        "op12_source_audit": op12_source_audit,
        "op13_spelling": op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_embedding_dedup": OP5_SQL, "op8_quality_rules": op8_sql(), "op9_chat_format": OP9_SQL, "op10_html_extract": OP10_SQL,
            "op12_source_audit": OP12_SQL}
