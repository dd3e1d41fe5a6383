"""One query per operator, with production parameters over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright import session
from casewright.llm import bpe, conversations, decontaminate, jaccard_join, licenses, neighbours, phrases, ppm, sharding, suffix_dedup, token_files, toxicity, url_filters
from casewright.llm.common import BATCH_BYTES, fold, table

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
WORD_IDS, WORD_ID_BYTES, END_ID = 49_408, 2, 1
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
FILE_IDS = 8 << 20
#: Rows handed to a Python worker at once; whole texts among them make batches large.
BATCH_ROWS = 2000


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    docs = table(spark, sf_dir, "documents")
    scored = ppm.score(docs, ppm.training_fold(docs))
    return scored.select("doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.tune(spark)
    work, path = session.Workspace(spark, "token_ids"), session.fresh_path(spark, "token_files")
    kept, counts = token_files.staged(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY), END_ID, WORD_IDS, work.path("ids"), WORD_ID_BYTES)
    token_files.write(kept, path, WORD_IDS, files=1 + int(counts.sum()) // FILE_IDS, id_bytes=WORD_ID_BYTES, counts=counts)
    work.clear()
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return jaccard_join.link(table(spark, sf_dir, "documents"), jaccard_join.Rule(words=3, percent=90))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_distinct(F.col("spans.item"))
    hits = decontaminate.hit_words()
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return phrases.collocations(table(spark, sf_dir, "documents"), session.Workspace(spark, "phrases"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.judge(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.tune(spark)
    return conversations.digest(conversations.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_toxicity, op2_lm_scoring, op3_token_files, op4_bpe, op5_jaccard_join, op6_url_filters, op7_nearest_neighbours, op8_sharding, op9_decontamination, op10_suffix_dedup,
        op11_phrases, op12_licenses, op13_conversations,
    )
}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _pattern(markup: str) -> str:
    """A license template as a regular expression over words that are each followed by a blank."""
    out = " "
    for mark, low, high, word in re.findall(r"<<(/?optional|replace \w+ (\d+)\.\.(\d+))>>|([A-Za-z0-9]+)", markup):
        if word:
            out += word.lower() + " "
        else:
            out += {"optional": "(?:", "/optional": ")?"}.get(mark, "(?:[^ ]+ ){" + f"{low},{high}" + "}")
    return out


def _labels(lists: str) -> str:
    return f"array_to_string(list_sort(list_distinct({lists})), ',')"


_PHRASE_WORDS = [(p.split(), label) for p, label in licenses.PHRASES]
_BASE_STARTS = " || ".join(
    f"list_filter(range(0, len(w)), lambda i: w[i + 1 : i + {len(p)}] = {p})" for p, _ in _PHRASE_WORDS)
_BASE_LABELS = " || ".join(f"CASE WHEN contains(t, ' {' '.join(p)} ') THEN ['{label}'] ELSE [] END" for p, label in _PHRASE_WORDS)
_TEMPLATE_LABELS = " || ".join(f"CASE WHEN regexp_matches(t, '{_pattern(m)}') THEN ['{label}'] ELSE [] END" for label, m in licenses.TEMPLATES)

ORACLE: dict[str, str] = {
    "op11_phrases": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\n\x0B\x0C\r]')), '[^ \t]+') AS w FROM documents
        ), sized AS (SELECT lang, w, unnest(range(1, 6)) AS size FROM pieces
        ), grams AS (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM sized
        ), f AS (SELECT lang, size, w[i : i + size - 1] AS words, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 100
        ), totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang
        ), inside AS (SELECT lang, unnest([words[1 : size - 1], words[2 : size]]) AS words, c FROM f
        ), kept AS (SELECT * FROM f WHERE size > 1 AND NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = f.lang AND x.words = f.words AND 100 * x.c >= 100 * f.c)
        ), cuts AS (SELECT lang, words, size, c, unnest(range(1, size)) AS k FROM kept
        ), scored AS (
            SELECT x.lang, x.words, x.c AS a, x.k, l.c AS l, r.c AS r, t.n,
                   1000 * CAST(x.c AS HUGEINT) * CAST(t.n AS HUGEINT) // (CAST(l.c AS HUGEINT) * CAST(r.c AS HUGEINT)) AS score
            FROM cuts x JOIN totals t ON t.lang = x.lang JOIN f l ON l.lang = x.lang AND l.words = x.words[1 : x.k] JOIN f r ON r.lang = x.lang AND r.words = x.words[x.k + 1 : x.size]
        ), lowest AS (
            SELECT *, array_to_string(words, ' ') AS phrase, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS cut FROM scored
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE cut = 1)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""",
    "op12_licenses": f"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), joined AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t FROM words
        ), found AS (SELECT doc_id, w, {_BASE_STARTS} AS starts, {_BASE_LABELS} AS base, {_TEMPLATE_LABELS} AS own FROM joined)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base, list_min(starts) AS first_word, list_max(starts) AS last_word,
               {_labels('base')} AS base_labels, {_labels('base || own')} AS labels,
               CASE WHEN len(own) > 0 THEN 1.0 WHEN len(starts) > 0 THEN 0.5 ELSE 0.0 END AS score
        FROM found""",
    "op6_url_filters": f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), split AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS})
        SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               coalesce(max_by(verdict, length(rule_host || rule_path)), 'allow') AS verdict
        FROM split LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY page_id, host, path""",
}
