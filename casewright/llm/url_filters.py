"""Allow and block rules for URLs: a blocked Bloom filter, then an exact hash join.

A rule is (host, path, verdict). It fits its host and all subdomains when the
URL's path starts with the rule's path; the longest rule wins, and of equally
long ones the first by text. Every URL is turned into its canonical keys: each
host suffix joined with each path prefix that has the length of some rule's
path. Keys go through a blocked Bloom filter (one 64-bit word per key, so one
lookup each); the few that pass meet the rules in an equality join, which
removes the false positives.

Everything is built from DataFrame functions.

Defined results: a null URL, or one without ``://``, has empty host and path,
fits no rule and gets the default verdict; repeated rows stay repeated; repeated
rules count once (of two verdicts for one rule, ``block`` holds); an empty page
or rule table gives no rule hits; further columns of the pages are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import lower_ascii
from casewright.session import stage

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BITS_PER_KEY, PROBES, WORD = 16, 4, 64
# A filter of more words than this is joined by block instead of being carried as one array.
ARRAY_WORDS = 1 << 15


@dataclass(frozen=True)
class Filter:
    """The filter's words, keyed by block number, and how many blocks there are."""

    words: DataFrame
    blocks: int


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    """The bits of one key within its word: PROBES six-bit fields of a second hash."""
    code = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        mask = mask.bitwiseOR(_bit(F.shiftrightunsigned(code, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return mask


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def build_filter(rules: DataFrame) -> Filter:
    """OR the masks of all rule keys per block; the size follows from the number of rules."""
    keys = rules.select(F.concat("host", "path").alias("key")).distinct()
    blocks = max(1, -(-keys.count() * BITS_PER_KEY // WORD))
    words = keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("key"))).alias("word"))
    return Filter(words, blocks)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every host suffix followed by every path prefix of one of the lengths, longest first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: F.length(path) >= n)
    return F.when(
        (host != "") & (F.lit(len(lengths)) > 0),
        F.flatten(F.transform(suffixes, lambda s: F.transform(fitting, lambda n: F.concat(s, F.substring(path, F.lit(1), n))))),
    ).otherwise(F.array().cast("array<string>"))


def passing(keys: DataFrame, bloom: Filter) -> DataFrame:
    """Rows of ``keys`` (host, path, key) whose key may be listed."""
    block = _block(F.col("key"), bloom.blocks)
    fits = F.col("word").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key"))
    if bloom.blocks <= ARRAY_WORDS:
        pairs = bloom.words.collect()  # at most ARRAY_WORDS words
        words = [0] * bloom.blocks
        for row in pairs:
            words[row["block"]] = row["word"]
        literal = F.array(*[F.lit(w).cast("long") for w in words]) if bloom.blocks <= 64 else F.from_json(F.lit(str(words)), "array<bigint>")
        return keys.withColumn("word", F.element_at(literal, (block + 1).cast("int"))).filter(fits).drop("word")
    return keys.withColumn("block", block).join(bloom.words, "block").filter(fits).drop("block", "word")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id") -> DataFrame:
    """``<id>, host, path, rule, verdict`` for every page."""
    rules = rules.filter("host IS NOT NULL AND path IS NOT NULL AND host != ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    listed = rules.select(F.concat("host", "path").alias("key"), "verdict").groupBy("key").agg(F.max("verdict").alias("verdict"))
    # Path lengths of rules: as many as there are different ones, at most a URL's length.
    lengths = sorted((r["n"] for r in rules.select(F.length("path").alias("n")).distinct().collect()), reverse=True)
    split = pages.select(F.col(id_column), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keys = split.filter("host != ''").select("host", "path", F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key"))
    hits = passing(keys, build_filter(rules)).distinct().join(listed, "key")
    best = hits.groupBy("host", "path").agg(F.min(F.struct((-F.length("key")).alias("n"), "key", "verdict")).alias("best"))
    found = best.select("host", "path", F.col("best.key").alias("rule"), F.col("best.verdict").alias("verdict"))
    joined = split.join(found, ["host", "path"], "left")
    return joined.select(id_column, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def staged_rules(spark, rows: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table in the shared folder, from (host, path, verdict) rows."""
    return stage(spark.createDataFrame(rows, "host string, path string, verdict string"), "url_rules")
