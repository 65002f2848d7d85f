"""URL filter: a blocked Bloom filter in front of an exact rule join.

The listed canonical URLs are rules (host, path, verdict); a rule fits its host
and all subdomains if the url's path starts with the rule's path.  A url's keys
are all pairs of a host suffix, of at most as many labels as the longest listed host,
and a path prefix of a listed length.  The Bloom filter puts each listed key's bits into one 64-bit block; the keys whose block
has all their bits go to an exact hash join with the list, which removes the
false positives.  The longest fitting rule wins (then the longer host).

The filter has at most ``MAX_BLOCKS`` blocks, whatever the list's length, so it
can always be broadcast; a longer list only lets more keys through to the join.

Defined results: a null url, or one without ``://``, has an empty host and path
and, like any url that no rule fits, the verdict allow and a null rule; of
several verdicts for one rule, block wins; rules with a null or empty host, a
null path or another verdict than allow or block are ignored; repeated urls are
judged alike, and ties between rules of one length go to the longer host; empty
tables give no rows.  Very long urls are judged whole: a url's keys are as many as
labels times path lengths of the list, whatever its own length.  Columns besides
page_id and url are not read, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse.llm.common import constant_rows
from acctpulse.llm.decontaminate import lower_ascii

BITS_PER_KEY = 16
PROBES = 4
MAX_BLOCKS = 1 << 20  # of 8 bytes each
BROADCAST_RULES = 200_000
MAX_PREFIX_LENGTHS = 4_096  # distinct path lengths of a list up to which they are constants of the query; more are joined as a table

#: Host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return constant_rows(spark, rules, rule_host="string", rule_path="string", verdict="string")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _mask(key: Column) -> Column:
    """PROBES bits of one 64-bit block."""
    h, mask = F.xxhash64(key, F.lit(2)), F.lit(0).cast("long")
    for i in range(PROBES):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63))
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int")))
    return mask


def bloom_filter(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """The blocks (block, bits) of the listed keys, and how many blocks there can be."""
    blocks = max(1, min(MAX_BLOCKS, n_keys * BITS_PER_KEY // 64))
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("key"))).alias("bits")), blocks


def _labels(name: Column) -> Column:
    """How many labels a host has."""
    return F.length(name) - F.length(F.replace(name, F.lit("."), F.lit(""))) + 1


def _with_prefixes(keys: DataFrame, lengths: DataFrame) -> DataFrame:
    """Each key with its path's prefixes of the listed lengths."""
    sizes = sorted(r[0] for r in lengths.limit(MAX_PREFIX_LENGTHS + 1).collect())
    if len(sizes) <= MAX_PREFIX_LENGTHS:
        prefixes = F.array(*[F.substring("path", 1, n) for n in sizes]).cast("array<string>")
        return keys.select("host", "path", "suffix", F.explode(F.array_distinct(prefixes)).alias("prefix"))
    longest = lengths.agg(F.max("size")).first()[0]
    each = keys.withColumn("size", F.explode(F.sequence(F.lit(0), F.least(F.length("path"), F.lit(longest)))))
    return each.join(lengths, "size").select("host", "path", "suffix", F.substring("path", F.lit(1), F.col("size")).alias("prefix"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of each page."""
    rules = rules.filter("rule_host is not null and rule_host != '' and rule_path is not null and verdict in ('allow', 'block')")
    rules = rules.groupBy(lower_ascii(F.col("rule_host")).alias("rule_host"), "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    listed = rules.select(F.concat("rule_host", "rule_path").alias("rule"), F.concat_ws("\0", "rule_host", "rule_path").alias("key"), F.length("rule_host").alias("host_length"), "rule_verdict")
    n_rules, most_labels = rules.select(F.count(F.lit(1)), F.coalesce(F.max(_labels(F.col("rule_host"))), F.lit(0))).first()
    lengths = rules.select(F.length("rule_path").alias("size")).distinct()

    out = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(_labels(F.col("host")), F.lit(most_labels))), lambda k: F.call_function("substring_index", "host", F.lit("."), -k))
    keys = out.select("host", "path").distinct().filter(F.col("host") != "").filter(F.lit(most_labels > 0)).select("host", "path", F.explode(suffixes).alias("suffix"))
    keys = _with_prefixes(keys, lengths)
    keys = keys.select("host", "path", F.concat_ws("\0", "suffix", "prefix").alias("key"))

    bloom, blocks = bloom_filter(listed, n_rules)
    possible = keys.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(bloom), "block")
    mask = _mask(F.col("key"))
    possible = possible.filter(F.col("bits").bitwiseAND(mask) == mask).select("host", "path", "key")
    exact = possible.join(F.broadcast(listed) if n_rules <= BROADCAST_RULES else listed, "key")
    best = exact.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("size"), "host_length", "rule", "rule_verdict")).alias("best"))
    return out.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))


def _rules_sql() -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


SQL = f"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {_rules_sql()}),
u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
k AS (SELECT *, row_number() OVER () AS n FROM u),
m AS (
  SELECT k.n, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY k.n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM k JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, m.rule, coalesce(m.rule_verdict, 'allow') AS verdict
FROM k LEFT JOIN m ON m.n = k.n AND m.place = 1
"""
