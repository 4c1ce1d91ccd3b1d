"""URL filter: a blocked Bloom filter of the listed canonical URLs in front of an exact hash join.

A listed URL is a rule: host (lower case, a domain that also stands for its subdomains), path prefix, and verdict.
A page's candidates are its host's suffixes at dots, as long as the longest listed host, each with the path's prefixes
of the listed lengths. A candidate picks one block of eight 32-bit words and one bit in each word, so that a probe
reads one row of a table of at most ``MAX_BLOCKS`` rows; what passes is joined exactly on host and path prefix,
which removes the false positives. The longest rule (host and path together, then host) wins; a page without a
rule is allowed.

Defined results: a null URL, or one without ``://``, has an empty host and path; equal rows are each judged; a
rule listed twice counts once, with verdict block if either says so; an empty list allows everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
WORDS, KEYS_A_BLOCK, MAX_BLOCKS = 8, 16, 1 << 17
#: A rule list of at most this many rows is broadcast to the exact join; a longer one is joined by shuffle.
BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url) -> tuple:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def _probe(host, path, blocks: int) -> list:
    """The block of a key, and its bit in each word of the block."""
    bits = F.xxhash64(host, path)
    return [F.pmod(F.xxhash64(path, host), F.lit(blocks)).alias("block"),
            *[F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * j).bitwiseAND(F.lit(31)).cast("int")).alias(f"m{j}")
              for j in range(WORDS)]]


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages`` (page_id, url), by ``rules`` (host, path, verdict)."""
    rules = (rules.select(F.translate("host", _UPPER, _LOWER).alias("rhost"), F.col("path").alias("rpath"), "verdict")
             .where("rhost is not null and rpath is not null and verdict is not null")
             .groupBy("rhost", "rpath").agg(F.max("verdict").alias("verdict")))
    n = rules.count()
    host, path = host_and_path(F.col("url").cast("string"))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    if not n:
        return base.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    labels = rules.agg(F.max(F.size(F.split("rhost", "\\.")))).first()[0]
    lengths = sorted(r[0] for r in rules.select(F.length("rpath")).distinct().collect())  # at most a URL's length of them
    blocks = 1
    while blocks < min(n / KEYS_A_BLOCK, MAX_BLOCKS):
        blocks <<= 1
    sieve = (rules.select(*_probe(F.col("rhost"), F.col("rpath"), blocks)).groupBy("block")
             .agg(*[F.bit_or(f"m{j}").alias(f"w{j}") for j in range(WORDS)]))
    last = F.reverse(F.split("host", "\\.", -1))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(last), F.lit(labels))),
                           lambda i: F.array_join(F.reverse(F.slice(last, F.lit(1), i)), "."))
    prefixes = F.array_distinct(F.transform(F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: x <= F.length("path")),
                                            lambda x: F.substring(F.col("path"), F.lit(1), x)))
    cand = base.select("*", F.explode(suffixes).alias("rhost")).select("*", F.explode(prefixes).alias("rpath"))
    cand = cand.select("*", *_probe(F.col("rhost"), F.col("rpath"), blocks)).join(F.broadcast(sieve), "block")
    for j in range(WORDS):
        cand = cand.where(F.col(f"w{j}").bitwiseAND(F.col(f"m{j}")) != 0)
    listed = F.broadcast(rules) if n <= BROADCAST_RULES else rules
    hit = cand.select("page_id", "host", "path", "rhost", "rpath").join(listed, ["rhost", "rpath"])
    fit = F.struct(F.length(F.concat("rhost", "rpath")).alias("size"), F.length("rhost").alias("host_size"),
                   F.concat("rhost", "rpath").alias("rule"), "verdict")
    rows = base.select("*", F.lit(1).alias("page"), F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>").alias("fit")) \
        .unionByName(hit.select("page_id", "host", "path", F.lit(0).alias("page"), fit.alias("fit")))
    best = rows.groupBy("page_id", "host", "path").agg(F.sum("page").alias("times"), F.max("fit").alias("fit"))
    return best.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit("allow")).alias("verdict"),
                       F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")


ORACLE = r"""
WITH rules(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
r AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
h AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(v, length(rhost || rpath)) AS verdict
      FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN h USING (rid)
"""
