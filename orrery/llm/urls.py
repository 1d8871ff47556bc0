"""URL rules and blocklists: a blocked Bloom filter of the listed canonical
keys passes possible hits to an exact hash join that removes false positives.

A listed key is a host joined with the beginning of a path, such as
``example.com/en/``. It fits its host and all subdomains if the URL's path
begins with the rule's path. The longest fitting key wins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, mix64, written

_WORDS = 8  # one block: 8 words of 64 bits
_PROBES = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block_and_mask(h: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of every hash and the (n, 8) words whose bits it sets: one bit in each word."""
    u = h.astype(np.int64).view(np.uint64)
    block = ((u >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)
    salt = mix64(np.arange(1, _PROBES + 1)) | np.uint64(1)
    bit = ((u & np.uint64(0xFFFFFFFF))[:, None] * salt[None, :]) >> np.uint64(58)
    return block.astype(np.int64), np.uint64(1) << bit


def build_filter(keys: DataFrame, bits_per_key: int = 16, most_bytes: int = 64 << 20) -> np.ndarray:
    """(key) -> the filter's words, (blocks, 8) of 64 bits.

    Tasks set the bits of their own keys by block; the blocks are or-ed in a
    group-by. The filter has ``bits_per_key`` bits a key and ``most_bytes`` at
    most, whatever the list's length: that bounds what the driver gathers and
    broadcasts. A longer list lets more false positives through to the exact join.
    """
    n = keys.count()
    n_blocks = int(max(1, min(most_bytes // (8 * _WORDS), -(-n * bits_per_key // (64 * _WORDS)))))

    def bits(batches):
        for b in batches:
            block, mask = _block_and_mask(b["h"].to_numpy(), n_blocks)
            u, inv = np.unique(block, return_inverse=True)
            words = np.zeros((len(u), _WORDS), np.uint64)
            np.bitwise_or.at(words, inv, mask)
            out = pd.DataFrame({"block": u})
            for j in range(_WORDS):
                out[f"w{j}"] = words[:, j].view(np.int64)
            yield out

    schema = "block long, " + ", ".join(f"w{j} long" for j in range(_WORDS))
    rows = (keys.select(F.xxhash64("key").alias("h")).mapInPandas(bits, schema)
            .groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(_WORDS)]).toPandas())
    words = np.zeros((n_blocks, _WORDS), np.uint64)
    if len(rows):
        words[rows["block"].to_numpy()] = rows[[f"w{j}" for j in range(_WORDS)]].to_numpy(np.int64).view(np.uint64)
    return words


def possible(spark, words: np.ndarray):
    """Column test: may the key with this xxhash64 be in the filter?"""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        w = shared.value
        block, mask = _block_and_mask(h.to_numpy(), len(w))
        return pd.Series(((w[block] & mask) == mask).all(axis=1))
    return test


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Adds host, path, rule (the longest fitting key or null) and verdict,
    in place of columns of these names.

    ``urls``: any table with a ``url`` column and a unique ``page_id``;
    ``rules``: (rule, host, path, verdict). A URL that no rule fits is allowed.
    Null URLs and URLs without ``://`` have empty host and path and fit no
    rule. Repeated URLs are judged once; a rule listed twice with different
    verdicts blocks. No rules: everything is allowed; no URLs give no rows.
    """
    urls = urls.drop("host", "path", "rule", "verdict", "rule_verdict")
    rules = written(rules.filter(F.col("host") != "").withColumn("key", F.concat("host", "path")).groupBy("key").agg(
        F.max("verdict").alias("verdict"), F.first("path").alias("rule_path")), "url-rules")
    # The distinct lengths of listed paths: no more than a URL has places.
    lengths = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect()]
    parsed = urls.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    distinct = written(parsed.select("host", "path").distinct(), "url-hosts")
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    keyed = distinct.select("host", "path", F.explode(F.array_distinct(hosts)).alias("suffix"))
    paths = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)]) if lengths else F.array().cast("array<string>")
    keyed = keyed.select("host", "path", "suffix", F.explode(paths).alias("prefix")).filter("prefix is not null and suffix <> ''")
    keyed = keyed.withColumn("key", F.concat("suffix", "prefix"))
    maybe = keyed.filter(possible(urls.sparkSession, build_filter(rules.select("key")))(F.xxhash64("key")))
    # A possible hit names one split of the key into host and path; the rule's own split must agree.
    hits = maybe.alias("m").join(rules.alias("r"), (F.col("m.key") == F.col("r.key")) & (F.col("m.prefix") == F.col("r.rule_path")))
    best = hits.groupBy("m.host", "m.path").agg(
        F.max(F.struct(F.length("r.key").alias("n"), F.col("r.key").alias("key"), F.col("r.verdict").alias("verdict"))).alias("best"))
    best = best.select("host", "path", F.col("best.key").alias("rule"), F.col("best.verdict").alias("rule_verdict"))
    out = parsed.join(best, ["host", "path"], "left")
    return out.withColumn("verdict", F.coalesce("rule_verdict", F.lit("allow"))).drop("rule_verdict")


# The rules of the query (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op8(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    rules = spark.createDataFrame(list(RULES), "verdict string, host string, path string")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return match_rules(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
WITH p AS (
  SELECT page_id, translate(CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1) ELSE '' END,
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(verdict, h, q) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                            ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (
  SELECT p.page_id, p.host, p.path, r.h || r.q AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.h || r.q) DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.q))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1"""
