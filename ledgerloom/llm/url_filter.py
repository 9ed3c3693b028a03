"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

Listed are rules (a host with its subdomains, and a path prefix) and whole canonical URLs.
Both become keys. A URL has few keys that could be listed: its canonical form, and each
ending of its host at a dot with each prefix of its path of a listed length. The filter
drops nearly all keys that are not listed without moving a row; the join by key removes
what it let through wrongly.

The filter is a table of 512-bit blocks, one bit in each of eight words per key. It has at
most ``max_blocks`` rows whatever the list's size, so it can be broadcast; a longer list
only lets more wrong keys through to the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import pick

# The rules as the contract states them: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Query parameters that do not change a page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
WORDS = 8
KEYS_PER_BLOCK = 40


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one, or for a null."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(url: Column) -> Column:
    """Host, path without slashes at its end, and sorted query without tracking parameters.

    Null for a URL without a host.
    """
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(
        F.split(query, "&"), lambda p: (F.length(p) > 0) & ~F.coalesce(p.rlike(TRACKING), F.lit(False))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&")))
    whole = F.concat(
        host_of(url),
        F.regexp_replace(path_of(url), "/+$", ""),
        F.coalesce(tail, F.lit("")),
    )
    return F.when(host_of(url) != "", whole)


def _bits(key: Column) -> list[Column]:
    """One bit of each word of a block, from a hash that is not the block's."""
    bits = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("bigint")
    return [
        F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 6 * w).bitwiseAND(63).cast("int"))
        for w in range(WORDS)
    ]


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of all keys: at most ``blocks`` rows."""
    words = [F.bit_or(bit).alias(f"w{w}") for w, bit in enumerate(_bits(F.col("key")))]
    return keys.groupBy(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")).agg(*words)


def may_contain(rows: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose ``key`` the filter does not rule out."""
    near = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    bits = _bits(F.col("key"))
    passes = [F.col(f"w{w}").bitwiseAND(bit) == bit for w, bit in enumerate(bits)]
    joined = near.join(F.broadcast(bloom), "block").where(reduce(and_, passes))
    return joined.select(*rows.columns)


def judge(
    pages: DataFrame,
    listed: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    max_blocks: int = 1 << 17,
) -> DataFrame:
    """Judge the url of every page (page_id, url).

    One row per row of ``pages``: page_id, host, path, rule (the longest that fits, else
    null), listed (the canonical URL is one of ``listed.url``), verdict: the rule's, else
    block for listed URLs and allow for others.

    A url that is null or has no ``://`` has an empty host and path and fits nothing.
    Repeated rows are judged each. Of rules of one length, that with the longer host wins;
    hosts, and of one host and path the verdicts, must not repeat.
    """
    spark = pages.sparkSession
    pages = pick(pages, ("page_id", "bigint"), ("url", "string"))
    given = [(f"rule {h}{p}", f"{h}{p}", len(h) + len(p), len(h), v) for h, p, v in rules]
    entries = spark.createDataFrame(
        given, "key string, rule string, chars int, host_chars int, verdict string"
    )
    if listed is not None:
        whole = listed.select(canonical(listed["url"].cast("string")).alias("url"))
        whole = whole.where("url IS NOT NULL").distinct()
        entries = entries.unionByName(
            whole.select(F.concat(F.lit("url "), F.col("url")).alias("key")),
            allowMissingColumns=True,
        )

    labels = max([h.count(".") + 1 for h, _, _ in rules], default=0)
    lengths = sorted({len(p) for _, p, _ in rules})
    url = F.col("url")
    parts = F.split(host_of(url), r"\.")
    ends = [
        F.when(F.size(parts) >= n, F.array_join(F.slice(parts, F.greatest(F.size(parts) - (n - 1), F.lit(1)), n), "."))
        for n in range(1, labels + 1)
    ]
    starts = [F.when(F.length(path_of(url)) >= n, path_of(url).substr(1, n)) for n in lengths]
    keys = [F.concat(F.lit("rule "), end, start) for end in ends for start in starts]
    keys.append(F.concat(F.lit("url "), canonical(url)))
    probes = (
        pages.select("url")
        .where(F.instr(url, "://") > 0)
        .distinct()
        .select("url", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    )

    count = entries.count()
    blocks = min(max_blocks, 1 << max(0, (count // KEYS_PER_BLOCK).bit_length()))
    bloom = blocked_bloom(entries.select("key"), blocks)
    hits = may_contain(probes, bloom, blocks).join(entries, "key")
    best = F.max(
        F.when(F.col("rule").isNotNull(), F.struct("chars", "host_chars", "rule", "verdict"))
    )
    found = hits.groupBy("url").agg(
        best.alias("_best"), F.bool_or(F.col("rule").isNull()).alias("_listed")
    )
    is_listed = F.coalesce("_listed", F.lit(False))
    method = F.when(is_listed, "block").otherwise("allow")
    return pages.join(found, "url", "left").select(
        "page_id",
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), method).alias("verdict"),
        is_listed.alias("listed"),
    )


def repeated_urls(pages: DataFrame) -> DataFrame:
    """The canonical URLs that several pages have, as a list of urls."""
    urls = pages.select(canonical(pages["url"].cast("string")).alias("canonical"))
    often = urls.groupBy("canonical").agg(F.count("*").alias("n")).where("n > 1")
    return often.where("canonical IS NOT NULL").select(
        F.concat(F.lit("http://"), F.col("canonical")).alias("url")
    )
