"""Addresses judged by rules and by a list of addresses, through a blocked Bloom filter.

What is listed goes into a Bloom filter whose keys each touch one block of 512 bits. The
filter is built by a grouped ``bit_or`` and has a size bound of its own, so it is broadcast
whatever the list's size. What it lets pass is joined with the list itself, by value, which
removes false positives; the rest of the table is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import keep, read_table

#: (host, path, verdict) of the query's rules.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Words whose hosts the query lists; a user's own list goes in their place.
UNWANTED = ["ads", "adult", "bets", "casino", "pills", "poker", "porn", "spam", "xxx"]

WORDS = 8
_WORD_BITS = 64
BLOCK_BITS = WORDS * _WORD_BITS
BITS_PER_KEY = 16
#: 64 MB. Beyond 33 million keys the filter stops growing and lets more candidates pass to the join.
MAX_BLOCKS = 1 << 20
_LOW = (1 << 32) - 1
#: An odd multiplier for each word of a block: powers of one number, below 2^31.
_SALTS = [pow(0x9E3779B1, k + 1, 1 << 31) | 1 for k in range(WORDS)]

PREFIX, EXACT = 0, 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of an address; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    part = lambda n: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", n), F.lit(""))
    return lower_ascii(part(1)), part(2)


def canonical_path(path: Column) -> Column:
    return F.rtrim(path, F.lit("/"))


def _key(host: Column, path: Column, kind: Column) -> Column:
    return F.xxhash64(host, path, kind.cast("int"))


# -- the filter -----------------------------------------------------------------


def _block_and_masks(h: Column, blocks: int) -> list[Column]:
    high, low = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_LOW))
    block = F.shiftrightunsigned(high * F.lit(blocks), 32)
    places = [F.shiftright((low * F.lit(s)).bitwiseAND(F.lit(_LOW)), 26) for s in _SALTS]
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, p.cast("int")).alias(f"w{k}") for k, p in enumerate(places)]
    return [block.alias("block"), *masks]


def build_filter(keys: DataFrame, n: int) -> np.ndarray:
    """The filter's words, one row per block, for about ``n`` hashes in column ``h``.

    At most ``MAX_BLOCKS`` rows reach the driver, however many keys there are.
    """
    blocks = min(MAX_BLOCKS, max(1, -(-n * BITS_PER_KEY // BLOCK_BITS)))
    words = np.zeros((blocks, WORDS), dtype=np.uint64)
    names = [f"w{k}" for k in range(WORDS)]
    rows = (
        keys.select(*_block_and_masks(F.col("h"), blocks))
        .groupBy("block").agg(*[F.bit_or(w).alias(w) for w in names])
        .toArrow()
    )
    at = rows.column("block").to_numpy()
    for k, name in enumerate(names):
        words[at, k] = rows.column(name).to_numpy().view(np.uint64)
    return words


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each hash; always true for those it was built with."""
    h = hashes.view(np.uint64)
    low = h & np.uint64(_LOW)
    block = ((h >> np.uint64(32)) * np.uint64(len(words))) >> np.uint64(32)
    found = np.ones(len(h), dtype=bool)
    for k, salt in enumerate(_SALTS):
        place = ((low * np.uint64(salt)) & np.uint64(_LOW)) >> np.uint64(26)
        found &= (words[block, k] >> place) & np.uint64(1) == 1
    return found


# -- judging --------------------------------------------------------------------


def _listed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules and addresses as one list (r_host, r_path, kind, block), each key once."""
    host, path = host_and_path(F.col("url"))
    exact = urls.select(
        host.alias("r_host"), canonical_path(path).alias("r_path"), F.lit(EXACT).alias("kind"),
        F.lit(True).alias("block"),
    )
    prefix = rules.select(
        lower_ascii(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"),
        F.lit(PREFIX).alias("kind"), (F.col("verdict") == "block").alias("block"),
    )
    return (
        prefix.unionByName(exact).filter("r_host != ''")
        .groupBy("r_host", "r_path", "kind").agg(F.max("block").alias("block"))
    )


def _candidates(lengths: list[tuple[int, int]]) -> Column:
    """What of the list may apply to (host, path): NULLs, prefixes by their lengths, the address."""
    host, path = F.col("host"), F.col("path")
    entry = lambda h, p, kind: F.struct(
        h.alias("r_host"), p.alias("r_path"), F.lit(kind).alias("kind")
    )
    found = []
    for of_host, of_path in lengths:
        more = F.length(host) - of_host
        border = (more == 0) | ((more > 0) & (F.substring(host, more, F.lit(1)) == "."))
        fits = border & (F.length(path) >= of_path)
        found.append(F.when(fits, entry(F.right(host, F.lit(of_host)), F.left(path, F.lit(of_path)), PREFIX)))
    found.append(F.when(host != "", entry(host, canonical_path(path), EXACT)))
    return F.array(*found)


def _probe(pages: DataFrame, words: np.ndarray) -> DataFrame:
    """``pages`` with ``possible``, the places in ``hashes`` that the filter lets pass."""
    shared = pages.sparkSession.sparkContext.broadcast(words)
    schema = pages.drop("hashes").withColumn("possible", F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hashes")
            flat = hashes.flatten()
            of, width = np.arange(len(hashes)), len(flat) // max(1, len(hashes))
            hit = np.zeros(len(flat), dtype=bool)
            valid = flat.is_valid().to_numpy(zero_copy_only=False)
            hit[valid] = passes(shared.value, flat.drop_null().to_numpy(zero_copy_only=False))
            row, place = np.repeat(of, width)[hit], np.tile(np.arange(width), len(of))[hit]
            offsets = np.searchsorted(row, np.arange(len(of) + 1))
            possible = pa.ListArray.from_arrays(offsets.astype(np.int32), place.astype(np.int32))
            kept = batch.drop_columns(["hashes"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, possible], [*kept.schema.names, "possible"]
            )

    return pages.mapInArrow(run, schema)


def judge_urls(
    pages: DataFrame, rules: DataFrame, urls: DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, listed, verdict.

    ``rules`` has host, path and verdict (allow or block), ``urls`` the column ``url``. A rule
    fits its host and all its subdomains where the path begins with the rule's; the longest
    decides, of two equal ones the one that blocks, and ``rule`` names it. Where no rule fits,
    addresses of ``urls`` are blocked and all others allowed. Addresses are the same if host
    and path are, but for slashes at the end of the path; scheme, query and fragment do not
    count. ``listed`` tells whether an address is in ``urls``, whatever the rules say.

    A NULL address, or one without ``://``, has an empty host and path, no rule, and is allowed.
    Lists may be empty; entries with a NULL or empty host are ignored. Very long addresses are
    read whole. Repeated rows stay repeated, other columns of ``pages`` are ignored, and no
    pages give no rows.

    The lengths of host and path that occur among the rules are collected: a few numbers for
    each different pair of lengths.
    """
    listed = keep(_listed(rules, urls), "listed")
    lengths = sorted(
        tuple(r) for r in listed.filter(F.col("kind") == PREFIX)
        .select(F.length("r_host"), F.length("r_path")).distinct().collect()
    )
    entries = _candidates(lengths)
    words = build_filter(
        listed.select(_key(F.col("r_host"), F.col("r_path"), F.col("kind")).alias("h")), listed.count()
    )
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    hashes = F.transform(entries, lambda e: F.when(e.isNotNull(), _key(e["r_host"], e["r_path"], e["kind"])))
    # Numbered and stored: candidates of one row find each other again, whatever runs twice.
    probed = keep(
        _probe(split.withColumn("hashes", hashes), words)
        .withColumn("row", F.monotonically_increasing_id()),
        "probed",
    )
    own = ["row", "page_id", "host", "path"]
    possible = probed.filter(F.size("possible") > 0).select(*own, F.explode("possible").alias("at"))
    entry = F.get(entries, F.col("at"))
    found = (
        possible.withColumn("entry", entry).select(*own, "entry.*")
        .join(listed, ["r_host", "r_path", "kind"], "left")
    )
    rule = F.concat("r_host", "r_path")
    is_rule = F.col("block").isNotNull() & (F.col("kind") == PREFIX)
    best = F.max(F.when(is_rule, F.struct(
        F.length(rule).alias("length"), F.length("r_host").alias("of_host"), rule.alias("rule"), "block"
    )))
    is_listed = F.max(F.col("block").isNotNull() & (F.col("kind") == EXACT))
    judged = found.groupBy(*own).agg(best.alias("best"), is_listed.alias("listed"))
    verdict = F.when(F.coalesce(F.col("best.block"), F.col("listed")), "block").otherwise("allow")
    none = F.lit(None).cast("string")
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), "listed", verdict.alias("verdict")
    ).unionByName(
        probed.filter(F.size("possible") == 0).select(
            "page_id", "host", "path", none.alias("rule"), F.lit(False).alias("listed"),
            F.lit("allow").alias("verdict"),
        )
    )


def mirror_urls(pages: DataFrame) -> DataFrame:
    """Addresses (``url``) whose page is a whole copy of one with a smaller page_id elsewhere.

    Pages without text, address or id list nothing. Copies are reduced to one row per digest
    and address before the digests are shuffled; a digest with very many addresses is split by
    adaptive execution in the join.
    """
    host, path = host_and_path(F.col("url"))
    places = (
        pages.filter("html != '' AND page_id IS NOT NULL")
        .select(F.md5("html").alias("digest"), "page_id", host.alias("host"), canonical_path(path).alias("path"))
        .filter("host != ''")
        .groupBy("digest", "host", "path").agg(F.min("page_id").alias("page_id"))
    )
    first = places.groupBy("digest").agg(F.min(F.struct("page_id", "host", "path")).alias("first"))
    elsewhere = (F.col("host") != F.col("first.host")) | (F.col("path") != F.col("first.path"))
    return (
        places.join(first, "digest").filter(elsewhere)
        .select(F.concat(F.lit("http://"), "host", "path").alias("url")).distinct()
    )


def unwanted_urls(pages: DataFrame, words: list[str]) -> DataFrame:
    """Addresses (``url``) with one of ``words`` as a part of the host between dots and hyphens."""
    host, path = host_and_path(F.col("url"))
    return (
        pages.select(host.alias("host"), canonical_path(path).alias("path"))
        .filter(F.col("host").rlike(_word_in_host(words)))
        .select(F.concat(F.lit("http://"), "host", "path").alias("url")).distinct()
    )


def _word_in_host(words: list[str]) -> str:
    return f"(^|[.-])({'|'.join(words)})([.-]|$)"


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address judged; listed are mirrors and hosts with unwanted words."""
    pages = read_table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = mirror_urls(pages).unionByName(unwanted_urls(pages, UNWANTED))
    return judge_urls(pages, rules, listed)


OP11_SQL = f"""
WITH rests AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, html,
    translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
addressed AS (SELECT *, concat(host, rtrim(path, '/')) AS address FROM split),
origins AS (SELECT address, first_value(address) OVER (PARTITION BY html ORDER BY page_id, address)
    AS origin FROM addressed WHERE html <> '' AND host <> '' AND page_id IS NOT NULL),
listed AS (SELECT address FROM origins WHERE address <> origin UNION
  SELECT address FROM addressed WHERE regexp_matches(host, '{_word_in_host(UNWANTED)}')),
rules AS (SELECT * FROM (VALUES
    {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}) AS t(r_host, r_path, r_verdict)),
fitting AS (SELECT a.*, r.*, row_number() OVER (PARTITION BY page_id
      ORDER BY length(r_host) + length(r_path) DESC) AS place
    FROM addressed a LEFT JOIN rules r
      ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, r_host || r_path AS rule, listed.address IS NOT NULL AS listed,
  coalesce(r_verdict, CASE WHEN listed.address IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM fitting LEFT JOIN listed ON listed.address = fitting.address AND host <> '' WHERE place = 1
"""
