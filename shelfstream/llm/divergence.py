"""How the sources of a language differ in their terms.

Texts are counted with Arrow's kernels inside the tasks that read them: lower case, splitting
by a pattern, dictionary encoding and grouped counts, folded over the batches of a task into a
table of bounded size. Spark adds the partial counts up. The counts of the kept terms are then
dealt to columnar shards, a range of a language's terms against one or two blocks of its
sources, whose sums of divergences are added up in turn. All arithmetic is in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfstream.llm.common import keep, read_table

#: What lies between terms: ASCII characters other than letters.
BETWEEN_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
TOP_TERMS = 10
#: Probabilities are in parts of this.
ONE = 1_000_000_000

#: Bytes of text counted at a time; a longer document is one step of its own.
STEP_BYTES = 4 << 20
#: Rows of partial counts a task holds before it passes them on.
HELD_ROWS = 400_000
#: Terms and sources of a shard, in expectation.
SHARD_TERMS = 4_096
BLOCK_SOURCES = 256

_COUNTS = "lang string, source string, term string, n long, docs long"
_ARROW = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
    ("n", pa.int64()), ("docs", pa.int64()),
])
_GROUP = ["lang", "source", "term"]


# -- counting -------------------------------------------------------------------


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``STEP_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    step = np.cumsum(sizes, dtype=np.int64) // STEP_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            # A copy: the kernel for lower case misreads the offsets of a slice.
            yield batch.take(pa.array(np.arange(a, b)))


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a batch of texts; each group also has a row without a term.

    ``n`` counts occurrences, ``docs`` the texts with the term.
    """
    text = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    parts = pc.split_pattern_regex(pc.ascii_lower(text), pattern=BETWEEN_TERMS)
    doc, word = pc.list_parent_indices(parts), parts.flatten()
    some = pc.not_equal(word, "")
    word = word.filter(some).dictionary_encode()
    each = pa.table({"doc": doc.filter(some), "word": word.indices})
    per_doc = each.group_by(["doc", "word"]).aggregate([([], "count_all")])

    # Languages and sources as one number, so that grouping compares numbers only.
    langs, sources = (
        pc.fill_null(batch.column(c), "").dictionary_encode() for c in ("lang", "source")
    )
    places = max(1, len(sources.dictionary))
    group = langs.indices.to_numpy().astype(np.int64) * places + sources.indices.to_numpy()
    docs = per_doc.column("doc").to_numpy()
    counted = pa.table({
        "group": group[docs], "word": per_doc.column("word"), "n": per_doc.column("count_all"),
    }).group_by(["group", "word"]).aggregate([("n", "sum"), ("n", "count")])

    def named(groups: np.ndarray, terms: pa.Array, n, docs) -> pa.Table:
        lang = langs.dictionary.take(pa.array(groups // places))
        source = sources.dictionary.take(pa.array(groups % places))
        return pa.table([lang, source, terms, n, docs], names=_ARROW.names).cast(_ARROW)

    bare = np.unique(group)
    zero = pa.array(np.zeros(len(bare), dtype=np.int64))
    terms = word.dictionary.take(counted.column("word").combine_chunks())
    return pa.concat_tables([
        named(bare, pa.nulls(len(bare), pa.string()), zero, zero),
        named(counted.column("group").to_numpy(), terms, counted.column("n_sum"), counted.column("n_count")),
    ])


def _folded(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(_GROUP).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.rename_columns(["lang", "source", "term", "n", "docs"]).select(_ARROW.names)


def term_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, n, sources) of each language's terms in at least ``min_docs`` texts.

    ``sources`` lists each source with the term and its count. A row with a NULL term lists all
    sources of the language. Partial counts are shuffled once, by language and term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, least = [], 0, 0
        for batch in batches:
            for step in _steps(batch):
                held.append(count_terms(step))
                rows += held[-1].num_rows
                if rows > max(HELD_ROWS, 2 * least):
                    held = [_folded(held)]
                    rows = least = held[0].num_rows
                    if rows > HELD_ROWS:
                        yield from held[0].to_batches()
                        held, rows, least = [], 0, 0
        if held:
            yield from _folded(held).to_batches()

    plain = docs.select(*[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")])
    return (
        plain.mapInArrow(run, _COUNTS)
        .repartition("lang", "term")
        .groupBy(*_GROUP).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs"),
            F.collect_list(F.struct("source", "n")).alias("sources"),
        )
        .filter((F.col("docs") >= min_docs) | F.col("term").isNull())
        .drop("docs")
    )


# -- divergences ----------------------------------------------------------------


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(ONE * (count + 2) / (total + 2 * terms)), without a product beyond 63 bits.

    Long division in base 1000; exact for totals up to 9e15.
    """
    below = np.asarray(total + 2 * terms, dtype=np.int64)
    whole, rest = np.divmod(count + 2, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digit
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_FOUND = "lang string, source string, part string, item string, value long"


def _shard(sources: pa.Table, counts: pa.Table) -> Iterator[tuple[str, list, list, list]]:
    """(part, source, item, value): sums over this shard's terms, and the best terms of each source.

    A row of shares per source, a column per term in the order of the terms' bytes.
    """
    names = sources.column("source").to_pylist()
    block = sources.column("block").to_numpy()
    totals = sources.column("total").to_numpy()
    of_lang, kept, i, j = (sources.column(c)[0].as_py() for c in ("of_lang", "kept", "i", "j"))
    counts = counts.sort_by("term").combine_chunks()
    terms = counts.column("term").combine_chunks()
    row_of = {name: k for k, name in enumerate(names)}
    matrix = np.zeros((len(names), len(terms)), dtype=np.int64)
    for lists in counts.column("sources").chunks:
        term, own = pc.list_parent_indices(lists).to_numpy(), lists.flatten()
        own_names = own.field("source").dictionary_encode()
        at = np.array([row_of[x] for x in own_names.dictionary.to_pylist()], dtype=np.int64)
        matrix[at[own_names.indices.to_numpy()], term] = own.field("n").to_numpy()
    p = shares(matrix, totals[:, None], kept) if len(terms) else matrix

    for k in np.flatnonzero(block == i).tolist():
        others = np.flatnonzero(block == j)
        others = others[others > k] if i == j else others
        if not len(others):
            continue
        sums = divergence(p[others], p[k]).sum(axis=1).tolist()
        their = [names[x] for x in others.tolist()]
        yield "pair", [names[k]] * len(their), their, sums
        yield "pair", their, [names[k]] * len(their), sums
    if i == j and len(terms):
        q = shares(counts.column("n").to_numpy(), np.int64(of_lang), kept)
        for k, name in enumerate(names):
            place = np.flatnonzero((matrix[k] > 0) & (p[k] > q))
            value = divergence(p[k, place], q[place])
            best = np.argsort(-value, kind="stable")[:TOP_TERMS]
            yield "term", [name] * len(best), terms.take(pa.array(place[best])).to_pylist(), value[best].tolist()


def source_divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank for each group (lang, source) of ``docs``.

    A term is a run of ASCII letters and characters beyond ASCII, with A-Z in lower case. Each
    language keeps the terms in at least ``min_docs`` of its documents. Part ``pair`` compares
    a source with each other source of its language over all kept terms, part ``term`` lists
    the ``top_terms`` (``TOP_TERMS`` at most) terms a source uses most beyond its language.
    Ranks go by falling value, then by the item's bytes.

    NULL text, language and source are read as empty ones; a group whose texts have no term
    counts as any other; a language with one source has no pairs, one without kept terms has
    pairs of value 0. Very long texts are counted whole, one at a time. Repeated rows count
    repeatedly, other columns are ignored, and no rows give no rows.
    """
    if not 1 <= top_terms <= TOP_TERMS:
        raise ValueError(f"top_terms from 1 to {TOP_TERMS}")
    counts = keep(term_counts(docs, min_docs), "term-counts")
    kept = counts.filter("term IS NOT NULL")
    named = lambda df: df.select("lang", F.inline("sources"))
    groups = named(counts.filter("term IS NULL")).drop("n")
    totals = named(kept).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per language: how much there is of it, and how it is cut. Stored, so that its size is
    # known and Spark broadcasts it if it is small, in place of dealing the terms out by language.
    langs = keep(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        kept.groupBy("lang").agg(F.sum("n").alias("of_lang"), F.count(F.lit(1)).alias("kept")),
        "lang", "left",
    ).na.fill(0, ["of_lang", "kept"]).withColumns({
        "shards": F.greatest(F.ceil(F.col("kept") / SHARD_TERMS), F.lit(1)),
        "blocks": F.ceil(F.col("sources") / BLOCK_SOURCES),
    }).drop("sources"), "languages")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    block_of = lambda source: F.pmod(F.xxhash64(source), F.col("blocks"))
    # A shard holds sources of block i and of block j, i <= j.
    in_blocks = groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
    sources = keep(
        in_blocks.withColumn("block", block_of("source")).withColumn("other", F.explode(upto("blocks")))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .select("lang", "i", "j", F.explode(upto("shards")).alias("shard"), "source", "block", "total",
                "of_lang", "kept"),
        "sources",
    )
    here = lambda s: block_of(s["source"]).isin(F.col("i"), F.col("j"))
    dealt = (
        kept.join(langs.select("lang", "shards", "blocks"), "lang").withColumn("i", F.explode(upto("blocks")))
        .withColumn("j", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)))
        .select("lang", "i", "j", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"),
                "term", "n", F.filter("sources", here).alias("sources"))
    )

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"part": [], "source": [], "item": [], "value": []}, schema=pa.schema(
            [(c, pa.string()) for c in ("part", "source", "item")] + [("value", pa.int64())]
        ))
        if not left.num_rows:
            return empty.append_column("lang", pa.array([], pa.string())).select(_FOUND_NAMES)
        out = [empty] + [
            pa.table({"part": pa.array([part] * len(source), pa.string()), "source": source, "item": item,
                      "value": value}, schema=empty.schema)
            for part, source, item, value in _shard(left, right)
        ]
        found = pa.concat_tables(out)
        return found.append_column("lang", pa.array([key[0].as_py()] * found.num_rows, pa.string())).select(
            _FOUND_NAMES
        )

    tile = ["lang", "i", "j", "shard"]
    found = sources.groupBy(*tile).cogroup(dealt.groupBy(*tile)).applyInArrow(run, _FOUND)
    summed = keep(
        found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")), "divergences"
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    of_part = lambda part: summed.filter(F.col("part") == part).withColumn("rank", F.row_number().over(order))
    # Apart, so that the terms beyond the last rank go before they are shuffled.
    return of_part("pair").unionByName(of_part("term").filter(F.col("rank") <= top_terms))


_FOUND_NAMES = [f.split()[0] for f in _FOUND.split(", ")]


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and its own terms."""
    return source_divergences(read_table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (SELECT doc, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
counted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source),
of_source AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + {ONE}::hugeint * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * s.v) AS p
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
of_lang AS (SELECT lang, term, 1 + {ONE}::hugeint * (sum(n) + 2)
    // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q
  FROM counted JOIN sizes USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS f
      FROM of_source x JOIN of_source y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) z
    ON z.lang = a.lang AND z.source = a.source AND z.other = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM of_source JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part
    ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, cast(value AS bigint) AS value, cast(rank AS int) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
