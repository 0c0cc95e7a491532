"""Divergences of sources against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from check_oracle import connect, rows_of, rows_of_sql

from shelfstream.llm import divergence
from shelfstream.llm.divergence import OP13_SQL, count_terms, op13_divergence, shares, source_divergences

SCHEMA = "doc_id long, text string, lang string, source string, n long, docs string, part int, term string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text))


def _slow(rows, min_docs=10):
    docs, own, of_lang, groups = Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((t or "", x or "", s or "") for t, x, s in rows):
        terms = _terms(text)
        groups[lang].add(source)
        docs.update((lang, t) for t in set(terms))
        own[lang, source].update(terms)
        of_lang[lang].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t in of_lang[lang] if docs[lang, t] >= min_docs]

        def share(count, kept=kept):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        q = share(of_lang[lang])
        p = {s: share(own[lang, s]) for s in sources}
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(apart(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, apart(p[s][t], q[t])) for t in kept if own[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(ranked)]
    return sorted(out)


def _found(spark, rows, **options):
    table = spark.createDataFrame([(n, *r, 1, "x", 2, "y") for n, r in enumerate(rows)], SCHEMA)
    return source_divergences(table.repartition(3), **options)


def _rows(seed, n, sources, langs=2):
    rng = random.Random(seed)
    words = ["The", "the", "ÉTÉ", "été", "a1b", "x_y", "don't", "ß", "東京", "Z", "q" * 50, "\u0130", "e\u0301"]
    words += [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    text = lambda: "".join(rng.choice(words) + rng.choice(" .\n\t9-\x7f_`@[") for _ in range(rng.randint(0, 40)))
    return [(text(), f"l{rng.randrange(langs)}", f"s{min(rng.randrange(sources), rng.randrange(sources))}") for _ in range(n)]


EDGES = [
    (None, None, None), ("", "", ""), ("1 2 3", "l0", "bare"), (None, "l0", None), ("word", "l9", "alone"),
    ("word", None, "s0"), ("A " * 200_000, "l0", "long"), (" , ;", "l8", "p"), (None, "l8", "q"),
]


@pytest.mark.parametrize("terms, sources, step, held", [(4096, 256, 1 << 22, 400_000), (7, 2, 300, 5), (50, 3, 1, 100)])
def test_equals_plain_counting(spark, monkeypatch, terms, sources, step, held):
    monkeypatch.setattr(divergence, "SHARD_TERMS", terms)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", sources)
    monkeypatch.setattr(divergence, "STEP_BYTES", step)
    monkeypatch.setattr(divergence, "HELD_ROWS", held)
    rows = _rows(terms, 150, 7) + EDGES + [("same same", "l1", "s1")] * 30
    got = _found(spark, rows)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _slow(rows)


def test_another_least_number_of_documents(spark):
    rows = _rows(5, 60, 3)
    assert sorted(map(tuple, _found(spark, rows, min_docs=1).collect())) == _slow(rows, 1)


def test_no_rows_and_one_source(spark):
    assert _found(spark, []).collect() == []
    assert _found(spark, [("a b", "en", "s")]).collect() == []
    got = _found(spark, [("a", "en", "s"), ("b", "en", "t")]).collect()
    assert sorted(map(tuple, got)) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_of_counts_beyond_63_bits():
    counts = [0, 1, 10**9, 10**13, 8 * 10**15 - 3]
    total, terms = 8 * 10**15, 10**6
    want = [1 + 10**9 * (c + 2) // (total + 2 * terms) for c in counts]
    assert shares(np.array(counts), np.int64(total), terms).tolist() == want


def test_only_ascii_letters_change_case():
    batch = pa.RecordBatch.from_pydict({"text": ["ÄBC Äbc äbc", None], "lang": ["x", None], "source": ["s", "s"]})
    rows = {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in count_terms(batch).to_pylist()}
    assert rows == {("x", "s", None): (0, 0), ("", "s", None): (0, 0), ("x", "s", "Äbc"): (2, 1), ("x", "s", "äbc"): (1, 1)}


def test_steps_of_a_batch_hold_its_texts():
    texts = [None, "Ab" * 50_000, "é" * 30_000, "c D e" * 3] * 40
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["x"] * 160, "source": ["s"] * 160})
    steps = list(divergence._steps(batch.slice(3)))
    assert len(steps) > 1
    assert [t for s in steps for t in s.column("text").to_pylist()] == texts[3:]
    got = Counter()
    for r in divergence._folded([count_terms(s) for s in steps]).to_pylist():
        got[r["term"]] += r["n"]
    want = Counter(t for x in texts[3:] for t in _terms(x or ""))
    assert +got == want


def test_query_equals_sql(spark, sf_dir):
    assert rows_of(op13_divergence(spark, sf_dir)) == rows_of_sql(connect(sf_dir), OP13_SQL)
