"""Near copies never share a sequence."""

from __future__ import annotations

from collections import defaultdict

from shelfstream.llm.packing import op10_packing
from shelfstream.llm.simhash import op2_simhash


def test_near_copies_are_kept_apart(spark, tmp_path):
    words = [f"word{i * 7919 % 1000}" for i in range(400)]
    texts = [" ".join(words[:i] + ["changed"] + words[i + 1 :]) for i in (3, 90, 200, 310, 399)]
    rows = [(i, t, f"source{i}") for i, t in enumerate([*texts, "another text", None])]
    rows += [(None, texts[0], "source7"), (5, "another text of an equal id", "source8")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.component_id for r in op2_simhash(spark, str(tmp_path)).collect() if r.doc_id != 5}
    assert len({found[i] for i in range(5)}) < 5
    packed = op10_packing(spark, str(tmp_path)).collect()
    assert sorted(r.source for r in packed) == sorted(r[2] for r in rows)
    bins = defaultdict(list)
    for r in packed:
        bins[r.bin_id].append(r)
    for own in bins.values():
        near = [found[r.doc_id] for r in own if r.doc_id != 5]
        assert len(near) == len(set(near))
