"""What the driver's entry offers of this subpackage."""

from __future__ import annotations

import ast
import re
from pathlib import Path

import corpus_pipeline

import __spark_entry__ as contract

ROOT = Path(__file__).resolve().parents[2]


def test_one_query_per_operator_and_the_pipeline():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert "op4_warc" in contract.oracle_sql() and "pipeline" not in contract.oracle_sql()


def test_stages_in_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "language", "near_duplicates", "pii", "packing"
    ]


def test_nothing_outside_imports_the_subpackage():
    for file in (ROOT / "shelfstream").rglob("*.py"):
        if "llm" in file.parts:
            continue
        for node in ast.walk(ast.parse(file.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else (
                [a.name for a in node.names] if isinstance(node, ast.Import) else []
            )
            assert not any(".llm" in n or n == "corpus_pipeline" for n in names), file
