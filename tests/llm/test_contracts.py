"""Every numbered query: columns and types of its contract, one row per row of its whole table, plain invariants."""

import re
import zlib

import pytest

from cohortline.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

LONG, TEXT, REAL, FLAG, INT = "bigint", "string", "double", "boolean", "int"
CONTRACTS = {
    "op1": ("documents", {"doc_id": LONG, "n_bytes": LONG, "n_removed": LONG, "n_spans": LONG, "kept_sha256": TEXT}),
    "op2": ("documents", {"doc_id": LONG, "held_out": FLAG, "n_tokens": LONG, "n_known": LONG, "train_tokens": LONG, "base_score": REAL, "score": REAL}),
    "op3": ("documents", {"doc_id": LONG, "contaminated": FLAG}),
    "op4": ("documents", {"doc_id": LONG, "start": LONG, "n_tokens": LONG, "ids_crc32": LONG}),
    "op5": ("documents", {"doc_id": LONG, "held_out": FLAG, "score": REAL, "predicted": INT}),
    "op6": ("embeddings", {"vec_id": LONG, "n_links": LONG, "component_id": LONG, "kept": FLAG}),
    "op7": ("documents", {"doc_id": LONG, "fingerprint": TEXT, "component_id": LONG}),
    "op9": ("documents", {"doc_id": LONG, "score": REAL, "keep": FLAG}),
    "op10": ("pages", {"page_id": LONG, "url": TEXT, "text": TEXT, "n_chars": LONG}),
    "op11": (None, {"lang": TEXT, "source": TEXT, "part": TEXT, "item": TEXT, "value": LONG, "rank": INT}),
    "op12": ("documents", {"doc_id": LONG, "n_chars": LONG, "edited_sha256": TEXT, "fingerprint": TEXT, "edited_fingerprint": TEXT, "near_edited": REAL, "near_next": REAL}),
    "op13": ("documents", {"doc_id": LONG, "n_a": LONG, "n_b": LONG, "n_groups": LONG, "n_links": LONG, "n_best": LONG, "count_sum": LONG, "groups_sha256": TEXT}),
}


def check_rows(name, rows, texts):
    fold = lambda i, n: zlib.crc32(str(i).encode()) % n
    for r in rows:
        if name == "op1":
            assert r.n_bytes == len((texts[r.doc_id] or "").encode()) >= r.n_removed >= r.n_spans and re.fullmatch("[0-9a-f]{64}", r.kept_sha256)
        elif name == "op2":
            assert r.held_out == (fold(r.doc_id, 5) == 1) and 0 < r.n_known <= r.n_tokens and r.score < 0 and r.base_score < 0
        elif name == "op5":
            assert r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= .3)
        elif name == "op6":
            assert r.component_id <= r.vec_id and r.kept == (r.vec_id == r.component_id) and r.n_links >= 0
        elif name == "op7":
            assert re.fullmatch("[0-9a-f]{16}", r.fingerprint) and r.component_id <= r.doc_id
        elif name == "op10":
            assert r.n_chars == len(r.text)
        elif name == "op12":
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and re.fullmatch("[0-9a-f]{64}", r.edited_sha256)
        elif name == "op13":
            assert r.n_links == r.n_a + r.n_b - r.n_groups and 0 <= r.n_best <= r.n_links <= r.count_sum
            assert (r.groups_sha256 == "") == (r.n_a == 0)
    if name == "op4":
        start = 0
        for r in sorted(rows, key=lambda r: r.doc_id):
            assert r.start == start and r.n_tokens >= 1 and 0 <= r.ids_crc32 < 2 ** 32
            start += r.n_tokens
    if name == "op11":
        by = {}
        for r in rows:
            by.setdefault((r.lang, r.source, r.part), []).append((r.rank, -r.value, r.item.encode()))
        for (_, _, part), got in by.items():
            assert [g[0] for g in sorted(got)] == list(range(1, len(got) + 1)) and sorted(got) == sorted(got, key=lambda g: g[1:])
            assert part == "pair" or len(got) <= 10


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_contract(spark, name):
    (query,) = [q for k, q in QUERIES.items() if k.startswith(f"{name}_")]
    table, columns = CONTRACTS[name]
    got = query(spark, SF_SMALL)
    assert {c: t for c, t in got.dtypes if c in columns} == columns
    rows = got.collect()
    if table:
        source = spark.read.parquet(f"{SF_SMALL}/{table}.parquet")
        key = next(iter(columns))
        assert sorted(r[key] for r in rows) == sorted(r[0] for r in source.select(key).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    check_rows(name, rows, texts)
