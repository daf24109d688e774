"""The Merkle manifest against a plain tree, its layout and its defined cases."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.merkle import Layout, build_block, fold, merkle_manifest, siblings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: dict) -> str:
    values = [row[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def path(tree: list[list[str]], k: int) -> list[tuple[str | None, bool]]:
    out = []
    for level in tree[:-1]:
        other = k ^ 1
        out.append((level[other] if other < len(level) else None, other < k))
        k >>= 1
    return out


def expected(rows: list[dict]) -> list[tuple]:
    """All rows by one list per level and tree, without blocks."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, members = {}, {}
    for lang in langs:
        own = [(r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r) for r in rows if r["lang"] == lang]
        members[lang] = sorted(own, key=lambda x: x[:3])
        trees[lang] = levels([x[2] for x in members[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        for k, (_, _, digest, row) in enumerate(members[lang]):
            proof = path(trees[lang], k) + path(top, j)
            bad = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None
            cur = leaf(row | {"n_chars": row["n_chars"] + 1}) if bad else digest
            for other, left in proof:
                cur = h(cur) if other is None else h(other, cur) if left else h(cur, other)
            said = h(*[d for d, _ in proof if d is not None])
            out.append((row["doc_id"], digest, trees[lang][-1][0], top[-1][0], said, cur, not bad))
    return out


def made(docs, **options) -> list[tuple]:
    got = [tuple(r) for r in merkle_manifest(docs, **options).collect()]
    return sorted(got, key=str)


def rows_of(n: int) -> list[dict]:
    langs = [None, "de", "en", "en", "en", "fr"]
    rows = [{"doc_id": k * 3 % 1000 - 5, "text": f"text é {k}", "lang": langs[k % 6], "source": "s", "n_chars": k} for k in range(n)]
    rows.append({"doc_id": 5000, "text": "alone", "lang": "zz", "source": None, "n_chars": None})
    return rows


@pytest.mark.parametrize("height", [1, 2, 3, 12])
def test_manifest_equals_plain_trees(spark, height):
    rows = rows_of(150)
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOCS)
    want = expected(rows)
    assert made(docs, height=height) == sorted(want, key=str)
    assert 0 < sum(not r[-1] for r in want) < len(want) / 3


def test_manifest_defined_cases(spark):
    rows = [
        {"doc_id": None, "text": None, "lang": "en", "source": None, "n_chars": 3},
        {"doc_id": None, "text": "", "lang": "en", "source": "", "n_chars": 3},
        *[{"doc_id": 7, "text": "same", "lang": "en", "source": "s", "n_chars": 4}] * 5,
        {"doc_id": 7, "text": "other " * 30_000, "lang": "en", "source": "s", "n_chars": None},
        {"doc_id": 2**62, "text": "x", "lang": "", "source": "s", "n_chars": 2**62},
    ]
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOCS)
    clashing = docs.withColumns({"tree": F.lit("x"), "leaf": F.lit(1), "place": F.lit(2), "block": F.lit(3)})
    assert made(clashing, height=2) == sorted(expected(rows), key=str)
    assert made(docs.limit(0)) == []
    one = docs.filter("lang = ''")
    assert made(one)[0][4] == h()


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 6, 11])
def test_layout_is_the_recursive_one(depth):
    """Every address once; each split's trees lie in a row, the top one first."""
    shape = Layout(depth)
    at = {(d, k): int(shape.addresses(d, np.array([k]))[0]) for d in range(depth + 1) for k in range(1 << d)}
    assert sorted(at.values()) == list(range(shape.size))

    def check(d: int, k: int, rows: int, first: int) -> None:
        assert at[d, k] == first
        if rows > 1:
            upper = rows // 2
            check(d, k, upper, first)
            bottom = (1 << rows - upper) - 1
            for i in range(1 << upper):
                check(d + upper, (k << upper) + i, rows - upper, first + (1 << upper) - 1 + i * bottom)

    check(0, 0, depth + 1, 0)


@pytest.mark.parametrize("leaves", [1, 2, 3, 7, 8, 21])
def test_block_siblings_lead_to_its_root(leaves):
    digests = [bytes([k]) * 32 for k in range(leaves)]
    depth = (leaves - 1).bit_length()
    nodes = build_block(digests, depth)
    for k, digest in enumerate(digests):
        proof = [(d, bool(k >> i & 1)) for i, d in enumerate(siblings(nodes, k, depth))]
        assert fold(digest, proof) == nodes[0]
        assert leaves == 1 or fold(b"x" * 32, proof) != nodes[0]
