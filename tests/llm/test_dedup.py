"""Near-duplicate documents and lines against all pairs, and their defined cases."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from strata.llm.line_dedup import SHINGLE_CHARS, dedup_lines, line_hashes
from strata.llm.near_dedup import band_keys, drop_near_duplicates, near_duplicates, shingle_set, signature
from tests.llm.brute import components, shingles


def test_near_duplicates_equal_all_pairs(spark, make_docs, near_texts):
    texts = dict(near_texts)
    texts |= {5000: None, 5001: "", 5002: " \t\n", 5003: "one two", 5004: "ONE  two", 5005: "one two three", 5006: "x " * 30_000}
    rows = near_duplicates(make_docs(texts)).collect()
    sets = {k: shingles(t) for k, t in texts.items()}
    expected = components(sets)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in rows)
    assert expected[5004] == 5003 and expected[5005] == 5005 and expected[5002] == 5002


def test_copies_linked_only_through_their_original(make_docs, words):
    base = words[:60]
    texts = {1000: " ".join(base)}
    for k in range(40):
        copy = list(base)
        copy[(k * 7) % 55 + 2] = f"changed{k}"
        texts[k] = " ".join(copy)
    rows = near_duplicates(make_docs(texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == components({k: shingles(t) for k, t in texts.items()})


def test_pairs_among_many_texts_alike_to_one_hub(make_docs):
    """Texts at about 0.68 to a hub, in pairs at 0.75 to 0.8: the finer keys decide on pairs away from a centre."""
    rng = random.Random(8)
    chunks = [" ".join(f"w{k * 15 + i}" for i in range(15)) for k in range(60)]

    def without(left_out):
        return " ".join(c for k, c in enumerate(chunks) if k not in left_out)

    texts = {0: without(())}
    for pair in range(300):
        order = rng.sample(range(60), 20)
        texts[2 * pair + 1], texts[2 * pair + 2] = without(order[:16]), without(order[4:])
    expected = components({k: shingles(t) for k, t in texts.items()})
    assert expected[1] == 1 and sum(k != c for k, c in expected.items()) == 300
    assert {r.doc_id: r.component_id for r in near_duplicates(make_docs(texts)).collect()} == expected


def test_near_duplicates_defined_cases(spark, make_docs):
    text = "a b c d e f g"
    docs = make_docs([(1, text), (1, text), (None, text), (2, text)]).withColumn("kept", F.lit("x")).withColumn("size", F.lit(1))
    rows = sorted(near_duplicates(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, r.component_id, r.kept) for r in rows] == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]
    assert near_duplicates(docs.limit(0)).count() == 0
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "1", "None"]


def test_rows_that_share_a_doc_id(make_docs, words):
    a, b, c, d = (" ".join(words[k * 40 : k * 40 + 40]) for k in range(4))
    docs = make_docs([(0, a), (1, a), (1, b), (2, b), (5, c), (5, a), (6, d), (6, None), (7, d + " end")])
    found = {(r.doc_id, r.n_shingles > 0): r.component_id for r in near_duplicates(docs).collect()}
    assert found == {(0, True): 0, (1, True): 0, (2, True): 0, (5, True): 0, (6, True): 6, (6, False): 6, (7, True): 6}
    left = sorted((r.doc_id, r.text) for r in drop_near_duplicates(docs).collect() if r.text)
    assert left == sorted([(0, a), (1, b), (5, c), (6, d)])


def test_texts_with_one_long_passage_make_few_pairs(spark, make_docs, monkeypatch):
    """Texts alike to 60 % by a common passage: buckets bring them together by chance,
    and the rarest shingles pair only the near copies among them."""
    from strata.llm import common

    rng = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(120))
    texts = {}
    for k in range(0, 2000, 2):
        own = [f"x{k}-{i}" for i in range(40)]
        texts[k] = passage + " " + " ".join(own)
        if k % 20 == 0:
            own[rng.randrange(8, 32)] = "changed"
        else:
            own = [f"y{k}-{i}" for i in range(40)]
        texts[k + 1] = passage + " " + " ".join(own)
    counted = []
    plain = common.confirmed_pairs
    monkeypatch.setattr(common, "confirmed_pairs", lambda pairs, *rest: counted.append(pairs.count()) or plain(pairs, *rest))
    rows = near_duplicates(make_docs(texts)).collect()
    expected = {k: k - k % 2 if (k - k % 2) % 20 == 0 else k for k in texts}
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert sum(counted) < 6 * len(texts)


def test_pairs_meet_at_their_first_common_shingle_only(make_docs, monkeypatch):
    """Texts of one family that miss 0.75 to each other share many rare shingles;
    the join makes a pair once, not once per shingle."""
    from strata.llm import common

    rng = random.Random(11)
    chunks = [" ".join(f"w{k * 6 + i}" for i in range(6)) for k in range(60)]
    texts = {k: " ".join(c if rng.random() < 0.87 else f"own{k}-{i}" for i, c in enumerate(chunks)) for k in range(200)}
    made = []
    plain = common._paired

    def counted(*args):
        pairs = plain(*args)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(common, "_paired", counted)
    rows = near_duplicates(make_docs(texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == components({k: shingles(t) for k, t in texts.items()})
    assert made[-1][1] > 1000 and made[-1][0] < 2 * made[-1][1]


def test_lines_are_moved_not_their_hashes(make_docs, words, monkeypatch):
    from strata.llm import common, line_dedup

    schemas = {}
    plain = common.write_once

    def noted(df, name):
        schemas[name] = dict(df.dtypes)
        return plain(df, name)

    for module in (common, line_dedup):
        monkeypatch.setattr(module, "write_once", noted)
    line = " ".join(words[:12])
    texts = {k: f"{line} {words[20 + k]}\nown line {k} of this text" for k in range(6)}
    rows = dedup_lines(make_docs(texts)).collect()
    assert {r.doc_id: r.dropped_lines for r in rows} == _cut(texts)
    assert schemas["line-sets"]["body"] == "string" and "array" not in str(schemas["line-sets"])


def test_few_lines_apart_in_a_bucket_are_compared_without_dealing_out_shingles(make_docs, monkeypatch):
    """A line and two that differ from it more than from each other, ASCII and other
    letters: few pairs, so the shingles of the lines aren't moved at all."""
    from strata.llm import common

    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = {}
    for k in range(0, 120, 3):
        base = ["".join(rng.choices(letters, k=6)) for _ in range(40)]
        other = base[:32] + ["".join(rng.choices(letters, k=6)) for _ in range(8)]
        third = list(other)
        third[39] = "漢字é😀" if k % 2 else "changed"
        texts |= {k: " ".join(base), k + 1: " ".join(other), k + 2: " ".join(third)}
    dealt = []
    plain = common._prefixes
    monkeypatch.setattr(common, "_prefixes", lambda sets, *rest: dealt.append(sets.count()) or plain(sets, *rest))
    rows = {r.doc_id: r.dropped_lines for r in dedup_lines(make_docs(texts)).collect()}
    expected = _cut(texts)
    assert rows == expected and sum(map(len, expected.values())) == 40
    assert dealt == []


def test_lines_of_a_hub_apart_from_many_others(make_docs):
    """Lines at about 0.68 to a hub, in pairs at 0.8: more lie apart in a bucket than
    are compared at once, and none of the links is lost."""
    rng = random.Random(8)
    chunks = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30)) for _ in range(60)]

    def without(left_out):
        return " ".join(c for k, c in enumerate(chunks) if k not in left_out)

    texts = {0: without(())}
    for pair in range(40):
        order = rng.sample(range(60), 18)
        texts[2 * pair + 1], texts[2 * pair + 2] = without(order[:16]), without(order[2:])
    rows = {r.doc_id: r.dropped_lines for r in dedup_lines(make_docs(texts)).collect()}
    expected = _cut(texts)
    assert sum(map(len, expected.values())) >= 40
    assert rows == expected


def test_the_same_shingle_has_one_hash_in_any_line(spark):
    lines = ["a common start é", "a common start e", "漢字かな交じり文の長い一行です😀", "short"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k long, line string")
    found = {r.k: r.h for r in df.select("k", line_hashes(F.col("line")).alias("h")).collect()}
    assert [len(found[k]) for k in range(4)] == [max(1, len(x) - SHINGLE_CHARS + 1) for x in lines]
    assert found[0][:-1] == found[1][:-1] and found[0][-1] != found[1][-1]


def test_signatures_are_full_and_estimate_similarity():
    a = shingle_set(b" ".join(b"%d" % i for i in range(400)))
    b = shingle_set(b" ".join(b"%d" % i for i in range(40, 440)))
    assert len(signature(a)) == len(signature(a[:1])) == 256
    true = len(set(a) & set(b)) / len(set(a) | set(b))
    assert abs((signature(a) == signature(b)).mean() - true) < 0.12
    assert (band_keys(a) == band_keys(a.copy())).all()


def _runs(line: str) -> set[str]:
    return {line[i : i + SHINGLE_CHARS] for i in range(max(1, len(line) - SHINGLE_CHARS + 1))}


def _cut(texts: dict, percent: int = 75) -> dict:
    """Expected dropped line numbers, by all pairs of distinct lines."""
    normal = {k: [re.sub(r"\s+", " ", line.lower()).strip(" ") for line in (t or "").split("\n")] for k, t in texts.items()}
    distinct = sorted({line for lines in normal.values() for line in lines if line})
    root = components({line: _runs(line) for line in distinct}, percent)
    seen, out = set(), {}
    for k in sorted(texts):
        out[k] = []
        for i, line in enumerate(normal[k]):
            if line:
                if root[line] in seen:
                    out[k].append(i)
                seen.add(root[line])
    return out


def test_lines_equal_all_pairs(make_docs, words):
    lines = [" ".join(words[k * 9 : k * 9 + 9]) for k in range(30)]
    texts = {}
    for k in range(40):
        near = lines[(k * 7) % 30].split()
        near[k % 9] = words[500 + k]
        texts[k] = "\n".join([lines[k % 30], "", lines[(k * 3) % 30].upper(), " ".join(near), "The.", f"own line {k} of this one"])
    texts |= {100: None, 101: "", 102: "\n\n", 103: "漢字かな交じり文の長い一行です。", 104: "漢字かな交じり文の長い一行です!", 105: "w " * 20_000}
    rows = {r.doc_id: r for r in dedup_lines(make_docs(texts)).collect()}
    expected = _cut(texts)
    assert {k: r.dropped_lines for k, r in rows.items()} == expected
    for k, t in texts.items():
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in expected[k])
        assert rows[k].text == kept and rows[k].n_lines == (t or "").count("\n") + 1


def test_lines_defined_cases(make_docs):
    docs = make_docs([(1, "same line here\nother"), (1, "same line here\nother"), (None, "same line here"), (2, "same line here")])
    docs = docs.withColumn("dropped_lines", F.lit("mine")).withColumn("line", F.lit(0))
    rows = dedup_lines(docs).collect()
    # A null doc_id comes first; equal rows are cut alike.
    assert sorted((str(r.doc_id), r.text) for r in rows) == [("1", "other"), ("1", "other"), ("2", ""), ("None", "same line here")]
    assert dedup_lines(docs.limit(0)).count() == 0


def test_lines_compared_to_their_last_character(make_docs):
    same_start = ["import numpy", "import numpy as np", "return self.x", "return self.value", "https://example.com/a", "https://example.com/some/other"]
    tokens = [f"/usr/share/lib/{'abcdefgh'[k] * 9}/{'stuvwxyz'[k] * 7}" for k in range(8)]
    ends = ["a common start of lines " + w for w in ("x", "y", "which ends quite otherwise", "and then goes another way")]
    emoji = ["😀" * 5 + "abcdefghij" + c for c in ("k", "lmnopqrs")]
    texts = {k: line for k, line in enumerate(same_start + tokens + ends + emoji)}
    expected = _cut(texts)
    rows = {r.doc_id: r.dropped_lines for r in dedup_lines(make_docs(texts)).collect()}
    assert rows == expected
    assert sum(map(len, expected.values())) < 4
