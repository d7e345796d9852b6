"""MinHash groups against all pairs of full sets."""

from __future__ import annotations

import random
import re
from math import comb

import numpy as np
import pyarrow as pa
import pytest

from foyer.llm import minhash as m
from foyer.llm import queries

from .conftest import WORD, lowered, texts

WORDS = re.compile(WORD)


def shingles(text, n):
    words = WORDS.findall(lowered(text or ""))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def expected(rows, n=4, percent=80):
    """By key: the set's size and the least key reachable."""
    sets = {i: shingles(text, n) for i, text in rows}
    nodes = sorted({s for s in sets.values() if s}, key=len)
    group = {s: s for s in nodes}

    def root(s):
        while group[s] is not s:
            s = group[s]
        return s

    for at, a in enumerate(nodes):
        for b in nodes[at + 1 :]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                group[root(a)] = root(b)
    least = {}
    for i, s in sets.items():
        if s:
            least[root(s)] = min(i, least.get(root(s), i))
    return {i: (len(s), least[root(s)] if s else i) for i, s in sets.items()}


def found_in(frame, **how):
    rows = m.near_groups(frame, **how).collect()
    assert all(r.kept == (r.key == r.group_key) for r in rows)
    return {r.key: (r.n_grams, r.group_key) for r in rows}


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query(spark, sf_dir, scale):
    sf_dir = sf_dir.replace("0.001", scale)
    rows = queries.op12_minhash_dedup(spark, sf_dir).collect()
    want = expected(texts(spark, sf_dir).items())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and len(rows) == len(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def edited(draw, words, share):
    return " ".join(draw.choice("abcdefgh") * 3 + str(draw.random()) if draw.random() < share else w for w in words)


def family(seed, copies, share):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    return [" ".join(base), *(edited(draw, base, share) for _ in range(copies))]


@pytest.mark.parametrize("head, part", [(4096, 2048), (3, 2), (64, 5)])
def test_edited_copies_and_a_common_passage(spark, docs, monkeypatch, head, part):
    """Groups round a base, chains, and texts that share half: none may merge wrongly or be lost."""
    monkeypatch.setattr(m, "HEAD", head)
    monkeypatch.setattr(m, "PART", part)
    draw = random.Random(5)
    every = [*family(1, 60, 0.02), *family(2, 40, 0.035), *family(3, 30, 0.05)]
    passage = " ".join(f"common{i}" for i in range(60))
    for i in range(50):
        every.append(passage + " " + " ".join(f"own{i}_{draw.randrange(99)}_{k}" for k in range(draw.randrange(5, 60))))
    chain = [f"c{i}" for i in range(130)]
    every += [" ".join(chain[i : i + 100]) for i in range(0, 30, 3)]
    draw.shuffle(every)
    rows = list(enumerate(every))
    assert found_in(docs(*rows)) == expected(rows)


def test_cases(spark, docs):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "one  two\nthree"),
        (8, "one two three four"), (9, "One two three FOUR"), (10, "one two three four five"), (11, long),
        (12, long.upper().replace("X", "x", 3)), (13, long + " y"), (-14, "one"), (15, "Ä ä ö ü"), (16, "ä ä ö ü"),
    ]
    frame = docs(*rows, node=1, bucket="b", marks="c", root=2, u=3, key="k", grams=0)
    assert found_in(frame) == expected(rows)


def test_null_and_repeated_keys(spark, docs):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "q r s t"), (None, None), (7, "")]
    found = sorted((repr(r.key), r.n_grams, repr(r.group_key), r.kept) for r in m.near_groups(docs(*rows)).collect())
    assert found == sorted([
        ("None", 1, "5", False), ("None", 1, "5", False), ("5", 1, "5", True), ("5", 1, "5", True),
        ("None", 1, "None", True), ("None", 0, "None", True), ("7", 0, "7", True),
    ])


def test_empty_table(spark, docs):
    assert m.near_groups(docs()).collect() == []


def test_other_lengths_and_limits(spark, docs):
    rows = list(enumerate([*family(7, 30, 0.1), *family(8, 20, 0.2)]))
    assert found_in(docs(*rows), n=2, percent=60) == expected(rows, 2, 60)


def test_large_sides_are_joined_by_hash(spark, docs, monkeypatch):
    monkeypatch.setattr(m, "BROADCAST_ROWS", 0)
    rows = list(enumerate([*family(9, 20, 0.03)] * 3))
    assert found_in(docs(*rows)) == expected(rows)


def test_layout_meets_its_chances():
    for percent in (50, 60, 75, 80, 90, 95):
        bands, rows = m.layout(percent)
        assert bands * rows <= m.MOST_HASHES and (1 - (percent / 100) ** rows) ** bands <= m.MISS
        least, h, p = m.least_agreement(percent, bands * rows), bands * rows, percent / 100
        assert sum(comb(h, k) * p**k * (1 - p) ** (h - k) for k in range(least)) <= m.MISS


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(0)
    pool = m.bytewords.mix(np.arange(1, 3001, dtype=np.uint64))
    a, b = np.sort(pool[:2000]), np.sort(pool[1000:])
    signs = m._family(2000)
    agree = (m.signature(a, signs) == m.signature(b, signs)).mean()
    assert abs(agree - 1 / 3) < 0.05
    shuffled = draw.permutation(a)
    assert (m.signature(a, signs) == m.signature(shuffled, signs)).all()


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_buckets_of_one_node_go(size):
    entries = sorted([(1, 5), (2, 3), (2, 3), (3, 1), (3, 1), (3, 2), (3, 4), (4, 9), (5, 1), (5, 2), (6, 7), (6, 7)])
    batches = [
        pa.RecordBatch.from_pydict({"bucket": [b for b, _ in part], "node": [n for _, n in part]})
        for i in range(0, len(entries), size) if (part := entries[i : i + size])
    ]
    found = [tuple(row.values()) for batch in m._meeting(iter(batches)) for row in batch.to_pylist()]
    assert sorted(found) == [(3, 1), (3, 2), (3, 4), (5, 1), (5, 2)]
