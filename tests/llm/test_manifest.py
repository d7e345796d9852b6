"""The Merkle manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import oracle_rows, spark_rows
from pyspark.sql import functions as F

from foyer.llm import manifest as m
from foyer.llm import oracle, queries

from .conftest import lowered

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text) -> str:
    i, _, lang, source, n = row
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        first = i // 16 * 16
        yield "".join(level[first:i]), "".join(level[i + 1 : first + 16])
        i //= 16


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    for place, g in enumerate(order):
        for i, (_, _, own, row) in enumerate(groups[g]):
            path = [*steps(trees[g], i), *steps(top, place)]
            key = "" if row[0] is None else str(row[0])
            hit = zlib.crc32(key.encode()) % 5 == 0 and row[1] is not None
            now = leaf(row, lowered(row[1])) if hit else own
            for before, after in path:
                now = digest(before + now + after)
            proof = digest("".join(b + a for b, a in path))
            yield row[0], own, trees[g][-1][0], top[-1][0], proof, now, now == top[-1][0]


def check(spark, tmp_path, rows, **extra):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected(rows)))


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS).collect()]
    found = queries.op11_merkle_manifest(spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows))
    assert {r.verified for r in found} == {True, False}


def test_oracle(sf_dir, spark):
    name = "op11_merkle_manifest"
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == oracle_rows(oracle.ORACLES[name], sf_dir)


def test_nulls_ties_repeats_and_clashing_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(m, "_UNFOLD_BITS", 2)
    draw = random.Random(3)
    rows = [(i, f"Text {i}", "en", f"s{i % 3}", i) for i in range(-40, 700)]
    rows += [(draw.randrange(-(1 << 63), 1 << 63), "Far", None, "far", None) for _ in range(300)]
    rows += [(5, f"Same key {i}", "en", "s2", 1) for i in range(40)]  # One key, different leaves.
    rows += [(7, "Same ROW", "en", "s1", 1)] * 33  # Equal rows are as many leaves.
    rows += [(None, "A", "en", None, 1), (None, "A", "en", None, 1), (None, "B", None, None, None)]
    rows += [(63, None, None, None, None), (64, "", "", "", 0), (-1, "x" * 300_000, "Ä", "é", 1), (1, "Z", "z", "Z", 1)]
    check(spark, tmp_path, rows, g="x", place=1, steps="y", leaf=2, word=3, slot=4, node=5)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4097])
def test_sizes(spark, tmp_path, n):
    check(spark, tmp_path, [(i * 3, f"Row {i}", "en", "one", i) for i in range(n)])


def test_many_groups(spark, tmp_path):
    check(spark, tmp_path, [(i, f"Row {i}", "en", f"group {i % 300}", i) for i in range(900)])


def test_empty_table(spark, tmp_path):
    check(spark, tmp_path, [])


def test_no_window_holds_a_whole_group(spark):
    """Keys of any spread are counted in steps of at most 2^16 rows."""
    words = spark.range(0, 1 << 20, 64).select(
        F.lit("1").alias("g"), F.xxhash64("id").alias("word"), F.lit(1).cast("long").alias("n")
    ).withColumn("word", F.shiftright("word", 6))
    located, sizes = m._directory(words)
    rows = sorted((r.word, r.before) for r in located.collect())
    assert [before for _, before in rows] == list(range(len(rows))) and sizes.first().n == len(rows)
