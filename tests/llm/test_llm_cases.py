"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foyer.llm import bytewords, decontaminate, gru, lm, quality, repeats, rules, secrets, suffixes
from foyer.llm.components import components
from foyer.llm.decontaminate import distances, leaks
from foyer.llm.jaccard import jaccard_groups, one_per_group
from foyer.llm.mixing import mixed
from foyer.llm.repeats import without_repeats
from foyer.llm.sharding import capacities, place, ring, shard_by_ring
from foyer.llm.tokens import token_counts


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(n))


LONG = prose(1, 30_000)
ROWS = [
    (1, prose(2, 120)), (2, prose(2, 120)), (3, None), (4, ""), (5, " \n\t"), (6, LONG), (None, prose(3, 60)),
    (None, None), (7, prose(4, 80)), (7, prose(4, 80)), (8, "one two"), (9, "One TWO"), (10, "a" * 2000), (None, prose(3, 60)),
]


@pytest.fixture
def odd(docs):
    return docs(*ROWS, shard="x", slot="y", leaks=1, n_tokens="z", spans=2, score=3, epoch=4, language="q", strong=5, ring_cell=6, kept=7)


@pytest.fixture
def none(docs):
    return docs().limit(0)


def test_sharding_cases(odd, none):
    found = shard_by_ring(odd, 3).collect()
    assert len(found) == len(ROWS)
    counts = np.bincount([r["shard"] for r in found])
    assert counts.max() - counts.min() <= 1
    assert sorted((r["shard"], r["slot"]) for r in found) == [(s, i) for s in range(3) for i in range(counts[s])]
    assert shard_by_ring(none, 3).count() == 0
    with pytest.raises(ValueError):
        shard_by_ring(none, 0)


def test_ring_moves_few_keys():
    rng = random.Random(5)
    counts = {cell: rng.randint(0, 3) for cell in range(0, 65536, 7)}
    total = sum(counts.values())

    def owners(shards):
        found = {}
        for cell, a, b, shard, _ in place(counts, ring(shards), capacities(total, shards)):
            found |= {(cell, k): shard for k in range(a, b)}
        return found

    before, after = owners(20), owners(21)
    assert len(before) == len(after) == total
    assert sum(before[k] != after[k] for k in before) < 0.25 * total


def test_token_count_cases(odd, none):
    found = token_counts(odd).select("doc_id", "text", "n_tokens").collect()
    assert len(found) == len(ROWS)
    assert all((r.n_tokens == 0) == (not r.text) for r in found)
    assert token_counts(none).count() == 0


def test_quality_cases(odd, none, docs):
    rows = quality.described(odd, ["doc_id", "score"])
    empty = quality.fit(rows.withColumn("label", F.lit(None).cast("int")), "label")
    assert {r.score for r in quality.scores(rows.drop("score"), empty, ["doc_id"]).collect()} == {0.5}
    model = quality.fit(rows.withColumn("label", F.when(F.col("length") > 4, 1).otherwise(0)), "label")
    found = quality.scores(rows.drop("score"), model, ["doc_id"]).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    assert quality.scores(quality.described(none, ["doc_id"]), model, ["doc_id"]).count() == 0


def test_leak_cases(odd, none, spark):
    item = " ".join(prose(2, 120).split()[20:60])
    words = item.split()
    near = " ".join([*words[:5], "new", *words[6:20], *words[21:]])
    items = spark.createDataFrame(
        [(1, item), (2, near), (None, item), (3, None), (4, "one two"), (5, "")], "item_id long, text string"
    )
    found = {(r.doc_id, r.text): r.leaks for r in leaks(odd, items).collect()}
    hits = found[1, prose(2, 120)]
    assert [(x.item, x.edits) for x in hits] == [(None, 0), (1, 0), (2, 2)]
    assert [(x.first, x.end) for x in hits][:2] == [(20, 60)] * 2
    assert all(not v for k, v in found.items() if k[0] not in (1, 2))
    assert leaks(none, items).count() == 0
    assert leaks(odd, items.limit(0)).where(F.size("leaks") > 0).count() == 0


@pytest.mark.parametrize("words", [8, 15, 40, 59, 100, 200, 400])
def test_leaks_at_the_edit_limit(words):
    """Every planted item is found, with insertions alone and with all kinds of edits."""
    rng = np.random.default_rng(words)
    vocabulary = bytewords.mix(np.arange(1, 3001, dtype=np.uint64))
    items = [rng.choice(vocabulary, words) for _ in range(3)]
    most = int(decontaminate.allowed(words))
    search = decontaminate.Search(*decontaminate._grouped(items, [0, 1, 2], decontaminate.EDITS, 1), 1)
    texts = []
    for trial in range(30):
        own = items[trial % 3].tolist()
        kinds = ["insert"] if trial < 15 else ["insert", "delete", "replace"]
        for _ in range(most):
            at, kind, new = int(rng.integers(len(own))), str(rng.choice(kinds)), rng.choice(vocabulary)
            own[at : at + (kind != "insert")] = [] if kind == "delete" else [new]
        texts.append(np.concatenate([rng.choice(vocabulary, 30), np.array(own, np.uint64), rng.choice(vocabulary, 30)]))
    search.add(np.concatenate(texts), np.append(0, np.cumsum([len(x) for x in texts])), 0)
    found = {(text, item) for text, item, *_ in search.matches()}
    assert found >= {(i, i % 3) for i in range(30)}


def test_edit_distances():
    rng = random.Random(7)
    for _ in range(50):
        a = [rng.randint(0, 3) for _ in range(rng.randint(1, 8))]
        b = [rng.randint(0, 3) for _ in range(rng.randint(0, 10))]
        table = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i][j] = min(
                    table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (a[i - 1] != b[j - 1])
                )
        rows = np.array([b + [-1] * (12 - len(b))])
        got, _ = distances(np.array([a]), np.array([len(a)]), rows)
        assert got[0] == min(table[-1])


def test_rule_cases(odd, none):
    rows = rules.measured(odd)
    found = rules.judged(rows, rules.refined(rows)).collect()
    assert len(found) == len(ROWS)
    assert all(r.n_words == r.word_chars == 0 and r.base_failed and not r.kept for r in found if not (r.text or "").strip())
    rows = rules.measured(none)
    assert rules.judged(rows, rules.refined(rows)).count() == 0


def test_rules_of_other_languages_and_of_mostly_junk(docs):
    rng = random.Random(31)

    def text(letters, n=90):
        return " ".join("".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(n))

    latin, cyrillic, junk = "abcdefilmnoprstu", "абвгдежзиклмнопрсту", "#*$%&|<>"
    rows = [("it", text(latin)) for _ in range(90)] + [("ru", text(cyrillic)) for _ in range(25)]
    rows += [(None, text(latin)) for _ in range(90)] + [(None, text(cyrillic)) for _ in range(25)]
    few = len(rows)
    rows += [("uk", text(cyrillic))]  # Too few for a reference.
    # Half letters, half symbols: the mean is far from both, so that a refinement keeps none.
    none_kept = len(rows)
    rows += [("xx", text(latin)) for _ in range(30)] + [("xx", text(junk)) for _ in range(30)]
    junk_at = len(rows)
    rows += [("it", text(junk, 200)) for _ in range(3)]
    frame = docs(*[(i, t) for i, (_, t) in enumerate(rows)]).drop("lang")
    langs = frame.sparkSession.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "doc_id long, lang string")
    measured = rules.measured(frame.join(langs, "doc_id"))
    found = {r.doc_id: r for r in rules.judged(measured, rules.refined(measured)).collect()}
    assert all(found[i].kept for i in range(none_kept))
    assert not any(found[i].kept for i in range(none_kept, len(rows)))
    assert few < none_kept < junk_at


def test_recurrent_model_cases(odd, none):
    found = lm.scored(odd, F.col("doc_id").isNotNull()).collect()
    assert len(found) == len(ROWS)
    assert all(r.n_tokens == 1 for r in found if not (r.text or "").strip())
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)
    assert lm.scored(none, F.lit(True)).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(8, 4, 4, 1).items()}
    ids, bounds = rng.integers(0, 9, 50), np.array([0, 7, 20, 50])
    source, target, starts, text = next(gru.windows(ids, bounds, 2, 100, 9))
    state, valid = np.zeros((source.shape[1], 4)), text >= 0

    def total():
        out, _ = gru.run(p, source, starts, state)
        return gru.outputs(p, out.reshape(-1, 4)[valid.ravel()], target.ravel()[valid.ravel()], False)[0].sum()

    _, grads, _ = gru.gradients(p, source, starts, target, valid, state)
    for name, values in p.items():
        at = tuple(rng.integers(0, s) for s in values.shape)
        here = values[at]
        values[at] = here + 0.01
        up = total()
        values[at] = here - 0.01
        slope = (up - total()) / 0.02
        values[at] = here
        assert slope == pytest.approx(grads[name][at], abs=2e-3)


def test_state_is_carried_across_windows():
    p = gru.initial(32, 8)
    ids = np.random.default_rng(2).integers(0, 33, 300).astype(np.int32)
    bounds = np.array([0, 0, 120, 121, 300])
    whole = gru.score(p, ids, bounds, n=2, steps=1000)
    assert gru.score(p, ids, bounds, n=3, steps=7) == pytest.approx(whole, rel=1e-5)
    assert whole[0] == 0


def test_windows_of_one_long_text_among_short_ones():
    """Memory goes with the tokens, not with lanes times the longest text; windows as by the definition."""
    sizes = [400_000, *[30] * 255]
    bounds = np.append(0, np.cumsum(sizes))
    ids = np.random.default_rng(4).integers(0, 30, bounds[-1]).astype(np.int32)
    tracemalloc.start()
    met = np.zeros(len(ids), int)
    n = 0
    for source, target, starts, text in gru.windows(ids, bounds, 256, 32, 31):
        valid = text >= 0
        n += int(valid.sum())
        assert (source[starts] == 31).all() and not starts[~valid].any()
        inner = valid[1:] & ~starts[1:]
        assert (source[1:][inner] == target[:-1][inner]).all()
        met[: 32] += np.bincount(target[valid], minlength=32)[:32]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(ids) and (met[:32] == np.bincount(ids, minlength=32)).all()
    assert peak < 100 * len(ids)


def test_repeat_cases(odd, none):
    found = without_repeats(odd).select("doc_id", "text", "spans", "kept_bytes").collect()
    assert len(found) == len(ROWS)
    for row in found:
        data = (row.text or "").encode()
        if row.doc_id in (1, 2, 7, 10):  # Copies, and a text that repeats itself.
            assert [tuple(s) for s in row.spans] == [(0, len(data))] and row.kept_bytes == b""
        elif row.doc_id is not None:
            assert row.spans == [] and bytes(row.kept_bytes) == data
    assert without_repeats(none).count() == 0


def test_repeats_around_a_short_common_passage(docs, monkeypatch):
    """A passage below the length in many surroundings: its segments are more than one array may hold."""
    rng = random.Random(21)

    def noise(n):
        return "".join(rng.choices("abcdefghijklmnop ", k=n))

    passage, wider, copied = noise(380), [noise(30), noise(30)], noise(450)
    texts = [noise(210) + passage + noise(210) for _ in range(6000)]
    texts += [noise(250) + wider[0] + passage + wider[1] + noise(250) for _ in range(3)]  # 440 bytes shared.
    texts += [noise(200) + copied + noise(200) for _ in range(5)]
    seen, real = [], repeats._shards

    def watched(length):
        work, most = real(length), 1 << 21

        def bounded(batches):
            def counted():
                sizes: dict[int, int] = {}
                for batch in batches:
                    for gram, data in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                        sizes[gram] = sizes.get(gram, 0) + len(data)
                    assert max(sizes.values()) <= most, "one gram's segments in one array"
                    yield batch

            yield from work(counted())

        seen.append(length)
        return bounded

    monkeypatch.setattr(repeats, "_shards", watched)
    found = without_repeats(docs(*enumerate(texts))).select("doc_id", "spans").collect()
    assert seen
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found}
    times = Counter(hash(t[k : k + 400]) for t in texts for k in range(len(t) - 399))
    for i, t in enumerate(texts):
        want: list[tuple[int, int]] = []
        for k in range(len(t) - 399):
            if times[hash(t[k : k + 400])] > 1:
                want = [*want[:-1], (want[-1][0], k + 400)] if want and k <= want[-1][1] else [*want, (k, k + 400)]
        assert spans[i] == want
    assert sum(map(bool, spans.values())) == 8


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(150):
        own = [rng.randint(1, 1 + rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 60))]
        text = np.array([*own, *(own if rng.random() < 0.5 else []), 0], np.uint8)
        array, data = suffixes.suffix_array(text), bytes(text)
        want = sorted(range(len(data)), key=lambda i: data[i:])
        assert array.tolist() == want
        before, shared = suffixes.common_prefixes(text, array)
        for a, b in zip(want, want[1:], strict=False):
            n = 0
            while b + n < len(data) and a + n < len(data) and data[a + n] == data[b + n]:
                n += 1
            assert (before[b], shared[b]) == (a, n)


def test_secret_cases(docs, none):
    own = docs(
        (1, "user: bob99 and https://db.example.com/x with q8Zk3Lw0PqR7tYv2Bn5M"),
        (2, "see https://example.com/page for user: bob99"), (3, None), (4, ""),
        (5, "password = hunter22 at ftp://files.example.com/a"), (5, "password = hunter22 at ftp://files.example.com/a"),
        (6, "ftp://files.example.com/a " + "x " * 400 + "password = hunter22"), (7, "token=abc"), strong=1, weak=2,
    )
    rows = secrets.parts(own.withColumn("k", F.md5(F.coalesce("text", F.lit("")))))
    found = rows.join(secrets.linked(rows, "k"), "k", "left").select(
        "doc_id", secrets.listed(F.col("strong")).alias("strong"),
        secrets.listed(F.coalesce("added", F.array())).alias("added"),
    ).collect()
    assert sorted((r.doc_id, r.strong, r.added) for r in found) == [
        (1, "", "login:0:11,endpoint:16:40,random:46:66"), (2, "", ""), (3, "", ""), (4, "", ""),
        (5, "assign:0:19", "endpoint:23:48"), (5, "assign:0:19", "endpoint:23:48"),
        (6, "assign:826:845", ""), (7, "", ""),
    ]
    assert secrets.parts(none).count() == 0


def test_jaccard_cases(odd, none):
    found = jaccard_groups(odd).collect()
    assert len(found) == len(ROWS)
    groups = sorted((r.key or 0, r.n_grams, r.group_key or 0) for r in found)
    assert groups == sorted([
        (1, 116, 1), (2, 116, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 29996, 6), (0, 56, 0), (0, 0, 0),
        (7, 76, 7), (7, 76, 7), (8, 1, 8), (9, 1, 8), (10, 1, 10), (0, 56, 0),
    ])
    kept = one_per_group(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 10]
    assert jaccard_groups(none).count() == 0 and one_per_group(none).count() == 0


def test_jaccard_large_groups(docs):
    """Many near copies, far more than a column makes pairs of, and a passage that unlike texts share."""
    base, passage = prose(11, 200).split(), prose(12, 60)
    rows = []
    for i in range(120):
        own = list(base)
        own[i] = f"edit{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, passage + " " + prose(100 + i, 60)) for i in range(60)]
    found = {r.key: r.group_key for r in jaccard_groups(docs(*rows)).collect()}
    assert all(found[i] == 0 for i in range(120))
    assert all(found[1000 + i] == 1000 + i for i in range(60))


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(200, 260)] + [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(70)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in found} == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert len(found) == len({r.node for r in found})


def test_mixture_redistributes_among_siblings_first(spark):
    sizes = {("a", "en", "s0"): 10, ("a", "en", "s1"): 500, ("a", "de", "s2"): 500, ("b", "en", "s3"): 500}
    rows = [
        (k * 1000 + i, d, l, s, 1) for k, ((d, l, s), n) in enumerate(sizes.items()) for i in range(n)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n_tokens long")
    docs = docs.withColumns({w: F.lit(1) for w in ("wd", "wl", "ws")})
    found = mixed(docs, ["domain", "lang", "source"], ["wd", "wl", "ws"], share=(400, 1510), max_epochs=1)
    got = {r.source: r.n for r in found.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert got == {"s0": 10, "s1": 90, "s2": 100, "s3": 200}  # s1 makes up for s0.


def test_mixture_cases(odd, none):
    rows = odd.withColumns({"n_tokens": F.length("text"), "w": F.lit(1)})
    found = mixed(rows, ["lang", "source"], ["w", "w"], share=(3, 2), max_epochs=2).collect()
    total = sum(r.n_tokens or 0 for r in rows.collect())
    assert sum(r.taken for r in found) in range(total * 3 // 2 - 4, total * 3 // 2 + 1)
    assert mixed(none.withColumns({"n_tokens": F.lit(1), "w": F.lit(1)}), ["lang"], ["w"]).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stage_cases(spark, sf_dir, odd, none, stage):
    name, function = corpus_pipeline.STAGES[stage]
    for docs in (odd, none):
        found = function(spark, docs, sf_dir)
        assert found.count() <= docs.count(), name
        if stage < 4:
            assert found.columns == docs.columns


CLASHING = {
    "kept": 7, "language": "q", "leaks": 1, "epoch": 4, "n_tokens": "z", "domain": "dd", "length": "l", "row": "r",
    "class_reference": 3, "word_reference": "w", "taken": 5, "mix_rank": "m", "w_lang": 2, "n_words": "n", "base_failed": 9,
}


@pytest.mark.parametrize("stage", range(4))
def test_stages_leave_values_of_columns_alone(spark, docs, sf_dir, stage):
    """Every row that stays is one that came, whatever its other columns are called."""
    rows = [(i, prose(i, 60 + i)) for i in range(40)] + [(None, None), (3, ""), (5, prose(99, 90))]
    frame = docs(*rows, **CLASHING)
    name, function = corpus_pipeline.STAGES[stage]
    found = function(spark, frame, sf_dir)
    assert found.columns == frame.columns and found.schema.simpleString() == frame.schema.simpleString()
    came, stay = Counter(map(repr, frame.collect())), Counter(map(repr, found.collect()))
    assert not stay - came and sum(stay.values()) > 15, name


def test_clashing_names_of_statistics_and_references(spark, docs):
    frame = docs(*[(i, prose(i, 60)) for i in range(30)], **CLASHING, score=1, variety=2, label=0)
    frame = frame.withColumn("label", F.col("doc_id") % 2)
    rows = quality.described(frame, ["doc_id", "length", "score", "label", "kept"])
    found = quality.scores(rows, quality.fit(rows, "label"), ["doc_id", "score", "kept"])
    assert found.columns == ["doc_id", "kept", "score"] and found.where("score between 0 and 1").count() == 30
    judged = rules.judged(rules.measured(frame), rules.refined(rules.measured(frame).drop("text")))
    assert judged.where("kept is not null").count() == 30 and judged.columns.count("kept") == 1


def test_leaks_of_items_with_other_ids(spark, docs):
    items = spark.createDataFrame([("x7", prose(1, 20)), ("12", prose(2, 20)), (None, prose(3, 20))], "item_id string, text string")
    frame = docs((1, prose(5, 30) + " " + prose(1, 20)), (2, prose(2, 20)), (3, prose(6, 50)), (4, prose(3, 20)))
    found = {r.doc_id: [x["item"] for x in r.leaks] for r in leaks(frame, items).collect()}
    assert found == {1: [None], 2: [12], 3: [], 4: [None]}


@pytest.mark.parametrize("part", [2048, 2])
def test_jaccard_of_edited_copies_and_a_common_passage(docs, monkeypatch, part):
    """Groups round a base and texts that share a passage, against all pairs; in parts of any size."""
    from foyer.llm import jaccard

    from .test_minhash import expected, family

    monkeypatch.setattr(jaccard, "PART", part)
    rng = random.Random(4)
    every = [*family(11, 60, 0.02), *family(12, 40, 0.04)]
    passage = " ".join(f"common{i}" for i in range(60))
    every += [passage + " " + " ".join(f"own{i}_{k}" for k in range(rng.randrange(5, 60))) for i in range(40)]
    rng.shuffle(every)
    rows = list(enumerate(every))
    found = {r.key: (r.n_grams, r.group_key) for r in jaccard_groups(docs(*rows)).collect()}
    assert found == expected(rows, 5, 75)


@pytest.mark.parametrize("target", [0.9, 0.97])
@pytest.mark.parametrize("words", [8, 15, 23, 31, 40, 59, 100, 200])
def test_leaks_meet_the_target_recall(words, target):
    """Of texts with as many edits as may be, by insertions alone and by all kinds, that share is found."""
    rng = np.random.default_rng(1000 + words)
    vocabulary = bytewords.mix(np.arange(1, 5001, dtype=np.uint64))
    items = [rng.choice(vocabulary, words, replace=False) for _ in range(4)]
    most, trials = int(decontaminate.allowed(words)), 120
    search = decontaminate.Search(*decontaminate._grouped(items, [0, 1, 2, 3], decontaminate.EDITS, 2, target), 2)
    texts = []
    for trial in range(trials):
        own = items[trial % 4].tolist()
        kinds = ["insert"] if trial % 2 else ["insert", "delete", "replace"]
        for _ in range(most):
            at, kind, new = int(rng.integers(len(own))), str(rng.choice(kinds)), rng.choice(vocabulary)
            own[at : at + (kind != "insert")] = [] if kind == "delete" else [new]
        texts.append(np.concatenate([rng.choice(vocabulary, 20), np.array(own, np.uint64), rng.choice(vocabulary, 20)]))
    search.add(np.concatenate(texts), np.append(0, np.cumsum([len(x) for x in texts])), 0)
    found = {(text, item) for text, item, *_ in search.matches()}
    for kind in (0, 1):
        share = np.mean([(i, i % 4) in found for i in range(trials) if i % 2 == kind])
        assert share >= min(target, 0.95) - 0.03, (words, kind, share)


def test_leaks_against_every_place(spark, docs):
    """Items, edits and places of matches equal those of a comparison at every word."""
    rng = random.Random(12)
    items = [prose(200 + i, rng.randrange(15, 60)) for i in range(8)]
    rows = []
    for i in range(40):
        own = items[i % 8].split()
        for _ in range(rng.randrange(0, len(own) // 4 + 3)):
            at = rng.randrange(len(own))
            own[at : at + rng.randrange(2)] = [rng.choice(["nova", "q"])] if rng.random() < 0.6 else []
        rows.append((i, " ".join([prose(500 + i, rng.randrange(0, 40)), *own, prose(700 + i, 20)]).strip()))
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")

    def best(text, item):
        text, item = text.split(), item.split()
        most, found = len(item) // 4, []
        for first in range(len(text)):
            now = list(range(len(text) - first + 1))[: len(item) + most + 1]
            part = text[first : first + len(item) + most]
            for i, word in enumerate(item):
                new = [i + 1]
                for j, other in enumerate(part):
                    new.append(min(now[j] + (word != other), now[j + 1] + 1, new[j] + 1))
                now = new
            edits = min(now)
            if edits <= most:
                found.append((edits, first, first + now.index(edits)))
        return min(found, default=None)

    want = {(i, k, *hit) for i, text in rows for k, item in enumerate(items) if (hit := best(text, item))}
    got = {(r.doc_id, x.item, x.edits, x.first, x.end) for r in leaks(docs(*rows), frame).collect() for x in r.leaks}
    assert len(want) > 20 and got <= want and len(want - got) <= 1


def test_quality_scores_against_plain_densities(spark, docs):
    """Scores equal the ratio of two normal densities, written out."""
    rng = random.Random(8)
    rows = [(i, prose(i, rng.randrange(20, 90)) + ("! X1" * (i % 7) if i % 2 else "")) for i in range(60)]
    frame = docs(*rows).withColumn("label", F.col("doc_id") % 2)
    described = quality.described(frame, ["doc_id", "label"])
    found = {r.doc_id: r.score for r in quality.scores(described, quality.fit(described, "label"), ["doc_id"]).collect()}
    table = described.toPandas().sort_values("doc_id")
    x, label = table[quality.STATISTICS].to_numpy(), table.label.to_numpy()
    parts = [x[label == c] for c in (0, 1)]
    pooled = sum(len(p) * p.var(0) for p in parts) / len(x)
    unit = np.sqrt(np.maximum(pooled, 1e-6))
    densities = []
    for part in parts:
        spread = np.cov(part.T, bias=True) / np.outer(unit, unit)
        spread = (1 - quality.SHRINKAGE) * spread + quality.SHRINKAGE * np.eye(len(unit))
        off = (x - part.mean(0)) / unit
        far = (off @ np.linalg.inv(spread) * off).sum(1)
        densities.append(np.log(len(part) / len(x)) - 0.5 * np.linalg.slogdet(spread)[1] - 0.5 * far)
    want = 1 / (1 + np.exp(np.clip(densities[0] - densities[1], -500, 500)))
    assert np.allclose([found[i] for i in range(60)], want, atol=1e-6)


@pytest.mark.parametrize("letters, caught", [(8, True), (3, False)])
def test_planted_passages_above_and_below_400_bytes(docs, letters, caught):
    """A passage of 60 words that repeats goes if it has 400 bytes, by the operator's contract, and else stays."""
    rng = random.Random(letters)
    passage = " ".join("".join(rng.choices("abcdefghij", k=letters)) for _ in range(60))
    assert (len(passage) >= 400) == caught
    rows = [(i, prose(900 + i, 80) + (f" {passage} " if i < 10 else " ") + prose(950 + i, 40)) for i in range(20)]
    for row in without_repeats(docs(*rows)).collect():
        removed = sum(span["end"] - span["start"] for span in row.spans)
        if caught and row.doc_id < 10:
            # Neighbours that some of the texts share by chance go with it.
            assert len(passage) + 2 <= removed <= len(passage) + 12
        else:
            assert removed == 0
