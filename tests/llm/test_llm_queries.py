"""Each registered query over a whole small table, against brute force or its SQL."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import oracle_rows, spark_rows
from tokenizers import Tokenizer, models, pre_tokenizers

from foyer.llm import queries as llm
from foyer.llm import tokens
from foyer.llm.bytewords import mix  # noqa: F401  (the workers import it too)

from .conftest import WORD, lowered, texts

WORDS = re.compile(WORD)


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    assert spark_rows(llm.QUERIES[name](spark, sf_dir)) == oracle_rows(llm.ORACLES[name], sf_dir)


def test_sharding(spark, sf_dir):
    found = llm.op1_ring_sharding(spark, sf_dir).toPandas()
    own = texts(spark, sf_dir)
    assert sorted(found.doc_id) == sorted(own)
    for row in found.itertuples():
        data = own[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law) == (len(data) + 16, zlib.crc32(data), "rows")
    counts = found.groupby("shard").size()
    assert len(counts) == llm.SHARDS and counts.max() - counts.min() <= 1
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_token_counts(spark, sf_dir):
    vocabulary = [("<unk>", 0.0), *tokens.pieces()]
    exact = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokens.SPACE, prepend_scheme="always", split=True)
    own = texts(spark, sf_dir)
    for row in llm.op2_unigram_tokens(spark, sf_dir).collect():
        assert row.n_tokens == len(exact.encode(own[row.doc_id], add_special_tokens=False).ids)


def test_quality_on_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = llm.op3_quality_discriminant(spark, sf_dir).join(labels, "doc_id", "left").toPandas()
    assert found.score.between(0, 1).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    held = found[found.held_out & found.quality.notna()]
    assert (held.predicted == held.quality).mean() > 0.95


def test_benchmark_leaks(spark, sf_dir):
    def plain(text):
        return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "

    own = {i: plain(t) for i, t in texts(spark, sf_dir).items()}
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    exact = {(i, item.item_id) for item in items for i, t in own.items() if plain(item.text) in t}
    found = llm.op4_benchmark_leaks(spark, sf_dir).collect()
    assert {(r.doc_id, x) for r in found for x, e in zip(r.item_ids, r.edits, strict=True) if e == 0} == exact
    assert len(found) == len(own)


def test_quality_rules(spark, sf_dir):
    own = texts(spark, sf_dir)
    found = llm.op5_divergence_rules(spark, sf_dir).collect()
    assert len(found) == len(own)
    for row in found:
        text = own[row.doc_id]
        words = WORDS.findall(text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        again = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        want = (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(again), len(words) < 20 or 100 * len(again) > 30 * len(words),
        )
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == want
        assert not (row.base_failed and row.kept)


def test_recurrent_scores(spark, sf_dir):
    own = {i: [*WORDS.findall(lowered(t)), None] for i, t in texts(spark, sf_dir).items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in own}
    counts = Counter(w for i, words in own.items() if not held[i] for w in words)
    n, v = sum(counts.values()), len(counts)
    for row in llm.op6_recurrent_scores(spark, sf_dir).collect():
        words = own[row.doc_id]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[row.doc_id], len(words), n)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(base) and row.score < 0


def test_repeated_spans(spark, sf_dir):
    own = {i: t.encode() for i, t in texts(spark, sf_dir).items()}
    times = Counter(t[k : k + 400] for t in own.values() for k in range(len(t) - 399))
    for row in llm.op7_repeated_spans(spark, sf_dir).collect():
        data, gone, reach = own[row.doc_id], [], 0
        for k in range(len(data)):
            if k + 400 <= len(data) and times[data[k : k + 400]] > 1:
                reach = k + 400
            gone.append(k < reach)
        kept = bytes(b for b, x in zip(data, gone, strict=True) if not x)
        spans = sum(x and not y for x, y in zip(gone, [False, *gone], strict=False))
        want = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
        assert (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) == want


def test_secrets(spark, sf_dir):
    kinds = {
        "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        "access": (r"(AKIA[A-Z0-9]+)", 20),
        "hex": (r"([0-9a-f]+)", 24),
    }
    own = texts(spark, sf_dir)
    for row in llm.op8_linked_secrets(spark, sf_dir).collect():
        found = sorted(
            (m.start(), k, m.end()) for k, (kind, (pattern, least)) in enumerate(kinds.items())
            for m in re.finditer(pattern, own[row.doc_id]) if len(m[1]) >= least
        )
        spans = [f"{list(kinds)[k]}:{a}:{b}" for a, k, b in found]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row.spans.split(",")) or not spans


def linked(own: dict[int, str], percent=75) -> tuple[dict, dict]:
    sets = {}
    for i, text in own.items():
        words = WORDS.findall(lowered(text))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i in sorted(own):
        for gram in sets[i]:
            holders[gram].append(i)
    shared = Counter((a, b) for ids in holders.values() for n, a in enumerate(ids) for b in ids[n + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: len(s) for i, s in sets.items()}, {i: find(i) for i in own}


def test_jaccard_join(spark, sf_dir):
    sizes, groups = linked(texts(spark, sf_dir))
    for row in llm.op9_jaccard_join(spark, sf_dir).collect():
        assert (row.n_shingles, row.component_id) == (sizes[row.doc_id], groups[row.doc_id])


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in llm.op5_divergence_rules(spark, sf_dir).where("kept").collect()}
    own = {i: t for i, t in texts(spark, sf_dir).items() if i in kept}
    _, groups = linked(own)
    alone = {i for i in own if groups[i] == i}
    leaky = {r.doc_id for r in llm.op4_benchmark_leaks(spark, sf_dir).where("contaminated").collect()}
    clean = alone - leaky
    result = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(result.columns) == {*docs.columns, "shard", "slot"}
    assert result.doc_id.is_unique and set(result.doc_id) <= clean
    words = {i: len(WORDS.findall(t)) for i, t in own.items()}
    total, taken = sum(words[i] for i in clean), sum(words[i] for i in result.doc_id)
    share, of = corpus_pipeline.MIX_SHARE
    assert taken >= total * share // of
    counts = np.bincount(result["shard"], minlength=llm.SHARDS)
    assert counts.max() - counts.min() <= 1
