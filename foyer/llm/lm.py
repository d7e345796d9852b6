"""Scores of whole texts by a gated recurrent language model trained on the corpus.

Word counts are taken over all training text. The most frequent words are the model's vocabulary; any
other word costs the model's probability of "another word" times its share, by counts plus one, of
those words, with one share for all unknown ones. So the scores are log probabilities that add up.

Training is one pass over all training text in rounds that grow: in a round each task trains
a copy on its share, and the copies are averaged by tokens, in groups and then over the groups. Within
a task, truncated backpropagation runs over windows of lanes that carry their state. What
reaches the driver is the model, the table of the most frequent words, and a few sums; other words
are counted and looked up by joins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foyer.llm import bytewords, gru
from foyer.llm.common import fresh, most_frequent, named, whole_text, written

VOCABULARY = 1024
#: Frequent words whose counts are sent to all tasks, at most.
TABLE = 1 << 18
LANES, STEPS, WINDOWS, CHUNK = 256, 32, 128, 1 << 20
#: Tokens, about, that each copy of a round trains on at least.
COPY_TOKENS = 1 << 18
#: Shares of the training text, in sixteenths, and rates of the rounds.
ROUNDS = [(1, 0.03), (1, 0.03), (2, 0.02), (4, 0.01), (8, 0.005)]
GROUPS = 32
END = int(bytewords.mix(np.array([0xE0D], np.uint64))[0])
_TASK_WORDS = 1 << 22


@dataclass
class Model:
    """A trained model. ``counts``: (word, n) of all training words by hash, the end included."""

    parameters: dict
    words: np.ndarray  # Hashes of the most frequent words, the vocabulary first.
    word_counts: np.ndarray
    counts: DataFrame
    tokens: int
    distinct: int

    @property
    def outside(self) -> int:
        """Counts plus one of all known words outside the vocabulary, and one for the unknown."""
        inside = self.word_counts[:VOCABULARY]
        return self.tokens - int(inside.sum()) + self.distinct - len(inside) + 1


def _tokens(raw: np.ndarray, bounds: np.ndarray):
    """Blocks of texts as (first text, last text, token hashes with ends, token bounds)."""
    for first, last in bytewords.blocks(bounds):
        data = bytewords.LOWER[raw[bounds[first] : bounds[last]]]
        starts, ends, at = bytewords.words(data, bounds[first : last + 1] - bounds[first])
        own = bytewords.Prefix(data).hashes(starts, ends)
        yield first, last, np.insert(own, at[1:], np.uint64(END)), at + np.arange(len(at))


def _counts(texts: DataFrame) -> DataFrame:
    def scan(batches):
        held, size = [], 0

        def done():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["word", "n"])

        for batch in batches:
            for _, _, own, _ in _tokens(*bytewords.text_bytes(batch.column(0))):
                held.append(own)
                size += len(own)
                if size >= _TASK_WORDS:
                    yield done()
                    held, size = [], 0
        if held:
            yield done()

    return texts.mapInArrow(scan, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the most frequent words, by falling count."""
    found = most_frequent(counts, "word", "n", most).toPandas()
    words, n = found["word"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.lexsort((words, -n))
    return words[order], n[order]


def _start(words: np.ndarray, n: np.ndarray, tokens: int) -> dict:
    """Parameters that begin at the word frequencies."""
    p = gru.initial(VOCABULARY)
    counts = np.full(VOCABULARY, 0.5)
    counts[: len(n[:VOCABULARY])] = n[:VOCABULARY]
    by_class = counts.reshape(-1, gru.CLASS_SIZE)
    rest = max(0.5, tokens - n[:VOCABULARY].sum())
    p["class_bias"] = np.log(np.append(by_class.sum(1), rest) / (counts.sum() + rest)).astype(np.float32)
    p["word_bias"] = np.log(by_class / by_class.sum(1, keepdims=True)).astype(np.float32)
    return p


def _packed(p: dict) -> bytes:
    return b"".join(p[k].astype(np.float32).tobytes() for k in sorted(p))


def _unpacked(data: bytes, like: dict) -> dict:
    flat, out, at = np.frombuffer(data, np.float32), {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _chunks(batches, table: bytewords.Table, text_column: int = 0):
    """Runs of whole texts of about CHUNK tokens: (ids, bounds) for a model."""
    held, sizes, total = [], [], 0
    for batch in batches:
        for _, _, own, at in _tokens(*bytewords.text_bytes(batch.column(text_column))):
            found = table.find(own)
            held.append(np.where((found >= 0) & (found < VOCABULARY), found, VOCABULARY).astype(np.int32))
            sizes.append(np.diff(at))
            total += len(own)
            if total >= CHUNK:
                yield np.concatenate(held), np.append(0, np.cumsum(np.concatenate(sizes)))
                held, sizes, total = [], [], 0
    if held:
        yield np.concatenate(held), np.append(0, np.cumsum(np.concatenate(sizes)))


def _round(texts: DataFrame, p: dict, words: np.ndarray, rate: float) -> dict:
    """The model after a round over the texts: copies trained by task, averaged by tokens."""
    shared = texts.sparkSession.sparkContext.broadcast((p, words[:VOCABULARY]))

    def work(batches):
        start, known = shared.value
        mine = {k: v.copy() for k, v in start.items()}
        optimizer, seen = gru.Adam(mine, rate), 0
        for ids, bounds in _chunks(batches, bytewords.Table(known)):
            n = int(np.clip(len(ids) // (STEPS * WINDOWS), 8, LANES))
            gru.train(mine, ids, bounds, n=n, steps=STEPS, optimizer=optimizer)
            seen += len(ids)
        if seen:
            group = TaskContext.get().partitionId() % GROUPS
            yield pa.RecordBatch.from_arrays(
                [pa.array([group], pa.int32()), pa.array([seen], pa.int64()), pa.array([_packed(mine)], pa.binary())],
                ["part", "tokens", "model"],
            )

    def average(batches):
        total, seen = None, 0
        for batch in batches:
            for n, model in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                flat = np.frombuffer(model.as_buffer(), np.float32).astype(np.float64) * n
                total, seen = (flat if total is None else total + flat), seen + n
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int32()), pa.array([seen], pa.int64()),
                 pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())],
                ["part", "tokens", "model"],
            )

    schema = "part int, tokens long, model binary"
    copies = texts.mapInArrow(work, schema).repartition(GROUPS, "part").mapInArrow(average, schema).collect()
    if not copies:
        return p
    # At most one model per group.
    flat = sum(np.frombuffer(r["model"], np.float32).astype(np.float64) * r["tokens"] for r in copies)
    return _unpacked((flat / sum(r["tokens"] for r in copies)).astype(np.float32).tobytes(), p)


def train_model(docs: DataFrame, text: str = "text") -> Model:
    """A model of all texts of ``docs``; a null text is an empty one. An empty table is allowed."""
    texts = docs.select(whole_text(text).alias("text"))
    counts = written(_counts(texts), "lm-counts")
    tokens, distinct = counts.agg(F.sum("n"), F.count("*")).head()
    words, n = _frequent(counts, TABLE)
    p = _start(words, n, tokens or 0)
    share, low = F.pmod(F.xxhash64("text", F.lit("round")), F.lit(16)), 0
    for sixteenths, rate in ROUNDS:
        part = texts.where((share >= low) & (share < low + sixteenths))
        copies = max(1, (tokens or 0) * sixteenths // 16 // COPY_TOKENS)
        p = _round(part.coalesce(copies), p, words, rate)
        low += sixteenths
    return Model(p, words, n, counts, tokens or 0, distinct)


def score_texts(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """One row per different text: ``text_key`` (xxhash64), ``n_tokens``, ``n_known``, ``base_score``, ``score``.

    ``n_tokens`` counts the words and the end, ``n_known`` those seen in training. ``base_score`` adds
    up log10 of (count + 1) / (tokens + distinct + 1); ``score`` is the model's log10 probability of
    the whole text. A null text counts as empty: its end alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.parameters, model.words, model.word_counts))

    def work(batches):
        p, known, n = shared.value
        table = bytewords.Table(known)
        logs_of = np.append(np.log10(n + 1.0), 0.0)  # The last is for words not in the table.
        part = TaskContext.get().partitionId()
        seen: set[int] = set()
        held: list[tuple] = []
        total = 0

        def done():
            keys = np.concatenate([x[0] for x in held])
            found = np.concatenate([x[1] for x in held])
            hashes = np.concatenate([x[2] for x in held])
            bounds = np.append(0, np.cumsum(np.concatenate([x[3] for x in held])))
            lanes = int(np.clip(len(found) // (STEPS * WINDOWS), 8, LANES))
            inside = (found >= 0) & (found < VOCABULARY)
            ids = np.where(inside, found, VOCABULARY).astype(np.int32)
            model_logs = gru.score(p, ids, bounds, n=lanes, steps=STEPS)
            each = logs_of[found]

            def per_text(x):
                return np.diff(np.append(0, np.cumsum(x))[bounds])

            yield rows(
                len(keys), text_key=keys, n_tokens=np.diff(bounds), n_known=per_text(found >= 0),
                logs=per_text(each), n_outside=per_text(~inside), outside_logs=per_text(np.where(inside, 0, each)),
                model=model_logs,
            )
            rare = np.flatnonzero(found < 0)
            if len(rare):
                of = np.repeat(np.arange(len(keys)), np.diff(bounds))[rare]
                order = np.lexsort((hashes[rare], of))
                of, word = of[order], hashes[rare][order]
                first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (word[1:] != word[:-1])]))
                yield rows(
                    len(first), text_key=keys[of[first]], word=word[first].view(np.int64),
                    n_tokens=np.diff(np.append(first, len(of))),
                )

        def rows(count, **columns):
            arrays = [
                pa.array(columns[c]).cast(t) if c in columns else pa.nulls(count, t) for c, t in fields.items()
            ]
            arrays[1] = pa.array(np.full(count, part, np.int32))
            return pa.RecordBatch.from_arrays(arrays, list(fields))

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for first, last, own, at in _tokens(*bytewords.text_bytes(batch.column(1))):
                new = np.array([k not in seen and not seen.add(k) for k in keys[first:last].tolist()])
                mine = np.repeat(new, np.diff(at))
                held.append((keys[first:last][new], table.find(own[mine]), own[mine], np.diff(at)[new]))
                total += int(mine.sum())
                if total >= CHUNK:
                    yield from done()
                    held.clear()
                    total = 0
        if total:
            yield from done()

    whole, real = pa.int64(), pa.float64()
    fields = {
        "text_key": whole, "part": pa.int32(), "word": whole, "n_tokens": whole, "n_known": whole,
        "logs": real, "n_outside": whole, "outside_logs": real, "model": real,
    }
    texts = docs.select(F.xxhash64(whole_text(text)).alias("text_key"), whole_text(text).alias("text"))
    found = written(texts.mapInArrow(
        work, "text_key long, part int, word long, n_tokens long, n_known long, logs double, "
        "n_outside long, outside_logs double, model double",
    ), "lm-texts")
    # A text met by several tasks: one of them counts.
    one = found.where("word is null").drop("word").withColumn("first", F.struct(
        "part", "n_tokens", "n_known", "logs", "n_outside", "outside_logs", "model"
    )).groupBy("text_key").agg(F.min("first").alias("first")).select("text_key", "first.*")
    rare = (
        found.where("word is not null").select("text_key", "part", "word", F.col("n_tokens").alias("times"))
        .join(model.counts, "word")
        .groupBy("text_key", "part")
        .agg(
            F.sum("times").alias("rare_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("rare_logs"),
        )
    )
    rows = one.join(rare, ["text_key", "part"], "left")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return rows.select(
        "text_key", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * math.log10(model.tokens + model.distinct + 1)).alias("base_score"),
        (
            F.col("model") / math.log(10) + F.col("outside_logs") + rare_logs
            - F.col("n_outside") * math.log10(model.outside)
        ).alias("score"),
    )


def scored(docs: DataFrame, training: Column, *, text: str = "text") -> DataFrame:
    """The rows with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows where ``training`` holds. Columns of these names are replaced.
    """
    own = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    docs = docs.drop(*(c for c in docs.columns if c.lower() in own and c != text))
    key = fresh("lm_key", docs)
    model = train_model(docs.where(training), text)
    scores = score_texts(docs, model, text=text).withColumnRenamed("text_key", key)
    rows = docs.withColumn(key, F.xxhash64(whole_text(text)))
    return rows.join(scores, key, "left").withColumn("train_tokens", F.lit(model.tokens).cast("long")).drop(key)
