"""Repeated passages by suffix arrays over shards of candidate text.

Every string of ``length`` bytes is owned by the least, by hash, of its ``GRAM``-byte grams
(leftmost if several are equal), which its content alone decides. So equal strings are owned by equal grams, and the strings that an
occurrence of a gram owns start side by side: a segment. Segments go to shards by their gram; where
segments of one gram differ, each different one is put once into the shard's text, whose suffix
array and permuted common prefixes show which of its strings start twice. Segments that occur
twice as a whole are repeated throughout and need not be compared again. Each start in a document
lies in one segment, so a string never meets itself.

A gram whose different segments are longer together than a shard (a short passage in many
surroundings) is not put into one array: its strings are counted by gram and 64-bit hash of the whole
string, each of which is a key of its own, so the gram is dealt over all tasks.

Only grams, segment hashes and places are shuffled, then each different segment of a repeated gram
once: copies combine before they move, and a gram with one segment, however frequent, moves none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foyer.llm import bytewords, suffixes
from foyer.llm.common import fresh, named, whole_text, written

LENGTH, GRAM = 400, 200
#: Bytes of text at which a suffix array closes; a gram with more is dealt by its strings. So an array has
#: at most twice as many.
SHARD = 1 << 21
#: Strings that occur more often than this share of all are sent to all tasks: there are at most so many.
FREQUENT_STRINGS = 1 << 16
#: Bytes of a side that may be sent to all tasks; beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20
_PLACE_BITS = np.uint64(28)
_PIECE = 1 << 23
_HELD_STRINGS = 1 << 18


def segments(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Segments of a block: text number, first start, starts, the gram's hash, the segment's hash."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = bytewords.Prefix(data)
    at = np.arange(len(data) - gram + 1)
    hashes = prefix.hashes(at, at + gram)
    places = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    least = (hashes & ~places) | at.astype(np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: span - width], least[width - span :])
    owner = (least & places).astype(np.int64)
    starts = np.arange(len(owner))
    text = np.searchsorted(bounds, starts, "right") - 1
    whole = starts + length <= bounds[np.minimum(text + 1, len(bounds) - 1)]
    starts, owner, text = starts[whole], owner[whole], text[whole]
    if not len(starts):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    low = starts[first]
    own = prefix.hashes(low, low + count - 1 + length)
    own = bytewords.mix(own ^ (owner[first] - low).astype(np.uint64))
    return text[first], low, count, hashes[owner[first]], own


def _pieces(raw: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Blocks (bytes, bounds, first text, offset in it); a long text comes in overlapping pieces."""
    for first, last in bytewords.blocks(bounds):
        size = bounds[last] - bounds[first]
        if last - first == 1 and size > _PIECE:
            for low in range(0, int(size) - length + 1, _PIECE):
                part = raw[bounds[first] + low : min(bounds[first] + low + _PIECE + length - 1, bounds[last])]
                yield part, np.array([0, len(part)]), first, low
        else:
            yield raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], first, 0


def _scan(length: int, gram: int):
    def scan(batches):
        seen: set[int] = set()
        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(1))
            keys = batch.column(0).to_numpy()
            fresh_text = np.zeros(len(keys), bool)
            for i, key in enumerate(keys.tolist()):
                if key not in seen:
                    seen.add(key)
                    fresh_text[i] = True
            for data, own, first, offset in _pieces(raw, bounds, length):
                text, low, count, grams, hashes = segments(data, own, length, gram)
                keep = fresh_text[text + first]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[text + first][keep]), pa.array((low - own[text] + offset)[keep]),
                    pa.array(count[keep].astype(np.int32)),
                    pa.array(grams[keep].view(np.int64)), pa.array(hashes[keep].view(np.int64)),
                ], ["text_key", "low", "starts", "gram", "segment"])

    return scan


def _cut(length: int):
    """The bytes of wanted segments, from rows (text, wanted)."""

    def cut(batches):
        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(0))
            wanted = batch.column(1)
            at = wanted.offsets.to_numpy()
            low, starts, gram, segment = (
                wanted.values.field(i).to_numpy() for i in range(4)
            )
            grams, hashes, counts, parts = [], [], [], []
            for i in range(batch.num_rows):
                for j in range(at[i], at[i + 1]):
                    begin = bounds[i] + low[j]
                    grams.append(gram[j])
                    hashes.append(segment[j])
                    counts.append(starts[j])
                    parts.append(raw[begin : begin + starts[j] - 1 + length].tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(grams, pa.int64()), pa.array(hashes, pa.int64()), pa.array(counts, pa.int32()),
                pa.array(parts, pa.binary()),
            ], ["gram", "segment", "starts", "bytes"])

    return cut


def _strings(length: int):
    """The hash of each string of wanted segments, from rows (text, wanted)."""

    def scan(batches):
        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(0))
            wanted = batch.column(1)
            at = wanted.offsets.to_numpy()
            low, starts, gram, segment = (wanted.values.field(i).to_numpy() for i in range(4))
            held, size = [], 0
            for i in range(batch.num_rows):
                for j in range(at[i], at[i + 1]):
                    begin = bounds[i] + low[j]
                    own = np.arange(starts[j])
                    hashes = bytewords.Prefix(raw[begin : begin + starts[j] - 1 + length]).hashes(own, own + length)
                    held.append((np.full(len(own), gram[j]), np.full(len(own), segment[j]), own.astype(np.int32), hashes.view(np.int64)))
                    size += len(own)
                    if size >= _HELD_STRINGS:
                        yield done(held)
                        held, size = [], 0
            if held:
                yield done(held)

    def done(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], ["gram", "segment", "at", "string"]
        )

    return scan


def _repeated_starts(parts: list[np.ndarray], starts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each part, which of its first starts begin a string that starts twice in the shard."""
    sizes = np.array([len(p) + 1 for p in parts])
    begin = np.cumsum(sizes) - sizes
    text = np.full(int(sizes.sum()) + 1, suffixes.SEPARATOR, np.uint8)
    for at, part in zip(begin, parts, strict=True):
        text[at : at + len(part)] = part + suffixes.SHIFT
    text[-1] = 0
    array = suffixes.suffix_array(text)
    before, shared = suffixes.common_prefixes(text, array)
    twice = shared >= length
    twice[before[twice]] = True
    return [twice[at : at + n] for at, n in zip(begin, starts, strict=True)]


def _shards(length: int):
    """Repeated runs of starts of each segment, from the segments of a partition sorted by gram."""

    def work(batches):
        held, size, now = [], 0, None
        for batch in batches:
            gram, segment, starts = (batch.column(i).to_numpy() for i in range(3))
            data = batch.column(3)
            for i in range(batch.num_rows):
                if size >= SHARD and gram[i] != now:
                    yield from done(held)
                    held, size = [], 0
                now = gram[i]
                part = np.frombuffer(data[i].as_buffer(), np.uint8)
                held.append((gram[i], segment[i], int(starts[i]), part))
                size += len(part)
        if held:
            yield from done(held)

    def done(held):
        out = []
        found = _repeated_starts([x[3] for x in held], np.array([x[2] for x in held]), length)
        for (gram, segment, _, _), twice in zip(held, found, strict=True):
            if twice.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[False], twice, [False]]).astype(np.int8)))
                out.append((gram, segment, [
                    {"at": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)
                ]))
        yield pa.RecordBatch.from_arrays([
            pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
            pa.array([x[2] for x in out], pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))),
        ], ["gram", "segment", "runs"])

    return work


def _merged(length: int):
    """Byte spans (start, end) covered by a text's runs of starts, joined where they touch."""

    def merge(batches):
        for batch in batches:
            runs = batch.column(1)
            at = runs.offsets.to_numpy()
            low, n = runs.values.field(0).to_numpy(), runs.values.field(1).to_numpy()
            out = []
            for i in range(batch.num_rows):
                a, b = low[at[i] : at[i + 1]], n[at[i] : at[i + 1]]
                order = np.argsort(a, kind="stable")
                a, reach = a[order], np.maximum.accumulate(a[order] + b[order] - 1 + length)
                first = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
                last = np.append(first[1:], len(a)) - 1
                out.append([
                    {"start": int(x), "end": int(y)} for x, y in zip(a[first], reach[last], strict=True)
                ])
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, spans)], ["text_key", "spans"])

    return merge


def _small(frame: DataFrame, size: Column) -> DataFrame:
    """The frame, marked for broadcast if its rows take few bytes."""
    few = (frame.agg(F.sum(size)).head()[0] or 0) <= BROADCAST_BYTES
    return F.broadcast(frame) if few else frame


def _runs_by_string(long: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Repeated runs of starts of wanted segments, without bringing a gram's segments together.

    A text that several rows share counts its strings once per row, which is right: they repeat.
    """
    keys = ["gram", "string"]
    strings = written(
        long.join(_small(wanted, 40 + 32 * F.size("wanted")), "text_key").select("text", "wanted")
        .mapInArrow(_strings(length), "gram long, segment long, at int, string long"),
        "repeats-strings",
    )
    repeated = written(strings.groupBy(*keys).agg(F.count("*").alias("times")).where("times > 1"), "repeats-strings-twice")
    total = repeated.agg(F.sum("times")).head()[0] or 0
    often = F.col("times") > total // FREQUENT_STRINGS
    # What is frequent never meets in one task; of the rest no key has more than a small share of the rows.
    frequent = F.broadcast(repeated.where(often).select(*keys, F.lit(True).alias("often")))
    marked = strings.join(frequent, keys, "left")
    rest = _small(repeated.where(~often).select(*keys), F.lit(16))
    twice = marked.where("often").select("gram", "segment", "at").union(
        marked.where("often is null").join(rest, keys).select("gram", "segment", "at")
    )
    ats = twice.groupBy("gram", "segment").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    begins = F.filter("ats", lambda x, i: (i == 0) | (F.get("ats", i - 1) < x - 1))
    ends = F.filter("ats", lambda x, i: (i == F.size("ats") - 1) | (F.get("ats", i + 1) > x + 1))
    runs = F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("at"), (b - a + 1).alias("n")))
    return ats.select("gram", "segment", runs.alias("runs"))


def repeated_spans(
    docs: DataFrame, *, text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Spans of the bytes that strings of ``length`` bytes cover which also start elsewhere.

    One row (``text_key``, ``spans``: array of (start, end), in bytes, end exclusive, sorted,
    apart) per different text that has any; ``text_key`` is ``xxhash64`` of the text, null as empty.
    Elsewhere is any other place in any row, the same text included; strings do not cross texts. So a
    text of ``length`` bytes or more that two rows share is covered whole. Shorter, empty and null
    texts have no spans; an empty table gives none.
    """
    rows = docs.select(whole_text(text).alias("text")).select(F.xxhash64("text").alias("text_key"), "text")
    long = rows.where(F.octet_length("text") >= length)
    found = written(
        long.mapInArrow(
            _scan(length, gram), "text_key long, low long, starts int, gram long, segment long"
        ).dropDuplicates(["text_key", "low"]),
        "repeats-segments",
    )
    kinds = written(
        found.groupBy("gram", "segment").agg(
            F.count("*").alias("times"), F.min(F.struct("text_key", "low", "starts")).alias("one")
        ),
        "repeats-kinds",
    )
    grams = kinds.groupBy("gram").agg(
        F.count("*").alias("kinds"), F.sum(F.col("one.starts") + F.lit(length - 1)).alias("bytes")
    )
    grams = kinds.join(grams, "gram").where("kinds > 1 or times > 1")
    # Segments whose gram fits a shard, and those whose gram does not, by the text to cut them from.
    chosen = written(
        grams.where("kinds > 1").select(
            "one.text_key", (F.col("bytes") > SHARD).alias("hot"),
            F.struct("one.low", "one.starts", "gram", "segment").alias("want"),
        ).groupBy("text_key", "hot").agg(F.collect_list("want").alias("wanted")),
        "repeats-wanted",
    )
    wanted, hot = (chosen.where(of).select("text_key", "wanted") for of in ("not hot", "hot"))
    sent = _small(wanted, 40 + 32 * F.size("wanted"))
    parts = long.join(sent, "text_key").select("text", "wanted").mapInArrow(
        _cut(length), "gram long, segment long, starts int, bytes binary"
    )
    runs = (
        parts.repartition("gram").dropDuplicates(["gram", "segment"]).sortWithinPartitions("gram")
        .mapInArrow(_shards(length), "gram long, segment long, runs array<struct<at:int,n:int>>")
    )
    if not hot.isEmpty():
        runs = runs.union(_runs_by_string(long, hot, length))
    # What is known of each segment: repeated as a whole, or these runs of its starts.
    whole = F.array(F.struct(F.lit(0).alias("at"), F.col("one.starts").alias("n")))
    known = written(
        grams.where("times > 1").select("gram", "segment", whole.alias("runs")).union(
            written(runs, "repeats-runs")
            .join(grams.where("times > 1").select("gram", "segment"), ["gram", "segment"], "left_anti")
            .select("gram", "segment", "runs")
        ),
        "repeats-known",
    )
    runs = found.join(known, ["gram", "segment"]).select("text_key", "low", F.explode("runs").alias("run")).select(
        "text_key", F.struct((F.col("low") + F.col("run.at")).alias("low"), F.col("run.n").cast("long").alias("n")).alias("run")
    )
    shared = (
        long.groupBy("text_key").agg(F.count("*").alias("times"), F.max(F.octet_length("text")).alias("size"))
        .where("times > 1")
        .select("text_key", F.struct(
            F.lit(0).cast("long").alias("low"), (F.col("size") - length + 1).cast("long").alias("n")
        ).alias("run"))
    )
    return (
        runs.union(shared).groupBy("text_key").agg(F.collect_list("run").alias("runs"))
        .mapInArrow(_merged(length), "text_key long, spans array<struct<start:long,end:long>>")
    )


def without_repeats(
    docs: DataFrame, *, text: str = "text", length: int = LENGTH, spans_column: str = "spans",
    kept_column: str = "kept_bytes",
) -> DataFrame:
    """The rows with their repeated spans and the bytes that remain, on end.

    A row without repeats has no spans and all its bytes. Columns of the two names are replaced.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() in (spans_column, kept_column) and c != text))
    key = fresh("repeats_key", docs)
    spans = written(repeated_spans(docs, text=text, length=length), "repeats-spans")
    spans = _small(spans, 40 + 32 * F.size("spans")).select(
        F.col("text_key").alias(key), F.col("spans").alias(spans_column)
    )
    rows = docs.withColumn(key, F.xxhash64(whole_text(text))).join(spans, key, "left").drop(key)
    data = F.to_binary(whole_text(text), F.lit("utf-8"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    rows = rows.withColumn(spans_column, F.coalesce(named(spans_column), empty))

    def cut(done: Column, span: Column) -> Column:
        part = F.substring(data, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        return F.struct(span["end"].alias("at"), F.concat(done["out"], part).alias("out"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("out"))
    kept = F.aggregate(named(spans_column), begin, cut, lambda done: F.concat(
        done["out"],
        F.substring(data, (done["at"] + 1).cast("int"), F.octet_length(data)),
    ))
    return rows.withColumn(kept_column, F.when(F.size(named(spans_column)) == 0, data).otherwise(kept))
