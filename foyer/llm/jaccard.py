"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Documents with equal n-gram sets are one row of the incidence. Of each row only a size-derived part
can start an overlap large enough to matter: with the n-grams in one global order, two sets that
link share one among the first n - ceil(t n) + 1 of the longer and the first n - ceil(2t/(1+t) n) + 1
of the shorter. These entries are dealt into blocks by n-gram; a block multiplies its columns and
discards the pairs whose sizes or places bound the overlap below what a link needs. The pairs
left are compared by sketches, which bound how many n-grams they can share, and then counted
exactly, set against set.

Skew. The order puts very frequent n-grams last, so only documents that consist of little else have
them in their part. A column with many rows makes no pair of all of them: each is counted
against the column's first row, then those outside the column's largest component against a row
inside; the links found are merged each time. At last, in columns that still hold several components, the
rows outside the largest one meet all others in parts of bounded size, by the same bounds and sketch against
sketch, and only pairs that pass are made. Copies combine before the shuffle.

A set is known by a 64-bit hash and so is an n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.llm import bytewords
from foyer.llm.common import fresh, most_frequent, named, whole_text, written
from foyer.llm.components import components
from foyer.llm.outsiders import PART, Rows, dealt

N, PERCENT = 5, 75
#: N-grams moved to the end of the order, at most; and when one counts as frequent.
FREQUENT, FREQUENT_IN_TASK, TASK_GRAMS = 1_000_000, 3, 1 << 22
#: Columns with more rows than this are linked by their first row before pairs are made.
SMALL_COLUMN = 3
#: Rounds in which rows of long columns are drawn into the largest component, before all pairs are made.
TURNS = 3
#: Rows counted against one set in one go.
GROUP_ROWS = 500
#: Rows of a side that may be sent to all tasks; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000

#: Bits of a set's parity sketch.
SKETCH = 4096

_ORDER = bytewords.mix(np.arange(101, 101 + 64, dtype=np.uint64))


def gram_sets(raw: np.ndarray, bounds: np.ndarray, n: int = N) -> Iterator[tuple[int, np.ndarray]]:
    """For each text of a run, its number and its set of n-grams as sorted hashes."""
    for first, last in bytewords.blocks(bounds):
        data = bytewords.LOWER[raw[bounds[first] : bounds[last]]]
        starts, ends, at = bytewords.words(data, bounds[first : last + 1] - bounds[first])
        word = bytewords.Prefix(data).hashes(starts, ends)
        grams = word * _ORDER[0]
        for k in range(1, n):
            grams[: len(word) - k] += word[k:] * _ORDER[k]
        grams = bytewords.mix(grams)
        for i in range(last - first):
            a, b = at[i], at[i + 1]
            if b - a >= n:
                own = np.sort(grams[a : b - n + 1])
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif b > a:  # The whole sequence as one, apart from every n-gram.
                own = (word[a:b] * _ORDER[: b - a]).sum(keepdims=True) + np.uint64(b - a)
                own = bytewords.mix(own ^ _ORDER[n])
            else:
                own = grams[:0]
            yield first + i, own


def set_hash(own: np.ndarray) -> int:
    """One hash for a set, as a signed 64-bit number."""
    both = np.array([own.sum(), np.bitwise_xor.reduce(own) + np.uint64(len(own))], np.uint64)
    return int(bytewords.mix(bytewords.mix(both[:1]) + both[1:]).view(np.int64)[0])


def sketch(own: np.ndarray) -> bytes:
    """Parities of the n-grams per bit: bits that differ are at most the n-grams that differ."""
    bits = np.bincount((own & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def _sets(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Key, ``node``, ``n_grams`` of each row, a sketch where a task first meets a node; and counts

    of n-grams frequent in a task.
    """
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches):
        seen, grams, held = set(), [], 0

        def frequent():
            if grams:
                found, counts = np.unique(np.concatenate(grams), return_counts=True)
                found, counts = found[counts >= FREQUENT_IN_TASK], counts[counts >= FREQUENT_IN_TASK]
                if len(found):
                    yield _batch(gram=found.view(np.int64), count=counts.astype(np.int64))

        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(1))
            nodes, sizes, sketches = [], [], []
            for _, own in gram_sets(raw, bounds, n):
                node = set_hash(own) if len(own) else None
                nodes.append(node)
                sizes.append(len(own))
                sketches.append(None)
                if node is not None and node not in seen:
                    seen.add(node)
                    sketches[-1] = sketch(own)
                    grams.append(own)
                    held += len(own)
                if held >= TASK_GRAMS:
                    yield from frequent()
                    grams, held = [], 0
            yield _batch(
                key=batch.column(0), text_key=batch.column(2), node=pa.array(nodes, pa.int64()),
                n_grams=pa.array(sizes, pa.int64()), sketch=pa.array(sketches, pa.binary()),
            )
        yield from frequent()

    names = {
        "key": kind, "text_key": "long", "node": "long", "n_grams": "long", "sketch": "binary",
        "gram": "long", "count": "long",
    }
    types: dict[str, pa.DataType] = {"sketch": pa.binary()}

    def _batch(**columns):
        n_rows = len(next(iter(columns.values())))
        arrays = []
        for name in names:
            if name in columns:
                arrays.append(columns[name] if isinstance(columns[name], pa.Array) else pa.array(columns[name]))
            else:
                arrays.append(pa.nulls(n_rows, types.get(name, pa.int64())))
        return pa.RecordBatch.from_arrays(arrays, list(names))

    def typed(batches):
        def noted():
            for batch in batches:
                types["key"] = batch.schema.field(0).type
                yield batch

        yield from scan(noted())

    rows = docs.select(
        named(key).alias("key"), whole_text(text).alias("text"), F.xxhash64(whole_text(text)).alias("text_key")
    )
    return rows.mapInArrow(typed, ", ".join(f"{c} {t}" for c, t in names.items()))


def _needed(size: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap with any set that links."""
    return -(-percent * size // 100)


def _pair_needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of two sets that link: 100 o >= percent (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def _entries(docs: DataFrame, text: str, n: int, percent: int, frequent: DataFrame) -> DataFrame:
    """The part of each distinct set that can start an overlap: (gram, node, size, place)."""
    found = frequent.toPandas()
    last, times = found["gram"].to_numpy(np.int64), found["count"].to_numpy(np.int64)
    last = last[np.lexsort((last, times))]
    order = np.argsort(last.view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast((last.view(np.uint64)[order], order))

    def scan(batches):
        hot, rank = shared.value
        low = np.zeros(1 << 23, bool)
        low[(hot & np.uint64((1 << 23) - 1)).astype(np.int64)] = True
        seen = set()
        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(0))
            out = []
            for _, own in gram_sets(raw, bounds, n):
                if not len(own) or (node := set_hash(own)) in seen:
                    continue
                seen.add(node)
                size = len(own)
                take = size - int(_needed(np.int64(size), percent)) + 1
                maybe = np.flatnonzero(low[(own & np.uint64((1 << 23) - 1)).astype(np.int64)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(hot, own[maybe]), len(hot) - 1)
                    is_hot = hot[at] == own[maybe]
                    if is_hot.any():
                        place = maybe[is_hot]
                        behind = own[place[np.argsort(rank[at[is_hot]])]]
                        own = np.concatenate([np.delete(own, place), behind])
                out.append((own[:take], node, size))
            if out:
                lengths = [len(x[0]) for x in out]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([x[0] for x in out]).view(np.int64)),
                    pa.array(np.repeat(np.array([x[1] for x in out], np.int64), lengths)),
                    pa.array(np.repeat(np.array([x[2] for x in out], np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])),
                ], ["gram", "node", "size", "place"])

    return docs.select(whole_text(text).alias("text")).mapInArrow(
        scan, "gram long, node long, size int, place int"
    )


def _bounded(a, b, size, place, percent: int) -> np.ndarray:
    """Which pairs of entries (by index) can belong to sets that link."""
    need = _pair_needed(size[a], size[b], percent)
    room = np.minimum(size[a] - place[a], size[b] - place[b])
    short = np.minimum(size[a], size[b])
    return (room >= need) & (100 * short >= percent * np.maximum(size[a], size[b]))


def _product(percent: int):
    """Pairs of a block of columns, and the entries of its long columns."""

    def multiply(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        gram, node, size, place = (table.column(i).to_numpy() for i in range(4))
        size, place = size.astype(np.int64), place.astype(np.int64)
        order = np.lexsort((node, gram))
        gram, node = gram[order], node[order]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])])
        gram, node, size, place = gram[new], node[new], size[order][new], place[order][new]
        head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        rows = np.diff(np.append(head, len(gram)))
        first, count = np.repeat(head, rows), np.repeat(rows, rows)
        at = np.arange(len(gram))
        pairs = []
        for step in range(1, SMALL_COLUMN):
            a = at[(count <= SMALL_COLUMN) & (at + step < first + count)]
            pairs.append((a, a + step))
        long = count > SMALL_COLUMN
        a = at[long & (at > first)]
        pairs.append((first[a], a))
        a, b = (np.concatenate(side) for side in zip(*pairs, strict=True))
        good = _bounded(a, b, size, place, percent)
        a, b = a[good], b[good]
        found = np.unique(np.stack([node[a], node[b]], 1), axis=0)
        yield _rows(np.zeros(len(found), np.int64), found[:, 0], found[:, 1], None, None)
        yield _rows(gram[long], node[long], None, size[long], place[long])

    def _rows(gram, u, v, size, place):
        empty = pa.nulls(len(u), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(x) if x is not None else empty for x in (gram, u, v, size, place)],
            ["gram", "u", "v", "size", "place"],
        )

    return multiply


def _toward(percent: int, turn: int):
    """For each row of a long column outside the column's largest component, one within it."""

    def link(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        gram, node, size, place, root = (table.column(i).to_numpy() for i in range(5))
        order = np.lexsort((node, root, gram))
        gram, node, size, place, root = (x[order] for x in (gram, node, size, place, root))
        run = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (root[1:] != root[:-1])))
        length = np.diff(np.append(run, len(gram)))
        by_length = np.lexsort((length, gram[run]))
        last = np.append(gram[run][by_length][1:] != gram[run][by_length][:-1], True)
        largest = by_length[last]  # One run per column, by rising n-gram.
        column = np.searchsorted(gram[run][largest], gram)
        begin, n = run[largest][column], length[largest][column]
        outside = np.flatnonzero(root != root[begin])
        drawn = bytewords.mix((node ^ gram)[outside].view(np.uint64) + np.uint64(turn))
        inside = begin[outside] + (drawn % n[outside].astype(np.uint64)).astype(np.int64)
        good = _bounded(outside, inside, size, place, percent)
        found = np.stack([node[outside[good]], node[inside[good]]], 1)
        found = np.unique(np.sort(found, axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    return link


def _across(percent: int):
    """Rows (part, outside, node, size, place, root, sketch) by part, outsiders first: pairs of an outsider and a

    row of another component within the bounds, those of the sketches too.
    """
    def meet(batches):
        now, held = None, None
        for batch in batches:
            rows, u, v = Rows(batch, SKETCH // 8), [], []
            part, outside, *fields = rows.columns
            words = rows.marks.view(np.uint64)
            for first, last in rows.runs():
                if part[first] != now:
                    now, held = part[first], None
                split = first + int(np.count_nonzero(outside[first:last] == 0))
                if split > first:
                    more = *(column[first:split].astype(np.int64) for column in fields), words[first:split]
                    held = more if held is None else tuple(map(np.concatenate, zip(held, more, strict=True)))
                for at in range(split, last) if held is not None else ():  # A part may have drawn no outsider.
                    node, size, place, root = (int(column[at]) for column in fields)
                    its_node, its_size, its_place, its_root, its_words = held
                    need = _pair_needed(its_size, np.int64(size), percent)
                    room = np.minimum(its_size - its_place, size - place)
                    short, long = np.minimum(its_size, size), np.maximum(its_size, size)
                    live = np.flatnonzero((its_root != root) & (room >= need) & (100 * short >= percent * long))
                    if len(live):
                        apart = np.bitwise_count(its_words[live] ^ words[at]).sum(1, dtype=np.int64)
                        found = live[apart <= its_size[live] + size - 2 * need[live]]
                        u.append(its_node[found])
                        v.append(np.full(len(found), node))
            none = np.zeros(0, np.int64)
            pairs = np.sort(np.stack([np.concatenate([none, *u]), np.concatenate([none, *v])], 1), axis=1)
            pairs = np.unique(pairs, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    return meet


def _against(percent: int, links):
    """Rows (u, part, own, node, n_grams, data), sorted: the first of a part against its others."""

    def count(batches):
        now, leader = None, None
        for batch in batches:
            u, part, own, node, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            data = batch.column(5)
            found = []
            for i in range(batch.num_rows):
                mine = np.frombuffer(data[i].as_buffer(), np.uint64)
                if (u[i], part[i]) != now:
                    now, leader = (u[i], part[i]), None
                if own[i] == 0:
                    leader, leader_size = np.array(mine), size[i]
                elif links(leader, mine, int(leader_size), int(size[i]), percent):
                    found.append((u[i], node[i]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                    ["u", "v"],
                )

    return count


def _sets_link(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    at = np.minimum(np.searchsorted(a, b), n_a - 1)
    overlap = int((a[at] == b).sum())
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def _sketches_may(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """False only if the sets differ in more n-grams than two that link can."""
    least = -(-percent * (n_a + n_b) // (100 + percent))
    return int(np.bitwise_count(a ^ b).sum()) <= n_a + n_b - 2 * least


def _few(frame: DataFrame) -> DataFrame:
    """The frame, marked for broadcast if it has few rows; else its join shuffles."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _places(pairs: DataFrame) -> DataFrame:
    """Where a node's data has to go so that it meets those it is paired with: (u, part, own, node).

    All pairs of a ``u`` lie together, in parts of about ``GROUP_ROWS``, each with u itself.
    """
    parts = pairs.groupBy("u").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("parts"))
    arms = pairs.join(parts, "u").select(
        "u", F.pmod(F.hash("v"), F.col("parts")).alias("part"), F.lit(1).alias("own"), F.col("v").alias("node")
    )
    heads = parts.select(
        "u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("own"),
        F.col("u").alias("node"),
    )
    return written(arms.union(heads), "jaccard-places")


def _compared(data: DataFrame, places: DataFrame, percent: int, links) -> DataFrame:
    """Pairs (u, v) of the places that pass, from rows (node, n_grams, data)."""
    together = data.join(_few(places), "node").select("u", "part", "own", "node", "n_grams", "data")
    return together.repartition("u", "part").sortWithinPartitions("u", "part", "own").mapInArrow(
        _against(percent, links), "u long, v long"
    ).distinct()


def _verified(docs: DataFrame, rows: DataFrame, pairs: DataFrame, text: str, n: int, percent: int) -> DataFrame:
    """The pairs (u, v) that link: those whose sketches allow it, counted exactly."""
    pairs = written(pairs.select("u", "v").distinct(), "jaccard-pairs")
    sketches = rows.where("sketch is not null").select("node", "n_grams", F.col("sketch").alias("data"))
    pairs = written(_compared(sketches, _places(pairs), percent, _sketches_may), "jaccard-pairs")
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    keys = rows.join(_few(written(nodes, "jaccard-nodes")), "node", "left_semi").groupBy("node").agg(
        F.min("text_key").alias("text_key")
    )
    keys = written(keys.select("text_key"), "jaccard-keys")

    def sets(batches):
        seen = set()
        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(0))
            nodes, sizes, grams = [], [], []
            for _, own in gram_sets(raw, bounds, n):
                if len(own) and (node := set_hash(own)) not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sizes.append(len(own))
                    grams.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(grams, pa.binary())],
                ["node", "n_grams", "data"],
            )

    texts = docs.select(whole_text(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    texts = texts.join(_few(keys), "text_key", "left_semi").select("text")
    held = texts.mapInArrow(sets, "node long, n_grams long, data binary")
    return _compared(held, _places(pairs), percent, _sets_link)


def jaccard_groups(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT
) -> DataFrame:
    """Per row: ``key``, ``text_key``, ``n_grams`` (its set's size), ``node``, ``root``, ``group_key``.

    Texts link if 100 x intersection >= percent x union of their sets of n-word grams, words in
    lower case (A-Z). A text of fewer words has the whole sequence as its one gram; one without
    words, or null, has none, links with nothing and has a null ``node`` and its own key as
    ``group_key``. ``group_key`` is the least non-null key reachable by links, the row's own
    included, and null if there is none. Rows with equal sets have the same ``node``, and linked
    ones the same ``root``; repeated keys and rows are kept. An empty table gives an empty result.
    """
    scanned = written(_sets(docs, key, text, n), "jaccard-scan")
    rows = scanned.where("gram is null").drop("gram", "count")
    counts = scanned.where("gram is not null").groupBy("gram").agg(F.sum("count").alias("count"))
    frequent = most_frequent(written(counts, "jaccard-counts"), "gram", "count", FREQUENT)
    entries = _entries(docs, text, n, percent, frequent)
    blocks = written(
        entries.repartition("gram").mapInArrow(
            _product(percent), "gram long, u long, v long, size long, place long"
        ),
        "jaccard-blocks",
    )
    links = written(
        _verified(docs, rows, blocks.where("v is not null"), text, n, percent), "jaccard-links"
    )
    # Long columns: draw rows into the largest component as long as that merges any, then all across.
    long = blocks.where("v is null").select("gram", F.col("u").alias("node"), "size", "place")
    roots = components(links)
    turn = 0
    while True:
        last = turn == TURNS
        now = long.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        split = now.groupBy("gram").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
        now = written(now.join(split.select("gram"), "gram", "left_semi"), "jaccard-split")
        if last:
            apart = now.select("node").distinct()
            sketches = rows.where("sketch is not null").select("node", "sketch").join(apart, "node", "left_semi")
            sketches = written(sketches.dropDuplicates(["node"]), "jaccard-sketches")
            now = now.select("gram", "node", "size", "place").join(sketches, "node")
            now = dealt(now, roots, "gram", ("node", "size", "place", "root", "sketch"), PART)
            more = now.mapInArrow(_across(percent), "u long, v long")
        else:
            now = now.select("gram", "node", "size", "place", "root")
            more = now.repartition("gram").mapInArrow(_toward(percent, turn), "u long, v long")
        more = written(_verified(docs, rows, more, text, n, percent), "jaccard-links")
        merged = bool(more.head(1))
        if merged:
            links = written(links.union(more), "jaccard-links")
            roots = components(links)
        if last:
            break
        turn = turn + 1 if merged else TURNS
    roots = written(roots, "jaccard-roots")
    rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rows.where("root is not null").groupBy("root").agg(F.min("key").alias("group_key"))
    return (
        rows.join(least, "root", "left")
        .withColumn("group_key", F.when(F.col("root").isNull(), F.col("key")).otherwise(F.col("group_key")))
        .select("key", "text_key", "n_grams", "node", "root", "group_key")
    )


def one_per_group(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT
) -> DataFrame:
    """The rows without near copies: of each group of linked texts, the row of the least key stays.

    Null keys come last, equal ones go by their texts' hash, and of rows that repeat both one stays.
    Rows without words are linked with nothing, so all of them stay.
    """
    row = fresh("jaccard_row", docs)

    def identity(key_column, text_key):
        return F.xxhash64(key_column.isNull(), key_column, text_key)

    groups = jaccard_groups(docs, key=key, text=text, n=n, percent=percent)
    first = groups.where("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_key")).alias("first")
    )
    chosen = first.select(identity(F.col("first.key"), F.col("first.text_key")).alias(row))
    some = whole_text(text).rlike("[^\x20\x09-\x0D]")
    rows = docs.where(some).withColumn(row, identity(named(key), F.xxhash64(whole_text(text))))
    rows = rows.join(chosen, row, "left_semi").dropDuplicates([row]).drop(row)
    return rows.select(*map(named, docs.columns)).union(docs.where(~some))
