"""MinHash near-duplicates: minima of many universal hashes, banding, verification, components.

Texts with equal shingle sets are one node. A node's signature is the least value of each of H hashes
x -> a x + b (mod 2^32) over its shingles; bands of rows of it are buckets. Layout and bounds follow from the
threshold: a pair that links shares no bucket, or is dropped by its signatures, with a chance below ``MISS``.

A bucket never gives all its pairs. First its members meet one leader: the member nearest to the bucket's most
frequent values, which in a group of edited copies is the text they were made from. Pairs whose
signatures agree enough are counted on the full sets; links give components by alternating large-star
and small-star. Buckets that still hold several components go on: members outside a bucket's largest component
meet all others of the bucket, signature against signature, first with the nearest one alone as a pair,
as long as that merges any, then with every one that could link. What two members have in common is bounded by
what each has of their leader, counted exactly, and the shingles beside it that several members have: that
leaves out edited copies whose edits differ. Outsiders are dealt in parts of bounded size, past which the bucket
streams, so no task holds a bucket.

A set is known by a 64-bit hash and so is a shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.llm import bytewords
from foyer.llm.common import named, whole_text, written
from foyer.llm.components import components
from foyer.llm.jaccard import gram_sets, set_hash
from foyer.llm.outsiders import PART, Rows, dealt

N, PERCENT = 4, 80
#: Chance that a pair at the threshold is missed, by the bands and again by the signatures; most hashes.
MISS, MOST_HASHES = 1e-7, 256
#: Members of a bucket that its leader is chosen from.
HEAD = 4096
#: Rounds in which an outsider meets its nearest member alone.
TURNS = 1
#: Texts whose hashes may be sent to all tasks; beyond it texts are combined and joined by hash.
BROADCAST_ROWS = 2_000_000
_CHUNK = 2048
#: What goes along with the members of a bucket that others have yet to meet.
_FIELDS = ("bucket", "buckets", "node", "n_grams", "root", "common", "shared", "marks")


def layout(percent: int, miss: float = MISS, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows of a band: the longest rows whose bands, within ``most`` hashes, miss no more."""
    chance = percent / 100
    for rows in range(16, 0, -1):
        bands = 1 if chance == 1 else ceil(log(miss) / log(1 - chance**rows))
        if rows * bands <= most:
            return bands, rows
    raise ValueError(f"no layout of {most} hashes for a similarity of {percent} %")


def least_agreement(percent: int, hashes: int, miss: float = MISS) -> int:
    """Minima that a pair at the threshold has in common, but for a chance of ``miss``."""
    chance, total = percent / 100, 0.0
    for count in range(hashes + 1):
        total += comb(hashes, count) * chance**count * (1 - chance) ** (hashes - count)
        if total > miss:
            return count
    return hashes


def _family(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = bytewords.mix(np.arange(7001, 7001 + 2 * hashes, dtype=np.uint64)).astype(np.uint32)
    return seeds[:hashes] | np.uint32(1), seeds[hashes:]


def signature(own: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each hash over a set that is not empty."""
    times, plus = family
    folded = (own >> np.uint64(32)).astype(np.uint32)
    found = None
    for first in range(0, len(folded), _CHUNK):
        values = folded[first : first + _CHUNK, None] * times
        values += plus
        least = values.min(0)
        found = least if found is None else np.minimum(found, least)
    return found


def _buckets(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band, the band's number included."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in found[: bands * rows].reshape(bands, rows).T:
        key = bytewords.mix(key + column.astype(np.uint64))
    return key.view(np.int64)


def _scanned(docs: DataFrame, key: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """Key, ``text_key``, ``node``, ``n_grams``; buckets and marks where a task first meets a node.

    Marks are the low bytes of the minima: enough to compare signatures.
    """
    kind = docs.schema[key].dataType.simpleString()
    hashes = bands * rows

    def scan(batches):
        seen, family = set(), _family(hashes)
        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(1))
            nodes, sizes, buckets, marks = [], [], [], []
            for _, own in gram_sets(raw, bounds, n):
                node = set_hash(own) if len(own) else None
                nodes.append(node)
                sizes.append(len(own))
                if node is None or node in seen:
                    buckets.append(None)
                    marks.append(None)
                else:
                    seen.add(node)
                    found = signature(own, family)
                    buckets.append(_buckets(found, bands, rows))
                    marks.append(found.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(buckets, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["key", "text_key", "node", "n_grams", "buckets", "marks"],
            )

    texts = docs.select(
        named(key).alias("key"), whole_text(text).alias("text"), F.xxhash64(whole_text(text)).alias("text_key")
    )
    return texts.mapInArrow(
        scan, f"key {kind}, text_key long, node long, n_grams long, buckets array<long>, marks binary"
    )


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries (bucket, node) in order, those of buckets with several nodes, each once."""
    bucket, node, given = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in batches:
        if not batch.num_rows:
            continue
        # The last row so far goes along; ``given`` if it has come out.
        bucket = np.concatenate([bucket, batch.column(0).to_numpy()])
        node = np.concatenate([node, batch.column(1).to_numpy()])
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (node[1:] != node[:-1]))
        bucket, node = bucket[new], node[new]
        near = bucket[1:] == bucket[:-1]
        good = np.append(False, near) | np.append(near, False)
        if given:
            good[0] = False
        given = bool(good[-1]) or (given and len(good) == 1)
        yield pa.RecordBatch.from_arrays([pa.array(bucket[good]), pa.array(node[good])], ["bucket", "node"])
        bucket, node = bucket[-1:], node[-1:]


def _fits(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can link."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _leader(marks: np.ndarray) -> int:
    """The row that has most of the most frequent marks."""
    hashes = marks.shape[1]
    flat = marks.astype(np.int64) + 256 * np.arange(hashes)
    common = np.bincount(flat.ravel(), minlength=256 * hashes).reshape(hashes, 256).argmax(1)
    return int((marks == common).sum(1).argmax())


def _arrays(kinds: str, *columns: list[np.ndarray]) -> pa.RecordBatch:
    """Pieces of columns on end, as named longs and, after a ``?``, booleans."""
    arrays, names = [], kinds.split()
    for name, pieces in zip(names, columns, strict=True):
        none = np.zeros(0, bool if name.endswith("?") else np.int64)
        arrays.append(pa.array(np.concatenate([none, *pieces])))
    return pa.RecordBatch.from_arrays(arrays, [name.rstrip("?") for name in names])


def _star(percent: int, hashes: int):
    """Rows (bucket, node, n_grams, marks) by bucket, with the bucket's leader as ``hub`` and whether their

    signatures allow a link, ``near``.
    """
    least = least_agreement(percent, hashes)

    def lead(batches):
        now, held, leader = None, [], None  # A bucket that goes on in the next batch.

        def against(node, size, marks):
            one, its_size, its_marks = leader
            near = ((marks == its_marks).sum(1) >= least) & _fits(size, its_size, percent)
            for to, values in zip(out, (np.full(len(node), now), np.full(len(node), one), node, size, near), strict=True):
                to.append(values)
            held_marks.append(marks)

        def given():
            rows = _arrays("bucket hub node n_grams near?", *out)
            every = np.concatenate([np.zeros((0, hashes), np.uint8), *held_marks])
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(hashes), len(every), [None, pa.py_buffer(every)])
            return rows.append_column("marks", fixed.cast(pa.binary()))

        def chosen():
            nonlocal held, leader
            node, size, marks = (np.concatenate(part) for part in zip(*held, strict=True))
            at = _leader(marks) if len(node) > 2 else 0
            leader = node[at], size[at], marks[at]
            against(node, size, marks)
            held = []

        for batch in batches:
            rows, out, held_marks = Rows(batch, hashes), ([], [], [], [], []), []
            bucket, node, size = rows.columns
            for first, last in rows.runs():
                if bucket[first] != now:
                    if held:
                        chosen()
                    now, leader = bucket[first], None
                part = node[first:last], size[first:last], rows.marks[first:last]
                if leader is None:
                    held.append(part)
                    if sum(len(x[0]) for x in held) >= HEAD:
                        chosen()
                else:
                    against(*part)
            yield given()
        if held:
            out, held_marks = ([], [], [], [], []), []
            chosen()
            yield given()

    return lead


def _beyond(percent: int, hashes: int, nearest: bool):
    """Rows (part, outside, bucket, buckets, node, n_grams, root, common, shared, marks) by part, outsiders first:

    pairs of an outsider and a member of another component that may link, each by the first of the buckets
    that both are in; with ``nearest`` only the one whose signature agrees most. Two sets of a hub have in
    common what both have of it, at most, and shingles apart from the hub's that several sets of the hub have.
    """
    least = least_agreement(percent, hashes)

    def meet(batches):
        now, held, best = None, None, None

        def given():
            """The nearest members of the outsiders of the part that ends."""
            if nearest and held is not None:
                some = best[0] >= least
                out[0].append(held[0][some])
                out[1].append(best[1][some])

        for batch in batches:
            rows, out = Rows(batch, hashes), ([], [])
            part, outside, bucket, buckets, *fields = rows.columns
            for first, last in rows.runs():
                if part[first] != now:
                    given()
                    now, held = part[first], None
                split = first + int(np.count_nonzero(outside[first:last] == 0))
                if split > first:
                    more = *(column[first:split] for column in [*fields, buckets]), rows.marks[first:split]
                    held = more if held is None else tuple(map(np.concatenate, zip(held, more, strict=True)))
                    best = np.zeros(len(held[0]), np.int64), np.zeros(len(held[0]), np.int64)
                for at in range(split, last) if held is not None else ():  # A part may have drawn no outsider.
                    node, size, root, common, shared = (column[at] for column in fields)
                    its_node, its_size, its_root, its_common, its_shared, its_buckets, its_marks = held
                    need = -(-percent * (its_size + size) // (100 + percent))
                    room = np.minimum(its_common, common) + np.minimum(its_shared, shared)
                    apart = (its_common >= 0) & (common >= 0) & (room < need)
                    live = np.flatnonzero((its_root != root) & ~apart & _fits(its_size, size, percent))
                    if not len(live):
                        continue
                    agree = (its_marks[live] == rows.marks[at]).sum(1)
                    if nearest:
                        closer = agree > best[0][live]
                        best[0][live[closer]] = agree[closer]
                        best[1][live[closer]] = node
                    else:
                        mine = buckets[at]
                        found = [i for i in live[agree >= least] if np.intersect1d(its_buckets[i], mine)[0] == bucket[at]]
                        out[0].append(its_node[found])
                        out[1].append(np.full(len(found), node))
            yield _arrays("u v", *out)
        out = ([], [])
        given()
        yield _arrays("u v", *out)

    return meet


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Written pairs (u, v) with their full sets ``a`` and ``b``."""
    nodes = written(
        pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct(), "minhash-needed"
    )
    if nodes.count() <= BROADCAST_ROWS:
        sets = sets.join(F.broadcast(nodes), "node", "left_semi")  # Few sets travel then.
    with_v = pairs.join(sets.select(F.col("node").alias("v"), F.col("grams").alias("b")), "v")
    return with_v.join(sets.select(F.col("node").alias("u"), F.col("grams").alias("a")), "u")


def _counted(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The different pairs (u, v) with ``common``, the shingles in both full sets, and ``linked``."""
    pairs = written(pairs.select("u", "v").where("u <> v").distinct(), "minhash-pairs")
    both = _with_sets(pairs, sets).select(
        "u", "v", F.size(F.array_intersect("a", "b")).cast("long").alias("common"),
        (F.size("a") + F.size("b")).alias("n"),
    )
    linked = 100 * F.col("common") >= percent * (F.col("n") - F.col("common"))
    return written(both.select("u", "v", "common", linked.alias("linked")), "minhash-counted")


def _of_hubs(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, node, common, shared) of the pairs of hubs that have a member they do not link with.

    ``shared`` counts the node's shingles that the hub does not have and another of its members has.
    """
    hubs = stars.where("not linked").select("u").distinct()
    stars = written(stars.join(hubs, "u", "left_semi"), "minhash-hubs")
    apart = _with_sets(stars.select("u", "v"), sets).select("u", "v", F.explode(F.array_except("b", "a")).alias("gram"))
    apart = written(apart, "minhash-apart")
    several = apart.groupBy("u", "gram").agg(F.count("*").alias("n")).where("n > 1").select("u", "gram")
    shared = apart.join(several, ["u", "gram"], "left_semi").groupBy("u", "v").agg(F.count("*").alias("shared"))
    found = stars.join(shared, ["u", "v"], "left").select(
        F.col("u").alias("hub"), F.col("v").alias("node"), "common", F.coalesce("shared", F.lit(0).cast("long")).alias("shared")
    )
    return written(found, "minhash-common")


def _sets(docs: DataFrame, nodes: DataFrame, text: str, n: int) -> DataFrame:
    """(node, grams) of the nodes, from one text each."""
    texts = docs.select(whole_text(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    keys = written(nodes.select("text_key").distinct(), "minhash-keys")
    if keys.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(keys), "text_key", "left_semi")
    else:
        texts = texts.groupBy("text_key").agg(F.first("text").alias("text")).join(keys, "text_key", "left_semi")

    def work(batches):
        seen = set()
        for batch in batches:
            raw, bounds = bytewords.text_bytes(batch.column(0))
            found, grams = [], []
            for _, own in gram_sets(raw, bounds, n):
                if len(own) and (node := set_hash(own)) not in seen:
                    seen.add(node)
                    found.append(node)
                    grams.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(grams, pa.list_(pa.int64()))], ["node", "grams"]
            )

    sets = texts.select("text").mapInArrow(work, "node long, grams array<long>")
    return written(sets.dropDuplicates(["node"]), "minhash-sets")


def near_groups(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT
) -> DataFrame:
    """Per row: ``key``, ``n_grams`` (its set's size), ``node``, ``root``, ``group_key``, ``kept``.

    Texts link if 100 x intersection >= percent x union of their sets of n-word shingles, words in
    lower case (A-Z). A text of fewer words has the whole sequence as its one shingle; one without
    words, or null, has none, links with nothing, has a null ``node`` and its own key as ``group_key``.
    ``group_key`` is the least non-null key reachable by links, the row's own included, and null if there is
    none; ``kept`` says that it is the row's key, null equal to null. Rows with equal sets have the same ``node``
    and linked ones the same ``root``; repeated keys and rows stay, other columns do not count. An
    empty table gives an empty result.
    """
    bands, rows_in_band = layout(percent)
    hashes = bands * rows_in_band
    rows = written(_scanned(docs, key, text, n, bands, rows_in_band), "minhash-scan")
    first = rows.where("marks is not null")
    entries = first.select(F.explode("buckets").alias("bucket"), "node")
    entries = entries.repartition("bucket").sortWithinPartitions("bucket", "node")
    members = written(entries.mapInArrow(_meeting, "bucket long, node long"), "minhash-members")
    # One signature a node, for nodes that share a bucket with another.
    nodes = first.join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    nodes = written(nodes.select("node", "text_key", "n_grams", "marks"), "minhash-nodes")
    sets = _sets(docs, nodes, text, n)
    placed = members.join(nodes.select("node", "n_grams", "marks"), "node").select("bucket", "node", "n_grams", "marks")
    by_bucket = placed.repartition("bucket").sortWithinPartitions("bucket")
    stars = by_bucket.mapInArrow(
        _star(percent, hashes), "bucket long, hub long, node long, n_grams long, near boolean, marks binary"
    )
    stars = written(stars, "minhash-stars")
    pairs = stars.where("near").select(F.col("hub").alias("u"), F.col("node").alias("v"))
    counted = _counted(pairs, sets, percent)
    links = counted.where("linked").select("u", "v")
    roots = written(components(links), "minhash-roots")
    # In a bucket of two, all has been said. Of the others, what is known of members and their hubs goes along.
    larger = stars.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 2").select("bucket")
    stars = written(stars.drop("near").join(larger, "bucket", "left_semi"), "minhash-larger")
    of_node = stars.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))  # No more than bands.
    known = stars.join(_of_hubs(counted, sets), ["hub", "node"], "left").withColumns({
        "common": F.coalesce("common", F.lit(-1).cast("long")), "shared": F.coalesce("shared", F.lit(0).cast("long")),
    })
    placed = written(known.join(of_node, "node").drop("hub"), "minhash-known")
    turn = 0
    while True:
        # As long as meeting the nearest member alone merges any; at last every one that could link.
        last = turn == TURNS
        more = dealt(placed, roots, "bucket", _FIELDS, PART).mapInArrow(_beyond(percent, hashes, not last), "u long, v long")
        more = more.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        more = _counted(more, sets, percent).where("linked").select("u", "v")
        merged = bool(more.head(1))
        if merged:
            links = links.union(more)
            roots = written(components(links), "minhash-roots")
        if last:
            break
        turn = turn + 1 if merged else TURNS
    found = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = found.where("root is not null").groupBy("root").agg(F.min("key").alias("group_key"))
    found = found.select("key", "n_grams", "node", "root").join(least, "root", "left")
    group = F.when(F.col("root").isNull(), F.col("key")).otherwise(F.col("group_key"))
    return found.withColumn("group_key", group).select(
        "key", "n_grams", "node", "root", "group_key", F.col("group_key").eqNullSafe(F.col("key")).alias("kept")
    )
