"""Merkle manifest of a dataset: a tree per group, its leaves placed by bitmap rank.

A group's keys are a compressed bitmap: 64-bit words by key, of which only those with a bit set are
kept, as rows that a hash aggregate builds with map-side OR. Words carry a popcount directory of four
steps (word, 2^16 keys, 2^32, 2^48), each a running count within the step above, so no window holds more
than 65,536 rows whatever the keys are. A leaf's place is one rank query: the directory's count plus the
bits below its own. No sort of the leaves is made.

Levels are then reduced by slot: a place divided by 256 is a block, its rest the slot in the block's
array. A block makes two levels at once; blocks of blocks follow until each group has one node, and
the groups' nodes make a last tree in the same way. Steps of the proofs come down the same blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foyer.llm.common import named, written

#: Children of a node; and of a block of two levels. The expressions below shift by these.
FAN, BLOCK = 16, 256
#: Below the word of any key: rows without a key come first.
_NO_KEY = -(1 << 60)
#: A word's place in the directory: bits dropped from step to step.
_STEPS = (10, 16, 16)
#: Rows of repeated keys that one row is unfolded into in one go.
_UNFOLD_BITS = 16

_STEP_TYPE = "array<struct<before:string,after:string>>"


def field_bytes(value: Column) -> Column:
    """``-`` for a null, else the byte count, a colon and the value's text."""
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts on end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _rows(docs: DataFrame, key: str, group: str, fields: Sequence[str], changed: Mapping[str, Column]) -> DataFrame:
    """(g, key, word, bit, leaf, seen): ``g`` sorts null groups first, ``seen`` is the changed leaf or null."""
    value = named(key).cast("long")
    own = [field_bytes(named(name)) for name in fields]
    after = [field_bytes(changed.get(name, named(name))) for name in fields]
    same = F.lit(True)
    for name, column in changed.items():
        same = same & named(name).eqNullSafe(column)
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), named(group).cast("string")), F.lit("0")).alias("g"),
        value.alias("key"),
        F.when(value.isNull(), F.lit(_NO_KEY)).otherwise(F.shiftright(value, 6)).alias("word"),
        F.when(value.isNull(), F.lit(0)).otherwise(value.bitwiseAND(F.lit(63))).cast("int").alias("bit"),
        F.unhex(digest(*own)).alias("leaf"),
        F.when(~same, F.unhex(digest(*after))).alias("seen"),
    )


def _running(rows: DataFrame, keys: Sequence[str], order: str, n: str) -> Column:
    """The sum of ``n`` over the rows before this one."""
    from pyspark.sql import Window

    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(before), F.lit(0).cast("long"))


def _directory(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words with ``before``, the rows of the group in earlier words; and (g, n) of the groups."""
    levels = [words.withColumnRenamed("word", "at")]
    for step in _STEPS:
        wider = levels[-1].groupBy("g", F.shiftright("at", step).alias("at")).agg(F.sum("n").alias("n"))
        levels.append(wider)
    sizes = levels[-1].groupBy("g").agg(F.sum("n").alias("n"))
    done = levels[-1].withColumn("before", _running(levels[-1], ["g"], "at", "n"))
    for step, level in zip(reversed(_STEPS), reversed(levels[:-1]), strict=True):
        above = done.select("g", F.col("at").alias("up"), F.col("before").alias("base"))
        level = level.withColumn("up", F.shiftright("at", step))
        inside = level.withColumn("before", _running(level, ["g", "up"], "at", "n"))
        done = inside.join(above, ["g", "up"]).withColumn("before", F.col("before") + F.col("base")).drop("up", "base")
    return done.withColumnRenamed("at", "word"), sizes


def _unfolded(rows: DataFrame) -> DataFrame:
    """A row for each of the ``m`` equal rows that a row stands for, ``tie`` counting on."""
    step = 1 << _UNFOLD_BITS
    parts = rows.select("*", F.explode(F.expr(f"sequence(0L, (m - 1) div {step})")).alias("part"))
    # Parts of a row that stands for very many are dealt out before they are unfolded.
    parts = parts.repartition("g", "key", "leaf", "part")
    within = F.expr(f"sequence(part * {step}, least(m, (part + 1) * {step}) - 1)")
    return parts.select("*", F.explode(within).alias("more")).withColumn("tie", F.col("tie") + F.col("more")).drop("part", "more", "m")


def _ties(rows: DataFrame) -> DataFrame:
    """Rows of repeated keys with ``tie``, their number among the rows of the key, by leaf.

    Equal rows are one row until they have their numbers; the others are numbered in cells of the
    leaf's first 12 bits, so a key with very many rows is not sorted by one task.
    """
    one = ["g", "key", "word", "bit"]
    distinct = rows.groupBy(*one, "leaf", "seen").agg(F.count("*").alias("m"))
    distinct = written(distinct.withColumn("cell", F.substring(F.hex("leaf"), 1, 3)), "manifest-ties")
    cells = distinct.groupBy("g", "word", "bit", "cell").agg(F.sum("m").alias("rows"))
    cells = cells.withColumn("first", _running(cells, ["g", "word", "bit"], "cell", "rows")).drop("rows")
    inside = distinct.withColumn("tie", _running(distinct, ["g", "word", "bit", "cell"], "leaf", "m"))
    tied = inside.join(cells, ["g", "word", "bit", "cell"])
    return _unfolded(tied.withColumn("tie", F.col("tie") + F.col("first")).drop("first", "cell"))


def _placed(rows: DataFrame) -> DataFrame:
    """(g, n, place, key, leaf, seen): each row's place among the ``n`` of its group, from 0."""
    mask = F.expr("shiftleft(1L, bit)")
    words = rows.groupBy("g", "word").agg(F.bit_or(mask).alias("bits"), F.count("*").alias("n"))
    words = written(words, "manifest-words")
    repeated = words.where("n > bit_count(bits)").select("g", "word")
    below = F.expr("cast(bit_count(bits & ~shiftleft(-1L, bit)) as long)")
    extra = F.lit(0).cast("long")
    located, sizes = _directory(words.select("g", "word", "n"))
    located = located.drop("n").join(words.select("g", "word", "bits"), ["g", "word"])
    rows = rows.withColumn("tie", F.lit(0).cast("long"))
    if repeated.head(1):
        own = rows.join(repeated, ["g", "word"], "left_semi")
        ids = own.groupBy("g", "word", "bit").agg((F.count("*") - 1).alias("more")).where("more > 0")
        ids = written(ids, "manifest-repeats")
        tied = _ties(rows.join(ids, ["g", "word", "bit"], "left_semi"))
        rows = rows.join(ids, ["g", "word", "bit"], "left_anti").unionByName(tied.select(rows.columns))
        mores = ids.groupBy("g", "word").agg(F.collect_list(F.struct("bit", "more")).alias("mores"))
        located = located.join(mores, ["g", "word"], "left")
        extra = F.expr("aggregate(filter(mores, x -> x.bit < bit), 0L, (a, x) -> a + x.more)")
        extra = F.coalesce(extra, F.lit(0).cast("long"))
    place = (F.col("before") + below + extra + F.col("tie")).alias("place")
    return rows.join(located, ["g", "word"]).select("g", place, "key", "leaf", "seen").join(sizes, "g")


def _blocks(level: DataFrame, *more: str) -> DataFrame:
    """Slot arrays of a level (g, n, place, node, ...): (g, n, block, entries, slots, runs), digests in hex."""
    slot = F.col("place").bitwiseAND(F.lit(BLOCK - 1)).cast("int").alias("slot")
    entry = F.struct(slot, F.lower(F.hex("node")).alias("node"), *more)
    blocks = level.groupBy("g", "n", F.shiftright("place", 8).alias("block")).agg(
        F.collect_list(entry).alias("entries")
    )
    keyed = "map_from_entries(transform(entries, x -> struct(x.slot as slot, x.node as node)))"
    blocks = blocks.withColumn("keyed", F.expr(keyed)).withColumn(
        "slots", F.expr("transform(sequence(0, size(entries) - 1), i -> keyed[i])")
    )
    run = f"sha2(array_join(slice(slots, r * {FAN} + 1, {FAN}), ''), 256)"
    runs = f"transform(sequence(0, (size(slots) - 1) div {FAN}), r -> {run})"
    return blocks.withColumn("runs", F.expr(runs)).drop("keyed")


def _reduced(blocks: DataFrame) -> DataFrame:
    """The level above: (g, n, place, node)."""
    node = F.expr(
        f"case when n = 1 then slots[0] when n <= {FAN} then runs[0] else sha2(array_join(runs, ''), 256) end"
    )
    return blocks.select(
        "g", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("block").alias("place"), F.unhex(node).alias("node")
    )


#: What stands before and after a child, run by run: one step per level of the block that is there.
_OWN_STEPS = f"""
concat(
  if(n > 1, array(struct(
    array_join(slice(slots, slot - slot % {FAN} + 1, slot % {FAN}), '') as before,
    array_join(slice(slots, slot + 2, {FAN - 1} - slot % {FAN}), '') as after)), cast(array() as {_STEP_TYPE})),
  if(n > {FAN}, array(struct(
    array_join(slice(runs, 1, slot div {FAN}), '') as before,
    array_join(slice(runs, slot div {FAN} + 2, {FAN}), '') as after)), cast(array() as {_STEP_TYPE})),
  steps)
"""


def _descended(blocks: DataFrame, paths: DataFrame, *more: str) -> DataFrame:
    """Children of the blocks with ``steps`` to the top: (g, place, node, ..., steps)."""
    both = blocks.join(paths, ["g", "block"])
    each = both.select("g", "n", "block", "slots", "runs", "steps", F.explode("entries").alias("entry"))
    each = each.select("*", "entry.*").withColumn("steps", F.expr(_OWN_STEPS))
    return each.select("g", (F.shiftleft("block", 8) + F.col("slot")).alias("place"), "node", *more, "steps")


def _tree(level: DataFrame, name: str, *more: str) -> tuple[DataFrame, list[DataFrame]]:
    """(g, place, node) of each group's top, and the written blocks of every two levels, lowest first."""
    found = []
    while True:
        blocks = written(_blocks(level, *(more if not found else ())), name)
        found.append(blocks)
        level = written(_reduced(blocks), name)
        if not level.where("n > 1").head(1):
            return level, found


def _paths(top: DataFrame, trees: list[DataFrame]) -> DataFrame:
    """The steps of the lowest blocks' own nodes, from the steps of the tops: (g, place, steps)."""
    paths = top
    for number in range(len(trees) - 1, 0, -1):
        blocks = trees[number]
        paths = _descended(blocks, paths.withColumnRenamed("place", "block"))
        paths = written(paths.select("g", "place", "steps"), "manifest-paths")
    return paths


def _ranked(tops: DataFrame) -> DataFrame:
    """The groups' tops with their ``place`` in the order of the groups: one count per range reaches the driver."""
    spark = tops.sparkSession
    runs = tops.repartitionByRange("g").sortWithinPartitions("g")
    runs = written(runs.withColumn("at", F.monotonically_increasing_id()), "manifest-groups")
    counts = runs.groupBy(F.shiftright("at", 33).cast("int").alias("part")).count().collect()
    first, total = [], 0
    for part, count in sorted(tuple(row) for row in counts):
        first.append((part, total))
        total += count
    firsts = spark.createDataFrame(first, "part int, first long")
    ranked = runs.withColumn("part", F.shiftright("at", 33).cast("int")).join(F.broadcast(firsts), "part")
    place = F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranked.select("g", "node", place.alias("place"), F.lit(total).cast("long").alias("n"))


def manifest(
    docs: DataFrame, *, key: str = "doc_id", group: str = "source",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per row: ``key``, ``group_key``, ``place``, ``leaf``, ``subroot``, ``root``, ``steps``, ``folded_root``, ``verified``.

    A leaf is the digest of the fields' texts. Within a group leaves ascend by ``key`` (a whole
    number; null first, equal ones by leaf; rows that are equal in all fields are as many leaves).
    While a group has several nodes, 16 on end become one; the groups' last nodes, null group first and the
    others by their UTF-8 bytes, become the root in the same way. ``steps`` are, level by level, the
    digests before and after the row's own node. ``changed`` gives fields another value, as found later:
    ``folded_root`` is the root that follows from the row's changed leaf and its steps, and
    ``verified`` says whether it is the root. Other columns do not count. An empty table has no rows.
    """
    spark = docs.sparkSession
    changed = changed or {}
    rows = written(_rows(docs, key, group, fields, changed), "manifest-rows")
    placed = _placed(rows).withColumnRenamed("leaf", "node")
    tops, trees = _tree(placed, "manifest-levels", "key", "seen")
    ranked = _ranked(tops.select("g", "node"))
    shelf = written(ranked.withColumnRenamed("g", "own").withColumn("g", F.lit("")), "manifest-shelf")
    # The groups are the leaves of a last tree of one group.
    last, shelves = _tree(shelf, "manifest-shelves", "own")
    found = last.select(F.lower(F.hex("node"))).head()
    root = F.lit(found[0] if found else None).cast("string")
    start = spark.createDataFrame([("", 0, [])], f"g string, place long, steps {_STEP_TYPE}")
    paths = _paths(start, shelves)
    owners = _descended(shelves[0], paths.withColumnRenamed("place", "block"), "own")
    owners = written(owners.select(F.col("own").alias("g"), F.col("node").alias("subroot"), "steps"), "manifest-owners")
    paths = _paths(owners.select("g", F.lit(0).cast("long").alias("place"), "steps"), trees)
    paths = paths.withColumnRenamed("place", "block")
    out = _descended(trees[0], paths, "key", "seen").join(owners.select("g", "subroot"), "g")
    begin = F.coalesce(F.lower(F.hex("seen")), F.col("node"))
    folded = F.aggregate("steps", begin, lambda now, step: F.sha2(F.concat(step["before"], now, step["after"]).cast("binary"), 256))
    out = out.select(
        "key", F.expr("if(g = '0', null, substr(g, 2))").alias("group_key"), "place",
        F.col("node").alias("leaf"), "subroot", root.alias("root"), "steps", folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(steps: str = "steps") -> Column:
    """The digest of a row's siblings, level by level, from left to right."""
    sides = F.transform(steps, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(sides, "").cast("binary"), 256)
