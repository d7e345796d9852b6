"""Benchmark decontamination by an edit-distance LSH over item-sized windows.

Texts and items are words: lower case, ASCII punctuation and white space between them. An item is cut into
blocks of 16 to 31 words (a shorter one is a block as it is); of the k edits that an item of n blocks
may have, one block at least has no more than k / n. A window starts at every word of a text. A random walk
(CGK) writes a window's words out to more places, at each step moving on by a bit that hashes the step and
the word; strings at a small edit distance come out at a small Hamming distance. A table keys such a
walk by a few sampled places, and windows that share a key with a block in any of the tables are compared with it.

How many walks a group of blocks of similar length gets follows from the target recall: blocks
with as many edits as they may have, insertions alone and all kinds, are walked when the tables are made, and
the share of them that a walk finds says how many walks miss few enough. Long items have several blocks, each of
which finds them, so their recall is higher.

Where a block is found, the whole item is compared exactly, from every place at which it can begin.

Before the walk two bounds drop windows that cannot match a block: each word that no item has costs an edit,
and an edit breaks at most two of a block's pairs of neighbours, so enough pairs must be there that
some item has. Blocks of similar length share their windows. The items are sent to all tasks in slices of bounded
size; each slice is one pass over the texts, and nothing is shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.llm import bytewords
from foyer.llm.common import fresh, named, whole_text

#: Edits per item word that still match, and words below which an item is no passage.
EDITS, MIN_WORDS = 0.25, 8
#: Share of the texts with as many edits as may be that is found, at least.
RECALL = 0.97
#: Least words of a block of a longer item.
BLOCK = 16
#: Tables of a walk, places of a key; most walks.
TABLES, PLACES, MOST_WALKS = 6, 3, 64
#: Edited blocks, and walks of each, that the number of walks is measured by.
TRIALS, TRIAL_WALKS = 300, 8
#: Block lengths that share windows: up to so many times the least.
STRETCH = 1.15
#: Windows of a group that are walked together.
HELD_WINDOWS = 20_000
#: Words of windows that are compared with an item in one go.
HELD_CELLS = 1 << 20
#: Bytes of item text sent to the tasks in one pass.
SLICE_BYTES = 16 << 20

_SEPARATE = bytewords.LOWER.copy()
_SEPARATE[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def _words(raw: np.ndarray, bounds: np.ndarray):
    """Blocks as (first text, last text, word hashes, first words of texts)."""
    for first, last in bytewords.blocks(bounds):
        data = _SEPARATE[raw[bounds[first] : bounds[last]]]
        starts, ends, at = bytewords.words(data, bounds[first : last + 1] - bounds[first])
        yield first, last, bytewords.Prefix(data).hashes(starts, ends), at


def allowed(words: int | np.ndarray, edits: float = EDITS):
    """Edits with which a text still matches an item of so many words."""
    return np.floor(np.asarray(words) * edits + 1e-9).astype(np.int64)


def walk(rows: np.ndarray, steps: int, seed: int, wanted: np.ndarray) -> np.ndarray:
    """The random walks of rows of word numbers: (steps, rows); beyond a row's end, its last pad.

    Only the ``wanted`` steps hold words. The bits of a word's hash say at which steps the walk moves on from it.
    """
    n, width = rows.shape
    words = np.full((n, width + 1), -1, np.int64)
    words[:, :-1] = rows
    words = words.ravel()
    bits = bytewords.mix((words + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 1_000_003))
    at = np.arange(n) * (width + 1)
    end = at + width
    out = np.zeros((steps, n), np.int64)
    needed = set(wanted.tolist())
    for step in range(steps):
        if step in needed:
            out[step] = words[at]
        at = np.minimum(at + ((bits[at] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64), end)
    return out


def _edited(rng: np.random.Generator, size: int, edits: int, kinds: int, width: int) -> np.ndarray:
    """Blocks of words 0 to size - 1, each after ``edits`` edits; words behind it, to ``width``, are others'."""
    out = np.empty((TRIALS, width), np.int64)
    for trial in range(TRIALS):
        own, new = list(range(size)), iter(range(size, size + width + edits))
        for _ in range(edits):
            at, kind = int(rng.integers(len(own) + 1)), int(rng.integers(kinds))
            if kind == 0 or at == len(own):
                own.insert(at, next(new))
            else:
                own[at : at + 1] = [next(new)] if kind == 1 else []
        out[trial] = [*own, *new][:width]
    return out


def walks_for(size: int, edits: int, steps: int, places: list, recall: float, seed: int) -> int:
    """Walks that find the target share of blocks of so many words after so many edits, of the harder kind."""
    if not edits:
        return 1
    rng = np.random.default_rng([seed, size, edits])
    most = 1
    for kinds in (1, 3):  # Insertions alone; all kinds.
        rows = _edited(rng, size, edits, kinds, size + edits)
        hits = np.zeros((TRIALS, TRIAL_WALKS), bool)
        for number in range(TRIAL_WALKS):
            wanted = np.concatenate(places[number])
            plain = walk(np.arange(size)[None], steps, seed + number, wanted)
            walked = walk(rows, steps, seed + number, wanted)
            for place in places[number]:
                hits[:, number] |= (walked[place] == plain[place]).all(0)
        # Blocks differ in how easily they are found: each one's chance counts by itself.
        chance = (hits.sum(1) + 0.5) / (TRIAL_WALKS + 1)
        number = 1
        while number < MOST_WALKS and ((1 - chance) ** number).mean() > 1 - recall:
            number += 1
        most = max(most, number)
    return most


class Blocks:
    """Blocks of similar length, with the items they are of and their keys in every table."""

    def __init__(self, blocks: list[tuple[int, int, int, np.ndarray]], recall: float, seed: int):
        """Blocks are (item, words of the item before it, edits, words)."""
        self.item, self.offset, self.edits = (np.array([b[i] for b in blocks]) for i in range(3))
        self.sizes = np.array([len(b[3]) for b in blocks])
        self.least, self.most = int(self.sizes.min()), int(self.sizes.max())
        self.least_pairs = int((self.sizes - 1 - 2 * self.edits).min())
        self.words = np.full((len(blocks), self.most), -1, np.int64)
        for i, (*_, row) in enumerate(blocks):
            self.words[i, : len(row)] = row
        rng = np.random.default_rng([seed, self.least])
        # Sampled where every block of the group still walks.
        self.steps = max(PLACES, int(1.6 * self.least))
        places = [[rng.choice(self.steps, PLACES, replace=False) for _ in range(TABLES)] for _ in range(MOST_WALKS)]
        walks = max(
            walks_for(size, edits, self.steps, places, recall, seed)
            for size, edits in sorted({(int(s), int(e)) for s, e in zip(self.sizes, self.edits, strict=True)})
        )
        self.places = places[:walks]
        self.tables = []
        for number, own in enumerate(self.places):
            walked = walk(self.words, self.steps, seed + number, np.concatenate(own))
            for place in own:
                keys = _keys(walked, place)
                order = np.argsort(keys, kind="stable")
                known, first = np.unique(keys[order], return_index=True)
                self.tables.append((known, np.append(first, len(keys)), order))

    def candidates(self, rows: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, block) that share a key in a table."""
        found = [np.zeros(0, np.int64)]
        for number, places in enumerate(self.places):
            walked = walk(rows, self.steps, seed + number, np.concatenate(places))
            for t, place in enumerate(places):
                known, first, members = self.tables[number * TABLES + t]
                keys = _keys(walked, place)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                row = np.flatnonzero(known[at] == keys)
                at = at[row]
                count = first[at + 1] - first[at]
                ends = np.cumsum(count)
                member = members[np.repeat(first[at] - ends + count, count) + np.arange(count.sum())]
                found.append(np.repeat(row, count) * len(self.sizes) + member)
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.sizes), pairs % len(self.sizes)


def _keys(walked: np.ndarray, place: np.ndarray) -> np.ndarray:
    key = np.zeros(walked.shape[1], np.uint64)
    for p in place:
        key = bytewords.mix(key + (walked[p] + 2).astype(np.uint64))
    return key


def distances(items: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each item to a beginning of its row, and that beginning's length.

    Both are padded with -1, which equals nothing. All pairs advance together, a row of the usual
    table at a time.
    """
    n, width = rows.shape
    now = np.broadcast_to(np.arange(width + 1), (n, width + 1)).copy()
    final = now.copy()
    for i in range(items.shape[1]):
        mine = items[:, i : i + 1]
        change = now[:, :-1] + ((mine != rows) | (mine < 0))
        new = np.empty_like(now)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(change, now[:, 1:] + 1)
        # Insertions: a running minimum of value minus place.
        new = np.minimum.accumulate(new - np.arange(width + 1), axis=1) + np.arange(width + 1)
        now = new
        final[sizes == i + 1] = now[sizes == i + 1]
    end = final.argmin(1)
    return final[np.arange(n), end], end


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring word numbers."""
    return bytewords.mix((left.astype(np.uint64) << np.uint64(32)) + right.astype(np.uint64))


def _grouped(hashes: list[np.ndarray], numbers: list[int], edits: float, seed: int, recall: float = RECALL):
    """The tables of the items' words and pairs of words, the items, and their blocks by length."""
    vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
    table = bytewords.Table(vocabulary)
    items = dict(zip(numbers, map(table.find, hashes), strict=True))
    pairs = [_pairs(own[:-1], own[1:]) for own in items.values()]
    pairs = bytewords.Table(np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64))
    blocks = []
    for number, own in items.items():
        n = max(1, len(own) // BLOCK)
        most = int(allowed(len(own), edits)) // n
        cuts = [len(own) * i // n for i in range(n + 1)]
        blocks += [(number, low, most, own[low:high]) for low, high in zip(cuts, cuts[1:], strict=False)]
    groups, held = [], []
    for block in sorted(blocks, key=lambda b: (len(b[3]), b[0], b[1])):
        if held and len(block[3]) > STRETCH * len(held[0][3]):
            groups.append(held)
            held = []
        held.append(block)
    if held:
        groups.append(held)
    items = {number: (own, int(allowed(len(own), edits))) for number, own in items.items()}
    return table, pairs, items, [Blocks(group, recall, seed) for group in groups]


def live_windows(ids: np.ndarray, bounds: np.ndarray, pairs: bytewords.Table, groups: list[Blocks]):
    """Per group, the windows that the bounds leave: text number, first word, the words of the window.

    ``ids`` are word numbers, -1 for words that no item has.
    """
    every = np.arange(len(ids))
    ends = np.repeat(bounds[1:], np.diff(bounds))
    unknown = np.append(0, np.cumsum(ids < 0))
    both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0) & (every[1:] < ends[:-1]))
    # Pairs that some item has, by the place of their first word.
    known = np.zeros(len(ids) + 1, np.int64)
    known[both + 1] = pairs.find(_pairs(ids[both], ids[both + 1])) >= 0
    known = np.cumsum(known)
    padded = np.append(ids, -1).astype(np.int32)
    for group in groups:
        most = int(group.edits.max())
        width = group.most + most
        last = np.minimum(ends, every + width) - 1
        start = every[known[last] - known[:-1] >= group.least_pairs]
        here = np.minimum(ends[start] - start, group.least)
        lost = unknown[start + here] - unknown[start] + group.least - here
        start = start[lost <= most]
        places = start[:, None] + np.arange(width)
        rows = padded[np.minimum(places, len(ids))]
        rows[places >= ends[start][:, None]] = -1
        text = np.searchsorted(bounds, start, "right") - 1
        yield text, start - bounds[text], rows


class Search:
    """Matches of items in texts; windows are gathered and compared many at a time."""

    def __init__(self, table, pairs, items: dict, groups: list[Blocks], seed: int):
        self.table, self.pairs, self.items, self.groups, self.seed = table, pairs, items, groups, seed
        self.held: list[list[tuple]] = [[] for _ in groups]
        self.texts: dict[int, np.ndarray] = {}
        self.begins: dict[tuple[int, int], set[int]] = {}

    def add(self, hashes: np.ndarray, bounds: np.ndarray, first: int) -> None:
        """Texts by their word hashes; ``first`` is the number of the first one."""
        if len(hashes):
            ids = self.table.find(hashes)
            for number, (text, at, rows) in enumerate(live_windows(ids, bounds, self.pairs, self.groups)):
                for i in np.unique(text).tolist():
                    if i + first not in self.texts:
                        self.texts[i + first] = ids[bounds[i] : bounds[i + 1]].copy()
                self.held[number].append((text + first, at, rows))
                if sum(len(x[0]) for x in self.held[number]) >= HELD_WINDOWS:
                    self._look(number)

    def matches(self) -> list[tuple]:
        """All matches so far: (text, item, edits, first word, end)."""
        for number in range(len(self.groups)):
            self._look(number)
        found = [match for pair, begins in self.begins.items() for match in self._compared(*pair, begins)]
        self.texts, self.begins = {}, {}
        return found

    def _look(self, number: int) -> None:
        """Note where the items of blocks that windows match can begin."""
        if not self.held[number]:
            return
        group = self.groups[number]
        text, at, rows = (np.concatenate(x) for x in zip(*self.held[number], strict=True))
        self.held[number] = []
        row, block = group.candidates(rows, self.seed) if len(rows) else (text[:0], text[:0])
        for cut in range(0, len(row), 8192):
            r, b = row[cut : cut + 8192], block[cut : cut + 8192]
            edits, _ = distances(group.words[b], group.sizes[b], rows[r])
            good = edits <= group.edits[b]
            r, b = r[good], b[good]
            for i, item, begin in zip(text[r].tolist(), group.item[b].tolist(), (at[r] - group.offset[b]).tolist(), strict=True):
                self.begins.setdefault((i, item), set()).add(begin)

    def _compared(self, text: int, item: int, begins: set[int]):
        """The whole item against the text, from every word at which edits before the block may have put it."""
        own, most = self.items[item]
        ids = np.append(self.texts[text], -1)
        starts = np.unique(np.concatenate([np.arange(b - most, b + most + 1) for b in sorted(begins)]))
        starts = starts[(starts >= 0) & (starts < len(ids) - 1)]
        width = len(own) + most
        step = max(1, HELD_CELLS // width)
        for cut in range(0, len(starts), step):
            some = starts[cut : cut + step]
            rows = ids[np.minimum(some[:, None] + np.arange(width), len(ids) - 1)]
            edits, length = distances(np.broadcast_to(own, (len(some), len(own))), np.full(len(some), len(own)), rows)
            good = edits <= most
            for e, first, n in zip(edits[good].tolist(), some[good].tolist(), length[good].tolist(), strict=True):
                yield text, item, e, first, first + n


def leaks(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text",
    edits: float = EDITS, min_words: int = MIN_WORDS, seed: int = 1, keep: list[str] | None = None,
    column: str = "leaks", recall: float = RECALL,
) -> DataFrame:
    """The rows with ``leaks``: array of (item, edits, first, end), a best match per item, by item.

    A text leaks an item of m words if some run of its words is within floor(``edits`` x m) word
    edits of it; ``first`` and ``end`` are the run's places in words. ``recall`` is the share of runs with as many
    edits as that which is found, for items of any length; those with fewer edits are found more surely. Items of under ``min_words``
    words, null ones included, are no passages and match nothing. A null item id is kept as null, and one that is no whole number is null. A
    null or empty text has no leaks. ``keep``: the columns to return, all by default. Repeated items
    and rows each count. A column of the new name is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != column]
    number, slice_of = "number", "slice"
    passages = items.select(named(item).try_cast("long").alias("item"), whole_text(item_text).alias("text"))
    size = passages.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    slices = max(1, math.ceil(size / SLICE_BYTES))
    passages = passages.withColumn(slice_of, F.pmod(F.xxhash64("item", "text"), F.lit(slices)))
    inside = fresh("leak_text", docs)
    rows = docs.select(*map(named, keep), whole_text(text).alias(inside))
    found = F.array().cast("array<struct<item:bigint,edits:int,first:int,end:int>>")
    rows = rows.withColumn(column, found)
    for part in range(slices):
        # At most about SLICE_BYTES of text.
        held = passages.where(F.col(slice_of) == part).select("item", "text").collect()
        raw, bounds = bytewords.text_bytes(pa.array([r["text"] for r in held], pa.string()))
        hashes: list[np.ndarray] = []
        for first, last, own, at in _words(raw, bounds):
            hashes += [own[at[i] : at[i + 1]] for i in range(last - first)]
        chosen = [i for i, own in enumerate(hashes) if len(own) >= min_words]
        if chosen:
            names = [held[i]["item"] for i in chosen]
            grouped = _grouped([hashes[i] for i in chosen], list(range(len(chosen))), edits, seed, recall)
            rows = _searched(rows, inside, column, names, grouped, seed)
    return rows.withColumn(column, F.array_sort(named(column))).drop(inside)


def _searched(rows: DataFrame, inside: str, column: str, names: list, grouped, seed: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((names, *grouped))
    text_at, leaks_at = rows.columns.index(inside), rows.columns.index(column)

    def scan(batches):
        names, *rest = shared.value
        search = Search(*rest, seed)
        kind = pa.list_(pa.struct([
            ("item", pa.int64()), ("edits", pa.int32()), ("first", pa.int32()), ("end", pa.int32()),
        ]))
        for batch in batches:
            best: dict[tuple[int, int], tuple] = {}
            for first, _, own, at in _words(*bytewords.text_bytes(batch.column(text_at))):
                search.add(own, at, first)
            for text, number, *match in search.matches():
                best[text, number] = min(best.get((text, number), tuple(match)), tuple(match))
            old = batch.column(leaks_at)
            if best:
                lists = old.to_pylist()
                for (text, number), (edits, start, end) in sorted(best.items()):
                    lists[text] = lists[text] + [
                        {"item": names[number], "edits": edits, "first": start, "end": end}
                    ]
                old = pa.array(lists, kind)
            yield batch.set_column(leaks_at, batch.schema.field(leaks_at).with_type(old.type), old)

    return rows.mapInArrow(scan, rows.schema)
