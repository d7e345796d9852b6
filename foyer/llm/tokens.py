"""Token counts of a unigram tokenizer: Viterbi that carries counts alone, over Aho-Corasick matches.

The tokenizer starts a segment at each space, written as U+2581 (one is put before the text if it has none),
and cuts each segment into vocabulary pieces of the greatest total score. A character that no piece
of its own covers may be taken as unknown, ten below the least score, and counts as its UTF-8
bytes. Ties go to the longer last piece: places are filled from the left, by starts in rising
order, and only a greater score replaces one.

Segments repeat, so each worker keeps the counts of the last ones it met, up to ``CACHE``; nothing is
shuffled. The vocabulary file is read once, by the driver, and its pieces are sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.llm.common import fresh, named, whole_text

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Segments a worker remembers; beyond it, it starts anew.
CACHE = 400_000


def pieces(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """The pieces of a vocabulary file with their scores: ordinary ones and bytes, no control pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), float(model.get_score(i)))
        for i in range(model.get_piece_size())
        if not model.is_control(i) and not model.is_unknown(i)
    ]


class Counter:
    """Counts of segments and texts for one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self._matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self._matches.add_word(piece, (len(piece), score))
        if vocabulary:
            self._matches.make_automaton()
        self._any = bool(vocabulary)
        self._unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self._known: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Pieces of one segment."""
        n = len(text)
        best, count = [0.0] * (n + 1), [-1] * (n + 1)
        count[0] = 0
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, match in self._matches.iter(text) if self._any else ():
            ends[end + 1].append(match)  # Longest first, so by rising start.
        for end in range(1, n + 1):
            single = False
            for length, score in ends[end]:
                start = end - length
                total = best[start] + score
                if count[end] < 0 or total > best[end]:
                    best[end], count[end] = total, count[start] + 1
                single |= length == 1
            if not single:
                total = best[end - 1] + self._unknown
                if count[end] < 0 or total > best[end]:
                    best[end] = total
                    count[end] = count[end - 1] + len(text[end - 1].encode())
        return count[n]

    def segments(self, text: str) -> Iterator[str]:
        text = text.replace(SPACE, " ")
        return iter((text[1:] if text.startswith(" ") else text).split(" "))

    def text(self, text: str) -> int:
        """Tokens of a whole text; an empty one has none."""
        if not text:
            return 0
        known, total = self._known, 0
        for part in self.segments(text):
            n = known.get(part)
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                n = known[part] = self.segment(SPACE + part)
            total += n
        return total


_counters: dict[int, tuple[list, Counter]] = {}


def _counter(vocabulary: list[tuple[str, float]]) -> Counter:
    """This worker's counter for a vocabulary."""
    held = _counters.get(id(vocabulary))
    if held is None or held[0] is not vocabulary:
        _counters.clear()
        held = _counters[id(vocabulary)] = (vocabulary, Counter(vocabulary))
    return held[1]


def token_counts(
    docs: DataFrame, *, text: str = "text", path: str = VOCABULARY, column: str = "n_tokens",
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows with ``n_tokens``, the number of tokens of the whole text.

    A null or empty text has none. ``keep``: the columns to return, all by default; one of the new
    name is replaced. An empty table gives an empty result.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != column.lower()]
    inside = fresh("token_text", docs)
    rows = docs.select(*map(named, keep), whole_text(text).alias(inside), F.lit(0).cast("long").alias(column))
    shared = docs.sparkSession.sparkContext.broadcast(pieces(path))

    def count(batches):
        counter = _counter(shared.value)
        for batch in batches:
            found = [counter.text(t) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(found, pa.int64())], [*keep, column]
            )

    return rows.mapInArrow(count, rows.drop(inside).schema)
