"""Quality rules by distribution divergence, in DataFrame functions alone.

A document's histogram of character classes and its histogram of common words are compared with
those of its language by the Jensen-Shannon distance. A language is a value of the language column,
listed or not; only listed ones have common words. Rows without one are told apart by their script
alone. A reference is the mean histogram of the documents that pass the base rules, each weighing
alike, then anew of those that it keeps, so that junk leaves it: a few aggregates into a table of one
row per language. Where fewer than ``MIN_REFERENCE`` documents are kept the last reference stays, and
a language that never had so many gives no verdict. Short documents have rough histograms: below
the minimum lengths a distance gives no verdict either. Two plain rules go first: too few words, and
too many words in repeated windows.

Everything about a text is computed within its own row; no text or word is shuffled. Windows of
eight words are hashed by doubling (pairs, fours, eights), so the work is linear in the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foyer.llm.common import SPACE, fresh, named, whole_text, words, written

WINDOW = 8
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Below these lengths a histogram is too rough for a verdict.
MIN_CHARS_FOR_CLASSES, MIN_WORDS_FOR_WORDS = 200, 50
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.16, 0.30
#: Times the reference is measured anew on the rows that the last one keeps.
REFINEMENTS = 2
#: Documents that a reference needs at least.
MIN_REFERENCE = 20
#: A document's share of a histogram counts in whole steps of this part, so that sums have no order.
_STEPS = 1_000_000
#: Languages whose references may be sent to all tasks; beyond it the join shuffles.
BROADCAST_ROWS = 50_000
#: In place of a language that is not given: mostly a-z, or mostly other letters.
NO_LANGUAGE = ("?a-z", "?other letters")

#: Common words of the languages that get a reference of their own.
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was".split(),
    "de": "der die und in den von zu das mit sich des auf".split(),
    "fr": "de la le et les des en un du une que est".split(),
    "es": "de la que el en y a los se del las un".split(),
}
SYMBOLS = "#*$%&|<>"
DIGITS = "0-9"
#: Character classes; what is in none of them counts as a last class. Digits are left out:
#: a number or two would dominate the histogram of a short text.
CLASSES = {
    "lower": "a-z",
    "upper": r"\p{Lu}",
    "letter": r"\p{L}&&[^a-z\p{Lu}]",
    "space": SPACE,
    "stop": r".,;:!?'\"()\-",
    "symbol": r"#*$%&|<>&&[^a]",
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _in_class(text: Column, members: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{members}]+", ""))


def _doubled(hashes: Column, step: int, count: Column) -> Column:
    """Hashes of spans twice as long: each with the one ``step`` further on."""
    return F.zip_with(
        F.slice(hashes, 1, count), F.slice(hashes, step + 1, count), lambda a, b: F.xxhash64(a, b)
    )


def measured(
    docs: DataFrame, text: str = "text", lang: str = "lang", listed: dict | None = None
) -> DataFrame:
    """The rows with their measures and histograms; see ``judged`` for their use.

    Adds the five measures, ``n_text_chars``, ``language`` (one of ``NO_LANGUAGE`` where null or empty),
    ``class_counts`` and ``word_counts``. Columns of these names are replaced. A null text counts
    as empty; its measures are 0.
    """
    listed = COMMON_WORDS if listed is None else listed
    own = ["n_text_chars", "language", "class_counts", "word_counts"]
    docs = docs.drop(*(c for c in docs.columns if c.lower() in MEASURES + own and c not in (text, lang)))
    whole, word, lines, hashes, again, order, at, codes = (
        fresh(f"rule_{name}", docs)
        for name in ("text", "words", "lines", "hashes", "again", "order", "at", "codes")
    )
    size = F.size(named(word))
    language = F.coalesce(named(lang).cast("string"), F.lit(""))
    in_order = F.lit("")
    for name, list_words in listed.items():
        in_order = F.when(F.col("language") == name, F.lit(",".join(list_words))).otherwise(in_order)
    most = max(map(len, listed.values()), default=0)

    rows = docs.withColumns({whole: whole_text(text), "language": language})
    rows = rows.withColumn(word, words(named(whole)))
    for step in (0, 1, 2, 4):
        made = (
            F.transform(named(word), lambda x: F.xxhash64(x)) if step == 0
            else _doubled(named(hashes), step, size - 2 * step + 1)
        )
        rows = rows.withColumn(
            hashes, F.when(size >= WINDOW, made).otherwise(F.array().cast("array<long>"))
        )
    lines_with_words = F.filter(F.split(named(whole), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    rows = rows.withColumns({
        lines: lines_with_words,
        again: F.size(F.array_distinct(named(hashes))) < F.size(named(hashes)),
        codes: F.filter(
            F.transform(named(word), lambda x: F.find_in_set(F.lower(x), in_order)), lambda c: c > 0
        ),
    })
    # Windows in the order of their hash, for texts that have equal ones.
    rows = rows.withColumn(order, F.when(named(again), F.sort_array(
        F.transform(named(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )))
    rows = rows.withColumn(at, F.sort_array(F.filter(
        F.transform(named(order), lambda x, i: F.when(
            (x["h"] == F.get(named(order), i - 1)["h"]) | (x["h"] == F.get(named(order), i + 1)["h"]),
            x["i"],
        )),
        lambda i: i.isNotNull(),
    )))
    covered = F.aggregate(
        F.transform(named(at), lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(named(at), i + 1) - p, F.lit(WINDOW))
        ).cast("long")),
        F.lit(0).cast("long"), lambda a, b: a + b,
    )
    rows = rows.withColumns({
        "class_counts": F.array(*(_in_class(named(whole), m).cast("long") for m in CLASSES.values())),
        "n_text_chars": F.length(named(whole)).cast("long"),
    })
    lower, other = (F.col("class_counts")[list(CLASSES).index(c)] for c in ("lower", "letter"))
    rows = rows.withColumns({
        "language": F.when(F.col("language") != "", F.col("language")).otherwise(
            F.when(other > lower, NO_LANGUAGE[1]).otherwise(NO_LANGUAGE[0])
        ),
        "n_words": size.cast("long"),
        "word_chars": F.col("n_text_chars") - F.col("class_counts")[list(CLASSES).index("space")],
        "n_symbols": F.col("class_counts")[list(CLASSES).index("symbol")],
        "n_dup_lines": (F.size(named(lines)) - F.size(F.array_distinct(named(lines)))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
        "class_counts": F.concat(F.col("class_counts"), F.array(
            F.col("n_text_chars") - _in_class(named(whole), DIGITS) - F.aggregate(
                F.col("class_counts"), F.lit(0).cast("long"), lambda a, b: a + b
            )
        )),
        "word_counts": F.transform(
            F.sequence(F.lit(1), F.lit(most)),
            lambda k: (F.size(named(codes)) - F.size(F.array_remove(named(codes), k))).cast("long"),
        ),
    })
    rows = rows.withColumn("word_counts", F.concat(F.col("word_counts"), F.array(
        F.col("n_words") - F.size(named(codes))
    )))
    # As a generated row, the measures are computed once: a filter on them is not moved into them.
    return rows.select(*map(named, docs.columns), F.inline(F.array(F.struct(*MEASURES, *own))))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def references(rows: DataFrame, listed: dict | None = None, least: int = MIN_REFERENCE) -> DataFrame:
    """Mean histograms per language over measured rows, for languages with ``least`` rows or more."""
    listed = COMMON_WORDS if listed is None else listed
    n_classes, n_words = len(CLASSES) + 1, max(map(len, listed.values()), default=0) + 1

    def total(column: str, n: int) -> Column:
        share = _STEPS / _total(F.col(column))
        return F.array(*(F.sum(F.round(F.col(column)[i] * share).cast("long")) for i in range(n)))

    return rows.groupBy("language").agg(
        F.count("*").alias("documents"),
        total("class_counts", n_classes).alias("class_reference"),
        total("word_counts", n_words).alias("word_reference"),
    ).where(F.col("documents") >= least).drop("documents")


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; 0 if either is empty."""

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    n, m = _total(counts), _total(reference)
    sides = F.zip_with(counts, reference, lambda a, b: part(a / n, b / m) + part(b / m, a / n))
    return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(F.lit(0.0), _total(sides) / 2))).otherwise(0.0)


def judged(
    rows: DataFrame,
    reference: DataFrame,
    *,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Measured rows with ``base_failed``, ``kept`` and both distances.

    A row is kept if the base rules pass and each distance is within its limit or gives no
    verdict: texts under the minimum lengths have none, nor has a language without a reference, nor
    have words of an unlisted language. ``reference`` is counted: pass one that is written. Columns of
    the names of what is added, or of the reference, are replaced.
    """
    added = {"class_reference", "word_reference", "class_distance", "word_distance", "base_failed", "kept"}
    rows = rows.drop(*(c for c in rows.columns if c.lower() in added))
    if reference.count() <= BROADCAST_ROWS:
        reference = F.broadcast(reference)
    rows = rows.join(reference, "language", "left")
    rows = rows.withColumns({
        "class_distance": distance(F.col("class_counts"), F.col("class_reference")),
        "word_distance": distance(F.col("word_counts"), F.col("word_reference")),
        "base_failed": _base_failed(),
    })
    even = (
        (F.col("n_text_chars") < MIN_CHARS_FOR_CLASSES)
        | (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= max_class_distance)
    ) & (
        (F.col("n_words") < MIN_WORDS_FOR_WORDS)
        | ~F.col("language").isin(*COMMON_WORDS)
        | (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= max_word_distance)
    )
    return rows.withColumn("kept", ~F.col("base_failed") & even).drop("class_reference", "word_reference")


def refined(rows: DataFrame, times: int = REFINEMENTS, **limits: float) -> DataFrame:
    """References measured on rows that pass the base rules, then ``times`` times on those that the last keeps.

    ``rows`` are read again each time: pass measures that are written, without their texts. A language
    of which too few rows are kept stays with its last reference.
    """
    reference = written(references(rows.where(~_base_failed())), "rules-reference-0")
    for number in range(1, times + 1):
        kept = judged(rows, reference, **limits).where("kept").select("language", "class_counts", "word_counts")
        new = references(kept).withColumnRenamed("language", "again").withColumnsRenamed(
            {"class_reference": "new_classes", "word_reference": "new_words"}
        )
        reference = written(
            reference.join(new, F.col("language") == F.col("again"), "left").select(
                "language", F.coalesce("new_classes", "class_reference").alias("class_reference"),
                F.coalesce("new_words", "word_reference").alias("word_reference"),
            ),
            f"rules-reference-{number}",
        )
    return reference
