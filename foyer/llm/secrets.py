"""Secret scans with multipart credential linking, in DataFrame functions alone.

Strong finds (an assigned secret, an access identifier, a long hex run) are reported as they are.
Weak candidates - a plain login, a random looking word, an endpoint - are common in clean text, so
one is reported only where complementary parts lie within its scope: a strong part of another
role, or weak parts of both other roles. The parts of a text meet by an interval join: parts are
summarised per text, bin of one scope's width, and role, and a candidate joins its own bin and
the two beside it, so a text with many parts costs in proportion to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foyer.llm.common import fresh, named, whole_text

#: Kinds in the order in which equal starts are listed.
KINDS = ["assign", "access", "hex", "login", "random", "endpoint"]
ROLES = {
    "assign": "secret", "access": "id", "hex": "secret",
    "login": "id", "random": "secret", "endpoint": "endpoint",
}
STRONG = KINDS[:3]
#: Code points before and behind a candidate in which its complements must start.
SCOPE = 300

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LOGIN = r"""(?i:\b(user(?:name)?|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
RANDOM = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""\b[a-z][a-z0-9+]{1,11}://[^\x20\x09-\x0D"'<>]+"""


def spans(text: Column, pattern: str, kind: str, good: Column | None = None, value: int = 0) -> Column:
    """Matches of a pattern as structs (start, kind_no, end, value), in code points.

    Lengths of what lies between the matches and of the matches add up to the places.
    """
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if value == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    pairs = F.arrays_zip(between.alias("gap"), matches.alias("match"), values.alias("value"))
    empty = F.array().cast("array<struct<start:int,kind_no:int,end:int,value:string>>")

    def grow(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        found = F.when(x["match"].isNotNull(), F.array(F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), end.alias("end"),
            x["value"].alias("value"),
        ))).otherwise(empty)
        return F.struct(end.alias("at"), F.concat(done["found"], found).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    walked = F.aggregate(pairs, begin, grow, lambda done: done["found"])
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def parts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``strong`` and ``weak``, arrays of (start, kind_no, end, value) by start.

    A weak candidate that overlaps a strong find of its role, or of its own place, is left out.
    A null text has none.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() in ("strong", "weak") and c != text))
    whole = fresh("secret_text", docs)
    rows = docs.withColumn(whole, whole_text(text))
    t = named(whole)
    rows = rows.withColumns({
        "strong": F.concat(
            F.filter(spans(t, ASSIGN, "assign", value=2), lambda x: F.length(x["value"]) >= 6),
            F.filter(spans(t, ACCESS, "access"), lambda x: F.length(x["value"]) >= 20),
            spans(t, HEX, "hex"),
        ),
        "weak": F.concat(
            spans(t, LOGIN, "login"),
            F.filter(
                spans(t, RANDOM, "random"),
                lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]") & ~x["value"].rlike("^/|//"),
            ),
            spans(t, ENDPOINT, "endpoint"),
        ),
    })
    rows = rows.withColumn("weak", F.filter(F.col("weak"), lambda x: ~F.exists(
        F.col("strong"), lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])
    )))
    return rows.withColumns({"strong": F.array_sort("strong"), "weak": F.array_sort("weak")}).drop(whole)


def linked(rows: DataFrame, key: str, scope: int = SCOPE) -> DataFrame:
    """Weak candidates with complements: one row per ``key``, ``added`` its reported spans.

    ``rows`` hold ``key`` (equal for equal texts), ``strong`` and ``weak``. Equal texts are linked
    once. A row without candidates makes no row.
    """
    role = F.element_at(
        F.array(*(F.lit(ROLES[kind]) for kind in KINDS)), F.col("part.kind_no") + 1
    )
    each = (
        rows.where(F.size("weak") > 0)
        .select(named(key).alias("key"), F.explode(F.concat("strong", "weak")).alias("part"))
        .select(
            "key", "part.start", "part.kind_no", "part.end", role.alias("role"),
            (F.col("part.kind_no") < len(STRONG)).alias("is_strong"),
        )
        .distinct()
    )
    bin_of = F.floor(F.col("start") / scope).cast("int")
    there = each.groupBy("key", bin_of.alias("bin"), "role", "is_strong").agg(
        F.min("start").alias("first"), F.max("start").alias("last")
    )
    wanted = each.where(~F.col("is_strong")).select(
        "key", "start", "kind_no", "end", F.col("role").alias("own_role"),
        F.explode(F.array(bin_of - 1, bin_of, bin_of + 1)).alias("bin"),
    )
    near = wanted.join(there, ["key", "bin"]).where(
        (F.col("role") != F.col("own_role"))
        & (F.col("last") >= F.col("start") - scope)
        & (F.col("first") <= F.col("start") + scope)
    )
    return (
        near.groupBy("key", "start", "kind_no", "end")
        .agg(F.bool_or("is_strong").alias("by_strong"), F.countDistinct("role").alias("n_roles"))
        .where(F.col("by_strong") | (F.col("n_roles") == 2))
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind_no", "end"))).alias("added"))
        .withColumnRenamed("key", key)
    )


def listed(found: Column) -> Column:
    """Spans as text: ``kind:start:end`` by start, then kind, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["kind_no"] + 1), x["start"], x["end"]
    )), ",")
