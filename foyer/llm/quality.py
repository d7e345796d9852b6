"""A quality classifier: regularised quadratic discriminant over statistics of whole texts.

A text becomes a dozen transformed statistics of its bytes, words and repetitions. Each class has a
mean and a covariance, shrunk towards the pooled variances; a score compares the two log densities,
with Mahalanobis distances by Cholesky factors that are made once. Fitting needs only sums of products
per class, one aggregate over all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.llm import bytewords
from foyer.llm.common import fresh, named, whole_text

STATISTICS = [
    "length", "word_length", "word_spread", "upper", "digit", "symbol", "exclaim", "foreign", "line",
    "stop", "bare", "echo", "variety", "top",
]
SHRINKAGE = 0.15


def _class(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


_UPPER, _DIGIT = _class(bytes(range(65, 91))), _class(b"0123456789")
_SYMBOL, _EXCLAIM, _LINE, _STOP = _class(b"#*$%&|<>"), _class(b"!"), _class(b"\n"), _class(b".,;:?'\"()-")
_FOREIGN = _class(bytes(range(128, 256)))
_LETTER = _class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def statistics(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of statistics per text; an empty text has the values of no words."""
    out = np.zeros((len(bounds) - 1, len(STATISTICS)))
    for first, last in bytewords.blocks(bounds):
        data, own = raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        size = np.maximum(np.diff(own), 1)

        def share(members, data=data, own=own, size=size):
            return np.diff(np.append(0, np.cumsum(members[data]))[own]) / size

        starts, ends, at = bytewords.words(data, own)
        n = np.diff(at)
        some = np.maximum(n, 1)

        def per_text(x, at=at):
            return np.diff(np.append(0, np.cumsum(x))[at])

        length = (ends - starts).astype(float)
        mean = per_text(length) / some
        spread = np.sqrt(np.maximum(per_text(length * length) / some - mean * mean, 0))
        letters = np.append(0, np.cumsum(_LETTER[data]))
        bare = per_text(letters[ends] == letters[starts]) / some
        hashes = bytewords.Prefix(bytewords.LOWER[data]).hashes(starts, ends)
        text = np.repeat(np.arange(last - first), n)
        echo = np.append(False, (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) if len(text) else hashes
        order = np.lexsort((hashes, text))
        hashes, same = hashes[order], text[order]
        new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (same[1:] != same[:-1]))[: len(same)])
        times = np.diff(np.append(new, len(same)))
        kinds = np.bincount(same[new], minlength=last - first)
        top = np.zeros(last - first)
        np.maximum.at(top, same[new], times)
        out[first:last] = np.stack([
            np.log1p(n), np.log1p(mean), np.log1p(spread), *(
                np.sqrt(share(c)) for c in (_UPPER, _DIGIT, _SYMBOL, _EXCLAIM, _FOREIGN, _LINE, _STOP)
            ), np.sqrt(bare), np.sqrt(per_text(echo) / some),
            np.log1p(kinds) - 0.9 * np.log1p(n), np.sqrt(top / some),
        ], 1)
    return out


def described(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and a column per statistic, which replaces one of its name. A null text counts as empty."""
    keep = [c for c in keep if c.lower() not in STATISTICS]
    inside = fresh("quality_text", docs)
    rows = docs.select(*map(named, keep), whole_text(text).alias(inside))
    schema = rows.drop(inside).schema
    for name in STATISTICS:
        schema = schema.add(name, "double")

    def scan(batches):
        for batch in batches:
            found = statistics(*bytewords.text_bytes(batch.column(len(keep))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *map(pa.array, found.T.copy())], schema.names
            )

    return rows.mapInArrow(scan, schema)


@dataclass
class Discriminant:
    """Two classes in standard units: means, inverse Cholesky factors and constants."""

    center: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of class 1; one half for all if a class was not seen."""
        if not self.means:
            return np.full(len(rows), 0.5)
        x = (rows - self.center) / self.scale
        logs = [
            constant - 0.5 * (((x - mean) @ factor.T) ** 2).sum(1)
            for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(rows: DataFrame, label: str, shrinkage: float = SHRINKAGE) -> Discriminant:
    """The discriminant of described rows with a label of 0 or 1; rows with another or null are left out."""
    d = len(STATISTICS)
    x = [named(name) for name in STATISTICS]
    sums = [F.sum(a) for a in x] + [F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d)]
    found = rows.where(named(label).isin(0, 1)).groupBy(named(label).cast("int").alias("c")).agg(
        F.count("*").alias("n"), F.array(*sums).alias("s")
    ).collect()
    counts, means, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for row in found:
        c, s = row["c"], np.array(row["s"])
        counts[c], means[c] = row["n"], s[:d] / row["n"]
        products[c][np.triu_indices(d)] = s[d:]
        products[c] = products[c] + np.triu(products[c], 1).T
    if counts.min() < 2:
        return Discriminant(np.zeros(d), np.ones(d), [], [], [])
    within = [products[c] / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = np.diag(sum(counts[c] * within[c] for c in (0, 1)) / counts.sum())
    scale = np.sqrt(np.maximum(pooled, 1e-6))
    center = (counts[:, None] * means).sum(0) / counts.sum()
    kept = Discriminant(center, scale, [], [], [])
    for c in (0, 1):
        covariance = within[c] / np.outer(scale, scale)
        covariance = (1 - shrinkage) * covariance + shrinkage * np.eye(d)
        lower = np.linalg.cholesky(covariance)
        kept.means.append((means[c] - center) / scale)
        kept.factors.append(np.linalg.inv(lower))
        kept.constants.append(float(np.log(counts[c] / counts.sum()) - np.log(np.diag(lower)).sum()))
    return kept


def scores(rows: DataFrame, model: Discriminant, keep: list[str], column: str = "score") -> DataFrame:
    """The kept columns of described rows with their score, from 0 to 1; it replaces a column of its name."""
    keep = [c for c in keep if c.lower() != column.lower()]
    chosen = rows.select(*map(named, keep), *map(named, STATISTICS))
    schema = rows.select(*map(named, keep)).schema.add(column, "double")

    def scan(batches):
        for batch in batches:
            x = np.stack([batch.column(len(keep) + i).to_numpy() for i in range(len(STATISTICS))], 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(model.score(x))], schema.names
            )

    return chosen.mapInArrow(scan, schema)
