"""A keyed table on shared storage that a stream upserts while others read it.

Files are written once and never changed. What the table holds is said by a manifest: the newest file in
``manifests/``, put in place by one rename under a name that was not there before. A batch writes its
rows to a new folder, then its manifest; until then readers see the table of the batch before, from then
on all of the new rows. A batch that is retried starts again from the manifest of the batch before it.

Rows are dealt to buckets by a hash of the key. A bucket has its whole rows and, above them, changes in levels:
``FAN`` parts of a level are merged into one of the next, and when the changes of a bucket pass a share
of its whole they are folded into it. So the bytes rewritten follow the keys that change, not the table's size.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from foyer.operators.rejects import REASON
from foyer.streaming.files import write_even
from foyer.streaming.run import BatchWriter

#: Changes of one level that are merged at once.
FAN = 8
#: The level of a bucket's whole rows; the bucket of rejected rows.
_WHOLE, _REJECTS = -1, -1
_BATCH, _BUCKET, _FOLDER = "__batch", "__bucket", "__part"


@dataclass(frozen=True)
class Part:
    level: int
    size: int
    files: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    """The parts of each bucket after a batch; ``rewritten`` are the bytes it merged or folded.

    ``own`` are the files of good rows that the batch itself wrote, ``notes`` what its writer has to remember.
    """

    version: int
    schema: str
    buckets: int
    parts: dict[int, list[Part]] = field(default_factory=dict)
    rewritten: int = 0
    own: list[str] = field(default_factory=list)
    notes: dict = field(default_factory=dict)

    def files(self) -> set[str]:
        return {name for parts in self.parts.values() for part in parts for name in part.files} | set(self.own)

    def text(self) -> str:
        parts = {str(b): [[p.level, p.size, list(p.files)] for p in found] for b, found in self.parts.items()}
        return json.dumps({"version": self.version, "schema": self.schema, "buckets": self.buckets, "parts": parts,
                           "rewritten": self.rewritten, "own": self.own, "notes": self.notes})

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)
        parts = {int(b): [Part(level, size, tuple(files)) for level, size, files in listed]
                 for b, listed in found.pop("parts").items()}
        return Manifest(**found, parts=parts)


class _Folder:
    """The table's folder in whatever file system it is, by Spark's own access."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._root = self._at("")
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        if not self._files.exists(self._at(folder)):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._at(folder)))

    def sizes(self, folder: str) -> dict[str, int]:
        """All data files below a folder, by name below the table's."""
        if not self._files.exists(self._at(folder)):
            return {}
        found, listed = {}, self._files.listFiles(self._at(folder), True)
        while listed.hasNext():
            status = listed.next()
            name = status.getPath().toUri().getPath()
            if name.endswith(".parquet"):
                found[folder + name.split(f"/{folder}", 1)[1]] = status.getLen()
        return found

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file that is there whole or not at all."""
        draft = self._at(f"drafts/{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        self._files.mkdirs(self._at(name).getParent())
        if not self._files.rename(draft, self._at(name)):
            raise OSError(f"cannot put {name} in place below {self.path}")

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


def _versions(folder: _Folder) -> list[tuple[int, int, str]]:
    """(version, attempt, name) of the manifests, in order."""
    found = []
    for name in folder.names("manifests"):
        version, attempt = name.removesuffix(".json").rsplit("-", 1)
        found.append((int(version), int(attempt), name))
    return sorted(found)


def _manifest(folder: _Folder, before: int | None = None) -> Manifest | None:
    """The newest manifest, or the newest of the batches before one."""
    found = [name for version, _, name in _versions(folder) if before is None or version < before]
    return Manifest.of(folder.read(f"manifests/{found[-1]}")) if found else None


def manifest(spark: SparkSession, path: str, before: int | None = None) -> Manifest | None:
    """What the table holds now, or held before a batch."""
    return _manifest(_Folder(spark, path), before)


def _put(folder: _Folder, new: Manifest) -> None:
    attempt = 1 + max((a for version, a, _ in _versions(folder) if version == new.version), default=-1)
    folder.put(f"manifests/{new.version}-{attempt}.json", new.text())


def _written(rows: DataFrame, folder: _Folder, name: str) -> dict[int, tuple[int, tuple[str, ...]]]:
    """Write rows by bucket to a new folder: size and files of each bucket."""
    write_even(rows.withColumn(_FOLDER, F.col(_BUCKET)), f"{folder.path}/{name}", _FOLDER, by=_FOLDER)
    found = defaultdict(dict)
    for file, size in folder.sizes(name).items():
        found[int(file.rsplit(f"{_FOLDER}=", 1)[1].split("/")[0])][file] = size
    return {bucket: (sum(files.values()), tuple(sorted(files))) for bucket, files in found.items()}


def _read(spark: SparkSession, folder: _Folder, schema: str, files: Sequence[str]) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*(f"{folder.path}/{f}" for f in files))


def _latest(rows: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """The newest row of each key."""
    values = [name for name in rows.columns if name not in (*keys, *more, _BATCH)]
    return rows.groupBy(*keys, *more).agg(
        *(F.max_by(name, _BATCH).alias(name) for name in values), F.max(_BATCH).alias(_BATCH)
    )


def _due(bucket: int, parts: list[Part], share: float) -> tuple[int, list[Part]] | None:
    """What a bucket has to rewrite now: the new part's level and the parts that go into it."""
    changes = [part for part in parts if part.level != _WHOLE]
    whole = sum(part.size for part in parts if part.level == _WHOLE)
    if bucket != _REJECTS and len(parts) > 1 and sum(part.size for part in changes) >= share * whole:
        return _WHOLE, parts
    for level in sorted({part.level for part in changes}):
        same = [part for part in changes if part.level == level]
        if len(same) >= FAN:
            return level + 1, same
    return None


def upsert_table(
    path: str, keys: Sequence[str], buckets: int = 16, share: float = 0.5, keep: int = 10
) -> BatchWriter:
    """Keyed upsert: rows of a later batch replace those of an earlier one.

    ``buckets`` holds for the life of a table; choose it so that a bucket's whole rows are a few files. Rows with
    a ``reject_reason`` are kept apart, in the same write, for ``rejects``. Manifests of the last ``keep``
    batches stay, and the files that they name: a reader may take that long. Keep the table and the
    checkpoint of one stream together: they share batch numbers. ``notes()`` is asked after the
    batch has been written, and kept with it.
    """
    def write(batch: DataFrame, batch_id: int, notes: Callable[[], dict] = dict) -> None:
        spark = batch.sparkSession
        folder = _Folder(spark, path)
        base = _manifest(folder, batch_id)
        spread = base.buckets if base else buckets
        bucket = F.pmod(F.xxhash64(*keys), F.lit(spread)).cast("int")
        if REASON in batch.columns:
            bucket = F.when(F.col(REASON).isNull(), bucket).otherwise(F.lit(_REJECTS))
        rows = batch.withColumn(_BATCH, F.lit(batch_id).cast("long")).withColumn(_BUCKET, bucket)
        schema = rows.schema.json()
        attempt, own = uuid.uuid4().hex, []
        parts = defaultdict(list, {b: list(found) for b, found in base.parts.items()} if base else {})
        for b, (size, files) in _written(rows, folder, f"data/{batch_id}-{attempt}").items():
            # The first rows of a bucket are its whole rows as they are.
            level = 0 if parts[b] or b == _REJECTS else _WHOLE
            parts[b].append(Part(level, size, files))
            own += files if b != _REJECTS else ()
        due = {b: found for b in parts if (found := _due(b, parts[b], share))}
        rewritten = 0
        if due:
            files = [name for _, old in due.values() for part in old for name in part.files]
            merged = _read(spark, folder, schema, files)
            keyed = _latest(merged.where(F.col(_BUCKET) != _REJECTS), keys, _BUCKET).select(merged.columns)
            if _REJECTS in due:
                keyed = keyed.union(merged.where(F.col(_BUCKET) == _REJECTS))
            for b, (size, names) in _written(keyed, folder, f"data/{batch_id}-{attempt}-merged").items():
                level, old = due[b]
                parts[b] = [part for part in parts[b] if part not in old] + [Part(level, size, names)]
                rewritten += size
        _put(folder, Manifest(batch_id, schema, spread, dict(parts), rewritten, own, notes()))
        _forget(folder, batch_id - keep)

    return write


def declare(rows: DataFrame, path: str, buckets: int = 16) -> None:
    """Give a table the columns of ``rows``, so that it can be read before its first batch."""
    folder = _Folder(rows.sparkSession, path)
    if not _versions(folder):
        schema = StructType([*rows.schema, StructField(_BATCH, LongType()), StructField(_BUCKET, IntegerType())])
        _put(folder, Manifest(-1, schema.json(), buckets))


def _forget(folder: _Folder, before: int) -> None:
    """Delete the manifests before a version, and files of theirs and of failed attempts that no later one names."""
    versions = _versions(folder)
    old = [(version, name) for version, _, name in versions if version < before]
    if not old or len(old) == len(versions):
        return
    kept: set[str] = set()
    for version, _, name in versions:
        if version >= before:
            kept |= Manifest.of(folder.read(f"manifests/{name}")).files()
    for name in folder.names("data"):
        if int(name.split("-")[0]) < before:
            files = folder.sizes(f"data/{name}")
            gone = [file for file in files if file not in kept]
            if len(gone) == len(files):
                folder.delete(f"data/{name}")
            else:
                for file in gone:
                    folder.delete(file)
    for _, name in old:
        folder.delete(f"manifests/{name}")


def upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table's rows as of its newest manifest; batches that come later do not touch them."""
    folder = _Folder(spark, path)
    found = _manifest(folder)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    files = sorted({name for b, parts in found.parts.items() if b != _REJECTS for part in parts for name in part.files})
    if files:
        rows = _latest(_read(spark, folder, found.schema, files).drop(_BUCKET), keys)
    else:
        rows = spark.createDataFrame([], StructType.fromJson(json.loads(found.schema))).drop(_BUCKET)
    return rows.drop(_BATCH, "line", REASON) if REASON in rows.columns else rows.drop(_BATCH)


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows of all batches: ``batch_id``, ``line``, ``reject_reason``, and how often in the batch."""
    folder = _Folder(spark, path)
    found = _manifest(folder)
    files = [name for part in (found.parts.get(_REJECTS, []) if found else []) for name in part.files]
    if not files:
        return spark.createDataFrame([], f"batch_id long, line string, {REASON} string, n long")
    rows = _read(spark, folder, found.schema, files)
    n = F.col("n").cast("long") if "n" in rows.columns else F.lit(1).cast("long")
    return rows.select(F.col(_BATCH).alias("batch_id"), "line", REASON, n.alias("n"))


def own_rows(spark: SparkSession, path: str, found: Manifest) -> DataFrame:
    """The good rows that the manifest's batch wrote."""
    folder = _Folder(spark, path)
    if found.own:
        return _read(spark, folder, found.schema, found.own).drop(_BATCH, _BUCKET)
    return spark.createDataFrame([], StructType.fromJson(json.loads(found.schema))).drop(_BATCH, _BUCKET)


def whole_table(path: str, keep: int = 10) -> BatchWriter:
    """A table that each batch replaces whole, for streams in ``complete`` mode; the last ``keep`` copies stay.

    A batch that is repeated gives a new copy under its own number.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = _Folder(batch.sparkSession, path)
        rows = batch.withColumn(_BATCH, F.lit(batch_id).cast("long")).withColumn(_BUCKET, F.lit(0))
        found = _written(rows, folder, f"data/{batch_id}-{uuid.uuid4().hex}")
        parts = {b: [Part(_WHOLE, size, files)] for b, (size, files) in found.items()}
        _put(folder, Manifest(batch_id, rows.schema.json(), 1, parts))
        _forget(folder, batch_id + 1 - keep)

    return write


def copies(spark: SparkSession, path: str) -> list[int]:
    """The batches whose whole copies are there, in order."""
    return sorted({version for version, _, _ in _versions(_Folder(spark, path))})


def whole_copy(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """The copy of a batch, or the newest."""
    folder = _Folder(spark, path)
    found = _manifest(folder, None if batch_id is None else batch_id + 1)
    if found is None or batch_id not in (None, found.version):
        raise FileNotFoundError(f"no copy of batch {batch_id} at {path}")
    files = sorted(found.files())
    if files:
        return _read(spark, folder, found.schema, files).drop(_BATCH, _BUCKET)
    return spark.createDataFrame([], StructType.fromJson(json.loads(found.schema))).drop(_BATCH, _BUCKET)
