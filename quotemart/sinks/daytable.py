"""Tables by day that change by one rename.

Every load writes its days into a folder of its own. A pointer version, one small file, names for
each day the load that counts. Readers take the newest version, so rows that were written but not
published are never seen, days change together or not at all, and a version that somebody else has
published meanwhile is taken as the ground for the next.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quotemart.sources import files

LOADS, POINTERS, VERSION, LOAD = "loads", "pointers", "version", "load"
KEPT = 3


class Conflict(RuntimeError):
    """Another load has changed a day since it was read."""


@dataclass(frozen=True)
class Pointer:
    """The load that counts for a day, the rows it has there, and how many days it wrote in all."""

    load: str
    rows: int
    of: int


@dataclass(frozen=True)
class Version:
    """One state of a table: its number, a label, and the pointers by day; a calendar bounds the days."""

    number: int
    label: str
    days: dict[int, Pointer]


@dataclass(frozen=True)
class Staged:
    """Rows written but not published: the load's name, the rows read back, and those lost for want of a day.

    ``days`` counts the rows of each day, ``nulls`` those without a value in the columns asked for.
    """

    load: str
    rows: DataFrame
    days: dict[int, int]
    nulls: dict[str, int]
    dropped: int


class DayTable:
    """A table below ``path``, partitioned by an integer column."""

    def __init__(self, spark: SparkSession, path: str, day: str, schema: StructType):
        self.spark, self.path, self.day, self.schema = spark, path.rstrip("/"), day, schema
        # Partition columns come last on disk.
        self.by_day = StructType([f for f in schema.fields if f.name != day] + [schema[day]])

    def _version_path(self, number: int) -> str:
        return f"{self.path}/{POINTERS}/{VERSION}={number:09d}"

    def _numbers(self) -> list[int]:
        found = files.names(self.spark, f"{self.path}/{POINTERS}")
        return [int(n.removeprefix(f"{VERSION}=")) for n in found if n.startswith(f"{VERSION}=")]

    def _load_path(self, load: str) -> str:
        return f"{self.path}/{LOADS}/{LOAD}={load}"

    def _read_version(self, number: int) -> Version | None:
        text = files.read_text(self.spark, f"{self._version_path(number)}/days.json")
        if text is None:
            return None
        held = json.loads(text)
        return Version(number, held["label"], {int(d): Pointer(*p) for d, p in held["days"].items()})

    def version(self, label: str | None = None) -> Version:
        """The newest version, or the newest under a label; version 0 has no days."""
        for number in reversed(self._numbers()):
            found = self._read_version(number)
            if found and label in (None, found.label):
                return found
        if label is not None:
            raise ValueError(f"{self.path} has no version labelled {label}")
        return Version(0, "", {})

    def exists(self) -> bool:
        """Whether any version was published."""
        return bool(self._numbers())

    def read(self, days: Iterable[int] | None = None, label: str | None = None, version: Version | None = None) -> DataFrame:
        """The rows that count, of the given days or of all; only their folders are listed."""
        held = (version or self.version(label)).days
        wanted = held if days is None else {d: held[d] for d in set(days) & held.keys()}
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        whole = Counter(p.load for p in wanted.values())
        paths = {self._load_path(p.load) if whole[p.load] == p.of else f"{self._load_path(p.load)}/{self.day}={d}" for d, p in wanted.items()}
        read = self.spark.read.schema(self.by_day).option("basePath", f"{self.path}/{LOADS}").parquet(*sorted(paths))
        return (read if days is None else read.where(F.col(self.day).isin(sorted(wanted)))).select(*self.schema.names)

    def stage(self, rows: DataFrame, required: Sequence[str] = ()) -> Staged:
        """Write rows where no reader looks; rows without a day are counted and left out.

        One pass over the written rows counts them by day, and the nulls of the required columns.
        """
        load = uuid.uuid4().hex
        seen = Observation()
        lost = F.count(F.when(F.col(self.day).isNull(), 1)).alias("lost")
        observed = rows.select(*self.schema.names).observe(seen, lost).where(F.col(self.day).isNotNull())
        observed.write.partitionBy(self.day).parquet(self._load_path(load))
        back = self.spark.read.schema(self.by_day).parquet(self._load_path(load)).select(*self.schema.names)
        nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in required]
        counts = back.groupBy(self.day).agg(F.count(F.lit(1)).alias("n"), *nulls).collect()
        missing = {c: sum(r[f"null_{c}"] for r in counts) for c in required}
        return Staged(load, back, {r[self.day]: r["n"] for r in counts}, missing, seen.get["lost"])

    def discard(self, staged: Staged) -> None:
        """Remove rows that shall not be published."""
        files.delete(self.spark, self._load_path(staged.load))

    def publish(self, staged: Staged, touched: Iterable[int], label: str = "", ground: Version | None = None) -> list[int]:
        """Let the staged days count, and empty the other touched ones; returns the days emptied.

        Of two loads at once the later rename finds its number taken, takes the new version as its
        ground and tries again, so both count. Rows that were made from a version's content name it
        as their ``ground``: a day that has changed since raises ``Conflict``.
        """
        changing = set(touched) | staged.days.keys()
        mine = {d: Pointer(staged.load, n, len(staged.days)) for d, n in staged.days.items()}
        emptied: list[int] = []

        def change(old: dict[int, Pointer]) -> dict[int, Pointer]:
            if ground and any(old.get(d) != ground.days.get(d) for d in changing):
                raise Conflict(f"{self.path}: a day has changed since version {ground.number}")
            emptied[:] = sorted(d for d in set(touched) - mine.keys() if d in old)
            return {d: p for d, p in old.items() if d not in emptied} | mine

        self._swap(change, label)
        return emptied

    def clear(self) -> None:
        """Make the table empty; what it held is left behind as an older version."""
        self._swap(lambda old: {}, "")

    def _swap(self, change, label: str) -> None:
        while True:
            held = self.version()
            days = change(held.days)
            folder = f"{self.path}/{POINTERS}/_new-{uuid.uuid4().hex}"
            text = {"label": label, "days": {d: [p.load, p.rows, p.of] for d, p in sorted(days.items())}}
            files.write_text(self.spark, f"{folder}/days.json", json.dumps(text))
            if files.commit(self.spark, folder, self._version_path(held.number + 1)):
                break
            files.delete(self.spark, folder)
        self._clean()

    def _clean(self) -> None:
        """Remove old pointer versions, and the days that only they named."""
        numbers = self._numbers()
        kept = [v for n in numbers[-KEPT:] if (v := self._read_version(n))]
        named = {(d, p.load) for v in kept for d, p in v.days.items()}
        loads = {load for _, load in named}
        for number in numbers[:-KEPT]:
            old = self._read_version(number)
            for d, p in old.days.items() if old else ():
                if p.load not in loads:
                    files.delete(self.spark, self._load_path(p.load))
                elif (d, p.load) not in named:
                    files.delete(self.spark, f"{self._load_path(p.load)}/{self.day}={d}")
            files.delete(self.spark, self._version_path(number))
