"""A store of small tables, each kept as numbered versions below one folder.

Parquet tables take no MERGE, and a path must not be overwritten while it is read, so every change
writes the next version. Readers take the latest complete one. A version is written aside and takes
its number by a rename that fails if the number is taken: of two loads at once the later one builds
its change anew on the other's version, so that both count and no key is given twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quotemart.operators.upsert import shaped
from quotemart.schemas import FACT, SCHEMAS
from quotemart.sinks.snapshots import keep_latest
from quotemart.sources import files
from quotemart.sources.snapshots import latest_token, read_snapshot

VERSION = "version"
KEPT_VERSIONS = 3
# Staged rows of other loads that may be running are left alone up to this many.
KEPT_STAGED = 8
ROWS = "_rows"


class Store:
    """Versioned tables below a folder every executor can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        # Versions that this store has written: the last of a table, and the staged ones it still keeps.
        self.last: dict[str, str] = {}
        self.staged: dict[str, list[str]] = {}

    def path(self, table: str) -> str:
        """Folder of a table."""
        return f"{self.folder}/{table}"

    def init(self, tables: list[str]) -> None:
        """Make empty tables; whatever they held is left behind as an older version."""
        for table in tables:
            self.write(table, self.spark.createDataFrame([], SCHEMAS[table]))

    def read(self, table: str) -> DataFrame:
        """Latest version of a table, empty if it was never written."""
        return read_snapshot(self.spark, self.path(table), VERSION, SCHEMAS[table])

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write the next version of a table, whatever the one before holds, and return it as read back."""
        return self._next(table, lambda: shaped(df, SCHEMAS[table]))

    def change(self, table: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Write the next version from the latest and return it as read back.

        ``build`` makes the new content from the old; it is called again if somebody else has
        published a version meanwhile.
        """
        while True:
            held = latest_token(self.spark, self.path(table), VERSION)
            old = read_snapshot(self.spark, self.path(table), VERSION, SCHEMAS[table], held) if held else self.read(table)
            made = self._attempt(table, shaped(build(old), SCHEMAS[table]), int(held or 0) + 1)
            if made is not None:
                keep_latest(self.spark, self.path(table), VERSION, KEPT_VERSIONS)
                return made

    def revert(self, table: str) -> None:
        """Delete the version this store has written last, if it is still the latest, so that the one before counts again."""
        last = latest_token(self.spark, self.path(table), VERSION)
        if last and last == self.last.get(table):
            files.delete(self.spark, f"{self.path(table)}/{VERSION}={last}")

    def rows(self, table: str) -> int | None:
        """Rows of the latest version, as its write has counted them; None if there is none. Starts no job."""
        last = latest_token(self.spark, self.path(table), VERSION)
        text = files.read_text(self.spark, f"{self.path(table)}/{VERSION}={last}/{ROWS}") if last else None
        return int(text) if text else None

    def stage(self, name: str, df: DataFrame, kept: int | None = None) -> DataFrame:
        """Write intermediate rows and return them as read back.

        All runs are kept for audit, or the last ``kept`` of this store and some of others. What follows starts from the written rows, so they are computed once and a lost executor
        costs no more than a new read.
        """
        name = f"audit/{name}"
        made = self._next(name, lambda: df, KEPT_STAGED if kept else None)
        if kept:
            own = self.staged.setdefault(name, [])
            own.append(self.last[name])
            for token in own[:-kept]:
                files.delete(self.spark, f"{self.path(name)}/{VERSION}={token}")
            del own[:-kept]
        return made

    def _attempt(self, name: str, df: DataFrame, number: int) -> DataFrame | None:
        """Publish rows as one version, None if its number is taken."""
        table, token = self.path(name), f"{number:09d}"
        aside, seen = f"{table}/_new-{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(aside)
        files.write_text(self.spark, f"{aside}/{ROWS}", str(seen.get["rows"]))
        if not files.commit(self.spark, aside, f"{table}/{VERSION}={token}"):
            files.delete(self.spark, aside)
            return None
        self.last[name] = token
        return read_snapshot(self.spark, table, VERSION, df.schema, token)

    def _next(self, name: str, build: Callable[[], DataFrame], kept: int | None = KEPT_VERSIONS) -> DataFrame:
        while True:
            last = latest_token(self.spark, self.path(name), VERSION)
            made = self._attempt(name, build(), int(last or 0) + 1)
            if made is not None:
                if kept:
                    keep_latest(self.spark, self.path(name), VERSION, kept)
                return made


def fact_path(store: Store) -> str:
    """Folder of the daily fact."""
    return store.path(FACT)
