"""Tables whose partitions are written once and switched by one commit record.

Every write goes to a folder of its own, ``<root>/version=<id>``, which nobody
reads yet. One small file in ``<root>/_log`` then names the partitions it
replaces; creating that file is the whole publication, for one partition or a
thousand. No file is moved or replaced: a reader resolves the newest version of
each partition once and keeps reading those files whatever is committed
meanwhile, until ``vacuum`` removes what has been out of use for a while.

Commit files are numbered. A writer that finds its number taken looks at what
came between: other partitions are no conflict, the same ones are.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.sources.files import Folder

_LOG = "_log"
_RECORD = "number bigint, part string, version string, source string, at bigint"
#: Name of the only partition of a table without partition columns.
WHOLE = ""


class ConcurrentCommit(Exception):
    """Another writer has replaced the same partitions meanwhile."""


class VersionedTable:
    """A Parquet table of write-once versions below ``root``."""

    def __init__(self, spark: SparkSession, root: str, partitions: tuple[str, ...] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partitions = partitions
        self._log = Folder(spark, f"{self.root}/{_LOG}")

    @property
    def _depth(self) -> str:
        return "/".join(f"{p}=*" for p in self.partitions)

    def exists(self) -> bool:
        return bool(self._names())

    # -- writing --------------------------------------------------------------

    def stage(self, frame: DataFrame) -> str:
        """Write a new version that no reader sees; returns its id."""
        version = uuid.uuid4().hex
        writer = frame.write.mode("errorifexists").option("compression", "snappy")
        if self.partitions:
            writer = writer.partitionBy(*self.partitions)
        writer.parquet(self.folder(version))
        return version

    def folder(self, version: str, part: str = WHOLE) -> str:
        return f"{self.root}/version={version}/{part}".rstrip("/")

    def parts_of(self, version: str) -> list[str]:
        """The partitions that a version holds, from its folders."""
        return Folder(self.spark, self.folder(version)).glob(self._depth) if self.partitions else [WHOLE]

    def head(self) -> int:
        """Number of the newest commit, 0 if there is none."""
        return max((int(name.split(".")[0]) for name in self._names()), default=0)

    def _names(self) -> list[str]:
        return self._log.glob("[0-9]*.json")

    def commit(
        self,
        version: str | None,
        parts: Iterable[str],
        since: int | None = None,
        sources: dict[str, str] | None = None,
    ) -> int:
        """Make a version the current one of the given partitions; returns the commit's number.

        ``version`` None removes them. ``since`` is the commit the version was
        computed from: if one of its partitions was replaced after that, this
        raises. ``sources`` is kept with the partitions.
        """
        parts = sorted(set(parts))
        while True:
            head = self.head()
            if since is not None and head > since:
                later = {r["part"] for r in self._records().where(F.col("number") > since).select("part").distinct().collect()}
                if clash := later.intersection(parts):
                    raise ConcurrentCommit(f"{self.root}: replaced meanwhile: {', '.join(sorted(clash))}")
            number, at = head + 1, int(time.time() * 1000)
            lines = [
                json.dumps({"number": number, "part": p, "version": version, "source": (sources or {}).get(p), "at": at})
                for p in parts
            ]
            if self._log.create_once(f"{number:020d}.json", "\n".join(lines) + "\n"):
                return number

    def publish(self, frame: DataFrame, since: int | None = None) -> int:
        """Write a version and make it current for the partitions it holds."""
        version = self.stage(frame)
        return self.commit(version, self.parts_of(version), since)

    # -- reading --------------------------------------------------------------

    def _records(self) -> DataFrame:
        """All commit lines; a snapshot repeats older ones with their numbers."""
        return self.spark.read.schema(_RECORD).json([f"{self._log.path}/{n}" for n in self._names()])

    def current(self, as_of: int | None = None) -> dict[str, tuple[str, str | None]]:
        """The newest version of each partition and the source kept with it: one line per partition."""
        if not self.exists():
            return {}
        rows = self._records()
        if as_of is not None:
            rows = rows.where(F.col("number") <= as_of)
        newest = rows.groupBy("part").agg(F.max_by(F.struct("version", "source"), "number").alias("v"))
        return {r["part"]: (r["v"]["version"], r["v"]["source"]) for r in newest.collect() if r["v"]["version"] is not None}

    def read(self, schema: T.StructType | None = None, as_of: int | None = None) -> DataFrame:
        """The rows of all current partitions, as of now or of an earlier commit."""
        own = self.current(as_of)
        if not own:
            if schema is None:
                raise FileNotFoundError(f"{self.root} holds nothing")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())]))
        paths = sorted(self.folder(version, part) for part, (version, _) in own.items())
        return reader.option("basePath", self.root).parquet(*paths).drop("version")

    # -- upkeep ---------------------------------------------------------------

    def files(self) -> dict[str, list[int]]:
        """Bytes of the data files of each current partition."""
        pattern = "/".join(["version=*", *([self._depth] if self.partitions else []), "*.parquet"])
        own = {self.folder(version, part): part for part, (version, _) in self.current().items()}
        out: dict[str, list[int]] = {part: [] for part in own.values()}
        for name, size in Folder(self.spark, self.root).sizes(pattern):
            part = own.get(f"{self.root}/{name.rsplit('/', 1)[0]}")
            if part is not None:
                out[part].append(size)
        return out

    def compact_files(self, schema: T.StructType, file_bytes: int = 128 << 20) -> dict[str, int]:
        """Rewrite partitions cut into more files than their bytes need; returns their new file counts.

        The number of files follows from the bytes on disk. Rows of a partition
        are dealt evenly over its files; other partitions are not read. The
        rewritten ones become current by one commit, unless others replaced them.
        """
        since, wanted = self.head(), {}
        for part, sizes in self.files().items():
            need = max(1, -(-sum(sizes) // file_bytes))
            if len(sizes) > need:
                wanted[part] = need
        if not wanted:
            return {}
        own = self.current(since)
        rows = (
            self.spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())]))
            .option("basePath", self.root)
            .parquet(*[self.folder(own[part][0], part) for part in wanted])
            .drop("version")
        )
        name = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in self.partitions])
        ends = list(accumulate(wanted.values(), initial=0))
        rows_of = [(part, n, first) for (part, n), first in zip(wanted.items(), ends)]
        # One line per partition, as on the driver: the rows are not shuffled to meet it.
        files = F.broadcast(self.spark.createDataFrame(rows_of, "part_ string, files_ bigint, first_ bigint"))
        dealt = (
            rows.withColumn("part_", name)
            .join(files, "part_")
            .withColumn("slot_", (F.col("first_") + F.pmod(F.monotonically_increasing_id(), F.col("files_"))).cast("int"))
            .repartitionById(ends[-1], F.col("slot_"))
            .drop("part_", "files_", "first_", "slot_")
        )
        sources = {part: source for part, (_, source) in own.items()}
        self.commit(self.stage(dealt), wanted, since, sources)
        return wanted

    def compact_log(self, keep_seconds: float = 3600) -> None:
        """Write the state as one snapshot; drop commit files older than that and than ``keep_seconds``.

        The snapshot lines carry the numbers of their commits, so both kinds of
        files may be read together, and a commit that is made meanwhile counts
        as later.
        """
        names, head = self._names(), self.head()
        if head == 0:
            return
        newest = self._records().where(F.col("number") <= head).groupBy("part").agg(
            F.max_by(F.struct("number", "version", "source", "at"), "number").alias("v")
        )
        lines = [json.dumps({"part": r["part"], **r["v"].asDict()}) for r in newest.orderBy("part").collect()]
        snapshot = f"{head:020d}.snapshot.json"
        if snapshot not in names:
            self._log.create_once(snapshot, "\n".join(lines) + "\n")
        limit = (time.time() - keep_seconds) * 1000
        ages = dict(self._log.changed_at("[0-9]*.json"))
        for name in names:
            # The newest number stays, so that the next one is known.
            if name != snapshot and int(name.split(".")[0]) <= head and ages.get(name, limit) < limit:
                if name != f"{head:020d}.json":
                    self._log.delete(name)

    def vacuum(self, keep_seconds: float = 7 * 86_400) -> list[str]:
        """Delete partition folders that are in no use and older than ``keep_seconds``."""
        used = {self.folder(version, part) for part, (version, _) in self.current().items()}
        pattern = "version=*" + (f"/{self._depth}" if self.partitions else "")
        limit = (time.time() - keep_seconds) * 1000
        table = Folder(self.spark, self.root)
        gone = []
        for name, changed in table.changed_at(pattern):
            if f"{self.root}/{name}" not in used and changed < limit:
                table.delete(name)
                gone.append(name)
        return gone
