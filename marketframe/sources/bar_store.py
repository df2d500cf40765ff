"""The stored table of partial bar states (S17, S20, U1): appends, compaction by day, one list of live parts.

States lie in plain Parquet folders by day. Which (folder, day) parts are live says the newest version of a small list
under ``versions``; a version is written aside and renamed into place, which fails if another writer was first. So a
reader sees the table before or after an append or a compaction and never in between, a retried append changes nothing,
and a compaction rewrites only days that hold several parts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketframe.operators import bars as B
from marketframe.sources.sinks import with_day


class BarStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def version(self) -> int:
        """The newest version; 0 before the first append."""
        if not self._fs.exists(self._at("versions")):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(self._at("versions"))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def live(self, version: int | None = None) -> list[tuple[str, int]]:
        """The live (folder, day) parts of a version."""
        version = self.version() if version is None else version
        if not version:
            return []
        rows = self.spark.read.text(f"{self.path}/versions/{version:08d}.json").collect()      # one line a part
        return [tuple(json.loads(r.value)) for r in rows]

    def _commit(self, parts: list[tuple[str, int]], after: int) -> None:
        """The next version; raises if another writer took its place."""
        aside, to = self._at(f"aside-{uuid.uuid4().hex}"), self._at(f"versions/{after + 1:08d}.json")
        self._fs.mkdirs(self._at("versions"))
        out = self._fs.create(aside)
        out.write("\n".join(json.dumps(p) for p in sorted(parts)).encode())
        out.close()
        jvm = self.spark.sparkContext._jvm
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._hadoop.FileContext.getFileContext(self._fs.getUri()).rename(aside, to, none)

    def _write(self, states: DataFrame, folder: str) -> list[tuple[str, int]]:
        (with_day(states, "minute", "day").repartitionByRange("day", "symbol", "minute").sortWithinPartitions("day", "symbol", "minute")
         .write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/{folder}"))
        names = [f.getPath().getName() for f in self._fs.listStatus(self._at(folder))]
        return [(folder, int(n.removeprefix("day="))) for n in names if n.startswith("day=")]

    def append(self, ticks: DataFrame, name: str) -> bool:
        """The partial states of a batch of ticks. ``name`` tells batches apart: one that is live, or was and has
        been compacted since, is not added again (False)."""
        at = self.version()
        if self._fs.exists(self._at(f"done/{name}")):
            return False
        parts = self.live(at)
        if not any(f == f"batch-{name}" for f, _ in parts):
            self._commit(parts + self._write(B.partial_bars(ticks), f"batch-{name}"), at)
        self._fs.create(self._at(f"done/{name}"), True).close()
        return True

    def compact(self, least: int = 2) -> list[int]:
        """Days with at least ``least`` parts become one part each (A10); the other days are not read. Returns the days."""
        at = self.version()
        parts = self.live(at)
        several = {d for _, d in parts if sum(e == d for _, e in parts) >= least}
        if several:
            old = [p for p in parts if p[1] in several]
            merged = self._write(B.merge_partials(self._states(old)), f"merged-{at + 1:08d}-{uuid.uuid4().hex}")
            self._commit([p for p in parts if p[1] not in several] + merged, at)
        return sorted(several)

    def vacuum(self) -> int:
        """Removes the parts that the newest version does not name; only when no reader is on an older one."""
        live, gone = set(self.live()), 0
        for folder in self._fs.listStatus(self._hadoop.Path(self.path)):
            name = folder.getPath().getName()
            if name.startswith(("batch-", "merged-")):
                for day in self._fs.listStatus(folder.getPath()):
                    own = day.getPath().getName()
                    if own.startswith("day=") and (name, int(own.removeprefix("day="))) not in live:
                        gone += self._fs.delete(day.getPath(), True)
        return gone

    def _states(self, parts: list[tuple[str, int]]) -> DataFrame:
        if not parts:
            return B.partial_bars(self.spark.createDataFrame([], "seq long, timestamp timestamp, timestamp_ms long, symbol string, price double, volume double"))
        return self.spark.read.parquet(*[f"{self.path}/{f}/day={d}" for f, d in parts]).select(*B.STATE)

    def states(self, frm=None, to=None) -> DataFrame:
        """The states of the newest version; with a range of minutes only its days' parts are opened."""
        day = lambda x: int(str(x)[:10].replace("-", ""))       # noqa: E731
        s = self._states([p for p in self.live() if (frm is None or p[1] >= day(frm)) and (to is None or p[1] <= day(to))])
        if frm is not None:
            s = s.filter(F.col("minute") >= F.lit(str(frm)).cast("timestamp"))
        return s if to is None else s.filter(F.col("minute") <= F.lit(str(to)).cast("timestamp"))

    def bars(self, frm=None, to=None, open_mode: str = "heavy") -> DataFrame:
        """The finalising view over the stored states (what the dashboards read)."""
        return B.finalize(self.states(frm, to), open_mode)
