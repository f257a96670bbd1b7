"""Tables of change files by period and bucket of sites, with versions.

An upsert writes its own rows and nothing else: one change file for each period and bucket
that they fall in. Reading puts changes together, the later ones in front, only where a
bucket has several. A version is a small table of entries, one for each change file with
its numbers of rows and its ranges of time and site; it counts once its ``_SUCCESS`` marker is
there, so a reader sees the version before or the one after and files are never replaced
below it. Entries also tell which files a window of time or some sites need.

One writer at a time; a batch that is repeated after a crash is written once. Which files
a read opens is decided on the driver, from the entries that its filters leave.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..columns import KEYS, TS
from ..functions import time as t
from . import tables

SNAPSHOT = 16  # every so many versions list all live entries, those between only what they add
MANY_CHANGES = 8
LOG = (
    "v long, part date, bucket int, base boolean, n_rows long, low timestamp_ntz, high timestamp_ntz, "
    "first string, last string, writer string, batch long, layout string"
)
_EVER = "1970-01-01"


Places = set[tuple[dt.date, int]]


@dataclass(frozen=True)
class BucketTable:
    """A table at ``path``, keyed by ``keys`` and ``ts``.

    ``period`` is what one part covers: ``day``, ``month``, ``year`` or ``ever``. ``moment`` is the SQL
    expression whose period counts, by default the time itself.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str] = KEYS
    ts: str = TS
    period: str = "day"
    buckets: int = 64
    moment: str | None = None
    _marks: dict = field(default_factory=dict, compare=False, repr=False)

    # Where rows belong

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def part(self, moment: str | None = None) -> Column:
        moment = moment or self.moment or self.ts
        if self.period == "ever":
            return F.lit(_EVER).cast("date").alias("part")
        day = F.expr(f"CAST({moment} AS DATE)")
        return (day if self.period == "day" else F.trunc(day, self.period)).alias("part")

    def places(self, points: DataFrame, moment: str | None = None) -> Places:
        """The parts and buckets of some keys and moments, at most one for each that there is."""
        return {tuple(row) for row in points.select(self.part(moment), self.bucket()).distinct().collect()}

    def widened(self, places: Places) -> Places:
        """The parts and buckets of this table around those of one with the same buckets and shorter periods."""
        if self.period == "day":
            return places
        first = {"month": {"day": 1}, "year": {"day": 1, "month": 1}}.get(self.period)
        return {(part.replace(**first) if first else dt.date.fromisoformat(_EVER), bucket) for part, bucket in places}

    # Versions

    def _folder(self, kind: str, v: int) -> str:
        return f"{self.path.rstrip('/')}/{kind}/v={v:09d}"

    def version(self) -> int:
        """The newest complete version, 0 if there is none."""
        fs, folder = tables._file_system(self.spark, f"{self.path.rstrip('/')}/versions")
        if not fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        for v in sorted((int(x[2:]) for x in names if x.startswith("v=")), reverse=True):
            if tables.exists(self.spark, f"{self._folder('versions', v)}/_SUCCESS"):
                return v
        return 0

    def log(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        start = max(version - version % SNAPSHOT, 1)
        folders = [self._folder("versions", v) for v in range(start, version + 1)]
        reader = self.spark.read.schema(LOG)
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], LOG)

    def entries(self, version: int | None = None) -> DataFrame:
        """The change files that count: those of a bucket since its last compaction."""
        found = self.log(version).where("part IS NOT NULL")
        base = found.where("base").groupBy("part", "bucket").agg(F.max("v").alias("since"))
        found = found.join(base, ["part", "bucket"], "left").where("v >= coalesce(since, 0)")
        return found.drop("since")

    def marks(self, version: int) -> list:
        """The rows of a version's log that say which batches it holds and how it is laid out."""
        if version not in self._marks:
            self._marks.clear()
            found = self.log(version).where("part IS NULL").select("v", "writer", "batch", "layout")
            self._marks[version] = found.collect()  # one for each writer and version since the snapshot
        return self._marks[version]

    def version_of(self, writer: str, batch: int) -> int | None:
        """The version that a writer's batch made."""
        return max((m["v"] for m in self.marks(self.version()) if (m["writer"], m["batch"]) == (writer, batch)), default=None)

    def _commit(self, v: int, schema: StructType, base: bool, writer: str | None, batch: int | None) -> None:
        layout = json.dumps({"schema": schema.jsonValue(), "buckets": self.buckets, "period": self.period})
        written = self._scan([self._folder("changes", v)], schema)
        site = self.keys[0]
        added = written.groupBy("v", "part", "bucket").agg(
            F.lit(base).alias("base"), F.count("*").alias("n_rows"), F.min(self.ts).alias("low"), F.max(self.ts).alias("high"),
            F.min(F.col(site).cast("string")).alias("first"), F.max(F.col(site).cast("string")).alias("last"),
        )
        mark = self.spark.createDataFrame([(v, writer, batch, layout)], "v long, writer string, batch long, layout string")
        rows = added.unionByName(mark, allowMissingColumns=True)
        if v % SNAPSHOT == 0:
            before = self.log(v - 1).where("part IS NULL")
            marks = before.groupBy("writer").agg(F.max_by(F.struct(*before.columns), "v").alias("row")).select("row.*")
            rows = rows.unionByName(self.entries(v - 1), allowMissingColumns=True).unionByName(marks, allowMissingColumns=True)
        rows.select(*StructType.fromDDL(LOG).names).coalesce(1).write.mode("overwrite").parquet(self._folder("versions", v))

    # Writing

    def upsert(self, rows: DataFrame, writer: str, batch: int, sequence: str | None = None, unique: bool = False) -> int:
        """Insert rows, replacing those with the same key; the version that holds them.

        Within a batch the highest ``sequence`` wins, as in :func:`tables.upsert`, unless the rows are
        known to be ``unique``. Rows with a null in a key are an error. Repeating a batch changes nothing.
        """
        done, newest = self.version_of(writer, batch), self.version()
        if done:
            return done
        keyed = [*self.keys, self.ts]
        if not unique:
            if not sequence:
                sequence, rows = "_none", rows.withColumn("_none", F.lit(0))
            rows = tables.last_write_wins(rows, sequence, keyed)
        unkeyed = F.raise_error(F.lit("rows with a NULL key cannot be stored"))
        rows = rows.withColumns({c: F.coalesce(F.col(c), unkeyed.cast(rows.schema[c].dataType)) for c in keyed})
        self._write(rows, newest + 1)
        self._commit(newest + 1, rows.schema, False, writer, batch)
        return newest + 1

    def _write(self, rows: DataFrame, v: int) -> None:
        placed = rows.select("*", self.part(), self.bucket())
        (
            placed.hint("rebalance", "part", "bucket")
            .sortWithinPartitions("part", "bucket", *self.keys, self.ts)
            .write.mode("overwrite")
            .partitionBy("part", "bucket")
            .parquet(self._folder("changes", v))
        )

    def compact(self, changes: int = MANY_CHANGES) -> int:
        """One file again for each part and bucket with so many change files or more."""
        newest = self.version()
        many = self.entries(newest).groupBy("part", "bucket").agg(F.count("*").alias("n"))
        many = {tuple(row) for row in many.where(F.col("n") >= changes).select("part", "bucket").collect()}
        if not many:
            return newest
        files = self._files(newest, many)
        schema = self._schema(newest)
        self._write(self._merged(self._scan([f for some in files for f in some], schema), schema), newest + 1)
        self._commit(newest + 1, schema, True, None, None)
        return newest + 1

    def vacuum(self, keep: int = 2) -> int:
        """Remove change files that none of the last ``keep`` versions needs; how many folders."""
        newest = self.version()
        oldest = max(newest - keep + 1, 1)
        later = self.log(newest).where(F.col("part").isNotNull() & (F.col("v") > oldest))
        needed = self.entries(oldest).select("v", "part", "bucket").unionByName(later.select("v", "part", "bucket"))
        wanted = {tuple(self._file(*row).split("/")[-3:]) for row in needed.distinct().collect()}
        fs, pattern = tables._file_system(self.spark, f"{self.path.rstrip('/')}/changes/v=*/part=*/bucket=*")
        removed = 0
        for status in fs.globStatus(pattern) or []:
            place = status.getPath()
            name = place.getParent().getParent().getName(), place.getParent().getName(), place.getName()
            if int(name[0][2:]) <= newest and name not in wanted:
                removed += bool(fs.delete(place, True))
        return removed

    # Reading

    def _schema(self, version: int) -> StructType:
        layout = max(self.marks(version), key=lambda m: m["v"])["layout"]
        found = json.loads(layout)
        if (found["buckets"], found["period"]) != (self.buckets, self.period):
            raise ValueError(f"the table has {found['buckets']} buckets by {found['period']}")
        return StructType.fromJson(found["schema"])

    def _file(self, v: int, part, bucket: int) -> str:
        return f"{self._folder('changes', v)}/part={part}/bucket={bucket}"

    def _files(self, version: int, places: Places | None = None, low=None, high=None, sites=None) -> list[list[str]]:
        """The change files of each part and bucket that can hold such rows, later ones last."""
        if sites is not None:
            names = self.spark.createDataFrame([(s,) for s in sites], f"{self.keys[0]} string")
            homes = {row["bucket"] for row in names.select(self.bucket()).collect()}
        found = self.log(version).where("part IS NOT NULL")
        if places is not None:
            found = found.where(F.col("part").isin({part for part, _ in places}))
        if sites is not None:
            found = found.where(F.col("bucket").isin(homes))
        # The time is part of the key: a file beyond the window holds no copy of a row inside.
        outside = F.lit(False)
        if low is not None:
            outside |= F.col("high") < F.expr(t.wall(low))
        if high is not None:
            outside |= F.col("low") > F.expr(t.wall(high))
        each: dict[tuple, list] = {}
        rows = found.select("v", "part", "bucket", "base", F.coalesce(outside, F.lit(False)).alias("outside")).collect()
        for row in sorted(rows, key=lambda row: row["v"]):
            place = row["part"], row["bucket"]
            if places is not None and place not in places:
                continue
            files = each.setdefault(place, [])
            if row["base"]:
                files.clear()
            if not row["outside"]:
                files.append(self._file(row["v"], *place))
        return [files for files in each.values() if files]

    def _scan(self, files: list[str], schema: StructType) -> DataFrame:
        layout = StructType([*schema.fields, *StructType.fromDDL("v long, part date, bucket int").fields])
        return self.spark.read.schema(layout).option("basePath", f"{self.path.rstrip('/')}/changes").parquet(*files)

    def _merged(self, rows: DataFrame, schema: StructType) -> DataFrame:
        keyed = [*self.keys, self.ts]
        rest = [c for c in schema.names if c not in keyed]
        newest = F.max_by(F.struct(*rest), "v").alias("_row")
        return rows.groupBy(*keyed).agg(newest).select(*keyed, "_row.*").select(*schema.names)

    def change(self, version: int) -> DataFrame:
        """The rows that one version wrote."""
        schema = self._schema(version)
        return self._scan([self._folder("changes", version)], schema).select(*schema.names)

    def read(
        self,
        places: Places | None = None,
        low=None,
        high=None,
        sites: Sequence[str] | None = None,
        version: int | None = None,
        like: DataFrame | None = None,
    ) -> DataFrame:
        """The rows of a version: of some parts and buckets, in a closed window of time, of some sites.

        ``like`` gives the columns where the table does not exist yet.
        """
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], like.schema if like is not None else StructType())
        schema = self._schema(version)
        files = self._files(version, places, low, high, sites)
        clean, dirty = [f[0] for f in files if len(f) == 1], [f for some in files if len(some) > 1 for f in some]
        out = self.spark.createDataFrame([], schema)
        if clean:
            out = self._scan(clean, schema).select(*schema.names)
        if dirty:
            merged = self._merged(self._scan(dirty, schema), schema)
            out = out.unionByName(merged) if clean else merged
        if sites is not None:
            out = out.where(F.col(self.keys[0]).isin(list(sites)))
        bounds = [(">=", low), ("<=", high)]
        for op, bound in bounds:
            if bound is not None:
                out = out.where(f"{self.ts} {op} {t.wall(bound)}")
        return out

