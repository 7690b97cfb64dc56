"""Published tables: keyed upsert (SNK5) and replace by predicate (SNK6), each one commit.

A table is a folder of Parquet files by partition value (a month) and a numbered
list of the live folders. A write makes new folders for the partitions it
touches, from their rows and the incoming ones, and then publishes the next
list by one rename. Readers take the newest list, so they see all of a write or
nothing of it; folders of a write that failed are in no list. Partitions that a
write doesn't change keep their files. A second writer that lost the race for a
number gets an error and can start anew from the new state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Partition values one write may touch; a table has one a month, so more are a mistake.
MAX_TOUCHED = 10_000
PART = "_part"


@dataclass(frozen=True)
class Version:
    """One published state: its number, the schema, the live folder of each partition value."""

    number: int
    schema: T.StructType | None
    folders: dict[str, str]


class PublishedTable:
    """Table of rows told apart by ``key`` within a value of ``partition``."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], partition: str = "month"):
        self.spark, self.root, self.key, self.partition = spark, root.rstrip("/"), list(key), partition

    # ---- versions --------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> Version:
        """The newest published state; number 0 before the first write."""
        fs, folder = self._fs(), self._path("versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return Version(0, None, {})
        text = self.spark.read.text(f"{self.root}/versions/{max(numbers):012d}.json", wholetext=True).first()[0]
        said = json.loads(text)
        return Version(max(numbers), T.StructType.fromJson(said["schema"]), said["folders"])

    def _publish(self, base: Version, schema: T.StructType, folders: dict[str, str]) -> Version:
        """Make ``folders`` the state after ``base``, or fail if another writer was first."""
        jvm = self.spark._jvm
        fs, waiting, final = self._fs(), self._path(f"versions/{uuid.uuid4().hex}.new"), self._path(f"versions/{base.number + 1:012d}.json")
        out = fs.create(waiting, True)
        out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "folders": folders}).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(waiting, final, options)  # fails where the name is taken
        except Exception as e:
            raise RuntimeError(f"version {base.number + 1} of {self.root} was published by another writer") from e
        return Version(base.number + 1, schema, folders)

    # ---- reading ---------------------------------------------------------------

    def _rows(self, v: Version, parts: Sequence[str] | None = None) -> DataFrame:
        folders = [f for p, f in sorted(v.folders.items()) if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], v.schema)
        return self.spark.read.schema(v.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, parts: Sequence[str] | None = None, version: Version | None = None) -> DataFrame:
        """Rows of the newest state, of some partition values only if named (other folders aren't listed)."""
        v = version or self.version()
        if v.schema is None:
            raise ValueError(f"{self.root} has no published version")
        return self._rows(v, parts)

    # ---- writing ---------------------------------------------------------------

    def _part(self):
        return F.coalesce(F.col(self.partition).cast("string"), F.lit("none"))

    def _values(self, df: DataFrame) -> list[str]:
        """Partition values of ``df``; they are months, so there are few."""
        got = [r[0] for r in df.select(self._part().alias(PART)).distinct().limit(MAX_TOUCHED + 1).collect()]
        if len(got) > MAX_TOUCHED:
            raise ValueError(f"a write to {self.root} touches more than {MAX_TOUCHED} values of {self.partition}")
        return got

    def _conform(self, v: Version, incoming: DataFrame) -> tuple[T.StructType, DataFrame]:
        """The table's columns, then new ones; missing columns of ``incoming`` are null."""
        fields = list(v.schema.fields) if v.schema else []
        known = {f.name for f in fields}
        fields += [f for f in incoming.schema.fields if f.name not in known]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        own = set(incoming.columns)
        return schema, incoming.select(*[(F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    def _write(self, v: Version, schema: T.StructType, rows: DataFrame, touched: Sequence[str]) -> Version:
        """New folders for the touched partitions, then the next version."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.withColumn(PART, self._part()).repartition(PART, *self.key).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        fs, jpath = self._fs(), self._path(folder)
        made = {}
        for s in fs.listStatus(jpath):
            name = s.getPath().getName()
            if name.startswith(f"{PART}="):
                made[self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name.removeprefix(f"{PART}="))] = f"{folder}/{name}"
        folders = {p: f for p, f in v.folders.items() if p not in set(touched)} | made
        return self._publish(v, schema, folders)

    def upsert(self, incoming: DataFrame, order: Sequence[str] = ()) -> Version:
        """SNK5: rows replace those of the same partition value and key, others are added.

        Of incoming rows that share both, the greatest by ``order``, then by its
        JSON text, counts. Only partitions in which a row changes are written;
        if none does, the version stays. A null key is a value like others.
        """
        v = self.version()
        schema, new = self._conform(v, incoming)
        text = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]), {"ignoreNullFields": "false"})
        on = [self.partition, *self.key]
        best = Window.partitionBy(*on).orderBy(*[F.col(c).desc() for c in order], F.col("_text").desc())
        new = new.withColumn("_text", text).withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")
        reached = self._values(new)
        if not reached:
            return v if v.number else self._publish(v, schema, {})
        at = Version(v.number, schema, v.folders)
        old = self._rows(at, reached)
        same = old.withColumn("_text", text)
        equal = lambda a, b, cols: [a[c].eqNullSafe(b[c]) for c in cols]
        changed = new.join(same, equal(new, same, [*on, "_text"]), "left_anti")
        touched = self._values(changed)
        if not touched:
            return v
        now = new.drop("_text").where(self._part().isin(touched))
        old = self._rows(at, touched)
        rows = old.join(now, equal(old, now, on), "left_anti").unionByName(now)
        return self._write(v, schema, rows, touched)

    def replace(self, incoming: DataFrame, by: Sequence[str]) -> Version:
        """SNK6: every row, of any partition, that agrees with an incoming one in
        ``by`` goes, and the incoming rows come, in one commit."""
        v = self.version()
        schema, new = self._conform(v, incoming)
        gone = new.select(*by).distinct()
        at = Version(v.number, schema, v.folders)
        old = self._rows(at)
        equal = [old[c].eqNullSafe(gone[c]) for c in by]
        touched = sorted({*self._values(new), *self._values(old.join(gone, equal, "left_semi"))})
        if not touched:
            return v if v.number else self._publish(v, schema, {})
        old = self._rows(at, touched)
        rows = old.join(gone, [old[c].eqNullSafe(gone[c]) for c in by], "left_anti").unionByName(new)
        return self._write(v, schema, rows, touched)
