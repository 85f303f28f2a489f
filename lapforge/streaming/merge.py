"""Micro-batches into a table of races, each batch exactly once.

A live table is three folders:

``batches/query=<q>/batch=<n>``
    The rows of a micro-batch.  A batch that is delivered again replaces its own folder, so its rows are never
    stored twice; writing it costs what the batch costs.
``base/version=<v>/season=<s>``
    The rows of races into which batches have been merged, one version per merge.
``ledger``
    One small file per merge, written last: which batches of which query the merge holds, and which races it
    rewrote.  What the ledger does not name does not exist for a reader, so a merge is there as a whole or not at all.

Batches may arrive while a merge runs: it takes the batches it has seen at its start and leaves the others alone.  A batch
that a merge holds already is ignored when it is delivered again.  A merge keeps what its predecessor read, so a
reader that began before it ends well; the merge after that removes it.

One merge may run at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.operators.ordered import keep_last

RACE = ["season", "round"]
LEDGER = "version long, query string, batch long, season int, round int"


class LiveTable:
    """Rows of ``schema`` with one row per ``keys``, the last by ``order_cols``; ``season`` and ``round`` are among the columns."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order_cols: Sequence[str] = ("ingested_at",)):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order_cols = list(keys), list(order_cols)
        for part in ("batches", "base", "ledger"):
            folder = self._hadoop(part)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)

    # --- what is stored ---------------------------------------------------------------------

    def _hadoop(self, part: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")

    def _read(self, part: str, extra: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *T.StructType.fromDDL(extra).fields])
        # files cannot hold a field that is never null
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def stored(self) -> DataFrame:
        """All batches that are still stored, with ``query`` and ``batch``."""
        return self._read("batches", "query string, batch long")

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger")

    def merged(self) -> DataFrame:
        """The last batch of each query that a merge holds."""
        return self.ledger().where("query is not null").groupBy("query").agg(F.max("batch").alias("upto"))

    def version(self) -> int:
        return self.ledger().agg(F.max("version")).first()[0] or 0

    def _base(self) -> DataFrame:
        """The merged rows: of every race the version that the ledger names last."""
        latest = self.ledger().where("season is not null").groupBy(*RACE).agg(F.max("version").alias("version"))
        return self._read("base", "version long").join(latest, [*RACE, "version"]).select(*self.schema.names)

    def pending(self) -> DataFrame:
        """Stored batches that no merge holds yet."""
        rows = self.stored().join(self.merged(), "query", "left")
        return rows.where("upto is null or batch > upto").select(*self.schema.names, "query", "batch")

    def current(self) -> DataFrame:
        """The table: merged races as they are, races with pending rows with the last row of every key."""
        new = self.pending().select(*self.schema.names)
        touched, base = new.select(*RACE).distinct(), self._base()
        open_rows = base.join(touched, RACE, "left_semi").unionByName(new)
        return base.join(touched, RACE, "left_anti").unionByName(keep_last(open_rows, self.keys, self.order_cols))

    # --- what is written --------------------------------------------------------------------

    def writer(self, query: str) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function; ``query`` names the stream and stays the same when it is started again."""

        def add(batch: DataFrame, number: int) -> None:
            done = self.merged().where(F.col("query") == query).first()
            if done and number <= done["upto"]:
                return
            rows = keep_last(batch.select(*self.schema.names), self.keys, self.order_cols)
            rows = rows.withColumns({"query": F.lit(query), "batch": F.lit(number).cast("long")})
            self._replace(rows, "batches", ["query", "batch"])

        return add

    def _replace(self, rows: DataFrame, part: str, by: list[str]) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.path}/{part}")

    def merge(self) -> None:
        """Merge the pending batches into the base; only races they touch are rewritten."""
        version, before = self.version() + 1, self.merged()
        heads = self.pending().groupBy("query").agg(F.max("batch").alias("head")).collect()  # a row per stream
        if not heads:
            return
        seen = F.lit(False)
        for h in heads:
            seen = seen | ((F.col("query") == h["query"]) & (F.col("batch") <= h["head"]))
        new = self.pending().where(seen).select(*self.schema.names)
        touched = new.select(*RACE).distinct()
        rows = keep_last(self._base().join(touched, RACE, "left_semi").unionByName(new), self.keys, self.order_cols)
        self._replace(rows.withColumn("version", F.lit(version).cast("long")).hint("rebalance", *map(F.col, RACE)), "base", ["version", "season"])

        old = [(h["query"], h["upto"]) for h in before.collect()]  # a row per stream
        races = self._read("base", "version long").where(F.col("version") == version).select(*RACE).distinct()
        races = races.select(F.lit(version).cast("long").alias("version"), F.lit(None).cast("string").alias("query"), F.lit(None).cast("long").alias("batch"), *RACE)
        streams = self.spark.createDataFrame([(version, h["query"], h["head"], None, None) for h in heads], LEDGER)
        # one file, moved into place by the commit of its job: the merge holds from here on
        races.unionByName(streams).coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        self._drop(old, version)

    def _drop(self, merged_before: list[tuple[str, int]], version: int) -> None:
        """Remove batches that the merge before this one held, and base versions that it superseded."""
        files = self._hadoop("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

        def folders(part: str, name: str):
            for entry in files.listStatus(self._hadoop(part)):
                if entry.getPath().getName().startswith(f"{name}="):
                    yield entry.getPath(), entry.getPath().getName().removeprefix(f"{name}=")

        upto = dict(merged_before)
        for place, query in folders("batches", "query"):
            for entry in files.listStatus(place):
                number = entry.getPath().getName().removeprefix("batch=")
                if query in upto and number.isdigit() and int(number) <= upto[query]:
                    files.delete(entry.getPath(), True)
        ledger = self.ledger().where(F.col("season").isNotNull() & (F.col("version") < version))
        live = {r[0] for r in ledger.groupBy(*RACE).agg(F.max("version").alias("v")).select("v").distinct().collect()}
        for place, number in folders("base", "version"):
            if int(number) < version and int(number) not in live:
                files.delete(place, True)
