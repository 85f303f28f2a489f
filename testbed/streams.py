"""The streaming path as registered queries: files land, streams run until all of them are read, tables come out."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge import schemas
from lapforge.plans.silver import typed_telemetry
from lapforge.session import shared_folder
from lapforge.streaming import live
from lapforge.streaming.merge import LiveTable
from testbed.bindings import ORDER, Tables

#: The generated samples spread over months and come in no order, so nothing may count as late.
DELAY = "4000 days"
LAP_SCHEMA = (
    "season int, round int, abbreviation string, lap_number long, stint long, compound string, tyre_life long, "
    "fresh_tyre boolean, lap_start_date timestamp"
)
SAMPLE_SCHEMA = "season int, round int, abbreviation string, lap_number long, date timestamp, speed double"


def folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/lapforge/{name}-{uuid.uuid4().hex}"


def as_schema(df: DataFrame, ddl: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(ddl).fields])


def landed(t: Tables) -> str:
    """Raw telemetry in three deliveries, all samples of a day in one of them."""
    path = folder(t, "landed")
    rows = as_schema(t.raw("telemetry"), schemas.TELEMETRY)
    rows.repartition(3, F.to_date("date")).write.parquet(path)
    return path


def run(writer, path: str) -> None:
    query = writer.option("checkpointLocation", f"{path}/checkpoint-{uuid.uuid4().hex}").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def cleaned(t: Tables) -> DataFrame:
    """Keys of the samples that the cleaned stream lets through."""
    out = folder(t, "cleaned")
    stream = live.clean_stream(live.telemetry_stream(t.spark, landed(t), files_per_batch=1), DELAY)
    keys = schemas.SILVER_KEYS["telemetry"]
    run(stream.select(*keys).writeStream.format("parquet").option("path", f"{out}/rows"), out)
    return t.spark.read.parquet(f"{out}/rows").select(*keys)


def windowed(t: Tables) -> DataFrame:
    """Figures per driver and six hours after the last micro-batch."""
    out, seen = folder(t, "windows"), []

    def replace(figures: DataFrame, number: int) -> None:
        figures.write.mode("overwrite").parquet(f"{out}/{number}")
        seen.append(number)

    typed = typed_telemetry(live.telemetry_stream(t.spark, landed(t), files_per_batch=2))
    figures = live.window_figures(typed, "6 hours")
    run(figures.writeStream.outputMode("complete").foreachBatch(replace), out)
    return t.spark.read.schema(figures.schema).parquet(f"{out}/{max(seen)}")


def merged(t: Tables) -> DataFrame:
    """Three batches, all of them delivered again after a checkpoint was lost, the first two already merged by then."""
    source, out = landed(t), folder(t, "live")
    schema = typed_telemetry(as_schema(t.raw("telemetry").limit(0), schemas.TELEMETRY)).schema
    table = LiveTable(t.spark, f"{out}/table", schema, schemas.SILVER_KEYS["telemetry"], ORDER["telemetry"])
    add = table.writer("pit wall")

    def deliver(upto: int) -> None:
        stream = typed_telemetry(live.telemetry_stream(t.spark, source, files_per_batch=1))
        run(stream.writeStream.foreachBatch(lambda batch, n: add(batch, n) if n <= upto else None), out)

    deliver(1)
    table.merge()
    deliver(2)
    stored = table.stored().count()  # the merged batches are still there for readers, and none twice
    pending = table.pending().select(*table.schema.names)
    keys = schemas.SILVER_KEYS["telemetry"]
    rows = table.current().select(*keys, "relative_distance", "speed")
    twice = pending.groupBy(*keys).count().where("count > 1").count()
    return rows.withColumns({"stored_rows": F.lit(stored).cast("long"), "pending_twice": F.lit(twice).cast("long")})


def with_late_laps(t: Tables) -> DataFrame:
    """Samples first, their laps a delivery later; a last row far ahead ends the session."""
    out = folder(t, "late")
    samples = as_schema(t.silver("telemetry"), SAMPLE_SCHEMA)
    started = samples.groupBy(*live.LAP).agg(F.min("date").alias("lap_start_date"))
    laps = as_schema(t.silver("laps").drop("lap_start_date").join(started, live.LAP), LAP_SCHEMA)
    end = datetime(2999, 1, 1)

    def land(df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(f"{out}/{name}")

    def deliver() -> None:
        joined = live.with_late_laps(
            t.spark.readStream.schema(SAMPLE_SCHEMA).parquet(f"{out}/samples"), live.lap_stream(t.spark, f"{out}/laps", LAP_SCHEMA), "1 day", longest=DELAY
        )
        query = (
            joined.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()

    land(samples, "samples")
    land(laps.limit(0), "laps")
    deliver()
    land(laps, "laps")
    land(t.spark.createDataFrame([(9999, 1, "end", 1, end, 0.0)], SAMPLE_SCHEMA), "samples")
    land(t.spark.createDataFrame([(9999, 2, "end", 1, 1, "", 1, True, end)], LAP_SCHEMA), "laps")
    deliver()
    return t.spark.read.schema(f"{SAMPLE_SCHEMA}, stint long, compound string, tyre_life long, fresh_tyre boolean").parquet(f"{out}/rows")
