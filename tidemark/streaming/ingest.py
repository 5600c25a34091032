"""Streaming ingest: parse, default, validate, then fan out to sinks and to a table of rejects."""

from __future__ import annotations

import json
import logging
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery, StreamingQueryListener

from tidemark.functions import cleaning as c
from tidemark.operators.staging import STREAM_DEFAULTS, default_fields, reject_reason
from tidemark.schema import PRICE_COLUMNS
from tidemark.session import settings
from tidemark.sources.files import CORRUPT, JSON_TIME, parse_records, path_exists, write_text

log = logging.getLogger(__name__)

@dataclass(frozen=True)
class Sink:
    """A named target of a micro-batch; ``write(df, batch_id)`` must give the same result when repeated."""

    name: str
    write: Callable[[DataFrame, int], None]
    enabled: bool = True


def text_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON lines files of a folder as a stream of ``value`` texts."""
    reader: DataStreamReader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


RECORD_KEY = ["_key", "_key2"]


def prepare(texts: DataFrame) -> DataFrame:
    """Typed records with defaults, and ``reject_reason`` where a record is refused.

    Works on streams and on tables with a ``value`` column. A record without a time gets the time of
    ingest; one that is no JSON is refused as corrupt. The two hashes in RECORD_KEY are of the record as it was
    sent, before any default.
    """
    parsed = parse_records(texts.select(F.col("value").cast("string").alias("value")))
    known = [F.col(x) for x in PRICE_COLUMNS]
    keyed = (
        parsed.withColumn("_key", F.xxhash64(*known, *[x.isNull() for x in known]))
        .withColumn("_key2", F.xxhash64(F.lit("second"), *[x.isNull() for x in known], *known))
    )
    no_number = F.col("price").isNull() & F.get_json_object("value", "$.price").isNotNull()
    timed = keyed.withColumn("scraped_at", F.when(F.col(CORRUPT).isNull(), c.default_event_time("scraped_at")))
    filled = default_fields(timed, STREAM_DEFAULTS)
    reason = F.coalesce(
        F.when(F.col(CORRUPT).isNotNull(), "corrupt record"), F.when(no_number, "price not numeric"), reject_reason(filled)
    )
    return filled.withColumn("reject_reason", reason).drop(CORRUPT)


def valid_records(prepared: DataFrame) -> DataFrame:
    """Accepted records with the key of what was sent; replays are dropped when a batch is written."""
    return prepared.where(F.col("reject_reason").isNull()).select(*PRICE_COLUMNS, "pipeline", *RECORD_KEY)


def first_of_each(valid: DataFrame) -> DataFrame:
    """Each record once, however late its replays come. On a stream the keys are state (see STATE)."""
    return valid.dropDuplicates(RECORD_KEY)


#: The keys of all records live in RocksDB on the executors' disks, dealt over the partitions the stream began
#: with (see ``state_settings``); a batch looks up and adds its own keys, and its checkpoint is the change it made. Nothing of earlier batches is
#: listed or read again, but by a task that takes over a partition from a lost executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
COUNTERS = "batch long, received long, written long"


def state_settings(spark: SparkSession) -> dict[str, str]:
    """STATE, and two partitions for each core: a batch opens, commits and writes files of every partition, so idle ones cost."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {**STATE, "spark.sql.shuffle.partitions": str(min(most, max(16, 2 * spark.sparkContext.defaultParallelism)))}


def rejected_records(prepared: DataFrame) -> DataFrame:
    # Records are parsed once: without the count in between, the filter is moved below the parsing and repeats it for each rule.
    counted = prepared.observe("refused", F.count_if(F.col("reject_reason").isNotNull()).alias("n"))
    return counted.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def observed(prepared: DataFrame, name: str = "ingest") -> DataFrame:
    """Count accepted and refused records while they pass."""
    ok = F.col("reject_reason").isNull()
    return prepared.observe(name, F.count_if(ok).alias("ingested"), F.count_if(~ok).alias("errors"))


@dataclass
class IngestCounters(StreamingQueryListener):
    """Totals over all finished micro-batches; register with ``spark.streams.addListener``."""

    name: str = "ingest"
    ingested: int = 0
    errors: int = 0
    started: float = field(default_factory=time.time)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.ingested += row["ingested"]
            self.errors += row["errors"]

    @property
    def rate(self) -> float:
        return round(self.ingested / max(int(time.time() - self.started), 1), 2)


def fan_out(sinks: list[Sink], failed: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: every enabled sink gets the batch; the others go on when one fails.

    With ``failed``, a folder, the batch of a failed sink is written there for ``retry_failed``; if that fails
    too, the stream stops, so that nothing is lost. Without it a failure is only logged.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                if not sink.enabled:
                    continue
                try:
                    sink.write(kept, batch_id)
                except Exception as err:  # noqa: BLE001 - any sink may fail in its own way
                    log.warning("sink %s failed for batch %s: %s", sink.name, batch_id, err)
                    if failed:
                        kept.write.mode("overwrite").parquet(f"{failed}/{sink.name}/batch={batch_id}")
        finally:
            kept.unpersist()

    return run


def retry_failed(spark: SparkSession, sink: Sink, failed: str) -> list[int]:
    """Deliver again what a sink has missed, batch by batch, and return the numbers of the batches delivered.

    A delivered batch is replaced by an empty one. A batch that fails again raises and stays.
    """
    folder = f"{failed}/{sink.name}"
    if not path_exists(spark, folder):
        return []
    missed = spark.read.parquet(folder)
    numbers = sorted(r[0] for r in missed.select("batch").distinct().collect())
    for number in numbers:
        batch = spark.read.parquet(f"{folder}/batch={number}")
        sink.write(batch, number)
        spark.createDataFrame([], batch.schema).write.mode("overwrite").parquet(f"{folder}/batch={number}")
    return numbers


def folder_sink(name: str, path: str, fmt: str = "parquet", enabled: bool = True) -> Sink:
    """Files in one sub-folder per batch, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    return Sink(name, write, enabled)


def start(df: DataFrame, sinks: list[Sink], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    return start_batches(df, fan_out(sinks, f"{checkpoint}/failed"), checkpoint, available_now)


def start_batches(
    df: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True, name: str | None = None
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if available_now else writer).start()


class CounterLog(StreamingQueryListener):
    """Writes what was received and written in each finished batch of one query: a small file a batch, replaced if repeated."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder, name
        self.ended, self.query_id = threading.Event(), ""

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.query_id = str(event.id)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics if event.progress.name == self.name else {}
        if "received" in seen:
            counts = {"batch": event.progress.batchId, "received": seen["received"]["n"], "written": seen["written"]["n"]}
            write_text(self.spark, f"{self.folder}/batch-{counts['batch']}.json", json.dumps(counts))

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.ended.set()


def start_valid(valid: DataFrame, sinks: list[Sink], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Deliver accepted records to the sinks, each record once, and keep counters of what was received and written.

    A batch that is run again starts from the state before it, so it gives the same rows. ``wait`` ends when the
    counters of the last batch are written; those of a batch whose driver died right after it are missing.
    """
    spark, name = valid.sparkSession, f"ingest-{uuid.uuid4().hex}"
    received = valid.observe("received", F.count(F.lit(1)).alias("n"))
    once = first_of_each(received).observe("written", F.count(F.lit(1)).alias("n")).drop(*RECORD_KEY)
    log = CounterLog(spark, f"{checkpoint}/counters", name)
    spark.streams.addListener(log)
    with settings(spark, state_settings(spark)):
        query = start_batches(once, fan_out(sinks, f"{checkpoint}/failed"), checkpoint, available_now, name)
    query.counter_log = log
    return query


def wait(*queries: StreamingQuery, seconds: float = 60) -> None:
    """Until the queries have ended, and the counters of those that keep some are written."""
    for query in queries:
        query.awaitTermination()
        log_of = getattr(query, "counter_log", None)
        if log_of is not None:
            log_of.ended.wait(seconds)
            log_of.spark.streams.removeListener(log_of)


def start_limited(df: DataFrame, sink: Sink, checkpoint: str, limit: int) -> StreamingQuery:
    """Deliver the first ``limit`` records of a stream in all, over any number of batches and restarts; then it stops.

    The limit belongs to the checkpoint: what its batches held beyond it is not delivered later.
    How many a batch has delivered is a small file of it below the checkpoint. A batch that is run again counts what the
    batches before it delivered, so it delivers as many as the first time, and its folder is replaced.
    """
    spark, folder, reached = df.sparkSession, f"{checkpoint}/taken", threading.Event()

    def run(batch: DataFrame, batch_id: int) -> None:
        before = 0
        if path_exists(spark, folder):
            earlier = spark.read.schema("batch long, n long").json(folder).where(F.col("batch") < batch_id)
            before = earlier.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        n = 0
        if before < limit:
            part = batch.limit(limit - before).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                n = part.count()
                sink.write(part, batch_id)
            finally:
                part.unpersist()
        write_text(spark, f"{folder}/batch-{batch_id}.json", json.dumps({"batch": batch_id, "n": n}))
        if before + n >= limit:
            reached.set()

    query = start_batches(df, run, checkpoint)

    def stop() -> None:
        # Later batches deliver nothing; stopping spares reading them.
        while query.isActive and not reached.wait(0.2):
            pass
        if query.isActive:
            query.stop()

    threading.Thread(target=stop, daemon=True).start()
    return query


def read_counters(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Totals of all batches of ``start_valid``: received = written + replays."""
    folder = f"{checkpoint}/counters"
    rows = spark.read.schema(COUNTERS).json(folder) if path_exists(spark, folder) else spark.createDataFrame([], COUNTERS)
    counted = rows.withColumn("replays", F.col("received") - F.col("written"))
    return counted.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("received", "written", "replays")])


def ingest_stream(texts: DataFrame, sinks: list[Sink], rejects: Sink, checkpoint: str) -> list[StreamingQuery]:
    """One query for accepted records and one for rejects; both read all the source holds.

    Every record that is read is written, refused with a reason, or a replay of a written one.
    """
    prepared = prepare(texts)
    return [
        start_valid(valid_records(observed(prepared)), sinks, f"{checkpoint}/valid"),
        start(rejected_records(prepared), [rejects], f"{checkpoint}/rejects"),
    ]


def stream_to_jsonl(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to JSON lines files, each record exactly once."""
    return (
        df.writeStream.format("json")
        .options(**JSON_TIME)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(folder)
    )
