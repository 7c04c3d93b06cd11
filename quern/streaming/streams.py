"""Structured Streaming forms of the polling loops: folder ingest, feedback, job states."""

from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.operators import chunks, extract
from quern.sources.files import shared_path

#: States that a job doesn't leave, and the one that a silent job gets.
TERMINAL = ("finished", "failed", "cancelled")
SILENT = "timed out"
#: Folders of the catalogue of paths; a batch reads those of its own paths only.
CATALOG_PARTS = 64
#: Parts of the jobs, by hash; a part is one key of the state, since a call a job costs far more than the job's events.
JOB_PARTS = 4096


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, on disk beside a bounded cache, not in the heap."""
    name, kind = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, kind)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of the files of a folder and those that arrive later, each read whole."""
    return spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def known_paths(spark: SparkSession, catalog: str, before: int) -> DataFrame:
    """path, part of the catalogue's entries of earlier batches; a folder that isn't there has none."""
    try:
        return spark.read.schema("path string, batch long, part int").parquet(catalog).filter(F.col("batch") < before)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, batch long, part int")


def ingest(stream: DataFrame, out: str, checkpoint: str, catalog: str | None = None, first_batch: int = 0) -> None:
    """(path, text) rows to cleaned chunks in out; a path that the catalogue knows is passed over. Runs until nothing is new.

    The stream keeps no state: what is known lies in the catalogue, a table of paths dealt to CATALOG_PARTS folders by
    hash, of which a batch reads its own paths' folders. A batch writes its chunks, then its paths; tried again, it
    overwrites both and counts as known what earlier batches wrote. first_batch: above all batches of earlier streams into
    the same catalogue, for a stream with a new checkpoint.
    """
    catalog = catalog or f"{out}-paths"

    def write(batch: DataFrame, n: int) -> None:
        spark, n = batch.sparkSession, n + first_batch
        rows = batch.filter("path is not null").groupBy("path").agg(F.max("text").alias("text")).withColumn("part", F.pmod(F.xxhash64("path"), F.lit(CATALOG_PARTS)).cast("int"))
        parts = [r["part"] for r in rows.select("part").distinct().collect()]
        known = known_paths(spark, catalog, n).filter(F.col("part").isin(parts)).select("path")
        new = rows.join(known, "path", "left_anti")
        blocks = extract.paragraph_blocks(new.select(F.col("path").alias("doc_id"), "text"), "\n")
        chunks.clean(blocks).write.mode("overwrite").parquet(f"{out}/batch={n}")
        new.select("path", "part").write.mode("overwrite").partitionBy("part").parquet(f"{catalog}/batch={n}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_feedback(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Feedback rows, stamped, to an append-only table."""
    rows = stream.withColumn("timestamp", F.current_timestamp())
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def running_means(stream: DataFrame) -> DataFrame:
    """Ratings by model, for update or complete mode."""
    return stream.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 6).alias("mean_rating"))


def state_counts(stream: DataFrame) -> DataFrame:
    return stream.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def keep_updates(updates: DataFrame, checkpoint: str, out: str) -> None:
    """An aggregation or keyed state in update mode: every batch writes its changed rows to a folder of its own; see latest.

    A batch that is tried again overwrites its folder, so a replay changes nothing.
    """

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    with rocksdb(updates.sparkSession):
        query = updates.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest(spark: SparkSession, out: str, *key: str) -> DataFrame:
    """The newest row of every key in what keep_updates wrote."""
    rows = spark.read.parquet(out)
    columns = [c for c in rows.columns if c not in (*key, "batch")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*columns), "batch").alias("_r")).select(*key, "_r.*")


def job_states(events: DataFrame, silence: str = "1 day", delay: str = "1 hour", terminal: tuple[str, ...] = TERMINAL) -> DataFrame:
    """(job, state, ts) events to (job, state, ts) changes of each job's current state, for update mode.

    A job is in its first terminal state, or else in the state of its latest event; equal times go by name. So the order
    of arrival, late and repeated events make no difference, unless they come more than delay behind the newest. A job
    without a terminal state and without an event for silence behind the newest one less delay is timed out, until it is
    heard of again. Rows without job, state or ts are passed over.
    """
    spark = events.sparkSession
    quiet = int(spark.sql(f"select unix_micros(timestamp '1970-01-01 00:00:00Z' + interval {silence})").first()[0])
    done = set(terminal)

    def later(a: tuple[str, int], b: tuple[str, int]) -> tuple[str, int]:
        """Of two events the one that tells the state."""
        if (a[0] in done) != (b[0] in done):
            return a if a[0] in done else b
        first, last = sorted((a, b), key=lambda e: (e[1], e[0]))
        return first if a[0] in done else last

    def run(key: tuple, frames, state: GroupState):
        mark = state.getCurrentWatermarkMs()
        #: Of every job of the part: state, at, silent, and when it is timed out (null: never).
        held = {job: tuple(rest) for job, *rest in zip(*state.get)} if state.exists else {}
        heard, out = {}, []
        for pdf in () if state.hasTimedOut else frames:
            for job, *event in zip(pdf["job"].tolist(), pdf["state"], pdf["at"].tolist()):
                old = heard.get(job) or held.get(job, ())[:2]
                heard[job] = later(old, tuple(event)) if old else tuple(event)
        for job, new in heard.items():
            if job not in held or (*new, False) != held[job][:3]:
                out.append((job, *new))
            held[job] = (*new, False, None if new[0] in done else max((new[1] + quiet) // 1000, mark + 1))
        for job, (name, at, _, due) in held.items():
            if due is not None and due < mark and job not in heard:
                held[job] = (name, at, True, None)
                out.append((job, SILENT, at))
        state.update(tuple(map(list, zip(*((job, *rest) for job, rest in held.items())))))
        if dues := [due for *_, due in held.values() if due is not None]:
            state.setTimeoutTimestamp(min(dues))
        if out:
            yield pd.DataFrame(out, columns=["job", "state", "at"])

    kind = events.schema["job"].dataType.simpleString()
    rows = events.filter("job is not null and state is not null and ts is not null").select("job", "state", F.col("ts").cast("timestamp").alias("ts"))
    rows = rows.withWatermark("ts", delay).withColumns({"at": F.unix_micros("ts"), "part": F.pmod(F.xxhash64("job"), F.lit(JOB_PARTS))})
    kept = f"job array<{kind}>, state array<string>, at array<long>, silent array<boolean>, due array<long>"
    states = rows.groupBy("part").applyInPandasWithState(run, f"job {kind}, state string, at long", kept, "update", GroupStateTimeout.EventTimeTimeout)
    return states.select("job", "state", F.timestamp_micros("at").alias("ts"))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table as a stream of its files; the pattern also takes a table that is a single file."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path[:-1] + "[t]")


def paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """Output and checkpoint of one run."""
    return shared_path(spark, name), shared_path(spark, name + "-state")
