"""Streams over real folders: late, repeated and silent jobs, restarts, replays, known paths."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quern.streaming import streams as ST

START = datetime(2024, 5, 1)
SCHEMA = "job string, state string, ts timestamp, event int"


def at(minutes):
    return START + timedelta(minutes=minutes)


def send(spark, folder, *events):
    spark.createDataFrame([(j, s, at(m), 1) for j, s, m in events], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, tmp_path, delay="10 minutes"):
    """All that is new in the folder, and the states after it: job to (state, minutes)."""
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    ST.keep_updates(ST.job_states(stream, "60 minutes", delay), str(tmp_path / "state"), str(tmp_path / "out"))
    return {r.job: (r.state, (r.ts - START).total_seconds() / 60) for r in ST.latest(spark, str(tmp_path / "out"), "job").collect()}


def test_jobs_over_restarts(spark, tmp_path):
    send(spark, tmp_path / "in", ("a", "queued", 0), ("a", "running", 5), ("b", "running", 3), ("b", "finished", 30), ("c", "queued", 1), ("a", "running", 5))
    assert run(spark, tmp_path) == {"a": ("running", 5), "b": ("finished", 30), "c": ("queued", 1)}
    # Late within the delay, repeated, and after the end: nothing that tells less than what is known changes a state.
    send(spark, tmp_path / "in", ("a", "queued", 21), ("a", "queued", 21), ("b", "running", 40), ("c", "queued", 22), ("d", "failed", 50), ("d", "running", 51))
    assert run(spark, tmp_path) == {"a": ("queued", 21), "b": ("finished", 30), "c": ("queued", 22), "d": ("failed", 50)}
    # Far ahead: silent jobs are timed out, ended ones are not.
    send(spark, tmp_path / "in", ("e", "running", 200))
    assert run(spark, tmp_path) == {"a": (ST.SILENT, 21), "b": ("finished", 30), "c": (ST.SILENT, 22), "d": ("failed", 50), "e": ("running", 200)}
    # Heard of again, and too late to count.
    send(spark, tmp_path / "in", ("a", "running", 205), ("c", "cancelled", 23))
    assert run(spark, tmp_path) == {"a": ("running", 205), "b": ("finished", 30), "c": (ST.SILENT, 22), "d": ("failed", 50), "e": ("running", 200)}


def test_order_of_arrival_makes_no_difference(spark, tmp_path):
    rng = random.Random(6)
    events = [(f"j{rng.randrange(30)}", rng.choice(["queued", "running", "running", "finished", "failed"]), rng.randrange(50)) for _ in range(120)]
    want = {}
    for job in {e[0] for e in events}:
        own = sorted((m, s) for j, s, m in events if j == job)
        ends = [e for e in own if e[1] in ST.TERMINAL]
        want[job] = (ends[0] if ends else own[-1])[::-1]
    for turn in range(2):
        rng.shuffle(events)
        for i in range(0, 120, 60):
            send(spark, tmp_path / str(turn) / "in", *events[i : i + 60])
            got = run(spark, tmp_path / str(turn), "60 minutes")
        assert got == want


def test_files_are_taken_once(spark, tmp_path):
    """Real files; a second stream with a checkpoint of its own; a catalogue entry of another loader."""
    folder, out, catalog = tmp_path / "docs", str(tmp_path / "out"), str(tmp_path / "paths")
    line = "A line that is long enough to stay in the table of chunks."
    (folder / "sub").mkdir(parents=True)
    for n in range(3):
        (folder / "sub" / f"{n}.txt").write_text(f"{line} {n}\nAnother line that is long enough to stay here. {n}")
    ST.ingest(ST.text_files(spark, str(folder)), out, str(tmp_path / "s1"), catalog)
    known = spark.read.parquet(catalog).filter("path like '%/0.txt'").first().path.replace("/sub/0.txt", "/known.txt")
    spark.createDataFrame([(known,)], "path string").withColumn("part", F.pmod(F.xxhash64("path"), F.lit(ST.CATALOG_PARTS)).cast("int")).write.partitionBy("part").parquet(f"{catalog}/batch=50")
    (folder / "known.txt").write_text(line)
    (folder / "new.txt").write_text(line)
    ST.ingest(ST.text_files(spark, str(folder)), out, str(tmp_path / "s2"), catalog, first_batch=100)
    got = sorted(r.doc_id.rpartition("/")[2] for r in spark.read.parquet(out).collect())
    assert got == ["0.txt", "0.txt", "1.txt", "1.txt", "2.txt", "2.txt", "new.txt"]
    assert spark.read.parquet(catalog).count() == 5


def test_replayed_batches_change_nothing(spark, tmp_path):
    """The last batch is run again, as after a crash between the sink and the commit."""
    source, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    frame = lambda rows: spark.createDataFrame(rows, "model_name string, rating int")
    means = lambda: ST.keep_updates(ST.running_means(spark.readStream.schema("model_name string, rating int").parquet(str(source))), str(state), out)
    read = lambda: {r.model_name: (r.n, r.mean_rating) for r in ST.latest(spark, out, "model_name").collect()}
    frame([("a", 1), ("a", 4), ("b", 2)]).write.mode("append").parquet(str(source))
    means()
    frame([("a", 4), ("c", 5)]).write.mode("append").parquet(str(source))
    means()
    want = {"a": (3, 3.0), "b": (1, 2.0), "c": (1, 5.0)}
    assert read() == want
    last = max(int(p.name) for p in (state / "commits").iterdir() if p.name.isdigit())
    for p in (state / "commits").iterdir():
        if p.name in (str(last), f".{last}.crc"):
            p.unlink()
    means()
    assert read() == want


def test_jobs_that_share_a_part(spark, tmp_path, monkeypatch):
    """All jobs in one key of the state: a part with news also times out its silent jobs, and one without news does."""
    monkeypatch.setattr(ST, "JOB_PARTS", 1)
    test_jobs_over_restarts(spark, tmp_path)
    assert spark.read.format("statestore").load(str(tmp_path / "state")).count() == 1
