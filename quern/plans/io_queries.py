"""Queries and SQL of sources and streams."""

from pyspark.sql import functions as F

from quern.operators import extract as X
from quern.sources import files as S
from quern.sources.report_files import save_reports
from quern.streaming import streams as ST

from .views import duck, table, view


def _paths(s, d):
    ext = F.element_at(F.array(*map(F.lit, [".txt", ".PDF", ".bin", ".exe", ".log"])), (F.col("doc_id") % 5 + 1).cast("int"))
    folder = F.when(F.col("doc_id") % 11 == 0, "/my.cache/").when(F.col("doc_id") % 13 == 0, "/x/venv_").otherwise("/docs/")
    return table(s, d, "documents").select(F.concat(folder, F.col("doc_id").cast("string"), ext).alias("path"), (F.col("n_chars") * F.when(F.col("doc_id") % 7 == 0, 100000).otherwise(1)).alias("length"))


def _structures(s, d):
    docs = X.assemble_documents(view(s, d, "v_blocks"), view(s, d, "v_blocks").limit(0).select("doc_id", "page", F.col("ord").alias("image_index")))
    chunk = lambda c: F.struct(c["page"].alias("page"), F.lit(None).cast("int").alias("page_number"), c["chunk_type"].alias("chunk_type"), c["text"].alias("text"), F.lit(None).cast("string").alias("markdown"))
    text = F.to_json(F.struct(F.col("doc_id").cast("string").alias("source_path"), F.lit("txt").alias("doc_type"), "total_pages", F.transform("chunks", chunk).alias("chunks")))
    return docs.select(F.from_json(text, S.STRUCTURE).alias("r")).select("r.*")


def s1_walk(spark, sf_dir):
    """Documents as files in folders by source, some of which a walk passes over, listed again with their sizes."""
    root = S.shared_path(spark, "tree")
    rows = table(spark, sf_dir, "documents").filter("length(text) > 0").select("doc_id", F.col("text").alias("report"), F.col("lang").alias("lang"))
    save_reports(rows.filter("lang <> 'en'"), f"{root}/docs/other")
    save_reports(rows.filter("lang = 'en'"), f"{root}/docs/en-venv")
    found = S.allowed_files(S.walk(spark, root))
    return found.select(F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("long").alias("doc_id"), "length")


def st1_ingest(spark, sf_dir):
    """Every document comes twice in one stream and again in a second one; a path is taken once."""
    docs = ST.table_stream(spark, sf_dir, "documents").select(F.explode(F.array(F.lit(0), F.lit(1))).alias("again"), F.col("doc_id").cast("string").alias("path"), "text")
    out, state = ST.paths(spark, "ingest")
    ST.ingest(docs.drop("again"), out, state)
    ST.ingest(docs.drop("again"), out, state + "-2", first_batch=1_000_000)
    return spark.read.parquet(out).select(F.col("doc_id").cast("long").alias("doc_id"), "ord", "chunk_id", "context_tokens")


def st2_feedback(spark, sf_dir):
    """Means that are kept up to date while the feedback comes in."""
    rows = ST.table_stream(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("model_name"), (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 5 + 1).alias("rating"))
    out, state = ST.paths(spark, "feedback")
    ST.keep_updates(ST.running_means(rows), state, out)
    return ST.latest(spark, out, "model_name")


def st2_feedback_log(spark, sf_dir):
    """Feedback appended to a table as it comes in, then averaged."""
    rows = ST.table_stream(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("model_name"), (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 5 + 1).alias("rating"))
    out, state = ST.paths(spark, "feedback")
    ST.append_feedback(rows, out, state)
    return ST.running_means(spark.read.parquet(out))


def st3_state_counts(spark, sf_dir):
    """Events by type, counted in update mode."""
    out, state = ST.paths(spark, "states")
    ST.keep_updates(ST.state_counts(ST.table_stream(spark, sf_dir, "events").select(F.col("event_type").alias("state"))), state, out)
    return ST.latest(spark, out, "state")


def st3_job_states(spark, sf_dir):
    """Jobs (a user's day) by their current state; a purchase ends one, and twelve silent hours time it out."""
    events = ST.table_stream(spark, sf_dir, "events").select((F.col("user_id") * 100 + F.dayofmonth("ts")).alias("job"), F.col("event_type").alias("state"), "ts")
    out, state = ST.paths(spark, "jobs")
    ST.keep_updates(ST.job_states(events, "12 hours", "2 days", ("purchase",)), state, out)
    return ST.state_counts(ST.latest(spark, out, "job"))


def s6_write_jsonl(spark, sf_dir):
    """Written, then read as text, so that the lines themselves are the result."""
    path = S.shared_path(spark, "jsonl")
    S.write_jsonl(view(spark, sf_dir, "v_sft").select("conv_id", "turn", F.lit(None).cast("string").alias("note")), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def s5_jsonl_files(spark, sf_dir):
    """Training rows as a file for each of four shards, every tenth line blank and every thirteenth cut off; read with their numbers."""
    path = S.shared_path(spark, "lines")
    whole = F.to_json(F.struct("prompt", "response"))
    line = F.when(F.col("turn") % 10 == 4, " ").when(F.col("conv_id") % 13 == 0, F.left(whole, F.lit(30))).otherwise(whole)
    rows = view(spark, sf_dir, "v_sft").withColumn("shard", F.col("conv_id") % 4)
    rows.repartition("shard").sortWithinPartitions("shard", "conv_id", "turn").select("shard", line.alias("value")).write.partitionBy("shard").text(path)
    read = S.read_jsonl(spark, f"{path}/*/*", "prompt string, response string", quarantine=True)
    return read.select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("int").alias("shard"), "line_no", "prompt", "response", "bad_line")


def s9_feedback_log(spark, sf_dir):
    """Two appends to one log, read back; all rows are stamped."""
    path = S.shared_path(spark, "feedback")
    rows = view(spark, sf_dir, "v_feedback").select("model_name", "version", F.lit("p").alias("prompt"), F.lit(None).cast("string").alias("comment"), "rating", "latency", "input_tokens", "output_tokens")
    S.append_feedback(rows, path)
    S.append_feedback(rows.withColumn("comment", F.lit("again é")), path)
    return S.read_log(spark, path, S.FEEDBACK).select(F.col("timestamp").isNotNull().alias("stamped"), "model_name", "version", "prompt", "response", "comment", "rating", "latency", "input_tokens", "output_tokens")


def s10_metrics_log(spark, sf_dir):
    path = S.shared_path(spark, "metrics")
    rows = view(spark, sf_dir, "v_metrics").select(F.col("run_id").cast("double").alias("ts"), F.lit(1).alias("epoch"), "step", F.col("value").alias("loss"), F.lit(0.5).alias("lr"), "metric")
    S.append_metrics(rows, path)
    return S.read_log(spark, path, S.METRICS)


def s11_store(spark, sf_dir):
    """Saved as a table of the store, appended to, loaded."""
    target = S.shared_path(spark, "store")
    S.save_table(view(spark, sf_dir, "v_documents"), target)
    S.save_table(view(spark, sf_dir, "v_documents").withColumn("id", -F.col("id")), target)
    return S.load_table(spark, target)


QUERIES = {
    "s1_allowed_files": lambda s, d: S.allowed_files(_paths(s, d)),
    "s1_walk": s1_walk,
    "s2_new_files": lambda s, d: S.new_files(view(s, d, "v_documents").select("file_path").unionByName(view(s, d, "v_documents").select("file_path")), view(s, d, "v_documents").join(table(s, d, "labels").select(F.col("doc_id").alias("id")), "id")),
    "s3_normalize_path": lambda s, d: view(s, d, "v_documents").select("id", S.normalize_path(F.when(F.col("id") % 2 == 0, F.concat(F.lit("D:\\"), F.replace("file_path", F.lit("/"), F.lit("\\")))).otherwise(F.col("file_path"))).alias("path")),
    "s4_explode_structures": lambda s, d: S.explode_structures(_structures(s, d)).select(F.col("source_path").cast("long").alias("doc_id"), "ord", "page", "chunk_type", "text"),
    "s5_parse_jsonl": lambda s, d: S.parse_jsonl(view(s, d, "v_sft").select((F.col("conv_id") * 10 + F.col("turn")).alias("line_no"), F.when(F.col("conv_id") % 5 == 0, " ").otherwise(F.to_json(F.struct("prompt", "response"))).alias("value")), "prompt string, response string"),
    "s5_jsonl_files": s5_jsonl_files,
    "s6_write_jsonl": s6_write_jsonl,
    "s9_feedback_log": s9_feedback_log,
    "s10_metrics_log": s10_metrics_log,
    "s11_store": s11_store,
    "s12_inventory": lambda s, d: S.inventory(_paths(s, d)),
    "st1_ingest": st1_ingest,
    "st2_feedback": st2_feedback,
    "st2_feedback_log": st2_feedback_log,
    "st3_state_counts": st3_state_counts,
    "st3_job_states": st3_job_states,
}
PATHS = "with f as (select case when doc_id % 11 = 0 then '/my.cache/' when doc_id % 13 = 0 then '/x/venv_' else '/docs/' end || doc_id || ['.txt', '.PDF', '.bin', '.exe', '.log'][doc_id % 5 + 1] as path, doc_id, n_chars * case when doc_id % 7 = 0 then 100000 else 1 end as length from documents)"
SQL = {
    "s1_allowed_files": PATHS + " select path, length from f where doc_id % 5 in (0, 1)",
    "s1_walk": "select doc_id, strlen(text) as length from documents where lang <> 'en' and length(text) > 0",
    "s2_new_files": "select distinct file_path from v_documents where file_path not in (select file_path from v_documents join labels on doc_id = id)",
    "s3_normalize_path": "select id, case when id % 2 = 0 then '/mnt/d/' || file_path else file_path end as path from v_documents",
    "s4_explode_structures": "select doc_id, ord, page, chunk_type, text from v_blocks",
    "s5_parse_jsonl": "select conv_id * 10 + turn as line_no, prompt, response from v_sft where conv_id % 5 <> 0",
    "s5_jsonl_files": """with r as (select cast(conv_id % 4 as int) as shard, row_number() over (partition by conv_id % 4 order by conv_id, turn) as line_no, conv_id, turn, prompt, response,
        left('{"prompt":' || cast(to_json(prompt) as varchar) || ',"response":' || cast(to_json(response) as varchar) || '}', 30) as cut from v_sft)
        select shard, line_no, case when conv_id % 13 <> 0 then prompt end as prompt, case when conv_id % 13 <> 0 then response end as response, case when conv_id % 13 = 0 then cut end as bad_line from r where turn % 10 <> 4""",
    "s6_write_jsonl": """select '{"conv_id":' || conv_id || ',"turn":' || turn || ',"note":null}' as line from v_sft""",
    "s9_feedback_log": "select true as stamped, model_name, version, 'p' as prompt, null as response, unnest([null, 'again é']) as comment, rating, latency, input_tokens, output_tokens from v_feedback",
    "s10_metrics_log": "select cast(run_id as double) as ts, 1 as epoch, step, value as loss, 0.5::double as lr from v_metrics",
    "s11_store": "select * from v_documents union all select -id, file_name, file_path, domain_code, audience_id, severity from v_documents",
    "st1_ingest": "with b as (select doc_id, ord, S(text) as text from v_blocks where length(S(text)) > 5), d as (select * from b qualify row_number() over (partition by doc_id, text order by ord) = 1) select doc_id, ord, 'p1_c' || row_number() over (partition by doc_id order by ord) as chunk_id, cast(len(W(text)) as int) as context_tokens from d where length(text) >= 40",
    "s12_inventory": PATHS + " select case when doc_id % 11 <> 0 and doc_id % 13 = 0 then 'COMMON_IGNORE' when doc_id % 5 in (2, 4) then 'MODEL_OR_BINARY' when length > 50 * 1024 * 1024 then 'LARGE_FILE' else 'OK' end as flag, count(*) as n, cast(sum(length) as bigint) as bytes from f where doc_id % 11 <> 0 group by 1",
    "st2_feedback": "select model_name, count(*) as n, round(avg(rating), 6) as mean_rating from v_feedback group by model_name",
    "st2_feedback_log": "select model_name, count(*) as n, round(avg(rating), 6) as mean_rating from v_feedback group by model_name",
    "st3_job_states": """with j as (select user_id * 100 + day(ts) as job, coalesce(min_by(event_type, (ts, event_type)) filter (where event_type = 'purchase'), max_by(event_type, (ts, event_type))) as state, max(ts) as last from events group by 1)
        select case when state <> 'purchase' and last < (select max(ts) from events) - interval 60 hours then 'timed out' else state end as state, count(*) as n from j group by 1""",
    "st3_state_counts": "select event_type as state, count(*) as n from events group by 1",
}
ORACLE_SQL = {k: duck(v) for k, v in SQL.items()}
