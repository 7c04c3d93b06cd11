"""Queries over the catalogue of documents, chunks, questions, answers, models and runs."""

import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _contains(c: Column, part: str) -> Column:
    return F.contains(F.lower(c), F.lit(part.lower()))


def search_documents(docs: DataFrame, name: str = "", domain: str | None = None, audience: int | None = None, severity: int | None = None) -> DataFrame:
    """Case-insensitive part of the name, optional equalities; newest (largest id) first."""
    out = docs.filter(_contains(F.col("file_path"), name)) if name else docs
    for c, v in (("domain_code", domain), ("audience_id", audience), ("severity", severity)):
        out = out if v is None else out.filter(F.col(c) == v)
    return out.orderBy(F.desc("id"))


#: Folders of a name index, and the grams of a search part that are looked up (the rarest).
GRAM_PARTS, GRAMS = 256, 3


def name_grams(docs: DataFrame, name: str = "file_path", key: str = "id") -> DataFrame:
    """gram, key: the distinct trigrams of every name, in lower case."""
    low = F.lower(F.coalesce(F.col(name), F.lit("")))
    grams = F.when(F.length(low) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substring(low, i, F.lit(3)))))
    return docs.select(F.explode(grams).alias("gram"), key)


def _gram_part(gram: Column) -> Column:
    return (F.crc32(gram.cast("binary")) % GRAM_PARTS).cast("int")


def save_name_index(docs: DataFrame, path: str, name: str = "file_path", key: str = "id") -> None:
    """The posting lists of all trigrams and their lengths, in folders by the hash of the gram."""
    postings = name_grams(docs, name, key).withColumn("part", _gram_part(F.col("gram")))
    # A gram that very many names hold fills more than one task.
    spread = F.pmod(F.xxhash64(key), F.lit(8))
    postings.repartition("part", spread).sortWithinPartitions("gram", key).write.partitionBy("part").parquet(f"{path}/postings")
    sizes = postings.groupBy("part", "gram").agg(F.count(F.lit(1)).alias("n"))
    sizes.repartition("part").write.partitionBy("part").parquet(f"{path}/sizes")


def search_names(docs: DataFrame, index: str, part: str, name: str = "file_path", key: str = "id") -> DataFrame:
    """Rows whose name contains the part, in any case, by the index that save_name_index wrote of these docs.

    The rarest trigrams of the part give candidates, whose names are then looked at; parts of fewer than three characters scan.
    """
    low = part.lower()
    if len(low) < 3:
        return docs.filter(_contains(F.col(name), part)) if part else docs
    grams = sorted({low[i : i + 3] for i in range(len(low) - 2)})
    parts = sorted({zlib.crc32(g.encode()) % GRAM_PARTS for g in grams})
    of = lambda table, grams: docs.sparkSession.read.parquet(f"{index}/{table}").filter(F.col("part").isin(parts) & F.col("gram").isin(grams))
    sizes = {r["gram"]: r["n"] for r in of("sizes", grams).collect()}
    if len(sizes) < len(grams):
        return docs.limit(0)
    rare = sorted(grams, key=lambda g: (sizes[g], g))[:GRAMS]
    hits = of("postings", rare).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(rare)).select(key)
    return docs.join(hits, key, "left_semi").filter(_contains(F.col(name), part))


def page_of(docs: DataFrame, page: int, per_page: int) -> DataFrame:
    """One page, newest first, with the total and the number of pages on every row."""
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    rows = docs.orderBy(F.desc("id")).offset((page - 1) * per_page).limit(per_page)
    return rows.crossJoin(F.broadcast(total)).withColumn("total_pages", F.ceil(F.col("total") / per_page).cast("long"))


def first_by_name(docs: DataFrame, part: str) -> DataFrame:
    return docs.filter(_contains(F.col("file_path"), part)).orderBy("file_path", "id").limit(1)


def by_ids(docs: DataFrame, ids: list[int]) -> DataFrame:
    """A short list becomes an IN; a long one a semi join that Spark broadcasts while it is small."""
    if len(ids) <= 1000:
        return docs.filter(F.col("id").isin(ids))
    return docs.join(docs.sparkSession.createDataFrame([(i,) for i in ids], "id long"), "id", "left_semi")


def by_dimension(docs: DataFrame, dim: DataFrame, fk: str, code: str) -> DataFrame:
    """Rows whose dimension (id, code) has this code."""
    return docs.join(dim.filter(F.col("code") == code).select(F.col("id").alias(fk)), fk, "left_semi")


def max_severity(docs: DataFrame, levels: DataFrame, code: str) -> DataFrame:
    """Rows up to the severity of a code (code, severity); an unknown code fails."""
    limit = levels.filter(F.col("code") == code).agg(F.max("severity").alias("_limit"))
    checked = limit.select(F.coalesce("_limit", F.raise_error(F.lit(f"unknown criticality {code}")).cast("int")).alias("_limit"))
    return docs.crossJoin(F.broadcast(checked)).filter(F.col("severity") <= F.col("_limit")).drop("_limit")


def with_all_tags(docs: DataFrame, tags: DataFrame, include: list[str]) -> DataFrame:
    """Documents that have every tag of include; all documents for an empty list."""
    if not include:
        return docs
    have = tags.filter(F.col("tag").isin(include)).groupBy("document_id").agg(F.count_distinct("tag").alias("n"))
    return docs.join(have.filter(F.col("n") == len(set(include))).select(F.col("document_id").alias("id")), "id", "left_semi")


def without_tags(docs: DataFrame, tags: DataFrame, exclude: list[str]) -> DataFrame:
    return docs.join(tags.filter(F.col("tag").isin(exclude)).select(F.col("document_id").alias("id")), "id", "left_anti")


def eligibility(docs: DataFrame, tags: DataFrame, chunks: DataFrame, ranked: DataFrame) -> DataFrame:
    """id, errors: what a document lacks for a training set. chunks and ranked: (doc_id, …)."""
    n = lambda df, key, out: df.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias(out))
    j = docs.join(n(tags, "document_id", "_t"), "id", "left").join(n(chunks, "doc_id", "_c"), "id", "left").join(n(ranked, "doc_id", "_r"), "id", "left")
    lacks = [("missing tags", F.col("_t").isNull()), ("missing domain", F.col("domain_code").isNull()), ("missing audience", F.col("audience_id").isNull()),
             ("missing criticality", F.col("severity").isNull()), ("no chunks", F.col("_c").isNull()), ("no ranked answers", F.col("_r").isNull())]
    return j.select("id", F.array_compact(F.array(*(F.when(c, error) for error, c in lacks))).alias("errors"))


def require_eligible(report: DataFrame) -> DataFrame:
    """The report; a document with errors fails the query."""
    bad = F.raise_error(F.concat(F.lit("Document id="), F.col("id").cast("string"), F.lit(" invalid: "), F.array_join("errors", ", ")))
    return report.withColumn("errors", F.when(F.size("errors") > 0, bad.cast("array<string>")).otherwise(F.col("errors")))


def resolved_qna(questions: DataFrame, ranking: DataFrame, chunks: DataFrame) -> DataFrame:
    """Questions with a ranking, with their chunk's context."""
    return chunks.select("doc_id", "context").join(questions, "doc_id").join(ranking, "question_id")


def assemble_records(docs: DataFrame, tags: DataFrame, qna: DataFrame) -> DataFrame:
    """Nested training records: instruction, input, output, metadata with sorted tags and the answer's model."""
    sets = tags.groupBy(F.col("document_id").alias("id")).agg(F.array_sort(F.collect_set("tag")).alias("_tags"))
    rows = qna.join(docs.join(sets, "id", "left").withColumnRenamed("id", "doc_id"), "doc_id")
    meta = F.struct(
        F.struct("doc_id", "file_name", "domain_code", "audience_id", "severity", F.coalesce("_tags", F.array().cast("array<string>")).alias("tags")).alias("document"),
        F.struct("question_id").alias("question"), F.struct(F.col("best_model").alias("model")).alias("answer"),
    )
    return rows.select(F.col("question").alias("instruction"), F.col("context").alias("input"), F.col("best_answer").alias("output"), meta.alias("metadata"))


def build_dataset(docs, tags, levels, qna, *, ids=None, domain=None, code=None, include=(), exclude=(), report=None) -> DataFrame:
    """Selection and assembly as one lazy plan; report: drop documents with errors in it."""
    out = docs if ids is None else by_ids(docs, ids)
    out = out if domain is None else out.filter(F.col("domain_code") == domain)
    out = out if code is None else max_severity(out, levels, code)
    out = without_tags(with_all_tags(out, tags, list(include)), tags, list(exclude))
    out = out if report is None else out.join(report.filter(F.size("errors") == 0).select("id"), "id", "left_semi")
    return assemble_records(out, tags, qna)


def flat_qna(chunks: DataFrame, questions: DataFrame, answers: DataFrame, ranking: DataFrame) -> DataFrame:
    """A row for every answer, one with nulls for a question without any; is_best from the ranking."""
    rows = chunks.select("doc_id", "context").join(questions, "doc_id").join(answers.select("question_id", "model_name", "answer", "score"), "question_id", "left")
    rows = rows.join(ranking.select("question_id", "best_model"), "question_id", "left")
    return rows.withColumn("is_best", F.coalesce(F.col("model_name") == F.col("best_model"), F.lit(False))).drop("best_model")


def list_runs(runs: DataFrame, documents: DataFrame, part: str = "") -> DataFrame:
    """Runs with document name, seconds (null while running) and OK or FAIL, newest first."""
    rows = runs.join(documents, "document_id", "left")
    rows = rows.filter(_contains(F.col("name"), part)) if part else rows
    ts = lambda c: F.unix_micros(F.to_timestamp(F.col(c)))
    seconds = (ts("finished_at") - ts("started_at")) / 1e6
    return rows.select("run_id", "name", seconds.alias("seconds"), F.when(F.col("success"), "OK").otherwise("FAIL").alias("status")).orderBy(F.desc("run_id"))


def seed_if_absent(existing: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Existing rows and the seed rows whose key is new."""
    return existing.unionByName(seed.dropDuplicates([key]).join(existing.select(key), key, "left_anti"))


def upsert_models(stored: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, outcome (insert, update, skip, keep) and the fields as they are afterwards."""
    j = stored.withColumn("_s", F.lit(True)).alias("s").join(new.withColumn("_n", F.lit(True)).alias("n"), key, "full")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"s.{f}").eqNullSafe(F.col(f"n.{f}"))
    outcome = F.when(F.col("_s").isNull(), "insert").when(F.col("_n").isNull(), "keep").when(same, "skip").otherwise("update")
    return j.select(key, outcome.alias("outcome"), *[F.when(F.col("_n"), F.col(f"n.{f}")).otherwise(F.col(f"s.{f}")).alias(f) for f in fields])


def finish_run(runs: DataFrame, run_id: int, success: bool, error: str | None = None) -> DataFrame:
    """The run row closed, its error cut to 4000 characters."""
    here = F.col("run_id") == run_id
    return runs.withColumns({
        "success": F.when(here, F.lit(success)).otherwise(F.col("success")),
        "finished_at": F.when(here, F.current_timestamp()).otherwise(F.col("finished_at")),
        "error_message": F.when(here, F.left(F.lit(error), F.lit(4000))).otherwise(F.col("error_message")),
    })


def lineage(run_id: int, **outputs: DataFrame) -> DataFrame:
    """run_id, parent_type, parent_id of what the stages of a run made; outputs: name to frame with an id."""
    parts = [df.select(F.lit(run_id).cast("long").alias("run_id"), F.lit(name).alias("parent_type"), F.col("id").cast("long").alias("parent_id")) for name, df in outputs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def attach_metadata(docs: DataFrame, domain: str, audience: int, severity: int, tags: DataFrame, tag_ids: list[int]) -> DataFrame:
    """New documents with constant metadata, a row for each of the tags (id, code)."""
    out = docs.withColumns({"domain_code": F.lit(domain), "audience_id": F.lit(audience), "severity": F.lit(severity)})
    ids = F.explode(F.array(*map(F.lit, tag_ids))).alias("tag_id")
    return out.select("*", ids).join(tags.select(F.col("id").alias("tag_id"), F.col("code").alias("tag")), "tag_id").drop("tag_id")


def next_ids(df: DataFrame, natural: list[str], out: str = "id") -> DataFrame:
    """Surrogate ids that only depend on the natural key."""
    return df.withColumn(out, F.xxhash64(*natural))


def latest(df: DataFrame, key: str, by: str) -> DataFrame:
    """The newest row of every key."""
    w = Window.partitionBy(key).orderBy(F.desc(by))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
