"""Folders, JSON and JSONL, append logs, and the relational store."""

import functools
import os
import tempfile
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

import pandas as pd
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.extract import suffix

#: Suffixes that a folder scan takes by default, and what an inventory flags; fixed values.
ALLOWED = [".pdf", ".doc", ".docx", ".pptx", ".txt", ".md", ".xlsx", ".xls", ".csv"]
IGNORED = ["__pycache__", ".venv", "venv", ".cache", ".pytest_cache", ".idea", ".vscode", "node_modules", ".ipynb_checkpoints"]
BINARY = [".safetensors", ".pt", ".bin", ".ckpt", ".log", ".sqlite", ".db"]
PRUNED = ["venv", "lib64", ".cache"]
LARGE = 50 * 1024 * 1024

CHUNK = T.StructType([T.StructField("page", T.IntegerType()), T.StructField("page_number", T.IntegerType()), T.StructField("chunk_type", T.StringType()), T.StructField("text", T.StringType()), T.StructField("markdown", T.StringType())])
STRUCTURE = T.StructType([T.StructField("source_path", T.StringType()), T.StructField("doc_type", T.StringType()), T.StructField("total_pages", T.IntegerType()), T.StructField("chunks", T.ArrayType(CHUNK))])
FEEDBACK = "timestamp timestamp, model_name string, version int, prompt string, response string, rating int, comment string, latency double, input_tokens int, output_tokens int"
METRICS = "ts double, epoch int, step int, loss double, lr double"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only on a local master where none is set."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quern-"))
    return sc._jsc.sc().getCheckpointDir().get()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder, so that a later step doesn't go back behind them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path, length, modificationTime of all files below root; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")


def list_folders(paths: list[str], pruned: list[str] = PRUNED):
    """(path, folder, length, modificationTime) of what folders hold; a folder whose name holds a pruned part is left out.

    Links to folders are not followed.
    """
    for path in paths:
        if "://" in path:
            store, inside = fs.FileSystem.from_uri(path)
            head = path[: len(path) - len(inside)] if path.endswith(inside) else ""
            found = [(head + x.path, x.type == fs.FileType.Directory, x.size or 0, x.mtime) for x in store.get_file_info(fs.FileSelector(inside))]
        else:
            found = []
            with os.scandir(path) as entries:
                for e in entries:
                    info = e.stat(follow_symlinks=False)
                    if not (e.is_symlink() and e.is_dir()):
                        found.append((e.path, e.is_dir(follow_symlinks=False), info.st_size, datetime.fromtimestamp(info.st_mtime, UTC)))
        for row in found:
            if not (row[1] and any(p in row[0].rpartition("/")[2].lower() for p in pruned)):
                yield row


def walk(spark: SparkSession, root: str, pruned: list[str] = PRUNED) -> DataFrame:
    """path, length, modificationTime of the files below root, listed level by level on the executors; pruned folders are never opened.

    root is a path that all machines see, or a URI that pyarrow opens. A level's folders are dealt out by path.
    """

    def run(frames):
        for pdf in frames:
            rows = list(list_folders(pdf["path"].tolist(), pruned))
            yield pd.DataFrame(rows, columns=["path", "folder", "length", "modificationTime"]).astype({"path": str, "folder": bool, "length": "int64", "modificationTime": "datetime64[us, UTC]"})

    root = "/" + root[5:].lstrip("/") if root.startswith("file:") else root
    level, files = spark.createDataFrame([(root.rstrip("/"),)], "path string"), []
    while True:
        listed = stored(level.repartition("path").mapInPandas(run, "path string, folder boolean, length long, modificationTime timestamp"))
        files.append(listed.filter("not folder").drop("folder"))
        level = listed.filter("folder").select("path")
        if level.isEmpty():
            return functools.reduce(DataFrame.unionByName, files)


def allowed_files(files: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """Files whose suffix, in any case, is allowed."""
    return files.filter(suffix(F.col("path")).isin(allowed or ALLOWED))


def new_files(files: DataFrame, catalog: DataFrame, key: str = "file_path") -> DataFrame:
    """One row for each path that the catalogue lacks."""
    return files.join(catalog.select(key), key, "left_anti").dropDuplicates([key])


def normalize_path(c: Column) -> Column:
    """C:\\a\\b to /mnt/c/a/b; other paths stay."""
    moved = F.concat(F.lit("/mnt/"), F.lower(F.left(c, F.lit(1))), F.translate(c.substr(F.lit(3), F.length(c)), "\\", "/"))
    return F.when(c.rlike(r"^[A-Za-z]:.*\\"), moved).otherwise(c)


def file_flags(files: DataFrame) -> DataFrame:
    """files with flag: ignored name, binary suffix, larger than 50 MB, in this order; pruned folders are left out."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    folder = F.lower(F.regexp_replace("path", r"[^/]*$", ""))
    any_of = lambda c, parts: F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(c, p))
    flag = F.when(any_of(name, IGNORED), "COMMON_IGNORE").when(suffix(F.col("path")).isin(BINARY), "MODEL_OR_BINARY").when(F.col("length") > LARGE, "LARGE_FILE").otherwise("OK")
    return files.filter(~any_of(folder, PRUNED)).withColumn("flag", flag)


def inventory(files: DataFrame) -> DataFrame:
    return file_flags(files).groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))


def explode_structures(docs: DataFrame) -> DataFrame:
    """Structure documents to one row for each raw chunk with its place; documents without chunks keep a row."""
    rows = docs.select("source_path", "doc_type", F.posexplode_outer("chunks").alias("ord", "c"))
    return rows.select("source_path", "doc_type", "ord", "c.*")


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    return explode_structures(spark.read.schema(STRUCTURE).json(path, multiLine=True))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no, value of the text files at path: lines are counted from 1 in each file, however many splits it has.

    Rows of a split stand together in their partition, so a row's place in its split needs no window. The splits' sizes
    are counted first, and their running sum (a row a split) says where each begins.
    """
    block = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start")]
    lines = spark.read.text(path).select("value", *block, F.monotonically_increasing_id().alias("_at"))
    sizes = lines.groupBy("path", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_start")) - F.col("_n")
    begins = sizes.select("path", "_start", (before - F.col("_first")).alias("_shift"))
    return lines.join(begins, ["path", "_start"]).select("path", (F.col("_at") + F.col("_shift") + 1).alias("line_no"), "value")


def parse_jsonl(lines: DataFrame, schema: str, quarantine: bool = False) -> DataFrame:
    """(line_no, value), path as well where there is one, to these and fields. Blank lines are passed over; bad ones fail with their number.

    With quarantine, bad lines come back as rows with the text in bad_line.
    """
    where = [c for c in ("path", "line_no") if c in lines.columns]
    rows = lines.filter(F.trim("value") != "")
    parsed = F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    out = rows.select(*where, parsed.alias("r")).select(*where, "r.*")
    if quarantine:
        return out.withColumnRenamed("_bad", "bad_line")
    file = F.concat(F.lit(" of "), "path") if "path" in where else F.lit("")
    fail = F.raise_error(F.concat(F.lit("bad JSON in line "), F.col("line_no").cast("string"), file)).cast("long")
    return out.withColumn("line_no", F.when(F.col("_bad").isNotNull(), fail).otherwise(F.col("line_no"))).drop("_bad")


def read_jsonl(spark: SparkSession, path: str, schema: str, quarantine: bool = False) -> DataFrame:
    """The records of the JSONL files at path with path and line_no; see parse_jsonl."""
    return parse_jsonl(numbered_lines(spark, path), schema, quarantine)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_feedback(df: DataFrame, path: str) -> None:
    write_jsonl(df.withColumn("timestamp", F.current_timestamp()), path, "append")


def append_metrics(df: DataFrame, path: str) -> None:
    write_jsonl(df.select("ts", "epoch", "step", "loss", "lr"), path, "append")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_table(df: DataFrame, target: str, jdbc: dict | None = None, mode: str = "append") -> None:
    """A table of the store: Parquet under target, or with jdbc options a table of that name."""
    if jdbc:
        df.write.format("jdbc").options(dbtable=target, **jdbc).mode(mode).save()
    else:
        df.write.mode(mode).parquet(target)


def load_table(spark: SparkSession, target: str, jdbc: dict | None = None, split: str | None = None, parts: int = 8, quote: str = '"') -> DataFrame:
    """A table of the store. split: a number column by whose range a JDBC table is read in parts at once; quote: the store's mark around names."""
    if not jdbc:
        return spark.read.parquet(target)
    reader = spark.read.format("jdbc").options(**jdbc)
    if split:
        name = f"{quote}{split}{quote}"
        ends = spark.read.format("jdbc").options(**jdbc).option("query", f"select min({name}) as low, max({name}) as high from {target}")
        low, high = ends.load().first()
        if low is not None and high > low:
            reader = reader.options(partitionColumn=split, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.option("dbtable", target).load()


def save_report(tables: dict[str, DataFrame], path: str, form: str = "csv") -> None:
    """The report's tables side by side, each in a folder of its name."""
    for name, df in tables.items():
        df.write.format(form).option("header", True).save(f"{path}/{name}")


#: Folders of a table that is kept up to date by key.
KEY_PARTS = 64


def _keyed(df: DataFrame, key: str, parts: int) -> DataFrame:
    return df.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))


def save_keyed(df: DataFrame, path: str, key: str, parts: int = KEY_PARTS) -> None:
    """A table that upsert keeps up to date: rows lie in folders by the hash of their key."""
    _keyed(df, key, parts).repartition("_part").write.partitionBy("_part").parquet(path)


def load_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_part")


def upsert(path: str, new: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], parts: int = KEY_PARTS) -> None:
    """Writes merge(stored, new) back into the table at path: only the folders that hold keys of new are read and replaced.

    Files of other folders stay as they are. merge keeps each key, and its rows have the table's columns.
    """
    spark, rows = new.sparkSession, stored(_keyed(new, key, parts))
    touched = [r["_part"] for r in rows.select("_part").distinct().collect()]
    before = spark.read.parquet(path).filter(F.col("_part").isin(touched))
    after = _keyed(merge(before.drop("_part"), rows.drop("_part")), key, parts).select(*before.columns)
    after.repartition("_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(path)
