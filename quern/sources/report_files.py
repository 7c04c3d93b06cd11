"""Text reports as files, one for each document, by a data source with commit.

df.write.format("report_files").option("path", folder).save() takes (name, text) rows; rows of one name that follow one another
are the lines of one file, so a long report passes through a task piece by piece. Every task writes to a folder of its own attempt, and the commit gives the folders their final names, one rename a task. A task that is tried again, or
runs twice, leaves nothing behind, and a write that fails takes its folders with it.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@dataclass
class Written(WriterCommitMessage):
    folder: str | None
    files: int


class ReportWriter(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool, once: bool):
        if missing := {"name", "text"} - set(columns):
            raise ValueError(f"reports need columns {sorted(missing)}")
        self.path, self.name, self.text, self.overwrite, self.once, self.write_id = path, columns.index("name"), columns.index("text"), overwrite, once, uuid.uuid4().hex

    @property
    def staging(self) -> str:
        return f"_staging-{self.write_id}"

    def write(self, iterator: Iterator) -> Written:
        store, root = open_folder(self.path)
        folder, n, last, out = f"{self.staging}/{uuid.uuid4().hex}", 0, None, None
        try:
            for row in iterator:
                name, data = row[self.name], (row[self.text] or "").encode()
                if out and name == last:
                    if self.once:
                        raise ValueError(f"two reports named {name!r}")
                    out.write(b"\n" + data)
                    continue
                if not name or "/" in name or name in (".", ".."):
                    raise ValueError(f"no file name: {name!r}")
                if out:
                    out.close()
                else:
                    store.create_dir(f"{root}/{folder}", recursive=True)
                if n and store.get_file_info(f"{root}/{folder}/{name}").type != fs.FileType.NotFound:
                    raise ValueError(f"two reports named {name!r}")
                out, last, n = store.open_output_stream(f"{root}/{folder}/{name}"), name, n + 1
                out.write(data)
        finally:
            if out:
                out.close()
        return Written(folder if n else None, n)

    def commit(self, messages: list) -> None:
        store, root = open_folder(self.path)
        store.create_dir(root, recursive=True)
        old = [x.path for x in store.get_file_info(fs.FileSelector(root)) if x.type == fs.FileType.Directory and x.base_name.startswith("part-")] if self.overwrite else []
        for i, folder in enumerate(sorted(m.folder for m in messages if m and m.folder)):
            store.move(f"{root}/{folder}", f"{root}/part-{i:05d}-{self.write_id}")
        for path in old:
            store.delete_dir(path)
        self._clear(store, root)
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list) -> None:
        self._clear(*open_folder(self.path))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.staging}")


class ReportFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "report_files"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ReportWriter(self.options["path"], schema.fieldNames(), overwrite, self.options.get("once", "false") == "true")


def save_reports(reports: DataFrame, path: str, mode: str = "append") -> None:
    """(doc_id, report) as {doc_id}.txt in the part folders of path; a doc_id comes once. mode: append or overwrite."""
    reports.sparkSession.dataSource.register(ReportFiles)
    rows = reports.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.col("report").alias("text"))
    rows.write.format("report_files").options(path=path, once=True).mode(mode).save()


def save_report_parts(parts: DataFrame, path: str, mode: str = "append") -> None:
    """(doc_id, page, chunk_id, part) as {doc_id}.txt, the parts in order, the head (nulls) first; no report is ever whole in memory."""
    parts.sparkSession.dataSource.register(ReportFiles)
    order = [F.asc_nulls_first(c) for c in ("doc_id", "page", "chunk_id")]
    rows = parts.repartition("doc_id").sortWithinPartitions(*order).select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.col("part").alias("text"))
    rows.write.format("report_files").option("path", path).mode(mode).save()


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(name, text) of the reports at path; Spark passes over files without a byte."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/part-*")
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.decode("content", "UTF-8").alias("text"))
