"""``caserun``: a sink that publishes all document outputs of a run at once, or none of them.

Rows are ``data_set, doc_id, content``. Tasks write files below ``_staging/<run>``, which readers skip.
When all tasks have ended, files that no successful task has named are deleted, each data set's folder
is moved to ``<data set>/run_id=<run>`` with one rename, and last the manifest ``_runs/<run>.json`` is
written: a run exists when its manifest does. When the job fails, the staged files go and nothing has
been visible. A run whose manifest is there already is not written again, so a repeated call, or a
replayed batch of a stream, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from casemill import fixed_values as V
from casemill.sources.casedocs import file_system

ROW_TYPE = "data_set string, doc_id string, content string"
RUNS_DIR, STAGING_DIR = "_runs", "_staging"
#: Data sets that every run has, with no rows perhaps.
DATA_SETS = [V.STRUCTURED_DIR, V.EMAILS_DIR, V.SUMMARIES_DIR]
#: Data sets whose content is a JSON record, written as lines; others become Parquet of doc_id and content.
JSON_SETS = [V.STRUCTURED_DIR]


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: data set, name below the staging folder, rows."""

    files: list[tuple[str, str, int]] = field(default_factory=list)


class _File:
    def __init__(self, root: str, data_set: str):
        self.data_set, self.rows = data_set, 0
        self.name = f"{data_set}/part-{uuid.uuid4().hex}.{'json' if data_set in JSON_SETS else 'parquet'}"
        self._system, self._path = file_system(f"{root}/{self.name}")
        self._system.create_dir(self._path.rsplit("/", 1)[0], recursive=True)
        self._out = self._system.open_output_stream(self._path, compression=None)
        self._schema = pa.schema([("doc_id", pa.string()), ("content", pa.string())])
        self._table = None if data_set in JSON_SETS else pq.ParquetWriter(self._out, self._schema)

    def write(self, rows: pa.RecordBatch) -> None:
        self.rows += rows.num_rows
        if self._table is None:
            self._out.write("".join(f"{line}\n" for line in rows.column("content").to_pylist()).encode())
        else:
            columns = [rows.column(name).cast(pa.string()) for name in self._schema.names]
            self._table.write_batch(pa.RecordBatch.from_arrays(columns, schema=self._schema))

    def close(self) -> None:
        if self._table is not None:
            self._table.close()
        self._out.close()

    def drop(self) -> None:
        self.close()
        self._system.delete_file(self._path)


class _Writer(DataSourceArrowWriter):
    def __init__(self, out_dir: str, run_id: str, overwrite: bool):
        self._out, self._run, self._overwrite = out_dir.rstrip("/"), run_id, overwrite
        # A name of its own for each call, so that two calls for one run never share files.
        self._staged = f"{self._out}/{STAGING_DIR}/{run_id}-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files: dict[str, _File] = {}
        try:
            for batch in batches:
                sets = batch.column("data_set")
                for data_set in sets.unique().to_pylist():
                    if data_set not in files:
                        files[data_set] = _File(self._staged, data_set)
                    files[data_set].write(batch.filter(pa.compute.equal(sets, data_set)))
            for file in files.values():
                file.close()
        except BaseException:
            for file in files.values():
                file.drop()
            raise
        return Written([(f.data_set, f.name, f.rows) for f in files.values()])

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, out = file_system(self._out)
        staged = file_system(self._staged)[1]
        manifest = f"{out}/{RUNS_DIR}/{self._run}.json"
        known = system.get_file_info(manifest).type != fs.FileType.NotFound
        if known:
            self._drop_staged(system, staged)
            return
        files = [f for m in messages if m is not None for f in m.files]
        kept = {name for _, name, _ in files}
        for info in system.get_file_info(fs.FileSelector(staged, recursive=True, allow_not_found=True)):
            # Left by attempts that were lost or came second.
            if info.type == fs.FileType.File and info.path[len(staged) + 1 :] not in kept:
                system.delete_file(info.path)
        sets = {data_set: {"files": 0, "rows": 0} for data_set in DATA_SETS}
        for data_set, _, rows in files:
            entry = sets.setdefault(data_set, {"files": 0, "rows": 0})
            entry["files"] += 1
            entry["rows"] += rows
        for data_set in sets:
            target = f"{out}/{data_set}/run_id={self._run}"
            if system.get_file_info(target).type != fs.FileType.NotFound:
                system.delete_dir(target)  # of a call that ended before its manifest
            if sets[data_set]["files"]:
                system.create_dir(f"{out}/{data_set}", recursive=True)
                system.move(f"{staged}/{data_set}", target)
            else:
                system.create_dir(target, recursive=True)
        system.create_dir(f"{out}/{RUNS_DIR}", recursive=True)
        with system.open_output_stream(f"{manifest}.new", compression=None) as handle:
            handle.write(json.dumps({"run_id": self._run, "data_sets": sets}).encode())
        system.move(f"{manifest}.new", manifest)
        # Staged files of this call, and what earlier calls for the run have left.
        for info in system.get_file_info(fs.FileSelector(f"{out}/{STAGING_DIR}", allow_not_found=True)):
            if info.base_name.rsplit("-", 1)[0] == self._run:
                system.delete_dir(info.path)
        if self._overwrite:
            self._drop_other_runs(system, out)

    def abort(self, messages: list[Written | None]) -> None:
        system, staged = file_system(self._staged)
        self._drop_staged(system, staged)

    @staticmethod
    def _drop_staged(system, staged: str) -> None:
        from pyarrow import fs

        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)

    def _drop_other_runs(self, system, out: str) -> None:
        from pyarrow import fs

        for info in system.get_file_info(fs.FileSelector(f"{out}/{RUNS_DIR}")):
            run = info.base_name.removesuffix(".json")
            if run == self._run or not info.base_name.endswith(".json"):
                continue
            # The manifest goes first: from then on the run does not exist.
            with system.open_input_stream(info.path) as handle:
                sets = json.loads(handle.read())["data_sets"]
            system.delete_file(info.path)
            for data_set in sets:
                system.delete_dir(f"{out}/{data_set}/run_id={run}")


class CaseRun(DataSource):
    """Options: ``path`` and ``run_id``; mode ``overwrite`` removes earlier runs once this one is published."""

    @classmethod
    def name(cls) -> str:
        return "caserun"

    def schema(self) -> str:
        return ROW_TYPE

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options["run_id"], overwrite)


def is_published(spark: SparkSession, out_dir: str, run_id: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{RUNS_DIR}/{run_id}.json")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def published_runs(spark: SparkSession, out_dir: str) -> DataFrame:
    """``run_id, data_set, files, rows`` of the runs whose manifests are there."""
    entry = "struct<files:bigint,rows:bigint>"
    manifests = spark.read.schema(f"run_id string, data_sets map<string,{entry}>").json(f"{out_dir}/{RUNS_DIR}/*.json")
    return manifests.selectExpr("run_id", "explode(data_sets) as (data_set, n)").selectExpr("run_id", "data_set", "n.files", "n.rows")


def publish(rows: DataFrame, out_dir: str, run_id: str, clean: bool = False) -> None:
    """Write ``data_set, doc_id, content`` rows as the outputs of a run, unless it is published already."""
    spark = rows.sparkSession
    if is_published(spark, out_dir, run_id):
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_dir)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    spark.dataSource.register(CaseRun)
    rows.write.format("caserun").option("run_id", run_id).mode("overwrite" if clean else "append").save(whole)
