"""Sinks (S6-S9). Output is written by the executors in parallel into a
directory (one file per partition); sorting happens only here.

Every output is published as a whole: it is written beside its place, its rows are
counted while they are written and again in what was written, and only then does it
take the place of an earlier output, with a manifest (``_MANIFEST.json``: rows,
columns, files and their bytes; Spark's readers skip it). A run that fails leaves the
earlier output as it was. A ``Publication`` holds several outputs back until all are
written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from yearloom.operators.reshape import sort_nulls_last

MANIFEST = "_MANIFEST.json"


class PublishError(RuntimeError):
    """What was written isn't what was to be written."""


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it sees it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of a published output."""
    fs, p = _file_system(spark, f"{path.rstrip('/')}/{MANIFEST}")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


@dataclass
class _Staged:
    path: str
    stage: str


class Publication:
    """Outputs that appear together: written beside their places as they come, put there by ``commit``. As a context it commits at the
    end, or removes what was written if the body fails."""

    def __init__(self, spark: SparkSession):
        self.spark, self.staged = spark, []

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_) -> None:
        self.commit() if kind is None else self.abort()

    def add(self, df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None], reread: Callable[[str], DataFrame]) -> str:
        """Write ``df`` beside ``path`` and check it; returns ``path``."""
        path = path.rstrip("/")
        one = _Staged(path, f"{path}.next-{uuid.uuid4().hex}")
        self.staged.append(one)
        seen = Observation()
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")).write, one.stage)
        rows, found = seen.get["rows"], reread(one.stage).count()
        if rows != found:
            raise PublishError(f"{path}: {rows} rows were to be written, {found} are there")
        fs, p = _file_system(self.spark, one.stage)
        files, each = [], fs.listFiles(p, True)
        while each.hasNext():
            f = each.next()
            name = f.getPath().toString().split(one.stage.rsplit("/", 1)[1] + "/", 1)[1]
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                files.append({"file": name, "bytes": f.getLen()})
        out = fs.create(_file_system(self.spark, f"{one.stage}/{MANIFEST}")[1])
        out.write(bytearray(json.dumps({"rows": rows, "columns": df.columns, "files": sorted(files, key=lambda f: f["file"])}, indent=1).encode()))
        out.close()
        return path

    def commit(self) -> None:
        """Put all outputs in their places; if that fails, those already moved go back."""
        moved = []
        try:
            for one in self.staged:
                fs, place = _file_system(self.spark, one.path)
                old = None
                if fs.exists(place):
                    old = f"{one.path}.previous-{uuid.uuid4().hex}"
                    if not fs.rename(place, _file_system(self.spark, old)[1]):
                        raise PublishError(f"{one.path} can't be moved away")
                moved.append((one, old))
                parent = place.getParent()
                if not (fs.exists(parent) or fs.mkdirs(parent)) or not fs.rename(_file_system(self.spark, one.stage)[1], place):
                    raise PublishError(f"{one.path} can't be put in its place")
        except Exception:
            for one, old in reversed(moved):
                fs, place = _file_system(self.spark, one.path)
                if old is not None:
                    fs.delete(place, True)
                    fs.rename(_file_system(self.spark, old)[1], place)
            self.abort()
            raise
        for _, old in moved:
            if old is not None:
                fs, p = _file_system(self.spark, old)
                fs.delete(p, True)
        self.staged = []

    def abort(self) -> None:
        """Remove what was written; the places keep what they had."""
        for one in self.staged:
            fs, p = _file_system(self.spark, one.stage)
            fs.delete(p, True)
        self.staged = []


def _publish(df: DataFrame, path: str, write, reread, publication: Publication | None) -> str:
    if publication is not None:
        return publication.add(df, path, write, reread)
    with Publication(df.sparkSession) as alone:
        return alone.add(df, path, write, reread)


def _ordered(df: DataFrame, order_by: Sequence[str] | None, single_file: bool) -> DataFrame:
    if order_by:
        df = sort_nulls_last(df, order_by)
    # one file only for small published outputs (the wide tables)
    return df.coalesce(1) if single_file else df


def _text(df: DataFrame, path: str, order_by, single_file: bool, publication, **options) -> str:
    # a quote inside a cell is doubled, as the readers expect
    def write(w: DataFrameWriter, to: str) -> None:
        w.options(header=True, escape='"', **options).csv(to)

    def reread(to: str) -> DataFrame:
        return df.sparkSession.read.options(header=True, escape='"', multiLine=True, **options).csv(to)

    return _publish(_ordered(df, order_by, single_file), path, write, reread, publication)


def write_csv(df: DataFrame, path: str, order_by: Sequence[str] | None = None, single_file: bool = False,
              publication: Publication | None = None) -> str:
    """CSV with header, missing printed as ``NA``."""
    return _text(df, path, order_by, single_file, publication, nullValue="NA", emptyValue="")


def write_tsv(df: DataFrame, path: str, order_by: Sequence[str] | None = None, single_file: bool = False,
              publication: Publication | None = None) -> str:
    """Tab-separated, missing as ``NA``."""
    return _text(df, path, order_by, single_file, publication, sep="\t", nullValue="NA")


def write_csv_quoted(df: DataFrame, path: str, order_by: Sequence[str] | None = None, single_file: bool = False,
                     publication: Publication | None = None) -> str:
    """Base-R style CSV, every field quoted, no row names, missing as ``NA``."""
    return _text(df, path, order_by, single_file, publication, quoteAll=True, nullValue="NA")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, publication: Publication | None = None) -> str:
    """Columnar sink for the long table (partitioned e.g. by model)."""
    def write(w: DataFrameWriter, to: str) -> None:
        (w.partitionBy(*partition_by) if partition_by else w).parquet(to)

    return _publish(df, path, write, lambda to: df.sparkSession.read.schema(df.schema).parquet(to), publication)
