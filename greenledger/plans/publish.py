"""Atomic publication: readers follow one manifest, or see nothing new.

A build is written under a folder of its own. When all of it is there and its
contract holds, one manifest file names every table's folders, under the next
version number; it is written beside its place and renamed into it, which either
happens or does not. Readers open the manifest of a version and read what it names,
so they never see tables of two builds, of an unfinished build or of a failed one.
A table may be cut into parts by month; a later version then names the folders of
an earlier build for the parts that it leaves as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .pipeline import PARTED, ReportingBuild, ReportingParams, TableStore, run_pipeline

MANIFESTS, BUILDS = "_published", "builds"


class PublicationConflict(RuntimeError):
    """Another publication took the version that this one was to be."""


class NotPublished(LookupError):
    """The version, or the table in it, was never published."""


@dataclass(frozen=True)
class Manifest:
    """``tables``: name -> part -> folder; an uncut table has one part, ''. ``schemas`` and
    ``rows``: each table's columns, as JSON, and number of rows."""
    version: int
    build: str
    tables: Mapping[str, Mapping[str, str]]
    schemas: Mapping[str, str]
    rows: Mapping[str, int]


class Publication:
    """The versions published under ``root``, a folder of any store that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self._conf)

    def _list(self, folder: str) -> list[str]:
        path, fs = self._path(folder), self._fs()
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    # ------------------------------------------------------------- reading
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._list(f"{self.root}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The manifest of a version, by default the latest."""
        known = self.versions()
        if not known or version is not None and version not in known:
            raise NotPublished(f"{self.root} has no version {version or ''}".rstrip())
        version = known[-1] if version is None else version
        text = "".join(r["value"] for r in self.spark.read.text(self._file(version), wholetext=True).collect())
        return Manifest(**json.loads(text))

    def _file(self, version: int) -> str:
        return f"{self.root}/{MANIFESTS}/{version:010d}.json"

    def table(self, name: str, version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """A table as of a version; of a table cut by month, ``parts`` reads some only."""
        return self.read(self.manifest(version), name, parts)

    def read(self, manifest: Manifest, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        if name not in manifest.tables:
            raise NotPublished(f"{name} is not in version {manifest.version}")
        own, schema = manifest.tables[name], StructType.fromJson(json.loads(manifest.schemas[name]))
        wanted = own if parts is None else [p for p in parts if p in own]
        if not wanted:  # none of these months has rows
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[own[p] for p in wanted])

    # ------------------------------------------------------------- writing
    def new_folder(self) -> str:
        """A folder for a build that nobody reads yet."""
        return f"{self.root}/{BUILDS}/{uuid.uuid4().hex}"

    def parts_of(self, name: str, folder: str) -> dict[str, str]:
        """The parts that a TableStore wrote of a table; an empty month has none."""
        if name not in PARTED:
            return {"": folder}
        return {n.partition("=")[2]: f"{folder}/{n}" for n in self._list(folder) if "=" in n}

    def commit(self, build: str, tables: Mapping[str, Mapping[str, str]], schemas: Mapping[str, StructType],
               after: int | None) -> Manifest:
        """Publish ``tables`` as the version that follows ``after``, the latest one when the
        build began (None: there was none). If another publication was faster, nothing
        is published and the build has to start again from what is there now."""
        version = (after or 0) + 1
        names = sorted(tables)
        made = Manifest(version, build, {n: dict(tables[n]) for n in names}, {n: schemas[n].json() for n in names}, {})
        counts = [self.read(made, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
        made = replace(made, rows={r["name"]: r["n"] for r in reduce(DataFrame.unionByName, counts).collect()})
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self._conf)
        fs = self._fs()
        draft = self._path(f"{self.root}/{MANIFESTS}/.draft-{uuid.uuid4().hex}")
        fs.mkdirs(draft.getParent())
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(made.__dict__, indent=1).encode()))
        finally:
            out.close()
        gateway = self.spark.sparkContext._gateway
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.NONE  # never over a file that is there
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(self._path(self._file(version))), options)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if fs.exists(self._path(self._file(version))):
                raise PublicationConflict(f"version {version} of {self.root} is already there") from error
            raise
        return made


def publish_build(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, params: ReportingParams | None = None,
                  gate: bool = False) -> Manifest:
    """Build everything from ``raw`` and publish it. A failed contract raises, as does a
    closed gate; then nothing is published, and the quality report lies in the build's
    own folder, which the error names."""
    published = Publication(spark, root)
    known = published.versions()
    folder = published.new_folder()
    try:
        build: ReportingBuild = run_pipeline(spark, raw, folder, params, gate, parted=True)
    except Exception as error:
        error.add_note(f"nothing was published; the quality report is in {folder}/reports/dq_report")
        raise
    store: TableStore = build.store
    tables = {name: published.parts_of(name, path) for name, path in store.written.items()}
    return published.commit(folder.rpartition("/")[2], tables, store.schemas, known[-1] if known else None)
