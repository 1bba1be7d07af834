"""Layers as named, versioned tables with an atomic swap (SRC-5, SRC-6, SRC-8, SRC-9, DQ-13).

A lake is a root folder with a namespace (catalog database) per layer. A load writes a new version
of a table *beside* the old one, checks it against the table's contract in the same pass, and
compares the rows written with the rows counted; nothing that readers see has changed yet.
:meth:`Lake.publish` then moves one pointer: it writes the next manifest - the list of all tables
and their version folders - under its final name in one step, and points the views of the
namespaces to it. A load that dies half-way leaves the old manifest, views and files as they were;
a reader that has started keeps reading the files of its version, which stay until
:meth:`Lake.vacuum`.

Rows that break the contract go to the reject table of the load with the names of the rules;
the counts of every rule are gathered by ``DataFrame.observe`` while the table is written, without
a second scan, and kept as a history (:meth:`Lake.quality_history`). Only a load that has rejects
reads its input again, for these rows.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.contracts import RULES, Contract
from marketlake.sources.files import with_audit

HISTORY = "layer string, table_name string, version string, rule string, n_rows long, n_bad long, loaded_at timestamp"


class LoadError(RuntimeError):
    """A load whose files do not hold the rows that were written."""


@dataclass
class Lake:
    spark: SparkSession
    root: str
    timings: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.tag = f"{zlib.crc32(self.root.encode()):08x}"  # one set of names per place
        self._new: dict[str, dict] = {}
        self._quality: list[tuple] = []

    # ---- files ------------------------------------------------------------------------------
    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list[str]:
        p, fs = self._path(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _manifests(self) -> list[int]:
        return [int(n[:-5]) for n in self._list(f"{self.root}/_manifests") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, number: int | None = None) -> dict[str, dict]:
        """{table: {"version", "bucket_by", "buckets"}} of the newest (or the given) published state."""
        numbers = self._manifests()
        if not numbers:
            return {}
        text = self.spark.read.text(f"{self.root}/_manifests/{number or numbers[-1]:010d}.json", wholetext=True).first()[0]
        return json.loads(text)

    # ---- names ------------------------------------------------------------------------------
    def namespace(self, layer: str) -> str:
        name = f"lake_{self.tag}_{layer}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
        return name

    def _folder(self, table: str, entry: dict) -> str:
        return f"{self.root}/{table}/{entry['version']}"

    def frame(self, table: str, entry: dict) -> DataFrame:
        """A version as a frame; a bucketed one through the catalog, which knows its buckets."""
        if not entry.get("bucket_by"):
            return self.spark.read.parquet(self._folder(table, entry))
        return self.spark.table(self._version_table(table, entry))

    def _version_table(self, table: str, entry: dict) -> str:
        name = f"{self.namespace('versions')}.{table.replace('/', '_')}_{entry['version'].replace('-', '_')}"
        if not self.spark.catalog.tableExists(name):
            ddl = self.spark.read.parquet(self._folder(table, entry)).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ddl)
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({entry['bucket_by']}) SORTED BY ({entry['bucket_by']}) "
                           f"INTO {entry['buckets']} BUCKETS LOCATION '{self._folder(table, entry)}'")
        return name

    # ---- loads ------------------------------------------------------------------------------
    def load(self, table: str, df: DataFrame, contract: Contract | None = None, audit: str | None = None,
             bucket_by: str | None = None, buckets: int | None = None, aligned: bool = False) -> DataFrame:
        """Write a new version of ``table`` ("layer/name") and return it; not seen by readers before
        :meth:`publish`. ``bucket_by``: one file per bucket of that column (``aligned``: ``df`` is
        partitioned so already). ``audit``: name of the load-time column."""
        t0 = time.perf_counter()
        entry = {"version": f"v-{uuid.uuid4().hex[:12]}", "bucket_by": bucket_by, "buckets": buckets}
        rows, names, seen = df, [], Observation()
        if contract:
            names, rows = contract.names(), contract.mark(df)
        rules = [F.count_if(F.array_contains(RULES, n)).alias(f"_{i}") for i, n in enumerate(names)]
        marked = rows
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), *([F.count_if(F.size(RULES) > 0).alias("n_rejected"), *rules] if contract else []))
        if contract:
            rows = rows.where(F.size(RULES) == 0).drop(RULES)
        if bucket_by and not aligned:
            rows = rows.repartition(buckets, bucket_by)
        out = with_audit(rows, audit) if audit else rows
        if bucket_by:  # through the catalog, so that files are named by bucket
            staging = f"{self.namespace('versions')}.{table.replace('/', '_')}_{entry['version'].replace('-', '_')}"
            out.write.bucketBy(buckets, bucket_by).sortBy(bucket_by).option("path", self._folder(table, entry)).saveAsTable(staging)
        else:
            out.write.parquet(self._folder(table, entry))
        got = seen.get
        kept = got["n_rows"] - got.get("n_rejected", 0)
        written = self.frame(table, entry)
        if written.count() != kept:
            raise LoadError(f"{table}: {kept} rows were written, {written.count()} are there")
        if got.get("n_rejected"):
            marked.where(F.size(RULES) > 0).withColumnRenamed(RULES, "rules").write.parquet(f"{self.root}/_rejects/{table}/{entry['version']}")
        layer, name = table.split("/")
        self._quality += [(layer, name, entry["version"], n, got["n_rows"], got[f"_{i}"]) for i, n in enumerate(names)]
        self._new[table] = entry
        self.timings[table] = round(time.perf_counter() - t0, 3)
        return written.drop(audit) if audit else written

    def publish(self) -> int:
        """Make the loads since the last publish the current versions, all at once."""
        numbers = self._manifests()
        number = (numbers[-1] if numbers else 0) + 1
        state = {**self.manifest(), **self._new}
        if self._quality:
            rows = self.spark.createDataFrame(self._quality, HISTORY.replace(", loaded_at timestamp", ""))
            rows.withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/_quality")
        target, fs = self._path(f"{self.root}/_manifests/{number:010d}.json")
        draft, _ = self._path(f"{self.root}/_manifests/.{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        stream.close()
        if fs.exists(target) or not fs.rename(draft, target):  # the pointer moves here
            raise LoadError(f"another load published {number} at {self.root}")
        self._new, self._quality = {}, []
        self.attach()
        return number

    # ---- reads ------------------------------------------------------------------------------
    def attach(self) -> dict[str, str]:
        """Point the views of the namespaces to the current versions; {table: view}. A new session
        calls this to see the tables by name."""
        views, state = {}, self.manifest()
        for table, entry in state.items():
            layer, name = table.split("/")
            view = f"{self.namespace(layer)}.{name}"
            source = self._version_table(table, entry) if entry.get("bucket_by") else f"parquet.`{self._folder(table, entry)}`"
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {source}")
            views[table] = view
        # names of versions that are no longer current; their files stay
        current = {self._version_table(t, e) for t, e in state.items() if e.get("bucket_by")}
        for t in self.spark.catalog.listTables(self.namespace("versions")):
            name = f"{self.namespace('versions')}.{t.name}"
            if name not in current and not any(t.name.endswith(e["version"].replace("-", "_")) for e in self._new.values()):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return views

    def table(self, table: str, manifest: int | None = None) -> DataFrame:
        """The current (or an earlier published) version of a table."""
        return self.frame(table, self.manifest(manifest)[table])

    def rejects(self, table: str) -> DataFrame | None:
        """The rows that the current version's load turned away, with their rules; None if there are none."""
        path = f"{self.root}/_rejects/{table}/{self.manifest()[table]['version']}"
        p, fs = self._path(path)
        return self.spark.read.parquet(path) if fs.exists(p) else None

    def quality_history(self) -> DataFrame:
        """(layer, table_name, version, rule, n_rows, n_bad, loaded_at) of all published loads."""
        return self.spark.read.schema(HISTORY).parquet(f"{self.root}/_quality") if self._list(f"{self.root}/_quality") \
            else self.spark.createDataFrame([], HISTORY)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete manifests but the last ``keep`` and the version folders that none of these name.
        Not to be run beside a load."""
        numbers = self._manifests()
        kept = numbers[-keep:]
        named = {f"{t}/{e['version']}" for n in kept for t, e in self.manifest(n).items()}
        gone = []
        for layer in self._list(self.root):
            if layer.startswith("_"):
                continue
            for name in self._list(f"{self.root}/{layer}"):
                gone += [f"{layer}/{name}/{v}" for v in self._list(f"{self.root}/{layer}/{name}") if v.startswith("v-") and f"{layer}/{name}/{v}" not in named]
        for path in [*gone, *(f"_manifests/{n:010d}.json" for n in numbers if n not in kept)]:
            p, fs = self._path(f"{self.root}/{path}")
            fs.delete(p, True)
        return gone
