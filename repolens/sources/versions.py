"""Tables that are published together (J7, B10): immutable partition folders, named by one manifest.

A batch writes each table's rebuilt partitions to folders of its own,
``<root>/<table>/batch=<id>/<partition>/``, and never touches a folder that is
there. ``publish`` then writes one new manifest that names, for every table
and partition, the batch that holds it. Readers resolve the highest manifest
first, so they see all tables of one run or all of the run before; a run that
is lost before ``publish`` leaves only unnamed folders. A manifest has an
entry a partition, i.e. one a month or bucket, whatever the rows.

Manifests are numbered and created by a rename that fails if the number is
taken, so of two runs that start from one manifest the second is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_FOLDER = "_manifests"


class StaleManifest(RuntimeError):
    """Another run has published since this one read the tables."""


@dataclass
class Manifest:
    number: int = 0
    #: table -> partition path -> batch
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    #: run -> stages it has committed
    done: dict[str, list[str]] = field(default_factory=dict)

    def draft(self) -> Manifest:
        """A copy to be changed and published as the next number."""
        return Manifest(self.number + 1, {t: dict(p) for t, p in self.tables.items()}, {r: list(s) for r, s in self.done.items()})


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest published manifest; an empty one of number 0 if there is none."""
    numbers = sorted(n for n in _names(spark, f"{root}/{_FOLDER}") if n.endswith(".json") and not n.startswith("."))
    if not numbers:
        return Manifest()
    fs, p = _fs(spark, f"{root}/{_FOLDER}/{numbers[-1]}")
    stream = fs.open(p)
    try:
        body = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(body))


def publish(spark: SparkSession, root: str, draft: Manifest) -> None:
    """Make ``draft`` the tables that readers see. Refused with ``StaleManifest`` if its number is taken."""
    name = f"{draft.number:010d}.json"
    if name in _names(spark, f"{root}/{_FOLDER}"):
        raise StaleManifest(f"{root} has been published by another run")
    fs, folder = _fs(spark, f"{root}/{_FOLDER}")
    fs.mkdirs(folder)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(folder, f".{name}.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps({"number": draft.number, "tables": draft.tables, "done": draft.done}, sort_keys=True).encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # never over a file that is there
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(tmp, jvm.org.apache.hadoop.fs.Path(folder, name), options)
    except Exception as e:
        if name in _names(spark, f"{root}/{_FOLDER}"):
            raise StaleManifest(f"{root} has been published by another run") from e
        raise


def _key_type(name: str) -> T.DataType:
    return T.DateType() if name.endswith("month") or name.endswith("date") else T.IntegerType() if name.endswith("bucket") else T.StringType()


def load(spark: SparkSession, root: str, manifest: Manifest, table: str, schema: T.StructType, partition_cols: list[str], keep=None) -> DataFrame:
    """A table as ``manifest`` names it, with its partition columns. ``keep``: a test of partition paths;
    other folders are not even listed."""
    entries = manifest.tables.get(table, {})
    paths = [f"{root}/{table}/batch={batch}" + (f"/{key}" if key else "") for key, batch in entries.items() if keep is None or keep(key)]
    full = T.StructType([*schema.fields, *(T.StructField(c, _key_type(c)) for c in partition_cols)])
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{root}/{table}").parquet(*paths).select(*full.names)


def write_batch(df: DataFrame, root: str, draft: Manifest, table: str, partition_cols: list[str], touched) -> str:
    """Write the rows of the rebuilt partitions of ``table`` and name their folders in ``draft``; partitions in ``touched``
    (paths) that got no row leave it. Returns the batch."""
    spark, batch = df.sparkSession, f"{draft.number:010d}-{uuid.uuid4().hex[:8]}"
    path = f"{root}/{table}/batch={batch}"
    if partition_cols:
        order = [*partition_cols, *(c for c in ("language",) if c in df.columns)]
        df.hint("rebalance", *partition_cols).sortWithinPartitions(*order).write.partitionBy(*partition_cols).parquet(path)
    else:
        df.write.parquet(path)
    entries = draft.tables.setdefault(table, {})
    for key in touched:
        entries.pop(key, None)
    found = [""]
    for _ in partition_cols:
        found = [f"{f}/{n}".lstrip("/") for f in found for n in _names(spark, f"{path}/{f}".rstrip("/")) if "=" in n]
    entries.update({key: batch for key in found})
    return batch


def partition_path(row, partition_cols: list[str]) -> str:
    """The folder of a partition, from a row of its values."""
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in partition_cols)


def touched_partitions(df: DataFrame, partition_cols: list[str]) -> set[str]:
    """The partitions that ``df`` has rows in: at most one value a month or bucket."""
    return {partition_path(r, partition_cols) for r in df.select(*partition_cols).distinct().collect()}


def mark_done(spark: SparkSession, root: str, run: str, stage: str) -> None:
    """Note in a manifest of its own that ``run`` has committed ``stage`` (for stages that land files themselves)."""
    draft = read_manifest(spark, root).draft()
    draft.done.setdefault(run, []).append(stage)
    publish(spark, root, draft)


def has_batches(spark: SparkSession, path: str) -> bool:
    """Whether a folder is one of a published table (or of a run that was lost before its first manifest)."""
    names = _names(spark, path)
    return bool(names) and all(n.startswith(("batch=", "_", ".")) for n in names)


def drop_unnamed(spark: SparkSession, root: str, tables) -> int:
    """Delete the batches that the current manifest does not name (left by lost runs or replaced by later ones).
    To be run when no reader holds an older manifest. Returns how many batches went."""
    manifest, gone = read_manifest(spark, root), 0
    for table in tables:
        live = set(manifest.tables.get(table, {}).values())
        for name in _names(spark, f"{root}/{table}"):
            if name.startswith("batch=") and name[len("batch=") :] not in live:
                fs, p = _fs(spark, f"{root}/{table}/{name}")
                gone += bool(fs.delete(p, True))
    return gone
