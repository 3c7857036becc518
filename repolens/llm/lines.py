"""Reversible line dedup over a growing corpus.

A line's key is the line without white space at its ends and with A-Z lower-cased;
keys of fewer than ``min_chars`` code points are never dropped. Three tables hold the
state, and every operation returns a new state, so an insertion can be undone:

* postings (hi, lo, doc, part): which document holds which key, exact; part: a hash of the text, so that the
  rows of an id that many rows share (or lack) stay apart;
* counts (hi, lo, docs, first): the reference count of a key and its smallest document;
* filters (shard, bits, table): a cuckoo filter of the keys of each shard of the hashes.

Inserting documents asks the filters first: a key that they do not know is new and needs
no look at the counts; only the rest meets the exact table. Deleting documents
takes their postings away, counts down, and takes keys that no document holds any more
out of the filters. Dropping is decided by the exact counts alone.

Keys are 128-bit hashes. A key that a third of the documents hold is counted by a
partial aggregate, and its postings are joined with its one count, a join that AQE
splits. A shard holds a bounded number of keys (``SHARD_KEYS``) as there are more
shards the more keys there are.

A null or empty text is one empty line. A document id may repeat: its rows are one document.
A null id is a document larger than all others, whose rows are handled text by text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm import cuckoo
from repolens.llm.common import tidied
from repolens.session import cut_lineage

MIN_CHARS = 10
SHARD_KEYS = 100_000
#: Batches in which ``dedup`` grows its index.
BATCHES = 2
BLANK = b" \t\n\x0b\x0c\r"
_LAST = (1 << 63) - 1


def _keys(text: bytes, min_chars: int) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text and their keys (None: too short to be dropped)."""
    lines = text.split(b"\n")
    keys = [x.strip(BLANK).lower() for x in lines]
    return lines, [k if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode()) >= min_chars) else None for k in keys]


def _digest(keys) -> bytes:
    import xxhash

    return b"".join(map(xxhash.xxh3_128_digest, keys))


def doc_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(_LAST))


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, doc, part): the keys of the lines of every document, once per row."""

    def held(batches):
        for b in batches:
            found = [{k for k in _keys(t.as_buffer().to_pybytes() if t.is_valid else b"", min_chars)[1] if k} for t in b.column(2)]
            hashes = np.frombuffer(b"".join(_digest(f) for f in found), ">i8").reshape(-1, 2).astype(np.int64)
            n = [len(f) for f in found]
            columns = [hashes[:, 0], hashes[:, 1], *(np.repeat(b.column(i).to_numpy(), n) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hi", "lo", "doc", "part"])

    return docs.select(doc_key(key).alias("doc"), _part(text).alias("part"), F.col(text).cast("binary")).mapInArrow(tidied(held), "hi long, lo long, doc long, part long")


def _part(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


@dataclass
class Index:
    """The state: three DataFrames on written tables, and how many bits name a shard."""

    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    bits: int


def empty(spark: SparkSession, bits: int = 4) -> Index:
    return Index(
        spark.createDataFrame([], "hi long, lo long, doc long, part long"),
        spark.createDataFrame([], "hi long, lo long, docs long, first long"),
        spark.createDataFrame([], "shard long, `table` binary"),
        bits,
    )


def _shard(bits: int) -> Column:
    return F.shiftrightunsigned("hi", 64 - bits).alias("shard")


def _counted(held: DataFrame, once: bool = False) -> DataFrame:
    """Counts of the documents of postings; ``once``: no document has two rows."""
    if not once:
        held = held.select("hi", "lo", "doc").distinct()
    return held.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first"))


def _load(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint16).reshape(-1, cuckoo.SLOTS).copy()


def _build(keys: np.ndarray, room: int = 1) -> bytes:
    n = len(keys) * room
    while True:
        table = cuckoo.empty(n)
        if cuckoo.insert(table, keys):
            return table.tobytes()
        n *= 2


def build_filters(counts: DataFrame, bits: int, room: int = 1) -> DataFrame:
    """(shard, table): a filter of all keys of each shard, with room for ``room`` times as many."""

    def built(rows: pa.Table) -> pa.Table:
        return pa.table({"shard": rows["shard"][:1], "table": pa.array([_build(rows["lo"].to_numpy(), room)], pa.binary())})

    return counts.select(_shard(bits), "lo").groupBy("shard").applyInArrow(built, "shard long, `table` binary")


def probe(keys: DataFrame, filters: DataFrame, bits: int) -> DataFrame:
    """(hi, lo, known) of distinct (hi, lo): known is false only for keys that are not in the index."""

    def asked(rows: pa.Table, table: pa.Table) -> pa.Table:
        lo = rows["lo"].to_numpy()
        known = cuckoo.contains(_load(table["table"][0].as_py()), lo) if len(table) else np.zeros(len(lo), bool)
        return pa.table({"hi": rows["hi"], "lo": rows["lo"], "known": pa.array(known)})

    return keys.select(_shard(bits), "hi", "lo").groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(asked, "hi long, lo long, known boolean")


def insert(index: Index, docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, new_ids: bool = False, once: bool = False, room: int = 1) -> Index:
    """The index with ``docs`` added. A document that it holds already gains its new keys. ``new_ids``: the
    index holds none of them; ``once``: no id is in two rows; ``room``: how many times these keys the first
    filters have room for, so that batches to come don't fill them."""
    new = postings(docs, key, text, min_chars)
    if index.postings.isEmpty():
        held = cut_lineage(new, "line-postings")
        counts = cut_lineage(_counted(held, once or not _repeats(docs, key)), "line-counts")
        bits = max(4, int(counts.count() // shard_keys).bit_length())
        return Index(held, counts, cut_lineage(build_filters(counts, bits, room), "line-filters"), bits)
    if new_ids:
        added = fresh = cut_lineage(new, "line-postings")
    else:
        added = cut_lineage(new.distinct().join(index.postings, ["hi", "lo", "doc", "part"], "left_anti"), "line-postings")
        fresh = added.select("hi", "lo", "doc").distinct().join(index.postings, ["hi", "lo", "doc"], "left_anti")
    gained = cut_lineage(_counted(fresh, once and new_ids), "line-gains")
    asked = cut_lineage(gained.join(probe(gained, index.filters, index.bits), ["hi", "lo"]), "line-asked")
    # Keys that the filters know may be in the counts; the others are new for certain.
    known = asked.filter("known").select("hi", "lo", F.col("docs").alias("more"), F.col("first").alias("other"))
    unseen = asked.filter("not known").drop("known")
    met = index.counts.join(known, ["hi", "lo"], "full")
    merged = met.select("hi", "lo", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"), F.least("first", "other").alias("first"))
    counts = cut_lineage(merged.unionByName(unseen), "line-counts")
    # Of the known keys, those without a count were mistaken for others.
    mistaken = known.join(index.counts, ["hi", "lo"], "left_anti").select("hi", "lo")
    filters = cut_lineage(_updated(index, unseen.select("hi", "lo").unionByName(mistaken), counts, cuckoo.insert), "line-filters")
    return Index(index.postings.unionByName(added), counts, filters, index.bits)


def delete(index: Index, ids: DataFrame, key: str = "doc_id") -> Index:
    """The index without the documents ``ids``, as if they had never been inserted."""
    gone = ids.select(doc_key(key).alias("doc")).distinct()
    lost = cut_lineage(index.postings.join(gone, "doc", "left_semi"), "line-lost")
    left = cut_lineage(index.postings.join(gone, "doc", "left_anti"), "line-postings")
    touched = lost.select("hi", "lo").distinct()
    again = _counted(left.join(touched, ["hi", "lo"], "left_semi"))
    counts = cut_lineage(index.counts.join(touched, ["hi", "lo"], "left_anti").unionByName(again), "line-counts")
    dead = touched.join(counts, ["hi", "lo"], "left_anti")
    filters = cut_lineage(_updated(index, dead, counts, cuckoo.delete), "line-filters")
    return Index(left, counts, filters, index.bits)


def _updated(index: Index, keys: DataFrame, counts: DataFrame, change) -> DataFrame:
    """The filters after ``change`` with ``keys``; one too full is built again from the counts."""

    def changed(rows: pa.Table, old: pa.Table) -> pa.Table:
        shard = (rows if len(rows) else old)["shard"][:1]
        if not len(old):
            return pa.table({"shard": shard, "table": pa.array([_build(rows["lo"].to_numpy())], pa.binary())})
        table = _load(old["table"][0].as_py())
        fine = change(table, rows["lo"].to_numpy()) is not False if len(rows) else True
        return pa.table({"shard": shard, "table": pa.array([table.tobytes() if fine else None], pa.binary())})

    new = keys.select(_shard(index.bits), "lo").groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInArrow(changed, "shard long, `table` binary")
    new = cut_lineage(new, "line-filters")
    full = new.filter("`table` is null").select("shard")
    if full.isEmpty():
        return new
    again = counts.withColumn("shard", _shard(index.bits)).join(full, "shard", "left_semi").drop("shard")
    return new.filter("`table` is not null").unionByName(build_filters(again, index.bits))


def _repeats(docs: DataFrame, key: str) -> bool:
    """Whether an id occurs in two rows: then postings may repeat."""
    return not docs.groupBy(key).count().filter("count > 1").isEmpty()


def drops(index: Index) -> DataFrame:
    """(doc, part, hashes): the keys whose lines go from a document's text, as 16-byte hashes; keys that
    at least two documents hold go from all but the smallest. A row has the keys of one text."""
    shared = index.counts.filter("docs >= 2").select("hi", "lo", "first")
    gone = index.postings.join(shared, ["hi", "lo"]).filter("doc != first")
    hashes = F.concat(F.unhex(F.lpad(F.hex("hi"), 16, "0")), F.unhex(F.lpad(F.hex("lo"), 16, "0")))
    return gone.groupBy("doc", "part").agg(F.collect_set(hashes).alias("hashes"))


def apply(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text`` without the lines of ``gone`` (what ``drops`` gives), and n_lines
    and n_dropped. The last two replace columns of their names."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    at = names.index(text)
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], doc_key(key).alias("doc"), _part(text).alias("part"))
    both = inner.join(gone, ["doc", "part"], "left").drop("doc", "part")
    fields = [f for f in both.schema.fields if f.name != "hashes"]
    fields[at] = T.StructField(f"c{at}", T.StringType())

    def kept(batches):
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for t, h in zip(b.column(at), b.column(len(names))):
                body = t.as_buffer().to_pybytes() if t.is_valid else b""
                if not h.is_valid:
                    n_lines.append(body.count(b"\n") + 1)
                    n_dropped.append(0)
                    texts.append(body)
                    continue
                gone_ = set(h.as_py())
                lines, keys = _keys(body, min_chars)
                stay = [x for x, k in zip(lines, keys) if k is None or _digest([k]) not in gone_]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                texts.append(b"\n".join(stay))
            columns = list(b.columns[: len(names)])
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[f.name for f in schema])

    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    out = both.mapInArrow(tidied(kept), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_lines", "n_dropped")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """Line dedup of a whole table: the index grows by batches of documents, dealt by a hash of their ids, each of
    which asks the filters of those before; then the index's drops are applied."""
    once = not _repeats(docs, key)
    index = empty(docs.sparkSession)
    batch = F.pmod(F.xxhash64(doc_key(key)), F.lit(batches))
    for i in range(batches):
        index = insert(index, docs.filter(batch == i), key, text, min_chars, new_ids=True, once=once, room=batches)
    return apply(docs, drops(index), key, text, min_chars)
