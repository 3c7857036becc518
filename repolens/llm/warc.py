"""WARC archives: writing, and reading in parts with a verified chain of records.

Writing: every row is a record; of rows with equal payloads of at least ``least`` bytes the one with the
smallest id is a response, the others are revisits of it (a header block without the
payload). Spark's text writer writes the files, a record a row, with the end of a
record as the line separator; plain, or compressed by a codec of Spark's text source, a stream a file.

Reading: Spark splits the archives at the magic that begins a record, wherever it stands. A plain file is
read in blocks by several tasks; one whose codec can't be split, as gzip, is one block, as large as the
partition that wrote it. Places are those in the uncompressed file. What a
task finds are candidates: a true record, or a magic inside a payload. A candidate
names its successor: the place where its header and the stated content length end.
A record is true if the chain from the start of the file reaches it. Tasks follow the
chain within their block and tell where it leaves the block, for every candidate that it
might be entered by; pointer jumping over those exits, which doubles the reach each
round, finds the entries that the file start reaches; the blocks then keep the records on
the chain from their entries. A payload cut at a magic inside it is put together again
from the pieces that its length covers.

Only places, header fields and digests move between tasks; payloads move where they were cut.

Null payloads are empty payloads; null ids are written as such and read as null. Rows with one id and one payload
are records of their own; all rows with the smallest id are responses. Line ends in header
values are percent-encoded. An archive cut off in a record loses that record.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repolens.llm.common import tidied
from repolens.session import cut_lineage

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST = 100
_STEP = len(MAGIC)


def _value(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "\r", "%0D"), "\n", "%0A")


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST) -> DataFrame:
    """(value): the text of one record per row of ``pages``, without the magic's and the end's repetition."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("bytes", F.octet_length("body").cast("long")).withColumn("digest", F.sha2("body", 256))
    firsts = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(firsts.drop("n"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    content = F.when(revisit, F.lit("")).otherwise(F.col("body"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(k + ": "), v, F.lit("\r\n"))
    return rows.select(
        F.concat(
            F.lit(MAGIC),
            line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            line("WARC-Record-ID", name(F.col("id"))),
            F.when(F.col("url").isNotNull(), line("WARC-Target-URI", _value(F.col("url")))).otherwise(""),
            line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            line("X-Payload-Bytes", F.col("bytes").cast("string")),
            F.when(revisit, F.concat(line("WARC-Refers-To", name(F.col("first"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise(""),
            line("Content-Type", F.lit("text/html")),
            line("Content-Length", F.octet_length(content).cast("string")),
            F.lit("\r\n"),
            content,
        ).alias("value")
    )


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST, compression: str = "none") -> None:
    out = records(pages, key, url, payload, least).write.mode("overwrite").option("lineSep", END).option("compression", compression)
    # For gzip and deflate: on pages level 1 takes a fifth of the time of the default and an eighth more bytes.
    out.option("zlib.compress.level", "BEST_SPEED").text(path)


_FIELDS = "type string, id string, uri string, digest string, refers_to string, stated long"
_NAMES = {b"warc-type": 0, b"warc-record-id": 1, b"warc-target-uri": 2, b"warc-payload-digest": 3, b"warc-refers-to": 4, b"x-payload-bytes": 5}


def _header(piece: bytes):
    """(header bytes with the blank line, content length, fields) of a candidate, or None."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    length, fields = None, [None] * 6
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            return None
        if name == b"content-length":
            if not value.isdigit() or len(value) > 18:
                return None
            length = int(value)
        elif name in _NAMES:
            fields[_NAMES[name]] = value.decode("utf-8", "replace")
    if length is None or fields[0] is None:
        return None
    return end + 4, length, fields


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value) of the stretches between magics, in the order of the file within a block."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary"))


def _walk(batches):
    """(file, block, place, piece) of the pieces; place: from the first piece of the block."""
    at, place = None, 0
    for b in batches:
        for file, block, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if (file, block) != at:
                at, place = (file, block), 0
            piece = value.as_buffer().to_pybytes()
            yield file, block, place, piece
            place += len(piece) + _STEP


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per stretch between magics: (file, block, place, size, head, length, whole, sha, fields): head is the
    size of the header, null if none parses; whole tells that the stretch holds the content; sha its digest then."""

    def found(batches):
        out = []
        for file, block, place, piece in _walk(batches):
            h = _header(piece)
            if h is None:
                out.append((file, block, place, len(piece), None, None, False, None, [None] * 6))
            else:
                head, length, fields = h
                whole = len(piece) >= head + length
                sha = hashlib.sha256(memoryview(piece)[head : head + length]).hexdigest() if whole else None
                out.append((file, block, place, len(piece), head, length, whole, sha, fields))
            if len(out) >= 5000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(rows):
        c = list(zip(*rows))
        f = list(zip(*c[8]))
        stated = [int(x) if x is not None and x.isdigit() and len(x) < 19 else None for x in f[5]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), *[pa.string()] * 5, pa.int64()]
        names = ["file", "block", "place", "size", "head", "length", "whole", "sha", "type", "id", "uri", "digest", "refers_to", "stated"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip([*c[:8], *f[:5], stated], kinds)], names=names)

    return _pieces(spark, path).mapInArrow(tidied(found), f"file string, block long, place long, size long, head long, length long, whole boolean, sha string, {_FIELDS}")


def _placed(found: DataFrame) -> DataFrame:
    """The candidates with ``at``: where the magic begins in the file. Blocks of a file, one row each, are added up."""
    blocks = found.groupBy("file", "block").agg(F.sum(F.col("size") + _STEP).alias("bytes"))
    up = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(up), F.lit(0)).alias("base"))
    # The first stretch of a file, before any magic, belongs to no candidate.
    return found.join(bases, ["file", "block"]).withColumn("at", F.col("base") + F.col("place") - _STEP)


def _exits(rows: pa.Table) -> pa.Table:
    """For every candidate of a block, where the chain from it leaves the block."""
    at, next_ = rows["at"].to_numpy(), rows["next"].to_numpy()
    order = np.argsort(at)
    known: dict[int, int] = {}
    for a, n in zip(at[order][::-1].tolist(), next_[order][::-1].tolist()):
        known[a] = known.get(n, n)
    return pa.table({"file": rows["file"], "block": rows["block"], "at": rows["at"], "exit": pa.array([known[a] for a in at.tolist()], pa.int64())})


def _chain(rows: pa.Table, entries: pa.Table) -> pa.Table:
    """The places of the true records of a block, from its entries."""
    next_ = dict(zip(rows["at"].to_pylist(), rows["next"].to_pylist()))
    true = set()
    for a in entries["at"].to_pylist():
        while a in next_ and a not in true:
            true.add(a)
            a = next_[a]
    source = rows if len(rows) else entries
    return pa.table({"file": pa.array([source["file"][0].as_py()] * len(true), pa.string()), "at": pa.array(sorted(true), pa.int64())})


def _entries(exits: DataFrame) -> DataFrame:
    """(file, block, at): where the chains from the starts of the files enter the blocks."""
    step = cut_lineage(exits.select("file", "at", F.col("exit").alias("to")), "warc-steps")
    reached = cut_lineage(exits.groupBy("file").agg(F.lit(0).cast("long").alias("at")), "warc-reached")
    while True:
        ahead = reached.join(step, ["file", "at"]).select("file", F.col("to").alias("at"))
        more = cut_lineage(reached.union(ahead).distinct(), "warc-reached")
        if more.count() == reached.count():
            break
        reached = more
        on = step.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        step = cut_lineage(step.join(on, ["file", "to"], "left").select("file", "at", F.coalesce("further", "to").alias("to")), "warc-steps")
    return reached.join(exits.select("file", "block", "at"), ["file", "at"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per true record: file, at, type, id, uri, digest (as stated), refers_to, payload_bytes and
    payload_digest (of what was read; of a revisit: as stated)."""
    found = cut_lineage(_placed(candidates(spark, path)), "warc-candidates")
    heads = found.filter("head is not null and at >= 0")
    heads = heads.withColumn("next", F.col("at") + _STEP + F.col("head") + F.col("length") + len(END))
    places = heads.select("file", "block", "at", "next")
    exits = cut_lineage(places.groupBy("file", "block").applyInArrow(_exits, "file string, block long, at long, exit long"), "warc-exits")
    entries = _entries(exits)
    true = places.groupBy("file", "block").cogroup(entries.groupBy("file", "block")).applyInArrow(_chain, "file string, at long")
    records_ = cut_lineage(heads.join(true, ["file", "at"], "left_semi"), "warc-records")
    # A record that the file ends in is lost.
    ends = found.groupBy("file").agg(F.max(F.col("at") + _STEP + F.col("size")).alias("file_end"))
    records_ = records_.join(ends, "file").filter(F.col("next") <= F.col("file_end")).drop("file_end")
    cut = records_.filter("not whole")
    if not cut.isEmpty():
        joined = _joined(spark, path, found, cut)
        records_ = records_.join(joined, ["file", "at"], "left").withColumn("sha", F.coalesce("sha", "joined")).drop("joined")
    bare = F.regexp_replace("digest", "^sha256:", "")
    revisit = F.col("type") == "revisit"
    return records_.select(
        "file", "at", "type", "id", "uri", "digest", "refers_to",
        F.when(revisit, F.col("stated")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, bare).otherwise(F.col("sha")).alias("payload_digest"),
    )


def _joined(spark: SparkSession, path: str, found: DataFrame, cut: DataFrame) -> DataFrame:
    """(file, at, joined): digests of the contents that were cut at a magic inside them."""
    spans = cut.select("file", F.col("at").alias("record"), "head", "length", "next")
    # Every piece belongs to the nearest true record before it that was cut, if that covers it.
    parts = found.select("file", "block", "place", "at")
    marks = parts.join(spans.select("file", F.col("record").alias("at"), "record", "head", "length", "next"), ["file", "at"], "left")
    back = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("record").isNotNull(), F.struct("record", "head", "length", "next")), True).over(back)
    covered = marks.withColumn("r", last).filter((F.col("r").isNotNull()) & (F.col("at") < F.col("r.next"))).select("file", "block", "place", "at", "r.record", "r.head", "r.length")

    def raw(batches):
        for file, block, place, piece in _walk(batches):
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([place], pa.int64()), pa.array([piece], pa.binary())], names=["file", "block", "place", "piece"])

    pieces = _pieces(spark, path).mapInArrow(tidied(raw), "file string, block long, place long, piece binary").join(covered, ["file", "block", "place"])

    def together(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["at"].to_numpy())
        whole = MAGIC.encode().join(rows["piece"][int(i)].as_py() for i in order)
        head, length = rows["head"][0].as_py(), rows["length"][0].as_py()
        return pa.table({"file": rows["file"][:1], "at": rows["record"][:1], "joined": pa.array([hashlib.sha256(whole[head : head + length]).hexdigest()])})

    return pieces.groupBy("file", "record").applyInArrow(together, "file string, at long, joined string")


def page_number(record_id: Column) -> Column:
    """The id that a record's name was made of."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")
