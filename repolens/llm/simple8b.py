"""Token ids in Simple-8b files: word-aligned shards in the order of a key.

A shard is a sequence of 64-bit little-endian words, made of groups:

    MAGIC | documents | ids | packed words | blocks
    key of each document | number of ids of each document
    start word of each block | packed words
    end marker (the 8 bytes that Spark's text writer puts after a row)

A group like this holds some consecutive documents; a shard file has one or
more. Packed words follow Simple-8b: the top 4 bits select how many ids of
what width share the other 60 bits. Selector 15 is the escape: the next word
is an id of more than 60 bits, raw. Ids are packed in blocks of ``BLOCK``, whose
start words are listed, so that a reader takes all blocks at once, or any
block alone.

Files are written by Spark's text writer (one binary row per group, the end
marker as the line separator), hence by its commit protocol: a lost task
leaves nothing behind. They are read by the binaryFile source, one shard a row;
the writer bounds a shard by the number of ranges of the key.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm import pretokens as P
from repolens.llm.bpe import _flat
from repolens.llm.common import coded, list_array, row_groups, take_slices, text_bytes, text_parts, tidied
from repolens.llm.subwords import ByteLevel, Remembered
from repolens.session import cut_lineage

MAGIC = 0x0031303842504D53
MARKER = "S8B-END\n"
BLOCK = 4096
SHARD_BYTES = 16 << 20
NO_KEY = -(1 << 63)
#: Ids in a word and bits of an id, by selector. Fixed values of Simple-8b (60 payload bits).
COUNT = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTH = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
_LIMIT = (np.uint64(1) << WIDTH.astype(np.uint64)) - np.uint64(1)
#: The narrowest selector for small ids.
_NEEDED = np.searchsorted(_LIMIT, np.arange(1 << 16, dtype=np.uint64)).astype(np.int8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, start word of each block) of unsigned 64-bit ids."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.arange(0, n, BLOCK)  # id of each block
    # The narrowest selector whose ids all fit, from the width that each id needs: a
    # running maximum over windows of growing length. Behind a block's end zeros count.
    rows = -(-n // BLOCK)
    need = np.zeros((rows, BLOCK + 60), np.int8)
    flat = np.zeros(rows * BLOCK, np.int8)
    flat[:n] = _NEEDED[ids] if ids.max() < len(_NEEDED) else np.searchsorted(_LIMIT, ids)  # 14: more than 60 bits
    need[:, :BLOCK] = flat.reshape(rows, BLOCK)
    best = np.full((rows, BLOCK), 14, np.int8)
    have = 1
    for s in range(13, -1, -1):
        while have < COUNT[s]:
            step = min(have, int(COUNT[s]) - have)
            np.maximum(need[:, :-step], need[:, step:], out=need[:, :-step])
            have += step
        best[need[:, :BLOCK] <= s] = s
    best = best.reshape(-1)[:n]
    # Where the word that begins at an id ends; followed from all blocks at once by doubling.
    block_end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    jump = np.append(np.minimum(np.arange(n) + np.append(COUNT, 1)[best], block_end), n)
    begins = np.zeros(n + 1, bool)
    reached = first
    while True:
        begins[reached] = True
        after = jump.take(reached)
        if begins[after[after < n]].all():
            break
        reached, jump = np.concatenate([reached, after]), jump.take(jump)
    begin = np.flatnonzero(begins[:n])
    sel = best[begin].astype(np.int64)
    # Each id, moved to its place in its word; the ids of a word share no bit, so their sum is the word.
    shift = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    shift *= np.repeat(np.append(WIDTH, 0)[sel], np.diff(np.append(begin, n)))
    word = np.add.reduceat(ids << shift.astype(np.uint64), begin) | sel.astype(np.uint64) << np.uint64(60)
    escapes = sel == 14
    word[escapes] = np.uint64(ESCAPE) << np.uint64(60)
    place = np.arange(len(begin)) + np.cumsum(escapes) - escapes
    out = np.zeros(len(begin) + int(escapes.sum()), np.uint64)
    out[place] = word
    out[place[escapes] + 1] = ids[begin[escapes]]
    return out, place[np.searchsorted(begin, first)]


def unpack(words: np.ndarray, blocks: np.ndarray, n: int) -> np.ndarray:
    """The n ids in ``words``; blocks: the start word of each block."""
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    maybe = np.flatnonzero(sel == ESCAPE)
    for i in maybe.tolist():  # a raw word may look like an escape
        raw[i + 1 if not raw[i] else i] |= not raw[i]
    heads = np.flatnonzero(~raw)
    kind = sel[heads]
    count = np.append(COUNT, [1, 1])[kind]
    # A block's last word may hold fewer ids than its selector says.
    block = np.searchsorted(blocks, heads, "right") - 1
    before = np.cumsum(count) - count
    first = np.searchsorted(heads, blocks)
    start = before - before[first][block] + block * BLOCK
    count = np.minimum(count, np.minimum((block + 1) * BLOCK, n) - start)
    out = np.zeros(n, np.uint64)
    for s in range(14):
        rows = np.flatnonzero(kind == s)
        mask = _LIMIT[s]
        for k in range(COUNT[s] if len(rows) else 0):
            some = rows[k < count[rows]]
            out[start[some] + k] = (words[heads[some]] >> np.uint64(k * WIDTH[s])) & mask
    rows = np.flatnonzero(kind == ESCAPE)
    out[start[rows]] = words[heads[rows] + 1]
    return out


def group_bytes(keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    words, blocks = pack(ids)
    head = np.array([MAGIC, len(keys), len(ids), len(words), len(blocks)], "<i8")
    return b"".join(x.astype(t).tobytes() for x, t in ((head, "<i8"), (keys, "<i8"), (sizes, "<i8"), (blocks, "<i8"), (words, "<u8")))


def read_groups(content: bytes):
    """(keys, sizes, ids) of each group of a shard file."""
    at = 0
    while at < len(content):
        magic, docs, n, words, blocks = np.frombuffer(content, "<i8", 5, at).tolist()
        if magic != MAGIC:
            raise ValueError("no group begins here")
        at += 40
        part = []
        for kind, size in (("<i8", docs), ("<i8", docs), ("<i8", blocks), ("<u8", words)):
            part.append(np.frombuffer(content, kind, size, at))
            at += 8 * size
        if content[at : at + 8] != MARKER.encode():
            raise ValueError("a group is cut off")
        at += 8
        yield part[0], part[1], unpack(part[3], part[2], n)


def write(df: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> None:
    """Write the lists ``ids`` of each partition of ``df``, in its order, as a shard file.
    A null list is empty; a null key is written as the smallest integer."""

    def groups(batches):
        for b in batches:
            keys = b.column(0).fill_null(NO_KEY).to_numpy(zero_copy_only=False)
            values, offsets = _flat(b.column(1))
            for i, j in row_groups(offsets, 1 << 18):
                body = group_bytes(keys[i:j], np.diff(offsets[i : j + 1]), values[offsets[i] : offsets[j]])
                yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["value"])

    rows = df.select(F.col(key).cast("long"), F.col(ids)).mapInArrow(tidied(groups), "value binary")
    rows.select(F.col("value").cast("string")).write.mode("overwrite").option("lineSep", MARKER).text(path)


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read(spark, path: str) -> DataFrame:
    """(shard, place, doc_id, ids) of all documents of the files in ``path``;
    place: of the document in its shard."""

    def documents(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                place = 0
                for keys, sizes, ids in read_groups(content.as_py()):
                    lists = list_array(ids.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys)), pa.array(np.arange(place, place + len(keys))), pa.array(keys, mask=keys == NO_KEY), lists],
                        names=["shard", "place", "doc_id", "ids"],
                    )
                    place += len(keys)

    return _files(spark, path).mapInArrow(tidied(documents), "shard string, place long, doc_id long, ids array<long>")


def index(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of the
    ids as little-endian unsigned 32-bit integers) of all documents of the files in ``path``.

    Reading a shard gives places within it; the shards' totals, one row a
    shard, are added up in the order of their first keys."""

    def entries(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                before, place = 0, 0
                for keys, sizes, ids in read_groups(content.as_py()):
                    ends = np.cumsum(sizes)
                    raw = memoryview(ids.astype("<u4").tobytes())
                    crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys)), pa.array(np.arange(place, place + len(keys))), pa.array(keys, mask=keys == NO_KEY), pa.array(before + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                        names=["shard", "place", "doc_id", "inner", "n_tokens", "ids_crc32"],
                    )
                    before, place = before + len(ids), place + len(keys)

    found = cut_lineage(_files(spark, path).mapInArrow(tidied(entries), "shard string, place long, doc_id long, inner long, n_tokens long, ids_crc32 long"), "simple8b-index")
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("total"), F.min_by("doc_id", "place").alias("first"))
    before = Window.orderBy(F.col("first").asc_nulls_first(), "shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return found.join(bases, "shard").select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


_ENCODERS: dict = {}


def _encoder(path: str, content: str) -> Remembered:
    """The tokenizer's encoder of words with what it knows already; kept for the life of a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Remembered(ByteLevel(content))
    return _ENCODERS[path]


def _added(content: str) -> dict[bytes, int]:
    """The strings of a tokenizer's added tokens and their ids, longest first."""
    tokens = json.loads(content)["added_tokens"]
    if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take other text with them")
    return {t["content"].encode(): t["id"] for t in sorted(tokens, key=lambda t: -len(t["content"].encode()))}


def _bounds(data: np.ndarray, offsets: np.ndarray, added: dict[bytes, int]) -> np.ndarray:
    """Bounds of the words: added tokens, leftmost and longest first, and pre-tokens of the text between."""
    whole = data.tobytes() if added else b""
    found = []
    if any(t in whole for t in added):
        either = re.compile(b"|".join(map(re.escape, added)))
        found = [m.span() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for m in either.finditer(whole, x, y)]
    if not found:
        return P.token_bounds(data, offsets, P.classes())
    first, last = (np.array(x) for x in zip(*found))
    bounds = P.token_bounds(data, np.unique(np.concatenate([offsets, first, last])), P.classes())
    at = np.searchsorted(first, bounds, "right") - 1
    return bounds[(at < 0) | (bounds == first[at]) | (bounds >= last[at])]


def tokenise(df: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids", end_id: int | None = 0, added: bool = False) -> DataFrame:
    """``df`` without ``text``, with the ids that the tokenizers library gives each whole
    text without special tokens around it, and ``end_id`` after them. The library encodes
    each distinct word of a batch once, and remembers words of batches before. The string of an added token
    in a text is that token if ``added`` (the library's default), else ordinary text. Null: an empty text."""
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    tokens = _added(content) if added else {}
    shared = df.sparkSession.sparkContext.broadcast(content)
    at = df.columns.index(text)
    others = [i for i, c in enumerate(df.columns) if c not in (text, ids)]
    schema = T.StructType([*(df.schema.fields[i] for i in others), T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def encoded(batches):
        encoder = _encoder(tokenizer_path, shared.value)
        for batch in batches:
            _, bounds = text_parts(batch.column(at))
            for i, j in row_groups(bounds, 8 << 20):
                b = batch.slice(i, j - i)
                data, offsets = text_parts(b.column(at))
                cut = _bounds(data, offsets, tokens)
                place, distinct = coded(data, cut)
                flat, length = encoder.encode(distinct, tokens)
                begin = np.cumsum(length) - length
                bound = np.searchsorted(cut[:-1], offsets)
                total = np.concatenate([[0], np.cumsum(length[place])])
                n_end = int(end_id is not None)
                out = np.empty(int(total[-1]) + n_end * (j - i), np.int32)
                rows = total[bound] + n_end * np.arange(j - i + 1)
                for x, y in row_groups(rows, 1 << 18):
                    p = place[bound[x] : bound[y]]
                    v = take_slices(flat, begin[p], length[p])
                    part = out[rows[x] : rows[y]]
                    if n_end:
                        last = np.zeros(len(part), bool)
                        last[rows[x + 1 : y + 1] - 1 - rows[x]] = True
                        part[last], part[~last] = end_id, v
                    else:
                        part[:] = v
                lists = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(out))
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in others), lists], names=[f.name for f in schema])

    return df.mapInArrow(tidied(encoded), schema)


def write_documents(docs: DataFrame, tokenizer_path: str, path: str, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES, added: bool = False) -> None:
    """Tokenise whole texts and write their ids as shards in ascending order of ``key``.
    Spark deals the texts into ranges of the key; each range is sorted, tokenised and
    written by one task. Rows of one key are sorted by a hash of the text; null keys come first."""
    n = max(1, -(-text_bytes(docs, text) // shard_bytes))
    dealt = docs.select(F.col(key).cast("long").alias(key), text).repartitionByRange(n, key).sortWithinPartitions(key, F.xxhash64(text))
    write(tokenise(dealt, tokenizer_path, text, added=added), path, key=key)
