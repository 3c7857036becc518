"""Byte-level BPE encoding and decoding of whole texts.

Encoding shuffles the distinct words of the corpus: texts are dealt into chunks of
bounded size, each chunk lists its distinct pre-tokens by buckets of
their hash, each bucket encodes a word once whatever number of chunks sent it, and
the ids go back to the chunks, which put them in the places of the words.
Equal rows of a task are dealt to other chunks after every ``COPIES``, so no text fills one. Words are
told apart by their bytes; hashes only deal and order them.
The positions never move: a chunk finds them again from its own texts. A word
that fills a third of the corpus costs one entry per chunk.

Decoding joins the ids with the token-byte table, which is as large as the
vocabulary (50,256 tokens, 835 kB) and therefore broadcast.

A null text is an empty text with no ids. Rows may repeat; every row
gets its ids. Other columns pass through, whatever their names, but for the
names of the columns added.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm import pretokens as P
from repolens.llm.common import coded, list_array, mix64, row_groups, take_slices, text_bytes, text_parts, tidy

#: Bytes of text in a chunk, chunks for each bucket of words, and equal rows that stay together.
CHUNK_BYTES = 8 << 20
CHUNKS_A_BUCKET = 2
COPIES = 64
_ENCODER: dict = {}


def _encoder(ranks: dict[bytes, int], key: str):
    """An encoder of single words, kept for the life of a Python worker."""
    if key not in _ENCODER:
        import tiktoken

        _ENCODER[key] = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    return _ENCODER[key]


def _packed(texts: np.ndarray, start: np.ndarray, length: np.ndarray) -> bytes:
    import zstandard

    body = length.astype("<u4").tobytes() + take_slices(texts, start, length).tobytes()
    return zstandard.compress(len(length).to_bytes(4, "little") + body, 3)


def _unpacked(blob: bytes) -> tuple[np.ndarray, bytes]:
    """Lengths and what follows them."""
    import zstandard

    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw, "<u4", n, 4), raw[4 + 4 * n :]


def _inflated(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of compressed texts, and their bounds."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    texts = [unpack(x.as_buffer()) if x.is_valid else b"" for x in column]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def encode(df: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", chunk_bytes: int = CHUNK_BYTES, keep_text: bool = True) -> DataFrame:
    """``df`` with the column ``ids`` (array of integers), without ``text`` if not ``keep_text``."""
    spark = df.sparkSession
    ranks = spark.sparkContext.broadcast(P.read_ranks(ranks_path))
    n_chunks = max(1, -(-text_bytes(df, text) // chunk_bytes))
    bits = max(4, (n_chunks // CHUNKS_A_BUCKET).bit_length())
    names = df.columns
    keep = [i for i, c in enumerate(names) if c != ids and (keep_text or c != text)]
    # Columns by number, so that no name clashes.
    inner = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if i in keep], F.col(f"`{text}`").cast("string").alias("body"))
    fields = [inner.schema[f"c{i}"] for i in keep]
    mark = F.xxhash64(F.col("body"), *[F.col(f"c{i}") for i in keep if not isinstance(inner.schema[f"c{i}"].dataType, T.MapType)])
    kept = T.StructType([T.StructField("chunk", T.LongType()), *fields, T.StructField("body", T.BinaryType())])

    def deflate(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(1).compress
        seen: dict[int, int] = {}
        own = np.uint64(TaskContext.get().partitionId() + 1) * np.uint64(0x9E3779B97F4A7C15)
        for b in batches:
            marks = b.column(0).to_pylist()
            copy = []
            for m in marks:
                seen[m] = seen.get(m, -1) + 1
                copy.append(seen[m])
            deal = mix64(np.array(marks, np.int64).view(np.uint64) ^ mix64(own + np.array(copy, np.uint64) // np.uint64(COPIES))) % np.uint64(n_chunks)
            columns = [b.column(i) for i in range(1, b.num_columns - 1)]
            bodies = pa.array([pack(x.as_py().encode()) if x.is_valid else None for x in b.column(b.num_columns - 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(deal.astype(np.int64)), *columns, bodies], names=kept.names)

    dealt = inner.select(mark.alias("mark"), "*").mapInArrow(deflate, kept).repartition("chunk")

    def words(table: pa.Table) -> pa.Table:
        data, offsets = _inflated(table["body"])
        _, distinct = coded(data, P.token_bounds(data, offsets, P.classes()))
        del data, offsets
        order, hashes = P.by_hash(distinct)
        body, at = text_parts(distinct)
        start, size = at[:-1][order], np.diff(at)[order]
        # Only buckets that have words: at most as many as there are words, however many buckets.
        buckets, cut = np.unique(hashes >> np.uint64(64 - bits), return_index=True)
        chunk = table["chunk"][0].as_py()
        blobs = [(b, _packed(body, start[i:j], size[i:j])) for b, i, j in zip(buckets.tolist(), cut.tolist(), [*cut[1:].tolist(), len(order)])]
        tidy()
        return pa.table({"chunk": pa.array([chunk] * len(blobs), pa.int64()), "bucket": pa.array([b for b, _ in blobs], pa.int64()), "words": pa.array([x for _, x in blobs], pa.binary())})

    def encoded(table: pa.Table) -> pa.Table:
        import zstandard

        encoder, known, out = _encoder(ranks.value, ranks_path), {}, []
        for blob in table["words"]:
            length, body = _unpacked(blob.as_py())
            ends = np.cumsum(length.astype(np.int64)).tolist()
            got = []
            for a, b in zip([0, *ends], ends):
                w = body[a:b]
                if (x := known.get(w)) is None:
                    x = known[w] = np.array(encoder.encode_ordinary(w.decode()), "<u4").tobytes()
                got.append(x)
            counts = np.array([len(x) // 4 for x in got], "<u4")
            out.append(zstandard.compress(len(got).to_bytes(4, "little") + counts.tobytes() + b"".join(got), 3))
        known.clear()
        tidy()
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "ids": pa.array(out, pa.binary())})

    def reassembled(texts: pa.Table, parts: pa.Table) -> pa.Table:
        data, offsets = _inflated(texts["body"])
        cut = P.token_bounds(data, offsets, P.classes())
        bounds = np.searchsorted(cut[:-1], offsets)
        code, distinct = coded(data, cut)
        order, _ = P.by_hash(distinct)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        place = rank[code]
        del code, distinct, cut, data
        order = np.argsort(parts["bucket"].to_numpy()) if len(parts) else []
        got = [_unpacked(parts["ids"][int(i)].as_py()) for i in order]
        length = np.concatenate([x for x, _ in got]).astype(np.int64) if got else np.zeros(0, np.int64)
        flat = np.frombuffer(b"".join(x for _, x in got), "<u4").astype(np.int32)
        first = np.cumsum(length) - length
        total = np.concatenate([[0], np.cumsum(length[place])])
        out = np.empty(int(total[-1]), np.int32)
        for a in range(0, len(place), 1 << 18):
            p = place[a : a + (1 << 18)]
            out[total[a] : total[a + len(p)]] = take_slices(flat, first[p], length[p])
        columns = [texts[f.name].combine_chunks() for f in fields]
        del got, flat, place
        tidy()
        return pa.Table.from_arrays([*columns, list_array(out, total[bounds], pa.int32())], names=[*(f.name for f in fields), "ids"])

    parts = dealt.groupBy("chunk").applyInArrow(words, "chunk long, bucket long, words binary")
    parts = parts.groupBy("bucket").applyInArrow(encoded, "chunk long, bucket long, ids binary")
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = dealt.groupBy("chunk").cogroup(parts.groupBy("chunk")).applyInArrow(reassembled, schema)
    return out.select(*[F.col(f"c{i}").alias(names[i]) for i in keep], F.col("ids").alias(ids))


def token_bytes(ranks_path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all bytes in the order of the ids, and bounds."""
    ranks = P.read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])])


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded", digest: str | None = None) -> DataFrame:
    """``df`` with the column ``decoded``: the bytes of the tokens of ``ids``; and, if it is named,
    the column ``digest``: lower-case hex SHA-256 of the ids as little-endian unsigned
    32-bit integers. A null list gives null, an empty one no bytes; an id outside the table
    fails the job."""
    table = df.sparkSession.sparkContext.broadcast(token_bytes(ranks_path))
    at = df.columns.index(ids)
    added = [T.StructField(decoded, T.BinaryType())] + ([T.StructField(digest, T.StringType())] if digest else [])
    schema = T.StructType([*df.schema.fields, *added])

    def joined(batches):
        data, bounds = table.value
        size = np.diff(bounds)
        for b in batches:
            lists = b.column(at)
            values, offsets = _flat(lists)
            out, digests = [], []
            for i, j in row_groups(offsets, 1 << 18):
                v = values[offsets[i] : offsets[j]]
                if len(v) and (v.min() < 0 or v.max() >= len(size)):
                    raise ValueError("an id is outside the token-byte table")
                text = take_slices(data, bounds[v], size[v]).tobytes()
                ends = np.concatenate([[0], np.cumsum(size[v])])[offsets[i : j + 1] - offsets[i]]
                out += [text[x:y] for x, y in zip(ends[:-1], ends[1:])]
                if digest:
                    raw, at_ = memoryview(v.astype("<u4").tobytes()), (offsets[i : j + 1] - offsets[i]) * 4
                    digests += [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(at_[:-1].tolist(), at_[1:].tolist())]
            nulls = lists.is_null().to_pylist() if lists.null_count else [False] * len(lists)
            found = [(out, pa.binary()), (digests, pa.string())][: len(added)]
            columns = [pa.array([None if n else x for n, x in zip(nulls, c)], t) for c, t in found]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[f.name for f in schema])
            tidy()

    return df.mapInArrow(joined, schema)


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the bounds of its rows in them."""
    lists = lists.fill_null([]) if lists.null_count else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]
