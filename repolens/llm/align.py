"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes: A, a byte-level BPE of the tokenizers library, is given each text behind a space;
B, a BPE of the sentencepiece library, puts that space itself. Bytes where tokens of both end cut a text into groups;
the two tokens that end there are linked.

A task numbers its documents in blocks of bounded size and inverts them: for each pair of ids that is
linked in a block, the compressed bitmap of the documents that hold it, and planes for what
they hold it more than once: plane k has the documents whose further links have bit k. A bitmap is a list of 16-bit
places (even length) or, where that is longer, one bit a document (odd length). A block is written once it is full, so a
pair has at most one row a block, whatever its frequency; blocks hold different documents, so the OR of a
pair's bitmaps is their union side by side, and popcounts add up: Spark sums them by pair. The
sums, joined with the postings, go back to the blocks, and each posting adds its pair's score to its documents.

Nulls and texts: a null or empty text, and one whose tokens don't give its bytes back, has no tokens: zeros, and an empty
digest. Rows may repeat; every row is a document of its own. Other columns pass through whatever their names, but for the
names of the columns added. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm import pretokens as P
from repolens.llm.common import coded, row_groups, take_slices, text_parts, tidy
from repolens.llm.subwords import ByteLevel, Pieces, Remembered
from repolens.session import cut_lineage

#: Bytes of text worked on at once, and bytes of text and documents in a block.
SLICE_BYTES, BLOCK_BYTES, BLOCK_DOCUMENTS = 2 << 20, 8 << 20, 1 << 16
#: Words that a worker remembers of each of two generations, for each tokenizer.
KNOWN_WORDS = 50_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_ENCODERS: dict = {}


def _encoders(key: tuple[str, str], a: str, b: bytes) -> tuple[Remembered, Remembered]:
    """Both encoders, kept for the life of a Python worker."""
    if key not in _ENCODERS:
        _ENCODERS[key] = Remembered(ByteLevel(a), KNOWN_WORDS), Remembered(Pieces(b), KNOWN_WORDS)
    return _ENCODERS[key]


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that are not empty, each behind a space, and their bounds."""
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    bounds = np.concatenate([[0], np.cumsum(size[some] + 1)]).astype(np.int64)
    out = np.full(int(bounds[-1]), 32, np.uint8)
    inner = np.ones(len(out), bool)
    inner[bounds[:-1]] = False
    out[inner] = data
    return out, bounds


def _placed(ids: np.ndarray, counts: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The ids of the distinct words, put in the places of the words."""
    first = np.cumsum(counts) - counts
    return take_slices(ids, first[word], counts[word])


def _numerals(top: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal numerals of 0 to ``top`` and a place for what follows each."""
    words = [b"%d," % i for i in range(top + 1)]
    return np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])])


def aligned(data: np.ndarray, offsets: np.ndarray, a_words: Remembered, b_words: Remembered, numerals: tuple[np.ndarray, np.ndarray]) -> tuple[dict, tuple]:
    """The digest columns of each text, and (A id, B id, text) of each link."""
    n, a, b = len(offsets) - 1, a_words.encoder, b_words.encoder
    rows = np.flatnonzero(np.diff(offsets))
    spaced, bounds = _spaced(data, offsets)
    out = {c: np.zeros(n, np.int64) for c in COUNTS}
    digests = np.full(n, "", object)
    # B first: its tokens say which texts come back whole.
    cut = b.words(spaced, bounds)
    word, distinct = coded(spaced, cut)
    ids, counts = b_words.encode(distinct)
    body, at = text_parts(distinct)
    fine = b.exact(body, ids, counts, np.diff(at))
    owner = np.searchsorted(bounds, cut[:-1], "right") - 1
    whole = np.ones(len(rows), bool)
    whole[owner[~fine[word]]] = False
    b_ids = _placed(ids, counts, word[whole[owner]])
    cut = P.token_bounds(spaced, bounds, P.classes())
    word, distinct = coded(spaced, cut)
    ids, counts = a_words.encode(distinct)
    owner = np.searchsorted(bounds, cut[:-1], "right") - 1
    a_ids = _placed(ids, counts, word[whole[owner]])
    rows = rows[whole]
    if not len(rows):
        return {**out, "groups_sha256": digests}, (np.zeros(0, np.int64),) * 3
    ends = np.cumsum(np.diff(bounds)[whole])  # of the texts, side by side
    a_end, b_end = np.cumsum(a.size[a_ids]), np.cumsum(b.size[b_ids])
    a_last = b_end[np.searchsorted(b_end, a_end)] == a_end
    b_last = a_end[np.searchsorted(a_end, b_end)] == b_end
    a_row, b_row = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
    out["n_a"][rows], out["n_b"][rows] = np.bincount(a_row, minlength=len(rows)), np.bincount(b_row, minlength=len(rows))
    link_row = a_row[a_last]
    out["n_groups"][rows] = out["n_links"][rows] = np.bincount(link_row, minlength=len(rows))
    # All tokens in the order of the digest: A's of a group, then B's.
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    a_upto, b_upto = np.cumsum(np.bincount(a_group)), np.cumsum(np.bincount(b_group))
    a_place = np.arange(len(a_ids)) + np.concatenate([[0], b_upto])[a_group]
    b_place = np.arange(len(b_ids)) + a_upto[b_group]
    every = np.empty(len(a_ids) + len(b_ids), np.int64)
    every[a_place], every[b_place] = a_ids, b_ids
    digits, bound = numerals
    size = np.diff(bound)[every]
    line = take_slices(digits, bound[:-1][every], size)
    stop = np.cumsum(size)
    line[stop[a_place[a_last]] - 1] = ord("|")
    line[stop[b_place[b_last]] - 1] = ord(";")
    raw = memoryview(line.tobytes())
    tokens = np.cumsum(np.bincount(a_row, minlength=len(rows)) + np.bincount(b_row, minlength=len(rows)))
    to = stop[tokens - 1].tolist()
    digests[rows] = [hashlib.sha256(raw[x : y - 1]).hexdigest() for x, y in zip([0, *to], to)]
    return {**out, "groups_sha256": digests}, (a_ids[a_last], b_ids[b_last], rows[link_row])


def _bitmaps(group: np.ndarray, place: np.ndarray, n_groups: int, n_places: int) -> tuple[np.ndarray, np.ndarray]:
    """Compressed bitmaps of the places of each group (both ascending): bytes and bounds. A group without places
    has an empty one."""
    count = np.bincount(group, minlength=n_groups)
    full = (n_places + 7) // 8 | 1
    dense = 2 * count > full
    size = np.where(dense, full, 2 * count)
    bounds = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(int(bounds[-1]), np.uint8)
    bits = np.zeros((int(dense.sum()), 8 * full), bool)
    of_dense = dense[group]
    bits[(np.cumsum(dense) - 1)[group[of_dense]], place[of_dense]] = True
    in_dense = np.repeat(dense, size)
    out[in_dense] = np.packbits(bits, axis=1, bitorder="little").reshape(-1)
    out[~in_dense] = place[~of_dense].astype("<u2").view(np.uint8)
    return out, bounds


def postings(key: np.ndarray, place: np.ndarray, n_places: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Links (key of the pair, place of the document) inverted: (distinct keys, document bitmaps, planes)."""
    both, times = np.unique(key * BLOCK_DOCUMENTS + place, return_counts=True)
    more = times - 1  # further links of the pair in the document
    pairs, group = np.unique(both // BLOCK_DOCUMENTS, return_inverse=True)
    place = both % BLOCK_DOCUMENTS
    data, bounds = _bitmaps(group, place, len(pairs), n_places)
    docs = _binary(data, bounds)
    parts, owner = [], []
    for k in range(int(more.max(initial=0)).bit_length()):
        some = (more >> k) & 1 == 1
        parts.append(_bitmaps(group[some], place[some], len(pairs), n_places))
        owner.append(np.where(more_bits(more, group, len(pairs)) > k)[0])
    if not parts:
        return pairs, docs, pa.ListArray.from_arrays(pa.array(np.zeros(len(pairs) + 1, np.int32)), pa.array([], pa.binary()))
    # Planes of a pair stand together, from plane 0 to its highest.
    start = np.concatenate([b[:-1][o] + base for (_, b), o, base in zip(parts, owner, np.cumsum([0, *(len(d) for d, _ in parts)]))])
    size = np.concatenate([np.diff(b)[o] for (_, b), o in zip(parts, owner)])
    plane = np.repeat(np.arange(len(parts)), [len(o) for o in owner])
    pair = np.concatenate(owner)
    order = np.lexsort((plane, pair))
    data = take_slices(np.concatenate([d for d, _ in parts]), start[order], size[order])
    flat = _binary(data, np.concatenate([[0], np.cumsum(size[order])]))
    lists = np.concatenate([[0], np.cumsum(np.bincount(pair, minlength=len(pairs)))]).astype(np.int32)
    return pairs, docs, pa.ListArray.from_arrays(pa.array(lists), flat)


def more_bits(more: np.ndarray, group: np.ndarray, n_groups: int) -> np.ndarray:
    """Planes that each group needs."""
    top = np.zeros(n_groups, np.int64)
    np.maximum.at(top, group, more)
    return np.frexp(top.astype(np.float64))[1]


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _members(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of the bitmap, place) of all members of binary bitmaps."""
    data, bounds = text_parts(bitmaps)
    size = np.diff(bounds)
    lists = size % 2 == 0
    place = take_slices(data, bounds[:-1][lists], size[lists]).view("<u2").astype(np.int64)
    of = np.repeat(np.flatnonzero(lists), size[lists] // 2)
    if lists.all():
        return of, place
    dense = np.flatnonzero(~lists)
    bits = np.unpackbits(take_slices(data, bounds[:-1][dense], size[dense]), bitorder="little")
    on = np.flatnonzero(bits)  # one block's full bitmaps have one length
    return np.concatenate([of, dense[on // (8 * size[dense[0]])]]), np.concatenate([place, on % (8 * size[dense[0]])])


def invert(df: DataFrame, a_path: str, b_path: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents and postings in one table, written once: rows with ``place`` are documents (other columns as c0, c1 ...,
    and the digest columns), rows with ``a`` are postings (a, b, block, docs, planes)."""
    at = df.columns.index(text)
    others = [i for i, c in enumerate(df.columns) if i != at]
    inner = df.select(*[F.col(f"`{df.columns[i]}`").alias(f"c{i}") for i in others], F.col(f"`{text}`").cast("string").alias("body"))
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        shared = df.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    own = inner.schema.fields[:-1]
    own = [T.StructField(f.name, f.dataType, True) for f in own]
    added = [T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("groups_sha256", T.StringType())]
    pair = [T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("docs", T.BinaryType()), T.StructField("planes", T.ArrayType(T.BinaryType()))]
    schema = T.StructType([*own, *added, *pair])

    def rows(batches: Iterable[pa.RecordBatch]):
        a_words, b_words = _encoders((a_path, b_path), *shared.value)
        a, b = a_words.encoder, b_words.encoder
        numerals = _numerals(max(len(a.size), len(b.size)))
        block, held, links, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def filled(columns: dict, n: int, of: pa.Schema) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in of], schema=of)

        def closed(of: pa.Schema):
            key, place = (np.concatenate(x) for x in zip(*links))
            pairs, docs, planes = postings(key, place, held)
            for i in range(0, len(pairs), 1 << 16):
                j = min(i + (1 << 16), len(pairs))
                yield filled({"block": pa.array(np.full(j - i, block)), "a": pa.array((pairs[i:j] // len(b.size)).astype(np.int32)), "b": pa.array((pairs[i:j] % len(b.size)).astype(np.int32)), "docs": docs.slice(i, j - i), "planes": planes.slice(i, j - i)}, j - i, of)

        of = None
        for batch in batches:
            if of is None:
                of = pa.schema([*(pa.field(f.name, batch.schema.field(f.name).type) for f in own), ("block", pa.int64()), ("place", pa.int32()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.binary()), ("planes", pa.list_(pa.binary()))])
            _, bounds = text_parts(batch.column(len(others)))
            for i, j in row_groups(bounds, SLICE_BYTES):
                for x in range(i, j, BLOCK_DOCUMENTS):
                    part = batch.slice(x, min(j, x + BLOCK_DOCUMENTS) - x)
                    n, nbytes = part.num_rows, int(bounds[x + part.num_rows] - bounds[x])
                    if held and (held + n > BLOCK_DOCUMENTS or size + nbytes > block_bytes):
                        yield from closed(of)
                        block, held, links, size = block + 1, 0, [], 0
                    digest, (la, lb, row) = aligned(*text_parts(part.column(len(others))), a_words, b_words, numerals)
                    columns = {f.name: part.column(k) for k, f in enumerate(own)} | {c: pa.array(digest[c], pa.int64()) for c in COUNTS}
                    columns |= {"block": pa.array(np.full(n, block)), "place": pa.array(np.arange(held, held + n), pa.int32()), "groups_sha256": pa.array(digest["groups_sha256"].tolist(), pa.string())}
                    links.append((la * len(b.size) + lb, row + held))
                    held, size = held + n, size + nbytes
                    yield filled(columns, n, of)
                    tidy()
        if held:
            yield from closed(of)

    return cut_lineage(inner.mapInArrow(rows, schema), "align-inverted")


def popcount(bitmap: Column) -> Column:
    """Members of a compressed bitmap."""
    return F.when(F.octet_length(bitmap) % 2 == 0, (F.octet_length(bitmap) / 2).cast("long")).otherwise(F.bitmap_count(bitmap))


def pair_counts(inverted: DataFrame) -> DataFrame:
    """(a, b, n_documents, count, best) of every linked pair, count: its links in the corpus; best: no
    other A id has more links with this B id. Written once."""
    further = F.aggregate(F.transform("planes", lambda p, k: F.call_function("shiftleft", popcount(p), k)), F.lit(0).cast("long"), lambda x, y: x + y)
    found = inverted.filter("a is not null").select("a", "b", popcount(F.col("docs")).alias("n"), further.alias("m"))
    counts = cut_lineage(found.groupBy("a", "b").agg(F.sum("n").alias("n_documents"), F.sum(F.col("n") + F.col("m")).alias("count")), "align-counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("a", "b", "n_documents", "count", (F.col("count") == F.col("top")).alias("best"))


def scored(inverted: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents with ``n_best`` and ``count_sum``, which the postings give back."""
    documents = inverted.filter("place is not null").drop("a", "b", "docs", "planes")
    back = inverted.filter("a is not null").select(F.col("block").alias("home"), "a", "b", "docs", "planes")
    back = back.join(pairs.select("a", "b", "count", "best"), ["a", "b"]).select("home", "docs", "planes", "count", "best")
    schema = T.StructType([*documents.schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def total(docs: pa.Table, found: pa.Table) -> pa.Table:
        place = docs["place"].to_numpy()
        n = int(place.max()) + 1 if len(place) else 0
        best, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for part in found.to_batches(max_chunksize=1 << 15):
            count, is_best = part.column(3).to_numpy(), part.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = part.column(2)
            flat = lists.flatten()
            per = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(per)), per)
            plane = np.arange(len(flat)) - np.repeat(np.cumsum(per) - per, per)
            for bitmaps, row, weight in ((part.column(1), np.arange(len(per)), np.ones(len(per), np.int64)), (flat, owner, np.int64(1) << plane.astype(np.int64))):
                of, at = _members(bitmaps)
                np.add.at(sums, at, weight[of] * count[row[of]])
                np.add.at(best, at, weight[of] * is_best[row[of]])
        tidy()
        out = docs.append_column("n_best", pa.array(best[place], pa.int64()))
        return out.append_column("count_sum", pa.array(sums[place], pa.int64()))

    return documents.groupBy("block").cogroup(back.groupBy("home")).applyInArrow(total, schema)


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    inverted = invert(df, a_path, b_path, text)
    found = scored(inverted, pair_counts(inverted))
    new = [*COUNTS, "n_best", "count_sum", "groups_sha256"]
    at = df.columns.index(text)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if i != at and c not in new], *new)
