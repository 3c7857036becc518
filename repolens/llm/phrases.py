"""Collocations of whole texts, counted by prefix-free parsing.

``parse`` cuts each text's words into chunks where the content says so: a chunk begins where a window of
``WINDOW`` words hashes to a multiple of ``MODULUS`` and ends with the window that begins the next one, so equal passages give
equal chunks wherever they stand. Chunks overlap by that window; a phrase of up to ``WINDOW`` + 1 words belongs to the chunk in whose
own words, those before the next window, it begins. The dictionary has each distinct chunk once with its
frequency in the parse, and phrases are counted inside distinct chunks, weighted by it.

The dictionary is written as blocks of bounded size. A block counts its distinct phrases of one and two words; buckets, by
a hash of the phrase, add the blocks' counts up and send each block back which of its phrases are frequent. Longer phrases are
counted only where all their pairs of words are frequent, as no other can be. A frequent phrase costs an
entry a block, however often it occurs. Neither blocks nor buckets grow with the data, there are more of them.

A null text has no words, a null language is ``und``. Rows may repeat and count each. Other columns are not read. An
empty table gives an empty result. Counts are 64-bit integers, scores are taken from 38-digit decimals.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolens.llm.common import coded, mix64, packed, row_groups, take_slices, text_parts, tidied, tidy, words_of
from repolens.session import cut_lineage

#: Words in a trigger window and the longest phrase; one window in ``MODULUS`` begins a chunk.
WINDOW, LONGEST, MODULUS = 4, 5, 64
SLICE_BYTES, BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20, 16 << 20
UNKNOWN = "und"
#: Bytes that end a piece, and bytes that separate its words.
PIECE_ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Parts that a language's candidates are ranked in before they meet.
RANK_PARTS = 64


def _set(found: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(found))


def _sums(code: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of the weights of each code."""
    out = np.zeros(n, np.int64)
    np.add.at(out, code, weight)
    return out


def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def _factor(key: np.ndarray) -> tuple[np.ndarray, int]:
    import pandas as pd

    code, distinct = pd.factorize(key)
    return code.astype(np.int64), len(distinct)


def _first(code: np.ndarray, n: int) -> np.ndarray:
    """First place of each code."""
    out = np.empty(n, np.int64)
    out[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    return out


def chunks_of(data: np.ndarray, offsets: np.ndarray, modulus: int = MODULUS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and bounds of the chunks of the texts, the text of each, and how many words are its own. In a
    chunk words are separated by a space, pieces by a line break, and A-Z are lower-cased."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    data = lower[data]
    start, end = words_of(data, offsets, _set(PIECE_ENDS + SPACES))
    if not len(start):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bound = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bound))
    ended = np.concatenate([[0], np.cumsum(_set(PIECE_ENDS)[data])])
    piece = ended[start]
    body, at = packed(data, start, end)
    # Words one after another, each with what separates it from the next.
    size = np.diff(at) + 1
    to = np.concatenate([[0], np.cumsum(size)])
    line = np.full(int(to[-1]), 32, np.uint8)
    inside = np.ones(len(line), bool)
    inside[to[1:] - 1] = False
    line[inside] = body
    line[to[1:-1][piece[1:] != piece[:-1]] - 1] = 10
    word, distinct = coded(body, at)
    hashes = _word_hashes(distinct)[word]
    begins = np.zeros(len(row), bool)
    begins[bound[:-1][np.diff(bound) > 0]] = True
    if len(row) >= WINDOW:
        n = len(row) - WINDOW + 1
        window = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            window = mix64(window * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
        begins[:n] |= (window % np.uint64(modulus) == 0) & (row[:n] == row[WINDOW - 1 :])
    first = np.flatnonzero(begins)
    following = np.append(first[1:], len(row))
    last = np.minimum(following + WINDOW, bound[row[first] + 1])
    length = to[last] - 1 - to[first]
    return take_slices(line, to[first], length), np.concatenate([[0], np.cumsum(length)]), row[first], following - first


def parse(df: DataFrame, text: str = "text", lang: str = "lang", modulus: int = MODULUS) -> DataFrame:
    """The dictionary: (lang, chunk, own, n) of each distinct chunk. Equal chunks of a task are counted before the shuffle."""
    inner = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("string").alias("body"))

    def cut(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            _, bounds = text_parts(b.column(1))
            for i, j in row_groups(bounds, SLICE_BYTES):
                part = b.slice(i, j - i)
                data, at, row, own = chunks_of(*text_parts(part.column(1)), modulus)
                langs = part.column(0).dictionary_encode()
                lang_of = langs.indices.to_numpy()[row].astype(np.int64)
                chunk, distinct = coded(data, at)
                key, n = _factor((lang_of * (int(own.max(initial=0)) + 1) + own) * max(1, len(distinct)) + chunk)
                head = _first(key, n)
                chunks = distinct.take(pa.array(chunk[head])).cast(pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(lang_of[head])), chunks, pa.array(own[head]), pa.array(np.bincount(key, minlength=n))], names=["lang", "chunk", "own", "n"])

    found = inner.mapInArrow(tidied(cut), "lang string, chunk string, own long, n long")
    return found.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


def _stored(columns: dict) -> bytes:
    """Columns as one compressed buffer."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _loaded(buffer) -> pa.RecordBatch:
    with pa.ipc.open_stream(buffer) as r:
        return r.read_next_batch()


def blocks(dictionary: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, raw, body): the dictionary in blocks of about ``block_bytes``, written once."""

    def pack(batches: Iterable[pa.RecordBatch]):
        block = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def closed():
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            body = _stored({c: t.column(c) for c in t.schema.names})
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([size]), pa.array([body], pa.binary())], names=["block", "raw", "body"])

        for b in batches:
            _, bounds = text_parts(b.column(1))
            for i, j in row_groups(bounds, block_bytes):
                nbytes = int(bounds[j] - bounds[i])
                if held and size + nbytes > block_bytes:
                    yield closed()
                    block, held, size = block + 1, [], 0
                held.append(b.slice(i, j - i))
                size += nbytes
        if held:
            yield closed()

    return cut_lineage(dictionary.mapInArrow(pack, "block long, raw long, body binary"), "phrase-blocks")


class Block:
    """The words of a block's chunks, and its distinct phrases of one and two words."""

    def __init__(self, body):
        t = _loaded(body)
        langs = t.column(0).dictionary_encode()
        self.langs = langs.dictionary
        self.data, offsets = text_parts(t.column(1))
        self.start, self.end = words_of(self.data, offsets, _set(b" \n"))
        bound = np.searchsorted(self.start, offsets)
        row = np.repeat(np.arange(t.num_rows), np.diff(bound))
        own = np.arange(len(row)) - bound[row] < t.column(2).to_numpy()[row]
        #: How often a phrase that begins at a word counts.
        self.weight = np.where(own, t.column(3).to_numpy()[row], 0)
        self.lang = langs.indices.to_numpy()[row].astype(np.int64)
        body, at = packed(self.data, self.start, self.end)
        word, distinct = coded(body, at)
        self.word_hash = _word_hashes(distinct)[word]
        self.word, self.n_words = _factor(self.lang * len(distinct) + word)
        #: Whether the next word is of the same piece.
        self.goes_on = np.zeros(len(row), bool)
        self.goes_on[:-1] = (row[1:] == row[:-1]) & (self.data[self.start[1:] - 1] == 32)
        self.two_at = np.flatnonzero(self.goes_on)
        self.two, self.n_two = _factor(self.word[self.two_at] * self.n_words + self.word[self.two_at + 1])

    def entries(self, code: np.ndarray, n: int, at: np.ndarray, size: int) -> dict:
        """Distinct phrases of ``size`` words, of which ``code`` has that which begins at each word of ``at``."""
        head = at[_first(code, n)]
        first, last = self.start[head], self.end[head + size - 1]
        found = np.full(n, size, np.uint64)
        for k in range(size):
            found = mix64(found * np.uint64(0x9E3779B97F4A7C15) + self.word_hash[head + k])
        return {"lang": self.lang[head], "start": first, "size": last - first, "n": _sums(code, self.weight[at], n), "hash": found}

    def short(self) -> dict:
        """Entries of all phrases of one and two words; and one empty phrase a language, which counts its words."""
        words = self.entries(self.word, self.n_words, np.arange(len(self.word)), 1)
        two = self.entries(self.two, self.n_two, self.two_at, 2)
        n = len(self.langs)
        zero = np.zeros(n, np.int64)
        total = {"lang": np.arange(n), "start": zero, "size": zero, "n": _sums(self.lang, self.weight, n), "hash": np.zeros(n, np.uint64)}
        return {c: np.concatenate([total[c], words[c], two[c]]) for c in total}

    def long(self, frequent: np.ndarray) -> dict | None:
        """Entries of longer phrases, all of whose pairs of words are frequent; ``frequent``: flags of ``short``'s entries."""
        fine = frequent[len(self.langs) + self.n_words :]
        code = np.full(len(self.word) + 1, -1, np.int64)
        code[self.two_at] = np.where(fine[self.two], self.two, -1)
        n, out = self.n_two, []
        for size in range(3, LONGEST + 1):
            at = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0))
            found, m = _factor(code[at] * n + code[at + 1])
            code = np.full(len(code), -1, np.int64)
            code[at], n = found, m
            counted = self.weight[at] > 0
            some, k = _factor(found[counted])
            if not k:
                break
            out.append(self.entries(some, k, at[counted], size))
        return {c: np.concatenate([x[c] for x in out]) for c in out[0]} if out else None

    def dealt(self, entries: dict, bits: int):
        """(bucket, places of its entries, stored entries) of each bucket that has some."""
        bucket = (entries["hash"] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(entries["hash"]), np.int64)
        order = np.argsort(bucket, kind="stable")
        numbers, cut = np.unique(bucket[order], return_index=True)
        for b, i, j in zip(numbers.tolist(), cut.tolist(), [*cut[1:].tolist(), len(order)]):
            x = order[i:j]
            size = entries["size"][x]
            text = take_slices(self.data, entries["start"][x], size)
            phrases = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(text)])
            yield b, x, _stored({"lang": pa.DictionaryArray.from_arrays(pa.array(entries["lang"][x].astype(np.int32)), self.langs), "phrase": phrases, "n": pa.array(entries["n"][x])})


def _sent(block: int, parsed: Block, entries: dict | None, bits: int):
    if entries is not None:
        for bucket, _, body in parsed.dealt(entries, bits):
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([block], pa.int64()), pa.array([body], pa.binary())], names=["bucket", "block", "body"])


def totals(parts: DataFrame, least: int) -> DataFrame:
    """Adds up the entries of each bucket: rows (lang, phrase, f) of its frequent phrases, and rows (home, bucket, flags) that tell each block
    which of its entries are frequent. The empty phrase always is. Written once."""

    def added(table: pa.Table) -> pa.Table:
        got = [_loaded(x.as_buffer()) for x in table["body"]]
        langs = pa.concat_arrays([g.column(0).dictionary_decode() for g in got]).dictionary_encode()
        data = [text_parts(g.column(1)) for g in got]
        size = np.concatenate([np.diff(o) for _, o in data])
        phrase, distinct = coded(np.concatenate([d for d, _ in data]), np.concatenate([[0], np.cumsum(size)]).astype(np.int64))
        code, n = _factor(langs.indices.to_numpy().astype(np.int64) * len(distinct) + phrase)
        total = _sums(code, np.concatenate([g.column(2).to_numpy() for g in got]), n)
        head = _first(code, n)
        frequent = (total >= least) | (size[head] == 0)
        flags, at = frequent[code], 0
        sent = []
        for g in got:
            sent.append(np.packbits(flags[at : at + g.num_rows]).tobytes())
            at += g.num_rows
        head = head[frequent]
        k = len(head)
        rows = pa.table({
            "lang": langs.dictionary.take(langs.indices.take(pa.array(head))), "phrase": distinct.take(pa.array(phrase[head])).cast(pa.large_string()).cast(pa.string()), "f": pa.array(total[frequent]),
            "home": pa.nulls(k, pa.int64()), "bucket": pa.nulls(k, pa.int64()), "flags": pa.nulls(k, pa.binary()),
        })
        back = pa.table({"lang": pa.nulls(len(got), pa.string()), "phrase": pa.nulls(len(got), pa.string()), "f": pa.nulls(len(got), pa.int64()), "home": table["block"], "bucket": table["bucket"], "flags": pa.array(sent, pa.binary())})
        tidy()
        return pa.concat_tables([rows, back])

    return cut_lineage(parts.groupBy("bucket").applyInArrow(added, "lang string, phrase string, f long, home long, bucket long, flags binary"), "phrase-totals")


def frequencies(df: DataFrame, least: int, text: str = "text", lang: str = "lang", modulus: int = MODULUS, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(lang, phrase, f) of all phrases of up to ``LONGEST`` words with f >= ``least``; the empty phrase has
    the number of words of the language."""
    stored = blocks(parse(df, text, lang, modulus), block_bytes)
    raw = stored.agg(F.sum("raw")).first()[0] or 0
    bits = int(raw // bucket_bytes).bit_length()

    def short(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            for block, body in zip(b.column(0).to_pylist(), b.column(1)):
                parsed = Block(body.as_buffer())
                yield from _sent(block, parsed, parsed.short(), bits)

    def longer(block: pa.Table, back: pa.Table) -> pa.Table:
        out = []
        for number, body in zip(block["block"].to_pylist(), block["body"]):
            parsed = Block(body.as_buffer())
            entries = parsed.short()
            flags = dict(zip(back["bucket"].to_pylist(), back["flags"].to_pylist()))
            frequent = np.zeros(len(entries["n"]), bool)
            bucket = (entries["hash"] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(frequent), np.int64)
            order = np.argsort(bucket, kind="stable")
            numbers, cut = np.unique(bucket[order], return_index=True)
            for b, i, j in zip(numbers.tolist(), cut.tolist(), [*cut[1:].tolist(), len(order)]):
                frequent[order[i:j]] = np.unpackbits(np.frombuffer(flags[b], np.uint8), count=j - i).astype(bool)
            del entries
            out += _sent(number, parsed, parsed.long(frequent), bits)
        tidy()
        return pa.Table.from_batches(out, pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("body", pa.binary())]))

    kind = "bucket long, block long, body binary"
    bodies = stored.select("block", "body")
    one = totals(bodies.mapInArrow(tidied(short), kind), least)
    back = one.filter("home is not null").select("home", "bucket", "flags")
    two = totals(bodies.groupBy("block").cogroup(back.groupBy("home")).applyInArrow(longer, kind), least)
    return one.unionByName(two).filter("phrase is not null").select("lang", "phrase", "f")


def _words(phrase: str) -> Column:
    return F.split(F.col(phrase), " ")


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact: products of up to 38 digits."""
    top = F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(15,0)") * n.cast("decimal(17,0)")
    return F.call_function("div", top, left.cast("decimal(18,0)") * right.cast("decimal(18,0)")).cast("long")


def collocations(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language by score, from the rows of ``frequencies``."""
    found = cut_lineage(found, "phrase-frequencies")
    sizes = found.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    known = found.filter("phrase <> ''").select("lang", "phrase", "f")
    long = known.withColumn("w", _words("phrase")).filter(F.size("w") > 1).withColumnRenamed("f", "a")
    cuts = long.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"), F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(sizes, "lang").withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("x")).select("lang", "phrase", "x.*")
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    around = long.filter(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = lowest.join(around, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    heads = left.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000, **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``LONGEST`` words found ``least`` times or more.

    A phrase's score is the lowest of its cuts into two parts, floor(1000 * a * n / (l * r)), ties by the shortest first part. Phrases
    inside a longer one that occurs as often are dropped. Ties of score and a go by the phrase's bytes."""
    return collocations(frequencies(df, least, text, lang, **sizes), top)
