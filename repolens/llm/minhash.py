"""Near-duplicates by bottom-k sketches.

A document's set is that of its distinct shingles of ``words`` consecutive words; its sketch
the ``K`` smallest hashes of the set under one hash function. Documents of equal sets
are one class, compared once, under an id of its own.

Candidates come from inverted lists of the retained values. Two sets of similarity 0.8 share
about 0.8 K retained values, fewer than ``K * SHARED`` with a probability below 1e-7. So it is
enough to list, per document, the K - K * SHARED + 1 retained values that the fewest
documents retain: of those, two such documents have one in common, and values
that many unlike documents retain (common passages) make no lists. Values that one
document alone retains make none either.

A list of at most ``SMALL`` members is paired up. A longer one is worked off by pivots: in each
round every list that still holds two or more components compares all members with some
pivots, which leave the list; components that the links unite shrink the list's
work to nothing where the members are near copies. Pivots are compared in blocks, as postings of
their whole sets. No list is cut, no pair skipped that could join two components.

A pair goes on if the sketch of the union estimates a similarity near enough the limit, and
links if the whole sets of shingles, built again from the texts, are similar enough.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolens.llm.common import Stretches, connected_components, list_array, mix64, row_groups, take_slices, text_parts, tidied
from repolens.session import cut_lineage

K = 48
SHARED = 20 / 48
SMALL = 8
#: Members of a long list that the first round, and each later one, compares with all others.
FIRST, PIVOTS = 32, 1024
#: Shingles of the pivots of one block, and members that a block is compared with in one task.
BLOCK, SALTED = 4 << 20, 1024
#: Standard deviations by which an estimate may fall short.
SLACK = 5.0
#: Bytes of shingles that a task keeps while it confirms links.
KEPT = 64 << 20
NO_ID = (1 << 63) - 1
#: Stands behind the values of a short sketch; no shingle has it as its hash.
FILL = np.uint64((1 << 64) - 1)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of each text, ascending. Words are the stretches
    between the bytes 20 and 09-0D; A-Z are lower-cased; a text with fewer
    words is one shingle, without words none."""
    low = data.copy()
    upper = (low >= 65) & (low <= 90)
    low[upper] += 32
    solid = ~((low == 32) | ((low >= 9) & (low <= 13)))
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(low), bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(low), bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    word = Stretches(low).of(start, end)
    of = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(of, minlength=len(offsets) - 1) if len(of) else np.zeros(len(offsets) - 1, np.int64)
    first = np.cumsum(count) - count
    size = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    text = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(text)) - (np.cumsum(size) - size)[text] + first[text]
    h = np.zeros(len(text), np.uint64)
    left = (first + count)[text] - at
    for j in range(words):
        some = left > j
        h[some] = mix64(h[some] * np.uint64(0x9FB21C651E98DF25) + word[at[some] + j] + np.uint64(j + 1))
    h[h == FILL] -= np.uint64(1)  # FILL is no hash
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], np.searchsorted(text[new], np.arange(len(size) + 1))


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, k: int = K) -> DataFrame:
    """(id, h, g, n_shingles, whole, sketch): h and g are hashes of the text; whole is a digest of the full
    set, null for an empty set; sketch its k smallest hashes, ascending as unsigned numbers."""

    def sketched(batches):
        for batch in batches:
            _, bounds = text_parts(batch.column(3))
            for i, j in row_groups(bounds, 1 << 20):
                b = batch.slice(i, j - i)
                h, at = shingles(*text_parts(b.column(3)), words)
                size = np.diff(at)
                raw = memoryview(h.tobytes())
                whole = [hashlib.blake2b(raw[8 * x : 8 * y], digest_size=16).digest() if y > x else None for x, y in zip(at[:-1], at[1:])]
                place = np.arange(len(h)) - np.repeat(at[:-1], size)
                kept = np.minimum(size, k)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], pa.array(size), pa.array(whole, pa.binary()), list_array(h[place < k].view(np.int64), np.concatenate([[0], np.cumsum(kept)]), pa.int64())],
                    names=["id", "h", "g", "n_shingles", "whole", "sketch"],
                )

    return docs.select(*_named(key, text), text).mapInArrow(tidied(sketched), "id long, h long, g int, n_shingles long, whole binary, sketch array<long>")


def _named(key: str, text: str) -> list[Column]:
    """id, h, g: the id of a row, and hashes that tell texts of one id apart."""
    return [F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("h"), F.hash(text).alias("g")]


def _lists(reps: DataFrame, name: str) -> DataFrame:
    """(value, id, n, holders): the rarest retained values of each set that others retain too."""
    held = reps.select("id", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    common = held.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).filter("holders >= 2")
    shared = held.join(common, "value").groupBy("id").agg(
        F.first("n").alias("n"), F.first("kept").alias("kept"), F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("values")
    )
    # Values without other holders are the rarest, and come first in the count.
    take = F.col("kept") - F.floor(F.col("kept") * SHARED) + 1 - (F.col("kept") - F.size("values"))
    rare = shared.select("id", "n", F.explode(F.slice("values", F.lit(1), F.greatest(F.lit(0), F.least(take, F.size("values"))).cast("int"))).alias("v"))
    return cut_lineage(rare.select(F.col("v.value").alias("value"), "id", "n", F.col("v.holders").alias("holders")), name)


def _near(n: str, m: str, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return (F.least(n, m) * 100) >= (F.greatest(n, m) * percent)


def _shared_of_union(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shared, size) per row of two matrices of ascending sketches: the size of the union's sketch, and how
    many of its values both hold. The largest number fills short rows."""
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    fill = both == FILL
    again = np.zeros(both.shape, bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    rank = np.cumsum(~again, axis=1)  # of each value among the distinct ones
    inside = (rank <= K) & ~fill
    return (again & inside).sum(1), (~again & inside).sum(1)


def _likely(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Rows whose union's sketch estimates a similarity near enough the limit."""
    shared, size = _shared_of_union(x, y)
    limit = percent / 100
    return shared >= (limit - SLACK * np.sqrt(limit * (1 - limit) / np.maximum(size, 1))) * size


def _matrix(sketches: pa.Array) -> np.ndarray:
    """One row of K unsigned hashes per sketch, filled up with FILL."""
    size = np.diff(sketches.offsets.to_numpy())
    out = np.full((len(size), K), FILL)
    out[np.arange(K)[None] < size[:, None]] = sketches.flatten().to_numpy().view(np.uint64)
    return out


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the sketch of the union does not rule out."""
    a, b = (reps.select(F.col("id").alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb")

    def likely(batches):
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(_likely(_matrix(batch.column(2)), _matrix(batch.column(3)), percent)))

    return both.mapInArrow(likely, "a long, b long")


class _Pivots:
    """The pivots of one room: whole sets as postings, sketches, and which pivots are known to hang together."""

    def __init__(self, words: int, percent: int):
        self.words, self.percent = words, percent
        self.parts: list[tuple] = []

    def add(self, ids: np.ndarray, components: np.ndarray, texts: pa.Array) -> None:
        for i, j in row_groups(text_parts(texts)[1], 2 << 20):
            h, at = shingles(*text_parts(texts.slice(i, j - i)), self.words)
            self.parts.append((ids[i:j], components[i:j], h, np.diff(at)))

    def close(self) -> None:
        ids, components, h, sizes = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.ids, self.components, self.sizes = [], ids, components, sizes
        self.sketches = _bottom(h, np.concatenate([[0], np.cumsum(sizes)]))
        order = np.argsort(h, kind="stable")
        self.hashes, self.owners = h[order], np.repeat(np.arange(len(ids)), sizes)[order]
        self.root = list(range(len(ids)))

    def top(self, p: int) -> int:
        while self.root[p] != p:
            self.root[p] = p = self.root[self.root[p]]
        return p

    def links(self, ids: np.ndarray, components: np.ndarray, h: np.ndarray, at: np.ndarray):
        """Pairs of ids that hang together: each member and a pivot that it links to, and the pivots that
        it joins unless an earlier member did."""
        sizes = np.diff(at)
        small, large = np.minimum(sizes[:, None], self.sizes[None]), np.maximum(sizes[:, None], self.sizes[None])
        open_ = (small * 100 >= large * self.percent) & (small > 0)
        open_ &= (ids[:, None] != self.ids[None]) & (components[:, None] != self.components[None])
        m, p = np.nonzero(open_)
        sketch = _bottom(h, at)
        likely = [_likely(sketch[m[x : x + 8192]], self.sketches[p[x : x + 8192]], self.percent) for x in range(0, len(m), 8192)]
        if not likely:
            return
        likely = np.concatenate(likely)
        m, p = m[likely], p[likely]
        first = np.searchsorted(self.hashes, h, "left")
        shared = np.searchsorted(self.hashes, h, "right") - first
        upto = np.concatenate([[0], np.cumsum(shared)])[at]
        for i, j in row_groups(upto, 4 << 20):
            x, y = np.searchsorted(m, [i, j])
            if x == y:
                continue
            some, pivot = m[x:y], p[x:y]
            owner = take_slices(self.owners, first[at[i] : at[j]], shared[at[i] : at[j]])
            member = np.repeat(np.arange(j - i), np.diff(upto)[i:j])
            both = np.bincount(member * len(self.ids) + owner, minlength=(j - i) * len(self.ids))[(some - i) * len(self.ids) + pivot]
            near = 100 * both >= self.percent * (sizes[some] + self.sizes[pivot] - both)
            last = -1
            for one, q in zip(some[near].tolist(), pivot[near].tolist()):
                if one != last:
                    last, head = one, q
                    yield int(ids[one]), int(self.ids[q])
                elif self.top(head) != self.top(q):
                    self.root[self.top(q)] = self.top(head)
                    yield int(self.ids[head]), int(self.ids[q])


def _bottom(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of the K smallest hashes of each ascending set, filled up with FILL."""
    kept = np.minimum(np.diff(at), K)
    out = np.full((len(kept), K), FILL)
    out[np.arange(K)[None] < kept[:, None]] = take_slices(h, at[:-1], kept)
    return out


def _compared(labelled: DataFrame, chosen: DataFrame, round_: int, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) that hang together, from comparing all members of each list with its pivots.

    Lists of near copies have nearly the same pivots. So each pivot is in one block, named by the first
    pivot of any of its lists, and a member goes once to each block with pivots of its lists: no pair
    travels, and a text once a block instead of once a pair. A block has rooms of about ``PIVOTS``
    pivots, or ``BLOCK`` shingles; a room is salted by its number of members."""
    lead = F.xxhash64(F.col("pivots")[0]["id"], F.lit(round_))
    each = chosen.select("value", lead.alias("home"), F.explode("pivots").alias("p")).select("value", "home", "p.*")
    at_home = cut_lineage(
        each.groupBy("id").agg(F.min("home").alias("home"), F.max("n").alias("n"), F.max("component").alias("component"), F.collect_set("value").alias("values")),
        "block-pivots",
    )
    room = at_home.groupBy("home").agg(F.greatest(F.ceil(F.sum("n") / F.lit(BLOCK)), F.ceil(F.count(F.lit(1)) / F.lit(PIVOTS)), F.lit(1)).alias("rooms"))
    pivots = at_home.join(room, "home").select("home", F.pmod(F.xxhash64("id"), "rooms").alias("room"), "id", "component", "values")
    asked = pivots.select(F.explode("values").alias("value"), "home", "room").distinct()
    members = cut_lineage(labelled.select("value", "id", "component").join(asked, "value").select("home", "room", "id", "component").distinct(), "block-members")
    salts = members.groupBy("home", "room").agg(F.ceil(F.count(F.lit(1)) / F.lit(SALTED)).alias("salts"))
    salted = members.join(salts, ["home", "room"]).select("home", "room", F.pmod(F.xxhash64("id", F.lit("salt")), "salts").alias("salt"), F.lit(1).alias("kind"), "id", "component")
    copied = pivots.join(salts, ["home", "room"]).select(
        "home", "room", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), "id", "component"
    )
    rows = salted.union(copied.select(*salted.columns)).join(texts, "id").select("home", "room", "salt", "kind", "id", "component", "text")
    blocks = rows.repartition("home", "room", "salt").sortWithinPartitions("home", "room", "salt", "kind")

    def compared(batches):
        block, pivots_ = None, None
        for batch in batches:
            home, room_, salt, kind, ids, components = (batch.column(c).to_numpy() for c in range(6))
            change = (np.diff(home) != 0) | (np.diff(room_) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)
            edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(home)]])
            found = []
            for x, y in zip(edges[:-1], edges[1:]):
                if x == y:
                    continue
                here, text = (home[x], room_[x], salt[x]), batch.column(6).slice(x, y - x)
                if kind[x] == 0:
                    if here != block:
                        block, pivots_ = here, _Pivots(words, percent)
                    pivots_.add(ids[x:y], components[x:y], text)
                    continue
                if pivots_.parts:
                    pivots_.close()
                for i, j in row_groups(text_parts(text)[1], 1 << 20):
                    for k in range(i, j, 512):  # very short texts
                        last = min(j, k + 512)
                        h, at = shingles(*text_parts(text.slice(k, last - k)), words)
                        found += pivots_.links(ids[x + k : x + last], components[x + k : x + last], h, at)
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return blocks.mapInArrow(tidied(compared), "a long, b long")


class _Sets:
    """The shingles of texts; those of the last ones are kept, up to ``KEPT`` bytes: pairs that were
    joined on one side bring the same texts again and again."""

    def __init__(self, words: int):
        self.words, self.kept, self.bytes = words, {}, 0

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        coded = texts.fill_null("").dictionary_encode()
        data, at = text_parts(coded.dictionary)
        raw = memoryview(data)
        keys = [hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(at[:-1], at[1:])]
        new = [i for i, key in enumerate(keys) if key not in self.kept]
        h, bounds = shingles(*text_parts(coded.dictionary.take(pa.array(new, pa.int64()))), self.words)
        for i, x, y in zip(new, bounds[:-1], bounds[1:]):
            self.kept[keys[i]] = h[x:y].copy()
            self.bytes += 8 * int(y - x)
        found = [self.kept[key] for key in keys]
        while self.bytes > KEPT:
            self.bytes -= self.kept.pop(next(iter(self.kept))).nbytes
        return [found[i] for i in coded.indices.to_numpy()]


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets have 100 * intersection >= percent * union."""
    a, b = (texts.select(F.col("id").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")

    def checked(batches):
        sets = _Sets(words)
        for batch in batches:
            sizes = text_parts(batch.column(2))[1] + text_parts(batch.column(3))[1]
            for i, j in row_groups(sizes, 2 << 20):
                part = batch.slice(i, j - i)
                keep = []
                for p, q in zip(sets.of(part.column(2)), sets.of(part.column(3))):
                    both_ = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(q) else 0
                    keep.append(100 * both_ >= percent * (len(p) + len(q) - both_))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(tidied(checked), "a long, b long")


def _merged(found: DataFrame, new: DataFrame) -> DataFrame:
    """Components (id, component) after the links ``new`` (a, b): only those that they join change."""
    a, b = (found.select(F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    between = new.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    fresh = new.select(F.col("a").alias("id")).union(new.select("b")).distinct().join(found, "id", "left_anti")
    everyone = found.union(fresh.select("id", F.col("id").alias("component")))
    joined = connected_components(between, "joined").select(F.col("id").alias("component"), F.col("component").alias("low"))
    return cut_lineage(everyone.join(joined, "component", "left").select("id", F.coalesce("low", "component").alias("component")), "linked")


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``: component_id is the smallest id
    that links of at least ``percent`` similarity reach. Each row is a document of its own, whatever
    its id; a null id counts as the largest integer. One row of each component is kept, of
    those with its smallest id one. Rows without words are alone, and kept."""
    return _linked(docs, key, text, words, percent).select("id", "n_shingles", "component_id", "kept")


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``link`` keeps. Of rows of one id and text any is kept."""
    all_ = docs.select(F.struct("*").alias("row"), *_named(key, text), F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("words"))
    first = _linked(docs, key, text, words, percent).filter("kept and n_shingles > 0").select("id", "h", "g")
    one = all_.filter("words").join(first, ["id", "h", "g"], "left_semi").dropDuplicates(["id", "h", "g"])
    return one.select("row.*").union(all_.filter("not words").select("row.*"))


def _linked(docs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """``link`` with the texts' hashes h and g."""
    rows = cut_lineage(sketches(docs, key, text, words).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # Classes of equal sets have ids of their own: ids of rows may repeat or be null.
    classes = rows.filter("whole is not null").groupBy("whole").agg(
        F.min(F.struct("id", "h", "g", "row")).alias("low"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = cut_lineage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    reps = classes.select(F.col("class").alias("id"), "n", "sketch")
    lists = _lists(reps, "lists")
    involved = lists.select("id").distinct()
    low = classes.join(involved, classes["class"] == involved["id"], "left_semi").select("class", "low.id", "low.h", "low.g")
    listed = docs.select(*_named(key, text), F.col(text).alias("text")).join(low, ["id", "h", "g"])
    # One row a class, also where rows of one id have one text.
    texts = cut_lineage(listed.groupBy(F.col("class").alias("id")).agg(F.first("text").alias("text")), "listed-texts")

    small = lists.filter(F.col("holders") <= SMALL).groupBy("value").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("m"))
    paired = small.filter("size(m) >= 2").select(
        F.explode(F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(x.id as a, x.n as n, y.id as b, y.n as o))))")).alias("p")
    )
    pairs = paired.select("p.*").filter(_near("n", "o", percent)).filter("a != b").select("a", "b").distinct()
    links = cut_lineage(_verified(_estimated(pairs, reps, percent), texts, words, percent), "links")

    found = connected_components(links, "linked")
    # A document with its long lists, at most K, is one row where it gets its component.
    long = lists.filter(F.col("holders") > SMALL).groupBy("id", "n").agg(F.collect_set("value").alias("values"))
    for round_ in count():
        labelled = long.join(found, "id", "left").select("id", "n", F.coalesce("component", "id").alias("component"), F.explode("values").alias("value"))
        sizes = labelled.groupBy("value", "component").agg(F.count(F.lit(1)).alias("size"))
        heads_ = F.sum("size") if round_ == 0 else F.sum("size") - F.max("size")
        open_ = sizes.groupBy("value").agg(
            F.count(F.lit(1)).alias("parts"), heads_.alias("heads"), F.max_by("component", F.struct("size", "component")).alias("main")
        )
        labelled = cut_lineage(labelled.join(open_.filter("parts > 1").select("value", "main", "heads"), "value"), "open-lists")
        if labelled.isEmpty():
            break
        # At first a few pivots, the same in all lists of the same members; then those that are
        # not in the list's largest component: once they are gone, the list is done.
        heads = labelled if round_ == 0 else labelled.filter("component != main")
        chosen = cut_lineage(_first_members(heads, round_, FIRST if round_ == 0 else PIVOTS), "pivots")
        new = cut_lineage(_compared(labelled, chosen, round_, texts, words, percent), "links")
        done = chosen.select("value", F.explode("pivots").alias("p")).select("value", F.col("p.id").alias("id"))
        left = labelled.select("value", "id", "n").join(done, ["value", "id"], "left_anti")
        long = cut_lineage(left.groupBy("id", "n").agg(F.collect_set("value").alias("values")), "long-lists")
        if not new.isEmpty():
            found = _merged(found, new)
    parts = classes.select("class", "whole", "low").join(found.select(F.col("id").alias("class"), "component"), "class", "left")
    parts = parts.select("whole", "low", F.coalesce("component", "class").alias("component"))
    first = parts.groupBy("component").agg(F.min("low").alias("first"))
    named = parts.join(first, "component").select("whole", F.col("first.id").alias("component_id"), F.col("first.row").alias("first"))
    out = rows.drop("sketch").join(named, "whole", "left")
    return out.select("id", "h", "g", "n_shingles", F.coalesce("component_id", "id").alias("component_id"), F.coalesce(F.col("first") == F.col("row"), F.lit(True)).alias("kept"))


def _first_members(labelled: DataFrame, round_: int, n: int) -> DataFrame:
    """(value, pivots): the first n members of each list in the order of the round's hash. Each of
    4n parts of a list gives its first member, so no list is sorted as a whole; a list of at most n
    members (``heads``) gives them all."""
    order = F.struct(F.xxhash64("id", F.lit(round_)).alias("h"), F.col("id"))
    apart = F.xxhash64("id", F.lit(round_), F.lit("part"))
    part = F.when(F.col("heads") <= n, apart).otherwise(F.pmod(apart, F.lit(4 * n)))
    heads = labelled.groupBy("value", part.alias("part")).agg(F.min(F.struct(order.alias("o"), F.struct("id", "n", "component").alias("m"))).alias("head"))
    return heads.groupBy("value").agg(F.slice(F.sort_array(F.collect_list("head")), 1, n).alias("heads")).select("value", F.col("heads.m").alias("pivots"))
