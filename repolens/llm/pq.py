"""Near-duplicate vectors by product quantisation.

Vectors are scaled to length one; equal ones are one class. A bounded sample (``SAMPLE`` vectors with
the smallest hashes) fits coarse centroids and, for the residuals, one codebook for each
subspace. Every vector is then indexed: by the list of its nearest centroid, its codes,
and the length of what the codes leave out.

Each class is a query against all: it probes the ``PROBES`` nearest lists. Against a list's
members its distances are sums of table entries (one table per query and subspace, one
entry per code). A pair whose distance by table is larger than the limit by more than the length
that the member's codes leave out cannot be near enough; all others get their
exact cosine, in double precision.

Queries and members of a list meet in blocks of bounded size, so a list that holds a third of
all vectors is many tasks. A block returns the number of links of each query and a
spanning forest of the links, never the pairs. Lists, centroids and codebooks are bounded by
``LISTS``; nothing else comes to the driver.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different dimensions neither. An id may repeat: each row is a vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.llm.common import connected_components, tidied
from repolens.session import cut_lineage

SAMPLE = 8192
LISTS = 512
LIST_SIZE = 128
PROBES = 12
SUBSPACES = 8
CODES = 64
BLOCK = 2048
COSINE = 0.9


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c**2).sum(1)[None] - 2 * x @ c.T).argmin(1)
        size = np.bincount(near, minlength=len(c))
        for d in range(x.shape[1]):
            c[:, d] = np.where(size > 0, np.bincount(near, x[:, d], len(c)) / np.maximum(size, 1), c[:, d])
    return c


class Quantiser:
    """Coarse centroids, and codebooks of the residuals' subspaces."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.centroids = _kmeans(sample, lists, rng)
        dim = sample.shape[1]
        self.bounds = np.unique(np.linspace(0, dim, min(subspaces, dim) + 1).astype(int))
        left = sample - self.centroids[self.nearest(sample, 1)[:, 0]]
        self.books = [_kmeans(left[:, a:b], codes, rng) for a, b in zip(self.bounds[:-1], self.bounds[1:])]

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each vector, nearest first."""
        d = (self.centroids**2).sum(1)[None] - 2 * x @ self.centroids.T
        n = min(n, d.shape[1])
        some = np.argpartition(d, n - 1, axis=1)[:, :n]
        return np.take_along_axis(some, np.take_along_axis(d, some, 1).argsort(1, kind="stable"), 1)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (one byte a subspace) of the residuals, and the lengths that the codes leave out."""
        left = x - self.centroids[lists]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        for m, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            book = self.books[m]
            codes[:, m] = ((book**2).sum(1)[None] - 2 * left[:, a:b] @ book.T).argmin(1)
            left[:, a:b] -= book[codes[:, m]]
        return codes, np.sqrt((left**2).sum(1))

    def distances(self, q: np.ndarray, list_: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of the queries to the coded members of a list, by table."""
        left = q - self.centroids[list_]
        out = np.zeros((len(q), len(codes)))
        for m, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            book = self.books[m]
            part = left[:, a:b]
            table = (part**2).sum(1)[:, None] + (book**2).sum(1)[None] - 2 * part @ book.T
            out += table[:, codes[:, m]]
        return np.maximum(out, 0)


def _matrix(column) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy()
    return flat.reshape(len(column), -1).astype(float) if len(column) else np.zeros((0, 1))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex that each of n vertices reaches by the edges (a, b)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def fit(classes: DataFrame, total: int, sample: int = SAMPLE) -> Quantiser:
    """A quantiser of a bounded sample of the classes: those with the smallest hashes."""
    rows = classes.select(F.xxhash64("unit").alias("h"), "unit").orderBy("h").limit(sample).select("unit").collect()
    x = np.array([r["unit"] for r in rows], float)
    return Quantiser(x, max(1, min(LISTS, total // LIST_SIZE, len(x))))


def _linked(classes: DataFrame, model: Quantiser, cosine: float, probes: int, block: int) -> DataFrame:
    """(a, b, n) of classes (id, unit, copies): rows with null b count n vectors linked with a; others
    are links of the spanning forests."""
    shared = classes.sparkSession.sparkContext.broadcast(model)

    def indexed(batches):
        for b in batches:
            x = _matrix(b.column("unit"))
            codes, left = shared.value.encode(x, lists := shared.value.nearest(x, 1)[:, 0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.astype(np.int32)), b.column("id"), b.column("unit"), b.column("copies"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left)],
                names=["list", "id", "unit", "copies", "codes", "left_out"],
            )

    index = cut_lineage(classes.mapInArrow(tidied(indexed), "list int, id long, unit array<double>, copies long, codes binary, left_out double"), "pq-index")
    blocks = {r["list"]: -(-r["count"] // block) for r in index.groupBy("list").count().collect()}  # at most LISTS rows
    parts = np.ones(len(model.centroids), np.int32)
    for i, n in blocks.items():
        parts[i] = n

    # Queries of a list are dealt into as many blocks as its members, times the probes.
    def asked(batches):
        for b in batches:
            x, ids = _matrix(b.column("unit")), b.column("id").to_numpy()
            lists = shared.value.nearest(x, probes)
            row = np.repeat(np.arange(len(x)), lists.shape[1])
            l_ = lists.reshape(-1)
            n = parts[l_]
            row, l_ = np.repeat(row, n), np.repeat(l_, n)
            member = np.arange(len(l_)) - np.repeat(np.cumsum(n) - n, n)
            mine = (ids[row] * 7919 + 13) % (parts[l_] * probes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(l_.astype(np.int32)), pa.array(member.astype(np.int32)), pa.array(mine.astype(np.int32)), pa.array(ids[row]), *(b.column(c).take(pa.array(row)) for c in ("unit", "copies")), pa.array(lists[row, 0].astype(np.int32))],
                names=["list", "member", "query", "id", "unit", "copies", "home"],
            )

    def told(batches):
        for b in batches:
            lists, ids = b.column("list").to_numpy(), b.column("id").to_numpy()
            n = parts[lists] * probes
            row = np.repeat(np.arange(len(lists)), n)
            query = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            member = (ids * 104729 + 5) % parts[lists]
            asks = pa.array([x.tobytes() for x in shared.value.nearest(_matrix(b.column("unit")), probes).astype(np.int32)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists[row]), pa.array(member[row].astype(np.int32)), pa.array(query.astype(np.int32)), *(b.column(c).take(pa.array(row)) for c in ("id", "unit", "copies", "codes", "left_out")), asks.take(pa.array(row))],
                names=["list", "member", "query", "id", "unit", "copies", "codes", "left_out", "asks"],
            )

    radius = np.sqrt(max(0.0, 2 - 2 * cosine))

    def met(queries: pa.Table, members: pa.Table) -> pa.Table:
        out_a, out_b, out_n = [], [], []
        if len(queries) and len(members):
            y, yid = _matrix(members["unit"]), members["id"].to_numpy()
            copies, left = members["copies"].to_numpy(), members["left_out"].to_numpy()
            codes = np.frombuffer(b"".join(members["codes"].to_pylist()), np.uint8).reshape(len(y), -1)
            x, xid = _matrix(queries["unit"]), queries["id"].to_numpy()
            x_copies, home = queries["copies"].to_numpy(), queries["home"].to_numpy()
            asks = np.frombuffer(b"".join(members["asks"].to_pylist()), np.int32).reshape(len(y), -1)
            list_ = members["list"][0].as_py()
            for s in range(0, len(x), 256):
                q, qid = x[s : s + 256], xid[s : s + 256]
                close = np.sqrt(shared.value.distances(q, list_, codes)) <= radius + left[None] + 1e-9
                i, j = np.nonzero(close)
                exact = np.concatenate([np.einsum("nd,nd->n", q[i[k : k + 65536]], y[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)])
                good = (exact >= cosine) & (qid[i] != yid[j])
                i, j = i[good], j[good]
                if not len(i):
                    continue
                # The member finds the query itself if it asks the query's list; else its end counts here.
                once = ~(asks[j] == home[s + i][:, None]).any(1)
                ids = np.concatenate([qid, yid])
                found = np.zeros(len(ids), np.int64)
                np.add.at(found, i, copies[j])
                np.add.at(found, len(q) + j[once], x_copies[s + i[once]])
                some = np.flatnonzero(found)
                low = _forest(i, j + len(q), len(ids))
                edge = np.flatnonzero(low != np.arange(len(low)))
                out_a += [ids[some], ids[edge]]
                out_b += [np.full(len(some), -1), ids[low[edge]]]
                out_n += [found[some], np.full(len(edge), -1)]
        a, b, n = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in (out_a, out_b, out_n))
        return pa.table({"a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64), mask=n >= 0), "n": pa.array(n.astype(np.int64), mask=n < 0)})

    key = ["list", "member", "query"]
    queries = classes.select("id", "unit", "copies").mapInArrow(tidied(asked), "list int, member int, query int, id long, unit array<double>, copies long, home int")
    members = index.mapInArrow(tidied(told), "list int, member int, query int, id long, unit array<double>, copies long, codes binary, left_out double, asks binary")
    return queries.groupBy(*key).cogroup(members.groupBy(*key)).applyInArrow(met, "a long, b long, n long")


def link(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id) of every row: the other vectors that are linked with it directly, and the
    smallest id that links reach."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", F.abs))
    scaled = F.transform("v", lambda x: x / largest)  # no square over- or underflows
    rows = rows.withColumn("v", F.when(fine & (largest > 0), scaled))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # -0.0 and 0.0 are one value: adding 0.0 makes them equal.
    rows = rows.withColumn("unit", F.transform("v", lambda x: x / norm + 0.0)).select("id", "unit")
    rows = cut_lineage(rows.withColumn("digest", F.when(F.col("unit").isNotNull(), F.sha2(F.to_json("unit").cast("binary"), 256))), "pq-rows")
    # The class id is a row's id, or a number of its own where an id is repeated or null.
    classes = rows.filter("unit is not null").groupBy("digest").agg(F.min("id").alias("low"), F.first("unit").alias("unit"), F.count(F.lit(1)).alias("copies"))
    classes = cut_lineage(classes.withColumn("id", F.monotonically_increasing_id()), "pq-classes")
    counted, forests = None, None
    for (dim,) in sorted(classes.select(F.size("unit")).distinct().collect()):
        own = classes.filter(F.size("unit") == dim)
        found = cut_lineage(_linked(own.select("id", "unit", "copies"), fit(own, own.count()), cosine, probes, block), "pq-links")
        n, e = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n")), found.filter("b is not null").select("a", "b").distinct()
        counted, forests = (n, e) if counted is None else (counted.union(n), forests.union(e))
    if counted is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    parts = connected_components(forests, "pq-components").select(F.col("id"), "component")
    named = classes.join(parts, "id", "left").join(counted, classes["id"] == counted["a"], "left")
    named = named.select("digest", "low", "copies", F.coalesce("component", "id").alias("component"), F.coalesce("n", F.lit(0)).alias("n"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select("digest", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "digest").join(named, "digest", "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
