"""Language identification by a bidirectional gated recurrent network over bytes.

Whole texts are cut into windows of ``WINDOW`` bytes; a network reads every window from both
ends and gives every byte position probabilities of the languages; a document's
probabilities are the mean over all its positions. Gates are piecewise linear (a clipped
line in place of the sigmoid and the tangent), so a position costs two small
products and a few clips.

The network is trained in numpy by backpropagation through time on windows of a bounded sample
of labelled documents (``SAMPLE`` hash buckets a language, one document each at most); the sample is
all that comes to the driver. It is the same for the same table, and so is the model.

Null texts and texts without a letter are ``und`` with score 0. The smaller language
wins a tie. If there is no labelled text, every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import text_parts, tidied

WINDOW = 96
HIDDEN = 12
SAMPLE = 1024
STEPS = 260
BATCH = 192
UNKNOWN = "und"
#: How many held-out documents a threshold needs, and what part of their score is asked.
LEAST_ROWS = 30
#: Texts of this bit length (1024 bytes) and longer ones share a threshold.
LONGEST_BITS = 11
ASKED = 0.95


@dataclass
class Model:
    """Weights, and the languages in ascending order. For either direction: E (3H, 256) what a byte
    adds to the gates, U (3H, H) what the state adds, V (classes, H) its part in
    the labels; c (classes, 1)."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def _step(e: np.ndarray, u: np.ndarray, h: np.ndarray, hidden: int):
    """One step of the unit: reset gate, update gate, candidate, new state."""
    s = u @ h
    gates = np.clip(e[: 2 * hidden] + s[: 2 * hidden] + 0.5, 0, 1)
    r, z = gates[:hidden], gates[hidden:]
    n = np.clip(e[2 * hidden :] + r * s[2 * hidden :], -1, 1)
    return r, z, n, s[2 * hidden :], h + z * (n - h)


def labels(model: Model, x: np.ndarray) -> np.ndarray:
    """Probabilities (time, classes, windows) of every position of windows x (time, windows) of bytes."""
    w, steps, width = model.weights, *x.shape
    k = len(model.languages)
    hidden = w["Uf"].shape[1]
    out = np.empty((steps, k, width), np.float32)
    out[:] = w["c"]
    a, s = np.empty((3 * hidden, width), np.float32), np.empty((3 * hidden, width), np.float32)
    for way, times in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        e, u, v = w["E" + way], w["U" + way], w["V" + way]
        h = np.zeros((hidden, width), np.float32)
        for t in times:
            np.take(e, x[t], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=s)
            gates, n, m = a[: 2 * hidden], a[2 * hidden :], s[2 * hidden :]
            gates += s[: 2 * hidden]
            gates += np.float32(0.5)
            np.clip(gates, 0, 1, out=gates)
            m *= gates[:hidden]
            n += m
            np.clip(n, -1, 1, out=n)
            n -= h
            n *= gates[hidden:]
            h += n
            out[t] += v @ h
    out -= out.max(1, keepdims=True)
    np.exp(out, out=out)
    out /= out.sum(1, keepdims=True)
    return out


def _gradients(w: dict, x: np.ndarray, y: np.ndarray, valid: np.ndarray) -> tuple[float, dict]:
    """Mean cross entropy over the positions, and its gradients, by backpropagation through time."""
    steps, width = x.shape
    hidden, k = w["Uf"].shape[1], w["c"].shape[0]
    trace, logits = {}, np.repeat(w["c"][None], steps, 0) + np.zeros((steps, k, width), np.float32)
    for way, times in (("f", list(range(steps))), ("b", list(range(steps - 1, -1, -1)))):
        h, seen = np.zeros((hidden, width), np.float32), []
        for t in times:
            r, z, n, m, new = _step(w["E" + way][:, x[t]], w["U" + way], h, hidden)
            seen.append((t, h, r, z, n, m, new))
            h = new
            logits[t] += w["V" + way] @ h
        trace[way] = seen
    logits -= logits.max(1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(1, keepdims=True)
    total = valid.sum()
    picked = p[np.arange(steps)[:, None], y[None, :], np.arange(width)[None, :]]
    loss = float(-(np.log(picked + 1e-9) * valid).sum() / total)
    p[np.arange(steps)[:, None], y[None, :], np.arange(width)[None, :]] -= 1
    p *= (valid / total)[:, None, :]
    g = {"c": p.sum((0, 2))[:, None]}
    flat = x.reshape(-1)
    order = np.argsort(flat, kind="stable")
    byte, start = np.unique(flat[order], return_index=True)
    for way, seen in trace.items():
        u, v = w["U" + way], w["V" + way]
        du, dv = np.zeros_like(u), np.zeros_like(v)
        de = np.empty((steps, 3 * hidden, width), np.float32)
        dh = np.zeros((hidden, width), np.float32)
        for t, h, r, z, n, m, new in reversed(seen):
            dv += p[t] @ new.T
            dh = dh + v.T @ p[t]
            dn = dh * z * (np.abs(n) < 1)
            dz = dh * (n - h) * ((z > 0) & (z < 1))
            dr = dn * m * ((r > 0) & (r < 1))
            d = de[t]
            d[:hidden], d[hidden : 2 * hidden], d[2 * hidden :] = dr, dz, dn
            ds = np.concatenate([dr, dz, dn * r])
            du += ds @ h.T
            dh = dh * (1 - z) + u.T @ ds
        ge = np.zeros_like(w["E" + way])
        ge[:, byte] = np.add.reduceat(de.transpose(1, 0, 2).reshape(3 * hidden, -1)[:, order], start, axis=1)
        g |= {"E" + way: ge, "U" + way: du, "V" + way: dv}
    return loss, g


def train(texts: list[bytes], langs: list[str], hidden: int = HIDDEN, window: int = WINDOW, steps: int = STEPS, batch: int = BATCH, seed: int = 7) -> Model:
    """A model of labelled texts; every language is drawn as often as any other."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    k = max(1, len(names))
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    w = {"c": np.zeros((k, 1), np.float32)}
    for way in "fb":
        w |= {"E" + way: draw(3 * hidden, 256), "U" + way: draw(3 * hidden, hidden), "V" + way: draw(k, hidden)}
    by = [[t for t, x in zip(texts, langs) if x == name and t] for name in names]
    by = [(i, x) for i, x in enumerate(by) if x]
    first, second = ({n: np.zeros_like(a) for n, a in w.items()} for _ in range(2))
    for step in range(1, steps + 1 if len(by) > 1 else 1):
        x, y = np.zeros((window, batch), np.uint8), np.zeros(batch, np.int64)
        for j in range(batch):
            lang, own = by[rng.integers(len(by))]
            text = own[rng.integers(len(own))]
            at = int(rng.integers(max(1, len(text) - window // 2)))
            part = np.frombuffer(text[at : at + window], np.uint8)
            x[: len(part), j], y[j] = part, lang
        _, g = _gradients(w, x, y, (x > 0).astype(np.float32))
        norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        rate = 0.02 * (1 - step / (steps + 1)) + 0.0005
        for n in w:
            a = g[n] * min(1.0, 1.0 / (norm + 1e-9))
            first[n] = 0.9 * first[n] + 0.1 * a
            second[n] = 0.99 * second[n] + 0.01 * a * a
            w[n] -= (rate * first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Model(names, {n: np.ascontiguousarray(a, np.float32) for n, a in w.items()})


def held_out(key: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SAMPLE) -> list[tuple[bytes, str]]:
    """(text, language) of at most ``size`` documents a language for training: of each of ``size`` hash
    buckets the document whose text has the smallest hash. Of a long text the part
    sampled is 1024 characters from a place that its hash gives."""
    usable = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0) & ~held_out(F.col(key)))
    hashed = usable.select(F.col(lang).alias("y"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("x"))
    least = hashed.groupBy("y", F.pmod(F.col("h"), F.lit(size)).alias("bucket")).agg(F.min("h").alias("h")).select("y", "h")
    part = F.expr("substring(x, 1 + cast(pmod(shiftright(h, 20), greatest(1, char_length(x) - 1024)) as int), 1024)")
    rows = hashed.join(F.broadcast(least), ["y", "h"], "left_semi").select("y", "h", part.alias("x")).distinct().sort("y", "h").collect()
    return [(r["x"].encode(), r["y"]) for r in rows]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    rows = sample(docs, key, text, lang)
    return train([x for x, _ in rows], [y for _, y in rows])


def pooled(model: Model, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, width: int = 2048) -> np.ndarray:
    """Mean probabilities (texts, classes) over all positions of each text."""
    size = np.diff(offsets)
    parts = -(-size // window)
    of = np.repeat(np.arange(len(size)), parts)
    number = np.arange(len(of)) - (np.cumsum(parts) - parts)[of]
    start = offsets[:-1][of] + number * window
    length = np.minimum(window, offsets[1:][of] - start)
    sums = np.zeros((len(size), len(model.languages)))
    for a in range(0, len(of), width):
        s, n = start[a : a + width], length[a : a + width]
        at = s[None, :] + np.arange(window)[:, None]
        valid = np.arange(window)[:, None] < n[None, :]
        x = np.where(valid, data[np.minimum(at, len(data) - 1)], 0)
        p = labels(model, x)
        np.add.at(sums, of[a : a + width], np.einsum("tkw,tw->wk", p, valid.astype(np.float32)))
    return sums / np.maximum(size, 1)[:, None]


def thresholds(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang: str = "lang") -> list[float]:
    """By the bit length of a text's number of bytes, the score that shows a learned language: a part (``ASKED``)
    of the lowest score of held-out documents of that or a larger bit length, among those whose language the
    network finds. Every labelled held-out document counts, with its whole text; a row a bit length comes to the
    driver. Where fewer than ``LEAST_ROWS`` are left, that of shorter texts; with too few in all, 0."""
    out = [0.0] * 40
    if not model.languages:
        return out
    held = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & held_out(F.col(key)))
    scored = predict(held.select(F.col(text).alias("text"), F.col(lang).alias("lang")), model).filter("lang_pred = lang")
    rows = scored.groupBy(F.least(_bit_length("text"), F.lit(LONGEST_BITS)).alias("bits")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).collect()
    for b in range(len(out)):
        some = [r for r in rows if r["bits"] >= b]
        out[b] = ASKED * min(r["least"] for r in some) if sum(r["n"] for r in some) >= LEAST_ROWS else out[max(0, b - 1)]
    return out


def _bit_length(text: str) -> Column:
    return F.length(F.bin(F.octet_length(text)))


def shown(thresholds_: list[float], text: str = "text") -> Column:
    """Whether a predicted row's text has letters and a score that shows a learned language."""
    asked = F.element_at(F.array(*map(F.lit, thresholds_)), _bit_length(text) + 1)
    return F.col(text).rlike(r"\p{L}") & (F.col("score") >= asked)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of their names."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = names.index(text)
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches):
        model_ = shared.value
        k = len(model_.languages)
        for b in batches:
            data, offsets = text_parts(b.column(at))
            letters = b.column(len(names)).to_numpy(zero_copy_only=False)
            best, score = np.zeros(len(letters), int), np.zeros(len(letters))
            if k:
                p = pooled(model_, data, offsets)
                best, score = p.argmax(1), np.clip(p.max(1), 0, 1)
            langs = [model_.languages[i] if ok and k else UNKNOWN for i, ok in zip(best, letters)]
            score[~letters] = 0
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(langs, pa.string()), pa.array(score)], names=[f.name for f in schema])

    schema = T.StructType([*inner.schema.fields[: len(names)], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = inner.mapInArrow(tidied(predicted), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "lang_pred", "score")
