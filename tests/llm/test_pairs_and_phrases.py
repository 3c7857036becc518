"""op11 to op13 against plain Python: nulls, empty and odd texts, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers as PT
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from repolens.llm import align, phrases, quality
from repolens.llm.common import text_parts

A, B = PT.path("byte_bpe_50k.json"), PT.path("piece_bpe_32k.model")
ODD = [None, "", " ", "   ", "a ", " a  b ", "\n\n x\ty\r\n", "don't we'll <s> </s> <|endoftext|> <0x41>", "▁ under", "日本語 and ' ' 12３", "ﬁ ​\xa0é é \x00z", "a" * 3000, "the cat the cat the cat " * 400, "👍🏽 ok"]


def plain_alignment(texts):
    """Rows of op12 by the two libraries on whole texts."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {}
    own = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    for x in range(256):
        letters[chr(x) if x in own else chr(256 + [y for y in range(256) if y not in own].index(x))] = x
    rows, links = [], []
    for t in texts:
        rows.append(dict(n_a=0, n_b=0, n_groups=0, n_links=0, groups_sha256=""))
        links.append([])
        if not t:
            continue
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
        if b"".join(ba) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            continue
        ea, eb = [], []
        for parts, ends in ((ba, ea), (bb, eb)):
            at = 0
            for p in parts:
                at += len(p)
                ends.append(at)
        common, groups, x, y = sorted(set(ea) & set(eb)), [], 0, 0
        for e in common:
            u, v = ea.index(e, x) + 1, eb.index(e, y) + 1
            groups.append(",".join(map(str, ia[x:u])) + "|" + ",".join(map(str, ib[y:v])))
            links[-1].append((ia[u - 1], ib[v - 1]))
            x, y = u, v
        rows[-1] = dict(n_a=len(ia), n_b=len(ib), n_groups=len(groups), n_links=len(links[-1]), groups_sha256=hashlib.sha256(";".join(groups).encode()).hexdigest())
    count = Counter(x for l in links for x in l)
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    for r, l in zip(rows, links):
        r["n_best"], r["count_sum"] = sum(count[x] == top[x[1]] for x in l), sum(count[x] for x in l)
    return rows, count, links


@pytest.mark.parametrize("block_bytes", [align.BLOCK_BYTES, 200])
def test_alignment_is_that_of_whole_texts(spark, block_bytes, monkeypatch):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(["the ", "cat", " ", "é", "ing", "\n", "12", "，", "un", "'s"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += texts[:40]
    df = spark.createDataFrame([(i, t, "c", 7) for i, t in enumerate(texts)], "doc_id long, text string, a string, n_a int").repartition(3)
    inverted = align.invert(df, A, B, block_bytes=block_bytes)
    pairs = align.pair_counts(inverted)
    got = {r["c0"]: r.asDict() for r in align.scored(inverted, pairs).collect()}
    want, count, links = plain_alignment(texts)
    for i, w in enumerate(want):
        assert {k: got[i][k] for k in w} == w, texts[i]
    holders = Counter(x for l in links for x in set(l))
    assert {(r["a"], r["b"]): (r["count"], r["n_documents"]) for r in pairs.collect()} == {k: (n, holders[k]) for k, n in count.items()}
    whole = align.align(df, A, B)
    assert whole.columns == ["doc_id", "a", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert align.align(df.limit(0), A, B).count() == 0


def test_bitmaps_hold_their_members():
    import numpy as np

    rng = np.random.default_rng(3)
    group, place = np.nonzero(rng.random((50, 999)) < rng.random((50, 1)) ** 3)
    data, bounds = align._bitmaps(group, place, 50, 999)
    of, at = align._members(align._binary(data, bounds))
    assert sorted(zip(of.tolist(), at.tolist())) == list(zip(group.tolist(), place.tolist()))
    assert {len(x) % 2 for x in align._binary(data, bounds).to_pylist()} == {0, 1}


def plain_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated)]


def test_quality_counts_are_those_of_plain_python():
    rng = random.Random(2)
    texts = ODD + ["x\nx", "x\nx\n", "\n\n", "x \nx\nx ", "#a|é b\x0bc", "a a a a", "a b c", "a b c a b c"]
    texts += ["".join(rng.choice(["a", "b ", " ", "\n", "é", "#", "\t", "a b\n"]) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    got = [list(map(int, x)) for x in zip(*quality.counts_of(*text_parts(pa.array(texts))))]
    assert got == [plain_counts(t) for t in texts]


def test_quality_bounds_follow_language_and_source(spark):
    rng = random.Random(4)

    def prose(size, n=80):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(size - 2, size + 2))) for _ in range(n))

    rows = [(i, prose(5), "en", "a", 1) for i in range(40)] + [(100 + i, prose(30), None, None, 1) for i in range(40)]
    rows += [(200, prose(30), "en", "a", 1), (201, prose(5), None, None, 1), (202, prose(5).replace(" ", "## "), "en", "a", 1), (203, prose(5), "en", "rare", 1), (204, prose(5).replace(" ", "## "), "xx", "rare", 1)]
    rows += [(205, None, "en", "a", 1), (206, "", None, "a", 1), (207, "a b c " * 40, "en", "a", 1), (0, rows[0][1], "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    out = quality.apply(df, least=20)
    assert out.columns == ["doc_id", "lang", "source", *quality.COUNTS, "base_failed", "kept"]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in out.collect()}
    assert all(got[i] == (False, True) for i in [*range(40), *range(100, 140), 203])
    assert [got[i] for i in (200, 201, 202, 204)] == [(False, False)] * 4
    assert [got[i] for i in (205, 206, 207)] == [(True, False)] * 3
    assert out.filter("doc_id = 0").count() == 2
    assert quality.apply(df.limit(0)).count() == 0


def test_quality_buckets_are_within_a_thirtysecond(spark):
    values = [*range(300), 1000, 4095, 4096, 12345, 10**9, 10**15]
    number = quality.bucket(F.col("v"))
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", number.alias("n"), quality.floor_of(number).alias("low")).collect()
    assert all(r["low"] <= r["v"] < r["low"] + max(1, r["low"] / 32) + (r["low"] < 64) for r in rows)
    assert [r["n"] for r in rows] == sorted(r["n"] for r in rows)


def plain_frequencies(rows):
    f = Counter()
    for text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            f[lang or "und", ""] += len(w)
            for m in range(1, 6):
                f.update((lang or "und", " ".join(w[i : i + m])) for i in range(len(w) - m + 1))
    return f


def plain_collocations(rows, least, top):
    f = {k: n for k, n in plain_frequencies(rows).items() if n >= least or k[1] == ""}
    found = defaultdict(list)
    for (lang, phrase), a in f.items():
        w = phrase.split(" ")
        if len(w) < 2:
            continue
        n, cuts = f[lang, ""], []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        if not any(b >= a and x == lang and f" {phrase} " in f" {y} " and len(y.split(" ")) > len(w) for (x, y), b in f.items()):
            found[lang].append((-score, -a, phrase.encode(), left, right, n))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n, -s) for lang, x in found.items() for i, (s, a, p, left, right, n) in enumerate(sorted(x)[:top]))


def phrase_rows():
    rng = random.Random(11)
    words = ["the", "Cat", "é", "日本", "o'x", "UN", "a-b", "#", "zz", "of"]
    made = [("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", " ,", "\x0c", "\xa0"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "fr", None])) for _ in range(200)]
    made += [("a " * 500, "en"), ("kick the bucket now " * 30, "fr"), (None, "en"), ("", None), ("und only", "und"), ("...", "xx"), ("one two three four five six", "de")]
    return made + made[:50] * 3


@pytest.mark.parametrize("sizes", [{}, dict(modulus=2, block_bytes=300, bucket_bytes=2000), dict(modulus=1)])
def test_collocations_are_those_of_plain_counting(spark, sizes):
    rows = phrase_rows()
    df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n int, chunk string").repartition(3)
    got = [tuple(r) for r in phrases.mine(df, least=4, top=60, **sizes).orderBy("lang", "rank").collect()]
    assert got == plain_collocations(rows, 4, 60)
    counted = {(r["lang"], r["phrase"]): r["f"] for r in phrases.frequencies(df, 4, **sizes).collect() if r["f"]}
    assert counted == {k: n for k, n in plain_frequencies(rows).items() if n >= 4 or k[1] == "" and n}


def test_no_collocations_without_rows(spark):
    assert phrases.mine(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.mine(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        a = rng.randint(1, 10 ** rng.randint(1, 14))
        left, right = (a + rng.randint(0, 10 ** rng.randint(1, 15)) for _ in range(2))
        rows.append((a, max(left, right) + rng.randint(0, 10**16), left, right))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long").select("*", phrases.score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s"))
    assert all(r["s"] == 1000 * r["a"] * r["n"] // (r["l"] * r["r"]) for r in df.collect())
