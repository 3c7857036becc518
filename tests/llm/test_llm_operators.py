"""Operators on small tables: nulls, empty and odd texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as PT
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from repolens.llm import bpe, langid, lines, minhash, mixing, pii, pq, pretokens, queries, simple8b, warc, winnow
from repolens.llm.common import connected_components

RANKS = PT.path("byte_bpe_50k.tiktoken")
TEXTS = ["Hello  world's\n\nend ", None, "", "日本語 and '", "a" * 3000, "x\ny\nlonger than ten\nlonger than ten", "  Longer than TEN  ", "don't we'll <|endoftext|>", "x\ny\nlonger than ten\nlonger than ten"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, ["b", None, "a"][i % 3], 5, "c") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [(None, "no id at all", None, None, None, "c")], "doc_id long, text string, lang string, source string, n_chars long, ids string")


def test_bpe_is_tiktoken_and_decodes(docs):
    enc = tiktoken.Encoding("own", pat_str=PT.PATTERN, mergeable_ranks=pretokens.read_ranks(RANKS), special_tokens={})
    got = bpe.decode(bpe.encode(docs, RANKS, chunk_bytes=1000), RANKS, digest="sha").collect()
    assert len(got) == docs.count()
    for r in got:
        assert list(r["ids"]) == enc.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
        assert r["sha"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    assert bpe.encode(docs.limit(0), RANKS).count() == 0


def test_simple8b_files_hold_the_library_ids(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PT.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    path = str(tmp_path / "shards")
    simple8b.write_documents(docs, PT.path("byte_bpe_50k.json"), path, shard_bytes=1000)
    want, start = {}, 0
    for i, text in [(None, "no id at all"), *enumerate(TEXTS)]:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in simple8b.index(spark, path).collect()} == want
    assert {r["doc_id"]: len(r["ids"]) for r in simple8b.read(spark, path).collect()} == {i: n for i, (_, n, _) in want.items()}


def test_simple8b_query_gives_the_ids_of_the_untouched_library(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [*TEXTS, f"a {end} b", end, end * 2, f"x{end} don't{end}", "<|endof", "text|>", f"é{end}日本 {end[:-1]}", "last <|endoftext"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    t, want, start = Tokenizer.from_file(PT.path("byte_bpe_50k.json")), {}, 0
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = queries.op10_simple8b(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want


def test_next_row_and_likeness(docs):
    rows = docs.filter("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for n in (1, 2, 5):
        got = {r["doc_id"]: r["next_text"] for r in winnow.with_next(rows, "doc_id", ["text"], n).collect()}
        assert got == {i: TEXTS[i - 1] or "" for i in range(len(TEXTS))}
    prints = winnow.fingerprint(rows, {"text": "a"})
    assert prints.filter(F.size("a_hashes") == 0).count() == 2
    one = prints.select(winnow.likeness(F.col("a_hashes"), F.col("a_hashes")).alias("x")).distinct().collect()
    assert [r["x"] for r in one] == [1.0]


def test_line_dedup_and_its_reversal(spark, docs):
    some = docs.filter("doc_id in (5, 6, 8)").select("doc_id", "text")
    out = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in lines.dedup(docs).collect()}
    assert out[5] == (4, 0, TEXTS[5]) and out[6] == (1, 1, "") and out[8] == (4, 2, "x\ny") and out[1] == (1, 0, "") and out[2] == (1, 0, "")
    index = lines.insert(lines.empty(spark), some.filter("doc_id != 5"))
    before = sorted(index.counts.collect())
    both = lines.insert(index, some.filter("doc_id = 5"))
    assert sorted((r["docs"], r["first"]) for r in both.counts.collect()) == [(3, 5)]
    back = lines.delete(both, some.filter("doc_id = 5"))
    assert sorted(back.counts.collect()) == before
    none = lines.delete(back, some)
    assert none.counts.count() == 0
    assert lines.probe(both.counts, both.filters, both.bits).filter("known").count() == 1
    assert lines.probe(both.counts, none.filters, none.bits).filter("known").count() == 0
    assert lines.dedup(docs.limit(0)).count() == 0


def _components(texts, k=4):
    def shingled(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    sets, low = [shingled(t) for t in texts], list(range(len(texts)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                low[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("few", [False, True])
def test_minhash_links_families_chains_and_passages(spark, monkeypatch, few):
    if few:  # several rounds of pivots, rooms and salts
        for name, value in {"FIRST": 2, "PIVOTS": 3, "BLOCK": 400, "SALTED": 4}.items():
            monkeypatch.setattr(minhash, name, value)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    base, passage = [rng.choice(words) for _ in range(150)], " ".join(rng.choice(words) for _ in range(60))
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 5])):
            copy[rng.randrange(150)] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.choice([8, 12, 15, 60]))) for _ in range(40)]
    texts += ["", None, "a b", "A  B\n", " "] + texts[:3]
    rng.shuffle(texts)
    component, size = _components(texts)
    got = sorted(minhash.link(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), words=4).collect())
    assert [r["component_id"] for r in got] == component and [r["n_shingles"] for r in got] == size
    assert minhash.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_of_null_and_repeated_ids_are_documents_of_their_own(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    bases = [text(rng.choice([8, 30, 200])) for _ in range(20)]
    near = [" ".join(b.split()[:-1] + ["other"]) for b in bases[:10] if len(b.split()) > 29]
    texts = bases + near + bases[:5] + ["", " ", None]
    ids = [None if i % 3 == 0 else i % 4 for i in range(len(texts))]
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is None, ids[i] or 0, i))
    texts, ids = [texts[i] for i in order], [ids[i] for i in order]
    component, size = _components(texts, 5)
    table = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    id_ = lambda i: minhash.NO_ID if ids[i] is None else ids[i]
    got = minhash.link(table).collect()
    assert sorted((r["id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((id_(i), size[i], id_(component[i])) for i in range(len(texts)))
    assert sum(r["kept"] for r in got) == len(set(component)) < len(texts)
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, table, None).collect()]
    groups = {frozenset(texts[j] for j in range(len(texts)) if component[j] == c): ids[c] for c in set(component) if size[c]}
    assert len(left) == len(set(component)) and all(sum(t in g and i == first for i, t in left) == 1 for g, first in groups.items())


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(200, 100 + i) for i in range(20)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 120)}, 200: 100}


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    x = np.concatenate([base, base[:10] + rng.standard_normal((10, 16)) * 0.1, base[:3] * 2, np.repeat(base[:1], 5, 0) + rng.standard_normal((5, 16)) * 0.3, base[5:6]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [1.0, 2.0])]
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in pq.link(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), block=8).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    found = sum(got[i][0] for i in range(len(x))) / (near.sum() - len(x))
    assert 0.9 <= found <= 1.0
    assert all(got[i] == (0, i) for i, _ in odd)
    assert pq.link(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(10**6, None, "en"), (10**6 + 1, "", None), (10**6 + 2, "12 !?", None)], docs.schema)
    out = langid.predict(docs.union(extra), langid.fit(docs)).cache()
    test = out.filter(langid.held_out(F.col("doc_id")) & (F.col("doc_id") < 10**6))
    assert test.filter("lang = lang_pred").count() >= 0.95 * test.count()
    assert {(r["lang_pred"], r["score"]) for r in out.filter("doc_id >= 1000000").collect()} == {("und", 0.0)}
    assert out.filter("score < 0 or score > 1").count() == 0


def test_language_gradients():
    rng = np.random.default_rng(0)
    w = langid.train([b"ab", b"cd"], ["x", "y"], hidden=3, window=4, steps=1, batch=2).weights
    w = {n: a.astype(float) for n, a in w.items()}
    x, y, valid = rng.integers(97, 101, (5, 6)), np.array([0, 1, 0, 1, 1, 0]), np.ones((5, 6))
    _, g = langid._gradients(w, x, y, valid)
    for name in ("Uf", "Vb", "Eb", "c"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        value, h = w[name][at], 1e-4
        w[name][at] = value + h
        up = langid._gradients(w, x, y, valid)[0]
        w[name][at] = value - h
        down = langid._gradients(w, x, y, valid)[0]
        w[name][at] = value
        assert abs((up - down) / (2 * h) - g[name][at]) < 1e-3


def test_mixing_meets_targets(spark, docs):
    rows = [(i, "w " * (1 + i % 50), "big" if i % 3 else "small") for i in range(900)]
    planned = mixing.report(mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    for r in planned.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 50
    assert planned.filter("taken > 3 * size").count() == 0
    mixed = [r["doc_id"] for r in mixing.mix(docs).collect()]
    assert mixed == [r["doc_id"] for r in mixing.mix(docs).collect()]
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs.limit(0)).count() == 0


def test_warc_rejects_magic_in_payloads(spark, tmp_path):
    def record(p):
        return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: {len(p.encode())}\r\n\r\n{p}\r\n\r\n"

    rows = []
    for i in range(60):
        b = "é" * (i % 90) + "x" * (i * 7 % 400)
        b = f"pre WARC/1.0\r\n mid {b} WARC/1.0\r\nContent-Length: 5\r\n\r\nabc" if i % 5 == 0 else b
        b = b + record("inner " + b) + "tail" if i % 7 == 0 else b
        b = "same" * 40 if i % 11 == 0 else b
        rows.append((i, f"http://x/{i}\r\nWARC-Type: bad" if i % 3 else None, None if i % 13 == 0 else b))
    path = str(tmp_path / "warc")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = {r["page"]: r for r in warc.read(spark, path).withColumn("page", warc.page_number(F.col("id"))).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == len(rows)
    firsts = {}
    for i, _, body in rows:
        raw = (body or "").encode()
        digest = hashlib.sha256(raw).hexdigest()
        first = firsts.setdefault(digest, i) if len(raw) >= 100 else i
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"], r["type"]) == (len(raw), digest, "response" if first == i else "revisit")
        assert r["refers_to"] == (None if first == i else f"<urn:page:{first}>")


def test_surrogates_are_consistent_and_keep_their_format(spark):
    texts = [
        "Mail Und.34@mail7.example.com or und.34@MAIL7.example.com, call +1 (017) 555-7713.",
        "4111 1111 1111 1111 and 4111111111111111, ip 8.196.197.208 and 10.0.0.1; Frau Schmidt met г-н Петров.",
        'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" und.34@mail7.example.com',
        None,
        "",
        "nothing here, version 3.0",
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_entities int")
    got = {r["doc_id"]: r for r in pii.replace(df).collect()}
    assert [got[i]["n_entities"] for i in range(6)] == [3, 6, 2, 0, 0, 0]
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == texts[5]
    mail = re.findall(r"\S+@\S+\w", got[0]["text"])
    assert mail[0].lower() == mail[1].lower() == re.findall(r"\S+@\S+\w", got[2]["text"])[0] and mail[0][0].isupper()
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", got[1]["text"])
    digits = [int(c) for c in cards[1]]
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111"
    assert sum(sum(divmod(d * 2, 10)) if i % 2 == 0 else d for i, d in enumerate(digits)) % 10 == 0
    assert "Schmidt" not in got[1]["text"] and re.search(r"Frau [A-Z][a-z]+", got[1]["text"]) and re.search(r"г-н [А-ЯЁ][а-яё]+", got[1]["text"])
    many = spark.createDataFrame([(i, f"1.2.{i // 250 % 9}.{i % 9} and u{i}@a.b.example.com") for i in range(400)], "doc_id long, text string")
    names = many.select(F.explode(pii.entities(F.col("text"))).alias("entity")).distinct()
    pairs = pii.surrogates(names).collect()
    assert len({r["surrogate"] for r in pairs}) == len(pairs) == names.count()


def test_surrogates_find_names_and_numbers_of_many_forms(spark):
    one = ["Mr John Fitzgerald Kennedy", "Mr John F. Kennedy", "Dr. J. Smith", "Mr. O'Neil", "Mrs McDonald", "Frau von der Leyen", "Dr. 李明", "السيد محمد علي", "מר כהן", "Ms SMITH"]
    one += ["555 123 4567", "3782 822463 10005", "2001:db8::8a2e:370:7334", "fe80::1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"]
    plain = ["at 12:30:45 std::vector a::b", "Mr and Dr", "version 1.2.3", "00:1a:2b:3c:4d:5e"]
    table = spark.createDataFrame([(i, f"x ({e}), y") for i, e in enumerate(one)] + [(100 + i, t) for i, t in enumerate(plain)], "doc_id long, text string")
    found = {r["doc_id"]: r["e"] for r in table.select("doc_id", pii.entities(F.col("text")).alias("e")).collect()}
    assert found == {**{i: [e] for i, e in enumerate(one)}, **{100 + i: [] for i in range(len(plain))}}
    same = [("Mr. Smith", "Mr Smith"), ("Dr. Anna Weber", "Dr Anna Weber"), ("Mr O'Neil", "Mr. O’NEIL"), ("Dr J.R. Smith", "Dr. J. R. Smith"), ("2001:DB8::1", "2001:db8:0:0:0:0:0:0001")]
    forms = spark.createDataFrame([(e,) for e in [*one, *(x for pair in same for x in pair)]], "entity string").distinct()
    got = {r["entity"]: r["surrogate"] for r in pii.surrogates(forms).collect()}
    for a, b in same:
        assert got[a].lower().replace(".", "") == got[b].lower().replace(".", "") and got[a] != a, (a, b)
    assert re.fullmatch(r"\d{3} \d{3} \d{4}", got["555 123 4567"]) and re.fullmatch(r"3\d{3} \d{6} \d{5}", got["3782 822463 10005"])
    assert re.fullmatch(r"2001:db8(:[0-9a-f]{1,4}){6}", got["fe80::1"]) and re.match(r"السيد [\u0600-\u06ff]+", got["السيد محمد علي"]) and re.match(r"Dr\. [\u4e00-\u9fff]+$", got["Dr. 李明"])
    for e in one[:6]:
        assert not set(re.findall(r"[A-Z]\w+", e)[1:]) & set(re.findall(r"\w+", got[e]))


def test_surrogates_of_formats_with_few_values(spark):
    mails = [f"{chr(97 + i % 26)}@host{i}.com" for i in range(1000)]
    phones = [f"+1 {i // 100 + 10} {i % 100:02d}" for i in range(100, 8000, 2)]
    found = spark.createDataFrame([(e,) for e in mails + [m.upper() for m in mails[:50]] + phones], "entity string")
    got = {r["entity"]: r["surrogate"] for r in pii.surrogates(found).collect()}
    assert len(got) == 1000 + 50 + len(phones)
    assert len({got[m] for m in mails}) == 1000 and len({got[p] for p in phones}) == len(phones)
    assert all(re.fullmatch(r"[a-z][0-9a-f]*@example\.com", got[m]) for m in mails) and not set(got.values()) & set(got)
    assert all(got[m.upper()] == got[m].upper() for m in mails[:50])


def test_pipeline_on_a_small_table(spark, docs):
    table = docs.drop("ids")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, None)
        assert out.columns == table.columns, name
        table = spark.createDataFrame(out.collect(), out.schema)
        if name == "language":
            assert table.filter("text is null or text = ''").count() == 0 and table.count() == 8
        if name == "near_dedup":
            assert table.filter("doc_id in (5, 8)").count() == 2  # their lines differ by now
    last = corpus_pipeline.STAGES[-1][1](spark, table, None)
    assert last.count() == table.count()


def test_pipeline_language_rejects_what_the_network_does_not_know(spark):
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(1)
    noise = ["".join(rng.choice("0123456789abcdef") for _ in range(400)), "if (x==0) { return y[i]; } " * 20, "საქართველო არის ქვეყანა " * 10]
    rows = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    both = clean.unionByName(rows.withColumn("doc_id", F.col("doc_id").cast(clean.schema["doc_id"].dataType)), allowMissingColumns=True)
    left = [r["doc_id"] for r in corpus_pipeline.language(spark, both, None).select("doc_id").collect()]
    assert not [i for i in left if i >= 10**6]
    assert len(left) >= 0.995 * clean.count()


def test_pipeline_run_without_labels_against_plain_python(spark, tmp_path):
    enc = tiktoken.Encoding("own", pat_str=PT.PATTERN, mergeable_ranks=pretokens.read_ranks(RANKS), special_tokens={})
    texts = ["one clean text", "another of them", "日本語", "", None, "12 !?", "one  Clean text"]
    spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(enc.encode_ordinary(texts[i])) for i in (0, 1, 2)} and len(got) == 3


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 1500])
def test_words_whose_hashes_meet_get_their_own_ids(spark, tmp_path, chunk_bytes):
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    texts = [one, other, one + " " + other, other + " x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    enc = tiktoken.Encoding("own", pat_str=PT.PATTERN, mergeable_ranks=pretokens.read_ranks(RANKS), special_tokens={})
    got = bpe.decode(bpe.encode(df, RANKS, chunk_bytes=chunk_bytes), RANKS).collect()
    assert all(list(r["ids"]) == enc.encode_ordinary(texts[r["doc_id"]]) and bytes(r["decoded"]).decode() == texts[r["doc_id"]] for r in got)
    simple8b.write_documents(df, PT.path("byte_bpe_50k.json"), str(tmp_path / "s"), shard_bytes=chunk_bytes)
    assert {r["doc_id"]: r["ids"] for r in simple8b.read(spark, str(tmp_path / "s")).collect()} == {i: [*enc.encode_ordinary(t), 0] for i, t in enumerate(texts)}


def test_equal_rows_are_dealt_to_several_chunks(spark):
    df = spark.createDataFrame([("the same text again",)] * 1000, "text string").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = bpe.encode(df, RANKS, chunk_bytes=1000).select(F.array_join("ids", ",").alias("ids"), F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 1000 and len({r["ids"] for r in rows}) == 1 and len({r["p"] for r in rows}) > 1


def test_next_rows_of_equal_and_null_keys_form_one_ring(spark):
    rng = random.Random(3)
    rows = [(k, f"{k}-{i}") for i, k in enumerate([None] * 300 + [7] * 300 + rng.sample(range(1000), 300))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (1, 4, 40):
        got = {r["text"]: r["next_text"] for r in winnow.with_next(df, "doc_id", ["text"], n).collect()}
        assert len(got) == len(rows) == len(set(got.values()))
        seen, at = [], max(got, key=lambda t: -1 if t[0] == "N" else int(t.split("-")[0]))
        for _ in rows:
            seen.append(at)
            at = got[at]
        assert len(set(seen)) == len(rows)
        keys = [-1 if t[0] == "N" else int(t.split("-")[0]) for t in seen]
        i = keys.index(max(keys))
        assert keys[i:] + keys[:i] == sorted(keys, reverse=True) or sorted(keys[:i] + keys[i:], reverse=True) == keys


def test_edited_likeness_is_that_of_plain_python(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, "é" * 200 + "abc" * 50), (50, "the end " * 40)]
    got = {r["doc_id"]: r for r in queries.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted((i for i, _ in rows), reverse=True)
    text = {i: t or "" for i, t in rows}
    prints = {r["doc_id"]: r["fingerprint"] for r in got.values()}

    def grams(fingerprint):
        return {fingerprint[i : i + 8] for i in range(0, len(fingerprint), 8)}

    for i, j in zip(order, order[1:] + order[:1]):
        n = len(text[i]) // 2
        edited = text[i][: len(text[i]) - n] + text[j][:n]
        r, a, b, c = got[i], grams(prints[i]), grams(got[i]["edited_fingerprint"]), grams(prints[j])
        assert r["n_chars"] == len(text[i]) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == (len(a & b) / len(a | b) if a | b else 1.0) and r["near_next"] == (len(a & c) / len(a | c) if a | c else 1.0)


def plain_line_dedup(rows, low=10):
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)}) for x in (t or "").split("\n")] for _, t in rows]
    held = {}
    for (i, _), ks in zip(rows, keys):
        for k in ks:
            if len(k) >= low:
                held.setdefault(k, set()).add(float("inf") if i is None else i)
    out = []
    for (i, t), ks in zip(rows, keys):
        me = float("inf") if i is None else i
        lines_ = (t or "").split("\n")
        stay = [x for x, k in zip(lines_, ks) if not (k in held and len(held[k]) > 1 and min(held[k]) != me)]
        out.append((i, len(lines_), len(lines_) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_line_dedup_asks_the_filters_of_batches_before(spark, batches, monkeypatch):
    rng = random.Random(7)
    pool = [f"a line of number {i} of them" for i in range(60)] + ["short", "", "  A LINE of number 3 of them ", "été " * 5]
    rows = [(None if i % 3 == 0 else rng.randrange(70), rng.choice([None, "", "x\n"]) if i % 17 == 0 else "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))) for i in range(200)]
    rows += rows[:9]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked, probe = [], lines.probe
    monkeypatch.setattr(lines, "probe", lambda *a: asked.append(1) or probe(*a))
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in lines.dedup(df, batches=batches).collect()]
    assert sorted(got, key=str) == plain_line_dedup(rows)
    assert len(asked) == batches - 1


def test_counts_of_links_hold_for_both_ends_with_more_lists_than_probes(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((10_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = rng.standard_normal(x.shape)
    other -= (other * x).sum(1)[:, None] * x
    other /= np.linalg.norm(other, axis=1)[:, None]
    c = rng.uniform(0.9, 0.97, len(x))[:, None]
    x = np.concatenate([x, c * x + np.sqrt(1 - c**2) * other])
    want_links, want = np.zeros(len(x), int), 0
    for i in range(0, len(x), 2000):
        near = x[i : i + 2000] @ x.T >= 0.9
        want_links[i : i + 2000] = near.sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    assert len(x) // pq.LIST_SIZE >= 128
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in pq.link(df).collect()}
    found = sum(n for n, _ in got.values()) / want_links.sum()
    members = {}
    for i, (_, g) in got.items():
        members.setdefault(g, []).append(i)
    assert found >= 0.99
    assert all(got[i][0] > 0 for m in members.values() if len(m) > 1 for i in m)
    assert all(got[i][0] <= want_links[i] for i in got)


def test_pipeline_behind_its_first_stage_against_plain_python(spark, tmp_path):
    import duckdb

    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 90").orderBy("doc_id").collect()
    texts = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in base]
    made = []
    for k, (_, t, lang, source) in enumerate(texts[:30]):
        w = t.split(" ")
        made.append((1000 + k, " ".join(w[: len(w) // 2] + ["changed"] + w[len(w) // 2 + 1 :]), lang, source))
        made.append((2000 + k, t + "\nThis line stands in many documents\nshort", lang, source))
    rows = texts + made + [(3000, texts[3][1], "en", None), (3001, None, None, None), (3002, "", "en", "x")]
    table = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    kept = sorted((r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.language(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), None).collect())
    assert len(kept) >= len(rows) - 4
    source = {i: s for i, _, s in kept}
    deduped = [(i, t) for i, _, _, t in plain_line_dedup([(i, t) for i, t, _ in kept])]
    deduped.sort()
    sets, low = [], {}
    for i, t in deduped:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        sets.append((i, {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()))
        low[i] = i
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                u, v = low[i], low[j]
                low = {k: min(u, v) if g in (u, v) else g for k, g in low.items()}
    single = [(i, t, source[i]) for i, t in deduped if low[i] == i]
    assert len(single) < len(deduped)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", single)
    enc = tiktoken.Encoding("own", pat_str=PT.PATTERN, mergeable_ranks=pretokens.read_ranks(RANKS), special_tokens={})
    want, text = [], {i: t for i, t, _ in single}
    for i, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({queries.OP9_SQL})").fetchall():
        ids = enc.encode_ordinary(text[i])
        want += [(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())] * (taken // size if size else 0)
    assert got == sorted(want)


@pytest.fixture(scope="module")
def no_rows(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "embeddings", "pages"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.mark.parametrize("name", [*queries.QUERIES, "pipeline"])
def test_empty_tables_give_empty_results(spark, no_rows, name):
    run = corpus_pipeline.run if name == "pipeline" else queries.QUERIES[name]
    assert run(spark, no_rows).count() == 0


def test_rows_without_an_id_are_mixed_and_linked_each(spark):
    rng = random.Random(5)
    rows = [(None if i % 3 == 0 else i, " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 9))), rng.choice(["x", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mixing.plan(df).collect()
    assert len(planned) == 300
    for source in ("x", None):
        own = [r for r in planned if r["source"] == source]
        size = sum(r["size"] for r in own)
        assert sorted(r["before"] for r in own if r["size"]) == sorted({r["before"] for r in own if r["size"]})  # words before a row are its own place
        assert max(r["before"] + r["size"] for r in own) == size
    vectors = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.1]), (3, [1.0, 0.0]), (4, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(r["n_links"] for r in pq.link(vectors).collect()) == [0, 2, 2, 2]


def test_very_long_texts(spark):
    words = [f"w{i * 7919 % 5003}" for i in range(400_000)]
    long = " ".join(words)
    df = spark.createDataFrame([(1, long), (2, long[:-5] + "e é"), (3, "short")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in queries.edited_likeness(df).collect()}
    assert got[1]["n_chars"] == len(long) and got[2]["near_next"] > 0.9
    out = {r["doc_id"]: r for r in pii.replace(df.withColumn("text", F.concat("text", F.lit(" a@example.org")))).collect()}
    assert all(r["n_entities"] == 1 and "a@example.org" not in r["text"] for r in out.values())
