"""Each training-data operator against plain code on small tables, with nulls, empties, ties, repeated rows and extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.llm import bpe, common, decontaminate, graph, html_extract, near_copies, quality_rules, repeats, sharding, simhash, substring_dedup, suffix_dedup, token_output, url_filters

public_tokenizers = pytest.importorskip("public_tokenizers")
WS = re.compile(r"[^\x20\x09-\x0D]+")
random.seed(11)
BASE = ["".join(random.choice("abcdefgh ij\n") for _ in range(1400)) for _ in range(4)]


def made_rows():
    out = []
    for i in range(40):
        b, x = random.choice(BASE), random.randrange(0, 800)
        out.append((i, "".join(random.choice("xyz ") for _ in range(random.randrange(0, 40))) + b[x : x + random.randrange(300, 600)] + "é" + random.choice(BASE)[random.randrange(0, 900) :][: random.randrange(380, 450)], "en", f"s{i % 3}"))
    return out + [(100, None, None, None), (101, "", "en", "s0"), (102, "ab" * 700, "en", None), (103, "z" * 399, None, "s1"), (104, "z" * 900, "en", "s0"), (105, out[0][1], "en", "s0"), (105, out[0][1], "en", "s0"), (None, out[3][1], "de", "s0"), (106, "the cat sat " * 90, "en", "s0")]


ROWS = made_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), "extra") for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long, n string").repartition(3)


def ids(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def covered(seqs, length):
    count = Counter(s[i : i + length] for s in seqs for i in range(len(s) - length + 1))
    for s in seqs:
        out = np.zeros(len(s), bool)
        for i in range(len(s) - length + 1):
            if count[s[i : i + length]] > 1:
                out[i : i + length] = True
        yield out


def test_op1_counts_and_limits(spark, docs):
    got = {(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality_rules.query(docs).collect()}
    want = set()
    for d, t, *_ in ROWS:
        w = WS.findall(t or "")
        tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (t or "").split("\n") if WS.search(x)]
        want.add((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)))
    assert got == want
    assert quality_rules.query(docs.limit(0)).count() == 0
    kept = quality_rules.filtered(docs)
    assert kept.columns == docs.columns


def test_op1_rejects_odd_documents_of_a_group(spark):
    word = lambda: "".join(random.choice("abcdefghijklmnop") for _ in range(random.randrange(3, 8)))
    good = [(i, " ".join(word() for _ in range(80)), "en", "s") for i in range(300)]
    bad = [(1000 + i, " ".join(word() + "###" for _ in range(80)), "en", "s") for i in range(20)]
    # long words are odd among short ones, but not in a source that has many of them
    long = lambda: "".join(random.choice("abcdefghijklmnop") for _ in range(random.randrange(8, 24)))
    bad += [(2000 + i, " ".join(long() for _ in range(80)), "en", "s") for i in range(20)]
    other = [(3000 + i, " ".join(long() for _ in range(80)), "en", "t") for i in range(300)]
    df = spark.createDataFrame(good + bad + other, "doc_id long, text string, lang string, source string")
    assert {r["doc_id"] for r in quality_rules.query(df).filter("kept").collect()} == {g[0] for g in good + other}


def test_op1_very_long_text_and_clashing_names(spark):
    text = "word other\n" * 40_000
    df = spark.createDataFrame([(1, text, "en", "s", 5, "q", 7)], "doc_id long, text string, lang string, source string, n_words int, kept string, b int")
    (r,) = quality_rules.query(df).collect()
    assert (r["n_words"], r["n_dup_lines"], r["n_repeat_words"], r["kept"]) == (80_000, 39_999, 80_000, False)
    assert quality_rules.filtered(df).columns == df.columns


@pytest.mark.parametrize("large_buckets", [False, True])
def test_op2_and_op8_against_brute_force(docs, monkeypatch, large_buckets):
    if large_buckets:
        monkeypatch.setattr(repeats, "BUCKET", 1)
        monkeypatch.setattr(substring_dedup, "GROUP", 50)
    raw = [(t or "").encode() for _, t, *_ in ROWS]
    words = [tuple(b.split()) for b in raw]
    want = []
    for (d, *_), b, c, p in zip(ROWS, raw, covered(raw, 400), covered(words, 50), strict=True):
        want.append((d, len(b), int(c.sum()), int((np.diff(np.concatenate([[0], c.astype(int)])) == 1).sum()), hashlib.sha256(bytes(x for x, y in zip(b, c, strict=True) if not y)).hexdigest(), int(p.sum())))
    assert ids(tuple(r) for r in suffix_dedup.digests(docs).collect()) == ids(want)
    want = [(d, len(w), int(c.sum()), hashlib.sha256(b" ".join(x for x, y in zip(w, c, strict=True) if not y)).hexdigest()) for (d, *_), w, c in zip(ROWS, words, covered(words, 35), strict=True)]
    assert ids(tuple(r) for r in substring_dedup.digests(docs).collect()) == ids(want)


def test_op2_and_op8_texts(docs):
    rest = {r["doc_id"]: r for r in suffix_dedup.deduplicated(docs).collect()}
    assert rest[105]["text"] == "" and rest[103]["text"] == "z" * 399 and rest[100]["text"] is None and rest[105]["n_chars"] == 0 and rest[103]["n"] == "extra"
    assert suffix_dedup.digests(docs.limit(0)).count() == 0 and substring_dedup.digests(docs.limit(0)).count() == 0
    assert {r["text"] for r in substring_dedup.deduplicated(docs).filter("doc_id = 103").collect()} == {"z" * 399}


def test_op8_passages_of_words(spark):
    words = [f"w{k}" for k in range(400)]
    passage = " \n".join(words[:55])
    rows = [(1, f"é {' '.join(words[60:80])} {passage} . {' '.join(words[80:120])}", 9, "x"), (2, f"{passage}\n\nrest of it", 9, "y"), (3, " ".join(words[200:249]), 9, "z"), (4, " ".join(words[200:249]) + " other", 9, "z"), (None, None, 9, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, k string")
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["k"]) for r in suffix_dedup.deduplicated(df, suffix_dedup.PASSAGE, repeats.Words).collect()}
    one, two = rows[0][1].replace(passage, ""), "\n\nrest of it"
    assert got == {1: (one, len(one), "x"), 2: (two, len(two), "y"), 3: (rows[2][1], 9, "z"), 4: (rows[3][1], 9, "z"), None: (None, 9, "w")}


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_long_texts_in_stretches(monkeypatch, piece):
    texts = [b.encode() for b in BASE] + [b"", b" ", b"x" * 300, b"\n a  b\x0b"]
    monkeypatch.setattr(repeats, "PIECE", 1 << 30)
    symbols, ends = repeats.Words.symbols(texts)
    assert np.diff([0, *ends]).tolist() == [len(t.split()) for t in texts]
    monkeypatch.setattr(repeats, "PIECE", piece)
    assert np.array_equal(np.concatenate([repeats.Words.symbols([t])[0] for t in texts]), symbols)


def test_blocks_do_not_change_anchors(monkeypatch):
    shape = repeats.Shape(400, 160)
    for t in [BASE[0] * 3, "ab" * 3000, "z" * 2000]:
        x, ends = repeats.Bytes.symbols([t.encode()])
        monkeypatch.setattr(repeats, "BLOCK", 1 << 18)
        (p,) = repeats.parts(x, ends, shape)
        assert (p.high - p.low + 1).sum() == len(t) - 399
        for block in (100, 333):
            monkeypatch.setattr(repeats, "BLOCK", block)
            parts = list(repeats.parts(x, ends, shape))
            for f in (lambda q: q.at + q.offset, lambda q: q.context, lambda q: q.low + q.offset, lambda q: q.high + q.offset):
                assert np.array_equal(np.concatenate([f(q) for q in parts]), f(p))


def brute_fingerprint(t):
    import xxhash

    w = (t or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(pairs):
    root = {}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root.setdefault(a, a), root.setdefault(b, b)
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


def test_op3_against_brute_force(docs):
    fp = [(d, brute_fingerprint(t)) for d, t, *_ in ROWS]
    top = groups_of([(a, b) for _, a in fp for _, b in fp if (a ^ b).bit_count() <= 3])
    least = {}
    for d, f in fp:
        least.setdefault(top[f], []).append(d)
    want = [(d, f"{f:016x}", min([x for x in least[top[f]] if x is not None], default=None)) for d, f in fp]
    assert ids(tuple(r) for r in simhash.grouped(docs).collect()) == ids(want)
    assert simhash.grouped(docs.limit(0)).count() == 0
    once = [r["doc_id"] for r in simhash.deduplicated(docs).collect()]
    assert len(once) == len(set(once)) and set(once) - {None} == {c for _, _, c in want if c is not None}


@pytest.mark.parametrize("hot", [20_000, 3])
def test_op3_links(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    fps = {random.getrandbits(64) for _ in range(60)}
    for b in list(fps)[:20]:
        for _ in range(12):
            x = b
            for k in random.sample(range(64), random.randint(1, 5)):
                x ^= 1 << k
            fps.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = {r["node"]: r["root"] for r in graph.components(simhash.linked(df)).collect()}
    want = groups_of([(signed(a), signed(b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 3])
    assert got == want


def test_op3_rows_that_share_an_id_or_have_none(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    rows = [(1, one, "x"), (1, two, "x"), (1, two, "x"), (None, three, "y"), (None, one, "y"), (2, two, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    want = sorted([(1, one), (1, two), (0, three)])
    for of in (simhash, near_copies):
        got = of.deduplicated(df)
        assert got.columns == df.columns and sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == want


def test_op3_very_long_text():
    words = [f"w{k % 977}" for k in range(120_000)]
    assert simhash.fingerprint(" \n".join(words)) == brute_fingerprint(" ".join(words))


@pytest.mark.parametrize(("tried", "block", "share"), [((1, 4, 4), 200_000, 20_000), ((), 300, 3)])
def test_near_copies_against_brute_force(spark, monkeypatch, tried, block, share):
    import corpus_pipeline

    monkeypatch.setattr(near_copies, "TRIED", tried)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "SHARE", share)

    rows = [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (None, "a b c")]
    for k in range(12):
        base = [f"w{random.randrange(5000)}" for _ in range(100)]
        for c in range(6):
            w = list(base)
            for j in range(c):
                w[random.randrange(100)] = f"new{k}x{c}x{j}"
            rows.append((10 + 10 * k + c, " ".join(w)))
    def own(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    same = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    made = [(d, own(t)) for d, t in rows]
    top = groups_of([(i, j) for i, (_, a) in enumerate(made) for j, (_, b) in enumerate(made) if same(a, b)])
    least = {}
    for i, (d, _) in enumerate(made):
        least.setdefault(top[i], []).append(d)
    want = [(d, min([x for x in least[top[i]] if x is not None], default=None)) for i, (d, _) in enumerate(made)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ids(tuple(r) for r in near_copies.grouped(df).collect()) == ids(want)
    assert ids((r["doc_id"],) for r in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, df, "").collect()) == ids({(c,) for _, c in want})
    assert near_copies.grouped(df.limit(0)).count() == 0


def test_near_copies_by_bits_first(spark, monkeypatch):
    """The stage goes through SimHash's grid, and sets that the grid links are compared even if they share no other cell."""
    import corpus_pipeline

    draw, rows = random.Random(7), []
    for k in range(30):
        fp = draw.getrandbits(64)
        for c in range(k % 4 + 1):
            x = fp
            for b in draw.sample(range(64), min(c, 1)):
                x ^= 1 << b
            rows.append((len(rows), 10, x - (1 << 64) if x >> 63 else x))
    got = [(r["a"], r["b"]) for r in near_copies.near_bits(spark.createDataFrame(rows, "sid long, n long, fp long")).collect()]
    fp = {sid: x for sid, _, x in rows}
    near = {(i, j) for i in fp for j in fp if i < j and ((fp[i] ^ fp[j]) & ((1 << 64) - 1)).bit_count() <= 3}
    assert set(got) <= near and len(got) <= len(rows) and groups_of(got).keys() == {i for p in near for i in p}
    words = [f"w{k}" for k in range(60)]
    own = [(k, near_copies.shingles(t).tobytes()) for k, t in enumerate([" ".join(words), " ".join([*words[:-1], "x"]), " ".join(words[:30])])]
    sets = spark.createDataFrame(own, "sid long, own binary")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    links = common.staged(near_copies.verified(pairs, sets, 0.8), "near-links")
    none = spark.createDataFrame([], "cell long, sid long, n long")
    assert {(r["node"], r["root"]) for r in near_copies.linked(none, sets, 0.8, links).collect()} == {(0, 0), (1, 0)}
    calls, real = [], simhash.linked
    monkeypatch.setattr(simhash, "linked", lambda fps, bits=3: calls.append(bits) or real(fps, bits))
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words, "x"]))], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()] == [1] and calls == [3]


@pytest.mark.parametrize(("html", "want"), [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<nav>m</nav><article><h1>A &amp; B</h1><p>one<br>two<p>x</article><footer>f</footer>", "A & B\none two\nx"),
    ("<div class='ad'>x<article><p>Hello world</p>", "Hello world"), ("<div id='cookie-notice'>c</div><div><p>One two three.</p><p>Five.</p></div><div class='comments'><p>nice</p></div>", "One two three.\nFive."),
    ("<main><header><h1>T</h1></header><p>a &lt;b&gt;&nbsp;d</p><aside>z</aside><section class=comments><article><p>reader</p></article></section></main>", "T\na <b> d"), ("<script>var a='<p>no</p>'</script>yes", "yes"),
])
def test_op4(html, want):
    assert html_extract.extracted(html) == want


PROSE = "A plain sentence of some length, as articles have many of them, goes on here and comes to its end. " * 3


@pytest.mark.parametrize(("html", "want", "by_smoothing"), [
    (f"<article><h1>A</h1><p>{PROSE}</p><p>Yes.</p></article><article><p>A short second one.</p></article>", ["A", PROSE, "Yes.", "A short second one."], True),
    (f"<body><p>Lead ...</p><article><p>{PROSE}</p></article>", ["Lead ...", PROSE], True),
    (f"<main><p>{PROSE}</p><section class='related-work'><h2>Related work</h2><p>Some.</p></section><div id='search'><p>On search.</p></div></main>", [PROSE, "Related work", "Some.", "On search."], False),
    (f"<main><h1>Title</h1><article><p>{PROSE}</p></article></main>", ["Title", PROSE], False),
    (f"<div><ul><li><a href=x>Home</a><li><a href=x>News of today and much more of it</a></ul></div><div><p>{PROSE}</p><p>{PROSE}</p></div><div><a>top</a></div>", [PROSE, PROSE], False),
    (f"<div><div>{PROSE}</div><div>Short.</div><div>{PROSE}</div></div>", [PROSE, "Short.", PROSE], True),
    (f"<p>One <span class=ad>buy</span> two <a href=x>three</a> {PROSE}</p><article class=comment><p>{PROSE}</p></article>", [f"One two three {PROSE}"], False),
])
def test_op4_regions(html, want, by_smoothing):
    want = "\n".join(x.strip() for x in want)
    assert html_extract.extracted(html) == want
    assert (html_extract.extracted(html, sigma=0) != want) == by_smoothing


def test_op4_pages_against_plain_patterns(spark):
    """The test pages have one article each; an article's blocks by patterns, without a parser."""
    import html
    import os

    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test tables")
    block = re.compile(r"</?(?:p|h1)>")
    for r in html_extract.main_text(common.table(spark, "/root/testdata/sf0.01", "pages")).join(common.table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        lines = (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in block.split(inner))
        assert r["text"] == "\n".join(x for x in lines if x)


def test_op4_empty_table_and_very_long_page(spark):
    df = spark.createDataFrame([(1, "u", f"<nav>menu</nav><p>{PROSE * 20_000}</p>")], "page_id long, url string, html string")
    assert html_extract.main_text(df.limit(0)).count() == 0
    (r,) = html_extract.main_text(df).collect()
    assert r["text"] == (PROSE * 20_000).strip() and r["n_chars"] == len(r["text"])


def test_op4_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>", "x"), (1, "u", "<p>é</p>", "x"), (2, None, None, None)], "page_id long, url string, html string, text string")
    assert ids(tuple(r) for r in html_extract.main_text(df).collect()) == ids([(1, "u", "é", 1), (1, "u", "é", 1), (2, None, "", 0)])


def test_op5(spark):
    urls = ["http://a.example.net/en/1?x", "http://a.example.net/de/1", "https://EXAMPLE.com/de/1", "http://x.org/fr/", "http://x.org/fr", "http://x.io/ads/1", None, "", "no scheme", "http://net", "http://a.net/", "http://x.io/a.net/", "http://internet/", "ftp://u.io/x.exe#f"]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.judged(df).collect()}
    assert got == {0: ("example.net/en/", "allow"), 1: ("net/", "block"), 2: ("example.com/de/", "block"), 3: ("org/fr/", "allow"), 4: (None, "allow"), 5: (None, "block"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: ("net/", "block"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "block")}


def test_op5_automaton():
    import fnmatch

    globs = ["".join(random.choice("ab*?") for _ in range(random.randrange(1, 9))) for _ in range(60)]
    texts = ["".join(random.choice("ab") for _ in range(random.randrange(0, 9))) for _ in range(80)]
    got = url_filters.GlobAutomaton.compiled(globs).matches([t.encode() for t in texts])
    assert all(got[i, k] == fnmatch.fnmatchcase(t, g) for i, t in enumerate(texts) for k, g in enumerate(globs))


def test_op6(docs, spark):
    rows = sharding.sharded(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted((d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    many = spark.createDataFrame([(i, f"text {i % 900} " * (1 + i % 7), f"s{i % 5}", "en") for i in range(2000)] + [(5000 + i, "copy " * 30, "s0", "en") for i in range(3000)], "doc_id long, text string, source string, lang string")
    out = sharding.sharded(many).toPandas()
    size = out.groupby("shard")["size"].sum()
    assert len(size) == 16 and size.max() < 1.05 * size.mean() and size.min() > 0.95 * size.mean()
    assert all(sorted(g) == list(range(len(g))) for _, g in out.groupby("shard")["slot"])
    small = out[out.doc_id < 5000].groupby("text_crc32")["shard"].nunique()
    assert small.max() == 1
    assert sharding.sharded(docs.limit(0)).count() == 0


def test_op7(docs, monkeypatch):
    from tokenizers import Tokenizer

    model = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(model)
    got = {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_output.digests(docs, model).collect()}
    want, at = set(), 0
    for d, t, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        own = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.add((d, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    assert got == want
    assert token_output.digests(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [0, 1, 256, 257, 131_073])
def test_op7_round_trip(n):
    own = np.random.default_rng(n).zipf(1.3, n).astype(np.int64) % 49408
    raw = token_output.packed(own, [1, None], [n, 0])
    s = token_output.Segment(raw)
    assert np.array_equal(s.ids(), own) and s.doc_ids == [1, None]
    for b, (_, _, size, first, *_) in enumerate(s.head["blocks"]):
        assert np.array_equal(s.block(b), own[first : first + size])
    if n > 1:
        broken = bytearray(raw)
        broken[-3] ^= 1
        with pytest.raises(ValueError):
            token_output.Segment(bytes(broken)).ids()


ODD = ["", " ", "\n", " a", "a ", "a  b", "a\n\nb", "a \nb", "don't we'll", "x<|endoftext|>y", "<|endoftext", "\x00a \x01b", "a\x1cb", "日本 語", "é x", "12 345½", " \n a", "😀 😀", "a\r\nb\r\n", "İ. Σς", "A'S b.", *["".join(random.choice(" \n\tab'1é日\x1c\x85.,😀") for _ in range(10)) for _ in range(300)]]


def test_op9_and_op7_words_equal_the_library(tmp_path):
    from tokenizers import Tokenizer

    model = public_tokenizers.path("byte_bpe_50k.json")
    library, plain = Tokenizer.from_file(model), bpe.Coder(model)
    units = Counter(u for t in ODD + BASE for u in bpe.units(t))
    (tmp_path / "lex").write_bytes(bpe.Transducer.built({u.encode(): plain.merged(u) for u in units if random.random() < 0.5}))
    coder = bpe.Coder(model, str(tmp_path / "lex"))
    words, other = token_output.Words(public_tokenizers.path("word_bpe_49k.json")), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for t in ODD + BASE:
        want = library.encode(t, add_special_tokens=False).ids
        got = coder.encode(t)
        assert list(memoryview(got).cast("I")) == want, t
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False)
        assert np.frombuffer(words.encode(t), "<u4").tolist() == other.encode(t, add_special_tokens=False).ids, t


def test_op7_words_of_a_batch(monkeypatch):
    """Words of texts that are looked up together, each once; pieces and an emptied store change nothing."""
    from tokenizers import Tokenizer

    model = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(model)
    texts = [*ODD, None, "Été!!! «été» étE,*** don't 's x's a_b __ 42 4²2 ǅ ŉ ſ e\u0301 \u2003z", *BASE, " \n ", "word ", "word"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    pa = token_output.pa
    words, calls = token_output.Words(model), []
    monkeypatch.setattr(words, "plain", lambda t, plain=words.plain: calls.append(t) or plain(t))
    for piece, kept in ((1 << 23, 1_100_000), (100, 1_100_000), (1 << 23, 50), (1, 1)):
        monkeypatch.setattr(token_output, "PIECE", piece)
        monkeypatch.setattr(token_output, "CACHE_WORDS", kept)
        monkeypatch.setattr(token_output, "MARKS", min(kept, 1 << 14))
        got = list(words.encode_all(pa.array(["cut off", *texts], pa.string()).slice(1)))
        assert np.concatenate([x for x, _ in got]).tolist() == [i for own in want for i in own]
        assert np.concatenate([n for _, n in got]).tolist() == [len(own) for own in want]
    assert list(words.encode_all(pa.array([], pa.string()))) == []
    calls.clear()
    monkeypatch.setattr(token_output, "CACHE_WORDS", 1_100_000)
    many = [f"{a}{b}{c}" for a in ("new", "NEW", "né") for b in ("", "er", "est") for c in (".", "$$$", ",%%%", "!!")]
    got = b"".join(x.tobytes() for x, _ in words.encode_all(pa.array(many)))
    assert np.frombuffer(got, "<u4").tolist() == [i for t in many for i in library.encode(t, add_special_tokens=False).ids]
    assert set(calls) <= {".", "$$$", ",%%%", "!!"}


def test_op9_transducer_is_minimal_and_exact(tmp_path):
    keys = {("".join(random.choice("ab") for _ in range(random.randrange(1, 9))) + random.choice(["ing", "ed", ""])).encode(): bytes([i % 256] * 4 * (i % 3)) for i in range(300)}
    (tmp_path / "t").write_bytes(bpe.Transducer.built(keys))
    t = bpe.Transducer(str(tmp_path / "t"))
    assert all(t.ids_of(k) == v for k, v in keys.items()) and t.ids_of(b"zz") is None and t.ids_of(b"") is None
    assert sorted(t.find(k) for k in keys) == list(range(len(keys)))


def test_op9_table(docs):
    from tokenizers import Tokenizer

    model = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(model)
    want = []
    for d, t, *_ in ROWS:
        own = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert ids(tuple(r) for r in bpe.digests(docs, model, size=100).collect()) == ids(want)
    assert bpe.digests(docs.limit(0), model).count() == 0


def test_op10(spark):
    word = lambda: "".join(random.choice("abcdefghijklmnop") for _ in range(random.randrange(3, 9)))
    items = [(k, " ".join(word() for _ in range(14 + 5 * k)) + ". " + " ".join(word() for _ in range(6)) + ".") for k in range(12)] + [(50, " ".join(word() for _ in range(400)))]
    filler = lambda n: " ".join(word() for _ in range(n))
    rows, want = [(1000, None), (1001, ""), (None, filler(50))], set()
    for k, t in items:
        rows.append((k, f"{filler(40)} {t} {filler(60)}"))
        want.add((k, k))
        w = t.split()
        rows.append((100 + k, f"{filler(33)} {' '.join(x for i, x in enumerate(w) if i % 8)} {filler(20)}"))  # a word in eight is missing
        want.add((100 + k, k))
        rows.append((200 + k, filler(150)))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*items, (60, None), (61, "...")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench).collect()} == want
    small = decontaminate.Params(block_bytes=500)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench, small).collect()} == want
    assert {r["doc_id"] for r in decontaminate.decontaminated(df, bench).collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontaminate.leaks(df.limit(0), bench).count() == 0 and decontaminate.leaks(df, bench.limit(0)).count() == 0


def test_op10_items_of_common_words(spark):
    common = [f"c{k}" for k in range(40)]
    rows, items, want = [(1000 + k, " ".join(random.sample(common, 30))) for k in range(60)], [], set()
    for k in range(8):
        rare = 4 + k % 5
        own = random.sample(common, 20 - rare) + [f"r{k}x{j}" for j in range(rare)]
        random.shuffle(own)
        items.append((k, " ".join(own)))
        lost = set(random.sample([w for w in own if w[0] == "r"], 4))  # a fifth of the words, up to all rare ones
        rows += [(k, " ".join(w for w in own if w not in lost)), (100 + k, " ".join("other" if w in lost else w for w in own))]
        want |= {(k, k), (100 + k, k)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench).collect()} >= want


@pytest.mark.parametrize("dense", [1 << 24, 0])
def test_op10_places(monkeypatch, dense):
    monkeypatch.setattr(decontaminate, "DENSE", dense)
    pieces = [np.array(random.choices(range(30), k=15), np.int32) for _ in range(7)]
    items = [decontaminate.Item(k, x, x[-5:], x) for k, x in enumerate(pieces)]
    search = decontaminate.Search(items, np.ones(40), np.ones((40, 2), np.float32), 30, decontaminate.Params())
    ids = np.array(random.choices(range(41), k=128), np.int32)
    ((width, _, n, _, _, _, keys, times, table),) = search.groups
    assert (table is None) == (dense == 0) and width == 48 and n.tolist() == [15] * 7
    start, item = np.repeat(np.arange(7), 7), np.tile(np.arange(7), 7)
    want = [sum(int(x) in set(pieces[i].tolist()) for x in ids[8 * s : 8 * s + 48]) for s, i in zip(start, item, strict=True)]
    assert search._places(ids, start, 48, item, keys, table).tolist() == want
    want = [sum(int(x) in set(ids[8 * s : 8 * s + 48].tolist()) for x in pieces[i]) for s, i in zip(start, item, strict=True)]
    assert search._shared(ids, start, 48, item, keys, times).tolist() == want


def reworded_corpus():
    """Documents of 30 topics, each with 40 notions that two words name; items, and their texts with other words for some notions."""
    draw = random.Random(3)
    word = lambda t, k, form=None: f"{'ab'[draw.randrange(2) if form is None else form]}{t}x{k}"
    rows = [(i, " ".join(word(i % 30, draw.randrange(40)) for _ in range(90))) for i in range(1500)]
    items, ids = [], set()
    for t in range(30):
        own = draw.sample(range(40), 26)
        text = lambda forms: " ".join(word(t, k, f) for k, f in zip(own[:20], forms, strict=True)) + ". " + " ".join(word(t, k, 0) for k in own[20:]) + "."  # noqa: B023, E731
        items.append((t, text([0] * 20)))
        other = set(draw.sample(range(20), 13))  # half of all words
        rows.append((5000 + t, f"{' '.join(word(t, draw.randrange(40)) for _ in range(30))} {text([int(j in other) for j in range(20)])} {' '.join(word(t, draw.randrange(40)) for _ in range(30))}"))
        ids.add((5000 + t, t))
    return rows, items, ids


def test_op10_latent_space_finds_other_words(spark, monkeypatch):
    rows, items, want = reworded_corpus()
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    p = decontaminate.Params(rank=32)
    found = lambda: {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench, p).collect()}
    own = found()
    assert own <= want and len(own) >= 0.9 * len(want)

    def random_basis(read, idf, p):
        return np.linalg.qr(np.random.default_rng(1).standard_normal((len(idf), p.rank)))[0].astype(np.float32)

    monkeypatch.setattr(decontaminate, "_basis", random_basis)
    assert len(found()) < 0.5 * len(own)


def test_op10_recall_against_full_search(spark):
    """Items with lost and replaced words among other text: what the cosine finds of all that meet the rule."""
    draw = random.Random(9)
    word = lambda: f"w{int(3000 * draw.random() ** 3)}"
    items = [(k, " ".join(word() for _ in range(draw.randrange(12, 60))) + ". " + " ".join(word() for _ in range(6)) + ".") for k in range(40)]
    rows = [(i, " ".join(word() for _ in range(150))) for i in range(600)]
    for k, t in items:
        for j, share in enumerate((0.0, 0.1, 0.2, 0.3, 0.38)):
            w = t.split()
            for x in draw.sample(range(len(w) - 6), int(share * (len(w) - 6))):
                w[x] = word()
            rows.append((1000 + 10 * k + j, " ".join([*(word() for _ in range(draw.randrange(90))), *w, *(word() for _ in range(70))])))
    rows.append((9000, "spam eggs " * 60 + items[0][1] + " spam eggs" * 60))
    p = decontaminate.Params()
    vocab = decontaminate.Vocabulary(sorted({w for _, t in items for w in decontaminate.tokens(t)}), p.hashed)
    cut = [decontaminate.Item.cut(k, t, vocab.own)[0] for k, t in items]
    want = set()
    for d, t in rows:
        ids = vocab.read(t)
        for x in cut:
            share, answer = (decontaminate.lcs(y, ids) / len(y) for y in (x.ids, x.answer))
            if share >= p.lcs or share >= p.paraphrase and answer >= p.answer:
                want.add((d, x.item_id))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), p).collect()}
    assert len(want) > 180 and len(got & want) >= 0.95 * len(want)
    assert {(1000 + 10 * k, k) for k, _ in items} | {(9000, 0)} <= got


def test_op10_rows_of_one_id_or_none(spark):
    bench = spark.createDataFrame([(1, " ".join(f"b{k}" for k in range(30)))], "item_id long, text string")
    leak, clean = " ".join(f"b{k}" for k in range(30)), "nothing of it here"
    df = spark.createDataFrame([(None, leak, 1), (None, clean, 2), (None, None, 3), (7, leak, 4), (7, clean, 5), (7, clean, 5)], "doc_id long, text string, cosine int")
    assert sorted(r["cosine"] for r in decontaminate.decontaminated(df, bench).collect()) == [2, 3, 5, 5]
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench).collect()} == {(None, 1), (7, 1)}


def test_op10_long_items_across_stretches(spark):
    filler = lambda n: " ".join(f"f{random.randrange(4000)}" for _ in range(n))
    items = [(k, " ".join(f"w{random.randrange(3000)}" for _ in range(n))) for k, n in enumerate((129, 330, 800, 1000, 2000, 10_000))]
    rows = [(k, f"{filler(70)} {t} {filler(90)}") for k, t in items]
    border = decontaminate.STRETCH
    rows += [(100 + k, f"{filler(border - len(t.split()) // 2)} {t} {filler(400)}") for k, t in items]
    rows += [(200 + k, f"{filler(500)} {' '.join(w for j, w in enumerate(t.split()) if j % 6)} {filler(50)}") for k, t in items]
    rows += [(300 + k, " ".join(t.split()[: len(t.split()) // 2]) + " " + filler(900)) for k, t in items]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["lcs_share"] for r in decontaminate.leaks(df, bench).collect()}
    assert set(got) == {(d + k, k) for d in (0, 100, 200) for k, _ in items}
    assert all(got[d + k, k] == 1.0 for d in (0, 100) for k, _ in items)


def test_op10_words_in_any_script(monkeypatch):
    """Words of a batch, of one text, and of pieces of it are the same."""
    words = ["don't", "stop", "été", "日本", "x_y", "a" * 30, "i̇stanbul"]
    vocab = decontaminate.Vocabulary(words, 10)
    texts = ["«Don't» (STOP)! ... été, 日本  x_y\t_ é— " + "A" * 30, "", " \n ", "stop", None, "...", "Other words, and other words."]
    one = [vocab.read(t).tolist() for t in texts]
    assert one[0][:5] == [0, 1, 2, 3, 4] and one[0][-1] == 5 and one[1] == one[2] == one[4] == one[5] == [] and one[3] == [1]
    assert one[6][0] == one[6][3] >= len(words) and one[6][1] == one[6][4] != one[6][2]
    assert [x.tolist() for x in vocab.read_all(decontaminate.pa.array(texts))] == one
    monkeypatch.setattr(decontaminate, "PIECE", 8)
    assert [x.tolist() for x in vocab.read_all(decontaminate.pa.array(texts))] == one and [x.tolist() for x in vocab.read_all(decontaminate.pa.array(texts).slice(1, 5))] == one[1:6]
    assert list(vocab.read_all(decontaminate.pa.array([], "string"))) == []


def test_op10_numbers_each_once_and_sums_of_blocks():
    place = np.full(50, 7, np.int32)
    for n in (0, 1, 30, 400):
        ids = np.array(random.choices(range(50), k=n), np.int32)
        assert sorted(decontaminate._distinct(ids, place).tolist()) == sorted(set(ids.tolist()))
    own = np.arange(20, dtype=np.int32)
    search = decontaminate.Search([decontaminate.Item(0, own, own[-5:], own)], np.linspace(1, 2, 40), np.linalg.qr(np.random.default_rng(0).standard_normal((40, 3)))[0].astype(np.float32), 20, decontaminate.Params())
    ids = np.array(random.choices(range(41), k=96), np.int32)
    at = np.array(sorted(random.sample(range(88), 60)))
    want = [search.low[ids[at[at < 8 * b]]].sum(axis=0) for b in range(12)]
    assert np.allclose(search._sums(ids, at, 11), want, atol=1e-4)


def test_op10_white_space_at_the_end(monkeypatch):
    """Words do not depend on the bytes that lie in memory behind a batch's last text."""
    pa = decontaminate.pa
    texts = [" \n ", "«One» two. ", "one two.\n", "two\u3000"]
    vocab = decontaminate.Vocabulary(["one", "two"], 10)
    for behind in (b"\0", b"a", b"\xff", b"\xc3"):
        lower = lambda a, b=behind: pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(x := a[0].as_py().lower().encode())], np.int32)), pa.py_buffer(x + b)])
        monkeypatch.setattr(decontaminate.pc, "utf8_lower", lower)
        assert [vocab.read(t).tolist() for t in texts] == [[], [0, 1], [0, 1], [1]]
        assert [decontaminate.tokens(t) for t in texts] == [[], ["one", "two"], ["one", "two"], ["two"]]


def test_lcs_against_the_table():
    for _ in range(50):
        a, b = ([random.randrange(4) for _ in range(random.randrange(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs(np.array(a, int), np.array(b, int)) == t[-1][-1]


CLASHING = "k a g n fp row root sid cells own component_id slot shard size law n_tokens start n_words n_removed kept b h h2 seg part tag metric v c rest w1 at node piece bytes ids p leaf text_crc32 doc label".split()


def results():
    word, byte = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    bench = lambda df: df.sparkSession.createDataFrame([(1, " ".join(BASE[0].split()[:20]))], "item_id long, text string")
    return {
        "op1": quality_rules.query, "op2": substring_dedup.digests, "op3": simhash.grouped, "op6": sharding.sharded, "op7": lambda df: token_output.digests(df, word),
        "op8": suffix_dedup.digests, "op9": lambda df: bpe.digests(df, byte), "op10": lambda df: decontaminate.leaks(df, bench(df)), "near": near_copies.grouped,
    }


@pytest.mark.parametrize("name", sorted(results()))
def test_clashing_names_change_nothing(docs, name):
    one = docs.drop("n")
    more = one.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    run = results()[name]
    plain = lambda df: sorted(str(r) for r in df.select(*sorted(df.columns)).collect())
    assert plain(run(more)) == plain(run(one))


def test_very_long_text(spark):
    from tokenizers import Tokenizer

    draw = random.Random(2)
    text = " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randrange(2, 9))) for _ in range(200_000)) + " é\n"
    df = spark.createDataFrame([(1, text, "en", "s"), (2, "short one", "en", "s"), (3, text[:500_000], "en", "s")], "doc_id long, text string, lang string, source string")
    word, byte = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    n = {r["doc_id"]: r["n_tokens"] for r in token_output.digests(df, word).collect()}
    assert n[1] == len(Tokenizer.from_file(word).encode(text, add_special_tokens=False).ids) + 1
    ids = np.array(Tokenizer.from_file(byte).encode(text, add_special_tokens=False).ids, "<u4")
    got = {r["doc_id"]: (r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(df, byte).collect()}
    assert got[1] == (hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert sorted(r["size"] for r in sharding.sharded(df).collect()) == sorted(len(t.encode()) + 1 for t in (text, "short one", text[:500_000]))
    spans = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.digests(df).collect()}
    assert spans == {1: (500_000, 1), 2: (0, 0), 3: (500_000, 1)}
    cut = {r["doc_id"]: r["n_removed"] for r in substring_dedup.digests(df).collect()}
    whole = len(text[:500_000].split())
    assert cut[3] >= whole - 1 and cut[1] == cut[3] and cut[2] == 0
    assert url_filters.judged(spark.createDataFrame([(1, "http://a.net/" + "x/" * 500_000)], "page_id long, url string")).first()["verdict"] == "block"


def test_op5_empty_table(spark):
    assert url_filters.judged(spark.createDataFrame([], "page_id long, url string, rule int")).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_op7_parts_and_segments(docs, monkeypatch, parts):
    """Starts run on over parts and segments."""
    monkeypatch.setattr(token_output, "PART_BYTES", 4_000 // parts)
    model = public_tokenizers.path("word_bpe_49k.json")
    rows = sorted(token_output.digests(docs, model).collect(), key=lambda r: r["start"])
    assert rows[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
    assert [r["doc_id"] for r in rows if r["doc_id"] is not None] == sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)


def test_pipeline_stages_against_brute_force(spark):
    """Each stage on what the one before kept, over all rows of the smallest tables."""
    import os

    import corpus_pipeline
    import duckdb
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    docs = common.table(spark, folder, "documents")
    kept, before = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.staged(stage(spark, before, folder), f"test-{name}")
        assert after.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in after.collect()}
        assert after.count() == len(kept[name])
        before = after
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    good = dict(duck.execute(f"SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM ({quality_rules.oracle()}) WHERE kept)").fetchall())
    assert kept["quality_rules"] == good

    def own(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    made = sorted((d, own(t)) for d, t in good.items())
    top = groups_of([(d, e) for d, a in made for e, b in made if 5 * len(a & b) >= 4 * len(a | b)])
    single = {d: good[d] for d, _ in made if top[d] == d}
    assert kept["simhash_near_dedup"] == single
    ids = sorted(single)
    words = [tuple((single[d] or "").encode().split()) for d in ids]
    cut = {d: b" ".join(x for x, y in zip(w, c, strict=True) if not y) for d, w, c in zip(ids, words, covered(words, 50), strict=True)}
    got = kept["suffix_array_dedup"]
    assert {d: b" ".join((t or "").encode().split()) for d, t in got.items()} == cut

    p = decontaminate.Params()
    items = dict(duck.execute(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall())
    vocab = decontaminate.Vocabulary(sorted({w for t in items.values() for w in decontaminate.tokens(t)}), p.hashed)
    cuts = [decontaminate.Item.cut(k, t, vocab.own)[0] for k, t in items.items() if decontaminate.tokens(t)]

    def leaks(x, ids):
        n = len(x.ids)
        if np.isin(x.ids, ids).mean() < p.paraphrase:
            return False
        for a in range(0, max(1, len(ids) - n), max(1, n // 2)):
            share, answer = (decontaminate.lcs(y, ids[a : a + 2 * n]) / len(y) for y in (x.ids, x.answer))
            if share >= p.lcs or share >= p.paraphrase and answer >= p.answer:
                return True
        return False

    read = {d: vocab.read(t) for d, t in got.items()}
    assert kept["benchmark_decontamination"] == {d: t for d, t in got.items() if not any(leaks(x, read[d]) for x in cuts)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, folder).collect()}
    want = {}
    for d, t in kept["benchmark_decontamination"].items():
        i = library.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert last == want
