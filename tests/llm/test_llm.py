"""Operators of the llm subpackage against brute force, round trips and held-out accuracy, and on odd tables."""

import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import chat_format, decontaminate, html_text, license_scan, line_dedup, near_dedup, packing, progressive_jpeg, registry, substring_dedup, toxicity, words
from tidewell.llm.components import components

ODD = [(None, "a b c d"), (3, "A b c d"), (2, "a b c d"), (2, "a b c d"), (5, None), (6, ""), (7, "x"), (8, " \n\t "), (9, "Ünï cödé 日本 " * 30), (10, "q " * 50_000)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and long texts, repeated rows and ids, and columns whose names may clash."""
    return spark.createDataFrame([(*r, "s", 1, 2) for r in ODD], "doc_id long, text string, source string, k long, n_words long").repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("kind", ["white", "white_lower", "alnum_lower"])
def test_words(kind):
    import re

    texts = ["", "a", " a  b\tc", "Ab aB", None, "é-x É_y 日本", "x", "end ", "a\x0bb\x0cc", "9Z@z`"]
    pattern = r"[^\x20\x09-\x0D]+" if kind.startswith("white") else r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if kind.endswith("lower") else t or ""
    w = words.split(pa.array(texts, pa.string()), kind)
    want = [(i, x) for i, t in enumerate(texts) for x in re.findall(pattern, lower(t))]
    got = [(int(d), lower(w.data[s:e].tobytes().decode())) for d, s, e in zip(w.doc, w.start, w.end, strict=True)]
    assert got == want
    by = {}
    for (_, x), h in zip(want, w.h.tolist(), strict=True):
        assert by.setdefault(x, h) == h
    assert len(set(by.values())) == len(by)


def test_packing_encodes_words_once():
    """Words that come again at a line's end or start, or with other marks, are not encoded anew."""
    e = packing.Encoder(packing.default_vocabulary())
    inner, read = e.tokenizer, []

    class Spy:
        def encode(self, text, **options):
            read.append(text)
            return inner.encode(text, **options)

        def encode_batch_fast(self, texts, **options):
            read.extend(texts)
            return inner.encode_batch_fast(texts, **options)

    e.tokenizer = Spy()
    r = random.Random(2)
    words_ = ["".join(r.choice("abcdefgé") for _ in range(9)) for _ in range(300)]
    e.encode(["x " + " ".join(words_), *words_])
    known = sum(map(len, read))
    marks = [",\n", ".\n", "\n", "_!\n", "...\n", ")\n"]
    text = " ".join(["x", *(a + r.choice(marks) + b if m else a + "," for a, b, m in zip(words_, words_[1:], [1, 0] * 200, strict=False))])
    read.clear()
    (raw,) = e.encode([text])
    assert sum(map(len, read)) < known / 4
    assert np.frombuffer(raw, "<u4").tolist() == inner.encode(text, add_special_tokens=False).ids


def test_packing_units():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    e = packing.Encoder(packing.default_vocabulary())
    r = random.Random(1)
    odd = ["", " ", "  a  b ", "a\n \nb", "it's we'll", "<|endoftext|> a", "é　  b", "foo\n\n x", "Ġ a Ġb"]
    odd += ["".join(r.choice(["a", "B", " ", " ", "\n", "é", "1", ".", "'s", "\t", "word"]) for _ in range(r.randint(0, 12))) for _ in range(300)]
    for text, raw in zip(odd, e.encode(odd), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    for _ in range(60):
        lengths = [r.choice([1, 3, 256, 700, 2048, 5000]) if r.random() < 0.5 else r.randint(1, 4000) for _ in range(r.randint(0, 40))]
        cover, seqs = {}, {}
        for d, a, n, s, o, tier in packing.pack_block(lengths):
            cover.setdefault(d, []).append((a, n))
            seqs.setdefault(s, []).append((o, n, tier))
        for d, n in enumerate(lengths):
            ends = sorted(cover[d])
            assert [a for a, _ in ends] == np.cumsum([0, *(k for _, k in ends)])[:-1].tolist() and sum(k for _, k in ends) == n
        short = 0
        for x in seqs.values():
            x.sort()
            assert [o for o, *_ in x] == np.cumsum([0, *(n for _, n, _ in x)])[:-1].tolist()
            short += sum(n for _, n, _ in x) != x[0][2]
        assert short <= 1


def test_step_groups():
    r = random.Random(6)
    lengths = [min(20_000, int(r.lognormvariate(5.5, 1.3)) + 1) for _ in range(9000)]
    filled, tier_of = {}, {}
    for _, _, n, s, _, tier in packing.pack_block(lengths):
        filled[s], tier_of[s] = filled.get(s, 0) + n, tier
    step = packing.deal(filled, tier_of)
    totals, tiers = {}, {}
    for s, g in step.items():
        totals[g] = totals.get(g, 0) + filled[s]
        tiers.setdefault(g, set()).add(tier_of[s])
    assert len(totals) == -(-sum(lengths) // packing.STEP_TOKENS) > 5 and max(totals.values()) - min(totals.values()) <= packing.TIERS[-1]
    assert all(x == set(packing.TIERS) for x in tiers.values())
    assert packing.deal({}, {}) == {}


def test_packing_query(spark, sf):
    """Each id of each document lies in one piece; sequences are gapless and padded little."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    ids = {d: np.array([*x.ids, 1], "<u4") for d, x in zip(docs, t.encode_batch([x or "" for x in docs.values()], add_special_tokens=False), strict=True)}
    cover, seqs = {}, {}
    for r in packing.op1_packing(spark, sf).collect():
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"]
        cover.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert cover.keys() == docs.keys()
    for d, x in cover.items():
        assert [a for a, _ in sorted(x)] == np.cumsum([0, *(n for _, n in sorted(x))])[:-1].tolist() and sum(n for _, n in x) == len(ids[d])
    sizes = []
    for x in seqs.values():
        x.sort()
        assert [a for a, _ in x] == np.cumsum([0, *(n for _, n in x)])[:-1].tolist()
        sizes.append(sum(n for _, n in x))
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in sizes)
    assert max(sizes) <= 2048 and padded <= 1.02 * sum(sizes)


def test_packing(spark, odd):
    got = packing.pack(odd.drop("k")).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 5) == 1
    assert sum(r["length"] for r in got if r["doc_id"] == 2) == 2 * next(r["doc_tokens"] for r in got if r["doc_id"] == 3)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in got)
    assert packing.pack(odd.limit(0)).count() == 0


def test_decontamination(spark, odd, sf):
    items = spark.createDataFrame([(1, "a B c d"), (2, "x"), (3, None), (None, "cödé 日本 ünï"), (4, " ".join("q" for _ in range(12)))], "item_id long, text string")
    got = decontaminate.contamination(odd, items)
    got = got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated")
    want = decontaminate.brute_force(ODD, [("" if i is None else i, t) for i, t in map(tuple, items.collect())])
    assert rows(got) == sorted(want, key=repr)
    assert decontaminate.contamination(odd.limit(0), items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).where("n_hit > 0").count() == 0
    assert {r["doc_id"] for r in decontaminate.clean(odd, items).collect()} == {5, 6, 8, 9}  # only A-Z are lower-cased
    assert decontaminate.clean(odd.withColumn("bad", F.lit(3)), items).where("bad = 3").count() == 4
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = decontaminate.brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()])
    assert rows(decontaminate.op2_decontaminate(spark, sf)) == sorted(want, key=repr)


def test_decontamination_in_chunks(spark, monkeypatch):
    """Many windows of common words against one segment of the same words, with few candidates at once."""
    r = random.Random(8)
    docs = [(d, " ".join(r.choice("ab") for _ in range(300))) for d in range(5)]
    items = [(str(i), " ".join(r.choice("ab") for _ in range(14))) for i in range(40)]
    seg = decontaminate.Segment(decontaminate.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).first().asDict())
    table, size, _ = decontaminate._item_windows([t for _, t in items], 10)
    whole = decontaminate.phrase_matches(seg, table, size)
    monkeypatch.setattr(decontaminate, "CANDIDATES", 1000)
    parts = decontaminate.phrase_matches(seg, table, size)
    assert len(whole[0]) and sorted(zip(*map(list, whole), strict=True)) == sorted(zip(*map(list, parts), strict=True))


def test_search(spark):
    docs = spark.createDataFrame([(1, "the red fox saw the blue dog"), (2, "blue fox the red dog")], "doc_id long, text string")
    index = decontaminate.build_index(docs)
    assert rows(decontaminate.search(index, [["the", "red"], ["blue", "dog"]])) == [(0, 1, 0), (0, 2, 2), (1, 1, 5)]
    near = {(r["phrase"], r["doc_id"]) for r in decontaminate.search(index, [["blue", "red"], ["fox", "dog"]], slop=4).collect()}
    assert near == {(0, 1), (0, 2), (1, 1), (1, 2)}
    near = {(r["phrase"], r["doc_id"]) for r in decontaminate.search(index, [["blue", "red"], ["fox", "dog"]], slop=3).collect()}
    assert near == {(0, 2), (1, 2)}


def test_chat(spark):
    data = [(1, 0, "user", "a"), (1, 1, "user", "b\\[/]"), (1, 1, "user", "b\\[/]"), (1, 2, "assistant", None), (1, 3, "assistant", "x<s>"), (2, None, None, "z"), (None, 0, "assistant", "é")]
    df = spark.createDataFrame([(*r, 1, "c") for r in data], "conv_id long, turn long, role string, text string, ts long, segs string")
    out = chat_format.format_conversations(df)
    assert out.where("conv_id = 1").first()["formatted"] == "<s>[user]a[+]b\\b\\i\\s\\j[+]b\\b\\i\\s\\j[/][assistant][+]x\\ls\\g[/]</s>"
    got = {r["conv_id"]: r for r in chat_format.digest(out).collect()}
    for c in (1, 2, None):
        turns = [(r or "", t or "") for v, _, r, t in data if v == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.format_conversations(df.limit(0)).count() == 0
    huge = ["<s>[/]\\" * 40_000, "a" * 300_000]
    r = chat_format.digest(chat_format.format_conversations(spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(huge)], "conv_id long, turn long, role string, text string"))).first()
    assert r["loss_chars"] == sum(map(len, huge)) and r["loss_sha256"] == hashlib.sha256("".join(huge).encode()).hexdigest()
    long = spark.range(1500).selectExpr("1 conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t', id) text")
    r = chat_format.digest(chat_format.format_conversations(long)).first()
    assert r["loss_sha256"] == hashlib.sha256("".join(f"t{i}" for i in range(1, 1500, 2)).encode()).hexdigest()


def test_toxicity(spark, odd, sf, sf_small):
    got = {r["doc_id"]: r for r in toxicity.op4_toxicity(spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[d]["predicted"], y) for d, y in labels.items() if got[d]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for d, r in got.items())
    assert np.mean([p == y for p, y in held]) >= 0.95
    labelled = spark.createDataFrame([(d, int(d % 2)) for d in range(20)] + [(3, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(d, f"some words here {'awful' if d % 2 else 'nice'}") for d in range(20)], "doc_id long, text string")
    model = toxicity.train(docs, labelled)
    out = toxicity.score(odd.withColumn("score", F.lit("old")), model)
    assert out.count() == len(ODD) and out.where("score is null").count() == 0 and dict(out.dtypes)["score"] == "double"
    assert toxicity.score(docs.where("doc_id = 1"), model).first()["score"] > 0.5 > toxicity.score(docs.where("doc_id = 2"), model).first()["score"]
    none = toxicity.train(docs.limit(0), labelled.limit(0))
    assert toxicity.score(odd, none).where("score > 0.01").count() == 0


def test_label_model_recovers_rates(spark):
    """Planted rates, classes and a correlated pair come back from votes alone."""
    r = np.random.default_rng(11)
    n, lexicon, patterns = 20_000, 15, 3
    kind = r.choice(3, n, p=[0.88, 0.08, 0.04])
    rates = np.full((3, lexicon + patterns), 0.01)
    rates[1, :9], rates[2, 9:15] = r.uniform(0.25, 0.8, 9), r.uniform(0.3, 0.7, 6)
    rates[:, lexicon:] = [0.05, 0.1, 0.2]
    fired = r.random((n, lexicon + patterns)) < rates[kind]
    same = r.random(n) < 0.7
    fired[same, 8] = fired[same, 7]  # a pair that copies each other
    bits, times = np.unique(np.packbits(fired, axis=1), axis=0, return_counts=True)
    votes = spark.createDataFrame([(bytearray(b.tobytes()), int(t)) for b, t in zip(bits, times, strict=True)], "bits binary, n long").repartition(3)
    m = toxicity.fit_label_model(votes, lexicon, lexicon + patterns, 0.3)
    assert m.group[7] == m.group[8] and len(set(m.group)) == lexicon + patterns - 1
    assert abs(m.prior[0] - 0.88) < 0.02 and sorted(np.abs(np.sort(m.prior[1:]) - [0.04, 0.08]) < 0.02) == [True, True]
    toxic = kind > 0
    for i in set(range(lexicon + patterns)) - {7, 8}:
        assert abs(m.a[m.group[i]] - fired[toxic, i].mean()) < 0.05 and abs(m.b[m.group[i]] - fired[~toxic, i].mean()) < 0.05
    assert np.mean((m.posterior(fired) > 0.5) == toxic) > 0.97


def test_near(spark, odd, sf):
    got = {r["doc_id"]: r for r in near_dedup.near_groups(odd, shingle=2).collect()}
    assert got[3]["component_id"] == got[2]["component_id"] == got[None]["component_id"] == 2
    assert got[5]["component_id"] == 5 and got[5]["n_shingles"] == got[8]["n_shingles"] == 0 and got[7]["n_shingles"] == 1
    assert sorted(r["doc_id"] for r in near_dedup.dedup(odd).collect()) == [2, 5, 6, 7, 8, 9, 10]
    assert near_dedup.near_groups(odd.limit(0)).count() == 0
    clash = near_dedup.dedup(odd.withColumns({"near_t": F.lit(4), "__t": F.lit(5)}))
    assert clash.columns == [*odd.columns, "near_t", "__t"] and clash.where("near_t = 4 and __t = 5").count() == 7
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(near_dedup.op5_near_dedup(spark, sf)) == sorted(near_dedup.brute_force(docs), key=repr)


@pytest.mark.parametrize("block_bytes", [near_dedup.BLOCK_BYTES, 4000])
def test_near_chain(spark, monkeypatch, block_bytes):
    """A group in which many texts are linked only with some of the others, in one block or in many."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(near_dedup, "CELL_BLOCKS", 3)
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 700)
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for d in range(150):
        text = list(base)
        for _ in range(r.randint(0, 16)):
            text[r.randrange(120)] = f"x{r.randrange(10**6)}"
        docs.append((d, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = near_dedup.near_groups(df, shingle=2).select("doc_id", "n_shingles", "component_id", "kept")
    want = near_dedup.brute_force(docs)
    assert len({x[2] for x in want}) > 3 and rows(got) == sorted(want, key=repr)


def test_superminhash_estimates():
    r = np.random.default_rng(0)
    a, b = r.integers(0, 2**52, 400, dtype=np.uint64), r.integers(0, 2**52, 100, dtype=np.uint64)
    x, y = np.sort(a), np.sort(np.concatenate([a[:320], b[:80]]))
    sig = near_dedup.superminhash(np.repeat([0, 1], [len(x), len(y)]), np.concatenate([x, y]), 2, 200)
    assert abs((sig[0] == sig[1]).mean() - 320 / 480) < 0.12
    assert (near_dedup.superminhash(np.zeros(1, np.int64), x[:1], 1, 200) >> np.uint64(48)).max() == 199


@pytest.mark.parametrize("block", [10, 10**6])
def test_components(spark, block):
    r = random.Random(5)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(70)] + [(i, i + 1) for i in range(100, 140)]
    parent = list(range(150))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    want = sorted((x, root(x)) for x in {x for e in edges if e[0] != e[1] for x in e})
    assert rows(components(spark.createDataFrame([*edges, (None, 3), (4, 4)], "a long, b long").repartition(4), block=block)) == sorted(want, key=repr)


def test_html(spark):
    pages = [
        (1, "http://a.b/x", "<nav>no</nav><article><header><h1>T &amp; U</h1></header><p class=ad>no<p>one <b>two</b><br>three<script>var x='<p>';</script></article><footer>no</footer>", "T & U\n\none two three"),
        (2, None, None, ""), (3, "odd", "", ""), (4, "http://a.b/y", "plain < text &copy", "plain < text ©"),
        (5, "http://a.b/z", "<main><ul><li>a<li>b</ul><form>no</form></main> out <p>cut <a hre", "a\n\nb"),
        (6, "http://a.b/w", '<article><p>x</p><section class="comments">no</section></article><article class="comment">no</article>', "x"),
        (6, "http://a.b/w", '<article><p>x</p><section class="comments">no</section></article><article class="comment">no</article>', "x"),
    ]
    pages += [(100 + i, f"http://t.net/{i}", f"<div>same <i>box</i></div><div><p>own {i}</p></div>", f"own {i}") for i in range(12)]
    pages += [(200 + i, "http://t.net/c", "<div><p>a copied page</p></div>", "a copied page") for i in range(12)]
    df = spark.createDataFrame([(*p[:3], "h") for p in pages], "page_id long, url string, html string, host string").repartition(3)
    assert rows(html_text.extract(df).drop(*html_text.RULES)) == sorted(((p[0], p[1], p[3]) for p in pages), key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("wrap", ['div class="content-sidebar-wrap"', 'div class="page has-sidebar"', 'div class="layout no-comments"', 'section id="social-policy"', 'div class="post related-topic"', 'div class="sidebar"', "form"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "{}"])
def test_html_wrappers(wrap, inner):
    page = f"<{wrap}><nav>no</nav><div class=ad>no</div>{inner.format('<h1>T</h1><p>own</p>')}</{wrap.split()[0]}><div class=comments><article class=comment><p>no</p></article></div>"
    assert html_text.choose(*html_text.parse(page))[0] == ["T", "own"]


def test_html_templates(spark):
    """Templates of neutral names go by counts, also where their text changes from page to page; articles of one shape stay."""
    r = random.Random(9)
    word = lambda n: " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(r.randrange(1000)) for _ in range(n))
    menu = lambda: "<div class=x1><span>" + "".join(f"<a href=/{w}>{w}</a> " for w in word(5).split()) + "</span></div>"
    notices = [word(6) for _ in range(8)]
    pages, want = [], {}
    for i in range(40):
        own = [word(30) for _ in range(r.randint(2, 6))]
        host = "http://big.net" if i < 38 else "http://small.net"
        fixed, notice = "<div class=x2>same on all <b>pages</b></div>", notices[i % 8]
        pages.append((i, f"{host}/{i}", menu() + fixed + f"<div class=x3>{notice}</div><div class=x4>" + "".join(f"<p>{t}</p>" for t in own) + "</div><p>last <span class=ad>no</span>words</p>", 1))
        want[i] = "\n\n".join([*own, "last words"])
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host int").repartition(4)
    got = {r["page_id"]: r for r in html_text.extract(df).collect()}
    for i in range(38):
        assert got[i]["text"] == want[i] and (got[i]["n_template"], got[i]["n_listed"]) == (3, 0)
    for i in (38, 39):
        assert got[i]["n_template"] == 0 and got[i]["text"].endswith(want[i]) and "same on all pages" in got[i]["text"]


def test_html_query(spark, sf):
    """The query equals counts made page by page; on pages of the test tables templates are found and articles whole."""
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = {r["page_id"]: r for r in html_text.op6_html_text(spark, sf).collect()}
    parsed = [(u.split("/")[2].lower(), *html_text.parse(h)) for _, u, h in pages]
    seen = {}
    for host, blocks, boxes in parsed:
        main = "\n".join(html_text.choose(blocks, boxes)[0])
        for b in boxes:
            seen.setdefault((host, b.exact), (b, set()))[1].add(main)
    shapes = {}
    for (host, _), (b, mains) in seen.items():
        if b.small:
            s = shapes.setdefault((host, b.shape), [set(), 0, 0, 0])
            s[0] |= mains
            s[1], s[2], s[3] = s[1] + len(mains), s[2] + len(mains) * (len(mains) > 1), s[3] + len(mains) * b.links
    exact = {k for k, (_, mains) in seen.items() if len(mains) >= html_text.MIN_PAGES}
    told = {k for k, (m, n, again, menus) in shapes.items() if len(m) >= html_text.MIN_PAGES and (again >= html_text.RECURRING * n or menus >= 0.5 * n)}
    for (page_id, _, _), (host, blocks, boxes) in zip(pages, parsed, strict=True):
        texts, _ = html_text.choose(blocks, boxes, frozenset(e for h, e in exact if h == host), frozenset(s for h, s in told if h == host))
        assert got[page_id]["text"] == "\n\n".join(texts) and got[page_id]["n_chars"] == len(got[page_id]["text"])
    assert told and all(r["text"] for r in got.values())


def test_html_long(spark):
    long = "<article>" + "<div>" * 3000 + "<p>deep" + "</div>" * 3000 + "".join(f"<p>para {i}" for i in range(20_000)) + "</article>"
    df = spark.createDataFrame([(1, "http://a.b/1", long)], "page_id long, url string, html string")
    text = html_text.extract(df).first()["text"]
    assert text.startswith("deep\n\npara 0\n\n") and text.endswith("para 19999")


def test_jpeg():
    r = random.Random(0)
    data = [bytes(64), r.randbytes(64), r.randbytes(6400), b"some text. " * 640, bytes(64 * 50), bytes([104]) * 640, bytes(r.choice([103, 104, 105, 104]) for _ in range(64 * 77))]
    streams = progressive_jpeg.encode(data)
    for p, s, (image, c) in zip(data, streams, progressive_jpeg.decode(streams), strict=True):
        assert progressive_jpeg.payload(image, c) == p
        alone = progressive_jpeg.encode([p])[0]
        assert alone == s and (progressive_jpeg.rgb(image, c) == progressive_jpeg.rgb(*progressive_jpeg.decode([s])[0])).all()
    try:
        from PIL import Image
    except ImportError:
        return
    assert Image.open(io.BytesIO(streams[3])).size == progressive_jpeg.decode(streams[3:4])[0][0].width


def test_inverse_transform():
    c = np.zeros((2, 64), np.int16)
    c[0, 0], c[1, 1] = 80, 100
    s = progressive_jpeg._samples(c).reshape(2, 8, 8)
    assert (s[0] == 138).all()
    want = 128 + 100 / 4 * np.sqrt(0.5) * np.cos((2 * np.arange(8) + 1) * np.pi / 16)
    assert (np.abs(s[1].astype(float) - want[None, :]) <= 0.51).all()


def test_media_column(spark, odd):
    media = progressive_jpeg.media_column(odd.withColumn("media", F.lit(1)))
    got = {r["doc_id"]: r for r in progressive_jpeg.digests(media).collect()}
    for d, t in ODD:
        raw = (t or "").encode()
        padded = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        assert (got[d]["n_bytes"], got[d]["payload_bytes"], got[d]["payload_sha256"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
        assert got[d]["tail_crc32"] == zlib.crc32(padded[-64:])
    assert got[2]["feature"] == got[None]["feature"] and got[2]["media_sha256"] == got[None]["media_sha256"]
    part = media.select("doc_id", "n_bytes", F.when(F.col("doc_id") == 6, F.lit(b"no image")).when(F.col("doc_id") == 7, F.substring("media", 1, 300)).when(~F.col("doc_id").eqNullSafe(5), F.col("media")).alias("media"))
    for r in progressive_jpeg.digests(part).collect():
        assert (r == got[r["doc_id"]]) == (r["doc_id"] not in (5, 6, 7)) and (r["media_bytes"] is None) == (r["doc_id"] == 5)
    t = progressive_jpeg.tensor_column(media.where("doc_id = 7").unionByName(media.where("doc_id = 6").withColumn("media", F.lit(b"no image"))))
    shapes = {r["doc_id"]: r["rgb"] for r in t.collect()}
    assert shapes[6] is None and len(shapes[7]["samples"]) == shapes[7]["height"] * shapes[7]["width"] * 3
    assert progressive_jpeg.media_column(odd.limit(0)).count() == 0


def test_license(spark, odd):
    mit = license_scan.TEMPLATES["MIT-text"]
    cut = " ".join(w for i, w in enumerate(mit.split()) if i % 9)
    docs = spark.createDataFrame([(1, f"x y\n{mit} z", 0), (2, cut, 0), (3, "released under the mit license, all rights reserved", 0), (4, "the license of the software", 0)], "doc_id long, text string, licenses int")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(docs).collect()}
    assert [(m["license"], m["start"], m["coverage"]) for m in got[1]] == [("MIT-text", 2, 1.0)]
    assert got[2][0]["license"] == "MIT-text" and 0.8 <= got[2][0]["coverage"] < 1
    assert [m["license"] for m in got[3]] == ["MIT", "proprietary"] and got[4] == []
    assert license_scan.scan(odd).where("size(licenses) > 0").count() == 0 and license_scan.scan(odd).count() == len(ODD)
    r = random.Random(2)
    for _ in range(200):
        a, b = [r.randrange(6) for _ in range(r.randint(0, 30))], [r.randrange(6) for _ in range(r.randint(0, 30))]
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(license_scan.align(a, a)) == len(a)


def test_license_texts(spark):
    """Every template is found whole as itself, and a license text less its warranty as what is left of it."""
    docs = spark.createDataFrame([(k, f"some words before\n{t}\nand after") for k, t in license_scan.TEMPLATES.items()], "name string, text string")
    for r in license_scan.scan(docs).collect():
        assert [(m["license"], m["start"], m["coverage"]) for m in r["licenses"]] == [(r["name"], 3, 1.0)]


def test_license_gap_of_any_size(spark):
    """Repeated words without any unique one are aligned whatever their number."""
    a = [i % 3 for i in range(400)]
    assert len(license_scan.align([7, *a, 8], [9, *a, 6])) == 400


def test_license_query(spark, sf):
    """The statements in the test documents, which are given word by word, are found as by looking for each word by word."""
    import re

    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in word.findall(t or "")]
    forms = {k: split(t) for k, t in license_scan.TEMPLATES.items()}
    got = {r["doc_id"]: r for r in license_scan.op8_license_scan(spark, sf).collect()}
    docs = {r["doc_id"]: split(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    found = 0
    for d, w in docs.items():
        hits = sorted((-len(f), k, i) for k, f in forms.items() for i in range(len(w) - len(f) + 1) if w[i] == f[0] and w[i : i + len(f)] == f)
        kept = []
        for n, k, i in hits:
            if all(i - n <= j or i >= j + m for m, _, j in kept):
                kept.append((-n, k, i))
        assert got[d]["n_matches"] == len(kept) and got[d]["licenses"] == ",".join(sorted({k for _, k, _ in kept})), d
        assert got[d]["license_words"] == sum(n for n, _, _ in kept) and got[d]["first_start"] == min([i for *_, i in kept], default=-1)
        found += len(kept)
    assert found > 20 and set(got) == set(docs)


def test_license_twice(spark):
    mit, gpl = license_scan.TEMPLATES["MIT-text"], license_scan.TEMPLATES["GPL-3.0-header"]
    prose = "the use of this and the copies of the software"
    texts = ["All rights reserved. All rights reserved.", f"{prose} {mit} {mit} {prose}", f"{prose} {gpl} {prose} {gpl} {prose}", "All rights reserved. " * 7]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(m["license"], m["start"], m["end"], m["coverage"]) for m in r["licenses"]] for r in license_scan.scan(docs).collect()}
    assert got[0] == [("proprietary", 0, 3, 1.0), ("proprietary", 3, 6, 1.0)] and len(got[3]) == 7
    for d, name in ((1, "MIT-text"), (2, "GPL-3.0-header")):
        assert [(m[0], m[3]) for m in got[d]] == [(name, 1.0)] * 2 and got[d][0][2] <= got[d][1][1]


def test_lines(spark, odd):
    data = [(i, f"own {i}\nshared line\nmore of it {i}", f"s{i}") for i in range(12)] + [(50, "shared line", "s1"), (51, None, "s2"), (52, "", None), (53, "twice\nshared line\nshared line\nplenty of other words here", "s3")]
    df = spark.createDataFrame([(*r, 9) for r in data], "doc_id long, text string, source string, n_lines int").repartition(4)
    got = {r["doc_id"]: r for r in line_dedup.remove_boilerplate(df).collect()}
    assert got[3]["text"] == "own 3\nmore of it 3" and (got[3]["n_lines"], got[3]["n_removed_lines"]) == (3, 1)
    assert got[50]["text"] == "" and got[50]["n_removed_lines"] == 1 and got[51]["text"] is None and got[52]["text"] == ""
    assert got[53]["text"] == "twice\nplenty of other words here" and got[53]["n_removed_lines"] == 2
    clash = df.withColumns({"t1": F.lit(1), "row": F.lit(2), "gone": F.lit(3), "parts": F.lit(4)})
    assert rows(line_dedup.remove_boilerplate(clash).select("doc_id", "text", "t1", "row", "gone", "parts")) == rows(line_dedup.remove_boilerplate(df).select("doc_id", "text", F.lit(1), F.lit(2), F.lit(3), F.lit(4)))
    long = "\n".join(f"line {i}" if i % 2 else "shared line" for i in range(60_000))
    one = line_dedup.remove_boilerplate(df.unionByName(spark.createDataFrame([(99, long, "s9", 9)], df.schema))).where("doc_id = 99").first()
    assert one["n_removed_lines"] == 30_000 and one["text"] == "\n".join(f"line {i}" for i in range(1, 60_000, 2))
    assert line_dedup.remove_boilerplate(odd).count() == len(ODD) and line_dedup.remove_boilerplate(df.limit(0)).count() == 0


def test_lines_of_mostly_boilerplate(spark):
    # 12 pages with a site line; two pages of little else; one document copied to 12 sites, and near copies of it on 12
    data = [(i, f"own words of page {i}\nsite line\nmore of its own {i}", f"s{i}") for i in range(12)]
    data += [(50, "site line\nown\nsite line", "s1"), (51, "site line", "s2"), (52, "site line", "s3")]
    data += [(100 + i, "a copied document\nand its end\nsite line", f"s{i}") for i in range(12)]
    data += [(200 + i, f"a near copy\nof many lines\n{i}", f"s{i}") for i in range(12)]
    df = spark.createDataFrame([(*r, "en", len(r[1])) for r in data], "doc_id long, text string, source string, lang string, n_chars long").repartition(4)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.lines(spark, df, "").collect()}
    assert got[3][0] == "own words of page 3\nmore of its own 3"
    assert got[50] == ("own", 3) and got[51] == got[52] == ("", 0)
    assert got[105][0] == "a copied document\nand its end" and got[205][0] == "a near copy\nof many lines\n5"


def test_substrings(spark, odd, sf):
    assert rows(substring_dedup.dedup(odd, digest=True)) == sorted(substring_dedup.brute_force(ODD), key=repr)
    assert substring_dedup.dedup(odd.limit(0)).count() == 0
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(substring_dedup.op10_substring_dedup(spark, sf)) == sorted(substring_dedup.brute_force(docs), key=repr)
    r = random.Random(4)
    few = [(d, " ".join(r.choice("ab") for _ in range(r.randint(0, 40)))) for d in range(60)]
    df = spark.createDataFrame(few, "doc_id long, text string").repartition(6)
    assert rows(substring_dedup.dedup(df, window=5, digest=True)) == sorted(substring_dedup.brute_force(few, 5), key=repr)


def test_substrings_without_ids(spark):
    """Many different texts of null id, and of one id, are told apart."""
    r = random.Random(12)
    data = [(None if i % 2 else 7, f"{i} " + " ".join(r.choice("abc") + str(r.randrange(40)) for _ in range(20))) for i in range(20_000)]
    data += [(3, " ".join(t.split()[2:18])) for _, t in data[::40]]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    got = rows(substring_dedup.dedup(df, digest=True))
    assert got == sorted(substring_dedup.brute_force(data), key=repr) and sum(x[2] > 0 for x in got) >= 500


@pytest.mark.parametrize("window", [1, 2, 4, 6, 10, 13])
def test_substring_windows(spark, window, monkeypatch):
    """Every window length, with minimizers taken for hot and slices of a few documents."""
    r = random.Random(window)
    data = [(r.randrange(60), " ".join(r.choice("ab") for _ in range(r.randint(0, 60)))) for _ in range(80)]
    data = list(dict(data).items())
    run = substring_dedup._hot_minimizers
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", 1e-9)
    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert len(run(df.select(F.col("text").alias("t")), len(data), window)) > 0
    assert rows(substring_dedup.dedup(df, window=window, digest=True)) == sorted(substring_dedup.brute_force(data, window), key=repr)


def test_native_equals_sql(spark, sf):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, text in registry.oracle_sql().items():
        df = registry.queries()[name](spark, sf)
        r = c.execute(text)
        at = [[x[0] for x in r.description].index(n) for n in df.columns]
        assert rows(df) == sorted((tuple(x[i] for i in at) for x in r.fetchall()), key=repr)


def lines_by_hand(docs, min_sites=line_dedup.MIN_SITES, share=corpus_pipeline.COPY_SHARE):
    """The line stage of (doc_id, text, lang, source, n_chars), line by line."""
    sites = {}
    for _, t, _, source, _ in docs:
        for x in (t or "").split("\n"):
            if x.strip(" ") and source is not None:
                sites.setdefault(x, set()).add(source)
    boiler = {x for x, s in sites.items() if len(s) >= min_sites}
    heavy, proven = {}, {}
    for t in {d[1] for d in docs if d[1]}:
        own = [x for x in t.split("\n") if x in boiler]
        heavy[t] = sum(map(len, own)) > share * len(t)
        if not heavy[t]:
            for x in set(own):
                proven[x] = proven.get(x, 0) + 1
    out = []
    for d, t, lang, source, n in docs:
        if t:
            gone = {x for x in boiler if not heavy[t] or proven.get(x, 0) >= min_sites}
            kept = [x for x in t.split("\n") if x not in gone]
            if len(kept) < t.count("\n") + 1:
                t = "\n".join(kept)
                n = len(t)
        out.append((d, t, lang, source, n))
    return out


def test_pipeline(spark, sf):
    """Each stage after toxicity equals its brute-force version on what the stage before it kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [[tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == corpus_pipeline.COLUMNS, name
        kept.append([tuple(r) for r in docs.collect()])
        docs = spark.createDataFrame(kept[-1], docs.schema)
    start, civil, lines, distinct, clean = kept
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = {r[0] for r in start} - {r[0] for r in civil}
    assert len(start) - len(gone) == len(civil) and set(civil) <= set(start)
    assert np.mean([labels[r[0]] == (r[0] in gone) for r in start if r[0] in labels]) >= 0.95
    assert sorted(lines, key=repr) == sorted(lines_by_hand(civil), key=repr)
    first = {d for d, _, _, k in near_dedup.brute_force([(r[0], r[1]) for r in lines], shingle=5) if k}
    assert sorted(distinct, key=repr) == sorted((r for r in lines if r[0] in first), key=repr)
    bad = {d for d, *_, hit in decontaminate.brute_force([(r[0], r[1]) for r in distinct], bench) if hit}
    assert bad and sorted(clean, key=repr) == sorted((r for r in distinct if r[0] not in bad), key=repr)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r[0] for r in last.select("doc_id").distinct().collect()} == {r[0] for r in clean} and len(clean) > 0.7 * len(start)


def test_pipeline_on_odd_tables(spark, sf_small):
    """Nulls in every column, empty, blank and long texts, repeated rows, and columns of clashing names."""
    odd = [(None, "a b c d", None, None, None), (3, "A b c d", "en", "s1", 7), (2, "a b c d", "en", "s2", 7), (2, "a b c d", "en", "s2", 7), (5, None, "en", "s1", None), (6, "", None, "s1", 0), (7, " \n\t ", "en", None, 4), (7, " \n\t ", "en", None, 4), (9, "q " * 60_000, "en", "s3", 120_000)]
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in odd], "doc_id long, text string, lang string, source string, n_chars long, bad int, near_t string, __score double").repartition(3)
    alive = {"toxicity": 9, "line dedup": 9, "near dedup": 5, "decontamination": 5}
    docs, empty = df, df.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = stage(spark, docs, sf_small), stage(spark, empty, sf_small)
        assert docs.columns == empty.columns == corpus_pipeline.COLUMNS and (docs.count(), empty.count()) == (alive[name], 0), name
        docs = spark.createDataFrame(docs.collect(), docs.schema).repartition(2)
    assert sorted((r["doc_id"] for r in docs.collect()), key=str) == [2, 5, 6, 7, 9]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_small)
    assert {r["doc_id"] for r in pieces.collect()} == {2, 5, 6, 7, 9} and corpus_pipeline.STAGES[-1][1](spark, empty, sf_small).count() == 0


def test_pipeline_run(spark, sf_small):
    """run() gives the pieces of what all stages kept, and leaves no table but the stages' results."""
    import os

    from tidewell import session

    folder = session.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, sf_small)
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {"pipeline-" + n.replace(" ", "-") for n, _ in corpus_pipeline.STAGES}
    n = spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert 0.6 * n < out.select("doc_id").distinct().count() < n


def test_near_dedup_writes_few_files(spark, monkeypatch, tmp_path):
    """Tables of keys are written by a few tasks for each core, however many shuffle partitions there are."""
    from tidewell import session
    from tidewell.llm import near_dedup

    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    base = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(40)]
    docs = spark.createDataFrame([(i, base[i % 40] + " end" * (i // 40)) for i in range(120)], "doc_id long, text string")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 97)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        near_dedup.near_groups(docs, shingle=2)
        most = 4 * spark.sparkContext.defaultParallelism
        files = {d.name: len(list(d.glob("part-*"))) for d in tmp_path.iterdir() if not d.name.startswith(("signed", "texts"))}
        assert len(files) > 8 and max(files.values()) <= most < 97, files
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
