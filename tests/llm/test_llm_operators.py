"""The operators on small tables: brute force, round trips and edge cases."""

from __future__ import annotations

import math
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import (
    decontaminate,
    extract,
    jaccard,
    langid,
    mixing,
    neighbours,
    shared,
    sharding,
    toxicity,
    warc,
    wavelet,
    words,
)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    shared.prepare(spark)


def documents(spark, texts, source="s"):
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


LONG = " ".join(f"w{i}" for i in range(300))
ODD = ["", None, " \n\t", "a", "a b c", LONG, LONG, LONG.replace("w7 ", "x "), LONG[:900], "end. of, it"]


def test_words_match_a_plain_split(monkeypatch):
    monkeypatch.setattr(words, "PIECE", 64)
    hashes, bounds = words.hashed(pa.array(ODD))
    plain = [(t or "").encode().lower().split() for t in ODD]
    assert [len(p) for p in plain] == list(np.diff(bounds))
    seen = {}
    for word, h in zip((w for p in plain for w in p), hashes, strict=True):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/", "<p>x"), (1, None, "<p>x"), (2, "u", None), (4, "u", ""), (None, "u", "<p>x"), (1, None, "<p>x"), (5, "u", "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("revisit", F.lit("extra"))
    got = sorted(map(tuple, warc.archive_pages(spark, pages).collect()), key=str)
    digest = warc.digest_text
    x, empty = digest(b"<p>x"), digest(b"")
    assert got == sorted(
        [
            (1, 4, x, "response", None),
            (1, 4, x, "revisit", 1),
            (3, 4, x, "revisit", 1),
            (None, 4, x, "revisit", 1),
            (2, 0, empty, "response", None),
            (4, 0, empty, "revisit", 2),
            (5, 2, digest("é".encode()), "response", None),
        ],
        key=str,
    )
    index = warc.write_archives(spark, pages, frame_bytes=300).filter("page_id = 5").first()
    headers, block = warc.read_record(index["bundle"], index["frame"], index["offset"])
    assert headers["WARC-Record-ID"] == f"<{index['record_id']}>" and warc.http_payload(block)[1] == "é".encode()
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


PAGE = """<html><body><header class="top"><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
<nav><ul><li><a href=1>A</a></ul></nav><div class="content post-123"><article><header><h1>The Title</h1></header>
<p>First &amp; best para<b>graph</b>
 here.<p>Second &lt;p&gt; one.<ul><li>item a<li>item b</ul><div class="ad">BUY</div></article></div>
<section class="comments"><p>A reader says very many things, on and on and on and on and on.</p></section>
<form><label>Name</label></form><footer>(c)</footer><script>if(a<b){"</p>"}</script></body></html>"""


def test_extract(spark):
    rows = [(1, "http://h/1", PAGE), (2, "http://h/2", PAGE.replace("post-123", "post-9")), (3, None, None), (4, "x", ""), (5, "http://h/3", "plain text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit(1))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract.extract_pages(pages).collect()}
    article = "The Title First & best paragraph here. Second <p> one. item a item b"
    assert got[1] == got[2] == (article, len(article))
    assert got[3] == got[4] == ("", 0) and got[5] == ("plain text", 10)


@pytest.mark.parametrize(
    "around",
    ['class="overflow-hidden"', 'style="overflow:hidden"', 'data-x="hidden"', 'class="content has-sidebar"', 'class="entry comments-open"', 'id="page" class="layout sidebar-left"'],
)
@pytest.mark.parametrize("inner", ["article", "div"])
def test_extract_keeps_what_holds_the_article(around, inner):
    aside = '<div class="sidebar"><p>Aside</p></div><div hidden><p>Secret</p></div><p style="color:red;display:none">Gone</p>'
    comments = '<div id="comments" class="comments-area">' + "<article><p>A reader says very many things.</p></article>" * 9 + "</div>"
    page = f"<body><div {around}><{inner}><h1>Title</h1><p>First paragraph.</p><p>Second one.</p></{inner}>{aside}</div>{comments}<div class=sidebar><p>More</p></div></body>"
    assert extract.extract(page) == "Title First paragraph. Second one."


@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_extract_keeps_the_title_of_long_articles(spark, outer):
    menu = '<div class="links"><a href=1>Other story</a> <a href=2>Next story</a></div>'
    page = "<body><div>{m}<{o}><h1>The title</h1><div class=entry-content><p>{t}</p></div><div class=sub>Author</div></{o}></div></body>"
    rows = [(i, "http://h/", page.format(m=menu, o=outer, t=" ".join(["words"] * n))) for i, n in enumerate((20, 2000))]
    got = {r["page_id"]: r["text"] for r in extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: " ".join(["The title", *["words"] * n, "Author"]) for i, n in enumerate((20, 2000))}


@pytest.mark.parametrize(
    "html",
    [
        "<a " * 340_000,
        '<a "' * 250_000,
        "<!x " * 250_000,
        "<a '\" " * 170_000,
        "<div>" * 100_000 + "</b>" * 100_000,
        "<b><article>" + "<i>" * 120_000 + "</b>" * 120_000,
        "<span>x" * 140_000,
        "<ul><li>" * 120_000,
        "<p " + "x" * 1_000_000 + ">t",
        '<div class="x menu"><article>t</article>' * 25_000,
        '<div class="x menu"><article>t</article></div>' * 22_000,
        "<div class=x><p>t</p></div>" * 36_000,
    ],
    ids=lambda html: html[:12],
)
def test_broken_pages_of_a_megabyte_take_seconds(html):
    begin = time.monotonic()
    extract.votes(html)
    extract.extract(html, "div.x")
    assert time.monotonic() - begin < 20


def test_tags_end_as_a_plain_search_finds():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        html = "".join(rng.choice(list("<<<>ab/!? \"'-")) for _ in range(30))
        tags, at, found = extract._Tags(html), 0, []
        while m := tags.next(at):
            found.append(m.span())
            at = m.end()
        assert found == [m.span() for m in extract._TAG.finditer(html)]


@pytest.mark.parametrize(
    "kept",
    ['p class="market-share"', 'div class="search-results-study"', 'p class="alert"', 'p class="menu"', 'li class="related"', 'h2 id="search"', "label", 'span class="share"'],
)
@pytest.mark.parametrize("dropped", ['div class="share-buttons"', 'div class="related-posts"', 'p class="advert"', 'div class="cookie-law"', 'section class="menu"'])
def test_extract_inside_articles_goes_by_whole_names(kept, dropped):
    page = f"<body><article><h1>T</h1><p>One.</p><{kept}>Two.</{kept.split()[0]}><{dropped}>Gone.</{dropped.split()[0]}><p>Three.</p></article><div class=market-share><p>Aside</p></div></body>"
    assert " ".join(extract.extract(page).split()) == "T One. Two. Three."


def test_extract_is_the_same_for_hot_hosts_and_many(spark):
    rows = [(i, f"http://{'hot' if i % 3 else f'h{i}'}/{i}", f"<body><div class=d{i % 2}><p>Text {i} of the page.</p></div></body>") for i in range(60)]
    rows += [(60, None, "<p>x</p>"), (None, "http://hot/", None), (1, "http://hot/1", rows[1][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    plain = sorted(map(tuple, extract.extract_pages(pages).collect()), key=str)
    assert len(plain) == len(rows)
    for limits in ((10, 5, 1 << 20), (10, 100, 5), (1000, 0, 0)):
        assert sorted(map(tuple, extract.extract_pages(pages, *limits).collect()), key=str) == plain
    assert extract.extract_pages(pages.limit(0), 10, 0, 0).count() == 0


def test_consensus_path_beats_an_odd_page(spark):
    odd = "<body><div class=note1><p>short</p></div><div class=main><p>text</p></div></body>"
    usual = "<body><div class=main><p>" + "text " * 50 + "</p></div></body>"
    rows = [(i, "http://h/", usual) for i in range(5)] + [(9, "http://h/", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert extract.extract_pages(pages).filter("page_id = 9").first()["text"] == "text"


def test_language_gradients_match_differences():
    net = {k: v.astype(np.float64) for k, v in langid.new_network(3, hidden=3).items()}
    rng = np.random.default_rng(1)
    x, y = rng.integers(97, 103, (6, 4)), np.array([0, 1, 2, 0])
    _, grads = langid.loss_and_gradients(net, x, y)
    for name in ("Uf", "Ob", "b", "Wf"):
        at = (1, x[0, 0]) if name[0] == "W" else (1, 0)
        kept, losses = net[name][at], []
        for step in (1e-4, -1e-4):
            net[name][at] = kept + step
            losses.append(langid.loss_and_gradients(net, x, y)[0])
        net[name][at] = kept
        assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=0.02, abs=1e-5)


def test_every_language_is_drawn_equally_often(monkeypatch):
    drawn = []
    plain = langid.loss_and_gradients
    monkeypatch.setattr(langid, "loss_and_gradients", lambda net, x, y: drawn.append(y) or plain(net, x, y))
    for languages in (3, 20):  # fewer and more than a batch has
        drawn.clear()
        windows = [bytes([97 + k]) * 8 for k in range(languages)]
        net = langid.train(windows, np.arange(languages), languages, steps=40, batch=8)
        counts = np.bincount(np.concatenate(drawn), minlength=languages)
        assert counts.max() - counts.min() <= 1 and counts.min() >= 40
        p = langid.document_probabilities(net, pa.array([w * 4 for w in windows], pa.binary()))
        assert (p.argmax(axis=1) == np.arange(languages)).mean() > 0.9


def test_language_segments_pool_whole_texts():
    net = langid.new_network(2, hidden=4)
    texts = ["abc" * 100, "", "xyz", None]
    p = langid.document_probabilities(net, pa.array(texts))
    assert p[[0, 2]].sum(axis=1) == pytest.approx(1, abs=1e-5) and not p[[1, 3]].any()
    assert p[0] == pytest.approx(langid.document_probabilities(net, pa.array(texts[:1]))[0], abs=1e-6)


def test_language_predictions(spark):
    texts = ["the cat and the dog went home " * 3, "der hund und die katze gehen heim " * 3] * 40
    rows = [(i, t, ("en", "de")[i % 2], "s", 1) for i, t in enumerate(texts)] + [(900, None, "en", "s", 0), (901, "12 34!", None, "s", 6)]
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumn("score", F.lit(1))
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert all(got[i]["lang_pred"] == ("en", "de")[i % 2] for i in range(80))
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"
    assert got[6]["held_out"] == (zlib.crc32(b"6") % 4 == 2)
    assert langid.identify(docs.limit(0)).count() == 0


def plain_groups(texts, size, percent):
    sets = []
    for text in texts:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    return [(i, len(s), group[i]) for i, s in enumerate(sets)]


def test_jaccard_groups_match_all_pairs(spark):
    rng = np.random.default_rng(3)
    texts = list(ODD)
    for base in range(6):
        for n in range(8):  # chains of edits: neighbours link, ends do not
            w = [f"b{base}x{i}" for i in range(120)]
            for k in range(n):
                w[15 * k] = f"e{base}y{k}"
            texts.append(" ".join(w))
    texts += [" ".join(f"v{x}" for x in rng.integers(0, 50, 60)) for _ in range(20)]
    docs = documents(spark, texts).withColumn("n", F.lit("clash"))
    got = sorted(map(tuple, jaccard.group_documents(spark, docs).collect()))
    assert got == plain_groups(texts, 4, 85)
    kept = {r["doc_id"] for r in jaccard.drop_near_copies(spark, documents(spark, texts)).collect()}
    assert kept == {i for i, n, g in plain_groups(texts, 4, 85) if i == g or not n}
    assert jaccard.group_documents(spark, docs.limit(0)).count() == 0


def test_prefixes_of_similar_sets_meet_under_every_order():
    rng = np.random.default_rng(0)
    levels = rng.integers(0, 20, 1 << jaccard.SKETCH_BITS).astype(np.uint8)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 100).astype(np.uint64))
        b = np.unique(np.concatenate([a[8:], rng.integers(0, 2**63, 7).astype(np.uint64)]))
        assert 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
        for number in (1, 2, 3):
            assert len(np.intersect1d(jaccard.prefix(a, levels, number), jaccard.prefix(b, levels, number)))


def test_sharding_is_even_and_gathers_copies(spark):
    texts = [f"unique {i}" for i in range(300)] + ["hot"] * 150 + [f"pair {i // 2}" for i in range(80)] + ["", None]
    rows = sharding.shard(spark, documents(spark, texts).withColumn("row", F.lit(0)), shards=10).collect()
    sizes, slots, places = {}, {}, {}
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text) + 16 and r["text_crc32"] == zlib.crc32(text.encode()) and r["law"] == "rows"
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + 1
        slots.setdefault(r["shard"], []).append(r["slot"])
        places.setdefault(text, set()).add(r["shard"])
    assert len(rows) == len(texts) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(p) > 1 for t, p in places.items() if t.startswith("pair")) <= 8
    assert len(places["hot"]) < 10
    assert sharding.shard(spark, documents(spark, texts).limit(0)).count() == 0


def test_groups_gather_without_unlinked_rows(spark):
    groups = documents(spark, [f"group {i // 3}" for i in range(300)])
    sharded = sharding.shard(spark, groups, shards=10).cache()
    assert sorted(r["count"] for r in sharded.groupBy("shard").count().collect()) == [30] * 10
    # All 100 groups start cut; shards without a loose document left may keep a few so.
    assert sharding.cut_links(sharded).count() <= 15


def test_sharding_of_null_ids_few_rows_and_empty_texts(spark):
    rows = [(None, "a"), (None, "a"), (7, ""), (8, ""), (9, None)]
    out = sharding.shard(spark, spark.createDataFrame(rows, "doc_id long, text string"), shards=40).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in out) == [(0, 17), (0, 17), (7, 16), (8, 16), (9, 16)]
    assert all(r["slot"] == 0 for r in out) and len({r["shard"] for r in out}) == 5
    linked = {r["doc_id"]: r["link"] for r in out if r["doc_id"]}
    assert linked[7] == linked[8] is not None and linked[9] is None


ITEMS = [
    (1, "What river runs through the old town of Marley and meets the sea? The river Tarn."),
    (2, "Name the largest moon of the seventh planet in this invented system. It is Ogelle."),
    (3, None),
]


def test_leaks_are_found_and_clean_texts_left(spark):
    filler = " ".join(f"f{i}" for i in range(400))
    texts = [
        f"{filler} {ITEMS[0][1].upper()} {filler}",
        f"{filler} {ITEMS[0][1].split('?')[0]} {filler}",  # the question without its answer
        filler,
        None,
        "",
        ITEMS[1][1],
    ]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_leaks(documents(spark, texts).withColumn("item_id", F.lit("x")), bench, index_items=1)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(0, 1), (5, 2)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(documents(spark, texts), bench).collect()) == [1, 2, 3, 4]
    assert decontaminate.find_leaks(documents(spark, texts), bench.limit(0)).count() == 0


def test_leaks_do_not_depend_on_the_parts_of_the_index(spark):
    common = " ".join(f"c{i}" for i in range(20))
    items = [(i, f"{common} " + " ".join(f"o{i}x{k}" for k in range(10 + i % 7))) for i in range(40)]
    items += [(5, items[6][1]), (6, items[6][1]), (6, items[6][1]), (None, items[7][1]), (50, " "), (51, common[:40])]
    filler = " ".join(f"f{i}" for i in range(90))
    texts = [common, f"{filler} {common} {filler}", None, "", *[f"{filler} {items[i][1]} {filler}" for i in (0, 6, 39)], filler * 9]
    texts += [" ".join(w for k, w in enumerate(items[9][1].split()) if k % 6), texts[4]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, texts)
    docs = docs.unionAll(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    found = [sorted(map(tuple, decontaminate.find_leaks(docs, bench, index_items=n).collect()), key=str) for n in (1, 10, 100)]
    assert found[0] == found[1] == found[2]
    assert {(0, 51), (1, 51), (4, 0), (5, 5), (5, 6), (6, 39), (None, 6), (9, 0)} <= {r[:2] for r in found[0]}
    assert not [r for r in found[0] if r[0] in (0, 1) and r[1] != 51]
    statistics = decontaminate.Statistics.of([t for _, t in {(i, t) for i, t in items if i is not None}])
    index = decontaminate.Index([items[39]], statistics)
    assert index.search(list(range(len(index.terms))), 0.5) == [(0, pytest.approx(1.0))]


def test_passages_without_a_question_are_verified_whole(spark):
    passage = "Along the northern ridge the old surveyors left seven marked stones beside the frozen track. Nobody moved them for ninety winters after that. It snowed."
    filler = " ".join(f"f{i}" for i in range(200))
    texts = [f"{filler} {passage}", f"{filler} {passage.replace('It snowed', 'Rain fell')} {filler}", f"{passage[:-10]} {filler}", f"It snowed. {filler}"]
    bench = spark.createDataFrame([(7, passage), *ITEMS], "item_id long, text string")
    found = decontaminate.find_leaks(documents(spark, texts), bench)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(0, 7), (1, 7), (2, 7)]
    assert decontaminate.split_item("Who? The cat.") == ("Who?", "The cat.")
    assert decontaminate.split_item("Name it. Answer: Ogelle")[1].strip() == "Ogelle"
    for whole in (passage, "Why not? It rained. It snowed.", "Who? Where?", "Vitamin a: good."):
        assert decontaminate.split_item(whole) == (whole, whole)


def test_block_max_wand_matches_all_scores():
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"t{x}" for x in rng.zipf(1.4, 30) % 200)) for i in range(120)]
    index = decontaminate.Index(items)
    for _ in range(40):
        terms = np.unique(rng.integers(0, len(index.terms), 40))
        plain = np.zeros(len(index.owner))
        for t in terms:
            low, high = index.starts[t], index.starts[t + 1]
            plain[index.pieces[low:high]] += index.scores[low:high]
        for threshold in (0.1, 0.3, 0.6):
            assert sorted(p for p, _ in index.search(terms.tolist(), threshold)) == np.flatnonzero(plain >= threshold).tolist()


def test_tokens_equal_the_tokenizer_and_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(wavelet.tokenizer_path())
    texts = [*ODD, "don't I'LL a.b,c ,, x. <|endoftext|> <|ENDOFTEXT|>", "Ünï É é, 東京。 nb sp İI ΣΑΣ 🙂, q'S", "Å̊ å, \x1c\x85"]
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    docs = documents(spark, texts).withColumn("start", F.lit(0))
    got = sorted(map(tuple, wavelet.tokenize_documents(spark, docs, shard_bytes=500).collect()))
    starts = np.cumsum([0, *map(len, ids)])
    assert got == [(i, starts[i], len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)]
    assert wavelet.tokenize_documents(spark, docs.limit(0)).count() == 0


def test_wavelet_queries(tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK", 16)
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 37, 1000).astype(np.uint32)
    path = str(tmp_path / "x.wm")
    wavelet.write_matrix(path, tokens, [7, None], np.array([400, 600]))
    with shared.open_file(path) as source:
        matrix = wavelet.WaveletMatrix(source)
        assert (matrix.decode() == tokens).all() and matrix.documents()[0] == [7, None]
        for i in (0, 127, 128, 500, 999):
            assert matrix.access(i) == tokens[i]
        for token in (0, 5, 36, 60):
            where = np.flatnonzero(tokens == token)
            assert matrix.count(token) == len(where) and matrix.rank(token, 500) == (where < 500).sum()
            assert matrix.count(token, 100, 700) == ((where >= 100) & (where < 700)).sum()
            assert [matrix.select(token, k) for k in range(len(where))] == where.tolist()
        with pytest.raises(IndexError):
            matrix.select(60, 0)


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    x[5] = x[200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (None, x[1].tolist()), (900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    got = neighbours.nearest(spark, vectors, F.col("vec_id") % 100 == 0, group=2).collect()
    for q in (0, 100, 200):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(300), d)) if i != q][:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[1] for m in mine] == order and [m[0] for m in mine] == list(range(1, 11))
        assert [m[2] for m in mine] == pytest.approx(d[order].tolist(), rel=1e-12)
    assert neighbours.nearest(spark, vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_int8_bounds_hold():
    rng = np.random.default_rng(6)
    a, b = (neighbours.Block(np.arange(50), rng.standard_normal((50, 24)) * s) for s in (1, 30))
    exact = np.sqrt(((a.x[:, None] - b.x[None]) ** 2).sum(axis=2))
    lower, upper = neighbours.tile_bounds(a, b)
    assert (lower <= exact).all() and (exact <= upper).all()


def toxic_sample():
    rng = np.random.default_rng(8)
    plain = [" ".join(f"w{x}" for x in rng.integers(0, 60, 30)) for _ in range(400)]
    texts, labels = [], []
    for i, text in enumerate(plain):
        insult = i % 5 == 0
        # Mentions of one group come mostly with insults.
        mention = " women" if (insult and i % 10 == 0) or i % 97 == 0 else ""
        texts.append(text + mention + (" you idiot scum!" if insult else ""))
        labels.append(float(insult))
    return texts, np.array(labels)


def test_counterfactuals_lower_the_score_of_neutral_mentions():
    texts, labels = toxic_sample()
    features, bounds = toxicity.features(pa.array(texts))
    sparse = toxicity.counted(features, bounds)
    neutral = toxicity.features(pa.array(["w1 w2 women w3", "w1 w2 men w3"]))
    gaps = []
    for fairness in (0.0, 5.0):
        w, b = toxicity.train(*sparse, labels, fairness=fairness)
        p = toxicity.score_features(*neutral, w, b)
        gaps.append(p[0] - p[1])
        mine = toxicity.score_features(features, bounds, w, b)
        assert ((mine >= toxicity.THRESHOLD) == (labels == 1)).mean() > 0.97
    assert 0 <= gaps[1] < 0.5 * gaps[0]


def test_swapped_terms_take_their_heads_along():
    texts = ["muslims and muslim immigration: Muslim immigrants", "christians and christian immigration: christian citizens", "women men women"]
    sparse = toxicity.counted(*toxicity.features(pa.array(texts)))
    row, feature, difference = toxicity.swapped(*sparse, toxicity.swap_table(toxicity.IDENTITY_PAIRS))
    plain = [dict(zip(sparse[1][sparse[0] == i].tolist(), sparse[2][sparse[0] == i].tolist(), strict=True)) for i in range(3)]
    turned = {f: plain[0].get(f, 0) - plain[1].get(f, 0) for f in plain[0] | plain[1]}
    got = dict(zip(feature[row == 0].tolist(), difference[row == 0].tolist(), strict=True))
    assert got == pytest.approx({f: d for f, d in turned.items() if d})

    samples, labels = toxic_sample()
    samples = [t.replace("women", "muslims") for t in samples]
    sparse = toxicity.counted(*toxicity.features(pa.array(samples)))
    neutral = toxicity.features(pa.array(["w1 w2 muslims w3", "w1 w2 christians w3"]))
    gaps = []
    for fairness in (0.0, 5.0):
        p = toxicity.score_features(*neutral, *toxicity.train(*sparse, labels, fairness=fairness))
        gaps.append(p[0] - p[1])
    assert 0 <= gaps[1] < 0.1 * gaps[0]


def test_toxicity_queries(spark):
    texts, labels = toxic_sample()
    docs = documents(spark, [*texts, None, ""]).withColumn("label", F.lit("x"))
    marks = spark.createDataFrame([(i, 1, int(v)) for i, v in enumerate(labels)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, marks).collect()}
    held = [i for i in range(len(texts)) if got[i]["held_out"]]
    assert held and np.mean([got[i]["predicted"] == labels[i] for i in held]) > 0.95
    assert len(got) == len(texts) + 2 and got[len(texts)]["predicted"] == 0
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert {r["score"] for r in toxicity.score_documents(docs, marks.limit(0)).collect()} == {0.0}


def test_mixing_budgets(spark):
    texts = [" ".join(["w"] * (i % 7)) for i in range(90)] + [None]
    docs = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") % 3 < 2, F.concat(F.lit("s"), F.col("doc_id") % 3)))
    rows = mixing.mix(spark, docs.withColumn("size", F.lit("x"))).collect()
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in rows)
    assert sum(p[0]["target"] for p in by.values()) == pytest.approx(1.5 * total)
    for part in by.values():
        assert sum(r["taken"] for r in part) == math.floor(part[0]["target"])
    mixed = mixing.mix_documents(spark, docs)
    assert mixed.columns == docs.columns
    words_out = mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words_out == sum(r["taken"] for r in rows)
    assert mixing.mix(spark, docs.limit(0)).count() == 0 and mixing.mix_documents(spark, docs.limit(0)).count() == 0


W, V, X, Y = (" ".join(f"{letter}{i}" for i in range(60)) for letter in "wvxy")


def test_jaccard_rows_of_one_id_link_their_texts(spark):
    rows = [(1, W), (5, W), (5, V), (9, V + " v60"), (7, X)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard.group_documents(spark, docs).collect())
    assert got == [(1, 1), (5, 1), (5, 1), (7, 7), (9, 1)]


def test_near_copies_keep_unlike_texts_of_one_id(spark):
    rows = [(1, W), (5, W), (5, V), (7, X), (7, Y), (7, Y), (8, Y + " y60"), (None, W), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _key int")
    got = sorted(((r["doc_id"], r["text"]) for r in jaccard.drop_near_copies(spark, docs).collect()), key=str)
    assert got == sorted([(1, W), (5, V), (7, X), (7, Y), (None, W), (None, None), (9, "")], key=str)
    assert jaccard.drop_near_copies(spark, docs).columns == ["doc_id", "text", "_key"]
    assert jaccard.drop_near_copies(spark, docs.limit(0)).collect() == []


def test_bounds_hold_for_wide_vectors():
    draw = np.random.default_rng(8)
    x = np.rint(draw.uniform(100, 127, (40, 8192)))
    x[:, 0] = 127
    y = x + (np.arange(8192) % 1000 == 1) * draw.integers(-3, 1, (40, 1))
    queries, candidates = (neighbours.Block(np.arange(40), v) for v in (x, y))
    lower, upper = neighbours.tile_bounds(queries, candidates)
    exact = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    assert (lower <= exact).all() and (exact <= upper).all()
