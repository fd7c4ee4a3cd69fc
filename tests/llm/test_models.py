"""Classifiers, search, mixing, extraction and URL filters."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorascope.llm import extract, labelled, licenses, mixing, quality, topk, toxicity, urls


def brute_top(rows, k):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in good]
    out = []
    for q, a in good:
        if q % 5:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(a) == len(b))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [3, 10, 500])
def test_top_k_equals_brute_force(make, monkeypatch, k):
    monkeypatch.setattr(topk, "DEPTH", 4)
    r = random.Random(k)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(6)] + [(300, None), (305, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (310, [float("nan")] * 6), (None, rows[0][1])]
    rows += [(315, [float("inf")] * 6), (320, [1.0, 2.0]), (321, [3.0, -1.0]), (325, []), (330, [1e12] * 6)]
    df = make(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=k)
    assert sorted(tuple(x) for x in got.collect()) == brute_top(rows, k)


def test_top_k_of_no_rows(make):
    assert topk.top_k(make([], "vec_id long, embedding array<float>"), F.col("vec_id") % 5 == 0).count() == 0


def water_levels(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / share for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def test_mix_meets_its_targets(make):
    r = random.Random(2)
    rows = []
    for k, (source, n) in enumerate([("a", 40), ("b", 200), ("B", 3), (None, 60), ("é", 30), ("zero", 2)]):
        for _ in range(n):
            size = 0 if source == "zero" else r.choice([1, 5, 5, 5, 40, 120])
            rows.append((len(rows), source, " ".join(["w"] * size) if size or k % 2 else None, 1))
    df = make(rows, "doc_id long, source string, text string, SIZE int")
    got = mixing.mixed(df).collect()
    assert len(got) == len(rows) and sorted(x.id for x in got) == list(range(len(rows)))
    sizes = {}
    for x in got:
        sizes[x.source] = sizes.get(x.source, 0) + x["size"]
    target = water_levels(sizes)
    for source, size in sizes.items():
        own = [x for x in got if x.source == source]
        assert all(abs(x.target - target[source]) < 1e-6 * max(1, size) and x.source_size == size for x in own)
        taken = sum(x.copies * x["size"] for x in own)
        assert abs(taken - target[source]) <= max(3, 0.01 * target[source])
    assert all(0 <= x.copies <= 3 for x in got)
    again = mixing.mixed(df.repartition(7)).collect()
    assert sorted((x.id, x.copies) for x in got) == sorted((x.id, x.copies) for x in again)


def test_rates_tilt_exponentially(make):
    rows = [(i, "ab"[i % 2], " ".join(["w"] * (1 + i % 17))) for i in range(400)]
    got = mixing.mixed(make(rows, "doc_id long, source string, text string")).collect()
    for source in "ab":
        own = [x for x in got if x.source == source and x.rate < 3]
        slopes = {round(math.log(x.rate) / x["size"], 9) for x in own}
        assert len(slopes) == 1


def test_mix_of_nothing(make):
    schema = "doc_id long, source string, text string"
    assert mixing.mixed(make([], schema)).count() == 0
    empty = mixing.mixed(make([(None, None, None), (None, None, None)], schema)).collect()
    assert [(x["size"], x.target) for x in empty] == [(0, 0.0), (0, 0.0)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li></ul></nav><!-- ad --><div class="ad">Buy this now, it is a long advert text indeed.</div>%s
<footer>&copy; somebody &middot; words</footer></body></html>"""


@pytest.mark.parametrize(
    "body,want",
    [
        ("<article><h1>Head  line</h1><p><b>One two.<br><p>Three &amp; fo<i>ur</i>.</p><p>Sh.</p></article>", "Head line One two. Three & four. Sh."),
        ("<div id=content><p>Some long text that is the main one here.</p><p>And more of it, as long as that.</p></div>"
         "<div class='comments'><p>A reader's very long comment that says nothing at all but goes on.</p></div>",
         "Some long text that is the main one here. And more of it, as long as that."),
        ("<main><form><p>Sign up for our letters please</p></form><aside>See also</aside><p>Real words.</p></main>", "Real words."),
        ("", ""),
    ],
)
def test_main_text(body, want):
    assert extract.main_text(PAGE % body) == want


_LONG = "<p>This is the long text of a page, and it goes on for quite a while here.</p><p>It has a second part, as long as the first one of them is.</p>"
_LONG_TEXT = "This is the long text of a page, and it goes on for quite a while here. It has a second part, as long as the first one of them is."


@pytest.mark.parametrize(
    "body,want",
    [
        (f"<main class='with-sidebar'>{_LONG}</main>", _LONG_TEXT),
        (f"<article class='post has-comments'>{_LONG}</article>", _LONG_TEXT),
        (f"<article id='comments-open'>{_LONG}</article><article class='comment'><p>So true.</p></article>", _LONG_TEXT),
        (f"<form id='aspnetForm'><div>{_LONG}</div></form>", _LONG_TEXT),
        (f"<div role='form'>{_LONG}</div>", _LONG_TEXT),
        (f"<form><p>One.</p></form><form>{_LONG}</form><div class=comments>{_LONG * 9}</div>", _LONG_TEXT),
        ("<form><p>Post number one.</p></form><form><p>Post number two.</p></form><form><p>Post number six.</p></form>", "Post number one. Post number two. Post number six."),
        (f"<div><h2>Head</h2>{_LONG}</div><form><p>Sign up here</p></form>", f"Head {_LONG_TEXT}"),
        (f"<article>{_LONG}{_LONG}</article><article>{_LONG}</article><article><h2>Third</h2><p>Its words.</p></article>",
         f"{_LONG_TEXT} {_LONG_TEXT} {_LONG_TEXT} Third Its words."),
        (f"<div><article>{_LONG}</article></div><div><article><h2>B</h2>{_LONG}</article></div>", f"{_LONG_TEXT} B {_LONG_TEXT}"),
        (f"<article>{_LONG}</article><div>{_LONG}</div>", f"{_LONG_TEXT} {_LONG_TEXT}"),
    ],
)
def test_main_text_is_not_lost_by_names(body, want):
    assert extract.main_text(f"<body>{body}</body>") == want
    assert extract.main_text(PAGE % body) == want


def test_main_text_of_odd_pages(make):
    assert [extract.main_text(x) for x in (None, "", "plain &lt; text", "<p>", "<script>x", "a < b")] == ["", "", "plain < text", "", "", "a < b"]
    deep = "<div>" * 5000 + "deep words" + "</div>" * 5000
    assert extract.main_text(deep) == "deep words"
    rows = extract.main_texts(make([(1, None, 2), (1, None, 2), (2, "<p>x</p>", None)], "page_id long, html string, MAIN_TEXT int")).collect()
    assert sorted(r.main_text for r in rows) == ["", "", "x"]


def test_url_parts_and_rules(make):
    cases = {
        "HTTP://WWW.Example.COM/de/7?x#y": ("www.example.com", "/de/7", "example.com/de/", "block"),
        "http://a.example.net/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
        "http://badexample.com/de/": ("badexample.com", "/de/", None, None),
        "x://org/fr/#a://b": ("org", "/fr/", "org/fr/", "allow"),
        "http://net": ("net", "", None, None),
        "s://h?a=/b": ("h", "", None, None),
        "no url": ("", "", None, None),
        "": ("", "", None, None),
    }
    rows = [(u, "old") for u in cases] + [(None, "old")]
    got = {r.url: r for r in urls.judged(make(rows, "url string, HOST string")).collect()}
    for url, (host, path, rule, verdict) in cases.items():
        r = got[url]
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
    assert got[None].host == "" and got[None].verdict in ("allow", "block")
    assert urls.judged(make([], "url string")).count() == 0


def test_names_are_segmented_and_scored(make):
    model = urls.Segmenter({w: 3 for w in urls.KNOWN})
    assert model.words("cheapcasinowin.example") == ["cheap", "casino", "win", "example"] or model.words("casinowin") == ["casino", "win"]
    good = [(f"http://{a}{b}.example.com/x/{k}",) for k in range(20) for a in ("news", "home", "city") for b in ("blog", "daily")]
    bad = [(f"http://casinowin{k % 3}.example.com/x/{k}",) for k in range(20)]
    rows = urls.judged(make(good + bad + [("http://wincasino.example.com/",)], "url string")).collect()
    assert all((r.verdict == "block") == ("casino" in r.url) for r in rows)


def test_rare_tokens_and_long_words_keep_their_weight(make):
    long = "pneumonoultramicroscopicsilico"
    names = ["".join(chr(97 + k // 26**j % 26) for j in range(4)) for k in range(26**4 // 9)]
    common = [(f"http://a.example/{a}/{b}/{c}",) for a, b, c in zip(names[::3], names[1::3], names[2::3], strict=False)] * 2
    rows = common + [(f"http://{long}.{k}.example/",) for k in range(3)] + [("http://x.example/",), ("http://x.example/zzyzx",), ("http://keygen.example/zzyzx",)]
    got = {r.url: r for r in urls.judged(make(rows, "url string")).collect()}
    assert got["http://x.example/zzyzx"].block_odds > got["http://x.example/"].block_odds + 0.5
    counts = urls.dictionary(make([(f"{long}.{k}",) for k in range(3)], "host string"))
    words = {r.run: r.words for r in urls.segmented(make([(long + "shop",), ("casinowin",)], "run string"), counts).collect()}
    assert words == {long + "shop": [long, "shop"], "casinowin": ["casino", "win"]}


def test_nearest_examples_are_exact():
    r = np.random.default_rng(1)
    terms, n, k = 80, 300, 7
    dense = (r.random((terms, n)) < 0.05) * r.random((terms, n))
    t, e = np.nonzero(dense)
    w = dense[t, e]
    blocks = -(-n // toxicity.BLOCK)
    cell = t * blocks + e // toxicity.BLOCK
    starts = np.searchsorted(cell, np.arange(terms * blocks + 1))
    maxima = np.zeros(terms * blocks)
    np.maximum.at(maxima, cell, w)
    grid = np.column_stack([starts[:-1].reshape(-1, blocks), starts[blocks::blocks]])
    index = toxicity.Index(np.arange(terms), np.ones(terms), np.arange(n), np.zeros(n), grid, e, w, maxima.reshape(terms, blocks), np.zeros(4))
    for _ in range(100):
        own = np.sort(r.choice(terms, r.integers(1, 9), replace=False))
        weights = r.random(len(own))
        full = weights @ dense[own]
        found, scores = index.nearest(own, weights, k)
        assert np.allclose(scores, np.sort(full)[::-1][:k][np.sort(full)[::-1][:k] > 0]) and np.allclose(full[found], scores)


def labelled_texts(seed, n=400):
    r = random.Random(seed)
    plain = [f"word{k}" for k in range(200)]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.choice([5, 40, 300]))]
        bad = i % 3 == 0
        if bad:
            words[r.randrange(len(words))] = r.choice(["scumbag", "moronic", "trashy"])
            words.append("pathetic")
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad), int(not bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(make):
    docs, labels = labelled_texts(1)
    docs += [(1000, None), (1001, ""), (1001, ""), (None, "pathetic"), (1002, "word1 " * 100_000)]
    df, marks = make([(*d, "x") for d in docs], "doc_id long, text string, Score string"), make(labels, "doc_id long, toxic int, quality int")
    got = toxicity.scored(df, toxicity.fit(df, marks)).withColumn("out", labelled.held_out("doc_id")).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    truth = {i: t for i, t, _ in labels}
    held = [r for r in got if r.out and r.doc_id in truth]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == 0 for r in got if r.doc_id in (1000, 1001, 1002))


def test_toxicity_without_labels(make):
    df = make([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = toxicity.scored(df, toxicity.fit(df, make([], "doc_id long, toxic int"))).collect()
    assert [r.score for r in rows] == [0.5, 0.5]
    assert toxicity.scored(df.filter("doc_id > 9"), toxicity.fit(df, make([(1, None)], "doc_id long, toxic int"))).count() == 0


def test_quality_on_held_out_rows(make, monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 4)
    docs, labels = labelled_texts(4, 240)
    docs = [(i, t.replace(" ", "$$$ ## ") if i % 3 == 0 else t) for i, t in docs] + [(1000, None), (1001, ""), (None, "x")]
    df, marks = make(docs, "doc_id long, text string"), make(labels, "doc_id long, toxic int, quality int")
    got = quality.scored(df, quality.fit(df, marks)).withColumn("out", labelled.held_out("doc_id")).collect()
    truth = {i: q for i, _, q in labels}
    held = [r for r in got if r.out and r.doc_id in truth]
    assert len(got) == len(docs) and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_text_logits_cover_the_whole_text(monkeypatch):
    model = quality._new(3)
    text = np.random.default_rng(0).integers(32, 120, 9000).astype(np.uint8)
    offsets = np.array([0, 0, 100, 9000])
    whole = quality.text_logits(text, offsets, model)
    monkeypatch.setattr(quality, "_BLOCK", 3)
    assert np.allclose(whole, quality.text_logits(text, offsets, model), atol=1e-5)
    rows = quality._half_rows(text[100:])
    pooled = quality._pooled(rows, model)
    assert np.isclose(whole[2], quality._logits(np.maximum(pooled[1:], pooled[:-1]), model).mean(), atol=1e-5)


def test_gradients_equal_differences():
    model = {k: v.astype(np.float64) for k, v in quality._new(5).items()}
    r = np.random.default_rng(2)
    chunks = r.integers(0, 255, (4, 2, quality._HALF + quality.WIDTH - quality.STRIDE)).astype(np.uint8)
    y = np.array([0.0, 1, 1, 0])

    def loss():
        halves = chunks.reshape(8, -1)
        x = quality._windows(halves, model).reshape(-1, quality.WIDTH * quality.EMBED)
        pooled = (x @ model["filters"]).reshape(4, -1, quality.FILTERS).max(axis=1)
        z = quality._logits(pooled, model)
        return np.mean(np.logaddexp(0, z) - y * z)

    grads = quality._gradients(chunks, y, model)
    for name in ("out", "hidden", "bias", "filters", "embed"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        before = model[name][at]
        model[name][at] = before + 1e-5
        up = loss()
        model[name][at] = before - 1e-5
        down = loss()
        model[name][at] = before
        assert np.isclose((up - down) / 2e-5, grads[name][at], rtol=1e-2, atol=1e-6)


def test_license_paragraphs(make):
    docs = [
        (1, "Some text.\nReleased under the MIT License.\nMore text of the driver with a license."),
        (2, "Licensed under the Apache License, Version 2.0. See the LICENSE file."),
        (3, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
        (4, None), (5, ""), (6, "The license plate was missing from the car.\nwords only"), (6, "words only"), (None, "Licensed under CC BY-NC 4.0."),
    ]
    got = licenses.license_paragraphs(make([(*d, "x") for d in docs], "doc_id long, text string, family string")).collect()
    assert sorted((str(r.id), r.place, r.family) for r in got) == [("1", 1, "mit"), ("2", 0, "apache-2.0"), ("3", 0, "gpl"), ("None", 0, "cc-by-nc")]
    assert all(0.5 <= r.probability <= 1 and r.similarity >= licenses.OVERLAP for r in got)
