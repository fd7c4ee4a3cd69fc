"""Ranked search against plain scoring of every document."""

import math
import random
import re

import pytest

from agorascope.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, split(t)) for i, t, *_ in docs if split(t)]
    n_docs, length = len(bags), sum(len(w) for _, w in bags)
    out = []
    for item_id, text, *_ in items:
        scores = []
        wanted = sorted(set(split(text)))
        df = {t: sum(t in w for _, w in bags) for t in wanted}
        for doc_id, w in bags:
            m = 50 + (50 * len(w) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 20 * m)) for t in wanted)
            if score > 0:
                scores.append((-score, doc_id is None, 0 if doc_id is None else doc_id, doc_id))
        out += [(item_id, r + 1, doc_id, -s) for r, (s, _, _, doc_id) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def texts(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "of", "été", "Straße", "x1", "Ä", "ä", "don't", "\x00cut", "日本 語"] + [f"w{i}" for i in range(40)]
    return [" ".join(r.choices(words, k=r.choice([0, 1, 2, 5, 30]))) for _ in range(n)]


@pytest.mark.parametrize("k", [3, 50, 10_000])
def test_ranks_equal_brute_force(make, monkeypatch, k):
    monkeypatch.setattr(ranking, "PIECE", 16)
    monkeypatch.setattr(ranking, "BAGS", 200)
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", 5)
    docs = [(i, t, i) for i, t in enumerate(texts(1, 300))]
    docs += [(1000 - i, "The same words of w1, w1", 0) for i in range(200)] + [(None, t, 0) for t in texts(2, 60)]
    docs += [(7, "w2 w3", 0)] * 5 + [(5000, None, 0), (5001, "", 0), (5002, "...", 0)]
    items = [(i, t, i) for i, t in enumerate(texts(3, 12))] + [(3, "w1 the", 1), (None, "W2 été", 1), (90, None, 1), (91, "unknown", 1), (92, "?", 1)]
    random.Random(2).shuffle(docs)
    got = ranking.ranked(make(docs, "doc_id long, text string, score long").repartition(4), make(items, "item_id long, text string, rank long"), k=k)
    assert sorted(((r.item_id, r["rank"], r.id, r.score) for r in got.collect()), key=str) == brute(docs, items, k)


def test_long_text_and_text_ids(make):
    docs = [("a", "Word other " * 300_000), ("b", "word"), (None, "word")]
    got = ranking.ranked(make(docs, "doc_id string, text string"), make([(1, "word")], "item_id int, text string"))
    assert sorted(((r.item_id, r["rank"], r.id, r.score) for r in got.collect()), key=str) == brute(docs, [(1, "word")], 50)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "b")], [(1, "a")])])
def test_nothing_to_rank(make, docs, items):
    got = ranking.ranked(make(docs, "doc_id long, text string"), make(items, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "id", "score"] and got.collect() == []
