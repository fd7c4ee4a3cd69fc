"""Substring dedup, decontamination and the Jaccard join against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from agorascope.llm import components, decontaminate, jaccard, substrings
from agorascope.llm import words as W

SPACE = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, kept_text string, N_words int, source string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(seed=3, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["é", "\u00a0x", "Of", "THE"]
    passage = [r.choice(vocabulary) for _ in range(45)]
    rows = []
    for d in range(n):
        words = [r.choice(vocabulary) for _ in range(r.choice([0, 3, 12, 40, 150]))]
        if d % 3 == 0:
            at = r.randrange(len(words) + 1)
            cut = r.randrange(0, 20)
            words[at:at] = passage[cut : cut + r.choice([19, 20, 25])]
        if d % 7 == 0 and rows:
            words = re.findall(SPACE, rows[r.randrange(len(rows))][1] or "")
            if words and d % 2:
                words[r.randrange(len(words))] = "changed"
        rows.append((d * 37 - 500, r.choice([" ", "\n", "\t "]).join(words), None, 7, "s"))
    rows.append((2_000, "again " * 90, "old", 1, None))
    rows.append((2_001, "SE a b c d " * 9, None, None, None))
    rows.append((2_002, None, None, None, None))
    rows.append((2_003, " \n\t", None, None, None))
    rows.append((2_004, rows[0][1], None, None, None))
    rows.append((2_004, rows[0][1], None, None, None))
    rows.append((None, "again " * 30, None, None, None))
    rows.append((3_000, "long " + " ".join(f"x{k % 997}" for k in range(30_000)), None, None, None))
    return rows


def kept_words(rows, window=20):
    key = lambda i: (1, 0) if i is None else (0, i)
    texts = [(key(r[0]), re.findall(SPACE, r[1] or "")) for r in rows]
    first = {}
    for d, w in sorted(texts):
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d, i):
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_words_of_arrow_texts():
    texts = ["a b", None, "", "\ta\x0bb ", "c", "d e\u00a0f", "x" * 3000, "q"]
    column = pa.array(texts)
    for start in (0, 2, 7):
        words = W.split(*W.text_buffers(column.slice(start)))
        got = [
            [words.data[s:e].tobytes().decode() for s, e in zip(words.starts[a:b], words.ends[a:b], strict=True)]
            for a, b in zip(words.first[:-1], words.first[1:], strict=True)
        ]
        assert got == [re.findall(SPACE, t or "") for t in texts[start:]]
        assert all(int(h) == W.hash_word(words.data[s:e].tobytes()) for h, s, e in zip(words.hashes, words.starts, words.ends, strict=True))


def test_long_text_is_hashed_in_blocks():
    text = ("word" * 5 + " ") * (W.BLOCK // 10)
    words = W.split(*W.text_buffers(pa.array([text])))
    assert len(words.hashes) == W.BLOCK // 10 and len(np.unique(words.hashes)) == 1


def test_repeated_words_equal_brute_force(make):
    rows = corpus()
    got = substrings.repeated_words(make(rows, DOCS)).collect()
    want = sorted(zip([r[0] if r[0] is not None else 10**9 for r in rows], kept_words(rows), strict=True))
    found = sorted((r.doc_id if r.doc_id is not None else 10**9, (r.n_words, r.n_removed, r.kept_text)) for r in got)
    assert found == want
    assert {r.source for r in got} == {"s", None}


def test_repeated_words_of_an_empty_table(make):
    out = substrings.repeated_words(make([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "text", "kept_text", "n_words", "n_removed"] and out.count() == 0


def hits(text, items, window=10):
    words = re.findall(ALNUM, lower(text))
    covered, found = set(), set()
    for item, item_text in items:
        own = re.findall(ALNUM, lower(item_text))
        m = min(len(own), window)
        strings = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in strings:
                covered.update(range(i, i + m))
                found.add(item)
    return len(words), len(covered), sorted(found, key=lambda i: (i is None, i))


@pytest.mark.parametrize("block", [None, 200])
def test_benchmark_hits_equal_brute_force(make, monkeypatch, block):
    if block:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    r = random.Random(5)
    vocabulary = [f"t{k}" for k in range(30)] + ["É", "été", "Ab"]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 5, 10, 30])))) for k in range(8)]
    items += [(100, None), (101, "--"), (7, items[0][1]), (None, "t1 t2"), (None, items[4][1])]
    texts = []
    for d in range(40):
        words = [r.choice(vocabulary).upper() for _ in range(r.choice([0, 4, 60, 200]))]
        if d % 4 == 0:
            words[2:2] = re.findall(ALNUM, items[d % 8][1])
        texts.append((d, ("-" if d % 2 else " , ").join(words)))
    texts += [(None, items[3][1]), (90, None), (90, items[3][1]), (91, "")]
    docs = make([(i, t, 5) for i, t in texts], "doc_id long, text string, ITEMS int")
    found = decontaminate.benchmark_hits(docs, make(items, "item_id long, text string")).collect()
    want = sorted((str(i), *hits(t, items)) for i, t in texts)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in found) == want


def test_benchmark_hits_of_empty_tables(make):
    items, docs = "item_id long, text string", "doc_id long, text string"
    assert decontaminate.benchmark_hits(make([], docs), make([(1, "a")], items)).count() == 0
    row = decontaminate.benchmark_hits(make([(1, "a")], docs), make([], items)).first()
    assert (row.n_words, row.n_hit, row["items"]) == (1, 0, [])


def shingles(text):
    words = re.findall(SPACE, lower(text))
    m = min(5, len(words))
    return {tuple(words[i : i + m]) for i in range(len(words) - m + 1)} if m else set()


def classes(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def near_copies(seed=11):
    r = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(300)]
    passage = [r.choice(vocabulary) for _ in range(30)]
    rows, number = [], 0
    for group in range(14):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 9, 60, 200]))] + (passage if group % 2 else [])
        for _ in range(r.choice([1, 2, 6])):
            words = list(base)
            for _ in range(r.choice([0, 1, 2, 4])):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append((number * 13 % 101, " ".join(words).upper() if number % 2 else " ".join(words)))
            number += 1
    return rows + [(500, None), (501, ""), (502, "one two"), (503, "ONE  two"), (504, "one two three"), (505, rows[0][1]), (505, rows[0][1])]


@pytest.mark.parametrize("limit", [4, 0])
def test_near_duplicates_equal_brute_force(make, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "PAIRS_PER_SET", limit)
    rows = near_copies()
    got = jaccard.near_duplicates(make([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, token int, node string")).collect()
    want = classes(rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, len(shingles(t)), want[i]) for i, t in rows)


def test_near_duplicates_without_ids_or_rows(make):
    assert jaccard.near_duplicates(make([], "doc_id long, text string")).count() == 0
    rows = [(None, "a b c d e f g"), (4, "a b c d e f g"), (None, "other words than those above here")]
    got = sorted((r.n_shingles, str(r.component_id)) for r in jaccard.near_duplicates(make(rows, "doc_id long, text string")).collect())
    assert got == [(2, "None"), (3, "4"), (3, "4")]


def test_different_texts_of_one_id_or_none_stay_sets(make):
    r = random.Random(4)
    texts = [" ".join(f"x{r.randrange(500)}" for _ in range(80)) for _ in range(12)]
    near = [" ".join([*t.split()[:-1], "changed"]) for t in texts]
    rows = [(None, t) for t in texts] + [(100 + k, t) for k, t in enumerate(near)]
    rows += [(7, texts[0]), (7, "some words of another text that is linked with nothing"), (7, None), (300, texts[1]), (300, texts[2])]
    got = jaccard.near_duplicates(make(rows, "doc_id long, text string").repartition(3)).collect()
    want = {0: 7, 1: 101, 2: 101} | {k: 100 + k for k in range(3, 12)}
    expected = [(None, want[k]) for k in range(12)] + [(100 + k, want[k]) for k in range(12)] + [(7, 7)] * 3 + [(300, 101)] * 2
    assert sorted(map(str, ((r.doc_id, r.component_id) for r in got))) == sorted(map(str, expected))


def test_components_of_paths_and_stars(make):
    edges = [(i, i + 1) for i in range(100, 130)] + [(7, k) for k in range(8, 40)] + [(50, 50), (61, 60)]
    got = {r.node: r.component for r in components.components(make(edges, "a long, b long")).collect()}
    want = {k: 100 for k in range(100, 131)} | {k: 7 for k in range(7, 40)} | {60: 60, 61: 60}
    assert got == want

