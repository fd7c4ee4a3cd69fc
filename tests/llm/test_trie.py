"""The prefix trie against plain dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from agorascope.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, node string"


def brute(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[q] for q in below)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in members[p] if len(paths[c]) == len(p)))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p], digest(p))
        for p, m in members.items()
    )


def found(df, **options):
    return sorted(tuple(-1 if v is None else v for v in r) for r in trie.prefix_trie(df, **options).collect())


def talk(seed, n):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-60, 4 * n), n):
        for t in range(r.choice([0, 1, 2, 3, 3, 5, 9])):
            rows.append((c, t if r.random() > 0.05 else None, r.choice(["user", "assistant", None]), r.choice(["a", "b c", "", None, "d  e\tf"]), "x"))
    rows += [(10_000 + i, t, "user", "the same words", "x") for i in range(150) for t in range(4)]
    rows += [(20_000 + i, 0, "user", f"own {i}", "x") for i in range(40)] + [(None, i, "user", "lost", "x") for i in range(90)]
    return rows + rows[:30]


@pytest.mark.parametrize("shard_turns", [10, 60, 10**6])
def test_trie_equals_brute_force(make, monkeypatch, shard_turns):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = talk(shard_turns, 250)
    random.Random(3).shuffle(rows)
    assert found(make(rows, SCHEMA).repartition(3), shard_turns=shard_turns) == brute(rows)


def test_bounded_number_of_shards(make):
    rows = talk(5, 120)
    assert found(make(rows, SCHEMA), shard_turns=5, max_shards=3) == brute(rows)


def test_skeleton_splits_a_shared_path_by_id():
    path = (b"a", b"b")
    cuts = [((b"a",), float("-inf")), (path, 5), (path, 9), ((b"a", b"c"), float("-inf"))]
    skeleton = trie.Skeleton(cuts)
    assert [r[:4] for r in skeleton.rows()] == [(0, None, 0, 1), (1, 0, 1, 1), (2, 1, 2, 0)]


def test_long_text_long_conversation_and_turnless(make):
    rows = [(40, 0, "user", "w " * 200_000, None)] + [(41, t, "user", f"turn {t}", None) for t in range(3000)]
    # A conversation of one turn may lose it to the opening of a group that has none.
    rows += [(60 + i, 0, "user", "only", None) for i in range(1, 20)]
    assert found(make(rows, SCHEMA), shard_turns=500) == brute(rows)


def test_no_rows(make):
    assert found(make([], SCHEMA)) == [] and found(make([(None, 1, "user", "t", "x")], SCHEMA)) == []
