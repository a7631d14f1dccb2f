"""The trie of conversations against dictionaries, with containers of a few rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pageloom.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, head string"


def _brute(rows, share):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    full = own
    if share:
        full = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            full[c] = own.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own_members in members.items():
        chars = len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(own_members) - 1) * chars
    out = []
    for path, own_members in members.items():
        ends = sorted(c for c in own_members if len(full[c]) == len(path))
        out.append(
            (min(own_members), len(path), min(members[path[:-1]]) if path else None,
             len(own_members), children[path], leaves[path], saved[path],
             hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        )
    return sorted(map(repr, out))


def _conversations(n, seed):
    rng = random.Random(seed)
    texts = ["", "hi", "héllo", "a longer text", "中文"]
    rows = []
    for c in range(-3, n):
        if c % 17 == 5:
            continue
        turns = rng.randrange(1, 9)
        if c % 3 == 0:  # a third are copies
            rows += [(c, t, "user", f"same {t}") for t in range(4)]
        elif c % 11 == 0:  # a long common path
            rows += [(c, t, "user", "again") for t in range(30)] + [(c, 30, "user", f"end {c}")]
        else:
            rows += [(c, t if t else None, rng.choice(["user", None]), rng.choice(texts)) for t in range(turns)]
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(4)


def _got(spark, rows, share, **limits):
    own = trie.turn_sequences(_frame(spark, rows))
    own = trie.with_shared_openings(own) if share else own
    result = trie.prefix_trie(own, **limits)
    return sorted(map(repr, map(tuple, result.collect())))


@pytest.mark.parametrize("limits", [{"container_rows": 3}, {"container_bytes": 200}, {}])
@pytest.mark.parametrize("share", [True, False])
def test_nodes_equal_dictionaries(spark, share, limits):
    rows = _conversations(160, seed=share)
    assert _got(spark, rows, share, **limits) == _brute(rows, share)


def test_prefixes_of_one_another(spark):
    """Every conversation is the beginning of the next one; one row more each."""
    rows = [(c, t, "user", "x" * t) for c in range(1, 13) for t in range(c)]
    assert _got(spark, rows, False, container_rows=4) == _brute(rows, False)


def test_awkward_conversations(spark):
    rows = [
        (None, 1, "user", "no conversation"), (1, None, None, None), (101, 0, "user", "gone"),
        (2, 1, "user", "long " * 20_000), (3, 1, "user", "long " * 20_000), (102, 1, "user:", "x"),
        (103, 1, "user", ":x"), (10**15, 5, "", ""), (4, 2, "b", "same turn"), (4, 2, "b", "same turn"),
    ]
    for limits in ({}, {"container_rows": 1}):
        assert _got(spark, rows, True, **limits) == _brute(rows, True)
    assert _got(spark, [], True) == []


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(c, 1, "user", t) for c, ts in ((1, "ab"), (2, "ba")) for t in ts]
    result = _got(spark, rows, False)
    assert len(result) == 3  # root and one path


def test_long_member_lists(spark, monkeypatch):
    monkeypatch.setattr(trie, "_LISTED", 7)
    rows = [(c, 0, "user", "one") for c in range(300)]
    assert _got(spark, rows, False) == _brute(rows, False)
