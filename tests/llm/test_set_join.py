"""The n-gram Jaccard join against all pairs, and its pigeonholes one by one."""

import random
import re

import numpy as np
import pytest

from riskloom.llm import set_join

SEPARATE = r"[^\x20\x09-\x0D]+"


def shingle_set(text, k=3):
    w = re.findall(SEPARATE, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def plain_groups(rows, k=3, percent=90):
    """Sorted (id, set size, smallest id reachable); rows of one id are one document."""
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b:
                both = len(a & b)
                if rows[i][0] == rows[j][0] or 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted([(d, len(s), least[find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=repr)


def joined(docs, **how):
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in set_join.similar_groups(docs, **how).collect()], key=repr)


def edited(words, changes, rng):
    words = list(words)
    for _ in range(changes):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [rng.choice("abcdefgh") * 3 + str(rng.randrange(50))] * rng.randrange(2)
    return " ".join(words)


def families(rng, count, copies, size, most_changes):
    out = []
    for _ in range(count):
        base = [str(rng.randrange(400)) for _ in range(rng.randrange(*size))]
        out += [edited(base, rng.randrange(most_changes), rng) for _ in range(rng.randrange(1, copies))]
    return out


@pytest.mark.parametrize("moved", [set_join.MOVED, 0])
def test_equals_all_pairs(spark, moved):
    rng = random.Random(11)
    texts = families(rng, 60, 7, (1, 16), 2) + families(rng, 40, 8, (10, 60), 3) + families(rng, 10, 8, (200, 500), 20) + families(rng, 2, 4, (3000, 4000), 120)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = joined(docs, moved=moved)
    assert got == plain_groups(rows)
    assert sum(d != c for d, _, c in got) > 80


def test_many_unlike_members_of_one_key_and_chains(spark):
    """Copies of one text with so many changes that most do not link, and chains of small steps."""
    rng = random.Random(4)
    base = [str(i) for i in range(150)]
    texts = [edited(base, 3, rng) for _ in range(700)]
    chain = list(base)
    for i in range(60):
        chain[(7 * i) % 150] = f"new{i}"
        texts.append(" ".join(chain))
    rows = list(enumerate(texts))
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == plain_groups(rows)


def test_hot_keys_of_short_texts(spark, monkeypatch):
    """Small rounds, blocks and hot keys change the plan, not the rows."""
    for name, value in (("HUBS", 2), ("BLOCK", 8), ("HOT", 5)):
        monkeypatch.setattr(set_join, name, value)
    rng = random.Random(9)
    rows = [(f"d{i:04}", " ".join(rng.choice("abc") for _ in range(rng.randrange(10, 40)))) for i in range(300)]
    assert joined(spark.createDataFrame(rows, "doc_id string, text string")) == plain_groups(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert joined(no_docs) == []
    clashing = odd_docs.withColumnsRenamed({"tag": "name", "hash": "key", "doc": "parity", "spans": "first", "id": "comp", "score": "of"})
    assert joined(clashing) == plain_groups(rows)
    alike = [(5, "a b c d e f"), (5, "u v w x y z"), (3, "u v w x y z"), (9, "a b c d e f"), (None, "u v w x y z"), (7, "")]
    assert joined(spark.createDataFrame(alike, "doc_id long, text string")) == plain_groups(alike)


@pytest.mark.parametrize("percent", [50, 80, 90, 97, 100])
def test_bands_hold_all_partners(percent):
    bands = set_join.Bands(percent, 3000)
    own, low = (bands.of(np.arange(3001), lower) for lower in (False, True))
    for s in range(1, 3001, 7):
        for t in range(max(1, -(-percent * s // 100)), s + 1):
            if (apart := bands.allowed(s, t)) >= (1 if s == t else s - t) and apart:
                band, parts, need = own if own[0][t] == own[0][s] else low
                assert band[s] == own[0][t] and need[s] > apart and parts[s] >= need[s] > 0 and parts[s] == own[1][t]


def test_allocation_keeps_the_pigeonhole():
    rng = np.random.default_rng(2)
    raises = 0
    for _ in range(300):
        n = int(rng.integers(1, 40))
        cost, size, need = rng.choice([0, 0, 1, 5, 300], n), rng.integers(0, 12, n), int(rng.integers(1, n + 1))
        probed, raised = set_join.allocate(cost, size, need)
        assert len(probed) + len(raised) == need and set(raised) <= set(probed) and len(set(probed)) == len(probed)
        plain = np.sort(cost)[:need].sum()
        assert cost[probed].sum() + (set_join.MOVED * (size[raised] + 1)).sum() <= plain
        raises += len(raised)
    assert raises > 50


def test_parities_never_differ_in_more_bits_than_sets():
    rng = np.random.default_rng(8)
    for size in (9, 40, 700):
        a = np.sort(rng.integers(0, 1 << 62, size).astype(np.uint64))
        b = np.sort(np.concatenate([a[3:], rng.integers(0, 1 << 62, 2).astype(np.uint64)]))
        rows = [set_join.parity(np.zeros(len(x), np.int64), x, np.array([p])) for x, p in ((a, 7), (b, 20))]
        width = min(len(r[0]) for r in rows)
        bits = [set_join.folded(r, width) for r in rows]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= 5
