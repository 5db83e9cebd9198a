"""Whitening against a dense solver, vector codes against plain k-means."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import vector_codes, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x array<int>, codes string, component int, n long, error long, id string"
SF_DIR = "/root/testdata/sf0.01"


def table(spark, vectors, labels=None, ids=None):
    ids, labels = ids or list(range(len(vectors))), labels or [0] * len(vectors)
    return spark.createDataFrame([(i, v, l, [1], "c", 9, 8, 7, "i") for i, v, l in zip(ids, vectors, labels)], SCHEMA)


def some_vectors(n, size, seed=3):
    rng = np.random.default_rng(seed)
    return np.round(rng.standard_normal((n, size)) * rng.uniform(0.1, 1, size), 3).astype(np.float32).tolist()


ODD = [None, [], [1.0, None], [float("nan")] * 8, [float("inf")] * 8, [None] * 8]


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (id, label, vector) in any order."""
    kept = [(i, l, [math.floor(4096 * float(np.float32(c))) for c in v]) for i, l, v in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(kept[0][2]) // parts
    cut = [[r[2][p * size : (p + 1) * size] for r in kept] for p in range(parts)]
    books = [[list(c) for c in cut[p][:entries]] for p in range(parts)]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(p):
        return [min(range(len(books[p])), key=lambda j: (apart(c, books[p][j]), j)) for c in cut[p]]

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for c, j in zip(cut[p], nearest(p)):
                members[j].append(c)
            for j, own in members.items():
                books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    codes = [nearest(p) for p in range(parts)]
    errors = [sum(apart(cut[p][k], books[p][codes[p][k]]) for p in range(parts)) for k in range(len(kept))]
    by_label = Counter()
    for (_, label, _), e in zip(kept, errors):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, "".join(f"{codes[p][k]:02x}" for p in range(parts)), errors[k], by_label[l], digest) for k, (i, l, _) in enumerate(kept))


@pytest.mark.parametrize("n", [5, 16, 300])
def test_codes_equal_plain(spark, n):
    vectors = some_vectors(n, 16)
    vectors += vectors[:3] + [vectors[0]]
    ids = [None if i == 4 else 7 if i in (1, 2) else 10 * n - i for i in range(len(vectors))]
    labels = [None if i % 3 == 0 else i % 2 for i in range(len(vectors))]
    docs = table(spark, vectors, labels, ids).unionByName(table(spark, ODD))
    got = vector_codes.report(docs).collect()
    assert Counter(map(tuple, got)) == plain_codes(list(zip(ids, labels, vectors)))


def test_codes_of_no_and_of_equal_vectors(spark):
    assert vector_codes.report(table(spark, ODD[:1])).collect() == []
    rows = vector_codes.report(table(spark, [[0.5] * 8] * 40)).collect()
    assert {r["code"] for r in rows} == {"00" * 8} and {r["error"] for r in rows} == {0} and len(rows) == 40
    assert vector_codes.report(table(spark, [[]] * 3)).collect() == []


def test_wrong_lengths(spark):
    for vectors in ([[0.5] * 8, [0.5] * 16], [[0.5] * 9]):
        with pytest.raises(ValueError):
            vector_codes.report(table(spark, vectors))


def test_bounds_save_scans_and_net_displacement_saves_more():
    part = vector_codes.cut(np.floor(np.array(some_vectors(4000, 8)) * 4096).astype(np.int64), 1)[0]
    history, scans, drift_scans = part[None, :16], [], []
    bounds = vector_codes.Bounds.first(part, history[0])
    for _ in range(8):
        book = history[-1].copy()
        for j in range(16):
            if (own := part[bounds.code == j]).size:
                book[j] = own.sum(axis=0) // len(own)
        history = np.concatenate([history, book[None]])
        steps = np.sqrt(((history[1:] - history[:-1]) ** 2).sum(axis=2).astype(float))
        drift = np.vstack([steps[s:].sum(axis=0) for s in range(len(history))])
        others = np.stack([np.delete(drift, j, axis=1).max(axis=1) for j in range(16)], axis=1)
        drift_scans.append(len(bounds.undecided(drift, others)))
        net = len(bounds.undecided(*vector_codes.moved(history)))
        assert net <= drift_scans[-1]
        scans.append(bounds.update(part, history))
        code, own, _ = vector_codes.scan(part, book)
        assert (bounds.code == code).all() and (vector_codes.to_own(part, book, bounds.code) == own).all()
    assert sum(scans) < 0.7 * 8 * len(part) and sum(scans) < sum(drift_scans)


def dense(vectors, wanted=4):
    x = np.unique(np.floor(256 * np.array(vectors, np.float32).astype(float)), axis=0)
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    order = np.argsort(values)[::-1][:wanted]
    return x.astype(int), values[order], axes[:, order], values.sum()


def check_whitened(rows, ids, vectors, wanted=4):
    fit, values, axes, trace = dense(vectors, wanted)
    n, sums = len(fit), fit.sum(axis=0)
    got = defaultdict(dict)
    for r in rows:
        got[r["vec_id"]][r["component"]] = r
    assert len(rows) == len(ids) * len(values) and len(got) == len(set(ids))
    all_x = np.floor(256 * np.array(vectors, np.float32).astype(float)).astype(int)
    expected = (all_x - sums / n) @ axes / np.sqrt(values)
    signs = [0] * len(values)
    for i, x, w in zip(ids, all_x, expected):
        for k in range(len(values)):
            r = got[i][k + 1]
            assert (r["n"], r["deviation"]) == (n, sum((n * int(v) - int(s)) ** 2 for v, s in zip(x, sums)))
            assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-9) and r["identity_error"] <= 1e-10
            assert abs(r["whitened"]) == pytest.approx(abs(w[k]), abs=1e-7)
            if abs(w[k]) > 1e-3:
                sign = math.copysign(1, r["whitened"] * w[k])
                assert signs[k] in (0, sign)
                signs[k] = sign


@pytest.mark.parametrize("n, size", [(400, 24), (60, 3), (12, 5)])
def test_whitening_equals_dense(spark, n, size):
    vectors = some_vectors(n, size)
    vectors += vectors[: n // 3]
    docs = table(spark, vectors).unionByName(table(spark, ODD, ids=list(range(9000, 9006))))
    check_whitened(whitening.whiten(docs).collect(), list(range(len(vectors))), vectors, min(4, size))


def test_whitening_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect() if r["embedding"] is not None]
    check_whitened(whitening.whiten(docs).collect(), [i for i, _ in rows], [v for _, v in rows])


def test_components_without_variance_have_no_rows(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [[0.5, 0.25]] * 6)).collect() == []
    flat = [[i / 4, i / 2, 0.0, 1.0] for i in range(9)]
    rows = whitening.whiten(table(spark, flat)).collect()
    assert len(rows) == 9 and {r["component"] for r in rows} == {1} and rows[0]["explained"] == pytest.approx(1)
    assert whitening.whiten(table(spark, [[], []])).collect() == []


def test_deviation_is_exact_or_null(spark):
    rows = whitening.whiten(table(spark, [[1e13, 1.0], [-1e13, 2.0], [3e7, 3.0]])).where("component = 1").orderBy("vec_id").collect()
    x = [[int(256 * np.float32(1e13)), 256], [int(256 * np.float32(-1e13)), 512], [int(256 * 3e7), 768]]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * v - s) ** 2 for v, s in zip(r, sums)) for r in x]
    assert [r["deviation"] for r in rows] == [d if d < 1 << 63 else None for d in exact] and None in [r["deviation"] for r in rows]


def test_solver_on_close_and_equal_values():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    for spectrum in (np.r_[5, 5, 5 - 1e-6, 4.999, np.linspace(4, 0, 56)], np.r_[3, 1, np.zeros(58)], np.ones(60), np.zeros(60)):
        matrix = turn @ np.diag(spectrum) @ turn.T
        values, axes = whitening.leading_pairs(lambda w: matrix @ w, 60, 4)
        assert values == pytest.approx(spectrum[:4], abs=1e-12)
        assert np.abs(axes.T @ axes - np.eye(4)).max() < 1e-12
        assert np.linalg.norm(matrix @ axes - axes * values) < 1e-11
