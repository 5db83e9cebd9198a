"""Exact dedup and source mixing on odd rows, against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

from conftest_rows import all_rows
from riskloom.llm import exact_dedup, mixing


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i if i is not None else 1 << 62, i))
    out = Counter()
    for text, members in groups.items():
        keep = min(members)[2]
        for _, _, i in members:
            out[i, keep, len(members), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def test_exact_groups(spark, odd_docs):
    for capacity in (exact_dedup.CAPACITY, 1):
        got = exact_dedup.exact_groups(odd_docs, capacity=capacity).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == plain_groups(all_rows(odd_docs))


def test_keep_one_row_of_each(spark, odd_docs, no_docs):
    kept = exact_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(i for i, _ in all_rows(kept)) == sorted(k[1] for k in plain_groups(all_rows(odd_docs)) if k[3])
    assert exact_dedup.keep_one(no_docs).count() == 0 == exact_dedup.exact_groups(no_docs).count()


def test_directory_doubles_and_covers_all_slots():
    counts = {p: 1 for p in range(16)} | {0: 40}
    slots = exact_dedup.directory(counts, capacity=8, depth=4)
    assert len(slots) == 16 and slots[0] == (0, 4) and slots[15] == slots[8] == (1, 1)
    held = Counter()
    for p, n in counts.items():
        held[slots[p]] += n
    assert all(n <= 8 or depth == 4 for (_, depth), n in held.items())
    assert exact_dedup.directory({}, 8, 4) == [(0, 0)]


def plain_targets(sizes, weights, share):
    total, left, out = share * sum(sizes), list(range(len(sizes))), {}
    while True:
        unit = (total - sum(2 * sizes[i] for i in out)) / sum(weights[i] for i in left) if left else 0
        over = [i for i in left if unit * weights[i] >= 2 * sizes[i]]
        if not over:
            return [2 * sizes[i] if i in out else unit * weights[i] for i in range(len(sizes))]
        for i in over:
            out[i] = True
            left.remove(i)


def test_mix(spark, odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) <= 1.5 * sum(r["size"] for r in rows)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(odd_docs).collect()), key=repr)
    by_source = defaultdict(int)
    for r in odd_docs.select("source", "text").collect():
        by_source[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    names = sorted(s for s in by_source if s is not None) + [None]
    want = plain_targets([by_source[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5)
    assert {(r["source_size"], round(r["target"], 6)) for r in rows} == {(by_source[s], round(t, 6)) for s, t in zip(names, want)}
    assert mixing.mix(no_docs).count() == 0


def test_mix_comes_near_the_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), f"s{min(i % 9, 4)}") for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg({"taken": "sum", "target": "first"}).collect()
    assert all(abs(r["sum(taken)"] - r["first(target)"]) <= 7 for r in rows)


def test_the_index_decides(spark):
    docs = spark.createDataFrame([(i, f"text {i % 700 if i % 3 else 0}" + " " * (i % 5)) for i in range(3000)], "doc_id long, text string")
    index, slots = exact_dedup.build_index(docs, exact_dedup.entries(docs), capacity=20)
    buckets, files = len(set(slots)), {f for f in index.inputFiles() if f.endswith(".parquet")}
    assert 30 < buckets <= len(slots) and len(files) == buckets
    assert index.agg({"group_size": "sum"}).collect()[0][0] == 3000
    assert all(0 < n <= 20 for n in Counter(r["bucket"] for r in index.collect()).values())
    got = exact_dedup.exact_groups(docs, capacity=20).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == plain_groups(all_rows(docs))


def test_colliding_hashes_are_chained_and_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: exact_dedup.F.lit(7).cast("long"))
    docs = spark.createDataFrame([(i, f"text {i % 4}") for i in range(40)], "doc_id long, text string")
    index, _ = exact_dedup.build_index(docs, exact_dedup.entries(docs))
    assert sorted(r["place"] for r in index.collect()) == [1, 2, 3, 4]
    got = exact_dedup.exact_groups(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == plain_groups(all_rows(docs))
