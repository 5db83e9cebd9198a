"""Substring dedup, secrets, licenses, decontamination and near-duplicates on odd rows, against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest_rows import all_rows
from riskloom.llm import decontamination, licences, minhash, secrets, substrings, words
from riskloom.llm.components import components

SOLID, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text):
    return (text or "").translate(LOWER)


def copied_texts(seed, n=60):
    """Random words with passages of other texts in them."""
    rng = random.Random(seed)
    vocabulary = [rng.choice("abcdeé") * rng.randint(1, 3) + rng.choice("xyzß") for _ in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 40))] for _ in range(5)]
    out = []
    for i in range(n):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(passages)
        out.append((i, rng.choice([" ", "\n", " \t"]).join(own)))
    return out + [(n, out[0][1]), (n + 1, "w " * 50), (n + 2, "w " * 40), (n + 3, ("w " * 20).strip())]


# Words


@pytest.mark.parametrize("kind, pattern, lower", [(words.SOLID, SOLID, False), (words.ALNUM, ALNUM, True)])
def test_words(kind, pattern, lower, monkeypatch):
    monkeypatch.setattr(words, "PIECE_BYTES", 64)
    texts = ["A b", None, "", "é\x00ß\x0b\x0cz", " lead", "trail ", "x" * 300, "a", "b", "N0w-it's 9"]
    want = [pattern.findall(lowered(t) if lower else t or "") for t in texts]
    got, hashes = [], {}
    for piece in words.pieces(pa.array(texts), kind, lower):
        for a, b in zip(piece.first[:-1], piece.first[1:]):
            got.append([piece.text(i, i + 1).decode() for i in range(a, b)])
            for w, h in zip(got[-1], piece.hash[a:b].tolist()):
                assert hashes.setdefault(w, h) == h
    assert got == want and len(set(hashes.values())) == len(hashes)


# Substring dedup


def plain_dedup(rows, window):
    first = {}
    split = [(i, SOLID.findall(t or "")) for i, t in rows]
    for i, own in split:
        for j in range(len(own) - window + 1) if i is not None else ():
            key = tuple(own[j : j + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, own in split:
        gone = {k for j in range(len(own) - window + 1) if i is not None and first[tuple(own[j : j + window])] < i for k in range(j, j + window)}
        out.append((i, len(own), len(gone), hashlib.sha256(" ".join(w for k, w in enumerate(own) if k not in gone).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot", [64, 1])
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_DOCUMENTS", hot)
    rows = copied_texts(1)
    got = substrings.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, got)) == plain_dedup(rows, 13)
    assert sum(r["n_removed"] for r in got) > 500


def test_substring_dedup_odd(odd_docs, no_docs):
    got = Counter(map(tuple, substrings.dedup_report(odd_docs).collect()))
    assert got == plain_dedup(all_rows(odd_docs), 13)
    assert substrings.dedup_report(no_docs).count() == 0


def test_automaton_owners():
    rng = random.Random(3)
    texts = {i: [rng.choice("ab") for _ in range(rng.randint(3, 12))] for i in range(12)}
    automaton = substrings.SuffixAutomaton()
    for i in sorted(texts, reverse=True):
        automaton.add(texts[i], i)
    for own in texts.values():
        want = [min(i for i, t in texts.items() if any(t[k : k + 3] == own[j : j + 3] for k in range(len(t) - 2))) for j in range(len(own) - 2)]
        assert automaton.owners(own, 3) == want
    assert automaton.owners(list("cab"), 3) == [None]


# Secrets

HEX = "0123456789abcdef" * 2


def test_base_spans():
    found = lambda t: [(secrets.KINDS[k], t[s:e]) for s, k, e in secrets.base_spans(t)]
    assert found('PassWord = "abcdefghijkl" x') == [("assign", 'PassWord = "abcdefghijkl')]
    assert found("token=short token: abcdefghijk/=") == [("assign", "token: abcdefghijk/=")]
    assert found("token=a.secret: abcdefghijklmnop") == []  # the first match takes the keyword of the second
    assert found("apikey='" + HEX + "'") == [("assign", "apikey='" + HEX), ("hex", HEX)]
    assert found("é AKIA" + "Z" * 14 + " AKIA" + "Z" * 13) == [("access", "AKIA" + "Z" * 14)]
    assert found("paſsword=abcdefghijkl") == [] == found("")


def test_random_runs_and_what_is_left_out():
    tokens = secrets.tokenizer()
    found = lambda t: [t[s:e] for s, _, e in secrets.random_spans(t, secrets.base_spans(t), tokens)]
    assert found("key is Zx9Qv3LkT8bWn2RyUj5P, ok") == ["Zx9Qv3LkT8bWn2RyUj5P"]
    for text in (
        "the_quick_brown_fox_2024", "see mail7.example.com now", "3f2504e0-4f89-11d3-9a0c-0305e82c3301", "A" * 20, "1234567890123456789012",
        HEX.upper(), "src/main/java/org/thing4/Name.java", "InternationalizationSupport2", "secret=Zx9Qv3LkT8bWn2RyUj5P",
    ):
        assert found(text) == []
    assert tokens("ab1" * 5000) > 0


def test_random_runs_like_paths_and_names():
    tokens, rng = secrets.tokenizer(), random.Random(5)
    found = lambda t: [t[s:e] for s, _, e in secrets.random_spans(t, secrets.base_spans(t), tokens)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    mixed = ["".join(rng.choice(letters + letters.upper()) for _ in range(24)) for _ in range(50)]
    for run in ["wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "xqzvkwjbfhgmtpqzxwvk42", *mixed]:
        assert found(f"see {run} here") == [run]
    for text in ("src/main/java/org/thing4/ServletRequest", "internationalization", "my-long-name-of-words", "Geschwindigkeitsbegrenzung"):
        assert found(text) == []


def test_random_strings_joined_to_words():
    tokens = secrets.tokenizer()
    found = lambda t: [t[s:e] for s, _, e in secrets.random_spans(t, secrets.base_spans(t), tokens)]
    key = "Zx9Qv3LkT8bWn2RyUj5P"
    assert found(f"my.service.production.database.connection.{key}") == found(f"{key}-production-database-connection-string") == [key]
    assert found("production-database-Zx9Qv3Lk-T8bWn2RyUj5P-connection-string") == ["Zx9Qv3Lk-T8bWn2RyUj5P"]
    other = key[::-1]
    assert found(f"{key}-production-database-connection-string-for-the-service-{other}") == [key, other]
    digest, uuid = hashlib.md5(b"x").hexdigest().upper(), "3f2504e0-4f89-11d3-9a0c-0305e82c3301"
    for text in (f"report-{uuid}-final", f"the-story-of-a-name-{digest}", "example.com/2024/05/01/the-story-of-a-long-name", "github.com/some-org/some-project/blob/main/file_name_v2.py"):
        assert found(text) == []
    assert found(f"{digest}-{uuid}-" * 3 + key) == [key]


def test_very_long_runs_of_parts():
    tokens = secrets.tokenizer()
    run = "-".join(["production", hashlib.md5(b"x").hexdigest().upper(), "name"] * 20_000)
    assert secrets.random_spans(run, [], tokens) == []


def test_secret_scan(spark, odd_docs, no_docs):
    rows = [(1, "token=abcdefghijkl and Zx9Qv3LkT8bWn2RyUj5P"), (2, None), (3, "é" + HEX)]
    got = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["spans"] == "assign:0:18,random:23:43" and got[1]["base_sha256"] == hashlib.sha256(b"assign:0:18").hexdigest()
    assert (got[2]["n_hex"], got[2]["spans"], got[2]["base_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())
    assert got[3]["spans"] == "hex:1:33"
    assert secrets.scan(odd_docs).count() == odd_docs.count() and secrets.scan(no_docs).count() == 0


# Licenses


def test_licences(spark, odd_docs, no_docs):
    mit = licences.TEMPLATES[0][1]
    edited = mit.replace("merge, publish,", "merge, then publish,").replace("substantial ", "")
    rows = [
        (1, "x y " + edited), (2, "Code under the MIT License, MIT LICENSE"), (3, None), (4, "no licence"), (5, " ".join(mit.split()[:12])),
        (6, "Licensed under CC BY-NC 4.0."), (7, "gnu general-public license gnu general public licence"), (1, "x y " + edited), (None, edited),
    ]
    got = defaultdict(list)
    for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r["doc_id"]].append(r)
    assert [(r["labels"], r["base_labels"], r["n_base"]) for r in got[1] + got[None]] == [("mit", "", 0)] * 3 and got[1][0]["score"] > 0.6
    assert (got[2][0]["n_base"], got[2][0]["first_word"], got[2][0]["last_word"], got[2][0]["labels"]) == (2, 3, 5, "mit")
    assert (got[3][0]["n_words"], got[3][0]["first_word"], got[3][0]["labels"], got[3][0]["score"]) == (0, None, "", 0.0)
    assert got[4][0]["score"] == 0 and got[5][0]["labels"] == "" and 0 < got[5][0]["score"] < 0.5
    assert got[6][0]["labels"] == "cc-by,cc-by-nc" and got[7][0]["base_labels"] == "gpl" and got[7][0]["n_base"] == 1
    assert licences.scan(odd_docs).count() == odd_docs.count() and licences.scan(no_docs).count() == 0


# Decontamination


def plain_decontamination(docs, items, window=13):
    wanted = defaultdict(set)
    for i, t in items:
        own = ALNUM.findall(lowered(t))
        for j in range(max(1, len(own) - window + 1) if own else 0):
            wanted[tuple(own[j : j + window])].add(i)
    out = []
    for d, t in docs:
        own, hit, found = ALNUM.findall(lowered(t)), set(), set()
        for size in {len(k) for k in wanted}:
            for j in range(len(own) - size + 1):
                if tuple(own[j : j + size]) in wanted:
                    hit.update(range(j, j + size))
                    found |= {str(i) for i in wanted[tuple(own[j : j + size])] if i is not None}
        out.append((d, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(own)))
    return Counter(out)


@pytest.mark.parametrize("block", [decontamination.BLOCK_WORDS, 60])
def test_decontamination(spark, block, monkeypatch):
    docs = copied_texts(5)
    items = [(i, " ".join(SOLID.findall(t)[k : k + 30])) for i, t in docs[:30:3] for k in (0, 20)] + [(90, "W w"), (91, None), (92, "--"), (93, docs[4][1][:20]), (90, "W w")]
    found = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"], block_words=block)
    monkeypatch.setattr(decontamination, "find", lambda *a: found)
    assert Counter(map(tuple, decontamination.report(None, None).collect())) == plain_decontamination(docs, items)


def test_decontamination_odd(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "c d e f g h i j k l m n o"), (None, "é" * 50), (3, "x")], "item_id long, text string")
    rows = [tuple(r) for r in items.collect()]
    assert Counter(map(tuple, decontamination.report(odd_docs, items).collect())) == plain_decontamination(all_rows(odd_docs), rows)
    assert decontamination.clean(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert decontamination.clean(no_docs, items).count() == 0
    kept = decontamination.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 3, 4, 5, 5, 9]


def test_fm_index():
    rng = np.random.default_rng(0)
    text = rng.integers(1, 4, 300)
    index = decontamination.FmIndex(text)
    patterns = rng.integers(1, 5, (80, 4))
    low, high = index.search(patterns, np.full(80, 4))
    for p, a, b in zip(patterns, low, high):
        want = [i for i in range(297) if (text[i : i + 4] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# Near-duplicates


def plain_near(rows, k, percent=80):
    sets = {}
    for i, t in rows:
        own = SOLID.findall(lowered(t))
        sets[i] = {tuple(own[j : j + k]) for j in range(len(own) - k + 1)} or ({tuple(own)} if own else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_groups(spark):
    rng = random.Random(7)
    rows = []
    for i in range(30):
        own = [f"w{rng.randint(0, 500)}" for _ in range(rng.choice([2, 5, 8, 40, 150]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(own)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 500)}"
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
    for k in (4, 5):
        got = {r["doc_id"]: r for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=k).collect()}
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == plain_near(rows, k)
        assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_near_pairs_of_crowded_buckets(spark):
    """1,100 distinct near copies of one text; each is similar enough to one other alone, and both share crowded buckets only."""
    rng = random.Random(11)
    rows = []
    for pair in range(550):
        places = set(rng.sample(range(200), 22))
        for copy in "xy":
            rows.append((len(rows), " ".join(f"{copy}{pair}.{j}" if j in places else f"w{j}" for j in range(200))))
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 for i, _ in rows}


def test_cell_counts_leave_no_similar_pair_out(spark):
    """Sets of so many hashes that cells are full."""
    heads = spark.createDataFrame([(i, i, 90_000 + 10_000 * i, bytearray([255] * minhash.CELLS), [5, 6]) for i in range(3)], "id long, comp long, n long, cells binary, bands array<long>")
    members = heads.select("id", "comp", minhash.F.lit(5).cast("long").alias("key"))
    lists = [minhash.blocks(members, heads.drop("comp"), minhash.F.lit(0), name) for name in ("hubs", "others")]
    assert sorted(map(tuple, minhash.possible(*lists, 80).collect())) == [(0, 1), (0, 2), (1, 2)]


def test_near_odd(odd_docs, no_docs):
    got = minhash.near_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None}
    assert by[2] == (0, 2, True) and by[4] == (0, 4, True) and by[6] == (11, 1, False) and by[10] == (11, 1, False) and by[7] == (1, 7, True)
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 5, 7, 8, 9]
    assert minhash.near_groups(no_docs).count() == 0 == minhash.keep_one(no_docs).count()


def test_densification_borrows_only_full_bins():
    row, h = np.zeros(3, np.int64), np.sort(words.mix(np.arange(3, dtype=np.uint64)))
    values = minhash.densified(row, h, 2, 16)
    assert set(values[0]) == set(h) and not values[1].any()


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randint(0, 30), 100 + rng.randint(0, 30)) for _ in range(25)] + [(200, i) for i in range(201, 230)]
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: m for x, m in parent.items() if any(x in e and e[0] != e[1] for e in edges)}
