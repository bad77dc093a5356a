"""Hard negatives, SimHash classes and the filter audit against brute force."""

import random
import re
from itertools import combinations, permutations

import numpy as np
import xxhash

from tests.llm.helpers import AWKWARD, documents, prose
from tidemark.llm import filter_audit as fa
from tidemark.llm import hard_negatives as hn
from tidemark.llm import simhash as sh

SPACE = r"[\x20\x09-\x0D]+"


# ---- hard negatives


def brute_negatives(rows):
    """rows: (id, label, vector); whole scans in plain Python integers."""
    usable = [(i, (y + 1) % 10 if i % 7 == 0 else y, [int(np.floor(256.0 * float(np.float32(e)))) for e in x]) for i, y, x in rows if i is not None and y is not None and x is not None and all(e is not None and np.isfinite(e) for e in x)]
    out = []
    for k, (a, label, x) in enumerate(usable):
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, v, strict=False)), i, y) for m, (i, y, v) in enumerate(usable) if m != k)
        for s, i, _ in [t for t in scored if t[2] == label][:5]:
            within = [t for t in scored if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s][:10]
            out += [(a, i, r, t[1], -s, -t[0]) for r, t in enumerate(within, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, y, x, 7, "c") for i, y, x in rows], "vec_id long, label int, embedding array<float>, n long, id string")


def clustered(n, dims, seed, labels=10, spread=0.4):
    r = np.random.RandomState(seed)
    centres = r.randn(6, dims)
    return [(i, int(r.randint(labels)), (centres[r.randint(6)] + spread * r.randn(dims)).astype(np.float32).tolist()) for i in range(n)]


def mined(spark, rows):
    return sorted(tuple(r) for r in hn.hard_negatives(vectors(spark, rows)).collect())


def test_hard_negatives(spark, monkeypatch):
    for name, value in (("CANDIDATE_BLOCK", 150), ("ANCHOR_BLOCK", 4), ("CANDIDATE_LEAF", 16), ("ANCHOR_LEAF", 2)):
        monkeypatch.setattr(hn, name, value)
    rows = clustered(1200, 8, 3)
    rows += [(i + 1200, 4, rows[5][2]) for i in range(150)]  # one hot vector and label: ties by id
    rows += [(1400, None, rows[0][2]), (1500, 3, None), (1600, 3, [1.0, None, 0.5]), (1700, 2, [float("nan")] * 8), (1800, 2, [float("inf")] + [0.0] * 7), (None, 1, rows[1][2]), (1900, 1, []), (2000, 1, [1.0, 2.0]), (200, *rows[200][1:]), (-700, 6, rows[9][2])]
    got = mined(spark, rows)
    assert got == brute_negatives(rows)
    assert {r[0] for r in got} >= {0, 100, 200, 1200, -700} and not {1400, 1500, 1600, 1700, 1800} & {r[0] for r in got}


def test_hard_negatives_prune_and_stay_exact(monkeypatch):
    """On clustered vectors most leaf pairs are never scored, and what is found is what a scan finds."""
    rows = clustered(4000, 6, 5, labels=3, spread=0.1)
    x = np.floor(256 * np.array([r[2] for r in rows], np.float64))
    n, labels = np.arange(len(rows)), np.array([r[1] for r in rows])
    tree = hn.Tree.grow(n, n, labels, x, 64)
    some = n % 10 == 0
    anchors = hn.Tree.grow(n[some], n[some], labels[some], x[some], 4)
    scored = []
    real = hn.Search.score_leaves
    monkeypatch.setattr(hn.Search, "score_leaves", lambda self, i, c, j: (scored.append((i, j)), real(self, i, c, j)))
    every = np.arange(len(anchors.n))
    seek = hn.Search(anchors, every, np.full(len(every), -np.inf), np.full(len(every), np.inf), 5, True)
    seek.visit(tree)
    q, score, ids = seek.results()
    for k in every:
        own = anchors.n[k]
        s = sorted((-int(x[own] @ x[m]), m) for m in n if m != own and labels[m] == labels[own])[:5]
        assert sorted(zip((-score[q == k]).tolist(), ids[q == k].tolist(), strict=True)) == s
    leaves = (anchors.left < 0).sum() * (tree.left < 0).sum()
    assert 0 < len(scored) < leaves / 4


def test_hard_negatives_of_empty_tables(spark):
    assert mined(spark, [(100, 1, [1.0])]) == []
    assert hn.hard_negatives(vectors(spark, clustered(3, 4, 1)).limit(0)).count() == 0
    assert hn.hard_negatives(vectors(spark, clustered(50, 4, 1)).where("vec_id > 0")).count() == 0


# ---- SimHash


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(points, radius=2):
    parent = {p: p for p in points}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(sorted(points), 2):
        if (a ^ b).bit_count() <= radius:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {p: find(p) for p in points}


def test_simhash_classes(spark):
    base = prose(300, 11)
    near = [(100 + k, base.replace(base.split()[7 * k], "changed", 1)) for k in range(30)]
    rows = [*AWKWARD, *near, (40, base), (41, base.upper()), (39, "\t" + base.replace(" ", "\n\x0b")), (50, "One two"), (51, "one  TWO "), (52, "İstanbul ÀB"), (None, base), (60, "w" * 70_000), (61, prose(20_000, 3)), (None, "only one without id here")]
    got = {(r.doc_id, r.fingerprint): r.component_id for r in sh.near_classes(documents(spark, rows)).collect()}
    fps = {(i, t): brute_fingerprint(t) for i, t in rows}
    held = classes(set(fps.values()))
    least = {}
    for (i, _), f in fps.items():
        if i is not None:
            least[held[f]] = min(i, least.get(held[f], i))
    assert got == {(i, f"{f:016x}"): least.get(held[f]) for (i, _), f in fps.items()}
    assert got[(None, f"{brute_fingerprint(base):016x}")] == 39 and sh.near_classes(documents(spark, rows)).count() == len(rows)
    assert sh.near_classes(documents(spark, rows).limit(0)).count() == 0


def test_covering_masks_miss_no_pair():
    for positions in (list(range(64)), list(range(5, 64, 3)), [1, 2, 9, 60]):
        masks = sh.covering(positions, 2)
        assert len(masks) == 7
        for a, b in combinations(positions, 2):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_links_of_a_dense_group(spark):
    """A thousand fingerprints in one bucket, and strangers: the same links as all pairs, through refined buckets."""
    r = random.Random(5)
    points = {r.getrandbits(64) & ~0x3FF | k for k in range(3)} | {0x5A5A << 40 | k for k in range(1 << 10)} | {r.getrandbits(64) for _ in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if (a ^ b if a ^ b >= 0 else (a ^ b) + (1 << 64)).bit_count() <= 2}
    for most in (sh.MOST, 4):
        got = [tuple(x) for x in sh.links(df, most=most).collect()]
        assert set(got) == want and len(got) == len(want)


# ---- filter audit


def brute_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        marks = [x for x in labels if i is not None and x[0] == i]
        docs.append((part or "", {k for k, v in fails.items() if v}, any(x[1] == 1 for x in marks), any(x[2] == 1 for x in marks)))
    out = []
    for part in {d[0] for d in docs}:
        own, steps, sums = [d for d in docs if d[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                sums[f] += len(gone)
                steps.append((part, order, step, len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*s, sums[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def test_filter_audit(spark):
    r = random.Random(2)
    texts = [None, "", " \t", "One", prose(250, 1), prose(250, 1), "word " * 300, "Word#" * 150, prose(210, 2) + " & co", prose(220, 3).upper(), "é漢😀 " * 210, prose(9000, 5)]
    rows = [(k if k % 9 else None, r.choice(texts), r.choice(["web", "books", None, ""])) for k in range(160)]
    rows += [(7, texts[4], "web"), (7, texts[4], "web"), (None, texts[4], "only null"), (10**15, prose(230, 9), "clean")]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1])) for k in range(0, 200, 2)] + [(8, 1, 0), (8, 0, 1), (None, 1, 1)]
    df = spark.createDataFrame([(i, t, p, 1, "x") for i, t, p in rows], "doc_id long, text string, source string, failing int, part string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.filter_audit(df, marks)
    assert sorted(tuple(x) for x in got.collect()) == brute_audit(rows, labels)
    assert got.count() == 600 * 5
    assert fa.filter_audit(df.limit(0), marks).count() == 0
    assert fa.filter_audit(df, marks.limit(0)).where("good_lost > 0 OR toxic_lost > 0").count() == 0


def test_audit_of_other_filters(spark):
    """Three filters: shares add up to what all remove, in every order."""
    failing = spark.createDataFrame([("p", f, 0, 0) for f in (0, 1, 1, 3, 7, 6, 4, 0)], "part string, failing int, good int, toxic int")
    rows = fa.audit(failing, "XYZ").collect()
    assert len(rows) == 18
    assert sum({r.filter_order[r.step - 1]: r.shapley for r in rows}.values()) == 6 * 6
    assert {r.kept for r in rows if r.step == 3} == {2}
