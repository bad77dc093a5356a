import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, WORDS, documents, prose
from tidemark.llm import order_minhash as om
from tidemark.llm.exact_dedup import drop_copies, exact_groups
from tidemark.llm.graph import components


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i if i is not None else 1 << 62, i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        named = [g for g in groups[norm] if g[2] is not None]
        keep = min(named)[2] if named else None
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_groups(spark):
    rows = [*AWKWARD, (20, "ab c"), (21, "a bc "), (22, "abc"), (-5, "abc\n\n\n"), (1 << 60, "big"), (-(1 << 60), "big"), (23, "A bc")]
    got = sorted((tuple(r) for r in exact_groups(documents(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)
    assert got == brute_exact(rows)
    assert exact_groups(documents(spark, rows).limit(0)).count() == 0


def test_drop_copies_keeps_whole_rows(spark):
    rows = [(4, "a"), (4, "a"), (20, "ab c"), (21, "a bc "), (22, "abc"), (30, None), (31, "")]
    df = documents(spark, rows)
    kept = drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 21, 30]


def test_drop_copies_ties_and_clashing_columns(spark):
    """Of rows with one id and equal content the longest text stays, whatever their order; no column is lost."""
    for rows in ([(4, "ab"), (4, "a b   "), (4, "ab "), (None, "x"), (None, " x")], [(4, "a b   "), (4, "ab "), (4, "ab"), (None, " x"), (None, "x")]):
        df = spark.createDataFrame([(i, t, 1, "r", "c", "k") for i, t in rows], "doc_id long, text string, __text int, row string, content string, keep string")
        kept = drop_copies(df)
        assert kept.columns == df.columns
        assert sorted((r.doc_id or 0, r.text, r["__text"], r["row"]) for r in kept.collect()) == [(0, " x", 1, "r"), (4, "a b   ", 1, "r")]
        assert drop_copies(df.limit(0)).count() == 0


def test_drop_near_duplicates_keeps_clashing_columns(spark):
    text = prose(80, 5)
    df = spark.createDataFrame([(2, text, 1, "r"), (1, text + " more", 2, "s"), (3, None, 3, "t"), (3, None, 3, "t")], "doc_id long, text string, __raw int, row string")
    kept = om.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted((r.doc_id, r["__raw"]) for r in kept.collect()) == [(1, 2), (3, 3)]
    assert om.drop_near_duplicates(df.limit(0)).count() == 0


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = "edit" + str(r.randrange(10**6))
    return " ".join(w)


def brute_classes(rows):
    s = {i: om.shingles(om.words(t)).astype(np.uint32) for i, t in rows}
    text = {i: tuple(om.words(t)) for i, t in rows}
    parent = {i: i for i in s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if text[a] == text[b] or (len(s[a]) and om.alignment(s[a], s[b]) >= om.SIMILARITY):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in s}


def test_near_duplicates_equal_brute_force(spark):
    base = prose(150, 1)
    rows = [(i, edited(base, i % 7, i)) for i in range(60)]  # around the threshold, many of them below it
    passage = prose(60, 2)
    rows += [(100 + i, prose(30, 50 + i) + " " + passage + " " + prose(30, 90 + i)) for i in range(25)]
    chain = base
    for i in range(12):  # each near the one before, the ends far apart
        chain = edited(chain, 2, 500 + i)
        rows.append((200 + i, chain))
    rows += [(300, None), (301, ""), (302, "..."), (303, "one two"), (304, "One, two!"), (305, "word " * 500), (306, "word " * 480), (307, prose(5000, 9)), (308, edited(prose(5000, 9), 20, 1)), (309, base), (309, base)]
    got = {r.doc_id: r.class_id for r in om.near_duplicates(documents(spark, rows)).collect()}
    assert got == brute_classes(rows)
    assert om.near_duplicates(documents(spark, rows)).count() == len(rows)


def test_near_duplicates_of_nothing(spark):
    assert om.near_duplicates(documents(spark, []).limit(0)).count() == 0
    only = documents(spark, [(None, "a b c"), (1, "a b c")])
    assert [r.class_id for r in om.near_duplicates(only).collect()] == [1, 1]
    kept = om.drop_near_duplicates(only)
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == only.columns


def test_order_matters_and_alignment_is_exact():
    a = om.shingles([w + str(i) for i, w in enumerate(WORDS * 4)])
    assert om.alignment(a, a) == 1.0
    assert om.alignment(a, np.concatenate([a[50:], a[:50]])) == 0.0
    r = random.Random(4)
    for _ in range(60):
        b = [x for x in a.tolist() if r.random() > 0.1] + [r.randrange(1 << 60) for _ in range(r.randrange(12))]
        x, y = a.tolist(), b
        row = [0] * (len(y) + 1)
        for u in x:
            last = 0
            for j, v in enumerate(y, 1):
                last, row[j] = row[j], last + 1 if u == v else max(row[j], row[j - 1])
        exact = row[-1] / (len(x) + len(y) - row[-1])
        assert abs(om.alignment(a, np.array(b, np.uint64)) - (exact if exact >= 0.8 else 0)) < 1e-12


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (20, 21), (30, 30)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20} | {100 + i: 100 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_recall():
    hit = tries = 0
    for seed in range(60):
        a = prose(200, seed)
        b = edited(a, 4, seed)
        x, y = om.shingles(om.words(a)), om.shingles(om.words(b))
        if om.alignment(x, y) >= om.SIMILARITY:
            tries += 1
            hit += bool(set(om.sketch(x)[0].tolist()) & set(om.sketch(y)[0].tolist()))
    assert tries > 20 and hit == tries
    assert F is not None


def test_short_near_duplicates_equal_brute_force(spark):
    rows = []
    for k in range(40):  # texts of 8 to 20 words, with a word before, after or both
        w = prose(8 + k % 13, 1000 + k)
        rows += [(10 * k, w), (10 * k + 1, w + " after"), (10 * k + 2, "before " + w), (10 * k + 3, "before " + w + " after")]
    want = brute_classes(rows)
    assert want[1] == 0 and want[11] == 10  # 8 and 9 words, 9 and 10 words
    assert {r.doc_id: r.class_id for r in om.near_duplicates(documents(spark, rows)).collect()} == want


def test_drop_copies_keeps_each_text_under_null_and_under_one_id(spark):
    rows = [(None, "one"), (None, "two"), (None, "two"), (None, "three"), (5, "thr ee"), (7, "four"), (7, "five"), (7, "five"), (8, "fo ur")]
    kept = drop_copies(documents(spark, rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(5, "thr ee"), (7, "five"), (8, "fo ur"), (None, "one"), (None, "two")]


def independent_classes(rows):
    """Smallest id by class, from the definition alone: labelled five-word shingles, longest common subsequence by
    dynamic programming, links at 0.8.  Rows are known by their place."""
    sequences = []
    for _, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        k = min(5, len(w))
        seen, out = defaultdict(int), []
        for i in range(len(w) - k + 1 if w else 0):
            g = tuple(w[i : i + k])
            out.append((g, seen[g]))
            seen[g] += 1
        sequences.append((tuple(w), out))
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            (wa, x), (wb, y) = sequences[a], sequences[b]
            near = wa == wb
            if not near and x and y:
                row = [0] * (len(y) + 1)
                for u in x:
                    last = 0
                    for j, v in enumerate(y, 1):
                        last, row[j] = row[j], last + 1 if u == v else max(row[j], row[j - 1])
                near = row[-1] / (len(x) + len(y) - row[-1]) >= 0.8 - 1e-12
            if near and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    ids = defaultdict(list)
    for v, (i, _) in zip(label, rows, strict=True):
        ids[v].append(i)
    return [min((i for i in ids[v] if i is not None), default=None) for v in label], label


def test_null_and_repeated_ids_with_different_texts(spark):
    a, b, c, d = (prose(60, 900 + k) for k in range(4))
    rows = [(None, a), (None, b), (None, b + " more"), (None, c), (4, d), (4, edited(c, 1, 3)), (4, prose(50, 950)), (7, d + " end"), (7, d), (9, prose(40, 951)), (9, prose(40, 951)), (None, None), (11, "")]
    want, label = independent_classes(rows)
    got = om.near_duplicates(documents(spark, rows))
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == sorted(zip([i for i, _ in rows], want, strict=True), key=str)
    kept = om.drop_near_duplicates(documents(spark, rows)).collect()
    texts = {}
    for v, row in zip(label, rows, strict=True):
        texts.setdefault(v, set()).add(row)
    assert len(kept) == len(texts) and all(sum((r.doc_id, r.text) in some for r in kept) == 1 for some in texts.values())


def test_near_duplicates_equal_an_independent_brute_force(spark):
    base = prose(40, 77)
    rows = [(i, edited(base, i % 4, i)) for i in range(24)] + [(100 + k, prose(8 + k, 300 + k)) for k in range(6)] + [(110 + k, prose(8 + k, 300 + k) + " tail") for k in range(6)]
    want, _ = independent_classes(rows)
    assert {r.doc_id: r.class_id for r in om.near_duplicates(documents(spark, rows)).collect()} == dict(zip([i for i, _ in rows], want, strict=True))


def test_blocks_of_a_hot_cluster_are_dealt_over_tasks(spark):
    entry = "0L AS head, id AS at, id AS component, unhex('00') AS signature, unhex('00') AS shingles, 8000000L AS bytes, id % 2 = 0 AS other"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        blocks = om.block_pairs(spark.range(12).selectExpr(*entry.split(", ")))
        plan = blocks._jdf.queryExecution().executedPlan().toString()
        assert blocks.count() > 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"hashpartitioning\(head#\d+L?, r#\d+, m#\d+", plan)


def test_repeated_short_labels_do_not_break_the_alignment():
    x = np.array([5, 7, 7, 9, 11, 13, 15, 17, 19, 21], np.uint32)
    assert om.alignment(x, x) > 0.8 and om.alignment(x, np.array([5, 7, 9, 9, 11, 13, 15, 17, 19, 21], np.uint32)) > 0
