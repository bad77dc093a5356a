import hashlib
import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import AWKWARD, WORDS, documents, prose
from tidemark.llm import decontamination, html_text, license_scan, toxicity, warc


def brute_contamination(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if names := windows.get(tuple(w[k : k + n])):
                    found |= names
                    hit.update(range(k, k + n))
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_contamination_equals_brute_force(spark, block):
    r = random.Random(block)
    letters = ["a", "b", "é", "C"]
    rows = [(i, " ".join(r.choice(letters) for _ in range(r.randrange(80)))) for i in range(60)] + AWKWARD
    items = [(i, " ".join(r.choice(letters) for _ in range(r.choice([0, 1, 7, 9, 10, 11, 14])))) for i in range(9)] + [(50, None), (51, prose(300, 1)[100:400]), (52, "A")]
    df, bench = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(x.doc_id), x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in decontamination.contamination(df, bench, block_bytes=block).collect())
    assert got == brute_contamination(rows, items)


def test_decontamination_drops_rows_and_takes_empty_tables(spark):
    df = documents(spark, [*AWKWARD, (77, prose(40, 8))])
    bench = spark.createDataFrame([(1, prose(40, 8))], "item_id long, text string")
    kept = decontamination.drop_contaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == len(AWKWARD) and kept.where("doc_id = 77").count() == 0
    assert decontamination.drop_contaminated(df, bench.limit(0)).count() == len(AWKWARD) + 1
    assert decontamination.contamination(df.limit(0), bench).count() == 0
    match = decontamination.find_matches(df, bench).where("doc_id = 77").first().matches[0]
    assert (match.start, match.item_start, match.words) == (0, 0, 40)
    assert decontamination.drop_contaminated(df, bench.union(df.select('doc_id', 'text').where('doc_id = 9')), block_bytes=50).where('doc_id IN (9, 77)').count() == 0


def test_repeated_text_is_joined_in_linear_steps():
    import time

    item = "again and again " * 100
    benchmark = decontamination.Benchmark([("i", item)])
    coded = [decontamination.np.array([benchmark.ids[w] for w in decontamination.words("and again again " * 3000)], "uint32")]
    began = time.perf_counter()
    found = benchmark.matches(coded)[0]
    assert time.perf_counter() - began < 2 and sum(m[3] for m in found) >= 9000
    for _, start, place, n in found[:40]:
        assert decontamination.words("and again again " * 3000)[start : start + n] == decontamination.words(item)[place : place + n]


def labelled(n, seed=0):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        w = [r.choice(WORDS) + r.choice(WORDS) for _ in range(60)]
        if bad:
            for _ in range(4):
                w[r.randrange(60)] = r.choice(["vile", "wretch", "nasty", "awful"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled(2000)
    df, lab = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(df, lab)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = [i for i, r in got.items() if r.held_out]
    right = sum(got[i].predicted == labels[i][2] for i in held)
    assert len(held) > 100 and right / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    clean = toxicity.drop_toxic(df, model)
    assert clean.columns == df.columns and clean.count() == sum(not r.predicted for r in got.values())
    assert len({r.score for r in toxicity.score(documents(spark, [(1, None), (2, ""), (2, "")]), model).collect()}) == 1


def test_every_character_is_in_a_window():
    long = "ab" * 40 + "çé漢字" * 20
    assert "".join(w[: toxicity.WORD_STEP] for w in toxicity.words(long)[:-1]) + toxicity.words(long)[-1] == long
    text = f"one {long} two, three"
    for i in range(len(long) - 8):
        assert any(long[i : i + 8] in w for w in toxicity.windows(text))
    assert toxicity.windows("one") == [" one "] and toxicity.windows("a b c") == [" a b c "] and toxicity.windows("a b c d") == [" a b c ", " c d "]
    assert toxicity.windows("a b c d e") == [" a b c ", " c d e "] and toxicity.windows("a b") == [" a b "]
    assert toxicity.windows(None) == toxicity.windows(" .") == []


def test_dictionaries_are_of_equal_size_and_no_window_is_skipped(spark):
    """Both own parts are of the same size, from their own class; margins are those of an independent scorer that compresses
    one window at a time."""
    import os

    import zstandard

    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    shared = len(os.path.commonprefix([model.toxic[::-1], model.ordinary[::-1]]))
    assert len(model.toxic) == len(model.ordinary) >= shared + 1024

    def compressor(own):
        how = zstandard.ZstdCompressionParameters(strategy=5, min_match=5, window_log=17, hash_log=15, chain_log=15, search_log=5, target_length=8, write_content_size=False, write_checksum=False, write_dict_id=False)
        held = zstandard.ZstdCompressionDict(own + toxicity.AFTER + b"#" + toxicity.BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=how)

    pair = compressor(model.toxic), compressor(model.ordinary)
    scorer, compared = toxicity.Scorer(model), 0
    for r in docs.where("doc_id % 40 = 0").collect():
        found = re.findall(r"\w+", (r.text or "").lower())
        if any(len(w) > 24 for w in found):
            continue
        parts = [found[i : i + 3] for i in range(0, len(found), 2)]
        parts = [p for i, p in enumerate(parts) if i == 0 or len(p) > 1]  # a last single word is in the window before
        assert {int.from_bytes(g, "little") for g in toxicity.grams(toxicity.plain(r.text))} == set(toxicity._gram_codes(r.text).tolist())
        raw = [toxicity.BEFORE + f" {' '.join(p)} ".encode() + toxicity.AFTER for p in parts]
        want = Counter(len(pair[1].compress(w)) - len(pair[0].compress(w)) for w in raw)
        assert scorer.margins(r.text) == want
        compared += want.total()
    assert compared > 10_000


def test_toxic_terms_late_in_unspaced_runs_and_clean_words_with_their_heads(spark):
    r = random.Random(11)
    letters = "日月火水木金土山川田人口目耳手足力男女子学校生先年時分半前後左右上下中外内"
    rows, labels = [], []
    for i in range(900):
        run = "".join(r.choice(letters) for _ in range(90))
        at = r.randrange(30, 80)
        bad = i % 4 == 0
        if bad:
            run = run[:at] + "愚劣卑怯" + run[at:]
        rows.append((i, run if i % 2 else " ".join([r.choice(WORDS), "worthwhile" if not bad else "worthless", run])))
        labels.append((i, int(bad)))
    df = documents(spark, rows)
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {x.doc_id: x for x in toxicity.score(df, model).collect()}
    held = [i for i, x in got.items() if x.held_out]
    assert sum(got[i].predicted == labels[i][1] for i in held) / len(held) > 0.95
    scorer = toxicity.Scorer(model)
    assert all(abs(got[i].score - scorer.score(t)) < 1e-12 for i, t in rows[:50])
    assert scorer.score("worthwhile") < 0.5


def test_toxicity_separates_held_out_documents_of_the_tables(spark):
    """Held-out accuracy on whole tables: area under the curve, and what is caught at the threshold."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    good, bad = ([r.score for r in got if r.toxic == y] for y in (0, 1))
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(good) * len(bad))
    assert auc > 0.9 and sum(g < 0.5 for g in good) / len(good) > 0.97


def test_held_out_labels_do_not_matter(spark):
    import zlib

    rows, labels = labelled(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    df = documents(spark, rows)
    models = [toxicity.train(df, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    assert models[0] == models[1]


@pytest.mark.parametrize("value", [0, 1, None])
def test_toxicity_with_one_class_or_none(spark, value):
    df = documents(spark, AWKWARD)
    lab = spark.createDataFrame([(i, value) for i, _ in AWKWARD], "doc_id long, toxic int")
    got = toxicity.score(df, toxicity.train(df, lab)).collect()
    assert len(got) == len(AWKWARD) and all(r.predicted == int(value == 1) for r in got)


PAGES = [(1, "http://a/1", "<p>" + "x" * 1000), (2, "http://a/2", "<p>" + "x" * 1000), (3, None, "short"), (4, "u\r\nv", "short"), (5, "u", None), (6, "u", ""), (7, "u", "é" * 600), (8, "u", "é" * 600), (9, "u", "z" * 200_000), (9, "u", "z" * 200_000)]


def test_warc_round_trip(spark):
    df = spark.createDataFrame([(*p, p[0], "x") for p in PAGES], "page_id long, url string, html string, key long, kind string")
    got = sorted(tuple(r) for r in warc.page_records(warc.write_archives(df)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    top = {}
    for i, _, h in PAGES:
        top[h] = max(top.get(h, 0), i)
    want = []
    for i, _, h in PAGES:
        b = (h or "").encode()
        again = len(b) >= 1000 and top[h] != i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[h] if again else None))
    assert got == sorted(want, key=lambda r: (r[0], r[1]))
    assert warc.read_archives(warc.write_archives(df), payloads=True).where("kind = 'gap'").count() == 0
    assert warc.page_records(warc.write_archives(df.limit(0))).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_later_records(spark, tmp_path, packed):
    r = random.Random(7)
    records = [warc.record("response", f"urn:tidemark:page:{i}", "http://x", bytes(r.randrange(32, 127) for _ in range(2000)), None) for i in range(6)]
    parts = [warc.gzip_member(x) for x in records] if packed else records
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    data = bytearray(b"".join(parts))
    for at in range(starts[1] + 700, starts[1] + 760):
        data[at] ^= 0x55
    data[starts[3] : starts[3] + 9] = b"\0" * 9  # a lost beginning
    path = tmp_path / ("a.warc.gz" if packed else "a.warc")
    path.write_bytes(bytes(data[: starts[6] - 5]))  # a lost end
    rows = warc.read_archives(spark.createDataFrame([(f"file://{path}",)], "archive string"), payloads=True).collect()
    assert sorted(x.record_id for x in rows if x.kind == "record") == [f"urn:tidemark:page:{i}" for i in ((0, 2, 4, 5) if packed else (0, 2, 4))]
    gaps = sorted((x.offset, x.length) for x in rows if x.kind == "gap")
    lost_end = [] if packed else [(starts[5], starts[6] - 5 - starts[5])]  # the digest of the last record holds without its member's trailer
    assert gaps == [(starts[1], starts[2] - starts[1]), (starts[3], starts[4] - starts[3]), *lost_end]


def opened(tmp_path, data, name):
    from pyarrow import fs

    (tmp_path / name).write_bytes(data)
    return fs.LocalFileSystem().open_input_file(str(tmp_path / name))


def one_record(i, size=2000, seed=7):
    r = random.Random(seed + i)
    return warc.record("response", f"urn:tidemark:page:{i}", "http://x", bytes(r.randrange(32, 127) for _ in range(size)), None)


def ids_and_gaps(f, packed=True):
    rows = list(warc.salvage(f, f.size(), packed))
    return [r[5].rsplit(":", 1)[1] for r in rows if r[3] == "record"], [r[:3] for r in rows if r[3] == "gap"]


def test_salvage_inside_a_member(tmp_path):
    bad = bytearray(one_record(1))
    bad[-500] ^= 1
    member = warc.gzip_member(one_record(0) + bytes(bad) + one_record(2))
    after = warc.gzip_member(one_record(3))
    n = len(one_record(0))
    assert ids_and_gaps(opened(tmp_path, member + after, "a")) == (["0", "2", "3"], [(0, n, len(bad))])
    assert ids_and_gaps(opened(tmp_path, one_record(0) + bytes(bad) + one_record(2), "b"), False) == (["0", "2"], [(n, None, len(bad))])


def test_a_flipped_bit_loses_no_record_before_it(tmp_path):
    data = bytearray(warc.gzip_member(b"".join(one_record(i, 30_000) for i in range(40))))
    data[len(data) // 2] ^= 4
    found, gaps = ids_and_gaps(opened(tmp_path, bytes(data) + warc.gzip_member(one_record(99)), "a"))
    assert found[:18] == [str(i) for i in range(18)] and found[-1] == "99" and gaps


def test_a_record_without_digests_needs_the_checksum(tmp_path):
    plain = re.sub(rb"WARC-(Payload|Block)-Digest: [^\r]*\r\n", b"", one_record(0))
    whole = warc.gzip_member(plain)
    assert ids_and_gaps(opened(tmp_path, whole, "a")) == (["0"], [])
    wrong = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
    assert ids_and_gaps(opened(tmp_path, wrong + warc.gzip_member(one_record(1)), "b")) == (["1"], [(0, None, len(wrong))])


def test_long_headers_and_missing_archives(spark):
    rows = [(1, "http://a/" + "x" * 70_000, "<p>one"), (2, "http://a/" + "y" * 200_000, "<p>" + "z" * 5000), (3, "u", "<p>" + "z" * 5000)]
    manifest = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(warc.read_archives(manifest, payloads=True).collect(), key=lambda r: r.record_id)
    assert [(r.kind, r.target_uri) for r in got] == [("record", u) for _, u, _ in rows]
    with pytest.raises(Exception, match="nowhere"):
        warc.read_archives(spark.createDataFrame([("file:///tmp/nowhere.warc.gz",)], "archive string")).count()


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


LONG = [prose(40, k) for k in range(4)]
NAV = "<nav><ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:8]) + "</ul></nav>"


@pytest.mark.parametrize(
    "body, text",
    [
        (f"{NAV}<div class='ad'>Buy now</div><article><h1>Head</h1><p><b>{LONG[0]}<br><p>{LONG[1]}</p><p>Short.</p></article><footer>c</footer>", f"Head {LONG[0]} {LONG[1]} Short."),
        (f"{NAV}<div id=main><h1>Head</h1><p>{LONG[0]}</p><p>x <a href=y>link</a> y</p><p>{LONG[2]}</p></div><div class='comments'><p>{LONG[3]}</p></div>", f"Head {LONG[0]} x link y {LONG[2]}"),
        ("<article><p>a&amp;b &lt;i&gt; caf&eacute;&nbsp;x</p><!-- c --><p>f<b>o</b>o</p><form><input>q</form><script>s()</script></article>", "a&b <i> café x foo"),
        ("<article><header><h1>Head</h1></header><p>one<p>two<aside>side</aside><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "Head one two a b c d"),
        (NAV, ""),
        ("", ""),
        # no article element: loose text with br, a headline and a short paragraph beside the core
        (f"{NAV}<h1>Head</h1>{LONG[0]}<br>{LONG[1]}<div><p>{LONG[2]}</p><p>{LONG[3]}</p></div><footer>c</footer>", f"Head {LONG[0]} {LONG[1]} {LONG[2]} {LONG[3]}"),
        # split containers with something short between them
        (f"{NAV}<div><p>{LONG[0]}</p><p>{LONG[1]}</p></div><p>Short.</p><div><p>{LONG[2]}</p></div>", f"{LONG[0]} {LONG[1]} Short. {LONG[2]}"),
        # a name alone removes nothing: a long notice is part of the article, a short one is not
        (f"<article><p>{LONG[0]}</p><div class='notice'>{LONG[1]} {LONG[2]} {LONG[3]}</div><div class='notice'>Closed</div></article>", f"{LONG[0]} {LONG[1]} {LONG[2]} {LONG[3]}"),
        (f"{NAV}<div class='search-result social'><p>{LONG[0]}</p><p>{LONG[1]}</p></div><div class='ad'>Buy {LONG[3]}</div>", f"{LONG[0]} {LONG[1]}"),
        # an article element around menus only is not the main text
        (f"<article><ul><li><a href=a>x</a><li><a href=b>y</a></ul></article><div><p>{LONG[0]}</p><p>{LONG[1]}</p></div>", f"{LONG[0]} {LONG[1]}"),
    ],
)
def test_main_text(body, text):
    assert html_text.main_text(page(body)) == text


def test_main_text_of_the_tables_is_the_article(spark):
    """Against another parser: what the standard library sees inside the article element of every page."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.depth, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            if self.depth and tag in ("p", "h1", "br"):
                self.out.append(" ")

        def handle_endtag(self, tag):
            self.depth -= tag == "article"

        def handle_data(self, data):
            if self.depth:
                self.out.append(data)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        parser = Article()
        parser.feed(r.html)
        assert got[r.page_id] == " ".join("".join(parser.out).split())


@pytest.mark.parametrize("piece", ["<a ", '<a "x>" ', "<div>", "<p><b>", '<a href="', "<!-- ", "<p><button><b>", "<li><b>", "<", "</x>", "<div></x>"])
def test_broken_markup_takes_linear_time(piece):
    import time

    began = time.perf_counter()
    html_text.main_text(piece * 40_000)
    assert time.perf_counter() - began < 10


def test_html_awkward(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain"), (4, "u", "<p>open <b>bold"), (4, "u", "<p>open <b>bold"), (5, "u", "<" * 2000), (6, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "u", "<p>a<!-- never closed"), (8, "u", "<script>never closed"), (9, "u", "a < b <3 x")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract_text(df).select("page_id", "url", "text", "n_chars").collect()}
    assert got[1] == got[2] == ("", 0) and got[3] == ("plain", 5) and got[4][0] == "open bold" and got[6][0] == "deep" and got[7][0] == "a" and got[8] == ("", 0)
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_license_scan(spark):
    rows = [(100 + i, prose(50, i) + "\n" + prose(30, 100 + i)) for i in range(120)]
    rows += [(1, prose(30, 300) + "\nLicensed under the Apache License, Version 2.0."), (2, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."), (3, "This work is licensed under the GNU General Public License, version 3."), (4, "My driving licence was released in May."), (5, None), (6, ""), (6, "")]
    df = documents(spark, rows)
    got = {r.doc_id: r for r in license_scan.scan(df, license_scan.train(df)).collect()}
    assert {i: got[i].licences for i in (1, 2, 3, 4, 5, 6)} == {1: ["Apache-2.0"], 2: ["CC-BY-NC", "MIT"], 3: ["GPL"], 4: [], 5: [], 6: []}
    assert not any(got[100 + i].n_licensed for i in range(120)) and got[2].n_paragraphs == 2 and got[5].n_paragraphs == 0
    assert license_scan.scan(df, license_scan.train(df)).count() == len(rows)
    empty = df.limit(0)
    assert license_scan.scan(empty, license_scan.train(empty)).count() == 0


def wrapped(text, width):
    out, line = [], ""
    for w in text.split():
        if line and len(line) + len(w) >= width:
            out, line = [*out, line], ""
        line = f"{line} {w}".strip()
    return "\n".join([*out, line])


#: Notices that are not what the classifier is fitted on: other phrases around the names, and wrapped texts.
NOTICES = [
    ("MIT", "This code is MIT licensed."), ("MIT", "Available freely to all under MIT License terms"), ("MIT", "the library uses the MIT license"), ("GPL", "Code released under GPLv3"), ("GPL", "You may copy it under the GNU General Public License, version 2 or later."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."), ("LGPL", "You may link to it under the GNU Lesser General Public License"), ("Apache-2.0", "We publish it under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License."), ("BSD", "with or without modification, are permitted provided that the following conditions are met:"), ("BSD", "Published under the 3-clause BSD license"),
    ("MPL-2.0", "Covered by the Mozilla Public License 2.0"), ("CC-BY-NC", "Photos: CC BY-NC 4.0"), ("CC-BY", "Text is shared under CC BY 4.0 by its writers"), ("CC0", "Data dedicated with CC0 1.0 Universal license"), ("ISC", "Offered under the ISC license"),
    ("Proprietary", "(c) 2021 Somebody Inc. All rights reserved."), ("Proprietary", "All rights reserved."),
]
ORDINARY = ["licensed under the Eclipse Public License 2.0", "Released under the GNU Affero General Public License", "Licensed under the PHP License 3.01", "My driving licence was released in May.", "The mayor gave permission to use the hall, free of charge.", "A table was reserved.", "Copyright is discussed in chapter two.", "He got his pilot license under the old rules."]


def test_license_families_flat_and_wrapped(spark):
    prosaic = [(100 + i, prose(50, i) + "\n" + prose(30, 100 + i)) for i in range(120)]
    notices = NOTICES + [(family, t) for family, some in license_scan.TEXTS.items() for t in some]
    rows = list(prosaic)
    for k, (_, t) in enumerate(notices):
        rows += [(1000 + k, prose(30, k) + "\n" + t), (2000 + k, prose(30, k) + "\n\n" + wrapped(t, 50) + "\n\n" + prose(9, k)), (3000 + k, prose(30, k) + "\n * " + wrapped(t, 40).replace("\n", "\n * ") + "\n *\n"), (4000 + k, prose(90, k) + ". " + t)]
    rows += [(5000, "\n" * 100_000 + "Released under\nthe MIT License.\n" + " \n" * 100_000)]
    rows += [(6000 + k, prose(20, k) + "\n" + t) for k, t in enumerate(ORDINARY)]
    df = documents(spark, rows)
    got = {r.doc_id: r.licences for r in license_scan.scan(df, license_scan.train(df)).collect()}
    want = {n + k: [family] for n in (1000, 2000, 3000, 4000) for k, (family, _) in enumerate(notices)} | {5000: ["MIT"]}
    missed = {i: (got[i], notices[i % 1000]) for i in want if got[i] != want[i]}
    assert len(missed) <= 0.03 * len(want), missed  # recall and precision over all families
    for family in license_scan.NAMES:
        named = [i for i in want if want[i] == [family]]
        assert sum(got[i] == [family] for i in named) >= 0.8 * len(named), family
    assert {i: got[i] for i in range(6000, 6000 + len(ORDINARY)) if got[i]} == {}
    assert not any(got[i] for i, _ in prosaic)


def test_every_fitted_notice_is_found(spark):
    """All names in all phrases; other licences in the same phrases are unknown."""
    made = [(f, p.format(n)) for f, names in license_scan.NAMES.items() for n in names for p in license_scan.PHRASES]
    rows = [(k, prose(15, k) + "\n" + t) for k, (_, t) in enumerate(made)]
    rows += [(10_000 + k, prose(15, k) + "\n" + p.format(n)) for k, (n, p) in enumerate((n, p) for n in license_scan.OTHER for p in license_scan.PHRASES)]
    rows += [(20_000, "Apache-2.0 OR MIT"), (20_001, "Distributed under Apache-2.0."), (20_002, "Released under the MIT/X11 terms"), (20_003, 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.')]
    df = documents(spark, rows)
    model = license_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert 0 < model.threshold < 1 and model.threshold != 0.5
    got = {r.doc_id: r.licences for r in license_scan.scan(df, model).collect()}
    missed = [(t, got[k]) for k, (f, t) in enumerate(made) if f not in got[k]]
    assert missed == []
    assert [(rows[len(made) + k][1], got[10_000 + k]) for k in range(len(license_scan.OTHER) * len(license_scan.PHRASES)) if got[10_000 + k]] == []
    assert "Apache-2.0" in got[20_000] and got[20_001] == ["Apache-2.0"] and got[20_002] == ["MIT"] and got[20_003] == ["MIT"]


def test_license_scan_equals_a_search_for_the_lines_of_the_tables(spark):
    """Brute force over the whole table: its licence lines are known, and nothing else is one."""
    lines = {"Licensed under the Apache License": "Apache-2.0", "Released under the MIT License": "MIT", "Licensed under CC BY-NC": "CC-BY-NC", "under the GNU General Public License": "GPL", "All rights reserved.": "Proprietary"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.licences for r in license_scan.scan(docs, license_scan.train(docs)).collect()}
    want = {r.doc_id: sorted({f for x, f in lines.items() if x in (r.text or "")}) for r in docs.collect()}
    assert got == want


def test_license_scan_of_null_ids_and_very_long_texts(spark):
    long = prose(20_000, 5) + "\n" + "Licensed under the MIT License.\n" + prose(20_000, 6).replace(" ", "\n")
    df = documents(spark, [(None, "Released under the MIT License."), (1, long), (2, "Released under the MIT License."), (2, "All rights reserved.")])
    got = sorted(((r.doc_id, r.licences) for r in license_scan.scan(df, license_scan.train(df)).collect()), key=str)
    assert got == [(1, ["MIT"]), (2, ["MIT", "Proprietary"]), (2, ["MIT", "Proprietary"]), (None, [])]


ARTICLE = "".join(f"<p>Sentence number {i} of the article that readers came for, long enough to be dense text.</p>" for i in range(8))
ARTICLE_TEXT = " ".join(f"Sentence number {i} of the article that readers came for, long enough to be dense text." for i in range(8))
MENU = '<div class="nav"><a href="/">Home</a> <a href="/n">News</a></div>'


@pytest.mark.parametrize("name", ["no-sidebar content", "sidebar-right", "with-comments", "ad-free", "hasMenu", "menu page", "not-an-advert"])
def test_names_of_layouts_do_not_lose_the_article(name):
    assert html_text.main_text(f'<body>{MENU}<div class="{name}"><div>{ARTICLE}</div></div><p>tiny</p></body>').startswith(ARTICLE_TEXT)


def test_forms_hidden_parts_and_headers():
    controls = '<input name="q"><select><option>Choose me</option></select><button>Send it</button><label>Your name</label>'
    assert html_text.main_text(f"<body><form action='/p'>{MENU}<div>{ARTICLE}</div>{controls}</form></body>") == ARTICLE_TEXT
    assert html_text.main_text(f"<body><div>{ARTICLE}</div><form>Sign up for our letter {controls}</form></body>") == ARTICLE_TEXT
    hidden = "<p hidden>Not shown</p><p hidden=''>Nor this</p><p aria-hidden=true>nor that one here</p><p style='x:y; display : none'>nor these words</p>"
    shown = '<p class="sm hidden lg">Shown by its class alone, which says nothing about being hidden to anyone at all.</p>'
    assert html_text.main_text(f"<body><div>{ARTICLE}{hidden}{shown}</div></body>") == f"{ARTICLE_TEXT} Shown by its class alone, which says nothing about being hidden to anyone at all."
    assert html_text.main_text(f"<body><header>Site name</header><main><header><h1>The headline</h1></header>{ARTICLE}</main></body>") == f"The headline {ARTICLE_TEXT}"


def test_reader_comments_go_even_where_they_are_longer():
    comments = "".join(f"<p>Comment {i}: I have read this and wish to say at length what I think of it, again and again.</p>" for i in range(20))
    assert html_text.main_text(f'<body><div class="story">{ARTICLE}</div><div class="comments">{comments}</div></body>') == ARTICLE_TEXT


def test_density_of_pages_without_article_elements():
    """The core of generated pages is the node with the largest density sum of a plain recursive computation."""
    r = random.Random(6)

    def grow(depth):
        parts = [f"<p>{' '.join(r.choice(WORDS) for _ in range(r.randrange(3, 40)))}</p>" if r.random() < 0.6 else f"<a href=x>{r.choice(WORDS)}</a>" for _ in range(r.randrange(1, 6))]
        parts += [grow(depth - 1) for _ in range(r.randrange(0, 3))] if depth else []
        r.shuffle(parts)
        return f"<div>{''.join(parts)}</div>"

    import math

    def counts(node):
        chars = tags = links = link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                chars += len("".join(c.split()))
            else:
                a, b, x, y = counts(c)
                chars, tags, links, link_tags = chars + a, tags + b + 1, links + x, link_tags + y + (c.tag == "a")
        return chars, tags, chars if node.tag == "a" else links, link_tags

    for _ in range(60):
        root = html_text.tree(f"<body>{grow(3)}</body>")
        body = root.children[0]
        body.parent = None
        nodes = html_text.measure(body)
        c, _, l, _ = counts(body)
        ratio = l / max(1, c)
        for node in nodes:
            total = 0.0
            for child in node.children:
                if not isinstance(child, str):
                    chars, tags, links, link_tags = counts(child)
                    if chars:
                        tags = max(1, tags)
                        base = math.log(chars / max(1, chars - links) * links + ratio * chars + math.e)
                        total += chars / tags * math.log(max(1.0, chars / max(1, links) * tags / max(1, link_tags)) + 1) / math.log(max(base, 1.5) + 1)
            assert abs(node.total - total) < 1e-9
