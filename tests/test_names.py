"""Plain names are those of the full compatibility decomposition and case folding, for every character."""

import unicodedata

from pyspark.sql import functions as F

from tidemark.functions import texts


def stripped(c):
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


def test_every_character_is_decomposed_and_folded(spark):
    codes = [*range(1, 0xD800), *range(0xE000, 0x110000)]
    lines = ["a" + "".join(f"{chr(c)}\x1f" for c in codes[k : k + 256]) for k in range(0, len(codes), 256)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "k long, t string")
    got = {r.k: (r.s, r.f) for r in df.select("k", texts.strip_accents(F.col("t")).alias("s"), texts.case_fold(texts.strip_accents(F.col("t"))).alias("f")).collect()}
    assert [k for k, t in enumerate(lines) if got[k][0] != stripped(t)] == []
    wrong = [c for k, t in enumerate(lines) for c, a, b in zip(t.split("\x1f"), got[k][1].split("\x1f"), stripped(t).casefold().split("\x1f")) if a != b]
    assert all(unicodedata.category(c[-1]) in ("Cn", "Lu") and ord(c[-1]) > 0x1C80 for c in wrong) and len(wrong) < 40  # letters newer than one of the two Unicode versions


def test_names(spark):
    cases = {"Łukasz ﬁnn-Straße": "łukasz finn strasse", "Ｊｏｓé Ｐérez Jr.": "jose perez", "김철수": stripped("김철수"), "ΜΑΡΊΑΣ": "μαριασ", "Йорк": "иорк", "N.Y.": "ny", "ab\u2028cd": "ab cd", "½ & Co": "1⁄2 and co", "": ""}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    assert [(r.raw, r.n, r.want) for r in df.select("raw", "want", texts.normalized_name(F.col("raw")).alias("n")).collect() if r.n != r.want] == []
