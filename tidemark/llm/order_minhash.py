"""Near-duplicates by Order MinHash, verified by banded alignment.

A document is the sequence of its five-word shingles, each labelled with its occurrence number so that all differ.
For each of ``BANDS`` hash functions the ``PICK`` shingles of least hash are taken and hashed in their order in the
text: two documents agree in a band about as often as their similarity to the power ``PICK``, and less if the order
differs.  Similarity is that of an alignment: shingles matched in order, over shingles in either.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BoundedCache, batch_rows, map_batches, materialise, worker_cache
from tidemark.llm.graph import components

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
#: A long pair at the least similarity agrees in no band with probability (1 - 0.8 ** 6) ** 48 = 5e-7; the fewer its
#: shingles the more often, 4e-6 at 24 in a text of 30.
BANDS, PICK = 48, 6
#: So texts of at most so many shingles have as many bands of fewer picks besides: 2e-11 at 4 in a text of 5.
SHORT, SHORT_PICK = 30, 3
#: Slots of the signature that screens pairs inside a bucket; its standard error at the least similarity is 0.025.
SLOTS = 256
SCREEN = SIMILARITY - 4 * (SIMILARITY * (1 - SIMILARITY) / SLOTS) ** 0.5
#: What one task step compares on either side: documents, and bytes of their shingles, at most (about).
BLOCK, BLOCK_BYTES = 1024, 8 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
STEP = 4096

_rng = np.random.RandomState(20240117)
_MULTIPLY = (_rng.randint(0, 1 << 31, SLOTS).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.randint(0, 1 << 31, SLOTS).astype(np.uint32)
_PLACE = (_rng.randint(1, 1 << 62, max(WORDS_PER_SHINGLE, PICK)).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(found: list[str]) -> np.ndarray:
    """64-bit hashes of the occurrence-labelled shingles, in text order; fewer words than five make one shingle."""
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = worker_cache("word hashes", lambda: BoundedCache(xxhash.xxh3_64_intdigest, limit=400_000))
    w = np.fromiter(map(hashes.__getitem__, found), np.uint64, n)
    k = min(n, WORDS_PER_SHINGLE)
    x = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        x += w[i : n - k + 1 + i] * _PLACE[i]
    x = _mix(x + np.uint64(k))
    order = np.argsort(x, kind="stable")
    ordered = x[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    if not first.all():
        at = np.arange(len(x))
        occurrence = np.empty(len(x), np.uint64)
        occurrence[order] = at - np.maximum.accumulate(np.where(first, at, 0))
        x = _mix(x + occurrence * np.uint64(0x9E3779B97F4A7C15))
    return x


def sketch(x: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Band keys and the screening signature of labelled shingles; in steps, so memory does not grow with the text."""
    folded = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    best, least_hash, least_at = None, None, None
    for start in range(0, len(x), STEP):
        h = folded[start : start + STEP, None] * _MULTIPLY + _ADD
        low = h.min(axis=0)
        best = low if best is None else np.minimum(best, low)
        h = h[:, :BANDS]
        if len(h) > PICK:
            at = np.argpartition(h, PICK - 1, axis=0)[:PICK]
            h = np.take_along_axis(h, at, axis=0)
        else:
            at = np.repeat(np.arange(len(h))[:, None], BANDS, axis=1)
        at = at + start
        if least_hash is not None:
            h, at = np.concatenate([least_hash, h]), np.concatenate([least_at, at])
            if len(h) > PICK:
                keep = np.argpartition(h, PICK - 1, axis=0)[:PICK]
                h, at = np.take_along_axis(h, keep, axis=0), np.take_along_axis(at, keep, axis=0)
        least_hash, least_at = h, at
    chosen = x[np.sort(least_at, axis=0)]  # in text order
    keys = (chosen * _PLACE[: len(chosen), None]).sum(axis=0, dtype=np.uint64)
    keys = _mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if len(x) <= SHORT:
        h = folded[:, None] * _MULTIPLY[:BANDS] + _ADD[:BANDS]
        few = x[np.sort(np.argsort(h, axis=0, kind="stable")[:SHORT_PICK], axis=0)]
        more = (few * _PLACE[: len(few), None]).sum(axis=0, dtype=np.uint64)
        keys = np.concatenate([keys, _mix(more + np.arange(BANDS, 2 * BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))])
    return keys.view(np.int64), ((best * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def alignment(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Matched over all shingles in the best order-keeping alignment inside the band; 0 when below ``least``.

    A pair that reaches ``least`` has at most (1 - least) / (1 + least) of its shingles unmatched, so no match lies
    further than that off the diagonal.  Labels are unique on each side, but for those that fell together when they were
    cut to 32 bits, of which the first counts; so the best alignment is a longest increasing run of positions.
    """
    n = len(a) + len(b)
    need = least / (1 + least) * n - 1e-9
    if min(len(a), len(b)) < need:
        return 0.0
    _, i, j = np.intersect1d(a, b, return_indices=True)
    if len(i) < need:
        return 0.0
    near = np.abs(i - j) <= int(n - 2 * need) + 1
    i, j = i[near], j[near]
    tails: list[int] = []
    for v in j[np.argsort(i, kind="stable")].tolist():
        at = bisect.bisect_left(tails, v)
        if at == len(tails):
            tails.append(v)
        else:
            tails[at] = v
    return len(tails) / (n - len(tails)) if len(tails) >= need else 0.0


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per input row: ``at`` (its number once written), ``id``, ``raw`` (MD5 of the text), ``content`` (hash of the
    word sequence), ``keys``, ``signature`` and ``shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                found = words(text)
                x = shingles(found)
                keys, signature = sketch(x) if len(x) else (np.zeros(0, np.int64), b"")
                rows.append((hashlib.blake2b(" ".join(found).encode(), digest_size=16).digest(), keys.tolist(), signature, x.astype(np.uint32).tobytes()))
            content, keys, signature, x = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(content, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(signature, pa.binary()), pa.array(x, pa.binary())],
                names=["id", "raw", "content", "keys", "signature", "shingles"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("id"), raw_key(text_col).alias("raw"), F.col(text_col))
    return map_batches(rows, run, "id long, raw binary, content binary, keys array<long>, signature binary, shingles binary").withColumn("at", F.monotonically_increasing_id())


def raw_key(text_col: str) -> Column:
    """What tells rows of one id apart: the MD5 of their text."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def verify(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of row numbers whose alignment reaches the similarity."""
    side = lambda c: sketched.select(F.col("at").alias(c), F.col("shingles").alias(f"shingles_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [alignment(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) >= SIMILARITY for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "shingles_a", "shingles_b")
    return materialise(map_batches(joined, run, "a long, b long"), "near-links")


def connect(groups: DataFrame) -> DataFrame:
    """Links between documents of different components of a cluster, one for each document and component at most.

    ``groups``: one row per block pair of a cluster, ``rest`` and ``members`` being arrays of bounded size of (at,
    component, signature, shingles).  Pairs whose signatures agree often enough are aligned, the most similar first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("at", "component", "signature", "shingles")
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                rest, members = ([tuple(x[f] for f in fields) for x in batch.column(c)[i].as_py()] for c in (0, 1))
                if not rest or not members:
                    continue
                ids, parts, signatures, found = zip(*members, strict=True)
                parts = np.array(parts)
                signatures = np.frombuffer(b"".join(signatures), np.uint8).reshape(len(ids), SLOTS)
                for one, component, signature, x in rest:
                    same = (signatures == np.frombuffer(signature, np.uint8)).mean(axis=1)
                    near = np.flatnonzero((same >= SCREEN) & (parts != component))
                    linked = set()
                    for j in near[np.argsort(-same[near], kind="stable")].tolist():
                        if parts[j] not in linked and alignment(np.frombuffer(x, np.uint32), np.frombuffer(found[j], np.uint32)) >= SIMILARITY:
                            linked.add(parts[j])
                            a.append(min(one, ids[j]))
                            b.append(max(one, ids[j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    with batch_rows(groups.sparkSession, 4):
        return materialise(groups.mapInArrow(run, "a long, b long"), "near-more")


def block_pairs(cluster: DataFrame) -> DataFrame:
    """One row per pair of blocks of a cluster, ``rest`` and ``members`` being arrays of bounded size.

    ``cluster``: ``head``, ``at``, ``component``, ``signature``, ``shingles``, ``bytes`` and ``other`` (not of the
    head's component).  The pairs are dealt by cluster and both blocks, stated explicitly: the join that brings the
    numbers of blocks leaves all rows of a cluster in one task, and a grouping would be content with that.
    """
    blocks_of = lambda rows, size: F.greatest(F.lit(1), F.ceil(rows / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")
    sizes = cluster.groupBy("head").agg(
        blocks_of(F.count("*"), F.sum("bytes")).alias("n_m"), blocks_of(F.count_if("other"), F.sum(F.when(F.col("other"), F.col("bytes")))).alias("n_r")
    )
    spread = cluster.join(sizes, "head").withColumn("entry", F.struct("at", "component", "signature", "shingles"))
    own = lambda n: F.pmod(F.xxhash64("at"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = spread.where("other").select("head", own("n_r").alias("r"), "n_m", "entry").select("head", "r", every("n_m").alias("m"), F.col("entry").alias("rest"))
    others = spread.select("head", own("n_m").alias("m"), "n_r", "entry").select("head", every("n_r").alias("r"), "m", F.col("entry").alias("member"))
    dealt = rest.unionByName(others, allowMissingColumns=True).repartition("head", "r", "m")
    return dealt.groupBy("head", "r", "m").agg(F.collect_list("rest").alias("rest"), F.collect_list("member").alias("members")).select("rest", "members")


def classes_of_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``raw``, ``class_id``, ``keep_id`` and ``keep_raw`` (the row of the class that stays) of every row."""
    sketched = materialise(sketches(df, id_col, text_col), "near-sketches")
    row = F.struct(F.col("id").isNull().alias("lost"), "id", "raw")
    texts = materialise(sketched.groupBy("content").agg(F.min("at").alias("at"), F.min(row).alias("first")), "near-texts")
    one_each = sketched.join(texts.select("at"), "at", "left_semi")
    bands = one_each.select("at", F.explode("keys").alias("key"))
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = materialise(bands.join(sizes, "key"), "near-members")

    company = members.groupBy("at").agg(F.sum("size").alias("company"))
    ranked = members.join(company, "at")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("company", (-F.col("at")).alias("at"))).alias("top")).select("key", (-F.col("top.at")).alias("leader"))
    led = materialise(ranked.join(leaders, "key").select("key", "at", "leader", "size"), "near-led")
    first = led.where("at <> leader").select(F.least("at", "leader").alias("a"), F.greatest("at", "leader").alias("b")).distinct()
    links = verify(first, sketched)

    labels = components(links, "near-components").withColumnRenamed("id", "at")
    labelled = led.where("size > 2").join(labels, "at", "left").withColumn("component", F.coalesce("component", "at"))
    heads = labelled.groupBy("key").agg(F.max(F.when(F.col("at") == F.col("leader"), F.col("component"))).alias("head"), F.min("component").alias("low"), F.max("component").alias("high"))
    apart = labelled.join(heads.where("low <> high").select("key", "head"), "key").select("head", "at", "component").distinct()
    data = sketched.select("at", "signature", "shingles")
    cluster = materialise(apart.join(data, "at").withColumn("bytes", F.octet_length("shingles")).withColumn("other", F.col("component") != F.col("head")), "near-apart")
    more = connect(block_pairs(cluster))

    classes = components(links.unionByName(more), "near-classes").withColumnRenamed("id", "at")
    known = texts.join(classes, "at", "left").withColumn("component", F.coalesce("component", "at"))
    kept = known.groupBy("component").agg(F.min("first").alias("keep"))
    by_text = known.join(kept, "component").select("content", F.col("keep.id").alias("keep_id"), F.col("keep.raw").alias("keep_raw"))
    return sketched.select("id", "raw", "content").join(by_text, "content").select("id", "raw", "keep_id", "keep_raw")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``class_id``, the smallest id in its class, and ``kept``: this row's text stays.  Ids are longs.

    Classes are the connected components of links between texts at a similarity of 0.8 or more.  Of a class the row
    with the smallest id stays, and of several texts with that id the one of smallest MD5.

    1. Rows with equal word sequences are one text, whatever their ids.  From here on a text goes by the number of one
       of its rows, so rows with a null id, and different texts under one id, are treated as any others.
    2. A bucket holds the texts that agree in a band.  Its leader is the member with the most company in all its
       buckets; every other member is verified against it.  So a group of copies, however large, costs a pair per
       member and band at most, and no pairs within it are made.
    3. What leaders did not connect is compared with all of other components in the buckets that one component leads:
       in blocks of bounded size, by signature, then by alignment, and without making rows of pairs.  No pair that
       shares a band goes unexamined.  In a cluster of m members of which r are outside its head's component that is
       r times m signature comparisons, dealt evenly by pairs of blocks.

    Null and empty texts and texts without words have no shingle; they are one text.  Very long texts are sketched in
    steps of bounded memory.  Repeated rows are each returned, with the same decision.  A null id comes after all
    others: it is the class id only where the class has no other.  An empty table gives an empty result; other columns
    are not read.
    """
    rows = classes_of_rows(df, id_col, text_col)
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("raw") == F.col("keep_raw"))
    return rows.select(F.col("id").alias(id_col), F.col("keep_id").alias("class_id"), same.alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, whole: the one that ``near_duplicates`` keeps, of repeated equal rows one.

    A row is known by its id and its text together, so different texts under one id, or without id, each stay unless
    they are near each other.  Null and empty texts are one text; very long ones are compared whole; an empty table stays
    empty; other columns come through as they are, whatever their names.
    """
    keep = classes_of_rows(df, id_col, text_col).select("keep_id", "keep_raw").distinct()
    rows = df.select(F.struct(*df.columns).alias("row"), raw_key(text_col).alias("raw"), F.col(id_col).cast("long").alias("id"))
    stay = rows.join(keep, (F.col("raw") == F.col("keep_raw")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
    return stay.dropDuplicates(["raw", "id"]).select(*[F.col("row")[c].alias(c) for c in df.columns])
