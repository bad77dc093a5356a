"""Near-duplicates by SimHash; pairs within the radius are found by covering locality-sensitive hashing.

Bit positions are labelled with nonzero vectors of ``RADIUS + 1`` bits, in turn; every nonzero vector v gives a table
whose key is the fingerprint at the positions whose label has an odd product with v.  The labels of any ``RADIUS``
positions leave a vector orthogonal to them all, so two fingerprints that differ nowhere else agree in that table's key:
no pair is missed.  A bucket of many different fingerprints is covered again, on the positions that its key leaves
out; after three such rounds a bucket has at most 32 of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, materialise
from tidemark.llm.graph import components

BITS, RADIUS, WORDS, SEED = 64, 2, 3, 42
#: A bucket of more different fingerprints than this is covered again.
MOST = 64
#: Unless so few positions are left that it has at most 32.
FEW = 5
#: Shingles of a text whose bits are counted at once.
STEP = 1 << 14


def fingerprint(text: str | None) -> int:
    """SimHash of the three-word shingles of ``text``, repeats included, letters A to Z in lower case.

    Fewer words make one shingle; without words (null, empty, white space) it is zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes, both work on ASCII only
    if not words:
        return 0
    n = max(1, len(words) - WORDS + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        part = words[at : min(at + STEP, n) + WORDS - 1]
        joined = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = np.r_[0, ends[:-1] + 1]
        cut = zip(starts.tolist(), ends[WORDS - 1 :].tolist() or [len(joined)], strict=False)
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in cut], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as a signed long) of every row, from its whole text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    return map_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), each, "id long, fp long")


def covering(positions: list[int], radius: int) -> list[int]:
    """Masks over ``positions`` such that any ``radius`` of them lie outside one of the masks."""
    vectors = range(1, 1 << (radius + 1))
    label = {p: vectors[i % len(vectors)] for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (label[p] & v).bit_count() % 2) for v in vectors]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(points: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """Links (``a``, ``b``) between the different fingerprints ``fp`` of ``points`` at ``radius`` or fewer bits.

    A fingerprint goes to one bucket per table: seven for a radius of two.  Buckets of at most ``most`` are compared
    inside, larger ones are dealt out again by more bits, so no task compares all pairs of a large group, and none is cut.
    """
    spark = points.sparkSession
    level = points.select("fp", F.lit(0).cast("long").alias("mask"))
    masks, found = [0], None
    while True:
        finer = {m: [m | c for c in covering([p for p in range(BITS) if not m >> p & 1], radius)] for m in masks}
        tables = spark.createDataFrame([(_signed(m), [_signed(c) for c in under]) for m, under in finer.items()], "mask long, under array<long>")  # 7 to the power of the round
        keys = level.join(F.broadcast(tables), "mask").select("fp", F.explode("under").alias("mask"))
        keys = keys.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        keys = keys.distinct() if found is not None else keys  # two tables may be refined to the same one
        sizes = materialise(keys.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
        large = (F.col("n") > most) & (F.bit_count("mask") < BITS - max(FEW, 1 << radius))
        small = keys.join(sizes.where(~large), ["mask", "key"]).groupBy("mask", "key").agg(F.collect_list("fp").alias("held"))
        apart = f"held, a -> transform(filter(held, b -> b > a AND bit_count(a ^ b) <= {radius}), b -> named_struct('a', a, 'b', b))"
        pairs = small.select(F.explode(F.expr(f"flatten(transform({apart}))")).alias("link")).select("link.*")
        found = pairs if found is None else found.unionByName(pairs)
        if sizes.where(large).isEmpty():
            return found.distinct()
        level = materialise(keys.join(sizes.where(large), ["mask", "key"]).select("fp", "mask"), "simhash-large")
        masks = sorted({c for under in finer.values() for c in under})


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that is reachable.

    Rows with one fingerprint are one node, so copies make no pairs.  A null text counts as empty; a text without
    words has the fingerprint zero and is linked like any other; very long texts are hashed whole, in steps.  Rows that
    repeat an id are rows of their own; a row without id is linked, but gives no component its name, so a component of
    only such rows has a null ``component_id``.  An empty table gives no rows; other columns are not read.
    """
    seen = materialise(fingerprints(df, id_col, text_col), "simhash")
    points = materialise(seen.groupBy("fp").agg(F.min("id").alias("first")), "simhash-points")
    linked = components(links(points.select("fp"))).select(F.col("id").alias("fp"), "component")
    named = points.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "component").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return seen.join(classes, "fp").select(F.col("id").alias(id_col), hexed, "component_id")
