"""Toxicity by compression distance.

Two zstandard dictionaries of equal size are trained, one on toxic and one on ordinary text, by the same cover of byte
strings: each holds segments of its own class that lean to it, and common words of all text that lean to neither.  Every
window of three words, which shares a word with the next, is compressed with either; none is skipped.  Its margin is by how
many bytes the toxic dictionary does better.  A document's score is a calibrated function of how many windows pass each
margin threshold.  Dictionaries and calibration come from different documents.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, materialise, release, worker_cache

TRAIN_ROWS = 20_000  # bound of the labelled sample: the labelled ids of lowest hash
#: One labelled document in so many calibrates; the others make the dictionaries.
CALIBRATE_ONE_IN = 4
GRAM = 7  # bytes of the strings whose document frequencies are compared, besides whole words that are shorter
#: A gram leans to toxic text when it is in so many of its documents, so many times as often as in the other class, and by
#: a likelihood ratio that none of as many grams as there are would reach by chance.  Nothing sets ordinary text apart as
#: much, so all grams that are more frequent in it lean to it, the likeliest first, and as many bytes are taken.
LEAST_DOCS, LEAST_RATIO = 4, 3.0
LEAST_MATCH = 5  # bytes of the shortest match that compression takes
#: Bytes of a dictionary: segments of its class, and common words.
OWN_BYTES, COMMON_BYTES = 2048, 2048
#: Bounds of what the fit collects, the leaning grams of highest ratio and the segments in most documents: many times what a
#: dictionary can hold.
MOST_GRAMS, MOST_SEGMENTS = 50_000, 20_000
MOST_HELD = 100_000  # strings that a task counts at a time; the sums of what it tells are the same
#: Longer runs of word characters, as in scripts without spaces, are taken as overlapping words of so many characters.
WORD_CHARS, WORD_STEP = 24, 16
WINDOW_WORDS, WINDOW_STEP = 3, 2
#: Windows compressed in a lot; texts whose features a worker remembers, since corpora hold copies.
WINDOWS_AT_ONCE, TEXTS_KEPT = 4096, 20_000
THRESHOLDS = range(2, 9)
#: Both dictionaries end with these, and each window stands between them: zstd finds no match in the last bytes of
#: its input and stores very short inputs raw, and what both sides share cancels out of the margin.
BEFORE, AFTER = b"0123456789abcdef|", b"|ZYXWVUTSRQPONMLK"
WORD = re.compile(r"\w+")
SHORT_WORD = re.compile(rb"(?=( [^ ]{2,%d} ))" % (GRAM - 3))


def words(text: str | None) -> list[str]:
    out, found = [], WORD.findall((text or "").lower())
    if max(map(len, found), default=0) <= WORD_CHARS:
        return found
    for w in found:
        if len(w) <= WORD_CHARS:
            out.append(w)
        else:
            out += [w[i : i + WORD_CHARS] for i in range(0, len(w) - WORD_CHARS + WORD_STEP, WORD_STEP)]
    return out


def windows(text: str | None) -> list[str]:
    """Runs of ``WINDOW_WORDS`` words, every ``WINDOW_STEP``, the last one as long as there are words."""
    found = words(text)
    out = [f" {a} {b} {c} " for a, b, c in zip(found[::2], found[1::2], found[2::2], strict=False)]
    if len(found) % WINDOW_STEP == 0 or len(found) == 1:
        out += [f" {' '.join(found[-2:])} "] if found else []
    return out


def plain(text: str | None) -> bytes:
    """The words in UTF-8, a space around each: what grams and segments are taken from."""
    return f" {' '.join(WORD.findall((text or '').lower()))} ".encode()


def grams(data: bytes) -> set[bytes]:
    return {data[i : i + GRAM] for i in range(len(data) - GRAM + 1)} | set(SHORT_WORD.findall(data))


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: list[float]

    def scorer(self) -> Scorer:
        """The worker's scorer of this model, kept between tasks."""
        key = hashlib.md5(b"|".join([self.toxic, self.ordinary, repr(self.weights).encode()])).digest()
        return worker_cache(("toxicity", key), lambda: Scorer(self))


class Scorer:
    def __init__(self, model: ToxicityModel):
        self.weights = np.array(model.weights)
        self.toxic, self.ordinary = self._compressor(model.toxic), self._compressor(model.ordinary)
        self.known: dict[bytes, list[float]] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY2, min_match=LEAST_MATCH, window_log=17, hash_log=15, chain_log=15, search_log=5, target_length=8,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        trained = zstandard.ZstdCompressionDict(content + AFTER + b"#" + BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        trained.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=trained, compression_params=how)

    def margins(self, text: str | None) -> Counter:
        """How many windows of ``text`` have which margin; all are compressed, in lots."""
        found, out = windows(text), Counter()
        for at in range(0, len(found), WINDOWS_AT_ONCE):
            raw = [BEFORE + w.encode() + AFTER for w in found[at : at + WINDOWS_AT_ONCE]]
            toxic, ordinary = self.toxic.multi_compress_to_buffer(raw), self.ordinary.multi_compress_to_buffer(raw)
            out.update(map(operator.sub, map(len, ordinary), map(len, toxic)))
        return out

    def features(self, text: str | None) -> list[float]:
        """How many windows pass each threshold, by number and by share, the mean margin and the length."""
        key = hashlib.md5((text or "").encode()).digest()
        if key not in self.known:
            if len(self.known) >= TEXTS_KEPT:
                self.known.clear()
            self.known[key] = self._features(self.margins(text))
        return self.known[key]

    @staticmethod
    def _features(found: Counter) -> list[float]:
        n = max(1, found.total())
        over = [sum(c for m, c in found.items() if m >= t) for t in THRESHOLDS]
        return [1.0, *map(math.log1p, over), *(math.log1p(1000 * x / n) for x in over), sum(m * c for m, c in found.items()) / n, math.log1p(n)]

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def held_out(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _sample(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """``id_col``, ``__y`` and ``__fit`` (it makes dictionaries, not the calibration) of at most ``rows`` labelled ids."""
    ids = labels.where(~held_out(id_col) & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("__y"))
    place, n = F.pmod(F.xxhash64(id_col), 1 << 30), ids.count()
    few = ids.where(place < (2 * rows << 30) // n) if n > 2 * rows else ids  # so that few rows meet for the last choice
    return few.orderBy(place, id_col).limit(rows).withColumn("__fit", F.pmod(F.xxhash64(id_col, F.lit(1)), CALIBRATE_ONE_IN) > 0)


def _count(make):
    """A batch function that sums per task in how many documents of either class each byte string occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        counts: dict[tuple[str, bytes], list[int]] = {}

        def told() -> pa.RecordBatch:
            kinds, strings = zip(*counts, strict=True)
            out = pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(strings, pa.binary()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))], names=["kind", "string", "n0", "n1"])
            counts.clear()
            return out

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for key in make(y, text):
                    counts.setdefault(key, [0, 0])[y] += 1
                if len(counts) > MOST_HELD:
                    yield told()
        if counts:
            yield told()

    return run


def _gram_codes(text: str | None) -> np.ndarray:
    """``grams`` of the text as numbers: their bytes, the first one lowest; a text has no zero byte."""
    data = plain(text)
    at = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(at) - GRAM + 1
    long = sum((at[i : n + i] << np.uint64(8 * i) for i in range(1, GRAM)), at[:n].copy()) if n > 0 else at[:0]
    short = np.array([int.from_bytes(w, "little") for w in set(SHORT_WORD.findall(data))], np.uint64)
    return np.concatenate([np.unique(long), short])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_count`` of all grams, by sorting numbers."""
    release()
    held: list[list[np.ndarray]] = [[], []]

    def told() -> Iterator[pa.RecordBatch]:
        for y in (0, 1):
            if held[y]:
                codes, n = np.unique(np.concatenate(held[y]), return_counts=True)
                mine, none = pa.array(n.astype(np.int64)), pa.array(np.zeros(len(n), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(["g"] * len(n)), pa.array(codes.astype("<u8").view("S8").tolist(), pa.binary()), none if y else mine, mine if y else none], names=["kind", "string", "n0", "n1"])
                held[y].clear()

    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[y].append(_gram_codes(text))
        if sum(map(len, held[0])) + sum(map(len, held[1])) > 3 * MOST_HELD:
            yield from told()
    yield from told()


COUNTS = "kind string, string binary, n0 long, n1 long"


def _leaning(counted: DataFrame, sizes: list[int], own: int, times: float, least: float) -> dict[bytes, float]:
    """The grams that are ``times`` as frequent in class ``own``, with likelihood ratios of ``least`` or more; tested where
    they are, not on the driver."""
    a, b, n_a, n_b = F.col(f"n{own}"), F.col(f"n{1 - own}"), float(sizes[own]), float(sizes[1 - own])
    part = lambda k, n: F.when(k > 0, k * F.log(k / n)).otherwise(0.0) + F.when(k < n, (n - k) * F.log(1 - k / n)).otherwise(0.0)
    both = a + b
    ratio = 2 * (part(a, F.lit(n_a)) + part(b, F.lit(n_b)) - part(both, F.lit(n_a + n_b)))
    chosen = counted.where((a >= LEAST_DOCS) & (a / n_a > times * b / n_b)).select("string", ratio.alias("ratio")).where(F.col("ratio") >= least)
    return {bytes(r.string): r.ratio for r in chosen.orderBy(F.desc("ratio"), "string").limit(MOST_GRAMS).collect()}


def segments(data: bytes, leaning: dict[bytes, float]) -> set[bytes]:
    """The longest stretches of ``data`` that leaning grams cover."""
    out, start, end = set(), None, 0
    found = [(i, i + GRAM) for i in range(len(data) - GRAM + 1) if data[i : i + GRAM] in leaning]
    found += [m.span(1) for m in SHORT_WORD.finditer(data) if m[1] in leaning]
    for i, stop in sorted(found):
        if start is None or i > end:
            if start is not None:
                out.add(data[start:end])
            start = i
        end = max(end, stop)
    if start is not None:
        out.add(data[start:end])
    return out


def cover(candidates: list[bytes], leaning: dict[bytes, float], size: int = OWN_BYTES) -> bytes:
    """Segments chosen one by one, each the one with most leaning not yet covered for its length; the best stand last,
    where a match costs least."""
    covered: set[bytes] = set()
    worth = lambda g: sum(leaning.get(x, 0.0) for x in grams(g) - covered) / len(g)
    heap = [(-worth(g), g) for g in set(candidates)]
    heapq.heapify(heap)
    chosen, total = [], 0
    while heap and total < size:
        said, g = heapq.heappop(heap)
        now = worth(g)
        if now <= 0:
            continue
        if now < -said:
            heapq.heappush(heap, (-now, g))
            continue
        chosen.append(g)
        total += len(g)
        covered |= grams(g)
    return b"".join(chosen[::-1])


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learn from at most ``rows`` labelled documents that are not held out.

    The sample's ids are broadcast (their number is the bound), so texts are not shuffled.  Frequencies are counted per
    task and summed by byte string; what reaches the driver is what leans, candidate segments, common words and the
    calibration features, each bounded.  Where the calibrating documents are of one class only, all of the sample
    calibrate; where the sample is of one class or empty, the score is constant.
    """
    chosen = materialise(df.select(id_col, text_col).join(F.broadcast(_sample(labels, id_col, label_col, rows)), id_col).select("__y", text_col, "__fit"), "toxicity-sample")
    shares = {(r["__fit"], r["__y"]): r["count"] for r in chosen.groupBy("__fit", "__y").count().collect()}
    sizes = [shares.get((True, y), 0) for y in (0, 1)]
    there = [any(shares.get((f, y), 0) for f in (True, False)) for y in (0, 1)]
    n_weights = 2 * len(THRESHOLDS) + 3
    if not all(there):
        return ToxicityModel(b"", b"", [30.0 if there[1] else -30.0, *[0.0] * (n_weights - 1)])
    fit = chosen.where("__fit").select("__y", text_col)
    leaning: list[dict[bytes, float]] = [{}, {}]
    if all(sizes):
        counted = materialise(map_batches(fit, _count_grams, COUNTS).groupBy("string").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxicity-grams")
        leaning = [_leaning(counted, sizes, 0, 1.0, 0.0), _leaning(counted, sizes, 1, LEAST_RATIO, 2 * math.log(max(2, counted.count())))]

    def parts(y: int, text: str | None) -> Iterator[tuple[str, bytes]]:
        data = plain(text)
        yield from (("w", w) for w in set(data.split()))
        yield from (("s", g) for g in segments(data, leaning[y]))

    found = materialise(map_batches(fit, _count(parts), COUNTS).groupBy("kind", "string").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxicity-segments")
    top = lambda kind, n, least, limit: [bytes(r.string) for r in found.where((F.col("kind") == kind) & (n >= least)).orderBy(n.desc(), "string").limit(limit).collect()]
    common, size = [], 0
    for w in top("w", F.col("n0") + F.col("n1"), LEAST_DOCS, COMMON_BYTES):
        if size >= COMMON_BYTES:
            break
        if not any(g in side for g in grams(b" %b " % w) for side in leaning):
            common.append(w)
            size += len(w) + 1
    base = b" ".join([b"", *common[::-1], b""])
    ordinary, toxic = (cover(top("s", F.col(f"n{y}"), 1, MOST_SEGMENTS), leaning[y]) for y in (0, 1))
    equal = min(len(ordinary), len(toxic))  # the best stand last
    model = ToxicityModel(toxic[len(toxic) - equal :] + base, ordinary[len(ordinary) - equal :] + base, [0.0] * n_weights)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.features(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))], names=["y", "x"])

    apart = all(shares.get((False, y), 0) for y in (0, 1))
    seen = map_batches((chosen.where("NOT __fit") if apart else chosen).select("__y", text_col), features, "y int, x array<double>").toPandas()
    model.weights = _logistic(np.array(seen["x"].tolist()), seen["y"].to_numpy()).tolist()
    return model


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the intercept, column 0, is not penalised."""
    w = np.zeros(x.shape[1])
    ridge = l2 * np.r_[1e-6, np.ones(len(w) - 1)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Map-only, whole texts: every word is in a window, whatever the length of word or text.  Null and empty texts have no
    window and get the score of that; a null id is not held out; repeated rows are scored each; an empty table gives an
    empty result; no other column is read.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            scores = [scorer.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=[id_col, "held_out", "score", "predicted"])

    rows = df.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), text_col)
    return map_batches(rows, run, f"`{id_col}` {id_type}, held_out boolean, score double, predicted int")


def drop_toxic(df: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows, whole, whose text is not predicted toxic.

    Null, empty and very long texts are judged as ``score`` judges them; repeated rows and rows without id each by their
    own text; an empty table stays empty; other columns, whatever their names, come through as they are.
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, at = model.scorer(), names.index(text_col)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return map_batches(df, run, df.schema)
