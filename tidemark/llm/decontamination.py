"""Benchmark decontamination with suffix arrays of the training documents.

Documents are taken in shards of about ``SHARD_BYTES`` of text.  A shard's suffix array sorts the word positions that
can begin a match (as many benchmark words in a row as the shortest window has) by the words that follow; every benchmark
suffix is then looked up in it by binary search, which gives all places where its window occurs.  Windows that follow
each other on both sides are joined into longest verbatim matches.  The benchmark lies in the shared folder in blocks of
bounded size, which tasks read; it does not pass through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filesystem, map_batches, shared_dir, worker_cache

WINDOW = 10
#: Bytes of benchmark text that a task holds at once; larger benchmarks are searched block by block.
BLOCK_BYTES = 16 << 20
#: Bytes of document text that one suffix array is made of, so a block is read and searched once for so many.
SHARD_BYTES = 32 << 20
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z, as a byte map: what is no word byte becomes a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class Benchmark:
    """The suffixes of a block of items: for each distinct window its key and the items that have it, and where."""

    def __init__(self, items: list[tuple[str, str | None]]):
        self.ids: dict[bytes, int] = {}
        self.names: list[str] = []
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for name, text in items:
            coded = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            if coded:
                self.names.append(str(name))
                size = min(WINDOW, len(coded))
                for at in range(len(coded) - size + 1):
                    found.setdefault(tuple(coded[at : at + size]), []).append((len(self.names) - 1, at))
        self.windows = list(found)
        self.places: list[dict[int, dict[int, None]]] = []  # of each window by item, in order
        for hits in found.values():
            by_item: dict[int, dict[int, None]] = {}
            for item, at in hits:
                by_item.setdefault(item, {})[at] = None
            self.places.append(by_item)
        self.sizes = np.array([len(w) for w in self.windows], np.int64)
        self.shortest = int(self.sizes.min()) if len(self.sizes) else 0
        ids = np.zeros((len(self.windows), WINDOW), ">u4")
        for i, w in enumerate(self.windows):
            ids[i, : len(w)] = w
        self.low = _keys(ids.copy())
        ids[ids == 0] = 0xFFFFFFFF
        self.high = _keys(ids)

    def matches(self, docs: list[np.ndarray]) -> list[list[tuple[int, int, int, int]]]:
        """Per document the longest matches: (item, start in the document, start in the item, words)."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in docs]
        if not docs or not self.windows:
            return out
        text = np.concatenate([x for d in docs for x in (d, np.zeros(1, np.uint32))])  # a 0 between documents
        ends = np.cumsum([len(d) + 1 for d in docs])
        gaps = np.flatnonzero(text == 0)
        run = gaps[np.searchsorted(gaps, np.arange(len(text)))] - np.arange(len(text))  # benchmark words in a row from here
        starts = np.flatnonzero(run >= self.shortest)
        if not len(starts):
            return out
        padded = np.r_[text, np.zeros(WINDOW, np.uint32)]
        following = padded[starts[:, None] + np.arange(WINDOW)]
        following[np.arange(WINDOW) >= run[starts][:, None]] = 0
        keys = _keys(following.astype(">u4"))
        order = np.argsort(keys, kind="stable")  # the suffix array
        keys = keys[order]
        low, high = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        hits = [(item, at, w) for w in np.flatnonzero(high > low).tolist() for at in starts[order[low[w] : high[w]]].tolist() for item in self.places[w]]
        hits.sort()
        joined: list[list[int]] = []
        for item, at, w in hits:
            last, places, size = joined[-1] if joined else None, self.places[w][item], int(self.sizes[w])
            # on with the match that ends a word before, where the item goes on as well
            if last and last[0] == item and size == WINDOW and last[1] + last[3] == at + WINDOW - 1 and last[2] + last[3] - WINDOW + 1 in places:
                last[3] += 1
            else:
                joined.append([item, at, next(iter(places)), size])
        for item, at, place, size in joined:
            d = int(np.searchsorted(ends, at, "right"))
            out[d].append((item, at - (int(ends[d - 1]) if d else 0), place, size))
        return out


def _keys(ids: np.ndarray) -> np.ndarray:
    """Rows of big-endian ids as byte strings, which sort as the rows do."""
    return np.ascontiguousarray(ids).view(f"S{4 * WINDOW}").ravel()


class Blocks:
    """The benchmark in the shared folder, as blocks of bounded size that tasks read."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, block_bytes: int):
        total = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        self.n = math.ceil(total / block_bytes) or 1
        self.folder = shared_dir(items.sparkSession, "benchmark")
        rows = items.where(F.col(id_col).isNotNull() & (F.octet_length(text_col) > 0))
        rows = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col).cast("string")), self.n).alias("block"))
        rows.repartition(min(self.n, 1000), "block").write.partitionBy("block").parquet(self.folder)

    def read(self, block: int) -> Benchmark:
        """A block's windows; of a benchmark of one block a worker keeps them between its tasks."""
        if self.n == 1:
            return worker_cache(("benchmark", self.folder), lambda: self._load(0))
        return self._load(block)

    def _load(self, block: int) -> Benchmark:
        fs, root = filesystem(f"{self.folder}/block={block}")
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        tables = [pq.read_table(f.path, filesystem=fs, partitioning=None) for f in found if f.path.endswith(".parquet")]
        return Benchmark(sorted(pair for t in tables for pair in zip(t["id"].to_pylist(), t["text"].to_pylist(), strict=True)))

    def search(self, texts: list[pa.Array]) -> tuple[list[list[dict]], list[int]]:
        """Of each text in the arrays its matches and its number of words."""
        found = [words(t) for column in texts for t in column.to_pylist()]
        matches: list[list[dict]] = [[] for _ in found]
        for block in range(self.n):
            benchmark = self.read(block)
            code = benchmark.ids.get
            coded = [np.fromiter((code(w, 0) for w in ws), np.uint32, len(ws)) for ws in found]
            for have, new in zip(matches, benchmark.matches(coded), strict=True):
                have += [{"item_id": benchmark.names[i], "start": s, "item_start": p, "words": n} for i, s, p, n in new]
        return matches, [len(ws) for ws in found]


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The batches in lists of about ``SHARD_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SHARD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_matches(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: the id, ``n_words`` and ``matches``, an array of (``item_id``, ``start``, ``item_start``, ``words``).

    One map-only pass over the rows.  Of an item that holds a window at several places the match that goes on is
    followed, else the first place.  Null and empty texts have no words and no match; very long texts are searched
    whole; repeated rows and items are searched each; items without words or with a null id match nothing; with an empty
    table either way there is no match; other columns are not read.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("words", pa.int64())]))
    blocks = Blocks(items, item_id, item_text, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            matches, n_words = blocks.search([b.column(1) for b in shard])
            at = 0
            for b in shard:
                stop = at + b.num_rows
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words[at:stop], pa.int64()), pa.array(matches[at:stop], kind)], names=[id_col, "n_words", "matches"])
                at = stop

    return map_batches(df.select(id_col, text_col), run, f"`{id_col}` {id_type}, n_words long, matches array<struct<item_id:string,start:long,item_start:long,words:long>>")


def contamination(df: DataFrame, items: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_hit`` (words inside a match), ``n_items``, ``items_sha256``, ``contaminated``."""
    found = find_matches(df, items, id_col, **names)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, counts, digests = [], [], []
            for matches in batch.column(2).to_pylist():
                hit = reach = 0
                for start, stop in sorted((m["start"], m["start"] + m["words"]) for m in matches):
                    hit += max(0, stop - max(start, reach))
                    reach = max(reach, stop)
                items = sorted({m["item_id"] for m in matches})
                hits.append(hit)
                counts.append(len(items))
                digests.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array([h > 0 for h in hits], pa.bool_())],
                names=[id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return map_batches(found, run, f"`{id_col}` {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def drop_contaminated(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, whole, in whose text no window of any item occurs.

    A null or empty text has no words and stays; very long texts are searched whole; repeated rows and rows without id are
    judged each; an empty table stays empty, and without items all rows stay; other columns come through as they are.
    """
    at, blocks = df.columns.index(text_col), Blocks(items, item_id, item_text, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            matches, _ = blocks.search([b.column(at) for b in shard])
            clean = pa.array([not m for m in matches], pa.bool_())
            done = 0
            for b in shard:
                yield b.filter(clean.slice(done, b.num_rows))
                done += b.num_rows

    return map_batches(df, run, df.schema)
