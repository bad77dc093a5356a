"""Token-id shards with a minimal perfect hash index.

A shard is two files.  ``.ids`` holds raw little-endian ids, one document after the other in ascending key order.
``.mph`` holds, for the shard's distinct keys, a minimal perfect hash function (levels of bit arrays: a key sits at
the first level where no other remaining key has its bit; its slot is the rank of that bit) and, by slot, a 32-bit
fingerprint and the run of entries with that key; an entry is an offset into ``.ids``.  A keyed read costs a few hashes, a fingerprint
comparison and one ranged read.  Shards hold at most ``SHARD_IDS`` ids.  Their manifest, a small table, is written
last, so files of failed or repeated task attempts are never read.
"""

from __future__ import annotations

import io
import itertools
import json
import os
import string
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import filesystem, map_batches, shared_dir, worker_cache

SHARD_IDS = 1 << 26
TEXT_BYTES = 8 << 20  # texts that are encoded at once
GAMMA, LEVELS = 2.0, 40
PUNCTUATION = string.punctuation.replace("'", "")
MANIFEST = "shard string, part int, roll int, n_docs long, n_tokens long, min_key long, max_key long"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer of keys and a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """A minimal perfect hash function of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.cumsum(bits, dtype=np.int64) - bits)
            total += int(bits.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while len(rest):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            at = (mix(rest, len(levels)) % np.uint64(max(64, int(GAMMA * len(rest))))).astype(np.int64)
            alone = np.bincount(at, minlength=max(64, int(GAMMA * len(rest)))) == 1
            levels.append(alone.astype(np.uint8))
            rest = rest[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key not in the set gets -1 or some slot, which its fingerprint then rejects."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mix(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


class ShardWriter:
    def __init__(self, folder: str, part: int, roll: int, width: int):
        self.fs, self.root = filesystem(folder)
        self.name, self.part, self.roll, self.width = f"{part:06d}-{roll:04d}-{uuid.uuid4().hex}", part, roll, width
        self.out = self.fs.open_output_stream(f"{self.root}/{self.name}.ids")
        self.keys: list[int | None] = []
        self.ends: list[int] = []
        self.n = 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.n += len(ids) // self.width
        self.keys.append(key)
        self.ends.append(self.n)

    def close(self) -> tuple:
        self.out.close()
        nulls = sum(k is None for k in self.keys)
        keys = np.array(self.keys[nulls:], np.int64)
        distinct, first, runs = np.unique(keys, return_index=True, return_counts=True)
        function = PerfectHash.build(distinct)
        slots = function.slots(distinct)
        prints, starts, lengths, by_slot = (np.zeros(len(distinct), t) for t in (np.uint32, np.int64, np.int64, np.int64))
        prints[slots], starts[slots], lengths[slots], by_slot[slots] = fingerprints(distinct), first + nulls, runs, distinct
        raw = io.BytesIO()
        np.savez(raw, width=self.width, nulls=nulls, prints=prints, starts=starts, runs=lengths, keys=distinct, ends=np.array(self.ends, np.int64), sizes=[len(b) for b in function.levels], bits=np.packbits(np.concatenate(function.levels)) if function.levels else np.zeros(0, np.uint8))
        with self.fs.open_output_stream(f"{self.root}/{self.name}.mph") as out:
            out.write(raw.getvalue())
        low, high = (int(distinct[0]), int(distinct[-1])) if len(distinct) else (None, None)
        return self.name, self.part, self.roll, len(self.keys), self.n, low, high


class ShardReader:
    """Constant-time keyed access to one shard."""

    def __init__(self, folder: str, name: str):
        self.fs, root = filesystem(folder)
        with self.fs.open_input_file(f"{root}/{name}.mph") as f:
            z = np.load(io.BytesIO(f.read()))
        self.width, self.nulls, self.prints, self.starts, self.runs, self.keys = int(z["width"]), int(z["nulls"]), z["prints"], z["starts"], z["runs"], z["keys"]
        self.ends = np.concatenate([[0], z["ends"]])
        bits, levels, at = np.unpackbits(z["bits"]), [], 0
        for size in z["sizes"]:
            levels.append(bits[at : at + size])
            at += size
        self.function = PerfectHash(levels)
        self.payload = self.fs.open_input_file(f"{root}/{name}.ids")

    def entries(self, keys: np.ndarray) -> list[range]:
        """The entries of each key, none for keys that are not stored."""
        slots = self.function.slots(keys)
        good = slots >= 0
        good[good] = self.prints[slots[good]] == fingerprints(keys[good])
        return [range(self.starts[s], self.starts[s] + self.runs[s]) if ok else range(0) for s, ok in zip(slots, good, strict=True)]

    def ids(self, entry: int) -> np.ndarray:
        start, stop = int(self.ends[entry]), int(self.ends[entry + 1])
        raw = self.payload.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4")

    def get(self, key: int) -> list[np.ndarray]:
        return [self.ids(e) for e in self.entries(np.array([key], np.int64))[0]]


class WordEncoder:
    """Ids of texts as bytes, for a tokenizer that drops white space, splits letters from punctuation, lower-cases, and
    marks the last token of every word.

    No token reaches across white space, so the parts between spaces and line feeds are looked up, and those not known
    are put together from a word and the ASCII punctuation after it.  Words not known are encoded by the library, many
    at a time in one text, whose ids are cut after each token that ends a word.
    """

    def __init__(self, path: str, end_id: int, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        size = max(self.tokenizer.get_vocab_size(), end_id + 1)
        self.kind, self.width = ("<u2", 2) if size <= 1 << 16 else ("<u4", 4)
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = bool(mark) and token.endswith(mark)
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.limit = limit

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, self.kind)
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * self.width).tolist()
            if len(stops) != len(some):  # the tokenizer cuts one of them
                self._learn_whole(self.words, some)
                continue
            raw, start = ids.tobytes(), 0
            for word, stop in zip(some, stops, strict=True):
                self.words[word] = raw[start:stop]
                start = stop

    def _learn_whole(self, into: dict[str, bytes], texts: list[str]) -> None:
        for text, e in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            into[text] = np.array(e.ids, self.kind).tobytes()

    def _learn(self, wanted: list[str]) -> None:
        new = [p for p in wanted if p not in self.parts]
        if len(self.parts) + len(new) > self.limit:
            self.parts.clear()
            new = wanted
        split, other = [], []
        for part in new:
            word = part.rstrip(PUNCTUATION)
            if word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha()):  # no marks come up
                split.append((part, word.lower() if word.isascii() else word, part[len(word) :]))
            else:
                other.append(part)
        self._learn_whole(self.parts, other)
        needed = {w for _, w, _ in split}
        if len(self.words) + len(needed) > self.limit:
            self.words.clear()
        self._learn_words([w for w in needed if w not in self.words])
        if len(self.tails) > self.limit:
            self.tails.clear()
        self._learn_whole(self.tails, list({t for _, _, t in split} - self.tails.keys()))
        for part, word, tail in split:
            self.parts[part] = self.words[word] + self.tails[tail]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text.  Distinct parts are looked up once; their ids are then gathered by position."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = lists.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        found = list(map(self.parts.__getitem__, distinct))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        ids = np.frombuffer(b"".join(found), self.kind)
        index = coded.indices.to_numpy(zero_copy_only=False)
        sizes = lengths[index]
        ends = np.cumsum(sizes)
        gathered = ids[np.repeat((np.cumsum(lengths) - lengths)[index] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        bounds = np.r_[0, ends][lists.offsets.to_numpy()]
        for part in distinct:
            if len(part) > 64:
                del self.parts[part]
                self.words.pop(part.rstrip(PUNCTUATION).lower(), None)
        return [gathered[i:j] for i, j in itertools.pairwise(bounds.tolist())]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and texts of as many batches as hold about ``TEXT_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= TEXT_BYTES:
            yield tuple(pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))
            held, size = [], 0
    if held:
        yield tuple(pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))


def write_store(df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> tuple[str, DataFrame]:
    """Encode, append ``end_id`` to each document, write shards in ascending key order; returns folder and manifest.

    One range shuffle of the texts on the key; every task streams its sorted rows to its own shard files.  Keys are
    longs.  Null texts count as empty; very long texts are encoded whole; rows with a null key come first and have no keyed access; repeated keys are
    kept, ordered by text; an empty table gives an empty manifest; other columns are not read.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, "token-store")
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_cache(("words", tokenizer_path, end_id), lambda: WordEncoder(tokenizer_path, end_id))
        end = int(end_id).to_bytes(encoder.width, "little")
        part, roll, writer, rows = TaskContext.get().partitionId(), 0, None, []
        for keys, texts in _gathered(batches):
            for key, ids in zip(keys.to_pylist(), encoder.encode(texts), strict=True):
                if writer and writer.n >= SHARD_IDS:
                    rows.append(writer.close())
                    roll, writer = roll + 1, None
                writer = writer or ShardWriter(folder, part, roll, encoder.width)
                writer.add(key, ids.tobytes() + end)
        if writer:
            rows.append(writer.close())
        kinds = (pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4)
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    rows = df.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    manifest = map_batches(rows.repartitionByRange(partitions, "key").sortWithinPartitions("key", "text"), write, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return folder, spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_store(folder: str, manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per stored document, read through the index: the key, ``start``, ``n_tokens`` and ``ids_crc32``.

    ``start`` counts the ids of all documents before it: a running sum over the manifest (a row per shard), then
    offsets inside the shard.
    """
    starts = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = ShardReader(folder, name)
                order = [(None, range(shard.nulls))] if shard.nulls else []
                order += list(zip(shard.keys.tolist(), shard.entries(shard.keys), strict=True))
                rows = [(key, base + int(shard.ends[e]), int(shard.ends[e + 1] - shard.ends[e]), zlib.crc32(shard.ids(e).astype("<u4").tobytes())) for key, run in order for e in run]
                if len(rows) != len(shard.ends) - 1:
                    raise ValueError(f"shard {name}: its index does not reach all of its entries")
                for at in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[at : at + 10_000], strict=True)], names=[id_col, "start", "n_tokens", "ids_crc32"])

    spread = starts.select("shard", "base").repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return map_batches(spread, read, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")
