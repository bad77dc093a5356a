import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, documents
from tidemark.llm.piece_codec import PieceCodec, encode_decode
from tidemark.llm.pieces import PieceTable
from tidemark.llm.token_count import token_counts
from tidemark.llm.token_store import PerfectHash, ShardReader, WordEncoder, read_store, write_store

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(n, seed=1):
    r = random.Random(seed)
    chars = "abc the   \n\t▁é漢字ß😀́<s></s><0x0A>%$#\x00‍"
    return ["".join(r.choice(chars) for _ in range(r.randrange(60))) for _ in range(n)] + [" " * k for k in range(1, 60)] + ["aehinorst"[k % 9] * k for k in range(200)]


def test_counts_and_encoding_equal_the_library(sp):
    table, codec = PieceTable(MODEL), PieceCodec(MODEL)
    for text in random_texts(1500):
        want = sp.encode(text)
        assert sum(map(table.count, table.parts(table.normalise(text)))) == len(want)
        assert codec.encode(text) == want
        assert codec.decode(want) == sp.decode(want)


def test_decoding_any_ids_equals_the_library(sp):
    codec, r = PieceCodec(MODEL), random.Random(3)
    for _ in range(500):
        ids = [r.randrange(400) for _ in range(12)]
        assert codec.decode(ids) == sp.decode(ids)


def test_token_counts(spark, sp):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(documents(spark, AWKWARD), MODEL, limit=1500).collect())
    assert got == sorted((i or 0, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 1500) for i, t in AWKWARD)
    assert token_counts(documents(spark, AWKWARD).limit(0), MODEL).count() == 0


def test_codec_query(spark, sp):
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_decode(documents(spark, AWKWARD), MODEL).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted((i or 0, len(e := sp.encode(t or "")), sha(",".join(map(str, e))), sha(sp.decode(e))) for i, t in AWKWARD)
    full = {r.doc_id: (r.ids, r.decoded) for r in encode_decode(documents(spark, AWKWARD), MODEL, digests=False).collect()}
    assert full[5][0] == sp.encode(dict(AWKWARD)[5]) and full[1] == ([], "")
    assert encode_decode(documents(spark, AWKWARD).limit(0), MODEL).count() == 0


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.unique(np.random.RandomState(5).randint(-(1 << 62), 1 << 62, 5000))
    f = PerfectHash.build(keys)
    assert sorted(f.slots(keys).tolist()) == list(range(len(keys)))
    assert PerfectHash.build(keys[:0]).size == 0 and PerfectHash.build(keys[:1]).slots(keys[:1]).tolist() == [0]


def test_word_encoder_equals_the_library():
    encoder, r = WordEncoder(WORD_MODEL, 1, limit=300), random.Random(2)
    bits = ["a", "B", "'s", "'T", ".", ",", "...", "é", "Σ", "İ", "漢", " ", "  ", "\n", "\t", "\x1c", "\xa0", "1", "<|endoftext|>", "Hello", "World.", "it's,", "ß.", "x.,", "́", "Wörd%%%", "a$$$", "ǅ,", "ﬁ&&&", "ΑΣ.", "क़,"]
    for _ in range(6):
        texts = ["".join(r.choice(bits) for _ in range(r.randrange(30))) for _ in range(500)] + [None]
        want = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want


def test_store(spark):
    tokenizer = Tokenizer.from_file(WORD_MODEL)
    folder, manifest = write_store(documents(spark, AWKWARD), WORD_MODEL, end_id=1, partitions=3)
    got = [tuple(r) for r in read_store(folder, manifest).collect()]
    rows = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(got, key=key) == want
    shard = next(r for r in manifest.collect() if r.min_key is not None and r.min_key <= 5 <= r.max_key)
    reader = ShardReader(folder, shard.shard)
    assert reader.get(5)[0].tolist() == [*tokenizer.encode(dict(AWKWARD)[5], add_special_tokens=False).ids, 1]
    assert reader.get(10**9) == []
    empty = write_store(documents(spark, AWKWARD).limit(0), WORD_MODEL, end_id=1)
    assert read_store(*empty).count() == 0
