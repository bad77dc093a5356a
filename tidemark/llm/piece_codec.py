"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

An Aho-Corasick automaton gives, for every start, the pieces that match there.  The encoder takes the longest, goes
on if it is compatible with its left neighbour (merging the two again leaves exactly the two), else tries the next
shorter one, else steps back; a bitfield marks positions from which no continuation exists.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import BoundedCache, map_batches, worker_cache
from tidemark.llm.pieces import SPACE, PieceTable


class PieceCodec:
    def __init__(self, model_path: str):
        self.table = PieceTable(model_path)
        self.automaton = ahocorasick.Automaton()
        for piece in self.table.ids:
            if len(self.table.merge(piece)) == 1:  # others never come out of merging
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self._together = BoundedCache(self._compatible, limit=400_000)

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Whether merging the characters of both pieces again leaves exactly the two: no merge crosses their border."""
        symbols, left, rank = [*pair[0], *pair[1]], len(pair[0]), self.table.rank
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = rank.get(symbols[i] + symbols[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None or at == left - 1:
                return best is None and left == 1 and len(symbols) == 2
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            left -= at < left - 1

    def split(self, part: str) -> list[str]:
        """The pieces of a part, single characters without a piece included."""
        n = len(part)
        starts: list[list[str] | None] = [None] * n
        for last, piece in self.automaton.iter(part):
            at = last + 1 - len(piece)
            if starts[at] is None:
                starts[at] = [piece]
            else:
                starts[at].append(piece)  # ends ascend, so each list is in order of length
        together, failed, stuck = self._together, bytearray(n // 8 + 1), False
        chosen: list[tuple[str, int]] = []  # a piece and its place among the matches at its start
        at, choice, before = 0, None, None
        while at < n:
            matches = starts[at]
            if matches is None:
                matches = starts[at] = [part[at]]
            if choice is None:
                choice = len(matches) - 1
            while choice >= 0:
                piece = matches[choice]
                stop = at + len(piece)
                if not (stuck and failed[stop >> 3] >> (stop & 7) & 1) and (before is None or together[before, piece]):
                    break
                choice -= 1
            if choice >= 0:
                chosen.append((piece, choice))
                at, choice, before = stop, None, piece
            elif chosen:
                stuck = True
                failed[at >> 3] |= 1 << (at & 7)
                piece, choice = chosen.pop()
                at -= len(piece)
                choice -= 1
                before = chosen[-1][0] if chosen else None
            else:
                raise ValueError("the pieces of the model cannot spell this part")
        return [piece for piece, _ in chosen]

    def part_ids(self, part: str) -> list[int]:
        ids, by_byte = self.table.ids, self.table.byte_ids
        return [i for piece in self.split(part) for i in ([ids[piece]] if piece in ids else [by_byte[b] for b in piece.encode()])]

    def encode(self, text: str | None) -> list[int]:
        return [i for part in self.table.parts(self.table.normalise(text)) for i in self.part_ids(part)]

    def surface(self, ids: Iterable[int]) -> str:
        """The text of ids, the dummy prefix included; bytes that are no UTF-8 become U+FFFD."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.table.byte_of:
                raw.append(self.table.byte_of[i])
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            if i not in self.table.hidden:
                out.append(self.table.text_of[i].replace(SPACE, " ") if i else " ⁇ ")
        return "".join(out) + _utf8(raw)

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        text = self.surface(ids)
        first = next((i for i in ids if i not in self.table.hidden), 0)
        return text[1:] if self.table.text_of[first].startswith(SPACE) else text


def _utf8(raw: bytearray) -> str:
    """Each byte that belongs to no character becomes one U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, rest = [], bytes(raw)
        while rest:
            for n in (1, 2, 3, 4):
                try:
                    out.append(rest[:n].decode())
                    rest = rest[n:]
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                rest = rest[1:]
        return "".join(out)


class _Known:
    """A codec and, by part, its ids and the text that those ids decode to.

    Decoding an id list is decoding its parts and joining: a part begins at a piece of its own and holds its bytes
    whole.  So each part's ids are decoded once, when it is first met, and kept beside them.
    """

    def __init__(self, model_path: str, limit: int = 600_000):
        self.codec = PieceCodec(model_path)
        self.table = self.codec.table
        self.known = BoundedCache(self._round_trip, limit)

    def _round_trip(self, part: str) -> tuple[str, str]:
        ids = self.codec.part_ids(part)
        return ",".join(map(str, ids)), self.codec.surface(ids)

    def encode_decode(self, text: str | None) -> tuple[str, str]:
        """Decimal ids joined by commas, and the decoded text; the dummy prefix is left off."""
        parts = self.table.parts(self.table.normalise(text))
        if not parts:
            return "", ""
        ids, surfaces = zip(*map(self.known.__getitem__, parts), strict=True)
        return ",".join(ids), "".join(surfaces).removeprefix(" ")


def encode_decode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = True) -> DataFrame:
    """Encode every text and decode it again.

    ``digests``: the id, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas) and ``decoded_sha256``;
    otherwise the id, ``ids`` (array of int) and ``decoded``.  The decoded text is made from the ids.  Map-only.  Null and
    empty texts have no ids and decode to the empty text; a very long text is encoded part by part, in memory that
    grows with the text alone; repeated rows are encoded each; an empty table gives an empty result; other columns are not read.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache(("piece codec", model_path), lambda: _Known(model_path))
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids, decoded = known.encode_decode(text)
                if digests:
                    rows.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                else:
                    rows.append(([int(i) for i in ids.split(",")] if ids else [], decoded))
            types = [pa.int64(), pa.string(), pa.string()] if digests else [pa.list_(pa.int32()), pa.string()]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
            columns = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[id_col, *names])

    tail = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return map_batches(df.select(id_col, text_col), encode, f"`{id_col}` {id_type}, {tail}")
