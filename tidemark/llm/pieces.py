"""Byte-pair merging over the pieces of a merge-type SentencePiece model.

Text is normalised as such a model asks (identity rules, a dummy prefix, spaces as U+2581) and cut where no piece
can reach across: before a run of U+2581 and around line feeds.  Parts are independent, so each is encoded once and
its result is kept under its own text.  A model whose pieces do reach across is encoded whole.
"""

from __future__ import annotations

import heapq
import re

SPACE = "▁"


class PieceTable:
    """Ranks and ids of a model's ordinary pieces, read through the public sentencepiece API."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.text_of: list[str] = []
        self.byte_of: dict[int, int] = {i: b for b, i in enumerate(self.byte_ids)}
        self.hidden: set[int] = set()
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            self.text_of.append(piece)
            if sp.is_control(i):
                self.hidden.add(i)
            elif not (sp.is_unknown(i) or sp.is_byte(i)):
                self.ids[piece] = i
                self.rank[piece] = -sp.get_score(i)
        crossing = any(SPACE in p.lstrip(SPACE) or (len(p) > 1 and "\n" in p) for p in self.ids)
        self.parts = re.compile(r"[\s\S]+" if crossing else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall

    def normalise(self, text: str | None) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def merge(self, part: str) -> list[int]:
        """End positions of the symbols left when the best adjacent pair has been merged again and again.

        A heap holds the candidate pairs by rank, then by position; a doubly linked list holds the symbols.  A heap
        entry is stale when its left symbol is gone or the pair no longer has the entry's length.
        """
        n = len(part)
        end = list(range(1, n + 1))  # end[i]: end of the symbol that starts at i; 0 once it is merged away
        before = list(range(-1, n - 1))
        rank = self.rank
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(part[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank.get(part[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            left = before[i]
            if left >= 0 and (r := rank.get(part[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        ends, i = [], 0
        while i < n:
            i = end[i]
            ends.append(i)
        return ends

    def count(self, part: str) -> int:
        """Tokens of a part: its initial symbols minus the merges; characters without a piece count their bytes."""
        merges = len(part) - len(self.merge(part))
        return sum(1 if c in self.ids else len(c.encode()) for c in part) - merges
