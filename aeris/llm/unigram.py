"""Unigram vocabulary of a SentencePiece file: pieces with scores, byte pieces for what no piece covers.

The segmentation that both operators on it compute is the path of greatest score sum (exact in double precision). Ties
follow the tokenizer: nodes are filled by ascending start, and a later candidate must be better to replace one, so of
equal paths into a place the one whose last piece starts earliest stays. A character without a piece of its own scores
ten less than the least piece and is written as its UTF-8 byte pieces.
"""

from __future__ import annotations

import re
from functools import lru_cache

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Segments that a worker process keeps with their result in each of two generations, and their greatest length. A cache
#: only; no result depends on it.
KEPT_SEGMENTS, KEPT_LENGTH = 300_000, 40


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        p, n = self.processor, self.processor.get_piece_size()
        pieces = [p.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
        #: piece: (id, score)
        self.scores = {pieces[i]: (i, p.get_score(i)) for i in normal}
        self.byte_ids = {int(pieces[i][1:-1], 16): i for i in range(n) if p.is_byte(i)}
        self.unknown_id = p.unk_id()
        self.unknown_score = min(s for _, s in self.scores.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.scores))
        self.singles = frozenset(x for x in self.scores if len(x) == 1)
        #: bytes of each id, for decoding
        self.raw = [pieces[i].encode() for i in range(n)]
        for value, i in self.byte_ids.items():
            self.raw[i] = bytes([value])
        for i in range(n):
            if p.is_control(i):
                self.raw[i] = b""
            elif p.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
        # Places that no piece spans, so that all paths meet there: on both sides of a character that is in no longer
        # piece, and before a space mark after any other character if no piece holds these two in that order.
        inner = "".join(sorted({c for x in self.scores if len(x) > 1 for c in x}))
        before_space = any(a != SPACE and b == SPACE for x in self.scores for a, b in zip(x, x[1:]))
        if before_space:
            self._segments = re.compile(f"[^{re.escape(inner)}]|[{re.escape(inner)}]+")
        else:
            body = re.escape(inner.replace(SPACE, ""))
            self._segments = re.compile(f"{SPACE}+[{body}]*|[{body}]+|[^{SPACE}{body}]")

    def normalize(self, text: str | None) -> str:
        """The tokenizer's own normal form, with the space mark for spaces and before the text."""
        return self.processor.normalize(text) if text else ""

    def segments(self, normal: str) -> list[str]:
        """The normal form cut where no piece spans two segments."""
        return self._segments.findall(normal)

    def unknown_ids(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown_id]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(path)


class Kept(dict):
    """Results by segment. A missing one is computed, and kept if short; when the cache is full, what it holds becomes the
    older generation, from which segments that are met again are taken over."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, segment: str):
        found = self.older.get(segment)
        if found is None:
            found = self.compute(segment)
        if len(segment) <= KEPT_LENGTH:
            if len(self) >= KEPT_SEGMENTS:
                self.older = dict(self)
                self.clear()
            self[segment] = found
        return found
