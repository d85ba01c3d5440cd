"""A public SentencePiece vocabulary as a unigram model, and the pre-tokens both token operators share.

Scores are the file's own. Pieces are written with a plain space for the word
mark, and a text is read as one space plus the text, cut before every space and
around every newline. No piece crosses such a cut (runs of spaces and control
pieces are left out), so the best path of a text is that of its pre-tokens one
after another. A code point without a piece falls back to its UTF-8 bytes at a
score below every piece. Among paths of equal score the one of fewest tokens
wins, then the one whose last piece is longest.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: total score of a path in one Python integer: score x WEIGHT - tokens; no text has as many bytes, so no count wraps
WEIGHT = 1 << 32
PRETOKEN = re.compile(r" ?[^ \n]+| |\n")


@dataclass
class PieceModel:
    value: dict[str, tuple[int, int]]  # piece -> (score x WEIGHT - 1, id)
    bytes_at: int  # id of byte 0
    fallback: int  # score x WEIGHT of a code point without a piece, before its tokens
    longest: int

    @property
    def surface(self) -> dict[int, bytes]:
        """The bytes that each id stands for."""
        out = {i: p.encode() for p, (_, i) in self.value.items()}
        return out | {self.bytes_at + b: bytes([b]) for b in range(256)}


def load_pieces(path: str = MODEL_PATH) -> PieceModel:
    """Read the vocabulary on the driver; it is as large as the file (32,000 pieces) and goes out by broadcast."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    value, lowest = {}, 0.0
    for i in range(sp.get_piece_size()):
        piece, score = sp.id_to_piece(i), sp.get_score(i)
        if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or "▁" in piece[1:]:
            continue
        value[piece.replace("▁", " ")] = (round(score) * WEIGHT - 1, i)
        lowest = min(lowest, score)
    return PieceModel(value, sp.piece_to_id("<0x00>"), (round(lowest) - 10) * WEIGHT, max(map(len, value)))


def pretokens(text: str | None) -> list[str]:
    """Pre-tokens of one text; none for a null or empty text."""
    return PRETOKEN.findall(" " + text) if text else []


def best_path(model: PieceModel, pretoken: str) -> list[int]:
    """Plain dynamic programme over one pre-token, as the operators define it (for tests)."""
    n = len(pretoken)
    best: list[tuple[float, int]] = [(0, 0)] + [(-math.inf, 0)] * n
    for start in range(n):
        for end in range(start + 1, min(n, start + model.longest) + 1):
            got = model.value.get(pretoken[start:end])
            if got and best[start][0] + got[0] > best[end][0]:
                best[end] = (best[start][0] + got[0], start)
        if pretoken[start] not in model.value:
            cost = model.fallback - len(pretoken[start].encode())
            if best[start][0] + cost > best[start + 1][0]:
                best[start + 1] = (best[start][0] + cost, start)
    out: list[int] = []
    at = n
    while at:
        start = best[at][1]
        part = pretoken[start:at]
        got = model.value.get(part)
        out[:0] = [got[1]] if got else [model.bytes_at + b for b in part.encode()]
        at = start
    return out
