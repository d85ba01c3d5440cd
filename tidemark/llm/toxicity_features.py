"""Dense toxicity features of a text and the lexicon they look up (what tasks need; no Spark ML here)."""

from __future__ import annotations

import math
import re

import numpy as np

NEAR = 4
#: second-person words of the corpus languages (fixed values)
SECOND = frozenset(
    "you your yours yourself u ur ya tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "tú ti tuyo usted ustedes vosotros os vuestro".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_SPELLED = re.compile(r"[^\W\d_]*[0-9@$!*][^\s]*")
_LEET = str.maketrans("013457@$!", "oieastasi", "*.-_")
_STRETCH = re.compile(r"(.)\1{2,}")
_ASCII = np.zeros(256, np.uint8)
_ASCII[0x41:0x5B] = 1  # capitals
_ASCII[0x61:0x7B] = 2
_ASCII[0x80:] = 2  # letters beyond ASCII count as small
for _c in b"0123456789@$*":
    _ASCII[_c] = 3
_ASCII[0x21] = 4  # !
for _c in b"?.,;:":
    _ASCII[_c] = 5
N_FEATURES = 16


def units(word: str) -> list[str]:
    """What the lexicon counts of a word: itself and its beginnings."""
    return [word, *(f"{word[:k]}*" for k in (4, 5) if len(word) > k)]


class Lexicon:
    """Toxic and clean document counts per unit; a unit's weight is its smoothed log odds."""

    def __init__(self, counts: dict[str, tuple[int, int]], toxic: int, clean: int):
        self.counts, self.toxic, self.clean = counts, toxic, clean

    def floor(self, toxic: int) -> int:
        return max(3, toxic // 200)

    def weigher(self, own: int | None = None):
        """Word -> weight (0: no lexicon word, -1: second person); ``own`` leaves out one text of that label."""
        toxic, clean = self.toxic - (own == 1), self.clean - (own == 0)
        drop_t, drop_c = int(own == 1), int(own == 0)
        least = self.floor(toxic)
        counts = self.counts

        def weigh(word: str) -> float:
            best = 0.0
            for unit in units(word):
                got = counts.get(unit)
                if got:
                    t, c = got[0] - drop_t, got[1] - drop_c
                    if t >= least:
                        best = max(best, math.log((t + 0.5) / (toxic + 1)) - math.log((max(c, 0) + 0.5) / (clean + 1)))
            if best < 2.0:
                best = 0.0
            return best

        return weigh


class _Weights(dict):
    """Weights of words, remembered up to a bound."""

    def __init__(self, weigh):
        super().__init__()
        self.weigh = weigh

    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        if word in SECOND:
            out = -1.0
        else:
            out = self.weigh(word)
            if not out and len(word) > 3:
                plain = _STRETCH.sub(r"\1", word)
                if plain != word:
                    out = self.weigh(plain) or self.weigh(_STRETCH.sub(r"\1\1", word))
        self[word] = out
        return out


def word_weights(lexicon: Lexicon, own: int | None = None) -> _Weights:
    """The weights of a lexicon, remembered per word; ``own`` leaves out one text of that label."""
    return _Weights(lexicon.weigher(own))


def document_units(text: str) -> set[str]:
    """The distinct units of one text."""
    return {u for w in set(_WORD.findall(text.lower())) for u in units(w)}


def features(texts: list[str | None], weights: _Weights) -> np.ndarray:
    """One row of ``N_FEATURES`` per text."""
    out = np.zeros((len(texts), N_FEATURES))
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for i, (text, raw) in enumerate(zip(texts, raws, strict=True)):
        if not text:
            continue
        ws = _WORD.findall(text.lower())
        w = np.fromiter(map(weights.__getitem__, ws), np.float64, len(ws))
        n = max(1, len(ws))
        hit, second = np.flatnonzero(w > 0), np.flatnonzero(w < 0)
        row = out[i]
        if len(hit):
            top = np.sort(w[hit])[::-1]
            row[0] = top.sum() / n
            row[1] = top[0]
            row[2] = math.log1p(len(hit))
            row[3] = len(hit) / n
            row[4] = top[:3].mean()
            if len(second):
                at = np.searchsorted(second, hit)
                gap = np.minimum(
                    np.abs(hit - second[np.minimum(at, len(second) - 1)]), np.abs(hit - second[np.maximum(at - 1, 0)])
                )
                row[5] = (gap <= NEAR).sum() / n
                row[6] = math.exp(-float(gap.min()) / NEAR)
        row[7] = len(second) / n
        kind = _ASCII[np.frombuffer(raw, np.uint8)]
        count = np.bincount(kind, minlength=6)
        letters = max(1, int(count[1] + count[2]))
        row[8] = count[1] / letters
        row[9] = count[4] / len(raw)
        row[10] = count[5] / len(raw)
        if len(kind) > 2:
            letter = (kind == 1) | (kind == 2)
            inside = letter[:-2] & ((kind[1:-1] == 3) | (kind[1:-1] == 4)) & letter[2:]
            shouted = (kind[:-2] == 1) & (kind[1:-1] == 1) & (kind[2:] == 1)
            twice = (kind[:-1] == 4) & (kind[1:] == 4)
            row[11] = inside.sum() / n
            row[12] = shouted.sum() / letters
            row[13] = twice.sum() / n
            if inside.any():
                plain = (_WORD.findall(t.translate(_LEET)) for t in _SPELLED.findall(text.lower()))
                row[14] = sum(1 for ws_ in plain for x in ws_ if weights[x] > 0) / n
        row[15] = math.log1p(len(ws))
    return out
