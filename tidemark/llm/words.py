"""Words of whole Arrow text columns as integer arrays, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: a byte that no UTF-8 text holds, put behind every text
BREAK = 0xFF
#: kinds of bytes; runs of WORD and MARK bytes are words
SPACE, WORD, MARK, END = 0, 1, 2, 3


def kind_table(spaces: bytes, ends: bytes = b"", marks: bytes = b"") -> np.ndarray:
    """Kind of every byte value: ``spaces``, ``marks`` and ``ends`` as named, the end of a text END, the rest WORD."""
    kinds = np.full(256, WORD, np.uint8)
    for values, kind in ((spaces, SPACE), (marks, MARK), (ends, END), ([BREAK], END)):
        kinds[list(values)] = kind
    return kinds


def joined(texts: pa.Array) -> bytes:
    """UTF-8 of all texts (null: empty), ASCII letters lower-cased, each followed by a break."""
    parts = texts.fill_null("").cast(pa.large_binary()).to_pylist()
    return b"".join(x + b"\xff" for x in parts).lower()


def split_words(text: bytes, kinds: np.ndarray):
    """(ids, distinct, starts): the number of every word in reading order, the words, where each begins.

    A word is a longest run of bytes of one kind, WORD or MARK.
    """
    kind = kinds[np.frombuffer(text, np.uint8)]
    change = np.empty(len(kind) + 1, bool)
    change[0] = change[-1] = len(kind) > 0
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    at = np.flatnonzero(change)
    kind = kind[at[:-1]]
    kept = np.flatnonzero((kind == WORD) | (kind == MARK))
    if not len(kept):
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    width, of = (np.int32, pa.binary()) if len(text) < 2**31 else (np.int64, pa.large_binary())
    runs = pa.Array.from_buffers(of, len(at) - 1, [None, pa.py_buffer(at.astype(width)), pa.py_buffer(text)])
    starts = at[kept]
    del kind, change, at
    coded = runs.take(pa.array(kept)).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string()), starts


def phrases(distinct: pa.Array, *ids: np.ndarray) -> pa.Array:
    """The words of the given numbers, joined by a space."""
    parts = [distinct.take(pa.array(i)) for i in ids]
    return pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
