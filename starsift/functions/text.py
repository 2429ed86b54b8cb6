"""Tokens of texts as Spark expressions."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separators between tokens.
LETTERS = r"[^\p{L}]+"
WORDS = r"[^\p{L}\p{N}_]+"

_ASCII_LETTER = np.isin(np.arange(256), np.frombuffer(string.ascii_letters.encode(), np.uint8))


def tokens(text: str | Column, separator: str = WORDS, min_length: int = 1) -> Column:
    """Lower-cased tokens of a text, shorter ones left out."""
    parts = F.split(F.lower(text), separator)
    return F.filter(parts, lambda t: F.length(t) >= min_length)


def exploded(
    df: DataFrame, text: str, separator: str, min_length: int, *carry: str
) -> DataFrame:
    """One row (``carry``, term) for each token of each text."""
    term = F.explode(F.split(F.lower(text), separator)).alias("term")
    return df.select(*carry, term).filter(F.length("term") >= min_length)


def normalized(text: str | Column) -> Column:
    """Text with case and spacing differences taken out, for copy detection."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def distinct(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct values of an Arrow array, null among them, and each row's place there.

    For Python tasks whose work on a text depends on the text alone.
    """
    coded = pc.dictionary_encode(values, null_encoding="encode")
    return coded.dictionary, coded.indices.to_numpy()


def pieces(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """The same large strings in parts of about ``limit`` bytes, one text at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        least = (sizes[begin - 1] if begin else 0) + limit
        end = max(begin + 1, int(np.searchsorted(sizes, least, side="right")))
        yield texts.slice(begin, end - begin)
        begin = end


def letter_words(texts: pa.Array, piece: int = 1 << 22) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(texts, owners, words): the runs of letters of a large-string array, in order of each text.

    For Python tasks. About ``piece`` bytes of texts are split at a time, a longer text
    alone; an owner is a text's place within its piece. A null text has no words.
    """
    for part in pieces(texts, piece):
        part = pc.fill_null(part, "")
        plain = pc.string_is_ascii(part).to_numpy(zero_copy_only=False)
        owners, words = _ascii_words(part.filter(pa.array(plain)))
        owners = np.flatnonzero(plain)[owners]
        if not plain.all():
            rest = pc.split_pattern_regex(part.filter(pa.array(~plain)), LETTERS)
            others, more = pc.list_parent_indices(rest).to_numpy(), pc.list_flatten(rest)
            real = pc.not_equal(more, "")
            others = others[real.to_numpy(zero_copy_only=False)]
            owners = np.concatenate([owners, np.flatnonzero(~plain)[others]])
            words = pa.concat_arrays([words, more.filter(real)])
        yield len(part), owners, words


def _ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Owners and words of ASCII texts, from their bytes: the letters stay, next to each other."""
    if not len(texts) or texts.buffers()[2] is None:
        return np.empty(0, np.int64), pa.array([], pa.large_string())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    letter = _ASCII_LETTER[data]
    follows = np.zeros(len(data), dtype=bool)
    follows[1:] = letter[:-1]
    follows[edges[:-1][edges[:-1] < len(data)]] = False
    starts = np.flatnonzero(letter & ~follows)
    kept = data[letter]
    before = np.cumsum(letter)[starts] - 1
    bounds = np.append(before, len(kept)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(kept))
    return np.searchsorted(edges, starts, side="right") - 1, words
