import re

import pyarrow as pa
import pytest

from starsift.functions.text import letter_words

TEXTS = ["good, bad", "", None, "abc", "def ghi", "...", "é wörter 12 x", "ab\ncd_ef", "naïve", "tail ", "日本 a"]


@pytest.mark.parametrize("piece", [1, 8, 1000])
@pytest.mark.parametrize("skip", [0, 3])
def test_letter_words_equal_runs_of_letters(piece, skip):
    texts = pa.array(TEXTS, pa.large_string()).slice(skip)
    got, done = {}, 0
    for size, owners, words in letter_words(texts, piece):
        assert len(owners) == len(words)
        for owner, word in zip(owners.tolist(), words.to_pylist(), strict=True):
            got.setdefault(done + owner, []).append(word)
        done += size
    assert done == len(texts)
    runs = [re.findall(r"[^\W\d_]+", t or "") for t in TEXTS[skip:]]
    assert got == {i: r for i, r in enumerate(runs) if r}


def test_no_texts():
    assert list(letter_words(pa.array([], pa.large_string()))) == []
    assert sum(len(w) for _, _, w in letter_words(pa.array(["", None], pa.large_string()))) == 0
