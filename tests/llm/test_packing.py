import bisect
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from starsift.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def by_pieces(lengths, capacity):
    """Sequences of a best-fit decreasing packing of single pieces."""
    rooms, many = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            left = rooms.pop(at)
        else:
            left, many = capacity, many + 1
        if left - n:
            bisect.insort(rooms, left - n)
    return many


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_best_fit_of_single_pieces(seed):
    pick = random.Random(seed)
    capacity = pick.choice([1, 7, 20, 64])
    counts = Counter(min(capacity, int(pick.paretovariate(0.6))) for _ in range(pick.randrange(400)))
    used, seen = {}, Counter()
    for length, first, last, each, sequence, offset in packing.plan(counts, capacity):
        for rank in range(first, last):
            k = rank - first
            used.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
            seen[length] += 1
    assert seen == counts and sorted(used) == list(range(len(used)))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == by_pieces(list(counts.elements()), capacity)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pieces_are_those_of_the_library(docs, capacity):
    pick = random.Random(1)
    rows = [(i, " ".join(pick.choice(["tale", "Ünder", "don't", "123", "中文"]) for _ in range(pick.randrange(60)))) for i in range(60)]
    rows += [(i, "same text") for i in range(100, 130)] + [(130, None), (131, ""), (None, "x y"), (None, "x y"), (132, "<|endoftext|>")]
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, n, low, min(capacity, len(ids) - low), zlib.crc32(ids[low:low + capacity].tobytes()))
                 for n, low in enumerate(range(0, len(ids), capacity))]
    got = packing.pack_documents(docs(*rows), PATH, capacity).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= capacity
    assert len(sequences) == by_pieces([w[3] for w in want], capacity)


def test_empty(docs):
    assert packing.pack_documents(docs((1, "a")).limit(0), PATH).collect() == []
