import math
import random
import re
import zlib
from collections import Counter

import pytest

from starsift.llm import ngram_model


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(rows, order, weight):
    counts = Counter()
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    for t in train:
        seq = ["<s>", *tokens(t)]
        counts[("<s>",)] += 1
        for e in range(1, len(seq)):
            for n in range(1, order + 1):
                if n == 1 or e - n + 1 >= 0:
                    counts[tuple(seq[max(0, e - n + 1):e + 1])] += 1
    uni = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)}
    total, types = sum(uni.values()), len(uni)

    def prob(gram):
        if len(gram) == 1:
            return (uni.get(gram, 0) + 0.5) / (total + 0.5 * (types + 1))
        low = prob(gram[1:])
        context = counts.get(gram[:-1], 0)
        return weight * counts.get(gram, 0) / context + (1 - weight) * low if context else low

    out = []
    for i, t in rows:
        seq = ["<s>", *tokens(t)]
        score = sum(math.log10(prob(tuple(seq[max(0, e - order + 1):e + 1] if order > 1 else seq[e:e + 1])))
                    for e in range(1, len(seq)))
        base = sum(math.log10(prob((w,))) for w in seq[1:])
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        out.append((i, held, len(seq) - 1, sum(uni.get((w,), 0) > 0 for w in seq[1:]), total, base, score))
    return out


def sample(seed=1, n=120):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["The", "the", "é", "Éa"]
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randrange(0, 30)))) for i in range(n)]
    rows += [(n + i, f"rare{i} only here the w1 w2 w3") for i in range(30)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (None, "w1 w2 w3"), (3, "w1 the"), (3, "w1 the"),
             (600, "w1 w2 " * 4000), (601, "x" * 50000)]
    return rows


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("chars,keys", [(4_000_000, 4_000_000), (200, 50)])
def test_equals_brute_force(docs, order, chars, keys):
    rows = sample()
    got = ngram_model.score_documents(docs(*rows).repartition(3), order=order, weight=0.4,
                                      block_chars=chars, bucket_keys=keys).collect()
    want = brute(rows, order, 0.4)
    key = lambda r: (repr(r[0]), r[2], round(r[6], 6))
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_mass_of_one_context_is_one(docs):
    """What can follow a context, the unknown token included, adds up to one."""
    rows = [(0, "a b"), (2, "a c"), (3, "a b"), (7, "b c a")]
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    probe = [(100 + i, f"a {w}") for i, w in enumerate(["a", "b", "c", "unknown"]) ]
    probe = [(next(k for k in range(1000 * (i + 1), 10**6) if zlib.crc32(str(k).encode()) % 5 == 1), t)
             for i, (_, t) in enumerate(probe)] + [
        (next(k for k in range(9000, 10**6) if zlib.crc32(str(k).encode()) % 5 == 1), "a")]
    scores = {r.doc_id: r.score for r in ngram_model.score_documents(docs(*train, *probe)).collect()}
    by = brute(train + probe, 2, 0.4)
    assert all(math.isclose(scores[r[0]], r[6]) for r in by)


def test_empty(docs):
    assert ngram_model.score_documents(docs((1, "a")).limit(0)).collect() == []
    only_held = docs((next(k for k in range(99) if zlib.crc32(str(k).encode()) % 5 == 1), "a b"))
    row = ngram_model.score_documents(only_held).collect()[0]
    assert (row.n_known, row.train_tokens, row.base_score, row.score) == (0, 0, 0.0, 0.0)
