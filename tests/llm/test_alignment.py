import hashlib
from collections import Counter

import pytest
import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from starsift.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", " ", "  ", "a ", " a", "a  b", "a\n b", "a \n b", "你好 🙂🙂 x", "a   b", "x▁y z", "<s> <|endoftext|> <0x41>", "a\x00b c",
       "\u3000 a\u00a0 b", "é\u0301 ñ", "it's  don't", "𐍈𐍈 \U0001F9FF\U0001FAE8 q", "\x85 a\x1c b", "w" * 200 + " w", "\r\n\tx  \t y"]


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


def plain(aligner, text):
    """(ids of A, ids of B, groups, links) by the bytes of the tokens of whole texts."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a, parts_b = [aligner.bytes_a[i] for i in ids_a], [aligner.bytes_b[i] for i in ids_b]
    raw = (" " + text).encode()
    if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
        return None

    def ends(parts):
        out = [0]
        for p in parts:
            out.append(out[-1] + len(p))
        return out[1:]

    at_a, at_b = ends(parts_a), ends(parts_b)
    groups, links, i, j = [], [], 0, 0
    for cut in sorted(set(at_a) & set(at_b)):
        p, q = at_a.index(cut) + 1, at_b.index(cut) + 1
        groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
        links.append((ids_a[p - 1], ids_b[q - 1]))
        i, j = p, q
    return len(ids_a), len(ids_b), ";".join(groups), links


def test_rows_equal_the_alignment_of_whole_texts(docs, aligner):
    texts = [*ODD, "the cat sat on the mat", "the cat sat on the mat", "The Cat, the hat", None, ""]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    known = [plain(aligner, t or "") for t in texts]
    assert sum(k is not None for k in known) > 15 and known[ODD.index("x▁y z")] is None
    count = Counter(link for k in known if k for link in k[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    want = []
    for (i, _), k in zip(rows, known, strict=True):
        if k is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = k
        want.append((i, n_a, n_b, len(links), len(links), sum(count[x] == most[x[1]] for x in links),
                     sum(count[x] for x in links), hashlib.sha256(groups.encode()).hexdigest()))
    found, pairs = alignment.align_tokens(docs(*rows), A, B)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert {((r.id_a, r.id_b), r.n, r.best) for r in pairs.collect()} == {
        (x, n, n == most[x[1]]) for x, n in count.items()}


def test_units_meet_again_over_generations(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "_UNITS", 3)
    monkeypatch.setattr(alignment, "_TOGETHER", 2)
    for text in [*ODD, *reversed(ODD)]:
        want = plain(aligner, text)
        got = aligner.align(alignment.units_of(text))
        assert (want is None) == any(g is None for g in got)
        assert want is None or want[2] == ";".join(g[2] for g in got)


def test_empty(docs):
    found, pairs = alignment.align_tokens(docs((1, "a")).limit(0), A, B)
    assert found.collect() == [] and pairs.collect() == []


def test_tokenizers_that_are_not_of_the_kind():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as a, open(B, "rb") as b:
        with pytest.raises(ValueError):
            alignment.Aligner(a.read(), b.read())
