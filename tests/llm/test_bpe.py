import json
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starsift.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_definition(PATH))


BITS = ["hello", "World", "it's", "'s", "'LL", "don't", "12", "3.14", "naïve", "ÉCOLE", "straße", "ß", "İ", "ΑΣ", "é", "<|endoftext|>",
        "<|startoftext|>", "<|", " ", " ", "\x85", "\x1c", "😀", "漢字", "²", "ª", "×", "%%%", "''", "a" * 300, "́", "ſ", "K"]


def test_words_equal_the_library(library, encoder):
    pick = random.Random(1)
    for _ in range(4000):
        text = "".join(pick.choice([*BITS, " ", " ", "\n", "\t"]) for _ in range(pick.randrange(14)))
        want = library.encode(text, add_special_tokens=False).ids
        raw = encoder.encode(text.encode())
        assert np.frombuffer(raw, "<u4").tolist() == want, repr(text)
        assert encoder.decode(raw) == library.decode(want, skip_special_tokens=False)


def test_memory_of_words_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "_WORDS", 50)
    monkeypatch.setattr(bpe, "_PIECES", 50)
    small = bpe.Encoder(bpe.read_definition(PATH))
    for n in range(1000):
        assert small.encode(f"w{n} of the x{n % 7}".encode()) == encoder.encode(
            f"w{n} of the x{n % 7}".encode())
        assert len(small) <= 50 and len(small.pieces) <= 50 and len(small.old) <= 50


def test_chunks_follow_content():
    pick = random.Random(2)
    shared = " ".join(f"wörd{pick.randrange(9999)}" for _ in range(3000))
    parts = []
    for lead in ("", "other beginning é ", "x" * 777):
        raw = (lead + shared).encode()
        ends = bpe.chunk_ends(raw)
        assert ends[-1] == len(raw) and ends == sorted(set(ends))
        assert ends == bpe.chunk_ends(raw, piece=1000)
        sizes = np.diff([0, *ends])
        assert sizes.max() <= bpe.CHUNK[2] and (sizes[:-1] >= bpe.CHUNK[0]).all()
        for s, e in zip([0, *ends], ends):
            raw[s:e].decode()
        parts.append({raw[s:e] for s, e in zip([0, *ends], ends)})
    assert len(parts[0] & parts[1] & parts[2]) > 0.8 * len(parts[0])
    assert bpe.chunk_ends(b"") == [] and bpe.chunk_ends(b"ab") == [2]
    long = "é".encode() * 40000
    assert all(len(long[s:e]) % 2 == 0 for s, e in zip([0, *bpe.chunk_ends(long)], bpe.chunk_ends(long)))


def sample():
    pick = random.Random(3)
    words = [pick.choice(BITS[:20]) + str(pick.randrange(50)) for _ in range(400)]
    passage = " ".join(pick.choice(words) for _ in range(900))
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randrange(0, 300)))) for i in range(60)]
    rows += [(100 + i, f"lead{i} " * (i + 1) + passage + f" tail{i}") for i in range(20)]
    rows += [(200 + i, passage) for i in range(30)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (None, passage), (200, "same id"), (303, "x" * 40000),
             (304, ("y" * 20000 + " ") * 3), (305, "x" * 40000), (306, "short"), (307, "short"), (308, "z" * 5000 + passage)]
    return rows


def test_documents_equal_the_library(docs, library):
    rows = sample()
    got = sorted((tuple(r) for r in bpe.token_digests(docs(*rows).repartition(4), PATH).collect()), key=repr)
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_shared_chunks_are_found_and_bits_agree(docs, spark):
    rows = sample()
    bits = bpe._shared_bits(docs(*rows).repartition(3))
    counts = {}
    for _, text in rows:
        for c in bpe._chunks((text or "").encode()):
            counts[bpe._digest(c)] = counts.get(bpe._digest(c), 0) + 1
    for digest, n in counts.items():
        byte, mask = bpe._bit_at(bpe._bit(digest))
        assert bool(bits[byte] & mask) == (n > 1)
    assert bpe._bit_at(0) == (0, 1)
    got = spark.sql("select bitmap_bucket_number(32768L) a, bitmap_bit_position(32768L) b, "
                    "bitmap_bucket_number(32769L) c, bitmap_bit_position(32769L) d").first()
    for bit, (page, place) in ((32768, (got.a, got.b)), (32769, (got.c, got.d))):
        assert bpe._bit_at(bit) == (page * 4096 + place // 8, 1 << place % 8)


def test_empty(docs):
    assert bpe.token_digests(docs((1, "a")).limit(0), PATH).collect() == []


def test_rules_that_may_join_words_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(bpe.read_definition(public_tokenizers.path("byte_bpe_50k.json")))


def test_a_decoder_of_the_definition_is_used():
    definition = bpe.read_definition(public_tokenizers.path("word_bpe_49k.json"))
    rules = json.loads(definition)
    rules["decoder"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    encoder = bpe.Encoder(json.dumps(rules))
    ids = encoder.encode(b"hello world")
    assert encoder.decode(ids) == encoder.tokenizer.decode(list(np.frombuffer(ids, "<u4")), skip_special_tokens=False)
    assert encoder.decode(ids) != bpe.Encoder(definition).decode(ids)


def test_copies_next_to_each_other_do_not_share_chunks(spark):
    words = random.Random(4)
    texts = [" ".join(words.choice("abcdefgh") * words.randrange(1, 9) for _ in range(600)) for _ in range(3)]
    rows = [(i, t) for i, t in enumerate([texts[0]] * 3 + [texts[1], None, None, texts[2], texts[2]])]
    batch = pa.RecordBatch.from_pylist([{"text": t} for _, t in rows], pa.schema([("text", pa.string())]))
    for told in bpe._counted(iter([batch])):
        assert set(told.column("n").to_pylist()) == {1}
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING").coalesce(1)
    library = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r["ids_sha256"] for r in bpe.token_digests(docs, PATH).collect()}
    assert got == {
        i: hashlib.sha256(np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()
        for i, t in rows
    }
