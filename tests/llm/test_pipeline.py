import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from starsift.llm import bpe
from starsift.llm.queries import ORACLE, QUERIES

HEX = "0123456789abcdef0123456789"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with planted copies, toxic texts, secrets and two sources."""
    place = tmp_path_factory.mktemp("tables")
    rows, labels = [], []
    for i in range(200):
        text = " ".join(f"w{i}x{k}" for k in range(40))
        toxic = i % 8 == 0
        if toxic:
            text += " you idiot and moron and scum, stupid trash"
        if i % 10 == 3:
            text += f" token = {HEX}"
        rows.append((i, text, "en", "a" if i % 2 else "b", len(text)))
        labels.append((i, 1, int(toxic)))
    same = rows[1][1]
    rows += [(300 + k, same, "en", "a", len(same)) for k in range(20)]
    rows += [(400, None, None, None, None), (401, "", "en", "b", 0), (None, "no id here", "en", "b", 10)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return str(place)


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        kept = docs.collect()
        docs = spark.createDataFrame(kept, docs.schema)
        seen.append(kept)
        if name != "bpe":
            assert docs.columns == columns
    start, clean, single, masked, mixed, encoded = seen
    assert {r.doc_id for r in start} - {r.doc_id for r in clean} == {i for i in range(0, 200, 8)}
    gone = {r.doc_id for r in clean} - {r.doc_id for r in single}
    assert gone == {*range(300, 320), 401}
    texts = {r.doc_id: r.text for r in masked}
    assert len(masked) == len(single) and not any(HEX in (t or "") for t in texts.values())
    assert texts[3].endswith(" [secret]") and texts[1] == {r.doc_id: r.text for r in start}[1]
    size = {}
    for r in masked:
        size[r.source] = size.get(r.source, 0) + len((r.text or "").split())
    # Half as many words again in all: a and b weigh 5 and 2; the null source has no words.
    total = 1.5 * sum(size.values())
    got = {}
    for r in mixed:
        got[r.source] = got.get(r.source, 0) + len((r.text or "").split())
    assert abs(got["a"] - total * 5 / 7) <= 45 and abs(got["b"] - total * 2 / 7) <= 45
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in mixed:
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.append((r.doc_id, hashlib.sha256(ids).hexdigest(), ids))
    assert sorted(((r.doc_id, r.ids_sha256, bytes(r.ids)) for r in encoded), key=repr) == sorted(want, key=repr)


def test_run_equals_its_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, out.drop("ids").collect())) == sorted(map(repr, again.drop("ids").collect()))
    assert out.count() > 150


def test_queries_and_sql_are_registered():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 11)) and set(ORACLE) <= set(QUERIES)
    assert zlib.crc32(b"1") and bpe.CHUNK


def test_unused_arrow_memory_goes_back_after_each_batch(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa

    from starsift.llm import common

    calls = []
    pool = SimpleNamespace(release_unused=lambda: calls.append(1))
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 700_000, None, "b" * 700_000, ""]})
    parts = list(common.by_bytes(iter([batch, batch]), "text"))
    assert len(calls) == 2 and sum(p.num_rows for p in parts) == 8 and len(parts) == 4
    assert sum(p.num_rows for p in common.sliced(iter([batch] * 3), 3)) == 12 and len(calls) == 5
