import random
import zlib

import numpy as np
import pytest

from starsift.llm import toxicity


def corpus(n=1500, seed=4, stems=("zorgl", "quav")):
    """Clean texts, and toxic ones that hold an insult or words with a certain beginning."""
    pick = random.Random(seed)
    syllables = ["ta", "ri", "mo", "lun", "pe", "so", "ka", "ven", "du"]
    word = lambda: "".join(pick.choice(syllables) for _ in range(pick.randrange(1, 5)))
    rows, labels = [], {}
    for i in range(n):
        words = [word() for _ in range(pick.randrange(5, 80))]
        bad = pick.random() < 0.12
        if bad:
            kind = pick.randrange(3)
            for _ in range(pick.randrange(2, 6)):
                w = pick.choice(["idiot", "Scum,", "moron!"]) if kind == 0 else stems[kind - 1] + word()
                words.insert(pick.randrange(len(words) + 1), w)
        rows.append((i, " ".join(words)))
        labels[i] = int(bad)
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def fitted(spark, docs):
    rows, truth = corpus()
    table = spark.createDataFrame([(i, None, t) for i, t in truth.items() if i % 5 < 3]
                                  + [(None, 1, 1), (7, None, None), (99999, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    frame = docs(*rows, (None, "no id"), (5000, None), (5001, ""), (3, rows[3][1]), (5002, "tamo " * 30000))
    model = toxicity.fit_toxicity(frame, table, sample=400)
    return frame, model, truth, table


def test_held_out_texts_are_told(fitted):
    frame, model, truth, _ = fitted
    out = toxicity.score_toxicity(frame, model).collect()
    assert len(out) == frame.count()
    by = {r.doc_id: r for r in out}
    mine = [r for r in out if r.doc_id in truth and held(r.doc_id)]
    assert all(r.held_out == held(r.doc_id) for r in out if r.doc_id is not None)
    assert not by[None].held_out
    hit = sum(r.predicted == 1 for r in mine if truth[r.doc_id])
    assert hit >= 0.95 * sum(truth[r.doc_id] for r in mine)
    assert sum(r.predicted == 1 for r in mine if not truth[r.doc_id]) <= 0.01 * len(mine)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert by[5000].score == by[5001].score == by[5002].score < 0.5


def test_rejected_texts_go_and_clean_ones_stay(fitted):
    frame, model, truth, _ = fitted
    out = toxicity.without_toxic(frame, model)
    assert out.columns == frame.columns
    kept = [r.doc_id for r in out.collect()]
    clean = [i for i, t in truth.items() if not t]
    assert len(set(clean) & set(kept)) >= 0.99 * len(clean)
    assert len([i for i in kept if truth.get(i)]) <= 0.05 * sum(truth.values())


def test_held_out_rows_change_nothing(fitted, docs, spark):
    frame, model, truth, table = fitted
    other = frame.selectExpr(
        "doc_id", "case when doc_id is not null and crc32(cast(doc_id as string)) % 5 = 0 "
        "then 'idiot scum changed' else text end as text")
    again = toxicity.fit_toxicity(other, table.selectExpr(
        "doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic"),
        sample=400)
    assert again.terms == model.terms
    assert np.allclose(again.weights, model.weights)


def test_label_model_finds_accuracies(spark):
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.2
    on, off = np.array([0.7, 0.5, 0.6, 0.4]), np.array([0.02, 0.05, 0.01, 0.1])
    x = rng.random((20000, 4)) < np.where(y[:, None], on, off)
    x = np.hstack([x, x[:, 3:4]])
    masks, n = np.unique(x @ (1 << np.arange(5)), return_counts=True)
    frame = spark.createDataFrame([(int(m), int(c), 0, 0) for m, c in zip(masks, n)],
                                  "votes long, n long, n_toxic long, n_clean long")
    model = toxicity.fit_label_model(frame, 5, rounds=25)
    assert abs(model.prior - 0.2) < 0.05
    assert np.allclose(model.on_toxic[:3], on[:3], atol=0.08) and np.allclose(model.on_clean[:3], off[:3], atol=0.03)
    assert model.own[3] < 0.75 and model.own[4] < 0.75 and (model.own[:3] > 0.9).all()


def test_without_labels_or_rows(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(i, "you idiot, you moron" if i % 3 == 0 else "a plain text") for i in range(60)]
    model = toxicity.fit_toxicity(docs(*rows), none)
    out = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs(*rows), model).collect()}
    assert out == {i: int(i % 3 == 0) for i in range(60)}
    empty = docs((1, "a")).limit(0)
    model = toxicity.fit_toxicity(empty, none)
    assert toxicity.score_toxicity(empty, model).collect() == []
    assert model.score([]) < 0.5
