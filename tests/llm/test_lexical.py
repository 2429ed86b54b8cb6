import math
import random
import re

import pytest

from starsift.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string, rank int, query int"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, k):
    held = [(i, terms(t)) for i, t in rows]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    out = []
    for item, text in items:
        found = []
        for i, words in held:
            m, score = 75 + 25 * len(words) * n // total, 0
            for t in terms(text):
                df, tf = sum(t in w for _, w in held), words.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    score += w * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s)
                for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, rows, items, **how):
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEM)
    return sorted((tuple(r) for r in lexical.lexical_search(docs(*rows), asked, **how).collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"block_docs": 40, "short": 0.01}, {"block_docs": 7, "short": 5, "group_items": 3}])
def test_equals_brute_force(spark, docs, how):
    pick = random.Random(4)
    word = lambda: f"w{int(pick.paretovariate(0.7)) % 300}"
    rows = [(i, " ".join(word() for _ in range(pick.randrange(1, 120)))) for i in range(260)]
    rows += [(300, None), (301, ""), (302, " -- \n"), (None, "w1 w2 w3 w3"), (303, "W1-w2,W3 w3"), (303, "W1-w2,W3 w3"),
             (304, "É é\u00a0x 中文 _w1_ w2"), (305, "w9 " * 3000)]
    items = [(i, " ".join(word() for _ in range(pick.randrange(1, 30)))) for i in range(8)]
    items += [(8, None), (9, "nowhere"), (None, "w1 W2 w3"), (1, "w1 w1 É 中文"), (1, "w1 w1 É 中文")]
    assert searched(spark, docs, rows, items, k=6, **how) == brute(rows, items, 6)


def test_none(spark, docs):
    assert searched(spark, docs, [(1, None)], [(1, "a")]) == []
    assert searched(spark, docs, [(1, "a")], []) == []
    assert searched(spark, docs, [(1, "a b")], [(7, "A")])[0][:3] == (7, 1, 1)


@pytest.mark.parametrize("size", [1, 5, 1 << 20])
def test_terms_over_pieces(size):
    text = "alpha BETA,gamma  x中文y " + "z" * 30 + "!"
    assert [w.decode() for part in lexical.terms_of(text.encode(), size) for w in part] == terms(text)
