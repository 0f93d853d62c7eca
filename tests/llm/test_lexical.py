"""Ranked lexical search (operator 12) against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import make_docs, odd_rows, prose  # noqa: F401

from martlake.llm import lexical

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, sum(c.values()), c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, n, _ in counted)
    df = Counter(w for _, _, c in counted for w in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, n, c in counted:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * ((10 ** 9 * c[w]) // (1000 * c[w] + 8 * m)) for w, q in Counter(terms(text)).items() if w in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, n long, doc_id string")


COLUMNS = ["item_id", "rank", "doc_id", "score"]


def test_terms_are_the_pattern():
    r = random.Random(2)
    for _ in range(300):
        t = "".join(chr(r.choice([r.randint(0, 127), r.randint(0, 127), r.randint(128, 0x2FF), 0x1F600]))
                    for _ in range(40))
        n, c = lexical.count_terms(t)
        assert (n, c) == (len(terms(t)), Counter(w.encode() for w in terms(t)))


def test_long_texts_are_counted_in_runs(monkeypatch):
    t = " ".join(f"w{i % 37},x{i % 11}" for i in range(3000))
    whole = lexical.count_terms(t)
    monkeypatch.setattr(lexical, "RUN_BYTES", 10)
    assert lexical.count_terms(t) == whole


@pytest.mark.parametrize("few,block", [(8, 1 << 14), (0, 50), (1, 7)])
def test_first_documents_equal_brute_force(spark, make_docs, odd_rows, prose, monkeypatch, few, block):  # noqa: F811
    monkeypatch.setattr(lexical, "FEW", few)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    rows = [(i, prose(5 + i % 90, i)) for i in range(200)]
    rows += [(300 + i, rows[7][1]) for i in range(30)]            # thirty equal ones: ties by id
    rows += [(5, rows[5][1].upper()), (5, rows[5][1])]            # ids that repeat
    rows += [*odd_rows, (None, "the river stone"), (901, "THE river, stone! é 日本")]
    asked = [(i, prose(12, 1000 + i)) for i in range(25)]
    asked += [(50, rows[7][1]), (51, ""), (52, None), (53, "nothing_of_this zzzz"), (54, "the the the river river"),
              (54, "the the the river river"), (54, "stone"), (None, "É 日本 é"), (56, "of")]
    want = plain(rows, [a for a in asked if a[1]])
    got = lexical.search(make_docs(rows), items_of(spark, asked)).select(COLUMNS).collect()
    same(got, want)


def test_items_come_in_blocks(spark, make_docs, prose, monkeypatch):  # noqa: F811
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", 20)
    rows = [(i, prose(30, i)) for i in range(60)]
    asked = [(i, prose(10, 500 + i)) for i in range(12)]
    same(lexical.search(make_docs(rows), items_of(spark, asked), k=4).select(COLUMNS).collect(), plain(rows, asked, 4))


def test_only_masks_that_can_win_are_scored():
    """Of 5,000 documents with a common word, only those with the rare words are scored."""
    n = 5000
    ids = list(range(n))
    terms_of = [[0, 1, 2] if i % 400 == 0 else [0] for i in ids]
    sizes = [len(t) for t in terms_of]
    flat = np.array([t for ts in terms_of for t in ts], np.int32)
    block = lexical.Block(ids, np.full(n, 100), np.concatenate([[0], np.cumsum(sizes)]), flat,
                          np.ones(len(flat), np.int64), n, n * 100)
    seen = []
    starts = block.starts

    class Watched(list):
        def __getitem__(self, i):
            seen.append(i)
            return starts[i]

    block.starts = Watched()
    best: list = []
    block.rank([(0, 3), (1, 5000), (2, 4000)], best, 10, np.zeros(3, np.int64))
    assert [d for _, _, d in best] == list(range(0, 4000, 400)) and len(seen) <= 2 * 13


def test_empty_tables(spark, make_docs):  # noqa: F811
    docs = make_docs([(1, "the river")])
    assert lexical.search(docs.limit(0), items_of(spark, [(1, "the")])).count() == 0
    assert lexical.search(docs, items_of(spark, [(1, "the")]).limit(0)).columns == COLUMNS
    assert lexical.search(make_docs([(1, None), (2, " .,")]), items_of(spark, [(1, "the")])).count() == 0
