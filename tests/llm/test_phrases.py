"""Phrase collocations (operator 13) against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import make_docs, odd_rows, prose  # noqa: F401

from martlake.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for p in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall("[^\x20\x09]+", p)


def all_counts(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang or "und", " ".join(w[i:i + k])] += 1
    return f, n


def plain(rows, least=100, top=2000, cover=100):
    f, n = all_counts(rows)
    found = {g: a for g, a in f.items() if a >= least and " " in g[1]}
    held: dict = defaultdict(int)
    for (lang, p), a in found.items():
        w = p.split(" ")
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = lang, " ".join(w[i:i + size])
                held[key] = max(held[key], a)
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if held[lang, p] and 100 * held[lang, p] >= cover * a:
            continue
        w = p.split(" ")
        score, _, lr = min((1000 * a * n[lang] // (f[lang, x] * f[lang, y]), k, (f[lang, x], f[lang, y]))
                           for k in range(1, len(w)) for x, y in [(" ".join(w[:k]), " ".join(w[k:]))])
        out[lang].append((-score, -a, p.encode(), lr))
    return sorted((lang, r, p.decode(), -a, lr[0], lr[1], n[lang], -s) for lang, rows in out.items()
                  for r, (s, a, p, lr) in enumerate(sorted(rows)[:top], 1))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 3, 4) for i, (t, lang) in enumerate(rows)],
                                 "doc_id long, text string, lang string, phrase string, k int, f long").repartition(3)


def corpus(seed, n=120):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["The", "OF", "é\xa0日", "a\x1cb"]
    fixed = ["new york city", "in spite of the", "one two three four five six"]
    out = []
    for _ in range(n):
        t = []
        for _ in range(r.randint(0, 60)):
            t.append(r.choice(fixed) if r.random() < 0.2 else r.choice(words[:3] if r.random() < 0.4 else words))
            t.append(r.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r\n", ";"]))
        out.append(("".join(t), r.choice(["en", "en", None, "fr"])))
    return out


ODD = [(None, "en"), ("", "en"), (" \t.,;\n", None), ("one", "xx"), ("x" * 5000, "en"), ("one two three four five six", "en")]


@pytest.mark.parametrize("least,sample,bits", [(5, 8, 1 << 28), (5, 50, 1 << 12), (20, 2, 1 << 12)])
def test_phrases_equal_brute_force(spark, monkeypatch, least, sample, bits):
    monkeypatch.setattr(phrases, "HELD", 500)
    monkeypatch.setattr(phrases, "HELD_PHRASES", 60)
    monkeypatch.setattr(phrases, "PART_CHARS", 2000)
    monkeypatch.setattr(phrases, "RUN_BYTES", 3000)
    monkeypatch.setattr(phrases, "SAMPLE", sample)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    rows = corpus(least) + ODD
    rows += rows[:10]                # repeated rows count again
    got = phrases.collocations(frame(spark, rows), least, top=30).collect()
    assert sorted(map(tuple, got)) == plain(rows, least, 30)
    found = phrases.frequent_phrases(frame(spark, rows), least)
    f, n = all_counts(rows)
    want = {g: a for g, a in f.items() if a >= least}
    assert {(r["lang"], r["phrase"]): r["f"] for r in found.where("k > 0").collect()} == want
    assert {r["lang"]: r["f"] for r in found.where("k = 0").collect()} == {k: v for k, v in n.items() if k in
                                                                           {r[1] or "und" for r in rows if r[0]} and v}


def test_border_failures_are_followed(spark, monkeypatch):
    """Nothing is in the sample, so that every phrase comes from the border and its expansion."""
    monkeypatch.setattr(phrases, "SAMPLE", 1 << 40)
    rows = corpus(3, 60)
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows), 8).collect())) == plain(rows, 8)


class Exact:
    """A filter without mistakes."""

    def __init__(self, hashes):
        self.hashes = hashes

    def has(self, h):
        return np.isin(h, self.hashes)


def hashes_of(found):
    out = []
    for p in found:
        words = phrases.word_hashes("en", p.split(b" "))
        h = words[:1]
        for w in words[1:]:
            h = phrases.longer(h, np.array([w]))
        out.append(h[0])
    return np.array(out, np.uint64)


def test_hashes_that_meet_only_cost_time(monkeypatch):
    """All hashes of longer phrases collide in 64 values: every frequent phrase is still counted, by itself."""
    longer = phrases.longer
    monkeypatch.setattr(phrases, "longer", lambda h, w: longer(h, w) % np.uint64(64))
    text = b" ".join(random.Random(4).choices([b"a", b"b", b"c", b"d", b"e"], k=900))
    sums: Counter = Counter()
    for k, _, h, at, _ in phrases.levels(text, "en", 0, [], None, 5, False):
        if k:
            sums.update(h[at].tolist())
    known = Exact(np.array([x for x, n in sums.items() if n >= 20], np.uint64))
    got = {p: f for k, p, f in phrases.count_run(text, "en", 0, [(5, known)]) if k}
    words = text.split()
    whole = Counter(b" ".join(words[i:i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    assert all(f == whole[p] for p, f in got.items())
    assert {p for p, f in whole.items() if f >= 20} <= set(got)


def counted(text, steps, guess, longest=5):
    return {b" ".join([words[w] for w in a[i:i + k]]) for k, a, _, at, words in
            phrases.levels(text, "en", 0, steps, guess, longest, False) if k for i in at.tolist()}


def test_a_pass_counts_the_proposed_phrases_and_their_border():
    """Counted is what has both parts in the guess; the last pass has every frequent phrase."""
    text = b" ".join(random.Random(9).choices([b"a", b"b", b"c", b"d"], k=400))
    whole = {p: f for k, p, f in phrases.count_run(text, "en", 0, []) if k}
    frequent = {p for p, f in whole.items() if f >= 20}
    border = lambda s: {p for p in whole if b" " not in p or {p.rsplit(b" ", 1)[0], p.split(b" ", 1)[1]} <= s}
    for guess in (frequent, {p for p in frequent if b"a" not in p}, set()):
        first = counted(text, [], Exact(hashes_of(guess)))
        assert first == border(guess)
        known = Exact(hashes_of(first & frequent))
        last = {p: f for k, p, f in phrases.count_run(text, "en", 0, [(5, known)], Exact(hashes_of(guess))) if k}
        assert frequent <= set(last) and all(f == whole[p] for p, f in last.items())
        assert guess != frequent or set(last) == frequent
    assert counted(text, [], None, 2) == {p for p in whole if p.count(b" ") < 2}


def test_sums_of_hashes():
    a, b = np.array([5, 7, 9], np.uint64), np.array([1, 7, 2 ** 64 - 1], np.uint64)
    key, count = phrases.summed([a, b], [np.array([1, 2, 3]), np.array([4, 5, 6])])
    assert key.tolist() == [1, 5, 7, 9, 2 ** 64 - 1] and count.tolist() == [4, 1, 7, 3, 6]


@pytest.mark.parametrize("size", [12, 60, 700])
def test_runs_of_long_texts(size):
    r = random.Random(size)
    text = "".join(r.choice(["aa", "b", "ccc", "d" * 30]) + r.choice([" ", " ", " ", "  ", "\n"]) for _ in range(900)).encode()
    whole, parted = Counter(), Counter()
    for p in text.split(b"\n"):
        w = p.split()
        whole[0, b""] += len(w)
        for k in range(1, 6):
            for i in range(len(w) - k + 1):
                whole[k, b" ".join(w[i:i + k])] += 1
    for part, skip in phrases.runs(text, size):
        for k, p, f in phrases.count_run(part, "en", skip, []):
            parted[k, p] += f
    assert parted == whole


def test_hashes_that_meet_are_told_apart():
    a = np.array([1, 2, 1, 2, 1, 3])
    h = np.zeros(6, np.uint64)
    got = {tuple(a[i:i + 2].tolist()): c for i, c in phrases.distinct(a, h, np.arange(5), 2)}
    assert got == {(1, 2): 2, (2, 1): 2, (1, 3): 1}


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    rows = [("en", 0, "", 4 * big), ("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 1)]
    found = spark.createDataFrame(rows, "lang string, k int, phrase string, f long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: found)
    got = phrases.collocations(found).collect()
    assert got[0]["score"] == 1000 * (big - 1) * 4 * big // (big * (big + 7))


def test_empty_table(spark):
    assert phrases.collocations(frame(spark, ODD).limit(0)).count() == 0
    assert phrases.collocations(frame(spark, [(None, "en"), ("", None)])).count() == 0
