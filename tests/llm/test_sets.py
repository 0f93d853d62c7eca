"""Mixing, dedup, archives, url rules, vector search and the pipeline against brute force."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from llm_fixtures import make_docs, odd_rows, prose  # noqa: F401
from martlake.llm import mixing, near_dedup, prefix_forest, setsketch, substring_dedup, url_rules, warc, wordhash
from martlake.llm.common import table
from martlake.llm.graph import components


# ---- hashes ---------------------------------------------------------------

def test_window_hashes_tell_words_apart():
    data = b"a b c a b c  a\tb\nd " * 3
    words = data.split()
    h = wordhash.word_hashes(data)
    assert len(h) == len(words) == len(wordhash.word_starts(data))
    assert len(set(h.tolist())) == len(set(words))
    for size in (1, 2, 3, 5, 18):
        w = wordhash.window_hashes(h, size)
        plain = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
        assert len(set(zip(w.tolist(), plain, strict=True))) == len(set(plain)) == len(set(w.tolist()))
    assert not len(wordhash.word_hashes(b"")) and not len(wordhash.word_hashes(b" \n"))


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    data = b" ".join(bytes(random.Random(i).choices(b"abcdef", k=i % 30 + 1)) for i in range(300)) + b"  "
    whole = wordhash.word_hashes(data)
    monkeypatch.setattr(wordhash, "PIECE", 7)
    assert (wordhash.word_hashes(data) == whole).all()


# ---- mixing ---------------------------------------------------------------

def plain_targets(sizes, weights=(1, 2, 3), times=3):
    """Reshare by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > times * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: times * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 900, "b": 20, "c": 30, "d": 500, None: 4}, {"a": 5, "b": 5}, {"z": 7},
                                   {"a": 1000, "b": 1, "c": 1, "d": 0}])
def test_targets_equal_resharing(spark, sizes):
    frame = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())],
                                  "doc_id long, source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    for s, t in plain_targets(sizes).items():
        assert got[s] == pytest.approx(t)


def test_golden_points_are_exact(spark):
    rows = mixing.golden_points(spark, 5000).collect()
    assert all(r.point == r.slot * mixing.GOLDEN % (1 << mixing.POINT_BITS) for r in rows)
    assert mixing.GOLDEN / (1 << mixing.POINT_BITS) == pytest.approx((5 ** 0.5 - 1) / 2, abs=1e-11)


def test_mix_comes_near_targets(make_docs, odd_rows, prose):
    rows = [(i, prose(20 + i % 90, i)) for i in range(300)]
    rows += [(5, prose(40, 1)), (5, prose(40, 1)), *odd_rows]
    docs = make_docs(rows, lambda i: None if i is None or i % 7 == 0 else f"s{i % 5 if i % 3 else 0}")
    got = mixing.mix(mixing.document_sizes(docs))
    taken = got["taken"].collect()
    assert len(taken) == len(rows) and all(r.taken <= 3 * r.size for r in taken)
    words, target, size = Counter(), {}, Counter()
    for r in taken:
        words[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
    for s in target:
        assert abs(words[s] - target[s]) <= 4 and {r.source_size for r in taken if r.source == s} == {size[s]}
    again = mixing.mix(mixing.document_sizes(docs.repartition(7)))["taken"]
    assert sorted(map(str, taken)) == sorted(map(str, again.collect()))
    ranks = got["draws"].groupBy("place", "block", "epoch").count()
    assert ranks.where("count > 1").isEmpty()
    assert mixing.mix(mixing.document_sizes(docs.limit(0)))["taken"].isEmpty()
    blank = mixing.mix(mixing.document_sizes(docs.where("doc_id = 901")))["taken"].collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)]


def test_the_layout_is_one_stream_a_source(spark, monkeypatch):
    """Starts follow one another without a gap, however documents fall into buckets and groups of buckets."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    monkeypatch.setattr(mixing, "GROUP_BUCKETS", 4)
    sizes = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("source"),
                                    (F.col("id") % 7).alias("size"))
    targets = mixing.source_targets(sizes)
    rows = mixing.lay_out(sizes, targets, 300, 7).orderBy("place", "start").collect()
    for place in (0, 1):
        at = 0
        for r in (r for r in rows if r.place == place):
            assert r.start == at
            at += r.size
        assert at == sum(i % 7 for i in range(300) if (i % 3 > 0) == (place == 0))


def test_small_sources_are_in_the_mix(spark):
    sizes = [(i, "ab"[i % 2], 10_000_000) for i in range(40)]
    sizes += [(100 + i, "m", 20) for i in range(20)]              # a millionth of the total
    sizes += [(200, "n", 1520), (300, "o", 1), (301, "o", 6)]      # 1520: a block of the large sources, about
    frame = spark.createDataFrame(sizes, "doc_id long, source string, size long")
    got = mixing.mix(frame)["taken"].groupBy("source").agg(F.sum("taken").alias("words"), F.first("target").alias("t"),
                                                           F.first("source_size").alias("size")).collect()
    for r in got:
        assert abs(r.words - r.t) <= max(4, 0.01 * r.t) and r.words <= 3 * r.size, r


def test_mixed_documents_hold_the_words_taken(make_docs, odd_rows, prose):
    rows = [(i, prose(30 + i % 40, i)) for i in range(60)] + odd_rows + [(3, prose(33, 3))]
    docs = make_docs(rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter()
    whole = defaultdict(set)
    for i, t in rows:
        whole[i].add(" ".join((t or "").split()))
    for r in out.collect():
        assert any(x.startswith(" ".join(r.text.split())) for x in whole[r.doc_id])
        got[r.source] += len(r.text.split())
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").split())
    for s, t in plain_targets(dict(sizes)).items():
        assert abs(got[s] - t) <= 4
    assert mixing.mixed_documents(docs.limit(0)).isEmpty()


# ---- substring dedup ------------------------------------------------------

def plain_repeats(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("window,block", [(35, 18), (9, 5), (3, 2)])
def test_repeats_equal_brute_force(make_docs, odd_rows, prose, monkeypatch, window, block):
    r = random.Random(window)
    passages = [prose(r.randint(window - 2, 3 * window), 100 + i) for i in range(6)]
    rows = [(i, f"{prose(r.randint(0, 50), i)} {r.choice(passages)}\n{prose(r.randint(0, 50), 1000 + i)} "
                f"{r.choice(passages)}") for i in range(50)]
    rows += [(60, prose(40, 60)), (61, prose(40, 60)), (60, prose(40, 60)), (70, "w " * 4 * window), *odd_rows]
    monkeypatch.setattr(substring_dedup, "PACK_BYTES", 2000)
    monkeypatch.setattr(substring_dedup, "BUCKET_ROWS", 500)
    got = substring_dedup.remove_repeats(make_docs(rows), window, block).collect()
    want = [(i, *x) for (i, _), x in zip(rows, plain_repeats([t for _, t in rows], window), strict=True)]
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_repeats_of_nothing(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    assert substring_dedup.remove_repeats(docs.limit(0)).isEmpty()
    assert sum(r.n_removed for r in substring_dedup.remove_repeats(docs).collect()) == 0
    with pytest.raises(ValueError):
        substring_dedup.repeats(docs, 10, 6)


def test_hashes_travel_unchanged():
    h = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (substring_dedup.read_hashes(substring_dedup.write_hashes(h)) == h).all()


# ---- near-duplicates ------------------------------------------------------

def plain_components(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    low = [i for i, _ in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    group[root(a)] = root(b)
    best = {}
    for k, i in enumerate(low):
        if i is not None:
            best[root(k)] = min(i, best.get(root(k), i))
    return [(i, len(sets[k]), i if not sets[k] else best.get(root(k))) for k, i in enumerate(low)]


def near_rows(prose, r, n_bases=12):
    rows, k = [], 0
    for b in range(n_bases):
        words = prose(r.randint(30, 120), 7000 + b).split()
        for _ in range(r.choice([1, 2, 5, 25])):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 14))):
                copy[r.randrange(len(copy))] = f"new{r.randint(0, 10 ** 6)}"
            rows.append((k, " ".join(copy) if r.random() < 0.7 else " ".join(copy).title()))
            k += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(make_docs, odd_rows, prose, monkeypatch, seed):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 4)
    rows = near_rows(prose, random.Random(seed)) + odd_rows + [(0, prose(50, 1)), (0, prose(50, 2)), (500, "One two"),
                                                               (501, "one TWO"), (None, "one two"), (None, "solo text x")]
    got = near_dedup.near_duplicates(make_docs(rows)).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(plain_components(rows), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_dropping_keeps_one_of_each(make_docs, odd_rows, prose):
    rows = near_rows(prose, random.Random(4), 6) + odd_rows + [(901, ""), (700, prose(60, 9)), (700, prose(60, 9))]
    docs = make_docs(rows)
    out = near_dedup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    want = Counter(i for i, n, c in set(plain_components(rows)) if n and i == c)
    want += Counter(i for i, n, _ in plain_components(rows) if not n)
    assert Counter(r.doc_id for r in out.collect()) == want | Counter({None: 1})
    assert near_dedup.drop_near_duplicates(docs.limit(0)).isEmpty()
    assert near_dedup.near_duplicates(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("bits", [0, 3])
def test_classes_whose_names_meet_are_told_apart(make_docs, odd_rows, prose, bits):
    """With a first digest of few bits many sets have one name; the second digest keeps them apart."""
    rows = [(i, prose(30 + i % 5, i % 25)) for i in range(60)] + odd_rows
    docs = make_docs(rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got, want = (sorted((tuple(r) for r in near_dedup.judge_rows(docs, b).drop("one", "two").collect()), key=key)
                 for b in (bits, 64))
    assert got == want
    kept = [sorted((tuple(r) for r in near_dedup.drop_near_duplicates(docs, b).collect()), key=key) for b in (bits, 64)]
    assert kept[0] == kept[1] and len(kept[0]) == 25 + 6


def test_columns_named_as_those_used_inside(make_docs, prose):
    docs = make_docs([(i, prose(40, i // 2)) for i in range(20)])
    clash = docs.withColumns({c: F.lit(i) for i, c in enumerate(
        ("__class_one", "__class_two", "__id", "__one", "__two", "__tag", "__size", "__taken", "__rest", "packed", "node"))})
    out = near_dedup.drop_near_duplicates(clash)
    assert out.columns == clash.columns and out.count() == 10
    mixed = mixing.mixed_documents(clash)
    assert mixed.columns == clash.columns and mixed.count() == mixing.mixed_documents(docs).count()


def test_rows_that_differ_by_nulls_or_in_a_map_stay_apart(spark):
    rows = [(1, "a b c", None, "s", {"x": 1}), (1, "a b c", "s", None, {"x": 1}), (1, "a b c", "s", None, {"x": 2})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, m map<string,int>")
    got = mixing.mixed_documents(docs).collect()
    assert {(r.lang, r.source, r.m["x"]) for r in got} == {(None, "s", 1), ("s", None, 1), ("s", None, 2)}


def test_sketches_estimate_and_merge():
    r = np.random.default_rng(2)
    for overlap in (0.3, 0.6, 0.8, 0.95):
        n = 2000
        both = r.integers(0, 1 << 63, int(2 * n * overlap / (1 + overlap)), dtype=np.uint64)
        a, b = (np.concatenate([both, r.integers(0, 1 << 63, n - len(both), dtype=np.uint64)]) for _ in range(2))
        x, y = (setsketch.sketch(s, np.array([0])) for s in (a, b))
        assert abs((x == y).mean() - overlap) < 0.12
        size = np.array([n])
        grid = np.linspace(0, 0.999, 400)
        one = np.ones((1, 1))
        like = setsketch.log_likelihood(grid[None], (x > y).sum() * one, (x < y).sum() * one, (x == y).sum() * one,
                                        n * one, n * one)
        assert abs(grid[like.argmax()] - overlap) < 0.12
        assert setsketch.may_reach(x, y, size, size, 0.8)[0] == (overlap >= 0.7)
        union = setsketch.sketch(np.unique(np.concatenate([a, b])), np.array([0]))
        assert (setsketch.merge(x, y) == union).all()


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (7, 7), (200, 201), (201, 200)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    roots = {0: 0, 99: 99, 200: 200}       # a component's smallest node may be left out
    assert got | roots == {i: 0 for i in range(61)} | {99: 99, 100: 99, 200: 200, 201: 200}
    assert components(edges.limit(0)).isEmpty()


# ---- archives -------------------------------------------------------------

PAGES = [(1, "http://a/x", "<p>one</p>"), (2, "http://a/y", "<p>one</p>"), (0, None, "<p>two\r\n\r\nWARC/1.1\r\n</p>"),
         (5, "http://b/\r\nX: y", None), (6, "http://b", ""), (None, "http://c", "<p>one</p>"), (None, "http://d", "alone"),
         (1, "http://a/x", "<p>one</p>"), (9, "u", "é中" * 3000)]


def test_archives_round_trip(spark, monkeypatch):
    pages = spark.createDataFrame([(*p, "x", 3) for p in PAGES],
                                  "page_id long, url string, html string, record_type string, payload_bytes long")
    pages = pages.select("page_id", "url", "html")
    raw = warc.archive_pages(pages)
    back = warc.read_archive(spark, raw, payloads=True).collect()
    assert sorted((str(r.page_id), r.payload) for r in back) == sorted((str(i), h or "") for i, _, h in PAGES)
    clean = warc.deduplicate_archive(spark, raw)
    rows = warc.read_archive(spark, clean, payloads=True).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    assert len(rows) == len(PAGES)
    sha = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    text = {sha(h or ""): h or "" for _, _, h in PAGES}
    for r in rows:
        body = text[r.payload_digest]
        assert r.payload_bytes == len(body.encode())
        original = first.get(body)
        if r.page_id == original:
            assert (r.record_type, r.refers_to, r.payload) == ("response", None, body)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", original, "")
    # record ids are unique, over both archives
    assert len({r.record_id for r in [*back, *rows]}) == len(back) + len(rows)
    large = warc.read_archive(spark, warc.deduplicate_archive(spark, raw, 10 ** 6))
    assert large.where("record_type = 'revisit'").isEmpty()
    assert warc.read_archive(spark, warc.archive_pages(pages.limit(0))).isEmpty()


def records_of(spark, path):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    return [list(warc.parse_archive(warc.inflated(bytes(f.content)))) for f in files]


def test_fresh_headers_refer_to_each_other(spark):
    pages = spark.createDataFrame([(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "own")],
                                  "page_id long, url string, html string")
    clean = warc.deduplicate_archive(spark, warc.archive_pages(pages))
    every = [h for f in records_of(spark, clean) for h, _ in f]
    info = [h for h in every if h["WARC-Type"] == "warcinfo"]
    by_page = {h["X-Page-ID"]: h for h in every if "X-Page-ID" in h}
    assert len(info) == 1 and len(by_page) == 3 and "WARC-Target-URI" not in by_page["3"]
    one, two = by_page["1"], by_page["2"]
    assert two["WARC-Type"] == "revisit" and two["WARC-Refers-To"] == one["WARC-Record-ID"]
    assert two["WARC-Refers-To-Target-URI"] == "http://a/1" and two["WARC-Refers-To-Date"] == one["WARC-Date"]
    assert one["WARC-Date"] > "2020" and re.fullmatch("<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", one["WARC-Record-ID"])


def test_large_payloads_have_files_of_their_own(spark, monkeypatch):
    """Payloads of megabytes: few to a file, inflated in pieces, and back whole."""
    monkeypatch.setattr(warc, "FILE_BYTES", 4 << 20)
    r = random.Random(1)
    big = ["".join(r.choices("abcdefgh \r\n", k=3 << 20)), "é" * (1 << 20), "x" * (70 << 10)]
    rows = [(i, "http://a/", h) for i, h in enumerate([*big, *["small"] * 50, big[0]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    raw = warc.archive_pages(pages)
    files = records_of(spark, raw)
    sizes = [[len(b) for h, b in f if h["WARC-Type"] != "warcinfo"] for f in files]
    assert all(len(s) == 1 for s in sizes if max(s, default=0) > 1 << 20) and sum(map(len, sizes)) == len(rows)
    clean = warc.read_archive(spark, warc.deduplicate_archive(spark, raw), payloads=True).collect()
    got = {x.page_id: (x.record_type, x.payload) for x in clean}
    assert [got[i] for i in range(3)] == [("response", h) for h in big] and got[53] == ("revisit", "")


def test_members_and_pieces(monkeypatch):
    import gzip

    record = lambda i, body: (f"WARC/1.1\r\nWARC-Type: x\r\nN: {i}\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    bodies = [bytes([65 + i % 26]) * (i * 37 % 900) for i in range(60)]
    data = b"".join(gzip.compress(record(i, b)) for i, b in enumerate(bodies))
    for piece in (7, 100, 1 << 20):
        monkeypatch.setattr(warc, "PIECE", piece)
        for archive in (data, gzip.compress(b"".join(record(i, b) for i, b in enumerate(bodies)))):
            assert [(h["N"], b) for h, b in warc.parse_archive(warc.inflated(archive))] == [(str(i), b) for i, b in enumerate(bodies)]
    with pytest.raises(ValueError):
        list(warc.parse_archive([record(1, b"abc")[:-5]]))


# ---- url rules ------------------------------------------------------------

def page(i, url, html="<p>x</p>"):
    return (i, url, html, "own", "v")


def judged(spark, pages, rules=url_rules.RULES):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, rule string, verdict string")
    return {r.page_id: r for r in url_rules.judge_urls(frame, url_rules.rules_frame(spark, rules)).collect()}


def test_rules_and_hosts(spark):
    got = judged(spark, [page(1, "http://WWW.Example.com/en/x?q#f"), page(2, "https://a.example.com/en/x"),
                         page(3, "http://b.net/es/1"), page(4, "http://b.net/de/1"), page(5, "http://xcom/"),
                         page(6, None), page(7, "no scheme"), page(8, "http://a.com"), page(9, "ftp://notexample.com/en/"),
                         page(10, "")])
    seen = {i: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()}
    assert seen[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert seen[2] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert seen[3] == ("b.net", "/es/1", "net/es/", "block")
    assert seen[4] == ("b.net", "/de/1", None, "allow")
    assert seen[5] == ("xcom", "/", None, "allow")
    assert seen[6] == seen[7] == seen[10] == ("", "", None, "allow")
    assert seen[8] == ("a.com", "", None, "allow")
    assert seen[9] == ("notexample.com", "/en/", "com/", "allow")


def test_blocks_reach_aliases_and_allow_wins(spark):
    link = '<head><link href="{0}" rel="canonical"></head>'.format
    hop = '<meta http-equiv="refresh" content="0; url={0}">'.format
    rules = [("block", "bad.org", "/"), ("allow", "ok.org", "/")]
    got = judged(spark, [
        page(1, "http://bad.org/a"), page(2, "http://m.org/1", link("https://bad.org/a#x")),
        page(3, "http://m.org/2/", hop("http://www.m.org/1?utm_source=z")), page(4, "http://free.org/1", link("http://m.org/3")),
        page(5, "http://n.org/1", link("http://bad.org/b")), page(6, "http://n.org/2", link("http://n.org/1")),
        page(7, "http://ok.org/z", hop("http://n.org/2")), page(8, "http://bad.org/b")], rules)
    verdict = {i: r.verdict for i, r in got.items()}
    assert verdict == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block"}


def test_targets_that_are_no_rows_carry_their_rules(spark):
    link = '<head><link href="{0}" rel="canonical"></head>'.format
    rules = [("block", "bad.org", "/"), ("allow", "ok.org", "/")]
    got = judged(spark, [page(1, "http://m.org/1", link("http://bad.org/es/1")), page(2, "http://m.org/2", link("http://m.org/1")),
                         page(3, "http://bad.org/z", link("http://n.org/3")), page(4, "http://n.org/4", link("http://n.org/3")),
                         page(5, "http://n.org/3", link("https://www.ok.org/not-a-row")), page(6, "http://o.org/")], rules)
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}
    assert judged(spark, [page(1, "http://m.org/1", link("http://bad.org/es/1"))], rules).keys() == {1}


def test_relative_links_are_resolved(spark):
    link = '<head>{1}<link href="{0}" rel="canonical"></head>'.format
    hop = '<meta http-equiv="refresh" content="0; url={0}">'.format
    rules = [("block", "bad.org", "/"), ("block", "m.org", "/es/")]
    block = ["/es/1", "es/2", "./es/3", "../es/4", "../../es/5", "/x/../es/6", "//bad.org/q", "HTTP://bad.org/r", "//m.org/es/s?x=/../"]
    base = ["http://m.org/", "http://m.org/a", "http://m.org", "http://m.org/a/b", "https://m.org/a/b/c", "http://m.org/p/q",
            "http://m.org/6", "http://m.org/7", "http://m.org/8"]
    allow = ["/go?u=http://bad.org/", "es/1", "mailto:x@bad.org", "?u=http://bad.org/", "#http://bad.org/", "../b/../c"]
    pages = [page(i, f"{u}?n={i}", link(t, "")) for i, (u, t) in enumerate(zip(base, block, strict=True))]
    pages += [page(20 + i, f"{u}?n={20 + i}", hop(t)) for i, (u, t) in enumerate(zip(base, block, strict=True))]
    pages += [page(40 + i, f"http://m.org/deep/x{i}", link(t, "")) for i, t in enumerate(allow)]
    pages += [page(60, "http://m.org/based", link("z", '<base href="//bad.org/y/">')), page(61, "no scheme", link("/es/1", ""))]
    got = {i: r.verdict for i, r in judged(spark, pages, rules).items()}
    assert {i for i, v in got.items() if v == "block"} == {*range(9), *range(20, 29), 60}


def with_sql(name, **tables):
    """Rows of a query's SQL over the given tables."""
    import duckdb

    from martlake.llm import registry

    db = duckdb.connect()
    for t, rows in tables.items():
        db.register(t, rows)
    return db.sql(registry.SQL[name]).df()


def test_url_sql_is_the_query_on_planted_links(spark, tmp_path):
    link = '<head>{1}<link href="{0}" rel="canonical"></head>'.format
    hop = "<meta http-equiv='refresh' content='0; url={0}'>".format
    targets = ["/es/1", "es/2", "./es/3", "../es/4", "../../es/5", "/x/../es/6", "//a.net/q", "HTTP://b.net/es/r", "//m.net/es/s?x=/../",
               "/go?u=http://a.net/es/", "mailto:x@a.net", "?u=http://a.net/es/", "#http://a.net/", "../b/../c", "..", "/a/./b/.",
               "https://www.example.com/en/x", "http://example.com/en/y"]
    bases = ["http://m.net", "http://m.net/a/b?x=1", "https://www.m.org/p/q/index.html", "no scheme", None]
    rows = [(100 * i + j, f"{b}/{j}" if b and j % 3 == 0 and b.startswith("http") else b,
             (link(t, '<base href="//k.net/fr/y/">' if j % 7 == 0 else "") if j % 2 else hop(t)))
            for i, b in enumerate(bases) for j, t in enumerate(targets)]
    rows += [(9000, "http://k.org/1", link("http://not-a-row.net/es/1", "")), (9001, "http://k.org/2", link("/1", "")),
             (9002, "http://k.org/3", None), (9003, "http://x.example.com/en/1", "<p>"), (9004, "http://m.net/fr/", "<link <link rel=canonical href=/z>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = url_rules.op8_url_equivalence(spark, str(tmp_path)).toPandas()
    want = with_sql("op8_url_equivalence", pages=frame.toPandas())
    clean = lambda d: {r.page_id: tuple(None if v != v else v for v in (r.host, r.path, r.rule, r.verdict, r.component))
                       for r in d.itertuples()}
    assert clean(got) == clean(want) and len(got) == len(rows)
    assert {"allow", "block"} == set(got.verdict)


def test_mixing_sql_is_the_query_with_small_sources(spark, prose, tmp_path):
    rows = [(i, prose(200 + i % 40, i), "big" if i < 1800 else f"s{i % 4}") for i in range(1810)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op1_mixing(spark, str(tmp_path)).toPandas()
    want = with_sql("op1_mixing", documents=frame.toPandas())
    key = lambda d: sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in d.itertuples())
    assert key(got) == key(want)
    # the small sources have blocks of their own length
    sizes = mixing.document_sizes(frame)
    assert mixing.mix(sizes)["targets"].select("block").distinct().count() > 1


def test_a_page_of_open_tags_and_a_host_of_many_labels(spark):
    got = judged(spark, [page(1, "http://m.org/", "<link rel=" * 100_000), page(2, "http://" + "a." * 20_000 + "net/es/1")])
    assert got[1].verdict == "allow" and got[2].verdict == "block"


def test_url_rules_on_nothing(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_rules.judge_urls(none, url_rules.rules_frame(spark)).isEmpty()
    again = judged(spark, [page(1, "http://b.net/es/1"), page(1, "http://b.net/es/1")])
    assert again[1].verdict == "block"


def test_url_plan_is_native(spark):
    frame = url_rules.judge_urls(table(spark, SF_SMALL, "pages"), url_rules.rules_frame(spark))
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# ---- nearest neighbours ---------------------------------------------------

def plain_nearest(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, []).append(np.array(v, float))
    out = {}
    for i, vs in ok.items():
        if i % 20 == 0:
            v = vs[0]
            near = sorted((-float(v @ max(us, key=lambda u: v @ u)), j) for j, us in ok.items()
                          if j != i and len(us[0]) == len(v))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def test_neighbours_on_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "UNIT_ROWS", 16)
    monkeypatch.setattr(prefix_forest, "QUERY_ROWS", 2)
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).tolist()) for i in range(200)]
    rows += [(200 + i, rows[40][1]) for i in range(70)]                     # a large group of equal vectors
    rows += [(300, None), (320, [0.0] * 6), (340, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (360, [float("nan")] + [1.0] * 5),
             (380, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (20, rows[20][1]), (400, [1.0, 2.0]), (401, [2.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = defaultdict(list)
    # a share over the number of trees asks for everything: the result is exact
    for x in prefix_forest.nearest(frame, F.col("vec_id") % 20 == 0, 20, share=float(prefix_forest.TREES)).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    want = plain_nearest(rows, 20)
    assert set(got) == {i for i, near in want.items() if near}
    for i, near in got.items():
        assert [x[0] for x in near] == list(range(1, len(near) + 1))
        assert [x[1] for x in near] == [j for j, _ in want[i]]
        assert np.allclose([x[2] for x in near], [s for _, s in want[i]], rtol=1e-12)
    assert prefix_forest.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).isEmpty()


def test_many_ties_go_to_the_smaller_ids(spark):
    """Two hundred different vectors of equal score, in any order of their codes: the smallest ids are returned."""
    r = np.random.default_rng(8)
    ids = r.permutation(np.arange(1, 220))[:200].tolist()
    rows = [(i, [1.0, *(np.where(np.arange(8) == j % 8, 1.0 + j, 0.0) * r.choice([-1, 1])).tolist()]) for j, i in enumerate(ids)]
    rows = [(i, v) for i, v in rows if i % 20] + [(0, [2.0, *[0.0] * 8])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = prefix_forest.nearest(frame, F.col("vec_id") == 0, 20, share=float(prefix_forest.TREES)).orderBy("rank").collect()
    assert [x.vec_id for x in got] == sorted(i for i, _ in rows if i)[:20] and {x.score for x in got} == {2.0}


def test_ties_within_a_part():
    import pyarrow as pa

    n = 500
    first = np.random.default_rng(9).permutation(n)
    x = np.hstack([np.ones((n, 1)), np.random.default_rng(1).normal(size=(n, 3))])
    index = pa.table({"code": np.zeros(n, np.int64), "first": first, "class": first + 1000,
                      "vector": pa.array([v.tobytes() for v in x], pa.binary())})
    q = np.array([3.0, 0, 0, 0])
    queries = pa.table({"code": np.zeros(1, np.int64), "depth": np.zeros(1, np.int64), "class": np.array([7]),
                        "vector": pa.array([q.tobytes()], pa.binary())})
    got = prefix_forest.best_of_part(index, queries, 20)
    assert got["class"].to_pylist() == list(range(1000, 1021)) and set(got["score"].to_pylist()) == {3.0}


def test_recall_at_production_parameters(spark):
    rows = table(spark, SF_MID, "embeddings").select("vec_id", "embedding").collect()
    want = plain_nearest([(r.vec_id, r.embedding) for r in rows], 20)
    got = defaultdict(set)
    for x in prefix_forest.op10_prefix_forest(spark, SF_MID).collect():
        got[x.query_id].add(x.vec_id)
    recall = np.mean([len(got[i] & {j for j, _ in near}) / len(near) for i, near in want.items()])
    assert set(got) == set(want) and recall >= 0.9


# ---- pipeline -------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline
    from martlake.llm.piece_encoder import default_model, encoder

    docs = table(spark, SF_SMALL, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "private_data", "mixing", "encoding"]
    columns, seen = docs.columns, {}
    from martlake.llm.common import stage
    for name, step in corpus_pipeline.STAGES:
        docs = seen[name] = stage(step(spark, docs, SF_SMALL), f"test-{name}")
        assert name == "encoding" or docs.columns == columns
    good = {r.doc_id: r.text for r in seen["quality"].collect()}
    want = {i for i, n, c in plain_components(sorted(good.items())) if not n or i == c}
    assert sorted(r.doc_id for r in seen["near_dedup"].collect()) == sorted(want)
    clean = {r.doc_id: r.text for r in seen["private_data"].collect()}
    assert set(clean) == want and not any("@mail" in t for t in clean.values())
    mixed = seen["mixing"].collect()
    whole = [r for r in mixed if r.text == clean[r.doc_id]]
    assert len(whole) >= len(mixed) - 20 and max(Counter(r.doc_id for r in mixed).values()) <= 3
    enc = encoder(default_model())
    assert sorted(tuple(r.ids) for r in docs.collect()) == sorted(tuple(enc.library.encode(r.text)) for r in mixed)


def test_llm_queries_equal_their_sql(spark):
    import duckdb

    from martlake.llm import registry
    from test_oracle import rows

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in registry.SQL.items():
        assert rows(registry.QUERIES[name](spark, SF_SMALL).toPandas()) == rows(con.execute(sql).df()), name
