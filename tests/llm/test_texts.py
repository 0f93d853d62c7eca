"""Encoding, personal data, edits and quality rules against brute force and exact round trips."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlake.llm import edit_counts, pii, piece_encoder, quality
from martlake.llm.common import table

from conftest import SF_MID, SF_SMALL
from llm_fixtures import make_docs, odd_rows, prose  # noqa: F401


# ---- encoding -------------------------------------------------------------

@pytest.fixture(scope="module")
def enc():
    return piece_encoder.encoder(piece_encoder.default_model())


def test_encoder_equals_library_on_random_strings(enc):
    r = random.Random(1)
    alphabet = ["a", "b", "the", "▁", " ", "  ", "\n", "é", "中", "😀", "\x00", "th", "in", "　", "<s>", "<0x0A>",
                ".", "...", "1", "\r\n", "ﬁ", "é", "'s", "http://", "=="]
    for _ in range(3000):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 50)))
        assert enc.encode(t) == enc.library.encode(t), t


@pytest.mark.parametrize("t", ["", " ", "a" * 5000, " " * 3000, "ab" * 9000, "中" * 800, "=-" * 2000, "e" + "́" * 500])
def test_encoder_on_long_cuts(enc, t):
    assert enc.encode(t) == enc.library.encode(t)


def test_pair_check_is_the_merge_rule(enc):
    for t in ("▁the", "ing", "tion", "▁hello"):
        if t in enc.id_of:
            assert enc.merge(t) == [t]
    a, b = enc.id_of["▁the"], enc.id_of["re"]
    assert enc.follows(a, b) == (enc.merge("▁there") == ["▁the", "re"])


def test_encode_documents_on_odd_rows(spark, make_docs, odd_rows, enc, prose):
    docs = make_docs([*odd_rows, (1, prose(300, 1)), (1, prose(300, 1))])
    got = piece_encoder.encode_documents(docs, piece_encoder.default_model(), ("n_tokens", "ids", "ids_text", "decoded"))
    rows = got.collect()
    assert len(rows) == 8
    want = {i: t for i, t in odd_rows} | {1: prose(300, 1)}
    for r in rows:
        ids = enc.library.encode(want[r.doc_id] or "")
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_text == ",".join(map(str, ids))
        assert r.decoded == enc.library.decode(ids)
    empty = piece_encoder.encode_documents(docs.limit(0), piece_encoder.default_model())
    assert empty.columns == ["doc_id", "n_tokens", "ids", "decoded"] and empty.isEmpty()


def test_op2_on_whole_table(spark, enc):
    texts = dict(table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    rows = piece_encoder.op2_piece_encoding(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = enc.library.encode(texts[r.doc_id])
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(enc.library.decode(ids)))


# ---- personal data --------------------------------------------------------

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")),
                    14 <= len(digits) <= 19 and pii.luhn(digits), 10 <= len(digits) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    r = random.Random(3)
    parts = list("ab@.@..+-- ()0123456789é") + ["1.2.3.4", "+1 ", "4111 1111 1111 1111", "x@y.z", "299"]
    for _ in range(20_000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 40)))
        assert pii.base_spans(t)[0] == plain_spans(t), t


def test_long_texts_stay_linear():
    for t in ("1" * 200_000, "a" * 200_000, "a@" * 50_000, "+1(" * 50_000, "1.2.3 " * 40_000, "1 " * 80_000):
        pii.scan(t)


def test_em_tells_good_from_bad_labelers():
    patterns = [("+++00", 900), ("---00", 400), ("++-00", 20), ("-++00", 15), ("+--0-", 10)]
    chance, given = pii.reliabilities(patterns)
    assert chance[0] > 0.99 and chance[1] < 0.01
    assert given[1, 1, 0] > 0.9 and given[0, 1, 1] > 0.8


def test_method_adds_spans_and_keeps_base(make_docs, odd_rows, prose):
    rows = [(i, f"{prose(20, i)} call +1 (212) 555-{1000 + i} or mail a{i}@b.org now") for i in range(40)]
    rows.append((77, f"{prose(20, 5)} call (212) 555-0199 today"))
    got = {r.doc_id: r for r in pii.detect(make_docs([*rows, *odd_rows])).collect()}
    assert got[3].n_phone == 1 and got[3].n_email == 1
    text = dict(rows)[77]
    at = text.index("(212)")
    assert got[77].n_phone == 0 and got[77].base == "" and got[77].spans == f"phone:{at}:{at + 14}"
    assert got[900].spans == "" and got[901].n_ip == 0 and None in got


def test_a_rejected_candidate_hides_nothing(make_docs, prose):
    """A digit run that fails its card check overlaps the phone number, is refused, and the number stays."""
    rows = [(i, f"{prose(20, i)} call +1 212 555 {1000 + i} or (312) 555-{2000 + i} now, card 4111 1111 1111 1111") for i in range(40)]
    rows += [(80, "tel 555-123-4567 10001"), (81, "call 2024 555-223-4567 soon")]
    text = dict(rows)
    base, more = pii.scan(text[80])
    assert not base and {(k, text[80][s:e]) for s, k, e, _ in more} >= {(2, "555-123-4567 10001")}
    got = {r.doc_id: r.spans for r in pii.detect(make_docs(rows)).collect()}
    at = text[81].index("555")
    assert f"phone:{at}:{at + 12}" in got[81]


def test_overlaps_are_settled_among_accepted_spans():
    more = [(0, 2, 18, "a"), (4, 3, 16, "b"), (20, 3, 32, "b"), (22, 0, 30, "c"), (40, 1, 50, "d"), (40, 3, 55, "d")]
    spans = pii.all_spans([], more, {(3, "b"): 0.97, (0, "c"): 0.99, (1, "d"): 0.96, (3, "d"): 0.96})
    assert spans == [(4, 3, 16), (22, 0, 30), (40, 3, 55)]


def test_planted_spans_are_found_and_others_left(make_docs, prose):
    """Recall and precision of added spans: spelled-out, IPv6 and national forms against digit runs of other kinds."""
    r = random.Random(11)
    rows, good, bad = [], {}, {}
    for i in range(400):
        area, exchange = f"{r.randint(2, 9)}{r.randint(0, 8)}{r.randint(2, 9)}", f"{r.randint(2, 9)}{r.randint(2, 9)}{r.randint(0, 9)}"
        planted = [f"ann.b{i} (at) mail{i % 7} (dot) org", ":".join(f"{r.randint(0, 65535):x}" for _ in range(8)),
                   f"{area}-{exchange}-{r.randint(0, 9999):04d}"][i % 3]
        lead = [["contact", "write to", ""], ["host", "ip address", ""], ["phone", "call", ""]][i % 3][i % 2]
        other = [f"order {r.randint(10 ** 13, 10 ** 14 - 1)}7", f"serial 1{r.randint(10, 99)}-1{r.randint(10, 99)}-{r.randint(1000, 9999)}"][i % 2]
        text = f"{prose(8, i)} {lead} {planted} {prose(4, 900 + i)} {other} mail a{i}@b{i % 5}.com"
        rows.append((i, text))
        good[i] = (text.index(planted), text.index(planted) + len(planted))
        bad[i] = (text.index(other), text.index(other) + len(other))
    hit = wrong = added = 0
    for x in pii.detect(make_docs(rows)).collect():
        spans = [tuple(map(int, s.split(":")[1:])) for s in x.spans.split(",") if s and s not in x.base.split(",")]
        added += len(spans)
        hit += good[x.doc_id] in spans
        wrong += any(s < bad[x.doc_id][1] and e > bad[x.doc_id][0] for s, e in spans)
    assert hit >= 0.9 * len(rows) and hit / max(1, added) >= 0.95 and wrong <= 0.02 * len(rows), (hit, added, wrong)


def test_redact_keeps_columns(make_docs, odd_rows):
    docs = make_docs([(1, "mail a@b.org, ip 1.2.3.4!"), (2, "nothing here"), *odd_rows])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "mail [EMAIL], ip [IP]!" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "nothing here" and got[900].text is None and len(got) == 8
    assert pii.redact(docs.limit(0)).isEmpty() and pii.detect(docs.limit(0)).isEmpty()


def test_op3_on_whole_table(spark):
    texts = dict(table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    rows = pii.op3_pii(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        counts = Counter(k for _, k, _ in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in range(4)]
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


# ---- edits ----------------------------------------------------------------

def test_tree_equals_full_count_after_random_edits():
    c = edit_counts.counter(*edit_counts.default_vocabulary())
    r = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "the", "'s", "é", "1", "23", ".", "!!", " word", "\t", "中", "'", "ll"]
    for _ in range(400):
        t = "".join(r.choice(parts) for _ in range(r.choice([0, 1, 5, 50, 400, 900])))
        tree = edit_counts.CountTree(c, t)
        for _ in range(5):
            at, n = r.randint(0, len(t) + 2), r.choice([0, 0, 1, 3, 40, 300])
            ins = "".join(r.choice(parts) for _ in range(r.choice([0, 1, 4, 100])))
            tree.edit(at, n, ins)
            a = min(at, len(t))
            t = t[:a] + ins + t[a + n:]
            assert tree.text() == t and tree.chars[1] == len(t)
            assert tree.tokens[1] == len(c.encoding.encode_ordinary(t))


def test_edits_touch_little(prose):
    c = edit_counts.counter(*edit_counts.default_vocabulary())
    tree = edit_counts.CountTree(c, prose(5000, 2))
    tree.edit(12_000, 5, "changed")
    assert 0 < tree.encoded < 12


def test_many_edits_at_one_place_split_their_leaf(prose):
    c = edit_counts.counter(*edit_counts.default_vocabulary())
    t = prose(300, 7)
    tree = edit_counts.CountTree(c, t)
    for i in range(1500):
        tree.edit(400, 0, f" word{i} and")
        t = t[:400] + f" word{i} and" + t[400:]
    assert max(len(p) for p, _ in tree.leaves) <= edit_counts.SPLIT
    assert tree.text() == t and tree.tokens[1] == len(c.encoding.encode_ordinary(t))
    tree.edit(100, len(t) - 150, "")
    assert tree.text() == t[:100] + t[-50:]


def test_kept_trees_are_edited_without_counting_again(spark, make_docs, odd_rows, prose, scratch, monkeypatch):
    vocabulary = edit_counts.default_vocabulary()
    c = edit_counts.counter(*vocabulary)
    n = lambda s: len(c.encoding.encode_ordinary(s))
    t = prose(600, 4)
    docs = make_docs([*odd_rows, (1, t), (2, t), (3, "other")])
    edit_counts.build_trees(docs, *vocabulary).write.parquet(scratch + "/trees")
    trees = spark.read.parquet(scratch + "/trees")
    assert {r.doc_id: r.n_tokens for r in trees.collect()} == {r.doc_id: n(r.text or "") for r in docs.collect()}
    kinds = "doc_id long, seq long, at long, length long, insertion string"
    first = edit_counts.edit_trees(trees, spark.createDataFrame([(1, 0, 5, 3, "new words"), (900, 0, 0, 0, "text")], kinds),
                                   *vocabulary)
    first.write.parquet(scratch + "/edited")
    got = {r.doc_id: r for r in spark.read.parquet(scratch + "/edited").collect()}
    once = t[:5] + "new words" + t[8:]
    assert set(got) == {1, 900} and got[1].text == once and got[900].text == "text"
    assert got[1].n_tokens == n(t) and got[1].n_tokens_edited == n(once) and got[1].n_pieces_encoded < 12
    # a second batch goes on from the trees of the first
    again = edit_counts.edit_trees(spark.read.parquet(scratch + "/edited"),
                                   spark.createDataFrame([(1, 0, 0, 0, "start ")], kinds), *vocabulary).collect()
    assert [(r.n_tokens, r.n_tokens_edited, r.text) for r in again] == [(n(once), n("start " + once), "start " + once)]
    # a known tree is taken as it is: counts that are wrong stay wrong beyond the edit
    tree = edit_counts.CountTree(c, "a b c", (np.array([1, 2, 2], "<i4").tobytes(), np.array([7, 7, 7], "<i4").tobytes()))
    assert tree.tokens[1] == 21


def test_count_edited_on_odd_rows(spark, make_docs, odd_rows, prose):
    c = edit_counts.counter(*edit_counts.default_vocabulary())
    t = prose(400, 4)
    docs = make_docs([*odd_rows, (1, t), (1, t), (2, t)])
    edits = spark.createDataFrame(
        [(1, 1, 3, 4, "xyz"), (1, 0, None, None, "start "), (1, 2, 10 ** 6, 5, None), (900, 0, 0, 9, "new text"),
         (None, 0, 0, 0, "lost"), (12345, 0, 0, 0, "nobody"), (901, 0, -4, -1, "")],
        "doc_id long, seq long, at long, length long, insertion string")
    rows = edit_counts.count_edited(docs, edits, *edit_counts.default_vocabulary()).collect()
    assert len(rows) == 9
    after = "start " + t
    after = after[:3] + "xyz" + after[7:]
    n = lambda s: len(c.encoding.encode_ordinary(s))
    assert [(r.n_tokens, r.n_edits, r.n_tokens_edited) for r in rows if r.doc_id == 1] == [(n(t), 3, n(after))] * 2
    by = {r.doc_id: r for r in rows}
    assert by[2].n_tokens_edited == n(t) and by[2].n_edits == 0
    assert by[900].n_tokens == 0 and by[900].n_tokens_edited == n("new text")
    assert by[None].n_edits == 0 and by[901].n_tokens_edited == 0
    assert edit_counts.count_edited(docs.limit(0), edits.limit(0), *edit_counts.default_vocabulary()).isEmpty()


def test_op4_on_whole_table(spark):
    c = edit_counts.counter(*edit_counts.default_vocabulary())
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    texts = dict(docs.collect())
    before = dict(texts)
    for e in edit_counts.sample_edits(docs).orderBy("doc_id", "seq").collect():
        t = texts[e.doc_id]
        texts[e.doc_id] = t[:e.at] + e.insertion + t[e.at + e.length:] if e.at <= len(t) else t + e.insertion
    rows = edit_counts.op4_edit_counts(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens == len(c.encoding.encode_ordinary(before[r.doc_id]))
        assert r.n_tokens_edited == len(c.encoding.encode_ordinary(texts[r.doc_id]))


# ---- quality --------------------------------------------------------------

def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    marked = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked), len(lines))


def test_stats_equal_plain_counts():
    r = random.Random(9)
    parts = ["a", "b", "ab", " ", " ", "\n", "\r", "\x0b", "#", "é", " ", "|", "\n\n", "  "]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 60)))
        assert quality.text_stats(t) == plain_stats(t), repr(t)
    assert quality.text_stats(None) == (0,) * 6


def test_forest_scores_outliers_high():
    import numpy as np

    r = np.random.default_rng(1)
    rows = np.vstack([r.normal(0, 0.1, (2000, 4)), r.normal(3, 0.1, (20, 4))])
    score = quality.anomaly_scores(quality.fit_forest(rows), rows)
    assert score[2000:].min() > np.quantile(score[:2000], 0.99)


def quality_fixture(make_docs, prose, odd_rows):
    good = [(i, prose(120, i)) for i in range(60)]
    bad = [(100 + i, " ".join(w + "###$$$" for w in prose(100, 500 + i).split())) for i in range(12)]
    return good, bad, make_docs([*good, *bad, *odd_rows, good[0]])


def test_labels_set_the_threshold(spark, make_docs, prose, odd_rows):
    good, bad, docs = quality_fixture(make_docs, prose, odd_rows)
    labels = spark.createDataFrame([*((i, 1, 0) for i, _ in good[:30]), *((i, 0, 0) for i, _ in bad[:6]),
                                    (None, 1, 0), (5, None, 0), (99999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = [(r.doc_id, r.base_failed, r.kept) for r in quality.judge(docs, labels).collect()]
    assert len(got) == 60 + 12 + 6 + 1
    assert all(k and not f for i, f, k in got if i is not None and i < 60)
    assert not any(k for i, _, k in got if i is not None and 100 <= i < 112)
    assert all(f and not k for i, f, k in got if i is None or i >= 900)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, k in got if k)
    # without labels the forest rejects nothing; an empty table gives an empty result
    assert quality.judge(docs, labels.limit(0)).where("not kept and not base_failed").isEmpty()
    assert quality.judge(docs.limit(0), labels).isEmpty() and quality.keep_good(docs.limit(0), labels).isEmpty()


def test_op9_on_whole_table(spark):
    texts = dict(table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    rows = quality.op9_quality_rules(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        s = plain_stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s[:5]
        assert r.base_failed == (s[0] < 50 or 100 * s[4] > 50 * s[0]) and not (r.kept and r.base_failed)


def test_quality_separates_held_out_labels(spark):
    labels = table(spark, SF_MID, "labels")
    shown, held = labels.where(F.col("doc_id") % 2 == 0), labels.where(F.col("doc_id") % 2 == 1)
    judged = quality.judge(table(spark, SF_MID, "documents"), shown).join(held, "doc_id").where("not base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, False), 0) >= 0.9 * (n.get((0, False), 0) + n.get((0, True), 0))


def test_labels_reach_documents_of_moderate_rates(spark, make_docs, prose, odd_rows):
    good = [(i, prose(100, i)) for i in range(80)]
    few = [(200 + i, " ".join(w + "#" * (k % 11 == 0) for k, w in enumerate(prose(100, 900 + i).split())))
           for i in range(10)]                                  # 0.1 symbols a word
    again = [(300 + i, prose(36, 700 + i) + " " + " ".join([prose(12, 800 + i)] * 2)) for i in range(10)]   # 40% repeat
    labels = spark.createDataFrame([*((i, 1) for i, _ in good), *((i, 0) for i, _ in few[:5] + again[:5])],
                                   "doc_id long, quality int")
    rows = quality.judge(make_docs([*good, *few, *again, *odd_rows]), labels).where("not base_failed").collect()
    assert {r.doc_id for r in rows if not r.kept} == {i for i, _ in few + again}


def test_one_document_in_many_steers_the_forest(spark):
    word = lambda i: F.concat(F.lit("w"), (i + F.col("id") % 40).cast("string"))
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.transform(F.sequence(F.lit(1), F.lit(52)), word)).alias("text"))
    odd = (77, 40_007, 99_983)
    docs = docs.withColumn("text", F.when(F.col("doc_id").isin(*odd), F.concat("text", F.lit(" " + "#$" * 15)))
                           .otherwise(F.col("text")))
    labels = docs.where("doc_id % 50 = 0").select("doc_id", F.lit(1).alias("quality")).unionByName(
        spark.createDataFrame([(odd[0], 0)], "doc_id long, quality int"))
    got = {r.doc_id for r in quality.judge(docs, labels).where("not kept").collect()}
    assert got == set(odd)
