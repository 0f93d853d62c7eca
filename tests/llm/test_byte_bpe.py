"""Byte-level BPE (operator 11) against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import pytest
from llm_fixtures import make_docs, odd_rows, prose  # noqa: F401

from martlake.llm.byte_bpe import ByteEncoder, byte_alphabet, default_tokenizer, encode_words, op11_byte_bpe

SIGNS = ["a", "b", "e", "th", "the", " ", "  ", "\n", "'s", "'S", "1", "23", ".", "..", "--", "é", "ñ", "日", "本",
         "<|endoftext|>", "<|end", "oftext|>", "\x1c", "\x85", " ", "\U0001f600", "́", "²", "½", "Ⅷ", "_",
         "\t", "ING", "�", "\x00", "՘", "࢏", "\U00016ea0", "\U0001ccf0"]


@pytest.fixture(scope="module")
def pair():
    from tokenizers import Tokenizer

    return ByteEncoder(default_tokenizer()), Tokenizer.from_file(default_tokenizer())


def same(pair, texts):
    own, library = pair
    for t, got in zip(texts, own.encode_all(texts), strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want, t[:60]
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_ids_are_the_librarys(pair):
    r = random.Random(5)
    same(pair, ["".join(r.choice(SIGNS) for _ in range(r.randint(0, 30))) for _ in range(4000)])
    same(pair, ["".join(r.choice("ab") for _ in range(r.randint(0, 40))) for _ in range(2000)])
    same(pair, [c * n for c in "a- \n9" for n in range(120)])
    known = [t.decode("utf-8", "ignore") for t in pair[0].bytes_of.values()]
    same(pair, ["".join(r.choice(known) for _ in range(r.randint(1, 6))) for _ in range(5000)])


def test_long_texts_and_words(pair, monkeypatch):
    from martlake.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "GROUP_CHARS", 1000)
    monkeypatch.setattr(byte_bpe, "RUN_WORDS", 7)
    monkeypatch.setattr(byte_bpe, "MEMO", 50)
    r = random.Random(6)
    words = ["".join(r.choice(SIGNS) for _ in range(4)) for _ in range(300)]
    same(pair, [" ".join(words), "short", "", " ".join(reversed(words)), "".join(r.choice("abcde") for _ in range(20000))])


def test_pairs_fit_exactly_when_merging_gives_them_again(pair):
    own = pair[0]
    r = random.Random(7)
    ids = [i for i in own.bytes_of if i not in own.special.values()]
    a, b = np.array(r.choices(ids, k=4000)), np.array(r.choices(ids, k=4000))
    want = [own.merge(own.bytes_of[x] + own.bytes_of[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert own.fits(a, b).tolist() == want and 0 < sum(want) < 4000


def test_only_failing_words_are_merged(pair, monkeypatch):
    own = ByteEncoder(default_tokenizer())
    merged = []
    whole = own.merge
    monkeypatch.setattr(own, "merge", lambda w: merged.append(w) or whole(w))
    own.encode_all(["the house of the river"])
    assert merged == []


def test_other_files_are_refused(tmp_path):
    with open(default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    low = {b: c for c, b in byte_alphabet().items()}
    spec["model"]["vocab"] = {low[b]: b for b in range(256)} | {"ab": 256, "abc": 257, "bc": 258}
    spec["model"]["merges"] = [["ab", "c"], ["a", "b"]]        # before its part
    at = tmp_path / "t.json"
    at.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        ByteEncoder(str(at))
    spec["model"]["merges"] = [["a", "b"], ["b", "c"], ["ab", "c"], ["a", "bc"]]        # two histories
    at.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        ByteEncoder(str(at))


def test_rows_and_odd_cases(spark, make_docs, odd_rows):  # noqa: F811
    docs = make_docs([*odd_rows, (1, "the quick brown fox<|endoftext|>"), (1, "the quick brown fox<|endoftext|>")])
    got = [r.asDict() for r in encode_words(docs, default_tokenizer()).collect()]
    assert len(got) == docs.count()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        assert r["decoded"] == (text[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"])
    assert [r["ids"][-1] for r in got if r["doc_id"] == 1] == [50256, 50256]
    assert encode_words(docs.limit(0), default_tokenizer()).count() == 0


def test_query_is_the_librarys_result(spark, pair):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    rows = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = {}
    for r in rows:
        ids = pair[1].encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(pair[1].decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in op11_byte_bpe(spark, sf).collect()}
    assert got == want
