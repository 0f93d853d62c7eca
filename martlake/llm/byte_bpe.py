"""Byte-level BPE encoding and decoding by speculation and verification (operator 11).

The ids are those of the tokenizers library for a byte-level BPE file, without
added begin or end tokens, truncation or padding, found another way:

* Words (pre-tokens) of a group of texts are collected; those that the worker
  does not remember are encoded together.
* Speculate: an Aho-Corasick automaton takes the longest token at every place,
  from the left.
* Verify: one vectorised check tests all adjacent pairs at once.  A pair fits
  if no merge across its border would come before the merges that complete its
  two tokens; the check undoes the merges at the border, the latest first, in
  numpy, for all pairs together.
* A word whose pairs all fit is done: the first merge across any border of the
  word would also happen in the pair at that border.  Only the others are
  merged exactly, by a heap of pairs, in time n log n.

Decoding joins the bytes of the tokens and reads them as UTF-8, with the
replacement character for what is none.

Edge cases: null and empty texts have no ids and decode to the empty text; the
string of a special token in a text is that token, as in the library; repeated
rows are encoded alike; an empty table gives an empty result; a long text is
taken in runs of words; a text without spaces is one word, merged in n log n.
Other columns of the table, whatever their names, are not read.  Files whose
merges make a token twice, or come before the merges of their parts, are
refused: the check needs one history for each token.
"""

from __future__ import annotations

import heapq
import json
import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, table

MEMO = 200_000           # words of one generation that a worker remembers
MEMO_CHARS = 48          # a longer word is not remembered
GROUP_CHARS = 1 << 21    # characters of texts encoded together
RUN_WORDS = 1 << 17      # words of a longer text taken at a time
NEVER = 1 << 40
# fixed values: the pre-token pattern of byte-level BPE
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Character that a byte-level vocabulary file writes for each byte: printable
    ones stand for themselves, the others are moved behind 255 in their order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteEncoder:
    def __init__(self, tokenizer_file: str):
        import ahocorasick
        import regex

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]
                or not pre["use_regex"] or any(model.get(k) for k in (
                    "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
                or any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"])):
            raise ValueError("a byte-level BPE file without normaliser, prefix space, affixes or dropout is needed")
        of_char = byte_alphabet()
        to_bytes = lambda t: bytes(of_char[c] for c in t)
        ids = {to_bytes(t): i for t, i in model["vocab"].items()}
        self.bytes_of = {i: t for t, i in ids.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        size = max(self.bytes_of) + 1
        self.base = [ids[bytes([b])] for b in range(256)]
        # history of each token: the rank of the merge that makes it, its left and its right part
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        parts = [(ids[to_bytes(a)], ids[to_bytes(b)], ids[to_bytes(a) + to_bytes(b)]) for a, b in merges]
        for r, (a, b, c) in enumerate(parts):
            if self.rank[c] >= 0 or len(self.bytes_of[c]) < 2 or max(self.rank[a], self.rank[b]) >= r or any(
                    self.rank[p] < 0 and len(self.bytes_of[p]) > 1 for p in (a, b)):
                raise ValueError("each token needs one merge, after those of its parts")
            self.rank[c], self.left[c], self.right[c] = r, a, b
        self.merge_of = {(a, b): (r, c) for r, (a, b, c) in enumerate(parts)}
        codes = np.array([a << 32 | b for a, b, _ in parts], np.int64)
        order = np.argsort(codes)
        self.codes, self.code_rank = codes[order], order
        # times at which a token at the left, and at the right, of a border is made: of merges of one
        # rank the left one comes first, and a merge across the border (2 * rank) stands between them
        made = self.rank >= 0
        self.made_left = np.where(made, 2 * self.rank - 1, -9)
        self.made_right = np.where(made, 2 * self.rank + 1, -9)
        # only tokens that their own bytes merge to are proposed
        a, b = (np.array(x, np.int64) for x in list(zip(*parts, strict=True))[:2])
        whole = dict(zip((c for _, _, c in parts), self.fits(a, b, top=False), strict=True))
        alive = {i: True for i in self.base}
        for a, b, c in parts:
            alive[c] = bool(alive[a] and alive[b] and whole[c])
        self.found = ahocorasick.Automaton()
        for i, ok in alive.items():
            if ok:
                self.found.add_word(self.bytes_of[i].decode("latin-1"), i)
        self.found.make_automaton()
        self.words = regex.compile(WORDS)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        newer = newer_characters()
        self.newer = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in newer) + "]") if newer else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def fits(self, a: np.ndarray, b: np.ndarray, top: bool = True) -> np.ndarray:
        """Whether merging the bytes of each pair (a, b) gives a and b again; ``top=False``
        leaves out the merge of a with b itself."""
        ok = np.ones(len(a), bool)
        at, x, y = np.arange(len(a)), a, b
        until = np.full(len(a), NEVER if top else -NEVER, np.int64)
        while len(at):
            code = x << 32 | y
            k = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            crossed = (self.codes[k] == code) & (2 * self.code_rank[k] < until)
            ok[at[crossed]] = False
            tx, ty = self.made_left[x], self.made_right[y]
            go = ~crossed & (np.maximum(tx, ty) > -9)
            undo_left = tx > ty
            until = np.where(undo_left, tx, ty)[go]
            x, y = np.where(undo_left, self.right[x], x)[go], np.where(undo_left, y, self.left[y])[go]
            at = at[go]
        return ok

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the pair of lowest rank, the first of equals."""
        out: list[int | None] = [self.base[c] for c in word]
        n, rank = len(out), self.merge_of
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1], i + 1) for i in range(n - 1) if (m := rank.get((out[i], out[i + 1])))]
        heapq.heapify(heap)
        while heap:
            r, i, made, j = heapq.heappop(heap)
            if out[i] is None or after[i] != j or rank.get((out[i], out[j])) != (r, made):
                continue
            out[i], out[j] = made, None
            nxt = after[i] = after[j]
            if nxt < n:
                before[nxt] = i
                if m := rank.get((made, out[nxt])):
                    heapq.heappush(heap, (m[0], i, m[1], nxt))
            prev = before[i]
            if prev >= 0 and (m := rank.get((out[prev], made))):
                heapq.heappush(heap, (m[0], prev, m[1], i))
        return [t for t in out if t is not None]

    def learn(self, words: list[str]) -> None:
        """Encode words that are not remembered, all of them together."""
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(w) for w in raw])
        # a proposed token must not run over the end of its word: words are parted by a sign of no token
        parted = "\u0100".join([w.decode("latin-1") for w in raw])
        got = list(self.found.iter_long(parted))
        last = np.fromiter((e for e, _ in got), np.int64, len(got))
        ids = np.fromiter((i for _, i in got), np.int64, len(got))
        of = np.searchsorted(ends + np.arange(len(raw)), last, side="right")
        inside = np.flatnonzero(of[1:] == of[:-1])
        pair, where = np.unique(ids[inside] << 32 | ids[inside + 1], return_inverse=True)
        bad = np.zeros(len(raw), bool)
        bad[of[inside][~self.fits(pair >> 32, pair & 0xFFFFFFFF)[where]]] = True
        starts = np.searchsorted(of, np.arange(len(raw) + 1)) * 4
        found, memo = ids.astype("<u4").tobytes(), self.memo
        for k, (w, failed) in enumerate(zip(words, bad.tolist(), strict=True)):
            memo[w] = (array_u32(self.merge(raw[k])) if failed else found[starts[k]:starts[k + 1]])

    def split(self, text: str):
        """Runs of words of a text, special tokens among them as words of their own."""
        pieces = self.apart.split(text) if self.apart else [text]
        for p in pieces:
            if not p:
                continue
            if p in self.special:
                yield [p]
                continue
            shown = p if p.isascii() or not self.newer else self.newer.sub("\uffff", p)      # signs to the library
            if len(p) <= GROUP_CHARS and shown == p:
                yield self.words.findall(p)
                continue
            found = self.words.finditer(shown)
            while run := [p[m.start():m.end()] for m in islice(found, RUN_WORDS)]:
                yield run

    def remember(self, words: set[str]) -> None:
        missing = words - self.memo.keys()
        for w in [w for w in missing if w in self.older or w in self.special]:
            self.memo[w] = self.older[w] if w in self.older else array_u32([self.special[w]])
            missing.discard(w)
        if missing:
            self.learn(list(missing))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes of little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        group: list[list[str]] = []
        held = 0

        def flush():
            nonlocal held
            self.remember(set().union(*group))
            memo = self.memo
            out.extend([b"".join([memo[w] for w in ws]) for ws in group])
            self.forget()
            group.clear()
            held = 0

        for text in texts:
            if text and len(text) > GROUP_CHARS:
                flush()
                runs = []
                for run in self.split(text):
                    self.remember(set(run))
                    runs.append(b"".join([self.memo[w] for w in run]))
                    self.forget()
                out.append(b"".join(runs))
                continue
            group.append([w for run in self.split(text or "") for w in run])
            held += len(text or "")
            if held > GROUP_CHARS:
                flush()
        flush()
        return out

    def forget(self) -> None:
        """Bound the remembered words between two groups."""
        if len(self.memo) > MEMO:
            self.older = {w: i for w, i in self.memo.items() if len(w) <= MEMO_CHARS}
            self.memo = {}

    def decode(self, ids: bytes) -> str:
        known = self.bytes_of
        return b"".join([known[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def array_u32(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def newer_characters() -> list[tuple[int, int]]:
    """Letters and digits of this Python's Unicode tables that the library's tables do not hold, as ranges.

    Only code points that the standard library does not know either are asked for."""
    import unicodedata

    import regex
    from tokenizers.pre_tokenizers import ByteLevel

    cut = ByteLevel(add_prefix_space=False)
    free = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    out: list[tuple[int, int]] = []
    for c in regex.findall(r"[\p{L}\p{N}]", free):
        if len(cut.pre_tokenize_str("a" + c)) > 1 and len(cut.pre_tokenize_str("1" + c)) > 1:
            if out and out[-1][1] == ord(c) - 1:
                out[-1] = out[-1][0], ord(c)
            else:
                out.append((ord(c), ord(c)))
    return out


_encoders: dict[str, ByteEncoder] = {}


def encoder(tokenizer_file: str) -> ByteEncoder:
    """The worker's encoder for a file; made once in a process."""
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = ByteEncoder(tokenizer_file)
    return _encoders[tokenizer_file]


# column: Arrow type, DDL, how it comes from the bytes of the ids
OUTPUTS = {"n_tokens": (pa.int64(), "long", lambda enc, ids: len(ids) // 4),
           "ids": (pa.list_(pa.int32()), "array<int>", lambda enc, ids: np.frombuffer(ids, "<i4")),
           "ids_bytes": (pa.binary(), "binary", lambda enc, ids: ids),
           "decoded": (pa.string(), "string", lambda enc, ids: enc.decode(ids))}


def encode_words(docs: DataFrame, tokenizer_file: str, outputs=("n_tokens", "ids", "decoded"),
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the asked ``outputs`` for each row: n_tokens, ids (array), ids_bytes (little-endian
    unsigned 32-bit integers), decoded (the text that the ids stand for).

    A map over rows without a shuffle; a task holds one small batch of texts.
    """
    arrow_batches(docs.sparkSession, 500)
    rows = docs.select(F.col(key), F.col(text))
    keep = rows.schema[0]

    def run(batches):
        enc = encoder(tokenizer_file)
        for batch in batches:
            ids = enc.encode_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([OUTPUTS[o][2](enc, i) for i in ids], OUTPUTS[o][0]) for o in outputs)],
                [key, *outputs])

    return rows.mapInArrow(run, f"`{key}` {keep.dataType.simpleString()}, "
                           + ", ".join(f"{o} {OUTPUTS[o][1]}" for o in outputs))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_words(docs, default_tokenizer(), ("n_tokens", "ids_bytes", "decoded"))
    return out.select("doc_id", "n_tokens", F.sha2("ids_bytes", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
