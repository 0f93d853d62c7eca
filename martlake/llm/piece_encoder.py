"""SentencePiece BPE encoding by backtracking (operator 2).

The ids are those of the sentencepiece library's encode without sampling or
begin / end ids, found another way: an Aho-Corasick automaton gives the longest
piece at every position; pieces are taken greedily; a piece may follow another
only if merging their characters from scratch gives those two pieces again; if
no piece fits, the position is marked in a bitfield as failed and the last
piece is taken back for its next shorter prefix.  An encoding whose neighbours
all fit is the merge result itself, because the first merge across a border of
the whole text would also happen in the pair at that border.

A text is normalised by the model's own rules and cut where no piece can reach
across, before a run of meta spaces; results of short cuts are remembered in a
bounded dictionary.  Characters outside the vocabulary become their byte
pieces.  Decoding is the library's ``decode(ids)``.

Edge cases: null and empty texts have no ids and decode to the empty text;
repeated rows are encoded alike; an empty table gives an empty result; a text
without spaces is one cut, encoded in time in proportion to its length.  Models
of another kind, or with user-defined pieces, are refused.
"""

from __future__ import annotations

import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, table

SPACE = "▁"
MEMO, PAIRS = 250_000, 350_000     # entries of one generation of cuts, and of pairs, in a worker at most
MEMO_CHARS = 48          # a cut of more characters is not remembered
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6    # fixed values: kinds of pieces


class PieceEncoder:
    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or kinds & {USER, UNUSED} or BYTE not in kinds:
            raise ValueError("a BPE model with byte pieces, without user-defined or unused ones, is needed")
        self.text = [p.piece for p in model.pieces]
        self.size = [len(t) for t in self.text]
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.id_of = normal
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        if any(re.search(f"[^{SPACE}]{SPACE}", t) for t in normal):
            self.parts = re.compile(r"(?s).+")      # a piece may reach across: the text is one cut
        # only pieces that their own characters merge to can be in a result
        self.found = ahocorasick.Automaton()
        alive = {t: i for t, i in normal.items() if len(t) == 1 or self.merge(t) == [t]}
        for t, i in alive.items():
            self.found.add_word(t, i)
        self.found.make_automaton()
        # next shorter piece that is a prefix; a first character outside the vocabulary ends the chain as itself
        self.shorter: dict[int, int | None] = {}
        for t, i in alive.items():
            k = next((k for k in range(len(t) - 1, 0, -1) if t[:k] in alive), 0)
            self.shorter[i] = alive[t[:k]] if k else ~ord(t[0]) if len(t) > 1 else None
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.byte_ids = frozenset(self.bytes.values())
        self.decimals = [str(i) for i in range(len(self.text))]
        self.tail = re.compile(rf"({SPACE}*\w+)([^\w{SPACE}]+)")

    def merge(self, text: str) -> list[str]:
        """Merge the characters of ``text``: always the best-scored neighbours, the first of equals."""
        score = self.score
        out = list(text)
        pairs = [score.get(a + b) for a, b in zip(out, out[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, s in enumerate(pairs):
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return out
            out[at:at + 2] = [out[at] + out[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score.get(out[at - 1] + out[at])
            if at < len(pairs):
                pairs[at] = score.get(out[at] + out[at + 1])

    def word(self, i: int) -> str:
        return self.text[i] if i >= 0 else chr(~i)

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the characters of pieces a and b gives a and b again."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            x, y = self.word(a), self.word(b)
            known = self.fits[a, b] = self.merge(x + y) == [x, y]
        return known

    def backtrack(self, cut: str) -> list[int]:
        """Pieces of ``cut``; a character outside the vocabulary is the complement of its code point."""
        n, size, shorter, fits = len(cut), self.size, self.shorter, self.fits
        longest: list[int | None] = [None] * n
        for end, i in self.found.iter(cut):
            longest[end - size[i] + 1] = i      # ends grow, so the longest stays
        open_ = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, last, piece = 0, None, longest[0]
        if piece is None:
            piece = ~ord(cut[0])
        while True:
            end = at + (size[piece] if piece >= 0 else 1)
            if open_[end]:
                known = True if last is None else fits.get((last, piece))
                if known or known is None and self.follows(last, piece):
                    out.append(piece)
                    if end == n:
                        return out
                    at, last, piece = end, piece, longest[end]
                    if piece is None:
                        piece = ~ord(cut[end])
                    continue
            piece = shorter[piece] if piece >= 0 else None
            if piece is None:
                open_[at] = 0
                piece = out.pop()
                at -= size[piece] if piece >= 0 else 1
                last = out[-1] if out else None

    def ids_of(self, cut: str) -> bytes:
        """Ids of a cut, as bytes of an int32 array."""
        ids = array("i")
        for i in self.backtrack(cut):
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.bytes[b] for b in chr(~i).encode())
        return ids.tobytes()

    def remembered(self, cut: str) -> bytes:
        """As :meth:`ids_of`, from two generations of remembered cuts."""
        known = self.memo.get(cut)
        if known is None:
            known = self.older.get(cut)
            if known is None:
                known = self.ids_of(cut)
            if len(cut) <= MEMO_CHARS:
                if len(self.memo) >= MEMO:
                    self.older, self.memo = self.memo, {}
                self.memo[cut] = known
        return known

    def cut_ids(self, cut: str) -> bytes:
        """Ids of a cut that is not remembered.  A word and the signs after it are looked up apart;
        the two results are the whole one if their pieces at the border fit."""
        parted = self.tail.fullmatch(cut)
        if parted:
            a, b = map(self.remembered, parted.groups())
            x, y = array("i", a[-4:])[0], array("i", b[:4])[0]
            if x in self.byte_ids or y in self.byte_ids or self.follows(x, y):
                return a + b
        return self.remembered(cut)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text."""
        if not text:
            return []
        get, missing = self.memo.get, self.cut_ids
        out = array("i")
        out.frombytes(b"".join([get(c) or missing(c) for c in self.parts.findall(self.library.normalize(text))]))
        return out.tolist()

    def decimal(self, ids: list[int]) -> str:
        return ",".join([self.decimals[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_encoders: dict[str, PieceEncoder] = {}


def encoder(model_file: str) -> PieceEncoder:
    """The worker's encoder for a model; made once in a process."""
    if model_file not in _encoders:
        _encoders[model_file] = PieceEncoder(model_file)
    return _encoders[model_file]


OUTPUTS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_text": pa.string(), "decoded": pa.string()}
DDL = {"n_tokens": "long", "ids": "array<int>", "ids_text": "string", "decoded": "string"}


def encode_documents(docs: DataFrame, model_file: str, outputs=("n_tokens", "ids", "decoded"),
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the asked ``outputs`` for each row: n_tokens, ids (array), ids_text (decimal ids
    joined by commas), decoded (the text that decoding the ids gives).

    A map over rows without a shuffle; a task holds one small batch of texts.
    """
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.col(text))
    keep = rows.schema[0]

    def run(batches):
        enc = encoder(model_file)
        for batch in batches:
            got: dict[str, list] = {o: [] for o in outputs}
            for t in batch.column(1):
                ids = enc.encode(t.as_py())
                for o in outputs:
                    got[o].append(len(ids) if o == "n_tokens" else ids if o == "ids" else
                                  enc.decimal(ids) if o == "ids_text" else enc.decode(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(got[o], OUTPUTS[o]) for o in outputs)], [key, *outputs])

    return rows.mapInArrow(run, f"`{key}` {keep.dataType.simpleString()}, "
                           + ", ".join(f"{o} {DDL[o]}" for o in outputs))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_documents(docs, default_model(), ("n_tokens", "ids_text", "decoded"))
    return out.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
