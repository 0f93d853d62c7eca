"""Edit-aware token counts (operator 4).

A document is kept as a segment tree over its pre-tokens: leaves hold runs of
about ``RUN`` pre-tokens with their text, lengths and token counts; inner nodes
hold the sums of characters and tokens below.  An edit replaces characters at a
position.  The tree is descended by character sums to the first pre-token that
the edit can change (a pre-token depends on up to two characters beyond its
end); from there the text is cut into pre-tokens again until a border meets a
border of the old text beyond the edit, from where everything is as before.
Only these pre-tokens are encoded, and only the sums above touched leaves are
updated; a leaf that has grown beyond ``SPLIT`` pre-tokens is split.

``build_trees`` keeps the trees of a table of documents as a table, and
``edit_trees`` applies a batch of edits to such a table: it reads the trees of
the edited documents alone and encodes nothing but what the edits touch.
``count_edited`` does both at once for documents that have no trees yet.

In Spark, edits and rows are dealt by doc_id and sorted, the edits of a document
before its rows, and a task streams through them: it holds the edits of one
document and one tree at a time, however many rows repeat the id.

Edge cases: positions and lengths are code points, cut to the text's ends as it
is when the edit is applied; a null or negative position is the start, a null or
negative length is 0, a null insertion is empty; edits of one document apply in
order of seq, ties by position, length and insertion; edits of unknown or null
documents are ignored; rows that repeat a doc_id each get all its edits; null
and empty texts have no tokens; empty tables and other columns are fine.
"""

from __future__ import annotations

import base64
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, table

RUN = 64                # pre-tokens in a leaf when the tree is built
SPLIT = 4 * RUN         # a leaf of more is split
LOOK = 2                # characters beyond its end that a pre-token depends on, as in white space or "'ll"
MEMO = 400_000          # pre-tokens whose counts a worker remembers, at most
MEMO_CHARS = 48


class PieceCounter:
    """Pre-tokens of a text and their token counts, for a vocabulary of byte pair ranks."""

    def __init__(self, rank_file: str, pattern: str):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(rank_file).read_bytes().splitlines())}
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.memo: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= MEMO_CHARS:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[piece] = n
        return n


class CountTree:
    """Segment tree of a document's pre-tokens."""

    def __init__(self, counter: PieceCounter, text: str, kept: tuple[bytes, bytes] | None = None):
        """The tree of a text; ``kept``: lengths and counts of its pre-tokens as :meth:`kept` gives them."""
        self.counter = counter
        if kept is None:
            pieces = counter.pieces(text)
            memo, count = counter.memo.get, counter.count
            counts = [memo(p) or count(p) for p in pieces]
        else:
            ends = np.cumsum(np.frombuffer(kept[0], "<i4")).tolist()
            pieces = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            counts = np.frombuffer(kept[1], "<i4").tolist()
        self.leaves = [(pieces[i:i + RUN], counts[i:i + RUN]) for i in range(0, len(pieces), RUN)] or [([], [])]
        self.encoded = 0        # pre-tokens encoded again by edits
        self.add_up()

    def add_up(self) -> None:
        """The sums above all leaves."""
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (p, c) in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(map(len, p)), sum(c)
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def split(self, leaf: int) -> None:
        """Cut a leaf into leaves of ``RUN``.  The sums are added up anew: once for the hundreds of
        pre-tokens that a leaf must have gained."""
        pieces, counts = self.leaves[leaf]
        parts = [(pieces[i:i + RUN], counts[i:i + RUN]) for i in range(0, len(pieces), RUN)]
        self.leaves[leaf:leaf + 1] = parts
        self.leaves = [x for x in self.leaves if x[0]] or [([], [])]
        self.add_up()

    def kept(self) -> tuple[bytes, bytes]:
        """Lengths and counts of the pre-tokens, as little-endian 32-bit integers."""
        lengths = [len(p) for pieces, _ in self.leaves for p in pieces]
        counts = [c for _, cs in self.leaves for c in cs]
        return np.array(lengths, "<i4").tobytes(), np.array(counts, "<i4").tobytes()

    def text(self) -> str:
        return "".join(p for pieces, _ in self.leaves for p in pieces)

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf starts."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if char >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        return min(i - self.width, len(self.leaves) - 1), start

    def put(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[leaf] = pieces, counts
        i = self.width + leaf
        chars, tokens = sum(map(len, pieces)) - self.chars[i], sum(counts) - self.tokens[i]
        while i:
            self.chars[i] += chars
            self.tokens[i] += tokens
            i //= 2

    def edit(self, at: int, length: int, insertion: str) -> None:
        """Replace ``length`` characters from ``at`` by ``insertion``."""
        total = self.chars[1]
        at = min(max(at, 0), total)
        stop = at + min(max(length, 0), total - at)
        if stop == at and not insertion:
            return
        left, start = self.leaf_at(max(at - LOOK, 0))
        pieces, counts = self.leaves[left]
        keep = 0
        while keep < len(pieces) and start + len(pieces[keep]) <= at - LOOK:
            start += len(pieces[keep])
            keep += 1
        # text from the first pre-token that may change: what stands before the edit, then the insertion
        head, right = "".join(pieces[keep:]), left
        upto = start + len(head)                        # end of the old text that is at hand
        borders = {}                                    # old borders at and after the edit: (leaf, piece)
        place = start

        def note(leaf, first):
            nonlocal place
            for k, p in enumerate(self.leaves[leaf][0][first:], first):
                place += len(p)
                if place >= stop:
                    borders[place] = leaf, k + 1

        note(left, keep)
        old = [head]
        while upto < stop:
            right += 1
            old.append("".join(self.leaves[right][0]))
            upto += len(old[-1])
            note(right, 0)
        text = "".join(old)
        new = text[:at - start] + insertion + text[stop - start:]
        shift = len(insertion) - (stop - at)
        made: list[str] = []
        while True:
            made, end, met = [], start, None
            for p in self.counter.pieces(new):
                made.append(p)
                end += len(p)
                if end - shift in borders and end - shift >= stop and end >= at + len(insertion) and (
                        end - shift + LOOK <= upto or upto == total):
                    met = borders[end - shift]
                    break
            if met or upto == total:
                break
            right += 1                                  # no border met: read one leaf more
            more = "".join(self.leaves[right][0])
            upto += len(more)
            note(right, 0)
            new += more
        self.encoded += len(made)
        leaf, k = met or (right, len(self.leaves[right][0]))
        tail = self.leaves[leaf][0][k:], self.leaves[leaf][1][k:]
        fresh = pieces[:keep] + made, counts[:keep] + [self.counter.count(p) for p in made]
        if leaf == left:
            self.put(left, fresh[0] + tail[0], fresh[1] + tail[1])
        else:
            self.put(left, *fresh)
            for i in range(left + 1, leaf):
                self.put(i, [], [])
            self.put(leaf, *tail)
        for i in range(leaf + 1, right + 1 if not met else leaf + 1):
            self.put(i, [], [])
        if len(self.leaves[left][0]) > SPLIT:
            self.split(left)


_counters: dict[tuple[str, str], PieceCounter] = {}


def counter(rank_file: str, pattern: str) -> PieceCounter:
    key = rank_file, pattern
    if key not in _counters:
        _counters[key] = PieceCounter(*key)
    return _counters[key]


NAMES = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_pieces_encoded"]


def edited(docs: DataFrame, edits: DataFrame, rank_file: str, pattern: str, keep: bool) -> DataFrame:
    """NAMES and, with ``keep``, text, lengths and counts after the edits, for each row of ``docs`` (doc_id, text,
    and lengths and counts where the trees are known)."""
    arrow_batches(docs.sparkSession, 500)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    none = lambda kind: F.lit(None).cast(kind)
    known = [F.col(c) if c in docs.columns else none("binary").alias(c) for c in ("lengths", "counts")]
    rows = docs.select("doc_id", F.lit(1).alias("kind"), none("long").alias("seq"), none("long").alias("at"),
                       none("long").alias("length"), F.col("text"), *known)
    steps = edits.where("doc_id is not null").select(
        F.col("doc_id").cast(id_type), F.lit(0).alias("kind"), F.col("seq").cast("long"), F.col("at").cast("long"),
        F.col("length").cast("long"), F.col("insertion").alias("text"),
        none("binary").alias("lengths"), none("binary").alias("counts"))
    names = NAMES + (["text", "lengths", "counts"] if keep else [])

    def run(batches):
        made = counter(rank_file, pattern)
        waiting, current = [], None     # edits of the document at hand
        for b in batches:
            kinds = [b.schema.field(0).type, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
            out, held = [], 0
            for doc, kind, at, length, text, lengths, counts in zip(
                    *(b.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6, 7)), strict=True):
                if doc != current:
                    waiting, current = [], doc
                if kind == 0:
                    waiting.append((at or 0, length or 0, text or ""))
                    continue
                tree = CountTree(made, text or "", (lengths, counts) if lengths is not None else None)
                before = tree.tokens[1]
                for edit in waiting:
                    tree.edit(*edit)
                row = (doc, before, len(waiting), tree.tokens[1], tree.encoded)
                if keep:
                    # no text stays no text
                    row += (tree.text() if text is not None or waiting else None, *tree.kept())
                    held += len(row[5] or "")
                out.append(row)
                if held > 1 << 22:
                    yield batch(out, kinds)
                    out, held = [], 0
            if out:
                yield batch(out, kinds)

    def batch(out, kinds):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds[:len(names)], strict=True)], names)

    # documents with a null id hold no edits: they are dealt by their text instead of all to one task
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    together = (rows.unionByName(steps).withColumn("deal", deal)
                .repartition("deal").sortWithinPartitions("doc_id", "kind", "seq", "at", "length", "text"))
    ddl = f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in NAMES[1:])
    return together.drop("deal").mapInArrow(run, ddl + (", text string, lengths binary, counts binary" if keep else ""))


def count_edited(docs: DataFrame, edits: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens (before), n_edits, n_tokens_edited (after all edits), n_pieces_encoded (by edits)
    for each row of ``docs``; ``edits``: doc_id, seq, at, length, insertion."""
    return edited(docs.select("doc_id", "text"), edits, rank_file, pattern, False)


def build_trees(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, text, n_tokens, lengths, counts: the trees of the rows of ``docs``, to be written as a table.

    A map over rows; sums are not kept, since they follow from the lengths and counts by one addition each."""
    arrow_batches(docs.sparkSession, 500)
    rows = docs.select("doc_id", "text")

    def run(batches):
        made = counter(rank_file, pattern)
        for b in batches:
            trees = [CountTree(made, t.as_py() or "") for t in b.column(1)]
            kept = [t.kept() for t in trees]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([t.tokens[1] for t in trees], pa.int64()),
                 *(pa.array([k[i] for k in kept], pa.binary()) for i in (0, 1))],
                ["doc_id", "text", "n_tokens", "lengths", "counts"])

    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, text string, n_tokens long, "
                                "lengths binary, counts binary")


def edit_trees(trees: DataFrame, edits: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """The trees of the documents that have edits, after them: NAMES, text, lengths, counts.  Rows of
    ``trees`` without edits are neither shuffled nor encoded."""
    touched = trees.select("doc_id", "text", "lengths", "counts").join(
        edits.select("doc_id").distinct(), "doc_id", "left_semi")
    return edited(touched, edits, rank_file, pattern, True)


def sample_edits(docs: DataFrame) -> DataFrame:
    """Three edits for each document, drawn from its id and length: a replaced stretch, a deletion
    and an inserted line."""
    size = F.coalesce(F.length("text"), F.lit(0))
    spot = lambda i: F.pmod(F.xxhash64(F.lit(i), "doc_id"), size + 1)
    edit = lambda seq, at, length, insertion: F.struct(
        F.lit(seq).alias("seq"), at.alias("at"), F.lit(length).alias("length"), F.lit(insertion).alias("insertion"))
    return (docs.where("doc_id is not null")
            .select("doc_id", F.explode(F.array(
                edit(0, spot(0), 12, "rewritten words"), edit(1, spot(1), 30, ""),
                edit(2, spot(2), 0, "\nAn added line, 2024.\n"))).alias("e"))
            .select("doc_id", "e.*"))


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op4_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_edited(docs, sample_edits(docs), *default_vocabulary())
