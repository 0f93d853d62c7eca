"""Personal data by weak-supervision aggregation (operator 3).

Base spans (email, ip, card, phone) are leftmost non-overlapping matches per
kind with their checks, found in time in proportion to the text; they always stay.

The method adds spans.  Looser patterns give more candidates (spelled-out
addresses, IPv6, grouped digits, national phone numbers).  Five labelers vote
yes, no or nothing on every candidate, base spans included:

* ``form``: usual grouping (card and phone groups, dotted quads, local parts);
* ``check``: a checksum or range (Luhn, octets, digit counts);
* ``gazetteer``: endings of addresses, ranges of card issuers with their lengths, country codes, the
  rules of area codes and exchanges;
* ``context``: words of the kind just before the span;
* ``against``: signs that it is something else (part of a longer token, words for order numbers).

Beside the votes a candidate has features of its own, which no labeler holds:
its separators, length, variety of digits, and the signs before and after it.
Candidates are counted by (kind, votes, features), a table whose size is bounded
by the values these have.  Expectation-maximisation over the votes estimates
each labeler's reliability per kind and the chance of each row, beginning from
``PRIOR`` candidates a kind, so that no kind depends on base spans in the table;
a logistic span classifier on votes and features is then trained on these
chances, weighted by the counts.  All candidates that no base span touches are
judged; from ``MIN_CHANCE`` up they are accepted, and only accepted ones exclude
each other: the more likely, then the longer, then the first one stays.

Edge cases: null and empty texts hold nothing; repeated rows are treated alike;
an empty table gives an empty result; other columns are ignored (``redact``
returns all columns).  Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import arrow_batches, stage, table

KINDS = ("email", "ip", "card", "phone")        # fixed order
LABELERS = ("form", "check", "gazetteer", "context", "against")
MIN_CHANCE = 0.95
CONTEXT = 40                                    # code points before a span that the context labelers see

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# base patterns; the look-behinds and possessive repeats only save time
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# candidates beyond the base
SPELLED = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{1,63}"
                     r"(?:(?:\.|\x20?[(\[]\x20?dot\x20?[)\]]\x20?)[A-Za-z0-9-]{1,63}){1,5}")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])")
NATIONAL = re.compile(r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])")
# fixed values: endings beside the two-letter ones of countries; issuers as (first, last, lengths) of leading digits;
# country codes of one and two digits (all others have three)
ENDINGS = frozenset("com org net edu gov mil int info biz name pro mobi aero coop museum jobs travel cat tel asia post "
                    "app dev cloud online site shop store tech blog email xyz club live world agency company".split())
ISSUERS = [("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)),
           ("300", "305", (14,)), ("36", "36", (14,)), ("38", "39", (14,)), ("6011", "6011", (16, 17, 18, 19)),
           ("644", "649", (16, 17, 18, 19)), ("65", "65", (16, 17, 18, 19)), ("3528", "3589", (16, 17, 18, 19)),
           ("62", "62", (16, 17, 18, 19)), ("50", "50", (13, 14, 15, 16, 17, 18, 19)), ("56", "58", (13, 14, 15, 16, 17, 18, 19))]
COUNTRIES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                      "81 82 84 86 90 91 92 93 94 95 98".split())
CARD_GROUPS = frozenset([(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)])
# candidates that every kind starts from, as votes and their number
PRIOR = (("++++0", 5), ("++++0", 5), ("+++00", 5), ("--00-", 5), ("---0-", 5), ("0--0-", 5))
WORDS = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server|client)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|credit|debit|tarjeta|carte|karte)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|telefon|call|mobile|cell|fax)\b"),
}
OTHER = re.compile(r"(?i)\b(?:order|invoice|isbn|issn|version|serial|ticket|item|id|no|number|sku)\b[\s:.#]*$")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octets(s: str) -> bool:
    parts = [p.lstrip("0") for p in s.split(".")]
    return all(len(p) <= 3 and (not p or int(p) <= 255) for p in parts)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of the base spans, sorted, and the card matches that failed their check."""
    out, failed = [], []
    if "@" in text:
        upto = 0
        for m in AT_DOMAIN.finditer(text):
            start = m.start()
            while start > upto and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                upto = m.end()
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if octets(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = only_digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
            elif 13 <= len(digits) <= 19:
                failed.append((m.start(), m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(only_digits(m[0])) <= 15]
    return sorted(out), failed


def issued(digits: str) -> bool:
    """Whether a card number is in an issuer's range and has one of its lengths."""
    return any(len(digits) in lengths and low <= digits[:len(low)] <= high for low, high, lengths in ISSUERS)


def dialled(s: str, digits: str) -> bool:
    """Whether a phone number follows a numbering plan: a country code and enough digits after it, or a
    ten-digit number whose area and exchange may exist."""
    if s[0] == "+":
        code = next((n for n in (1, 2) if digits[:n] in COUNTRIES), 3)
        return digits[0] != "0" and 7 <= len(digits) - code <= 12
    return (len(digits) == 10 and digits[0] in "23456789" and digits[1] != "9" and digits[1:3] != "11"
            and digits[3] in "23456789" and digits[4:6] != "11")


def usual_form(name: str, s: str) -> str:
    groups = tuple(len(g) for g in re.findall("[0-9]+", s))
    if name == "email":
        local = re.split(r"[@(\[]", s)[0].strip()
        return "+" if local[:1].isalpha() and len(local) <= 32 else "-" if not any(c.isalpha() for c in local) else "0"
    if name == "ip":
        return "+" if ":" in s or all(g == str(int(g)) for g in s.split(".") if len(g) <= 3) and max(groups) <= 3 else "-"
    if name == "card":
        return "+" if groups in CARD_GROUPS else "0" if len(groups) == 1 else "-"
    if s[0] == "+":
        return "+" if 2 <= len(groups) <= 6 and max(groups) <= 5 else "0" if len(groups) == 1 else "-"
    return "+" if groups == (3, 3, 4) else "-"


def votes(text: str, kind: int, start: int, end: int) -> str:
    """A sign for each labeler: + yes, - no, 0 nothing."""
    s, name = text[start:end], KINDS[kind]
    digits = only_digits(s)
    before = text[max(0, start - CONTEXT):start]
    if name == "email":
        ending = re.split(r"[^A-Za-z0-9]+", s)[-1].lower()
        check = "+" if len(s) <= 254 and ".." not in s else "-"
        gaz = "+" if ending in ENDINGS or len(ending) == 2 and ending.isalpha() else "-"
    elif name == "ip":
        check = "0" if ":" in s else "+" if octets(s) else "-"
        gaz = "-" if s.startswith(("0.", "255.")) else "0"
    elif name == "card":
        check = "+" if luhn(digits) else "-"
        gaz = "+" if issued(digits) else "-"
    else:
        check = "+" if 10 <= len(digits) <= 15 else "-"
        gaz = "+" if dialled(s, digits) else "-"
    inside = start > 0 and (text[start - 1].isalnum() or text[start - 1] in "_/=")
    inside |= end < len(text) and (text[end].isalnum() or text[end] == "_")
    return (usual_form(name, s) + check + gaz + ("+" if WORDS[name].search(before) else "0")
            + ("-" if inside or OTHER.search(before) else "0"))


def around(c: str) -> str:
    return "e" if not c else "s" if c.isspace() else "p" if c in ".,;!?" else "b" if c in "()[]<>\"'" else "c" if c in ":=#" else "o"


def features(text: str, start: int, end: int) -> str:
    """A sign for each feature of the span and what touches it."""
    s = text[start:end]
    marks = {c for c in s if not c.isalnum()}
    digits = only_digits(s)
    return (("n" if not marks else "m" if len(marks) > 1 else "s" if marks == {" "} else "d" if marks == {"-"} else "o")
            + str(min(9, len(s) // 4)) + str(min(3, len(set(digits)) // 3))
            + around(text[start - 1:start]) + around(text[end:end + 1]))


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str]]]:
    """Base spans (start, kind, end), and the candidates beyond them with their votes, in order."""
    if not text:
        return [], []
    base, failed = base_spans(text)
    loose = [(a, 2, b) for a, b in failed]
    if "at)" in text or "at]" in text or "at )" in text or "at ]" in text:
        loose += [(m.start(), 0, m.end()) for m in SPELLED.finditer(text)]
    if ":" in text:
        loose += [(m.start(), 1, m.end()) for m in IPV6.finditer(text)]
    loose += [(m.start(), 3, m.end()) for m in NATIONAL.finditer(text)]
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))      # furthest end so far
    more = []
    for a, kind, b in sorted(loose):
        before = bisect_left(starts, b)
        if not (before and reach[before - 1] > a):
            more.append((a, kind, b, judged(text, kind, a, b)))
    return base, more


def judged(text: str, kind: int, start: int, end: int) -> str:
    """What decides about a candidate: its votes and features."""
    return votes(text, kind, start, end) + features(text, start, end)


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base (start, kind, end), more (start, kind, end, votes) and base_votes, one row per document."""
    arrow_batches(docs.sparkSession)
    span = [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]
    kinds = {"base": pa.list_(pa.struct(span)), "more": pa.list_(pa.struct([*span, ("votes", pa.string())])),
             "base_votes": pa.list_(pa.string())}
    rows = docs.select("doc_id", F.col("text"))
    id_type = rows.schema[0].dataType.simpleString()

    def run(batches):
        for b in batches:
            base, more, seen = [], [], []
            for t in b.column(1):
                text = t.as_py()
                x, y = scan(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in x])
                more.append([{"start": s, "kind": k, "end": e, "votes": v} for s, k, e, v in y])
                seen.append([judged(text, k, s, e) for s, k, e in x])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, k) for x, k in zip((base, more, seen), kinds.values(), strict=True))],
                ["doc_id", *kinds])

    return rows.mapInArrow(run, f"doc_id {id_type}, base array<struct<start:int,kind:int,end:int>>, "
                           "more array<struct<start:int,kind:int,end:int,votes:string>>, base_votes array<string>")


def vote_counts(spans: DataFrame) -> list[tuple[int, str, int]]:
    """Rows of (kind, votes and features) over all candidates.  They come to the driver: their number is
    bounded by the values that votes (3**5) and features have, and far smaller in any text."""
    both = F.concat(F.transform("more", lambda m: F.struct(m["kind"].alias("kind"), m["votes"].alias("votes"))),
                    F.transform("base", lambda m, i: F.struct(m["kind"].alias("kind"),
                                                              F.get("base_votes", i).alias("votes"))))
    got = spans.select(F.explode(both).alias("c")).groupBy("c.kind", "c.votes").count().collect()
    return sorted((r[0], r[1], r[2]) for r in got)


def reliabilities(patterns: list[tuple[str, int]], rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for one kind: the chance of each vote pattern, and per
    labeler P(vote = +, -, 0 | personal data or not).

    Starts from the share of yes among the votes cast; one pseudo-count a cell.
    """
    v = np.array([["+-0".index(c) for c in p] for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    yes, no = (v == 0).sum(1), (v == 1).sum(1)
    chance = (yes + 0.5) / (yes + no + 1.0)
    given = np.zeros((2, v.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([(1 - chance) * n, chance * n])
        for j in range(v.shape[1]):
            for k in range(3):
                given[:, j, k] = weight[:, v[:, j] == k].sum(1) + 1.0
        given /= given.sum(2, keepdims=True)
        prior = (weight.sum(1) + 1.0) / (n.sum() + 2.0)
        like = np.log(prior)[:, None] + sum(np.log(given[:, j, v[:, j]]) for j in range(v.shape[1]))
        new = 1 / (1 + np.exp(np.clip(like[0] - like[1], -500, 500)))
        if np.abs(new - chance).max() < 1e-9:
            break
        chance = new
    return chance, given


def train_classifier(x: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps on weighted rows with soft targets."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(beta)),
                               x.T @ (weight * (p - target)) + beta)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def accepted_votes(counts: list[tuple[int, str, int]]) -> dict[tuple[int, str], float]:
    """The chance of each (kind, votes and features) that the final classifier takes for personal data."""
    out = {}
    n_votes = len(LABELERS)
    for kind in sorted({k for k, _, _ in counts}):
        mine = [(v, n) for k, v, n in counts if k == kind]
        seen: dict[str, float] = {}
        for v, n in [*mine, *PRIOR]:
            seen[v[:n_votes]] = seen.get(v[:n_votes], 0) + n
        chance, _ = reliabilities(list(seen.items()))
        of = dict(zip(seen, chance, strict=True))
        kinds = [(j, c) for j in range(n_votes) for c in "+-"]
        kinds += sorted({(j, v[j]) for v, _ in mine for j in range(n_votes, len(v))})
        x = np.array([[v[j:j + 1] == c for j, c in kinds] for v, _ in [*mine, *PRIOR]], float)
        target = np.array([of[v[:n_votes]] for v, _ in [*mine, *PRIOR]])
        beta = train_classifier(x, target, np.array([n for _, n in [*mine, *PRIOR]], float))
        p = 1 / (1 + np.exp(-np.clip(np.hstack([np.ones((len(x), 1)), x]) @ beta, -30, 30)))
        out |= {(kind, v): float(q) for (v, _), q in zip(mine, p[:len(mine)], strict=True) if q >= MIN_CHANCE}
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def all_spans(base, more, accepted) -> list[tuple[int, int, int]]:
    """Base spans, and accepted candidates: of those that overlap the more likely, the longer, the first."""
    taken: list[tuple[int, int]] = []
    out = list(base)
    good = [(-accepted[k, v], s - e, s, k, e) for s, k, e, v in more if (k, v) in accepted]
    for _, _, s, k, e in sorted(good):
        at = bisect_left(taken, (s, e))
        if not (at and taken[at - 1][1] > s or at < len(taken) and taken[at][0] < e):
            taken.insert(at, (s, e))
            out.append((s, k, e))
    return sorted(out)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base and spans as ``kind:start:end`` joined by commas."""
    found = stage(find_spans(docs), "pii-spans")
    accepted = accepted_votes(vote_counts(found))
    id_type = found.schema[0].dataType.simpleString()

    def run(batches):
        for b in batches:
            counts, first, every = [[] for _ in KINDS], [], []
            for base, more in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                base = [(m["start"], m["kind"], m["end"]) for m in base]
                more = [(m["start"], m["kind"], m["end"], m["votes"]) for m in more]
                for i, c in enumerate(counts):
                    c.append(sum(k == i for _, k, _ in base))
                first.append(joined(base))
                every.append(joined(all_spans(base, more, accepted)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(first, pa.string()),
                 pa.array(every, pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return found.select("doc_id", "base", "more").mapInArrow(
        run, f"doc_id {id_type}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets, all columns kept.

    Overlapping spans become one, named after the first.  ``n_chars``, if there, follows the text.
    Spans are found again where the texts are, so no text is shuffled.
    """
    accepted = accepted_votes(vote_counts(stage(find_spans(docs), "pii-spans")))
    names = docs.columns
    at = names.index("text")

    def clean(text):
        spans = all_spans(*scan(text), accepted)
        if not spans:
            return text
        out, upto = [], 0
        for s, k, e in spans:
            if s >= upto:
                out += [text[upto:s], f"[{KINDS[k].upper()}]"]
            upto = max(upto, e)
        return "".join([*out, text[upto:]])

    def run(batches):
        for b in batches:
            texts = [clean(t.as_py()) for t in b.column(at)]
            columns = list(b.columns)
            columns[at] = pa.array(texts, pa.string())
            if "n_chars" in names:
                i = names.index("n_chars")
                old = columns[i].to_pylist()
                columns[i] = pa.array([n if t is None or t == u.as_py() else len(t) for n, t, u in zip(
                    old, texts, b.column(at), strict=True)], columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")
