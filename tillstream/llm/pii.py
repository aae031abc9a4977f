"""Personal data by rules and a skip-chain conditional random field.

The rules give base spans, which stay. The field then labels the tokens of each document that could
belong to the same entities: its chain edges link neighbouring tokens, its skip edges link
distant tokens that repeat or resemble each other, such as a card number written again with
other separators or with other digits among its last four. Loopy message passing lets the labels
of base spans flow along these edges; a token whose probability of a kind is the largest, and not
that of no kind, is an added span.

A number may be written in groups. So each base span is a node with all its digits, a phone also
one without its leading groups, and tokens that only together have the digits of a base span, or
all but its last four, are a node too. At least 7 digits must agree: shorter ones, and numbers
with a wrong digit further in front, are not linked.

A token's own potentials are log-odds by its shape, counted over all documents as the rules
label them. They are limited, as the rules know only what they match, and never speak
for a kind by themselves. Each occurrence of a token is linked to the one before and to an
occurrence in a base span, so edges grow with the text, not with its square.

Defined results: a NULL or empty text has no spans. Positions are code points, the end exclusive.
Every row is judged by its text alone, so repeated rows get the same spans. An empty table gives an
empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from tillstream.llm.text import whole_text

KINDS = ("email", "ip", "card", "phone")

# Potentials of the field, as logarithms.
SAME = 4.0
SIMILAR = 3.5
CHAIN = 0.5
SHAPE_LIMITS = (-2.0, -1.0)
LETTERS = -8.0
# Tokens of each shape that are none of the kinds, before any is counted; of each kind, one.
_PRIOR = 20
ROUNDS = 10
DAMPING = 0.3

# Shortest strings of letters and digits, and of digits, that tell one entity from another.
_NAME_CHARS = 5
_NUMBER_DIGITS = 7
# Digits at the end that may differ, and the most that a number of any kind has.
_LAST_DIGITS = 4
_MOST_DIGITS = 19

# What counts as which kind. Runs are taken whole, which does not change the matches.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")
_GROUP = re.compile(r"[0-9]+")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
# What may stand between the groups of one number.
_BETWEEN = " ()./-"
_EDGES = ".,;:!?\"'()[]{}<>"

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
            StructField("added", BooleanType()),
        ]
    )
)
_CELLS = "shape long, kind long, tokens long"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    added: bool = False


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """Each @ with a name before and a domain behind; no character belongs to two matches."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans by the rules, by kind and start."""
    found = [Span("email", *span) for span in _emails(text)] if "@" in text else []
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append(Span("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() <= 37:
            digits = _digits(match[0])
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                found.append(Span("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_digits(match[0])) <= 15:
                found.append(Span("phone", *match.span()))
    return found


class Token(NamedTuple):
    start: int
    end: int
    text: str
    kind: int  # of the base span it lies in, 0 for none
    alone: bool = True  # between white space, not a base span or a run of tokens


def tokens_of(text: str, spans: Sequence[Span]) -> list[Token]:
    """Tokens between white space, without signs around them, with the kind of their base span."""
    ordered = sorted(spans, key=lambda span: span.start)
    out, k = [], 0
    for match in _TOKEN.finditer(text):
        whole = match[0]
        core = whole.strip(_EDGES)
        if not core or not _HINT.search(core):
            continue
        start = match.start() + len(whole) - len(whole.lstrip(_EDGES))
        end = start + len(core)
        while k < len(ordered) and ordered[k].end <= start:
            k += 1
        covers = [x for x in ordered[k : k + 4] if x.start < end and x.end > start]
        out.append(Token(start, end, core, KINDS.index(covers[0].kind) + 1 if covers else 0))
    return out


def _is_number(token: str) -> bool:
    return not any(x.isalpha() or x == "@" for x in token)


def _base_nodes(text: str, spans: Sequence[Span]) -> list[Token]:
    """Each base span of digits as a whole; phones also without their leading groups."""
    out = []
    for span in spans:
        if span.kind == "email":
            continue
        whole, kind = text[span.start : span.end], KINDS.index(span.kind) + 1
        starts = [0]
        if span.kind == "phone":
            starts += [x.start() for x in _GROUP.finditer(whole) if x.start() > 1]
        out += [Token(span.start + at, span.end, whole[at:], kind, False) for at in starts]
    return out


def _run_nodes(text: str, tokens: Sequence[Token], known: Sequence[Token]) -> list[Token]:
    """Runs of tokens outside base spans that together have a key of a known node.

    From each token the run that equals a known number is taken, else the longest that resembles
    one; the next run starts behind it. A run has at most ``_MOST_DIGITS`` digits, so this takes
    linear time.
    """
    keys = {key for node in known for key, _ in _number_keys(node.text, node.kind)}
    fronts = {key.rpartition(":")[2].lstrip("#")[:_NUMBER_DIGITS] for key in keys}
    if not keys:
        return []
    out: list[Token] = []
    digits = ["" if x.kind or not _is_number(x.text) else _digits(x.text) for x in tokens]
    first = 0
    while first < len(tokens):
        held, best, last = digits[first], 0, first
        while held and last + 1 < len(tokens) and digits[last + 1]:
            between = text[tokens[last].end : tokens[last + 1].start]
            last += 1
            held += digits[last]
            if len(between) > 3 or between.strip(_BETWEEN) or len(held) > _MOST_DIGITS:
                break
            if len(held) >= _NUMBER_DIGITS and held[:_NUMBER_DIGITS] not in fronts:
                break
            shared = [key for key, _ in _number_keys(held) if key in keys]
            if shared:
                best = last
            if any(key[0] == "#" for key in shared):
                break
        if best:
            start, end = tokens[first].start, tokens[best].end
            out.append(Token(start, end, text[start:end], 0, False))
        first = max(first, best) + 1
    return out


def nodes_of(text: str, spans: Sequence[Span]) -> list[Token]:
    """The tokens, then base spans and runs of tokens that are no token by themselves."""
    tokens = tokens_of(text, spans)
    known = _base_nodes(text, spans)
    return [*tokens, *known, *_run_nodes(text, tokens, known)]


SHAPES = ("letters", "mixed", "at", "dotted", "short", "number", "long number", "too long")


def shape(token: str) -> int:
    digits = len(_digits(token))
    if "@" in token:
        return SHAPES.index("at")
    if not digits:
        return SHAPES.index("letters")
    if any(x.isalpha() for x in token):
        return SHAPES.index("mixed")
    if token.count(".") >= 2:
        return SHAPES.index("dotted")
    names = ("short", "number", "long number", "too long")
    return SHAPES.index(names[(digits >= _NUMBER_DIGITS) + (digits >= 16) + (digits >= 20)])


def shape_counts(texts: Iterable[str]) -> np.ndarray:
    """Tokens by shape and kind, 0 for none."""
    counts = np.zeros((len(SHAPES), len(KINDS) + 1), np.int64)
    for text in texts:
        if _HINT.search(text):
            for token in tokens_of(text, base_spans(text)):
                counts[shape(token.text), token.kind] += 1
    return counts


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Log-odds of each kind against none, by shape, within limits."""
    table = np.ones((len(SHAPES), len(KINDS) + 1))
    table[:, 0] = _PRIOR
    table += counts
    odds = np.clip(np.log(table) - np.log(table[:, :1]), *SHAPE_LIMITS)
    odds[:, 0] = 0
    odds[SHAPES.index("letters"), 1:] = LETTERS
    return odds


def fit(texts: Iterable[str]) -> np.ndarray:
    """Potentials by shape from these texts."""
    return log_odds(shape_counts(texts))


def _number_keys(number: str, kind: int = 0) -> list[tuple[str, float]]:
    """The digits of a number and, but for addresses, those in front of its last four."""
    digits = _digits(number)
    if len(digits) < _NUMBER_DIGITS:
        return []
    keys = [("#" + digits, SIMILAR)]
    if _NUMBER_DIGITS < len(digits) <= _MOST_DIGITS and kind != KINDS.index("ip") + 1:
        front = max(_NUMBER_DIGITS, len(digits) - _LAST_DIGITS)
        keys.append((f"^{len(digits)}:{digits[:front]}", SIMILAR))
    return keys


def _keys(token: Token) -> list[tuple[str, float]]:
    """What a token shares with others, and how strongly: itself, its name, its digits."""
    lowered = token.text.lower()
    name = lowered.partition("@")[0]
    plain = "".join(x for x in name if x.isalnum())
    keys = [("=" + lowered, SAME)] if len(plain) >= _NAME_CHARS and token.alone else []
    if len(plain) >= _NAME_CHARS and any(x.isdigit() for x in plain) and token.alone:
        keys.append(("~" + plain, SIMILAR))
    return keys + (_number_keys(token.text, token.kind) if _is_number(token.text) else [])


def _edges(tokens: Sequence[Token]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens with the logarithm of their potential for equal labels."""
    places: dict[str, list[int]] = {}
    strengths: dict[str, float] = {}
    edges: dict[tuple[int, int], float] = {}

    def link(a: int, b: int, strength: float) -> None:
        pair = (min(a, b), max(a, b))
        edges[pair] = max(edges.get(pair, 0.0), strength)

    for place, token in enumerate(tokens):
        for key, strength in _keys(token):
            places.setdefault(key, []).append(place)
            strengths[key] = strength
        if place and token.alone and token.start - tokens[place - 1].end <= 3:
            link(place - 1, place, CHAIN)
    for key, found in places.items():
        known = next((k for k in found if tokens[k].kind), None)
        for before, place in zip(found, found[1:], strict=False):
            link(before, place, strengths[key])
        for place in found if known is not None else ():
            if tokens[place].kind:
                known = place
            else:
                link(known, place, strengths[key])
    pairs = np.array(list(edges), np.int64).reshape(-1, 2)
    return pairs, np.array(list(edges.values()))


def marginals(unary: np.ndarray, pairs: np.ndarray, strengths: np.ndarray) -> np.ndarray:
    """Probabilities of the labels by loopy message passing; exact where the edges form no cycle."""
    labels = unary.shape[1]
    source = np.concatenate([pairs[:, 0], pairs[:, 1]])
    target = np.concatenate([pairs[:, 1], pairs[:, 0]])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    gain = np.expm1(np.concatenate([strengths, strengths]))[:, None]
    messages = np.full((len(source), labels), -np.log(labels))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, messages)
        # What a token says to another leaves out what it heard from it.
        said = belief[source] - messages[back]
        said = np.exp(said - said.max(1, keepdims=True))
        # Equal labels weigh exp(strength), others 1.
        sent = np.log(said.sum(1, keepdims=True) + gain * said)
        sent -= np.log(np.exp(sent).sum(1, keepdims=True))
        messages = DAMPING * messages + (1 - DAMPING) * sent
    belief = unary.copy()
    np.add.at(belief, target, messages)
    belief = np.exp(belief - belief.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


_CLAMPED = 50.0


def _outermost(spans: Sequence[Span]) -> list[Span]:
    """The spans that lie in no other one."""
    out: list[Span] = []
    for span in sorted(spans, key=lambda span: (span.start, -span.end)):
        if not out or span.end > out[-1].end:
            out.append(span)
    return out


def find_spans(text: str, odds: np.ndarray) -> list[Span]:
    """Base spans and added ones, by kind and start."""
    if not _HINT.search(text):
        return []
    base = base_spans(text)
    if not base:
        return []
    tokens = nodes_of(text, base)
    pairs, strengths = _edges(tokens)
    added = []
    if len(pairs) and any(not token.kind for token in tokens):
        unary = odds[[shape(token.text) for token in tokens]].copy()
        for place, token in enumerate(tokens):
            if token.kind:
                unary[place, token.kind] = _CLAMPED
        label = marginals(unary, pairs, strengths).argmax(1)
        added = [
            Span(KINDS[kind - 1], token.start, token.end, True)
            for token, kind in zip(tokens, label, strict=True)
            if kind and not token.kind
        ]
    return sorted([*base, *_outermost(added)], key=lambda span: (KINDS.index(span.kind), span.start))


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Shape potentials from all documents: the counts are summed per task, then over the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SHAPES), len(KINDS) + 1), np.int64)
        for batch in batches:
            total += shape_counts(text.as_py() for text in batch.column("text"))
        shapes, kinds = np.nonzero(total)
        columns = [pa.array(x, pa.int64()) for x in (shapes, kinds, total[shapes, kinds])]
        yield pa.RecordBatch.from_arrays(columns, ["shape", "kind", "tokens"])

    parts = docs.select(whole_text(text_col).alias("text")).mapInArrow(count, _CELLS)
    counts = np.zeros((len(SHAPES), len(KINDS) + 1), np.int64)
    for row in parts.groupBy("shape", "kind").agg(F.sum("tokens").alias("tokens")).collect():
        counts[row["shape"], row["kind"]] = row["tokens"]
    return log_odds(counts)


def personal_data(text: Column, odds: np.ndarray) -> Column:
    """Array of ``(kind, start, end, added)`` of each whole text."""

    @F.pandas_udf(SPANS)
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [span._asdict() for span in find_spans(text, odds)])

    return found(whole_text(text))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    each = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return F.concat_ws(",", each)


def redact(text: str, spans: Sequence[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are one."""
    out, at = [], 0
    for span in sorted(spans, key=lambda span: (span.start, -span.end)):
        if span.start >= at:
            out += [text[at : span.start], f"[{span.kind}]"]
        at = max(at, span.end)
    return "".join(out) + text[at:]
