"""Personal data: patterns, and a skip-chain conditional random field around them.

Four patterns find the base spans (email, ip, card, phone).  They are matched
by runs of byte classes, so any text is read in linear time.  A conditional
random field then labels every word that holds a digit or an ``@``; other words
can only be O, so they end a chain.  Neighbouring words share a potential, and
so do distant ones of a document that repeat each other or resemble each other
(the same last seven digits, local part or first three groups).  Equal words are
linked each to its next occurrence, so links grow with the words.  Words in base
spans are observed; sum-product messages pass them on for ``SWEEPS`` rounds, the
same for every document whatever else its batch holds.  A word whose label has a
probability of ``SURE`` or more joins the spans, unless it is no such thing by
its shape or touches a base span.

A null or empty text has no spans.  Repeated rows are judged each.  Texts of any
length are read whole; a text is one task's.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, slices, text_buffer
from .words import SPACE, word_spans

KINDS = ("email", "ip", "card", "phone")
#: Bytes of text judged together; a longer text is judged alone.
SLICE_BYTES = 1 << 20
#: Messages computed at once.
LINKS = 1 << 16
SWEEPS, DAMPING, SURE = 16, 0.3, 0.9
#: Documents that the generator draws for training, and the seed of the draw.
TRAIN_DOCS, SEED = 3000, 11


def _class(*parts: int | range | bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    for p in parts:
        flags[[p] if isinstance(p, int) else list(p)] = True
    return flags


DIGIT = _class(range(48, 58))
LABEL = _class(range(48, 58), range(65, 91), range(97, 123), b"-")
LOCAL = LABEL | _class(b"._%+")
CALL = DIGIT | _class(b" ().-")


class Text(NamedTuple):
    """Texts of a slice as bytes; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def runs(self, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each longest run of a class inside a text."""
        starts, ends, _ = word_spans(self.data, self.offsets, ~flags)
        return starts, ends, self.text_of(starts)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, side="right") - 1

    def chains(self, runs: tuple[np.ndarray, np.ndarray, np.ndarray], by: bytes) -> np.ndarray:
        """The number of the chain of each run: runs parted by just one byte of ``by``."""
        starts, ends, text = runs
        linked = (starts[1:] - ends[:-1] == 1) & (text[1:] == text[:-1])
        linked[linked] = _class(by)[self.data[ends[:-1][linked]]]
        return np.cumsum(np.r_[True, ~linked][: len(starts)]) - 1


def luhn(digits: bytes) -> bool:
    values = [d - 48 for d in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def octet(digits: bytes) -> bool:
    short = digits.lstrip(b"0")
    return len(short) < 4 and int(short or b"0") <= 255


def _emails(text: Text) -> list[tuple[int, int]]:
    at = np.flatnonzero(text.data == 64)
    if not len(at):
        return []
    where = text.text_of(at)
    local, label = text.runs(LOCAL), text.runs(LABEL)
    chain = text.chains(label, b".")
    if not len(chain) or not len(local[0]):
        return []
    last = np.searchsorted(chain, chain, side="right") - 1
    i = np.minimum(np.searchsorted(local[1], at), len(local[1]) - 1)
    j = np.minimum(np.searchsorted(label[0], at + 1), len(label[0]) - 1)
    good = (local[1][i] == at) & (local[2][i] == where) & (label[0][j] == at + 1) & (label[2][j] == where) & (last[j] > j)
    out, end = [], 0
    for p, start, stop in zip(at[good].tolist(), local[0][i[good]].tolist(), label[1][last[j[good]]].tolist(), strict=True):
        if max(start, end) < p:
            out.append((max(start, end), stop))
            end = stop
    return out


def base_spans(text: Text) -> list[tuple[int, int, int]]:
    """kind, start and end in bytes of the base spans of all texts, by kind and start."""
    raw = memoryview(np.ascontiguousarray(text.data))
    out = [(0, a, b) for a, b in _emails(text)]
    digits = text.runs(DIGIT)
    starts, ends, where = digits
    if len(starts):
        chain = text.chains(digits, b".")
        place = np.arange(len(chain)) - np.searchsorted(chain, chain)
        size = np.bincount(chain)[chain]
        for i in np.flatnonzero((place % 4 == 0) & (place + 3 < size)).tolist():
            if all(octet(bytes(raw[starts[k] : ends[k]])) for k in range(i, i + 4)):
                out.append((1, int(starts[i]), int(ends[i + 3])))
        chain = text.chains(digits, b" -")
        first = np.flatnonzero(np.r_[True, chain[1:] != chain[:-1]])
        after = np.r_[first[1:], len(chain)]
        count = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=count[1:])
        number = count[after] - count[first]
        for i, j in zip(first[(number >= 13) & (number <= 19)].tolist(), after[(number >= 13) & (number <= 19)].tolist(), strict=True):
            if luhn(b"".join(bytes(raw[starts[k] : ends[k]]) for k in range(i, j))):
                out.append((2, int(starts[i]), int(ends[j - 1])))
        plus = np.flatnonzero(text.data == 43)
        call = text.runs(CALL)
        if len(plus):
            r = np.minimum(np.searchsorted(call[0], plus + 1), len(call[0]) - 1)
            near = np.minimum(plus + 1, len(text.data) - 1)
            good = (call[0][r] == plus + 1) & (call[2][r] == text.text_of(plus)) & DIGIT[text.data[near]]
            plus, stop = plus[good], call[1][r[good]]
            j = np.searchsorted(starts, stop) - 1
            last = ends[j]
            # The first run of digits begins right behind the plus.
            n = count[j + 1] - count[np.searchsorted(starts, plus + 1)]
            good = (last - 1 >= plus + 3) & (n >= 9) & (n <= 15)
            out += [(3, a, b) for a, b in zip(plus[good].tolist(), last[good].tolist(), strict=True)]
    return sorted(out)


# Words of the field.

#: Words that announce a kind when they stand at most two words before.
CUES = {
    "email": "email e-mail mail mailto courriel correo",
    "ip": "ip host server address serveur servidor",
    "card": "card visa mastercard credit carte tarjeta karte",
    "phone": "phone tel call mobile fax cell telefon telephone telefono",
}
_CUE = {w: k for k, words in enumerate(CUES.values()) for w in words.split()}
_NUMBER = re.compile(rb"[+(]?[0-9][0-9().+-]*")
_QUAD = re.compile(rb"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_MAIL = re.compile(rb"[^@]+@[^@.]+(\.[^@.]+)+")
_HEX = re.compile(rb"[0-9a-fA-F]+")
_EDGES = b"()[]{}<>.,;:!?\"'#$%&*|=`"
_HEAD = b")[]{}<>.,;:!?\"'#$%&*|=`"
SIZES = (0, 2, 3, 4, 6, 7, 8, 12, 19)
FEATURES = ["bias", *(f"digits<={n}" for n in SIZES), "digits>19", "plus", "parens", "hyphen", "at", "mail", "quad", "quad over", "letters", "hex", "number", "luhn", "luhn window", "after plus", "call window", *(f"cue {k}" for k in KINDS)]
_F = {name: i for i, name in enumerate(FEATURES)}


class Word(NamedTuple):
    """A word of the field: its core in bytes, its place, its digits."""

    start: int
    end: int
    place: int
    core: bytes
    digits: bytes


def _core(raw: bytes, start: int) -> tuple[int, int, bytes]:
    """The word without marks around it; an opening parenthesis or plus before a digit stays."""
    left = raw.lstrip(_HEAD)
    if left[:1] == b"(" and not re.match(rb"\([0-9]+\)", left):
        left = left.lstrip(_EDGES)
    core = left.rstrip(_EDGES if not re.fullmatch(rb"\([0-9]+\)[^0-9]*", left) else _EDGES.replace(b")", b""))
    at = start + len(raw) - len(left)
    return at, at + len(core), core


def _windows(words: list[Word], run: list[int], feats: np.ndarray) -> None:
    """Marks the words of ``run``, numbers one behind another, that together make a card or follow a plus."""
    sizes = [len(words[i].digits) for i in run]
    for a in range(len(run)):
        if sizes[a] != 4 or a + 3 >= len(run):
            continue
        group = run[a : a + 4]
        if sizes[a + 1 : a + 3] == [4, 4] and 1 <= sizes[a + 3] <= 7 and luhn(b"".join(words[i].digits for i in group)):
            feats[group, _F["luhn window"]] = 1
    for a, i in enumerate(run):
        if words[i].core[:1] == b"+":
            total = 0
            for k in range(a, len(run)):
                if k > a and words[run[k]].core[:1] == b"+" or total + sizes[k] > 15:
                    break
                total += sizes[k]
                feats[run[k], _F["after plus"]] = 1
                if total >= 10:
                    break
        elif re.fullmatch(rb"\([0-9]{3}\)", words[i].core) and a + 1 < len(run) and sizes[a + 1] == 7:
            feats[run[a : a + 2], _F["call window"]] = 1
        elif re.fullmatch(rb"(\([0-9]{3}\)|[0-9]{3}-)[0-9]{3}-[0-9]{4}", words[i].core):
            feats[i, _F["call window"]] = 1


class Field(NamedTuple):
    """The words of a slice, their features, and the links between them with their kind (0 chain, 1 same, 2 alike)."""

    words: list[Word]
    features: np.ndarray
    left: np.ndarray
    right: np.ndarray
    link: np.ndarray


def field(text: Text) -> Field:
    starts, ends, _ = word_spans(text.data, text.offsets, SPACE)
    marked = np.zeros(len(text.data) + 1, np.int64)
    np.cumsum(DIGIT[text.data] | (text.data == 64), out=marked[1:])
    chosen = np.flatnonzero(marked[ends] > marked[starts])
    where = text.text_of(starts[chosen]).tolist()
    raw = memoryview(np.ascontiguousarray(text.data))
    words: list[Word] = []
    feats = np.zeros((len(chosen), len(FEATURES)))
    feats[:, 0] = 1
    links: list[tuple[int, int, int]] = []
    seen: dict[tuple[int, int, bytes], int] = {}
    run: list[int] = []
    word = lambda k: bytes(raw[starts[k] : min(ends[k], starts[k] + 16)]).lower().strip(_EDGES)
    for n, k in enumerate(chosen.tolist()):
        start, end, core = _core(bytes(raw[starts[k] : ends[k]]), int(starts[k]))
        digits = bytes(c for c in core if 48 <= c <= 57)
        words.append(Word(start, end, k, core, digits))
        f, size = feats[n], len(digits)
        f[1 + next((i for i, most in enumerate(SIZES) if size <= most), len(SIZES))] = 1
        number, quad = _NUMBER.fullmatch(core) is not None, _QUAD.fullmatch(core)
        names = [("plus", core[:1] == b"+"), ("parens", b"(" in core or b")" in core), ("hyphen", b"-" in core), ("at", b"@" in core), ("mail", _MAIL.fullmatch(core) is not None), ("letters", any(c >= 65 for c in core)), ("hex", size < len(core) > 15 and _HEX.fullmatch(core) is not None), ("number", number)]
        names += [("quad", quad and all(map(octet, quad.groups()))), ("quad over", quad and not all(map(octet, quad.groups()))), ("luhn", number and 13 <= size <= 19 and luhn(digits))]
        for name, holds in names:
            if holds:
                f[_F[name]] = 1
        d = where[n]
        for back in (k - 1, k - 2):
            if back >= 0 and starts[back] >= text.offsets[d] and (cue := _CUE.get(word(back))) is not None:
                f[_F[f"cue {KINDS[cue]}"]] = 1
        beside = n > 0 and chosen[n - 1] == k - 1 and where[n - 1] == d
        if beside:
            links.append((n - 1, n, 0))
        keys = [(1, digits if number and size > 3 else core.lower())]
        keys += [(2, digits[-7:])] if number and 7 <= size <= 15 and not quad else []
        keys += [(2, core.lower().partition(b"@")[0] + b"@")] if b"@" in core else []
        keys += [(2, b".".join(quad.groups()[:3]))] if quad else []
        for link, key in keys:
            before = seen.get((d, link, key))
            if before is not None and not (link == 2 and (before, n, 1) in links[-3:]):
                links.append((before, n, link))
            seen[d, link, key] = n
        if run and not (beside and number):
            _windows(words, run, feats)
            run = []
        if number:
            run.append(n)
    if run:
        _windows(words, run, feats)
    table = np.array(links, np.int64).reshape(-1, 3)
    return Field(words, feats, table[:, 0], table[:, 1], table[:, 2])


# The model: unary weights and one symmetric or ordered table for each kind of link.


class Model(NamedTuple):
    unary: np.ndarray
    pair: np.ndarray


def marginals(f: Field, observed: np.ndarray, model: Model, sweeps: int = SWEEPS) -> np.ndarray:
    """Probability of each label (O first) of each word by loopy sum-product; observed is a label or -1."""
    local = f.features @ model.unary
    known = observed >= 0
    local[known] = -1e4
    local[known, observed[known]] = 0
    source, target = np.r_[f.left, f.right], np.r_[f.right, f.left]
    m = len(f.left)
    # The table of a link read from its left word, and from its right one.
    tables, table = np.concatenate([model.pair, model.pair.transpose(0, 2, 1)]), np.r_[f.link, f.link + len(model.pair)]
    reverse = np.r_[np.arange(m, 2 * m), np.arange(m)]
    messages = np.zeros((2 * m, 5))
    belief = local
    for _ in range(sweeps if m else 0):
        new = np.empty_like(messages)
        for a in range(0, 2 * m, LINKS):
            part = slice(a, a + LINKS)
            x = (belief[source[part]] - messages[reverse[part]])[:, :, None] + tables[table[part]]
            top = x.max(1)
            out = top + np.log(np.exp(x - top[:, None, :]).sum(1))
            new[part] = out - out.max(1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * new
        belief = local.copy()
        np.add.at(belief, target, messages)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _covered(words: list[Word], spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The label of the span that each word touches, or -1."""
    out = np.full(len(words), -1)
    starts, ends = (np.array([getattr(w, x) for w in words], np.int64) for x in ("start", "end"))
    for kind, a, b in spans:
        i, j = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b)
        out[i:j] = kind + 1
    return out


def _shape(kind: int, words: list[Word]) -> bool:
    """Whether words found by the field can be what they are said to be."""
    size = sum(len(w.digits) for w in words)
    core = words[0].core
    if kind == 0:
        return len(words) == 1 and b"@" in core.strip(b"@") and len(core) < 321
    if kind == 1:
        return len(words) == 1 and (q := _QUAD.fullmatch(core)) is not None and all(map(octet, q.groups()))
    return 13 <= size <= 19 if kind == 2 else 7 <= size <= 15


def added_spans(text: Text, base: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """What the field adds: kind, start, end in bytes; neighbours of one kind are one span as far as its digits go."""
    f = field(text)
    if not f.words:
        return []
    observed = _covered(f.words, base)
    p = marginals(f, observed, model)
    label = np.where((p.max(1) >= SURE) & (observed < 0), p.argmax(1), 0)
    out: list[tuple[int, int, int]] = []
    group: list[Word] = []
    kind = 0
    where = text.text_of(np.array([w.start for w in f.words], np.int64)).tolist()

    def close() -> None:
        if group and _shape(kind - 1, group):
            out.append((kind - 1, group[0].start, group[-1].end))
        group.clear()

    most = {3: 19, 4: 15}
    for n, w in enumerate(f.words):
        joins = group and label[n] == kind and kind in most and w.place == group[-1].place + 1 and where[n] == where[n - 1]
        joins = joins and w.core[:1] != b"+" and sum(len(x.digits) for x in group) + len(w.digits) <= most[kind]
        if not joins:
            close()
        kind = int(label[n])
        if kind:
            group.append(w)
    close()
    return out


# Training: documents drawn with their labels.


def drawn_document(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A text and the words in it that are personal data, as (kind, start, end)."""
    parts: list[tuple[str, int]] = []
    syllable = lambda: rng.choice("bcdfglmnprstv") + rng.choice("aeiou")
    plain = lambda: "".join(syllable() for _ in range(rng.randint(1, 4)))
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    say = lambda k=-1: parts.extend((plain(), k) for _ in range(rng.randint(1, 6)))

    def card(valid: bool) -> str:
        while True:
            d = digit(16)
            if luhn(d.encode()) == valid:
                return d

    def entity() -> tuple[int, list[str], list[str]]:
        """Kind, the words of a full mention, and of a shorter one that only the full one explains."""
        kind = rng.randrange(4)
        if kind == 0:
            name, host = plain() + rng.choice([".", "_", ""]) + digit(2), f"{plain()}.{rng.choice(['com', 'org', 'example.net'])}"
            return 0, [f"{name}@{host}"], [f"{name}@{plain()}"]
        if kind == 1:
            q = [str(rng.randrange(256)) for _ in range(4)]
            return 1, [".".join(q)], [".".join(q)]
        if kind == 2:
            d = card(True)
            grouped = [d[i : i + 4] for i in range(0, 16, 4)]
            return 2, rng.choice([[d], grouped, ["-".join(grouped)]]), grouped if rng.random() < 0.5 else [d]
        area, line, land = digit(3), f"{digit(3)}-{digit(4)}", "+" + digit(rng.randint(1, 2))
        full = rng.choice([[land, f"({area})", line], [f"{land}-{area}-{line}"], [land, area, line]])
        return 3, full, rng.choice([[f"({area})", line], [f"{area}-{line}"], [line]])

    def other() -> list[str]:
        """Numbers that are no personal data."""
        n = rng.randrange(12)
        return [
            [f"20{digit(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"],
            [f"{rng.randint(10, 23)}:{digit(2)}"],
            [f"v{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}"],
            [f"{rng.randint(1, 9)}.{rng.choice(['', '0.', '12'])}"],
            [f"${digit(2)}.{digit(2)}"],
            [f"#{digit(rng.randint(3, 9))}"],
            [card(False)],
            [card(False)[i : i + 4] for i in range(0, 16, 4)],
            ["".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 32, 40])))],
            [digit(rng.randint(1, 6))],
            [f"{digit(3)}-{digit(4)}"],
            [rng.choice([f"@{plain()}{digit(2)}", f"{plain()}@{digit(1)}", digit(rng.choice([8, 11, 13, 14, 20])), f"{rng.randint(256, 999)}.{digit(1)}.{digit(2)}.{digit(3)}"])],
        ][n]

    for _ in range(rng.randint(1, 4)):
        say()
        if rng.random() < 0.55:
            kind, full, short = entity()
            if rng.random() < 0.3:
                parts.append((rng.choice(list(CUES.values())[kind].split()) + rng.choice(["", ":"]), -1))
            parts.extend((w, kind) for w in full)
            # A number right before or behind hides some from the patterns.
            if rng.random() < 0.15:
                parts.append((digit(rng.choice([2, 4])), -1))
            for _ in range(rng.choice([0, 1, 2, 3])):
                say()
                parts.extend((w, kind) for w in rng.choice([full, short]))
        else:
            words = other()
            for _ in range(rng.choice([1, 1, 2])):
                parts.extend((w, -1) for w in words)
                say()
    say()
    text, spans = "", []
    for word, kind in parts:
        if text:
            text += " "
        if kind >= 0:
            spans.append((kind, len(text), len(text) + len(word)))
        text += word + ("," if rng.random() < 0.05 else "")
    return text, spans


def as_text(texts: list[str]) -> Text:
    return Text(*text_buffer(pa.array(texts, pa.string())))


@functools.lru_cache(maxsize=2)
def trained(seed: int = SEED, n: int = TRAIN_DOCS, steps: int = 400) -> Model:
    """The weights of greatest pseudo-likelihood over ``n`` drawn documents, found by gradient steps."""
    rng = random.Random(seed)
    drawn = [drawn_document(rng) for _ in range(n)]
    text = as_text([t for t, _ in drawn])
    f = field(text)
    said = sorted((k, int(text.offsets[i]) + a, int(text.offsets[i]) + b) for i, (_, spans) in enumerate(drawn) for k, a, b in spans)
    gold = np.maximum(_covered(f.words, said), 0)
    hot = np.eye(5)[gold]
    unary, pair = np.zeros((len(FEATURES), 5)), np.zeros((3, 5, 5))
    moment = [[np.zeros_like(w), np.zeros_like(w)] for w in (unary, pair)]
    for step in range(1, steps + 1):
        score = f.features @ unary
        np.add.at(score, f.right, pair[f.link, gold[f.left], :])
        np.add.at(score, f.left, pair[f.link, :, gold[f.right]])
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        miss = (p - hot) / len(gold)
        towards = np.zeros_like(pair)
        np.add.at(towards, (f.link, gold[f.left]), miss[f.right])
        back = np.zeros_like(pair)
        np.add.at(back, (f.link, gold[f.right]), miss[f.left])
        towards += back.transpose(0, 2, 1)
        # Links between distant words have no direction.
        towards[1:] = (towards[1:] + towards[1:].transpose(0, 2, 1)) / 2
        for w, g, (first, second) in zip((unary, pair), (f.features.T @ miss + 1e-4 * unary, towards + 1e-4 * pair), moment, strict=True):
            first[:] = 0.9 * first + 0.1 * g
            second[:] = 0.99 * second + 0.01 * g * g
            w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(unary, pair)


# The operator.

SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def spans_of(text: Text, model: Model) -> list[list[tuple[str, int, int, bool]]]:
    """The spans of each text in code points, by kind in order, then start."""
    base = base_spans(text)
    rows = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, base, model)]
    point = np.zeros(len(text.data) + 1, np.int64)
    np.cumsum((text.data & 0xC0) != 0x80, out=point[1:])
    out: list[list[tuple[str, int, int, bool]]] = [[] for _ in range(len(text.offsets) - 1)]
    for (kind, a, b, is_base), d in zip(sorted(rows), text.text_of(np.array([r[1] for r in sorted(rows)], np.int64)).tolist(), strict=True):
        first = point[text.offsets[d]]
        out[d].append((KINDS[kind], int(point[a] - first), int(point[b] - first), is_base))
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each text: kind, start, end (code points, end exclusive), and whether a pattern found it."""
    model = trained()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = spans_of(Text(*text_buffer(part.column("text"))), model)
                rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans] for spans in found]
                yield pa.record_batch([part.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return clean_columns(docs, "doc_id", "text").mapInArrow(find, f"doc_id long, spans {SPANS}")


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    line = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["base"])
    of = lambda kind: F.filter(base, lambda x: x["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
