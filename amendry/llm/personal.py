"""Personal data by candidates, boosted trees and calibrated thresholds.

Base rules find what is certain: e-mail and network addresses, card numbers with a right
check digit, international phone numbers. They miss what stands in another spelling or
touches a further number. So generators propose spans freely, and they overlap: every
stretch of up to a few neighbouring numbers, addresses spelt out or with marks put in.
Boosted trees score each candidate by its format and its surroundings, and per kind the
threshold is the lowest one that keeps the wanted precision on documents not learnt from.

The trees learn from what the base rules find in a bounded sample of documents: these
spans, the same ones respelt or put side by side, other cuts of them, and broken ones.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amendry.llm.rows import add_columns
from amendry.sources.workspace import Workspace

# fixed values: the kinds, in the order in which equal starts are listed, and the base rules
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE = 40_000  # documents to learn from, about
EXAMPLES = 60_000  # candidates to learn from, about
PRECISION = 0.99  # on the documents that thresholds are set by
AROUND = 40  # code points looked at on either side
MOST = 6  # neighbouring numbers that may make up one candidate

Span = tuple[int, int, int]  # start, kind, end

# ---- base rules


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) << (k & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, longest local parts; no letter is looked at twice, however long a word is."""
    done, at = 0, text.find("@")
    while at >= 0:
        run = text[done:at]
        local = len(run) - len(run.rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", max(done, at + 1))


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and passes_luhn(digits)


def is_ip(text: str) -> bool:
    values = [p.lstrip("0") or "0" for p in re.findall("[0-9]+", text)]
    return all(len(v) <= 3 and int(v) <= 255 for v in values)


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by start and then kind."""
    found = [(a, EMAIL, b) for a, b in _emails(text)]
    found += [(m.start(), IP, m.end()) for m in _IP.finditer(text) if is_ip(m[0])]
    found += [(m.start(), CARD, m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 12 and is_card(m[0])]
    found += [(m.start(), PHONE, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


# ---- candidates

_RUN = re.compile(r"[0-9][0-9\x20().-]{5,}[0-9]")
_NUMBER = re.compile(r"[^\x20]+")
_MARKED_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\{\.\}|\[dot\]|\(dot\))\x20?[0-9]{1,3}){3}(?![0-9])")
_IP_MARKS = ("[.]", "(.)", "{.}", "[dot]", "(dot)")
_CLOSED_AT = re.compile(r"[\[({]\x20?(?:at|@)\x20?[\])}]", re.I)
_SPACED_AT = re.compile(r"\x20@\x20?|@\x20")
_SPELT_AT = re.compile(r"\x20at\x20(?=[a-z0-9-]{1,63}\x20dot\x20)", re.I)
_SPELT_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63})+", re.I
)


def _numbers(text: str) -> Iterator[Span]:
    """Every stretch of up to MOST neighbouring numbers with the digits of a phone or card number."""
    for run in _RUN.finditer(text):
        begin = run.start()
        while begin and text[begin - 1] in "+(" and run.start() - begin < 2:
            begin -= 1
        parts = [(m.start() + begin, m.end() + begin) for m in _NUMBER.finditer(text[begin : run.end()])]
        digits = [sum(c in "0123456789" for c in text[a:b]) for a, b in parts]
        for i, (start, first) in enumerate(parts):
            while start < first and text[start] in ").-":
                start += 1
            if start == first or start and text[start - 1].isalnum():
                continue
            total = 0
            for (_, end), n in zip(parts[i : i + MOST], digits[i : i + MOST]):
                total += n
                while end > start and text[end - 1] in "(.-":
                    end -= 1
                if total > 19:
                    break
                if end < len(text) and text[end].isalnum():
                    continue
                if 7 <= total <= 15:
                    yield start, PHONE, end
                if 12 <= total:
                    yield start, CARD, end


def _at_marks(text: str) -> Iterator[tuple[int, int]]:
    """Where something stands for the sign between the two sides of an e-mail address, with a space on either side."""
    if "[" in text or "(" in text or "{" in text:
        for m in _CLOSED_AT.finditer(text):
            yield m.start() - (text[m.start() - 1 : m.start()] == " "), m.end() + (text[m.end() : m.end() + 1] == " ")
    if "@" in text:
        yield from (m.span() for m in _SPACED_AT.finditer(text))
    if " dot " in text or " DOT " in text:
        yield from (m.span() for m in _SPELT_AT.finditer(text))


def candidates(text: str) -> list[Span]:
    """All that may be personal data; spans overlap and most are not."""
    found = set(_numbers(text))
    if any(m in text for m in _IP_MARKS):
        found |= {(m.start(), IP, m.end()) for m in _MARKED_IP.finditer(text)}
    for start, end in _at_marks(text):
        run = text[max(0, start - 64) : start]
        local = len(run) - len(run.rstrip(LOCAL))
        domain = _SPELT_DOMAIN.match(text, end) if local else None
        if domain:
            found.add((start - local, EMAIL, domain.end()))
    return sorted(found)


# ---- features

# fixed values: words that stand near such data, or near other numbers
_NEAR = [
    re.compile(p, re.I)
    for p in (
        r"\b(?:tel|phone|telephone|call|fax|mobile|cell|dial|whatsapp|telefon|tél|teléfono)\b",
        r"\b(?:card|visa|mastercard|amex|credit|debit|payment|pay|karte|carte|tarjeta)\b",
        r"\b(?:ip|host|server|address|addr|client|login|adresse)\b",
        r"\b(?:mail|email|e-mail|contact|write|reach|kontakt|correo)\b",
        r"\b(?:isbn|issn|order|version|invoice|page|date|ref|no|id|total|price|population|year)\b",
    )
]
# fixed values: usual last labels of addresses
_LAST = frozenset("com org net edu gov info biz io co uk de fr es it nl be ch at eu us ca au jp in br pl se no dk fi pt".split())
_SIDES = 4


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isdigit() else 2 if c.isalpha() else 3


def features(text: str, span: Span) -> list[float]:
    """Format of a candidate and what stands around it."""
    start, kind, end = span
    own = text[start:end]
    digits = _digits(own)
    groups = [len(g) for g in re.findall("[0-9]+", own)] or [0]
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    ahead, behind = before.rstrip(), after.lstrip()
    sides = [0.0] * (2 * _SIDES)
    sides[_side(before[-1:])] = sides[_SIDES + _side(after[:1])] = 1.0
    labels = re.split(r"[^A-Za-z0-9-]+", own)
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        len(digits), len(own), len(groups), max(groups), min(groups), groups[0], groups[-1],
        *[own.count(c) for c in " -.()+@["],
        own[:1] == "+", own[:1] == "(", own.count("(") == own.count(")"),
        12 <= len(digits) <= 19 and passes_luhn(digits),
        len(groups) == 4 and max(groups) <= 3 and is_ip(own),
        int(digits[:1] or 0), digits[:2] == "00", len(set(digits)),
        len(labels), len(labels[-1]), sum(c.isalpha() for c in own), labels[-1].lower() in _LAST,
        *sides,
        ahead[-1:].isdigit(), ahead[-1:] == "+", behind[:1].isdigit(), behind[:1] in ("+", "("),
        *[bool(p.search(before)) for p in _NEAR],
    ]


WIDTH = len(features("", (0, 0, 0)))

# ---- boosted trees

DEPTH, ROUNDS, RATE, BINS = 4, 40, 0.3, 32


@dataclass
class Trees:
    """Full binary trees: at node k, values above cut[k] of feature[k] go to 2k + 2, others to 2k + 1."""

    feature: np.ndarray  # rounds x inner nodes
    cut: np.ndarray
    value: np.ndarray  # rounds x leaves
    thresholds: np.ndarray  # score that a candidate of each kind must reach

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows, inner = np.zeros(len(x)), np.arange(len(x)), self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees that follow the gradient of the logistic loss, split where it falls most; leaves take Newton's step."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    width = BINS + 1
    inner, total = 2**DEPTH - 1, np.zeros(len(x))
    found = [np.zeros((ROUNDS, inner), np.int64), np.full((ROUNDS, inner), np.inf), np.zeros((ROUNDS, 2**DEPTH))]
    for turn in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for depth in range(DEPTH):
            first, many = 2**depth - 1, 2**depth
            best = np.full(many, 1e-9)
            choice = np.zeros((many, 2), np.int64) - 1
            for f in range(x.shape[1]):
                cell = (node - first) * width + binned[:, f]
                g = np.cumsum(np.bincount(cell, slope, many * width).reshape(many, width), axis=1)
                h = np.cumsum(np.bincount(cell, bend, many * width).reshape(many, width), axis=1)
                rest_g, rest_h = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + 1) + rest_g**2 / (rest_h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(h < 1) | (rest_h < 1)] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(many), at] > best
                best[better] = gain[np.arange(many), at][better]
                choice[better] = np.stack([np.full(many, f), at], axis=1)[better]
            for k in np.flatnonzero(choice[:, 0] >= 0).tolist():
                f, at = choice[k].tolist()
                if at < len(edges[f]):
                    found[0][turn, first + k], found[1][turn, first + k] = f, edges[f][at]
            node = 2 * node + 1 + (x[np.arange(len(x)), found[0][turn, node]] > found[1][turn, node])
        g, h = np.bincount(node - inner, slope, 2**DEPTH), np.bincount(node - inner, bend, 2**DEPTH)
        found[2][turn] = RATE * g / (h + 1)
        total += found[2][turn, node - inner]
    return Trees(*found, np.full(len(KINDS), np.inf))


def calibrated(trees: Trees, x: np.ndarray, y: np.ndarray, precision: float) -> np.ndarray:
    """Per kind, the lowest score such that of all candidates reaching it, `precision` are right; infinite if none is."""
    scores, thresholds = trees.score(x), np.full(len(KINDS), np.inf)
    for kind in range(len(KINDS)):
        own = x[:, kind] > 0
        values, first = np.unique(-scores[own], return_inverse=True)
        if not len(values):
            continue
        right = np.cumsum(np.bincount(first, y[own]))
        every = np.cumsum(np.bincount(first))
        good = np.flatnonzero((right >= precision * every) & (right > 0))
        if len(good):
            last = good[-1]  # half-way to the next score below
            thresholds[kind] = -values[last] if last + 1 == len(values) else -(values[last] + values[last + 1]) / 2
    return thresholds


# ---- examples


def _valid_card(draw: random.Random) -> str:
    digits = f"{draw.choice('3456')}{draw.randrange(10**14):014d}"
    return next(digits + c for c in "0123456789" if passes_luhn(digits + c))


def _phone(draw: random.Random) -> str:
    a, b, c = draw.randrange(200, 999), draw.randrange(200, 999), draw.randrange(10**4)
    return draw.choice((f"+1 ({a}) {b}-{c:04d}", f"+{draw.randrange(20, 99)} {a} {b}{c:04d}", f"+1-{a}-{b}-{c:04d}"))


def _respelt(kind: int, own: str, draw: random.Random) -> Iterator[tuple[str, list[tuple[int, str]]]]:
    """Texts to put in place of a base span, and the (kind, text) parts of each that are personal data."""
    other = _valid_card(draw) if kind != CARD else _phone(draw)
    other_kind = CARD if kind != CARD else PHONE
    for first, second in (((kind, own), (other_kind, other)), ((other_kind, other), (kind, own))):
        yield f"{first[1]} {second[1]}", [first, second]
    digits = _digits(own)
    if kind == CARD and len(digits) == 16:
        for mark in ".-  ":
            spelt = (mark or " ").join(digits[k : k + 4] for k in range(0, 16, 4))
            yield spelt, [(CARD, spelt)]
        at = draw.randrange(16)
        wrong = digits[:at] + str((int(digits[at]) + draw.randrange(1, 9)) % 10) + digits[at + 1 :]
        if not passes_luhn(wrong):
            yield wrong, []
            yield " ".join(wrong[k : k + 4] for k in range(0, 16, 4)), []
    if kind == PHONE and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        for spelt in (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits[:-10]} {a} {b} {c}"):
            yield spelt, [(PHONE, spelt)]
        yield f"{a}{b}", []
        yield f"{b}-{a} {c[:2]}", []
    if kind == IP:
        parts = own.split(".")
        for mark in ("[.]", "(.)", "[dot]"):
            yield mark.join(parts), [(IP, mark.join(parts))]
        yield "[.]".join([*parts[:3], str(draw.randrange(256, 999))]), []
    if kind == EMAIL:
        local, _, domain = own.partition("@")
        for at, dot in ((" [at] ", " [dot] "), ("(at)", "(dot)"), (" @ ", "."), (" at ", " dot "), (" (at) ", ".")):
            spelt = local + at + domain.replace(".", dot)
            yield spelt, [(EMAIL, spelt)]
    # other numbers
    n = draw.randrange
    yield f"{n(1900, 2030)}-{n(1, 13):02d}-{n(1, 29):02d} {n(24):02d}.{n(60):02d}", []
    yield f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2030)} {n(1, 29)}.{n(1, 13)}.{n(1900, 2030)}", []
    yield f"{n(1, 999)}.{n(1000):03d}.{n(1000):03d}", []
    yield f"{n(10**7, 10**12)}", []
    yield f"{n(100)}.{n(10**7, 10**14)}", []
    yield f"97{n(8, 10)}-{n(1, 10)}-{n(10, 1000)}-{n(10**4, 10**6)}-{n(10)}", []
    words = ["".join(draw.choice("abcdefghinorstu") for _ in range(n(2, 8))) for _ in range(3)]
    yield f"{words[0]} at {words[1]} dot {words[2]}", []
    yield " ".join(str(n(1, 10**4)) for _ in range(n(3, 9))), []


def examples(text: str) -> list[tuple[list[float], bool]]:
    """Candidates of a text, as they are and respelt, and whether they are personal data.

    A candidate that no base span overlaps may be either and teaches nothing.
    """
    base, found = base_spans(text), []
    by_start = set(base)
    for span in candidates(text):
        if any(s < span[2] and span[0] < e for s, _, e in base):
            found.append((features(text, span), span in by_start))
    for start, kind, end in base:
        own = text[start:end]
        around = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        if around[0][-1:].isalnum() or around[1][:1].isalnum():
            continue  # by chance, inside a word
        found.append((features(text, (start, kind, end)), True))
        for spelt, parts in _respelt(kind, own, random.Random(zlib.crc32(own.encode()))):
            made, true, at = around[0] + spelt + around[1], set(), 0
            for k, part in parts:
                at = spelt.index(part, at)
                true.add((len(around[0]) + at, k, len(around[0]) + at + len(part)))
                at += len(part)
            edges = len(around[0]), len(around[0]) + len(spelt)
            own_spans = {s for s in candidates(made) if s[0] < edges[1] and edges[0] < s[2]} | true
            found += [(features(made, s), s in true) for s in sorted(own_spans)]
    return found


# ---- Spark

SPAN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("turn", T.IntegerType()), T.StructField("end", T.LongType()),
     T.StructField("base", T.BooleanType())]
)
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("turn", pa.int32()), ("end", pa.int64()), ("base", pa.bool_())]))


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def _learnt(batches):
    for batch in batches:
        for k, raw in zip(batch.column("_key").to_pylist(), batch.column("_text").cast(pa.binary())):
            rows = examples(_text(raw.as_py()))
            for at in range(0, len(rows), 1024):
                part = rows[at : at + 1024]
                columns = [pa.array([k] * len(part), pa.int64()), pa.array([r[0] for r in part], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([bool(r[1]) for r in part])], names=["key", "x", "y"])


def fit(df: DataFrame, text: str = "text", sample: int = SAMPLE, most: int = EXAMPLES, precision: float = PRECISION) -> Trees | None:
    """Learns from about `sample` distinct texts, chosen by a hash of the text, and of these from about `most` candidates.

    A fifth of the texts is kept from learning and sets the thresholds. None if the base
    rules find nothing to learn from. Equal texts teach once.
    """
    total = df.count()
    docs = df.select(F.col(f"`{text}`").alias("_text"), F.xxhash64(F.col(f"`{text}`")).alias("_key")).filter("_text is not null")
    if total > sample:
        docs = docs.filter(F.pmod("_key", F.lit(1 << 30)) < int((1 << 30) * sample / total))
    docs = docs.groupBy("_key").agg(F.min("_text").alias("_text"))
    width = df.sparkSession.sparkContext.defaultParallelism
    found = docs.repartition(4 * width, "_key").mapInArrow(_learnt, "key long, x array<double>, y boolean").distinct()
    found = Workspace(df.sparkSession).stage(found, "examples")
    many = found.count()
    if many > most:
        found = found.filter(F.pmod(F.xxhash64("key", "x", "y"), F.lit(1 << 30)) < int((1 << 30) * most / many))
    rows = found.toPandas()
    if not rows["y"].any():
        return None
    rows["x"] = rows["x"].map(tuple)
    rows = rows.sort_values(["key", "x", "y"], ignore_index=True)
    x, y = np.array(rows["x"].tolist(), np.float64), rows["y"].to_numpy(np.float64)
    aside = rows["key"].to_numpy() % 5 == 0
    if aside.all() or not aside.any() or not y[~aside].any():
        aside = np.zeros(len(rows), bool)
    trees = boost(x[~aside], y[~aside])
    trees.thresholds = calibrated(trees, x[aside], y[aside], precision) if aside.any() else trees.thresholds
    return trees


def chosen(covered: bytearray, spans: list[Span], scores: np.ndarray) -> list[Span]:
    """The best spans first, without those that meet what is covered already or a better one."""
    picked = []
    for k in np.lexsort((np.arange(len(spans)), -scores)).tolist():
        start, _, end = spans[k]
        if covered.find(1, start, end) < 0:
            covered[start:end] = b"\1" * (end - start)
            picked.append(spans[k])
    return picked


def found_spans(text: str, model: Trees | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and those that the model adds, which overlap neither base spans nor each other."""
    base = base_spans(text)
    if model is None:
        return base, []
    covered = bytearray(len(text))
    for start, _, end in base:
        covered[start:end] = b"\1" * (end - start)
    free = [s for s in candidates(text) if covered.find(1, s[0], s[2]) < 0]
    good, scores = [], []
    for at in range(0, len(free), 4096):
        part = free[at : at + 4096]
        for span, score in zip(part, model.score(np.array([features(text, s) for s in part], np.float64)).tolist()):
            if score >= model.thresholds[span[1]]:
                good.append(span)
                scores.append(score)
    return base, chosen(covered, good, np.array(scores))


def add_spans(df: DataFrame, model: Trees | None, text: str = "text", name: str = "spans") -> DataFrame:
    """df + `name`: array of (start, turn, end, base), by start, then by kind; turn is the kind's place in KINDS.

    Positions are code points, ends exclusive. Base spans are all there and marked; of the
    others, none overlaps a base span or another one. A null or empty text has no spans,
    equal texts have equal spans, a text of any length is read whole, all rows and other
    columns stay, and a column of df named `name` is replaced. Without a model there are
    base spans only.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts):
        found = []
        for raw in texts.cast(pa.binary()):
            base, more = found_spans(_text(raw.as_py()), sent.value)
            found.append(sorted([(*s, True) for s in base] + [(*s, False) for s in more]))
        return [pa.array([[dict(zip(SPAN.names, s)) for s in row] for row in found], _ARROW)]

    return add_columns(df, [text], [T.StructField(name, T.ArrayType(SPAN))], compute)


def listed(spans: Column, base: bool = False) -> Column:
    """Spans as text: kind:start:end, joined by commas; only those of the base rules if asked for."""
    names = F.array(*[F.lit(k) for k in KINDS])
    own = F.filter(spans, lambda s: s["base"]) if base else spans
    one = lambda s: F.concat_ws(":", F.element_at(names, s["turn"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(own, one), ",")


def count_of(spans: Column, kind: int) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter(spans, lambda s: (s["turn"] == kind) & s["base"])).cast("long")
