"""Personal data: e-mail and IP addresses, card and phone numbers, by rules and by a sequence model that learns from them.

1. ``rule_spans``: the exact rules of each kind. Their spans always stay. They are the labels, too, but for the check sum
   of cards, which no window shows and ``plausible`` tests at the end.
2. ``fit``: a character-level bidirectional LSTM with CRF transitions (``tagger``), trained in numpy on a bounded sample
   (``TRAIN_WINDOWS`` different windows of least hash, out of all windows of all texts). In every other training window
   the labelled spans are written in another way that people use and the rules do not know (``rewritten``: numbers without
   country code, dots and other marks between groups, accented domains), so that the model finds those, too.
3. ``personal_data``: in every whole text, windows of ``WIDTH`` characters, each half over the next, lie over all places
   that a span can touch. Every window is decoded by the CRF's forward and backward sums; where windows overlap, their log
   probabilities are averaged, weighted towards the middle of a window, and one best tagging is found for all the windows
   that touch. Its spans are added if they overlap no span of the rules, their mean probability is ``SURE`` or more,
   and what they hold can be of their kind (``plausible``).

A span of any kind holds a digit or an @, so that text farther than ``MARGIN`` characters from any has none and no
windows; nothing else is left out. Null and empty texts have no spans. Texts of any length are read whole, in linear time.
Repeated rows are treated alike; rows without an id, too. Without labelled spans there is no model, and the spans are
those of the rules. An empty table gives no rows. Other columns are left behind, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import texts
from xoutcome.llm.tagger import Tagger, best_tags

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE, MARGIN = 64, 32, 28
TRAIN_WINDOWS = 4_000
STEPS = 400
UNITS = 16
SURE = 0.9
GROUP = 2_048  # windows that are decoded at a time

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile("[0-9@]+")

Span = tuple[int, int, int]  # kind, start, end


# ---- rules ----

def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern would match, but from the @ backwards: long runs without an @ cost nothing."""
    out, end = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            out.append((start, end))
    return out


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def rule_spans(text: str, summed: bool = True) -> list[Span]:
    """All spans of the rules, by kind and start, in code points; ``summed=False`` leaves the cards' check sum out."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    out += [(2, *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and (not summed or luhn(d))]
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def plausible(kind: int, text: str) -> bool:
    """Whether a span that the model found can be of its kind."""
    digits = _digits(text)
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@.]+(?:\.[^\s@.]+)+", text))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and _is_ip(".".join(parts))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


# ---- windows ----

def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text around its digits and @ signs, joined where they touch."""
    out: list[tuple[int, int]] = []
    for m in _MARK.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def window_starts(a: int, b: int) -> list[int]:
    """Windows over a stretch, each half over the next; the last reaches its end."""
    return list(range(a, max(a + 1, b - STRIDE), STRIDE))


#: 1 digit, 2 and 3 small and capital ASCII letters, 4 all beyond ASCII, then the other ASCII characters one by one.
_CLASS = np.zeros(128, np.uint8)
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 1, 2, 3
_REST = np.flatnonzero(_CLASS == 0)
_CLASS[_REST] = np.arange(5, 5 + len(_REST))
CLASSES = 5 + len(_REST)


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(codes < 128, _CLASS[np.minimum(codes, 127)], 4).astype(np.uint8)


def _padded(part: np.ndarray, fill: int = 0) -> np.ndarray:
    out = np.full(WIDTH, fill, part.dtype)
    out[:len(part)] = part
    return out


def tags_of(spans: list[Span], a: int, b: int) -> np.ndarray:
    """Tags of the characters a to b; of overlapping spans the first kind is told."""
    out = np.zeros(b - a, np.uint8)
    for kind, s, e in reversed(spans):
        if s < b and e > a:
            out[max(s, a) - a:e - a] = 2 + 2 * kind
            if s >= a:
                out[s - a] = 1 + 2 * kind
    return out


# ---- learning ----

def rewritten(kind: int, text: str, draw: np.random.Generator) -> str:
    """The same datum written as the rules don't expect it."""
    if kind == 0:
        local, _, domain = text.partition("@")
        at = int(draw.integers(0, domain.index(".") + 1))
        return local + "@" + domain[:at] + str(draw.choice(list("éüñöçå"))) + domain[at:]
    if kind == 1:
        return text.replace(".", "[.]") if draw.random() < 0.5 else ".".join(f" {p}" if i else p for i, p in enumerate(text.split(".")))
    digits = _digits(text)
    if kind == 2:
        mark = str(draw.choice([".", " - ", "_", "/"]))
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    own = digits[-10:]
    mark = str(draw.choice(["-", ".", " ", "/"]))
    area = f"({own[:-7]}) " if draw.random() < 0.5 else own[:-7] + mark
    return ("00" + digits[:-10] + mark if digits[:-10] and draw.random() < 0.3 else "") + area + own[-7:-4] + mark + own[-4:]


def _examples(rows: list[tuple[str, bytes]], seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags of the windows, in every other one with the spans written anew."""
    draw = np.random.default_rng(seed)
    xs, ys = [], []
    for k, (text, tags) in enumerate(rows):
        tag = np.frombuffer(tags, np.uint8)
        if k % 2 and tag.any():
            cut = np.flatnonzero(np.concatenate([[True], (tag[1:] % 2 == 1) | ((tag[1:] == 0) != (tag[:-1] == 0)), [True]]))
            parts, new = [], []
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                piece, one = text[a:b], int(tag[a])
                whole = one % 2 == 1 and b < len(text)
                if whole:
                    piece = rewritten((one - 1) // 2, piece, draw)
                own = np.full(len(piece), one + (one % 2), np.uint8)
                if one % 2:
                    own[0] = one
                parts.append(piece)
                new.append(own)
            text, tag = "".join(parts)[:WIDTH], np.concatenate(new)[:WIDTH]
        xs.append(_padded(classes(text)))
        ys.append(_padded(tag))
    return np.array(xs), np.array(ys)


def training_windows(docs: DataFrame, windows: int = TRAIN_WINDOWS) -> list[tuple[str, bytes]]:
    """(text, tags) of at most ``windows`` different windows, those of least hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                parts = stretches(text)
                if parts:
                    spans = rule_spans(text, summed=False)
                    for a, b in parts:
                        for s in window_starts(a, b):
                            e = min(s + WIDTH, len(text))
                            near = [x for x in spans if x[1] < e and x[2] > s]
                            found.append((text[s:e], tags_of(near, s, e).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())], names=["text", "tags"])
    rows = docs.mapInArrow(run, "text string, tags binary").dropDuplicates(["text", "tags"])
    return [(r["text"], bytes(r["tags"])) for r in rows.orderBy(F.xxhash64("text", "tags"), "text", "tags").limit(windows).collect()]


def fit(docs: DataFrame, windows: int = TRAIN_WINDOWS, steps: int = STEPS) -> Tagger | None:
    """A model learned from the rules' spans in ``docs`` (doc_id, text); None where they find none."""
    rows = training_windows(docs, windows)
    if not any(any(tags) for _, tags in rows):
        return None
    model = Tagger(CLASSES, len(KINDS), UNITS)
    model.train(*_examples(rows), steps=steps)
    return model.as_type(np.float32)


# ---- decoding ----

_WEIGHT = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(float)


def found_spans(parts: list[tuple[str, int, int]], model: Tagger) -> list[list[tuple[int, int, int, float]]]:
    """(kind, start, end, probability) of what the model sees in each (text, start, end) stretch."""
    windows = [(k, s) for k, (_, a, b) in enumerate(parts) for s in window_starts(a, b)]
    tags = 1 + 2 * len(KINDS)
    sums = [np.zeros((b - a, tags)) for _, a, b in parts]
    weights = [np.zeros((b - a, 1)) for _, a, b in parts]
    coded = [classes(text[a:b]) for text, a, b in parts]
    for at in range(0, len(windows), GROUP):
        own = windows[at:at + GROUP]
        rows = np.array([_padded(coded[k][s - parts[k][1]:s - parts[k][1] + WIDTH]) for k, s in own])
        for (k, s), log_p in zip(own, model.log_marginals(rows)):
            a = s - parts[k][1]
            b = min(a + WIDTH, len(coded[k]))
            sums[k][a:b] += log_p[:b - a] * _WEIGHT[:b - a, None]
            weights[k][a:b] += _WEIGHT[:b - a, None]
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in parts]
    order = sorted(range(len(parts)), key=lambda k: len(coded[k]))
    for at in range(0, len(order), 256):
        own = order[at:at + 256]
        length = len(coded[own[-1]])
        scores = np.full((len(own), length, tags), -1e6)
        scores[:, :, 0] = 0
        for i, k in enumerate(own):
            mean = sums[k] / weights[k]
            scores[i, :len(mean)] = mean - np.log(np.exp(mean).sum(axis=1, keepdims=True))
        for k, tagged, mean in zip(own, best_tags(scores, model.rule), scores):
            tagged = tagged[:len(coded[k])]
            for s in np.flatnonzero(tagged % 2 == 1).tolist():
                e = s + 1
                while e < len(tagged) and tagged[e] == tagged[s] + 1:
                    e += 1
                sure = float(np.exp(mean[np.arange(s, e), tagged[s:e]]).mean())
                out[k].append(((int(tagged[s]) - 1) // 2, parts[k][1] + s, parts[k][1] + e, sure))
    return out


def spans_of(texts_: list[str], model: Tagger | None, sure: float = SURE) -> list[tuple[list[Span], list[tuple[int, int, int, float]]]]:
    """The rules' spans and those that the model adds, for each text."""
    base = [rule_spans(t) if _MARK.search(t) else [] for t in texts_]
    added: list[list[tuple[int, int, int, float]]] = [[] for _ in texts_]
    if model is not None:
        places = [(i, (t, a, b)) for i, t in enumerate(texts_) for a, b in stretches(t)]
        for at in range(0, len(places), GROUP):
            own = places[at:at + GROUP]
            for (i, (text, _, _)), found in zip(own, found_spans([p for _, p in own], model)):
                for kind, s, e, p in found:
                    if p >= sure and plausible(kind, text[s:e]) and all(e <= x or s >= y for _, x, y in base[i]):
                        added[i].append((kind, s, e, p))
    return list(zip(base, added))


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("by_rule", pa.bool_()), ("probability", pa.float64())]))


def personal_data(df: DataFrame, model: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; spans by kind and start, in code points, with the end exclusive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, added in spans_of(batch.column(1).to_pylist(), model):
                every = sorted([(*s, True, 1.0) for s in base] + [(k, s, e, False, p) for k, s, e, p in added])
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "by_rule": r, "probability": p} for k, s, e, r, p in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _FOUND)], names=["doc_id", "spans"])
    return texts(df, id_col, text_col).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long, by_rule: boolean, probability: double>>")


def digests(df: DataFrame) -> DataFrame:
    """The registered query: numbers of the rules' spans, their digest, and all spans as kind:start:end."""
    found = personal_data(df, fit(texts(df)))
    base = F.filter("spans", lambda s: s["by_rule"])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[of(k) for k in KINDS],
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def hexdigest(spans: list[Span]) -> str:
    """The digest of a text's spans as the registered query writes it."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
