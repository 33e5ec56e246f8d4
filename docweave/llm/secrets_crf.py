"""Secrets by patterns and by a linear-chain conditional random field.

Tokens are runs of the characters that secrets are made of. Each is tagged as the begin or the inside
of a secret or as outside, by its shape (length, classes, changes between letters and digits), its
neighbouring words, the characters around it and features of its document. Weights are trained by
maximum likelihood, with the forward-backward recursion, on windows of a bounded sample of documents
whose tags come from the patterns; unseen secrets are then found by shape and neighbourhood.

Tags are decoded by Viterbi over the whole text. A token whose outside score leads by more than any
neighbours' transitions could make up is outside on every best path, so the chain falls into short
runs there, and runs of all texts advance together. The result is that of one pass over the chain.

Defined results: a null or empty text has no spans. Spans of the field that touch a span of a pattern
are left to the pattern. Rows that repeat get equal spans. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.shared import Texts, mixed, slices

# The patterns and the least length of what they must match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "field")

OUTSIDE, BEGIN, INSIDE = 0, 1, 2


@dataclass(frozen=True)
class FieldOptions:
    """``sample_docs`` bounds the training sample (expected number of documents)."""

    sample_docs: int = 20_000
    window: int = 6
    rounds: int = 80
    penalty: float = 1e-4


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of all patterns by start, then kind as listed."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


_LONG_HEX = re.compile(HEX.pattern[:-1] + "{%d,}" % LEAST["hex"])


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[list(chars)] = 1
    return table


_LOWER, _UPPER = bytes(range(ord("a"), ord("z") + 1)), bytes(range(ord("A"), ord("Z") + 1))
_DIGIT, _MARK = b"0123456789", b"+/_.=-"
_OF = {"lower": _flags(_LOWER), "upper": _flags(_UPPER), "digit": _flags(_DIGIT), "mark": _flags(_MARK)}
_OF["hex"] = _flags(_DIGIT + b"abcdef")
_TOKEN = (_OF["lower"] + _OF["upper"] + _OF["digit"] + _OF["mark"]) > 0
_AROUND = np.full(256, 6)
for _k, _chars in enumerate((b"\"'", b"=", b":", b" \t", b"\n\r", b"<>{}()[]")):
    _AROUND[list(_chars)] = _k
_LENGTHS = np.array([2, 4, 8, 12, 16, 24, 32, 64])

WORDS = 4096
SHAPES = 9 * 16 * 2 * 3
TABLES = {"shape": SHAPES, "before": WORDS, "before2": WORDS, "after": WORDS, "around": 8 * 8 * 8, "file": 16}


class Tokens:
    """Tokens of a slice of texts with the index of each of their features."""

    def __init__(self, column: pa.Array):
        texts = self.texts = Texts(column)
        data, n, rows = texts.data, len(texts.data), len(column)
        inside = _TOKEN[data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        cut = texts.starts[(texts.starts > 0) & (texts.starts < n)]
        begins[cut] = inside[cut]
        stops[cut - 1] = inside[cut - 1]
        self.first, self.last = first, last = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.owner = owner = np.searchsorted(texts.ends, first, side="right")

        def total(flags: np.ndarray) -> np.ndarray:
            sums = np.zeros(n + 1, np.int32)
            np.cumsum(flags, out=sums[1:])
            return sums

        size = last - first
        count = {k: (s := total(_OF[k][data]))[last] - s[first] for k in ("lower", "upper", "digit", "mark", "hex")}
        is_digit = _OF["digit"][data]
        change = np.zeros(n, np.int32)
        change[1:] = is_digit[1:] != is_digit[:-1]
        changes = (s := total(change))[last] - s[np.minimum(first + 1, n)]
        kinds = sum((count[k] > 0) * (1 << i) for i, k in enumerate(("lower", "upper", "digit", "mark")))
        shape = np.searchsorted(_LENGTHS, size, side="right")
        shape = ((shape * 16 + kinds) * 2 + (count["hex"] == size)) * 3 + np.minimum(changes, 5) // 2

        word = (texts.word_hashes(first, last, lower=True) >> np.uint64(7)).astype(np.int64) % (WORDS - 1) + 1
        same = owner[1:] == owner[:-1]
        before, after, before2 = (np.zeros(len(word), np.int64) for _ in range(3))
        before[1:] = np.where(same, word[:-1], 0)
        after[:-1] = np.where(same, word[1:], 0)
        before2[1:] = np.where(same, before[:-1], 0)

        def beside(at: np.ndarray, ok: np.ndarray) -> np.ndarray:
            return np.where(ok, _AROUND[data[np.clip(at, 0, max(n - 1, 0))]] if n else 0, 7)

        start, end = texts.starts[owner], texts.ends[owner]
        around = beside(first - 1, first > start) * 64 + beside(first - 2, first - 1 > start) * 8 + beside(last, last < end)

        length = np.maximum(texts.ends - texts.starts, 1)
        per_text = {k: (s := total(_OF[k][data]))[texts.ends] - s[texts.starts] for k in ("digit", "mark")}
        code = (s := total(_flags(b"{}<>;=")[data]))[texts.ends] - s[texts.starts]
        file = np.minimum(per_text["digit"] * 50 // length, 3) * 4 + (code * 100 > length) * 2 + (per_text["mark"] * 20 > length)
        self.features = np.stack([shape, before, before2, after, around, file[owner]], axis=1).astype(np.int32)
        self.new_text = np.ones(len(word), bool)
        self.new_text[1:] = ~same

    def code_point(self, row: int, at: int) -> int:
        """Place of a byte in its text, in code points."""
        return int(np.count_nonzero((self.texts.data[self.texts.starts[row]:at] & 0xC0) != 0x80))


class Field:
    """Weights of a trained field: a table for each feature and the transitions."""

    def __init__(self, tables: list[np.ndarray], moves: np.ndarray):
        self.tables, self.moves = tables, moves

    @classmethod
    def blank(cls) -> Field:
        return cls([np.zeros((size, 3)) for size in TABLES.values()], np.zeros((3, 3)))

    def scores(self, features: np.ndarray) -> np.ndarray:
        return sum(table[features[..., i]] for i, table in enumerate(self.tables))

    def lead(self) -> float:
        """What transitions could at most gain by another tag than outside between any neighbours."""
        m = self.moves
        edges = np.zeros(4)
        into = {t: np.append(m[:, t], 0.0) for t in range(3)}
        out = {t: np.append(m[t], 0.0) for t in range(3)}
        edges = [
            (into[t] - into[OUTSIDE]).max() + (out[t] - out[OUTSIDE]).max() for t in (BEGIN, INSIDE)
        ]
        return float(max(edges))

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best tags of all tokens; texts do not touch."""
        tags = np.zeros(len(tokens.first), np.int8)
        if not len(tags):
            return tags
        scores = self.scores(tokens.features)
        live = scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= self.lead()
        opens = live.copy()
        opens[1:] &= ~live[:-1] | tokens.new_text[1:]
        starts = np.flatnonzero(opens)
        if not len(starts):
            return tags
        ends = live.copy()
        ends[:-1] &= ~live[1:] | tokens.new_text[1:]
        stops = np.flatnonzero(ends) + 1
        text_end = np.append(tokens.new_text[1:], True)
        order = np.argsort(stops - starts)
        for at in range(0, len(order), 4096):
            rows = order[at:at + 4096]
            self._viterbi(scores, starts[rows], stops[rows], tokens.new_text, text_end, tags)
        return tags

    def _viterbi(self, scores, starts, stops, new_text, text_end, tags) -> None:
        lengths = stops - starts
        steps, m = int(lengths.max()), len(starts)
        back = np.zeros((steps, m, 3), np.int8)
        # A run is entered from an outside token, or from the edge of its text.
        state = scores[starts] + np.where(new_text[starts][:, None], 0.0, self.moves[OUTSIDE][None])
        for t in range(1, steps):
            go = lengths > t
            reach = state[:, :, None] + self.moves[None]
            back[t] = reach.argmax(axis=1)
            moved = reach.max(axis=1) + scores[np.minimum(starts + t, len(scores) - 1)]
            state = np.where(go[:, None], moved, state)
        state = state + np.where(text_end[stops - 1][:, None], 0.0, self.moves[:, OUTSIDE][None])
        tag = state.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            go = np.flatnonzero(lengths > t)
            tags[starts[go] + t] = tag[go]
            if t:
                tag[go] = back[t, go, tag[go]]

    def gradient(self, features: np.ndarray, gold: np.ndarray, mask: np.ndarray) -> tuple[float, Field]:
        """Mean negative log-likelihood of windows (window, place, feature) and its gradient."""
        scores = self.scores(features)
        m, steps = gold.shape
        forward, backward = np.zeros((m, steps, 3)), np.zeros((m, steps, 3))

        def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        forward[:, 0] = scores[:, 0]
        for t in range(1, steps):
            step = log_sum(forward[:, t - 1][:, :, None] + self.moves[None], 1) + scores[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            step = log_sum(self.moves[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        whole = log_sum(forward[:, -1], 1)
        odds = np.exp(forward + backward - whole[:, None, None]) * mask[:, :, None]
        pair = np.zeros((3, 3))
        gold_score = -whole.sum()
        for t in range(1, steps):
            joint = np.exp(
                forward[:, t - 1][:, :, None] + self.moves[None] + (scores[:, t] + backward[:, t])[:, None, :]
                - whole[:, None, None]
            ) * mask[:, t, None, None]
            pair += joint.sum(axis=0)
            np.subtract.at(pair, (gold[:, t - 1][mask[:, t]], gold[:, t][mask[:, t]]), 1.0)
            gold_score += self.moves[gold[:, t - 1], gold[:, t]][mask[:, t]].sum()
        gold_score += np.take_along_axis(scores, gold[:, :, None], 2)[:, :, 0][mask].sum()
        np.put_along_axis(odds, gold[:, :, None], np.take_along_axis(odds, gold[:, :, None], 2) - mask[:, :, None], 2)
        flat, used = odds[mask], features[mask]
        tables = []
        for i, size in enumerate(TABLES.values()):
            table = np.zeros((size, 3))
            np.add.at(table, used[:, i], flat)
            tables.append(table / m)
        return -gold_score / m, Field(tables, pair / m)


def train(features: np.ndarray, gold: np.ndarray, mask: np.ndarray, options: FieldOptions) -> Field:
    """Weights by gradient steps with momentum and per-weight scaling, from zero; no random numbers."""
    field = Field.blank()
    weights = [*field.tables, field.moves]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, options.rounds + 1):
        if not len(gold):
            break
        _, slope = field.gradient(features, gold, mask)
        for w, g, a, b in zip(weights, [*slope.tables, slope.moves], first, second, strict=True):
            g = g + options.penalty * w
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            w -= 0.2 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-6)
    return field


def _tagged(tokens: Tokens, texts: list[str]) -> np.ndarray:
    """Tags that the patterns give: tokens inside the value of a match."""
    gold = np.zeros(len(tokens.first), np.int64)
    for row, text in enumerate(texts):
        spans = []
        if "=" in text or ":" in text:
            spans += [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
        spans += [(a, b) for a, b, kind in pattern_spans(text) if kind != "assign"]
        for a, b in spans:
            begin = tokens.texts.starts[row] + len(text[:a].encode("utf-8", "surrogatepass"))
            end = begin + len(text[a:b].encode())
            held = np.flatnonzero((tokens.first < end) & (tokens.last > begin))
            gold[held] = INSIDE
            gold[held[:1]] = BEGIN
    return gold


def training_windows(docs: DataFrame, options: FieldOptions) -> DataFrame:
    """Windows around tagged tokens, and one window by chance for each document, of a bounded sample."""
    rows = docs.count()
    share = min(1.0, options.sample_docs / max(rows, 1))
    pick = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    reach = options.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                column = batch.column("text").slice(begin, end - begin).fill_null("")
                tokens = Tokens(column)
                if not len(tokens.first):
                    continue
                gold = _tagged(tokens, column.to_pylist())
                starts = np.flatnonzero(tokens.new_text)
                sizes = np.diff(np.append(starts, len(gold)))
                chance = (mixed(tokens.texts.ends[tokens.owner[starts]].astype(np.uint64)) % sizes.astype(np.uint64)).astype(np.int64)
                centres = np.concatenate([np.flatnonzero(gold == BEGIN), starts + chance])
                features, tags = [], []
                for centre in centres.tolist():
                    low = starts[np.searchsorted(starts, centre, side="right") - 1]
                    high = np.append(starts, len(gold))[np.searchsorted(starts, centre, side="right")]
                    held = slice(max(low, centre - reach), min(high, centre + reach + 1))
                    features.append(tokens.features[held].astype("<i4").tobytes())
                    tags.append(gold[held].astype(np.int8).tobytes())
                yield pa.record_batch([pa.array(features, pa.binary()), pa.array(tags, pa.binary())], names=["features", "tags"])

    return docs.filter(pick).select("text").mapInArrow(run, "features binary, tags binary")


def fit(docs: DataFrame, options: FieldOptions = FieldOptions()) -> Field:
    """Train on the windows of the sample; what comes to the driver is bounded by ``sample_docs``."""
    rows = training_windows(docs, options).orderBy("features", "tags").collect()
    width = 2 * options.window + 1
    features = np.zeros((len(rows), width, len(TABLES)), np.int32)
    gold, mask = np.zeros((len(rows), width), np.int64), np.zeros((len(rows), width), bool)
    for i, row in enumerate(rows):
        tags = np.frombuffer(row["tags"], np.int8)
        features[i, :len(tags)] = np.frombuffer(row["features"], "<i4").reshape(-1, len(TABLES))
        gold[i, :len(tags)], mask[i, :len(tags)] = tags, True
    return train(features, gold, mask, options)


def field_spans(field: Field, tokens: Tokens, rows: int) -> list[list[tuple[int, int, str]]]:
    """Spans of tagged tokens of each text, in code points."""
    tags = field.decode(tokens)
    out: list[list[tuple[int, int, str]]] = [[] for _ in range(rows)]
    held = np.flatnonzero(tags != OUTSIDE)
    for at in held.tolist():
        row = int(tokens.owner[at])
        a, b = (tokens.code_point(row, int(x)) for x in (tokens.first[at], tokens.last[at]))
        goes_on = tags[at] == INSIDE and at > 0 and tags[at - 1] != OUTSIDE and not tokens.new_text[at]
        if goes_on and out[row]:
            out[row][-1] = (out[row][-1][0], b, "field")
        else:
            out[row].append((a, b, "field"))
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, options: FieldOptions = FieldOptions()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_field, base_sha256, spans."""
    field = fit(docs, options)
    model = docs.sparkSession.sparkContext.broadcast((field.tables, field.moves))  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = Field(*model.value)
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                column = batch.column("text").slice(begin, end - begin).fill_null("")
                texts = column.to_pylist()
                base = [pattern_spans(t) for t in texts]
                found = field_spans(trained, Tokens(column), len(texts))
                every = []
                for known, new in zip(base, found, strict=True):
                    new = [s for s in new if not any(s[0] < b and a < s[1] for a, b, _ in known)]
                    every.append(sorted(known + new, key=lambda s: (s[0], KINDS.index(s[2]))))
                yield pa.record_batch([
                    batch.column("doc_id").slice(begin, end - begin),
                    *(pa.array([sum(s[2] == kind for s in spans) for spans in every], pa.int64()) for kind in KINDS),
                    pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]),
                    pa.array([_joined(s) for s in every]),
                ], names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_field long, base_sha256 string, spans string"
    )
