"""Repair of damaged conversations by a dynamic program over a grammar.

Every row of a conversation becomes one of nine symbols: who speaks (``s``, ``u``, ``a`` or other) and
whether it is sound, truncated, or must go. Conversations share few distinct sequences of symbols;
Re-Pair names their most frequent neighbours by rules, found by counts over all sequences. A symbol has
a transfer matrix over the four states of ``(s?(ua)+)?``: the least cost from state to state, and the
audit of the edits as a rope of the parts it was made of. The matrix of a rule is the min-plus product of
its two sides, computed once, bottom-up, and shared by all conversations. Of equal costs the least audit
counts; audits of one entry and one cost are never prefixes of each other (the letters fix the cost but
for inserts), so the order holds under concatenation and the products are exact.

Rows are ordered by a range sort, so a long conversation is cut into pieces in several tasks. A piece has
a whole matrix, and pieces are folded in order, four audits at a time. Copies of a row travel as one row
with a count. The digest of a repaired conversation is a SHA-256 of its rows in order, which no two tasks
can share: rows stream through the task of their conversation and are not held. Rules are bounded
by ``RULES`` on the driver; a sequence without rules is multiplied symbol by symbol.

Defined results: null ``role`` and ``text`` are one space, and so are null ``conv_id`` and ``turn`` in the
damage key; rows without ``conv_id`` are one conversation. Rows of one turn are ordered by role, then by
digest of role and text, so repeated rows are adjacent. A role is kept only if it begins with s, u
or a where that may stand. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.shared import parked, unparked

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
STATES = range(4)  # nothing said; after s; after u; after a
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_SAID = {**dict.fromkeys((0, 1, 3), (2, "user")), 2: (3, "assistant")}  # what an insert or a new role says
# Symbols: must go; sound and truncated rows of each speaker.
SYMBOLS = "d" + "suax" + "SUAX"
RULES = 4_096
ROUNDS = 12
PIECE_ROWS = 1 << 14


class Rope:
    """A text as the concatenation of two others, with its length and hash."""

    __slots__ = ("left", "right", "size", "mark", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.mark = len(text), _mark(text)
        else:
            self.size = left.size + right.size
            self.mark = (left.mark * pow(_BASE, right.size, _MODULUS) + right.mark) % _MODULUS

    def __str__(self) -> str:
        return "".join(self.leaves())

    def leaves(self) -> Iterator[str]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.left is None:
                yield node.text
            else:
                stack += [node.right, node.left]

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        if self.size + other.size <= 64:
            return Rope(f"{self}{other}")
        return Rope(left=self, right=other)


_BASE, _MODULUS = 911_382_323, (1 << 61) - 1


def _mark(text: str) -> int:
    mark = 0
    for c in text.encode():
        mark = (mark * _BASE + c) % _MODULUS
    return mark


def before(x: Rope, y: Rope) -> bool:
    """Whether ``x`` is less than ``y``. Equal parts at equal places are passed by their hashes."""
    ours, theirs = [x], [y]
    while ours and theirs:
        a, b = ours.pop(), theirs.pop()
        if a.size == b.size and a.mark == b.mark:
            continue
        if a.left is None and b.left is None:
            n = min(a.size, b.size)
            if a.text[:n] != b.text[:n]:
                return a.text < b.text
            if a.size > n:
                ours.append(Rope(a.text[n:]))
            if b.size > n:
                theirs.append(Rope(b.text[n:]))
        elif b.left is None or (a.left is not None and a.size >= b.size):
            ours += [a.right, a.left]
            theirs.append(b)
        else:
            ours.append(a)
            theirs += [b.right, b.left]
    return not ours and bool(theirs)


Entry = tuple[int, Rope]
Row = tuple[Entry | None, ...]


def _lesser(x: Entry | None, y: Entry) -> Entry:
    if x is None or y[0] < x[0] or (y[0] == x[0] and before(y[1], x[1])):
        return y
    return x


def applied(row: Row, matrix: tuple[Row, ...]) -> Row:
    """Min-plus product of a row of entries with a matrix."""
    found: list[Entry | None] = [None] * len(STATES)
    for entry, steps in zip(row, matrix, strict=True):
        if entry is None:
            continue
        for state, step in enumerate(steps):
            if step is None:
                continue
            cost, old = entry[0] + step[0], found[state]
            if old is None or cost <= old[0]:
                found[state] = _lesser(old, (cost, entry[1] + step[1]))
    return tuple(found)


def product(left: tuple[Row, ...], right: tuple[Row, ...]) -> tuple[Row, ...]:
    return tuple(applied(row, right) for row in left)


def _entries(steps: dict[tuple[int, int], list[tuple[int, str]]]) -> tuple[Row, ...]:
    def least(at: tuple[int, int]) -> Entry | None:
        return (lambda best: (best[0], Rope(best[1])))(min(steps[at])) if at in steps else None

    return tuple(tuple(least((i, j)) for j in STATES) for i in STATES)


def _inserts() -> tuple[Row, ...]:
    """Inserts before a row or at the end: none, or as many as lead to another state."""
    steps: dict[tuple[int, int], list[tuple[int, str]]] = {(i, i): [(0, "")] for i in STATES}
    for begin in STATES:
        state = begin
        for n in (1, 2, 3):
            state = _SAID[state][0]
            steps.setdefault((begin, state), []).append((INSERT * n, "I" * n))
    return _entries(steps)


def _edits(symbol: str) -> tuple[Row, ...]:
    steps: dict[tuple[int, int], list[tuple[int, str]]] = {(i, i): [(DELETE, "D")] for i in STATES}
    if symbol != "d":
        extra = TRUNCATED if symbol.isupper() else 0
        for i, j in _NEXT.get(symbol.lower(), {}).items():
            steps.setdefault((i, j), []).append((KEEP + extra, "K"))
        for i in STATES:
            steps.setdefault((i, _SAID[i][0]), []).append((REROLE + extra, "R"))
    return _entries(steps)


INSERTS = _inserts()
MATRICES = {number: product(INSERTS, _edits(symbol)) for number, symbol in enumerate(SYMBOLS)}
START: Row = ((0, Rope()), None, None, None)


def closed(row: Row) -> Entry:
    """The least entry that ends as ``(s?(ua)+)?``, inserts at the end included."""
    ends = applied(row, INSERTS)
    best = None
    for state in (0, 3):
        if ends[state] is not None:
            best = _lesser(best, ends[state])
    return best


# Re-Pair


def _replaced(values: np.ndarray, cuts: np.ndarray, rules: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences (``values`` cut at ``cuts``) with the rules (left, right, name) of one round applied.

    No name of a round is a left side and a right side at once, so only ``xx`` can overlap.
    """
    if len(values) < 2 or not rules:
        return values, cuts
    left, right, name = (np.array(c, np.int64) for c in zip(*rules, strict=True))
    order = np.argsort(left << 32 | right)
    keys, name = (left << 32 | right)[order], name[order]
    pair = values[:-1] << 32 | values[1:]
    at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
    hit = keys[at] == pair
    hit[cuts[1:-1][(cuts[1:-1] > 0) & (cuts[1:-1] < len(values))] - 1] = False
    # In a run of one symbol every second place begins a pair.
    same = hit & (values[:-1] == values[1:])
    start = same & ~np.concatenate([[False], same[:-1]])
    if same.any():
        begin = np.flatnonzero(start)[np.maximum(np.cumsum(start) - 1, 0)]
        hit &= ~same | ((np.arange(len(hit)) - begin) % 2 == 0)
    values = values.copy()
    places = np.flatnonzero(hit)
    values[places] = name[at[places]]
    stays = np.ones(len(values), bool)
    stays[places + 1] = False
    gone = np.concatenate([[0], np.cumsum(~stays)])
    return values[stays], cuts - gone[cuts]


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols as numbers, and where each sequence begins and ends."""
    texts = column.to_pylist()
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    place = np.zeros(256, np.int64)
    place[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
    return place[np.frombuffer("".join(texts).encode(), np.uint8)], cuts


def _pairs(rounds: list[list[tuple[int, int, int]]]):
    """How often neighbours stand in the sequences, after the rules so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, cuts = _sequences(batch.column("symbols"))
            for rules in rounds:
                values, cuts = _replaced(values, cuts, rules)
            weight = np.repeat(np.asarray(batch.column("times")), np.diff(cuts))
            inside = np.ones(max(len(values) - 1, 0), bool)
            inside[cuts[1:-1][(cuts[1:-1] > 0) & (cuts[1:-1] < len(values))] - 1] = False
            pair = (values[:-1] << 32 | values[1:])[inside]
            keys, where = np.unique(pair, return_inverse=True)
            counts = np.bincount(where, weight[:-1][inside], minlength=len(keys)).astype(np.int64)
            yield pa.record_batch([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(counts)],
                                  names=["x", "y", "n"])

    return run


def grammar(sequences: DataFrame, most: int = RULES) -> list[list[tuple[int, int, int]]]:
    """Rounds of rules (left, right, name), most frequent neighbours first, from counts over all sequences."""
    rounds: list[list[tuple[int, int, int]]] = []
    name = len(SYMBOLS)
    while len(rounds) < ROUNDS and name < len(SYMBOLS) + most:
        room = len(SYMBOLS) + most - name
        counted = sequences.mapInArrow(_pairs(rounds), "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n"))
        top = counted.filter("n > 1").orderBy(F.desc("n"), "x", "y").limit(room).collect()
        lefts, rights, rules = set(), set(), []
        for pair in top:
            if pair.x in rights or pair.y in lefts or (pair.x == pair.y and pair.x in lefts | rights):
                continue
            lefts.add(pair.x)
            rights.add(pair.y)
            rules.append((pair.x, pair.y, name))
            name += 1
        if not rules:
            break
        rounds.append(rules)
    return rounds


def evaluated(rounds: list[list[tuple[int, int, int]]]) -> dict[int, tuple[Row, ...]]:
    """The matrix of every symbol and rule, bottom-up."""
    matrices = dict(MATRICES)
    for x, y, name in (rule for rules in rounds for rule in rules):
        matrices[name] = product(matrices[x], matrices[y])
    return matrices


_ENTRY = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_ENTRIES = "symbols string, whole boolean, entries array<struct<cost: bigint, audit: string>>"


def _solved(rounds: list[list[tuple[int, int, int]]]):
    """Of whole sequences the least entry; of pieces the sixteen entries of their matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = evaluated(rounds)

        def written(entry: Entry | None) -> dict | None:
            return None if entry is None else {"cost": entry[0], "audit": str(entry[1])}

        for batch in batches:
            values, cuts = _sequences(batch.column("symbols"))
            for rules in rounds:
                values, cuts = _replaced(values, cuts, rules)
            found = []
            whole = batch.column("whole").to_pylist()
            for row in range(len(batch)):
                names = values[cuts[row]:cuts[row + 1]].tolist()
                rows = [START] if whole[row] else [tuple((0, Rope()) if i == j else None for j in STATES) for i in STATES]
                for name in names:
                    rows = [applied(r, matrices[name]) for r in rows]
                found.append([written(closed(rows[0]))] if whole[row] else [written(e) for r in rows for e in r])
            yield pa.record_batch(
                [batch.column("symbols"), batch.column("whole"), pa.array(found, _ENTRY)], names=["symbols", "whole", "entries"]
            )

    return run


# Rows, places and pieces


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage, and how often a row comes (0: dropped)."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    held = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return held.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("times"),
    ).withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def _flags() -> tuple[Column, Column]:
    bare = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    return bare == "", ~F.substring(bare, -1, 1).isin(".", "!", "?")


def turns_of(rows: DataFrame) -> DataFrame:
    """Rows without their texts, copies as one."""
    blank, truncated = _flags()
    narrow = rows.select(
        "conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"), "digest", blank.alias("blank"),
        truncated.alias("truncated"), "times",
    )
    return narrow.groupBy("conv_id", "turn", "role", "initial", "digest", "blank", "truncated").agg(F.sum("times").alias("times"))


def placed(groups: DataFrame) -> DataFrame:
    """The turns, each with whether its text came earlier."""
    place = F.struct(F.col("turn").isNotNull(), "turn")
    first = groups.filter("times > 0").groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # Only texts that come in several places need to be met.
    again = first.filter("n > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("g"), "first")
    met = groups.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("g")), "left")
    return met.select(
        "conv_id", "turn", "role", "initial", "digest", "blank", "truncated", "times",
        (F.col("first").isNotNull() & (F.col("first") != place)).alias("repeated"),
    )


_PIECE = (
    "conv_id long, part int, no long, whole boolean, symbols string, blank long, duplicate long, truncated long, "
    "illegal long, first_initial string, last_initial string, first_turn long, last_turn long, turns long"
)
_LEGAL = {"su", "ua", "au"}


class _Piece:
    """A run of rows of one conversation in order."""

    def __init__(self, conv: int | None):
        self.conv, self.symbols, self.initials, self.turns = conv, [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.first = self.last = self.first_turn = self.last_turn = None
        self.distinct = 0

    def add(self, initial: str, times: int, blank: bool, truncated: bool, repeated: bool, turn: int | None) -> None:
        if not times:
            return
        symbol = "d"
        if blank:
            self.blank += times
        elif repeated:
            self.duplicate += times
        else:
            self.duplicate += times - 1
            self.truncated += truncated
            symbol = initial if initial in ("s", "u", "a") else "x"
            symbol = symbol.upper() if truncated else symbol
        self.symbols.append(symbol + "d" * (times - 1))
        self.rows += times
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.illegal += (times - 1) * (initial * 2 not in _LEGAL)
        self.last = initial
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.distinct += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, part: int, no: int, whole: bool) -> tuple:
        return (
            self.conv, part, no, whole, "".join(self.symbols), self.blank, self.duplicate, self.truncated, self.illegal,
            self.first, self.last, self.first_turn, self.last_turn, self.distinct,
        )


_PIECE_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("no", pa.int64()), ("whole", pa.bool_()), ("symbols", pa.string()),
    *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")), ("first_initial", pa.string()),
    ("last_initial", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _cut(piece_rows: int):
    """Sorted rows of a partition as pieces. A conversation at either end of it may go on elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, piece, alone, ready = TaskContext.get().partitionId(), 0, None, False, []
        for batch in batches:
            for conv, turn, initial, times, blank, truncated, repeated in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "times", "blank", "truncated", "repeated")),
                strict=True,
            ):
                fresh = piece is None or piece.conv != conv
                if fresh or piece.rows >= piece_rows:
                    if piece is not None:
                        ready.append(piece.row(part, no, fresh and alone))
                        no += 1
                    alone = fresh and piece is not None
                    piece = _Piece(conv)
                piece.add(initial, times, blank, truncated, repeated, turn)
                if len(ready) >= 4096:
                    yield _batch(ready, _PIECE_ARROW)
                    ready = []
        if piece is not None:
            ready.append(piece.row(part, no, False))
        yield _batch(ready, _PIECE_ARROW)

    return run


def pieces_of(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    order = (F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"))
    turns = parked(turns_of(rows), "turns")
    places = parked(placed(turns), "places")
    ranged = places.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = parked(ranged.mapInArrow(_cut(piece_rows), _PIECE), "pieces")
    unparked(turns, places)
    return pieces


_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_AUDIT_ARROW = pa.schema([
    ("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()),
])


class _Folded:
    """The pieces of one conversation so far."""

    def __init__(self, conv: int | None):
        self.conv, self.row, self.whole = conv, START, None
        self.counts = [0, 0, 0, 0]
        self.last = self.low = self.high = None
        self.turns = 0

    def add(self, p: dict) -> None:
        for i, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.counts[i] += p[c]
        entries = [None if e is None else (e["cost"], Rope(e["audit"])) for e in p["entries"]]
        if p["whole"]:
            self.whole = entries[0]
        else:
            self.row = applied(self.row, tuple(tuple(entries[4 * i:4 * i + 4]) for i in STATES))
        if p["first_initial"] is not None:
            if self.last is not None:
                self.counts[3] += self.last + p["first_initial"] not in _LEGAL
            self.last = p["last_initial"]
        if p["first_turn"] is not None:
            self.turns += p["turns"] - (self.high == p["first_turn"])
            self.low = p["first_turn"] if self.low is None else self.low
            self.high = p["last_turn"]

    def result(self) -> tuple:
        cost, audit = self.whole or closed(self.row)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts, cost, str(audit))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        ready = []
        for piece in batch.to_pylist():
            if held is None or held.conv != piece["conv_id"]:
                if held is not None:
                    ready.append(held.result())
                held = _Folded(piece["conv_id"])
            held.add(piece)
        yield _batch(ready, _AUDIT_ARROW)
    if held is not None:
        yield _batch([held.result()], _AUDIT_ARROW)


def audits(rows: DataFrame, most: int = RULES, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation of ``damaged`` rows: counts of faults, least cost and its audit."""
    pieces = pieces_of(rows, piece_rows)
    sequences = parked(pieces.groupBy("symbols", "whole").agg(F.count(F.lit(1)).alias("times")), "sequences")
    solved = parked(sequences.mapInArrow(_solved(grammar(sequences, most)), _ENTRIES), "entries")
    order = (F.asc_nulls_first("conv_id"), "part", "no")
    met = pieces.join(solved, ["symbols", "whole"]).drop("symbols")
    found = parked(met.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_fold, _AUDIT), "audits")
    unparked(pieces, sequences, solved)
    return found


# Repaired texts

_DIGEST = "conv_id long, repaired_sha256 string"
_DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


class Repaired:
    """Applies an audit to the rows of a conversation as they come; ``out`` takes the repaired lines."""

    def __init__(self, audit: str, out):
        self.audit, self.at, self.state, self.out, self.lines = audit, 0, 0, out, 0

    def _say(self, state: int, line: str) -> None:
        self.out((("\n" if self.lines else "") + line).encode())
        self.state, self.lines = state, self.lines + 1

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            state, role = _SAID[self.state]
            self._say(state, f"{role}:")
            self.at += 1

    def add(self, role: str, text: str, times: int) -> None:
        for _ in range(times):
            self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self._say(_NEXT[role[0]][self.state], f"{role}:{text}")
            elif edit == "R":
                state, said = _SAID[self.state]
                self._say(state, f"{said}:{text}")

    def end(self) -> None:
        self._inserted()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, repaired, held = None, None, None
    ready = []
    for batch in batches:
        for conv, audit, role, text, times in zip(
            *(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "times")), strict=True
        ):
            if audit is not None:  # a conversation begins with its audit
                if repaired is not None:
                    repaired.end()
                    ready.append((current, held.hexdigest()))
                current, held = conv, hashlib.sha256()
                repaired = Repaired(audit, held.update)
            else:
                repaired.add(role, text, times)
        yield _batch(ready, _DIGEST_ARROW)
        ready = []
    if repaired is not None:
        repaired.end()
        yield _batch([(current, held.hexdigest())], _DIGEST_ARROW)


def repair(rows: DataFrame, most: int = RULES, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation: faults, least cost, audit, and the digest of the repaired rows."""
    hurt = damaged(rows)
    found = audits(hurt, most, piece_rows)
    columns = ("conv_id", "turn", "role", "digest", "text", "times")
    lines = hurt.filter("times > 0").select(*columns, F.lit(None).cast("string").alias("audit"))
    heads = found.select(
        "conv_id", *(F.lit(None).cast(t).alias(c) for c, t in zip(columns[1:], ("long", "string", "string", "string", "long"), strict=True)),
        "audit",
    )
    order = (
        F.asc_nulls_first("conv_id"), F.col("audit").isNull(), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"),
    )
    digests = lines.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_digests, _DIGEST)
    named = digests.withColumnRenamed("conv_id", "c")
    return found.join(named, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


# The dynamic program symbol by symbol, without a grammar. CRC-32 comes from its polynomial.
SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([CAST(i AS UBIGINT)] || list_transform(range(8), lambda z: CAST(0 AS UBIGINT)),
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: CAST(ascii(c) AS UBIGINT)) AS codes
  FROM conversations
), coded AS (
  SELECT conv_id, turn, role, text, xor(list_reduce([CAST(4294967295 AS UBIGINT)] || codes,
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), CAST(4294967295 AS UBIGINT)) % 20 AS kind
  FROM raw, crc_table
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded WHERE kind <> 0
), numbered AS (
  SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS i
  FROM hurt
), faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS last_initial
  FROM numbered
), faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (last_initial IS NOT NULL AND last_initial || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), said(state, after, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
kept(initial, state, after) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
inserts(state, after, n, lines) AS (
  SELECT state, state, 0, CAST([] AS VARCHAR[]) FROM said
  UNION ALL SELECT state, after, 1, [role || ':'] FROM said
  UNION ALL SELECT a.state, b.after, 2, [a.role || ':', b.role || ':'] FROM said a JOIN said b ON b.state = a.after
), ids AS (
  SELECT DISTINCT conv_id FROM conversations
), lengths AS (
  SELECT ids.conv_id, count(f.i) AS n FROM ids LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id GROUP BY ids.conv_id
), dp(conv_id, i, state, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} FROM ids
  UNION ALL
  SELECT conv_id, i, state, min(best) FROM (
    SELECT d.conv_id, f.i, e.after AS state, {
      'cost': d.best.cost + 5 * n.n + e.cost,
      'audit': d.best.audit || repeat('I', n.n) || e.edit,
      'lines': d.best.lines || n.lines || CASE e.edit WHEN 'D' THEN CAST([] AS VARCHAR[])
        WHEN 'K' THEN [f.role || ':' || f.text] ELSE [e.role || ':' || f.text] END} AS best
    FROM dp d JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1
    JOIN inserts n ON n.state = d.state
    JOIN (
      SELECT state, state AS after, 'D' AS edit, '' AS role, '' AS initial, 2 AS cost FROM said
      UNION ALL SELECT state, after, 'R', role, '', 1 FROM said
      UNION ALL SELECT state, after, 'K', '', initial, 0 FROM kept
    ) x ON x.state = n.after AND (x.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
      AND (x.edit <> 'K' OR x.initial = f.initial),
    LATERAL (SELECT x.after, x.edit, x.role, x.cost + CASE WHEN x.edit <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost) e
  ) GROUP BY conv_id, i, state
), ended AS (
  SELECT d.conv_id, min({'cost': d.best.cost + 5 * n.n, 'audit': d.best.audit || repeat('I', n.n), 'lines': d.best.lines || n.lines}) AS best
  FROM dp d JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM d.conv_id AND l.n = d.i
  JOIN inserts n ON n.state = d.state AND n.after IN (0, 3)
  GROUP BY d.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.best.cost AS cost, e.best.audit AS audit,
  sha256(array_to_string(e.best.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""
