import hashlib
import random
import zlib
from itertools import product

import pytest

from docweave.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, times int, audit string, digest string"
SPACE = " \t\n\x0b\x0c\r"
SAID = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def make(seed: int = 8, conversations: int = 60) -> list[tuple]:
    draw = random.Random(seed)
    texts = ["Hello.", "Yes!", "no end", " \n", "", None, "Ask?\t", "a longer answer, cut", "é漢。", "x"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "support"]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(draw.choice([1, 2, 5, 9])):
            role = draw.choice(roles) if draw.random() < 0.3 else ["user", "assistant"][turn % 2]
            at = None if draw.random() < 0.1 else turn + draw.choice([0, 0, 0, 2, -1])
            rows.append((conv, at, role, draw.choice(texts) if draw.random() < 0.5 else f"Turn {turn}.", 9, "x", "y"))
    rows += rows[10:14] + [(1000, t, ["user", "assistant"][t % 2], f"long {t % 40}.", 1, "", "") for t in range(400)]
    return rows + [(1001, 5, "user", "same." * 2000, 1, "", "")] * 30


def hurt(rows: list[tuple]) -> dict:
    found: dict = {}
    for conv, turn, role, text, *_ in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        held = found.setdefault(conv, [])
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        if kind:
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            held += [((turn is not None, turn or 0), role, digest, text, turn)] * (2 if kind == 3 else 1)
    return {conv: sorted(held) for conv, held in found.items()}


def judged(held: list) -> tuple[list, tuple]:
    seen, out = set(), []
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, _, text, _ in held:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        out.append((role, text, fault))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:], strict=False))
    turns = {h[4] for h in held if h[4] is not None}
    return out, (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts.values(), illegal)


def inserted(best: dict) -> dict:
    found = dict(best)
    for state, (cost, audit, lines) in best.items():
        for n in (1, 2):
            state, role = SAID[state]
            cost, audit, lines = cost + 5, audit + "I", [*lines, f"{role}:"]
            found[state] = min(found.get(state, (cost, audit, lines)), (cost, audit, lines))
    return found


def brute(out: list) -> tuple:
    best = {0: (0, "", [])}
    for role, text, fault in out:
        new: dict = {}

        def put(state, entry, new=new):
            new[state] = min(new.get(state, entry), entry)

        for state, (cost, audit, lines) in inserted(best).items():
            put(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            if (role[:1], state) in NEXT:
                put(NEXT[role[:1], state], (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
            put(SAID[state][0], (cost + 1 + extra, audit + "R", [*lines, f"{SAID[state][1]}:{text}"]))
        best = new
    ends = inserted(best)
    cost, audit, lines = min(ends[s] for s in (0, 3) if s in ends)
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def expected():
    found = set()
    for conv, held in hurt(make()).items():
        out, counts = judged(held)
        found.add((conv, *counts, *brute(out)))
    return found


@pytest.mark.parametrize(("rules", "piece_rows"), [(repair.RULES, repair.PIECE_ROWS), (5, 7), (0, 3)])
def test_equal_to_brute_force(spark, expected, rules, piece_rows):
    rows = spark.createDataFrame(make(), SCHEMA).repartition(5)
    got = [tuple(r) for r in repair.repair(rows, rules, piece_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_no_rows_and_no_rows_left(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    turn = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = repair.repair(spark.createDataFrame([(5, turn, "user", "Hi.", 1, "", "")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def every_audit(symbols: str):
    """Costs and audits of all edits with at most two inserts at a place."""
    options = ["".join(p) for p in product(("", "I", "II"), repeat=1)]
    for gaps in product(options, repeat=len(symbols) + 1):
        for edits in product("DKR", repeat=len(symbols)):
            state, cost, audit = 0, 0, ""
            for place, gap in enumerate(gaps):
                for _ in gap:
                    state, cost = SAID[state][0], cost + 5
                audit += gap
                if place == len(symbols):
                    break
                symbol, edit = symbols[place], edits[place]
                audit += edit
                if edit == "D":
                    cost += 2
                    continue
                if symbol == "d" or (edit == "K" and (symbol.lower(), state) not in NEXT):
                    break
                cost += (edit == "R") + (5 if symbol.isupper() else 0)
                state = NEXT[symbol.lower(), state] if edit == "K" else SAID[state][0]
            else:
                continue
            if place == len(symbols) and state in (0, 3):
                yield cost, audit


def test_least_of_all_edits():
    draw = random.Random(1)
    for symbols in ["", *("".join(draw.choices(repair.SYMBOLS, k=n)) for n in (1, 2, 3, 3, 3) for _ in range(4))]:
        row = repair.START
        for c in symbols:
            row = repair.applied(row, repair.MATRICES[repair.SYMBOLS.index(c)])
        cost, audit = repair.closed(row)
        assert (cost, str(audit)) == min(every_audit(symbols))


def test_rules_expand_to_their_sequences(spark):
    draw = random.Random(4)
    texts = ["ua" * draw.randrange(40) + "".join(draw.choices("uaUds", k=draw.randrange(30))) for _ in range(50)] + ["u" * 33]
    rounds = repair.grammar(spark.createDataFrame([(t, True, 2) for t in texts], "symbols string, whole boolean, times long"))
    rules = {name: (x, y) for some in rounds for x, y, name in some}

    def spelled(name: int) -> str:
        return "".join(map(spelled, rules[name])) if name in rules else repair.SYMBOLS[name]

    import pyarrow as pa

    values, cuts = repair._sequences(pa.array(texts))
    before = len(values)
    for some in rounds:
        values, cuts = repair._replaced(values, cuts, some)
    assert ["".join(map(spelled, values[a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == texts
    assert len(rules) > 8 and len(values) < before / 4


def test_ropes_compare_as_texts():
    draw = random.Random(9)

    def grown(n: int) -> repair.Rope:
        if n < 2:
            return repair.Rope("".join(draw.choices("DIKR", [9, 1, 1, 1], k=n)))
        cut = draw.randrange(1, n)
        return repair.Rope(left=grown(cut), right=grown(n - cut))

    ropes = [grown(draw.choice([1, 2, 3, 90])) for _ in range(40)]
    for x in ropes:
        for y in ropes:
            assert repair.before(x, y) == (str(x) < str(y))
            assert str(x + y) == str(x) + str(y)
