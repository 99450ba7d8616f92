"""Structure repair: cheapest audits by exhaustive search, all columns by plain loops, odd rows, very long conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from fieldtide.llm import queries, structure_repair

SCHEMA = "conv_id long, turn long, role string, text string, cost int, audit string"
GOOD = re.compile(r"(s?(ua)+)?")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def searched(symbols):
    """(cost, audit) by trying every edit of every row and every place and number of inserted turns."""
    best = None
    options = [["D"] if s == "d" else ["D", "K", "u", "a"] for s in symbols]
    for edits in itertools.product(*options):
        base = sum({"D": 2, "K": 0}.get(e, 1) + (5 if s.isupper() and e != "D" else 0) for s, e in zip(symbols, edits))
        for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(symbols) + 1):
            cost = base + 5 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            roles, audit = gaps[0], "I" * len(gaps[0])
            for s, e, gap in zip(symbols, edits, gaps[1:]):
                roles += {"D": "", "K": s.lower()}.get(e, e) + gap
                audit += (e if e in "DK" else "R") + "I" * len(gap)
            if GOOD.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_cells_against_exhaustive_search():
    rng = random.Random(7)
    for n in (1, 2, 3):
        for symbols in itertools.product("suaxUd", repeat=n) if n < 3 else [[rng.choice("suaxSUAXd") for _ in range(3)] for _ in range(60)]:
            assert structure_repair.parse("".join(symbols)) == searched("".join(symbols)), symbols


def walked(symbols):
    """(cost, audit) by a walk over the rows with the cheapest audit per place."""
    moves = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def inserted(states):
        for _ in range(4):
            for place, (cost, audit) in list(states.items()):
                for role in "ua":
                    to = moves.get((role, place))
                    if to is not None and (cost + 5, audit + "I") < states.get(to, (10**9, "")):
                        states[to] = (cost + 5, audit + "I")
        return states

    states = inserted({0: (0, "")})
    for s in symbols:
        new, more = {}, 5 if s.isupper() else 0
        for place, (cost, audit) in states.items():
            tried = [(place, cost + 2, "D")]
            if s != "d":
                tried += [(moves[s.lower(), place], cost + more, "K")] if (s.lower(), place) in moves else []
                tried += [(moves[r, place], cost + 1 + more, "R") for r in "ua" if (r, place) in moves]
            for to, c, letter in tried:
                new[to] = min(new.get(to, (10**9, "")), (c, audit + letter))
        states = inserted(new)
    return min(states[p] for p in (0, 3) if p in states)


def test_long_spans_against_a_walk():
    rng = random.Random(3)
    for n in [*range(0, 40), 399, 1_000]:
        symbols = "".join(rng.choice("suaxUAd") for _ in range(n))
        assert structure_repair.parse(symbols) == walked(symbols)


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def brute(rows, damaged=True):
    convs = {r[0]: [] for r in rows}
    for row in hurt(rows) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]:
        convs[row[0]].append((row[1] is not None, row[1] or 0, row[2], row[3]))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        seen, symbols, faults = set(), "", []
        for _, _, role, text in turns:
            visible = VISIBLE.findall(text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            s = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "d" if fault in ("blank", "duplicate") else s.upper() if fault else s
        cost, audit = walked(symbols)
        lines, at, place = [], 0, 0
        for letter in audit:
            if letter == "I":
                lines.append(("assistant" if place == 2 else "user") + ":")
                place = 3 if place == 2 else 2
                continue
            _, _, role, text = turns[at]
            at += 1
            if letter == "R":
                role = "assistant" if place == 2 else "user"
            if letter != "D":
                lines.append(f"{role}:{text}")
                place = {"s": 1, "u": 2, "a": 3}[role[0]]
        known = [t for there, t, _, _ in turns if there]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        firsts = [r[:1] for _, _, r, _ in turns]
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(seed, n=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "and then", "", " \t", "é.", "One. Two", None]
    return [(c, rng.choice([i, i, i, i + 2, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             rng.choice(texts) if rng.random() < 0.3 else f"Turn {i} of {c}.") for c in range(n) for i in range(rng.randrange(1, 12))]


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_query_against_plain_loops(spark, frame, tmp_path):
    rows = conversations(1) + [(None, 1, "user", "lost."), (None, None, None, None), (7, 0, "user", "long " * 50_000 + ".")]
    rows += [(9_000, i, ["user", "assistant"][i % 2], "same." if i % 3 else f"{i}.") for i in range(9_500)]
    rows += [(10_000, 0, "user", "Hot?")] + [(c, 0, "user", "Hot.") for c in range(20_000, 20_100)]
    frame(rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_interval_repair"](spark, str(tmp_path)).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_repaired_turns(frame):
    rows = conversations(2, 40) + [(5_000, i, "user", f"{i}.") for i in range(8_200)]
    repair = structure_repair.Repair(frame(rows))
    want = brute(rows, damaged=False)
    lines = {}
    for row in sorted(repair.repaired().collect(), key=lambda r: (r.conv, r.place)):
        lines.setdefault(row.conv, []).append(row)
    for row in repair.report().collect():
        assert tuple(row[c] for c in COLUMNS) == want[row.conv]
        turns = lines.get(row.conv, [])
        assert [t.place for t in turns] == list(range(1, len(turns) + 1))
        assert GOOD.fullmatch("".join(t.role[0] for t in turns))
        assert "".join(t.edit for t in turns) == row.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == row.repaired_sha256


def test_empty_table(spark, frame, tmp_path):
    empty = frame([(1, 1, "user", "x")]).where("false")
    empty.write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.QUERIES["op13_interval_repair"](spark, str(tmp_path)).count() == 0
    assert structure_repair.Repair(empty).repaired().count() == 0
