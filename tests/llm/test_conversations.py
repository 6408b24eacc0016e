import itertools
import re
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grainmill.llm import conversations
from grainmill.llm.catalog import QUERIES, SQL, damaged
from grainmill.llm.conversations import Audit, Trails, audit_rows, repair, repaired

import oracle

LEGAL = re.compile("(s?(ua)+)?")


def by_trial(rows, most=3):
    """The least of all edit sequences with up to `most` insertions, by trying each."""
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(e != "D" and gone for e, (_, gone, _) in zip(edits, rows)):
            continue
        base = sum({"K": 0, "R": 1, "D": 2}[e] + (5 if e != "D" and cut else 0) for e, (_, _, cut) in zip(edits, rows))
        for inserts in itertools.product(range(most + 1), repeat=len(rows) + 1):
            if sum(inserts) > most:
                continue
            trail = "".join("I" * n + e for n, e in zip(inserts, [*edits, ""]))
            cost = base + 5 * sum(inserts)
            if (best is None or (cost, trail) < best) and fits(trail, rows):
                best = cost, trail
    return best


def fits(trail, rows):
    """Whether some choice of the free roles makes the initials legal."""
    rest = iter(rows)
    slots = []
    for e in trail:
        initial = None if e == "I" else next(rest)[0]
        if e != "D":
            slots.append([initial or "?"] if e == "K" else ["u", "a"])  # an empty role is no legal one
    return any(LEGAL.fullmatch("".join(x)) for x in itertools.product(*slots))


ROWS = st.lists(st.tuples(st.sampled_from(["u", "a", "s", "x", ""]), st.booleans(), st.booleans()).map(lambda r: (r[0], r[1], r[2] and not r[1])), max_size=4)


@settings(max_examples=60, deadline=None)
@given(ROWS, st.sampled_from([conversations.MODULUS, 7, 1]))
def test_audit_like_trying_all_edits(rows, modulus):
    audit = Audit(modulus)
    for row in rows:
        audit.add(*row)
    assert audit.result() == by_trial(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("DIKR", max_size=12), min_size=2, max_size=8), st.sampled_from([conversations.MODULUS, 5, 1]))
def test_trails_compare_like_strings(texts, modulus):
    trails = Trails(modulus)
    nodes = []
    for text in texts:
        node = 0
        for sign in text:
            node = trails.add(node, sign)
        nodes.append(node)
    for (s, a), (t, b) in itertools.product(zip(texts, nodes), repeat=2):
        assert trails.less(a, b) == (s < t)
        assert trails.signs(a) == s
    assert trails.shared([nodes[0], nodes[0]]) == nodes[0]
    assert trails.shared(nodes[:2]) == (nodes[0] if nodes[0] == nodes[1] else 0)


def test_settled_beginnings_change_nothing(monkeypatch):
    rows = [("uaxsa u"[i * i % 7].strip(), i % 11 == 3, i % 13 == 5) for i in range(700)]
    found = []
    for settle in (1, 7, 512, 10_000):
        monkeypatch.setattr(conversations, "SETTLE", settle)
        audit = Audit()
        for row in rows:
            audit.add(*row)
        found.append(audit.result())
    assert len(set(found)) == 1


def test_long_conversation_keeps_few_nodes():
    audit = Audit()
    for i in range(20_000):
        audit.add("ua"[i % 2] if i % 50 else "x", False, False)
    assert len(audit.trails.sign) < 20 * conversations.SETTLE
    assert audit.rows == 20_000


def plain(rows):
    """Faults, edits and repaired digest of one conversation's (turn, role, text) rows, by plain loops."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).digest()))
    seen, marks, blank, duplicate, truncated = set(), [], 0, 0, 0
    for _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\x0c\r")
        gone = cut = False
        if not core:
            blank, gone = blank + 1, True
        elif (role, text) in seen:
            duplicate, gone = duplicate + 1, True
        elif core[-1] not in ".!?":
            truncated, cut = truncated + 1, True
        seen.add((role, text))
        marks.append((role[:1], gone, cut))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
    cost, edits = by_trial(marks)
    lines = "\n".join(f"{r}:{x}" for r, x in repaired([r[1:] for r in rows], edits))
    return gaps, blank, duplicate, truncated, illegal, cost, edits, sha256(lines.encode()).hexdigest()


CONVERSATIONS = {
    1: [(0, "user", "Hi."), (1, "assistant", "Yes?")],
    2: [(None, "user", "Hi."), (None, "assistant", "No"), (5, None, None), (9, "tool", "x!")],
    3: [(3, "assistant", "Same."), (3, "assistant", "Same."), (4, "assistant", "Same.")],
    4: [(0, "system", "Be nice."), (1, "user", "é… \n"), (2, "user", "Ends!\x0b ")],
    5: [(0, "", ""), (0, "", "\t")],
    6: [(0, "user", "long " * 200_000), (1, "assistant", "ok.")],
    7: [(-3, "user", "nbsp "), (2**30, "usher", " "), (0, "aide", "b.")],
    None: [(0, "user", "a."), (1, "assistant", "b.")],
}


def test_repair_like_plain_loops(frame):
    rows = [(c, t, r, x, "extra", 1) for c, of in CONVERSATIONS.items() for t, r, x in of]
    got = repair(frame(rows, "conv_id long, turn int, role string, text string, audit string, part int"))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {c: plain(of) for c, of in CONVERSATIONS.items()}
    assert repair(frame([], "conv_id string, turn long, role string, text string")).count() == 0


def test_damage(frame):
    rows = [(c, t, "assistant", "A b. C!") for c in range(40) for t in range(6)] + [(None, None, None, None)]
    got = damaged(frame(rows, "conv_id long, turn long, role string, text string")).collect()
    import zlib

    want = []
    for c, t, r, x in rows:
        n = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        x = "" if n == 1 else "A b C" if n == 2 and x != " " else x
        want += [(c, t, "user" if n == 4 else r, x)] * (n != 0) * (2 if n == 3 else 1)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_largest_gap():
    rows = [(-(2**63), "u", False, False, False), (2**63 - 1, "a", False, False, False)]
    assert audit_rows(rows)[0] == 2**63 - 1


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_and_sql(spark, folder):
    assert oracle.compare(QUERIES["op13_conversations"](spark, folder), oracle.connect(folder), SQL["op13_conversations"]) == []
