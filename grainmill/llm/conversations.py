"""Cheapest repair of conversations, with the audit trail of the edits.

Rows become edits by a dynamic program over the four places in `(s?(ua)+)?`: nothing kept yet, after the system
row, after a user row, after an assistant row. The trail that leads to a place is a linked node; trails share
their beginnings, so a step adds a node and copies nothing. A node knows its ancestors 1, 2, 4, … steps back and
a rolling hash of the whole trail. Of equally cheap trails the least one is wanted: the longest common prefix of
two trails is found by going back in halving steps while hashes differ, and equal hashes are then checked by
walking back to a common node (or to a pair checked before), so a collision costs time and never a result.

Work on Spark: only turn, role, digest and marks of a row are shuffled by conversation for the audit, in their
order and as a stream. A second shuffle sends the texts after their conversation's audit, and the repaired text
is hashed as it streams by. A trail is cut off behind the last node that all live trails share, so what a
conversation holds follows the stretch that is not settled yet, beside its audit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from grainmill.llm.batches import as_batches, by_row

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "KRDI"
#: Costs of the edits, and of leaving a truncated row in place.
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: Places: nothing kept, after system, after user, after assistant; the first and the last may end a conversation.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
TURN = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Rows between two looks for a settled beginning.
SETTLE = 512
MODULUS, BASE = (1 << 61) - 1, 1_000_003
LARGEST = (1 << 63) - 1


class Trails:
    """Strings as linked nodes that share prefixes; node 0 is the empty one."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.up: list[list[int]] = [[]]
        self.sign = [""]
        self.depth = [0]
        self.hash = [0]
        self.twin: dict[int, int] = {}

    def add(self, parent: int, sign: str) -> int:
        node, above, k = len(self.sign), [parent], 0
        while len(self.up[above[k]]) > k:
            above.append(self.up[above[k]][k])
            k += 1
        self.up.append(above)
        self.sign.append(sign)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(sign)) % self.modulus)
        return node

    def parent(self, node: int) -> int:
        return self.up[node][0]

    def back(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def signs(self, node: int, above: int = 0) -> str:
        """The signs below node `above`."""
        found = []
        while node != above:
            found.append(self.sign[node])
            node = self.parent(node)
        return "".join(reversed(found))

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth hold one string; pairs found equal are remembered."""
        first, second = a, b
        while True:
            a, b = self.twin.get(a, a), self.twin.get(b, b)
            if a == b:
                break
            if self.sign[a] != self.sign[b]:
                return False
            a, b = self.parent(a), self.parent(b)
        if first != second:
            self.twin[max(first, second)] = min(first, second)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of `a` comes before that of `b`."""
        length = min(self.depth[a], self.depth[b])
        x, y = self.back(a, self.depth[a] - length), self.back(b, self.depth[b] - length)
        if self.hash[x] == self.hash[y]:
            if self.same(x, y):
                return self.depth[a] < self.depth[b]
        else:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            if self.sign[x] != self.sign[y] and self.same(self.parent(x), self.parent(y)):
                return self.sign[x] < self.sign[y]
        return self.signs(a) < self.signs(b)  # hashes have collided

    def shared(self, nodes: list[int]) -> int:
        """The deepest node above (or among) all `nodes`."""
        first = nodes[0]
        for other in nodes[1:]:
            length = min(self.depth[first], self.depth[other])
            first, other = self.back(first, self.depth[first] - length), self.back(other, self.depth[other] - length)
            for k in range(len(self.up[first]) - 1, -1, -1):
                if k < len(self.up[first]) and self.up[first][k] != self.up[other][k]:
                    first, other = self.up[first][k], self.up[other][k]
            if first != other:
                first = self.parent(first)
        return first


class Audit:
    """The cheapest edits of one conversation, row by row."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus, self.rows = modulus, 0
        self.trails = Trails(modulus)
        self.settled: list[str] = []
        self.live = {NOTHING: (0, 0)}
        self._offer_inserts(self.live)

    def _offer(self, into: dict, place: int, cost: int, trail: int, sign: str) -> None:
        held = into.get(place)
        if held and held[0] < cost:
            return
        node = self.trails.add(trail, sign)
        if not held or cost < held[0] or self.trails.less(node, held[1]):
            into[place] = cost, node

    def _offer_inserts(self, into: dict) -> None:
        for place in (NOTHING, SYSTEM, ASSISTANT, USER):
            if place in into:
                cost, trail = into[place]
                self._offer(into, TURN[place], cost + COSTS[INSERT], trail, INSERT)

    def add(self, initial: str, must_go: bool, truncated: bool) -> None:
        """One row: the first character of its role, whether it has to be deleted, whether it is truncated."""
        found: dict[int, tuple[int, int]] = {}
        stays = TRUNCATED if truncated else 0
        for place, (cost, trail) in self.live.items():
            self._offer(found, place, cost + COSTS[DELETE], trail, DELETE)
            if must_go:
                continue
            follows = TURN[place]
            if initial == ROLES[follows][0]:
                self._offer(found, follows, cost + stays + COSTS[KEEP], trail, KEEP)
            elif place == NOTHING and initial == "s":
                self._offer(found, SYSTEM, cost + stays + COSTS[KEEP], trail, KEEP)
            self._offer(found, follows, cost + stays + COSTS[REROLE], trail, REROLE)
        self._offer_inserts(found)
        # whatever may follow can follow an assistant row as well, a system row being deleted there
        if found[ASSISTANT][0] + COSTS[DELETE] < found.get(NOTHING, (0,))[0]:
            del found[NOTHING]
        if found[ASSISTANT][0] < found.get(SYSTEM, (0,))[0]:
            del found[SYSTEM]
        self.live = found
        self.rows += 1
        if self.rows % SETTLE == 0:
            self._settle()

    def _settle(self) -> None:
        """Put away what all live trails begin with, and the nodes of dead ones."""
        old, trails = self.trails, Trails(self.modulus)
        top = old.shared([trail for _, trail in self.live.values()])
        self.settled.append(old.signs(top))
        moved = {top: 0}
        for place, (cost, trail) in self.live.items():
            path, node = [], trail
            while node not in moved:
                path.append(node)
                node = old.parent(node)
            for below in reversed(path):
                moved[below] = trails.add(moved[old.parent(below)], old.sign[below])
            self.live[place] = cost, moved[trail]
        self.trails = trails

    def result(self) -> tuple[int, str]:
        """Cost and edits."""
        ends = [self.live[place] for place in (NOTHING, ASSISTANT) if place in self.live]
        best = ends[0]
        for cost, trail in ends[1:]:
            if cost < best[0] or (cost == best[0] and self.trails.less(trail, best[1])):
                best = cost, trail
        return best[0], "".join(self.settled) + self.trails.signs(best[1])


def repaired(rows: Iterable[tuple[str, str]], edits: str) -> Iterator[tuple[str, str]]:
    """The rows (role, text) that edits leave behind; rows are taken one at a time."""
    place, rows = NOTHING, iter(rows)
    for edit in edits:
        if edit == INSERT:
            place = TURN[place]
            yield ROLES[place], ""
            continue
        role, text = next(rows)
        if edit == DELETE:
            continue
        if edit == KEEP and place == NOTHING and role[:1] == "s":
            place = SYSTEM
        else:
            place = TURN[place]
            role = ROLES[place] if edit == REROLE else role
        yield role, text


LEGAL = {"su", "ua", "au"}


def audit_rows(rows: Iterable[tuple], modulus: int = MODULUS) -> tuple[int, int, int, int, int, int, str]:
    """Gaps, blank, duplicate, truncated, illegal, cost and edits of `(turn, initial, blank, repeated, open end)` rows in order."""
    audit = Audit(modulus)
    first = last = before = None
    turns = blank = duplicate = truncated = illegal = 0
    for turn, initial, is_blank, is_repeated, is_open in rows:
        if turn is not None:
            first = turn if first is None else first
            turns += turn != last
            last = turn
        is_repeated = is_repeated and not is_blank
        is_open = is_open and not (is_blank or is_repeated)
        blank, duplicate, truncated = blank + is_blank, duplicate + is_repeated, truncated + is_open
        illegal += before is not None and before + initial not in LEGAL
        before = initial
        audit.add(initial, is_blank or is_repeated, is_open)
    gaps = 0 if first is None else min(last - first + 1 - turns, LARGEST)
    return gaps, blank, duplicate, truncated, illegal, *audit.result()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _fields(df: DataFrame, *more: str) -> dict[str, pa.DataType]:
    """Columns of the audit, and texts beside it."""
    found = {"conv_id": to_arrow_type(df.schema["conv_id"].dataType), **{c: pa.int64() for c in COUNTS}, "audit": pa.string()}
    return found | {c: pa.string() for c in more}


def _schema(df: DataFrame, *more: str) -> str:
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return ", ".join([f"conv_id {df.schema['conv_id'].dataType.simpleString()}", counts, "audit string", *[f"{c} string" for c in more]])


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with null role and text as one space, and a digest of the text that orders rows of one turn and role."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def _faults(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last character that is no space does not end a sentence."""
    trimmed = F.rtrim(text, F.lit(SPACES))
    return trimmed == "", ~F.substring(trimmed, -1, 1).isin(".", "!", "?")


def audits(rows: DataFrame) -> DataFrame:
    """Counts of faults, cost and edits of every conversation of `rows(conv_id, turn, role, text)`."""
    marked = _marked(rows)
    blank, cut = _faults(F.col("text"))
    narrow = marked.select("conv_id", "turn", "role", "digest", blank.alias("blank"), cut.alias("cut")).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    ordered = (
        narrow.withColumn("repeated", F.row_number().over(seen) > 1)
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "repeated")
        .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "repeated", "cut")
    )
    fields = _fields(marked)

    def run(batches):
        found = ((conv, *audit_rows(row[1:] for row in of)) for conv, of in groupby(by_row(batches), key=lambda row: row[0]))
        return as_batches(found, fields)

    return ordered.mapInArrow(run, _schema(marked))


def repair(rows: DataFrame) -> DataFrame:
    """Every conversation of `rows(conv_id, turn, role, text)`, repaired: counts of its faults, cost, audit and repaired_sha256.

    Rows are taken by turn (null first), rows of one turn by role and the digest of the text. The first fault of a
    row counts: blank (nothing but spaces), duplicate (role and text seen earlier), truncated (no `.`, `!` or `?` at
    its end). gaps counts the turns that lack between the least and the largest (at most the largest long), illegal
    the neighbouring role initials other than su, ua, au. audit holds the initials of the cheapest edits (keep 0,
    rerole 1, delete 2, insert 5; blank and duplicate rows go, truncated ones that stay cost 5 more) that make the
    role initials `(s?(ua)+)?`, the least one if several cost the same. repaired_sha256 is the digest of the
    repaired rows as `role:text` lines. Null role or text counts as one space, an empty role is none
    that may stay, null conv_id is a conversation.
    Other columns are ignored; an empty table gives no rows.
    """
    marked, found = _marked(rows), audits(rows)
    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in [*found.schema, *marked.schema]}
    heads = found.select("*", F.lit(0).alias("part"), *[nothing[c] for c in ("turn", "role", "text", "digest")])
    bodies = marked.select("conv_id", *[nothing[c] for c in (*COUNTS, "audit")], F.lit(1).alias("part"), "turn", "role", "text", "digest")
    ordered = (
        heads.union(bodies)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", F.col("turn").asc_nulls_first(), "role", "digest")
        .select("conv_id", *COUNTS, "audit", "role", "text")
    )
    fields = _fields(marked, "repaired_sha256")

    def run(batches):
        def conversations():
            for _, of in groupby(by_row(batches), key=lambda row: row[0]):
                head = next(of)[:-2]
                whole = sha256()
                for i, (role, text) in enumerate(repaired((row[-2:] for row in of), head[-1])):
                    whole.update(("\n" if i else "").encode() + f"{role}:{text}".encode())
                yield *head, whole.hexdigest()

        return as_batches(conversations(), fields)

    return ordered.mapInArrow(run, _schema(marked, "repaired_sha256"))
