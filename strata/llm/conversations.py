"""Repair of the turn structure of conversations by the cheapest audit of edits.

A repaired conversation's role initials are ``(s?(ua)+)?``: perhaps a system turn, then user and
assistant in turn. The edits are Keep (0), Rerole to the role that the structure asks for (2),
Delete (3; the only one for blank and duplicate rows) and Insert an empty turn (2); a truncated row
that is not deleted adds 1. The audit is the string of the initials of the cheapest edits, the
least in ASCII among equally cheap ones.

1. **Dynamic program.** After each row there are four states (nothing yet, after system, after
   user, after assistant). Each holds its cheapest cost, its audit so far, and the digest of the
   repaired turns so far, so no row has to be seen again.
2. **Persistent audits.** An audit is a node of a tree: its edit, its parent, its depth, a rolling
   hash of all edits up to it, and ancestors at distances of powers of two. A new edit is one new
   node; all states share their prefixes.
3. **Ties.** Two audits of one cost compare at their first different edit: binary lifting finds the
   deepest equal prefixes by their hashes, and the prefixes are then compared node by node up to
   the node that they share, so a collision of hashes is seen and the audits are compared in full.
   (Of two equally cheap audits of the same rows none is a prefix of the other.)
4. **Long conversations.** What all states have in common is put out when the tree is large, and
   the tree starts anew from there.

Rows are dealt by conversation, once; duplicates are found by Spark on the same partitioning, in
sorted order, so neither a conversation's texts nor its set of turns is ever held in memory. The
digest of a conversation reads its turns in order, so one conversation is one task's stream.

Defined results: a null counts as one space in every column (a null conversation id is one
conversation, and is returned as null); rows of one turn number are ordered by role, then text;
an empty role has no initial and can be kept nowhere; other roles can only be reroled or deleted; texts
are bytes, of any content and length; an empty table gives an empty result; a conversation that
the damage leaves without rows has zeros, an empty audit and the digest of nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ID, TEXT, ship
from strata.llm.repeats import batches_of

BASE, PRIME = 1_000_003, (1 << 61) - 1         # of the rolling hash
TREE_NODES = 1 << 16                           # beyond, the common prefix is put out
KEEP, REROLE, DELETE, INSERT = (ord(c) for c in "KRDI")
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = {USER: b"user", ASSISTANT: b"assistant"}
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {b"su", b"ua", b"au"}
SPACES = b" \t\n\x0b\x0c\r"


class Audits:
    """A tree of edits: each node is the audit from the root to it."""

    def __init__(self, base: int = BASE, prime: int = PRIME):
        self.base, self.prime = base, prime
        self.edit, self.depth, self.hash = [0], [0], [0]
        self.up: list[list[int]] = [[0]]       # ancestors at distances 1, 2, 4, ...

    def add(self, parent: int, edit: int) -> int:
        node = len(self.edit)
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.base + edit) % self.prime)
        up, at = [parent], parent
        while at and len(self.up[at]) >= len(up):
            at = self.up[at][len(up) - 1]
            up.append(at)
        self.up.append(up)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            gap = self.depth[node] - depth
            node = self.up[node][min(gap.bit_length() - 1, len(self.up[node]) - 1)]
        return node

    def prefix(self, a: int, b: int) -> tuple[int, int]:
        """The deepest ancestors of one depth whose hashes are equal."""
        a, b = (self.ancestor(n, min(self.depth[a], self.depth[b])) for n in (a, b))
        while self.hash[a] != self.hash[b]:
            # the farthest pair of ancestors that still differs, else the parents
            for j in range(min(len(self.up[a]), len(self.up[b])) - 1, -1, -1):
                x, y = self.up[a][j], self.up[b][j]
                if j == 0 or self.hash[x] != self.hash[y]:
                    a, b = x, y
                    break
        return a, b

    def same(self, a: int, b: int) -> bool:
        """Are two audits of one depth equal? They are compared up to the node they share."""
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def text(self, node: int, above: int = 0) -> bytes:
        """The edits of an audit, from the depth ``above`` on."""
        out = bytearray()
        while self.depth[node] > above:
            out.append(self.edit[node])
            node = self.up[node][0]
        return bytes(reversed(out))

    def less(self, a: int, b: int) -> bool:
        if a == b:
            return False
        x, y = self.prefix(a, b)
        if not self.same(x, y):                # a collision
            return self.text(a) < self.text(b)
        depth = self.depth[x]
        if depth in (self.depth[a], self.depth[b]):
            return self.depth[a] < self.depth[b]
        return self.edit[self.ancestor(a, depth + 1)] < self.edit[self.ancestor(b, depth + 1)]


class Repair:
    """One conversation's rows in order, taken one at a time."""

    def __init__(self, tree_nodes: int = TREE_NODES, prime: int = PRIME):
        self.tree_nodes, self.prime = tree_nodes, prime
        self.audits = Audits(prime=prime)
        # state -> (cost, audit, digest of the repaired turns, has it turns)
        self.states = {START: (0, 0, hashlib.sha256(), False)}
        self.settled: list[bytes] = []
        self.insert()
        self.counts = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = None
        self.distinct = 0
        self.before: bytes | None = None

    def best(self, states: dict, state: int, cost: int, node: int, edit: int, digest, turns: bool, *turn: bytes
             ) -> None:
        """Take an edit into a state if it is the cheapest, or the least of the cheapest, so far."""
        known = states.get(state)
        if known and known[0] < cost:
            return
        new = self.audits.add(node, edit)
        if known and known[0] == cost and not self.audits.less(new, known[1]):
            return
        if turn:
            digest = digest.copy()
            digest.update(b"\n" + turn[0] if turns else turn[0])
            for part in turn[1:]:
                digest.update(part)
            turns = True
        states[state] = (cost, new, digest, turns)

    def insert(self) -> None:
        """Inserted turns; after these two steps another insertion cannot be cheaper."""
        for source in (START, SYSTEM, ASSISTANT, USER):
            if source in self.states:
                cost, node, digest, turns = self.states[source]
                state = FOLLOWS[source]
                self.best(self.states, state, cost + 2, node, INSERT, digest, turns, TURN[state] + b":")

    def row(self, turn: int | None, role: bytes, text: bytes, seen: bool) -> None:
        """The next row; ``seen`` says that an earlier one has its role and text."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        rest = text.rstrip(SPACES)
        blank, truncated = not rest, rest[-1:] not in (b".", b"!", b"?")
        fault = "blank" if blank else "duplicate" if seen else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        initial = role.decode("utf-8", "replace")[:1].encode()
        if self.before is not None and self.before + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = initial
        extra = int(fault == "truncated")
        after: dict = {}
        for state, (cost, node, digest, turns) in self.states.items():
            self.best(after, state, cost + 3, node, DELETE, digest, turns)
            if blank or seen:
                continue
            following = FOLLOWS[state]
            self.best(after, following, cost + 2 + extra, node, REROLE, digest, turns, TURN[following], b":", text)
            if initial == b"s" and state == START:
                following = SYSTEM
            elif initial != TURN[following][:1]:
                continue
            self.best(after, following, cost + extra, node, KEEP, digest, turns, role, b":", text)
        self.states = after
        self.insert()
        if len(self.audits.edit) > self.tree_nodes:
            self.settle()

    def settle(self) -> None:
        """Put out the edits that all states share, and keep the rest in a new tree."""
        old, heads = self.audits, [s[1] for s in self.states.values()]
        shared = heads[0]
        for head in heads[1:]:
            depth = min(old.depth[shared], old.depth[head])
            a, b = old.ancestor(shared, depth), old.ancestor(head, depth)
            while a != b:                      # the deepest common node, by lifting
                steps = range(min(len(old.up[a]), len(old.up[b])) - 1, -1, -1)
                j = next((j for j in steps if old.up[a][j] != old.up[b][j]), 0)
                a, b = old.up[a][j], old.up[b][j]
            shared = a
        depth = old.depth[shared]
        self.settled.append(old.text(shared))
        self.audits = Audits(prime=self.prime)
        made: dict[tuple[int, int], int] = {}          # (parent, edit): shared prefixes stay shared
        for state, (cost, node, digest, turns) in self.states.items():
            at = 0
            for edit in old.text(node, depth):
                if (at, edit) not in made:
                    made[at, edit] = self.audits.add(at, edit)
                at = made[at, edit]
            self.states[state] = (cost, at, digest, turns)
        # a tree that shares little grows until it has doubled
        self.tree_nodes = max(self.tree_nodes, 2 * len(self.audits.edit))

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of the repaired turns."""
        if self.low is not None:
            self.counts["gaps"] = self.high - self.low + 1 - self.distinct
        ends = [self.states[s] for s in (START, ASSISTANT) if s in self.states]
        best = ends[0]
        for end in ends[1:]:
            if end[0] < best[0] or end[0] == best[0] and self.audits.less(end[1], best[1]):
                best = end
        audit = b"".join(self.settled) + self.audits.text(best[1])
        return (*self.counts.values(), best[0], audit.decode(), best[2].hexdigest())


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
KINDS = [pa.int64()] * 6 + [pa.string()] * 2


def or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (ID, turn, role, TEXT, gone) with planted faults, by the checksum of ``id:turn``. Of a
    dropped row only its id stays (``gone``), for its conversation may have no other."""
    crc = F.crc32(F.concat(or_space(F.col(ID)), F.lit(":"), or_space(F.col("turn"))).cast("binary")) % 20
    text = F.when(F.col("crc") == 1, F.lit(""))
    bare = F.col(TEXT)
    for mark in ".!?":
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    text = text.when(F.col("crc") == 2, bare).when(F.col("crc") != 0, F.col(TEXT))
    times = F.when(F.col("crc") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (rows.withColumn("crc", crc).withColumn(TEXT, text)
            .withColumn("role", F.when(F.col("crc") == 4, F.lit("user")).otherwise(F.col("role")))
            .withColumn("gone", F.col("crc") == 0).withColumn("copy", F.explode(times))
            .select(ID, "turn", "role", TEXT, "gone"))


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", damage: bool = False) -> DataFrame:
    """One row for every conversation: counts of its faults, the cost and the audit of its cheapest
    repair, and the digest of the repaired turns. ``damage`` plants faults first."""
    ship(rows.sparkSession)
    rows = rows.select(F.col(f"`{id_col}`").alias(ID), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                       or_space(F.col(f"`{role_col}`")).alias("role"),
                       or_space(F.col(f"`{text_col}`")).alias(TEXT))
    rows = damaged(rows) if damage else rows.withColumn("gone", F.lit(False))
    # the same partitioning serves both orders: equal turns side by side, then turns in order
    alike = Window.partitionBy(ID).orderBy("gone", "role", TEXT, F.col("turn").asc_nulls_first())
    seen = ((F.lag("role").over(alike) == F.col("role")) & (F.lag(TEXT).over(alike) == F.col(TEXT))
            & ~F.lag("gone").over(alike))
    ordered = (rows.withColumn("seen", F.coalesce(seen, F.lit(False)))
               .sortWithinPartitions(F.col(ID).asc_nulls_first(), "gone", F.col("turn").asc_nulls_first(),
                                     "role", TEXT, "seen")
               .select(ID, "turn", F.col("role").cast("binary"), F.col(TEXT).cast("binary"), "gone", "seen"))
    kind = ordered.schema[ID].dataType.simpleString()

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at: object = None
        state: Repair | None = None
        for batch in batches:
            for conv, turn, role, text, gone, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != at:
                    if state is not None:
                        yield at, *state.result()
                    at, state = conv, Repair()
                if not gone:
                    state.row(turn, role, text, seen)
        if state is not None:
            yield at, *state.result()

    id_type = pa.int64() if kind == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of([ID, *FIELDS], [id_type, *KINDS], results(batches))

    schema = f"{ID} {kind}, " + ", ".join(f"{f} long" for f in FIELDS[:6]) + ", audit string, repaired_sha256 string"
    return ordered.mapInArrow(run, schema).withColumnRenamed(ID, id_col)
