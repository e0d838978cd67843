"""Conversation structure repair by generalised LR parsing with edits.

A conversation is well formed when the initials of its roles follow `GRAMMAR`:
nothing, or an optional system turn and then pairs of user and assistant.
`lr_table` turns the grammar into LR tables. `Parser` reads the turns with a
graph-structured stack: every stack is its top state on a shared lower stack,
and for each row it may keep the turn, rerole or delete it, and insert empty
turns before it, each at a cost. Stacks that are equal merge, the one with the
lowest (cost, audit) staying, audit being the edits' initials so far. What two
equal stacks would do next is the same, and of two audits of one cost neither
begins the other, as an insertion more would cost more; so the merge loses
nothing. The grammar is left-recursive, so stacks are at most four states deep
and a row is done in constant time.

On Spark the rows are partitioned by conversation and sorted by turn; a task
reads them as a stream and keeps the parser's few stacks of the conversation at
hand, with a small linked node per edit, but no texts. A second stream applies
the audits to the texts. So a conversation with a third of all rows takes one
task's time, as its digest over the text in order does anyway, but no more
memory than its audit.

Defined cases: a null role or text counts as one space, as does a null conv_id
or turn in the damage key; rows of a null conv_id are one conversation; null
turns come first; rows of one turn are ordered by role and text; a role whose
initial is none of the grammar's can be reroled or deleted only; conversations
without rows after damage give zeros and empty results; other columns are
ignored; an empty table gives no rows. Gaps are held at the largest long.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import stage

#: Productions (head, body); lower-case letters are role initials.
GRAMMAR = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "TP"), ("T", "P"), ("P", "ua"))
ROLES = {"u": "user", "a": "assistant"}  # roles that edits may give
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs; the last one for a truncated turn that stays
SPACE = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3

END, MOST = "$", (1 << 63) - 1


@lru_cache
def lr_table(grammar: tuple = GRAMMAR) -> tuple[dict, dict, int]:
    """(moves, reductions, accepting state): moves[state, symbol] is a state, reductions[state, lookahead] a tuple of (head, length)."""
    rules = (("^", grammar[0][0]), *grammar)
    heads = {h for h, _ in rules}
    empty, first, follow = set(), {h: set() for h in heads}, {h: set() for h in heads}
    follow["^"].add(END)
    size = -1
    while size != (size := len(empty) + sum(map(len, (*first.values(), *follow.values())))):
        for head, body in rules:
            if all(x in empty for x in body):
                empty.add(head)
            for i, x in enumerate(body):
                if all(y in empty for y in body[:i]):
                    first[head] |= first.get(x, {x})
                if x in heads:
                    rest = body[i + 1:]
                    for j, y in enumerate(rest):
                        if all(z in empty for z in rest[:j]):
                            follow[x] |= first.get(y, {y})
                    if all(y in empty for y in rest):
                        follow[x] |= follow[head]

    def closed(items):
        items = set(items)
        while True:
            more = {(k, 0) for r, dot in items for k, (h, _) in enumerate(rules) if rules[r][1][dot:dot + 1] == h} - items
            if not more:
                return frozenset(items)
            items |= more

    states, moves = [closed({(0, 0)})], {}
    for i, state in enumerate(states):  # grows while it is read
        for x in sorted({rules[r][1][dot] for r, dot in state if dot < len(rules[r][1])}):
            nxt = closed({(r, dot + 1) for r, dot in state if rules[r][1][dot:dot + 1] == x})
            if nxt not in states:
                states.append(nxt)
            moves[i, x] = states.index(nxt)
    reductions = {}
    for i, state in enumerate(states):
        for r, dot in sorted(state):
            if r and dot == len(rules[r][1]):
                for look in follow[rules[r][0]]:
                    reductions[i, look] = (*reductions.get((i, look), ()), (rules[r][0], dot))
    return moves, reductions, moves[0, grammar[0][0]]


#: Audits are chains (length, all but the last letter, last letter, jump): equal audits are one chain, and the jumps, of
#: lengths that depend on the length alone, find where two chains part in logarithmic time.
EMPTY = (0, None, "", None)


def _linked(chain: tuple, letter: str) -> tuple:
    jump = chain[3]
    far = jump and jump[3]
    return chain[0] + 1, chain, letter, far if far and chain[0] - jump[0] == jump[0] - far[0] else chain


def _cut(chain: tuple, length: int) -> tuple:
    while chain[0] > length:
        chain = chain[3] if chain[3][0] >= length else chain[1]
    return chain


def _less(a: tuple, b: tuple) -> bool:
    """Whether path a = (cost, audit) goes before path b."""
    if a[0] != b[0]:
        return a[0] < b[0]
    x, y = _cut(a[1], b[1][0]), _cut(b[1], a[1][0])
    if x is y:
        return a[1][0] < b[1][0]
    while x[1] is not y[1]:
        x, y = (x[3], y[3]) if x[3] is not y[3] else (x[1], y[1])
    return x[2] < y[2]


class Parser:
    """Reads one conversation's turns; `result()` is the cheapest (cost, audit)."""

    def __init__(self, grammar: tuple = GRAMMAR):
        self.moves, self.reductions, self.accepting = lr_table(grammar)
        self.known: dict = {}   # what a stack becomes by a symbol: stacks are few and recur
        self.front = {(0, None): (0, EMPTY)}

    def _reduced(self, stack: tuple, look: str) -> list[tuple]:
        out, todo = [], [stack]
        while todo:
            top = todo.pop()
            out.append(top)
            for head, n in self.reductions.get((top[0], look), ()):
                under = top
                for _ in range(n):
                    under = under[1]
                todo.append((self.moves[under[0], head], under))
        return out

    def _shifted(self, stack: tuple, x: str) -> list[tuple]:
        if (stack, x) not in self.known:
            self.known[stack, x] = [(self.moves[top[0], x], top) for top in self._reduced(stack, x) if (top[0], x) in self.moves]
        return self.known[stack, x]

    @staticmethod
    def _offer(front: dict, stack: tuple, path: tuple) -> bool:
        if stack in front and not _less(path, front[stack]):
            return False
        front[stack] = path
        return True

    @staticmethod
    def _step(path: tuple, letter: str, cost: int, made: dict) -> tuple:
        """`path` with one edit more; equal audits stay one chain."""
        chain = path[1]
        at = (id(chain), letter)
        if at not in made:
            made[at] = _linked(chain, letter)
        return path[0] + cost, made[at]

    def _insert(self) -> None:
        made: dict = {}
        todo = list(self.front)
        while todo:  # an insertion always costs, so this ends
            stack = todo.pop(0)
            for x in ROLES:
                for nxt in self._shifted(stack, x):
                    if self._offer(self.front, nxt, self._step(self.front[stack], "I", INSERT, made)):
                        todo.append(nxt)

    def read(self, initial: str, fault: int) -> None:
        self._insert()
        made, front = {}, {}
        more = TRUNCATED if fault == CUT else 0
        for stack, path in self.front.items():
            self._offer(front, stack, self._step(path, "D", DELETE, made))
            if fault in (BLANK, DUPLICATE):
                continue
            for nxt in self._shifted(stack, initial) if len(initial) == 1 and initial.islower() else ():
                self._offer(front, nxt, self._step(path, "K", KEEP + more, made))
            for x in ROLES:
                if x != initial:
                    for nxt in self._shifted(stack, x):
                        self._offer(front, nxt, self._step(path, "R", REROLE + more, made))
        self.front = front

    def result(self) -> tuple[int, str]:
        self._insert()
        best: dict = {}
        for stack, path in self.front.items():
            if any(top[0] == self.accepting for top in self._reduced(stack, END)):
                self._offer(best, (), path)
        cost, chain = best[()]
        letters = []
        while chain[0]:
            letters.append(chain[2])
            chain = chain[1]
        return cost, "".join(reversed(letters))


# ------------------------------------------------------------------ on Spark
def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage; a dropped row stays as a mark of its conversation (gone = true, empty role and text)."""
    at = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn"),
                                F.coalesce(conversations["role"], F.lit(" ")).alias("role"), F.coalesce(conversations["text"], F.lit(" ")).alias("text"))
    rows = rows.withColumn("harm", F.crc32(F.concat(at("conv_id"), F.lit(":"), at("turn"))) % 20)
    gone, harm = F.col("harm") == 0, F.col("harm")
    text = F.when(gone | (harm == 1), "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(gone, "").when(harm == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), gone.alias("gone"), F.when(harm == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("time", "times")


def intact(conversations: DataFrame) -> DataFrame:
    """Rows as they are, in the form of `damaged`."""
    return conversations.select(conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn"),
                                F.coalesce(conversations["role"], F.lit(" ")).alias("role"), F.coalesce(conversations["text"], F.lit(" ")).alias("text"), F.lit(False).alias("gone"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds `pos` (place in the conversation), `initial` and `fault` (FINE, BLANK, DUPLICATE or CUT)."""
    turn = F.asc_nulls_first("turn")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(turn)
    order = Window.partitionBy("conv_id").orderBy("gone", turn, "role", "text")
    # One exchange by conversation serves both windows.
    rows = rows.repartition("conv_id").withColumn("nth", F.row_number().over(same)).withColumn("pos", F.row_number().over(order).cast("long"))
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    fault = F.when(last == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(~last.isin(".", "!", "?"), CUT).otherwise(FINE)
    return rows.select("conv_id", "pos", "turn", "gone", "role", "text", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LEGAL = ("su", "ua", "au")


def audits(faulty: DataFrame) -> DataFrame:
    """One row per conversation: its faults and the cheapest edits."""
    rows = faulty.select("conv_id", "pos", "turn", "gone", "initial", "fault").repartition("conv_id").sortWithinPartitions("conv_id", "pos")

    def run(batches):
        held = object()          # the conversation at hand
        parser, counts, turns, before, illegal = None, None, None, "", 0

        def closed():
            cost, audit = parser.result()
            low, high, n = turns
            gaps = 0 if low is None else min(high - low + 1 - n, MOST)
            return held, gaps, counts[BLANK], counts[DUPLICATE], counts[CUT], illegal, cost, audit
        for batch in batches:
            done = []
            for conv, turn, gone, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "gone", "initial", "fault"))):
                if conv != held:
                    if parser:
                        done.append(closed())
                    held, parser, counts, turns, before, illegal = conv, Parser(), [0] * 4, (None, None, 0), "", 0
                if gone:
                    continue
                parser.read(initial, fault)
                counts[fault] += 1
                illegal += bool(before) and before + initial not in _LEGAL
                before = initial or " "
                if turn is not None:
                    low, high, n = turns
                    turns = (turn if low is None else low, turn, n + (turn != high))
            yield _table(done)
        if parser:
            yield _table([closed()])
    return rows.mapInArrow(run, AUDIT)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in AUDIT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if n == "audit" else pa.int64()) for i, n in enumerate(names)], names=names)


def edits(audit: str, at: int, before: str) -> tuple[list[tuple[str, str]], int, str]:
    """(insertions, the place after them, the initial before) of an audit from place `at` on."""
    out = []
    while at < len(audit) and audit[at] == "I":
        before = "a" if before == "u" else "u"
        out.append((ROLES[before], ""))
        at += 1
    return out, at, before


def repaired(faulty: DataFrame, audit: DataFrame, digest: bool = False) -> DataFrame:
    """The repaired turns (conv_id, place, role, text), or with `digest` one row (conv_id, repaired_sha256) per conversation."""
    marks = audit.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    rows = faulty.where("NOT gone").select("conv_id", "pos", "role", "text", F.lit(None).cast("string").alias("audit"))
    rows = marks.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "pos")

    def run(batches):
        held, audit, at, before, place, sha = None, None, 0, "", 0, None

        def put(turns, out):
            nonlocal place
            for role, text in turns:
                if digest:
                    sha.update((b"\n" if place else b"") + f"{role}:{text}".encode())
                else:
                    out.append((held, place, role, text))
                place += 1

        def closed(out):
            if audit is not None:
                put(edits(audit, at, before)[0], out)
                if digest:
                    out.append((held, sha.hexdigest()))
        for batch in batches:
            out: list[tuple] = []
            for conv, pos, role, text, mark in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "pos", "role", "text", "audit"))):
                if pos == 0:
                    closed(out)
                    held, audit, at, before, place, sha = conv, mark, 0, "", 0, hashlib.sha256()
                    continue
                new, at, before = edits(audit, at, before)
                put(new, out)
                letter, at = audit[at], at + 1
                if letter == "R":
                    before = "a" if before == "u" else "u"
                    role = ROLES[before]
                if letter != "D":
                    put([(role, text)], out)
                    before = role[:1]
            yield _rows(out)
        out = []
        closed(out)
        yield _rows(out)

    schema = "conv_id long, repaired_sha256 string" if digest else "conv_id long, place long, role string, text string"

    def _rows(out):
        kinds = [(n, pa.int64() if t == "long" else pa.string()) for n, t in (x.split() for x in schema.split(", "))]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])
    return rows.mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with faults, audits) of `damaged` or `intact` rows, both staged."""
    faulty = stage(with_faults(rows), "turns")
    return faulty, stage(audits(faulty), "audits")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    faulty, audit = repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    digests = repaired(faulty, audit, digest=True).withColumnRenamed("conv_id", "_conv")
    return audit.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
