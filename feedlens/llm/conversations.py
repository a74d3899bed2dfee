"""Conversation structure repair: cheapest edits by dynamic programming, ties by path ranking.

A conversation is repaired to the turns ``(s?(ua)+)?`` (system, then user and assistant in turn).
Nodes are ``(rows consumed, state)``; an arc keeps, re-roles or deletes the next row or inserts an
empty turn. After the cost DP only the arcs on cheapest paths are left, and nodes are ranked by the
audit letters of their next 1, 2, 4, 8 ... arcs: a rank of twice the length is the pair of the
node's own rank and that of the node its pointer leads to, and the pointers double too. The final
ranks choose each node's arc, and the doubled pointers read the path out.

A conversation may be larger than a task. Rows are sorted once by ranges, a hot conversation spans
several, and each sorted task cuts its rows into blocks. A block's arcs between its first and last
states make a 4 by 4 table of least costs; these tables are chained per conversation, backwards for
the cost still to come after each block and forwards for the state in which the path enters it. So
a block is repaired by itself, and only the text that is hashed passes in order. Conversations that
end within one block, nearly all, are finished in the sorting task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlens.llm.common import read_table, stored
from feedlens.llm.resample import CRC_TABLE, crc_sql
from feedlens.session import lookup_join, materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Audit letters in their order; 0 stands for the end of the audit.
LETTERS = "DIKR"
#: States: nothing yet, after system, after user, after assistant. The state after a turn of each
#: initial, and the role that an inserted or re-roled turn gets.
STATES = 4
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("user", "user", "assistant", "user")
#: Cost and audit of what is still to insert when the rows are used up in a state.
CLOSING = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60
BLOCK_ROWS, BLOCK_BYTES = 1024, 256 << 10
FAULTS = ("blank", "duplicate", "truncated")
_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_COUNTED = _fields(gaps=_LONG, blank=_LONG, duplicate=_LONG, truncated=_LONG, illegal=_LONG,
                   cost=_LONG)
_PLACE = _fields(conv_id=_LONG, part=_INT, block=_INT)
WHOLE = T.StructType([*_fields(conv_id=_LONG), *_COUNTED,
                      *_fields(audit=_TEXT, repaired_sha256=_TEXT)])
ORDER = ("no_conv", "conv", "has_turn", "turn_key", "role", "text_key", "row")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the seeded damage; null roles and texts are a blank.

    The remainder of crc32(``conv_id:turn``) by 20 decides, nulls written as a blank: 0 drops the
    row, 1 empties its text, 2 removes the signs ``.!?``, 3 repeats the row, 4 makes it the user's.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    hurt = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return conversations.select(
        "conv_id", "turn", hurt.alias("hurt"),
        F.when(hurt == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(hurt == 1, F.lit("")).when(hurt == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
    ).filter("hurt <> 0").withColumn(
        "copy", F.explode(F.when(F.col("hurt") == 3, F.array(F.lit(0), F.lit(1)))
                          .otherwise(F.array(F.lit(0))))).drop("hurt")


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows in stored form with their ``fault`` (see ``FAULTS``, else null) and the sort keys.

    Duplicates need the first place of each role and text in a conversation: a grouping that folds
    copies before its shuffle, joined back only for what occurs twice or more.
    """
    text = F.col("text")
    keyed = stored(rows.select(
        "conv_id", F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce("conv_id", F.lit(0)).alias("conv"), "turn",
        F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn_key"),
        "role", "text", F.sha2(text, 256).alias("text_key"),
        F.monotonically_increasing_id().alias("row")), "turns")
    same = ["no_conv", "conv", "role", "text_key"]
    place = F.struct("has_turn", "turn_key", "row")
    repeated = materialize(keyed.groupBy(*same).agg(F.min(place).alias("first"),
                                                    F.count("*").alias("n"))
                           .filter("n > 1").drop("n"), "repeated")
    marked = lookup_join(keyed, repeated, same, "left")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ends = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = (F.when(blank, 0).when(place > F.col("first"), 1).when(~ends, 2))
    return marked.withColumn("fault", fault.cast("int")).drop("first")


@dataclass
class Arcs:
    """Arcs of a block's graph: from node, letter (1 to 4), target, cost; nodes count by rows."""

    source: np.ndarray
    letter: np.ndarray
    target: np.ndarray
    cost: np.ndarray


def row_arcs(initials: list[str], faults: list[int | None]) -> Arcs:
    """All arcs of a run of rows; node ``STATES * i + state`` stands before row i."""
    found = []
    for i, (initial, fault) in enumerate(zip(initials, faults, strict=True)):
        here, after = STATES * i, STATES * (i + 1)
        more = TRUNCATED if fault == 2 else 0
        for state in range(STATES):
            found.append((here + state, 1, after + state, DELETE))
            goal = NEXT[state][WANTED[state][0]]
            found.append((here + state, 2, here + goal, INSERT))
            if fault in (0, 1):
                continue
            if initial in NEXT[state]:
                found.append((here + state, 3, after + NEXT[state][initial], KEEP + more))
            found.append((here + state, 4, after + goal, REROLE + more))
    columns = np.array(found, np.int64).reshape(-1, 4).T
    return Arcs(*columns)


def least_costs(arcs: Arcs, n_rows: int, end: np.ndarray) -> np.ndarray:
    """Least cost from each node, given those of the last row's end; several columns at once.

    Rows are worked off backwards; within a row, inserts lead to another state before the row, at
    most two after each other on a cheapest path.
    """
    cost = np.full((STATES * (n_rows + 1), end.shape[1]), FAR, np.int64)
    cost[STATES * n_rows:] = end
    bounds = np.searchsorted(arcs.source, STATES * np.arange(n_rows + 1))
    insert = arcs.letter == 2
    for i in range(n_rows - 1, -1, -1):
        part = slice(bounds[i], bounds[i + 1])
        source, target, price, added = (arcs.source[part], arcs.target[part],
                                        arcs.cost[part, None], insert[part])
        for chosen in (~added, added, added):
            np.minimum.at(cost, source[chosen], cost[target[chosen]] + price[chosen])
    return cost


class Repair:
    """The least cheapest path through a block, from any state before its first row."""

    def __init__(self, initials: list[str], faults: list[int | None], end: list[int]):
        self.n = len(initials)
        arcs = row_arcs(initials, faults)
        self.cost = least_costs(arcs, self.n, np.array(end, np.int64)[:, None])[:, 0]
        best = self.cost[arcs.source] == self.cost[arcs.target] + arcs.cost
        self._rank(arcs.source[best], arcs.letter[best], arcs.target[best])

    def _rank(self, source: np.ndarray, letter: np.ndarray, target: np.ndarray) -> None:
        """Prefix doubling over the arcs of cheapest paths; nodes after the last row are ends.

        A letter leads from a node to one node only, so the least letter already tells where a
        node's least audit goes on; the final ranks choose among all its arcs, and would also tell
        arcs of one letter apart.
        """
        nodes = STATES * (self.n + 1)
        rank, pointer = np.zeros(nodes, np.int64), np.arange(nodes)
        self.letter, reach = np.zeros(nodes, np.int64), 3 * self.n + 1

        def least(keys) -> np.ndarray:
            order = np.lexsort(keys)
            return order[np.unique(source[order], return_index=True)[1]]

        first = least((letter, source))
        rank[source[first]], pointer[source[first]] = letter[first], target[first]
        length = 1
        while length < reach:  # a row has two inserts and one arc of its own at most
            pairs = rank * (rank.max() + 1) + rank[pointer]
            rank = np.unique(pairs, return_inverse=True)[1]
            pointer, length = pointer[pointer], 2 * length
        chosen = least((rank[target], letter, source))
        pointer = np.arange(nodes)
        pointer[source[chosen]], self.letter[source[chosen]] = target[chosen], letter[chosen]
        self.pointers = [pointer]
        while 1 << len(self.pointers) <= reach:
            self.pointers.append(self.pointers[-1][self.pointers[-1]])

    def path(self, state: int) -> tuple[str, list[tuple[str, int, int]], int]:
        """Audit letters, edits ``(letter, row, state before)`` and the state at the end."""
        nodes = np.array([state])
        for pointer in self.pointers:
            nodes = np.concatenate([nodes, pointer[nodes]])
            if self.letter[nodes[-1]] == 0:
                break
        # doubling lists node, next, then both shifted by two, and so on: in path order
        nodes = nodes[:np.flatnonzero(self.letter[nodes] == 0)[0] + 1]
        letters = [LETTERS[k - 1] for k in self.letter[nodes[:-1]]]
        edits = [(k, int(v) // STATES, int(v) % STATES)
                 for k, v in zip(letters, nodes[:-1], strict=True)]
        return "".join(letters), edits, int(nodes[-1]) % STATES


def repaired_lines(edits: list[tuple[str, int, int]], roles: list[str],
                   texts: list[str]) -> list[str]:
    """``role:text`` of each turn that the edits leave or make."""
    lines = []
    for letter, row, state in edits:
        if letter == "K":
            lines.append(f"{roles[row]}:{texts[row]}")
        elif letter == "R":
            lines.append(f"{WANTED[state]}:{texts[row]}")
        elif letter == "I":
            lines.append(f"{WANTED[state]}:")
    return lines


def closing(state: int) -> tuple[str, list[str]]:
    """Audit and turns that end a conversation whose rows are used up in ``state``."""
    lines = [f"{role}:" for role in {1: ("user", "assistant"), 2: ("assistant",)}.get(state, ())]
    return "I" * len(lines), lines


@dataclass
class Counts:
    """What two adjacent runs of rows of one conversation add up to."""

    faults: list[int]
    illegal: int
    first: str
    last: str
    turns: list[int]  # lowest, highest and number of distinct turns; empty without any

    @classmethod
    def of(cls, turns, roles, faults) -> Counts:
        initials = [r[:1] for r in roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        known = {t for t in turns if t is not None}
        return cls([sum(f == k for f in faults) for k in range(3)], illegal, initials[0],
                   initials[-1], [min(known), max(known), len(known)] if known else [])

    def then(self, other: Counts) -> Counts:
        illegal = self.illegal + other.illegal + (self.last + other.first not in ("su", "ua", "au"))
        turns = self.turns or other.turns
        if self.turns and other.turns:
            (low, a, n), (b, high, m) = self.turns, other.turns
            turns = [low, high, n + m - (a == b)]
        return Counts([a + b for a, b in zip(self.faults, other.faults, strict=True)], illegal,
                      self.first, other.last, turns)

    def gaps(self) -> int:
        return self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0


def whole_row(conv_id, counts: Counts, cost: int, audit: str, digest: str) -> list:
    return [conv_id, counts.gaps(), *counts.faults, counts.illegal, cost, audit, digest]


def finished(conv_id, turns, roles, texts, faults) -> list:
    """The result of a conversation that lies in one block."""
    work = Repair([r[:1] for r in roles], faults, list(CLOSING))
    audit, edits, state = work.path(0)
    more, lines = closing(state)
    text = "\n".join(repaired_lines(edits, roles, texts) + lines)
    return whole_row(conv_id, Counts.of(turns, roles, faults), int(work.cost[0]), audit + more,
                     hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


_BLOCK = _fields(turns=T.ArrayType(_LONG), roles=T.ArrayType(_TEXT), texts=T.ArrayType(_TEXT),
                 faults=T.ArrayType(_INT))
_SORTED = T.StructType([*WHOLE, *_fields(part=_INT, block=_INT), *_BLOCK])
_TABLE = T.StructType([*_PLACE, *_fields(costs=T.ArrayType(_LONG), n=T.ArrayType(_LONG),
                                         first=_TEXT, last=_TEXT, turns=T.ArrayType(_LONG))])
_CHAINED = T.StructType([*_PLACE, *_fields(after=T.ArrayType(_LONG), last_block=T.BooleanType()),
                         *_COUNTED])
_EXITS = T.StructType([*_PLACE, *_fields(exits=T.ArrayType(_INT))])
_ENTERED = T.StructType([*_PLACE, *_fields(state=_INT)])
_PIECES = T.StructType([*_PLACE, *_fields(audit=_TEXT, piece=T.BinaryType())])


def _record(rows: list, schema: T.StructType) -> pa.RecordBatch:
    """Rows (sequences in the order of ``schema``) as an Arrow batch."""
    fields = to_arrow_schema(schema)
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def _cut(block_rows: int):
    """Sorted rows to finished conversations and, for those that may go on, blocks.

    The first and the last conversation of a task may have rows in other tasks, and one of more
    than a block's rows or bytes has several blocks; all others are finished here. At most one
    block is held.
    """
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out, waiting, held, size = [], 0, ([], [], [], []), 0
        conv, block, edge, started = None, 0, True, False

        def close(whole: bool) -> None:
            nonlocal held, size, block, waiting
            if held[0]:
                if whole and block == 0:
                    out.append([*finished(conv, held[0], held[1], held[2], held[3]), *[None] * 6])
                else:
                    out.append([conv, *[None] * 8, part, block, *held])
                    waiting += size
                block += 1
            held, size = ([], [], [], []), 0

        for batch in batches:
            for conv_id, *row in zip(*[batch.column(k).to_pylist() for k in
                                       ("conv_id", "turn", "role", "text", "fault")], strict=True):
                if started and conv_id != conv:
                    close(not edge)
                    block, edge = 0, False
                elif len(held[0]) >= block_rows or size >= BLOCK_BYTES:
                    close(False)
                conv, started = conv_id, True
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                size += len(row[2])
                if len(out) >= 2000 or waiting >= 16 * BLOCK_BYTES:
                    yield _record(out, _SORTED)
                    out, waiting = [], 0
        close(False)
        if out:
            yield _record(out, _SORTED)
    return run


def _tables(batches):
    """Per block the least costs from and to each state, and its counts."""
    far = np.full((STATES, STATES), FAR, np.int64)
    np.fill_diagonal(far, 0)
    for batch in batches:
        rows = {k: batch.column(k).to_pylist() for k in batch.schema.names}
        out = []
        for *place, turns, roles, faults in zip(*[rows[k] for k in (
                "conv_id", "part", "block", "turns", "roles", "faults")], strict=True):
            arcs = row_arcs([r[:1] for r in roles], faults)
            costs = least_costs(arcs, len(roles), far)[:STATES]
            c = Counts.of(turns, roles, faults)
            out.append([*place, costs.ravel().tolist(), [*c.faults, c.illegal], c.first, c.last,
                        c.turns])
        yield _record(out, _TABLE)


def _chain(table: pa.Table) -> pa.Table:
    """One conversation's block tables, to the cost after each block and its counts."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["block"]))
    after, ends = np.array(CLOSING, np.int64), []
    for row in reversed(rows):
        ends.append(after.tolist())
        costs = np.array(row["costs"], np.int64).reshape(STATES, STATES)
        after = np.minimum(costs + after, FAR).min(axis=1)
    total = None
    for row in rows:
        c = Counts(row["n"][:3], row["n"][3], row["first"], row["last"], row["turns"])
        total = total.then(c) if total else c
    counted = [total.gaps(), *total.faults, total.illegal, int(after[0])]
    return pa.Table.from_batches([_record(
        [[r["conv_id"], r["part"], r["block"], end, i == len(rows) - 1, *counted]
         for i, (r, end) in enumerate(zip(rows, reversed(ends), strict=True))], _CHAINED)])


def _exits(batches):
    """Per block the state at its end for each state at its start, on least cheapest paths."""
    for batch in batches:
        rows = batch.to_pylist()
        made = [Repair([x[:1] for x in r["roles"]], r["faults"], r["after"]) for r in rows]
        exits = [[w.path(s)[2] if w.cost[s] < FAR else 0 for s in range(STATES)] for w in made]
        yield _record([[r["conv_id"], r["part"], r["block"], e]
                       for r, e in zip(rows, exits, strict=True)], _EXITS)


def _enter(table: pa.Table) -> pa.Table:
    """The state in which the path of one conversation enters each of its blocks."""
    rows, state, entered = table.to_pylist(), 0, []
    for row in sorted(rows, key=lambda r: (r["part"], r["block"])):
        entered.append([row["conv_id"], row["part"], row["block"], state])
        state = row["exits"][state]
    return pa.Table.from_batches([_record(entered, _ENTERED)])


def _pieces(batches):
    """Per block its part of the audit and of the repaired text, each turn ended by a newline."""
    for batch in batches:
        for r in batch.to_pylist():
            work = Repair([x[:1] for x in r["roles"]], r["faults"], r["after"])
            audit, edits, state = work.path(r["state"])
            lines = repaired_lines(edits, r["roles"], r["texts"])
            if r["last_block"]:
                more, added = closing(state)
                audit, lines = audit + more, lines + added
            piece = "".join(line + "\n" for line in lines).encode("utf-8", "surrogatepass")
            yield _record([[r["conv_id"], r["part"], r["block"], audit, piece]], _PIECES)


def _hashed(batches):
    """Sorted pieces, streamed, to one audit and digest per conversation."""
    conv, digest, audit, tail, started = None, hashlib.sha256(), [], b"", False
    schema = _fields(conv_id=_LONG, audit=_TEXT, repaired_sha256=_TEXT)

    def result():
        digest.update(tail[:-1])
        return _record([[conv, "".join(audit), digest.hexdigest()]], schema)

    for batch in batches:
        for conv_id, letters, piece in zip(*[batch.column(k).to_pylist() for k in
                                             ("conv_id", "audit", "piece")], strict=True):
            if started and conv_id != conv:
                yield result()
                digest, audit, tail = hashlib.sha256(), [], b""
            conv, started = conv_id, True
            audit.append(letters)
            if piece:  # the last newline is only known to be one between turns when more follows
                digest.update(tail)
                tail = piece
    if started:
        yield result()


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Counts of faults and the cheapest repair of every conversation (see ``WHOLE``).

    Reads ``conv_id``, ``turn``, ``role`` and ``text`` of undamaged or damaged rows. Rows are taken
    by turn, nulls first, rows of one turn by role and text hash; a null ``conv_id`` is a
    conversation of its own; null texts and roles must be filled before (see ``damaged``). Every
    turn counts by the first character of its role. A row with a first fault ``blank`` or
    ``duplicate`` must be deleted. An empty table gives no rows. ``block_rows`` changes no result.
    """
    marked = with_faults(conversations)
    cut = (marked.select("conv_id", "turn", "fault", "text", *ORDER)
           .repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
           .select("conv_id", "turn", "role", "text", "fault").mapInArrow(_cut(block_rows), _SORTED))
    cut = stored(cut, "cut")
    done = cut.filter("audit IS NOT NULL").select(*WHOLE.names)
    open_ = cut.filter("audit IS NULL").select("conv_id", "part", "block", *_BLOCK.names)
    keys = ["conv_id", "part", "block"]
    tables = open_.drop("texts").mapInArrow(_tables, _TABLE)
    chained = materialize(tables.groupBy("conv_id").applyInArrow(_chain, _CHAINED), "chained")
    spans = materialize(chained.table.select(*keys, "after", "last_block"), "spans")

    def joined(blocks: DataFrame, to) -> DataFrame:
        to = to.table.withColumnsRenamed({k: f"{k}_" for k in keys})
        on = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
        return blocks.join(to, on).drop(*[f"{k}_" for k in keys])

    exits = joined(open_.drop("texts", "turns"), spans).mapInArrow(_exits, _EXITS)
    states = materialize(exits.groupBy("conv_id").applyInArrow(_enter, _ENTERED), "entered")
    pieces = joined(joined(open_.drop("turns"), spans), states).mapInArrow(_pieces, _PIECES)
    hashed = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
              .mapInArrow(_hashed, "conv_id long, audit string, repaired_sha256 string"))
    counted = chained.table.filter("last_block").select(*WHOLE.names[:7])
    result = counted.withColumnRenamed("conv_id", "c").join(
        hashed, F.col("c").eqNullSafe(F.col("conv_id"))).select(*WHOLE.names)
    return done.unionByName(result)


def audit_conversations(conversations: DataFrame) -> DataFrame:
    """One row per original ``conv_id``: damage as in ``damaged``, then ``repair``.

    A conversation of which no row is left has zeros, an empty audit and the hash of no text.
    Other columns are not read.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    fixed = repair(damaged(rows)).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct()
    empty = hashlib.sha256(b"").hexdigest()
    fill = {n: 0 for n in WHOLE.names[1:7]} | {"audit": "", "repaired_sha256": empty}
    return (every.join(fixed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select(*WHOLE.names).fillna(fill))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation."""
    return audit_conversations(read_table(spark, sf_dir, "conversations"))


def _add(state: str, cost: str, letter: str, line: str) -> str:
    """DuckDB's SQL for a state (nine digits of cost, audit, chr(1), lines) with one more edit."""
    return (f"(lpad((substr({state}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || "
            f"substr({state}, 10, instr({state}, chr(1)) - 10) || '{letter}' || chr(1) || "
            f"substr({state}, instr({state}, chr(1)) + 1) || {line})")


def _step_sql() -> str:
    """The states after a row, from ``j0`` to ``j3`` after inserts before it."""
    arrivals = {q: [_add(f"j{q}", str(DELETE), "D", "''")] for q in range(STATES)}
    for q in range(STATES):
        for initial, goal in NEXT[q].items():
            arrivals[goal].append(f"CASE WHEN ini = '{initial}' AND may THEN "
                                  + _add(f"j{q}", "more", "K", "role || ':' || text || chr(10)")
                                  + " END")
        arrivals[NEXT[q][WANTED[q][0]]].append(
            "CASE WHEN may THEN " + _add(f"j{q}", f"{REROLE} + more", "R",
                                         f"'{WANTED[q]}:' || text || chr(10)") + " END")
    return ", ".join(f"least({', '.join([*arrivals[q], 'NULL'])}) AS s{q}" for q in range(STATES))


def _insert_sql(state: str, role: str) -> str:
    return _add(state, str(INSERT), "I", f"'{role}:' || chr(10)")


SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
named AS (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, row_number() OVER () AS r,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
    FROM conversations),
hurt AS (SELECT c, r, turn, {crc_sql('name')} % 20 AS h, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text FROM named, crc),
damaged AS (SELECT c, r, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hurt WHERE h <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role,
    sha256(text), r, copy) AS i FROM damaged),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 0
        WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 1
        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 2 END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY i) || substr(role, 1, 1) AS pair
    FROM ordered),
turns AS (SELECT c, i, substr(role, 1, 1) AS ini, role, text, coalesce(fault, 3) > 1 AS may,
    CASE WHEN fault = 2 THEN {TRUNCATED} ELSE 0 END AS more FROM faulty),
counted AS (SELECT c, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 0) AS blank, count(*) FILTER (fault = 1) AS duplicate,
    count(*) FILTER (fault = 2) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY c),
paths AS (
    SELECT c, 0::BIGINT AS i, '000000000' || chr(1) AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2,
        NULL::VARCHAR AS s3 FROM counted
    UNION ALL
    SELECT c, i, {_step_sql()} FROM (
        SELECT *, least(s3, {_insert_sql('j2', 'assistant')}) AS j3 FROM (
            SELECT t.*, s0 AS j0, s1 AS j1, s3, least(s2, {_insert_sql('s0', 'user')},
                {_insert_sql('s1', 'user')}, {_insert_sql('s3', 'user')}) AS j2
            FROM paths JOIN turns t ON t.c = paths.c AND t.i = paths.i + 1))),
ended AS (SELECT c, least(s0, s3, {_add('s2', str(CLOSING[2]), 'I', "'assistant:' || chr(10)")},
    {_add('s1', str(CLOSING[1]), 'II', "'user:' || chr(10) || 'assistant:' || chr(10)")}) AS best
    FROM paths JOIN counted USING (c) WHERE i = n)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(substr(best, 1, 9)::BIGINT, 0) AS cost,
    coalesce(substr(best, 10, instr(best, chr(1)) - 10), '') AS audit,
    sha256(coalesce(substr(best, instr(best, chr(1)) + 1, greatest(
        length(best) - instr(best, chr(1)) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM named) LEFT JOIN counted USING (c) LEFT JOIN ended USING (c)
"""
