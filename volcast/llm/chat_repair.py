r"""Chat formatting: minimum-cost role repair over an automaton of legal turns, then rendering.

Legal is: at most one system turn, first; then user and assistant in turn; an assistant at the end.
A turn keeps its role or is relabelled, and it is joined to the turn before (same role) or
appended, with empty turns put in where the automaton needs them.  The cheapest repair is found by
dynamic programming over the automaton's four states.

A conversation may be very long, so its turns are numbered (by range splits of the whole table, so that null or repeated
turn numbers are no single task) and cut into chunks of that number.  A chunk's effect is a small matrix (cheapest
cost from each state to each state).  Matrices are multiplied up a tree of ``fan`` children a node, and the chosen
states at the borders go back down it to the chunks, which retrace their own turns.
The programme works on roles alone; the texts are joined to the decisions afterwards.  Of repairs that cost
the same, a conversation of one chunk always gets the same one; another chunk length may choose another.

A marker inside a turn's text could forge a turn, so it is escaped: ``<|im_start|>`` becomes ``<\|im_start|>``, and every
backslash already there stays and gets one more before it, which :func:`unescaped` takes away again.

The result has one row per piece, so that no conversation or joined turn is ever held whole:
the pieces of a conversation in the order of ``chunk, seq`` are its rendered text.

Defined cases: a null text is empty; an unknown or null role may become any role at the low cost
``unknown``; turns with the same number go by role and text; rows equal in all four columns count
once; null turn numbers come first; a null conversation id is a conversation of its own; an empty
table gives no rows; a text of any length moves once, whole; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volcast.llm.common import written
from volcast.operators.series import number_rows

ROLES = ("", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
NO_WAY = 1 << 40
CHUNK, FAN = 512, 256
MARKER = r"<(\\*)\|(im_start|im_end)\|>"


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    unknown: int = 1
    relabel: int = 2
    insert: int = 3


def _empties(state: int, role: int) -> tuple[int, ...] | None:
    """The roles to put in between ``state`` and a new turn of ``role`` (None: impossible)."""
    queue = deque([(state, ())])
    while queue:
        at, path = queue.popleft()
        for nxt in NEXT[at]:
            if nxt == role:
                return path
            if len(path) < 3:
                queue.append((nxt, (*path, nxt)))
    return None


EMPTIES = {(s, r): _empties(s, r) for s in range(4) for r in (SYSTEM, USER, ASSISTANT)}
#: Empty turns that close a conversation in each state.
CLOSING = {START: (), ASSISTANT: (), **{s: (*EMPTIES[s, ASSISTANT], ASSISTANT) for s in (SYSTEM, USER)}}


def moves(own: int, costs: Costs) -> list[list[tuple[int, int, bool]]]:
    """Per state: (cost, new role, joined) of every way to take a turn whose own role is ``own`` (0: unknown).
    Cheap and plain ways come first, so equal costs have one fixed choice."""
    out = []
    for state in range(4):
        ways = []
        for role in sorted((SYSTEM, USER, ASSISTANT), key=lambda r: (r != own, r)):
            change = 0 if role == own else costs.relabel if own else costs.unknown
            between = EMPTIES[state, role]
            if between is not None:
                ways.append((change + costs.insert * len(between), role, False))
            if role == state:
                ways.append((change + costs.merge, role, True))
        out.append(sorted(ways, key=lambda w: w[0]))
    return out


def run_turns(owns: list[int], enter: int, costs: Costs) -> list[list[tuple[int, int, int, bool]]]:
    """Per turn and state after it: (cost, state before, role, joined); from ``enter`` with cost 0."""
    table = {own: moves(own, costs) for own in set(owns)}
    best = [NO_WAY] * 4
    best[enter] = 0
    steps = []
    for own in owns:
        step = [(NO_WAY, -1, -1, False)] * 4
        for state in range(4):
            if best[state] < NO_WAY:
                for cost, role, joined in table[own][state]:
                    if best[state] + cost < step[role][0]:
                        step[role] = (best[state] + cost, state, role, joined)
        best = [s[0] for s in step]
        steps.append(step)
    return steps


def retrace(steps, leave: int) -> list[tuple[int, int, bool]]:
    """(state before, role, joined) of every turn on the cheapest way that ends in ``leave``."""
    out = []
    for step in reversed(steps):
        _, before, role, joined = step[leave]
        out.append((before, role, joined))
        leave = before
    return out[::-1]


def _groups(batches, n_keys: int):
    """Consecutive rows (as tuples) with equal first ``n_keys`` columns.  A group is one chunk."""
    group = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and row[:n_keys] != group[0][:n_keys]:
                yield group[0][:n_keys], group
                group = []
            group.append(row)
    if group:
        yield group[0][:n_keys], group


def _emit(rows_of, fields: pa.Schema):
    """mapInArrow function from a generator of tuples."""

    def run(batches):
        held = []

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), fields)], schema=fields)

        for row in rows_of(batches):
            held.append(row)
            if len(held) >= 8192:
                yield batch_of()
                held = []
        if held:
            yield batch_of()

    return run


def _role_number(role: Column) -> Column:
    name = F.lower(F.btrim(role))
    return F.coalesce(*[F.when(name == ROLES[i], i) for i in (SYSTEM, USER, ASSISTANT)], F.lit(0))


def escaped(text: Column) -> Column:
    """Text whose turn markers are no markers."""
    return F.regexp_replace(text, MARKER, r"<\\$1|$2|>")


def unescaped(text: Column) -> Column:
    """The text that :func:`escaped` was given."""
    return F.regexp_replace(text, r"<\\(\\*)\|(im_start|im_end)\|>", r"<$1|$2|>")


#: A conversation's key without nulls, and the rows of the tree: a node's place in its level and its matrix.
CONV = ("no_conv", "conv")
NODE_FIELDS = [("no_conv", pa.bool_()), ("conv", pa.int64()), ("at", pa.int64())]
NODES = "no_conv boolean, conv long, at long"


def _families(level: DataFrame, fan: int) -> DataFrame:
    """The nodes of a level by parent: at most ``fan`` in a row."""
    return (level.groupBy(*CONV, F.floor(F.col("at") / fan).alias("parent"))
            .agg(F.sort_array(F.collect_list(F.struct("at", "m"))).alias("parts")))


def _step(best: list[int], m: list[int]) -> tuple[list[int], list[int]]:
    """Least costs after a matrix, and the state before it on the way to each."""
    new, froms = [NO_WAY] * 4, [-1] * 4
    for a in range(4):
        for b in range(4):
            if best[a] + m[4 * a + b] < new[b]:
                new[b], froms[b] = best[a] + m[4 * a + b], a
    return new, froms


def _from(state: int) -> list[int]:
    return [0 if s == state else NO_WAY for s in range(4)]


def _parents(batches):
    for batch in batches:
        for none, conv, parent, parts in zip(*(c.to_pylist() for c in batch.columns)):
            flat = []
            for enter in range(4):
                best = _from(enter)
                for p in parts:
                    best, _ = _step(best, p["m"])
                flat += best
            yield none, conv, parent, flat


def _children(batches):
    """Entering and leaving states of a node's children from its own."""
    for batch in batches:
        for none, conv, _, parts, enter, leave, is_last, cost in zip(*(c.to_pylist() for c in batch.columns)):
            best, back = _from(enter), []
            for p in parts:
                best, froms = _step(best, p["m"])
                back.append(froms)
            for i in range(len(parts) - 1, -1, -1):
                before = back[i][leave]
                yield none, conv, parts[i]["at"], before, leave, is_last and i == len(parts) - 1, cost
                leave = before


def borders_of(spark: SparkSession, effects: DataFrame, costs: Costs, fan: int = FAN) -> DataFrame:
    """The states in which the cheapest repair enters and leaves every chunk (``at``), by a tree over the chunks' matrices;
    ``cost`` is the conversation's."""
    levels = [effects]
    last = effects.agg(F.max("at")).first()[0] or 0            # one number: the tree's height follows from it
    fields = pa.schema([*NODE_FIELDS, ("m", pa.list_(pa.int64()))])
    while last:
        up = _families(levels[-1], fan).mapInArrow(_emit(_parents, fields), f"{NODES}, m array<long>")
        levels.append(written(spark, up, "chat-level"))
        last //= fan
    ways = [(F.element_at("m", START * 4 + s + 1) + costs.insert * len(CLOSING[s])).alias("cost") for s in range(4)]
    cheapest = F.array_min(F.array(*[F.struct(w, F.lit(s).alias("leave")) for s, w in enumerate(ways)]))
    borders = levels.pop().select(*CONV, "at", F.lit(START).alias("enter"), cheapest.alias("way")).select(
        *CONV, "at", "enter", "way.leave", F.lit(True).alias("is_last"), "way.cost")
    fields = pa.schema([*NODE_FIELDS, ("enter", pa.int32()), ("leave", pa.int32()), ("is_last", pa.bool_()), ("cost", pa.int64())])
    while levels:
        known = borders.withColumnRenamed("at", "parent")
        down = _families(levels.pop(), fan).join(known, [*CONV, "parent"])
        borders = down.mapInArrow(_emit(_children, fields), f"{NODES}, enter int, leave int, is_last boolean, cost long")
    return borders


def repair(spark: SparkSession, turns: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK, fan: int = FAN,
           conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, chunk, seq, turn, own_role, role, action, n_inserted, piece, conversation_cost."""
    turns = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         F.col(role_col).cast("string").alias("own_role"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["turn", "own", "own_text", "th"]
    slim = turns.select(F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"), "turn",
                        _role_number(F.col("own_role")).alias("own"),
                        F.coalesce("own_role", F.lit("")).alias("own_text"), F.sha2("text", 256).alias("th")).distinct()
    # the ranges are of the total order: rows of one conversation, or of one turn number, are split like any others
    ranged = written(spark, slim.repartitionByRange(*CONV, *order).withColumn("part", F.spark_partition_id()), "chat-ranges")
    numbered = number_rows(ranged, CONV, order, F.col("part"), rn_col="n", total_col=None)
    key = [*CONV, "chunk"]
    numbered = written(spark, numbered.select(*CONV, F.floor((F.col("n") - 1) / chunk).alias("chunk"), "n", *order), "chat-turns")

    def matrices(batches):
        for (none, conv, at), rows in _groups(batches, 3):
            owns = [r[5] for r in rows]
            flat = []
            for enter in range(4):
                flat += [s[0] for s in run_turns(owns, enter, costs)[-1]]
            yield none, conv, at, flat

    fields = pa.schema([*NODE_FIELDS, ("m", pa.list_(pa.int64()))])
    effects = written(spark, numbered.repartition(*key).sortWithinPartitions(*key, "n")
                      .mapInArrow(_emit(matrices, fields), f"{NODES}, m array<long>"), "chat-effects")
    borders = borders_of(spark, effects, costs, fan).withColumnRenamed("at", "chunk")
    marked = (numbered.join(borders, key).select(*key, "n", *order, "enter", "leave", "is_last", "cost")
              .repartition(*key).sortWithinPartitions(*key, "n"))

    def decide(batches):
        for (none, conv, part), rows in _groups(batches, 3):
            enter, leave, is_last, cost = rows[0][8:]
            steps = run_turns([r[5] for r in rows], enter, costs)
            for seq, (row, (before, role, joined)) in enumerate(zip(rows, retrace(steps, leave))):
                between = () if joined else EMPTIES[before, role]
                lead = "\n" if joined else "".join(
                    ("" if s == START else "<|im_end|>\n") + f"<|im_start|>{ROLES[r]}\n"
                    for s, r in zip((before, *between), (*between, role)))
                end = ""
                if is_last and seq == len(rows) - 1:
                    end = "".join(f"<|im_end|>\n<|im_start|>{ROLES[r]}\n" for r in CLOSING[role]) + "<|im_end|>\n"
                action = ("join" if joined else "append") + ("" if role == row[5] else ", relabel")
                n_new = len(between) + (len(CLOSING[role]) if end else 0)
                yield None if none else conv, part, seq, row[4], row[6], row[7], ROLES[role], action, n_new, lead, end, cost

    fields = pa.schema([("d_conv", pa.int64()), ("d_chunk", pa.int64()), ("seq", pa.int64()), ("d_turn", pa.int64()),
                        ("d_own", pa.string()), ("d_th", pa.string()), ("role", pa.string()), ("action", pa.string()),
                        ("n_inserted", pa.int32()), ("lead", pa.string()), ("tail", pa.string()), ("cost", pa.int64())])
    decisions = marked.mapInArrow(_emit(decide, fields), "d_conv long, d_chunk long, seq long, d_turn long, d_own string, "
                                  "d_th string, role string, action string, n_inserted int, lead string, tail string, cost long")
    # rows equal in all columns count once; of null and empty roles with equal turns too
    texts = turns.withColumn("th", F.sha2("text", 256)).dropDuplicates(["conv_id", "turn", "own_role", "th"])
    texts = texts.withColumn("own_text", F.coalesce("own_role", F.lit(""))).dropDuplicates(["conv_id", "turn", "own_text", "th"])
    same = (F.col("conv_id").eqNullSafe(F.col("d_conv")) & F.col("turn").eqNullSafe(F.col("d_turn"))
            & (F.col("own_text") == F.col("d_own")) & (F.col("th") == F.col("d_th")))
    return texts.join(decisions, same).select(
        F.col("conv_id"), F.col("d_chunk").alias("chunk"), "seq", "turn", "own_role", "role", "action", "n_inserted",
        F.concat("lead", escaped(F.col("text")), "tail").alias("piece"), F.col("cost").alias("conversation_cost"))


def rendered(pieces: DataFrame) -> DataFrame:
    """conv_id, text: whole conversations, for callers whose conversations fit a row."""
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "seq", "piece")))
    return pieces.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("text"))

