"""Operator 13: conversations repaired by aligning their turns to the alternating grammar ``(s?(ua)+)?``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

REROLE, INSERT, DELETE, TRUNCATED = 3, 3, 4, 3
ROLES = {"u": "user", "a": "assistant"}
# Steps of a conversation that one alignment table covers.
BLOCK_STEPS = 64
# Where the grammar stands: nothing yet, after the system turn, after a user's, after an assistant's.
STATES = "0sua"
NEXT = {"0": "u", "s": "u", "a": "u", "u": "a"}
# What is still to be paid when the conversation ends in a state: turns that have to follow.
CLOSING = {"0": 0, "s": 2 * INSERT, "u": INSERT, "a": 0}
FAR = 1 << 60
BLANKS = " \t\n\x0b\x0c\r"


@dataclass
class Block:
    """Consecutive steps of a conversation: turns that may stay, and runs of turns that must go.

    ``initials`` has the first character of each step's role, ``reps`` the turns of a run that must go and 0
    for a turn that may stay; ``late`` marks turns cut off; ``roles`` and ``texts`` belong to turns that may stay.
    """

    initials: list[str] = field(default_factory=list)
    reps: list[int] = field(default_factory=list)
    late: list[bool] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)


class Alignment:
    """Wagner-Fischer tables of a block's steps against the ends of the alternating string.

    ``tables[x][i, r]`` is the least cost of turning the steps from ``i`` on into the last ``r`` letters of
    ``...uaua`` that ends with ``x``, so one table holds every feasible length. Cells that cannot beat the
    incumbent, a greedy alignment, lie outside Ukkonen's band and are not computed. Letters are inserted in
    front of a step only; those behind the last step are the next block's, or the closing ones.
    """

    def __init__(self, block: Block) -> None:
        self.block = block
        self.n = len(block.reps)
        self.deletes = [DELETE * max(1, k) for k in block.reps]
        must = np.array([DELETE * k for k in block.reps], dtype=np.int64)
        may = np.array([k == 0 for k in block.reps], dtype=np.int64)
        # Of the steps from i on: what their runs cost in any case, and how many turns may stay.
        self.must = np.append(np.cumsum(must[::-1])[::-1], 0)
        self.may = np.append(np.cumsum(may[::-1])[::-1], 0)
        # An alignment may have to leave in the other state than the greedy one: two edits more.
        self.incumbent = max(self._greedy("u"), self._greedy("a")) + REROLE + INSERT
        self.tables = {x: self._table(x) for x in "ua"}
        self.all_gone = np.append(np.cumsum(np.array(self.deletes, dtype=np.int64)[::-1])[::-1], 0)

    def _greedy(self, state: str) -> int:
        """The better of two alignments that never look ahead: fit each turn's role, or fill in what it skips."""
        costs = []
        for fill in (False, True):
            at, cost = state, int(self.must[0])
            for initial, k, late in zip(self.block.initials, self.block.reps, self.block.late):
                if k:
                    continue
                cost += TRUNCATED * late
                want = NEXT[at]
                if initial == want:
                    at = want
                elif fill and initial in ROLES:
                    cost += INSERT
                    at = initial
                else:
                    cost += REROLE
                    at = want
            costs.append(cost)
        return min(costs)

    def _table(self, end: str) -> np.ndarray:
        slack = self.incumbent - self.must
        highest = int((self.may + slack // INSERT).max())
        table = np.full((self.n + 1, highest + 1), FAR, dtype=np.int64)
        table[self.n, 0] = 0
        letters = np.arange(highest + 1)
        is_end = letters % 2 == 1
        for i in range(self.n - 1, -1, -1):
            low = max(0, int(self.may[i] - slack[i] // DELETE))
            high = min(highest, int(self.may[i] + slack[i] // INSERT))
            if low > high:
                continue
            best = table[i + 1, low : high + 1] + self.deletes[i]
            if self.block.reps[i] == 0:
                wanted = np.where(is_end[low : high + 1], end, "a" if end == "u" else "u")
                change = np.where(wanted == self.block.initials[i], 0, REROLE) + TRUNCATED * self.block.late[i]
                one_less = np.full(high + 1 - low, FAR, dtype=np.int64)
                first = max(low, 1)
                one_less[first - low :] = table[i + 1, first - 1 : high]
                best = np.minimum(best, one_less + change)
            ramp = INSERT * letters[low : high + 1]
            table[i, low : high + 1] = np.minimum(np.minimum.accumulate(best - ramp) + ramp, FAR)
        return table

    def _targets(self, state: str) -> Iterator[tuple[int, str, int, int, str | None]]:
        """Cost, last state, first step aligned, length, and ``s`` where the system turn before that step stays."""
        starts = [(0, 0, state, None)]
        if state == "0":
            for i, (initial, k, late) in enumerate(zip(self.block.initials, self.block.reps, self.block.late)):
                if initial == "s" and k == 0:
                    starts.append((int(self.all_gone[0] - self.all_gone[i]) + TRUNCATED * late, i + 1, "s", "s"))
        for paid, i, at, kept in starts:
            yield paid + int(self.all_gone[i]), at, i, 0, kept
            for end, table in self.tables.items():
                # Lengths whose first letter is the one that follows the state.
                first = 1 if NEXT[at] == end else 2
                for r in (np.flatnonzero(table[i, first::2] < FAR) * 2 + first).tolist():
                    yield paid + int(table[i, r]), end, i, r, kept

    def costs(self) -> list[int]:
        """Least cost from each state to each, row by row; ``FAR`` where no alignment leads there."""
        out = []
        for state in STATES:
            row = dict.fromkeys(STATES, FAR)
            for cost, end, *_ in self._targets(state):
                row[end] = min(row[end], cost)
            out += row.values()
        return out

    def best(self, state: str, after: dict[str, int]) -> tuple[int, str, str]:
        """Cost, last state and audit of the cheapest alignment with what follows it, the ASCII-least audit among equals."""
        targets = [t for t in self._targets(state) if after[t[1]] < FAR]
        least = min(t[0] + after[t[1]] for t in targets)
        found = [(self._audit(end, i, r, kept), end, cost) for cost, end, i, r, kept in targets if cost + after[end] == least]
        audit, end, cost = min(found)
        return cost, end, audit

    def _audit(self, end: str, start: int, r: int, kept: str | None) -> str:
        """Edits of one alignment, traced back from its first step; of equal ones the ASCII-least: D, I, K, R."""
        out = ["D" * max(1, k) for k in self.block.reps[: start - 1 if kept else start]]
        if kept:
            out.append("K")
        if r == 0:
            return "".join(out + ["D" * max(1, k) for k in self.block.reps[start:]])
        table, i = self.tables[end], start
        while i < self.n:
            now = table[i, r]
            if table[i + 1, r] + self.deletes[i] == now:
                out.append("D" * max(1, self.block.reps[i]))
                i += 1
            elif r and table[i, r - 1] + INSERT == now:
                out.append("I")
                r -= 1
            else:
                letter = end if r % 2 == 1 else ("a" if end == "u" else "u")
                out.append("K" if self.block.initials[i] == letter else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def apply_audit(block: Block, state: str, audit: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn that the edits leave."""
    letters = iter(audit)
    turn = 0
    for initial, k in zip(block.initials, block.reps):
        if k:
            for _ in range(k):
                while next(letters) == "I":
                    state = NEXT[state]
                    yield ROLES[state], ""
            continue
        while (edit := next(letters)) == "I":
            state = NEXT[state]
            yield ROLES[state], ""
        if edit == "K":
            state = initial
            yield block.roles[turn], block.texts[turn]
        elif edit == "R":
            state = NEXT[state]
            yield ROLES[state], block.texts[turn]
        turn += 1
    for _ in letters:
        state = NEXT[state]
        yield ROLES[state], ""


class Digest:
    """SHA-256 of ``role:text`` lines, fed turn by turn."""

    def __init__(self) -> None:
        self.sha, self.some = hashlib.sha256(), False

    def add(self, turns: Iterator[tuple[str, str]]) -> None:
        for role, text in turns:
            self.sha.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
            self.some = True


@dataclass
class Tally:
    """What is counted over a run of turns in their order; ``add`` appends the tally of the run behind it."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_initial: str | None = None
    last_initial: str | None = None

    def add(self, other: Tally) -> None:
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        self.distinct += other.distinct - (other.first_turn is not None and other.first_turn == self.last_turn)
        if other.first_turn is not None:
            self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = other.last_turn
        if other.first_initial is not None:
            if self.last_initial is None:
                self.first_initial = other.first_initial
            else:
                self.illegal += self.last_initial + other.first_initial not in ("su", "ua", "au")
            self.last_initial = other.last_initial

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct


def damage(turns: DataFrame) -> DataFrame:
    """The stated damage on ``conv_id, turn, role, text``; adds ``copies``: 0 for a dropped row, 2 for a repeated one.

    A null role or text is one space, and so is a null in the key that is hashed.
    """
    blank_if_null = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    return (
        turns.select("conv_id", "turn", *[c.alias(n) for n, c in blank_if_null.items()], kind.alias("_kind"))
        .withColumns({
            "text": F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
            "role": F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")),
            "copies": F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1),
        })
        .drop("_kind")
    )


def find_faults(turns: DataFrame) -> DataFrame:
    """Equal turns of a conversation as one row: ``stays`` (0 or 1 that may stay), ``goes`` (those that must go), ``fault``.

    ``turns`` has ``conv_id, turn, role, text, copies``. A turn seen earlier is one whose role and text (by 128 bits)
    come at a smaller place of the conversation. The places come from a combined aggregate and are joined
    by conversation, turn and text, so no text or conversation gathers in one task. Rows of no copies end
    as one row of nulls per conversation, which keeps its id.
    """
    there = F.col("copies") > 0
    filled = {"turn": F.col("turn"), "role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))}
    shown = turns.select("conv_id", *[F.when(there, c).alias(n) for n, c in filled.items()], "copies")
    grouped = shown.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    bare = F.translate("text", BLANKS, "") == ""
    g = grouped.withColumns({"_text_id": F.md5(F.col("text").cast("binary")), "_blank": bare})
    g = stored(g, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = (
        g.where((F.col("copies") > 0) & ~F.col("_blank")).groupBy("conv_id", "role", "_text_id").agg(F.min(place).alias("_first"))
        .select(F.col("conv_id").alias("_c"), F.col("_first.turn").alias("_t"), F.col("role").alias("_r"), F.col("_text_id").alias("_i"), F.lit(1).alias("_one"))
    )
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("conv_id", "_c"), ("turn", "_t"), ("role", "_r"), ("_text_id", "_i"))]
    joined = g.join(firsts, same[0] & same[1] & same[2] & same[3], "left").withColumn("stays", F.coalesce("_one", F.lit(0)))
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(F.col("_blank"), "blank").when((F.col("stays") == 1) & ~end.isin(".", "!", "?"), "truncated")
    return joined.select("conv_id", "turn", "role", "text", "_text_id", "stays", (F.col("copies") - F.col("stays")).cast("bigint").alias("goes"), fault.alias("fault"))


def in_order(faults: DataFrame) -> DataFrame:
    """Conversations in ranges of their turns; a range holds part of a large conversation, its rows sorted.

    Turns follow ``turn`` (nulls first), ties ``role`` and the MD5 of the text. Texts are no range keys, since samples of those
    reach the driver.
    """
    order = ["conv_id", "turn", "role", "_text_id"]
    return stored(faults, "faults").repartitionByRange(*order).sortWithinPartitions(*order)


def _steps(row: dict) -> Iterator[tuple[str, int, bool, str | None, str | None, Tally]]:
    """Steps of a group of equal turns, each with its tally."""
    initial = row["role"][:1] or " "
    turn, fault = row["turn"], row["fault"]
    ends = dict(first_turn=turn, last_turn=turn, distinct=int(turn is not None), first_initial=initial, last_initial=initial)
    if row["stays"]:
        late = fault == "truncated"
        yield initial, 0, late, row["role"], row["text"], Tally(truncated=int(late), **ends)
    if row["goes"]:
        n = row["goes"]
        kind = {"blank": n} if fault == "blank" else {"duplicate": n}
        yield initial, n, False, None, None, Tally(illegal=n - 1, **kind, **ends)


_TALLY = ["blank", "duplicate", "truncated", "illegal", "distinct", "first_turn", "last_turn", "first_initial", "last_initial"]
_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_BLOCK = ["initials", "reps", "late", "roles", "texts"]


def _report(tally: Tally, cost: int) -> dict:
    return {"gaps": tally.gaps, **{n: getattr(tally, n) for n in _REPORT[1:5]}, "cost": cost}


def _close(state: str) -> str:
    return "I" * (CLOSING[state] // INSERT)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _key_types(df: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = df.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _aligned(ordered: DataFrame, block_steps: int, turns: bool) -> DataFrame:
    """Results of conversations that lie inside a range and a block; of all others their blocks with ``costs``."""
    spark_key, arrow_key = _key_types(ordered)
    longs = [*_REPORT, *_TALLY[4:7]]
    sql = (
        f"conv_id {spark_key}, part bigint, block bigint, whole boolean, {', '.join(f'{n} bigint' for n in longs)}, first_initial string, last_initial string, "
        "audit string, repaired_sha256 string, costs array<bigint>, initials array<string>, reps array<bigint>, late array<boolean>, roles array<string>, texts array<string>, "
        "repaired array<struct<role:string,text:string>>"
    )
    pair = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    strings = pa.list_(pa.string())
    schema = pa.schema(
        [("conv_id", arrow_key), ("part", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), *[(n, pa.int64()) for n in longs]]
        + [(n, pa.string()) for n in ("first_initial", "last_initial", "audit", "repaired_sha256")]
        + [("costs", pa.list_(pa.int64())), ("initials", strings), ("reps", pa.list_(pa.int64())), ("late", pa.list_(pa.bool_())), ("roles", strings), ("texts", strings), ("repaired", pair)]
    )

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0

        def out(key: object, block: Block, tally: Tally, whole: bool) -> dict:
            nonlocal number
            number += 1
            row = {"conv_id": key, "part": part, "block": number, "whole": whole}
            aligned = Alignment(block)
            if not whole:
                return row | {n: getattr(tally, n) for n in _TALLY} | {"costs": aligned.costs()} | {n: getattr(block, n) for n in _BLOCK}
            cost, end, audit = aligned.best("0", CLOSING)
            audit, cost = audit + _close(end), cost + CLOSING[end]
            kept, digest = list(apply_audit(block, "0", audit)), Digest()
            digest.add(iter(kept))
            made = row | _report(tally, cost) | {"audit": audit, "repaired_sha256": digest.sha.hexdigest()}
            return made | {"repaired": [{"role": r, "text": t} for r, t in kept] if turns else None}

        key, block, tally = None, None, Tally()
        edge = True  # the run of rows touches the begin of the range, or has filled a block
        for row in _rows(batches):
            if block is not None and row["conv_id"] != key:
                yield out(key, block, tally, whole=not edge)
                block, tally, edge = None, Tally(), False
            if block is None:
                key, block = row["conv_id"], Block()
            if row["role"] is None:
                continue
            for initial, reps, late, role, text, counted in _steps(row):
                if len(block.reps) == block_steps:
                    yield out(key, block, tally, whole=False)
                    block, tally, edge = Block(), Tally(), True
                block.initials.append(initial)
                block.reps.append(reps)
                block.late.append(late)
                if not reps:
                    block.roles.append(role)
                    block.texts.append(text)
                tally.add(counted)
        if block is not None:
            yield out(key, block, tally, whole=False)

    return ordered.drop("_text_id").mapInArrow(lambda batches: _batches(results(batches), schema), sql)


def _costs_behind(blocks: DataFrame) -> DataFrame:
    """For each block the least cost of what follows it, by the state it ends in: ``behind``.

    Blocks come conversation by conversation, last block first, and pass by one at a time, so a conversation of any length
    needs the memory of one block.
    """
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("behind", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            key, behind, first = None, [], True
            for row in _rows(batches):
                if first or row["conv_id"] != key:
                    key, first, behind = row["conv_id"], False, [CLOSING[x] for x in STATES]
                yield {"part": row["part"], "block": row["block"], "behind": behind}
                costs = row["costs"]
                behind = [min(FAR, *(costs[4 * i + j] + behind[j] for j in range(4))) for i in range(4)]

        return _batches(rows(), schema)

    by_end = blocks.select("conv_id", "part", "block", "costs").repartition("conv_id")
    return by_end.sortWithinPartitions("conv_id", F.desc("part"), F.desc("block")).mapInArrow(run, "part bigint, block bigint, behind array<bigint>")


def _joined(blocks: DataFrame, turns: bool) -> DataFrame:
    """Results of conversations of several blocks: each block is aligned from every state it may begin in, then the
    states are followed from the first block on, one block in memory at a time.

    Without ``turns`` one row per conversation, else one per block with its turns.
    """
    spark_key, arrow_key = _key_types(blocks)
    audits = "ends array<string>, audits array<string>, paid array<bigint>"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = [("ends", pa.list_(pa.string())), ("audits", pa.list_(pa.string())), ("paid", pa.list_(pa.int64()))]
        for batch in batches:
            made: list[list] = [[], [], []]
            for row in batch.select([*_BLOCK, "behind"]).to_pylist():
                aligned = Alignment(Block(*[row[n] for n in _BLOCK]))
                after = dict(zip(STATES, row["behind"]))
                cost, end, audit = zip(*[aligned.best(state, after) for state in STATES])
                for column, values in zip(made, (end, audit, cost)):
                    column.append(list(values))
            columns = [pa.array(c, type=k) for c, (_, k) in zip(made, extra)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *[n for n, _ in extra]])

    pair = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    schema = pa.schema([("conv_id", arrow_key), *[(n, pa.int64()) for n in _REPORT], ("audit", pa.string()), ("repaired_sha256", pa.string()), ("part", pa.int64()), ("block", pa.int64()), ("repaired", pair)])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            key, tally = None, None
            pieces: list[str] = []

            def closed() -> dict:
                pieces.append(_close(state))
                digest.add((ROLES[x], "") for x in _closing_letters(state))
                done = {"conv_id": key} | _report(tally, cost + CLOSING[state])
                return done | {"audit": "".join(pieces), "repaired_sha256": digest.sha.hexdigest()}

            for row in _rows(batches):
                if tally is None or row["conv_id"] != key:
                    if tally is not None:
                        yield from closing_turns(key, state) if turns else [closed()]
                    key, tally, state, cost, pieces, digest = row["conv_id"], Tally(), "0", 0, [], Digest()
                block, at = Block(*[row[n] for n in _BLOCK]), STATES.index(state)
                kept = list(apply_audit(block, state, row["audits"][at]))
                if turns:
                    yield {"conv_id": key, "part": row["part"], "block": row["block"], "repaired": [{"role": r, "text": t} for r, t in kept]}
                else:
                    digest.add(iter(kept))
                    pieces.append(row["audits"][at])
                tally.add(Tally(**{n: row[n] for n in _TALLY}))
                cost += row["paid"][at]
                state = row["ends"][at]
            if tally is not None:
                yield from closing_turns(key, state) if turns else [closed()]

        return _batches(rows(), schema)

    def closing_turns(key: object, state: str) -> list[dict]:
        left = [{"role": ROLES[x], "text": ""} for x in _closing_letters(state)]
        return [{"conv_id": key, "part": FAR, "block": 0, "repaired": left}] if left else []

    behind = _costs_behind(blocks)
    known = blocks.join(behind, ["part", "block"])
    named = known.select("conv_id", "part", "block", *_TALLY, *_BLOCK, "behind")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields)
    aligned = named.mapInArrow(align, f"{kinds}, {audits}").drop("behind")
    by_conv = aligned.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    longs = ", ".join(f"{n} bigint" for n in _REPORT)
    return by_conv.mapInArrow(follow, f"conv_id {spark_key}, {longs}, audit string, repaired_sha256 string, part bigint, block bigint, repaired array<struct<role:string,text:string>>")


def _closing_letters(state: str) -> str:
    return {"s": "ua", "u": "a"}.get(state, "")


def _prepared(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return df.select(df[conv].alias("conv_id"), df[turn].cast("bigint").alias("turn"), df[role].alias("role"), df[text].alias("text"))


def repair_report(turns: DataFrame, block_steps: int = BLOCK_STEPS) -> DataFrame:
    """``conv_id``, counts of faults, ``cost``, ``audit`` and ``repaired_sha256`` of each conversation.

    ``turns`` has ``conv_id, turn, role, text, copies`` (see ``damage``; 1 for a plain row). A null conversation id is a
    conversation of its own; a role without characters counts as one that does not fit. A conversation
    without copies has zeros and an empty audit; an empty table gives no rows. Conversations longer
    than a block, or cut by the end of a range, are aligned block by block: cost matrices between the grammar's
    states first, then what follows each block, then the audits, each with one block in memory. Only the
    bytes of an audit, an output, are kept whole. Repeated rows are duplicates; a million equal
    ones are one step.
    """
    done = stored(_aligned(in_order(find_faults(turns)), block_steps, False), "aligned")
    columns = ["conv_id", *_REPORT, "audit", "repaired_sha256"]
    return done.where("whole").select(columns).unionByName(_joined(done.where("not whole"), False).select(columns))


def repaired_turns(turns: DataFrame, block_steps: int = BLOCK_STEPS) -> DataFrame:
    """``conv_id, part, block, repaired``: the turns that ``repair_report`` hashes, in parts of a bounded number.

    Parts of a conversation follow ``part`` and ``block``; a conversation without turns has an empty part or none.
    """
    done = stored(_aligned(in_order(find_faults(turns)), block_steps, True), "aligned")
    columns = ["conv_id", "part", "block", "repaired"]
    return done.where("whole").select(columns).unionByName(_joined(done.where("not whole"), True).select(columns))


def repair_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``repair_report`` of the damaged rows of ``df``. Other columns are not read and may have any name."""
    return repair_report(damage(_prepared(df, conv, turn, role, text)))
