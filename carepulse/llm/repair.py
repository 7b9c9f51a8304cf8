"""Repair the structure of conversations: cheapest edits by big-integer weights."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, slices

#: What came before: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Digits of the audit letters in their ASCII order; 0 pads the end.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
#: Bits of a letter; letters of a row's field (two inserts, since more come back to a state, and the row's own); bits of a field.
BITS, LETTERS = 3, 3
FIELD = BITS * LETTERS
#: Rows that are decided with full letters; between blocks a rank stands for the letters so far.
BLOCK = 64
#: Bits of a rank: 16 pairs of a first and a last state.
RANK = 4
OTHER = 3
BAD, CUT = 1, 2  # must go; costs 5 if it stays


def _field(letters: str) -> int:
    return sum(DIGIT[c] << BITS * (LETTERS - 1 - k) for k, c in enumerate(letters))


def _move(state: int, initial: int) -> int | None:
    """The state after a turn with this initial (0 s, 1 u, 2 a), or None where it may not stand."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _inserts(state: int) -> Iterator[tuple[int, str, int]]:
    """(state, letters, cost) after no, one and two inserted turns; their roles follow from the state."""
    yield state, "", 0
    for n in (1, 2):
        state = ASSISTANT if state == USER else USER
        yield state, "I" * n, 5 * n


def _edges() -> list[list[tuple[int, int, int, int, str]]]:
    """For each kind of row (initial + 4 * fault) the cheapest (from, to, cost, field, letters) of each two states."""
    out = []
    for kind in range(12):
        initial, fault = kind % 4, kind // 4
        best: dict[tuple[int, int], tuple] = {}
        for start in range(4):
            for state, letters, cost in _inserts(start):
                ways = [(state, 2, "D")]
                if fault != BAD:
                    stays = 5 if fault == CUT else 0
                    ways.append((_move(state, 2 if state == USER else 1), 1 + stays, "R"))
                    ways.append((_move(state, initial), stays, "K"))
                for to, more, letter in ways:
                    way = cost + more, _field(letters + letter), letters + letter
                    if to is not None and ((start, to) not in best or way < best[start, to]):
                        best[start, to] = way
        out.append([(a, b, *way) for (a, b), way in sorted(best.items())])
    return out


EDGES = _edges()
#: (from, cost, field, letters) of the ends at which a conversation may stop.
ENDS = [(start, cost, _field(letters), letters) for start in range(4) for state, letters, cost in _inserts(start)
        if state in (START, ASSISTANT)]


def _ranked(values: list[list[int | None]], low: int) -> list[list[int | None]]:
    """The same order with the lowest ``low`` bits replaced by their rank."""
    mask = (1 << low) - 1
    place = {w: k for k, w in enumerate(sorted({v & mask for row in values for v in row if v is not None}))}
    return [[None if v is None else (v >> low) << RANK | place[v & mask] for v in row] for row in values]


def forward(kinds: list[int], starts: list[int], back: list | None = None) -> list[list[int | None]]:
    """Least weight from each of ``starts`` to each state over all rows; a weight is cost, then rank of the letters.

    In a block a weight is one integer: cost, rank of the letters before the block, a field for
    each row at a fixed place. Of two audits of equally many rows neither begins with the other, as each ends with the letter
    of a row, so comparing fields compares whole audits, whatever follows. ``back`` gets for each row
    the edge into each state, for the first start.
    """
    values: list[list[int | None]] = [[0 if q == s else None for q in range(4)] for s in starts]
    for first in range(0, len(kinds), BLOCK):
        block = kinds[first:first + BLOCK]
        shift = FIELD * len(block)
        values = [[None if v is None else v << shift for v in row] for row in values]
        for t, kind in enumerate(block):
            place = FIELD * (len(block) - 1 - t)
            into: list[tuple | None] = [None] * 4
            for s, row in enumerate(values):
                new: list[int | None] = [None] * 4
                for edge in EDGES[kind]:
                    v = row[edge[0]]
                    if v is None:
                        continue
                    w = v + (edge[2] << shift + RANK) + (edge[3] << place)
                    if new[edge[1]] is None or w < new[edge[1]]:
                        new[edge[1]] = w
                        if s == 0:
                            into[edge[1]] = edge
                values[s] = new
            if back is not None:
                back.append(into)
        values = _ranked(values, shift + RANK)
    return values


def _end(row: list[int | None]) -> tuple[int, str]:
    """State and letters of the cheapest end."""
    best = min((row[s] + (cost << RANK) << FIELD | field, s, letters) for s, cost, field, letters in ENDS if row[s] is not None)
    return best[1], best[2]


def solve(kinds: tuple[int, ...], start: int = START, after: int | None = None) -> tuple[int, list[str]]:
    """(cost, letters of each row and of the end). With ``after`` the rows must end in that state and nothing follows."""
    back: list = []
    row = forward(list(kinds), [start], back)[0]
    state, tail = _end(row) if after is None else (after, "")
    cost, letters = 5 * len(tail), []
    for into in reversed(back):
        edge = into[state]
        letters.append(edge[4])
        cost += edge[2]
        state = edge[0]
    return cost, [*letters[::-1], tail]


@lru_cache(1 << 14)
def _solve_short(kinds: tuple[int, ...], start: int, after: int | None) -> tuple[int, list[str]]:
    return solve(kinds, start, after)


def chain(matrices: list[list[list[int | None]]]) -> list[int]:
    """States at the ends of the pieces of one conversation, given each piece's weights from state to state."""
    row, back = [0 if q == START else None for q in range(4)], []
    for matrix in matrices:
        new: list[int | None] = [None] * 4
        into = [0] * 4
        for a in range(4):
            for b in range(4):
                if row[a] is None or matrix[a][b] is None:
                    continue
                cost, rank = matrix[a][b] >> RANK, matrix[a][b] & (1 << RANK) - 1
                w = (row[a] + (cost << RANK) << RANK) | rank
                if new[b] is None or w < new[b]:
                    new[b], into[b] = w, a
        row = _ranked([new], 2 * RANK)[0]
        back.append(into)
    states = [_end(row)[0]]
    for into in reversed(back[1:]):
        states.append(into[states[-1]])
    return states[::-1]


_BLANK = "^[ \\t-\\r]*\\z"
_ENDED = "[.!?][ \\t-\\r]*\\z"


def _ordered(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows by conversation and turn with the partition and place they got, and the fault that their own text shows."""
    kind = rows.schema[id_col].dataType.simpleString()
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    plain = rows.select(F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    fault = F.when(F.col("text").rlike(_BLANK), "b").when(~F.col("text").rlike(_ENDED), "t").otherwise("")
    plain = plain.select("*", fault.alias("own"), F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("_row"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array(range(k, k + n), pa.int64()), *batch.columns],
                                             ["part", "k", *batch.schema.names])
            k += n

    order = (F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("_row"))
    ordered = plain.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    return keep(ordered.mapInArrow(number, f"part int, k long, id {kind}, turn long, role string, text string, own string, digest string"),
                "conversations")


def _repeats(stored: DataFrame) -> DataFrame:
    """(part, k) of rows whose role and text an earlier row of the conversation has."""
    keys = ["id", "role", "digest"]
    place = F.col("part") * F.lit(1 << 40) + F.col("k")
    said = stored.select("part", "k", *keys, place.alias("place"))
    first = said.groupBy(*keys).agg(F.min("place").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    same = F.lit(True)
    for c in keys:
        same = same & said[c].eqNullSafe(first[c])
    return keep(said.join(first, same).where(F.col("place") > F.col("_first")).select("part", "k"), "repeats")


def _spread(stored: DataFrame, repeats: DataFrame, *cols: str) -> DataFrame:
    """Rows back in their partitions and order; a row with a null id column ``own`` says that the next one is a repeat."""
    marks = repeats.select("part", "k", *[F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in cols], F.lit(True).alias("mark"))
    rows = stored.select("part", "k", *cols, F.lit(False).alias("mark")).unionByName(marks)
    parts = (stored.agg(F.max("part")).first()[0] or 0) + 1
    return rows.repartitionById(parts, "part").sortWithinPartitions("part", "k", F.desc("mark"))


def _pieces(batches: Iterator[pa.RecordBatch], cols: list[str]) -> Iterator[tuple[int, object, list[tuple]]]:
    """(part, conversation, rows) of each piece; a row is (whether repeated, *cols)."""
    at, rows, repeated = None, [], False
    for batch in slices(batches, "text") if "text" in cols else batches:
        for part, mark, key, *row in zip(*(batch[c].to_pylist() for c in ("part", "mark", "id", *cols))):
            if mark:
                repeated = True
                continue
            if at != (part, key):
                if rows:
                    yield *at, rows
                at, rows = (part, key), []
            rows.append((repeated, *row))
            repeated = False
    if rows:
        yield *at, rows


_INITIAL = {"s": 0, "u": 1, "a": 2}


def _fault(repeated: bool, own: str) -> str:
    return "b" if own == "b" else "d" if repeated else own


def _kind(role: str, fault: str) -> int:
    return _INITIAL.get(role[:1], OTHER) + 4 * (BAD if fault in ("b", "d") else CUT if fault == "t" else 0)


def _borders(stored: DataFrame, repeats: DataFrame) -> dict:
    """Of pieces of conversations that go over partitions: number, state before and after, turn and role before, whether the last."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for part, key, rows in _pieces(batches, ["turn", "role", "own"]):
            piece = part, key, [_kind(role, _fault(again, own)) for again, _, role, own in rows], rows[-1][1:3]
            first, last = first or piece, piece
        kept = [] if first is None else [first] if first is last else [first, last]
        if kept:
            packed = [pickle.dumps((key, forward(kinds, [*range(4)]), tail)) for _, key, kinds, tail in kept]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in kept], pa.int32()), pa.array(range(len(kept)), pa.int32()), pa.array(packed, pa.binary())],
                                             ["part", "i", "piece"])

    found = _spread(stored, repeats, "id", "turn", "role", "own").mapInArrow(edges, "part int, i int, piece binary").collect()  # two a partition
    chains: list[list] = []
    for r in sorted(found, key=lambda r: (r["part"], r["i"])):
        key, matrix, tail = pickle.loads(r["piece"])
        if chains and chains[-1][-1][1] == key and chains[-1][-1][0] < r["part"]:
            chains[-1].append((r["part"], key, matrix, tail))
        else:
            chains.append([(r["part"], key, matrix, tail)])
    out = {}
    for pieces in (c for c in chains if len(c) > 1):
        states = chain([p[2] for p in pieces])
        before, said = START, None
        for i, (part, key, _, tail) in enumerate(pieces):
            out[part, key] = i, before, states[i], said, i == len(pieces) - 1
            before, said = states[i], tail
    return out


_TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost", "turns", "low", "high"]


def _repaired(letters: list[str], rows: list[tuple], state: int) -> list[dict]:
    """The edits in order; a deleted turn has a null role and text."""
    out = []
    for group, row in zip(letters, [*rows, None]):
        for c in group:
            role = text = None
            if c in "IR":
                role = "assistant" if state == USER else "user"
                text = "" if c == "I" else row[3]
            elif c == "K":
                role, text = row[2:4]
            if role is not None:
                state = _move(state, _INITIAL[role[0]])
            out.append({"edit": c, "role": role, "text": text})
    return out


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(id, piece, whole, blank, duplicate, truncated, illegal, cost, turns, low, high, edits) of each conversation.

    ``edits`` are (edit, role, text) in order: Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert of an
    empty user or assistant turn 5, and 5 more for a truncated turn that stays; blank and repeated turns must go. They are the cheapest ones after
    which role initials read ``(s?(ua)+)?``, and among those the ones with the least initials by ASCII. ``turns``
    counts distinct turn numbers between ``low`` and ``high``, nulls aside; ``illegal`` counts neighbours before the repair
    that aren't su, ua or au. A turn's first fault of blank, duplicate, truncated counts.

    Rows of a conversation go by turn, null first; rows of one turn by role, then by a digest of the text. A null role
    or text is one space, a null id is a conversation like any other. Repeated rows are duplicates. An empty table gives no
    rows; other columns are not looked at.

    Rows are dealt by range, so a conversation of any length is cut where partitions end, and gives a row a ``piece`` (``whole`` is
    false then). A cut piece is a matrix of weights from state to state; only the first and last piece of each
    partition go to the driver, which settles the states at the cuts.
    """
    bounded_batches(rows.sparkSession)
    stored = _ordered(rows, id_col, turn_col, role_col, text_col)
    repeats = _repeats(stored)
    borders = _borders(stored, repeats)
    id_type = stored.select("id").limit(0).toArrow().schema.field(0).type
    names = ["id", "piece", "whole", *_COUNTS, "edits"]
    types = [id_type, pa.int32(), pa.bool_(), *[pa.int64()] * len(_COUNTS), pa.list_(_TURN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for part, key, found in _pieces(batches, ["turn", "role", "text", "own"]):
            number, before, after, said, last = borders.get((part, key), (0, START, None, None, True))
            faults = [_fault(r[0], r[4]) for r in found]
            kinds = tuple(_kind(r[2], f) for r, f in zip(found, faults))
            cost, letters = (_solve_short if len(kinds) <= BLOCK else solve)(kinds, before, None if last else after)
            seen = [r[1] for r in found if r[1] is not None]
            turns = len(set(seen)) - (said is not None and said[0] is not None and bool(seen) and seen[0] == said[0])
            roles = ([said[1][:1]] if said is not None else []) + [r[2][:1] for r in found]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
            out.append((key, number, (part, key) not in borders, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost,
                        turns, min(seen, default=None), max(seen, default=None), _repaired(letters, found, before)))
            size += sum(len(r[3]) + 32 for r in found)
            if size > 4 << 20:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*out)), types)], names)

    kind = stored.schema["id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return _spread(stored, repeats, "id", "turn", "role", "text", "own").mapInArrow(
        run, f"id {kind}, piece int, whole boolean, {counts}, edits array<struct<edit:string,role:string,text:string>>")


def _rendered(edits: Column) -> Column:
    return F.transform(F.filter(edits, lambda e: e["role"].isNotNull()), lambda e: F.concat(e["role"], F.lit(":"), e["text"]))


def report(pieces: DataFrame) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row a conversation.

    Conversations in one piece need no shuffle. Of cut ones the turns of a conversation pass in order
    through one task, a batch at a time, because one digest covers them all.
    """
    spark = pieces.sparkSession
    kind = pieces.schema["id"].dataType.simpleString()
    pieces = keep(pieces, "repaired")
    letters = F.array_join(F.transform("edits", lambda e: e["edit"]), "")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    whole = pieces.where("whole").select(
        "id", gaps, *sums, letters.alias("audit"), F.sha2(F.array_join(_rendered(F.col("edits")), "\n"), 256).alias("repaired_sha256"))
    cut = pieces.where("NOT whole").withColumns({"audit": letters, "lines": _rendered(F.col("edits"))}).drop("edits")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for key, piece, lines in zip(*(batch[c].to_pylist() for c in ("id", "piece", "lines"))):
                if piece == 0:
                    if state is not None:
                        yield _one(*state)
                    state = key, hashlib.sha256(), False
                for line in lines:
                    state[1].update(("\n" if state[2] else "").encode() + line.encode())
                    state = *state[:2], True
        if state is not None:
            yield _one(*state)

    def _one(key, sha, _) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], id_type), pa.array([sha.hexdigest()])], ["key", "repaired_sha256"])

    id_type = pieces.select("id").limit(0).toArrow().schema.field(0).type
    hashed = cut.select("id", "piece", "lines").repartition("id").sortWithinPartitions("id", "piece").mapInArrow(
        digest, f"key {kind}, repaired_sha256 string")
    one = cut.groupBy("id").agg(*[F.sum(c).alias(c) for c in [*sums, "turns"]], F.min("low").alias("low"), F.max("high").alias("high"),
                                F.sort_array(F.collect_list(F.struct("piece", "audit"))).alias("audits"))
    joined = one.join(hashed, one["id"].eqNullSafe(hashed["key"])).select(
        "id", gaps, *sums, F.array_join(F.transform("audits", lambda a: a["audit"]), "").alias("audit"), "repaired_sha256")
    return whole.unionByName(joined)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of conversations with faults put in by crc32 of ``conv_id:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user. Nulls
    are one space, but conv_id and turn stay null where they are.
    """
    given = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    k = F.crc32(F.concat(given[0], F.lit(":"), given[1]).cast("binary")) % 20
    text = F.when(k == 1, "").when(k == 2, F.translate(given[3], ".!?", "")).otherwise(given[3])
    copies = F.explode(F.sequence(F.lit(1), F.when(k == 3, 2).otherwise(1)))
    return rows.where(k != 0).select("conv_id", "turn", F.when(k == 4, "user").otherwise(given[2]).alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def repaired_report(conversations: DataFrame) -> DataFrame:
    """The report of all conversations after ``damage``; one whose rows are all gone has zeros, an empty audit and the digest of nothing."""
    found = report(repair(damage(conversations)))
    ids = conversations.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, ids["conv_id"].eqNullSafe(found["id"]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
