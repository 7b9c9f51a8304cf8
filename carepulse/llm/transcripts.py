"""Roles of transcript lines by a hidden Markov model, and turns in one canonical form.

Every line is seen as a code of its speaker marker and a few features. Hidden
states say who speaks and whether the line begins a turn. Transition and
emission probabilities are counts over labelled lines, Viterbi finds the best states.

A transcript may be spread over many rows and partitions. Rows are sorted once by
transcript and position; a piece of a transcript inside one partition becomes a
matrix of best scores from the state before it to the state of its last line.
Only partitions' first and last pieces can belong to a longer transcript, so
those matrices alone go to the driver, which settles the states at the borders;
each partition then finds the states in between.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, slices

# Names by which transcripts mark who speaks.
SPEAKERS = {
    "user": ("user", "human", "customer", "client", "prompter", "me", "you", "q", "question", "instruction", "inst", "kunde", "utilisateur", "usuario"),
    "assistant": ("assistant", "ai", "bot", "agent", "model", "gpt", "a", "answer", "response", "support", "assistent", "asistente"),
    "system": ("system", "sys", "context", "developer"),
}
ROLES = ("user", "assistant", "system", "other")
_ROLE_OF = {name: ROLES.index(role) for role, names in SPEAKERS.items() for name in names}
_MARK = re.compile(r"^\s*(?:<\|(?:im_start\|>)?\s*|\[/?|#{1,4}\s*|\*\*|>\s*)?([A-Za-zÀ-ÿ]{1,15})\s*(?:\|>|\]|\*\*:?|:)\s*|^\s*#{1,4}\s*([A-Za-zÀ-ÿ]{1,15})\s*$")
_BULLET = re.compile(r"^\s*(?:[-*•]|\d+[.)]|```)")
NONE, OTHER = len(ROLES), len(ROLES) + 1
CODES = (len(ROLES) + 2) * 24
#: States: 2 * role, and 1 more inside a turn.
STATES = 2 * len(ROLES)


def marker(line: str) -> tuple[int, int]:
    """(role, OTHER or NONE; where the text after it begins)."""
    m = _MARK.match(line)
    if not m:
        return NONE, 0
    role = _ROLE_OF.get((m[1] or m[2]).lower(), OTHER)
    return role, m.end() if role != OTHER else 0


def code(line: str) -> int:
    """What the model sees of a line."""
    mark, at = marker(line)
    rest = line[at:].strip()
    size = 0 if not rest else 1 if len(rest) < 80 else 2
    return ((mark * 3 + size) * 2 + rest.endswith("?")) * 4 + 2 * bool(_BULLET.match(rest)) + rest.endswith(":")


_STORED = "part int, k long, id {kind}, text string, role int, learn boolean"


def _sorted(rows: DataFrame, id_col: str, order_col: str, text_col: str, role: F.Column, learn: F.Column) -> DataFrame:
    """Rows by transcript and position with the partition and place they got, stored."""
    bounded_batches(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()
    text = F.coalesce(text_col, F.lit(""))
    plain = rows.select(F.col(id_col).alias("id"), F.col(order_col).alias("pos"), text.alias("text"),
                        F.coalesce(role, F.lit(-1)).cast("int").alias("role"), F.coalesce(learn, F.lit(False)).alias("learn"))
    plain = plain.withColumn("digest", F.xxhash64("text", "role"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(k, k + n)), *batch.columns],
                ["part", "k", *batch.schema.names])
            k += n

    ordered = plain.repartitionByRange("id", "pos", "digest").sortWithinPartitions("id", "pos", "digest").drop("pos", "digest")
    return keep(ordered.mapInArrow(number, _STORED.format(kind=kind)), "transcripts")


def _spread(stored: DataFrame) -> DataFrame:
    return stored.repartition("part").sortWithinPartitions("part", "k")


def role_number(role: F.Column) -> F.Column:
    """Number of a role's name; other names are ``other``, null stays null."""
    found = F.lit(ROLES.index("other"))
    for k, name in enumerate(ROLES):
        found = F.when(F.lower(role) == name, k).otherwise(found)
    return F.when(role.isNotNull(), found)


def train(stored: DataFrame) -> dict:
    """Log probabilities from the rows that are to be learnt from, a row being one turn.
    Counts are smoothed by one; neighbours are counted inside partitions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, seen = np.zeros((STATES + 1, STATES), np.int64), np.zeros((STATES, CODES), np.int64)
        last, state = None, STATES
        for batch in slices(batches):
            for part, key, text, role, learn in zip(*(batch[c].to_pylist() for c in ("part", "id", "text", "role", "learn"))):
                state = state if last == (part, key) else STATES
                last = (part, key)
                if not learn or role < 0:
                    state = STATES
                    continue
                for i, line in enumerate(text.split("\n")):
                    new = 2 * role + (i > 0)
                    moves[state, new] += 1
                    seen[new, code(line)] += 1
                    state = new
        yield pa.RecordBatch.from_pydict({"kind": ["m"] * moves.size + ["s"] * seen.size, "k": pa.array([*range(moves.size), *range(seen.size)], pa.int32()),
                                          "n": np.concatenate([moves.ravel(), seen.ravel()])}).filter(
            pa.array(np.concatenate([moves.ravel(), seen.ravel()]) > 0))

    rows = _spread(stored.where("learn")).mapInArrow(count, "kind string, k int, n long").groupBy("kind", "k").agg(F.sum("n").alias("n")).collect()
    moves, seen = np.ones((STATES + 1) * STATES), np.full(STATES * CODES, 0.05)
    for r in rows:  # at most as many as the model has numbers
        (moves if r["kind"] == "m" else seen)[r["k"]] += r["n"]
    moves, seen = moves.reshape(STATES + 1, STATES), seen.reshape(STATES, CODES)
    for s in range(STATES + 1):  # a turn's inner lines follow lines of its own
        for t in range(1, STATES, 2):
            if s not in (t, t - 1):
                moves[s, t] = 1e-9
    return {"moves": np.log(moves / moves.sum(1, keepdims=True)), "seen": np.log(seen / seen.sum(1, keepdims=True)).T.copy()}


def viterbi(model: dict, codes: list[int], before: int, after: int | None = None) -> np.ndarray:
    """Best states of lines after a state (STATES: the beginning); the last one fixed if ``after`` is given."""
    score, back = model["moves"][before] + model["seen"][codes[0]], []
    for c in codes[1:]:
        step = score[:, None] + model["moves"][:STATES]
        back.append(step.argmax(0))
        score = step.max(0) + model["seen"][c]
    path = [int(score.argmax()) if after is None else after]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1])


def _matrix(model: dict, codes: list[int]) -> np.ndarray:
    """Best score of the lines from each state before them to each state of the last."""
    score = model["moves"] + model["seen"][codes[0]]
    for c in codes[1:]:
        score = (score[:, :, None] + model["moves"][None, :STATES]).max(1) + model["seen"][c]
    return score


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, object, list[str]]]:
    """(part, transcript, lines) of each piece."""
    at, lines = None, []
    for batch in slices(batches):
        for part, key, text in zip(*(batch[c].to_pylist() for c in ("part", "id", "text"))):
            if at != (part, key):
                if lines:
                    yield *at, lines
                at, lines = (part, key), []
            lines += text.split("\n")
    if lines:
        yield *at, lines


def _borders(stored: DataFrame, model: dict) -> dict[tuple[int, object], tuple[int, int | None, int, bool]]:
    """For pieces of transcripts that go over partitions: state before, last state, lines before, whether it is the last piece."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list] = {}
        for part, key, lines in _pieces(batches):
            kept = by_part.setdefault(part, [])
            if len(kept) == 2:
                kept.pop()
            kept.append((key, [code(x) for x in lines]))
        rows = [(part, i, pickle.dumps((key, len(codes), _matrix(model, codes)))) for part, kept in by_part.items()
                for i, (key, codes) in enumerate(kept)]
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("part", "i", "piece"), map(list, zip(*rows)))),
                                             pa.schema([("part", pa.int32()), ("i", pa.int32()), ("piece", pa.binary())]))

    found = _spread(stored.select("part", "k", "id", "text")).mapInArrow(edges, "part int, i int, piece binary").collect()  # two a partition
    chains: list[list] = []
    for r in sorted(found, key=lambda r: (r["part"], r["i"])):
        key, n, matrix = pickle.loads(r["piece"])
        if chains and chains[-1][-1][1] == key and chains[-1][-1][0] < r["part"]:
            chains[-1].append((r["part"], key, n, matrix))
        else:
            chains.append([(r["part"], key, n, matrix)])
    out = {}
    for chain in (c for c in chains if len(c) > 1):
        score, back = chain[0][3][STATES], []
        for _, _, _, matrix in chain[1:]:
            step = score[:, None] + matrix[:STATES]
            back.append(step.argmax(0))
            score = step.max(0)
        states = [int(score.argmax())]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        states, lines, before = states[::-1], 0, STATES
        for i, (part, key, n, _) in enumerate(chain):
            out[part, key] = before, states[i], lines, i == len(chain) - 1
            before, lines = states[i], lines + n
    return out


_TURNS = pa.schema([("first_line", pa.int64()), ("begins", pa.bool_()), ("role", pa.string()), ("n_lines", pa.int64()),
                    ("content", pa.string()), ("rendered", pa.string())])


def turns(stored: DataFrame, model: dict) -> DataFrame:
    """(id, first_line, begins, role, n_lines, content, rendered) of the turns found.

    ``content`` has no speaker markers; joined in order of first_line, ``rendered`` is the transcript in
    canonical form, turns as <|im_start|>role, a line break, the content and <|im_end|>. A turn that goes over a partition's end
    has a row for each part, of which only the first ``begins``.
    """
    borders = _borders(stored, model)
    kind = stored.schema["id"].dataType.simpleString()
    id_type = stored.select("id").limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for part, key, lines in _pieces(batches):
            before, after, offset, last = borders.get((part, key), (STATES, None, 0, True))
            states = viterbi(model, [code(x) for x in lines], before, after)
            cuts = [0, *[i for i in range(1, len(lines)) if states[i] % 2 == 0], len(lines)]
            for a, b in zip(cuts, cuts[1:]):
                begins, role = states[a] % 2 == 0, ROLES[states[a] // 2]
                own = [lines[a][marker(lines[a])[1]:] if begins else lines[a], *lines[a + 1:b]]
                content = "\n".join(own[1:] if begins and len(own) > 1 and not own[0].strip() else own)
                head = ("" if offset + a == 0 else "<|im_end|>\n") + f"<|im_start|>{role}\n" if begins else "\n"
                rows.append((key, offset + a, begins, role, b - a, content, head + content + ("<|im_end|>\n" if last and b == len(lines) else "")))
            if len(rows) > 2000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(map(list, zip(*rows)))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *[pa.array(c, f.type) for c, f in zip(columns[1:], _TURNS)]],
                                          ["id", *_TURNS.names])

    return _spread(stored.select("part", "k", "id", "text")).mapInArrow(
        run, f"id {kind}, first_line long, begins boolean, role string, n_lines long, content string, rendered string")


def parse(rows: DataFrame, id_col: str, order_col: str, text_col: str, role_col: str | None = None,
          learn: F.Column | None = None) -> DataFrame:
    """Turns (see ``turns``) of transcripts whose lines are in ``text_col``, over any number of rows.

    The model learns from rows for which ``learn`` holds and ``role_col`` isn't null, each one turn;
    roles other than user, assistant and system are ``other``. Without such rows all probabilities are
    equal but for the smoothing, and markers mean nothing. A null text is an empty line; rows with a null id are
    one transcript; rows of one position follow each other by a digest of text and role. Other columns are not looked at.
    """
    role = role_number(F.col(role_col)) if role_col else F.lit(None)
    stored = _sorted(rows, id_col, order_col, text_col, role, F.lit(False) if learn is None else learn)
    return turns(stored, train(stored))
