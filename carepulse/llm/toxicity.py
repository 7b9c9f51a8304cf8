"""Toxic spans by a linear-chain conditional random field, and scores of whole texts.

Only documents are labelled, so tokens get their labels in two steps: a token of
a toxic document is toxic if one of its features (the word, its beginnings, its
endings) is found in far more toxic than clean documents than chance allows; the
field that learns these labels then relabels the tokens by its marginals and is
trained again. It has two states, weights for the hashed features of a word, and
weights for the step from one word to the next. Forward and backward passes run
word by word over all lines of a batch at once.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, record, slices
from .words import Words, sample, split_words

#: Hashed word features; the last place is that of no feature.
FEATURES = 1 << 18
_PER_WORD = 9
#: Words whose value a Python worker remembers.
REMEMBERED = 200_000
#: Documents that a feature must be found in to get a weight, and the pull of all weights to 0.
SUPPORT, PENALTY = 4, 1.0
#: Texts that train the field, by label, and their words and lines in all.
SAMPLE, SAMPLE_WORDS, SAMPLE_LINES = {1: 1500, 0: 6000}, 6_000_000, 12_000


def features(word: str) -> list[int]:
    """Places of a word's features: itself, its first 3 to 7 letters, its last 3 and 4."""
    word = word.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789")
    if not word:
        return []
    names = [f"w{word}", *[f"p{word[:k]}" for k in (3, 4, 5, 6, 7) if len(word) >= k],
             *[f"s{word[-k:]}" for k in (3, 4) if len(word) >= k]]
    return [zlib.crc32(x.encode()) % FEATURES for x in names]


def _lines(words: Words) -> np.ndarray:
    """Where lines begin, in words: a text's first word, and words after a line break."""
    breaks = np.concatenate([[0], np.cumsum(words.raw == 10)])[words.start]
    new = np.zeros(len(words.start), bool)
    new[1:] = breaks[1:] != breaks[:-1]
    firsts = words.first[:-1][np.diff(words.first) > 0]
    new[firsts] = True
    return np.flatnonzero(new)


def marginals(emission: np.ndarray, begin: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Log odds of state 1 for every word. ``emission``: the words' own log odds; ``begin``: offsets of
    the lines; ``steps``: log weights of the steps 00, 01, 10, 11.

    With two states the forward message of a line is one number, the log odds
    of all that came before, and the backward one likewise.
    """
    n = len(emission)
    length = np.diff(np.append(begin, n))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    s00, s01, s10, s11 = steps
    before, after = np.zeros(n), np.zeros(n)
    longest = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
    state = np.zeros(len(begin))
    for t in range(1, longest):
        k = alive[t]
        odds = state[:k] + emission[begin[:k] + t - 1]
        state = np.logaddexp(s01, s11 + odds) - np.logaddexp(s00, s10 + odds)
        before[begin[:k] + t] = state
    state = np.zeros(len(begin))
    for t in range(longest - 2, -1, -1):
        k = alive[t + 1]
        at = begin[:k] + t
        odds = after[at + 1] + emission[at + 1]
        after[at] = np.logaddexp(s10, s11 + odds) - np.logaddexp(s00, s01 + odds)
    return before + emission + after


def _table(distinct: list[str]) -> np.ndarray:
    """Feature places of distinct words, padded."""
    out = np.full((len(distinct), _PER_WORD), FEATURES, np.int32)
    for i, word in enumerate(distinct):
        f = features(word)
        out[i, :len(f)] = f
    return out


def _telling(docs_words: list[np.ndarray], toxic: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features that mark toxic documents, as they are far more frequent there than chance allows, and
    those found in enough documents to get a weight at all."""
    seen = np.zeros((2, FEATURES + 1))
    for codes, label in zip(docs_words, toxic):
        seen[int(label), np.unique(table[codes])] += 1
    n = np.maximum(1, [np.sum(~toxic), np.sum(toxic)])
    share = n[1] / n.sum()
    total = seen.sum(0)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(seen[1] > 0, seen[1] * np.log(seen[1] / (total * share)), 0)
                 + np.where(seen[0] > 0, seen[0] * np.log(seen[0] / (total * (1 - share))), 0))
    often = (seen[1] + 0.5) / (n[1] + 1) / ((seen[0] + 0.5) / (n[0] + 1))
    found = (g > 30) & (often > 8)
    usual = total >= SUPPORT
    found[FEATURES] = usual[FEATURES] = False
    return found, usual


def _fit(docs_words, lines_of, toxic, table):
    """The field's weights from token labels."""
    telling, usual = _telling(docs_words, toxic, table)
    marked = telling[table].any(1)
    rng = np.random.default_rng(0)
    lines, owners = [], []
    for d, codes in enumerate(docs_words):
        for part in np.split(codes, lines_of[d][1:]):
            lines += [part[k:k + 64] for k in range(0, len(part), 64)]
        owners += [d] * (len(lines) - len(owners))
    owners = np.array(owners)
    hit = np.array([bool(toxic[d]) and bool(marked[x].any()) for x, d in zip(lines, owners)], bool)
    rest = rng.permutation(np.flatnonzero(~hit))[:max(0, SAMPLE_LINES - min(SAMPLE_LINES // 2, int(hit.sum())))]
    chosen = np.concatenate([rng.permutation(np.flatnonzero(hit))[:SAMPLE_LINES // 2], rest])
    lines = [lines[k] for k in chosen if len(lines[k])]
    owners = [owners[k] for k in chosen if len(lines) and len(docs_words[owners[k]])][:len(lines)]
    codes = np.concatenate([*lines, np.zeros(0, np.int64)]).astype(np.int64)
    begin = np.cumsum([0, *map(len, lines)])[:-1].astype(np.int64)
    inside = np.repeat(toxic[np.array(owners, np.int64)] if len(owners) else np.zeros(0, bool),
                       np.array([len(x) for x in lines], np.int64))
    label = (marked[codes] & inside).astype(float)
    weights, steps, bias = np.zeros(FEATURES + 1), np.log([[0.99, 0.01], [0.6, 0.4]]).ravel(), -3.0
    if not label.any():
        return weights, steps, -20.0
    used = table[codes]
    first, moves = np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
    first[begin] = True
    speed, pull = np.zeros(FEATURES + 1), 0.0
    for turn in range(2):
        moves[1:] = (2 * label[:-1] + label[1:]).astype(np.int64)
        counts = np.bincount(moves[~first], minlength=4) + np.array([1.0, 0.1, 0.1, 0.1])
        counts = counts.reshape(2, 2)
        steps = np.log(counts / counts.sum(1, keepdims=True)).ravel()
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(marginals(weights[used].sum(1) + bias, begin, steps), -30, 30)))
            wrong = np.where(label > 0, 4.0, 1.0) * (p - label)
            slope = (np.bincount(used.ravel(), np.repeat(wrong, _PER_WORD), FEATURES + 1) + PENALTY * weights) * usual
            speed += slope ** 2
            weights -= 0.5 * slope / (np.sqrt(speed) + 1e-6)
            drop = wrong.sum()
            pull += drop ** 2
            bias -= 0.3 * drop / (np.sqrt(pull) + 1e-6)
        odds = marginals(weights[used].sum(1) + bias, begin, steps)
        label = ((odds > 0) & inside).astype(float)
        if not label.any():
            break
    return weights, steps, bias


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a penalised logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        beta = beta - np.linalg.solve(h, x.T @ (p - y) + 0.05 * beta)
    return beta


def _summary(odds: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Of each text (all non-empty): the two largest log odds of a word, the log of the expected
    number of toxic words, and of their share."""
    odds = np.clip(odds, -20, 20)
    count = np.diff(np.append(begin, len(odds)))
    owner = np.repeat(np.arange(len(begin)), count)
    top = np.maximum.reduceat(odds, begin)
    at = np.flatnonzero(odds == top[owner])
    rest = odds.copy()
    rest[at[np.unique(owner[at], return_index=True)[1]]] = -20
    expected = np.log(np.add.reduceat(1 / (1 + np.exp(-odds)), begin) + 1e-3)
    return np.column_stack([top, np.maximum.reduceat(rest, begin), expected, expected - np.log(count)])


_EMPTY = np.array([-20.0, -20.0, np.log(1e-3), np.log(1e-3)])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    docs_words, lines_of, toxic, n = [], [], [], 0
    for batch in slices(batches):
        words = split_words(batch)
        if n > SAMPLE_WORDS:
            continue
        n += len(words.codes)
        codes = np.array([known.setdefault(w, len(known)) for w in words.distinct], np.int64)[words.codes] \
            if words.distinct else np.zeros(0, np.int64)
        starts = _lines(words)
        for k, label in enumerate(batch["label"].to_pylist()):
            a, b = words.first[k], words.first[k + 1]
            docs_words.append(codes[a:b])
            lines_of.append(starts[(starts >= a) & (starts < b)] - a)
            toxic.append(label == 1)
    toxic = np.array(toxic, bool)
    if not (toxic.any() and (~toxic).any()):
        share = float(toxic.all()) if len(toxic) else 0.0
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps({"share": share})]})
        return
    table = _table(list(known))
    # calibrate on texts that the field has not seen, then let it learn from all
    half = np.arange(len(toxic)) % 2 == 0
    rows, labels = [], []
    for part in (half, ~half):
        if toxic[part].any() and (~toxic[part]).any():
            keep_it = np.flatnonzero(part)
            weights, steps, bias = _fit([docs_words[k] for k in keep_it], [lines_of[k] for k in keep_it], toxic[part], table)
            values = weights[table].sum(1) + bias
            for k in np.flatnonzero(~part):
                rows.append(_summary(marginals(values[docs_words[k]], lines_of[k], steps), np.array([0]))[0]
                            if len(docs_words[k]) else _EMPTY)
                labels.append(toxic[k])
    beta = _logistic(np.array(rows), np.array(labels, float)) if rows else np.array([1.0, 0.0, 0.0, 0.0, 0.0])
    weights, steps, bias = _fit(docs_words, lines_of, toxic, table)
    model = {"weights": weights.astype(np.float32), "steps": steps, "bias": bias, "beta": beta}
    yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})


def train(labelled: DataFrame, docs: DataFrame, most: dict | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> dict:
    """A model from ``labelled`` (id, label 0 or 1) and the texts of ``docs``.

    One task fits it on a bounded sample: at most ``most`` texts by label
    (SAMPLE), the whole texts until SAMPLE_WORDS words are reached. An id with
    both labels counts as toxic. The model is 1 MB. With one label only, or none, every
    score is that label's.
    """
    bounded_batches(docs.sparkSession)
    labelled = labelled.where("label IN (0, 1)").groupBy("id").agg(F.max("label").cast("int").alias("label"))
    chosen = keep(sample(labelled, docs, most or SAMPLE, id_col, text_col), "toxicity-sample")
    row = chosen.orderBy(F.xxhash64("text")).repartition(1).mapInArrow(_train, "model binary").first()
    return pickle.loads(row["model"]) if row else {"share": 0.0}


_MEMORY: dict = {}


def _values(model: dict, key: int, distinct: list[str]) -> np.ndarray:
    """Log odds of distinct words by themselves, remembered for the worker's next batch."""
    if _MEMORY.get("key") != key or len(_MEMORY["known"]) > REMEMBERED:
        _MEMORY.update(key=key, known={})
    known = _MEMORY["known"]
    new = [w for w in distinct if w not in known]
    if new:
        values = model["weights"][_table(new)].sum(1) + model["bias"]
        known.update(zip(new, values.tolist()))
    return np.fromiter((known[w] for w in distinct), np.float64, len(distinct))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, n_toxic_words, spans) of every row.

    ``score`` is the calibrated probability from the words' marginals; spans are
    the words with a marginal of one half or more as start:end in code points, runs of
    them within a line joined, separated by commas. A null or empty text has no words and gets the
    score of none. Repeated rows are scored each; other columns are not looked at.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(pickle.dumps(model))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, key = pickle.loads(shared.value), zlib.crc32(shared.value)
        for batch in slices(batches):
            n = batch.num_rows
            scores, spans, found = np.zeros(n), [""] * n, np.zeros(n, np.int64)
            if "share" in model:
                scores[:] = model["share"]
            else:
                words = split_words(batch)
                starts = _lines(words)
                odds = marginals(_values(model, key, words.distinct)[words.codes], starts, model["steps"])
                full = np.diff(words.first) > 0
                stats = np.tile(_EMPTY, (n, 1))
                if full.any():
                    stats[full] = _summary(odds, words.first[:-1][full])
                value = np.clip(np.column_stack([stats, np.ones(n)]) @ model["beta"], -30, 30)
                scores = 1 / (1 + np.exp(-value))
                spans, found = _spans(words, starts, odds > 0)
            schema = pa.schema([("doc_id", batch["id"].type), ("score", pa.float64()), ("predicted", pa.int32()),
                                ("n_toxic_words", pa.int64()), ("spans", pa.string())])
            yield record(schema, batch["id"], scores, (scores >= 0.5).astype(np.int32), found, spans)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, n_toxic_words long, spans string")


def _spans(words: Words, lines: np.ndarray, toxic: np.ndarray) -> tuple[list[str], np.ndarray]:
    n = len(words.first) - 1
    owner = np.repeat(np.arange(n), np.diff(words.first))
    out: list[list[str]] = [[] for _ in range(n)]
    at = np.flatnonzero(toxic)
    if len(at):
        line = np.searchsorted(lines, at, side="right")
        new = np.append(True, (np.diff(at) > 1) | (np.diff(line) > 0))
        first, last = at[new], at[np.append(new[1:], True)]
        begin, end = words.points(words.start[first], owner[first]), words.points(words.end[last], owner[first])
        for d, a, b in zip(owner[first].tolist(), begin.tolist(), end.tolist()):
            out[d].append(f"{a}:{b}")
    return [",".join(x) for x in out], np.bincount(owner[at], minlength=n)
