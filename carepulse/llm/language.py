"""Language of whole texts: the family first, then one-versus-one linear SVMs within it.

Features are hashed runs of two to four bytes of the lower-cased text, as shares
of all such runs. A linear machine's value for a text is then the mean weight of
its runs, so a text of any length is scored by one pass over its bytes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, raw_bytes, record, slices, texts
from .tokens import forget
from .words import sample

#: Hashed features, and the place of runs that cross the end of a text.
FEATURES = 1 << 13
UNKNOWN = "und"
#: Weights of all machines together, 32 KB each; more labels than fit are an error.
MODEL_BYTES = 128 << 20
#: Machines from which on texts are counted first and each family's machines see only its own texts.
MANY = 64
#: Places of a language's profile.
_PROFILE = 512
# Language codes by family; other languages are put into families by their profiles.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu"),
}


def family_of(lang: str) -> str:
    """The family of a listed language; before profiles are known any other stands alone."""
    return next((name for name, members in FAMILIES.items() if lang in members), f"only-{lang}")


def ngrams(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature of the run of 2, 3 and 4 bytes that starts at each byte, and the texts' offsets."""
    raw, offsets = raw_bytes(pc.utf8_lower(column))
    b = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.uint32)
    n, out = len(raw), []
    code = b[:n]
    for k in (1, 2, 3):
        code = code * np.uint32(257) + b[k:n + k]
        feature = ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int32)
        for j in range(1, k + 1):  # runs that would go on into the next text
            at = offsets[1:] - j
            feature[at[at >= offsets[:-1]]] = FEATURES
        out.append(feature)
    return out, offsets


def _train(table: pa.Table) -> pa.Table:
    """Weights of one machine: squared hinge loss with a quadratic penalty, by accelerated descent."""
    forget()
    a, b = table["pair"][0].as_py().split("\t")
    x = np.zeros((table.num_rows, FEATURES + 1), np.float32)
    for i in range(table.num_rows):
        grams, _ = ngrams(table["text"].slice(i, 1).combine_chunks())
        for g in grams:
            x[i] += np.bincount(g, minlength=FEATURES + 1)
    x = x[:, :FEATURES]
    x /= np.maximum(1, x.sum(1, keepdims=True))
    y = np.where(np.array(table["side"]) == a, 1, -1).astype(np.float32)
    scale = 1 / (np.sqrt((x ** 2).mean(0)) + 1e-4)
    x *= scale / np.sqrt(FEATURES)
    sides = {s: max(1, int((y == s).sum())) for s in (1, -1)}
    c = np.where(y > 0, 1 / sides[1], 1 / sides[-1]).astype(np.float32)
    w, bias, penalty = np.zeros(FEATURES, np.float32), 0.0, 1e-3
    v = np.ones(FEATURES, np.float32)
    for _ in range(10):
        v = x.T @ (c * (x @ v))
        v /= np.linalg.norm(v) + 1e-12
    step = 1 / (2 * float(v @ (x.T @ (c * (x @ v)))) + 4 + penalty)
    last, last_bias = w, bias
    for t in range(300):
        m = t / (t + 3)
        u, u_bias = w + m * (w - last), bias + m * (bias - last_bias)
        slack = np.maximum(0, 1 - y * (x @ u + u_bias)) * c * y
        last, last_bias = w, bias
        w = u - step * (penalty * u - 2 * (x.T @ slack))
        bias = u_bias + step * 2 * float(slack.sum())
    weights = (w * scale / np.sqrt(FEATURES)).astype("<f4")
    return pa.table({"pair": [f"{a}\t{b}"], "weights": [weights.tobytes()], "bias": [float(bias)]})


def _profile(table: pa.Table) -> pa.Table:
    """Shares of a language's runs of bytes, each text counting alike; of unit length."""
    total = np.zeros(_PROFILE)
    for text in table["text"]:
        grams, _ = ngrams(pa.array([text.as_py()]))
        counts = sum(np.bincount(g[g < FEATURES] % _PROFILE, minlength=_PROFILE) for g in grams)
        total += np.sqrt(counts / max(1, counts.sum()))
    total /= np.linalg.norm(total) + 1e-12
    return pa.table({"label": table["label"].slice(0, 1), "profile": [total.astype("<f4").tobytes()]})


def _families(chosen: DataFrame, langs: list[str]) -> dict[str, list[str]]:
    """Listed languages by FAMILIES; n others in the root of n families of like profiles, none over twice the root.

    Profiles (2 KB a language, of MOST_LABELS at most) come to the driver, where families grow around languages far apart from each other.
    """
    families: dict[str, list[str]] = {}
    for lang in langs:
        if family_of(lang) in FAMILIES:
            families.setdefault(family_of(lang), []).append(lang)
    others = [lang for lang in langs if family_of(lang) not in FAMILIES]
    if not others:
        return families
    found = chosen.where(F.col("label").isin(others)).groupBy("label").applyInArrow(_profile, "label string, profile binary").collect()
    profiles = {r["label"]: np.frombuffer(r["profile"], "<f4") for r in found}
    likeness = np.array([profiles[x] for x in others]) @ np.array([profiles[x] for x in others]).T
    heads = [0]
    while len(heads) < np.ceil(np.sqrt(len(others))):
        heads.append(int(likeness[heads].max(0).argmin()))
    room = dict.fromkeys(heads, 2 * len(heads))
    order = sorted(range(len(others)), key=lambda i: (i not in room, -likeness[heads, i].max(), i))  # the surest first
    for i in order:
        head = i if i in heads else max((h for h in heads if room[h]), key=lambda h: likeness[h, i])
        room[head] -= 1
        families.setdefault(f"like-{others[head]}", []).append(others[i])
    return {f: sorted(members) for f, members in families.items()}


def train(labelled: DataFrame, docs: DataFrame, per_language: int = 600, id_col: str = "doc_id",
          text_col: str = "text") -> dict:
    """A model from ``labelled`` (id, label) and the texts of ``docs``.

    It is fitted on at most ``per_language`` texts of a language, and every
    machine is trained by a task of its own on the texts of its two sides, at
    most as many a side. The result holds 32 KB for every pair of families and
    every pair of languages within one; languages that aren't in FAMILIES are put into families by
    their texts, so that n languages need some n to the power of 1.5 machines. More than MODEL_BYTES is an error.
    """
    bounded_batches(docs.sparkSession)
    chosen = keep(sample(labelled, docs, per_language, id_col, text_col), "language-sample")
    langs = sorted(r[0] for r in chosen.select("label").distinct().collect())  # languages, a closed set
    families = _families(chosen, langs)
    machines = sum(len(f) * (len(f) - 1) // 2 for f in (families, *families.values()))
    if machines * FEATURES * 4 > MODEL_BYTES:
        raise ValueError(f"{len(langs)} languages need {machines} machines, more than MODEL_BYTES")
    sides = []
    for a, b in combinations(sorted(families), 2):
        for f in (a, b):
            sides += [(f"f:{a}\tf:{b}", f"f:{f}", lang, 1 / len(families[f])) for lang in families[f]]
    for members in families.values():
        for a, b in combinations(members, 2):
            sides += [(f"{a}\t{b}", lang, lang, 1.0) for lang in (a, b)]
    if not sides:
        return {"families": families, "machines": {}}
    spark = docs.sparkSession
    table = spark.createDataFrame(sides, "pair string, side string, label string, share double")
    rows = chosen.join(table, "label").where(
        F.pmod(F.xxhash64("text", "pair"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    found = rows.select("pair", "side", "text").groupBy("pair").applyInArrow(
        _train, "pair string, weights binary, bias double").collect()  # the model itself
    machines = {tuple(r["pair"].split("\t")): (np.frombuffer(r["weights"], "<f4"), r["bias"]) for r in found}
    return {"families": families, "machines": machines}


def _vote(names: list[str], values: dict[tuple[str, str], np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Winner of all pairwise machines (ties by the sum of values), and its weakest win."""
    votes, sums = np.zeros((n, len(names))), np.zeros((n, len(names)))
    weakest = np.full((n, len(names)), np.inf)
    for (a, b), value in values.items():
        i, j = names.index(a), names.index(b)
        votes[:, i] += value >= 0
        votes[:, j] += value < 0
        sums[:, i] += np.tanh(value)
        sums[:, j] -= np.tanh(value)
        weakest[:, i] = np.minimum(weakest[:, i], value)
        weakest[:, j] = np.minimum(weakest[:, j], -value)
    best = (votes + sums / (2 * len(names) + 1)).argmax(1)
    return best, weakest[np.arange(n), best]


def _shares(grams: list[np.ndarray], offsets: np.ndarray) -> np.ndarray:
    """The features of the texts between the offsets, one row each."""
    out = np.zeros((len(offsets) - 1, FEATURES + 1), np.float32)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        for g in grams:
            out[i] += np.bincount(g[a:b], minlength=FEATURES + 1)
    out = out[:, :FEATURES]
    return out / np.maximum(1, out.sum(1, keepdims=True))


def _by_family(shares: np.ndarray, families: dict, column_of: dict, weights: np.ndarray, bias: np.ndarray):
    """(language, weakest win) of each row: all machines of families, then those of the family found."""
    def values(keys: list, rows: np.ndarray) -> dict:
        at = [column_of[k] for k in keys]
        out = rows @ weights[:FEATURES, at] + bias[at]
        return {key: out[:, j] for j, key in enumerate(keys)}

    names, n = sorted(families), len(shares)
    between = values([k for k in column_of if k[0].startswith("f:")], shares)
    best, margin = _vote(names, {(a[2:], b[2:]): v for (a, b), v in between.items()}, n)
    pred, weak = np.full(n, UNKNOWN, object), np.zeros(n)
    for f in np.unique(best):
        members, at = families[names[f]], np.flatnonzero(best == f)
        inner = [k for k in combinations(members, 2) if k in column_of]
        won, inside = _vote(members, values(inner, shares[at]), len(at))
        pred[at], weak[at] = np.array(members, object)[won], np.minimum(margin[at], inside)
    return pred, weak


def _answer(batch: pa.RecordBatch, names_out: list[str], column: pa.Array, pred: np.ndarray, weak: np.ndarray, learned: bool) -> pa.RecordBatch:
    """The batch with language and score; texts without a letter have none."""
    letters = pc.match_substring_regex(column, r"\pL").to_numpy(zero_copy_only=False) & learned
    with np.errstate(over="ignore"):
        score = np.where(letters, 1 / (1 + np.exp(-2 * weak)), 0.0)
    pred = pa.array(np.where(letters, pred, UNKNOWN).tolist(), pa.string())
    return pa.RecordBatch.from_arrays([*[batch[c] for c in names_out], pred, pa.array(score)], [*names_out, "lang_pred", "score"])


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
            carry: list[str] | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, or the ``carry`` columns with lang_pred and score.

    A null text, or one without any letter, is ``und`` with score 0. The score is
    the logistic value of the weakest machine that the winner has won, family
    and language; it is 1 where there is only one language to choose. Without any
    learned language all is ``und``. Other columns are passed through or not looked at.
    """
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    families, shared = model["families"], spark.sparkContext.broadcast(pickle.dumps(model["machines"]))
    carried = {"doc_id": id_col} if carry is None else {f"_llm_{i}": c for i, c in enumerate(carry)}
    rows = docs.select(F.col(text_col).alias("text"), *[F.col(c).alias(k) for k, c in carried.items() if c != text_col])
    names_out = [k if c != text_col else "text" for k, c in carried.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        machines = pickle.loads(shared.value)
        keys = list(machines)
        weights = np.zeros((FEATURES + 1, max(1, len(keys))), np.float32)
        for k, key in enumerate(keys):
            weights[:FEATURES, k] = machines[key][0]
        bias = np.array([machines[key][1] for key in keys])
        names = sorted(families)
        column_of = {key: k for k, key in enumerate(keys)}
        many = len(keys) > MANY
        for batch in slices(batches, limit=1 << 20):
            column, n = texts(batch), batch.num_rows
            grams, offsets = ngrams(column)
            if many:
                pred, weak = np.full(n, UNKNOWN, object), np.zeros(n)
                for at in range(0, n, 500):
                    shares = _shares(grams, offsets[at:at + 501])
                    now = slice(at, at + len(shares))
                    pred[now], weak[now] = _by_family(shares, families, column_of, weights, bias)
                yield _answer(batch, names_out, column, pred, weak, True)
                continue
            total, count = np.zeros((n, len(keys))), np.zeros(n)
            full = np.diff(offsets) > 0
            begins = offsets[:-1][full]
            if len(begins):
                for g in grams:
                    if keys:
                        total[full] += np.add.reduceat(weights[g], begins, axis=0, dtype=np.float64)
                    count[full] += np.add.reduceat(g < FEATURES, begins, dtype=np.int64)
            values = total / np.maximum(1, count)[:, None] + bias if keys else total
            by = {key: values[:, k] for k, key in enumerate(keys)}
            pick = {(a[2:], b[2:]): v for (a, b), v in by.items() if a.startswith("f:")}
            best, margin = _vote(names, pick, n) if names else (np.zeros(n, int), np.zeros(n))
            pred, weak = np.full(n, UNKNOWN, object), np.zeros(n)
            for f, name in enumerate(names):
                members, at = families[name], np.flatnonzero(best == f)
                inner = {key: v[at] for key, v in by.items() if key[0] in members and key[1] in members}
                won, inside = _vote(members, inner, len(at))
                pred[at] = np.array(members, object)[won]
                weak[at] = np.minimum(margin[at], inside)
            yield _answer(batch, names_out, column, pred, weak, bool(names))

    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names_out) + ", lang_pred string, score double")
    return out.select(*[F.col(k).alias(c) for k, c in zip(names_out, carried.values())], "lang_pred", "score")


def accepted(docs: DataFrame, model: dict, text_col: str = "text", least_score: float = 0.0,
             languages: list[str] | None = None, fill: str | None = None) -> DataFrame:
    """The rows of ``docs`` in one of ``languages`` (without them, in any that was learned), with all their columns.

    A text is in the language that ``predict`` finds; below ``least_score`` it is in none. At about 0.5 the
    machines can't tell the language from the next one, as for a script that none of them has seen. Texts without a letter are in
    none. A NULL in the column ``fill`` becomes the language found.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = plain.columns[docs.columns.index(text_col)]
    found = predict(plain, model, plain.columns[0], text, carry=plain.columns)
    keep = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
    found = found.where(keep if languages is None else keep & F.col("lang_pred").isin(languages))
    filled = plain.columns[docs.columns.index(fill)] if fill in docs.columns else None
    return found.select(*[F.coalesce(c, "lang_pred").alias(c) if c == filled else c for c in plain.columns]).toDF(*docs.columns)
