"""Personal data by weak supervision, in DataFrame expressions only.

Strict patterns give the base spans. Loose patterns give further candidates.
Labelers (pattern, checksum, gazetteer, context, surroundings) vote yes, no or
nothing on every candidate. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is, and the posteriors train a logistic classifier
of spans, whose weights become literals of the plan. Base spans always stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns. Possessive quantifiers and the look-behind only save
# the engine from trying places at which the plain pattern can't begin a leftmost match.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that a text must pass before a pattern is tried on it.
_MAY = {"email": "@", "phone": "+"}
_CARD_MAY = r"[0-9](?:[\x20-]?[0-9]){11}"
LOOSE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
}
# Word lists of the labelers.
DOMAINS = "com|org|net|edu|gov|mil|info|io|co|uk|de|fr|es|it|nl|eu|us|ca|ch|at|be|pt|pl|ru|jp|cn|in|br"
COUNTRY_CODES = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|54|55|56|57|60|61|62|63|64|65|66|81|82|84|86|90|91"
ISSUERS = "4|5[1-5]|2[2-7]|34|37|36|38|60|62|65"
CUES = {
    "email": "e-?mail|mail|contact|contacto|kontakt|write|reach|courriel|correo",
    "ip": "ip|host|server|address|adresse|login|from",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment|cc",
    "phone": "phone|tel|telephone|call|mobile|fax|cell|telefon|téléphone|teléfono|sms",
}
AGAINST = "version|release|isbn|issn|page|chapter|order|invoice|item|sku|part|section|build|doi|rfc"
#: Code points before a span in which cues count.
CONTEXT = 24
_NEVER, _RUN = (1 << 31) - 1, 64
LABELERS = ("pattern", "checksum", "gazetteer", "context", "surroundings")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(items: Column, first: int, step) -> Column:
    """``first``, and the value after each item, for a ``step`` that adds up or takes the larger or smaller.

    In runs of _RUN items: the values before each run, then those within it, so that
    the work doesn't grow with the square of the items.
    """

    def values(x: Column) -> Column:
        run = lambda k, n: F.slice(x, k * _RUN + 1, n)
        heads = F.aggregate(F.sequence(F.lit(0), F.floor(F.size(x) / _RUN).cast("int")), F.array(F.lit(first)).cast("array<int>"),
                            lambda a, k: F.array_append(a, F.aggregate(run(k, _RUN), F.element_at(a, -1), step)).cast("array<int>"))
        return _let(heads, lambda h: F.transform(F.sequence(F.lit(0), F.size(x)), lambda i: F.aggregate(
            run(F.floor(i / _RUN).cast("int"), i % _RUN), F.get(h, F.floor(i / _RUN).cast("int")), step)))

    return _let(items, values)


def _find(text: Column, pattern: str, may: Column) -> Column:
    """Array of the leftmost matches: start, end, value, what is to its left (up to the match before), and the
    characters beside it. What lies between the matches, and their own lengths, add up to the places."""

    def places(m: Column) -> Column:
        steps = F.zip_with(F.slice(m["between"], 1, F.size(m["values"])), m["values"], lambda b, v: F.length(b) + F.length(v))
        return _let(_running(steps, 0, lambda last, n: last + n), lambda ends: F.transform(m["values"], lambda v, i: F.struct(
            (F.get(ends, i + 1) - F.length(v)).alias("start"), F.get(ends, i + 1).alias("end"), v.alias("value"),
            F.lower(F.substring(F.get(m["between"], i), -CONTEXT, CONTEXT)).alias("left"),
            F.concat(F.substring(F.get(m["between"], i), -1, 1), F.substring(F.get(m["between"], i + 1), 1, 1)).alias("beside"))))

    found = _let(F.struct(F.split(text, pattern, -1).alias("between"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")), places)
    return F.when(may, found).otherwise(F.array().cast("array<struct<start:int,end:int,value:string,left:string,beside:string>>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the sum of digits, every second from the right doubled (9 less beyond 9), ends in 0."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(_digits(value))
    return n.between(9, 15) if kind == "phone" else F.when(n.between(12, 19), luhn(_digits(value))).otherwise(F.lit(False))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("byte")


def _labelled(kind: str, m: Column, strict: Column) -> Column:
    """A candidate with its votes and shape."""
    value, start, end = m["value"], m["start"], m["end"]
    digits = _digits(value)
    left, beside = m["left"], m["beside"]
    check = {
        "email": (value.rlike(r"\.[A-Za-z]{2,}$"), ~value.rlike(r"[.\]]")),
        "ip": (_valid("ip", value), ~_valid("ip", value)),
        "card": (_valid("card", value), ~_valid("card", value)),
        "phone": (F.length(digits).between(9, 15), ~F.length(digits).between(9, 15)),
    }[kind]
    known = {
        "email": (F.lower(value).rlike(rf"\.(?:{DOMAINS})$"), F.lit(False)),
        "ip": (~value.rlike(r"^(?:0|10|127|192\.168|255)\."), value.rlike(r"^(?:0|127|255)\.")),
        "card": (digits.rlike(rf"^(?:{ISSUERS})"), ~digits.rlike(rf"^(?:{ISSUERS})")),
        "phone": (value.rlike(rf"^\+(?:{COUNTRY_CODES})") | digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^0{3}")),
    }[kind]
    grouped = {"email": value.rlike("^[A-Za-z]"), "ip": F.lit(True), "card": value.rlike("^(?:[0-9]{4}[ -]?){3,4}[0-9]{0,4}$"),
               "phone": value.rlike(r"[() .-]")}[kind]
    return F.struct(
        start.alias("start"), F.lit(KINDS.index(kind)).cast("byte").alias("kind"), end.alias("end"), strict.alias("base"),
        _vote(strict, ~strict).alias("pattern"), _vote(*check).alias("checksum"), _vote(*known).alias("gazetteer"),
        _vote(left.rlike(rf"(?<!\pL)(?:{CUES[kind]})(?!\pL)"), left.rlike(rf"(?<!\pL)(?:{AGAINST})(?!\pL)")).alias("context"),
        _vote(F.lit(False), beside.rlike(r"[\pL\pN_/=]")).alias("surroundings"), grouped.alias("grouped"))


def _labeller(kind: str, strict: bool):
    return lambda m: _labelled(kind, m, _valid(kind, m["value"]) if strict else F.lit(False))


def candidates(text: Column) -> Column:
    """Array of candidates of a text (null: none), by start and kind; loose ones don't overlap strict ones."""
    text = F.coalesce(text, F.lit(""))
    strict = []
    for kind in KINDS:
        may = F.contains(text, F.lit(_MAY[kind])) if kind in _MAY else text.rlike(BASE[kind] if kind == "ip" else _CARD_MAY)
        strict.append(F.transform(_find(text, BASE[kind], may), _labeller(kind, True)))
    may = {"email": F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]"), "phone": text.rlike(LOOSE["phone"])}
    loose = F.concat(*[F.transform(_find(text, p, may[kind]), _labeller(kind, False)) for kind, p in LOOSE.items()])

    def apart(found: Column) -> Column:
        """Base spans, and candidates that overlap none: none before ends, none after begins, inside them."""
        reach = _running(found, 0, lambda last, c: F.when(c["base"], F.greatest(last, c["end"])).otherwise(last))
        following = _running(F.reverse(found), _NEVER, lambda last, c: F.when(c["base"], F.least(last, c["start"])).otherwise(last))
        both = F.struct(reach.alias("reach"), following.alias("following"))
        return _let(both, lambda m: F.filter(found, lambda c, i: c["base"] | (
            (F.get(m["reach"], i) <= c["start"]) & (F.get(m["following"], F.size(found) - 1 - i) >= c["end"]))))

    return _let(F.array_sort(F.concat(*strict, loose)), apart)


@dataclass
class Model:
    """Weights of the span classifier; what EM found out about the labelers, as a report."""

    weights: dict[str, float]
    reliabilities: dict[str, dict[str, float]]

    def probability(self, c: Column) -> Column:
        value = F.lit(self.weights["bias"])
        for k, kind in enumerate(KINDS):
            value = value + F.when(c["kind"] == k, self.weights[kind]).otherwise(0.0)
        for name in LABELERS:
            value = value + F.when(c[name] == 1, self.weights[f"{name}+"]).when(c[name] == -1, self.weights[f"{name}-"]).otherwise(0.0)
        return 1 / (1 + F.exp(-(value + F.when(c["grouped"], self.weights["grouped"]).otherwise(0.0))))


def _expectation_maximisation(counts: list[tuple[int, tuple[int, ...], int]], rounds: int = 60):
    """Posterior of each (kind, votes) under votes that are independent given the truth, and each
    labeler's vote shares for true and false spans."""
    post = [1 / (1 + math.exp(-sum(votes))) for _, votes, _ in counts]
    shares = {}
    for _ in range(rounds):
        prior = {k: [1.0, 1.0] for k in range(len(KINDS))}
        shares = {(j, y, v): 0.5 for j in range(len(LABELERS)) for y in (0, 1) for v in (-1, 0, 1)}
        for (kind, votes, n), p in zip(counts, post):
            for y, w in ((1, n * p), (0, n * (1 - p))):
                prior[kind][y] += w
                for j, v in enumerate(votes):
                    shares[j, y, v] += w
        for j in range(len(LABELERS)):
            for y in (0, 1):
                total = sum(shares[j, y, v] for v in (-1, 0, 1))
                for v in (-1, 0, 1):
                    shares[j, y, v] /= total
        post = []
        for kind, votes, _ in counts:
            odds = math.log(prior[kind][1] / prior[kind][0])
            odds += sum(math.log(shares[j, 1, v] / shares[j, 0, v]) for j, v in enumerate(votes))
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return post, shares


def _logistic(rows: list[tuple[dict[str, float], float, float]], names: list[str], steps: int = 400) -> dict[str, float]:
    """Weights of a penalised logistic regression on (features, target, weight)."""
    weights, seen = dict.fromkeys(names, 0.0), dict.fromkeys(names, 1e-9)
    total = sum(n for _, _, n in rows) or 1.0
    for _ in range(steps):
        slope = {k: 0.002 * w for k, w in weights.items()}
        for features, target, n in rows:
            value = sum(weights[k] * x for k, x in features.items())
            wrong = (1 / (1 + math.exp(-max(-30.0, min(30.0, value)))) - target) * n / total
            for k, x in features.items():
                slope[k] += wrong * x
        for k, s in slope.items():
            seen[k] += s * s
            weights[k] -= 0.3 * s / math.sqrt(seen[k])
    return weights


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """The classifier from the candidates of all texts. Only counts of vote patterns leave the
    executors, at most 4 kinds x 3^5 votes x 2 shapes. Without any candidate all weights are 0."""
    c = F.col("c")
    found = docs.select(F.explode(candidates(F.col(text_col))).alias("c"))
    rows = found.groupBy(c["kind"].alias("kind"), *[c[n].alias(n) for n in LABELERS], c["grouped"].alias("grouped")).count().collect()
    rows = sorted((r["kind"], tuple(r[n] for n in LABELERS), r["grouped"], r["count"]) for r in rows)
    votes: dict[tuple, int] = {}
    for kind, v, _, n in rows:
        votes[kind, v] = votes.get((kind, v), 0) + n
    counts = [(kind, v, n) for (kind, v), n in votes.items()]
    post, shares = _expectation_maximisation(counts)
    truth = {(kind, v): p for (kind, v, _), p in zip(counts, post)}
    names = ["bias", "grouped", *KINDS, *[f"{n}{s}" for n in LABELERS for s in "+-"]]
    examples = []
    for kind, v, grouped, n in rows:
        features = {"bias": 1.0, KINDS[kind]: 1.0} | ({"grouped": 1.0} if grouped else {})
        features |= {f"{name}{'+' if x > 0 else '-'}": 1.0 for name, x in zip(LABELERS, v) if x}
        examples.append((features, truth[kind, v], float(n)))
    weights = _logistic(examples, names) if examples else dict.fromkeys(names, 0.0)
    return Model(weights, {n: {f"{'true' if y else 'false'}{v:+d}": shares[j, y, v] for y in (1, 0) for v in (-1, 0, 1)}
                           for j, n in enumerate(LABELERS)})


def spans(text: Column, model: Model, threshold: float = 0.5) -> Column:
    """Array of (start, kind, end, base) of a text: base spans and candidates with the threshold's probability
    or more, by start, then kind in the order of KINDS. Null texts have none."""
    return F.transform(F.filter(candidates(text), lambda c: c["base"] | (model.probability(c) > threshold)),
                       lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base")))


def written(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"].cast("int") + 1), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, found: Column) -> Column:
    """The text with every span, overlapping ones as one, replaced by <KIND> of its first."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["done"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                         F.element_at(names, s["kind"].cast("int") + 1))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], fresh).otherwise(acc["done"]).alias("done"))

    whole = F.aggregate(found, begin, step, lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)


def find(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array) of every row; other columns are not looked at. Null texts have no spans."""
    model = model or train(docs, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col), model).alias("spans"))


def redact(docs: DataFrame, model: Model | None = None, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the spans of ``text_col`` replaced; a null text stays null."""
    model = model or train(docs, text_col)
    text = F.col(text_col)
    return docs.select(*[_let(spans(text, model), lambda s: redacted(text, s)).alias(c) if c == text_col else F.col(c)
                         for c in docs.columns])
