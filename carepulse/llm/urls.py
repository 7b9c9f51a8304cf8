"""Judge URLs by rules of host and path: hashed expressions, joined on short prefixes."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import keep

#: Hex digits of a SHA-256 digest that expressions and rules are joined on.
SHORT = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the URL is null or has no ``://``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return _lower(host), path


def _lower(host: Column) -> Column:
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, "[.]", -1))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.translate(path, "/", ""))


def _folder(path: Column, depth: Column) -> Column:
    """The path up to and with its slash number ``depth``."""
    return F.when(depth > 0, F.concat(F.call_function("substring_index", path, F.lit("/"), depth), F.lit("/"))).otherwise("")


def _segment(path: Column, folder: Column) -> Column:
    return F.substring_index(F.substring(path, F.length(folder) + 1, F.length(path)), "/", 1)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, SHORT), 16, 10).cast("long")


def hashed_rules(rules: DataFrame) -> DataFrame:
    """(short, digest, rule, size, host_size, labels, depth, tail, verdict), one row a rule.

    ``rules`` has columns host, path and verdict. Rows with a null in one of them are no
    rules. A rule given with several verdicts has the greatest of them by name: block before allow.
    """
    plain = rules.select(_lower(F.col("host").cast("string")).alias("host"), F.col("path").cast("string").alias("path"),
                         F.col("verdict").cast("string").alias("verdict")).na.drop()
    one = plain.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.concat("host", "path")
    depth = _slashes(F.col("path"))
    return one.select(
        _short(F.sha2(rule, 256)).alias("short"), F.sha2(rule, 256).alias("digest"), rule.alias("rule"),
        F.length(rule).alias("size"), F.length("host").alias("host_size"), _labels(F.col("host")).alias("labels"),
        depth.alias("depth"), (F.length("path") - F.length(_folder(F.col("path"), depth))).alias("tail"), "verdict")


def _shapes(hashed: DataFrame) -> tuple[list[int], list[tuple[int, int]]]:
    """Numbers of labels, and (slashes, letters after the last slash), that rules have.

    They are small integers no larger than the longest rule, however many rules there are.
    """
    found = hashed.agg(F.collect_set("labels").alias("labels"), F.collect_set(F.struct("depth", "tail")).alias("paths")).first()
    return sorted(found["labels"]), sorted((p["depth"], p["tail"]) for p in found["paths"])


def expressions(host: Column, path: Column, labels: list[int], paths: list[tuple[int, int]]) -> Column:
    """All host suffixes of so many labels, each followed by all path prefixes of these shapes."""
    counts = F.array(*map(F.lit, labels)).cast("array<int>")
    shapes = F.array(*[F.struct(F.lit(d).alias("depth"), F.lit(t).alias("tail")) for d, t in paths])

    def prefix(shape: Column) -> Column:
        folder = _folder(path, shape["depth"])
        segment = _segment(path, folder)
        fits = (shape["depth"] <= _slashes(path)) & (shape["tail"] <= F.length(segment))
        return F.when(fits, F.concat(folder, F.substring(segment, F.lit(1), shape["tail"])))

    suffixes = F.transform(F.filter(counts, lambda n: n <= _labels(host)),
                           lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    prefixes = F.filter(F.transform(shapes, prefix), lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          unlisted: str = "allow") -> DataFrame:
    """(``id_col``, host, path, rule, verdict) of every row; ``rules`` as in ``hashed_rules``.

    A rule fits its host and all hosts below it, if the path starts with the rule's path. Of the rules
    that fit the longest (host and path together) decides, of equally long ones that with the longer host. URLs that no rule fits have a
    null rule and the verdict ``unlisted``. A null URL, or one without ``://``, has an empty host and
    path. Rows are judged one by one: null or repeated ids and repeated URLs give a row each; other
    columns are not looked at. Without rows the result has none; without rules nothing fits.

    What rules can tell apart of a URL is its head: the last labels of the host and the first segments of
    the path. Distinct heads are expanded, so a host that a third of all URLs have is looked up once. Expressions meet
    rules on the first 32 bits of their SHA-256 and are confirmed by all 256. No side is hinted: Spark broadcasts
    rules, or what was found, only below its threshold, and splits a frequent head otherwise; what was
    found is stored first, since a join can't be split above the aggregate that makes one side.
    """
    hashed = keep(hashed_rules(rules), "rules")
    labels, paths = _shapes(hashed)
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("_id"), host.alias("_host"), path.alias("_path"))
    if not labels:
        none = F.lit(None).cast("string")
        return urls.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"),
                           none.alias("rule"), F.lit(unlisted).alias("verdict"))
    depth = F.least(_slashes(F.col("_path")), F.lit(max(d for d, _ in paths)))
    folder = _folder(F.col("_path"), depth)
    tail = F.substring(_segment(F.col("_path"), folder), 1, max(t for _, t in paths))
    urls = urls.withColumns({"_head_host": F.substring_index("_host", ".", -max(labels)), "_head_path": F.concat(folder, tail)})
    heads = urls.select("_head_host", "_head_path").distinct()
    asked = heads.select("*", F.explode(expressions(F.col("_head_host"), F.col("_head_path"), labels, paths)).alias("_expression"))
    digest = F.sha2("_expression", 256)
    asked = asked.select("_head_host", "_head_path", _short(digest).alias("short"), digest.alias("_digest"))
    hits = asked.join(hashed, "short").where(F.col("_digest") == F.col("digest"))
    best = keep(hits.groupBy("_head_host", "_head_path").agg(
        F.max(F.struct("size", "host_size", "rule", "verdict")).alias("_best")), "judged-heads")
    found = urls.join(best, ["_head_host", "_head_path"], "left")
    return found.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"),
                        F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(unlisted)).alias("verdict"))
