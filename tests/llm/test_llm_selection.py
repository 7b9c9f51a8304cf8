"""URL rules, importance resampling and conversation repair against plain versions."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from carepulse.llm import repair, resampling, urls
from helpers import plan_of
from odd import odd_docs

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("a.net", "", "block"), ("net", "/e", "allow"), ("x.org", "/p/q", "block"), ("x.org", "/p/", "allow"), ("X.org", "/p/qq/r.html", "allow"),
         ("dup.org", "/", "allow"), ("dup.org", "/", "block"), ("deep.a.b.c.org", "/", "block"), (None, "/", "block"), ("q", None, "block"), ("z", "/", None)]
URLS = [None, "", "no scheme", "://", "http://", "http://com", "http://com/", "https://WWW.Example.COM/en/x?y#z", "http://example.com/EN/", "ftp://b.example.com/en/",
        "http://notexample.com/en/", "http://a.net", "http://b.a.net?x=/es/", "http://xa.net/es/1", "http://net/espresso", "http://net/es", "http://x.org/p/qz",
        "http://x.org/p/q", "http://x.org/p/Q", "http://sub.x.org/p/qq/r.html/more", "http://dup.org/", "http://y.deep.a.b.c.org/a//b", "http://a.b.c.org/",
        "http://..net/es/", "http://user@h.com:80/x", "a://b://c.com/en/", "http://com\n.net/es/\n?", "http://É.net/es/é", "http://" + "a." * 500 + "com/" + "p/" * 500]


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h.lower() + p, v) for h, p, v in rules if None not in (h, p, v)
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("rules", [RULES, RULES[:5], [("", "", "block")], []])
def test_urls_as_a_plain_loop_judges_them(spark, table, rules):
    pages = table("page_id long, url string, host string, rule string, verdict string, _id int, size int",
                  *[(i % 20 or None, u, "h", "r", "v", 1, 2) for i, u in enumerate(URLS * 2)])
    found = urls.judge(pages, table("host string, path string, verdict string", *rules))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(map(tuple, found.collect())) == Counter((i % 20 or None, *plain_verdict(u, rules)) for i, u in enumerate(URLS * 2))


def test_urls_random_rules_and_empty_table(spark, table):
    rnd = random.Random(7)
    def host(): return ".".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4)))
    def path(): return "".join(rnd.choice(["/", "/", "x", "y"]) for _ in range(rnd.randint(0, 6)))
    rules = [(host(), rnd.choice(["", "/"]) + path(), rnd.choice(["allow", "block"])) for _ in range(60)]
    best = {}
    for h, p, v in rules:
        best[h, p] = max(v, best.get((h, p), ""))
    given = [f"s://{host()}/{path()}" for _ in range(400)]
    shown = table("host string, path string, verdict string", *rules)
    found = urls.judge(table("page_id long, url string", *enumerate(given)), shown)
    want = [(i, *plain_verdict(u, [(*k, v) for k, v in best.items()])) for i, u in enumerate(given)]
    assert sorted(map(tuple, found.collect())) == sorted(want, key=lambda r: r[0])
    assert urls.judge(table("page_id long, url string", (1, "")).limit(0), shown).count() == 0


def test_urls_look_up_heads_not_rows(spark, table):
    hot = spark.range(20_000).selectExpr("id AS page_id", "concat('http://www.hot.com/en/', id) AS url")
    found = urls.judge(hot, table("host string, path string, verdict string", *RULES[:5]))
    assert found.where("rule = 'com/'").count() == 20_000
    assert "BatchEvalPython" not in plan_of(found) and "Arrow" not in plan_of(found)
    host, path = urls.split_url(hot["url"])
    assert hot.select(urls._lower(host)).distinct().count() == 1  # 20,000 URLs, one head


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, longest, buckets, percent, least):
    found = [plain_features(t, longest) for _, t in docs]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, f in found:
        np.add.at(s, [x % buckets for x in f], 1)
    for x in target:
        np.add.at(t, [x % buckets for x in plain_features(x, longest)[1]], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    rows = []
    for (i, _), (n, f) in zip(docs, found):
        weight = sum(gain[x % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((-r[4], r[0] is not None, r[0] or 0, k) for k, r in enumerate(rows) if r[1] >= least)
    place = {x[3]: k + 1 for k, x in enumerate(may[:len(may) * percent // 100])}
    return [(r[0], *r[2:], place.get(k)) for k, r in enumerate(rows)]


@pytest.mark.parametrize("longest, head_words, head_pairs", [(1, 50, 0), (1, 0, 0), (2, 50, 40), (2, 10_000, 20_000), (3, 30, 30), (3, 0, 0)])
def test_resampling_is_the_same_whatever_the_head(spark, sf_dir, longest, head_words, head_pairs):
    docs = odd_docs(spark).unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60"), allowMissingColumns=True)
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = resampling.resample(docs, target, longest=longest, buckets=1000, percent=35, least_words=3, head_words=head_words, head_pairs=head_pairs)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain_resample([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()], longest, 1000, 35, 3)
    # wholly tied rows (one id, one score) may swap
    assert Counter((a, b, c, d) for a, b, c, d, _ in map(tuple, found.collect())) == Counter(r[:4] for r in want)
    assert sorted((e, d) for _, _, _, d, e in map(tuple, found.collect()) if e) == sorted((r[4], r[3]) for r in want if r[4])
    assert {(a, e) for a, *_, e in map(tuple, found.collect()) if e} == {(r[0], r[4]) for r in want if r[4]}


def test_resampling_of_nothing(spark):
    none, some = odd_docs(spark, []), odd_docs(spark, [(1, "a b c"), (2, None)])
    assert resampling.resample(none, some).collect() == []
    rows = resampling.resample(some, none, least_words=1, percent=100).collect()
    assert {(r["doc_id"], r["n_features"], r["rank"]) for r in rows} == {(1, 3, 1), (2, 0, None)}


def test_ranks_of_many_ties(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS id", "id AS row", "5 AS score", "id % 2 = 0 AS may").withColumns({"score": resampling.F.lit(5).cast("long")})
    got = resampling.ranked(rows, 1000).where("rank IS NOT NULL").orderBy("rank").collect()
    want = sorted((i % 7, i) for i in range(0, 5000, 2))[:1000]
    assert [(r["id"], r["row"]) for r in got] == want and [r["rank"] for r in got] == list(range(1, 1001))


ROLES = ["user", "assistant", "system", "tool", "user", "assistant", "user", "assistant", None, ""]
TEXTS = ["One.", "Two!", "Three?", "cut", "", " \t", None, "Four. \n", "five", "Six.", "Seven.", "Eight é."]


def plain_report(rows):
    """Of (turn, role, text) in order: faults, then the least (cost, audit) by trying every way from the end."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    sys.setrecursionlimit(10_000)

    @lru_cache(None)
    def best(i, so_far, inserted):
        ways = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", so_far):
            ways.append((0, "", ()))
        # what matters of the roles so far is whether there are any, and the last one
        short = lambda x: x if len(x) < 2 else ("ua" if x[-1] == "a" else "uau")
        legal = lambda x: re.fullmatch("s?(ua)*u?", x)

        def go(cost, letter, turn, after, n):
            if not legal(after):
                return
            c, audit, turns = best(i + (letter != "I"), short(after) if after[:1] != "s" or len(after) > 1 else after, n)
            if audit is not None:
                ways.append((cost + c, letter + audit, turn + turns))

        if inserted < 2:
            for role in ("user", "assistant"):
                go(5, "I", ((role, ""),), so_far + role[0], inserted + 1)
        if i < len(rows):
            _, role, text = rows[i]
            stays = 5 if faults[i] == "t" else 0
            go(2, "D", (), so_far, 0)
            if faults[i] not in ("b", "d"):
                if role[:1] in ("s", "u", "a"):
                    go(stays, "K", ((role, text),), so_far + role[0], 0)
                for new in ("user", "assistant"):
                    go(1 + stays, "R", ((new, text),), so_far + new[0], 0)
        return min(ways, default=(10**9, None, ()))

    cost, audit, turns = best(0, "", 0)
    known = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


def in_order(rows):
    blank = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(blank, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def made(seed, n, longest=9):
    rnd = random.Random(seed)
    return {c: [(rnd.choice([None, *range(8)]) if rnd.random() < 0.2 else k, rnd.choice(ROLES), rnd.choice(TEXTS) if rnd.random() < 0.6 else f"Turn {k}.")
                for k in range(rnd.randint(1, longest))] for c in [None, *range(n - 1)]}


def pieces_of(table, given):
    rows = [(c, t, r, x, 1, "e", 2) for c, turns in given.items() for t, r, x in turns]
    return repair.repair(table("conv_id long, turn long, role string, text string, part int, edits string, k int", *rows))


def test_repair_finds_the_cheapest_edits(table):
    given = made(1, 300)
    got = {r[0]: tuple(r)[1:] for r in repair.report(pieces_of(table, given)).collect()}
    assert got == {c: plain_report(in_order(rows)) for c, rows in given.items()}


def test_repair_of_conversations_cut_by_partitions(spark, table):
    """Long conversations over all partitions; blocks of 64 rows and borders must not be seen in the result."""
    given = {**made(2, 20), 100: made(4, 1, 100)[None] * 3, 101: [(k, "user", f"Turn {k}.") for k in range(200)],
             102: [(k // 2, "userassistant"[4 * (k % 2):][:4 + 5 * (k % 2)], f"Turn {k}.") for k in range(200)]}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = pieces_of(table, given)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert pieces.where("NOT whole").select("id").distinct().count() >= 1 and pieces.where("piece > 0").count() >= 1
    got = {r[0]: tuple(r)[1:] for r in repair.report(pieces).collect()}
    assert got == {c: plain_report(in_order(rows)) for c, rows in given.items()}


def test_chains_of_pieces_equal_the_whole():
    rnd = random.Random(5)
    for _ in range(60):
        kinds = [rnd.randrange(12) for _ in range(rnd.randint(2, 200))]
        cuts = sorted({0, len(kinds), *[rnd.randrange(1, len(kinds)) for _ in range(3)]})
        parts = [kinds[a:b] for a, b in zip(cuts, cuts[1:])]
        states = repair.chain([repair.forward(p, [*range(4)]) for p in parts])
        cost, audit, before = 0, "", repair.START
        for k, (part, state) in enumerate(zip(parts, states)):
            c, letters = repair.solve(tuple(part), before, None if k == len(parts) - 1 else state)
            cost, audit, before = cost + c, audit + "".join(letters), state
        whole = repair.solve(tuple(kinds))
        assert (cost, audit) == (whole[0], "".join(whole[1]))


def test_damage_and_conversations_that_vanish(spark, table):
    rows = [(c, t, "user", "Hi. You!") for c in [None, *range(40)] for t in (None, 0)]
    shown = repair.damage(table("conv_id long, turn long, role string, text string", *rows))
    want = Counter()
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            want[c, t, role, "" if k == 1 else "Hi You" if k == 2 else text] += 2 if k == 3 else 1
    assert Counter(map(tuple, shown.collect())) == want
    gone = next(c for c in range(10_000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    out = repair.repaired_report(table("conv_id long, turn long, role string, text string", (gone, 0, "user", "x."))).collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repaired_report(table("conv_id long, turn long, role string, text string", rows[0]).limit(0)).collect() == []
