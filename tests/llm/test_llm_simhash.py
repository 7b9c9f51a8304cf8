import re
from itertools import combinations

import numpy as np
import xxhash
from odd import ODD, odd_docs, prose
from pyspark.sql import functions as F

from carepulse.llm import simhash
from carepulse.llm.components import components


def fingerprint(text, n=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
    parts = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(prints, bits):
    """Smallest id reachable for each (id, fingerprint), by brute force."""
    group = list(range(len(prints)))
    for i, j in combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= bits and group[i] != group[j]:
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    return sorted((x[0] if x[0] is not None else -1, f"{x[1]:016x}", min([p[0] for p, h in zip(prints, group) if h == g and p[0] is not None], default=-1))
                  for x, g in zip(prints, group))


def found(df, **given):
    out = simhash.near_duplicates(df, **given)
    return sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in
                  out.select("doc_id", simhash.hex_fingerprint("fp"), "component_id").collect())


def test_odd_documents(spark):
    assert found(odd_docs(spark)) == reachable([(i, fingerprint(t)) for i, t in ODD], 2)
    assert found(odd_docs(spark, [])) == []
    assert found(odd_docs(spark, [(None, "x"), (None, "x")])) == [(-1, f"{fingerprint('x'):016x}", -1)] * 2


def test_near_copies(spark):
    texts = []
    for k in range(40):
        words = prose(k, 120).split()
        texts += [" ".join(words), " ".join(words[:60] + ["x"] + words[61:]), " ".join(words).upper()]
    rows = [(3 * i % 121 + 5, t) for i, t in enumerate(texts)]
    assert found(odd_docs(spark, rows)) == reachable([(i, fingerprint(t)) for i, t in rows], 2)


def test_links_connect_what_all_pairs_connect(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2 ** 63, 12, dtype=np.uint64)
    values = set()
    for c in centres.tolist():
        for _ in range(25):
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                c ^= 1 << int(b)
            values.add(c)
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    fps = spark.createDataFrame(signed, "fp long").repartition(4)
    for bits in (1, 2):
        links = simhash.links(fps, bits).cache()
        assert links.where(f"differing > {bits} OR shared < {8 - bits} OR differing <> bit_count(a ^ b)").count() == 0
        roots = {r[0]: r[1] for r in components(links, "a", "b").collect()}
        prints = [(i, int(np.int64(v[0]).view(np.uint64))) for i, v in enumerate(signed)]
        want = {}
        for i, _, low in reachable(prints, bits):
            want.setdefault(low, set()).add(signed[i][0])
        got = {}
        for v, in signed:
            got.setdefault(roots.get(v, v), set()).add(v)
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_large_group_gives_no_pairs(spark):
    """Members of one posting list meet at values, not in pairs."""
    fps = spark.range(4000).select(F.col("id").alias("fp"))
    assert simhash.links(fps, 2).count() < 40 * 4000


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 50)]
    roots = {r[0]: r[1] for r in components(spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long"), "a", "b").collect()}
    assert roots == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_deduplicate_keeps_one_of_each_group(spark):
    docs = odd_docs(spark)
    out = simhash.deduplicate(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    by_id = sorted(i if i is not None else 10 ** 6 for i, _ in ODD)
    rows = sorted(ODD, key=lambda r: r[0] if r[0] is not None else 10 ** 6)  # rows of one id are rows of their own
    roots = {c for *_, c in reachable([(k, fingerprint(t)) for k, (_, t) in enumerate(rows)], 2)}
    want = [by_id[c] for c in roots]
    assert sorted(r[0] if r[0] is not None else 10 ** 6 for r in out.select("doc_id").collect()) == sorted(want)


def test_rows_without_an_id(spark):
    docs = odd_docs(spark, [(None, "first words of one text"), (None, "first words of one text"), (None, "other words of another"), (3, "other words of another")])
    out = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.deduplicate(docs).collect())
    assert out == [(0, "first words of one text"), (3, "other words of another")]


def test_unlike_rows_of_one_id_stay(spark):
    rows = [(1, prose(1, 40)), (1, prose(2, 40)), (1, prose(2, 40)), (None, prose(3, 40)), (None, prose(4, 40)), (None, prose(4, 40)), (2, prose(1, 40)), (None, prose(1, 40))]
    out = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.deduplicate(odd_docs(spark, rows)).collect())
    assert out == sorted({(1, prose(1, 40)), (1, prose(2, 40)), (0, prose(3, 40)), (0, prose(4, 40))})
