"""Version fingerprints, decontamination and the pipeline."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from odd import ODD, odd_docs, prose
from pyspark.sql import functions as F

from carepulse.llm import decontaminate, fingerprints as fp


def likeness(a, b):
    x, y = Counter(fp.paragraphs(a)), Counter(fp.paragraphs(b))
    either = sum((x | y).values())
    return sum((x & y).values()) / either if either else 1.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=60), min_size=2, max_size=5))
def test_peeling_recovers_the_difference(lists):
    versions = fp.Versions(lists)
    ia, ib = np.arange(len(lists) - 1), np.arange(1, len(lists))
    keys, pair, sign = fp.differences(versions, ia, versions, ib)
    for p in ia.tolist():
        x, y = (set(versions.of(np.array([k]))[0].tolist()) for k in (p, p + 1))
        assert set(keys[(pair == p) & (sign == 1)].tolist()) == x - y and set(keys[(pair == p) & (sign == -1)].tolist()) == y - x


def test_too_small_sketches_are_made_larger():
    a, b = fp.Versions([list(range(3000))]), fp.Versions([list(range(1000, 5000))])
    one = np.array([0])
    keys, _, sign = fp.differences(a, one, b, one)
    assert len(keys) == 3000 and (sign == 1).sum() == 1000


def test_fingerprints_of_odd_documents(spark):
    rows = fp.version_fingerprints(odd_docs(spark)).collect()
    order = sorted(ODD, key=lambda r: -(r[0] if r[0] is not None else -10 ** 9))
    assert len(rows) == len(ODD)
    texts = [t or "" for _, t in order]
    by_id = {r["doc_id"]: r for r in rows}
    for (i, t), text, following in zip(order, texts, texts[1:] + texts[:1]):
        if i in (None, 11, 12, 13, 10):  # ids that are not alone, or are followed by such
            continue
        k = len(text) // 2
        changed = text[:len(text) - k] + following[:k]
        r = by_id[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(r["near_edited"] - likeness(text, changed)) < 1e-12 and abs(r["near_next"] - likeness(text, following)) < 1e-12
    assert by_id[5]["fingerprint"] == by_id[6]["fingerprint"] != by_id[4]["fingerprint"]
    assert fp.version_fingerprints(odd_docs(spark, [])).count() == 0


def test_successors_over_many_blocks(spark):
    ids = random.Random(4).sample(range(-500, 5000), 700)
    texts = {i: prose(i, random.Random(i).randint(0, 40)) for i in ids}
    out = {r["doc_id"]: r for r in fp.version_fingerprints(odd_docs(spark, list(texts.items())).repartition(6)).collect()}
    order = sorted(ids, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        k = len(texts[i]) // 2
        assert out[i]["edited_sha256"] == hashlib.sha256((texts[i][:len(texts[i]) - k] + texts[j][:k]).encode()).hexdigest()


def test_single_document_follows_itself(spark):
    row = fp.version_fingerprints(odd_docs(spark, [(3, "abcd")])).collect()[0]
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, id int, doc_id long")


def test_decontamination(spark):
    rnd = random.Random(9)
    items = [(k, prose(500 + k, rnd.randint(14, 40)), 0, 0) for k in range(30)]
    rows, want = [], set()
    for k in range(120):
        text = prose(k, 60)
        if k % 3 == 0:
            item = items[k % 30]
            words = item[1].split()
            for at in range(rnd.randrange(5), len(words), 6 if k % 2 else 1000):
                words[at] = "xyzzy"
            joiner = rnd.choice([" ", "  ", "\n"])
            text = text[:100] + " " + joiner.join(w.upper() if k % 4 == 0 else w + "," for w in words) + " " + text[100:]
            want.add((k, item[0]))
        rows.append((k, text))
    docs = odd_docs(spark, rows)
    out = decontaminate.find(docs, bench(spark, items)).collect()
    texts = dict(rows)
    assert {(r["doc_id"], r["item_id"]) for r in out} == want
    for r in out:
        assert 0.8 * min(13, r["n_words"]) <= r["n_agreeing"] <= r["n_words"] == len(texts[r["doc_id"]][r["start"]:r["end"]].split())
    kept = decontaminate.remove(docs, bench(spark, items))
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == set(texts) - {k for k, _ in want}


def plain_passages(docs, items, least=5):
    """{(doc, item): (words, agreeing)} of the best diagonal, every one of them looked at word by word."""
    out = {}
    for d, text in docs:
        t = [w.lower() for w in text.split()]
        for i, item, *_ in items:
            w = item.lower().split()
            size = min(len(w), 13)
            if len(w) < least:
                continue
            for shift in range(-len(w), len(t)):
                a, b = max(0, -shift), min(len(w), len(t) - shift)
                same = [w[k] == t[k + shift] for k in range(a, b)]
                good = [k for k in range(len(same) - size + 1) if sum(same[k:k + size]) * 5 >= 4 * size]
                if good:
                    n = sum(same[good[0]:good[-1] + size])
                    if n > out.get((d, i), (0, 0))[1]:
                        out[d, i] = (good[-1] + size - good[0], n)
    return out


@pytest.mark.parametrize("hot", [64, 1, 0])
def test_decontamination_against_every_diagonal(spark, monkeypatch, hot):
    monkeypatch.setattr(decontaminate, "HOT", hot)
    rnd, few = random.Random(4), "abcdefghijkl"
    items = [(k, " ".join(rnd.choices(few, k=rnd.randint(3, 20))), 0, 0) for k in range(60)]
    docs = []
    for k in range(80):
        words = rnd.choices(few, k=rnd.randint(0, 40))
        at = rnd.randint(0, len(words))
        item = rnd.choice(items)[1].split()
        item[rnd.randrange(len(item))] = "z"
        docs.append((k, " ".join(words[:at] + item + words[at:])))
    out = decontaminate.find(odd_docs(spark, docs), bench(spark, items), least_words=4).collect()
    want = plain_passages(docs, items, 4)
    assert {(r["doc_id"], r["item_id"]) for r in out} == set(want) and len(out) == len(want)
    assert sum((r["n_words"], r["n_agreeing"]) == want[r["doc_id"], r["item_id"]] for r in out) >= 0.95 * len(out)
    dirty = {d for d, _ in want}
    kept = decontaminate.remove(odd_docs(spark, docs), bench(spark, items), least_words=4)
    assert sorted(r["doc_id"] for r in kept.collect()) == [d for d, _ in docs if d not in dirty]


@pytest.mark.parametrize("size", range(1, 14))
def test_masks_and_keys_leave_no_replacement_out(size):
    words = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(7919)
    k = decontaminate._replaced(size)
    plain = decontaminate.window_keys(words, np.array([0]), size)[0]
    for gone in combinations(range(size), k):
        assert any(all(i + j not in gone for j, m in enumerate(mask) if m == "1")
                   for mask in decontaminate.masks_for(size) for i in range(size - len(mask) + 1))
        other = words.copy()
        other[list(gone)] = 1
        assert (decontaminate.window_keys(other, np.array([0]), size)[0] == plain).any()


def test_shared_openings_make_no_pairs(spark):
    def rows(n, seed):
        return [(k, "one opening that all of them share " + prose(seed + k, 30)) for k in range(n)]
    items = decontaminate._items(bench(spark, [(k, t, 0, 0) for k, t in rows(300, 10 ** 6)]), "item_id", "text", 5)
    seed_rows = decontaminate._item_seeds(items)
    docs = odd_docs(spark, rows(300, 0)).selectExpr("doc_id AS id", "text")
    segments = decontaminate._segments(docs, list(decontaminate.MASKS), *decontaminate._filter(seed_rows))
    assert segments.count() >= 300
    assert decontaminate._candidates(items, seed_rows, segments).count() * 50 < 300 * 300  # all pairs share seeds


def test_odd_decontamination(spark):
    items = [(1, None, 0, 0), (None, "", 0, 0), (2, "a b", 0, 0), (3, "... !!!", 0, 0), (4, "the same text twice in two rows", 0, 0), (4, "the same text twice in two rows", 0, 0)]
    found = decontaminate.find(odd_docs(spark), bench(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(5, 4), (5, 4), (6, 4), (6, 4)]
    assert decontaminate.remove(odd_docs(spark), bench(spark, items)).count() == len(ODD) - 2
    assert decontaminate.remove(odd_docs(spark), bench(spark, [])).count() == len(ODD)
    assert decontaminate.find(odd_docs(spark, []), bench(spark, items)).count() == 0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = odd_docs(spark).withColumn("doc_id", F.col("doc_id") + 10 ** 6)
    docs = docs.unionByName(odd.select(*docs.columns))
    columns, counts = docs.columns, []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        if name == "language ID":
            assert all(re.search(r"[^\W\d_]", r["text"] or "") for r in out.collect())
        if name == "near-duplicates":
            assert out.select("doc_id", "text").distinct().count() == out.count()  # unlike rows of one id stay
            assert out.where("doc_id < 1000000").select("doc_id").distinct().count() == out.where("doc_id < 1000000").count()
        if name == "personal data":
            assert out.count() == docs.count() and out.where(F.col("text").rlike(r"[a-z]@[a-z0-9]+\.[a-z]")).count() == 0
            assert out.where("n_chars <> length(text)").count() == 0
        if name != "packing":
            assert out.columns == columns
            docs = out
        counts.append(out.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] <= counts[4] and "ids" in out.columns
