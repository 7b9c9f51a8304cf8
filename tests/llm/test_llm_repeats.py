import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from odd import ODD, odd_docs, prose

from carepulse.llm import repeats


def brute(rows, size):
    """(n_bytes, n_removed, n_spans, kept) by text, first come first kept."""
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            if data[p:p + size] in seen:
                gone[p:p + size] = b"\1" * size
            seen.add(data[p:p + size])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(data), sum(gone), spans, kept)
    return out


def got(df, size):
    rows = repeats.remove(df, size).collect()
    return {r[0]: (r[1], r[2], r[3], bytes(r[4])) for r in rows}, len(rows)


@pytest.mark.parametrize("size", [3, 10, 24, 100])
def test_against_brute_force(spark, size):
    rnd = random.Random(size)
    shared = [prose(k, 30) for k in range(6)]
    texts = []
    for k in range(60):
        parts = [prose(1000 + k, rnd.randint(0, 20))] + [rnd.choice(shared)[:rnd.randint(1, 300)] for _ in range(rnd.randint(0, 4))]
        rnd.shuffle(parts)
        texts.append(rnd.choice(["", " ", "\n"]).join(parts))
    texts += ["ab" * 200, "ab" * 150 + "x", "a" * 500, "", "ü" * 120, texts[3], texts[3], shared[0] * 3, "abc" * 100 + "abd" * 60]
    rows = [(7 * i % 101, t) for i, t in enumerate(texts)]
    out, n = got(odd_docs(spark, rows).repartition(5), size)
    assert n == len(rows) and out == brute(sorted(rows), size)


def test_odd_documents(spark):
    plain = [(i, t) for i, t in ODD if i is not None and i not in (11, 12)]
    out, n = got(odd_docs(spark), 100)
    want = brute(plain, 100)
    assert n == len(ODD) and {k: v for k, v in out.items() if k in want} == want
    assert got(odd_docs(spark, []), 100) == ({}, 0)


def test_equal_rows_are_one_text(spark):
    text = prose(5, 80)
    out = repeats.remove(odd_docs(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in out) == [(1, 0), (1, 0), (2, len(text))]


def test_frequent_trigger_is_dealt_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 3)
    line = "This passage of some eighty bytes is found in many of the documents, here as well. "
    rows = [(i, prose(i, 15) + line + prose(i % 4, 25)) for i in range(40)]
    assert got(odd_docs(spark, rows), 100)[0] == brute(rows, 100)


def test_triggers_depend_on_content_alone():
    rng = np.random.default_rng(0)
    middle = rng.integers(97, 123, 400).astype(np.uint8)
    found = []
    for k in (0, 7, 50):
        raw = np.concatenate([rng.integers(97, 123, 200 + k).astype(np.uint8), middle, rng.integers(97, 123, 90).astype(np.uint8)])
        trigger, _, _, low, n, _ = repeats.phrases(raw, np.array([0, len(raw)]), 100)
        by_window = np.repeat(trigger, n)
        found.append(by_window[200 + k:200 + k + 301])
        assert low[0] == 0 and n.sum() == len(raw) - 99
    assert all((x == found[0]).all() for x in found)


def test_too_small_a_size_is_refused(spark):
    with pytest.raises(ValueError):
        repeats.repeats(odd_docs(spark), 2)


def by_digest(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_two_hundred_thousand_rows_without_an_id(spark):
    """All different, so 31 bits of a digest would clash often; some share passages, and no text may lose another's bytes."""
    rnd = random.Random(1)
    shared = [prose(k, 30)[:130] for k in range(5)]
    texts = [f"{k} {rnd.getrandbits(400):x}" + (rnd.choice(shared) if k % 50 == 0 else "") for k in range(200_000)]
    rows = spark.createDataFrame(pa.table({"doc_id": pa.nulls(len(texts), pa.int64()), "text": texts})).repartition(8)
    want = brute([(t, t) for t in sorted(texts, key=by_digest)], 100)
    got_rows = repeats.remove(rows, 100).where("n_removed > 0").collect()
    assert sorted(bytes(r["kept"]) for r in got_rows) == sorted(w[3] for w in want.values() if w[1]) and len(got_rows) > 3000
    assert repeats.remove(rows, 100).agg({"n_bytes": "sum"}).first()[0] == sum(map(len, texts))


def test_texts_of_one_id_go_by_their_digest(spark):
    texts = [prose(k, 40) + prose(99, 40) + prose(k % 3, 30) for k in range(12)]
    rows = [(None if k % 2 else 5, t) for k, t in enumerate(texts)] + [(5, texts[0]), (7, texts[1])]
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, by_digest(r[1])))
    want = brute([((i, t), t) for i, t in order], 100)
    found = repeats.remove(odd_docs(spark, rows), 100).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["kept"])) for r in found) == sorted((i or -1, want[i, t][3]) for i, t in rows)


def test_places_that_a_text_lacks_are_an_error():
    with pytest.raises(RuntimeError):
        repeats._inside(np.array([5]), np.array([3]), 100, np.array([106]))
    repeats._inside(np.array([5]), np.array([3]), 100, np.array([107]))
