import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from odd import ODD, odd_docs, prose
from tokenizers import Tokenizer

from carepulse.llm import bitpack, packing
from carepulse.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBzé'’s.,!|<>0 \t\n ́ßΣ日 İ×"), max_size=40), max_size=6))
def test_word_encoder_equals_the_library(texts):
    encoder = WordEncoder(PATH)
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_word_encoder_forgets_and_stays_right(monkeypatch, tokenizer):
    import carepulse.llm.tokens as tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    encoder = WordEncoder(PATH)
    for seed in range(4):
        text = prose(seed, 60) + ". It's <|startoftext|>"
        assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120), st.integers(50, 60))
def test_bins_hold_every_item_without_gaps(lengths, capacity):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    bins, offsets = packing.sum_of_squares(lengths, capacity)
    filled = {}
    for size, b, at in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        assert filled.get(b, 0) == at
        filled[b] = at + size
    assert all(v <= capacity for v in filled.values())


def test_choice_minimises_the_sum_of_squares():
    # open gaps after 6, 6, 5: 4, 4, 5; the 4 fills a gap of 4 exactly (fewer open bins of that gap)
    bins, _ = packing.sum_of_squares(np.array([6, 6, 5, 4]), 10)
    assert bins[3] in (0, 1) and len(set(bins.tolist())) == 3


def test_few_bins():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 2047, 4000))[::-1]
    bins, _ = packing.sum_of_squares(lengths, 2048)
    assert bins.max() + 1 <= -(-lengths.sum() // 2048) * 1.01


def test_pack_odd_documents(spark, tokenizer):
    out = packing.pack(odd_docs(spark), PATH, 64, 0).toPandas()
    want = sorted((i if i is not None else -1, p, 64 * p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part))
                  for i, t in ODD for ids in [ids_of(tokenizer, t, 0)] for p, part in
                  enumerate(ids[k:k + 64] for k in range(0, len(ids), 64)))
    got = sorted((int(i) if i == i else -1, p, s, n, c, tuple(np.frombuffer(b, "<u2").tolist())) for i, p, s, n, c, b in
                 zip(out.doc_id, out.piece, out.start, out.length, out.ids_crc32, out.ids))
    assert got == want
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 64
    assert packing.pack(odd_docs(spark, []), PATH, 64, 0).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 32), st.integers(0, 5), st.randoms())
def test_bits_round_trip(bits, blocks, rnd):
    ids = np.array([rnd.randrange(1 << bits) for _ in range(64 * blocks)], np.uint32)
    data = bitpack.pack_bits(ids, bits)
    assert len(data) == 8 * blocks * bits and bitpack.unpack_bits(data, bits).tolist() == ids.tolist()


def test_random_access(tmp_path):
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 1000, 20_000).astype(np.uint32)
    writer = bitpack.Writer(str(tmp_path / "x.ids"), bitpack.width(1000))
    ends = np.array([5, 5, 9000])
    writer.add(pa.array([1, None, 3], pa.int64()), ids[:9000], ends)
    writer.add(pa.array([4], pa.int64()), ids[9000:], np.array([11_000]))
    assert writer.close() == 4
    file = bitpack.Reader(str(tmp_path / "x.ids"))
    assert file.bits == 10 and file.docs == 4 and file.ids == 20_000 and file.null.tolist() == [False, True, False, False]
    assert file.document(0).tolist() == ids[:5].tolist() and len(file.document(1)) == 0
    assert file.document(3).tolist() == ids[9000:].tolist() and file.range(4090, 4100).tolist() == ids[4090:4100].tolist()


def test_token_files_of_odd_documents(spark, tokenizer):
    out = bitpack.read_ids(bitpack.write_ids(odd_docs(spark), PATH, 1)).toPandas().sort_values(["start", "n_tokens"])
    assert out.start.tolist() == [0, *np.cumsum(out.n_tokens)[:-1]]
    assert [int(x) for x in out.doc_id.dropna()] == sorted(i for i, _ in ODD if i is not None) and out.doc_id.isna().tolist()[:2] == [True, True]
    want = sorted((i if i is not None else -1, tuple(ids_of(tokenizer, t, 1))) for i, t in ODD)
    assert sorted((int(i) if i == i else -1, tuple(x)) for i, x in zip(out.doc_id, out.ids)) == want
    assert all(c == zlib.crc32(np.array(x, "<u4").tobytes()) for c, x in zip(out.ids_crc32, out.ids))
    assert bitpack.read_ids(bitpack.write_ids(odd_docs(spark, []), PATH, 1)).count() == 0


def test_other_work_of_a_worker_drops_its_words():
    import carepulse.llm.language as language
    import carepulse.llm.tokens as tokens

    for work in (tokens.forget, lambda: language._train(pa.table({"pair": ["a\tb"] * 2, "side": ["a", "b"], "text": ["some text", "mehr Text"]}))):
        tokens.encoder(PATH).encode(pa.array(["words to remember"]))
        assert tokens.encoder.cache_info().currsize == 1
        work()
        assert tokens.encoder.cache_info().currsize == 0


def test_workers_give_arrow_memory_back(spark):
    from carepulse.llm.batches import bounded_batches

    def pool(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"pool": [pa.default_memory_pool().backend_name] * batch.num_rows})

    bounded_batches(spark)
    assert {r[0] for r in spark.range(4).mapInArrow(pool, "pool string").collect()} == {"system"}
