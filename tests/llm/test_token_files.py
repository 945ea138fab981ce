import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loreweave.llm import range_coder, token_files
from loreweave.llm.bpe import VOCABULARY, Codec, read_vocabulary
from loreweave.llm.range_coder import BLOCK, STEPS, BlockError, Mixer, pack, unpack
from loreweave.session import scratch_path


def brute(rows):
    """Rows ``(doc_id, text)`` in order to what the files must say."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    out, start = [], 0
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def back(ids, extra=b""):
    block, end = unpack(memoryview(pack(ids, extra) + b"more"))
    assert block.extra == extra and end == len(pack(ids, extra))
    return block.ids


@pytest.mark.parametrize("n", [0, 1, 2, STEPS - 1, STEPS, STEPS + 1, 3 * STEPS + 7, 20_000])
def test_round_trip_of_sizes(n):
    ids = (np.random.default_rng(n).zipf(1.4, n) % 50_000).astype(np.uint32)
    assert np.array_equal(back(ids, b"kept"), ids)


def test_round_trip_of_extremes():
    rng = np.random.default_rng(0)
    for ids in (
        np.zeros(30_000),
        np.arange(60_000),
        rng.integers(0, 1 << 32, 5_000),
        np.full(300, (1 << 32) - 1),
        np.tile(np.arange(7), 9_000),
        np.repeat(rng.integers(0, 50_000, 40), 600),
        # predictions that are certain for long, then always wrong
        np.concatenate([np.tile([1, 2, 3], 40_000), rng.integers(0, 50_000, 40_000)]),
    ):
        assert np.array_equal(back(ids.astype(np.uint32)), ids.astype(np.uint32))


def test_a_full_block_and_no_more():
    ids = (np.random.default_rng(1).zipf(1.2, BLOCK) % 3_000).astype(np.uint32)
    assert np.array_equal(back(ids), ids)
    with pytest.raises(BlockError):
        pack(np.zeros(BLOCK + 1, np.uint32))


def test_total_never_reaches_the_narrowest_range():
    mixer = Mixer(1 << 16, 4)
    mixer.below[-1] = (1 << 16) + range_coder.LEARN * BLOCK
    for order in (mixer.one, mixer.two):
        order.tries[:], order.right[:] = BLOCK + 8, BLOCK + 1
        order.held[:] = range_coder.CONFIDENCE + range_coder.CONFIDENCE - 1
    mixer.predict(4)
    assert int(mixer.total.max()) < int(range_coder.BOTTOM)


def test_orders_one_and_two_help():
    rng = np.random.default_rng(2)
    follow = rng.integers(0, 500, (500, 500))
    ids = [1, 2]
    for _ in range(60_000):
        ids.append(int(follow[ids[-2], ids[-1]]) if rng.random() < 0.9 else int(rng.integers(0, 500)))
    chained, shuffled = np.array(ids, np.uint32), rng.permutation(np.array(ids, np.uint32))
    pairs = np.tile(rng.permutation(5_000), 12).astype(np.uint32)
    assert len(pack(pairs)) < 0.5 * len(pack(rng.permutation(pairs)))
    assert len(pack(chained)) < len(pack(shuffled))


def test_skewed_ids_come_near_their_entropy():
    ids = (np.random.default_rng(3).zipf(1.5, 200_000) % 2_000).astype(np.uint32)
    share = np.bincount(ids)[np.bincount(ids) > 0] / len(ids)
    assert 8 * len(pack(ids)) / len(ids) < 1.08 * -(share * np.log2(share)).sum() + 0.4


def test_damage_is_found_and_stays_in_its_block():
    parts = [pack(np.arange(i, i + 900, dtype=np.uint32), b"x") for i in range(3)]
    data = bytearray(b"".join(parts))
    data[len(parts[0]) + len(parts[1]) // 2] ^= 1
    view = memoryview(bytes(data))
    _, at = unpack(view, 0)
    with pytest.raises(BlockError):
        unpack(view, at)
    assert unpack(view, len(parts[0]) + len(parts[1]))[0].ids[0] == 2
    with pytest.raises(BlockError):
        unpack(view[:20], 0)


ROWS = [
    (None, "no key"),
    (-5, "negative key"),
    (1, None),
    (2, ""),
    (3, "<|endoftext|> in the text, and ! which is id 0!!"),
    (4, "日本語 zażółć 😀\n\n  it's  "),
    (5, "x" * 5_000 + " long " * 3_000),
    (7, "same"),
    (7, "same"),
    (1 << 40, "last"),
]


def test_files_equal_brute_force(spark):
    df = spark.createDataFrame([(k, t, k, "extra") for k, t in reversed(ROWS)], "doc_id long, text string, start long, n_tokens string")
    want = brute(ROWS)
    for sizes in ({}, {"file_bytes": 500, "block": 300}):
        got = sorted((tuple(r) for r in token_files.token_files(df, **sizes).collect()), key=lambda r: r[1])
        assert got == want


def test_repeated_keys_with_other_texts(spark):
    rows = [(1, "a b"), (1, "c"), (1, None), (0, "z"), (1, "a b")]
    got = [tuple(r) for r in token_files.token_files(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("start").collect()]
    assert [r[0] for r in got] == [0, 1, 1, 1, 1]
    assert got[0][1] == 0 and all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:]))
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute(rows))


def test_empty_table(spark):
    assert token_files.token_files(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force_and_ids_come_back(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in token_files.token_files_query(spark, sf).collect())
    assert got == brute(rows)
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, folder, file_bytes=200_000, block=10_000)
    stored = token_files.ids_of(spark, folder).orderBy("file", "block").collect()
    assert len({r.file for r in stored}) > 1
    ids = np.concatenate([np.array(r.ids, "<u4") for r in stored])
    assert len(ids) == got[-1][1] + got[-1][2]
    assert zlib.crc32(ids[got[5][1] :][: got[5][2]].tobytes()) == got[5][3]


class Counted:
    """An encoding that counts the characters it is given."""

    def __init__(self, inner):
        self.inner, self.given = inner, 0

    def encode_to_numpy(self, text, allowed_special):
        self.given += len(text)
        return self.inner.encode_to_numpy(text, allowed_special=allowed_special)


def test_texts_of_a_run_encode_each_word_once():
    codec = Codec(*read_vocabulary(public_tokenizers.path(VOCABULARY)))
    parts = ["", " ", "\n", " \n", "a", "b's", "'s", "é", "　", "\x1c", "<|endoftext|>", "9.", "x\n\n", "日本"]
    rng = np.random.default_rng(4)
    odd = ["".join(rng.choice(parts, rng.integers(0, 6))) + " ".join(rng.choice(parts, rng.integers(0, 6))) for _ in range(5_000)]
    plain = [" ".join(rng.choice(["some", "unusualish", "words,", "zażółć", "and\nlines"], 200)) for _ in range(100)]
    for texts, run in ((odd, 1 << 24), (odd, 200), (odd, 1), (plain, 1 << 24), ([], 1)):
        got = list(codec.arrays(pa.array(texts, pa.string()), run))
        assert len(got) == len(texts)
        assert all(np.array_equal(x, codec.text.encode_to_numpy(t, allowed_special="all")) for x, t in zip(got, texts))
    codec.text = Counted(codec.text)
    list(codec.arrays(pa.array(plain)))
    assert codec.text.given < 0.05 * sum(map(len, plain))


@pytest.mark.parametrize("size", [1, 2, 3_000, 70_000])
def test_ids_are_found_without_a_search_of_all(size):
    mixer = Mixer(size, 64)
    rng = np.random.default_rng(size)
    for _ in range(12):
        points = rng.integers(0, mixer.below[-1], 500)
        assert np.array_equal(mixer.smaller(points), np.searchsorted(mixer.below, points, "right") - 1)
        mixer.predict(64)
        mixer.learn(rng.zipf(1.3, 64) % size)
