import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docketry.llm.packing import Encoder, fullest, pack_documents, plan_bins

PATH = public_tokenizers.path("byte_bpe_50k.json")


TOK = Tokenizer.from_file(PATH)


def plain_ids(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\t b c", "don't  stop", "x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|> ", "a<|endoftext|>\n\n <|endoftext|>b <|endoftext |>", "é à b c", "1 22  333\n\n4 ", "Hello world, it's  fine.\nNew line here", "tab\there now", "  x 　 y z", "a\x1c b \x1cc d",
]


def test_encoder_equals_whole_text_encoding():
    enc = Encoder(PATH)
    for t in TEXTS:
        for _ in range(2):
            assert np.frombuffer(enc.encode(t or ""), "<u4").tolist() == plain_ids(t), repr(t)


def test_encoder_on_random_text_and_small_memo():
    rng = np.random.default_rng(3)
    pieces = ["<|endoftext|>", "<|", "the", " ", "  ", "\n", "\t", "Élan", "ß", "12", "'s", "!!", "a", "中文", "\u00a0", "\u3000", "x" * 300, "\r\n", "-"]
    enc = Encoder(PATH, 20)
    for _ in range(400):
        t = "".join(rng.choice(pieces, rng.integers(1, 25)))
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == plain_ids(t), repr(t)


def test_fullest_is_brute_force_best():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 20, 4)}
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        room = int(rng.integers(1, 40))
        combo = fullest(sorted(counts, reverse=True), counts, room)
        assert sum(k * m for k, m in combo.items()) == max(s for s in sums if s <= room)
        assert all(m <= counts[k] for k, m in combo.items())


def test_plan_uses_each_item_once():
    h = {2048: 3, 1500: 4, 548: 3, 100: 50, 7: 9}
    used = defaultdict(int)
    for combo, times in plan_bins(h, 2048):
        assert sum(k * m for k, m in combo.items()) <= 2048
        for k, m in combo.items():
            used[k] += m * times
    assert used == h


def test_pack_documents(spark):
    texts = [*TEXTS, "word " * 5000, "long " * 2047, "same text here"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (3, "same id", "x")] + [(77, "same text here", "x")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = pack_documents(docs, PATH).collect()
    want = defaultdict(int)
    for i, t, _ in rows:
        ids = [*plain_ids(t), 0]
        start, piece = 0, 0
        while start < len(ids):
            n = (len(ids) - start) % 2048 or 2048
            want[i, piece, start, n, zlib.crc32(np.asarray(ids[start : start + n], "<u4").tobytes())] += 1
            start, piece = start + n, piece + 1
    have = defaultdict(int)
    bins = defaultdict(list)
    for r in got:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 1


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
