import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from skyloom.llm.packing import Limits, _sequences, op1_packing, pack_conversations, pack_documents, stage_packing


def test_pieces_hold_each_token_once(odd):
    rows = pack_documents(odd).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for doc, group in rows.groupby("doc_id"):
        ids = tokenizer.encode(texts[int(doc)], add_special_tokens=False).ids + [0]
        for r in group.itertuples():
            piece = ids[r.start : r.start + r.length]
            assert list(r.ids) == piece and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
    assert rows.length.sum() == sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert (group.length.cumsum() - group.length == group.offset).all()
        total = group.length.sum()
        assert total == 1024 or total & (total - 1) == 0


def test_all_three_limits_hold():
    rng = np.random.default_rng(1)
    limits = Limits(tokens=64, segments=3, loss_tokens=20)
    examples = []
    for k in range(400):
        n = int(rng.integers(1, 200))
        examples.append(((k, n), np.arange(n), rng.random(n) < 0.4))
    seen = {k: [] for k in range(400)}
    for pieces in _sequences(iter(examples), limits, 32):
        assert len(pieces) <= 3 and sum(len(p[2]) for p in pieces) <= 64 and sum(p[3].sum() for p in pieces) <= 20
        for (k, _), start, ids, _ in pieces:
            seen[k].append((start, len(ids)))
    for (k, n), *_ in examples:
        at = 0
        for start, length in sorted(seen[k]):
            assert start == at
            at += length
        assert at == n


def test_conversations_bear_loss_on_one_role(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hello there"), (1, 1, "assistant", "hi"), (2, 0, "user", None), (2, 1, None, "x")], "conv_id long, turn long, role string, text string")
    rows = {r.doc_id: r for r in pack_conversations(turns).collect()}
    assert rows[1].loss_tokens == 1 and rows[2].loss_tokens == 0


def test_empty(none):
    assert pack_documents(none).count() == 0


def test_registered_packing_takes_added_tokens_as_the_library_does(spark, tmp_path):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endoftext", "it's  plain <|endo <|endoftext|>7"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: tokenizer.encode(t, add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    assert ids[0] == [64, 220, 50256, 275, 0]
    for r in stage_packing(spark, docs, "").collect():
        assert list(r.ids) == ids[r.doc_id][r.start : r.start + r.length]
    for r in op1_packing(spark, str(tmp_path)).collect():
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def test_ids_equal_the_library_on_random_texts(spark):
    rng = random.Random(11)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "\t ", "'s", "'LL", "don't", "Straße", "日本語", "😀", "e\u0301", "\x00", "1234", "...", " the", "word", "\u00a0", "\u2003x", "ǅ", "٣", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {k: [] for k in range(len(texts))}
    for r in pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        found[r.doc_id].append((r.start, list(r.ids)))
    for k, t in enumerate(texts):
        assert [i for _, ids in sorted(found[k]) for i in ids] == tokenizer.encode(t, add_special_tokens=False).ids + [0]
