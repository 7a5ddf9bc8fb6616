import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from skyloom.llm import bpe
from skyloom.llm.bpe import decode, encode, op8_bpe, ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_ids_equal_the_library_and_come_back(odd):
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    ids = encode(odd)
    rows = ids.collect()
    assert len(rows) == 10
    for r in rows:
        assert list(r.ids) == whole.encode_ordinary(texts[r.doc_id]) and bytes(r.bytes) == texts[r.doc_id].encode()
    for r in decode(ids).collect():
        assert bytes(r.bytes) == texts[r.doc_id].encode()


def test_white_space_and_contractions(spark):
    text = "it's  we'll   \n\n x\t\ty     z 123 456abc !!! ??\r\n"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    assert list(encode(docs).first().ids) == whole.encode_ordinary(text)


def test_empty(none):
    assert encode(none).count() == 0 and decode(encode(none)).count() == 0


def test_many_blocks_and_digests(spark, tmp_path):
    """Words that stand in several blocks, blocks that hold no word, and the query's digests."""
    texts = [" ".join(f"w{(k * j) % 37}é" for j in range(k % 50)) if k % 3 else None for k in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    rows, before = bpe.BLOCK_ROWS, bpe.BLOCK_CHARS
    try:
        bpe.BLOCK_ROWS, bpe.BLOCK_CHARS = 16, 1000
        found = op8_bpe(spark, str(tmp_path)).collect()
        assert len(found) == 200 and bpe.blocks(docs).where("number < 0").count() > 12
    finally:
        bpe.BLOCK_ROWS, bpe.BLOCK_CHARS = rows, before
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        ids = np.array(whole.encode_ordinary(raw.decode()), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest())


def test_decode_alone(spark):
    rows = decode(spark.createDataFrame([(1, [0, 1, 2]), (1, [0, 1, 2]), (2, []), (3, None), (None, [5])], "doc_id long, ids array<int>")).collect()
    table = {i: t for t, i in ranks(PATH).items()}
    assert sorted((r.doc_id or -1, bytes(r.bytes)) for r in rows) == sorted([(1, table[0] + table[1] + table[2])] * 2 + [(2, b""), (3, b""), (-1, table[5])])
