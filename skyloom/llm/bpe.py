"""Byte-level BPE over distinct words (operator 8).

Texts are cut into pre-tokens with their positions; each distinct word of all texts is encoded once and its ids are
joined back. A frequent word stands in nearly every text, so what is shuffled is not a row for each place of a word
but one for each block of texts that holds it: a block keeps its texts as lists of word numbers (the positions) and
has a row for each of its distinct words. These rows cross one shuffle by word, in which each distinct word is encoded
once and its ids are joined to its rows; by block the ids come back to the positions and each text's ids are put
together in order. Decoding joins each block with the vocabulary's token-byte table, one broadcast row of fixed size,
and takes each id's bytes from it.

Blocks are written once, bucketed by block, so that texts are cut once and never shuffled. A block holds at most
``BLOCK_ROWS`` texts and about ``BLOCK_CHARS`` characters (more only if one text is longer), which bounds every
group; the number of buckets grows with the rows. No task keeps words that have passed.

Edge cases: a null or empty text has no ids; a null id stays null; repeated rows are encoded each; an empty table
gives no rows; other columns are ignored; special-token strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import new_folder

BLOCK_ROWS = 8192
BLOCK_CHARS = 16_000_000
#: Buckets at most, the limit of Spark's own setting.
BUCKETS = 100_000
LEVEL = 12
#: Bits of a word's number in its block, and of a block's in its partition: both and the partition are one 63-bit number.
NUMBER, IN_PARTITION = 28, 12
#: How blocks are stored: numbers of words follow each other, so each is written as what differs from the one before.
PARQUET = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}
#: Rows of words from which a partition sends their ids on.
FLUSH = 500_000

#: A text row (number -1) or the row of a word of a block.
BLOCKS = "block long, number int, word binary, places binary, doc_ids array<long>, sizes array<int>"
CODED = "block long, numbers binary, counts binary, ids binary"
_BLOCK_NAMES = ["block", "number", "word", "places", "doc_ids", "sizes"]
_BLOCK_KINDS = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def _encoder(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(tokens array<binary>): one row, the token-byte table of a rank file by id; its size does not depend on the input."""

    def run(_) -> Iterator[pa.RecordBatch]:
        table = [b""] * (max(ranks(path).values()) + 1)
        for token, i in ranks(path).items():
            table[i] = token
        yield pa.RecordBatch.from_arrays([pa.array([table], pa.list_(pa.binary()))], ["tokens"])

    return spark.range(1, numPartitions=1).mapInArrow(run, "tokens array<binary>")


def _press(x: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, their bytes in planes."""
    planes = np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def _numbers(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


class _Block:
    """Texts as lists of numbers of words."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.doc_ids: list[int | None] = []
        self.texts: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str, find) -> None:
        words, known = find(text), self.known
        self.texts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
        self.doc_ids.append(doc_id)
        self.chars += len(text)

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        """The texts' row, then the words' rows; frequent words get small numbers."""
        places = np.concatenate(self.texts)
        words = [w.encode() for w in self.known]
        # of equal counts in order of coming, in which places rise by one again and again and compress well
        order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.int64)
        number[order] = np.arange(len(words))
        sizes = [len(t) for t in self.texts]
        row = [[block], [-1], [None], [_press(number[places])], [self.doc_ids], [sizes]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, _BLOCK_KINDS, strict=True)], _BLOCK_NAMES)
        for at in range(0, len(words), 10_000):
            part = order[at : at + 10_000].tolist()
            n = len(part)
            columns = [pa.array(np.full(n, block)), pa.array(np.arange(at, at + n, dtype=np.int32)), pa.array([words[i] for i in part], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(n, k) for k in _BLOCK_KINDS[3:])], _BLOCK_NAMES)


def blocks(docs: DataFrame, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``BLOCKS``: the texts of ``docs(doc_id, text)`` in blocks, and the distinct words of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        block, n = _Block(), TaskContext.get().partitionId() << IN_PARTITION
        behind = n + (1 << IN_PARTITION)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    block.add(doc_id, text or "", find)
                    if len(block.texts) >= BLOCK_ROWS or block.chars >= BLOCK_CHARS:
                        yield from block.batches(n)
                        block, n = _Block(), n + 1
                        if n == behind or n >> 63 - NUMBER:
                            raise ValueError("too many blocks in a partition, or partitions; read the input in other parts")
        if block.texts:
            yield from block.batches(n)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS)


def _bucketed(df: DataFrame, column: str, parts: int, label: str) -> DataFrame:
    """``df`` written in the shared folder as a table in ``parts`` buckets by ``column``."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.write.format("parquet").option("path", path).options(**PARQUET).bucketBy(parts, column).saveAsTable(name)
    return spark.table(name)


def _messages(block: np.ndarray, number: np.ndarray, ids: pa.ListArray) -> pa.RecordBatch:
    """``CODED``: for each block one row with its words' numbers, numbers of ids, and ids, compressed."""
    order = np.lexsort((number, block))
    flat = ids.take(pa.array(order))
    ends = flat.offsets.to_numpy().astype(np.int64)
    values, number, block = flat.values.to_numpy(), number[order], block[order]
    first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    spans = list(zip(first.tolist(), [*first[1:].tolist(), len(block)], strict=True))
    columns = [
        pa.array(block[first]),
        pa.array([_press(np.diff(number[i:j], prepend=0)) for i, j in spans], pa.binary()),
        pa.array([_press(np.diff(ends[i : j + 1])) for i, j in spans], pa.binary()),
        pa.array([_press(values[ends[i] : ends[j]]) for i, j in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "numbers", "counts", "ids"])


def encode_words(rows: DataFrame, path: str, parts: int) -> DataFrame:
    """``CODED`` of ``rows(block, number, word)``: the ids of each block's words, in messages from each partition.

    One shuffle by word; in each partition the rows come in order of words, so each distinct word is encoded once, when
    it first comes, and its ids are joined to all its rows as they pass. What is kept is the last word and at most
    ``FLUSH`` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = _encoder(path), ranks(path)
        last, ids, held, n = None, None, [], 0
        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))
            found = []
            for w in runs.values.to_pylist():
                if w != last:
                    i = known.get(w)
                    last, ids = w, bpe.encode_ordinary(w.decode()) if i is None else [i]
                found.append(ids)
            which = np.repeat(np.arange(len(found)), np.diff(runs.run_ends.to_numpy(), prepend=0))
            joined = pa.array(found, pa.list_(pa.int32())).take(pa.array(which))
            key = batch.column(1).to_numpy()
            held.append((key >> NUMBER, key & (1 << NUMBER) - 1, joined))
            n += batch.num_rows
            if n >= FLUSH:
                yield _messages(*(np.concatenate(x) for x in list(zip(*held, strict=True))[:2]), pa.concat_arrays([x[2] for x in held]))
                held, n = [], 0
        if n:
            yield _messages(*(np.concatenate(x) for x in list(zip(*held, strict=True))[:2]), pa.concat_arrays([x[2] for x in held]))

    key = F.shiftleft("block", NUMBER).bitwiseOR(F.col("number").cast("long"))
    return rows.select("word", key.alias("key")).repartition(parts, "word").sortWithinPartitions("word").mapInArrow(run, CODED)


def with_tokens(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with the token-byte table, one row of fixed size, beside each."""
    return rows.join(F.broadcast(vocabulary(rows.sparkSession, path)), F.lit(True), "left")


def _taker(flat: np.ndarray, offsets: np.ndarray, at: np.ndarray | None = None):
    """A function from numbers to the joined stretches of ``flat``; stretch k has the number ``at[k]``, else k."""
    start, count = offsets[:-1], np.diff(offsets)
    if at is not None:
        start, count = np.zeros_like(start), np.zeros_like(count)
        start[at], count[at] = offsets[:-1], np.diff(offsets)

    def take(numbers: np.ndarray) -> np.ndarray:
        n = count[numbers]
        ends = np.cumsum(n)
        return flat[np.repeat(start[numbers] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]

    return take


def _decoder(tokens: pa.Array):
    """A function from ids to their tokens' bytes, by the joined table; an id without a token has none."""
    data = np.frombuffer(b"".join(tokens.to_pylist()), np.uint8)
    return _taker(data, np.append(0, np.cumsum(pc.binary_length(tokens).to_numpy())).astype(np.int64))


def _texts(block: pa.Table) -> Iterator[tuple]:
    """(doc_id, ids, bytes) of each text of a block, whose words' ids and the token table come with it."""
    for row in range(block.num_rows):
        messages = block.column("words")[row].as_py() or []
        places = _numbers(block.column("places")[row].as_py()).astype(np.int64)
        ids, raw = None, _decoder(block.column("tokens")[row].values)
        if messages:
            number, counts, flat = (np.concatenate(x).astype(np.int64) for x in zip(*((np.cumsum(_numbers(m["numbers"]), dtype=np.int64), _numbers(m["counts"]), _numbers(m["ids"])) for m in messages), strict=True))
            ids = _taker(flat.astype(np.int32), np.append(0, np.cumsum(counts)), number)
        at = 0
        for doc_id, size in zip(block.column("doc_ids")[row].as_py(), block.column("sizes")[row].as_py(), strict=True):
            found = ids(places[at : at + size]) if size else np.zeros(0, np.int32)
            at += size
            yield doc_id, found, raw(found).tobytes()


def _by_block(docs: DataFrame, path: str, column, schema: str) -> DataFrame:
    """``column(doc_id, ids, bytes)`` of each text of ``docs``, as rows of ``schema``."""
    spark = docs.sparkSession
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // BLOCK_ROWS + 1)
    cut = _bucketed(blocks(docs), "block", min(wanted, BUCKETS), "bpe_blocks")
    coded = encode_words(cut.where("number >= 0").select("block", "number", "word"), path, min(wanted, BUCKETS))
    words = coded.groupBy("block").agg(F.collect_list(F.struct("numbers", "counts", "ids")).alias("words"))
    texts = cut.where("number < 0").select("block", "places", "doc_ids", "sizes").join(words, "block", "left")
    texts = with_tokens(texts, path)
    fields = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}.get(f.split()[1], pa.list_(pa.int32()))) for f in schema.split(", ")])

    def run(block: pa.Table) -> pa.Table:
        made = [column(*t) for t in _texts(block)]
        columns = zip(*made, strict=True) if made else [[] for _ in fields]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return texts.groupBy("block").applyInArrow(run, schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, bytes binary) of every whole text of ``docs(doc_id, text)``: its ids and what they decode to."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return _by_block(docs, path, lambda d, x, b: (d, x, b), "doc_id long, ids array<int>, bytes binary")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, bytes) of ``rows(doc_id, ids)``; ids that are empty or null give no bytes, ids without a token are left out."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = F.coalesce("ids", F.array().cast("array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = None
        for batch in batches:
            for row in range(batch.num_rows):
                raw = raw or _decoder(batch.column(2)[row].values)  # the same table beside each row
                x = batch.column(1)[row].values.to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), pa.array([raw(x).tobytes()], pa.binary())], ["doc_id", "bytes"])

    return with_tokens(rows.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids")), path).mapInArrow(run, "doc_id long, bytes binary")


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents and of what they decode to."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return _by_block(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        lambda d, x, b: (d, len(x), sha(np.ascontiguousarray(x, "<u4").tobytes()), sha(b)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
