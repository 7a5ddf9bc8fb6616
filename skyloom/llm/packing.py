"""Vector bin packing of token sequences (operator 1).

Examples are placed under three simultaneous limits (tokens, segments, loss-bearing tokens) with the
dot-product heuristic: into the open sequence goes the piece that fits and whose demand vector has the
largest inner product with the room that is left, each dimension weighted by its share of the demand.

Each task packs the rows of its own partition from a pool of bounded size, so no row is shuffled, memory
does not grow with the input, and a lost task is computed anew from the scan alone. An input partition
ends with at most one partly filled sequence.

Edge cases: a null or empty text is the closing id alone; a null id stays null; repeated rows are packed
once each; ties go to the earlier piece of the pool; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " loss_tokens long, ids array<int>"
)


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("every limit must be at least 1")


def added_tokens(tokenizer: str | None = None) -> tuple[tuple[str, int], ...]:
    """(string, id) of the added tokens of a tokenizer file (default: the 50k byte-level vocabulary)."""
    with open(tokenizer or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    if any(t[flag] for t in found for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("only added tokens that match exactly are supported")
    return tuple((t["content"], t["id"]) for t in found)


@cache
def encoder(ranks: str, added: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """Byte-level BPE from a rank file; strings of ``added`` become their ids, others are ordinary text."""
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=dict(added))


class _Pool:
    """Pieces that wait for a sequence: demand vectors beside (document, start, ids, loss flags)."""

    def __init__(self, limits: Limits, size: int) -> None:
        self.limits, self.size = limits, size
        self.cap = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.demand = np.zeros((size + 1, 3))
        self.items: list[tuple] = []

    def add(self, doc, start: int, ids: np.ndarray, loss: np.ndarray) -> None:
        self.demand[len(self.items)] = len(ids), 1, np.count_nonzero(loss)
        self.items.append((doc, start, ids, loss))

    def take(self, k: int) -> tuple:
        """Remove piece k; the last piece takes its place."""
        item, last = self.items[k], self.items.pop()
        if k < len(self.items):
            self.items[k], self.demand[k] = last, self.demand[len(self.items)]
        return item

    def fill(self) -> list[tuple]:
        """One sequence: the best fitting pieces, then a cut piece for the room that is left."""
        n = len(self.items)
        room, chosen = self.cap.copy(), []
        weight = self.demand[:n].sum(0) / (n * self.cap) / self.cap**2
        while self.items and room[0] >= 1 and room[1] >= 1:
            demand = self.demand[: len(self.items)]
            gain = demand @ (weight * room)
            fits = (demand <= room).all(1)
            if fits.any():
                k = int(np.argmax(np.where(fits, gain, -1.0)))
                item = self.take(k)
            else:
                k = int(np.argmax(gain))
                doc, start, ids, loss = self.take(k)
                cut = _cut(loss, int(room[0]), int(room[2]))
                if not cut:
                    self.add(doc, start, ids, loss)
                    break
                item = doc, start, ids[:cut], loss[:cut]
                self.add(doc, start + cut, ids[cut:], loss[cut:])
            room -= len(item[2]), 1, np.count_nonzero(item[3])
            chosen.append(item)
        return chosen


def _cut(loss: np.ndarray, tokens: int, loss_tokens: int) -> int:
    """How many leading tokens fit."""
    n = min(len(loss), tokens)
    if np.count_nonzero(loss[:n]) > loss_tokens:
        n = int(np.searchsorted(np.cumsum(loss[:n]), loss_tokens, side="right"))
    return n


def _powers(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """Deal the pieces of a short sequence to sequences whose lengths are powers of two."""
    left = sum(len(p[2]) for p in pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        out, need = [], size
        while need:
            doc, start, ids, loss = pieces.pop(0)
            if len(ids) > need:
                pieces.insert(0, (doc, start + need, ids[need:], loss[need:]))
                ids, loss = ids[:need], loss[:need]
            need -= len(ids)
            out.append((doc, start, ids, loss))
        yield out


def _sequences(examples: Iterator[tuple], limits: Limits, pool_size: int) -> Iterator[list[tuple]]:
    """Sequences of pieces; ``examples`` yields ((id, tokens), ids, loss flags)."""
    pool = _Pool(limits, pool_size)
    for doc, ids, loss in examples:
        start = 0
        while (cut := _cut(loss[start:], limits.tokens, limits.loss_tokens)) and start + cut < len(ids):
            yield [(doc, start, ids[start : start + cut], loss[start : start + cut])]
            start += cut
        if len(ids) - start == limits.tokens:
            yield [(doc, start, ids[start:], loss[start:])]
            continue
        pool.add(doc, start, ids[start:], loss[start:])
        while len(pool.items) >= pool_size:
            yield pool.fill()
    while pool.items:
        chosen = pool.fill()
        if pool.items or sum(len(p[2]) for p in chosen) == limits.tokens:
            yield chosen
        else:
            yield from _powers(chosen)


def _rows(sequences: Iterator[list[tuple]], with_ids: bool, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 33 if TaskContext.get() else 0
    kinds = [pa.int64()] * 8 + [pa.list_(pa.int32())]
    names = [x.split()[0] for x in PIECES.split(", ")]
    out: list[list] = [[] for _ in names]

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
        for c in out:
            c.clear()
        return made

    for n, pieces in enumerate(sequences):
        offset = 0
        for (doc, total), start, ids, loss in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
            row = (doc, start, len(ids), crc, total, first + n, offset, int(np.count_nonzero(loss)), ids.astype(np.int32) if with_ids else None)
            for c, v in zip(out, row, strict=True):
                c.append(v)
            offset += len(ids)
        if len(out[0]) >= rows:
            yield batch()
    if out[0]:
        yield batch()


def pack(
    examples: DataFrame,
    limits: Limits = Limits(),
    *,
    ranks: str | None = None,
    added: tuple[tuple[str, int], ...] | None = None,
    end_id: int = 0,
    pool_size: int = 1024,
    with_ids: bool = True,
) -> DataFrame:
    """Pack ``examples(doc_id, segments array<struct<text string, loss boolean>>)``; returns ``PIECES``.

    Tokens of a segment bear loss if its flag says so; the closing ``end_id`` never does. ``ranks`` is a rank
    file with the ids of the tokenizer that is meant (default: the 50k byte-level vocabulary). Where a text holds
    a string of ``added`` (default: the added tokens of that vocabulary's tokenizer file) it is cut and the string's
    id set, as the ``tokenizers`` library does.
    """
    added = added_tokens() if added is None else added
    specials = {string for string, _ in added}
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks, added)

        def read() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    for doc, segments in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        ids, loss = [], []
                        for s in segments or ():
                            if s and s["text"]:
                                x = bpe.encode_to_numpy(s["text"], allowed_special=specials, disallowed_special=())
                                ids.append(x)
                                loss.append(np.full(len(x), bool(s["loss"])))
                        ids.append(np.array([end_id], np.uint32))
                        loss.append(np.zeros(1, bool))
                        x = np.concatenate(ids)
                        yield (doc, len(x)), x, np.concatenate(loss)

        yield from _rows(_sequences(read(), limits, pool_size), with_ids)

    return examples.select("doc_id", "segments").mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, limits: Limits = Limits(), **options) -> DataFrame:
    """Pack whole ``docs(doc_id, text)``, all of whose text bears loss."""
    one = F.struct(F.col("text").alias("text"), F.lit(True).alias("loss"))
    return pack(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array(one).alias("segments")), limits, **options)


def pack_conversations(turns: DataFrame, limits: Limits = Limits(), loss_role: str = "assistant", **options) -> DataFrame:
    """Pack ``turns(conv_id, turn, role, text)`` by conversation; only ``loss_role`` turns bear loss.

    A conversation is gathered whole, in turn order: its turns are one training example.
    """
    turn = F.struct("turn", F.col("text").alias("text"), (F.col("role") == loss_role).alias("loss"))
    gathered = turns.groupBy(F.col("conv_id").cast("long").alias("doc_id")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    segments = F.transform("t", lambda x: F.struct(x["text"].alias("text"), F.coalesce(x["loss"], F.lit(False)).alias("loss")))
    return pack(gathered.select("doc_id", segments.alias("segments")), limits, **options)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, with_ids=False).drop("ids")


def stage_packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences, with their ids; null texts, repeated rows and empty tables as in ``pack``."""
    return pack_documents(docs)
