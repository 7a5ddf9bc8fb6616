"""Removal of repeated byte strings by a distributed merge sort of suffixes (operator 11).

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id. The strings
are prefixes of suffixes, and equal ones meet in a sort: tasks sort the suffixes of a block of texts, exchange sorted,
front-coded runs (each string as what differs from the one before) by ranges, and each range merges its runs with a
loser tree that carries common prefixes: two strings whose prefixes shared with the last one out differ in length are
ordered without a look at their bytes, others are compared only behind what they are known to share.

Sorting the suffix of every byte would move some forty bytes for each, so it is done in two passes over few suffixes.
Each window of ``length`` bytes has an anchor, the leftmost of its ``gram``-byte strings of least hash; equal windows
have equal anchors at equal places, and one anchor serves some thirteen windows.

1. Anchors whose gram's hash occurs in one text only serve no repeated window. Each block's distinct hashes are sent
   by ranges as sorted differences; a bit for each comes back.
2. The suffixes at the other anchors, each with the bytes before it that its windows need in reverse, are sorted. Equal
   ones share all their windows: all but those of the smallest id are repeats. The common prefix of neighbours says
   which windows of the smallest may still equal another one's.
3. The suffixes at these windows are sorted, which settles them.

Equal strings of a block cross as one string with their places, so a passage that a third of all texts share is one
string a block. Blocks hold about ``BLOCK_BYTES`` (more only if one text is longer) and are written once, in buckets, so
texts are never shuffled; ranges are many enough to be bounded. Split points come from a bounded sample of the hashes
found in step 1; they decide where a string is sorted, never whether.

Edge cases: a null text is empty; texts shorter than ``length`` lose nothing; a null id loses nothing and takes
nothing; repeated rows have the same id, so neither loses to the other; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import bucketed, materialise, settled

LENGTH = 50
BLOCK_BYTES, BLOCK_ROWS = 16_000_000, 8192
#: Window starts that are hashed at once.
STRETCH = 1 << 21
#: Bits of a block's number in its partition.
IN_PARTITION = 24
#: Bits of a gram's hash that are exchanged; equal hashes of unlike grams only cost work.
KEY = 40
#: Hashes or strings that a range is made for, and sampled strings at most (on average).
RANGE_KEYS, RANGE_STRINGS, SAMPLE = 4_000_000, 300_000, 200_000
BUCKETS = 100_000

_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
ROWS = "block long, row int, doc_id long, text binary"
SPANS = "block long, kind int, payload binary"


# ---- blocks


def _blocked(docs: DataFrame) -> DataFrame:
    """``ROWS``: texts as bytes, dealt to blocks in the order in which tasks read them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row, held = TaskContext.get().partitionId() << IN_PARTITION, 0, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_pylist()
            blocks, rows = [], []
            for n in sizes:
                if row == BLOCK_ROWS or (row and held + n > BLOCK_BYTES):
                    block, row, held = block + 1, 0, 0
                blocks.append(block)
                rows.append(row)
                row, held = row + 1, held + n
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(rows, pa.int32()), *batch.columns], ["block", "row", "doc_id", "text"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, ROWS)


class _Block:
    """A block's texts as one array of bytes; of equal texts only one with the smallest id takes part."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by("row")
        self.ids = table.column("doc_id").to_pylist()
        texts = table.column("text").to_pylist()
        least: dict[bytes, int] = {}
        for i, (own, text) in enumerate(zip(self.ids, texts, strict=True)):
            if own is not None and (text not in least or own < self.ids[least[text]]):
                least[text] = i
        self.first = [least.get(text, i) for i, text in enumerate(texts)]
        self.part = np.array([i for i, text in enumerate(texts) if self.ids[i] is not None and least[text] == i], np.int64)
        self.texts = texts
        kept = [texts[i] for i in self.part.tolist()]
        self.data = np.frombuffer(b"".join(kept), np.uint8)
        self.ends = np.cumsum([len(t) for t in kept], dtype=np.int64)
        self.starts = np.append(0, self.ends[:-1])[: len(kept)].astype(np.int64)
        self.owners = np.array([self.ids[i] for i in self.part.tolist()], np.int64)

    def text_at(self, at: np.ndarray) -> np.ndarray:
        """Which of the texts that take part holds each byte."""
        return np.searchsorted(self.ends, at, "right")


# ---- anchors


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on, from those of powers of two."""
    h, size, at, out = data.astype(np.uint64) + np.uint64(1), 1, 0, None
    n = len(data) - gram + 1
    while True:
        if gram & size:  # the bits of ``gram`` from the lowest: each stretch goes before those taken
            part = h[gram - at - size : gram - at - size + n]
            out = part.copy() if out is None else out + part * np.uint64(pow(_BASE, at, 1 << 64))
            at += size
        if at == gram:
            break
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    out ^= out >> np.uint64(31)
    out *= np.uint64(_MIX)
    return out ^ out >> np.uint64(29)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Of each ``width`` hashes in a row the least, its lowest five bits replaced by how far behind the first it is.

    Offsets count from the window's own start, so of equal hashes the leftmost is least.
    """
    low = np.uint64(31)
    v, size = h & ~low, 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:] + np.uint64(size))
        size *= 2
    rest = width - size
    return np.minimum(v[: len(v) - rest], v[rest:] + np.uint64(rest)) if rest else v


def anchors(block: _Block, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first and last window, hash) of the anchors of all windows of a block's texts, in order."""
    found = []
    width = length - gram + 1
    n = len(block.data)
    valid = np.zeros(n + 1, bool)
    for s, e in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
        valid[s : max(s, e - length + 1)] = True
    for s in range(0, max(n - length + 1, 0), STRETCH):
        v = _least(_gram_hashes(block.data[s : s + STRETCH + length - 1], gram), width)
        p = np.flatnonzero(valid[s : s + len(v)])
        v = v[p]
        a = p + (v & np.uint64(31)).astype(np.int64) + s
        new = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(a)) - 1 if len(a) else new
        found.append((a[new], p[new] + s, p[last] + s, v[new] >> np.uint64(5)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    a, lo, hi, h = (np.concatenate(x) for x in zip(*found, strict=True))
    # a stretch may end within an anchor's windows
    same = np.flatnonzero(a[1:] == a[:-1])
    hi[same] = hi[same + 1]
    keep = np.ones(len(a), bool)
    keep[same + 1] = False
    return a[keep], lo[keep], hi[keep], h[keep] * np.uint64(_BASE) >> np.uint64(64 - KEY)


def _contexts(block: _Block, a: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Rows of bytes: the suffix at each anchor, the bytes before it in reverse, and which windows it serves.

    Bytes that no window of the anchor covers are zero, so equal rows are equal windows.
    """
    before = length - gram
    data = np.concatenate([np.zeros(before, np.uint8), block.data, np.zeros(length, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(data, before + length)[a]
    out = np.empty((len(a), length + before + 2), np.uint8)
    out[:, :length] = view[:, before:]
    out[:, length:-2] = view[:, before - 1 :: -1] if before else view[:, :0]
    out[:, :length][np.arange(length) >= (hi + length - a)[:, None]] = 0
    out[:, length:-2][np.arange(before) >= (a - lo)[:, None]] = 0
    out[:, -2], out[:, -1] = a - hi, a - lo
    return out


# ---- front-coded runs


def _stretches(x: np.ndarray) -> list[tuple[int, int]]:
    """(start, stop) of each stretch of equal numbers."""
    cuts = np.flatnonzero(np.diff(x)) + 1
    ends = [0, *cuts.tolist(), len(x)]
    return list(zip(ends, ends[1:], strict=False)) if len(x) else []


def _press(x: np.ndarray) -> bytes:
    """Numbers, their bytes in planes, compressed."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(raw.tobytes())


def _numbers(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _whole(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as strings that sort by bytes."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


RUNS = "part int, block long, shared binary, tails binary, counts binary, owners binary, texts binary, places binary"
_RUN_KINDS = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
_RUN_NAMES = [f.split()[0] for f in RUNS.split(", ")]


def sorted_run(number: int, rows: np.ndarray, owners: np.ndarray, texts: np.ndarray, places: np.ndarray, splits: np.ndarray) -> pa.Table:
    """``RUNS``: the rows in order, each distinct one once with its places by owner, cut at ``splits``, front-coded."""
    order = np.lexsort((owners,))
    order = order[np.argsort(_whole(rows)[order], kind="stable")]
    rows, owners, texts, places = rows[order], owners[order], texts[order], places[order]
    unlike = rows[1:] != rows[:-1]
    new = np.flatnonzero(np.append(True, unlike.any(1))) if len(rows) else np.zeros(0, np.int64)
    shared = np.append(0, unlike.argmax(1)[new[1:] - 1]) if len(new) else new
    counts = np.diff(np.append(new, len(rows)))
    distinct = rows[new]
    part = np.searchsorted(splits, _whole(distinct), "right") if len(splits) and len(new) else np.zeros(len(new), np.int64)
    made = []
    for i, j in _stretches(part):
        shared[i] = 0
        s, e = new[i], new[j] if j < len(new) else len(rows)
        tails = distinct[i:j][np.arange(rows.shape[1]) >= shared[i:j, None]]
        squeeze = zstandard.ZstdCompressor(level=3).compress
        made.append((int(part[i]), number, squeeze(shared[i:j].astype(np.uint8).tobytes()), squeeze(tails.tobytes()), _press(counts[i:j].astype(np.uint32)), _press(owners[s:e]), _press(texts[s:e].astype(np.uint32)), _press(places[s:e].astype(np.uint32))))
    columns = zip(*made, strict=True) if made else [[] for _ in _RUN_NAMES]
    return pa.table([pa.array(c, k) for c, k in zip(columns, _RUN_KINDS, strict=True)], _RUN_NAMES)


def read_run(shared: bytes, tails: bytes, width: int) -> Iterator[tuple[bytes, int]]:
    """(string, length of the prefix it shares with the one before) of a run, in order."""
    squeezed = zstandard.ZstdDecompressor()
    shared, tails = squeezed.decompress(shared), squeezed.decompress(tails)
    last, at = b"", 0
    for n in shared:
        end = at + width - n
        last, at = last[:n] + tails[at:end], end
        yield last, n


def merge(runs: list[Iterator[tuple[bytes, int]]], width: int) -> Iterator[tuple[int, bytes, int]]:
    """(run, string, length of the prefix shared with the string before) of all runs, in order, by a loser tree.

    Each node holds the run that lost there. ``known[r]`` is how much the run's string shares with the last string that
    passed the node; the longer prefix wins unread, equal ones are read on from there.
    """
    leaves = 1 << max(len(runs) - 1, 0).bit_length()
    strings: list[bytes | None] = [None] * leaves
    known = [0] * leaves
    for r, run in enumerate(runs):
        first = next(run, None)
        strings[r] = None if first is None else first[0]

    def loses(i: int, j: int) -> bool:
        """Whether run ``i`` comes behind run ``j``; the loser's known prefix becomes that with the winner."""
        x, y = strings[i], strings[j]
        if x is None or y is None:
            return x is None
        a, b = known[i], known[j]
        if a != b:
            return a < b
        x, y = x[a:], y[a:]
        if x == y:
            known[max(i, j)] = width
            return i > j
        more = int.from_bytes(x) ^ int.from_bytes(y)
        shared = width - (more.bit_length() + 7) // 8
        if x < y:
            known[j] = shared
            return False
        known[i] = shared
        return True

    tree = [0] * leaves

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        i, j = build(2 * node), build(2 * node + 1)
        if loses(i, j):
            i, j = j, i
        tree[node] = j
        return i

    if not runs:
        return
    best = build(1)
    while strings[best] is not None:
        yield best, strings[best], known[best]
        strings[best], known[best] = next(runs[best], (None, 0))
        node = best + leaves >> 1
        while node:
            if loses(best, tree[node]):
                best, tree[node] = tree[node], best
            node >>= 1


def _spans(kind: int, block: np.ndarray, texts: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int, bytes]]:
    """``SPANS``: of each block the windows ``first`` to ``last`` of its texts, as one message."""
    order = np.argsort(block, kind="stable")
    block = block[order]
    whole = np.stack([texts[order], first[order], last[order] - first[order]]).astype(np.uint32)
    return [(int(block[i]), kind, _press(whole[:, i:j].ravel())) for i, j in _stretches(block)]


def _read_spans(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, last window) of all messages."""
    parts = [_numbers(b, np.uint32).reshape(3, -1).astype(np.int64) for b in payloads]
    text, first, more = np.concatenate(parts, 1) if parts else np.zeros((3, 0), np.int64)
    return text, first, first + more


def settle(messages: pa.Table, width: int, length: int, gram: int) -> list[tuple[int, int, bytes]]:
    """``SPANS`` of a range of runs: kind 0 has windows that an earlier document has too, kind 1 those that are open.

    Strings longer than ``length`` are contexts of anchors, others are the windows themselves.
    """
    runs = {c: messages.column(c).to_pylist() for c in _RUN_NAMES}
    # of each distinct string how much it shares with the one before and its last two bytes; of each run its strings' numbers
    shared, served = [], []
    numbers: list[list[int]] = [[] for _ in runs["part"]]
    for r, string, same in merge([read_run(s, t, width) for s, t in zip(runs["shared"], runs["tails"], strict=True)], width):
        if same < width or not shared:
            shared.append(same)
            served.append(string[-2:])
        numbers[r].append(len(shared) - 1)
    string = np.concatenate([np.array(x, np.int64) for x in numbers])
    counts = np.concatenate([_numbers(b, np.uint32).astype(np.int64) for b in runs["counts"]])
    owners = [_numbers(b, np.int64) for b in runs["owners"]]
    block = np.repeat(np.array(runs["block"], np.int64), [len(o) for o in owners])
    owner = np.concatenate(owners)
    text, place = (np.concatenate([_numbers(b, np.uint32).astype(np.int64) for b in runs[c]]) for c in ("texts", "places"))
    head = np.cumsum(counts) - counts  # a string's first place in its run is of its smallest owner
    order = np.lexsort((owner[head], string))
    least = owner[head[order[np.append(True, np.diff(string[order]) > 0)]]]
    of = np.repeat(string, counts)
    bad = owner > least[of]
    if width == length:
        return _spans(0, block[bad], text[bad], place[bad], place[bad])
    near, far = np.frombuffer(b"".join(served), np.uint8).reshape(-1, 2).T.astype(np.int64)
    found = _spans(0, block[bad], text[bad], (place - far[of])[bad], (place - near[of])[bad])
    prefix = np.append(shared, 0)
    around = np.minimum(np.maximum(prefix[:-1], prefix[1:]), length)
    around[[0, -1]] = length  # neighbours in other ranges are not known
    near = np.maximum(near, length - around)
    may = (around >= gram) & (near <= far)
    open_ = may[of] & ~bad  # all places of the smallest id: a text may hold a string twice
    return found + _spans(1, block[open_], text[open_], (place - far[of])[open_], (place - near[of])[open_])


# ---- steps


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary())}
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


MESSAGES = "part int, block long, hashes binary, picked array<int>, samples array<binary>"
REPLIES = "block long, part int, n int, bits binary, hot long, samples array<binary>"


def _ask(parts: int, one_of: int, length: int, gram: int):
    """A block's distinct hashes by range, as differences, with the contexts of one hash of ``one_of``."""

    def run(table: pa.Table) -> pa.Table:
        block = _Block(table)
        a, lo, hi, h = anchors(block, length, gram)
        u, at = np.unique(h, return_index=True)
        picked = np.flatnonzero((u * np.uint64(_MIX) >> np.uint64(40)) % np.uint64(one_of) == 0)
        x = at[picked]
        contexts = _contexts(block, a[x], lo[x], hi[x], length, gram)
        part = (u * np.uint64(parts) >> np.uint64(KEY)).astype(np.int64)
        number, rows = table.column("block")[0].as_py(), []
        for i, j in _stretches(part):
            s, e = np.searchsorted(picked, [i, j])
            rows.append((int(part[i]), number, _press(np.diff(u[i:j], prepend=np.uint64(0))), (picked[s:e] - i).tolist(), [c.tobytes() for c in contexts[s:e]]))
        return _table(rows, MESSAGES)

    return run


def _answer(messages: pa.Table) -> pa.Table:
    """Of each message's hashes those that another block has too, as bits, and the samples among them."""
    m = messages.to_pydict()
    hashes = [np.cumsum(_numbers(b, np.uint64), dtype=np.uint64) for b in m["hashes"]]
    ends = np.cumsum([len(x) for x in hashes])
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    hot = np.zeros(len(every), bool)
    hot[order[1:][same]] = hot[order[:-1][same]] = True
    rows = []
    for i, own in enumerate(np.split(hot, ends[:-1])):
        samples = [s for at, s in zip(m["picked"][i], m["samples"][i], strict=True) if own[at]]
        rows.append((m["block"][i], m["part"][i], len(own), np.packbits(own).tobytes(), int(own.sum()), samples))
    return _table(rows, REPLIES)


def _context_run(splits: np.ndarray, length: int, gram: int):
    """The run of a block's contexts whose hash occurs in another text."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(table)
        a, lo, hi, h = anchors(block, length, gram)
        text = block.text_at(a)
        replies = replies.sort_by("part").to_pydict()
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(replies["bits"], replies["n"], strict=True)]
        hot = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        order = np.lexsort((text, h))
        new = np.append(True, h[order][1:] != h[order][:-1]) if len(h) else np.zeros(0, bool)
        rank = np.cumsum(new) - 1  # of each hash among the block's distinct ones
        # in two texts of this block: its first text is not its last
        cuts = np.flatnonzero(new)
        last = np.append(cuts[1:], len(order)) - 1
        hot = hot | (text[order][cuts] != text[order][last]) if len(cuts) else hot
        x = np.sort(order[hot[rank]]) if len(order) else order
        rows = _contexts(block, a[x], lo[x], hi[x], length, gram)
        return sorted_run(table.column("block")[0].as_py(), rows, block.owners[text[x]], text[x], a[x] - block.starts[text[x]], splits)

    return run


def _window_run(splits: np.ndarray, length: int):
    """The run of a block's open windows."""

    def run(table: pa.Table, spans: pa.Table) -> pa.Table:
        block = _Block(table)
        text, first, last = _read_spans(spans.column("payload").to_pylist())
        n = last - first + 1
        text, place = np.repeat(text, n), np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        view = np.lib.stride_tricks.sliding_window_view(block.data, length) if len(block.data) >= length else np.zeros((0, length), np.uint8)
        rows = view[block.starts[text] + place]
        return sorted_run(table.column("block")[0].as_py(), rows, block.owners[text], text, place, splits)

    return run


KEPT = "doc_id long, n_bytes long, starts array<int>, stops array<int>, kept binary"


def _without(length: int):
    """A block's texts without their repeated windows."""

    def run(table: pa.Table, spans: pa.Table) -> pa.Table:
        block = _Block(table)
        text, first, last = _read_spans(spans.column("payload").to_pylist())
        depth = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(depth, block.starts[text] + first, 1)
        np.add.at(depth, block.starts[text] + last + length, -1)
        gone = np.cumsum(depth[:-1]) > 0
        position = {row: k for k, row in enumerate(block.part.tolist())}
        rows = []
        for i, (own, whole) in enumerate(zip(block.ids, block.texts, strict=True)):
            k = position.get(block.first[i])
            if own is None or k is None:
                starts, stops, kept = [], [], whole
            elif own > block.ids[block.first[i]]:  # all of an equal text with a smaller id
                long = len(whole) >= length
                starts, stops, kept = ([0], [len(whole)], b"") if long else ([], [], whole)
            else:
                mask = gone[block.starts[k] : block.ends[k]]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).tolist()
                starts, stops = edges[::2], edges[1::2]
                kept = block.data[block.starts[k] : block.ends[k]][~mask].tobytes() if edges else whole
            rows.append((own, len(whole), starts, stops, kept))
        return _table(rows, KEPT)

    return run


def _splits(sample: list[bytes], parts: int, width: int) -> np.ndarray:
    """At most ``parts - 1`` strings that cut the sample evenly."""
    x = np.unique(np.array([s[:width].ljust(width, b"\0") for s in sample], f"S{width}"))
    return np.unique(x[np.linspace(0, len(x), parts + 1).astype(int)[1:-1]]) if len(x) else x


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``KEPT``: of each of ``docs(doc_id, text)`` the stretches of bytes that are repeats, and the bytes that are left.

    Reads written tables; use it within ``session.settled`` or ``session.scratch``, which remove them.
    """
    spark, gram = docs.sparkSession, length // 2 + 1
    if length - gram + 1 > 32:
        raise ValueError("length is at most 63")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = length + (length - gram) + 2
    texts = bucketed(_blocked(docs), "block", min(BUCKETS, max(least, size // (2 * BLOCK_BYTES) + 1)), "suffix-texts")
    hashes = size // (length - gram + 1) * 2  # anchors, by the usual density of least hashes

    parts = max(least, hashes // RANGE_KEYS + 1)
    asked = texts.groupBy("block").applyInArrow(_ask(parts, max(1, hashes // SAMPLE), length, gram), MESSAGES)
    replies = materialise(asked.repartition(parts, "part").groupBy("part").applyInArrow(_answer, REPLIES), "suffix-replies")
    sample = [r[0] for r in replies.select(F.explode("samples")).collect()]  # some SAMPLE strings, whatever the input
    ranges = max(least, (replies.agg(F.sum("hot")).first()[0] or 0) // RANGE_STRINGS + 1)

    def merged(runs: DataFrame, wide: int) -> DataFrame:
        dealt = runs.repartition(ranges, "part").groupBy("part")
        return dealt.applyInArrow(lambda t: _table(settle(t, wide, length, gram), SPANS), SPANS)

    contexts = texts.groupBy("block").cogroup(replies.select("block", "part", "n", "bits").groupBy("block"))
    spans = materialise(merged(contexts.applyInArrow(_context_run(_splits(sample, ranges, width), length, gram), RUNS), width), "suffix-spans")
    windows = texts.groupBy("block").cogroup(spans.where("kind = 1").groupBy("block"))
    last = merged(windows.applyInArrow(_window_run(_splits(sample, ranges, length), length), RUNS), length)
    return texts.groupBy("block").cogroup(spans.where("kind = 0").union(last).groupBy("block")).applyInArrow(_without(length), KEPT)


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes of 50-byte strings that an earlier document has: counts and digests."""

    def build() -> DataFrame:
        rows = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
        removed = F.aggregate(F.zip_with("starts", "stops", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
        return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

    return settled(spark, "op11", build)


ORACLE_SQL = """
with own as materialized (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
places as (select r, doc_id, h, unnest(range(len(h) // 2 - 49)) as p from own where doc_id is not null),
strings as materialized (select r, doc_id, p, substr(h, 2 * p + 1, 100) as s from places),
least as (select s, min(doc_id) as first_id from strings group by s),
bad as (select r, p from strings join least using (s) where first_id < doc_id),
begins as (select r, p, case when p <= lag(p) over (partition by r order by p) + 50 then 0 else 1 end as new from bad),
runs as (select r, p, sum(new) over (partition by r order by p) as run from begins),
spans as (select r, run, min(p) as start, max(p) + 50 as stop from runs group by r, run),
pieces as (
  select r, start, coalesce(lag(stop) over (partition by r order by start), 0) as since, start as upto, stop - start as gone from spans
  union all select r, max(stop), max(stop), len(any_value(h)) // 2, 0 from spans join own using (r) group by r),
kept as (
  select r, sum(gone)::bigint as n_removed, count(*) filter (gone > 0) as n_spans, string_agg(substr(h, 2 * since + 1, 2 * (upto - since)), '' order by start, gone desc) as h
  from pieces join own using (r) group by r)
select doc_id, len(own.h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept.h, own.h))) as kept_sha256
from own left join kept using (r)
"""
