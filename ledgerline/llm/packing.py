"""Packing by order-preserving dynamic programming.

The ids of the documents, each closed by END, stay in the order in which they are read. Windows of at most LENGTH ids are
cut from them at document ends (free), sentence ends or, where sentences run long, at a grid of other places; a cut costs
SENTENCE or MIDDLE, padding one for each id. The least cost up to a cut i is the least of cost(j) + LENGTH - (i - j) over
the cuts j within LENGTH before it, plus the cost of the cut itself: a sliding minimum of cost(j) + j, kept in a monotone
queue, so the work grows with the number of cuts. Windows are settled in blocks of about BLOCK ids, what follows the last
settled cut goes on to the next block. The rest at the end of a partition is split into powers of two, which are not padded.

A partition of the input is packed by one task from its own rows: nothing is shuffled, and a task that is run again gives
the same rows. sequence_id is the partition's number in the upper bits and counts in the lower 33.

With `by`, rows of unlike values there share no sequence: a task packs each value's rows by themselves, in the order in which
they are read, and has at most HELD ids waiting, as beyond them the value with the most ids is settled early.

A null text is empty and has the one id END. Repeated rows are packed one by one. An empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import per_worker, sized, tidied
from .tokens import CAPACITY, Encoder, public_path

LENGTH, END, SENTENCE, MIDDLE, GRID, BLOCK, HELD, SLICE = 2048, 1, 1, 3, 48, 1 << 19, 1 << 22, 2 << 20
PIECE = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def cuts(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Places to cut, ascending and with 0 first, and what each costs. Neighbours are at most GRID apart."""
    kind = np.concatenate((np.zeros(1 + len(doc_ends), np.int64), np.full(len(sentence_ends), SENTENCE)))
    place = np.concatenate(([0], doc_ends, sentence_ends))
    order = np.lexsort((kind, place))
    place, kind = place[order], kind[order]
    first = np.concatenate(([True], place[1:] != place[:-1]))
    place, kind = place[first], kind[first]
    gaps = np.diff(place, append=total)
    wide = np.flatnonzero(gaps > GRID)
    more = np.concatenate([np.arange(place[k] + GRID, place[k] + gaps[k], GRID) for k in wide]) if len(wide) else np.zeros(0, np.int64)
    place = np.concatenate((place, more))
    kind = np.concatenate((kind, np.full(len(more), MIDDLE)))
    order = np.argsort(place, kind="stable")
    return place[order].tolist(), kind[order].tolist()


def windows(place: list[int], price: list[int], length: int, final: bool) -> list[int]:
    """Ends of the windows of least cost. Unless final, they stop at the best cut within the last window's reach."""
    cost, back, queue = [0] * len(place), [0] * len(place), deque([(0, 0)])
    sums = [0] * len(place)
    for i in range(1, len(place)):
        here = place[i]
        while here - place[queue[0][0]] > length:
            queue.popleft()
        j, least = queue[0]
        cost[i] = least + length - here + price[i]
        back[i] = j
        value = sums[i] = cost[i] + here
        while queue and queue[-1][1] >= value:
            queue.pop()
        queue.append((i, value))
    at = len(place) - 1
    if not final:
        reach = [k for k in range(len(place) - 1, 0, -1) if place[-1] - place[k] < length]
        at = min(reach, key=cost.__getitem__, default=at)
    ends = []
    while at > 0:
        ends.append(place[at])
        at = back[at]
    return ends[::-1]


def powers(n: int) -> list[int]:
    """n as descending powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class Packer:
    """Takes documents, gives settled pieces: doc, start, length, doc_tokens, sequence, offset, ids. Packers may share numbers."""

    def __init__(self, ends_sentence: np.ndarray, length: int = LENGTH, block: int = BLOCK, numbers: Iterator[int] | None = None):
        self.ends_sentence, self.length, self.block, self.numbers = ends_sentence, length, block, numbers or count()
        self.docs: list[tuple] = []  # name, ids left, ids of it that are settled, ids in all
        self.held = 0

    def add(self, name, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((name, ids, 0, len(ids)))
        self.held += len(ids)
        if self.held >= self.block:
            yield self.settle(False)

    def settle(self, final: bool) -> tuple:
        flat = np.concatenate([d[1] for d in self.docs])
        doc_ends = np.cumsum([len(d[1]) for d in self.docs])
        place, price = cuts(len(flat), doc_ends, np.flatnonzero(self.ends_sentence[flat]) + 1)
        ends = windows(place, price, self.length, final)
        if final and ends:
            start = ends[-2] if len(ends) > 1 else 0
            ends = ends[:-1] + (start + np.cumsum(powers(ends[-1] - start))).tolist()
        done = ends[-1]
        bounds = np.array(ends)
        both = np.unique(np.concatenate((bounds, doc_ends[doc_ends <= done])))
        starts = np.concatenate(([0], both[:-1]))
        doc = np.searchsorted(doc_ends, starts, "right")
        window = np.searchsorted(bounds, starts, "right")
        doc_starts = np.concatenate(([0], doc_ends[:-1]))
        settled = np.array([d[2] for d in self.docs])
        rows = (
            [self.docs[k][0] for k in doc.tolist()], starts - doc_starts[doc] + settled[doc], both - starts, np.array([d[3] for d in self.docs])[doc],
            np.fromiter(islice(self.numbers, len(ends)), np.int64, len(ends))[window], starts - np.concatenate(([0], bounds[:-1]))[window], flat[:done].astype("<u4"), np.concatenate(([0], both)),
        )
        k = int(np.searchsorted(doc_ends, done, "right"))
        left = self.docs[k:]
        if left:
            name, ids, before, total = left[0]
            gone = done - int(doc_starts[k])
            left[0] = (name, ids[gone:], before + gone, total)
        self.docs, self.held = left, len(flat) - done
        return rows


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END, block: int = BLOCK, by: str | None = None, held: int = HELD, piece: int = SLICE, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit), and `by`, a string
    column, if it is given. Texts are encoded by slices of `piece` bytes, with the ids of at most `capacity` text pieces kept; both
    bound what a worker takes and change no row."""
    tokenizer = tokenizer or public_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("encoder", tokenizer, *[capacity] * (capacity != CAPACITY)), lambda: Encoder(tokenizer, capacity))
        tokens = [encoder.library.id_to_token(k) or "" for k in range(encoder.vocabulary)]
        ends_sentence, numbers = np.array([t.endswith((".", "!", "?", "Ċ")) for t in tokens]), count()
        packers: dict[str | None, Packer] = {}
        tail, part, type_ = np.array([end], encoder.dtype), 0, pa.int64()

        def out(group: str | None, rows: tuple) -> pa.RecordBatch:
            names, start, size, total, sequence, offset, ids, bounds = rows
            data = pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids)])
            columns = [pa.array(names, type_), *map(pa.array, (start, size, total, (part << 33) + sequence, offset)), data]
            return pa.RecordBatch.from_arrays(columns + [pa.array([group] * len(names), pa.string())] * bool(by), PIECE + [by] * bool(by))

        for batch in sized(batches, 2, piece):
            part, type_ = batch.column(0)[0].as_py(), batch.column(1).type
            groups = batch.column(3).to_pylist() if by else [None] * batch.num_rows
            for name, group, own in zip(batch.column(1).to_pylist(), groups, encoder.encode_column(batch.column(2))):
                if group not in packers:
                    packers[group] = Packer(ends_sentence, length, block, numbers)
                for rows in packers[group].add(name, np.concatenate((own, tail))):
                    yield out(group, rows)
            if sum(p.held for p in packers.values()) > held:
                group = max(packers, key=lambda g: packers[g].held)
                yield out(group, packers[group].settle(False))
        for group, packer in packers.items():
            if packer.docs:
                yield out(group, packer.settle(True))

    source = docs.select(F.spark_partition_id().alias("part"), "doc_id", "text", *[by] * bool(by))
    schema = f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    return source.mapInArrow(tidied(run), schema + f", `{by}` string" * bool(by))


def packed(docs: DataFrame, **options) -> DataFrame:
    """The pieces with a checksum in the place of their ids."""
    pieces = pack(docs, **options)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", *pieces.columns[len(PIECE) :])
