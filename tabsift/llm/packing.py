"""Token ids packed into fixed rows: best-fit decreasing with a segment tree over the rows' free room.

Documents longer than a row are split without loss; full pieces are rows of their own, the ends are packed with the
other documents. Each task packs what it reads, in lots of bounded size, so ids are never shuffled. A packed row
holds its ids as one line of the matrix, the cumulative lengths of its segments and the places where positions
start anew, with the documents they come from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tabsift.llm.common import chunks, read_bytes, small_batches

#: Tokens of a row, and tokens that one lot holds in memory.
ROW_TOKENS, LOT_TOKENS = 4_096, 4_000_000
CHUNK_BYTES = 4_000_000


class RoomTree:
    """A segment tree over free room 0..limit: how many open rows have each room; finds the least room that fits."""

    def __init__(self, limit: int):
        self.leaves = 1 << (limit + 1).bit_length()
        self.many = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(limit + 1)]

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.many[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        if room:
            self.rows[room].append(row)
            self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The open row of least room that holds ``need``, taken out with its room; None if there is none."""
        many, at = self.many, need + self.leaves
        if not many[at]:
            # Up to the first ancestor with rows on its right, then down to its leftmost one.
            while at > 1 and (at & 1 or not many[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if many[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], limit: int) -> list[list[int]]:
    """Rows as lists of places of ``lengths`` (1 to limit each), longest first, each into the tightest row."""
    tree, rows = RoomTree(limit), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[item])
        if found is None:
            rows.append([item])
            tree.put(limit - lengths[item], len(rows) - 1)
        else:
            room, row = found
            rows[row].append(item)
            tree.put(room - lengths[item], row)
    return rows


SCHEMA = (
    "shard int, row long, n_tokens int, n_segments int, doc_ids array<long>, doc_starts array<int>, "
    "cu_seqlens array<int>, position_resets array<int>, input_ids binary"
)


def pack_tokens(
    docs: DataFrame, ranks_path: str, *, pattern: str, text: str = "text", row_tokens: int = ROW_TOKENS,
    pad: int = 50_256, lot_tokens: int = LOT_TOKENS,
) -> DataFrame:
    """Packed rows of the tokens of all documents.

    shard and row number the rows. input_ids is a line of ``row_tokens`` little-endian unsigned 32-bit ids, filled
    up with ``pad``; n_tokens of them are used. cu_seqlens are the cumulative lengths of the n_segments segments,
    from 0; position_resets the places where positions begin at 0 again (cu_seqlens but its last); doc_ids and
    doc_starts name the document of each segment and the place of its first token there. Null and empty texts have
    no tokens and are in no row; repeated rows are packed as often as they occur; a null doc_id stays null; an
    empty table gives no rows. Shards are the tasks, so equal files and settings give equal rows.
    """
    data = read_bytes(ranks_path)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}
        library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        shard, made = TaskContext.get().partitionId(), 0
        pieces: list[tuple] = []  # doc_id, place in the document, ids
        held = 0

        def pack() -> Iterator[pa.RecordBatch]:
            nonlocal made
            rows = best_fit_decreasing([len(p[2]) for p in pieces], row_tokens)
            for at in range(0, len(rows), 256):
                part = [[pieces[i] for i in row] for row in rows[at:at + 256]]
                ends = [np.cumsum([0, *(len(p[2]) for p in row)]).tolist() for row in part]
                lines = []
                for row, upto in zip(part, ends):
                    line = np.full(row_tokens, pad, "<u4")
                    line[:upto[-1]] = np.concatenate([p[2] for p in row])
                    lines.append(line.tobytes())
                columns = [
                    pa.array([shard] * len(part), pa.int32()), pa.array(range(made, made + len(part)), pa.int64()),
                    pa.array([e[-1] for e in ends], pa.int32()), pa.array([len(r) for r in part], pa.int32()),
                    pa.array([[p[0] for p in r] for r in part], pa.list_(pa.int64())),
                    pa.array([[p[1] for p in r] for r in part], pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())), pa.array([e[:-1] for e in ends], pa.list_(pa.int32())),
                    pa.array(lines, pa.binary()),
                ]
                made += len(part)
                yield pa.RecordBatch.from_arrays(columns, names=[
                    "shard", "row", "n_tokens", "n_segments", "doc_ids", "doc_starts", "cu_seqlens",
                    "position_resets", "input_ids"])

        for batch in chunks(batches, text, CHUNK_BYTES):
            for doc_id, words in zip(batch.column("doc_id").to_pylist(), batch.column(text).to_pylist()):
                ids = np.array(library.encode_ordinary(words or ""), "<u4")
                for at in range(0, len(ids), row_tokens):
                    pieces.append((doc_id, at, ids[at:at + row_tokens]))
                held += len(ids)
                if held >= lot_tokens:
                    yield from pack()
                    pieces, held = [], 0
        yield from pack()

    return docs.select("doc_id", text).mapInArrow(run, SCHEMA)


def position_ids(row_cu_seqlens: list[int], row_tokens: int) -> np.ndarray:
    """Positions along a packed row: from 0 in every segment, 0 in the unused end."""
    positions = np.zeros(row_tokens, np.int64)
    for a, b in zip(row_cu_seqlens, row_cu_seqlens[1:]):
        positions[a:b] = np.arange(b - a)
    return positions


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the packed rows as a Parquet table, one file per shard, in row order."""
    packed.write.parquet(path)

