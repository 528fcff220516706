"""Operator 5: packing token sequences by Karmarkar-Karp multiway differencing.

Each document becomes ids plus an end id.  Whole windows are cut off its
front and are sequences as they are; what remains is cut into pieces of at
most ``max_piece`` ids.  The pieces of a block (``block_windows`` windows'
worth, gathered while a task reads its documents) are dealt to windows by
multiway differencing: every piece starts as a partial partition with one
filled slot; the two partitions with the widest imbalance are merged, fullest
slots against emptiest, until one is left.  If a slot exceeds the window, the
count of windows rises by one and the block is dealt anew.

Nothing is shuffled: a task holds one block, and the windows that a task
leaves underfull are at most one block's.  Sequence ids hold the task's
partition number, so they are the same when a task runs again.

Null and empty texts are one end id.  Repeated rows are packed as often as
they come.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import prepare, text_batches
from crawlweave.llm.hf_ids import id_encoder

WINDOW = 2048
#: Longest piece of what remains of a document beside its whole windows.
MAX_PIECE = 512
#: Windows dealt together.
BLOCK_WINDOWS = 128

_OUT = ("{id} {type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
        "sequence_tokens long, padded_tokens long")


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Deal items to ``k`` slots; the items of each slot."""
    if k == 1:
        return [list(range(len(sizes)))]
    left, right = [-1] * len(sizes), [-1] * len(sizes)  # nodes: items first, then joined slots
    heap = []
    for i, size in enumerate(sizes):
        # sums (descending, smallest taken off) and nodes of the filled slots; the others are empty
        heap.append((-size, i, [size], [i]))
    heapify(heap)
    ties = len(sizes)
    while len(heap) > 1:
        _, _, a_sums, a_nodes = heappop(heap)
        _, _, b_sums, b_nodes = heappop(heap)
        spare = k - len(a_sums) - len(b_sums)
        if spare >= 0:  # the filled slots of one meet empty slots of the other
            sums, nodes = a_sums + b_sums, a_nodes + b_nodes
        else:
            b_first = len(b_sums) + spare  # so many of b's slots find an empty one of a
            sums = a_sums + b_sums[:b_first]
            nodes = a_nodes + b_nodes[:b_first]
            at = len(a_sums) - 1
            for s, node in zip(b_sums[b_first:], b_nodes[b_first:], strict=True):
                sums[at] += s
                left.append(nodes[at])
                right.append(node)
                nodes[at] = len(left) - 1
                at -= 1
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, nodes = [sums[i] for i in order], [nodes[i] for i in order]
        least = sums[-1] if len(sums) == k else 0
        if least:
            sums = [s - least for s in sums]
        ties += 1
        heappush(heap, (least - least - sums[0], ties, sums, nodes))
    slots = []
    for root in heap[0][3]:
        items, stack = [], [root]
        while stack:
            node = stack.pop()
            if node < len(sizes):
                items.append(node)
            else:
                stack += [left[node], right[node]]
        slots.append(sorted(items))
    return slots + [[] for _ in range(k - len(slots))]


def deal(sizes: list[int], window: int) -> list[list[int]]:
    """Windows of items, none above ``window``: the count rises while a slot exceeds it."""
    k = max(1, -(-sum(sizes) // window))
    while True:
        slots = difference(sizes, k)
        if max(sum(sizes[i] for i in slot) for slot in slots) <= window:
            return [s for s in slots if s]
        k += 1


def padded(tokens: int, window: int = WINDOW) -> int:
    """Length a sequence is stored at: its own at a power of two, else the window."""
    return tokens if tokens & (tokens - 1) == 0 else window


def pack(df: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 1, max_piece: int = MAX_PIECE,
         block_windows: int = BLOCK_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with its ids (binary, little-endian 32-bit) and its place.

    ``start`` is the piece's place in its document, ``offset`` its place in
    its sequence, ``sequence_tokens`` and ``padded_tokens`` the sequence's
    length before and after padding.
    """
    prepare(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = _OUT.format(id=f"`{id_col}`", type=rows.schema["id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = id_encoder(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 40
        pieces: list[tuple] = []  # document, start, ids, ids of the document
        held = 0
        out: list[tuple] = []

        def sequence_of(members: list[tuple]) -> None:
            nonlocal sequence
            tokens, offset = sum(len(m[2]) // 4 for m in members), 0
            for doc, start, ids, doc_tokens in members:
                out.append((doc, start, len(ids) // 4, ids, doc_tokens, sequence, offset, tokens,
                            padded(tokens, window)))
                offset += len(ids) // 4
            sequence += 1

        def close() -> None:
            nonlocal pieces, held
            for slot in deal([len(p[2]) // 4 for p in pieces], window) if pieces else []:
                sequence_of([pieces[i] for i in slot])
            pieces, held = [], 0

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 9
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                               names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id",
                                                      "offset", "sequence_tokens", "padded_tokens"])
            out.clear()
            return batch

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field("id").type
            for part, texts in text_batches(batch, "text"):
                for doc, ids in zip(part.column("id").to_pylist(), encoder.encode(texts), strict=True):
                    ids += end
                    total = len(ids) // 4
                    whole = total // window * window
                    for start in range(0, whole, window):
                        sequence_of([(doc, start, ids[start * 4:(start + window) * 4], total)])
                    for start in range(whole, total, max_piece):
                        piece = ids[start * 4:min(start + max_piece, total) * 4]
                        pieces.append((doc, start, piece, total))
                        held += len(piece) // 4
                        if held >= block_windows * window:
                            close()
                    if len(out) >= 4096:
                        yield flush(kind)
        close()
        if out:
            yield flush(kind)

    return rows.mapInArrow(run, schema)

