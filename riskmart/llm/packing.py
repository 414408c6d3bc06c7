"""Pack tokenized documents into sequences, balancing attention cost.

A piece of ``n`` tokens costs ``LINEAR * n + QUADRATIC * n * n`` (attention stays within a document).
Pieces are taken in descending order and each goes to the sequence with the lowest cost so far among
those with room for it; where none has room, the piece is cut to fill the cheapest one and the rest
goes back into the queue. As documents may be cut freely, every sequence fills up except the last one
of a task.

No shuffle: each task tokenizes its own rows and packs them in buffers of ``BUFFER_SEQUENCES``
sequences, carrying what does not fill a sequence into the next buffer. Memory is one buffer plus one
Arrow batch. A document longer than a sequence is cut into full sequences first. Sequence ids hold
the task's partition number in their upper bits; a task that is run again yields the same rows.

Defined cases: a null text is empty, and an empty document is its end token alone; a null id stays null;
repeated rows are packed as often as they occur; other columns are not returned; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import tidy

SEQUENCE = 2048
END_ID = 1
LINEAR = 1.0
QUADRATIC = 1.0 / 1024  # at 1,024 tokens attention costs as much as the rest of a layer
BUFFER_SEQUENCES = 512
VOCABULARY = "word_bpe_49k.json"


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def assign(lengths: list[int], capacity: int, sequences: int) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Place pieces into ``sequences`` empty sequences.

    Returns placed (piece, start in piece, length, sequence, offset) and what found no room (piece, start, length).
    """
    queue = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(queue)
    costs, room = np.zeros(sequences), np.full(sequences, capacity)
    placed = []
    left = capacity * sequences
    while queue and left:
        n, piece, start = heapq.heappop(queue)
        n = -n
        at = int(np.argmin(np.where(room >= n, costs, np.inf)))
        if room[at] < n:
            at = int(np.argmin(np.where(room > 0, costs, np.inf)))
            taken = int(room[at])
            heapq.heappush(queue, (taken - n, piece, start + taken))
            n = taken
        placed.append((piece, start, n, at, capacity - int(room[at])))
        costs[at] += cost(n)
        room[at] -= n
        left -= n
    return placed, [(piece, start, -n) for n, piece, start in queue]


def pack_stream(documents: Iterable[tuple[object, bytes]], first_sequence: int, capacity: int, buffer_sequences: int) -> Iterator[list[tuple]]:
    """Lists of (id, start, ids, doc_tokens, sequence_id, offset) for (id, ids as bytes) in turn."""
    sequence = first_sequence
    pieces: list[tuple] = []  # id, start, ids, tokens of the document
    held = 0

    def flush(last: bool) -> list[tuple]:
        nonlocal sequence, pieces, held
        count = -(-held // capacity) if last else held // capacity
        placed, rest = assign([len(p[2]) // 4 for p in pieces], capacity, count)
        rows = []
        for piece, start, n, at, offset in placed:
            doc_id, first, ids, total = pieces[piece]
            rows.append((doc_id, first + start, ids[4 * start:4 * (start + n)], total, sequence + at, offset))
        sequence += count
        pieces = [(pieces[p][0], pieces[p][1] + s, pieces[p][2][4 * s:4 * (s + n)], pieces[p][3]) for p, s, n in rest]
        held = sum(n for _, _, n in rest)
        return rows

    for doc_id, ids in documents:
        total = len(ids) // 4
        full = total // capacity * capacity
        rows = []
        for start in range(0, full, capacity):
            rows.append((doc_id, start, ids[4 * start:4 * (start + capacity)], total, sequence, 0))
            sequence += 1
        if rows:
            yield rows
        if total > full:
            pieces.append((doc_id, full, ids[4 * full:], total))
            held += total - full
        if held >= buffer_sequences * capacity:
            yield flush(False)
    if pieces:
        yield flush(True)


def _packer(path: str | None, end_id: int, capacity: int, buffer_sequences: int, id_type: pa.DataType) -> Callable:
    schema = pa.schema([
        ("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ])

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from riskmart.llm.common import only
        from riskmart.llm.word_tokens import word_tokens

        only("packing")
        tokens = word_tokens(path or vocabulary_path())
        end = end_id.to_bytes(4, "little")

        def documents():
            for batch in batches:
                tokens.trim()
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield doc_id, tokens.ids(text.as_py() or b"") + end

        waiting: list[tuple] = []
        for rows in pack_stream(documents(), TaskContext.get().partitionId() << 33, capacity, buffer_sequences):
            waiting += rows
            if len(waiting) >= 500:
                yield _batch(waiting, schema)
                waiting = []
        if waiting:
            yield _batch(waiting, schema)

    return pack_task


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    doc_id, start, ids, total, sequence, offset = zip(*rows)
    columns = [doc_id, start, [len(x) // 4 for x in ids], ids, total, sequence, offset]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where this machine keeps the public vocabulary; looked up in each task."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = SEQUENCE,
    end_id: int = END_ID,
    buffer_sequences: int = BUFFER_SEQUENCES,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(tidy(_packer(path, end_id, capacity, buffer_sequences, to_arrow_type(id_type))), schema)


def op8_pack_sequences(spark, sf_dir: str) -> DataFrame:
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
