"""Sum-of-squares online packing of tokenised documents into sequences.

A document's ids are those of a byte-level BPE, then the end id 0. Whole windows of 1024 ids are cut off its front; the
rest is placed by the sum-of-squares rule: of all fill levels at which it fits, and a new window, it goes where the sum
over levels of (number of windows filled so far)**2 grows least. A level array holds those numbers.

Every task packs its own rows as they come, so nothing is shuffled and a key's share of the rows does not matter. Under
this rule the number of open windows grows as the root of the number of documents (measured: 661 after 4,000, 1,324
after 16,000), so a task holds a few thousand windows of 4 KB whatever its partition. What is open at a task's end is
closed as sequences of powers of two, which need no padding: a window of 700 ids as 512, 128, 32, 16, 8 and 4. A retried
task makes the same sequences.

Defined results: a null text is the empty text, whose ids are the end id alone. Repeated rows are packed as often as
they occur. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import give_back, table

WINDOW = 1024
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class Packer:
    """Places pieces (doc, start, ids, doc_tokens); done holds the rows of closed sequences."""

    def __init__(self, window: int = WINDOW, first: int = 0):
        import numpy as np

        self.np, self.window, self.next = np, window, first
        self.levels = np.zeros(window + 1, np.int64)  # windows at each fill; none is kept at 0 or window
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.done: list[tuple] = []

    def close(self, pieces: list) -> None:
        at, self.next = 0, self.next + 1
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, len(ids), ids.tobytes(), total, self.next - 1, at))
            at += len(ids)

    def add(self, doc, ids) -> None:
        total, w = len(ids), self.window
        whole = total - total % w
        for a in range(0, whole, w):
            self.close([(doc, a, ids[a : a + w], total)])
        if whole < total:
            self.place((doc, whole, ids[whole:], total), total - whole)

    def level_for(self, size: int) -> int:
        """The fill level whose use adds least to the sum of squares; 0 is a new window. Fuller windows win ties."""
        np, n, w = self.np, self.levels, self.window
        open_at = np.flatnonzero(n[1 : w - size + 1]) + 1
        gain = 2 * (n[open_at + size] - n[open_at]) + 2
        if len(open_at) and open_at[-1] + size == w:
            gain[-1] = 1 - 2 * n[open_at[-1]]  # a full window leaves the sum
        best, level = 2 * int(n[size]) + 1, 0
        if len(gain) and (least := int(gain.min())) <= best:
            level = int(open_at[np.flatnonzero(gain == least)[-1]])
        return level

    def place(self, piece: tuple, size: int) -> None:
        level = self.level_for(size)
        pieces = []
        if level:
            self.levels[level] -= 1
            pieces = self.open[level].pop()
        pieces.append(piece)
        fill = level + size
        if fill == self.window:
            self.close(pieces)
            return
        self.levels[fill] += 1
        self.open[fill].append(pieces)

    def finish(self) -> None:
        """Closes what is open as sequences of powers of two, larger ones first."""
        for fill in range(self.window - 1, 0, -1):
            for pieces in self.open[fill]:
                rest, left = pieces[::-1], fill
                while left:
                    need = 1 << (left.bit_length() - 1)
                    now, left = [], left - need
                    while need:
                        doc, start, ids, total = rest.pop()
                        now.append((doc, start, ids[:need], total))
                        if len(ids) > need:
                            rest.append((doc, start + need, ids[need:], total))
                        need -= len(now[-1][2])
                    self.close(now)
            self.open[fill] = []
        self.levels[:] = 0


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """docs(doc_id, text) -> a row for each piece, with its ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from skyloom.llm.pretoken import ByteBpe, parcels

        give_back()
        bpe, packer = ByteBpe(path), Packer(window, TaskContext.get().partitionId() << 32)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]

        def rows():
            done, packer.done = packer.done, []
            columns = list(zip(*done, strict=True)) if done else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            docs_, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for part in parcels(texts):
                ids, bounds = bpe.encode(texts[part])
                for i, doc in enumerate(docs_[part]):
                    packer.add(doc, np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)).astype("<u4"))
                yield rows()
        packer.finish()
        yield rows()
        del bpe, packer
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def digested(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_packing(spark, sf_dir):
    return digested(pack(table(spark, sf_dir, "documents")))
