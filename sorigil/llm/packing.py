"""Packing of documents into token windows by best-fit decreasing.

A document becomes the ids of its text and an end id. Documents longer than a window are cut into full
windows first; what is left of each is placed, longest first, into the open window with the least remaining
capacity that still holds it. The open windows are kept by remaining capacity in the leaves of a segment tree, so the
tightest one is found by one way up and one down.

One scan tokenises every text and already cuts it, so only narrow rows (document, start, length, checksum) are
written and exchanged, never ids. The pieces are dealt evenly over groups of about ``GROUP`` pieces, as many groups
as the table needs, and each is packed by itself: with that many pieces to choose from a group wastes well under
one percent, and no group grows with the table or with a key.

Results: a null or empty text has the end id alone. Rows that repeat a doc_id, or have none, are documents of
their own. Other columns are not read. An empty table gives an empty result. The strings of special tokens in a text
are ordinary text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.llm.common import slices, stored

WINDOW = 2048  # contract: ids in a sequence
END = 1  # contract: the id behind every document
TOKENIZER = "byte_bpe_50k.json"
GROUP = 100_000


class Encoder:
    """Ids of texts for a byte-level BPE file of the tokenizers library.

    Where the file's merges are in the order of its ids, the same vocabulary runs in tiktoken, which gives the
    same ids several times faster; the tokenizers library itself is the way for any other file, and for
    texts tiktoken gives up on. Both are compared on a probe when a worker starts."""

    PROBE = "It's 12 o'clock\n\n  and\tall was well, naïve façade ß中文 \U0001f600!!  end "

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        path = name
        if "/" not in name:
            import public_tokenizers

            path = public_tokenizers.path(name)
        self.slow = Tokenizer.from_file(str(path))
        self.slow.encode_special_tokens = True
        self.fast = self._fast(str(path))
        if self.fast is not None and self.fast.encode_ordinary(self.PROBE) != self._slow_ids(self.PROBE):
            self.fast = None

    @staticmethod
    def _fast(path: str):
        import public_tokenizers
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        if spec["model"].get("type", "BPE") != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            return None
        special = {t["content"] for t in spec.get("added_tokens", [])}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _slow_ids(self, text: str) -> list[int]:
        return self.slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except (ValueError, RuntimeError):
                pass
        return np.array(self._slow_ids(text), np.uint32)


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """The encoder of this worker, made once."""
    return Encoder(name)


PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def _cut(name: str, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = encoder(name).ids
    for batch in batches:
        for part in slices(batch, 2000, 8 << 20):
            row, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(part.column(1).to_pylist()):
                ids = np.append(encode(text or ""), END).astype("<u4")
                for at in range(0, len(ids), window):
                    piece = ids[at : at + window]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                names=[batch.schema.names[0], "start", "length", "ids_crc32", "doc_tokens"],
            )


class OpenWindows:
    """Open windows by remaining capacity: leaf c of a segment tree counts those with c ids to spare."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, number: int) -> None:
        self.stacks[capacity].append(number)
        i = self.leaves + capacity
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, number) of the tightest window that holds ``size``, taken out of the tree."""
        count, i = self.count, self.leaves + size
        while not count[i]:
            while i & 1:  # a right child has nothing to its right below its parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, self.stacks[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset for each length (1 to ``window``), longest first, ties in the given order."""
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int(np.count_nonzero(lengths == window))
    number[order[:full]], offset[order[:full]] = np.arange(full), 0
    opened, tree = full, OpenWindows(window)
    for i, size in zip(order[full:].tolist(), lengths[order[full:]].tolist()):
        found = tree.take(size)
        capacity, at = found or (window, opened)
        opened += found is None
        number[i], offset[i] = at, window - capacity
        if capacity > size:
            tree.add(capacity - size, at)
    return number, offset


def _pack(window: int, groups: int, key: tuple, pieces: pa.Table) -> pa.Table:
    """One group's windows; its numbers are spaced by the number of groups, so all are distinct."""
    pieces = pieces.sort_by([(pieces.column_names[1], "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
    number, offset = best_fit_decreasing(pieces["length"].to_numpy(), window)
    numbers = pa.array(number * groups + key[0].as_py(), pa.int64())
    return pieces.drop_columns(["group"]).append_column("sequence_id", numbers).append_column("offset", pa.array(offset, pa.int64()))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, tokenizer: str = TOKENIZER, group: int = GROUP) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    one = docs.schema[id_col]
    cut = T.StructType([one, *T._parse_datatype_string(PIECES)])
    pieces = stored(docs.select(id_col, text_col).mapInArrow(partial(_cut, tokenizer, window), cut), "pieces")
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.select(F.pmod(F.monotonically_increasing_id(), F.lit(groups)).alias("group"), "*")
    packed = T.StructType([*cut, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key, rows):
        return _pack(window, groups, key, rows)

    return dealt.groupBy("group").applyInArrow(run, packed)
