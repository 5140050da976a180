"""A double-array trie of vocabulary pieces in NumPy, walked for all positions of many words at once.

The trie is made on the driver from a bounded list of pieces, written as one uncompressed Arrow file into the shared
folder and handed out with ``SparkContext.addFile``: an executor fetches it once and all its Python workers map the same
file, so a worker holds no copy of the vocabulary.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from sorigil.session import scratch_path

_CODE_POINTS = 0x110000
_WINDOW = 1024  # places looked at in one step when room for a node's children is sought


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts together and the texts' lengths."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return flat, np.fromiter(map(len, texts), np.int64, len(texts))


@dataclass
class Trie:
    """State s has the child ``base[s] + code`` for a character's code where ``check`` there is s. ``piece`` is the piece's number
    that ends in a state, or -1. ``code`` is 0 for characters outside the alphabet."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    alphabet: np.ndarray

    def __post_init__(self) -> None:
        self.code = np.zeros(_CODE_POINTS, np.int32)
        self.code[self.alphabet] = np.arange(1, len(self.alphabet) + 1)

    def matches(self, flat: np.ndarray, left: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, piece number) of every piece that begins at a place of ``flat``, where ``left`` is how many characters
        the place's word still has; sorted by place, then length."""
        codes = self.code[flat]
        at, state = np.arange(len(flat)), np.zeros(len(flat), np.int32)
        found = []
        for depth in range(max_len):
            if depth:
                inside = left[at] > depth
                at, state = at[inside], state[inside]
            if not len(at):
                break
            c = codes[at + depth]
            child = self.base[state] + c
            ok = (c > 0) & (self.check[child] == state)
            at, state = at[ok], child[ok]
            piece = self.piece[state]
            hit = np.flatnonzero(piece >= 0)
            found.append((at[hit], np.full(len(hit), depth + 1, np.int64), piece[hit].astype(np.int64)))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        place, size, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(place, kind="stable")  # lengths already ascend
        return place[order], size[order], piece[order]

    def lattice(self, words: list[str], max_len: int, unknown: bool = True) -> tuple[np.ndarray, ...]:
        """Flat edges (word number, begin, end, piece number) of all words, by word and begin. With ``unknown``, a place
        whose character is no piece has an edge of length one with piece number -1, so no place is without edges."""
        flat, lengths = code_points(words)
        word = np.repeat(np.arange(len(words)), lengths)
        begin = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place, size, piece = self.matches(flat, lengths[word] - begin, max_len)
        if unknown:
            single = np.zeros(len(flat), bool)
            single[place[size == 1]] = True
            rest = np.flatnonzero(~single)
            if len(rest):
                place, size, piece = np.r_[place, rest], np.r_[size, np.ones(len(rest), np.int64)], np.r_[piece, np.full(len(rest), -1)]
                order = np.lexsort((size, place))
                place, size, piece = place[order], size[order], piece[order]
        return word[place], begin[place], begin[place] + size, piece


def build(pieces: list[str]) -> Trie:
    """The trie of distinct, non-empty pieces; piece k has number k."""
    flat, lengths = code_points(pieces)
    if (lengths == 0).any():
        raise ValueError("an empty piece")
    alphabet = np.unique(flat)
    depth = int(lengths.max()) if len(lengths) else 0
    table = np.zeros((len(pieces), depth), np.int32)
    inside = np.arange(depth)[None, :] < lengths[:, None]
    table[inside] = np.searchsorted(alphabet, flat) + 1
    order = np.lexsort(table.T[::-1]) if depth else np.zeros(0, np.int64)
    table, number = table[order], lengths[order]
    # nodes of one depth are the distinct prefixes of that length; in sorted rows they and their children are runs
    parent_of, code_of, ends = [np.zeros(1, np.int64)], [np.zeros(1, np.int32)], {}
    node, rows, total = np.zeros(len(pieces), np.int64), np.arange(len(pieces)), 1
    for d in range(depth):
        rows = rows[number[rows] > d]
        c, up = table[rows, d], node[rows]
        new = np.r_[True, (c[1:] != c[:-1]) | (up[1:] != up[:-1])]
        node[rows] = total + np.cumsum(new) - 1
        parent_of.append(up[new])
        code_of.append(c[new])
        total += int(new.sum())
        last = rows[number[rows] == d + 1]
        ends.update(zip(node[last].tolist(), order[last].tolist()))
    parent, code = np.concatenate(parent_of), np.concatenate(code_of)
    if len(ends) != len(pieces):
        raise ValueError("a piece is listed twice")
    return _placed(parent, code, ends, alphabet)


def _placed(parent: np.ndarray, code: np.ndarray, ends: dict[int, int], alphabet: np.ndarray) -> Trie:
    """Nodes (0 is the root) in a double array: nodes with several children are fitted first, single children fill what is free."""
    n, width = len(parent), len(alphabet) + 1
    base_of, slot = np.zeros(n, np.int64), np.zeros(n, np.int64)
    children = np.bincount(parent[1:], minlength=n)
    by_parent = np.argsort(parent[1:], kind="stable") + 1
    first = np.r_[0, np.cumsum(children)]
    room = max(2 * n + 4 * width, 2 * _WINDOW)
    free = np.ones(room, bool)
    free[:width] = False  # slots of the root and below no base
    low = 0
    for p in sorted(np.flatnonzero(children > 1).tolist(), key=lambda p: -children[p]):
        mine = by_parent[first[p] : first[p + 1]]
        c = code[mine]
        at = low
        while True:
            if at + _WINDOW + width > len(free):
                free = np.r_[free, np.ones(len(free), bool)]
            fits = free[at + c[0] : at + c[0] + _WINDOW].copy()
            for x in c[1:].tolist():
                fits &= free[at + x : at + x + _WINDOW]
            k = int(fits.argmax())
            if fits[k]:
                break
            at += _WINDOW
        low = max(low, at)
        base_of[p] = at + k
        slot[mine] = at + k + c
        free[slot[mine]] = False
    single = np.flatnonzero(children == 1)
    if np.count_nonzero(free) < len(single):
        free = np.r_[free, np.ones(len(single), bool)]
    mine = by_parent[first[single]]
    slot[mine] = np.flatnonzero(free)[: len(single)]
    base_of[single] = slot[mine] - code[mine]
    size = int(max(slot.max(), base_of.max()) if n else 0) + width + 1
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    base[slot] = base_of
    check[slot[1:]] = slot[parent[1:]]
    where = np.fromiter(ends.keys(), np.int64, len(ends))
    piece[slot[where]] = np.fromiter(ends.values(), np.int64, len(ends))
    return Trie(base, check, piece, alphabet)


@dataclass(frozen=True)
class Shared:
    """A trie with its pieces and their ids in a file that every executor has; ``size`` pieces."""

    name: str
    size: int


def share(spark: SparkSession, pieces: list[str], ids: list[int] | None = None) -> Shared:
    """Write the trie of ``pieces`` to the shared folder and hand it out. The columns are rows of lists of one Arrow file."""
    trie = build(pieces)
    columns = {"base": trie.base, "check": trie.check, "piece": trie.piece, "alphabet": trie.alphabet.astype(np.int32), "ids": np.asarray(ids if ids is not None else range(len(pieces)), np.int32)}
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for v in columns.values()]
    words = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pa.array(pieces, pa.string()))
    batch = pa.RecordBatch.from_arrays([*lists, words], [*columns, "words"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, batch.schema) as writer:
        writer.write_batch(batch)
    name = f"trie-{uuid.uuid4().hex}.arrow"
    path = scratch_path(spark, name)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    try:
        out.write(bytearray(sink.getvalue().to_pybytes()))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return Shared(name, len(pieces))


_OPEN: dict[str, tuple[Trie, np.ndarray, pa.Array]] = {}


def opened(shared: Shared) -> tuple[Trie, np.ndarray, pa.Array]:
    """In a task: the trie, the pieces' ids and the pieces, from the mapped file (opened once per worker)."""
    if shared.name not in _OPEN:
        _OPEN.clear()
        batch = pa.ipc.open_file(pa.memory_map(SparkFiles.get(shared.name))).get_batch(0)
        column = lambda c: batch.column(c).values.to_numpy()
        _OPEN[shared.name] = (Trie(column("base"), column("check"), column("piece"), column("alphabet")), column("ids"), batch.column("words").values)
    return _OPEN[shared.name]
