"""Near duplicates by SuperMinHash signatures, banding, exact verification and union-find.

Signature (Ertl's SuperMinHash): every element of a document's shingle set draws its own permutation of the
registers, and its j-th draw offers ``j + u`` to the register the permutation names. A register keeps the least
offer. Because one element never offers two values of the same rank to one register, the registers are negatively
correlated and estimate the Jaccard similarity with less variance than independent hashes. A document stops as
soon as every register holds an offer below the next rank, which long documents reach in the first round.

Grouping:

1. one scan turns every text into a narrow row: set size, 128-bit digest of the set, band keys;
2. equal sets become one representative (their least id), so copies cost one row from here on;
3. representatives that share a band key are candidates. First every member of a bucket is compared with one hub,
   the bucket's least member: one pair a member, and groups of near copies come together across their
   32 bands of hubs;
4. what is left open are members outside the largest component of their bucket. They are compared with every
   member of the bucket that is in another component, in blocks of bounded volume within tasks (a third
   of the documents in one bucket is many blocks); only links that join components leave a task. After that every
   candidate pair is compared or lies within one component;
5. a pair is a link when the full sets meet the threshold;
6. components by union-find over the links: small batches first contract their own links, then
   large-star and small-star rounds join the rest with partial aggregation, all in written tables.

``BANDS`` of ``ROWS`` registers miss a pair at similarity 0.8 with probability (1 - 0.8**5)**32 = 3e-6, less above.

Results: a document without words has an empty set, is linked with nothing and is its own component. Rows that
repeat a doc_id are one document with the links of all of them. A null doc_id cannot be named: the row has a null
component and is kept. Shingles are compared by 64-bit hashes, sets by their full sorted hashes.
Other columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorigil.llm.common import slices, stored
from sorigil.llm.words import NOT_SPACE, find_words, mix

ROWS, BANDS = 5, 32
REGISTERS = ROWS * BANDS
SHINGLE = 2  # contract: words in a shingle
LEAST_PERCENT = 80  # contract: 100 * intersection >= 80 * union
VOLUME = 200_000  # shingles of one side of a block
ELEMENTS_AT_ONCE = 100_000

_STEP = np.uint64(0xD1342543DE82EF95)
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and the row offsets into them."""
    words = find_words(column, NOT_SPACE)
    hashes, counts = words.hashes(), np.diff(words.at)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))  # fewer words: the whole sequence is one
    at = np.concatenate(([0], np.cumsum(n)))
    row = np.repeat(np.arange(len(n)), n)
    first = words.at[:-1][row] + np.arange(at[-1]) - at[:-1][row]
    width = np.minimum(counts, size)[row]
    value = mix(width.astype(np.uint64))
    for k in range(size):
        use = k < width
        value[use] = mix(value[use] * _STEP + hashes[first[use] + k])
    for a, b in zip(at[:-1], at[1:]):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(n) + 1))


def signatures(values: np.ndarray, at: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash registers (rows x registers, rank in the high half) of the sets ``values[at[r]:at[r + 1]]``."""
    n_rows, k = len(at) - 1, np.uint64(registers)
    out = np.full((n_rows, registers), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    element, owner = values, np.repeat(np.arange(n_rows), np.diff(at))
    places: np.ndarray | None = None  # the part of each element's permutation that is still to come
    for rank in range(registers):
        draw = mix(element + np.uint64((rank + 1) * int(_STEP) % (1 << 64)))
        target = rank + (((draw & _LOW) * (k - np.uint64(rank))) >> _HALF).astype(np.int64)
        if places is None:
            register = target
        else:
            every = np.arange(len(element))
            register = places[every, target].astype(np.int64)
            places[every, target] = places[:, rank]
        np.minimum.at(flat, owner * registers + register, (np.uint64(rank) << _HALF) | (draw >> _HALF))
        open_rows = out.max(axis=1) >= np.uint64(rank + 1) << _HALF
        going = open_rows[owner]
        if not going.any():
            break
        if places is None:
            places = np.tile(np.arange(registers, dtype=np.uint8 if registers <= 256 else np.int32), (int(going.sum()), 1))
            swapped = target[going]
            places[np.arange(len(swapped)), swapped] = 0
        else:
            places = places[going]
        element, owner = element[going], owner[going]
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each row and band."""
    cells = sig.reshape(len(sig), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, cells.shape[:2]).copy()
    for r in range(cells.shape[2]):
        key = mix(key * _STEP + cells[:, :, r])
    return key


def _chunks(counts_at: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(counts_at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(counts_at, counts_at[lo] + ELEMENTS_AT_ONCE, "right")) - 1)
        yield lo, hi
        lo = hi


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1000, 2 << 20):
            values, at = shingle_sets(part.column(1))
            keys = np.empty((part.num_rows, BANDS), np.uint64)
            for lo, hi in _chunks(at):
                keys[lo:hi] = band_keys(signatures(values[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]))
            size = np.diff(at)
            digest = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * BANDS, pa.int32()), pa.array(keys.view(np.int64).reshape(-1)))],
                names=["id", "n_shingles", "digest", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1000, 2 << 20):
            values, at = shingle_sets(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))], names=["id", "shingles"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find within a batch: the links of a batch become links to each group's least node."""
    for batch in batches:
        parent: dict[int, int] = {}

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top_of(parent, a), top_of(parent, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(x, top_of(parent, x)) for x in list(parent) if top_of(parent, x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b): root is the least node of its component.

    Large-star and small-star rounds (Kiveris et al.): a node's neighbours above it are linked to its least
    neighbour, then those below; the links become stars after a number of rounds that grows with the logarithm of
    the nodes. Least neighbours are partial aggregates, so a hub's neighbours are never gathered in one place."""
    links = stored(links.select("a", "b").mapInArrow(_contract, "a long, b long").distinct(), "links")
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))  # every link of ``large`` goes down
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        new = stored(small.where("a <> b").distinct(), "links")
        lows = new.select(F.col("b").alias("a")).distinct()
        if new.groupBy("a").count().where("count > 1").isEmpty() and new.join(lows, "a", "left_semi").isEmpty():
            return new.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(lows.select(F.col("a").alias("node"), F.col("a").alias("root")))
        links = new


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(two, "b").join(one, "a").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("common") >= LEAST_PERCENT * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def candidates(features: DataFrame) -> DataFrame:
    """(key, id, n): the representatives of every band key that two or more of them share."""
    named = features.where("id is not null and digest is not null")
    reps = named.groupBy("digest").agg(F.min("id").alias("id"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"))
    keyed = reps.select(F.explode("bands").alias("key"), "id", "n").repartition("key")
    # reads every column of ``keyed``, so that both sides below share one exchange
    shared = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("n").alias("n")).where("lo <> hi").select("key")
    return stored(keyed.join(shared, "key", "left_semi"), "buckets")


def links_of(docs: DataFrame, features: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, root) of all representatives that are linked with another."""
    buckets = candidates(features)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).join(buckets.select("id").distinct(), "id", "left_semi")
    sets = stored(texts.mapInArrow(_sets, "id long, shingles array<long>").where("size(shingles) > 0"), "sets")
    hubs = buckets.groupBy("key").agg(F.min(F.struct("id", "n")).alias("hub")).select("key", F.col("hub.id").alias("a"), F.col("hub.n").alias("na"))
    pairs = buckets.join(hubs, "key").where("id > a").where(100 * F.least("na", "n") >= LEAST_PERCENT * F.greatest("na", "n"))
    links = same_document(features).unionAll(stored(verified(pairs.select("a", F.col("id").alias("b")).distinct(), sets), "links"))
    labels = components(links)
    rest = open_links(buckets, labels, sets)
    return labels if rest.isEmpty() else components(links.unionAll(rest))


def open_links(buckets: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of one bucket that are not in one component yet."""
    rooted = buckets.join(labels, F.col("id") == F.col("node"), "left").select("key", "id", "n", F.coalesce("root", "id").alias("root"))
    per_root = rooted.groupBy("key", "root").agg(F.count("*").alias("m"), F.sum("n").alias("volume"))
    mixed = per_root.groupBy("key").agg(F.count("*").alias("roots"), F.max(F.struct("m", "volume", "root")).alias("top"), F.sum("volume").alias("volume")).where("roots > 1")
    shape = mixed.select(
        "key", F.col("top.root").alias("major"),
        F.ceil((F.col("volume") - F.col("top.volume")) / VOLUME).cast("int").alias("asking"), F.ceil(F.col("volume") / VOLUME).cast("int").alias("asked"),
    )
    open_ = stored(rooted.join(shape, "key"), "open")
    ask = open_.where("root <> major").select("key", F.pmod(F.xxhash64("id"), "asking").alias("a"), F.explode(F.sequence(F.lit(0), F.col("asked") - 1)).alias("b"), F.lit(True).alias("asks"), "id", "root")
    every = open_.select("key", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("a"), F.pmod(F.xxhash64("root", "id"), "asked").alias("b"), F.lit(False).alias("asks"), "id", "root")
    blocks = ask.select("key", F.col("a").cast("long"), F.col("b").cast("long"), "asks", "id", "root").unionAll(every.select("key", F.col("a").cast("long"), F.col("b").cast("long"), "asks", "id", "root"))
    return stored(blocks.join(sets, "id").select("key", "a", "b", "asks", "id", "root", "shingles").groupBy("key", "a", "b").applyInArrow(_compare, "a long, b long"), "links")


def common_counts(asking: pa.ListArray, asked: pa.ListArray, at_once: int = 2_000_000) -> Iterator[tuple[int, np.ndarray]]:
    """For stretches of ``asked`` sets: the first one's number and how many shingles each has in common with each asking set."""
    values, sizes = asking.flatten().to_numpy(), asking.value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    others, size = asked.flatten().to_numpy(), asked.value_lengths().to_numpy()
    lo, hi = np.searchsorted(values, others, "left"), np.searchsorted(values, others, "right")
    ends = np.cumsum(size)
    work = np.r_[0, np.cumsum(hi - lo)][np.r_[0, ends]]
    first = 0
    while first < len(size):
        last = max(first + 1, int(np.searchsorted(work, work[first] + at_once, "right")) - 1)
        a, b = ends[first] - size[first], ends[last - 1]
        n = (hi - lo)[a:b]
        hit = owner[np.repeat(lo[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        row = np.repeat(np.repeat(np.arange(last - first), size[first:last]), n)
        yield first, np.bincount(row * len(sizes) + hit, minlength=(last - first) * len(sizes)).reshape(last - first, len(sizes))
        first = last


def _compare(block: pa.Table) -> pa.Table:
    """Links of a block that join two components: the asking sets against the others."""
    block = block.combine_chunks()
    asks = block["asks"].to_numpy()
    one, two = block.filter(pa.array(asks)), block.filter(pa.array(~asks))
    links: list[tuple[int, int]] = []
    if one.num_rows and two.num_rows:
        sets = [t["shingles"].combine_chunks() for t in (one, two)]
        sets = [s.chunk(0) if isinstance(s, pa.ChunkedArray) else s for s in sets]
        size = [s.value_lengths().to_numpy() for s in sets]
        ids, roots = ([t[c].to_pylist() for t in (one, two)] for c in ("id", "root"))
        parent: dict[int, int] = {}
        for first, common in common_counts(*sets):
            together = size[1][first : first + len(common), None] + size[0][None, :] - common
            for j, i in zip(*np.nonzero(100 * common >= LEAST_PERCENT * together)):
                x, y = top_of(parent, roots[0][i]), top_of(parent, roots[1][first + j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((ids[0][i], ids[1][first + j]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def top_of(parent: dict[int, int], x: int) -> int:
    """The least node of x's group, shortening the way there."""
    top = x
    while parent.setdefault(top, top) != top:
        top = parent[top]
    while parent[x] != top:
        parent[x], x = top, parent[x]
    return top


def same_document(features: DataFrame) -> DataFrame:
    """Links between the representatives of the texts of a doc_id that comes with several texts."""
    named = features.where("id is not null and digest is not null")
    several = named.groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("id")
    lead = named.groupBy("digest").agg(F.min("id").alias("rep"))
    reps = named.join(several, "id", "left_semi").join(lead, "digest").select("id", "rep").distinct()
    return reps.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_col)
    features = stored(source.mapInArrow(_features, "id long, n_shingles long, digest binary, bands array<long>"), "signatures")
    found = links_of(docs, features, id_col, text_col)
    named = features.where("id is not null and digest is not null")
    lead = named.groupBy("digest").agg(F.min("id").alias("rep"))
    group = features.select("id", "n_shingles", "digest").join(lead, "digest", "left").join(found, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "rep", "id"))
    return group.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that lead their group, one row for each doc_id; rows without an id stay. Rows that repeat an
    id are one document (all their texts link it): of those that lead, the one with the least text stays, texts without
    words behind all others, since they are linked with nothing."""
    kept = near_duplicates(docs, id_col, text_col).where("kept and n_shingles > 0").select(id_col).where(F.col(id_col).isNotNull()).distinct()
    worded = F.coalesce(F.col(text_col).rlike("[^ \\t-\\r]"), F.lit(False))
    led = docs.where(worded).join(kept, id_col, "left_semi").select(*docs.columns).unionAll(docs.where(~worded & F.col(id_col).isNotNull()))
    one = led.groupBy(F.col(id_col).alias("_id")).agg(F.min_by(F.struct(*docs.columns), F.struct(~worded, text_col)).alias("_row")).select("_row.*")
    return one.unionAll(docs.where(F.col(id_col).isNull()))
