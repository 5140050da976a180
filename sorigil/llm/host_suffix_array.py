"""Main text of web pages with a suffix array per host.

Every page is read into blocks: inside an article, inside a main part, elsewhere, or chrome (menus, headers,
footers, adverts and the like by their element, class, id or role). The pages of a host are taken in order and the
word streams of their blocks concatenated; a suffix array over the stream finds every substring of ``LEAST`` or
more words that two distinct pages have. What such substrings cover is boilerplate, unless it is marked as article:

* a page with an article has the article's blocks as its text, whole, also where another page repeats them;
* else a page with a main part has that part's blocks, else the blocks found elsewhere, and of these a block goes
  when ``COVERED`` or more of its words are covered; blocks with more unique runs than that stay whole. A page that would
  lose every block is a copy of another page and keeps them.

Pages are partitioned by host. Hosts of more than ``HOST_PAGES`` pages or ``STREAM`` words are dealt by page id over as
many shares as they fill. A task reads its pages in order and never holds more than about ``STREAM`` words (twice that
where one id comes again and again); a longer share is worked in stretches, each with a suffix array of its own. What
two stretches of a host have in common is found by two exchanges, dealt by host and hash, after which every share gets
back those of its hashes that another stretch has too. In the first a stretch sends a short hash of each of its distinct
minimizers: of the runs of ``PART`` words in a window of ``LEAST`` words the one with the least hash, about one for four
words. Equal windows have equal minimizers, so in the second it sends the 64-bit hashes of only those distinct windows
whose minimizer another stretch has. So the words found do not depend on how a host is cut. Pages are read into blocks
where they are scanned, so that work is even over the tasks; only the blocks, compressed, cross the network, and all
three steps read that one exchange.

Results: null and empty html give an empty text. A null address is the host "". Rows that repeat an id are
pages of their own, but a page is never evidence against its own copy by id. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sorigil.llm.common import slices, stored
from sorigil.llm.fm_index import suffix_ranks
from sorigil.llm.html_blocks import blocks
from sorigil.llm.words import NOT_SPACE, find_words, mix
from sorigil.session import broadcast_if_bounded

LEAST = 12  # words of a repeated substring
PART = 6  # words of a minimizer
PART_BITS = 24  # bits of a minimizer's hash, besides those that count the host's shares
COVERED = 0.8
STREAM = 1 << 20  # words in one suffix array
HOST_PAGES, HOT_HOSTS = 2000, 100_000  # pages of a share; long hosts whose list is broadcast
LEAST_BUCKETS = 64  # a long host's hashes are dealt over so many parts or more
ARTICLE, MAIN, OTHER, CHROME = range(4)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def repeated(words: np.ndarray, page: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Which words lie in a substring of ``least`` or more words that two distinct pages have; ``page`` numbers
    the page of each word, a page's words are together."""
    covered = np.zeros(len(words), bool)
    if len(words) < 2 * least:
        return covered
    turn = np.r_[0, np.cumsum(page[1:] != page[:-1])]
    place = np.arange(len(words)) + turn  # a separator between pages
    text = np.zeros(place[-1] + 2, np.int64)
    text[place] = np.unique(words, return_inverse=True)[1] + 1
    rank = suffix_ranks(text, least)
    order = np.argsort(rank, kind="stable")
    # neighbours in suffix order that agree on ``least`` words: equal hashes of so many words from here on
    run = np.zeros(len(text), np.uint64)
    inside = np.ones(len(text), bool)
    for k in range(least):
        ahead = np.r_[text[k:], np.zeros(k, np.int64)]
        inside &= ahead > 0
        run = mix(run * np.uint64(0xD1342543DE82EF95) + ahead.astype(np.uint64))
    run, inside = run[order], inside[order]
    new = np.r_[True, (run[1:] != run[:-1]) | ~inside[1:] | ~inside[:-1]]
    first = np.flatnonzero(new)
    page_at = np.zeros(len(text), np.int64)
    page_at[place] = page
    owner = page_at[order]
    several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
    starts = order[several[np.cumsum(new) - 1]]
    change = np.zeros(len(text) + 1, np.int64)
    change[starts] += 1
    np.add.at(change, starts + least, -1)
    return (np.cumsum(change)[:-1] > 0)[place]


def windows(words: np.ndarray, row: np.ndarray, least: int = LEAST, part: int = PART) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where ``least`` words of one row begin, the hashes of these words and their minimizers: the least hash of
    ``part`` words among them."""
    n = max(len(words) - least + 1, 0)
    run = np.zeros(n and len(words) - part + 1, np.uint64)
    for k in range(part):
        run = mix(run * np.uint64(0xD1342543DE82EF95) + words[k : k + len(run)])
    low, span = run, 1
    while n and span <= least - part:
        step = min(span, least - part + 1 - span)
        low, span = np.minimum(low[:-step], low[step:]), span + step
    run = run[:n]
    for k in range(part, least):
        run = mix(run * np.uint64(0xD1342543DE82EF95) + words[k : k + n])
    at = np.flatnonzero(row[:n] == row[least - 1 : least - 1 + n])
    return at, run[at], low[at]


def coded(values: np.ndarray) -> bytes:
    """Sorted numbers in about two bits more than the logarithm of their mean distance each: low bits as they are, the
    high bits as the places of ones (Elias-Fano)."""
    low = max((int(values[-1]) // len(values)).bit_length() - 1, 0)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(len(values))
    high = np.zeros(ones[-1] + 1, np.uint8)
    high[ones] = 1
    lows = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :low]
    return len(values).to_bytes(4, "little") + bytes([low]) + np.packbits(lows).tobytes() + np.packbits(high).tobytes()


def decoded(data: bytes) -> np.ndarray:
    n, low = int.from_bytes(data[:4], "little"), data[4]
    raw, cut = np.frombuffer(data, np.uint8, offset=5), (n * low + 7) // 8
    lows = np.zeros((n, 64), np.uint8)
    lows[:, :low] = np.unpackbits(raw[:cut], count=n * low).reshape(n, low)
    high = (np.flatnonzero(np.unpackbits(raw[cut:])) - np.arange(n)).astype(np.uint64)
    return (high << np.uint64(low)) | np.packbits(lows, axis=1, bitorder="little").view("<u8").ravel()


def covered_by(at: np.ndarray, n: int, least: int = LEAST) -> np.ndarray:
    """Which of ``n`` words lie in one of the windows that begin at ``at``."""
    change = np.zeros(n + 1, np.int64)
    change[at] += 1
    np.add.at(change, at + least, -1)
    return np.cumsum(change)[:-1] > 0


class Stretch:
    """Pages of one or more whole hosts, or a part of a long one, until their words fill a stream."""

    def __init__(self, tag: int = 0) -> None:
        self.rows: list[tuple] = []  # id, url, number of the page, blocks
        self.hosts: list[int] = []  # number of the host of each row
        self.keys: list[tuple] = []  # host and share of each row
        self.shares: list[int] = []  # shares of the host of each row
        self.words = 0
        self.number: dict[tuple, int] = {}
        self.tag = tag
        self.tags: dict[int, int] = {}  # tags of pages that go on in another stretch: copies by id are no evidence
        self.shared: list[np.ndarray] = []  # windows, or short minimizers, that other stretches have too

    def add(self, page_id, url: str | None, host: tuple, shares: int, found: list[tuple[int, str]]) -> int:
        """Adds a page's blocks; returns about how many words it has."""
        self.rows.append((page_id, url, self.number.setdefault((host, page_id), len(self.number)), found))
        self.hosts.append(int.from_bytes(hashlib.blake2b(host[0].encode(), digest_size=8).digest(), "little"))
        self.keys.append(host)
        self.shares.append(shares)
        words = sum(len(t) for _, t in found) // 6
        self.words += words
        return words

    def read(self) -> tuple:
        """Blocks of each row, words, words of each block, row of each word and its hash (words of two hosts never agree)."""
        size = [len(r[3]) for r in self.rows]
        words = find_words(pa.array([t for r in self.rows for _, t in r[3]], pa.string()), NOT_SPACE)
        per_block = np.diff(words.at)
        row = np.repeat(np.repeat(np.arange(len(self.rows)), size), per_block)
        return size, words, per_block, row, mix(words.hashes() ^ mix(np.array(self.hosts, np.uint64))[row])

    def numbers(self, row: np.ndarray) -> np.ndarray:
        return np.array([r[2] for r in self.rows], np.int64)[row]

    def distinct(self, minimizers: bool) -> Iterator[tuple]:
        """(host, buckets, bucket, share, tag, values) of long hosts: the short minimizers, or the windows whose minimizer
        another stretch has; sorted, divided by the number of buckets."""
        _, _, _, row, hashes = self.read()
        at, value, low = windows(hashes, row)
        row = row[at]
        bits = np.array([PART_BITS + n.bit_length() for n in self.shares], np.uint64)
        low >>= np.uint64(64) - np.minimum(bits, np.uint64(64))[row]
        if minimizers:
            some = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (row[1:] != row[:-1])]) if len(low) else at
            value = low
        else:
            some = np.flatnonzero(np.isin(low, np.concatenate(self.shared))) if self.shared else at[:0]
        value, row = value[some], row[some]
        # by host and share: the steps cut stretches at the same pages of a share, but need not put the same shares together
        number = {k: i for i, k in enumerate(dict.fromkeys(self.keys))}
        key = np.array([number[k] for k in self.keys], np.int64)[row]
        order = np.lexsort((value, key))
        value, key, page = value[order], key[order], self.numbers(row[order])
        first = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (key[1:] != key[:-1])]) if len(value) else np.zeros(0, np.int64)
        lowest, highest = (f.reduceat(page, first) if len(first) else page for f in (np.minimum, np.maximum))
        value, key = value[first], key[first]
        tag = np.full(len(first), self.tag)
        for n, own in self.tags.items():
            tag[(lowest == n) & (highest == n)] = own
        count = dict(zip(self.keys, self.shares))
        for (host, share), i in number.items():
            buckets = max(LEAST_BUCKETS, count[host, share])
            mine = np.flatnonzero(key == i)
            bucket = (value[mine] % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((value[mine], tag[mine], bucket))
            mine, bucket = mine[order], bucket[order]
            cut = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (tag[mine][1:] != tag[mine][:-1])]) if len(mine) else []
            for part in np.split(mine, cut[1:]) if len(mine) else []:
                yield host, buckets, int(value[part[0]] % np.uint64(buckets)), share, int(tag[part[0]]), value[part] // np.uint64(buckets)

    def texts(self) -> list[tuple]:
        size, words, per_block, row, hashes = self.read()
        cover = repeated(hashes, self.numbers(row))
        if self.shared:
            at, window, _ = windows(hashes, row)
            cover |= covered_by(at[np.isin(window, np.concatenate(self.shared))], len(hashes))
        total = np.r_[0, np.cumsum(cover)]
        share = (total[words.at[1:]] - total[words.at[:-1]]) / np.maximum(per_block, 1)
        out, at = [], 0
        for (page_id, url, _, found), n in zip(self.rows, size):
            kind = min((k for k, _ in found), default=CHROME)
            mine = [(t, share[at + i]) for i, (k, t) in enumerate(found) if k == kind != CHROME]
            kept = [t for t, s in mine if kind == ARTICLE or s < COVERED] or [t for t, _ in mine]
            text = "\n".join(kept)
            covered = int(total[words.at[at + n]] - total[words.at[at]])
            out.append((page_id, url, text, len(text), covered))
            at += n
        return out


def packed(found: list[tuple[int, str]]) -> tuple[int, bytes]:
    """Size and compressed form of blocks (no block has a line end in it)."""
    raw = "\n".join(f"{kind}{text}" for kind, text in found).encode()
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(size: int, data: bytes) -> list[tuple[int, str]]:
    raw = pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True).decode() if size else ""
    return [(int(line[0]), line[1:]) for line in raw.split("\n")] if raw else []


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, id, url, html) in; the blocks packed out."""
    for batch in batches:
        for part in slices(batch, 1000, 4 << 20):
            sizes, data = zip(*(packed(blocks(html)) for html in part.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], names=["host", "id", "url", "size", "blocks"])


def _stretches(stream: int, batches: Iterator[pa.RecordBatch], long_only: bool = False) -> Iterator[Stretch]:
    """Sorted pages (host, share, id, url, size, blocks, shares, known) as stretches. Rows with a negative size come ahead of
    the pages of their share and hold what other stretches have. ``long_only``: those of hosts of more than one share."""
    stretch, last, last_id, of_host, tag, known = Stretch(), None, None, 0, 0, []
    for batch in batches:
        if long_only:
            batch = batch.filter(pc.greater(batch.column(6), 1))
        for part in slices(batch, 1000, 4 << 20):
            for name, share, page_id, url, size, data, n, others in zip(*(c.to_pylist() for c in part.columns)):
                host = (name, share)
                same = host == last
                if not same:
                    of_host, known = 0, []
                if stretch.rows and (of_host >= stream if same else stretch.words >= stream // 2):
                    tag += 2
                    after = Stretch(tag)
                    if same:
                        after.shared += known
                        if page_id == last_id:  # the same page goes on
                            number = stretch.rows[-1][2]
                            after.tags[0] = stretch.tags.setdefault(number, stretch.tag + 1)
                    yield stretch
                    stretch, of_host = after, 0
                last = host
                if size < 0:
                    more = [decoded(x) for x in others or ()]
                    known += more
                    stretch.shared += more
                    continue
                last_id = page_id
                of_host += stretch.add(page_id, url, host, n, unpacked(size, data))
    if stretch.rows:
        yield stretch


SENT = "host string, buckets long, bucket long, share long, tag long, data binary"
BACK = "host string, share long, part long, data binary"


def _send(stream: int, minimizers: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages in; rows of ``SENT`` of the long hosts out, with their minimizers or windows."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for stretch in _stretches(stream, batches, long_only=True):
        rows = [(*key, coded(values)) for *key, values in stretch.distinct(minimizers)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["host", "buckets", "bucket", "share", "tag", "data"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``SENT`` sorted by host and bucket in; rows of ``BACK`` with the values that two tags have out."""

    def found(host: str, buckets: int, bucket: int, owners: dict[tuple, list[np.ndarray]]) -> pa.RecordBatch:
        every = [np.unique(np.concatenate(v)) if len(v) > 1 else v[0] for v in owners.values()]
        value, n = np.unique(np.concatenate(every), return_counts=True)
        value = value[n > 1]
        by: dict[int, list[np.ndarray]] = {}
        for (share, _), own in zip(owners, every):
            some = own[np.isin(own, value, assume_unique=True)]
            if len(some):
                by.setdefault(share, []).append(some)
        data = [coded(np.unique(np.concatenate(v)) * np.uint64(buckets) + np.uint64(bucket)) for v in by.values()]
        part = bucket // LEAST_BUCKETS
        return pa.RecordBatch.from_arrays(
            [pa.array([host] * len(by), pa.string()), pa.array(list(by), pa.int64()), pa.array([part] * len(by), pa.int64()), pa.array(data, pa.binary())],
            names=["host", "share", "part", "data"],
        )

    last, owners = None, {}
    for batch in batches:
        for host, buckets, bucket, share, tag, data in (tuple(c[i].as_py() for c in batch.columns) for i in range(batch.num_rows)):
            if owners and (host, buckets, bucket) != last:
                yield found(*last, owners)
                owners = {}
            last = (host, buckets, bucket)
            owners.setdefault((share, tag), []).append(decoded(data))
    if owners:
        yield found(*last, owners)


def _extract(id_type: pa.DataType, stream: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages and shared windows in; texts out."""
    for stretch in _stretches(stream, batches):
        cols = list(zip(*stretch.texts()))
        kinds = [id_type, pa.string(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["id", "url", "text", "n_chars", "n_repeated"])


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", host_pages: int = HOST_PAGES, stream: int = STREAM) -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars and the words that other pages of the host repeat."""
    spark = pages.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    hosted = pages.select(host_of(F.col(url_col)).alias("host"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    # a page has no more words, by the count of six characters a word, than its bytes over six
    size = F.greatest(F.ceil(F.col("n") / host_pages), F.ceil(F.col("bytes") / (6 * stream)))
    hosts = hosted.groupBy("host").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).alias("bytes"))
    long_hosts = stored(hosts.select("host", size.alias("shares")).where(F.col("shares") > 1), "hosts")
    hot = broadcast_if_bounded(long_hosts, HOT_HOSTS)
    kind = pages.schema[id_col].dataType
    one = T.StructType([T.StructField("host", T.StringType()), T.StructField("id", kind), *T._parse_datatype_string("url string, size long, blocks binary")])
    row = ["host", "share", "id", "url", "size", "blocks", "shares"]
    rows = hosted.mapInArrow(_read, one).join(hot, "host", "left").withColumn("shares", F.coalesce("shares", F.lit(1)).cast("long"))
    rows = rows.withColumn("share", F.pmod(F.xxhash64("id"), "shares")).select(*row)
    some_long = not long_hosts.isEmpty()
    if some_long:  # a row ahead of each share's pages, for what other stretches have
        none = {"id": F.lit(None).cast(kind), "url": F.lit(None).cast("string"), "size": F.lit(-1).cast("long"), "blocks": F.lit(None).cast("binary")}
        ahead = long_hosts.withColumn("shares", F.col("shares").cast("long")).withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
        rows = rows.unionByName(ahead.withColumns(none).select(*row))
    # each step below reads this exchange
    dealt = rows.repartition(tasks, "host", "share")

    def in_order(pages: DataFrame) -> DataFrame:
        # the same order each time, so that stretches end at the same pages
        return pages.sortWithinPartitions("host", "share", F.col("size") >= 0, "id", F.xxhash64("blocks"))

    def in_others(sent: DataFrame) -> DataFrame:
        """The pages with what other stretches have of ``sent`` in the rows ahead."""
        back = sent.repartition(tasks, "host", "bucket").sortWithinPartitions("host", "bucket").mapInArrow(_shared, BACK)
        back = back.repartition(tasks, "host", "share").groupBy("host", "share", "part").agg(F.collect_list("data").alias("known"))
        p, b = dealt.alias("p"), back.alias("b").hint("merge")
        joined = p.join(b, (F.col("p.host") == F.col("b.host")) & (F.col("p.share") == F.col("b.share")) & (F.col("p.size") < 0), "left")
        return in_order(joined.select("p.*", "b.known"))

    known = in_order(dealt.withColumn("known", F.lit(None).cast("array<binary>")))
    if some_long:
        for minimizers in (True, False):
            known = in_others(known.mapInArrow(partial(_send, stream, minimizers), SENT))
    schema = T.StructType([T.StructField("id", kind), *T._parse_datatype_string("url string, text string, n_chars long, n_repeated long")])
    return known.mapInArrow(partial(_extract, to_arrow_type(kind), stream), schema).withColumnsRenamed({"id": id_col, "url": url_col})
