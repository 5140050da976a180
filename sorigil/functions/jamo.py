"""Hangul text functions.

* ``hangul_to_jamo`` (T1): every precomposed syllable U+AC00..U+D7A3 becomes its
  initial, medial and (if any) final compatibility jamo; every other character
  is kept. Native Column expression, so it stays inside whole-stage codegen and
  has an exact SQL twin.
* ``hangul_to_jamo_arrow``: the same mapping as an Arrow function (a table by
  code point), for long texts where the per-character array of the native form
  dominates.
* ``utf8_bytes`` (T2): UTF-8 byte values of a string as ``ARRAY<INT>``.

The Arrow forms take a batch in runs of at most ``RUN_BYTES`` of text and hand every run's result out before the next,
so a worker's memory follows the run (or the longest text), not the rows of a batch times what a text grows to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.functions.bind import let

# ---------------------------------------------------------------------------
# Unicode Hangul syllable composition and the compatibility jamo
# used for output. They must be exactly these for correct results.
SYLLABLE_FIRST = 0xAC00  # 가
SYLLABLE_LAST = 0xD7A3  # 힣
INITIALS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
MEDIALS = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
FINALS = "ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"  # final index 1..27, 0 = none
# ---------------------------------------------------------------------------

N_FINAL_SLOTS = len(FINALS) + 1  # 28
N_PER_INITIAL = len(MEDIALS) * N_FINAL_SLOTS  # 588


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decompose_syllable(ch: str) -> str:
    """Python reference for one character (used by tests and the Arrow table)."""
    cp = ord(ch)
    if not SYLLABLE_FIRST <= cp <= SYLLABLE_LAST:
        return ch
    s = cp - SYLLABLE_FIRST
    fin = s % N_FINAL_SLOTS
    return INITIALS[s // N_PER_INITIAL] + MEDIALS[(s % N_PER_INITIAL) // N_FINAL_SLOTS] + (FINALS[fin - 1] if fin else "")


def _jamo_of_char(c: Column) -> Column:
    cp = F.ascii(c)
    s = cp - F.lit(SYLLABLE_FIRST)
    ini = F.lit(INITIALS).substr(F.floor(s / N_PER_INITIAL).cast("int") + 1, F.lit(1))
    med = F.lit(MEDIALS).substr(F.floor((s % N_PER_INITIAL) / N_FINAL_SLOTS).cast("int") + 1, F.lit(1))
    fin_idx = (s % N_FINAL_SLOTS).cast("int")
    fin = F.when(fin_idx > 0, F.lit(FINALS).substr(fin_idx, F.lit(1))).otherwise(F.lit(""))
    return F.when(cp.between(SYLLABLE_FIRST, SYLLABLE_LAST), F.concat(ini, med, fin)).otherwise(c)


def hangul_to_jamo(col) -> Column:
    """T1 as a native expression: ``array_join(transform(split(t, ''), jamo), '')``.

    Null stays null, the empty string stays empty, characters outside the BMP
    pass through (``split`` with an empty pattern splits by code point)."""
    c = _col(col)
    return F.array_join(F.transform(F.split(c, ""), _jamo_of_char), "")


RUN_BYTES = 1 << 20  # text that one step of an Arrow form converts


def runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[pa.Array]:
    """``texts`` in order, cut into runs of at most ``limit`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


_NO_CHAR = 0x110000  # fills a row of the table behind its last character
_STEP = 1 << 16  # characters looked up at once, so that a long text takes no more memory than a run
_TABLES: tuple[np.ndarray, np.ndarray] | None = None


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the characters that stand for it (up to three, then ``_NO_CHAR``) and their length in UTF-8."""
    global _TABLES
    if _TABLES is None:
        chars = np.full((_NO_CHAR, 3), _NO_CHAR, np.uint32)
        chars[:, 0] = np.arange(_NO_CHAR)
        for cp in range(SYLLABLE_FIRST, SYLLABLE_LAST + 1):
            for i, c in enumerate(decompose_syllable(chr(cp))):
                chars[cp, i] = ord(c)
        size = np.searchsorted([0x80, 0x800, 0x10000, _NO_CHAR], chars, side="right").astype(np.uint8) + 1
        _TABLES = chars, np.where(chars < _NO_CHAR, size, 0).sum(axis=1, dtype=np.uint8)
    return _TABLES


def _jamo_strings(run: pa.Array) -> pa.Array:
    """T1 of a run: its texts are looked up as one array of code points; where each ends follows from its characters' lengths."""
    chars, size = _tables()
    codes = np.frombuffer("".join(t or "" for t in run.to_pylist()).encode("utf-32-le"), np.uint32)
    out, ends = [], np.zeros(len(codes) + 1, np.int64)
    for lo in range(0, len(codes), _STEP):
        step = codes[lo : lo + _STEP]
        found = np.take(chars, step, axis=0).ravel()
        out.append(found[found != _NO_CHAR].tobytes().decode("utf-32-le").encode())
        ends[lo + 1 : lo + 1 + len(step)] = size[step]
    np.cumsum(ends, out=ends)
    last = np.cumsum(np.concatenate([[0], pc.fill_null(pc.utf8_length(run), 0).to_numpy(zero_copy_only=False)]), dtype=np.int64)
    if ends[-1] > 2**31 - 1:
        raise OverflowError("the jamo of a text take more than 2 GB")
    valid = pa.array(run.is_valid().to_numpy(zero_copy_only=False)).buffers()[1] if run.null_count else None
    return pa.StringArray.from_buffers(len(run), pa.py_buffer(ends[last].astype(np.int32)), pa.py_buffer(b"".join(out)), valid)


def jamo_runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for run in runs(batch):
            yield _jamo_strings(run)


@F.arrow_udf(T.StringType())
def hangul_to_jamo_arrow(s: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """T1 as an Arrow function: a table by code point, built once per worker and read for a run of texts at once."""
    return jamo_runs(s)


def jamo(col, native: bool = False) -> Column:
    """T1 for whole texts: the Arrow form by default (about 3x faster than the
    per-character array expression on long texts), the native form on request."""
    return hangul_to_jamo(col) if native else hangul_to_jamo_arrow(_col(col))


def utf8_bytes(col) -> Column:
    """UTF-8 byte values, ``ARRAY<INT>``; empty text gives an empty array, null stays null.

    Each byte is read from the binary value as a one-character ISO-8859-1
    string, whose code point is the byte value. The encoded value is bound
    once (``let``) so the per-byte lambda does not re-encode the text."""
    c = _col(col)

    def body(s):
        b = s["b"]
        idx = F.sequence(F.lit(1), F.greatest(F.octet_length(b), F.lit(1)))
        return F.transform(idx, lambda i: F.ascii(F.decode(b.substr(i, F.lit(1)), "ISO-8859-1")))

    codes = let(body, b=F.encode(c, "UTF-8"))
    return F.when(c.isNull(), F.lit(None).cast("array<int>")).when(F.length(c) == 0, F.array().cast("array<int>")).otherwise(codes)


def _byte_lists(s: pa.Array) -> pa.Array:
    b = s.cast(pa.binary())
    n = len(b)
    offsets = np.frombuffer(b.buffers()[1], dtype=np.int32)[b.offset : b.offset + n + 1]
    data = b.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    values = flat[offsets[0] : offsets[-1]].astype(np.int32) if n else np.zeros(0, dtype=np.int32)
    rel = (offsets - offsets[0]).astype(np.int32) if n else np.zeros(1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(rel), pa.array(values), mask=b.is_null())


def byte_runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for run in runs(batch):
            yield _byte_lists(run)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def utf8_bytes_arrow(s: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """T2 as an Arrow function: the string column's own UTF-8 buffer becomes the list values
    and its offsets the list offsets (no per-row Python)."""
    return byte_runs(s)


def utf8_tokens(col, native: bool = False) -> Column:
    """T2 for whole texts: Arrow by default, native on request."""
    return utf8_bytes(col) if native else utf8_bytes_arrow(_col(col))


@F.arrow_udf(T.BooleanType())
def utf8_made_arrow(s: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Whether ``utf8_bytes_arrow`` makes a value: every text is encoded, and its bytes, four to an integer, stay in the worker."""
    for made in byte_runs(s):
        yield made.is_valid()


def utf8_made(col) -> Column:
    """``utf8_tokens(col).isNotNull()`` where the tokens themselves are not wanted."""
    return utf8_made_arrow(_col(col))
