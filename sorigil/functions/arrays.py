"""Array columns for batching (R1-R6, L4) and channel handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sorigil.functions.bind import let


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def truncate_pad(tokens, length, pad) -> Column:
    """Cut to ``length`` and fill with ``pad`` up to ``length``."""
    x, n, p = _col(tokens), _lit_or_col(length), _lit_or_col(pad)
    filler = F.array_repeat(p, F.greatest(n - F.size(x), F.lit(0)))
    return F.when(n <= 0, F.slice(F.array(p), 1, 0)).otherwise(F.slice(F.concat(x, filler), 1, n))


def truncate_pad_2d(frames, length, channels: int, pad) -> Column:
    """R2: rows of ``channels`` codes, cut to ``length`` rows and filled with rows of ``pad``."""
    x, n, p = _col(frames), _lit_or_col(length), _lit_or_col(pad)
    pad_row = F.array_repeat(p, channels)
    filler = F.array_repeat(pad_row, F.greatest(n - F.size(x), F.lit(0)))
    return F.when(n <= 0, F.slice(F.array(pad_row), 1, 0)).otherwise(F.slice(F.concat(x, filler), 1, n))


def padding_mask(tokens, pad) -> Column:
    """``token <> pad`` per position (a real token equal to pad is masked too)."""
    p = _lit_or_col(pad)
    return F.transform(_col(tokens), lambda v: v != p)


def attention_mask(tokens) -> Column:
    """A 1 per token."""
    return F.array_repeat(F.lit(1), F.size(_col(tokens)))


def positions(length) -> Column:
    """``0 .. length-1``; empty for length 0 (``sequence`` would count down)."""
    n = _lit_or_col(length)
    return F.when(n <= 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), (n - 1).cast("int")))


def copies(k: int = 2) -> Column:
    """Copy index column to ``explode`` for k-fold row duplication; keep ``copy = 0`` to undo."""
    return F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy")


def preview(tokens, k: int = 10) -> Column:
    """L4: the first k tokens."""
    return F.slice(_col(tokens), 1, k)


def select_shape(x) -> Column:
    """A clip given either as an array of samples or as a list of candidate arrays → the first."""
    return F.get(_col(x), 0)


def to_mono(channels) -> Column:
    """Mean over channel arrays (``ARRAY<ARRAY<DOUBLE>>``) element by element.

    Channels are folded with ``zip_with`` (shorter channels count as 0 where they end)."""
    ch = _col(channels)
    first = F.get(ch, 0)
    rest = F.slice(ch, 2, F.greatest(F.size(ch) - 1, F.lit(0)))
    total = F.aggregate(rest, first, lambda acc, c: F.zip_with(acc, c, lambda a, b: F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))))
    return F.transform(total, lambda v: v / F.size(ch))


def join_ints(x, sep: str = ",") -> Column:
    """Integer array → ``"1,2,3"`` (engine-neutral form for comparisons and CSV); null elements are left out.

    The numbers are written into one buffer, as JSON, whose brackets are cut off by bytes; ``array_join`` first makes a string object of
    every element, some 60 bytes for each token of a text. Only arrays with null elements take that way."""
    c = _col(x)

    def body(s):
        inner = F.substring(s["listed"].cast("binary"), F.lit(2), F.octet_length(s["listed"]) - 2).cast("string")
        return F.when(s["listed"].contains("null"), F.array_join(c, sep)).otherwise(inner if sep == "," else F.replace(inner, F.lit(","), F.lit(sep)))

    return let(body, listed=F.to_json(c))
