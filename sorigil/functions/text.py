"""Text columns: word splitting for the subword vocabulary, speaker tags,
audio path and file-name formatting, piece strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word-start marker of the unigram vocabulary, the speaker
# tags of the dialogue model, and the whitespace characters that separate words.
WORD_START = "▁"  # ▁
SPEAKER_ONE = "[S1]"
SPEAKER_TWO = "[S2]"
WHITESPACE_RE = "[ \\t\\n\\r\\f]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mark_word(col) -> Column:
    """Prefix a word with the word-start marker."""
    return F.concat(F.lit(WORD_START), _col(col))


def single_line(col) -> Column:
    """Replace line breaks by a space so one text is one corpus line."""
    return F.regexp_replace(_col(col), "[\\r\\n]+", " ")


def tag_speaker(col) -> Column:
    """Prefix ``[S1] `` unless the text already starts with ``[S1]`` or ``[S2]``."""
    c = _col(col)
    tagged = c.startswith(SPEAKER_ONE) | c.startswith(SPEAKER_TWO)
    return F.when(c.isNull(), None).when(tagged, c).otherwise(F.concat(F.lit(SPEAKER_ONE + " "), c))


def resolve_path(data_dir, filename) -> Column:
    """``data_dir/wavs/filename``."""
    return F.concat_ws("/", _col(data_dir), F.lit("wavs"), _col(filename))


# Fixed value: the usual prefix of clip names.
CLIP_PREFIX = "zeroth"


def clip_filename(idx, prefix: str = CLIP_PREFIX) -> Column:
    """``<prefix>_%06d.wav`` of a 0-based index."""
    return F.format_string(f"{prefix}_%06d.wav", _col(idx))


def pieces_to_string(col) -> Column:
    """T4: pieces joined by single spaces."""
    return F.array_join(_col(col), " ")


def pieces_to_text(col) -> Column:
    """Inverse of segmentation: concatenate pieces, word-start markers become spaces."""
    return F.ltrim(F.translate(F.array_join(_col(col), ""), WORD_START, " "))
