"""Sources and sinks of the corpus tools (S1-S8) and data-set handling.

* S1 ``read_metadata``: pipe-separated ``filename|text[|jamo]`` with a header
  line, explicit schema; rows that do not fit land in ``_bad``.
* S2 ``list_audio``: the audio files that exist (``binaryFile`` listing; the
  file content is never selected, so it is never read).
* S3 ``read_speech_table``: rows of ``audio STRUCT<array, sampling_rate>, text``.
* S4 ``write_metadata`` / S5 ``write_corpus``: CSV with header / one text per line.
* S6 ``save_processed`` / ``load_processed``: the three-column processed table,
  reused when present.
* S7 ``read_vocab`` / S8 ``write_vocab``: ``id, piece, score`` (Parquet) and the
  ``piece<TAB>score`` export ordered by id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.functions.text import resolve_path, single_line

META_SCHEMA = T.StructType([T.StructField("filename", T.StringType()), T.StructField("text", T.StringType())])
JAMO_META_SCHEMA = T.StructType(META_SCHEMA.fields + [T.StructField("jamo", T.StringType())])
SPEECH_SCHEMA = T.StructType(
    [
        T.StructField(
            "audio",
            T.StructType([T.StructField("array", T.ArrayType(T.DoubleType())), T.StructField("sampling_rate", T.IntegerType())]),
        ),
        T.StructField("text", T.StringType()),
    ]
)
PROCESSED_SCHEMA = T.StructType(
    [
        T.StructField("text_tokens", T.ArrayType(T.IntegerType())),
        T.StructField("audio_tokens", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("original_indices", T.LongType()),
    ]
)
#: The file that tells a finished processed table and what it was made from (Spark's readers skip names with an underscore).
MANIFEST = "_manifest"
VOCAB_SCHEMA = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("piece", T.StringType()), T.StructField("score", T.DoubleType())]
)


# What stands for line breaks, quotes and the line writer's own marks in a quoted field.
LINE_ESCAPES = {"\\n": "\n", "\\r": "\r", "\\q": '"', "\\0": "\0", "\\1": "\u0001"}


def parse_metadata(lines: DataFrame, with_jamo: bool = False) -> DataFrame:
    """``value`` lines (header included or not) as metadata rows: shared by the batch and the stream reader.

    A line is ``filename|text[|jamo]``, fields apart by ``|``. A quote is an ordinary character, unless a field both
    begins and ends with one, as ``write_metadata`` writes fields that hold ``|``, a quote, a backslash or a line break
    (``\\n`` and ``\\r`` stand for line breaks, ``\\q`` for a quote, ``\\0`` and ``\\1`` for the first two control characters, a doubled
    backslash for one). A line that does not fit is kept whole in ``_bad``, with a null file name; empty lines and header lines are left
    out (``write_metadata`` quotes a row that reads like the header, so its rows all come back)."""
    names = ["filename", "text"] + (["jamo"] if with_jamo else [])
    header = "|".join(names)
    line = F.regexp_replace("value", "\r$", "")
    # fields: quoted ones (without a quote inside) or anything without the separator
    fields = F.regexp_extract_all(F.concat(line, F.lit("|")), F.lit('("[^"]*"(?=[|])|[^|]*)[|]'), F.lit(1))
    fits = F.size("_f") == len(names)

    def field(i: int) -> Column:
        raw = F.get("_f", i)
        inner = F.expr(f"substring(_f[{i}], 2, length(_f[{i}]) - 2)")

        # doubled backslashes are cut out first: a backslash that is left begins an escape
        def undone(part: Column) -> Column:
            for code, char in LINE_ESCAPES.items():
                part = F.replace(part, F.lit(code), F.lit(char))
            return part

        text = F.array_join(F.transform(F.split(inner, r"\\\\", -1), undone), "\\")
        return F.when((F.length(raw) >= 2) & raw.startswith('"') & raw.endswith('"'), text).otherwise(F.nullif(raw, F.lit("")))

    rows = lines.where((F.length("value") > 0) & (line != header)).withColumn("_f", fields)
    good = [F.when(fits, field(i)).alias(n) for i, n in enumerate(names)]
    rest = [c for c in lines.columns if c != "value"]
    return rows.select(*good, F.when(~fits, line).alias("_bad"), *rest)


def read_metadata(spark: SparkSession, paths: str | Sequence[str], with_jamo: bool = False) -> DataFrame:
    """Pipe-separated lines with a header; a line that does not fit is kept whole in ``_bad``.

    Files are read line by line, so a large file is split over tasks and an unclosed quote harms nothing."""
    return parse_metadata(spark.read.option("lineSep", "\n").text(list(paths) if not isinstance(paths, str) else paths), with_jamo)


def rejected(meta: DataFrame) -> DataFrame:
    """The lines set aside, with the data set they come from where it is known."""
    return meta.where(F.col("_bad").isNotNull()).select(F.col("_bad").alias("line"), *[c for c in ("source", "data_dir") if c in meta.columns])


def add_source(df: DataFrame, data_dir: str, source: str, source_ord: int) -> DataFrame:
    """Constant data-set columns."""
    return df.select("*", F.lit(data_dir).alias("data_dir"), F.lit(source).alias("source"), F.lit(source_ord).alias("source_ord"))


def with_full_path(df: DataFrame) -> DataFrame:
    """``full_path = data_dir/wavs/filename``."""
    return df.withColumn("full_path", plain_path(resolve_path("data_dir", "filename")))


def select_sources(df: DataFrame, sources: Sequence[str] | None, source_col: str = "source") -> DataFrame:
    """Keep the chosen data sets; ``None`` keeps all, an empty choice is an error."""
    if sources is None:
        return df
    if len(sources) == 0:
        raise ValueError("choose at least one data set")
    return df.where(F.col(source_col).isin(list(sources)))


def concat_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union keeping duplicates; order is carried by ``source_ord``. No frame is an error."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("no data set found")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_sources(spark: SparkSession, sources: Sequence[tuple[str, str, str]], with_jamo: bool = True) -> DataFrame:
    """Read each data set's metadata file (``name, data_dir, metadata_path``), skip missing files,
    tag each with its name and order, and concatenate (S1 + P1 + P2 + U1)."""
    frames = []
    for i, (name, data_dir, path) in enumerate(sources):
        if path_exists(spark, path):
            frames.append(with_full_path(add_source(read_metadata(spark, path, with_jamo), data_dir, name, i)))
    return concat_sources(frames)


def plain_path(path: Column) -> Column:
    """A path without the ``file:`` scheme, slashes doubled by accident or a slash at its end; other schemes stay."""
    local = F.regexp_replace(path, "^file:/*", "/")
    return F.regexp_replace(F.regexp_replace(local, "(?<!:)/{2,}", "/"), "(?<=.)/$", "")


def list_audio(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``full_path, length`` of the files under ``root``, of any type unless ``glob`` names one (content not read)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(root)
    return files.select(plain_path(F.col("path")).alias("full_path"), "length")


def read_speech_table(spark: SparkSession, path: str) -> DataFrame:
    """S3: a table of speech samples with the nested audio struct."""
    return spark.read.schema(SPEECH_SCHEMA).parquet(path)


#: Options of the CSV writer under which a one-column table is written as plain lines behind a header line.
LINES = {"header": True, "quote": "", "sep": "\u0001", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def metadata_line(cols: Sequence[str]) -> Column:
    """One metadata line: fields that hold ``|``, a quote, a backslash, a line break or one of the writer's marks are quoted and escaped; an empty
    field is quoted, null is not; so is a first field that equals its column's name, which the header has."""

    def field(name: str) -> Column:
        c = F.col(name).cast("string")
        escaped = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        for code, char in LINE_ESCAPES.items():
            escaped = F.replace(escaped, F.lit(char), F.lit(code))
        quoted = F.when((c == "") | (c == name) | c.rlike('[|"\\\\\n\r\x00\x01]'), F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(c)
        return F.coalesce(quoted, F.lit(""))

    return F.concat_ws("|", *(field(c) for c in cols))


def write_metadata(df: DataFrame, path: str, with_jamo: bool = False, mode: str = "overwrite") -> None:
    """``filename|text[|jamo]``, one line per row, each file with a header line; an empty text is told from null."""
    cols = ["filename", "text"] + (["jamo"] if with_jamo else [])
    df.select(metadata_line(cols).alias("|".join(cols))).write.mode(mode).options(**LINES).csv(path)


def write_corpus(df: DataFrame, path: str, col: str = "jamo", mode: str = "overwrite", compression: str = "none") -> None:
    """One text per line; line breaks inside a text become spaces, nulls are skipped.

    ``compression`` names a codec of Spark's text files, such as ``gzip``: a jamo takes three bytes, of which two hardly vary. A file written
    so is read by one task, as one task wrote it.

    A filter on a computed column is moved below it, which computes it twice; one on an exploded value stays where it is."""
    lines = df.select(F.explode(F.array(single_line(col))).alias("value"))
    lines.where(F.col("value").isNotNull()).write.mode(mode).text(path, compression=compression)


#: A reader turns the rows of a row group, up to 4096 of them, into arrays of 4 bytes a token and two levels at once, so a row group ends at
#: 16 MB of those. The writer counts tokens so only while their page is open (a closed page counts compressed), so pages may be longer than that.
PROCESSED_LAYOUT = {"parquet.block.size": 16 << 20, "parquet.page.size": 32 << 20, "parquet.page.size.row.check.min": 10, "parquet.page.size.row.check.max": 10}


def save_processed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``text_tokens, audio_tokens, original_indices``."""
    df.select(*PROCESSED_SCHEMA.fieldNames()).write.mode(mode).options(**PROCESSED_LAYOUT).parquet(path)


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROCESSED_SCHEMA).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file layer finds ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def fingerprint(*inputs: DataFrame, **params) -> str:
    """A digest of the inputs' rows (in any order) and of the parameters: columns, number of rows and two sums of row hashes, which a
    changed, added or lost row alters. One scan of each input, nothing collected but the sums."""
    parts = [repr(sorted(params.items()))]
    for df in inputs:
        row = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
        wide = lambda c: F.sum(c.cast("decimal(20,0)"))
        sums = df.select(row.alias("h"), F.xxhash64(row, F.lit(1)).alias("g")).agg(F.count(F.lit(1)), wide(F.col("h")), wide(F.col("g"))).first()
        parts.append(f"{df.schema.simpleString()} {tuple(map(str, sums))}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_manifest(spark: SparkSession, path: str) -> str | None:
    """The fingerprint of a finished table, None where there is none."""
    fs, name = _file(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if not fs.exists(name):
        return None
    stream = fs.open(name)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_manifest(spark: SparkSession, path: str, value: str) -> None:
    """Committed last, under its final name only when whole."""
    fs, part = _file(spark, f"{path.rstrip('/')}/{MANIFEST}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(value.encode()))
    finally:
        out.close()
    if not fs.rename(part, _file(spark, f"{path.rstrip('/')}/{MANIFEST}")[1]):
        raise OSError(f"the manifest of {path} could not be committed")


def processed_or_build(spark: SparkSession, path: str, build, of: str | None = None) -> DataFrame:
    """S6 reuse: load the processed table if a finished one made from the same inputs exists, otherwise build, save and load it.

    ``of`` is the inputs' ``fingerprint``; a manifest with it is written when the table is whole, and taken away before the table is
    written again, so that a changed input builds anew and a half-written table is never read. Without ``of`` any finished
    table is taken."""
    found = read_manifest(spark, path)
    if found is None or (of is not None and found != of):
        fs, manifest = _file(spark, f"{path.rstrip('/')}/{MANIFEST}")
        if found is not None:
            fs.delete(manifest, False)
        save_processed(build(), path)
        write_manifest(spark, path, of or "")
    return load_processed(spark, path)


def read_vocab(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``id, piece, score``. The TSV form carries no id column: its one file is small (a vocabulary) and in id order, so
    a line's place in it is the id."""
    if fmt == "parquet":
        return spark.read.schema(VOCAB_SCHEMA).parquet(path)
    whole = spark.read.text(path, wholetext=True).where(F.length("value") > 0)
    lines = whole.select(F.posexplode(F.split("value", "\n")).alias("id", "line")).where(F.length("line") > 0)
    return lines.select("id", F.split_part("line", F.lit("\t"), F.lit(1)).alias("piece"), F.split_part("line", F.lit("\t"), F.lit(2)).cast("double").alias("score"))


def write_vocab(vocab: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet ``id, piece, score``; the TSV export is one file ordered by id
    (bounded by the vocabulary size)."""
    if fmt == "parquet":
        vocab.select("id", "piece", "score").write.mode(mode).parquet(path)
        return
    out = vocab.orderBy("id").select(F.concat_ws("\t", "piece", F.round("score", 6).cast("string")).alias("value")).coalesce(1)
    out.write.mode(mode).text(path)


def needs_resample(audio: Column | str = "audio", target: int = 22050) -> Column:
    """The clip's rate differs from the target."""
    a = F.col(audio) if isinstance(audio, str) else audio
    return a["sampling_rate"] != F.lit(target)
