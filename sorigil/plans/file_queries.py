"""Registered queries that go through files, the way a user of the corpus tools works: metadata is written and
read back, data sets are chosen and concatenated, tables are saved and reused (S1-S8, P1, P4-P6, U1, J3, R16).

Files are written from the driver tables into a fresh folder below the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorigil.functions import arrays
from sorigil.functions.jamo import jamo, utf8_made, utf8_tokens
from sorigil.operators import encode, listing
from sorigil.plans import catalog
from sorigil.session import cut_lineage, scratch_path, spread
from sorigil.sources import fixtures as fx
from sorigil.sources import metadata as M

TARGET_RATE = 16
CHOSEN = ("src1", "src3", "src11")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _written_sources(spark: SparkSession, sf_dir: str, folder: str) -> list[tuple[str, str, str]]:
    """Each data set's metadata folder (``filename|text`` with header); the data sets are a short declared list."""
    meta = fx.documents_as_transcripts(spark, sf_dir)
    line = M.metadata_line(["filename", "text"]).alias("filename|text")
    meta.select("source", line).write.partitionBy("source").options(**M.LINES).csv(folder)
    names = [r["source"] for r in meta.select("source", "source_ord").distinct().orderBy("source_ord").collect()]
    return [(n, f"{fx.DATA_ROOT}/{n}/", f"{folder}/source={n}") for n in names]


@catalog.register("file_concat")
def file_concat(spark, sf_dir):
    """Every data set's metadata written, read, tagged, resolved and concatenated."""
    sources = _written_sources(spark, sf_dir, fresh_folder(spark, "metadata"))
    return M.load_sources(spark, [*sources, ("absent", "/data/absent", sources[0][2] + "-absent")], with_jamo=False).where("_bad is null").drop("_bad")


@catalog.register("file_chosen")
def file_chosen(spark, sf_dir):
    """The chosen data sets only."""
    sources = _written_sources(spark, sf_dir, fresh_folder(spark, "metadata"))
    return M.select_sources(M.load_sources(spark, sources, with_jamo=False), CHOSEN).select("source", "filename")


@catalog.register("file_rejects")
def file_rejects(spark, sf_dir):
    """Lines with a field too many are set aside whole, the others are read. Quotes stay as they are in the texts, and every fifth text is quoted whole."""
    folder = fresh_folder(spark, "raw")
    one_line = F.regexp_replace("text", "[\\r\\n]+", " ")
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('"'), one_line, F.lit('"'))).otherwise(one_line)
    raw = spread(fx.table(spark, sf_dir, "documents")).select(F.concat_ws("|", F.format_string("doc_%06d.wav", "doc_id"), text).alias("value"))
    raw.write.text(folder)
    meta = M.read_metadata(spark, folder)
    return meta.where("_bad is null").select("filename", "text", F.lit(False).alias("rejected")).unionAll(
        M.rejected(meta).select(F.lit(None).cast("string").alias("filename"), F.col("line").alias("text"), F.lit(True).alias("rejected")))


@catalog.register("file_corpus")
def file_corpus(spark, sf_dir):
    """The one-text-per-line jamo corpus, written and read back."""
    folder = fresh_folder(spark, "corpus")
    t = fx.documents_as_transcripts(spark, sf_dir)
    M.write_corpus(t.select(jamo("text").alias("jamo")), folder, compression="gzip")  # plain, it takes a dozen times the tables it is made from
    return spark.read.text(folder).select(F.col("value").alias("line"))


@catalog.register("file_listing")
def file_listing(spark, sf_dir):
    """The files of a folder tree by their paths and lengths: bytes per data set of the one-text-per-line files."""
    folder = fresh_folder(spark, "texts")
    docs = spread(fx.table(spark, sf_dir, "documents"))
    docs.select("source", F.regexp_replace("text", "[\\r\\n]+", " ").alias("value")).write.partitionBy("source").text(folder)
    files = M.list_audio(spark, folder).withColumn("source", F.regexp_extract("full_path", "/source=([^/]+)/[^/]+$", 1))
    return files.where("source <> ''").groupBy("source").agg(F.sum("length").alias("bytes"))


@catalog.register("file_processed")
def file_processed(spark, sf_dir):
    """Jamo texts as bytes where the encoding succeeded, saved as the three-column table, reused, and the rejects with a reason.

    A transcript's audio codes exist when its document is labelled."""
    docs = spread(fx.table(spark, sf_dir, "documents")).select("doc_id", "text")
    codes = fx.table(spark, sf_dir, "labels").select("doc_id", F.array(F.array(F.col("quality").cast("int"), F.col("toxic").cast("int"))).alias("audio_tokens")).dropDuplicates(["doc_id"])
    text = jamo(fx.hangulize("text"))  # syllables as in documents_as_transcripts
    # only rows with codes can be valid; the join exchanges the texts as they are read (at every size, so that its disk follows the input),
    # not their syllables or bytes, which are many times larger
    ok, _ = listing.keep_valid(docs.join(codes.hint("merge"), "doc_id").select("doc_id", utf8_tokens(text).alias("text_tokens"), "audio_tokens"))
    # the rejects are told from all rows, by whether the encoding succeeded: no text and no tokens are exchanged for them
    succeeded = F.when(utf8_made(text), F.array().cast("array<int>")).alias("text_tokens")
    _, rejects = listing.keep_valid(docs.select("doc_id", succeeded).join(codes, "doc_id", "left"))
    path = fresh_folder(spark, "processed")
    made_from = M.fingerprint(fx.table(spark, sf_dir, "documents").select("doc_id", "text"), codes)
    for _ in range(2):  # the second call finds the finished table
        saved = M.processed_or_build(spark, path, lambda: ok.select("text_tokens", "audio_tokens", F.col("doc_id").alias("original_indices")), made_from)
    kept = saved.select(F.col("original_indices").alias("doc_id"), arrays.join_ints("text_tokens").alias("tokens"), arrays.join_ints(F.flatten("audio_tokens")).alias("codes"), F.lit("").alias("reason"))
    return kept.unionAll(rejects.select("doc_id", F.lit("").alias("tokens"), F.lit("").alias("codes"), "reason"))


@catalog.register("file_speech")
def file_speech(spark, sf_dir):
    """A nested speech table written and read; rate check and the clip out of a list of candidates."""
    path = fresh_folder(spark, "speech")
    clips = fx.embeddings_as_clips(spark, sf_dir)
    clips.select("audio", F.col("clip_id").cast("string").alias("text")).write.parquet(path)
    t = M.read_speech_table(spark, path)
    return t.select(
        F.col("text").cast("bigint").alias("clip_id"), M.needs_resample("audio", TARGET_RATE).alias("resample"),
        F.posexplode(arrays.select_shape(F.array("audio.array", F.reverse("audio.array")))).alias("i", "v"),
    )


@catalog.register("file_vocab")
def file_vocab(spark, sf_dir):
    """The vocabulary written as Parquet and as text lines, both read back."""
    v = catalog._seed_vocab(spark, sf_dir, catalog._words_once(spark, sf_dir))
    folder = fresh_folder(spark, "vocab")
    out = []
    for fmt in ("parquet", "tsv"):
        M.write_vocab(v, f"{folder}/{fmt}", fmt)
        out.append(M.read_vocab(spark, f"{folder}/{fmt}", fmt).select(F.lit(fmt).alias("format"), "id", "piece", F.round("score", 6).alias("score")))
    return out[0].unionAll(out[1])


@catalog.register("lattice_edges")
def lattice_edges_q(spark, sf_dir):
    """Every substring of the distinct held-out words that is a vocabulary piece."""
    v = catalog._seed_vocab(spark, sf_dir, catalog._words_once(spark, sf_dir))
    words = cut_lineage(encode.text_words(catalog._benchmark_jamo(spark, sf_dir), "item_id").select("word").distinct())
    return encode.lattice_edges(words, v).select("word", "b", "e", "piece", "id", F.round("score", 6).alias("score"))
