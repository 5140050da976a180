"""Registered queries over the driver tables: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (or tables Spark derives from them) and
returns flat columns: integer arrays are joined into strings and float arrays
are exploded to one row per element, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorigil.operators import vocab
from sorigil.session import cut_lineage, spread
from sorigil.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


@register("jamo_words")
def jamo_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> Hangul -> jamo -> distinct ▁-words with frequencies."""
    docs = spread(fx.table(spark, sf_dir, "documents")).select("text")
    return vocab.word_counts(docs, "text", to_jamo=True, transform_word=fx.hangulize)


# ---- data sets, order and batching (P1-P4, U1, W1-W3, L1) -----------------
from sorigil.functions.jamo import hangul_to_jamo, jamo  # noqa: E402
from sorigil.operators import listing, order  # noqa: E402

BATCH_SIZE = 8
MAX_SAMPLES = 300


def _transcripts(spark, sf_dir):
    return fx.documents_as_transcripts(spark, sf_dir)


def _with_audio_positions(spark, sf_dir):
    """E3 load stage: keep rows whose audio exists, then number them in concatenated order."""
    kept = listing.with_audio(_transcripts(spark, sf_dir), fx.labels_as_listing(spark, sf_dir))
    return order.concat_positions(kept, "doc_id")


@register("jamo_metadata")
def jamo_metadata(spark, sf_dir):
    """``filename|text|jamo`` for every transcript (T1 on whole texts)."""
    t = _transcripts(spark, sf_dir)
    return t.select("filename", "text", jamo("text").alias("jamo"))


@register("source_concat")
def source_concat(spark, sf_dir):
    """Every data set's rows numbered inside the set and after concatenation."""
    t = order.concat_positions(_transcripts(spark, sf_dir), "doc_id")
    return t.select("doc_id", "source", "source_ord", "row_idx", "pos", "filename", "full_path")


@register("batch_assign")
def batch_assign(spark, sf_dir):
    """Encoding batches of min(B, 32) rows in concatenated order after the audio filter."""
    t = _with_audio_positions(spark, sf_dir)
    return t.select("doc_id", "pos", order.batch_id("pos", min(BATCH_SIZE, 32)).alias("batch_id"))


@register("max_samples")
def max_samples_q(spark, sf_dir):
    """L1: the first MAX_SAMPLES rows in concatenated order after the audio filter (the feature is a prefix)."""
    t = order.max_samples(_with_audio_positions(spark, sf_dir), MAX_SAMPLES)
    return t.select("doc_id", "source", "pos")


@register("with_audio")
def with_audio_q(spark, sf_dir):
    """Transcripts whose audio file exists, with positions over the kept rows."""
    return _with_audio_positions(spark, sf_dir).select("doc_id", "source", "row_idx", "pos", "full_path")


@register("missing_audio")
def missing_audio_q(spark, sf_dir):
    """Transcripts whose audio file is missing."""
    t = listing.missing_audio(_transcripts(spark, sf_dir), fx.labels_as_listing(spark, sf_dir))
    return t.select("doc_id", "source", "full_path")


@register("source_counts")
def source_counts_q(spark, sf_dir):
    """A1: rows before and after the audio filter per data set, plus the total row (source null)."""
    return listing.source_counts(_transcripts(spark, sf_dir), fx.labels_as_listing(spark, sf_dir))


@register("progress")
def progress_q(spark, sf_dir):
    """W4 + P6: per encoding batch, rows done, total and running count of valid encodings."""
    t = _with_audio_positions(spark, sf_dir)
    # a row encodes when its jamo text is non-empty; jamo decomposition maps a text to the
    # empty string only if it is empty, so the text's own length decides (no Python stage)
    valid = F.coalesce(F.length("text") > 0, F.lit(False))
    return listing.progress(t.select("pos", valid.alias("valid")), BATCH_SIZE)


# ---- encoding and batches (T2, P7, L3, L4, A2, R1-R6) -----------------------
from sorigil.functions import arrays, audio  # noqa: E402
from sorigil.functions.jamo import utf8_tokens  # noqa: E402
from sorigil.functions.text import tag_speaker  # noqa: E402
from sorigil.operators import batching, metrics  # noqa: E402

EPOCHS = 2
SEED = 0
PREVIEW = 10
COLLATE_AUDIO_LEN = 12
LOSS_BATCH = 4


def _encoded(spark, sf_dir):
    """E3 encode stage: jamo text of the kept rows as UTF-8 byte tokens."""
    t = _with_audio_positions(spark, sf_dir)
    return t.select("doc_id", "pos", utf8_tokens(jamo("text")).alias("text_tokens"))


@register("encode_bytes")
def encode_bytes_q(spark, sf_dir):
    """T2 + L4: byte tokens of every kept transcript, with their count and preview."""
    e = _encoded(spark, sf_dir)
    return e.select(
        F.col("pos").alias("original_indices"),
        F.size("text_tokens").alias("n_tokens"),
        arrays.join_ints(arrays.preview("text_tokens", PREVIEW)).alias("preview"),
        arrays.join_ints("text_tokens").alias("text_tokens"),
    )


@register("speaker_tag")
def speaker_tag_q(spark, sf_dir):
    """T1 then P7 on conversation turns (jamo first, then the default speaker tag)."""
    c = fx.conversations_tagged(spark, sf_dir)
    return c.select("conv_id", "turn", tag_speaker(jamo("text")).alias("text"))


@register("shuffle_epoch")
def shuffle_epoch_q(spark, sf_dir):
    """L3 + W3: each epoch's random order of the processed rows and its batches."""
    e = _with_audio_positions(spark, sf_dir).select("pos")
    b = batching.assign_batches(e, BATCH_SIZE, EPOCHS, SEED)
    return b.select("epoch", "pos", "shuffled_pos", "batch_id")


@register("collate_text")
def collate_text_q(spark, sf_dir):
    """Text tokens padded to the batch maximum capped at the text limit."""
    e = _encoded(spark, sf_dir)
    b = batching.assign_batches(e, BATCH_SIZE, EPOCHS, SEED)
    c = batching.collate_text(b, "text_tokens", batching.TEXT_LENGTH, batching.TEXT_PAD)
    return c.select(
        "epoch",
        "batch_id",
        "pos",
        "batch_len",
        arrays.join_ints("padded").alias("padded"),
        F.size(F.filter("padding_mask", lambda m: m)).alias("n_unmasked"),
        F.size("attention_mask").alias("n_attention"),
        arrays.join_ints("positions").alias("positions"),
    )


def _join_rows(x):
    return F.array_join(F.transform(x, lambda r: F.array_join(r, ",")), ";")


@register("collate_audio")
def collate_audio_q(spark, sf_dir):
    """R2: audio-code rows padded or cut to the batch length capped at the audio limit."""
    codes = fx.embeddings_as_audio_codes(spark, sf_dir).withColumnRenamed("clip_id", "pos")
    b = batching.assign_batches(codes, BATCH_SIZE, 1, SEED)
    c = batching.collate_audio(b, "audio_tokens", COLLATE_AUDIO_LEN, fx.CODE_CHANNELS, batching.AUDIO_PAD)
    return c.select("batch_id", F.col("pos").alias("clip_id"), "batch_len", _join_rows("padded").alias("padded"))


@register("channel_loss")
def channel_loss_q(spark, sf_dir):
    """W5 + A10: next-token cross-entropy per channel ignoring pad targets, mean over channels."""
    lg = fx.embeddings_as_logits(spark, sf_dir)
    pairs = metrics.next_token_pairs(lg).withColumn("batch_id", (F.col("seq_id") / LOSS_BATCH).cast("bigint"))
    _, per_batch = metrics.channel_loss(pairs, fx.LOGIT_PAD)
    return per_batch.select("batch_id", F.round("loss", 6).alias("loss"), "n_channels", "n_tokens")


LOSS_BLOCK = 5


@register("channel_loss_blocks")
def channel_loss_blocks_q(spark, sf_dir):
    """A10 with every score vector split over blocks of the vocabulary."""
    pairs = metrics.next_token_pairs(fx.embeddings_as_logits(spark, sf_dir)).withColumn("batch_id", (F.col("seq_id") / LOSS_BATCH).cast("bigint"))
    _, per_batch = metrics.channel_loss_of_blocks(metrics.score_blocks(pairs, LOSS_BLOCK), fx.LOGIT_PAD)
    return per_batch.select("batch_id", F.round("loss", 6).alias("loss"), "n_channels", "n_tokens")


@register("paired_rows")
def paired_rows_q(spark, sf_dir):
    """Each encoding batch doubled with adjacent copies (conditional and unconditional
    rows), then every second row kept again; ``kept`` marks the rows that survive."""
    t = _with_audio_positions(spark, sf_dir).select("pos")
    b = min(BATCH_SIZE, 32)
    slotted = t.select("pos", order.batch_id("pos", b).alias("batch_id"), (F.col("pos") % b).alias("slot"))
    doubled = batching.repeat_rows(slotted, "slot", 2)
    return doubled.select("batch_id", "pos", "copy", "slot_k", batching.is_kth("slot_k", 2).alias("kept"))


@register("clip_names")
def clip_names_q(spark, sf_dir):
    """P3 + W1: file names ``zeroth_%06d.wav`` of the clips by their 0-based enumeration index."""
    from sorigil.functions.text import clip_filename

    c = fx.embeddings_as_clips(spark, sf_dir).select("clip_id")
    idx = order.range_index(c, ["clip_id"], (), "idx")
    return idx.select("clip_id", "idx", clip_filename("idx").alias("filename"))


# ---- run log (A11, W6) -------------------------------------------------------


@register("epoch_metrics")
def epoch_metrics_q(spark, sf_dir):
    """Per-epoch mean loss, steps, optimizer steps, left-over micro-steps, elapsed time."""
    m = metrics.epoch_metrics(fx.events_as_run_log(spark, sf_dir))
    return m.select("epoch", "n_steps", F.round("avg_loss", 6).alias("avg_loss"), "optimizer_steps", "pending", F.round("elapsed_sec", 6).alias("elapsed_sec"))


@register("step_counters")
def step_counters_q(spark, sf_dir):
    """Logged micro-steps with optimizer-step counters within the epoch and the run."""
    stepped = metrics.step_index(fx.events_as_run_log(spark, sf_dir))
    s = metrics.step_counters(stepped)
    return s.select("epoch", "step", F.round("loss", 6).alias("loss"), "epoch_opt_step", "global_opt_step", "total_micro_steps")


# ---- waveforms (R7-R10, R14, R17, P8, A12) ------------------------------------
TRIM_THRESHOLD = 0.3
RESAMPLE_TO = 24


def _samples_long(df, arr_col):
    """One row per sample: ``clip_id, i, v`` (v rounded to 6 places; adding 0.0 turns -0.0 into 0.0)."""
    return df.select("clip_id", F.posexplode(arr_col).alias("i", "v")).select("clip_id", "i", (F.round("v", 6) + 0.0).alias("v"))


@register("trim_tail")
def trim_tail_q(spark, sf_dir):
    """Clips cut after the last loud sample plus the hold time at the clip's rate."""
    c = fx.embeddings_as_clips(spark, sf_dir)
    t = c.select("clip_id", audio.trim_tail("audio.array", TRIM_THRESHOLD, F.col("audio.sampling_rate")).alias("x"))
    return _samples_long(t, "x")


@register("change_speed")
def change_speed_q(spark, sf_dir):
    """R8 then R9: re-timed clips (factor 0.5 + 0.25 * label; 1.0 leaves a clip as is), clipped to [-1, 1]."""
    c = fx.embeddings_as_clips(spark, sf_dir)
    f = F.lit(0.5) + F.lit(0.25) * F.col("label")
    t = c.select("clip_id", audio.clip_amplitude(audio.change_speed("audio.array", f)).alias("x"))
    return _samples_long(t, "x")


@register("resample")
def resample_q(spark, sf_dir):
    """P8 + R10: clips whose rate differs from the target are resampled (band-limited); others pass."""
    from sorigil.sources.metadata import needs_resample

    c = fx.embeddings_as_clips(spark, sf_dir)
    x = F.when(needs_resample("audio", RESAMPLE_TO), audio.resample("audio.array", F.col("audio.sampling_rate"), F.lit(RESAMPLE_TO))).otherwise(
        F.col("audio.array")
    )
    return _samples_long(c.select("clip_id", x.alias("x")), "x")


@register("to_db")
def to_db_q(spark, sf_dir):
    """Amplitude in decibels relative to the clip maximum, 80 dB range."""
    c = fx.embeddings_as_clips(spark, sf_dir)
    return _samples_long(c.select("clip_id", audio.amplitude_to_db("audio.array").alias("x")), "x")


@register("to_mono")
def to_mono_q(spark, sf_dir):
    """The two halves of each clip taken as channels and averaged into one."""
    c = fx.embeddings_as_clips(spark, sf_dir)
    half = F.floor(F.size("audio.array") / 2).cast("int")
    ch = F.array(F.slice("audio.array", F.lit(1), half), F.slice("audio.array", half + 1, half))
    return _samples_long(c.select("clip_id", arrays.to_mono(ch).alias("x")), "x")


@register("clip_duration")
def clip_duration_q(spark, sf_dir):
    """Clip count and total seconds per label."""
    c = fx.embeddings_as_clips(spark, sf_dir)
    d = c.select("label", audio.duration("audio.array", F.col("audio.sampling_rate")).alias("sec"))
    return d.groupBy("label").agg(F.count(F.lit(1)).alias("n_clips"), F.round(F.sum("sec"), 6).alias("total_sec"))


# ---- spectral features (R11-R15, A3) --------------------------------------------
from sorigil.operators import spectral  # noqa: E402

FEAT_N_FFT = 16
FEAT_HOP = 4
FEAT_N_MELS = 4


def _features_long(df):
    out = df.select("clip_id", "frame_idx", F.posexplode("features").alias("bin", "v"))
    return out.select("clip_id", F.col("frame_idx").alias("frame"), "bin", (F.round("v", 6) + 0.0).alias("v"))


@register("spectrum_db")
def spectrum_db_q(spark, sf_dir):
    """Windowed power spectrum per frame in dB (ref = clip max), z-scored per clip."""
    c = fx.embeddings_as_clips(spark, sf_dir)
    return _features_long(spectral.log_features(c, FEAT_N_FFT, FEAT_HOP, None))


@register("mel_features")
def mel_features_q(spark, sf_dir):
    """The same with the mel projection (Slaney filters per clip rate)."""
    c = fx.embeddings_as_clips(spark, sf_dir)
    return _features_long(spectral.log_features(c, FEAT_N_FFT, FEAT_HOP, FEAT_N_MELS))


# ---- vocabulary and encoding (A4, A6, L2, J3, J4, T3-T5, A9, A7, A8) -----------
from sorigil.operators import encode  # noqa: E402

VOCAB_SIZE = 8000
SEED_TOP = 32_000


def _doc_words(spark, sf_dir):
    docs = spread(fx.table(spark, sf_dir, "documents")).select("text")
    return vocab.word_counts(docs, "text", to_jamo=True, transform_word=fx.hangulize)


def _words_once(spark, sf_dir):
    """The distinct-word table written once to the checkpoint folder, for plans that read it twice."""
    return cut_lineage(_doc_words(spark, sf_dir))


def _seed_vocab(spark, sf_dir, words=None):
    """A vocabulary derived from the corpus seeds (log relative frequency scores).

    The seed top-k and the ranked vocabulary are bounded tables (SEED_TOP plus
    the alphabet, VOCAB_SIZE rows); each is materialized once so the corpus scan
    and substring aggregation run once per query, not once per consumer."""
    w = _doc_words(spark, sf_dir) if words is None else words
    seeds = cut_lineage(vocab.top_pieces(vocab.seed_pieces(w), SEED_TOP))
    return cut_lineage(vocab.rank_vocab(vocab.initial_scores(seeds), VOCAB_SIZE))


@register("char_coverage")
def char_coverage_q(spark, sf_dir):
    """A4: jamo characters by frequency with running share (coverage 1.0 keeps all)."""
    c = vocab.char_coverage(_doc_words(spark, sf_dir), 1.0)
    return c.select("char", "n", "rank", F.round("share", 6).alias("share"), "kept")


@register("seed_pieces")
def seed_pieces_q(spark, sf_dir):
    """The seed-size top of frequency-weighted substrings (by count x length) plus every character."""
    s = vocab.top_pieces(vocab.seed_pieces(_words_once(spark, sf_dir)), SEED_TOP)
    return s.select("piece", "n", "len")


@register("rank_vocab")
def rank_vocab_q(spark, sf_dir):
    """L2: ids 0-3 reserved, then pieces by score descending (ties by piece)."""
    return _seed_vocab(spark, sf_dir, _words_once(spark, sf_dir))


@register("segment_words")
def segment_words_q(spark, sf_dir):
    """T3 + T5: best split of every distinct corpus word under the seed vocabulary."""
    w = _words_once(spark, sf_dir)
    seg = encode.segment_words(w, _seed_vocab(spark, sf_dir, w))
    return seg.select("word", F.array_join("pieces", " ").alias("pieces"), arrays.join_ints("ids").alias("ids"), F.round("score", 6).alias("score"))


def _benchmark_jamo(spark, sf_dir):
    b = fx.table(spark, sf_dir, "benchmark")
    return b.select("item_id", jamo(fx.hangulize("text")).alias("jamo"))


def _encoded_benchmark(spark, sf_dir):
    bj = _benchmark_jamo(spark, sf_dir)
    v = _seed_vocab(spark, sf_dir, _words_once(spark, sf_dir))
    seg = encode.segment_words(encode.text_words(bj, "item_id").select("word").distinct(), v)
    return encode.encode_texts(bj, "item_id", seg), v


@register("encode_texts")
def encode_texts_q(spark, sf_dir):
    """T3-T5 on whole held-out texts: pieces and ids per item."""
    e, _ = _encoded_benchmark(spark, sf_dir)
    return e.select("item_id", F.size("ids").alias("n_tokens"), F.array_join("pieces", " ").alias("pieces"), arrays.join_ints("ids").alias("ids"))


@register("decode_ids")
def decode_ids_q(spark, sf_dir):
    """Ids decoded back to text; equals the whitespace-normalised jamo text with
    characters outside the vocabulary shown as <unk>."""
    e, v = _encoded_benchmark(spark, sf_dir)
    return encode.decode_ids(e, "item_id", v)


@register("token_stats")
def token_stats_q(spark, sf_dir):
    """Tokens per transcript and unknown rate per data set."""
    t = _transcripts(spark, sf_dir).select("doc_id", "source", "text")
    w = _words_once(spark, sf_dir)
    v = _seed_vocab(spark, sf_dir, w)
    counts = encode.text_token_counts(t, "doc_id", encode.segment_words(w, v), "text", hangul_to_jamo)
    # texts without words count zero tokens
    per_text = t.select("doc_id", "source").join(counts, "doc_id", "left").na.fill(0, ["n", "u"])
    s = encode.token_stats(per_text, "source", ids_col=None)
    return s.select("source", "n_texts", F.round("avg_tokens", 6).alias("avg_tokens"), "max_tokens", "median_tokens", F.round("unk_rate", 6).alias("unk_rate"))


TRAIN_SEED_SIZE = 100_000
TRAIN_SHRINK = 0.5


@register("train_vocab")
def train_vocab_q(spark, sf_dir):
    """A4-A8 + L2: unigram vocabulary trained by EM with pruning on the corpus words
    (iterative; checked by invariants and row count, no SQL twin)."""
    return vocab.train_vocab(_doc_words(spark, sf_dir), VOCAB_SIZE, TRAIN_SEED_SIZE, em_rounds=2, shrink=TRAIN_SHRINK)


FEATURE_BLOCK = 8


def _clip_texts(spark, sf_dir):
    """``clip_id, jamo``: clip i reads the benchmark item whose rank by id is i modulo the number of items."""
    items = order.range_index(_benchmark_jamo(spark, sf_dir), ["item_id"], (), "rank")
    n = items.count()
    clips = fx.embeddings_as_clips(spark, sf_dir).select("clip_id")
    return clips.withColumn("rank", F.pmod("clip_id", F.lit(n))).join(items, "rank").select("clip_id", "jamo")


@register("feature_table")
def feature_table_q(spark, sf_dir):
    """The training examples: log-mel in blocks of frames, token ids and attention mask."""
    from sorigil.plans.features import feature_table

    vocabulary = _seed_vocab(spark, sf_dir, _words_once(spark, sf_dir))
    t = feature_table(fx.embeddings_as_clips(spark, sf_dir), _clip_texts(spark, sf_dir), vocabulary, FEAT_N_FFT, FEAT_HOP, FEAT_N_MELS, FEATURE_BLOCK)
    cells = F.transform(F.flatten("features"), lambda v: F.round(v * 10_000).cast("bigint"))
    return t.select(
        "clip_id", "block", "n_blocks", "n_frames", F.size("features").alias("frames"), F.array_join(cells, ",").alias("features"),
        arrays.join_ints("input_ids").alias("input_ids"), F.size("attention_mask").alias("n_attention"),
    )


TURN_VOCAB = 2000
TURN_COVERAGE = 0.9995


def trained_on(texts: DataFrame, key: str, text_col: str = "jamo", vocab_size: int = TURN_VOCAB, coverage: float = TURN_COVERAGE) -> tuple[DataFrame, DataFrame]:
    """E2 as one chain: a vocabulary trained on the texts' own words (the characters within ``coverage``), and every text's token counts with it."""
    words = cut_lineage(vocab.word_counts(texts, text_col, to_jamo=False))
    trained = cut_lineage(vocab.train_vocab(words, vocab_size, coverage=coverage))
    return trained, encode.text_token_counts(texts, key, encode.segment_words(words, trained), text_col)


@register("trained_token_stats")
def trained_token_stats_q(spark, sf_dir):
    """Turns encoded with a vocabulary trained on them (rare characters left out), tokens per turn by role
    (trained, so no SQL twin; a test holds it against the plain Viterbi)."""
    c = fx.conversations_tagged(spark, sf_dir).select(F.concat_ws(":", "conv_id", "turn").alias("turn_id"), "role", jamo("text").alias("jamo"))
    turns = cut_lineage(c)
    _, counts = trained_on(turns, "turn_id")
    per_turn = turns.select("turn_id", "role").join(counts, "turn_id", "left").na.fill(0, ["n", "u"])
    s = encode.token_stats(per_turn, "role", ids_col=None)
    return s.select("role", "n_texts", F.round("avg_tokens", 6).alias("avg_tokens"), "max_tokens", "median_tokens", F.round("unk_rate", 6).alias("unk_rate"))
