"""Evaluation: next-token pairs and per-channel loss (W5, A10), and run-log
metrics per epoch and per optimizer step (A11, W6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorigil.functions.bind import let
from sorigil.operators import order

ACCUMULATION = 4
LOG_EVERY = 10


def next_token_pairs(logits: DataFrame, seq: str = "seq_id", t: str = "t", channel: str = "channel") -> DataFrame:
    """Scores at t paired with the label at t+1; the last step of each sequence drops out.

    The window is per (sequence, channel): bounded by the sequence length."""
    w = Window.partitionBy(seq, channel).orderBy(t)
    return logits.withColumn("target", F.lead("label").over(w)).where(F.col("target").isNotNull())


def cross_entropy(logits="logits", target="target"):
    """``logsumexp(logits) - logits[target]`` with a max shift, target 0-based."""
    lg = F.col(logits) if isinstance(logits, str) else logits
    tg = F.col(target) if isinstance(target, str) else target
    return let(
        lambda s: s["m"] + F.log(F.aggregate(s["lg"], F.lit(0.0), lambda acc, v: acc + F.exp(v - s["m"]))) - F.get(s["lg"], tg),
        lg=lg,
        m=F.array_max(lg),
    )


def channel_loss(pairs: DataFrame, pad: int, batch_col: str = "batch_id", channel: str = "channel") -> tuple[DataFrame, DataFrame]:
    """A10: mean cross-entropy per (batch, channel) over targets <> pad, then the plain
    mean over channels. A channel whose targets are all pad has a null loss and is
    skipped in the mean. Returns (per-channel table, per-batch table).

    One pass and one partial aggregate: the cross-entropy is null where the target
    is pad, so ``avg`` and ``count`` skip those rows and an all-pad channel keeps its
    row with a null loss and zero tokens."""
    return _per_channel(pairs.withColumn("ce", F.when(F.col("target") != pad, cross_entropy())), batch_col, channel)


def _per_channel(losses: DataFrame, batch_col: str, channel: str) -> tuple[DataFrame, DataFrame]:
    per_ch = losses.groupBy(batch_col, channel).agg(F.avg("ce").alias("loss"), F.count("ce").alias("n_tokens"))
    per_batch = per_ch.groupBy(batch_col).agg(
        F.avg("loss").alias("loss"), F.count("loss").alias("n_channels"), F.sum("n_tokens").alias("n_tokens")
    )
    return per_ch, per_batch


def score_blocks(pairs: DataFrame, size: int) -> DataFrame:
    """Score vectors cut over the vocabulary: ``first`` (the block's first class) and ``scores`` of at most ``size`` classes, one row per block."""
    n = F.size("logits")
    cuts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), lambda b: F.struct((b * size).alias("first"), F.slice("logits", b * size + 1, F.lit(size)).alias("scores")))
    rows = pairs.where(n > 0).select(*(c for c in pairs.columns if c != "logits"), F.explode(cuts).alias("_b"))
    return rows.select(*(c for c in pairs.columns if c != "logits"), "_b.first", "_b.scores")


def step_losses(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, target, ce``: the cross-entropy of every step from its blocks, wherever they are.

    A block leaves its maximum, its sum of exponentials scaled by that maximum, and the target's score if the block has it; two of
    these merge into one (the smaller maximum's sum is scaled down), so no task needs a whole score vector. What is gathered per step is one
    pair of numbers a block. A target that no block has gives a null loss."""
    at = F.col("target") - F.col("first")
    scaled = let(lambda s: F.aggregate(s["v"], F.lit(0.0), lambda a, x: a + F.exp(x - s["m"])), v=F.col("scores"), m=F.array_max("scores"))
    part = F.struct(F.array_max("scores").alias("m"), scaled.alias("s")).alias("part")
    own = F.when((at >= 0) & (at < F.size("scores")), F.get("scores", at.cast("int"))).alias("own")
    parts = blocks.where(F.size("scores") > 0).select(*keys, "target", part, own)
    met = parts.groupBy(*keys).agg(F.max("target").alias("target"), F.collect_list("part").alias("parts"), F.max("own").alias("own"))

    def merge(a, b):
        m = F.greatest(a["m"], b["m"])
        return F.struct(m.alias("m"), (a["s"] * F.exp(a["m"] - m) + b["s"] * F.exp(b["m"] - m)).alias("s"))

    whole = F.aggregate(F.slice("parts", 2, F.size("parts")), F.get("parts", F.lit(0)), merge, lambda a: a["m"] + F.log(a["s"]))
    return met.select(*keys, "target", (whole - F.col("own")).alias("ce"))


def channel_loss_of_blocks(blocks: DataFrame, pad: int, step: Sequence[str] = ("seq_id", "t"), batch_col: str = "batch_id", channel: str = "channel") -> tuple[DataFrame, DataFrame]:
    """A10 on score vectors split over vocabulary blocks: the tables of ``channel_loss``."""
    losses = step_losses(blocks, [batch_col, channel, *step])
    return _per_channel(losses.withColumn("ce", F.when(F.col("target") != pad, F.col("ce"))), batch_col, channel)


def step_index(run_log: DataFrame, epoch: str = "epoch", ts_us: str = "ts_us", tiebreak: str = "event_id") -> DataFrame:
    """0-based micro-step inside each epoch by (time, tiebreak), range-partitioned: a burst of
    events within one second is spread like any other rows."""
    return order.range_index(run_log, [ts_us, tiebreak], [epoch], "step")


def epoch_metrics(run_log: DataFrame, accum: int = ACCUMULATION, epoch: str = "epoch", ts_us: str = "ts_us", loss: str = "loss") -> DataFrame:
    """Per epoch the mean step loss (sum of losses / number of steps), step count,
    optimizer steps, left-over micro-steps and elapsed seconds. One partial aggregate."""
    g = run_log.groupBy(epoch).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.avg(loss).alias("avg_loss"),
        ((F.max(ts_us) - F.min(ts_us)) / F.lit(1e6)).alias("elapsed_sec"),
    )
    return g.select(
        epoch,
        "n_steps",
        "avg_loss",
        F.floor(F.col("n_steps") / accum).cast("bigint").alias("optimizer_steps"),
        (F.col("n_steps") % accum).cast("bigint").alias("pending"),
        "elapsed_sec",
    )


def step_counters(stepped: DataFrame, accum: int = ACCUMULATION, log_every: int = LOG_EVERY, epoch: str = "epoch") -> DataFrame:
    """For every logged micro-step ((step+1) % log_every == 0): optimizer steps in the
    epoch so far, optimizer steps over the run so far, and the run's micro-step total.

    Optimizer steps of earlier epochs come from the per-epoch table (one row per epoch)."""
    # steps run in an epoch = its last step + 1; reading ``step`` keeps this aggregate on the
    # same plan as the logged rows below, so the step numbering is computed once
    per_epoch = stepped.groupBy(epoch).agg((F.max("step") + 1).alias("_n"))
    w = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    before = per_epoch.select(
        epoch,
        F.coalesce(F.sum(F.floor(F.col("_n") / accum)).over(w), F.lit(0)).alias("_prev_opt"),
        F.sum("_n").over(Window.partitionBy()).alias("total_micro_steps"),
    )
    logged = stepped.where((F.col("step") + 1) % log_every == 0)
    in_epoch = F.floor((F.col("step") + 1) / accum)
    return logged.join(before, epoch).select(
        epoch,
        "step",
        "loss",
        in_epoch.cast("bigint").alias("epoch_opt_step"),
        (F.col("_prev_opt") + in_epoch).cast("bigint").alias("global_opt_step"),
        F.col("total_micro_steps").cast("bigint").alias("total_micro_steps"),
    )
