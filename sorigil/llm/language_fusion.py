"""Language of web pages by fusing four kinds of evidence with Bayes' rule.

* Text: hashed byte trigrams of the visible blocks under a model per language, learnt from documents with a known
  language (additive smoothing). The log likelihood is a mean per trigram times at most ``EVIDENCE`` trigrams, since
  neighbouring trigrams are no independent witnesses.
* Declared markup language: right with probability ``DECLARED``, else any other language alike.
* Address suffix and host: priors by grouped aggregation of what the pages themselves say. Every page gives its
  posterior under text and declaration to its host, its suffix and the whole table; a host's prior is its own sum
  smoothed by ``STRENGTH`` pages' worth of its suffix's prior, which is smoothed by the overall one. A page's own vote is
  taken out before it is used (a host with one page has its suffix's prior).

Only narrow rows (ids, host, likelihoods) are written and grouped; texts are read once. A host with a third of
all pages is summed by partial aggregates and joined back as one row.

Every language of the documents can be an answer: a language is the whole primary subtag of a tag, two or three
letters (so there are at most 18,252, in practice some hundreds), other values and ``NO_LANGUAGE`` are none. Languages are
counted over all documents; learning uses about ``SAMPLE`` documents in all, an equal share of each language or all
it has, chosen by a hash of id and text, at least one each.

Results: one row per row of the table. A page without text or declaration has its host's prior. Null html is empty,
a null address is the host "" with the suffix "". Without any labelled document every language is null. Ties go to the
first language in alphabetical order. Rows that repeat an id are pages of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorigil.llm.common import slices, stored
from sorigil.llm.host_suffix_array import host_of
from sorigil.llm.html_blocks import blocks
from sorigil.llm.words import _LOWER, text_buffer

BUCKETS = 1 << 13
SAMPLE = 20_000
NO_LANGUAGE = ("und", "mul", "mis", "zxx")  # fixed values: tags that name no language
EVIDENCE = 50.0
DECLARED = 0.9
STRENGTH = 5.0
HTML_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})(?![A-Za-z])", re.I)


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every byte trigram of the lower-cased texts, none across rows."""
    raw, offsets = text_buffer(column)
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _LOWER[raw].astype(np.uint32)
    code = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    keep = row[:-2] == row[2:]
    return row[:-2][keep], bucket[keep].astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) in; (lang, bucket, n) summed per task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, 2000, 4 << 20):
            row, bucket = trigrams(part.column(1))
            names = np.array(part.column(0).to_pylist(), object)
            for name in set(names):
                sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                sums[name] += np.bincount(bucket[(names == name)[row]], minlength=BUCKETS)
    for name, n in sums.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])


def language_of(tag: Column) -> Column:
    """The primary subtag in lower case; null where a value names no language."""
    primary = F.lower(F.regexp_extract(tag, "^([A-Za-z]{2,3})(?:[-_]|$)", 1))
    return F.when((primary != "") & ~primary.isin(*NO_LANGUAGE), primary)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and log probabilities (language x bucket)."""
    key = [F.col(c) for c in (id_col, text_col) if c in docs.columns]
    known = docs.select(language_of(F.col(lang_col)).alias("lang"), F.col(text_col).alias("t"), F.pmod(F.xxhash64(*key), F.lit(1_000_000)).alias("h")).where("lang is not null and t is not null")
    counts = {r["lang"]: (r["n"], r["least"]) for r in known.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()}
    names = sorted(counts)
    if not names:
        return names, np.zeros((0, BUCKETS), np.float32)
    each = max(1, sample // len(names))
    limits = [(name, max(counts[name][1] + 1, int(1_000_000 * min(1.0, each / counts[name][0])))) for name in names]
    some = known.join(F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, below long")), "lang").where("h < below")
    counted = some.select("lang", "t").mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    logs = np.full((len(names), BUCKETS), 0.5, np.float32)
    number = {name: i for i, name in enumerate(names)}
    at = np.array([number[x] for x in counted["lang"].to_pylist()], np.int64)
    logs[at, counted["bucket"].to_numpy()] += counted["n"].to_numpy()
    return names, np.log(logs / logs.sum(1, keepdims=True, dtype=np.float64)).astype(np.float32)


def _evidence(names: list[str], logs: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, host, suffix, html) in; declared language and log likelihoods of text and declaration out."""
    k, number = len(names), {name: i for i, name in enumerate(names)}
    for batch in batches:
        for part in slices(batch, 500, 4 << 20):
            pages = part.column(3).to_pylist()
            texts = pa.array(["\n".join(t for kind, t in blocks(p) if kind < 3) for p in pages], pa.string())
            row, bucket = trigrams(texts)
            n = np.bincount(row, minlength=len(pages))
            text = np.stack([np.bincount(row, logs[i, bucket], len(pages)) for i in range(k)], 1) * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
            declared = [m[1].lower() if (m := HTML_LANG.search(p or "")) else None for p in pages]
            said = np.zeros_like(text)
            for i, d in enumerate(declared):
                if d in number and k > 1:
                    said[i] = np.log((1 - DECLARED) / (k - 1))
                    said[i, number[d]] = np.log(DECLARED)
            like = text + said
            vote = np.exp(like - like.max(1, keepdims=True))
            vote /= vote.sum(1, keepdims=True)
            at = pa.array(np.arange(len(pages) + 1) * k, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v.reshape(-1), pa.float64())) for v in (like, vote)]
            best = pa.array([names[i] if m else None for i, m in zip(text.argmax(1), n)], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(declared, pa.string()), best, *lists], names=["id", "host", "suffix", "declared", "text_lang", "likelihood", "vote"])


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, "([^.]+)$", 1)


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, host, declared and text language, fused language and its probability."""
    names, logs = learn(docs)
    kind = pages.schema[id_col].dataType
    if not names:
        none = F.lit(None).cast("string")
        return pages.select(id_col, host_of(F.col(url_col)).alias("host"), none.alias("declared"), none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("probability"))
    host = host_of(F.col(url_col))
    narrow = pages.select(F.col(id_col).alias("id"), host.alias("host"), suffix_of(host).alias("suffix"), F.col(html_col).alias("html"))
    schema = T.StructType([T.StructField("id", kind), *T._parse_datatype_string("host string, suffix string, declared string, text_lang string, likelihood array<double>, vote array<double>")])
    page = stored(narrow.mapInArrow(partial(_evidence, names, logs), schema), "evidence")
    votes = page.select("host", "suffix", F.posexplode("vote").alias("i", "v")).groupBy("host", "suffix", "i").agg(F.sum("v").alias("v"))

    def summed(by: list[str], name: str) -> DataFrame:
        """(by, sums by language, their total): one entry a language."""
        per = votes.groupBy(*by, "i").agg(F.sum("v").alias("v")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("s"), F.sum("v").alias(f"{name}_n"))
        return per.select(*by, F.col("s.v").alias(name), f"{name}_n")

    whole = summed([], "all").first()  # one row
    joined = page.join(summed(["host", "suffix"], "of_host"), ["host", "suffix"]).join(summed(["suffix"], "of_suffix"), "suffix")

    def smoothed(sums: Column, n: Column, i: Column, below: Column) -> Column:
        """A level's share of language i without the page's own vote, ``STRENGTH`` pages of the level below added."""
        return (F.greatest(F.get(sums, i) - F.get("vote", i), F.lit(0.0)) + STRENGTH * below) / (F.greatest(n - 1, F.lit(0.0)) + STRENGTH)

    overall, of_all = F.array(*map(F.lit, whole["all"] or [0.0])), F.lit(whole["all_n"] or 0.0)

    def posterior(like: Column, i: Column) -> Column:
        suffix = smoothed(F.col("of_suffix"), F.col("of_suffix_n"), i, smoothed(overall, of_all, i, F.lit(1.0 / len(names))))
        return like + F.log(smoothed(F.col("of_host"), F.col("of_host_n"), i, suffix))

    logged = joined.withColumn("post", F.transform("likelihood", posterior)).withColumn("top", F.array_max("post"))
    scaled = logged.withColumn("post", F.transform("post", lambda x: F.exp(x - F.col("top"))))
    total_post = F.aggregate("post", F.lit(0.0), lambda a, b: a + b)
    best = F.array_position("post", F.array_max("post")).cast("int")
    return scaled.select(
        F.col("id").alias(id_col), "host", "declared", "text_lang",
        F.element_at(F.array(*map(F.lit, names)), best).alias("lang"), (F.array_max("post") / total_post).alias("probability"),
    )
