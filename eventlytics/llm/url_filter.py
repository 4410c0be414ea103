"""URL filters: host/path rules, and a ratio of two character models.

Rules block or allow a host with all its subdomains below a path prefix; the
longest fitting rule wins. URLs without a rule get the method's verdict: two
variable-order Markov models over characters, one of accepted and one of
rejected URLs, score each URL by the difference of its log-likelihoods per
character, compared with a calibrated threshold.

A model has contexts of up to ``ORDER`` characters over a folded alphabet
(lower case; everything outside ``ALPHABET`` is one symbol). A context of any
length is smoothed by the one a character shorter (Witten-Bell: the weight of
the shorter one is its share of distinct followers), order 0 by the uniform
distribution. Counts come from every labelled URL by a distributed
aggregation; they are bounded by the alphabet (at most ``SYMBOLS ** (ORDER +
1)`` grams a model), and so is the broadcast table of log ratios.

Four fifths of the labelled URLs (by a hash of the URL) train the models; on
the other fifth the threshold with the best balanced accuracy is chosen.

Defined cases: null URLs and URLs without ``://`` have empty host and path;
empty URLs score 0; without labelled URLs of both kinds every score and the
threshold are 0 (verdict ``allow``); repeated rows are judged each for
itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.bytespans import row_groups, utf8
from eventlytics.llm.frames import only

ORDER = 3
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-_?=&:%"
SYMBOLS = len(ALPHABET) + 2   # any other byte; the start of the URL
OTHER, START = len(ALPHABET), len(ALPHABET) + 1
CODES = np.full(256, OTHER, np.int64)
for _i, _c in enumerate(ALPHABET):
    CODES[ord(_c)] = CODES[ord(_c.upper())] = _i
FOLDS, CALIBRATION_FOLD = 5, 0
ALLOW, BLOCK = "allow", "block"
STEP = 1e-3           # thresholds are multiples of this
GROUP_BYTES = 1 << 21


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlModel:
    ratios: np.ndarray | None   # ln accepted - ln rejected, by gram
    threshold: float


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty if null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def apply_rules(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Adds host, path, rule (null: none fits) and the rule's verdict.

    ``urls`` must have no columns of these names. Of equally long rules the
    first in the list wins.
    """
    host, path = host_and_path(F.col(url))
    d = urls.withColumn("host", host).withColumn("path", path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):  # the longest is asked first
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return d.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _coded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram numbers of all bytes (each with ORDER before it), rows joined."""
    n = len(offsets) - 1
    starts = offsets[:-1] + ORDER * np.arange(1, n + 1)
    keep = np.ones(len(data) + ORDER * n, bool)
    for k in range(1, ORDER + 1):
        keep[starts - k] = False
    padded = np.full(len(keep), START)
    padded[keep] = CODES[data]
    gram = padded.copy()
    scale = 1
    for k in range(1, ORDER + 1):
        scale *= SYMBOLS
        gram[k:] += padded[:-k] * scale
    return gram[keep], np.flatnonzero(keep)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = np.array(batch.column(1).to_pylist(), bool)
        for label in (True, False):
            data, offsets = utf8(batch.column(0).filter(pa.array(good == label)))
            for a, b in row_groups(offsets, GROUP_BYTES):
                gram, _ = _coded(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                keys, n = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(keys)), pa.array(keys), pa.array(n.astype(np.int64))],
                    names=["good", "gram", "n"])


def _log_probabilities(gram: np.ndarray, n: np.ndarray) -> np.ndarray:
    """ln p(symbol | ORDER symbols before), for every possible gram."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)     # below order 0
    for k in range(ORDER + 1):
        size = SYMBOLS ** (k + 1)
        c = np.bincount(gram % size, n, size).reshape(-1, SYMBOLS)
        total, distinct = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        shorter = np.tile(p.reshape(-1, SYMBOLS), (SYMBOLS if k else 1, 1))
        whole = total + distinct
        p = np.where(whole > 0, (c + distinct * shorter) / np.maximum(whole, 1), shorter)
    return np.log(p).ravel()


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            out = np.zeros(batch.num_rows)
            if ratios is not None:
                for a, b in row_groups(offsets, GROUP_BYTES):
                    gram, _ = _coded(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    sums = np.concatenate(([0.0], np.cumsum(ratios[gram], dtype=np.float64)))
                    cut = offsets[a:b + 1] - offsets[a]
                    out[a:b] = (sums[cut[1:]] - sums[cut[:-1]]) / np.maximum(np.diff(cut), 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.round(out, 6))],
                                             names=[*batch.schema.names[1:], "score"])

    return score


def score_urls(urls: DataFrame, ratios: np.ndarray | None, url: str = "url") -> DataFrame:
    """All columns but ``url``, and ``score``; ``urls`` must have none."""
    rest = [c for c in urls.columns if c != url]
    shared = urls.sparkSession.sparkContext.broadcast(ratios)
    schema = ", ".join(f"`{c}` {urls.schema[c].dataType.simpleString()}" for c in rest)
    return urls.select(url, *rest).mapInArrow(_scorer(shared), schema + ", score double")


def _best_threshold(counts) -> float:
    """The multiple of STEP with the best balanced accuracy, if scores at or
    above it are accepted; of equally good ones the middle one."""
    counts = sorted((r["at"], r["good"], r["n"]) for r in counts)
    goods = sum(n for _, good, n in counts if good)
    bads = sum(n for _, good, n in counts if not good)
    if not goods or not bads:
        return 0.0
    best, found = -1.0, []
    spots = sorted({at for at, _, _ in counts})
    good_below = bad_below = 0
    for spot in [*spots, spots[-1] + 1]:
        value = round((goods - good_below) / goods + bad_below / bads, 12)
        if value > best:
            best, found = value, []
        if value == best:
            found.append(spot)
        good_below += sum(n for at, good, n in counts if at == spot and good)
        bad_below += sum(n for at, good, n in counts if at == spot and not good)
    return found[len(found) // 2] * STEP


def fit_urls(labelled: DataFrame) -> UrlModel:
    """Models and threshold from ``labelled`` (url, good boolean)."""
    d = only(labelled, "url", "good").where("url IS NOT NULL AND good IS NOT NULL")
    d = d.withColumn("fold", F.crc32(F.col("url").cast("binary")) % FOLDS)
    train = d.where(F.col("fold") != CALIBRATION_FOLD).select("url", "good")
    grams = (train.mapInArrow(_count, "good boolean, gram bigint, n bigint")
             .groupBy("good", "gram").agg(F.sum("n").alias("n"))).toArrow()
    good = np.array(grams["good"].to_pylist(), bool)
    gram, n = grams["gram"].to_numpy(), grams["n"].to_numpy()
    if not good.any() or good.all():
        return UrlModel(None, 0.0)
    ratios = (_log_probabilities(gram[good], n[good])
              - _log_probabilities(gram[~good], n[~good])).astype(np.float32)
    held = score_urls(d.where(F.col("fold") == CALIBRATION_FOLD).select("url", "good"), ratios)
    counts = held.groupBy(F.floor(F.col("score") / STEP).alias("at"), "good").agg(F.count(F.lit(1)).alias("n"))
    return UrlModel(ratios, _best_threshold(counts.collect()))  # as many rows as distinct steps


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per page: page_id, host, path, rule, score and verdict; the
    models learn from the URLs that a rule decides."""
    d = apply_rules(only(pages, "page_id", "url"), rules)
    known = d.where("rule_verdict IS NOT NULL").select("url", (F.col("rule_verdict") == ALLOW).alias("good"))
    model = fit_urls(known)
    by_method = F.when(F.col("score") >= model.threshold, ALLOW).otherwise(BLOCK)
    return score_urls(d, model.ratios).select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_method).alias("verdict"), "score")
