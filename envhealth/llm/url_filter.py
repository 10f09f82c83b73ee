"""URL verdicts from rules, and beyond them from two character language models.

Accepted and rejected URLs each train a smoothed variable-order Markov model of bytes: the
estimate after a context of k bytes falls back to that after k - 1 bytes as far as the longer
context is rare. A URL's log-likelihood difference divided by its length is compared with a
threshold that is calibrated on URLs held out of the fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches
from .words import Texts, mixed, pieces, powers

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, rule); a rule is a host and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Bytes of the longest gram, bits of a hashed count table, weight of the shorter context.
ORDER, TABLE_BITS, BACKOFF = 5, 18, 4.0
#: One URL in so many is held out for the threshold, and so many score bins are counted.
CALIBRATION_FOLDS, BINS, BIN_RANGE = 10, 4096, 8.0

_STEP = np.uint64(0x2545F4914F6CDD1D)


def host_of(url: str | Column) -> Column:
    """Lower-cased text after the first `://` up to `/`, `?`, `#` or the end; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    """Text after the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """`struct(verdict, rule)` of the longest rule that fits, the first of equally long ones; else null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def gram_slots(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each gram length, each byte's slot as a gram and that of its context before it."""
    data, at = texts.data, texts.offsets
    place = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    gram, context = data.astype(np.uint64) + np.uint64(1), np.zeros(len(data), np.uint64)
    shift = np.uint64(64 - TABLE_BITS)
    for k, factor in enumerate(powers(_STEP, ORDER)):
        if k:
            before = np.zeros(len(data), np.uint64)  # 0 stands for the start of the URL
            before[k:] = data[:-k].astype(np.uint64) + np.uint64(1)
            before[place < k] = 0
            gram, context = gram + before * factor, context + before * factor
        yield mixed(gram) >> shift, mixed(context) >> shift


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task's `(url, accepted, held_out)` as `(held_out, slot, n)`."""
    tables: dict[bool, np.ndarray] = {}
    for batch in batches:
        kinds = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        for fold in np.unique(held):
            table = tables.setdefault(bool(fold), np.zeros(2 * ORDER * 2 << TABLE_BITS, np.int32))
            for kind in (0, 1):
                column = batch.column(0).filter(pa.array((held == fold) & (kinds == kind)))
                for texts in pieces(column, lower=False):
                    for k, slots in enumerate(gram_slots(texts)):
                        for which, slot in enumerate(slots):
                            base = ((kind * ORDER + k) * 2 + which) << TABLE_BITS
                            np.add.at(table, slot.astype(np.int64) + base, 1)
    for fold, table in tables.items():
        slot = np.flatnonzero(table)
        columns = [pa.array(np.full(len(slot), fold)), pa.array(slot), pa.array(table[slot].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["held_out", "slot", "n"])


def url_scores(column: pa.Array, tables: np.ndarray) -> np.ndarray:
    """Log-likelihood difference per byte; 0 for an empty or null URL."""
    out = []
    for texts in pieces(column, lower=False):
        logs = np.zeros(len(texts.data))
        for kind, sign in ((1, 1.0), (0, -1.0)):
            p = np.full(len(texts.data), 1 / 256)
            for k, (gram, context) in enumerate(gram_slots(texts)):
                n, total = tables[kind, k, 0][gram], tables[kind, k, 1][context]
                p = (np.minimum(n, total) + BACKOFF * p) / (total + BACKOFF)
            logs += sign * np.log(p)
        sums = np.concatenate([[0.0], np.cumsum(logs)])[texts.offsets]
        out.append(np.diff(sums) / np.maximum(1, np.diff(texts.offsets)))
    return np.concatenate([np.zeros(0), *out])


def _scored(batches, tables, columns: int):
    for batch in batches:
        kept = [batch.column(i) for i in range(1, columns)]
        names = [*batch.schema.names[1:], "score"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(url_scores(batch.column(0), tables.value))], names=names)


def train(spark, labelled: DataFrame) -> tuple[np.ndarray, float]:
    """Count tables and threshold from `labelled(url, accepted)`; all its rows are counted.

    The tables have a fixed size whatever the number of URLs. Without URLs of both kinds the
    tables are empty, all scores are 0 and the threshold is 0.
    """
    held = F.pmod(F.xxhash64("url"), F.lit(CALIBRATION_FOLDS)) == 0
    rows = labelled.select("url", "accepted", held.alias("held_out")).where("url is not null")
    partial_counts = rows.mapInArrow(_counted, "held_out boolean, slot long, n long")
    counts = partial_counts.groupBy("held_out", "slot").agg(F.sum("n").alias("n")).toArrow()
    shape = (2, ORDER, 2, 1 << TABLE_BITS)
    fit, rest = np.zeros(shape, np.float32), np.zeros(shape, np.float32)
    if counts.num_rows:
        fold = counts.column(0).to_numpy().astype(bool)
        slot, n = counts.column(1).to_numpy(), counts.column(2).to_numpy()
        fit.reshape(-1)[slot[~fold]] = n[~fold]
        rest.reshape(-1)[slot[fold]] = n[fold]
    whole = fit + rest
    if not (whole[0].any() and whole[1].any()):
        return np.zeros(shape, np.float32), 0.0
    score = partial(_scored, tables=spark.sparkContext.broadcast(fit), columns=2)
    out = rows.where("held_out").select("url", "accepted").mapInArrow(score, "accepted boolean, score double")
    slots = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + BIN_RANGE) * (BINS / 2 / BIN_RANGE))))
    bins = np.zeros((2, BINS))
    for slot, accepted, n in out.groupBy(slots.alias("slot"), "accepted").count().collect():
        bins[int(accepted), slot] = n
    share = bins / np.maximum(1, bins.sum(axis=1, keepdims=True))
    # Cut before bin i: accepted below it and rejected from it on are errors, each as a share.
    errors = np.concatenate([[0], np.cumsum(share[1])]) + np.concatenate([np.cumsum(share[0][::-1])[::-1], [0]])
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return whole, float(best[len(best) // 2]) / (BINS / 2 / BIN_RANGE) - BIN_RANGE


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """`(page_id, host, path, rule, verdict, score)`, one row per row of `pages(page_id, url)`.

    URLs that a rule fits keep its verdict and train the models; the others are allowed if
    their score reaches the threshold. A null URL, or one without `://`, has an empty host and
    path; null and empty URLs score 0. Without a rule hit of both kinds all others are allowed.
    Repeated rows are judged alike. Other columns are ignored; no rows, no result rows.
    """
    spark = pages.sparkSession
    small_batches(spark)
    host, path = host_of("url"), path_of("url")
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", first_rule(F.col("host"), F.col("path"), rules))
    labelled = rows.where("hit is not null").select("url", (F.col("hit.verdict") == "allow").alias("accepted"))
    tables, threshold = train(spark, labelled)
    kept = rows.select("url", "page_id", "host", "path", "hit.rule", F.col("hit.verdict").alias("given"))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, given string, score double"
    scored = kept.mapInArrow(partial(_scored, tables=spark.sparkContext.broadcast(tables), columns=6), schema)
    verdict = F.coalesce("given", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
