"""Documents drawn towards a target distribution by importance resampling.

Words and word pairs fall into hashed buckets. What a bucket is worth is the log ratio of its
share in the target texts and in all documents; a document's weight is the mean over its features.
With Gumbel noise added, the highest scores are a weighted draw without repetition.

Weights are looked up in an array of all buckets. The cutoff is found without sorting the scores:
a quantile sketch gives a bracket, exact counts outside of it confirm or widen it, and only the
bracket is sorted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import prefix_sums
from .scratch import saved, small_batches
from .words import ALNUM, find_words, pieces

BUCKETS, SEED = 10_000, 7
#: Words that a document needs to be drawn, and the share of such documents that is drawn.
LEAST_WORDS, PERCENT = 20, 25
#: Relative rank error of the sketch, and by what the bracket widens when counts refute it.
SKETCH, WIDER = 1e-3, 8
#: Words of more bytes are hashed one by one.
LONG_WORD = 64

_POLYNOMIAL = np.uint32(0xEDB88320)


def _byte_table() -> np.ndarray:
    """CRC-32 of single bytes, without the outer inversions."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ _POLYNOMIAL, table >> np.uint32(1))
    return table


_BYTES = _byte_table()


def _step(crc: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _BYTES[(crc ^ byte) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))


def _shift_tables() -> np.ndarray:
    """`[n, i, b]`: what byte i of a CRC with value b becomes after n zero bytes."""
    now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    out = [now]
    for _ in range(LONG_WORD):
        out.append(_step(out[-1], np.uint32(0)))
    return np.stack(out)


_SHIFTS = _shift_tables()


def _followed(crc: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """CRC of a text followed by another of `size` bytes, from the CRCs of both."""
    out = other.copy()
    for i in range(4):
        out ^= _SHIFTS[size, i, (crc >> np.uint32(8 * i)) & np.uint32(0xFF)]
    return out


def crc_of_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, all ranges at once."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    long = int(np.searchsorted(-sizes[order], -LONG_WORD, "left"))
    out = np.empty(len(starts), np.uint32)
    for i in order[:long]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    order = order[long:]
    first, size = starts[order], sizes[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(size.max(initial=0))):
        m = int(np.searchsorted(-size, -k, "left"))  # ranges of more than k bytes come first
        crc[:m] = _step(crc[:m], data[first[:m] + k])
    out[order] = ~crc
    return out


def feature_buckets(column: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: words of each text, and the bucket and the text number of every feature."""
    for texts in pieces(column):
        words = find_words(texts, ALNUM, hashed=False)
        n_words = np.diff(words.bounds)
        owner = np.repeat(np.arange(len(n_words)), n_words)
        one = crc_of_ranges(texts.data, words.starts, words.ends)
        first = np.flatnonzero(owner[1:] == owner[:-1])  # words that another word of the text follows
        space = ~_step(~one[first], np.uint32(0x20))
        size = (words.ends - words.starts)[first + 1]
        two = _followed(space, np.minimum(size, LONG_WORD), one[first + 1])
        for i in np.flatnonzero(size > LONG_WORD):
            a, b = words.starts[first[i] + 1], words.ends[first[i] + 1]
            two[i] = zlib.crc32(texts.data[a:b], int(space[i]))
        crc = np.concatenate([one, two]) % np.uint32(buckets)
        yield n_words, crc.astype(np.int64), np.concatenate([owner, owner[first]])


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """A task's features by bucket."""
    counts = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, slots, _ in feature_buckets(batch.column(0), buckets):
            counts += np.bincount(slots, minlength=buckets)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all of `texts(text)` by bucket; what comes to the driver has one row a bucket."""
    small_batches(texts.sparkSession)
    made = texts.select("text").mapInArrow(partial(_counted, buckets=buckets), "bucket long, n long")
    found = made.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    if found.num_rows:
        counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    buckets = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + buckets) / ((source + 1.0) * (float(target.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], gains) -> Iterator[pa.RecordBatch]:
    table = gains.value
    for batch in batches:
        words, sizes, weights = ([np.zeros(0, np.int64)] for _ in range(3))
        for n_words, slots, owner in feature_buckets(batch.column(1), len(table)):
            n = np.bincount(owner, minlength=len(n_words))
            total = np.zeros(len(n_words), np.int64)
            np.add.at(total, owner, table[slots])
            words.append(n_words), sizes.append(n), weights.append(np.where(n, total // np.maximum(1, n), 0))
        columns = [batch.column(0), *(pa.array(np.concatenate(x)) for x in (words, sizes, weights))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of an id, in thousandths, rounded down; a null id has that of an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def bracket(rows: DataFrame, score: str, wanted: int, n: int, error: float = SKETCH) -> tuple[int, int, int]:
    """Scores between which the `wanted`-th highest of n lies, and the number of rows above both.

    The sketch proposes; the exact count of the rows above and within decides, and widens the bracket
    until it holds the row.
    """
    while True:
        at = 1 - (wanted - 0.5) / n
        low, high = rows.approxQuantile(score, [max(0.0, at - error), min(1.0, at + error)], error / 2)
        above = F.sum((F.col(score) > high).cast("long"))
        within = F.sum(F.col(score).between(low, high).cast("long"))
        n_above, n_within = rows.agg(above, within).first()
        if n_above < wanted <= n_above + n_within:
            return int(low), int(high), n_above
        error = min(1.0, error * WIDER)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """`(doc_id, n_features, weight, score, rank)`, one row per row of `docs(doc_id, text)`.

    Of the documents with at least `least_words` words, `percent` percent (rounded down) with the highest
    scores get ranks from 1 on, ties by the smaller doc_id, null ids last; rows alike in both, which copies
    of a row are, by their number of features and then in any order. The others have a null rank. Null
    and empty texts have no features, weight 0 and no rank. `target(text)` may be empty. Other columns
    are ignored; no rows, no result rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    gains = spark.sparkContext.broadcast(bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_features long, weight long"
    weighed = docs.select("doc_id", "text").mapInArrow(partial(_weighed, gains=gains), schema)
    score = F.col("weight") + gumbel(F.col("doc_id"), seed)
    scored = saved(weighed.withColumns({"score": score, "row": F.monotonically_increasing_id()}), "scored")
    rows = scored.where(F.col("n_words") >= least_words)
    out = ["doc_id", "n_features", "weight", "score"]
    n = rows.count()
    wanted = percent * n // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*out, unranked)
    low, high, above = bracket(rows, "score", wanted, n)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    within = rows.where(F.col("score").between(low, high))
    place = F.lit(above + 1) + F.col("before")
    ranked = prefix_sums(within, order, before=F.lit(1)).withColumn("rank", place).drop("before")
    drawn = ranked.where(F.col("rank") <= wanted)
    sure = prefix_sums(rows.where(F.col("score") > high), order, before=F.lit(1))
    sure = sure.withColumn("rank", F.col("before") + 1).drop("before")
    left = ranked.where(F.col("rank") > wanted).withColumn("rank", unranked)
    rest = scored.where((F.col("n_words") < least_words) | (F.col("score") < low)).withColumn("rank", unranked)
    parts = [p.select(*out, "rank") for p in (drawn, sure, left, rest)]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])
