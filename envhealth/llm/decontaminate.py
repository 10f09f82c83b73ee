"""Benchmark passages in documents, found by winnowing.

Of every run of `SPAN - GRAM + 1` consecutive word grams the one with the least hash is kept, in
documents and benchmark items alike. Two equal spans of SPAN words keep the same gram, so every
shared span meets in a join on the kept hashes; each hit is then extended word by word.
Items shorter than SPAN are grams of their own length, at every position.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import saved, small_batches
from .words import ALNUM, Texts, Words, find_words, gram_fits, gram_hashes, pieces

SPAN, GRAM = 13, 7
#: A document is contaminated when at least one word in so many is hit.
ONE_IN = 20
#: Bits of the filter of benchmark hashes: 16 for each hash, 32 MiB at most. Beyond that it
#: lets more documents' hashes through to the join, which decides in any case.
FILTER_BITS_EACH, MOST_FILTER_BITS = 16, 1 << 28

_AS_WORDS = bytes(i if ALNUM[i] else 0x20 for i in range(256))


def winnowed(words: Words, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of grams that are least in some span; equal ones are all kept."""
    hashes = gram_hashes(words.hashes, gram)
    window = span - gram + 1
    starts = np.flatnonzero(gram_fits(words.bounds, len(words.hashes), span))
    if not len(starts):
        return starts, hashes[:0]
    least = hashes[starts]
    for j in range(1, window):
        np.minimum(least, hashes[starts + j], out=least)
    kept = np.zeros(len(hashes), bool)
    for j in range(window):
        kept[starts[hashes[starts + j] == least] + j] = True
    at = np.flatnonzero(kept)
    return at, hashes[at]


def every_gram(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    hashes = gram_hashes(words.hashes, n)
    at = np.flatnonzero(gram_fits(words.bounds, len(words.hashes), n))
    return at, hashes[at]


def _with_length(hashes: np.ndarray, n: int) -> np.ndarray:
    return hashes ^ np.uint64(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def _context(texts: Texts, words: Words, text: int, at: int, n: int, around: int) -> tuple[int, int, str]:
    """Position within the text, words before the gram, and the gram with `around` words either side."""
    low, high = words.bounds[text], words.bounds[text + 1]
    i, j = max(low, at - around), min(high, at + n + around)
    raw = texts.data[words.starts[i] : words.ends[j - 1]].tobytes()
    return int(at - low), int(at - i), raw.translate(_AS_WORDS).decode().strip(" ")


GRAM_FIELDS = [("pos", pa.int32()), ("n", pa.int32()), ("hash", pa.int64()), ("before", pa.int32()), ("words", pa.string())]
GRAM_TYPE = "array<struct<pos:int,n:int,hash:long,before:int,words:string>>"


def _grams(batches, key: str, short: list[int] | None, bitmap, span: int, gram: int):
    """Rows `(key, n_words, grams)`. `short` is None for items: their own length, if below span."""
    for batch in batches:
        counts, found = [], []
        for texts in pieces(batch.column(1)):
            words = find_words(texts, ALNUM)
            sizes = np.diff(words.bounds)
            counts += sizes.tolist()
            per_text: list[list] = [[] for _ in sizes]
            kinds = [(gram, *winnowed(words, span, gram))]
            for n in range(1, span) if short is None else short:
                kinds.append((n, *every_gram(words, n)))
            for k, (n, at, hashes) in enumerate(kinds):
                hashes = _with_length(hashes, n if k else 0)
                owner = np.searchsorted(words.bounds, at, "right") - 1
                if bitmap is not None and len(at):
                    bits = np.frombuffer(bitmap.value, np.uint8)
                    slot = hashes >> np.uint64(64 - int(log2(len(bits) * 8)))
                    keep = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
                    at, hashes, owner = (x[keep == 1] for x in (at, hashes, owner))
                if k and short is None:
                    whole = sizes[owner] == n
                    at, hashes, owner = at[whole], hashes[whole], owner[whole]
                for t, i, h in zip(owner.tolist(), at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    pos, before, text = _context(texts, words, t, i, n, span - n)
                    per_text[t].append((pos, n if k else 0, h, before, text))
            found += per_text
        rows = pa.array(
            [[dict(zip(("pos", "n", "hash", "before", "words"), g, strict=True)) for g in gs] for gs in found],
            pa.list_(pa.struct(GRAM_FIELDS)),
        )
        names = [key, "n_words", "grams"]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), rows], names=names)


def _filter(hashes: DataFrame) -> bytes:
    """One bit per hash prefix, built in blocks by the executors; its size is bounded."""
    n = hashes.count()
    bits = min(MOST_FILTER_BITS, 1 << max(15, ceil(log2(max(1, n * FILTER_BITS_EACH)))))
    slots = hashes.select(F.shiftrightunsigned("hash", 64 - int(log2(bits))).alias("slot"))

    def block(table: pa.Table) -> pa.Table:
        on = np.zeros(1 << 15, np.uint8)
        on[table.column("slot").to_numpy() & ((1 << 15) - 1)] = 1
        number = table.column("block")[0].as_py()
        return pa.table({"block": [number], "bits": [np.packbits(on, bitorder="little").tobytes()]})

    made = slots.distinct().withColumn("block", F.shiftright("slot", 15)).groupBy("block")
    out = bytearray(bits // 8)
    for number, packed in made.applyInArrow(block, "block long, bits binary").toLocalIterator():
        out[number * 4096 : number * 4096 + 4096] = packed
    return bytes(out)


def _extended(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Rows `(row, passage, lo, hi)`: document words that are shared with the passage around a hit."""
    for batch in batches:
        row, pos, n, before, words, passage, item_before, item_words = (c.to_pylist() for c in batch.columns)
        out: list[tuple] = []
        for r, p, short, i, text, it, j, other in zip(row, pos, n, before, words, passage, item_before, item_words, strict=True):
            # Words hold no ASCII space, but may hold any other kind.
            x, y = ([w for w in t.split(" ") if w] for t in (text, other))
            size = short or GRAM
            if x[i : i + size] != y[j : j + size]:
                continue
            left = right = 0
            if not short:
                while left < min(i, j) and x[i - left - 1] == y[j - left - 1]:
                    left += 1
                end, stop = i + size, j + size
                while end + right < len(x) and stop + right < len(y) and x[end + right] == y[stop + right]:
                    right += 1
                if left + size + right < span:
                    continue
            out.append((r, it, p - left, p + size + right))
        names, at = ["row", "passage", "lo", "hi"], list(zip(*out, strict=True)) or [[]] * 4
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(at, types, strict=True)], names=names)


def _lists(per_doc: DataFrame, items: DataFrame, passages: DataFrame) -> DataFrame:
    """`(passages, n_items, list)`: the items of each distinct set of passages that some document hit.

    Documents with the same set share its list, however many items hold its passages.
    """
    named = items.where("item_id is not null").select("hash", "n", "before", "words", F.col("item_id").cast("string").alias("item"))
    holders = named.join(passages, ["hash", "n", "before", "words"]).select("passage", "item").distinct()
    numbered = per_doc.select("passages").distinct().withColumn("set", F.monotonically_increasing_id())
    sets = saved(numbered, "sets")
    each = sets.select("set", F.explode("passages").alias("passage")).join(holders, "passage")
    listed = each.groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    listed = listed.select("set", F.size("items").cast("long").alias("n_items"), F.concat_ws(",", "items").alias("list"))
    return sets.join(listed, "set").drop("set")


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Benchmark words in `docs(doc_id, text)` by items of `benchmark(item_id, text)`.

    Returns `(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`, one row per document,
    repeated rows each for themselves. Words are runs of 0-9, a-z (A-Z lower-cased) and anything
    beyond ASCII. A word is hit if some `span` consecutive words around it occur in an item, or
    all words of a shorter item. Null and empty texts have no words and are not contaminated;
    an item without words matches nothing. An item whose item_id is null hits words but is not
    counted or listed; items that share an id count once. An empty benchmark hits nothing; no
    documents, no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    own = partial(_grams, key="item_id", short=None, bitmap=None, span=span, gram=gram)
    items = benchmark.select("item_id", "text").mapInArrow(own, f"item_id {item_type}, n_words long, grams {GRAM_TYPE}")
    items = saved(items.select("item_id", "n_words", F.inline("grams")), "items")
    short = sorted(r[0] for r in items.where("n > 0").select("n").distinct().collect())
    bitmap = spark.sparkContext.broadcast(_filter(items.select("hash").distinct()))
    each = partial(_grams, key="doc_id", short=short, bitmap=bitmap, span=span, gram=gram)
    found = docs.select("doc_id", "text").mapInArrow(each, f"doc_id {doc_type}, n_words long, grams {GRAM_TYPE}")
    found = saved(found.withColumn("row", F.monotonically_increasing_id()), "grams")
    # Items that share a passage (a hash and the words around it) are extended once, as one.
    where = ["hash", "n", "before", "words"]
    passages = items.groupBy(*where).agg(F.count("*").alias("items"))
    passages = saved(passages.select(*where, F.monotonically_increasing_id().alias("passage")), "passages")
    hits = found.select("row", F.inline("grams")).join(
        passages.select("hash", "passage", F.col("before").alias("item_before"), F.col("words").alias("item_words")), "hash"
    )
    columns = ["row", "pos", "n", "before", "words", "passage", "item_before", "item_words"]
    spans = hits.select(*columns).mapInArrow(partial(_extended, span=span), "row long, passage long, lo int, hi int")
    per_doc = spans.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"),
        F.array_sort(F.collect_set("passage")).alias("passages"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["hi"] - F.greatest(x["lo"], s["end"]), F.lit(0))).alias("n"),
            F.greatest(s["end"], x["hi"]).alias("end"),
        ),
        lambda s: s["n"].cast("long"),
    )
    per_doc = saved(per_doc.select("row", covered.alias("n_hit"), "passages"), "hits")
    lists = _lists(per_doc, items, passages)
    per_doc = per_doc.join(lists, "passages", "left").drop("passages")
    joined = found.select("row", "doc_id", "n_words").join(per_doc, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (ONE_IN * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
