"""SimHash near-duplicates by the general pigeonhole principle.

Fingerprints that differ in at most `max_bits` bits are linked. The bits are grouped into
parts; part i gets a threshold t_i with sum(t_i + 1) = max_bits + 1, so that any linked pair
differs in at most t_i bits of some part i. Such pairs share the part's value with some t_i of
its bits masked out, which is what the probes are. Parts hold correlated bits and thresholds
come from dynamic programming over estimated candidate counts; both only steer cost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import saved, shuffle_tasks, small_batches
from .words import mixed

BITS = 64
SEED = 42
#: Fingerprints that the plan is estimated from. The links found do not depend on it.
SAMPLE = 1500
#: Relative cost of writing, moving and sorting a probe, and of comparing two fingerprints.
PROBE_COST, COMPARE_COST = 1.0, 0.002
#: Shingles hashed together.
RUN = 1 << 16
#: Groups up to this size are compared by shifting; larger ones around leaders.
SMALL_GROUP = 64

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(words: list[bytes], size: int) -> int:
    """Bits that are set in over half of the hashes of all `size`-word shingles; none: 0."""
    total = max(1, len(words) - size + 1) if words else 0
    counts = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for i in range(0, total, RUN):
        run = words[i : i + RUN + size - 1]
        text = b" ".join(run)
        ends = np.cumsum([len(w) + 1 for w in run]) - 1
        n = max(1, len(run) - size + 1)
        starts = [0, *(ends[: n - 1] + 1).tolist()]
        stops = ends[size - 1 :].tolist() if len(run) >= size else [len(text)]
        hashes = [hashed(text[s:e], SEED) for s, e in zip(starts, stops, strict=True)]
        octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        for j in range(8):
            counts[8 * j : 8 * j + 8] += np.bincount(octets[:, j], minlength=256) @ _BYTE_BITS
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > total))


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """`(doc_id, fp)` with the fingerprint as a signed 64-bit value; one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()) if batch.num_rows else []
            found = [fingerprint((t.as_py() or b"").lower().split(), size) for t in texts]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, fp long")


def parts_of_bits(sample: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m groups of about equal size, correlated bits together."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    bits -= bits.mean(axis=0) if len(bits) else 0
    norm = np.sqrt((bits**2).sum(axis=0)) + 1e-9
    likeness = np.abs(bits.T @ bits) / norm / norm[:, None]
    free, parts = set(range(BITS)), []
    for k in range(m):
        wanted = (BITS - sum(map(len, parts))) // (m - k)
        part = [max(sorted(free), key=lambda i: likeness[i, sorted(free)].sum())]
        free -= set(part)
        while len(part) < wanted:
            part.append(max(sorted(free), key=lambda i: likeness[i, part].sum()))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def part_mask(bits: list[int] | tuple[int, ...]) -> int:
    return sum(1 << i for i in bits)


def part_costs(sample: np.ndarray, part: list[int], n: int, most: int, pairs: float) -> list[float]:
    """Estimated cost of thresholds -1, 0, ... most for one part among n fingerprints."""
    own = sample & np.uint64(part_mask(part))
    seen = np.zeros(len(part) + 1)
    for i in range(len(own) - 1):
        seen += np.bincount(np.bitwise_count(own[i] ^ own[i + 1 :]), minlength=len(part) + 1)
    seen /= max(1, seen.sum())
    chance = np.ones(1)  # of each distance, if bits were independent
    for i in part:
        one = float(((own >> np.uint64(i)) & np.uint64(1)).mean()) if len(own) else 0.5
        chance = np.convolve(chance, [one**2 + (1 - one) ** 2, 2 * one * (1 - one)])
    likely = np.maximum(seen, chance)
    costs = [0.0]
    for t in range(most + 1):
        meet = sum(likely[d] * comb(len(part) - d, t - d) for d in range(min(t, len(part)) + 1))
        costs.append(PROBE_COST * n * comb(len(part), t) + COMPARE_COST * pairs * meet)
    return costs


def probe_masks(sample: np.ndarray, n: int, max_bits: int) -> list[int]:
    """Masks under which any two of n fingerprints within `max_bits` bits agree at least once."""
    best: tuple[float, list[int]] | None = None
    for m in range(1, min(max_bits + 1, 6) + 1):
        parts = parts_of_bits(sample, m)
        most = min(max_bits, 3)
        # plans[s]: cheapest cost and thresholds of the parts so far with sum(t + 1) = s
        plans: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for part in parts:
            costs, nxt = part_costs(sample, part, n, most, n * n / 2), {}
            for s, (cost, chosen) in plans.items():
                for t in range(-1, most + 1):
                    total = (cost + costs[t + 1], [*chosen, t])
                    if s + t + 1 <= max_bits + 1 and total < nxt.get(s + t + 1, (np.inf,)):
                        nxt[s + t + 1] = total
            plans = nxt
        if (plan := plans.get(max_bits + 1)) and (best is None or plan[0] < best[0]):
            masks = [
                part_mask(part) & ~part_mask(dropped)
                for part, t in zip(parts, plan[1], strict=True)
                if t >= 0
                for dropped in combinations(part, t)
            ]
            best = (plan[0], masks)
    assert best is not None, "max_bits is too large for 6 parts"
    return best[1]


def near_pairs(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all of `values` (distinct) that are connected within `max_bits`.

    Values around a leader link to it. Any other value that is near one of them lies within
    twice the distance of the leader, so only those are compared further, each until one
    link is found: a dense group costs about its size, and gives about as many links.
    """
    left = values
    a, b = [], []
    while len(left) > 1:
        leader, left = left[0], left[1:]
        away = np.bitwise_count(left ^ leader)
        close, ring = left[away <= max_bits], left[(away > max_bits) & (away <= 2 * max_bits)]
        a.append(np.full(len(close), leader)), b.append(close)
        for i in range(0, len(close), 256):
            if not len(ring):
                break
            hit = np.bitwise_count(ring[:, None] ^ close[i : i + 256]) <= max_bits
            any_hit = hit.any(axis=1)
            a.append(close[i + hit[any_hit].argmax(axis=1)]), b.append(ring[any_hit])
            ring = ring[~any_hit]
        left = left[away > max_bits]
    none = np.zeros(0, values.dtype)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _linked(max_bits: int):
    def groups(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        sizes = np.diff(edge)
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        small = np.repeat(sizes <= SMALL_GROUP, sizes)
        k, v = keys[small], values[small]
        for shift in range(1, min(SMALL_GROUP, int(sizes[sizes <= SMALL_GROUP].max(initial=1)))):
            same = k[shift:] == k[:-shift]
            near = same & (np.bitwise_count(v[shift:] ^ v[:-shift]) <= max_bits)
            a.append(v[:-shift][near]), b.append(v[shift:][near])
        for g in np.flatnonzero(sizes > SMALL_GROUP):
            x, y = near_pairs(values[edge[g] : edge[g + 1]], max_bits)
            a.append(x), b.append(y)
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [], []

        def flush(whole: bool):
            k, v = np.concatenate(keys), np.concatenate(values)
            stop = len(k) if whole else int(np.searchsorted(k, k[-1]))
            keys[:], values[:] = [k[stop:]], [v[stop:]]
            if stop:
                a, b = groups(k[:stop], v[:stop])
                if len(a):
                    links = [pa.array(x.view(np.int64)) for x in (a, b)]
                    yield pa.RecordBatch.from_arrays(links, names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                keys.append(batch.column(0).to_numpy())
                values.append(batch.column(1).to_numpy().view(np.uint64))
                if keys[-1][0] != keys[-1][-1]:  # else the group goes on
                    yield from flush(False)
        if keys:
            yield from flush(True)

    return run


def _probes(masks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for mask in masks:
                key = mixed(mixed(fp & np.uint64(mask)) ^ np.uint64(mask)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], names=["key", "fp"])

    return run


def near_links(values: DataFrame, max_bits: int) -> DataFrame:
    """Links `(a, b)` between values of `values(fp)`, all distinct, that connect what is within `max_bits`.

    One task sees the distinct values under one probe, eight bytes each; equal fingerprints of
    any number of documents are one value, and no group's pairs are written out.
    """
    spark = values.sparkSession
    n = values.count()
    rows = values.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    masks = probe_masks(sample, n, max_bits)
    probes = values.select("fp").mapInArrow(_probes(masks), "key long, fp long")
    grouped = probes.repartition(shuffle_tasks(spark), "key").sortWithinPartitions("key", "fp")
    return grouped.mapInArrow(_linked(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 4, max_bits: int = 4) -> DataFrame:
    """`(doc_id, fingerprint, component_id)`, one row per document of `docs(doc_id, text)`.

    `component_id` is the smallest doc_id reachable over fingerprints that differ in at most
    `max_bits` bits. A null or empty text, and one of white space only, has fingerprint zero and
    links like any other; a text of fewer words than `size` is one shingle. Repeated rows each
    keep their row. A null doc_id keeps its row and never becomes a component_id unless all
    ids of the component are null. Other columns are ignored; no rows, no result rows.
    """
    found = saved(fingerprints(docs, size), "fingerprints")
    values = found.groupBy("fp").agg(F.min("doc_id").alias("first"))
    links = near_links(values.select("fp"), max_bits)
    rooted = values.join(components(links).withColumnRenamed("node", "fp"), "fp", "left")
    rooted = saved(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return found.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
