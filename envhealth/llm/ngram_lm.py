"""Language-model scores from a word bigram model in sharded Elias-Fano tries.

Documents become blocks of tokens with a vocabulary of their own. Counts are never brought to one
place: blocks send their words, and their distinct word pairs, to shards; a shard adds up
what the training documents of all blocks sent, and answers each block in the order it asked.
A pair shard keeps its counts as a trie: contexts and pointers as Elias-Fano sequences, the
successors of each context as one run of an Elias-Fano sequence, and a quantised value for each.
The probability after a context is (count + PRIOR * p1) / (context count + PRIOR), where p1 is
the smoothed probability of the word alone.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import floor, log2
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import saved, shuffle_tasks, small_batches
from .words import NOT_SPACE, find_words, mixed, pieces

#: Weight of the word's own probability, in occurrences of the context.
PRIOR = 100.0
#: Bytes of text in a block, and entries that one shard gets, about.
BLOCK_BYTES, SHARD_ENTRIES = 8 << 20, 1_000_000
#: Quantisation steps per doubling of a count.
STEPS = 1024
#: Hash of the token that ends each document; words are hashed to 64 bits.
END = np.uint64(0x452821E638D01377)
#: Bits of a word's hash within pairs.
PAIR_BITS = 48

_ONE = np.uint64(1)


def packed(values: np.ndarray, width: int) -> bytes:
    """Compressed bytes of unsigned values, the like bytes of all values together."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return zstandard.ZstdCompressor(level=1).compress(raw.tobytes())


def unpacked(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view("<u8")


# Elias-Fano sequences


def _bits_at(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    out = words[word] >> shift
    over = shift + np.uint64(width) > np.uint64(64)
    out[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
    return out & ((_ONE << np.uint64(width)) - _ONE)


@dataclass
class EliasFano:
    """A rising sequence: low bits packed, high parts as ones in a bit vector with a rank directory."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        width = max(0, floor(log2((int(values[-1]) + 1) / n))) if n else 0
        low = np.zeros(n * width // 64 + 2, np.uint64)
        at = np.arange(n) * width
        bits = values & ((_ONE << np.uint64(width)) - _ONE)
        shift = (at & 63).astype(np.uint64)
        np.bitwise_or.at(low, at >> 6, bits << shift)
        over = shift + np.uint64(width) > np.uint64(64)
        np.bitwise_or.at(low, (at[over] >> 6) + 1, bits[over] >> (np.uint64(64) - shift[over]))
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) if n else 0) // 64 + 1, np.uint64)
        np.bitwise_or.at(high, ones >> 6, _ONE << (ones & 63).astype(np.uint64))
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(n, width, low, high, ranks)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places i."""
        word = np.searchsorted(self.ranks, i, "right") - 1
        left = (i - self.ranks[word]).astype(np.uint8)
        x, at = self.high[word], word << 6
        for half in (32, 16, 8, 4, 2, 1):  # finds the wanted one within its word
            ones = np.bitwise_count(x & ((_ONE << np.uint64(half)) - _ONE))
            up = left >= ones
            left = np.where(up, left - ones, left)
            x = np.where(up, x >> np.uint64(half), x)
            at = at + np.where(up, half, 0)
        return (at - i).astype(np.uint64) << np.uint64(self.width) | _bits_at(self.low, i * self.width, self.width)

    def successor(self, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """First place in low <= i < high with a value of at least `wanted`, else high."""
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = self.get(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        return low

    def files(self, path: Path, name: str) -> None:
        for part in ("low", "high", "ranks"):
            np.save(path / f"{name}-{part}.npy", getattr(self, part))

    def mapped(self, path: Path, name: str) -> EliasFano:
        """The same sequence, read from memory-mapped files."""
        return EliasFano(self.n, self.width, *(np.load(path / f"{name}-{p}.npy", mmap_mode="r") for p in ("low", "high", "ranks")))


@dataclass
class PairTrie:
    """Word pairs of one shard and their quantised counts, in memory-mapped levels."""

    contexts: EliasFano
    words: EliasFano
    pointers: EliasFano
    offsets: EliasFano  # what each context's successors are raised by, to rise throughout
    successors: EliasFano
    codes: np.ndarray

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, count: np.ndarray, path: Path) -> PairTrie:
        """From pairs in any order, repeats to be added up, into files below `path`."""
        order = np.lexsort((word, context))
        context, word, count = context[order], word[order], count[order]
        new = np.ones(len(context), bool)
        new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
        total = np.add.reduceat(count, np.flatnonzero(new)) if len(count) else count
        contexts, starts = np.unique(context[new], return_index=True)
        words, number = np.unique(word[new], return_inverse=True)
        owner = np.repeat(np.arange(len(contexts)), np.diff(np.append(starts, len(total))))
        lasts = number[np.append(starts[1:], len(total)) - 1] + 1 if len(total) else number
        raised = np.cumsum(lasts) - lasts
        codes = np.round(np.log2(np.maximum(total, 1)) * STEPS).astype(np.uint16) + np.uint16(1)
        np.save(path / "codes.npy", codes)
        levels = {
            "contexts": contexts, "words": words, "pointers": np.append(starts, len(total)),
            "offsets": raised, "successors": number + raised[owner],
        }
        made = {}
        for name, values in levels.items():
            sequence = EliasFano.of(np.asarray(values))
            sequence.files(path, name)
            made[name] = sequence.mapped(path, name)
        return cls(**made, codes=np.load(path / "codes.npy", mmap_mode="r"))

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each asked pair; 0 for one that is not there."""
        out = np.zeros(len(context), np.uint16)
        asked, back = np.unique(context, return_inverse=True)
        everywhere = np.zeros(len(asked), np.int64), np.full(len(asked), self.contexts.n)
        place, known = self._placed(self.contexts, asked, *everywhere)
        asked_words, word_back = np.unique(word, return_inverse=True)
        everywhere = np.zeros(len(asked_words), np.int64), np.full(len(asked_words), self.words.n)
        number, word_known = self._placed(self.words, asked_words, *everywhere)
        rows = np.flatnonzero(known[back] & word_known[word_back])
        if not len(rows):
            return out
        c = place[back[rows]]
        low, high = (self.pointers.get(c + k).astype(np.int64) for k in (0, 1))
        wanted = self.offsets.get(c) + number[word_back[rows]].astype(np.uint64)
        at, found = self._placed(self.successors, wanted, low, high)
        out[rows[found]] = self.codes[at[found]]
        return out

    @staticmethod
    def _placed(sequence: EliasFano, wanted: np.ndarray, low: np.ndarray, high: np.ndarray):
        at = sequence.successor(low, high, wanted)
        found = at < high
        found[found] = sequence.get(at[found]) == wanted[found]
        return at, found


# Blocks, shards and answers


def _blocks(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        for texts in pieces(batch.column(1), size=BLOCK_BYTES):
            words = find_words(texts, NOT_SPACE)
            n = len(texts.offsets) - 1
            tokens = np.insert(words.hashes, words.bounds[1:], END)
            lengths = np.diff(words.bounds) + 1
            mine = held[texts.first : texts.first + n]
            vocabulary, ids = np.unique(tokens, return_inverse=True)
            counts = np.bincount(ids, np.repeat(~mine, lengths), len(vocabulary))
            columns = [
                pa.array([batch.column(0).slice(texts.first, n).to_pylist()], pa.list_(id_type)),
                pa.array([mine.tolist()], pa.list_(pa.bool_())),
                *[pa.array([x], pa.binary()) for x in (packed(lengths, 4), packed(vocabulary, 8), packed(counts, 4), packed(ids, 4))],
                *[pa.array([x], pa.int64()) for x in (len(tokens), len(vocabulary))],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "held", "lengths", "vocabulary", "counts", "tokens", "n_tokens", "n_words"])


BLOCK = "ids array<{}>, held array<boolean>, lengths binary, vocabulary binary, counts binary, tokens binary, n_tokens long, n_words long"
QUESTION = "block long, shard int, context binary, runs binary, word binary, counts binary"


def word_shards(vocabulary: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of each shard's part of a sorted vocabulary."""
    edges = [np.uint64((i << 64) // shards) for i in range(1, shards)]
    return np.concatenate([[0], np.searchsorted(vocabulary, np.array(edges, np.uint64)), [len(vocabulary)]])


def _word_questions(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, vocabulary, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "vocabulary", "counts")), strict=True):
            words, n = unpacked(vocabulary, 8), unpacked(counts, 4)
            cut = word_shards(words, shards)
            spans = [(s, a, b) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            columns = [
                pa.array([block] * len(spans), pa.int64()), pa.array([s for s, _, _ in spans], pa.int32()),
                pa.array([packed(words[a:b], 8) for _, a, b in spans], pa.binary()),
                pa.array([packed(n[a:b], 4) for _, a, b in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "shard", "word", "counts"])


def _word_answers(questions: pa.Table) -> pa.Table:
    words = [unpacked(w, 8) for w in questions.column("word").to_pylist()]
    counts = np.concatenate([unpacked(c, 4) for c in questions.column("counts").to_pylist()])
    known, back = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(back, counts, len(known))
    ends = np.cumsum([len(w) for w in words])
    n = len(words)
    return pa.table({
        "block": questions.column("block"), "shard": questions.column("shard"),
        "answer": pa.array([packed(total[back[e - len(w) : e]], 6) for w, e in zip(words, ends, strict=True)], pa.binary()),
        "distinct": pa.array([int((total > 0).sum())] + [0] * (n - 1), pa.int64()),
        "train": pa.array([int(total.sum())] + [0] * (n - 1), pa.int64()),
    })


@dataclass
class Pairs:
    """Distinct pairs of neighbours of a block, by shard, then context, then word."""

    previous: np.ndarray
    word: np.ndarray
    shard: np.ndarray
    back: np.ndarray  # place of each token's pair with the token before it; -1 for a first token
    count: np.ndarray


def block_pairs(tokens: np.ndarray, lengths: np.ndarray, held: np.ndarray, vocabulary: np.ndarray, shards: int) -> Pairs:
    first = np.zeros(len(tokens), bool)
    first[np.cumsum(lengths)[:-1]] = True
    first[0] = True
    at = np.flatnonzero(~first)
    size = len(vocabulary)
    pair, back = np.unique(tokens[at - 1].astype(np.int64) * size + tokens[at].astype(np.int64), return_inverse=True)
    trained = np.repeat(~held, lengths)[at]
    count = np.bincount(back, trained, len(pair))
    previous, word = pair // size, pair % size
    # A context's words are spread over 64 shards by their hash, so that none holds a hot one.
    shard = (mixed(vocabulary[previous] ^ (vocabulary[word] >> np.uint64(58))) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    whole = np.full(len(tokens), -1)
    whole[at] = place[back]
    return Pairs(previous[order], word[order], shard[order], whole, count[order])


def _decoded(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    held = np.array(row["held"], bool)
    return unpacked(row["tokens"], 4), unpacked(row["lengths"], 4).astype(np.int64), held, unpacked(row["vocabulary"], 8)


def _pair_questions(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    short = np.uint64(64 - PAIR_BITS)
    for batch in batches:
        for row in batch.to_pylist():
            tokens, lengths, held, vocabulary = _decoded(row)
            pairs = block_pairs(tokens, lengths, held, vocabulary, shards)
            cut = np.flatnonzero(np.diff(pairs.shard, prepend=-1, append=shards))
            out: list[list] = [[] for _ in range(6)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                previous = pairs.previous[a:b]
                runs = np.flatnonzero(np.diff(previous, prepend=-1))
                columns = (
                    row["block"], int(pairs.shard[a]), packed(vocabulary[previous[runs]] >> short, 6),
                    packed(np.diff(np.append(runs, b - a)), 4), packed(vocabulary[pairs.word[a:b]] >> short, 6), packed(pairs.count[a:b], 4),
                )
                for held_column, value in zip(out, columns, strict=True):
                    held_column.append(value)
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "shard", "context", "runs", "word", "counts"])


def _pair_answers(questions: pa.Table) -> pa.Table:
    """Builds the shard's trie from what training documents hold and looks every question up in it."""
    rows = questions.to_pylist()
    contexts = [np.repeat(unpacked(r["context"], 6), unpacked(r["runs"], 4).astype(np.int64)) for r in rows]
    words = [unpacked(r["word"], 6) for r in rows]
    counts = np.concatenate([unpacked(r["counts"], 4) for r in rows])
    context, word = np.concatenate(contexts), np.concatenate(words)
    seen = counts > 0
    with tempfile.TemporaryDirectory() as folder:
        trie = PairTrie.build(context[seen], word[seen], counts[seen], Path(folder))
        codes = trie.find(context, word)
        del trie
    ends = np.cumsum([len(w) for w in words])
    answers = [packed(codes[e - len(w) : e], 2) for w, e in zip(words, ends, strict=True)]
    return pa.table({"block": questions.column("block"), "shard": questions.column("shard"), "answer": pa.array(answers, pa.binary())})


def _scored(blocks: pa.Table, answers: pa.Table, shards: int, train: int, distinct: int, prior: float) -> pa.Table:
    """Scores of one block's documents. `shards` is the number of pair shards."""
    row = blocks.to_pylist()[0]
    tokens, lengths, held, vocabulary = _decoded(row)
    pairs = block_pairs(tokens, lengths, held, vocabulary, shards)
    came = sorted(answers.to_pylist(), key=lambda a: a["shard"])
    count = np.concatenate([unpacked(a["answer"], 6) for a in came if not a["pair"]]).astype(float)
    codes = np.concatenate([np.zeros(0), *[unpacked(a["answer"], 2) for a in came if a["pair"]]])
    alone = (count + 1) / (train + distinct + 1)
    together = np.where(codes > 0, np.exp2((codes - 1) / STEPS), 0)
    after = (together + prior * alone[pairs.word]) / (count[pairs.previous] + prior)
    base = np.log10(alone)[tokens]
    score = base.copy()
    inner = pairs.back >= 0
    score[inner] = np.log10(after)[pairs.back[inner]]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    known = np.add.reduceat((count > 0)[tokens].astype(np.int64), starts)
    return pa.table({
        "doc_id": pa.array(row["ids"], blocks.schema.field("ids").type.value_type), "held_out": pa.array(held),
        "n_tokens": pa.array(lengths), "n_known": pa.array(known), "train_tokens": pa.array([train] * len(lengths), pa.int64()),
        "base_score": pa.array(np.add.reduceat(base, starts)), "score": pa.array(np.add.reduceat(score, starts)),
    })


def score(docs: DataFrame, held_out: Column, prior: float = PRIOR) -> DataFrame:
    """`(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`, one row per document.

    Learns from the rows of `docs(doc_id, text)` for which `held_out` is not true and scores all.
    Tokens are runs without ASCII white space, A-Z in lower case, and one end; `base_score` is
    the add-one model of single tokens, `score` the pair model; both are sums of log10. A first
    token is scored alone. A null or empty text is its end token. Without a training row every
    token has the same probability. Repeated rows count and are scored each; a null doc_id keeps
    its row. Other columns are ignored; no rows, no result rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    small_batches(spark, 8 * BLOCK_BYTES)
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    arrow_id = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    blocks = rows.mapInArrow(partial(_blocks, id_type=arrow_id), BLOCK.format(id_type))
    blocks = saved(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    small_batches(spark)
    n_tokens, n_words = blocks.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    tasks = shuffle_tasks(spark)
    word_tasks, pair_tasks = (max(tasks, (n or 0) // SHARD_ENTRIES) for n in (n_words, n_tokens))
    asked = blocks.select("block", "vocabulary", "counts").mapInArrow(
        partial(_word_questions, shards=word_tasks), "block long, shard int, word binary, counts binary"
    )
    alone = asked.groupBy("shard").applyInArrow(_word_answers, "block long, shard int, answer binary, distinct long, train long")
    alone = saved(alone, "words")
    distinct, train = alone.agg(F.sum("distinct"), F.sum("train")).first()
    pairs = blocks.mapInArrow(partial(_pair_questions, shards=pair_tasks), QUESTION)
    together = pairs.groupBy("shard").applyInArrow(_pair_answers, "block long, shard int, answer binary")
    answers = together.withColumn("pair", F.lit(True)).unionByName(alone.select("block", "shard", "answer", F.lit(False).alias("pair")))
    finish = partial(_scored, shards=pair_tasks, train=train or 0, distinct=distinct or 0, prior=prior)

    def scored(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        return finish(blocks, answers)

    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, schema)
