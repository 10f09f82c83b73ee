"""Language of texts and of the spans of mixed texts.

Every word gets a score in each language from hashed character grams. The script of the word
narrows the languages that it may be in. A Viterbi path over a text's words, with a penalty for
every switch, labels its spans; the language with the most letters is the text's.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import saved, small_batches
from .words import mixed

GRAM, TABLE_BITS, SMOOTHING = 3, 16, 0.3
#: The fit takes about so many texts of each language.
TEXTS_EACH = 3000
SWITCH_PENALTY = 8.0
#: Share of a language's letters from which a script counts as one of its scripts.
SCRIPT_SHARE = 0.01
#: Characters of text that are split together, of a run of a longer text, and scores (words x languages)
#: that are held together. Texts that are labelled together share the steps of the longest one.
PIECE_CHARS, RUN_CHARS, CELLS = 4 << 20, 1 << 20, 8 << 20
#: Longer texts are cut after these. None is a letter, nor bears on how a letter is lower-cased.
_CUT = re.compile(r"[\s,;!?，。、！？]")
UNKNOWN = "und"
#: First code points of ranges with a script number each; fixed values of the Unicode blocks.
#: 0 other, 1 Latin, 2 Greek, 3 Cyrillic, 4 Armenian, 5 Hebrew, 6 Arabic, 7 Devanagari, 8 Bengali,
#: 9 Tamil, 10 Thai, 11 Georgian, 12 Hangul, 13 Kana, 14 Han.
SCRIPT_RANGES = (
    (0x0000, 0), (0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5),
    (0x0600, 6), (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0B80, 9), (0x0C00, 0),
    (0x0E00, 10), (0x0E80, 0), (0x10A0, 11), (0x1100, 12), (0x1200, 0), (0x1E00, 1), (0x1F00, 2),
    (0x2000, 0), (0x3040, 13), (0x3100, 0), (0x3130, 12), (0x3190, 0), (0x3400, 14), (0xA000, 0),
    (0xAC00, 12), (0xD7B0, 0), (0xF900, 14), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0),
    (0x20000, 14), (0x30000, 0),
)
SCRIPTS = 15

_STEP = np.uint64(0x9E3779B97F4A7C15)


@cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)


@dataclass
class Piece:
    """Words (runs of letters) of some texts: grams of each letter, first letters, owners."""

    slots: np.ndarray  # of every letter
    firsts: np.ndarray  # index among letters of each word's first
    sizes: np.ndarray
    scripts: np.ndarray  # of each word
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]


def split_words(texts: list[str]) -> Piece:
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    letter = np.zeros(len(points) + 1, bool)
    letter[:-1] = letter_table()[points]
    before = np.zeros(len(points) + 1, bool)
    before[1:] = letter[:-1]
    before[at] = False
    starts = np.flatnonzero(letter & ~before)
    letters = np.flatnonzero(letter)
    firsts = np.searchsorted(letters, starts)
    sizes = np.diff(np.append(firsts, len(letters)))
    c = points[letters].astype(np.uint64)
    place = np.arange(len(c)) - np.repeat(firsts, sizes)
    code = np.zeros(len(c), np.uint64)
    for k in range(GRAM):  # 0 stands for the start of the word
        back = np.zeros(len(c), np.uint64)
        back[k:] = c[: len(c) - k]
        back[place < k] = 0
        code = code * _STEP + back
    last = np.zeros(len(c), bool)
    last[firsts + sizes - 1] = True
    code += last  # endings differ from the same letters within a word
    slots = (mixed(code) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    edges = np.array([r[0] for r in SCRIPT_RANGES])
    numbers = np.array([r[1] for r in SCRIPT_RANGES])
    scripts = numbers[np.searchsorted(edges, points[starts], "right") - 1]
    return Piece(slots, firsts, sizes, scripts, np.searchsorted(starts, at))


@dataclass
class Model:
    """Log-likelihoods of the slots that a language was seen with, end to end; `rest` is that of any other."""

    languages: list[str]
    slots: np.ndarray
    logs: np.ndarray
    bounds: np.ndarray  # language i has slots[bounds[i]:bounds[i + 1]]
    rest: np.ndarray
    allowed: np.ndarray  # script x language

    def table(self, language: int) -> np.ndarray:
        mine = slice(self.bounds[language], self.bounds[language + 1])
        out = np.full(1 << TABLE_BITS, self.rest[language], np.float32)
        out[self.slots[mine]] = self.logs[mine]
        return out


def piece_chars(languages: int) -> int:
    """Characters whose words, one in two characters at most, have no more than CELLS scores."""
    return max(1 << 12, min(PIECE_CHARS, 2 * CELLS // max(1, languages)))


def _text_pieces(column: pa.Array, size: int) -> Iterator[list[str]]:
    """Runs of texts of about `size` characters; a longer text is a run of its own."""
    held, total = [], 0
    for value in column:
        text = value.as_py() or ""
        if held and total + len(text) > size:
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text)
    if held:
        yield held


def _runs(text: str, size: int) -> Iterator[str]:
    """Parts of about `size` characters that split no word; only a longer word makes a longer part."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + size - 1)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def _counted(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    """Letter counts by language and slot; slots from the table's end on count scripts."""
    number = {name: i for i, name in enumerate(languages)}
    width = (1 << TABLE_BITS) + SCRIPTS
    for batch in batches:
        names = [number[n] for n in batch.column(1).to_pylist()]
        done = 0
        for texts in _text_pieces(batch.column(0), PIECE_CHARS):
            mine = np.array(names[done : done + len(texts)], np.int64)
            done += len(texts)
            parts = [[t] for t in _runs(texts[0], RUN_CHARS)] if len(texts) == 1 else [texts]
            for part in parts:
                piece = split_words(part)
                owner = np.repeat(mine, np.diff(piece.bounds)) * width
                grams, n = np.unique(np.repeat(owner, piece.sizes) + piece.slots, return_counts=True)
                scripts, back = np.unique(owner + (1 << TABLE_BITS) + piece.scripts, return_inverse=True)
                letters = np.bincount(back, piece.sizes, len(scripts)).astype(np.int64)
                cell, n = np.concatenate([grams, scripts]), np.concatenate([n, letters])
                columns = [pa.array((cell // width).astype(np.int32)), pa.array((cell % width).astype(np.int32)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "slot", "n"])


def train(labelled: DataFrame) -> Model:
    """A model from `labelled(doc_id, text, lang)`, on about TEXTS_EACH texts of each language.

    Every lang value is learned; rows without one are left out. The texts are chosen by a hash of
    doc_id. The model holds what these texts show: 6 bytes for each slot that a language was seen
    with, at most TABLE_BITS of them, so it grows with the languages and not with the rows.
    """
    small_batches(labelled.sparkSession)
    labelled = labelled.where("lang is not null").select("doc_id", "text", "lang")
    sizes = saved(labelled.groupBy("lang").agg(F.count("*").alias("texts")), "languages")
    languages = sorted(r[0] for r in sizes.select("lang").toLocalIterator())
    width = 1 << TABLE_BITS
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.join(sizes, "lang").where(draw < TEXTS_EACH / F.col("texts"))
    made = sample.select("text", "lang").mapInArrow(partial(_counted, languages=languages), "lang int, slot int, n long")
    found = made.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    lang, slot, n = (found.column(i).to_numpy() for i in range(3))
    order = np.lexsort((slot, lang))
    lang, slot, n = lang[order], slot[order], n[order].astype(np.float64)
    k, gram = len(languages), slot < width
    scripts = np.zeros((k, SCRIPTS))
    scripts[lang[~gram], slot[~gram] - width] = n[~gram]
    shares = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    lang, slot, n = lang[gram], slot[gram], n[gram] + SMOOTHING
    total = np.bincount(lang, n - SMOOTHING, k) + SMOOTHING * width
    logs = np.log(n / total[lang]).astype(np.float32)
    rest = np.log(SMOOTHING / total).astype(np.float32)
    bounds = np.searchsorted(lang, np.arange(k + 1))
    return Model(languages, slot.astype(np.uint16), logs, bounds, rest, shares.T >= SCRIPT_SHARE)


def word_scores(piece: Piece, model: Model) -> np.ndarray:
    """Log-likelihood of each word in each language, less its best; languages of other scripts lose.

    A word in a script that no language uses is the same to all.
    """
    n = len(piece.firsts)
    scores = np.zeros((n, len(model.languages)), np.float32)
    if not n:
        return scores
    for i in range(len(model.languages)):  # one table is laid out at a time
        scores[:, i] = np.add.reduceat(model.table(i)[piece.slots], piece.firsts)
    scores -= scores.max(axis=1, keepdims=True)
    allowed = model.allowed[piece.scripts]
    some = allowed.any(axis=1, keepdims=True)
    return np.where(some, np.where(allowed, scores, scores - 50.0), 0.0).astype(np.float32)


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Language number of each word on the best path of its text; all texts advance together."""
    n, k = scores.shape
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    firsts, sizes = bounds[:-1][order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right") if len(sizes) else []
    stays = np.ones((n, k), bool)  # whether the best path into a state comes from the same state
    from_best = np.zeros(n, np.int32)
    best = np.zeros((len(sizes), k), np.float32)
    for t, m in enumerate(active):
        at = firsts[:m] + t
        if t:
            top = best[:m].argmax(axis=1)
            switch = best[np.arange(m), top] - penalty
            stay = best[:m] >= switch[:, None]
            stays[at], from_best[at] = stay, top
            best[:m] = np.where(stay, best[:m], switch[:, None]) + scores[at]
        else:
            best[:m] = scores[at]
    path = np.zeros(n, np.int32)
    state = np.zeros(len(sizes), np.int32)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = firsts[:m] + t
        ends = sizes[:m] == t + 1
        now = np.where(ends, best[:m].argmax(axis=1), state[:m]).astype(np.int32)
        path[at] = now
        state[:m] = np.where(stays[at, now], now, from_best[at])
    return path


def viterbi_in_runs(runs: Iterator[np.ndarray], k: int, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The path of `viterbi` for one text whose scores come in runs of words, and are not held.

    Back pointers stay: a bit for each word and language, and the best language before each word.
    """
    best: np.ndarray | None = None
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for scores in runs:
        stays, from_best = np.ones(scores.shape, bool), np.zeros(len(scores), np.int32)
        for t, score in enumerate(scores):
            if best is None:
                best = score.copy()
                continue
            top = best.argmax()
            switch = best[top] - np.float32(penalty)
            np.greater_equal(best, switch, out=stays[t])
            from_best[t] = top
            best = np.maximum(best, switch) + score
        kept.append((np.packbits(stays, axis=1), from_best))
    paths, state = [], int(best.argmax()) if best is not None else 0
    while kept:
        packed, from_best = kept.pop()
        stays = np.unpackbits(packed, axis=1, count=k)
        path = np.empty(len(from_best), np.int32)
        for t in range(len(path) - 1, -1, -1):
            path[t] = state
            if not stays[t, state]:
                state = int(from_best[t])
        paths.append(path)
    return np.concatenate(paths[::-1]) if paths else np.zeros(0, np.int32)


def _spans(path: np.ndarray, languages: list[str]) -> list[dict]:
    edge = np.flatnonzero(np.diff(path, prepend=-1, append=-1)) if len(path) else np.zeros(1, np.int64)
    runs = zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)
    return [{"lang": languages[path[a]], "first": a, "words": b - a} for a, b in runs]


def label_text(text: str, model: Model, size: int) -> tuple[str, float, list[dict]]:
    """`label` of one text in runs of about `size` characters; what is held of all is a few bytes a word."""
    k = len(model.languages)
    sizes: list[np.ndarray] = []

    def scored() -> Iterator[np.ndarray]:
        for part in _runs(text, size):
            piece = split_words([part])
            sizes.append(piece.sizes.astype(np.int32))
            yield word_scores(piece, model)

    path = viterbi_in_runs(scored(), k)
    letters = np.bincount(path, np.concatenate(sizes), k) if len(path) else np.zeros(k)
    total = letters.sum()
    name = model.languages[int(letters.argmax())] if total else UNKNOWN
    return name, float(letters.max() / max(1, total)), _spans(path, model.languages)


def label(piece: Piece, model: Model) -> tuple[list[str], list[float], list[list[dict]]]:
    """Language, its share of the letters, and spans of words in one language, of each text."""
    texts = len(piece.bounds) - 1
    k = len(model.languages)
    path = viterbi(word_scores(piece, model), piece.bounds)
    owner = np.repeat(np.arange(texts), np.diff(piece.bounds))
    letters = np.bincount(owner * k + path, piece.sizes, texts * k).reshape(texts, k)
    top, total = letters.argmax(axis=1), letters.sum(axis=1)
    share = letters.max(axis=1) / np.maximum(1, total)
    names = [model.languages[i] if total[t] else UNKNOWN for t, i in enumerate(top)]
    cuts = zip(piece.bounds[:-1].tolist(), piece.bounds[1:].tolist(), strict=True)
    return names, share.tolist(), [_spans(path[a:b], model.languages) for a, b in cuts]


def _labelled(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
    known, size = model.value, piece_chars(len(model.value.languages))
    for batch in batches:
        names, shares, spans = [], [], []
        for texts in _text_pieces(batch.column(1), size):
            if not known.languages:
                found = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
            elif len(texts) == 1 and len(texts[0]) > size:
                found = tuple([x] for x in label_text(texts[0], known, min(size, RUN_CHARS)))
            else:
                found = label(split_words(texts), known)
            for held, more in zip((names, shares, spans), found, strict=True):
                held += more
        columns = [batch.column(0), pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, span)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "spans"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`(doc_id, lang_pred, score, spans)`, one row per row of `docs(doc_id, text)`.

    `spans` are runs of words (runs of letters, counted from 0) in one language, `score` is the
    predicted language's share of the letters. A null text, an empty one, and one without a
    letter is `und` with score 0 and no span; so is every text if nothing was learned. Languages
    that tie go in alphabetical order. A very long text is scored in runs of words with its path
    carried over; memory follows the longest word, not the text. Other columns are ignored; no
    rows, no result rows.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, lang_pred string, score double, spans array<struct<lang:string,first:int,words:int>>"
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(partial(_labelled, model=shared), schema)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
