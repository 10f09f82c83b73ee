"""Each operator against a brute-force version, and on odd and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from envhealth.llm import (
    components,
    decontaminate,
    embedding_dedup,
    language,
    mixing,
    ngram_lm,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    url_filter,
    words,
)
from envhealth.llm.hot_keys import join_counted

from .conftest import ODD, WORDS, documents, prose


def split(text):
    return (text or "").encode().lower().split()


# Helpers


def test_words_are_cut_and_hashed_alike_wherever_they_stand():
    texts = ["Ab  cd", None, "", "cd\tab", "é ab " + "x" * 5000]
    found = [words.find_words(t, words.NOT_SPACE) for t in words.pieces(pa.array(texts), size=4)]
    whole = words.find_words(next(words.pieces(pa.array(texts))), words.NOT_SPACE)
    assert np.diff(whole.bounds).tolist() == [2, 0, 0, 2, 3]
    assert np.concatenate([w.hashes for w in found]).tolist() == whole.hashes.tolist()
    ab, cd, cd2, ab2, _, ab3, _ = whole.hashes.tolist()
    assert (ab, cd) == (ab2, cd2) and ab == ab3 != cd


def test_components_follow_chains_hubs_and_loops(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, i) for i in range(1001, 1100)]
    rest = [(5, 5), (7, 6)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    links = chain + hub + rest
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = dict(components.components(spark.createDataFrame(links, "a long, b long").repartition(9)).collect())
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1 mixing


def test_mixing_meets_targets(spark):
    rows = [(i, prose(i, 5 + i % 97), "en", f"s{i % 5 if i % 3 else 0}") for i in range(3000)]
    docs = documents(spark, rows)
    got = mixing.mix(docs).collect()
    again = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(5)).collect()}
    assert len(got) == 3000 and again == {r.doc_id: r.copies for r in got}
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        assert 0 <= r.copies <= 3 and r.size == len(split(rows[r.doc_id][1]))
    weights = {f"s{i}": (1, 2, 3)[i % 3] for i in range(5)}
    level = {s: sum(size.values()) * w / sum(weights.values()) for s, w in weights.items()}
    while any(level[s] > 3 * size[s] + 1e-6 for s in level):
        full = {s for s in level if level[s] >= 3 * size[s]}
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        open_weight = sum(weights[s] for s in weights if s not in full)
        level = {s: 3 * size[s] if s in full else rest * weights[s] / open_weight for s in level}
    for s in level:
        assert target[s] == pytest.approx(level[s])
        assert abs(taken[s] - target[s]) <= 101


def test_pivot_keeps_the_sum_and_the_chances():
    sizes, hits = [5, 9, 3, 20, 1, 7, 7, 2], np.zeros(8)
    for seed in range(4000):
        out = mixing.pivot(sizes, [0.3] * 8, random.Random(seed))
        assert sum(0 < x < 1 for x in out) <= 1
        assert sum(s * x for s, x in zip(sizes, out, strict=True)) == pytest.approx(0.3 * sum(sizes))
        hits += out
    assert np.allclose(hits / 4000, 0.3, atol=0.03)


@pytest.mark.parametrize("run", [7, 1 << 18])
def test_mixing_with_one_id_in_a_third_of_the_rows(spark, monkeypatch, run):
    rows = [(7, prose(1, 11), "en", f"s{i % 2}") for i in range(1500)]
    rows += [(7, prose(i, 5 + i % 60), "en", "s1") for i in range(1500)]
    rows += [(100 + i, prose(i, 5 + i % 60), "en", f"s{i % 3}") for i in range(1500)]
    docs, blocks = documents(spark, rows), spark.sparkContext.accumulator(0)
    plain = mixing.pivot

    def counted(sizes, chances, rand):
        blocks.add(len(sizes))
        return plain(sizes, chances, rand)

    monkeypatch.setattr(mixing, "pivot", counted)
    got = mixing.mix(docs, run=run).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r[0], r[3], len(split(r[1]))) for r in rows)
    assert 0 < blocks.value < 2400  # alike rows meet as one
    assert sorted(got) == sorted(mixing.mix(docs.repartition(3), run=run).collect())
    for source in ("s0", "s1", "s2"):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= 64
        assert {r.copies for r in mine} <= {0, 1, 2, 3}
        alike = [r.copies for r in mine if (r.doc_id, r.size) == (7, 11)]
        assert not alike or max(alike) - min(alike) <= 1


def test_mixing_of_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD)
    assert all(r.copies == 0 for r in got if r.size == 0)
    assert sum(r.target for r in {r.source: r for r in got}.values()) == pytest.approx(sum(r.size for r in got))
    assert mixing.mix(none).count() == 0
    assert {(r.target, r.copies) for r in mixing.mix(odd.where("text = ''")).collect()} == {(0.0, 0)}


# 2 token counts


def test_token_counts(odd, none, tmp_path):
    got = sorted(token_counts.document_tokens(odd, f"{tmp_path}/a").collect(), key=str)
    assert got == sorted([(r[0], len(split(r[1]))) for r in ODD], key=str)
    assert token_counts.document_tokens(none, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("block", [2, 10, 64, 1 << 20])
def test_separators_in_any_block(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_counts, "SCAN_RUN", 3)
    rng, expected = random.Random(block), []
    for name in ("x", "y", "z"):
        sizes = [rng.choice([0, 1, 2, 30]) for _ in range(25)]
        ids = [[rng.choice([1, 255, 256, 0x0100, 0xFFFF]) for _ in range(n)] for n in sizes]
        flat = [t for doc in ids for t in [*doc, 0]] + ([7, 7] if name == "z" else [])
        (tmp_path / name).mkdir()
        np.array(flat, "<u2").tofile(tmp_path / name / "part.bin")
        expected += [(name, i, n) for i, n in enumerate(sizes + ([2] if name == "z" else []))]
    found = token_counts.count_tokens(spark, str(tmp_path), block_bytes=block)
    got = [(r.path.split("/")[-2], r.place, r.n_tokens) for r in found.collect()]
    assert sorted(got) == sorted(expected)


def test_vocabulary_tokens_round_trip(odd, tmp_path):
    path = "/opt/tokenizers/byte_bpe_50k.json"
    tokenizers = pytest.importorskip("tokenizers")
    if not __import__("os").path.exists(path):
        pytest.skip("no vocabulary file")
    got = token_counts.document_tokens(odd.where("doc_id in (4, 9)"), f"{tmp_path}/v", token_counts.vocabulary_tokens(path))
    loaded = tokenizers.Tokenizer.from_file(path)
    expected = {r[0]: len(loaded.encode(r[1], add_special_tokens=False).ids) for r in ODD if r[0] in (4, 9)}
    assert dict(got.collect()) == expected


# 3 SimHash


def fingerprint(text, size=4):
    w = split(text)
    shingles = [b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, limit):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= limit:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_simhash_of_near_copies(spark):
    rows = []
    for i in range(40):
        base = prose(i, 150).split()
        for k in range(6):
            copy = list(base)
            for j in range(k):
                copy[(37 * j + 11 * i) % len(copy)] = f"other{i}{k}"
            rows.append((len(rows), " ".join(copy), "en", "s"))
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    fps = {r[0]: fingerprint(r[1]) for r in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == classes(fps, 4)


@pytest.mark.parametrize("limit", [2, 4, 8])
def test_masks_miss_no_pair(limit):
    rng = np.random.default_rng(limit)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    masks = simhash.probe_masks(base, 100_000, limit)
    for x in base[:100]:
        flips = rng.choice(64, limit, replace=False)
        y = x ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        assert any((x & np.uint64(m)) == (y & np.uint64(m)) for m in masks)


def test_large_groups_are_connected_like_all_pairs():
    rng = np.random.default_rng(5)
    values = np.unique(np.concatenate([
        c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (60, k)).astype(np.uint64), axis=1)
        for c in rng.integers(0, 2**63, 8, dtype=np.uint64) for k in (1, 2, 3, 5)
    ]))
    a, b = simhash.near_pairs(values, 4)
    assert (np.bitwise_count(a ^ b) <= 4).all() and len(a) < 20 * len(values)
    nodes, roots = components.forest(a.view(np.int64), b.view(np.int64))
    got = dict(zip(nodes.tolist(), roots.tolist(), strict=True))
    near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values) <= 4, 1))
    nodes, roots = components.forest(values[near[:, 0]].view(np.int64), values[near[:, 1]].view(np.int64))
    assert got == dict(zip(nodes.tolist(), roots.tolist(), strict=True))


def test_simhash_of_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got}
    assert {by_id[i].fingerprint for i in (1, 2, 3)} == {"0" * 16}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert by_id[None].component_id is None
    assert simhash.near_duplicates(none).count() == 0


def variants(seed, n, words, edits):
    """Texts of one base with random words replaced, in `edits` places each."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for i in range(n):
        copy = list(base)
        for j in rng.sample(range(words), rng.choice(edits)):
            copy[j] = f"new{seed}x{i}x{j}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("n", [400, 1600])
def test_links_of_one_family_grow_with_its_members(spark, n):
    rows = [(i, t, "en", "s") for i, t in enumerate(variants(7, n, 200, (1, 2, 3, 4, 6)))]
    values = simhash.fingerprints(documents(spark, rows)).select("fp").distinct().cache()
    members = values.count()
    links = [tuple(r) for r in simhash.near_links(values, 4).collect()]
    assert len(links) < 20 * members
    assert all((a ^ b).bit_count() <= 4 for a, b in ((a % 2**64, b % 2**64) for a, b in links))
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    fps = {r.fp: r.fp % 2**64 for r in values.collect()}
    assert {f: got.get(f, f) for f in fps} == classes(fps, 4)


def test_recall_of_fingerprints_by_edited_words(spark):
    """What one fingerprint finds: copies with one word in 400 changed mostly, with one in 20 hardly."""
    found = {}
    for edits in (0, 1, 20):
        texts = [t for i in range(60) for t in (prose(500 + i, 400), *variants(500 + i, 1, 400, (edits,)))]
        docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
        got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
        found[edits] = sum(got[2 * i] == got[2 * i + 1] for i in range(60)) / 60
    assert found[0] == 1 and found[1] >= 0.8 and found[20] <= 0.2


# 4 quality


def test_gradient_of_grades_equals_differences_of_a_plain_loss():
    rng = random.Random(4)
    rows = [(rng.randrange(3), rng.sample(range(6), rng.randrange(1, 5))) for _ in range(40)]
    rows = [(g, at, [rng.choice([0.5, 1.0, 2.0]) for _ in at]) for g, at in rows]
    weights, thresholds = [rng.uniform(-1, 1) for _ in range(6)], [-0.7, 0.9]

    def loss(w, t):
        out = 0.0
        for g, at, values in rows:
            score = sum(w[i] * v for i, v in zip(at, values, strict=True))
            below = [0.0, *(1 / (1 + math.exp(score - x)) for x in t), 1.0]
            out -= math.log(below[g + 1] - below[g])
        return out

    def slopes(x, of):
        moved = [[[y + d * (i == j) for j, y in enumerate(x)] for d in (-1e-5, 1e-5)] for i in range(len(x))]
        return [(of(low) - of(high)) / 2e-5 for low, high in moved]  # of the likelihood

    types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float32())]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    whole = pa.RecordBatch.from_arrays(columns, names=["grade", "slots", "values"])
    model = quality.Model(np.arange(6), np.array(weights, np.float32), np.array(thresholds))
    shared = type("Shared", (), {"value": model})
    [made] = quality._gradient(iter([whole.slice(0, 15), whole.slice(15)]), shared)
    grad, bends, found, n = (c[0].as_py() for c in made.columns)
    assert n == 40 and found == pytest.approx(loss(weights, thresholds), rel=1e-4)
    assert np.frombuffer(grad, np.float32) == pytest.approx(slopes(weights, lambda w: loss(w, thresholds)), abs=1e-3)
    assert bends == pytest.approx(slopes(thresholds, lambda t: loss(weights, t)), abs=1e-3)


def test_quality_by_held_out_accuracy(spark, none):
    rng = random.Random(1)
    rows, grades = [], []
    for i in range(900):
        grade = rng.choice([0, 1, 2])
        text = prose(i, rng.randrange(30, 200)).split()
        for word in ["vile", "nasty"][grade:]:
            text.insert(rng.randrange(len(text)), word)
        rows.append((i, " ".join(text), "en", "s"))
        grades.append((i, grade))
    docs, rated = documents(spark, rows), spark.createDataFrame([*grades, (None, 1), (3, None)], "doc_id long, grade int")
    model = quality.train(rated.where("doc_id % 3 <> 0 or doc_id is null"), docs, 3)
    assert (np.diff(model.thresholds) >= 0).all()
    got = {r.doc_id: r for r in quality.grade(docs, model).collect()}
    truth = dict(grades)
    held = [i for i in got if i % 3 == 0]
    assert np.mean([(got[i].tail_probability >= 0.5) == (truth[i] == 2) for i in held]) > 0.95
    assert np.mean([round(got[i].expected_grade) == truth[i] for i in held]) > 0.9
    kept = {r.doc_id for r in quality.selected(docs, model, 0.5).collect()}
    assert kept == {i for i in got if got[i].tail_probability >= 0.5}


def test_quality_of_odd_rows(spark, odd, none):
    rated = spark.createDataFrame([(5, 2), (8, 0), (1, 1), (77, 2)], "doc_id long, grade int")
    model = quality.train(rated, odd, 3)
    got = quality.grade(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.expected_grade <= 2 for r in got)
    blank = quality.train(rated.where("false"), odd, 3)
    assert len({r.tail_probability for r in quality.grade(odd, blank).collect()}) == 1
    assert quality.grade(none, model).count() == 0
    assert quality.selected(odd, model, 0.0).columns == odd.columns


# 5 language


FRENCH = "maison rivière pierre verte lumière arbre nuage hiver musique papier été forêt".split()
GREEK = "σπίτι ποτάμι πέτρα πράσινο φως νερό δέντρο δρόμος σύννεφο χειμώνας".split()


def test_language_of_texts_and_spans(spark):
    rows = [(i, prose(i, 60, w), lang, "s") for i in range(150) for w, lang in [((None, "en"), (FRENCH, "fr"), (GREEK, "el"))[i % 3]] if w]
    rows += [(i, prose(i, 60), "en", "s") for i in range(0, 150, 3)]
    model = language.train(documents(spark, rows).where("doc_id % 5 <> 1"))
    assert model.languages == ["el", "en", "fr"]
    got = {r.doc_id: r.lang_pred for r in language.identify(documents(spark, rows), model).collect()}
    assert all(got[r[0]] == r[2] for r in rows)
    mixed = prose(1, 40) + " " + prose(2, 30, FRENCH) + " " + prose(3, 20, GREEK)
    one = language.identify(documents(spark, [(1, mixed, None, None)]), model).first()
    assert [(s.lang, s.first, s.words) for s in one.spans] == [("en", 0, 40), ("fr", 40, 30), ("el", 70, 20)]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 7, 5, 6]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(0, 3, (bounds[-1], 3)).astype(np.float32)
    path = language.viterbi(scores, bounds, 2.0)

    def value(states, rows):
        return sum(scores[r, s] for r, s in zip(rows, states, strict=True)) - 2.0 * sum(a != b for a, b in zip(states, states[1:], strict=False))

    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        every = np.indices((3,) * (b - a)).reshape(b - a, -1).T if b > a else []
        best = max((value(list(s), range(a, b)) for s in every), default=0)
        assert value(list(path[a:b]), range(a, b)) == pytest.approx(best, abs=1e-4)


def plain_letters(text):
    """Words of a text as (slots of their letters, first letter), one letter at a time."""
    mask, step = (1 << 64) - 1, 0x9E3779B97F4A7C15
    words, word = [], ""
    for c in text.lower() + " ":
        if unicodedata.category(c)[0] == "L":
            word += c
        elif word:
            slots = []
            for i in range(len(word)):
                code = 0
                for k in range(3):
                    code = (code * step + (ord(word[i - k]) if i >= k else 0)) & mask
                h = (code + (i == len(word) - 1)) & mask
                h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & mask
                h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & mask
                slots.append((h ^ (h >> 31)) >> 48)
            words.append((slots, word[0]))
            word = ""
    return words


def plain_script(c):
    return [number for first, number in language.SCRIPT_RANGES if first <= ord(c)][-1]


def plain_language(train, texts):
    """Language and share of letters of texts; counts, scores and paths in plain Python."""
    names = sorted({lang for _, lang in train})
    counts, scripts = {n: Counter() for n in names}, {n: Counter() for n in names}
    for text, lang in train:
        for slots, first in plain_letters(text or ""):
            counts[lang].update(slots)
            scripts[lang][plain_script(first)] += len(slots)
    total = {n: sum(counts[n].values()) + 0.3 * 65536 for n in names}
    out = []
    for text in texts:
        words, best, back = plain_letters(text or ""), {}, []
        for slots, first in words:
            score = {n: sum(math.log((counts[n][s] + 0.3) / total[n]) for s in slots) for n in names}
            top = max(score.values())
            fits = {n: scripts[n][plain_script(first)] >= 0.01 * max(1, sum(scripts[n].values())) for n in names}
            score = {n: (v - top - 50 * (not fits[n])) * any(fits.values()) for n, v in score.items()}
            if best:
                lead = max(names, key=lambda n: best[n])
                back.append({n: n if best[n] >= best[lead] - 8 else lead for n in names})
                best = {n: max(best[n], best[lead] - 8) + score[n] for n in names}
            else:
                best = score
        letters = Counter()
        state = max(names, key=lambda n: best[n]) if best else None
        for i in range(len(words) - 1, -1, -1):
            letters[state] += len(words[i][0])
            state = back[i - 1][state] if i else None
        lang = max(names, key=lambda n: letters[n]) if words else "und"
        out.append((lang, letters[lang] / max(1, sum(letters.values()))))
    return out


def mixed_texts():
    rng = random.Random(5)
    kinds = {"en": None, "fr": FRENCH, "el": GREEK}
    rows = []
    for i in range(60):
        lang = rng.choice(list(kinds))
        parts = [prose(i, 25, kinds[lang] or WORDS), prose(100 + i, rng.randrange(1, 12), kinds[rng.choice(list(kinds))] or WORDS)]
        rows.append((i, rng.choice([" ", ", ", "\u00a0", " 12 "]).join(parts), lang, "s"))
    return rows + [(60, None, "fr", "s"), (61, "", "en", "s"), (62, "12 -- 日本", "el", "s"), (63, "ΣΑΣ ΟΔΟΣ, ΦΩΣ", "el", "s")]


def test_language_equals_plain_scores(spark):
    rows = mixed_texts()
    model = language.train(documents(spark, rows))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(documents(spark, rows), model).collect()}
    expected = plain_language([(r[1], r[2]) for r in rows], [r[1] for r in rows])
    for r, (lang, share) in zip(rows, expected, strict=True):
        assert got[r[0]] == (lang, pytest.approx(share)), r


def test_every_language_is_learned(spark):
    spell = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in "nrstvwxz"][:300]
    rows = [(i, " ".join([f"{w}{w}{w}", f"{w}{w}"] * 10), w, "s") for i, w in enumerate(spell)]
    model = language.train(documents(spark, rows))
    assert model.languages == sorted(spell)
    assert len(model.logs) < 300 * 30
    got = {r.doc_id: r.lang_pred for r in language.identify(documents(spark, rows), model).collect()}
    assert sum(got[i] == w for i, w in enumerate(spell)) > 290


@pytest.mark.parametrize("size", [1, 7, 100, 4000])
def test_long_texts_in_runs_equal_whole_ones(spark, size):
    rows = mixed_texts()
    model = language.train(documents(spark, rows))
    for text in [r[1] for r in rows if r[1]] + [" ".join(r[1] or "" for r in rows)]:
        assert "".join(language._runs(text, size)) == text
        name, share, spans = language.label_text(text, model, size)
        whole = language.label(language.split_words([text]), model)
        assert (name, spans) == (whole[0][0], whole[2][0])
        assert share == pytest.approx(whole[1][0])


def test_memory_of_a_very_long_text_is_bounded(spark):
    model = language.train(documents(spark, mixed_texts()))
    text = (prose(1, 30_000) + " " + prose(2, 30_000, FRENCH) + " ") * 3
    tracemalloc.start()
    name, _, spans = language.label_text(text, model, 1 << 14)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert name in ("en", "fr") and len(spans) == 6
    assert peak < 8 * len(text)


def test_language_of_odd_rows(odd, none):
    model = language.train(odd)
    got = language.identify(odd, model).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].lang_pred, by_id[i].score, by_id[i].spans) for i in (1, 2, 3)] == [("und", 0.0, [])] * 3
    assert all(0 <= r.score <= 1 and r.lang_pred in ("de", "en", "es", "und") for r in got)
    assert language.identify(none, model).count() == 0
    blank = language.train(none)
    assert {r.lang_pred for r in language.identify(odd, blank).collect()} == {"und"}


# 6 suffix arrays


def repeats(rows, size=50):
    """Words of each (doc_id, text) in a window that an earlier place holds."""
    first, out = {}, defaultdict(set)
    for d, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        w = split(text)
        for i in range(len(w) - size + 1):
            if first.setdefault(tuple(w[i : i + size]), (d, i)) != (d, i):
                out[d].update(range(i, i + size))
    return dict(out)


def spans_by_id(docs, chunk=8000):
    keyed = docs.select("doc_id", suffix_dedup.row_key("doc_id", "text").alias("key")).distinct()
    found = keyed.join(suffix_dedup.repeated_spans(docs, chunk), "key").collect()
    return {r.doc_id: {x for s in r.spans for x in range(s.lo, s.hi)} for r in found}


@pytest.mark.parametrize("chunk", [7, 8000])
def test_repeats_equal_brute_force(spark, chunk):
    rng = random.Random(4)
    shared = [prose(900 + i, n).split() for i, n in enumerate((49, 50, 51, 80, 200, 400))]
    rows = []
    for d in range(120):
        w = prose(d, rng.randrange(0, 150)).split()
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(shared)
            a = rng.randrange(0, max(1, len(p) - 60))
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = p[a : a + rng.randrange(40, 200)]
        rows.append((d, " ".join(w), "en", "s"))
    rows += [(200 + d, rows[d][1], "en", "s") for d in range(5)]
    docs = documents(spark, rows)
    expected = repeats([r[:2] for r in rows])
    assert spans_by_id(docs, chunk) == expected and expected
    cut = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs).collect()}
    assert {d: t.split() for d, t in cut.items()} == {
        r[0]: [x for i, x in enumerate(r[1].split()) if i not in expected.get(r[0], ())] for r in rows
    }


@pytest.mark.parametrize("n", [150, 450])
def test_a_passage_in_every_row_is_split(spark, monkeypatch, n):
    passage = prose(77, 60).split()
    rows = [(d, " ".join(prose(5000 + d, d % 7 * 10).split() + passage + prose(9000 + d % 40, 45).split()), "en", "s") for d in range(n)]
    rows += [(n + d, " ".join(passage * 2), "en", "s") for d in range(10)]
    shares = []
    whole = suffix_dedup.saved

    def kept(df, name):
        out = whole(df, name)
        if name == "matches":
            sizes = [r["count"] for r in out.groupBy(F.input_file_name()).agg(F.sum(F.size("repeats")).alias("count")).collect()]
            shares.append(max(sizes) / sum(sizes))
        return out

    monkeypatch.setattr(suffix_dedup, "saved", kept)
    docs = documents(spark, rows)
    assert spans_by_id(docs, 100) == repeats([r[:2] for r in rows])
    assert shares[0] < 0.5  # no task finds most of the repeats
    sources = {r.key: r.first_doc_ids for r in suffix_dedup.repeated_spans(docs).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert {r.key: r.first_doc_ids for r in suffix_dedup.repeated_spans(docs, 50).collect()} == sources
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_windows_around_a_common_line_are_not_compared(spark, monkeypatch):
    """Texts that share 30 words, with others before and after, and two that share 60 around those."""
    line, n = prose(78, 30).split(), 400
    alone = [" ".join([*(f"a{d}x{i}" for i in range(45)), *line, *(f"b{d}x{i}" for i in range(45))]) for d in range(n)]
    around = [" ".join([f"c{d}", *prose(79, 15).split(), *line, *prose(80, 15).split(), f"d{d}"]) for d in range(2)]
    rows = [(d, t, "en", "s") for d, t in enumerate([*alone, *around])]
    whole, made = suffix_dedup.saved, []

    def kept(df, name):
        out = whole(df, name)
        if name == "matches":
            made.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "saved", kept)
    found = spans_by_id(documents(spark, rows))
    assert found == repeats([r[:2] for r in rows]) == {n + 1: set(range(1, 61))}
    assert made[0] < 2 * n  # before, each of these had some twenty windows


def test_windows_of_copies_are_settled_by_their_tasks(spark, monkeypatch):
    """Pairs of copies: before, tasks left the windows of their first and last gram open for others to compare."""
    n, made = 200, []
    whole = suffix_dedup.saved

    def kept(df, name):
        out = whole(df, name)
        if name == "matches":
            made.append(out.where("window is not null").count())
        return out

    monkeypatch.setattr(suffix_dedup, "saved", kept)
    texts = [" ".join(f"a{d}x{i}" for i in range(90)) for d in range(n)]
    rows = [(d + n * copy, t, "en", "s") for d, t in enumerate(texts) for copy in (0, 1)]
    assert spans_by_id(documents(spark, rows)) == repeats([r[:2] for r in rows]) == {n + d: set(range(90)) for d in range(n)}
    assert made == [0]


def test_counted_joins_of_hot_keys_lose_no_row(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    counted = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("most")).where("k < 40")
    found = join_counted(rows.union(spark.sql("select null, 1")), counted, "k", F.col("id"))
    plain = rows.join(counted.drop("n"), "k")
    assert found.columns == plain.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_repeats_of_odd_rows(odd, none):
    assert spans_by_id(odd) == repeats([r[:2] for r in ODD])
    cut = suffix_dedup.without_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == len(ODD)
    assert {r.doc_id: r.text for r in cut.collect()}[1] is None
    assert suffix_dedup.without_repeats(none).count() == 0


# 7 embeddings


def vector_links(rows, limit=0.93):
    def able(v, label):
        return v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = defaultdict(set)
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows):
            if i != j and a == b and able(v, a) and able(w, b) and len(v) == len(w):
                x, y = np.float32(v).astype(float), np.float32(w).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= limit:
                    links[i].add(j)
    return links


@pytest.mark.parametrize("cell", [4, 8192])
def test_embeddings_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(25):
        center = rng.normal(size=48)
        for _ in range(8):
            rows.append((len(rows), [float(x) for x in np.float32(center + rng.normal(0, 0.15, 48))], int(rng.integers(2))))
    rows += [(len(rows) + i, rows[0][1], rows[0][2]) for i in range(3)]
    n = len(rows)
    odd = [None, [], [0.0] * 48, [None] + [1.0] * 47, [float("nan")] + [1.0] * 47, [float("inf")] * 48, [3.0, 4.0]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)]
    rows += [(n + 20, rows[0][1], None), (n + 21, [6.0, 8.0], 0), (None, rows[0][1], rows[0][2])]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, code string, key string")
    got = embedding_dedup.near_duplicates(table).collect()
    links = vector_links(rows)
    assert len(got) == len(rows)
    expected = {r[0]: len(links[i]) for i, r in enumerate(rows)}
    found = {r.vec_id: r.n_links for r in got}
    assert all(found[i] <= expected[i] for i in found)
    assert sum(found.values()) >= 0.97 * sum(expected.values())
    roots = {r.vec_id: r.component_id for r in got}
    assert all(roots[n + i] == n + i for i in range(6)) and roots[n + 21] == n + 6
    assert roots[n - 1] == roots[0] == roots[None] == 0
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(table.where("false")).count() == 0


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(1).normal(size=(5, 32))
    y = embedding_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(embedding_dedup.hadamard(y), x)


# 8 decontamination


def contaminated(text, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, ids = set(), set()
    for item, other in items:
        v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), other or ""))
        n = min(13, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                ids.add(item)
    names = sorted(str(i) for i in ids if i is not None)
    digest = hashlib.sha256(",".join(names).encode()).hexdigest()
    return len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)


def test_contamination_equals_brute_force(spark, odd, none):
    rng = random.Random(9)
    items = [(i, prose(500 + i, n)) for i, n in enumerate((5, 12, 13, 14, 30, 60, 60, 1, 0))]
    items += [(40, items[4][1]), (4, items[5][1]), (None, items[6][1]), (50, None), (51, "the the the the"), (52, "x " * 30)]
    rows = list(ODD)
    for d in range(100, 180):
        w = prose(d, rng.randrange(0, 200)).split()
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(items)[1] or ""
            part = p.split()[rng.randrange(0, 4) :][: rng.choice([5, 12, 13, 40, 80])]
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = [x.upper() + rng.choice(["", ".", ","]) for x in part]
        rows.append((d, " ".join(w), "en", "s"))
    bench = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, doc_id string")
    got = decontaminate.contamination(documents(spark, rows), bench).collect()
    expected = [(r[0], *contaminated(r[1], items)) for r in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert sum(e[5] for e in expected) > 10
    assert decontaminate.contamination(none, bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(odd, bench.where("false")).collect()} == {0}


def test_items_of_one_text_are_extended_once(spark, monkeypatch):
    texts = ["the", prose(900, 20), prose(901, 40)]
    items = [(i, texts[i % 3]) for i in range(900)]
    rows = [(d, f"{prose(d, 30)} the {texts[1 + d % 2]}", "en", "s") for d in range(60)]
    rows += [(100 + d, f"{prose(d, 9)} the end", "en", "s") for d in range(60)]
    seen, plain = spark.sparkContext.accumulator(0), decontaminate._extended

    def counted(batches, span):
        def count():
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        yield from plain(count(), span)

    def extended(n_items):
        bench = spark.createDataFrame(items[:n_items], "item_id long, text string")
        before = seen.value
        got = decontaminate.contamination(documents(spark, rows), bench).collect()
        if n_items == 9:  # brute force reads every item for every document
            expected = [(r[0], *contaminated(r[1], items[:n_items])) for r in rows]
            assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
        assert {r.n_items for r in got if r.doc_id >= 100} == {n_items // 3}
        assert {r.n_items for r in got if r.doc_id < 60} == {n_items // 3 * 2}
        return seen.value - before

    monkeypatch.setattr(decontaminate, "_extended", counted)
    assert extended(9) == extended(900)


def test_contamination_with_spaces_beyond_ascii(spark):
    rng = random.Random(10)
    spaces = ["\u0085", "\u00a0", "\u1680", "\u2003", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]
    items = [(i, prose(700 + i, n)) for i, n in enumerate((5, 9, 13, 14, 30, 60))]
    items += [(10 + i, f"{prose(720 + i, 8)}{s}{prose(740 + i, 8)} {s} {prose(760 + i, 3)}") for i, s in enumerate(spaces)]
    rows = []
    for d in range(120):
        item, s = items[d % len(items)][1], spaces[d % len(spaces)]
        w = prose(800 + d, 40).split()
        w[rng.randrange(15, 20)] += rng.choice([s, f"{s} {s}", f" {s}x", f"{s}x{s}x"])
        rows.append((d, " ".join([*w[:20], rng.choice([item, s + " " + item, item + " " + s]), *w[20:]]), "fr", "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(spark, rows), bench).collect()
    expected = [(r[0], *contaminated(r[1], items)) for r in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert sum(e[5] for e in expected) > 100


# 9 URLs


def test_url_rules_and_models(spark):
    urls = [
        "http://A.Net/x", "http://a.net", "http://net/?q", "https://w.example.net/en/1", "https://w.example.net/de/1",
        "http://notexample.net/en/", "http://q.example.com/de/2#t", "http://q.example.com/en/2", "http://f.org/fr/a?b=/",
        "http://f.org/en/a", "no scheme", "", None, "http://x.y://z/é", "ftp://org/fr/", "http://h.org?/fr/",
    ]
    more = [f"https://news{i}.example.net/en/story-{i}" for i in range(80)] + [f"http://casino{i}.net/win?{i}" for i in range(80)]
    probes = ["https://news7.example.info/en/story-9", "http://casino8.example.info/win?5"]
    rows = list(enumerate(urls + more + probes)) + [(None, urls[0]), (0, urls[0])]
    table = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, host string, score int")
    got = url_filter.judge(table).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    rules = [by_id[i].rule for i in range(len(urls))]
    assert rules == [
        "net/", None, "net/", "example.net/en/", "net/", "net/", "example.com/de/", None, "org/fr/",
        None, None, None, None, None, "org/fr/", None,
    ]
    assert [(by_id[i].host, by_id[i].path) for i in (0, 1, 2, 8, 10, 12, 13)] == [
        ("a.net", "/x"), ("a.net", ""), ("net", "/"), ("f.org", "/fr/a"), ("", ""), ("", ""), ("x.y:", "//z/é"),
    ]
    assert by_id[0].verdict == "block" and by_id[3].verdict == "allow"
    assert [by_id[len(urls) + 160 + i].verdict for i in (0, 1)] == ["allow", "block"]
    assert url_filter.judge(table.where("false")).count() == 0
    assert {r.verdict for r in url_filter.judge(table.where("page_id in (1, 10)")).collect()} == {"allow"}


# 10 language model


def plain_url_score(url, counts, backoff=4.0, order=5):
    """Log-likelihood difference per byte from counts of (kind, context, next byte)."""
    data, out = url.encode(), 0.0
    for i, byte in enumerate(data):
        for kind, sign in ((True, 1), (False, -1)):
            p = 1 / 256
            for k in range(order):
                before = tuple(data[j] if j >= 0 else None for j in range(i - k, i))
                n, total = counts[kind, before, byte], counts[kind, before]
                p = (n + backoff * p) / (total + backoff)
            out += sign * math.log(p)
    return out / max(1, len(data))


def test_url_scores_equal_plain_counts(spark):
    rng = random.Random(3)
    kinds = {True: "maison forêt papier".split(), False: "casino spin win".split()}
    labelled = [(f"http://a.{rng.choice('xyz')}/{rng.choice(kinds[k])}{rng.randrange(9)}", k) for k in (True, False) * 12]
    counts = Counter()
    for url, kind in labelled:
        data = url.encode()
        for i, byte in enumerate(data):
            for k in range(5):
                before = tuple(data[j] if j >= 0 else None for j in range(i - k, i))
                counts[kind, before, byte] += 1
                counts[kind, before] += 1
    tables, _ = url_filter.train(spark, spark.createDataFrame([*labelled, (None, True)], "url string, accepted boolean"))
    urls = [labelled[0][0], "http://a.x/casino", "http://b.org/été", "q", "", None]
    got = url_filter.url_scores(pa.array(urls), tables)
    assert got == pytest.approx([plain_url_score(u or "", counts) for u in urls], abs=1e-5)


def test_elias_fano_round_trip():
    rng = np.random.default_rng(3)
    for universe in (1, 50, 10**4, 2**50):
        values = np.sort(rng.integers(0, universe, 700)).astype(np.uint64)
        sequence = ngram_lm.EliasFano.of(values)
        assert (sequence.get(np.arange(700)) == values).all()
        asked = rng.integers(0, universe + 2, 300).astype(np.uint64)
        at = sequence.successor(np.zeros(300, np.int64), np.full(300, 700), asked)
        assert (at == np.searchsorted(values, asked)).all()


def test_language_model_equals_counts(spark, odd, none):
    docs = odd.union(documents(spark, [(100 + i, prose(i, 80), "en", "s") for i in range(60)]))
    held = F.col("doc_id") % 4 == 1
    got = ngram_lm.score(docs, held).collect()
    rows = [(r.doc_id, [*split(r.text), None]) for r in docs.select("doc_id", "text").collect()]
    train = [w for d, w in rows if d is None or d % 4 != 1]
    one = Counter(x for w in train for x in w)
    two = Counter(p for w in train for p in zip(w, w[1:], strict=False))
    n, v, mu = sum(one.values()), len(one), ngram_lm.PRIOR
    alone = {x: (one[x] + 1) / (n + v + 1) for w in rows for x in w[1]}
    expected = []
    for d, w in rows:
        base = sum(math.log10(alone[x]) for x in w)
        full = math.log10(alone[w[0]]) + sum(
            math.log10((two[a, b] + mu * alone[b]) / (one[a] + mu)) for a, b in zip(w, w[1:], strict=False)
        )
        expected.append((d, d is not None and d % 4 == 1, len(w), sum(one[x] > 0 for x in w), n, base, full))
    def order(r):
        return (str(r[0]), r[2])

    for a, b in zip(sorted(map(tuple, got), key=order), sorted(expected, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6], rel=2e-3)
    assert ngram_lm.score(none, held).count() == 0
    nothing = ngram_lm.score(odd, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in nothing} == {(0, 0, 0.0)}
