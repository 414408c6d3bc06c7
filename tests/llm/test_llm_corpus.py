"""Whitening, spelling variants and quality rules against brute force and over odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from llm_frames import LONG, no_documents, odd_documents
from riskmart.llm import quality, spelling, whitening

# ---- whitening ------------------------------------------------------------------------------------------


def _by_hand(vectors, k=32):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    gaps = x - x.mean(axis=0)
    e, q = np.linalg.eigh(gaps.T @ gaps / len(x))
    order = np.argsort(-e)[:k]
    return gaps @ (q[:, order] / np.sqrt(e[order])), e[order] / e.sum(), x.astype(int)


def _compare(found, ids, vectors, k=32, tolerance=1e-7):
    want, share, x = _by_hand(vectors, k)
    k = want.shape[1]
    got = np.zeros((len(ids), k))
    place = {v: i for i, v in enumerate(ids)}
    sums = x.sum(axis=0)
    assert len(found) == len(ids) * k
    for r in found:
        row = x[place[r["vec_id"]]]
        assert r["n"] == len(ids) and r["deviation"] == sum(int(len(ids) * c - s) ** 2 for c, s in zip(row, sums))
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9) and r["identity_error"] < 1e-8
    sign = np.sign((want * got).sum(axis=0))
    assert np.abs(want * sign - got).max() < tolerance


def test_supplied_vectors_against_the_eigenvectors_of_the_covariance(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    found = whitening.op11_whiten_embeddings(spark, small).collect()
    _compare(found, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_steep_and_flat_spectra(spark):
    """Deviations over six orders of magnitude, more dimensions than components wanted, and equal deviations."""
    rng = np.random.default_rng(3)
    steep = rng.standard_normal((400, 12)) * 10.0 ** np.linspace(3, -1, 12) + rng.standard_normal(12) * 50
    flat = np.vstack([np.eye(6), -np.eye(6)]).repeat(3, axis=0) * 2.0
    for vectors, k in ((steep, 5), (steep, 32), (flat, 32)):
        frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        found = whitening.whitened_vectors(frame, components=k).collect()
        if vectors is steep:
            _compare(found, list(range(len(vectors))), vectors, k, 1e-5)
        else:  # any basis will do: the whitened rows are told by their covariance
            z = np.zeros((len(vectors), 6))
            for r in found:
                z[r["vec_id"], r["component"] - 1] = r["whitened"]
            assert np.abs(z.T @ z / len(z) - np.eye(6)).max() < 1e-9 and len(found) == 6 * len(vectors)


def test_vectors_left_out_and_ranks(spark):
    schema = "embedding array<double>, vec_id long, n string, component string, x int"
    good = [([float(i), 2.0 * i, 1.0], i if i else None, "q", "q", 1) for i in range(6)]
    bad = [(None, 50, "q", "q", 1), ([1.0, None, 2.0], 51, "q", "q", 1), ([1.0, float("nan"), 2.0], 52, "q", "q", 1),
           ([1.0, float("inf"), 0.0], 53, "q", "q", 1), ([1.0, 2.0], 54, "q", "q", 1), ([], 55, "q", "q", 1), ([1e300, 0.0, 0.0], 56, "q", "q", 1)]
    found = whitening.whitened_vectors(spark.createDataFrame(good + bad + good[2:3], schema)).collect()
    assert len(found) == 7  # one direction only, and the repeated row comes back
    assert {r["vec_id"] for r in found} == {None, 1, 2, 3, 4, 5} and {r["n"] for r in found} == {7}
    assert found[0]["explained"] == pytest.approx(1.0)
    for rows in ([], bad, good[:1], good[1:2] * 4):
        assert whitening.whitened_vectors(spark.createDataFrame(rows, schema)).count() == 0


def test_deviations_beyond_a_long():
    x = np.array([[2 ** 40, 1], [0, 1], [5, 1]])
    sums = [2 ** 40 + 5, 3]
    exact = [(3 * a - sums[0]) ** 2 + (3 * b - sums[1]) ** 2 for a, b in x.tolist()]
    assert whitening.deviations(x, 3, sums) == [v if v < 2 ** 63 else None for v in exact]


# ---- spelling variants ----------------------------------------------------------------------------------


def _words_by_hand(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else (a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:])


def _groups_by_hand(words):
    listed, out = sorted(words), {}
    near = {w: [] for w in listed}
    by_size = {}
    for w in listed:
        by_size.setdefault(len(w), []).append(w)
    for w in listed:
        near[w] = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, ()) if _near(w, v)]
    form = {}
    for w in listed:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    for w in listed:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def _found(df):
    return {r["word"]: tuple(r[n] for n in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_spelling_of_the_supplied_documents(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    df = spelling.op12_spelling_variants(spark, small)
    assert dict(df.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    found = _found(df)
    assert len(found) == df.count() > 1_000 and found == _groups_by_hand(_words_by_hand(docs))
    assert sum(f[1] is not None for f in found.values()) > 100


def test_near_words_of_few_letters_and_any_length(spark):
    """Runs of equal letters, where an edit can be read in several ways, and words around and far past the hashed length."""
    rng = random.Random(5)
    words = {"".join(rng.choice("aab") for _ in range(rng.randint(5, 9))) for _ in range(250)}
    for size in (62, 63, 64, 65, 66, 67, 130, 3_000):
        word = "".join(rng.choice("aaé") for _ in range(size))
        words |= {word, *(word[:i] + c + word[i + k:] for i in (0, 1, size // 2, size - 1) for c in ("", "a", "z", "zz") for k in (0, 1))}
    counts = {w: rng.choice([1, 2, 2, 4, 9, 30, 30]) for w in sorted(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert _found(spelling.spelling_groups(frame)) == _groups_by_hand(counts)


def test_prefix_ranges_are_small_and_pairs_are_not_listed(spark):
    words = [("stem" + chr(97 + i % 26) + chr(97 + i // 26), 3) for i in range(26 * 26)]
    frame = spark.createDataFrame([(w, n, i) for i, (w, n) in enumerate(words)], "word string, n long, place long")
    turned = spelling.rotations(frame)
    assert turned.count() == sum(2 * len(w) + 1 for w, _ in words)
    assert turned.groupBy("prefix").count().agg({"count": "max"}).first()[0] <= spelling.LETTERS + 1
    assert spelling.neighbours(turned).agg({"n_near": "min"}).first()[0] == 50


def test_spelling_of_odd_rows(spark):
    docs = odd_documents(spark).select("text", "doc_id", "lang").withColumnRenamed("lang", "word")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert _found(spelling.spelling_groups(spelling.word_counts(docs))) == _groups_by_hand(_words_by_hand(rows))
    assert spelling.spelling_groups(spelling.word_counts(no_documents(spark))).count() == 0


# ---- quality rules --------------------------------------------------------------------------------------


def _counts_by_hand(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(line in lines[:i] for i, line in enumerate(lines) if re.search("[^\x20\x09-\x0d]", line)) if len(lines) < 2_000 else None
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def _ratio(data):
    return len(zstandard.ZstdCompressor(level=3).compress(data)) / len(data)


def _verdict_by_hand(text):
    data = (text or "").encode()

    def outside(piece):
        low, high = [(low, high) for start, low, high in ((0, 0, 9e9), *quality.BANDS) if len(piece) >= start][-1]
        return bool(piece) and not low <= _ratio(piece) <= high

    pieces, at = [], 0
    while len(data) - at >= 4_096 + 2_048:
        pieces.append(data[at:at + 4_096])
        at += 4_096
    pieces.append(data[at:])
    bad = sum(len(p) for p in pieces if outside(p))
    return not outside(data) and (len(pieces) == 1 or 3 * bad <= len(data))


def _check_quality(found, texts):
    for r in found:
        text = texts[r["doc_id"]]
        n, chars, symbols, dup, repeats = _counts_by_hand(text)
        failed = n < 50 or 100 * repeats > 50 * n
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_repeat_words"], r["base_failed"]) == (n, chars, symbols, repeats, failed)
        assert dup is None or r["n_dup_lines"] == dup
        assert r["kept"] == (not failed and _verdict_by_hand(text))


def test_quality_of_the_supplied_documents(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = quality.op13_quality_rules(spark, small).collect()
    assert len(found) == len(texts)
    _check_quality(found, texts)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    good = [r for r in found if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert good and sum(r["kept"] for r in good) >= 0.99 * len(good)


def test_bands_tell_prose_from_repetition_and_noise(spark):
    rng = random.Random(2)
    letters = "etaoinshrdlucmfwypvbgk"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(600)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    noise = ["".join(rng.choice([chr(c) for c in range(33, 127)]) for _ in range(70)) for _ in range(3_000)]
    long_words = ["".join(rng.choices(letters, k=40)) for _ in range(30)]
    few = " ".join(rng.choice(long_words) for _ in range(1_500))
    texts = dict(enumerate([prose(60), prose(400), prose(20_000), " ".join(noise[:60]), " ".join(noise), prose(2_000) + " " + " ".join(noise[:40]),
                            prose(2_000) + " " + " ".join(noise[:600]), few, (prose(900) + "\n") * 6]))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in quality.quality(frame).collect()}
    _check_quality(found.values(), texts)
    assert [found[i]["kept"] for i in range(8)] == [True, True, True, False, False, True, False, False]
    assert found[8]["base_failed"] and not found[7]["base_failed"]


def test_chunks_hold_the_whole_text():
    for size in (0, 1, 4_095, 4_096, 6_143, 6_144, 8_192, 100_001):
        data = bytes(i % 251 for i in range(size))
        pieces = quality.chunks_of(data)
        assert b"".join(pieces) == data and all(2_048 <= len(p) < 6_144 for p in pieces if size >= 2_048)


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = quality.quality(docs).collect()
    assert len(found) == docs.count()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    _check_quality([r for r in found if len(set(texts[r["doc_id"]])) == 1], {k: v[0] for k, v in texts.items()})
    assert quality.quality(no_documents(spark)).count() == 0
    assert quality.repeated_words(LONG.encode().split()) == len(LONG.split())
