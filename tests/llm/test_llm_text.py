"""Toxicity, token counts, language and packing: odd rows, brute force, gradients and held-out accuracy."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_frames import LONG, no_documents, odd_documents
from riskmart.llm import language_id, packing, token_counts, toxicity
from riskmart.llm.word_tokens import WordTokens, word_tokens

ALPHABET = "ab cé 'lls 12  \n\t.,!?üñ'tre  ve日本xZÀİ́"


def _random_text(rng, size):
    return "".join(rng.choice(ALPHABET) for _ in range(size))


# ---- toxicity -------------------------------------------------------------------------------------------


def test_ordinal_gradient_leads_to_the_likelihood_maximum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(600)]
    truth = np.array([3.0, 1.5, 0, 0, -1, -2])
    noise = rng.logistic(size=600)
    grades = np.searchsorted([0.0, 1.5, 3.0], [truth[r].sum() + e for r, e in zip(rows, noise)])
    model = toxicity.fit(rows, grades, np.arange(6), ridge=1e-6, steps=1500)
    assert np.all(np.diff(model.thresholds) > 0)
    assert np.corrcoef(model.weights, truth)[0, 1] > 0.97

    def loss(weights, cuts):
        score = np.array([weights[r].sum() for r in rows])
        above = np.column_stack([np.ones(600), 1 / (1 + np.exp(-(score[:, None] - cuts))), np.zeros(600)])
        return -np.log(above[np.arange(600), grades] - above[np.arange(600), grades + 1]).mean()

    best = loss(model.weights, model.thresholds)
    for i in range(6):
        for step in (-0.3, 0.3):
            moved = model.weights.copy()
            moved[i] += step
            assert loss(moved, model.thresholds) > best - 1e-4


def test_grades_share_toxic_documents_evenly():
    rows = [np.arange(n) for n in (5, 0, 1, 2, 3, 4, 6)]
    toxic = np.array([False, False, True, True, True, True, True])
    grades = toxicity.grade(rows, toxic, np.ones(10, bool))
    assert grades[:2].tolist() == [0, 0] and set(grades[2:]) <= {1, 2, 3} and grades[2] < grades[6]


def test_toxicity_on_the_supplied_tables(spark, small):
    docs = spark.read.parquet(small.replace("0.001", "0.01") + "/documents.parquet")
    labels = spark.read.parquet(small.replace("0.001", "0.01") + "/labels.parquet")
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = [r for r in found if r["toxic"] == 1], [r for r in found if r["toxic"] == 0]
    assert np.mean([r["rejected"] for r in toxic]) > 0.95 and np.mean([r["rejected"] for r in clean]) < 0.01
    assert np.mean([r["severity"] for r in toxic]) > 10 * np.mean([r["severity"] for r in clean])
    # The same rows by hand, word by word.
    weight = dict(zip(model.features.tolist(), model.weights))
    for r in found[:60]:
        score = sum(weight.get(f, 0.0) for f in toxicity.text_features(r["text"]))
        above = 1 / (1 + np.exp(-(score - model.thresholds)))
        assert r["severity"] == pytest.approx(above.sum()) and r["rejected"] == bool(above[0] >= 0.5)


def test_toxicity_of_odd_rows(spark):
    docs = odd_documents(spark).withColumnRenamed("size", "severity")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (6, 0), (99, 1), (8, 0), (10, 0)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs, model)
    assert found.count() == docs.count() and dict(found.dtypes)["severity"] == "double" and found.filter("rank = 1").count() == docs.count()
    assert toxicity.learn(docs, labels.filter("toxic = 0")) is None
    assert toxicity.score(docs, None).filter("rejected or severity <> 0").count() == 0
    assert toxicity.learn(no_documents(spark), labels) is None
    assert toxicity.score(no_documents(spark), model).count() == 0


def test_labels_of_other_documents_take_no_place_in_the_sample(spark):
    docs = spark.range(0, 10_000, 100).selectExpr("id doc_id", "if(id % 1000 = 0, 'foul words', 'fine words') text")
    labels = spark.range(10_000).selectExpr("id doc_id", "if(id % 1000 = 0 or id % 7 = 1, 1, 0) toxic")
    labels = labels.join(docs.filter("text = 'fine words'").select("doc_id").withColumn("fine", toxicity.F.lit(0)), "doc_id", "left").selectExpr("doc_id", "coalesce(fine, toxic) toxic")
    sample = toxicity._sampled(docs, labels, "doc_id", "text", 10, 50).groupBy("toxic").count().collect()
    assert {r["toxic"]: r["count"] for r in sample} == {1: 10, 0: 50}


# ---- token counts ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def byte_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    made.encode_special_tokens = True
    return lambda text: len(made.encode(text, add_special_tokens=False).ids)


def test_edits_against_encoding_everything(byte_tokenizer):
    rng, counts = random.Random(1), token_counts.counts_by()
    for _ in range(120):
        text = _random_text(rng, rng.randint(0, 900))
        tree = token_counts.TokenTree.of(text, counts)
        assert tree.n_tokens == byte_tokenizer(text)
        for _ in range(10):
            start, length = rng.randint(-2, len(text) + 3), rng.randint(0, rng.choice([1, 5, 400]))
            inserted = _random_text(rng, rng.choice([0, 1, 3, 50, 600]))
            tree.edit(start, length, inserted)
            start = min(max(start, 0), len(text))
            text = text[:start] + inserted + text[start + length:]
            assert tree.text == text and tree.n_chars == len(text)
            assert tree.n_tokens == byte_tokenizer(text)


def test_a_small_edit_encodes_little():
    counts = token_counts.counts_by()
    tree = token_counts.TokenTree.of(LONG, counts)
    tree.edit(200_000, 3, "cat")
    assert 0 < tree.encoded < 2_000


def test_edits_of_odd_rows(spark, byte_tokenizer):
    kind = "array<struct<start:long,length:long,inserted:string>>"
    edits = "case doc_id when 1 then array(struct(0L, 3L, 'zero'), struct(null, null, null), struct(5000L, 9L, ' end')) when 7 then array(struct(100L, -5L, 'x')) end"
    docs = odd_documents(spark).withColumn("edits", token_counts.F.expr(f"cast({edits} as {kind})"))
    found = token_counts.apply_edits(token_counts.token_trees(docs, edits_col="edits")).collect()
    assert len(found) == docs.count()
    by = defaultdict(list)
    for r in found:
        by[r["doc_id"]].append(r)
        assert r["tokens_after"] == byte_tokenizer(r["text"]) and r["chars_after"] == len(r["text"])
    assert by[1][0]["text"] == "zero two three four five six seven eight nine ten end"
    assert by[7][0]["text"] == LONG[:100] + "x" + LONG[100:]
    empty = no_documents(spark).withColumn("edits", token_counts.F.expr(f"cast(null as {kind})"))
    assert token_counts.apply_edits(token_counts.token_trees(empty, edits_col="edits")).count() == 0


def test_redaction_of_the_supplied_texts(spark, small, byte_tokenizer):
    import regex

    pattern = regex.compile(token_counts.REDACTED.replace(r"(?m:^", r"(?m:(?<=\n|\A)").replace("$)", r"(?=\n|\Z))"), regex.ASCII)
    found = {r["doc_id"]: r for r in token_counts.op2_token_counts(spark, small).collect()}
    edited = 0
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        after, n = pattern.subn(token_counts.MARK, r["text"] or "")
        got = found[r["doc_id"]]
        assert (got["n_edits"], got["tokens_before"], got["tokens_after"]) == (n, byte_tokenizer(r["text"] or ""), byte_tokenizer(after))
        edited += n
    assert edited > 0


# ---- language -------------------------------------------------------------------------------------------


def test_gru_gradients_against_differences():
    rng = np.random.default_rng(2)
    model = language_id.ByteGRU(["a", "b", "c"], hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    windows = rng.integers(97, 101, (5, 7)).astype(np.uint8)
    labels, sizes = rng.integers(0, 3, 5), np.array([7, 7, 3, 1, 7])
    _, grads = model.gradients(windows, labels, sizes)
    for key, value in model.p.items():
        flat = value.reshape(-1)
        places = rng.choice(flat.size, min(12, flat.size), replace=False) if key != "table" else [97, 98 + 256, 99 + 256 * 4, 100 + 256 * 8, 97 + 256 * 12]
        for i in places:
            kept, step = flat[i], 1e-2
            flat[i] = kept + step
            up, _ = model.gradients(windows, labels, sizes)
            flat[i] = kept - step
            down, _ = model.gradients(windows, labels, sizes)
            flat[i] = kept
            assert grads[key].reshape(-1)[i] == pytest.approx((up - down) / (2 * step), abs=3e-3)


def test_every_byte_is_in_exactly_one_window():
    texts = [b"", b"abc", bytes(range(1, 130)), b"x" * 64, b"y" * 65]
    windows, owners, sizes = language_id.cut(texts)
    for i, text in enumerate(texts):
        assert b"".join(w[:s].tobytes() for w, o, s in zip(windows, owners, sizes) if o == i) == text


def test_language_of_held_out_documents(spark, small):
    path = small.replace("0.001", "0.01")
    found = {r["doc_id"]: r for r in language_id.op5_identify_language(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    assert len(found) == len(docs)
    right = []
    for r in docs:
        got = found[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= got["score"] <= 1
        if got["held_out"] and any(c.isalpha() for c in r["text"] or ""):
            right.append(got["lang_pred"] == r["lang"])
    assert np.mean(right) > 0.95


def test_language_of_odd_rows(spark):
    docs = odd_documents(spark)
    model = language_id.learn(docs)
    assert set(model.languages) <= {"en", "de", "fr"}
    found = language_id.identify(docs, model).collect()
    assert len(found) == docs.count()
    by = {r["doc_id"]: r for r in found}
    for i in (4, 5, 6, 11):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert by[7]["lang_pred"] in model.languages
    assert language_id.learn(docs.withColumn("lang", language_id.F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(no_documents(spark), model).count() == 0


def test_no_language_is_lost_from_the_sample(spark, monkeypatch):
    """More languages than full shares fit in the sample, some of few documents, one with few readable ones."""
    learned = []
    monkeypatch.setattr(language_id.ByteGRU, "fit", lambda self, windows, labels, sizes: learned.extend(self.languages[i] for i in labels))
    many = language_id.SAMPLE // language_id.PER_LANGUAGE + 1
    frequent = spark.range(many * 2_000).selectExpr("id doc_id", f"concat('f', id % {many}) lang", "'words' text")
    rare = spark.range(10**6, 10**6 + 200).selectExpr("id doc_id", "concat('r', id % 20) lang", "'words' text")
    numbers = spark.range(2 * 10**6, 2 * 10**6 + 60_000).selectExpr("id doc_id", "'numbers' lang", "if(id % 20000 = 0, 'words', '12') text")
    docs = frequent.union(rare).union(numbers)
    model = language_id.learn(docs)
    free = docs.filter(~language_id.held_out("doc_id")).filter("text = 'words'").groupBy("lang").count().collect()
    assert set(model.languages) == {r["lang"] for r in free} and len(free) == many + 21
    each = language_id.SAMPLE // len(free)
    assert {lang: learned.count(lang) for lang in model.languages} == {r["lang"]: min(r["count"], each) for r in free}


# ---- packing --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(packing.vocabulary_path())
    return lambda text: made.encode(text, add_special_tokens=False).ids


def test_word_ids_are_those_of_the_whole_text(word_tokenizer):
    rng, tokens = random.Random(4), word_tokens(packing.vocabulary_path())
    texts = [_random_text(rng, rng.randint(0, 300)) for _ in range(300)]
    texts += ["", "a<|endoftext|>b <|startoftext|>", "It's don't I'LL x.", "Åström ΑΣ ΣΑΣ", "\x0b\x1c\x85　a b", "Ünïcödé... naïve, co-op", LONG[:5000]]
    for text in texts:
        assert np.frombuffer(tokens.ids(text.encode()), "<u4").tolist() == word_tokenizer(text), text


@pytest.mark.parametrize("text", ["<|ENDOFTEXT|>", "<|EndOfText|> A", "a<|STARTOFTEXT|>b, <|startoftext|>", "X<|endoftext|>Y.", "É<|EndOfText|>", "<|ENDOFTEXT|>,<|endoftext|>"])
def test_added_tokens_in_any_case(word_tokenizer, text):
    tokens = word_tokens(packing.vocabulary_path())
    for t in (text, text.lower(), text):
        assert np.frombuffer(tokens.ids(t.encode()), "<u4").tolist() == word_tokenizer(t), t


def _check_packed(rows, documents, word_tokenizer, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 > 0
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for sequence in sequences.values():
        at = 0
        for r in sorted(sequence, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    for doc_id, texts in documents.items():
        want = sorted(np.array([*word_tokenizer(t or ""), 1], "<u4").tobytes() for t in texts)
        got = sorted(pieces[doc_id], key=lambda r: r["start"])
        assert sum(r["length"] for r in got) == sum(len(w) // 4 for w in want)
        if len(texts) == 1:
            assert b"".join(bytes(r["ids"]) for r in got) == want[0]
            assert all(r["doc_tokens"] == len(want[0]) // 4 for r in got)
            assert [r["start"] for r in got] == np.cumsum([0, *[r["length"] for r in got[:-1]]]).tolist()
    return sequences


def test_packing_of_odd_rows(spark, word_tokenizer):
    docs = odd_documents(spark)
    rows = packing.pack(docs.coalesce(1), buffer_sequences=4, capacity=64).collect()
    documents = defaultdict(list)
    for r in docs.collect():
        documents[r["doc_id"]].append(r["text"])
    sequences = _check_packed(rows, documents, word_tokenizer, 64)
    total = sum(r["length"] for r in rows)
    assert len(sequences) == -(-total // 64)  # one task: no padding but in the last sequence
    assert packing.pack(no_documents(spark)).count() == 0


def test_packing_of_the_supplied_texts(spark, small, word_tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    documents = {r["doc_id"]: [r["text"]] for r in docs.collect()}
    rows = packing.pack(docs).collect()
    sequences = _check_packed(rows, documents, word_tokenizer, packing.SEQUENCE)
    assert sum(r["length"] for r in rows) > 0.97 * packing.SEQUENCE * (len(sequences) - docs.rdd.getNumPartitions())
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.op8_pack_sequences(spark, small).collect()}
    assert all(digests[r["doc_id"], r["start"]] == zlib.crc32(r["ids"]) for r in rows)


def test_assignment_balances_cost():
    rng = random.Random(3)
    lengths = [rng.randint(1, 900) for _ in range(2_000)]
    count = sum(lengths) // 2048
    placed, rest = packing.assign(lengths, 2048, count)
    assert sum(n for _, _, n, _, _ in placed) == 2048 * count and sum(n for _, _, n in rest) == sum(lengths) - 2048 * count
    cost = np.zeros(count)
    for _, _, n, at, _ in placed:
        cost[at] += packing.cost(n)
    in_order = np.zeros(count + 2)
    at, room = 0, 2048
    for n in lengths:  # the plain way: one after the other, cut where a sequence ends
        while n:
            take = min(n, room)
            in_order[at] += packing.cost(take)
            n, room = n - take, room - take
            if not room:
                at, room = at + 1, 2048
    assert cost.std() < 0.5 * in_order[:count].std()


def test_redactions_lie_where_the_matches_do(spark):
    """Against Python's own search with the plain form of the pattern; long texts with many matches included."""
    plain = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+\d{1,3} \(\d{3}\) \d{3}-\d{4}|(?m:^Licensed under [^\n]*$)", re.A)
    rng = random.Random(9)
    parts = ["a", "@", ".", "b.c", "x@y.z", "+", "+q@b.c", "-", " ", "\n", "+1 (234) 567-8901", "Licensed under the A", "é", "日"]
    texts = ["", None, "x@y.z.+q@b.c", "me@a.b" * 3, "+1 (234) 567-8901" * 2, "Licensed under X\nLicensed under Y\n", "a@b " * 5_000, "a@b.cd " * 20_000]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", token_counts.redactions(F.coalesce("t", F.lit(""))).alias("e")).collect()
    assert len(got) == len(texts)
    for i, edits in got:
        wanted = [(m.start(), m.end() - m.start(), token_counts.MARK) for m in plain.finditer(texts[i] or "")][::-1]
        assert [tuple(e) for e in edits] == wanted, texts[i][:200]
    no_hints = df.select("i", token_counts.redactions(F.coalesce("t", F.lit("")), hints=()).alias("e")).collect()
    assert sorted(no_hints) == sorted(got)


def test_words_of_every_character(word_tokenizer):
    tokens = word_tokens(packing.vocabulary_path())
    for c in [*range(1, 0x370), *range(0x1E00, 0x2200)]:
        for text in (chr(c), f"ab{chr(c)}cD", f"1{chr(c)}'s", f"Don't,{chr(c)}'ve"):
            assert np.frombuffer(tokens.ids(text.encode()), "<u4").tolist() == word_tokenizer(text), text


def test_word_cache_stays_bounded(word_tokenizer):
    tokens = WordTokens(packing.vocabulary_path(), limit=50)
    for i in range(400):
        text = f"the w{i} word"
        assert np.frombuffer(tokens.ids(text.encode()), "<u4").tolist() == word_tokenizer(text)
        tokens.trim()
        assert len(tokens) + len(tokens._older) < 120
    assert b"the" in tokens or b"the" in tokens._older
    tokens.clear()
    assert not tokens and not tokens._older
