"""Chat formatting, page extraction, nearest neighbours, the n-gram join and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_frames import LONG, no_documents, odd_documents
from riskmart.llm import ann, chat_format, components, html_extract, ngram_join

# ---- chat formatting ------------------------------------------------------------------------------------

_PIECES = ["\\", "### ", "</turn>", "###", "Assistant: ", "User: ", "\n", "a", " ", "é", "@", ":", "</", "turn>"]
_TEXT = st.lists(st.sampled_from(_PIECES), max_size=9).map("".join)
_ROLE = st.one_of(st.sampled_from(["system", "user", "assistant", "User", "", "@"]), _TEXT)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(_ROLE, _TEXT), max_size=5))
def test_every_conversation_comes_back(turns):
    formatted, spans, _ = chat_format.format_conversation(turns)
    assert chat_format.parse(formatted) == turns
    loss = [chat_format.unescape(formatted[a:b]) for a, b in spans]
    assert loss == [text for role, text in turns if role == "assistant"]


def test_plain_texts_stay_as_they_are():
    formatted, _, escaped = chat_format.format_conversation([("user", "a \\ b # c"), ("assistant", "fine\\n")])
    assert escaped == 0 and formatted == "### User: a \\ b # c</turn>\n### Assistant: fine\\n</turn>\n"


@pytest.mark.parametrize("broken", ["x", "### User: a", "### User: a</turn>", "### User: ### User: </turn>\n", "### Nobody: a</turn>\n"])
def test_broken_texts_are_refused(broken):
    with pytest.raises(chat_format.GrammarError):
        chat_format.parse(broken)


def test_chats_of_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "second"), (1, 0, "user", "first"), (1, 0, "user", "first"), (1, None, None, None),
        (2, 0, "assistant", ""), (None, 0, "tool", LONG), (None, 1, "assistant", chat_format.CONFLICT_TEXT),
        (chat_format.CONFLICT_ID, 0, "user", chat_format.CONFLICT_TEXT), (chat_format.CONFLICT_ID, 1, "assistant", chat_format.CONFLICT_TEXT),
    ]
    table = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat_format.format_chats(table)
    got = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    assert set(got) == {1, 2, None, -7}
    digest = lambda turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1]["turns_sha256"] == digest([("", ""), ("user", "first"), ("user", "first"), ("assistant", "second")])
    assert (got[1]["n_turns"], got[1]["loss_chars"]) == (4, 6)
    assert got[None]["turns_sha256"] == digest([("tool", LONG), ("assistant", chat_format.CONFLICT_TEXT)])
    assert got[-7]["loss_sha256"] == hashlib.sha256(chat_format.CONFLICT_TEXT.encode()).hexdigest()
    assert {r["conv_id"]: len(r["formatted"]) for r in formatted.collect()} == {k: r["formatted_chars"] for k, r in got.items()}
    assert chat_format.format_chats(table.limit(0)).count() == 0


# ---- page extraction ------------------------------------------------------------------------------------


def test_lstm_gradients_against_differences():
    rng = np.random.default_rng(1)
    model = html_extract.BiLSTM(inputs=4, hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x = rng.standard_normal((5, 3, 4))
    y = (rng.random((5, 3)) < 0.5).astype(float)
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 0, 1], [1, 0, 1], [1, 0, 0]], float)
    x *= mask[:, :, None]
    _, grads = model.gradients(x, y, mask)
    for key, value in model.p.items():
        flat = value.reshape(-1)
        for i in rng.choice(flat.size, min(10, flat.size), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-2
            up, _ = model.gradients(x, y, mask)
            flat[i] = kept - 1e-2
            down, _ = model.gradients(x, y, mask)
            flat[i] = kept
            assert grads[key].reshape(-1)[i] == pytest.approx((up - down) / 2e-2, abs=2e-3)


@pytest.mark.parametrize("page, texts", [
    ("", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a<b>b</b> c<br>d<p>e", ["ab c d", "e"]),
    ("<div>x<script>var p='</p>'</script>y</div>z", ["x", "y", "z"]), ("<style>p{}</style><!-- <p>no</p> --><p>1 < 2", ["1 < 2"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]), ("<title>t</title><p>&#233;&eacute;&nbsp;x", ["éé x"]),
    ("<p title='a>b'>q</p></div></p>r", ["q", "r"]), ("<textarea>no</textarea><p>yes", ["yes"]), ("<p>un<!-- never closed <p>x", ["un"]),
])
def test_leaf_blocks(page, texts):
    assert [b.text for b in html_extract.leaf_blocks(page)] == texts


@pytest.mark.parametrize("page, texts", [
    ("<p>Speed is <math><mi>x</mi></math> today", ["Speed is x today"]), ("<p>A <object data=a> tail</p><p>More</p>", ["A tail", "More"]),
    ("<p>one<svg>two</p><p>three</p>", ["onetwo", "three"]), ("<p>one <svg><text>no</text></svg>two</p>", ["one two"]),
    ("<div>a<video><p>no</p></video>b</div><p>c", ["ab", "c"]), ("<select><option>no<option>no</select>t", ["t"]), ("<p>a<canvas><p>b</p>c", ["a", "b", "c"]),
    ("<noscript><p>no</p></noscript><p>k", ["k"]), ("<svg><svg>no</svg></svg>x", ["x"]), ("<div><svg><p>a</p></div><svg>no</svg>b", ["a", "b"]),
    ("<p>a<b c</p><p>d", ["a<b c", "d"]), ("<p>x</p><title>t", ["x", "t"]), ("<p>a <x-tag>b</p>", ["a", "b"]),
])
def test_no_text_is_lost_to_unclosed_elements(page, texts):
    assert [b.text for b in html_extract.leaf_blocks(page)] == texts


@pytest.mark.parametrize("unit", ["x <y ", '<p class="x', "<div>", "</p>", "<ul><li>", "<svg>", "<!-- x", "<title>", "<svg><object></svg>", "<p>a<svg>b</svg>", "<foo><p>x", "<a '"])
def test_broken_markup_costs_linear_time(unit):
    start = time.perf_counter()
    html_extract.leaf_blocks(unit * 100_000)
    html_extract.leaf_blocks("<div>" * 5_000 + unit * 20_000 + ">")
    assert time.perf_counter() - start < 10  # takes about one second; the square of it would take hours


@pytest.fixture(scope="module")
def page_model(spark, small):
    return html_extract.fit_on(spark.read.parquet(small.replace("0.001", "0.01") + "/pages.parquet"))


def test_article_of_the_supplied_pages(spark, small, page_model):
    pages = spark.read.parquet(small.replace("0.001", "0.01") + "/pages.parquet")
    html_of = {r["page_id"]: r["html"] for r in pages.collect()}
    found = html_extract.extract(pages, page_model).collect()
    assert len(found) == len(html_of)
    right = 0
    for r in found:
        article = re.search(r"<article>(.*?)(?:</article>|<footer)", html_of[r["page_id"]] or "", re.S)
        want = " ".join(b.text for b in html_extract.leaf_blocks(article[1])) if article else ""
        right += r["text"] == want
        assert r["n_chars"] == len(r["text"])
    assert right >= 0.99 * len(found)


def test_layouts_never_seen(page_model):
    """Pages put together with another seed: nearly every block is labelled as it was placed."""
    pages = html_extract.training_pages(["<article><p>" + "</p><p>".join(
        f"Sentence {i} of a story that has words and some more words." for i in range(60)) + "</p></article><footer>Imprint</footer>"], 200, seed=99)
    labels = page_model.label([html_extract.features(p) for p in pages])
    truth = np.concatenate([[b.main for b in p] for p in pages])
    assert (np.concatenate(labels) == truth).mean() > 0.97


def _labels_by_hand(model, page):
    """One block after the other in both directions, in double precision; None where the model is undecided."""
    x = html_extract.features(page).astype(float)
    p = {k: v.astype(float) for k, v in model.p.items()}
    n = model.hidden
    states = {}
    for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        h, c = np.zeros(n), np.zeros(n)
        for t in order:
            a = x[t] @ p["x" + d] + h @ p["h" + d] + p["c" + d]
            i, f, o = (1 / (1 + np.exp(-a[k * n:(k + 1) * n])) for k in range(3))
            c = f * c + i * np.tanh(a[3 * n:])
            h = o * np.tanh(c)
            states[d, t] = h
    scores = [np.concatenate([states["f", t], states["b", t]]) @ p["o"] + p["z"][0] for t in range(len(x))]
    return [None if abs(s) < 1e-3 else s > 0 for s in scores]


def test_labels_against_one_page_at_a_time(page_model):
    pages = html_extract.training_pages([], 60, seed=3)
    labels = page_model.label([html_extract.features(p) for p in pages])
    for page, found in zip(pages, labels):
        for by_hand, label in zip(_labels_by_hand(page_model, page), found):
            assert by_hand is None or by_hand == label


def test_pages_of_odd_rows(spark, page_model):
    rows = [(1, None, None, "t"), (2, "u", "", "t"), (3, "u", "<", "t"), (None, "u", "<article><p>" + LONG + "</article>", "t"), (4, "u", "<div", "t"), (4, "u", "<div", "t")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_extract.extract(table, page_model).collect()
    assert len(found) == len(rows)
    by = {r["page_id"]: r for r in found}
    assert (by[1]["text"], by[2]["text"], by[None]["text"]) == ("", "", LONG.strip())
    assert html_extract.extract(table.limit(0), page_model).count() == 0
    assert html_extract.fit_on(table.limit(0)) is not None


# ---- nearest neighbours ---------------------------------------------------------------------------------


def _exact_neighbours(ids, vectors, query, k):
    q = vectors[ids.index(query)]
    scored = sorted((-float(np.dot(v, q) / np.sqrt(np.dot(v, v) * np.dot(q, q))), i) for i, v in zip(ids, vectors) if i != query)
    return scored[:k]


def test_recall_on_the_supplied_vectors(spark, small):
    path = small.replace("0.001", "0.1")
    table = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in table], [np.array(r["embedding"], float) for r in table]
    found = defaultdict(list)
    for r in ann.op4_nearest_vectors(spark, path).collect():
        found[r["query_id"]].append(r)
    assert set(found) == {i for i in ids if i % 50 == 0}
    hits = total = 0
    matrix = np.array(vectors)
    length = np.sqrt((matrix ** 2).sum(axis=1))
    for query, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        scores = matrix @ matrix[ids.index(query)] / (length * length[ids.index(query)])
        scores[ids.index(query)] = -2
        best = {ids[i] for i in np.lexsort((ids, -scores))[:5]}
        hits += len(best & {r["vec_id"] for r in rows})
        total += 5
        for r in rows:
            assert r["score"] == pytest.approx(scores[ids.index(r["vec_id"])], abs=1e-12)
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
    assert hits / total >= 0.9


def test_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]),
            (8, [-1.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0]), (11, [1e300, 1e300]), (12, [1e-300, 0.0]), (13, []), (None, [1.0, 0.0]), (0, [1.0, 0.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    found = ann.nearest(table, table.filter("vec_id in (0, 3, 9)"), k=3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in found] == [(0, 1, 9), (0, 2, 10), (0, 3, 12), (9, 1, 0), (9, 2, 10), (9, 3, 12)]
    assert all(r["score"] == pytest.approx(1.0) for r in found)
    assert ann.nearest(table, table.filter("vec_id = 0"), k=50).count() == 6
    assert ann.nearest(table.limit(0), table.limit(0)).count() == 0


def test_equal_vectors_go_by_id(spark):
    table = spark.range(3_000).selectExpr("id as vec_id", "if(id % 2 = 0, array(0.5F, 0.25F, 1F), array(float(id), 1F, float(-id % 7))) as embedding")
    found = ann.nearest(table, table.filter("vec_id in (0, 100)"), k=4).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in found] == [2, 4, 6, 8, 0, 2, 4, 6]


def test_adaptive_scan_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(0)
    rows = ann._unit(rng.standard_normal((3_000, 64)) + 2 * rng.standard_normal((1, 64)))
    turned = rows @ ann.rotation(64)
    blocks = [np.ascontiguousarray(turned[:, i:i + 16]) for i in range(0, 64, 16)]
    q, r = ann.adaptive_scan(turned[:40], blocks, 6)
    hits = sum(len(set(r[q == i]) & set(np.argsort(-(rows @ rows[i]))[:6])) for i in range(40))
    assert hits >= 0.98 * 240


def test_centres_are_fitted_without_a_matrix_of_all_scores():
    """Rows are scored piece by piece: the driver holds the sample, not a value for each row and centre."""
    import tracemalloc

    rng = np.random.default_rng(0)
    sample = ann._unit(rng.standard_normal((40_000, 8)))
    sample[1_000:2_000] = sample[0]  # equal centres of these stay empty
    tracemalloc.start()
    centres = ann.fit_centres(sample, 1_000, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # all scores are 320 MB
    whole, moved = sample[np.random.default_rng(7).choice(len(sample), 1_000, replace=False)], 0
    for _ in range(2):
        near = sample @ whole.T - (whole * whole).sum(axis=1) / 2
        label = near.argmax(axis=1)
        counts = np.bincount(label, minlength=1_000)
        sums = np.zeros_like(whole)
        np.add.at(sums, label, sample)
        whole = sums / np.maximum(counts, 1)[:, None]
        empty = np.flatnonzero(counts == 0)
        moved += len(empty)
        whole[empty] = sample[np.argsort(near.max(axis=1))[:len(empty)]]
    assert moved and np.allclose(centres, whole)


def test_a_batch_of_queries_is_copied_to_its_lists_piece_by_piece(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    vectors, spread = rng.standard_normal((500, 8)), ann.rotation(8)
    centres = ann.fit_centres(ann._unit(vectors) @ spread, 40)
    column = pa.array(list(vectors), pa.list_(pa.float64()))
    batches = [pa.RecordBatch.from_arrays([pa.array(range(500)), column], names=["vec_id", "v"]).slice(3, 400)]
    indexed = [pa.RecordBatch.from_arrays([column, pa.array([[i] for i in range(500)])], names=["v", "ids"]).slice(3, 400)]
    whole = [pa.Table.from_batches(task(b)) for task, b in ((ann._choose(spread, centres, 20), batches), (ann._assign(spread, centres), indexed))]
    assert [len(t) for t in whole] == [400 * 20, 400] and whole[1].column("ids").to_pylist() == [[i] for i in range(3, 403)]
    monkeypatch.setattr(ann, "SCORES", 2_000)
    copies, labels = list(ann._choose(spread, centres, 20)(batches)), list(ann._assign(spread, centres)(indexed))
    assert len(copies) > 1 and max(len(b) for b in copies) * 8 <= 2_000 and max(len(b) for b in labels) * 40 <= 2_000
    assert pa.Table.from_batches(copies).equals(whole[0]) and pa.Table.from_batches(labels).equals(whole[1])


# ---- n-gram join ----------------------------------------------------------------------------------------


def _brute_groups(texts: dict):
    sets = {}
    for key, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})))
        width = min(5, len(words))
        sets[key] = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.fixture(scope="module")
def near_copies():
    """Groups of near copies around the threshold, a passage in many texts, exact copies, short texts."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    passage = " ".join(word() for _ in range(30))
    texts = []
    for group in range(14):
        base = [word() for _ in range(rng.choice([7, 30, 80, 200]))]
        for _ in range(rng.choice([2, 5, 24])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(40)) + " " + passage for _ in range(40)]
    texts += [texts[0], texts[3].upper(), "", None, "one", "One", "one two", " \t"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("few, common, block", [(64, 100_000, 256), (2, 100_000, 3), (3, 1, 4), (1, 5, 1000)])
def test_groups_against_all_pairs(spark, near_copies, few, common, block):
    docs = spark.createDataFrame(list(near_copies.items()), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_groups(docs, few=few, common=common, block=block).collect()}
    assert found == _brute_groups(near_copies)


def test_trie_join_against_all_pairs():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 10**6, 90))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.2])], rng.integers(0, 10**6, rng.integers(0, 12))])) for _ in range(60)]
    want = {(i, j) for i, a in enumerate(sets[:25]) for j, b in enumerate(sets) if 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b))}
    assert set(ngram_join.trie_join(sets[:25], sets)) == want and len(want) > 25
    assert list(ngram_join.trie_join([], sets)) == [] and list(ngram_join.trie_join(sets, [])) == []


def test_one_row_of_each_group_stays(spark, near_copies):
    groups = _brute_groups(near_copies)
    docs = spark.createDataFrame([(i, t, "k") for i, t in near_copies.items()], "doc_id long, text string, row_key string")
    kept = ngram_join.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, root) in groups.items() if i == root)


def test_groups_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = ngram_join.jaccard_groups(docs).collect()
    assert len(found) == docs.count()
    by = defaultdict(set)
    for r in found:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by[1] == by[2] == by[3] == {(6, 1)}
    assert by[4] == {(0, 4)} and by[5] == {(0, 5)} and by[6] == {(0, 6)} and by[None] == {(7, None)} and by[8] == {(1, 8), (5, 8)}
    kept = ngram_join.first_of_groups(docs).collect()
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept)
    assert [i for _, i in ids] == [1, 4, 5, 6, 7, 8, 8, 10, 11, 0]
    assert ngram_join.first_of_groups(no_documents(spark)).count() == 0
    assert ngram_join.jaccard_groups(no_documents(spark)).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(3, 3), (200, 201), (201, 200)]
    rng.shuffle(links)
    got = dict(components.components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 7 for i in range(8, 30)}, 201: 200}


# ---- pipeline -------------------------------------------------------------------------------------------


def test_pipeline_against_plain_python(spark, small):
    """Each stage on its own input: toxicity by hand, dedup and join by brute force, mixing and packing by their sums."""
    import corpus_pipeline
    from riskmart.llm import mixing, toxicity
    from riskmart.llm.common import written
    from riskmart.llm.word_tokens import word_tokens

    docs = spark.read.parquet(f"{small}/documents.parquet")
    outputs, current = [docs], docs
    for name, stage in corpus_pipeline.STAGES:
        current = written(stage(spark, current, small), "test")
        outputs.append(current)
    raw, clean, single, near, mixed = [[r.asDict() for r in o.collect()] for o in outputs[:5]]
    assert all(o.columns == docs.columns for o in outputs[:5])
    model = toxicity.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    weight = dict(zip(model.features.tolist(), model.weights))
    rejected = lambda t: sum(weight.get(f, 0.0) for f in toxicity.text_features(t)) >= model.thresholds[0]
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in raw if not rejected(r["text"]))
    last = {}
    for r in clean:
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    assert sorted(r["doc_id"] for r in single) == sorted(last.values())
    groups = _brute_groups({r["doc_id"]: r["text"] for r in single})
    assert sorted(r["doc_id"] for r in near) == sorted(i for i, (_, root) in groups.items() if i == root)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(outputs[3]).collect()}
    seen = defaultdict(int)
    for r in mixed:
        seen[r["doc_id"]] += 1
    assert dict(seen) == {i: n for i, n in copies.items() if n}
    from riskmart.llm.packing import vocabulary_path

    tokens = word_tokens(vocabulary_path())
    want = defaultdict(int)
    for r in mixed:
        want[r["doc_id"]] += len(tokens.ids(r["text"].encode())) // 4 + 1
    packed = defaultdict(int)
    for r in current.collect():
        packed[r["doc_id"]] += r["length"]
    assert packed == want
    assert corpus_pipeline.run(spark, small).count() == current.count()


def test_stages_keep_columns_of_any_name(spark, small):
    """Odd rows and empty tables through every stage; columns named like the operators' own come back as they were."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    names = ["severity", "P_toxic", "grade", "rejected", "keep_id", "group_size", "source_size", "target", "taken", "Copies", "copy_", "row_key", "in0_", "a.b"]
    extra = {n: F.lit(f"own {n}") for n in names}
    for name, stage in corpus_pipeline.STAGES:
        docs = odd_documents(spark).withColumns(extra)
        got = stage(spark, docs, small)
        plain = stage(spark, odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars"), small)
        key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
        assert sorted(map(key, got.collect())) == sorted(map(key, plain.collect())), name
        assert stage(spark, no_documents(spark).withColumns(extra), small).count() == 0
        if name != "packing":
            assert got.dtypes == docs.dtypes, name
            for r in got.collect():
                assert [r[n] for n in names] == [f"own {n}" for n in names], name
                assert (r["kept"], r["size"], r["rank"], r["text_sha256"], r["block_"], r["key_"]) == ("x", "y", 1, 2, 3, "z"), name
