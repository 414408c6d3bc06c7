"""Exact deduplication and mixing against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from llm_frames import no_documents, odd_documents
from riskmart.llm import exact_dedup, mixing


def _brute_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return {
        text: (max((i for i in ids if i is not None), default=None), len(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
    }


@pytest.mark.parametrize("bits", [1 << 27, exact_dedup.BLOCK_BITS])
@pytest.mark.parametrize("hot", [4096, 0, 1])
def test_exact_dedup_of_odd_rows(spark, bits, hot, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_GROUPS", hot)
    docs = odd_documents(spark)
    found = exact_dedup.exact_dedup(docs, filter_bits=bits)
    assert set(found.columns) == {*docs.columns, "keep_id", "group_size"}
    want = _brute_dedup([(r["doc_id"], r["text"]) for r in docs.collect()])
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        keep, size, digest = want[r["text"] or ""]
        assert (r["keep_id"], r["group_size"], r["text_sha256"]) == (keep, size, digest)
        assert not r["kept"] or r["doc_id"] == keep
        assert r["block_"] == 3 and r["key_"] == "z"
    # Exactly one row of each group stays, also where rows repeat id and text.
    assert Counter(r["text"] or "" for r in rows if r["kept"]) == Counter(want.keys())


def test_exact_dedup_full_filter_changes_nothing(spark):
    """With every bit set all rows take the shuffled way; the result is the same."""
    docs = spark.range(3_000).selectExpr("id as doc_id", "concat('t', id % 1200) as text")
    small = exact_dedup.decide(docs, filter_bits=exact_dedup.BLOCK_BITS)
    large = exact_dedup.decide(docs)
    assert sorted(small.collect()) == sorted(large.collect())
    assert small.filter("kept").count() == 1200


def test_unique_rows_are_not_shuffled(spark):
    docs = spark.range(100).selectExpr("id as doc_id", "concat('t', id) as text")
    digests, bloom, bits, _ = exact_dedup._passes(docs, "doc_id", "text", exact_dedup.MOST_BITS)
    assert bits == exact_dedup.BLOCK_BITS
    probed = exact_dedup.may_repeat(digests, bloom, bits)
    assert probed.filter("maybe_").count() == 0
    assert "hashpartitioning" not in probed.filter("not maybe_")._jdf.queryExecution().executedPlan().toString()


def test_the_filter_grows_with_the_repeated_texts(spark):
    """The share of rows taken for repeated ones stays the same, whatever their number; beyond the bound it grows."""
    repeated = spark.range(60_000).selectExpr("xxhash64(id) as h")
    bits = exact_dedup.sized_filter(60_000)
    others = spark.range(400_000).selectExpr("sha2(concat('x', id), 256) as text_sha256")
    hit = exact_dedup.may_repeat(others, exact_dedup.bloom_filter(repeated, bits), bits).filter("maybe_").count()
    assert 0 < hit < 400_000 * 0.004
    assert exact_dedup.sized_filter(0) == exact_dedup.BLOCK_BITS
    assert exact_dedup.sized_filter(10**12) == exact_dedup.MOST_BITS
    assert exact_dedup.sized_filter(10**6) >= 16 * 10**6 > exact_dedup.sized_filter(10**6) - exact_dedup.BLOCK_BITS


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(no_documents(spark)).count() == 0


def _brute_targets(sizes, weights=(5, 2, 1), most=3):
    keys = sorted(sizes)
    w = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    target, free, left = {}, set(keys), float(sum(sizes.values()))
    while free:
        share = left / sum(w[k] for k in free)
        over = {k for k in free if share * w[k] > most * sizes[k]}
        if not over:
            target |= {k: share * w[k] for k in free}
            break
        for k in over:
            target[k] = float(most * sizes[k])
            left -= target[k]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"sa": 100}, {"sa": 10, "sb": 1000, "sc": 5}, {"sa": 0, "sb": 7}, {"sa": 0}, {"sa": 1, "sb": 1, "sc": 1, "sd": 997, "se": 3, "z": 8},
])
def test_targets_against_repeated_sharing(spark, sizes):
    table = spark.createDataFrame([(k, v) for k, v in sizes.items()], "key_ string, source_size long")
    got = {r["key_"]: r["target"] for r in mixing.targets(table).collect()}
    assert got == pytest.approx(_brute_targets(sizes), abs=1e-6)


def test_mixing_of_odd_rows(spark):
    docs = odd_documents(spark)
    mixed = mixing.mix(docs)
    assert set(mixed.columns) == {*docs.columns, "source_size", "target", "taken", "copies"}
    rows = mixed.collect()
    assert len(rows) == docs.count()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] += r["size"]
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
    assert sorted(map(repr, mixing.mix(docs.repartition(5)).collect())) == sorted(map(repr, rows))
    narrow = ["doc_id", "size", "source_size", "target", "taken", "copies"]
    decided = mixing.decide(docs)
    assert decided.columns == narrow
    assert sorted(map(repr, decided.collect())) == sorted(map(repr, mixed.select(*narrow).collect()))
    emitted = mixing.emit(mixed)
    assert emitted.count() == sum(r["copies"] for r in rows)
    assert "copies" not in emitted.columns


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(6_000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source", "repeat('w ', cast(1 + id * id % 97 as int)) as text"
    )
    by = mixing.mix(docs).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in by:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 2 * 97 + 0.01 * r["max(target)"]


def test_size_classes_grow_with_the_size(spark):
    got = [r[0] for r in spark.range(0, 5_000).select(mixing._class(mixing.F.col("id"))).collect()]
    assert got == sorted(got) and len(set(got)) < 120


def test_mixing_of_nothing(spark):
    assert mixing.mix(no_documents(spark)).count() == 0
    assert mixing.decide(no_documents(spark)).count() == 0
