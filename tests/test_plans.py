"""The four jobs on a small lake, and the shapes of the physical plans."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from frames import rows
from riskmart import zones as z
from riskmart.ml import models
from riskmart.ml.models import ModelSpec
from riskmart.operators import dedupe, features, intervals
from riskmart.plans import daily, exploitation, formatting, landing, training
from riskmart.sources import readers
from riskmart.workload.registry import Tables
from riskmart.zones import Zones

RUN_TS = datetime(2025, 1, 2)


def award(i, rng):
    risky = i % 4 == 0
    return {
        "id": f"{i:07d}",
        "startDate": f"{1 + i % 12:02d}/15/{2022 + i % 2}",
        "date": f"0{1 + i % 9}/01/2022",
        "estimatedTotalAmt": str(1000 + 10 * i),
        "fundsObligatedAmt": str(500 + rng.randrange(500)) if i % 10 else "n/a",
        "perfStateCode": ["MA", "NY", "TX"][i % 3],
        "title": "Study of bias" if risky else "Study of rocks",
        "abstractText": "equity and gender equity" if risky else "stones, sand and clay",
        "agency": "X",
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Landing and formatted zones filled from raw files: 240 awards over two years."""
    root = tmp_path_factory.mktemp("lake")
    raw, zones = root / "raw", Zones(str(root / "zones"))
    rng = random.Random(5)
    for year in (2022, 2023):
        folder = raw / "pages" / f"year={year}"
        folder.mkdir(parents=True)
        mine = [award(i, rng) for i in range(240) if 2022 + i % 2 == year]
        mine.append(dict(mine[0], title="older duplicate", date="01/01/2001"))
        for offset in range(0, len(mine) + 1, 25):
            body = {"response": {"award": mine[offset:offset + 25]}}
            (folder / f"{offset}.json").write_text(json.dumps(body))
    terminated = ["Grant Number,In Cruz List,USAspending Obligated,Termination Date"]
    terminated += [f"{i},{'yes' if i % 8 == 0 else 'no'},12.5,04/18/2025" for i in range(0, 240, 4) if i % 5]
    (raw / "terminated.csv").write_text("\n".join(terminated))
    review = ["AWARD ID,Total Award Funding Amount,Gender Category,Start-Date"]
    review += [f"{i}.0,1e5,{'NULL' if i % 2 else 'Gender'},2022-01-01" for i in range(0, 240, 6)]
    (raw / "review.csv").write_text("\n".join(review))
    (raw / "lexicon.csv").write_text("flagged_word\n Bias\nequity\nEQUITY\ngender\nhate speech\n")
    people = [
        {"id": {"bioguide": "B1"}, "terms": [
            {"type": "rep", "state": "MA", "start": "2021-01-03", "end": "2023-01-03", "party": "Democrat"},
            {"type": "rep", "state": "MA", "start": "2023-01-03", "end": "2025-01-03", "party": "Republican"},
            {"type": "sen", "state": "NY", "start": "2017-01-03", "end": "2023-01-03", "party": "Independent"},
        ]},
        {"id": {"bioguide": "B2"}, "terms": [{"type": "sen", "state": "TX", "start": "2021-01-03", "end": None}]},
    ]
    (raw / "people.json").write_text(json.dumps(people))
    source = str(raw / "pages")
    assert landing.land_awards(spark, zones, source, 2022, 2023).rows == 242
    assert landing.land_awards(spark, zones, source, 2022, 2022).rows == 121
    assert landing.land_csv(spark, zones, z.TERMINATED, str(raw / "terminated.csv")) == 48
    assert landing.land_csv(spark, zones, z.REVIEW_LIST, str(raw / "review.csv")) == 40
    assert landing.land_csv(spark, zones, z.LEXICON, str(raw / "lexicon.csv")) == 5
    assert landing.land_legislators(spark, zones, str(raw / "people.json")) == 2
    files = {
        z.AWARDS: source, z.TERMINATED: str(raw / "terminated.csv"), z.REVIEW_LIST: str(raw / "review.csv"),
        z.LEXICON: str(raw / "lexicon.csv"), z.LEGISLATORS: str(raw / "people.json"),
    }
    return zones, source, files


@pytest.fixture(scope="module")
def built(spark, lake):
    zones, _, _ = lake
    counts = formatting.format_all(spark, zones, RUN_TS)
    return zones, counts, exploitation.build_exploitation(spark, zones)


def test_landing_keeps_both_years_and_audits(spark, lake):
    zones, source, _ = lake
    years = readers.read_json_lines(spark, zones.landing(z.AWARDS)).groupBy("year").count()
    assert rows(years) == [(2022, 121), (2023, 121)]
    assert all(r["complete"] for r in landing.audit_awards(spark, source).collect())
    with pytest.raises(ValueError):
        landing.land_awards(spark, zones, source, 2023, 2022)


def test_formatted_zone(spark, built):
    zones, counts, _ = built
    assert counts == {"awards": 240, "terminated": 48, "review_list": 40, "legislators": 2, "lexicon": 4}
    awards = readers.read_table(spark, zones.formatted(z.AWARDS))
    first = awards.filter("award_id = '0000000'").first()
    assert first["title"] == "Study of bias" and first["startdate"] == datetime(2022, 1, 15)
    assert first["estimated_total_amt"] == 1000.0 and first["funds_obligated_amt"] is None
    assert first["formatted_at"] == RUN_TS
    assert rows(formatting.duplicates_removed(spark, zones)) == [(242, 240, 2)]
    listed = readers.read_table(spark, zones.formatted(z.REVIEW_LIST)).orderBy("award_id").first()
    assert listed["award_id"] == "0" and listed["total_award_funding_amount"] == 1e5 and listed["start_date"] == datetime(2022, 1, 1)
    ended = readers.read_table(spark, zones.formatted(z.TERMINATED)).filter("grant_number = '8'").first()
    assert ended["in_cruz_list"] is True and ended["termination_date"] == datetime(2025, 4, 18)
    assert rows(readers.read_table(spark, zones.formatted(z.LEXICON)).select("flagged_word")) == [
        ("bias",), ("equity",), ("gender",), ("hate speech",)
    ]
    totals = {r["dataset"]: r["n_rows"] for r in formatting.validate_formatted(spark, zones).collect()}
    assert totals["TOTAL"] == 334


def test_exploitation(spark, built):
    zones, _, parts = built
    assert sum(parts.values()) == 240 and set(parts) == {"train", "test"}
    train, test = readers.load_train(spark, zones), readers.load_test(spark, zones)
    assert (train.count(), test.count()) == (parts["train"], parts["test"])
    assert train.join(test, "award_id").count() == 0
    wide = {r["award_id"]: r for r in train.unionByName(test).collect()}
    for key, r in wide.items():
        i = int(key)
        assert r["is_terminated"] is (i % 4 == 0 and i % 5 != 0)
        assert r["in_cruz_list"] is (i % 6 == 0)
        assert r["flagged_word_count_abstract"] == (3 if i % 4 == 0 else 0)
        assert r["flagged_word_unique_abstract"] == (2 if i % 4 == 0 else 0)
        assert r["flagged_word_count_title"] == (1 if i % 4 == 0 else 0)
        assert r["flagged_word_diversity_score"] == (0.5 if i % 4 == 0 else 0.0)
        state, year = r["perfstatecode"], r["startdate_dt"].year
        assert r["representant"] == ({2022: "Democrat", 2023: "Republican"}[year] if state == "MA" else "Unknown")
        assert r["senator"] == ("Independent" if state == "NY" and year == 2022 else "Unknown")
    assert "abstract" not in train.columns and "abstracttext" not in train.columns


def test_a_repeated_day_gives_the_same_rows(spark, lake, built):
    zones, counts, parts = built
    before = rows(readers.load_train(spark, zones))
    again = daily.run(spark, zones, lake[2], 2022, 2023, RUN_TS)
    assert again["formatted"] == counts and again["integrated"] == parts and again["landed"]["awards"] == 242
    assert rows(readers.load_train(spark, zones)) == before


def test_absent_datasets_give_the_same_schema(spark, built):
    zones, _, _ = built
    awards = readers.read_table(spark, zones.formatted(z.AWARDS))
    full = exploitation.exploitation_frame(
        awards,
        readers.read_table(spark, zones.formatted(z.TERMINATED)),
        readers.read_table(spark, zones.formatted(z.REVIEW_LIST)),
        readers.read_table(spark, zones.formatted(z.LEGISLATORS)),
        readers.read_table(spark, zones.formatted(z.LEXICON)),
    )
    bare = exploitation.exploitation_frame(awards)
    assert bare.dtypes == full.dtypes
    assert bare.agg(F.max("is_terminated"), F.max("senator"), F.sum("flagged_word_count_title")).first() == (False, "Unknown", 0)


def test_empty_fact_stops_the_job(spark, tmp_path):
    with pytest.raises(ValueError):
        exploitation.build_exploitation(spark, Zones(str(tmp_path)))


def test_train_and_compare(spark, built):
    zones, _, _ = built
    specs = {
        "Random Forest": ModelSpec(models.RANDOM_FOREST, {"numTrees": 5, "maxDepth": 3}),
        "Gradient Boosted Trees": ModelSpec(models.GBT, {"maxIter": 2, "maxDepth": 2}),
        "Logistic Regression": ModelSpec(models.LOGISTIC, {"maxIter": 5}, {"regParam": [0.01, 0.1]}),
    }
    report = training.train_and_compare(spark, zones, "trial", specs, folds=2, partitions=2)
    table = {r["model"]: r for r in report["comparison"].collect()}
    assert set(table) == set(specs) and {r["position"] for r in table.values()} == {1, 2, 3}
    assert all(r["test_auc_roc"] > 0.7 and 0 <= r["val_f1"] <= 1 for r in table.values())
    assert 5 < report["importance_Random Forest"].count() <= 15
    assert "importance_Logistic Regression" not in report
    assert report["confusion"].count() == 12
    saved = spark.read.option("header", True).csv(f"{zones.reports}/trial/comparison")
    assert saved.count() == 3
    runs = readers.read_table(spark, zones.runs)
    assert rows(runs.select("run_name")) == sorted((n,) for n in specs)
    assert runs.filter("params['maxIter'] = '2' AND metrics['valid_accuracy'] IS NOT NULL").count() == 1
    experiment = training.Experiment(spark, zones, "trial")
    assert experiment.history().count() == 3
    tags = [t for r in experiment.tagged_runs().collect() for t in r["tags"]]
    assert sorted(tags) == ["best_accuracy", "best_f1"]


def test_experiment_guards_and_saved_model(spark, built):
    from pyspark.ml import PipelineModel

    zones, _, _ = built
    experiment = training.Experiment(spark, zones, "guards")
    with pytest.raises(ValueError):
        experiment.fit(ModelSpec(models.LOGISTIC), "r")
    with pytest.raises(ValueError):
        ModelSpec("svm")
    train = training.feature_frame(readers.load_train(spark, zones))
    experiment.load(train)
    model, found = experiment.fit(ModelSpec(models.LOGISTIC, {"maxIter": 3}), "lr", partitions=2)
    assert set(found) == {f"valid_{m}" for m in training.METRICS}
    with pytest.raises(ValueError):
        experiment.evaluate(model)
    experiment.load(train, training.feature_frame(readers.load_test(spark, zones)).withColumn("sample_weight", F.lit(1.0)))
    assert set(experiment.evaluate(model)) == {f"test_{m}" for m in training.METRICS}
    run_id = readers.read_table(spark, zones.runs).filter("experiment = 'guards'").first()["run_id"]
    again = PipelineModel.load(f"{zones.models}/{run_id}")
    assert rows(experiment.predict(again)) == rows(experiment.predict(model))


def test_forest_is_the_same_under_any_input_layout(spark, built):
    zones, _, _ = built
    train = training.feature_frame(readers.load_train(spark, zones))
    names = features.feature_columns(train, "is_terminated", drop=("award_id",))
    spec = ModelSpec(models.RANDOM_FOREST, {"numTrees": 5, "maxDepth": 3})
    seen = set()
    for n in (1, 5):
        laid_out = models.stable_layout(features.class_weights(train.repartition(n), "is_terminated"), "award_id", 3)
        seen.add(models.fit(spec, laid_out, "is_terminated", names).stages[-1].toDebugString.split("\n", 1)[1])
    assert len(seen) == 1


def test_published_grids_have_twelve_points():
    for grid in models.GRIDS.values():
        n = 1
        for values in grid.values():
            n *= len(values)
        assert n == 12


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_has_a_cross_join_or_python_worker(spark, small):
    for name in contract.oracle_sql():
        text = plan(contract.queries()[name](spark, small))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert node not in text, (name, node)


def test_dedupe_limits_groups_before_the_shuffle(spark, small):
    text = plan(dedupe.dedupe_latest(Tables(spark, small).events, ["user_id"], ["ts"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_range_and_columns_reach_the_scan(spark, small):
    text = plan(contract.queries()["year_range_scan"](spark, small))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text


def test_weights_do_not_shuffle_the_rows(spark, small):
    text = plan(contract.queries()["class_weights"](spark, small))
    assert "Join" not in text and "hashpartitioning" not in text


def test_lookup_does_not_shuffle_the_fact(spark, small):
    t = Tables(spark, small)
    fact = t.orders.select(
        "o_orderkey", "o_orderpriority", F.col("o_custkey").cast("string").alias("s"), F.col("o_orderdate").alias("d")
    )
    terms = spark.createDataFrame(
        [("rep", "1", datetime(1996, 1, 1), datetime(1998, 1, 1), "A")],
        "type string, state string, start timestamp, end timestamp, party string",
    )
    found = intervals.interval_lookup(fact, terms, "s", "d", {"rep": "r"})
    text = plan(found)
    assert "BroadcastHashJoin [_state" in text
    exchanges = [line for line in text.splitlines() if " Exchange " in line]
    assert exchanges and not any("o_orderkey" in line for line in exchanges)
