from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from frames import rows
from riskmart.operators import pages as paging
from riskmart.plans import formatting, landing
from riskmart.sinks import writers
from riskmart.sources import readers, schemas
from riskmart.zones import Zones


def test_csv_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("Award ID,Total Award\n0123456,1\n\"9,9\",x\n")
    df = readers.read_csv(spark, str(path))
    assert df.columns == ["Award ID", "Total Award", schemas.CORRUPT]
    df = df.drop(schemas.CORRUPT)
    assert rows(df) == [("0123456", "1"), ("9,9", "x")]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_array(spark, tmp_path, indent):
    people = [
        {"id": {"bioguide": "B1"}, "terms": [{"type": "rep", "state": "MA", "start": "2020-01-01", "end": "2022-01-01"}]},
        {"id": {"bioguide": "B2"}, "name": {"x": 1}, "terms": []},
    ]
    path = tmp_path / "people.json"
    path.write_text(json.dumps(people, indent=indent))
    df = readers.read_json_array(spark, str(path), schemas.LEGISLATOR)
    assert rows(df.select("id.bioguide", F.size("terms"))) == [("B1", 1), ("B2", 0)]
    assert readers.read_json_array(spark, str(path)).count() == 2


def test_json_years_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "awards")

    def write(year, ids, overwrite=True):
        df = spark.createDataFrame([(i, year) for i in ids], "id string, year int")
        writers.write_json_partitions(df, path, "year", overwrite)

    write(2022, ["a", "b"])
    write(2023, ["c"])
    write(2022, ["d"])
    assert rows(readers.read_json_lines(spark, path)) == [("c", 2023), ("d", 2022)]
    write(2023, ["e"], overwrite=False)
    assert rows(readers.read_json_lines(spark, path)) == [("c", 2023), ("d", 2022), ("e", 2023)]
    only = readers.read_json_lines(spark, path).filter("year = 2022")
    assert "PartitionFilters: [isnotnull(year" in only._jdf.queryExecution().toString()


def test_replace_and_count(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.replace_table(spark.range(10), path) == 10
    assert writers.replace_table(spark.range(3), path) == 3
    assert readers.read_table(spark, path).count() == 3


def test_optional_and_required(spark, tmp_path):
    path = str(tmp_path / "t")
    assert readers.read_optional(spark, path) is None
    with pytest.raises(ValueError):
        readers.read_required(spark, path)
    writers.replace_table(spark.range(0), path)
    with pytest.raises(ValueError):
        readers.read_required(spark, path)
    writers.replace_table(spark.range(1).withColumn("_id", F.lit("x")), path)
    assert readers.read_required(spark, path).columns == ["id"]


def test_keyed_layout(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("award_id"), (2020 + F.col("id") % 3).alias("year"))
    path = str(tmp_path / "keyed")
    assert writers.replace_keyed_table(df, path, "award_id", "year") == 1000
    assert {p for p in os.listdir(path) if p.startswith("year=")} == {"year=2020", "year=2021", "year=2022"}
    per_file = readers.read_table(spark, path).withColumn("f", F.col("_metadata.file_path"))
    assert per_file.select("f").distinct().count() == 3
    import pyarrow.parquet as pq

    part = os.path.join(path, "year=2020")
    name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
    keys = pq.read_table(os.path.join(part, name)).column("award_id").to_pylist()
    assert keys == sorted(keys)
    assert writers.replace_keyed_table(df.drop("year"), str(tmp_path / "flat"), "award_id", "year") == 1000


def test_partitioned_write_twice_gives_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "wide")
    df = spark.range(100).select("id", (F.col("id") % 2).alias("split"), (F.col("id") % 3).alias("year"))
    for _ in range(2):
        writers.write_partitioned(df, path, ["split", "year"])
        assert rows(spark.read.parquet(path).select("id", "split", "year")) == rows(df)


def test_report_is_one_csv(spark, tmp_path):
    path = tmp_path / "report"
    writers.write_report(spark.range(3).repartition(3), str(path))
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1 and (path / files[0]).read_text().splitlines()[0] == "id"


def page_files(root, spec):
    """``{year: {offset: number of awards | 'error' | 'broken'}}``"""
    for year, offsets in spec.items():
        folder = root / f"year={year}"
        folder.mkdir(parents=True)
        for offset, content in offsets.items():
            if content == "broken":
                text = '{"response": {"award": [{'
            elif content == "error":
                text = json.dumps({"response": {"serviceNotification": [{"code": 500}]}})
            else:
                awards = [{"id": f"{year}-{offset + i}", "title": "t"} for i in range(content)]
                text = json.dumps({"response": {"award": awards}}, indent=1)
            (folder / f"{offset}.json").write_text(text)
    return str(root)


SPEC = {
    2020: {0: 5, 5: 5, 10: 2},          # complete
    2021: {0: 5, 5: 5, 10: 0},          # complete, ends with an empty page
    2022: {0: 5, 10: 5, 15: 1},         # page 5 missing
    2023: {0: 5, 5: "error", 10: 5},    # error in the middle
    2024: {0: "broken", 5: 5},          # unreadable first page
    2025: {0: 5, 5: 3, 10: 5},          # short page in the middle
    2026: {5: 5, 10: 1},                # first page missing
}


def test_pages(spark, tmp_path):
    pages = readers.read_pages(spark, page_files(tmp_path / "pages", SPEC))
    got = {(r["year"], r["offset"]): (r["n_rows"], r["failed"]) for r in pages.collect()}
    assert got[(2020, 10)] == (2, False) and got[(2023, 5)] == (0, True) and got[(2024, 0)] == (0, True)
    # Every readable page is kept: after a hole, after a failed page, and without a first page.
    awards = landing.awards_of(pages)
    assert dict(rows(awards.groupBy("year").count())) == {2020: 12, 2021: 10, 2022: 11, 2023: 10, 2024: 5, 2025: 13, 2026: 6}
    audited = paging.page_audit(pages, "year", "offset", "n_rows", "failed", 5, range(2020, 2028))
    audit = {r["year"]: r for r in audited.collect()}
    assert {y for y, r in audit.items() if r["complete"]} == {2020, 2021}
    assert audit[2022]["missing_pages"] == 1 and audit[2023]["failed_pages"] == 1 and audit[2023]["early_short_pages"] == 0
    assert audit[2025]["early_short_pages"] == 1 and audit[2026]["missing_pages"] == 1
    assert (audit[2027]["n_pages"], audit[2027]["n_rows"], audit[2027]["complete"]) == (0, 0, False)


def test_audit_of_duplicate_and_misplaced_pages(spark):
    rows_ = [("a", 0, 25, False), ("a", 0, 25, False), ("a", 50, 3, False), ("b", 0, 25, False), ("b", 30, 2, False),
             ("c", 0, 0, True), ("c", 0, 25, False), ("c", 25, 1, False)]
    pages = spark.createDataFrame(rows_, "feed string, offset long, n_rows int, failed boolean")
    audit = {r["feed"]: r for r in paging.page_audit(pages, "feed", "offset", "n_rows", "failed").collect()}
    assert (audit["a"]["duplicate_pages"], audit["a"]["missing_pages"], audit["a"]["complete"]) == (1, 1, False)
    assert (audit["b"]["misaligned_pages"], audit["b"]["complete"]) == (1, False)
    assert (audit["c"]["failed_pages"], audit["c"]["n_rows"], audit["c"]["duplicate_pages"]) == (0, 26, 1)


def test_landing_keeps_fields_and_tells_what_is_missing(spark, tmp_path):
    source, zones = page_files(tmp_path / "pages", SPEC), Zones(str(tmp_path / "lake"))
    extra = {"response": {"award": [{"id": "x", "title": "t", "piEmail": "a@b", "cfda": ["1", "2"], "nested": {"k": 1}}]}}
    folder = tmp_path / "pages" / "year=2019"
    folder.mkdir()
    (folder / "0.json").write_text(json.dumps(extra))
    landed = landing.land_awards(spark, zones, source, 2019, 2021, rpp=5)
    assert landed.rows == 23 and all(r["complete"] for r in landed.audit)
    table = readers.read_json_lines(spark, zones.landing("awards"), schemas.LANDED_AWARD)
    kept = table.filter("id = 'x'").first()["extra"]
    assert kept["piEmail"] == "a@b" and json.loads(kept["cfda"]) == ["1", "2"] and json.loads(kept["nested"]) == {"k": 1}
    with pytest.raises(landing.IncompleteDownload) as error:
        landing.land_awards(spark, zones, source, 2021, 2023, rpp=5)
    assert [r["year"] for r in error.value.audit if not r["complete"]] == [2022, 2023]
    with pytest.raises(landing.IncompleteDownload):
        landing.land_awards(spark, zones, source, 2017, 2017, rpp=5)  # a year without any file
    assert landing.land_awards(spark, zones, source, 2022, 2023, rpp=5, allow_incomplete=True).rows == 21
    # A year whose new download yields nothing loses its old rows; other years stay.
    (tmp_path / "pages" / "year=2020" / "0.json").write_text("{")
    for name in ("5", "10"):
        (tmp_path / "pages" / "year=2020" / f"{name}.json").write_text('{"response": {"award": []}}')
    assert landing.land_awards(spark, zones, source, 2020, 2020, rpp=5, allow_incomplete=True).rows == 0
    counts = dict(rows(readers.read_json_lines(spark, zones.landing("awards"), schemas.LANDED_AWARD).groupBy("year").count()))
    assert counts == {2019: 1, 2021: 10, 2022: 11, 2023: 10}


def test_keyed_table_tolerates_absent_and_hot_keys(spark, tmp_path):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, null, concat('k', id)) as award_id", "id % 2 = 0 as in_cruz_list", "id as n")
    path = str(tmp_path / "keyed")
    assert writers.replace_keyed_table(df, path, ["award_id", "in_cruz_list", "nowhere"]) == 3000
    assert spark.read.parquet(path).filter("award_id is null").count() == 1000
    assert writers.replace_keyed_table(df.select("n"), path, ["award_id"], "year") == 3000
    assert writers.replace_keyed_table(df.limit(0), path, ["award_id"]) == 0


def test_malformed_records_are_set_aside(spark, tmp_path):
    path, zones = tmp_path / "list.csv", Zones(str(tmp_path / "lake"))
    path.write_text('Award ID,Note\n1,a\n2\n3,b,c\n4,"two\nlines"\n')
    assert landing.land_csv(spark, zones, "review_list", str(path)) == 2
    assert rows(readers.read_table(spark, zones.landing("review_list"))) == [("1", "a"), ("4", "two\nlines")]
    bad = readers.read_table(spark, zones.rejects("landing", "review_list"))
    assert rows(bad, schemas.CORRUPT, "reject_reason") == [("2", "malformed record"), ("3,b,c", "malformed record")]
    assert formatting.rejected(spark, zones) == {"review_list": 2}


def test_the_lake_root_is_required(monkeypatch):
    monkeypatch.delenv("RISKMART_ROOT", raising=False)
    with pytest.raises(ValueError):
        Zones.from_env()


def test_zone_paths(monkeypatch):
    monkeypatch.setenv("RISKMART_ROOT", "s3a://lake")
    zones = Zones.from_env()
    assert zones.landing("awards") == "s3a://lake/landing/awards" and zones.fmt == "parquet"


@pytest.mark.parametrize("replace", [
    lambda df, path: writers.replace_table(df, path),
    lambda df, path: writers.replace_keyed_table(df, path, ["id", "k"]),
    lambda df, path: writers.write_partitioned(df, path, ["k"]),
])
def test_a_failed_replacement_leaves_the_table(spark, tmp_path, replace):
    path = str(tmp_path / "t")
    old, new = spark.range(50).withColumn("k", F.col("id") % 2), spark.range(70).withColumn("k", F.col("id") % 3)
    replace(old, path)
    broken = new.withColumn("id", F.when(F.col("id") == 65, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception):
        replace(broken, path)
    assert rows(spark.read.parquet(path).select("id", "k")) == rows(old)
    replace(new, path)
    assert rows(spark.read.parquet(path).select("id", "k")) == rows(new)
    replace(spark.read.parquet(path).select("id", "k").filter("id < 7"), path)  # a table may be made from itself
    assert spark.read.parquet(path).count() == 7
    assert os.listdir(tmp_path) == ["t"]


@pytest.mark.parametrize("left", [[".replaced", ".written"], [".replaced"], ["", ".being-written"], ["", ".written"]])
def test_a_swap_cut_short_is_put_right(spark, tmp_path, left):
    """Whatever a dead job left beside the path: the table is whole, and the next replacement goes on from there."""
    path = str(tmp_path / "t")
    for suffix in left:
        spark.range(5 if suffix == ".written" else 3).write.parquet(path + suffix)
    writers.restore(spark, path)
    assert spark.read.parquet(path).count() == (5 if left == [".replaced", ".written"] else 3)
    assert writers.replace_table(spark.range(9), path) == 9
    assert spark.read.parquet(path).count() == 9 and os.listdir(tmp_path) == ["t"]
