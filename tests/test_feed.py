"""The paged feed as a data source: what is opened, what fails and how often it is tried."""

from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import rows
from riskmart.plans import landing
from riskmart.sources import feed


def envelope(*ids):
    return json.dumps({"response": {"award": [{"id": i, "title": "t"} for i in ids]}})


@pytest.fixture
def root(tmp_path):
    """Three years and two days; 2022 lacks its page 25, and one page of 2023 is no JSON."""
    pages = {
        "2021": {0: envelope("a", "b"), 25: envelope("c")},
        "2022": {0: envelope("d"), 50: envelope("e")},
        "2023": {0: "{not json", 25: json.dumps({"response": {"serviceNotification": "down"}}), 50: envelope("f")},
        "2024-02-28": {0: envelope("g")}, "2024-02-29": {0: envelope("h")},
    }
    for name, found in pages.items():
        folder = tmp_path / "pages" / f"feed={name}"
        folder.mkdir(parents=True)
        for offset, body in found.items():
            (folder / f"{offset}.json").write_text(body)
        (folder / "notes.txt").write_text("no page")
    return (tmp_path / "pages").as_uri()


def counted_source(log, broken=()):
    """A source that notes every page it opens; ``broken`` pages fail that many times first."""

    class Transport(feed.FolderTransport):
        def fetch(self, name, offset):
            tried = os.path.join(log, f"{name}-{offset}-")
            n = sum(f.startswith(f"{name}-{offset}-") for f in os.listdir(log))
            open(f"{tried}{n}", "w").close()
            if n < dict(broken).get((name, offset), 0):
                raise OSError("try again")
            return super().fetch(name, offset)

    class Source(feed.AwardFeed):
        def transport(self):
            return Transport(self.options["path"])

    return Source


def read(spark, root, log, broken=(), **options):
    log.mkdir()
    feed.register(spark, counted_source(str(log), broken))
    reader = spark.read.format(feed.FORMAT).option("pause", "0.01")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(root)


def opened(log):
    return sorted({tuple(f.rsplit("-", 1)[0].rsplit("-", 1)) for f in os.listdir(log)})


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_all_pages_and_missing_ones(spark, root, tmp_path):
    df = read(spark, root, tmp_path / "log")
    got = rows(df, "feed", "offset", "attempts", "failure")
    assert got == sorted([
        ("2021", 0, 1, None), ("2021", 25, 1, None), ("2022", 0, 1, None), ("2022", 25, 0, "missing"), ("2022", 50, 1, None),
        ("2023", 0, 1, None), ("2023", 25, 1, None), ("2023", 50, 1, None), ("2024-02-28", 0, 1, None), ("2024-02-29", 0, 1, None),
    ], key=repr)
    assert rows(landing.awards_of(feed.parsed(df)), "id") == [(c,) for c in "abcdefgh"]
    assert rows(feed.parsed(df).filter("failed"), "year", "offset") == [("2022", 25), ("2023", 0), ("2023", 25)]


@pytest.mark.parametrize("condition, pages", [
    (lambda: feed.between_dates(date(2022, 3, 1), date(2022, 3, 2)), [("2022", "0"), ("2022", "50")]),
    (lambda: feed.between_dates(date(2024, 2, 29), date(2025, 1, 1)), [("2024-02-29", "0")]),
    (lambda: feed.between_dates(date(2020, 1, 1), date(2020, 12, 31)), []),
    (lambda: F.col("feed").isin("2021", "2023") & (F.col("offset") >= 25), [("2021", "25"), ("2023", "25"), ("2023", "50")]),
    (lambda: (F.col("feed") == "2021") & (F.col("offset") < 25), [("2021", "0")]),
])
def test_only_pages_that_can_matter_are_opened(spark, root, tmp_path, condition, pages):
    log, condition = tmp_path / "log", condition()
    whole = rows(feed.read_feed(spark, root).filter(condition))
    df = read(spark, root, log).filter(condition)
    got = rows(df)
    assert opened(log) == pages
    assert got == whole and {(r[0], str(r[3])) for r in got if r[4]} == set(pages)


def test_the_plan_shows_the_pushed_range(spark, root):
    df = feed.parsed(feed.read_feed(spark, root).filter(feed.between_dates(date(2022, 1, 1), date(2022, 12, 31)) & (F.col("body") != "")))
    pushed = next(line for line in plan_of(df).splitlines() if "PushedFilters" in line)
    assert "to_date" in pushed and "from_date" in pushed
    with_or = feed.read_feed(spark, root).filter((F.col("feed") == "2021") | (F.col("offset") == 50))
    assert len(rows(with_or)) == 4  # what cannot be pushed is still applied


def test_three_attempts_and_a_row_that_says_why(spark, root, tmp_path):
    log = tmp_path / "log"
    df = read(spark, root, log, broken={("2021", 0): 2, ("2021", 25): 3}.items()).filter("feed = '2021'")
    assert rows(df, "offset", "attempts", "failure") == [(0, 3, None), (25, 3, "unreadable")]
    assert len(os.listdir(log)) == 6


def test_tasks_hold_a_bounded_number_of_pages(spark, root, tmp_path):
    df = read(spark, root, tmp_path / "log", pagesPerTask=1)
    assert df.rdd.getNumPartitions() == 10
    assert feed.read_feed(spark, (tmp_path / "nothing").as_uri()).count() == 0


def test_written_pages_come_back(spark, tmp_path):
    root = (tmp_path / "made").as_uri()
    pages = spark.createDataFrame([("2020", 0, envelope("a")), ("2020", 25, envelope("é")), ("2021-01-01", 0, "")], "feed string, offset long, body string")
    for _ in range(2):  # a task that runs twice changes nothing
        feed.write_feed(pages, root)
    assert rows(feed.read_feed(spark, root), "feed", "offset", "body") == rows(pages)
