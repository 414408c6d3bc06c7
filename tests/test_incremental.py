"""Landing page by page as files arrive: what a batch over all files lands, once."""

from __future__ import annotations

import json

import pytest

from frames import rows
from riskmart.plans import incremental, landing
from riskmart.sources import readers


def add(folder, year, offset, *awards, text=None):
    where = folder / f"year={year}"
    where.mkdir(parents=True, exist_ok=True)
    (where / f"{offset}.json").write_text(text or json.dumps({"response": {"award": [dict(a) for a in awards]}}))


def award(i, **more):
    return {"id": f"a{i}", "title": f"t{i}", **more}


@pytest.fixture
def lake(tmp_path):
    source = tmp_path / "pages"
    add(source, 2021, 0, award(1), award(2, newField="x"))
    add(source, 2022, 0, award(3), {"title": "no id"}, {"title": "no id", "agency": "NSF"})
    add(source, 2022, 25, text="{broken")
    add(source, 2022, 50, text=json.dumps({"response": {"serviceNotification": "down"}}))
    return source, str(tmp_path / "landed"), str(tmp_path / "checkpoint")


def land(spark, lake, **options):
    source, target, checkpoint = lake
    return incremental.land_new_pages(spark, str(source), target, checkpoint, **options)


def as_batch(spark, source):
    """Each (year, id, title) that a batch over all files finds."""
    return sorted({tuple(r) for r in landing.awards_of(readers.read_pages(spark, str(source))).selectExpr("cast(year as string)", "id", "title", "agency").collect()}, key=repr)


def test_two_runs_over_a_growing_folder_equal_one_batch(spark, lake):
    source, target, _ = lake
    assert land(spark, lake) == 5
    assert land(spark, lake) == 0  # a rerun adds nothing
    add(source, 2022, 75, award(4), award(3))  # overlaps the first page
    add(source, 2023, 0, award(1), award(5))  # the same id in another feed is another award
    assert land(spark, lake) == 3
    assert rows(incremental.landed(spark, target), "year", "id", "title", "agency") == as_batch(spark, source)
    assert land(spark, lake) == 0
    assert incremental.landed(spark, target).filter("id = 'a2'").first()["extra"] == {"newField": "x"}


def test_small_batches_land_the_same(spark, lake):
    source, target, _ = lake
    for i in range(6):
        add(source, 2024, i * 25, award(100 + i), award(100 + i // 2))
    land(spark, lake, files_per_batch=2)
    assert rows(incremental.landed(spark, target), "year", "id", "title", "agency") == as_batch(spark, source)


def test_files_of_any_age_are_landed(spark, lake):
    """Copies that keep an old modification time are not late."""
    import os

    source, _, _ = lake
    land(spark, lake)
    add(source, 2020, 0, award(50))
    os.utime(source / "year=2020" / "0.json", (10**9, 10**9))
    assert land(spark, lake) == 1


def test_nothing_landed_yet(spark, tmp_path):
    assert incremental.landed(spark, str(tmp_path / "none")) is None
    (tmp_path / "pages").mkdir()
    assert incremental.land_new_pages(spark, str(tmp_path / "pages"), str(tmp_path / "t"), str(tmp_path / "c")) == 0


def test_batches_are_listed_without_a_job(spark, tmp_path):
    """A batch of more files than Spark's own threshold: the stream's session has the batch size for it, others keep theirs."""
    name = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before, seen = spark.conf.get(name), []
    real = incremental.new_awards
    try:
        incremental.new_awards = lambda pages, horizon: seen.append(spark.conf.get(name)) or real(pages, horizon)
        folder = tmp_path / "pages" / "year=2023"
        folder.mkdir(parents=True)
        for i in range(40):
            (folder / f"{i}.json").write_text('{"response": {"award": [{"id": "%d"}]}}' % i)
        where = [str(tmp_path / n) for n in ("pages", "landed", "checkpoint")]
        assert incremental.land_new_pages(spark, *where, files_per_batch=50) == 40
    finally:
        incremental.new_awards = real
    assert seen == ["50"] and spark.conf.get(name) == before


def test_the_driver_has_an_entry_for_each_batch_not_for_each_file(spark, tmp_path):
    """What the stream remembers of its source, and lists of its target, grows with the batches."""
    source = tmp_path / "pages"
    for i in range(60):
        add(source, 2020 + i % 2, i * 25, award(i))
    lake = source, str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    assert land(spark, lake, files_per_batch=20) == 60
    add(source, 2021, 5000, award(500))
    assert land(spark, lake, files_per_batch=20) == 1
    remembered = [line for log in (tmp_path / "checkpoint").glob("**/sources/0/*") if log.name.isdigit() for line in log.read_text().splitlines() if line.startswith("{")]
    assert len(remembered) == 4 and not (tmp_path / "checkpoint" / "pages").exists()
    written = list((tmp_path / "landed").glob("year=*/*.parquet"))
    assert len(written) <= 3 * 2 * 4 + 1


def test_older_files_come_first(spark, tmp_path):
    import os

    source = tmp_path / "pages"
    for i in range(4):
        add(source, 2021, i, {"id": "a", "title": f"t{i}"}, award(i))
        os.utime(source / "year=2021" / f"{i}.json", (10**9 - i, 10**9 - i))
    lake = source, str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    assert land(spark, lake, files_per_batch=1) == 5
    assert incremental.landed(spark, lake[1]).filter("id = 'a'").first()["title"] == "t3"


def test_odd_files_land_as_the_json_reader_lands_them(spark, lake, tmp_path, monkeypatch):
    import gzip

    source, target, _ = lake
    text = json.dumps({"response": {"award": [{"id": "é", "n": 1, "more": {"x": [1, None]}}]}}, indent=1, ensure_ascii=False)
    odd = {
        "0.json": b"\xef\xbb\xbf" + text.encode(), "1.json": text.replace("é", "b").encode("utf-16"), "19.json": text.encode("utf-16-le"), "2.json": gzip.compress(b'{"response": {"award": [{"id": "z"}]}}'),
        "3.json": b'{"response": {"award": [{"id": "c\xff"}]}}', "4.json": b"", "5.json": b" \n", "6.json": b"[]", "7.json": b"null",
        "8.json": b' [{"response": {"award": [{"id": "d"}]}}, {"response": {"award": [{"id": "e"}]}}]', "9.json": b'{"response": {"award": {"id": "f"}}}',
        "10.json": b'{"response": {"award": [{"id": "g"}, null, {}]}} trailing', "11.json": b'{"response": {"award": null}}', "12.json": b'[{"response": 1},',
        "_13.json": text.encode(), ".14.json": text.encode(), "15.json.gz": gzip.compress(b'{"response": {"award": [{"id": "h"}]}}'), "16": b'{"response": {"award": [{"id": "i"}]}}',
        "17.json": b'{"response": {"award": [{"id": "j"}], "serviceNotification": {"a": 1}}}', "20.json": b'{"response": {"award": [{"id": "k", "sum": 1.10, "big": {"n": 12345678901234567890.10}, "two": 1, "two": 2}]}}',
        "18.json": b'{"other": 1, "response": {"award": [{"id": 5, "id": 6}]}}',
    }
    for folder in ("year=20%2F24", "year=__HIVE_DEFAULT_PARTITION__", "_other"):
        (source / folder / ".deep").mkdir(parents=True)
        for name, body in odd.items():
            (source / folder / name).write_bytes(body)
    n = land(spark, lake)
    by_ledger = rows(incremental.landed(spark, target).selectExpr("*", "to_json(extra) AS more").drop("extra"))
    monkeypatch.setattr(incremental.ledger, "feed_folders", lambda *_: None)
    lake = source, str(tmp_path / "landed2"), str(tmp_path / "checkpoint2")
    again = land(spark, lake)
    assert rows(incremental.landed(spark, lake[1]).selectExpr("*", "to_json(extra) AS more").drop("extra")) == by_ledger
    assert again == n == len(by_ledger)


@pytest.mark.parametrize("where", ["read_batch", "noted", "new_awards"])
def test_a_run_that_died_goes_on(spark, lake, monkeypatch, where):
    """While it reads a batch, before it notes one that was written, or before the stream starts."""
    source, target, checkpoint = lake
    calls = []
    kind = type(spark.range(1))
    place, name = {"noted": (kind, "coalesce")}.get(where, (incremental, where))
    real = getattr(place, name)

    def fails(*given):
        calls.append(given)
        if len(calls) == {"read_batch": 3, "noted": 4, "new_awards": 1}[where]:
            raise OSError("gone")
        return real(*given)

    with monkeypatch.context() as m:
        m.setattr(place, name, fails)
        with pytest.raises(OSError):
            land(spark, lake, files_per_batch=1)
    assert incremental.landed(spark, target) is None
    noted = {"read_batch": 2, "noted": 1, "new_awards": 4}[where]
    assert incremental.ledger.noted(spark, f"{checkpoint}/files").count() == noted
    assert land(spark, lake, files_per_batch=2) == 5
    assert incremental.ledger.noted(spark, f"{checkpoint}/files").count() == 4
    assert rows(incremental.landed(spark, target), "year", "id", "title", "agency") == as_batch(spark, source)
    assert land(spark, lake) == 0


def test_a_checkpoint_begun_before_there_were_ledgers_goes_on(spark, lake, monkeypatch):
    source, target, _ = lake
    with monkeypatch.context() as m:
        m.setattr(incremental.ledger, "feed_folders", lambda *_: None)
        m.setattr(incremental, "STATE", {})
        assert land(spark, lake) == 5
    add(source, 2022, 75, award(4), award(3))
    assert land(spark, lake) == 1
    assert rows(incremental.landed(spark, target), "year", "id", "title", "agency") == as_batch(spark, source)


def test_sources_of_another_layout_are_left_to_spark(spark, lake, tmp_path):
    from pyspark.errors import AnalysisException

    source, _, _ = lake
    assert incremental.ledger.feed_folders(str(source), "year") == ["year=2021", "year=2022"]
    assert incremental.ledger.feed_folders(str(source), "feed") is None
    assert incremental.ledger.feed_folders("viewfs://nowhere/pages", "year") is None
    with pytest.raises(AnalysisException):
        incremental.land_new_pages(spark, str(tmp_path / "none"), str(tmp_path / "t"), str(tmp_path / "c"))
