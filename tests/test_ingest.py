from __future__ import annotations

import json
from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import raw_row, rows_of, utc
from wattlane.operators import ingest
from wattlane.sources import landing, pages
from wattlane.window import BatchWindow

WINDOW = BatchWindow.of("2025-11-14T00:00:00", "2025-11-14T01:00:00")

REGION_ROW = {
    "period": "2025-11-14T00",
    "respondent": "NRTH",
    "respondent-name": "Northern Grid",
    "type": "D",
    "type-name": "Demand",
    "value": "871.25",
    "value-units": "megawatthours",
}
FUEL_ROW = {
    "period": "2025-11-14T00",
    "respondent": "NRTH",
    "respondent-name": "Northern Grid",
    "fueltype": "NG",
    "type-name": "Natural Gas",
    "value": "93.5",
    "value-units": "megawatthours",
}


def write_page(folder, name, document):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(document, indent=2))


def page(*rows):
    return {"response": {"total": str(len(rows)), "data": list(rows)}}


@pytest.fixture
def families(spark, tmp_path):
    def read(region_rows, fuel_rows):
        write_page(tmp_path / "region", "1.json", page(*region_rows))
        write_page(tmp_path / "fuel", "1.json", page(*fuel_rows))
        return pages.read_families(spark, str(tmp_path / "region"), str(tmp_path / "fuel"))

    return read


def stamped(rows):
    return ingest.stamp_batch(rows, WINDOW, utc("2025-11-14T01:05:00"))


def test_two_families_become_raw_rows(families):
    raw = ingest.normalise(stamped(families([REGION_ROW], [FUEL_ROW])))
    demand, generation = raw.orderBy("type").collect()
    assert (demand["type"], demand["type_name"], demand["fueltype"]) == ("D", "Demand", None)
    assert demand["value"] == 871.25
    assert (generation["type"], generation["type_name"]) == ("generation", "Generation")
    assert (generation["fueltype"], generation["fueltype_name"]) == ("NG", "Natural Gas")
    assert generation["_source_url"].endswith("/fuel/1.json")
    assert demand["batch_date"] == date(2025, 11, 14)
    assert demand["_batch_id"] == "20251114T000000_20251114T010000"


def test_page_without_rows_is_an_error(spark, tmp_path):
    write_page(tmp_path / "a", "1.json", {"error": "no"})
    with pytest.raises(PySparkException, match="missing the response object"):
        pages.page_rows(pages.read_pages(spark, str(tmp_path / "a")), "region").collect()
    write_page(tmp_path / "b", "1.json", {"response": {"total": "0"}})
    with pytest.raises(PySparkException, match="missing response.data"):
        pages.page_rows(pages.read_pages(spark, str(tmp_path / "b")), "region").count()


def test_empty_pages_make_an_empty_window(families):
    with pytest.raises(ingest.EmptyWindow):
        ingest.require_rows(families([], []))


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"respondent": ""}, "missing required fields: respondent"),
        ({"type": None, "period": None}, "missing required fields: period, type"),
        ({"value": "n/a"}, "value must be numeric"),
        ({"value": "1d"}, "value must be numeric"),
    ],
)
def test_strict_rows_fail_the_job_and_lenient_ones_are_split_off(families, change, message):
    rows = stamped(families([REGION_ROW, REGION_ROW | change], [FUEL_ROW]))
    with pytest.raises(PySparkException, match=message):
        ingest.normalise(rows).select("respondent_name").count()
    good, rejects = ingest.split_rejects(rows)
    assert good.count() == 2
    assert message in rejects.first()["violation"]


def test_fuel_row_needs_its_fuel_and_no_type(families):
    rows = stamped(families([REGION_ROW], [FUEL_ROW, FUEL_ROW | {"fueltype": ""}]))
    _, rejects = ingest.split_rejects(rows)
    assert rows_of(rejects, "violation") == [("row is missing required fields: fueltype",)]


def test_unmarked_row_is_rejected(families):
    rows = stamped(families([REGION_ROW], [])).withColumn("__row_kind", F.lit("other"))
    _, rejects = ingest.split_rejects(rows)
    assert rejects.count() == 1


@pytest.mark.parametrize("text", ["1e3", " 12 ", "-0.5", "+7", "inf", "nan"])
def test_numbers_in_any_notation_are_accepted(families, text):
    rows = stamped(families([REGION_ROW | {"value": text}], []))
    assert ingest.normalise(rows).count() == 1


def test_landing_path_content_and_replacement(spark, tmp_path, raw_frame):
    root = str(tmp_path / "landing")
    other = BatchWindow.of("2025-11-14T01:00:00", "2025-11-14T02:00:00")
    landing.land(raw_frame([raw_row(WINDOW), raw_row(other)]), root)
    landing.land(raw_frame([raw_row(WINDOW, value=2.0)]), root)
    folders = sorted(p.name for p in (tmp_path / "landing/year=2025/month=11/day=14").iterdir())
    assert folders == [
        "window=2025-11-14T00%3A00%3A00+00%3A00",
        "window=2025-11-14T01%3A00%3A00+00%3A00",
    ]
    file = next((tmp_path / "landing").rglob("*.json"))
    assert json.loads(file.read_text().splitlines()[0])["fueltype"] is None
    assert rows_of(landing.read_landed(spark, root), "value") == [(2.0,), (871.25,)]
    only = landing.read_landed(spark, root, [WINDOW])
    assert rows_of(only, "_batch_id", "value") == [(WINDOW.batch_id, 2.0)]
    row = landing.read_landed(spark, root, [WINDOW]).first()
    assert row["_ingestion_timestamp"].replace(tzinfo=None) == WINDOW.end.replace(tzinfo=None)


def test_landed_text_must_hold_the_schema(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/a.json").write_text('{"respondent": "NRTH", "value": "many"}\n')
    with pytest.raises((PySparkException, Py4JJavaError), match="Malformed records"):
        landing.read_landed(spark, str(tmp_path / "bad")).collect()
    (tmp_path / "short").mkdir()
    (tmp_path / "short/a.json").write_text('{"respondent": "NRTH", "value": 1.0}\n')
    with pytest.raises(PySparkException, match="missing required columns: respondent_name"):
        landing.read_landed(spark, str(tmp_path / "short")).count()
