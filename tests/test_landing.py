"""Landing zone, curated zone and the curate job."""

import gzip
import json
import os
import pathlib
from datetime import datetime, timezone

import pytest
from conftest import columns_of, ids, plan_of
from pyspark.errors import PySparkException

from dwellmart.operators.kinds import listings_of, macro_of
from dwellmart.operators.normalize import transform
from dwellmart.plans.curate import curate
from dwellmart.sources import landing
from dwellmart.sources.curated import read_curated, write_curated
from dwellmart.sources.landing import land, load_landing, preview

FULL = (
    '{"listing_id": "olx_123456", "city": "Warsaw", "district": "Mokotow", "price": 850000.0, '
    '"price_per_m2": 17000.0, "area": 50.0, "rooms": 2, "floor": 3, "building_year": 2018, '
    '"url": "https://example.com/123456", "date_scraped": "2026-03-15"}'
)
MINIMAL = (
    '{"listing_id": "gus_789", "city": "Krakow", "district": "Stare Miasto", '
    '"date_scraped": "2025-12-19T08:12:00Z"}'
)


@pytest.fixture
def zone(tmp_path):
    def build(*lines):
        drop = tmp_path / "zone"
        drop.mkdir(exist_ok=True)
        (drop / "olx_20260315_000000.json").write_text("\n".join(lines))
        return str(drop)

    return build


def test_full_and_minimal_records(spark, zone):
    rows = load_landing(spark, zone(FULL, MINIMAL)).orderBy("listing_id").collect()
    assert [tuple(row) for row in rows] == [
        ("gus_789", "Krakow", "Stare Miasto", None, None, None, None, None, None, None,
         datetime(2025, 12, 19, 8, 12)),
        ("olx_123456", "Warsaw", "Mokotow", 850000.0, 17000.0, 50.0, 2, 3, 2018,
         "https://example.com/123456", datetime(2026, 3, 15)),
    ]


def test_unknown_keys_are_ignored(spark, zone):
    frame = load_landing(spark, zone(MINIMAL.replace("{", '{"colour": "red", ')))
    assert ids(frame) == ["gus_789"] and "colour" not in frame.columns


BROKEN = [
    "{not json",
    FULL.replace('"rooms": 2', '"rooms": 3.0'),
    FULL.replace('"price": 850000.0', '"price": "12.5"'),
]


@pytest.mark.parametrize("line", BROKEN)
def test_strict_fails_on_a_broken_line(spark, zone, line):
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        load_landing(spark, zone(MINIMAL, line)).collect()


def test_quarantine_sets_broken_lines_aside(spark, zone, tmp_path):
    missing = MINIMAL.replace('"city": "Krakow", ', "").replace("789", "790")
    landing, curated, refused = zone(FULL, MINIMAL, missing, *BROKEN), tmp_path / "c", tmp_path / "r"
    counts = curate(spark, landing, str(curated), "quarantine", str(refused))
    assert (counts.raw, counts.curated, counts.rejected) == (6, 2, 4)
    reasons = columns_of(spark.read.parquet(str(refused)), "reasons")
    assert sorted(r[0][0] for r in reasons) == ["city_missing", "malformed", "malformed", "malformed"]


def test_modes_are_checked(spark, zone, tmp_path):
    with pytest.raises(ValueError):
        load_landing(spark, zone(FULL), "lenient")
    with pytest.raises(ValueError):
        curate(spark, zone(FULL), str(tmp_path / "c"), "quarantine")


def test_missing_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_landing(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        read_curated(spark, str(tmp_path / "nowhere"))


def test_drops_of_several_sources_are_read_together(spark, raw, macro_record, tmp_path):
    at = datetime(2026, 3, 12, 19, 58, 46, tzinfo=timezone.utc)
    zone = str(tmp_path / "landing")
    listings = raw({"listing_id": "olx_1", "url": "u"}, {"listing_id": "olx_2", "rooms": None})
    records = raw(macro_record())
    assert land(listings, zone, "olx", at) == f"{zone}/olx_20260312_195846"
    land(records, zone, "gus", at)
    back = load_landing(spark, zone)
    assert sorted(map(str, back.collect())) == sorted(map(str, listings.union(records).collect()))


def test_drops_are_compressed_and_cut_into_files_of_bounded_size(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setitem(landing.WRITTEN, "maxRecordsPerFile", 2)
    rows = raw(*[{"listing_id": f"olx_{i}"} for i in range(5)]).coalesce(1)
    drop = land(rows, str(tmp_path / "landing"), "olx")
    parts = sorted(name for name in os.listdir(drop) if name.startswith("part-"))
    assert len(parts) == 3 and all(name.endswith(".json.gz") for name in parts)
    lines = b"".join(gzip.decompress((pathlib.Path(drop) / name).read_bytes()) for name in parts).splitlines()
    assert sorted(json.loads(line)["listing_id"] for line in lines) == [f"olx_{i}" for i in range(5)]
    assert ids(load_landing(spark, drop)) == [f"olx_{i}" for i in range(5)]


def test_a_broken_record_aborts_its_drop(spark, raw, tmp_path):
    zone = str(tmp_path / "landing")
    with pytest.raises(PySparkException, match="date_scraped_missing"):
        land(raw({}, {"date_scraped": None}), zone, "olx")
    with pytest.raises(FileNotFoundError):
        load_landing(spark, f"{zone}/olx_*/*.json")


def test_strict_curate_rejects_the_batch_and_writes_nothing(spark, zone, tmp_path):
    nameless = MINIMAL.replace('"listing_id": "gus_789", ', "")
    with pytest.raises(PySparkException):
        curate(spark, zone(FULL, nameless), str(tmp_path / "c"))
    with pytest.raises(FileNotFoundError):
        read_curated(spark, str(tmp_path / "c" / "record_kind=listing"))


def test_curated_zone_keeps_kinds_apart(spark, raw, macro_record, tmp_path):
    curated = transform(raw({"listing_id": "olx_1"}, {"listing_id": "gus"}, macro_record()))
    write_curated(curated, str(tmp_path / "parted"))
    curated.write.parquet(str(tmp_path / "flat"))
    for path in ("parted", "flat"):
        back = read_curated(spark, str(tmp_path / path))
        assert ids(listings_of(back)) == ["olx_1"]
        assert ids(macro_of(back)) == ["gus", "gus_1"]
    plan = plan_of(macro_of(read_curated(spark, str(tmp_path / "parted"))))
    assert "PartitionFilters: [isnotnull(record_kind" in plan


def test_curate_overwrites(spark, zone, tmp_path):
    curated = str(tmp_path / "c")
    curate(spark, zone(FULL, MINIMAL), curated)
    counts = curate(spark, zone(FULL, FULL), curated)
    assert (counts.raw, counts.curated, counts.rejected) == (2, 1, 0)
    assert ids(read_curated(spark, curated)) == ["olx_123456"]


def test_curated_zone_of_another_tool(spark, raw, macro_record, tmp_path):
    """Times as text and whole numbers as floating ones are read in the declared types."""
    curated = transform(raw({"rooms": None}, {"listing_id": "olx_2"}, macro_record()))
    foreign = curated.withColumns({
        "rooms": curated.rooms.cast("double"),
        "building_year": curated.building_year.cast("double"),
        "date_scraped": curated.date_scraped.cast("string"),
    })
    foreign.coalesce(1).write.parquet(str(tmp_path / "foreign"))
    back = read_curated(spark, str(tmp_path / "foreign")).drop("record_kind")
    assert back.dtypes == curated.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, curated.collect()))


def test_preview_is_untruncated(raw, capsys):
    preview(raw({"url": "https://example.com/" + "x" * 50}, {}, {}), count=1)
    printed = capsys.readouterr().out
    assert "x" * 50 in printed and "only showing top 1 row" in printed
