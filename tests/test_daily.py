"""The ledger of drops and the daily run over it."""

import os
import uuid
from datetime import datetime, timezone

import pytest
from conftest import columns_of, ids, plan_of

from dwellmart.__main__ import main
from dwellmart.operators.integrity import audit
from dwellmart.plans.daily import Folders, ledger_of, run_daily
from dwellmart.sources.landing import land, load_landing
from dwellmart.sources.warehouse import Warehouse

FIRST, SECOND = (datetime(2026, 1, day, tzinfo=timezone.utc) for day in (1, 2))


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, f"star_{uuid.uuid4().hex}", str(tmp_path / "warehouse"))
    yield made
    made.discard()


@pytest.fixture
def folders(tmp_path):
    return Folders(str(tmp_path / "landing"), str(tmp_path / "curated"))


def stored(warehouse):
    return ids(warehouse.table("fact_listings"), "listing_natural_key")


def test_late_drops_are_taken_and_a_repeated_run_takes_none(spark, raw, macro_record, warehouse, folders):
    def run(feeds, at):
        return run_daily(spark, folders, warehouse, feeds, incremental=True, at=at)

    day = {"olx": raw({"listing_id": "olx_1"}, {"listing_id": "olx_1"}), "gus": raw(macro_record())}
    told = run(day, FIRST)
    assert (told.raw, told.curated, told.drops) == (3, 2, ("gus_20260101_000000", "olx_20260101_000000"))
    assert (told.load.listings, told.load.macro, told.load.rejected) == (1, 1, 0)
    again = run(day, FIRST)
    assert (again.raw, again.drops, again.load) == (0, (), told.load)

    land(raw({"listing_id": "otodom_7"}), folders.landing, "otodom", datetime(2025, 11, 1, tzinfo=timezone.utc))
    later = {"olx": raw({"listing_id": "olx_1", "price": 77.0, "date_scraped": "2025-08-01"})}
    told = run(later, SECOND)
    assert told.drops == ("olx_20260102_000000", "otodom_20251101_000000") and told.raw == 2
    assert stored(warehouse) == ["olx_1", "otodom_7"]
    assert [str(p) for (p,) in columns_of(warehouse.table("fact_listings").where("listing_natural_key = 'olx_1'"), "price")] == ["77.00"]

    ledger = ledger_of(warehouse, folders.landing)
    assert dict(columns_of(ledger.read_landed(), "drop", "rows")) == {
        "gus_20260101_000000": 1, "olx_20260101_000000": 2, "olx_20260102_000000": 1, "otodom_20251101_000000": 1,
    }
    assert sorted(run for _, run in columns_of(ledger.read_loaded(), "drop", "run")) == ["20260101_000000"] * 2 + ["20260102_000000"] * 2
    assert load_landing(spark, folders.landing).count() == 5  # the ledger is no part of the zone's records


def test_a_run_that_was_cut_off_takes_its_drops_again(spark, raw, warehouse, folders, monkeypatch):
    feeds = {"olx": raw({"listing_id": "olx_1"})}
    with monkeypatch.context() as patched:
        patched.setattr("dwellmart.plans.daily.read_curated", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_daily(spark, folders, warehouse, feeds, incremental=True, at=FIRST)
    told = run_daily(spark, folders, warehouse, feeds, incremental=True, at=FIRST)
    assert told.drops == ("olx_20260101_000000",) and told.raw == 1 and stored(warehouse) == ["olx_1"]


def test_unfinished_drops_wait(spark, raw, warehouse, folders):
    drop = land(raw({"listing_id": "olx_1"}), folders.landing, "olx", FIRST)
    os.rename(f"{drop}/_SUCCESS", f"{drop}/_LATER")
    ledger = ledger_of(warehouse, folders.landing)
    assert ledger.waiting() == []
    told = run_daily(spark, folders, warehouse, {"olx": raw({"listing_id": "olx_2"})}, incremental=True, at=FIRST)
    assert told.drops == ("olx_20260101_000000",) and stored(warehouse) == ["olx_2"]


def test_single_files_are_drops(spark, warehouse, folders):
    os.makedirs(folders.landing)
    line = '{"listing_id": "olx_5", "city": "a", "district": "b", "price": 10.0, "area": 10.0, "date_scraped": "2025-01-01T00:00:00Z"}\n'
    with open(f"{folders.landing}/olx_20260101_000000.json", "w") as file:
        file.write(line * 2)
    told = run_daily(spark, folders, warehouse, {}, incremental=True, at=FIRST)
    assert (told.raw, told.curated, stored(warehouse)) == (2, 1, ["olx_5"])
    assert run_daily(spark, folders, warehouse, {}, incremental=True, at=SECOND).drops == ()


def test_land_and_daily_commands(spark, raw, tmp_path, capsys):
    raw({"listing_id": "olx_1"}, {"listing_id": "olx_2"}).write.json(str(tmp_path / "given"))
    zone, database = str(tmp_path / "zone"), f"star_{uuid.uuid4().hex}"
    for _ in range(2):
        main(["land", "--input", str(tmp_path / "given"), "--landing", zone, "--source", "olx", "--at", "20260101_000000"])
        assert capsys.readouterr().out.strip().endswith("olx_20260101_000000")
    tables = ["--database", database, "--root", str(tmp_path / "warehouse")]
    daily = ["daily", "--landing", zone, "--curated", str(tmp_path / "curated"), *tables]
    main(daily)
    assert "raw=2" in capsys.readouterr().out
    main(daily)
    assert "raw=0" in (told := capsys.readouterr().out) and "listings=2" in told
    main([*daily, "--full"])
    assert "raw=2" in capsys.readouterr().out
    Warehouse(spark, database, str(tmp_path / "warehouse")).discard()


def test_a_fact_table_is_scanned_once_by_the_audit(spark, raw, warehouse, folders):
    run_daily(spark, folders, warehouse, {"olx": raw({"listing_id": "olx_1"})}, at=FIRST)
    plan = plan_of(audit(warehouse), "simple")
    folder = warehouse.location_of("fact_listings").rsplit("/", 1)[0]
    assert sum("listing_natural_key" in line for line in plan.splitlines() if "FileScan" in line) == 1
    assert folder and sum("property_id" in line for line in plan.splitlines() if "FileScan" in line and "date_id" in line) == 1
