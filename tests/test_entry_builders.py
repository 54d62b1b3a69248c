from datetime import datetime, timezone

from conftest import ids, plan_of

import __spark_entry__ as entry
from dwellmart.plans.daily import Folders
from dwellmart.sources.landing import land


def test_the_early_records_are_curated_once_and_read_from_files(spark, raw, tmp_path):
    folders = Folders(str(tmp_path / "landing"), str(tmp_path / "curated"))
    records = raw(
        {"listing_id": "olx_1", "date_scraped": "1998-05-31 10:00:00"},
        {"listing_id": "olx_2", "date_scraped": "1998-06-02 10:00:00"},
        {"listing_id": "otodom_3", "date_scraped": "1997-01-01 10:00:00"},
    )
    land(records, folders.landing, "olx", datetime(2026, 1, 1, tzinfo=timezone.utc))
    full = entry.Loaded(folders, None, None, {})

    early = entry._curated_early(spark, full)

    assert ids(early) == ["olx_1", "otodom_3"]
    # Every step of the load reads the stored rows, not the landing zone parsed and curated again.
    assert "json" not in plan_of(early).lower()
