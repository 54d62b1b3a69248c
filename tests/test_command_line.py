"""The command line, from landed files to a printed report."""

import os
import uuid

import pytest

from dwellmart.__main__ import main
from dwellmart.session import scratch_root, shuffle_partitions_for
from dwellmart.sources.landing import land
from dwellmart.sources.warehouse import Warehouse


def test_jobs_in_order(spark, raw, macro_record, tmp_path, capsys):
    zone, curated = str(tmp_path / "zone"), str(tmp_path / "curated")
    database = f"star_{uuid.uuid4().hex}"
    tables = ["--database", database, "--root", str(tmp_path / "warehouse")]
    land(raw({"city": "warsaw"}, {"listing_id": "olx_2", "city": "lodz"}), zone, "olx")
    land(raw(macro_record()), zone, "gus")
    main(["curate", "--landing", zone, "--curated", curated, "--preview", "2"])
    assert capsys.readouterr().out.count("only showing top 2 rows") == 2
    main(["init", *tables])
    main(["load", "--curated", curated, *tables])
    folder = capsys.readouterr().out.split()[-1].removeprefix("file:")
    main(["load", "--append", "--curated", curated, *tables])
    capsys.readouterr()
    main(["report", "by_city", "--city", "Lodz", *tables])
    printed = capsys.readouterr().out
    assert "Lodz" in printed and "Warsaw" not in printed
    main(["report", "search_display", "--min-rooms", "2", "--limit", "1", *tables])
    assert "500,000.00" in capsys.readouterr().out
    main(["report", "macro", *tables])
    assert "average_price_per_m2" in capsys.readouterr().out

    main(["query", "SELECT * FROM fact_listings", "--rows", "1", *tables])
    assert "1 of 2 rows" in capsys.readouterr().out
    main(["query", "SELECT * FROM fact_listings", "--rows", "1", "--output", str(tmp_path / "out"), *tables])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2

    Warehouse(spark, database, str(tmp_path / "warehouse")).discard()
    main(["query", "SELECT count(*) AS n FROM fact_listings", "--star", folder, *tables])
    assert "|2  |" in capsys.readouterr().out
    Warehouse(spark, database, str(tmp_path / "warehouse")).discard()


def test_shuffles_grow_with_the_input():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 * 1024**3, 8) == 400
    assert shuffle_partitions_for(100 * 10**12, 8) == 372_530
    with pytest.warns(UserWarning, match="100000 shuffle partitions"):
        assert shuffle_partitions_for(10**15, 8, most=100_000) == 100_000


def session_with(master, **settings):
    class Session:
        sparkContext = type("Context", (), {"master": master, "applicationId": "application_1"})
        conf = type("Conf", (), {"get": staticmethod(lambda name, default: settings.get(name, default))})

    return Session()


def test_scratch_folder_is_the_configured_one():
    shared = {"spark.checkpoint.dir": "s3a://lake/scratch/"}
    assert scratch_root(session_with("yarn", **shared)) == "s3a://lake/scratch"
    assert scratch_root(session_with("local[2]", **shared)) == "s3a://lake/scratch"


def test_scratch_folder_is_never_local_on_a_cluster():
    assert os.path.isdir(scratch_root(session_with("local[2]")))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session_with("yarn"))
