from __future__ import annotations

import pytest

from tests.test_bronze import put
from tests.test_jobs import DAY_ONE, DAY_TWO, HEADER, rows_of
from tidemark.__main__ import main
from tidemark.sources.layout import Lake
from tidemark.sources.tables import read_table


def test_jobs_by_command(spark, tmp_path, capsys):
    raw, lake = str(tmp_path / "raw"), Lake(str(tmp_path / "lake"))
    put(tmp_path / "raw", "1.csv", HEADER, *DAY_ONE, *DAY_TWO)
    main(["bronze", "--raw-dir", raw, "--bronze-dir", lake.bronze])
    main(["silver", "--bronze-dir", lake.bronze, "--silver-dir", lake.silver, "--show", "0", "--mode", "overwrite"])
    main(["gold", "--silver-dir", lake.silver, "--gold-dir", lake.gold, "--session-gap-minutes", "60"])
    main(["quality", "--lake", lake.root, "--event-types", "view", "purchase"])
    main(["export", "--gold-dir", lake.gold, "--export-dir", f"{lake.root}/export"])
    shown = capsys.readouterr().out
    assert "9 rows to" in shown and "event_id_unique" in shown and "first_seen_ts" in shown
    dim = read_table(spark, lake.gold_table("dim_customer"))
    back = spark.read.schema(dim.schema).csv(f"{lake.root}/export/dim_customer", header=True)
    assert rows_of(back) == rows_of(dim)

    grown = Lake(str(tmp_path / "grown"))
    main(["incremental", "--raw-dir", raw, "--lake", grown.root, "--session-gap-minutes", "60"])
    assert rows_of(read_table(spark, grown.gold_table("session_summary"))) == rows_of(
        read_table(spark, lake.gold_table("session_summary"))
    )


def test_folders_are_required():
    with pytest.raises(SystemExit):
        main(["gold", "--silver-dir", "x"])
    with pytest.raises(SystemExit):
        main(["silver", "--bronze-dir", "x", "--silver-dir", "y", "--mode", "merge"])
