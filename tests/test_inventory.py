"""Inventory parse / convert / numbering (reference cases: listing lines, golden order)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.operators import inventory as inv
from granary.sources import inventory as src

LINES = [
    r"HLS.L30.T55XYZ.2021003T010203.v2.0 2021-01-03\ 01:02:03.500+00 completed t",
    r"HLS.S30.T58XYZ.2023300T202122.v2.0 2023-10-27\ 20:21:22.250+00 completed t",
    r"HLS.L30.T59XYZ.2018011T000001.v2.0 2018-01-11\ 00:00:01+00 completed t",
    r"HLS.L30.T56XYZ.2019100T111213.v2.0 \N queued f",
    r"HLS.S30.T57XYZ.2020200T040506.v2.0 2020-07-18\ 04:05:06+00 failed f",
]


def lines_df(spark, lines, inventory="inv.txt"):
    return spark.createDataFrame([(inventory, v) for v in lines], "inventory string, value string")


def test_parse_lines(spark):
    rows = inv.parse_inventory(lines_df(spark, LINES)).orderBy("granule_id").collect()
    by_id = {r.granule_id: r for r in rows}
    assert len(rows) == 5
    tile = {k.split(".")[2]: r for k, r in by_id.items()}
    assert tile["T55XYZ"].start_datetime == dt.datetime(2021, 1, 3, 1, 2, 3, 500000)
    assert tile["T57XYZ"].start_datetime == dt.datetime(2020, 7, 18, 4, 5, 6)
    assert tile["T56XYZ"].start_datetime is None
    assert tile["T56XYZ"].status == "queued" and tile["T56XYZ"].published is False
    assert tile["T58XYZ"].published is True


def test_convert_golden_order(spark):
    out = inv.convert_inventory(lines_df(spark, LINES)).orderBy("inventory_seq").collect()
    assert [r.granule_id.split(".")[2] for r in out] == ["T58XYZ", "T55XYZ", "T59XYZ"]
    assert [r.inventory_seq for r in out] == [0, 1, 2]
    assert all(r.status == "completed" and r.published for r in out)


def test_month_order_within_a_year(spark):
    # months 1, 9, 10, 12 of one year must come out 12, 10, 9, 1 (true datetime order, not path order)
    lines = [
        rf"HLS.S30.T0{m:02d}AA.2023001T000000.v2.0 2023-{m:02d}-05\ 10:00:00+00 completed t" for m in (1, 9, 10, 12)
    ]
    out = inv.convert_inventory(lines_df(spark, lines), num_partitions=3).orderBy("inventory_seq").collect()
    assert [r.start_datetime.month for r in out] == [12, 10, 9, 1]


def test_bad_line_fails_in_strict_mode(spark):
    df = inv.parse_inventory(lines_df(spark, LINES + ["not an inventory line"]))
    with pytest.raises(Exception, match="Listing line has another form"):
        df.collect()


def test_bad_datetime_fails_in_strict_mode(spark):
    bad = r"HLS.S30.T60XYZ.2021003T010203.v2.0 some-day completed t"
    with pytest.raises(Exception, match="start time of another form"):
        inv.parse_inventory(lines_df(spark, [bad])).collect()


def test_quarantine_mode_splits_bad_lines(spark):
    df = inv.parse_inventory(lines_df(spark, LINES + ["garbage", ""]), strict=False)
    rows = df.collect()
    assert len(rows) == 6  # blank line skipped
    bad = [r for r in rows if not r.parse_ok]
    assert [r.value for r in bad] == ["garbage"] and bad[0].granule_id is None
    good, lines = inv.quarantine(df)
    assert good.count() == 5 and [tuple(r) for r in lines.collect()] == [("inv.txt", "garbage")]


def test_number_rows_matches_row_number_per_group(spark):
    # many range partitions and a hot day: the distributed numbering equals a global row_number per group
    base = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("inventory"),
        F.format_string("G%05d", "id").alias("granule_id"),
        F.when(F.col("id") % 2 == 0, F.lit("2024-01-01 00:00:00"))
        .otherwise(F.expr("cast(timestamp_seconds(id * 3600) as string)"))
        .cast("timestamp")
        .alias("start_datetime"),
    )
    numbered = inv.number_rows(base, inv.inventory_order(), group=["inventory"], num_partitions=7)
    got = {(r.inventory, r.granule_id): r.inventory_seq for r in numbered.collect()}
    pdf = base.toPandas().sort_values(["inventory", "start_datetime", "granule_id"], ascending=[True, False, True])
    pdf["seq"] = pdf.groupby("inventory").cumcount()
    want = {(r.inventory, r.granule_id): r.seq for r in pdf.itertuples()}
    assert got == want


def test_text_scan_and_write_roundtrip(spark, scratch):
    for name, part in (("one-cumulus-rds-granules.txt", LINES[:3]), ("two-cumulus-rds-granules.txt", LINES[3:])):
        with open(f"{scratch}/{name}", "w") as f:
            f.write("\n".join(part) + "\n\n")
    lines = src.read_inventory_text(spark, [f"{scratch}/one-cumulus-rds-granules.txt",
                                            f"{scratch}/two-cumulus-rds-granules.txt"])
    converted = inv.convert_inventory(lines)
    src.write_inventory(converted, f"{scratch}/out")
    back = src.read_inventory(spark, f"{scratch}/out", ["inventory", "inventory_seq", "granule_id", "status"])
    rows = back.orderBy("inventory", "inventory_seq").collect()
    assert [(r.inventory, r.inventory_seq) for r in rows] == [("one-cumulus-rds-granules.txt", i) for i in range(3)]
    assert dict(spark.read.parquet(f"{scratch}/out").dtypes)["start_datetime"] == "date"


def test_monthly_layout_write(spark, scratch):
    converted = inv.convert_inventory(lines_df(spark, LINES))
    src.write_monthly(inv.monthly_layout(converted), f"{scratch}/monthly")
    back = spark.read.parquet(f"{scratch}/monthly")
    assert sorted((r.year, r.month) for r in back.select("year", "month").collect()) == [(2018, 1), (2021, 1), (2023, 10)]


def test_number_rows_with_aqe_coalesced_range_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        base = spark.range(0, 3000).select(
            F.lit("inv").alias("inventory"),
            F.format_string("G%05d", "id").alias("granule_id"),
            F.expr("timestamp_seconds(id * 86400)").alias("start_datetime"),
        )
        numbered = inv.number_rows(base, inv.inventory_order(), group=["inventory"])
        got = sorted((r.inventory_seq, r.granule_id) for r in numbered.collect())
        assert got == [(i, f"G{2999 - i:05d}") for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
