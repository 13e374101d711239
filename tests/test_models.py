"""Granule IDs as columns (reference ID round trips)."""

from __future__ import annotations

import datetime as dt

from granary.functions import granules as gr

IDS = ["HLS.S30.T63XYZ.2023051T070809.v2.0", "HLS.L30.T62XYZ.2024061T050607.v2.0", "HLS.S30.T61XYZ.2021045T030405.v2.0"]


def test_id_roundtrip(spark):
    df = spark.createDataFrame([(i,) for i in IDS], "granule_id string")
    p = gr.granule_parts("granule_id")
    out = df.select(
        "granule_id",
        p.alias("p"),
        gr.compose_granule_id(p.product, p.platform, p.tile, p.begin_datetime, p.version).alias("back"),
        gr.acquisition_date("granule_id").alias("d"),
    ).collect()
    for r in out:
        assert r.back == r.granule_id
    first = out[0]
    assert (first.p.product, first.p.platform, first.p.tile, first.p.version) == ("HLS", "S30", "T63XYZ", "v2.0")
    assert first.p.begin_datetime == dt.datetime(2023, 2, 20, 7, 8, 9)
    assert first.d == "2023-02-20"


def test_bad_ids_are_null(spark):
    df = spark.createDataFrame([("HLS.S30.T63XYZ.2023051T214901.v2",), ("HLS.S30.T63XYZ.2023366T000000.v2.0",),
                                ("x",)], "granule_id string")
    assert [r.ok for r in df.select(gr.valid_granule_id("granule_id").alias("ok")).collect()] == [False, False, False]
