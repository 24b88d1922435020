"""P-helpers: composite keys, RFC 3339 round trip, lookback bounds, strict
base64 decode, contract key normalisation."""

import base64

from conftest import ts

from pyspark.sql import functions as F

from parcelflow.functions.columns import composite_key, decode_payload, event_key, lookback, rfc3339


def test_composite_key_and_event_key(spark):
    df = spark.createDataFrame([("a", None, 3, " parcel-created ")], "x string, y string, z int, t string")
    r = df.select(composite_key(["x", "y", "z"], "|").alias("k"),
                  composite_key(["x", "y"], "-", null=None).alias("n"),
                  event_key("t").alias("e")).first()
    assert (r.k, r.n, r.e) == ("a||3", None, "PARCEL_CREATED")


def test_rfc3339_round_trip_and_lookback(spark):
    df = spark.createDataFrame([(ts("2024-01-08 00:00:00.000123"),), (ts("2024-01-07 23:59:59"),)], "t timestamp")
    out = df.select(rfc3339("t").alias("s"), lookback(F.to_date("t"), "2024-01-15", 7).alias("in_window")).collect()
    assert [r.s for r in out] == ["2024-01-08T00:00:00.000123Z", "2024-01-07T23:59:59.000000Z"]
    assert [r.in_window for r in out] == [True, False]
    back = spark.createDataFrame([(out[0].s,)], "s string").select(F.col("s").try_cast("timestamp").alias("t"))
    assert back.first().t == ts("2024-01-08 00:00:00.000123")


def test_strict_base64(spark):
    good = base64.b64encode(b'{"a":1}').decode()
    rows = [(good,), (good[:-1],), ('{"a":1}',), ("1234",)]
    got = [r.p for r in spark.createDataFrame(rows, "r string").select(decode_payload("r").alias("p")).collect()]
    assert got == ['{"a":1}', good[:-1], '{"a":1}', "1234"]
