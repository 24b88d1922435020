import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelflow.functions.contracts import BRONZE_COLUMNS, bronze_schema  # noqa: E402
from parcelflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def bronze_rows(spark, rows):
    """Bronze DataFrame from dicts (absent fields NULL, timestamps as text)."""
    schema = bronze_schema("hot")
    out = []
    for r in rows:
        vals = []
        for f in schema.fields:
            v = r.get(f.name)
            if isinstance(v, str) and f.dataType.typeName() == "timestamp":
                v = ts(v)
            vals.append(v)
        out.append(tuple(vals))
    return spark.createDataFrame(out, schema)


def ev(event_id, parcel_id, event_type, event_ts, seq=0, **kw):
    d = {"schema_version": "1.0.0", "event_version": "1.0.0", "event_id": event_id, "parcel_id": parcel_id,
         "event_type": event_type, "event_ts": event_ts, "producer": "t", "sequence_no": seq}
    d.update(kw)
    return d


__all__ = ["BRONZE_COLUMNS", "bronze_rows", "ev", "ts", "SF_SMALL"]
