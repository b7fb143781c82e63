import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from volcast.session import build_session, drop_scratch
    s = build_session("local[4]", 8, app_name="volcast-tests")
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="volcast-test-", dir="/tmp")


def make_bars(spark, rows):
    """rows: (symbol, hour_index, close[, high, low, volume, taker]) -> bar DataFrame."""
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    out = []
    for r in rows:
        sym, i, close = r[0], r[1], r[2]
        high = r[3] if len(r) > 3 else close
        low = r[4] if len(r) > 4 else close
        vol = r[5] if len(r) > 5 else 1.0
        taker = r[6] if len(r) > 6 else 0.5
        out.append((sym, base + dt.timedelta(hours=i), float(close), float(high), float(low), float(close),
                    float(vol), float(taker), 1))
    schema = ("symbol string, bar_time timestamp_ntz, open double, high double, low double, close double, "
              "volume double, taker_buy_volume double, num_trades long")
    return spark.createDataFrame(out, schema)
