"""Monitor of numeric attributes: plain Python, batch twin and stream agree; restarts, idle and late rows."""

import datetime as dt
import math
import random

import pandas as pd
from pyspark.sql import functions as F

from equitas.streaming import values
from equitas.streaming.values import bias_by_value_window, quartile_edges, run_value_monitor

DAY = 86_400
SCHEMA = "ts timestamp, value double, size int, p int, y int"


def _attrs():
    return [("value", F.col("value")), ("size", F.col("size"))]


def _rows(days, seed):
    rng = random.Random(seed)
    out = []
    for d in days:
        for _ in range(150):
            at = dt.datetime(2024, 1, 1) + dt.timedelta(days=d, seconds=rng.randrange(DAY))
            value = rng.choice([None, math.nan, 0.0, rng.lognormvariate(2, 1), -rng.random(), rng.random() * 1e5])
            out.append((at, value, rng.choice([1, 2, 3, 7]), rng.randrange(2), rng.randrange(2)))
    return out


def _cell(v):
    if v == 0:
        return 0.0
    e = math.floor(math.log10(abs(v)))
    return math.floor(v * 10.0 ** (2 - e)) / 10.0 ** (2 - e) if e < 2 else math.floor(v / 10.0 ** (e - 2)) * 10.0 ** (e - 2)


def _plain(rows):
    """window and attribute -> (groups, rows, dpd, eod), value by value."""
    out = {}
    for j, name in ((1, "value"), (2, "size")):
        days, edges = {}, None
        for r in rows:
            if r[j] is not None and not math.isnan(r[j]):
                w = int(r[0].replace(tzinfo=dt.timezone.utc).timestamp()) // DAY * DAY
                days.setdefault(w, []).append((_cell(float(r[j])), r[3], r[4]))
        for w in sorted(days):
            values = sorted(v for v, _, _ in days[w])
            own = sorted({values[-(-k * len(values) // 4) - 1] for k in (1, 2, 3)})
            groups = {}
            for v, p, y in days[w]:
                groups.setdefault(sum(e < v for e in (edges or own)), []).append((p, y))
            rate = [sum(p for p, _ in g) / len(g) for g in groups.values()]
            tpr = [sum(p * y for p, y in g) / max(1, sum(y for _, y in g)) for g in groups.values()]
            out[w, name] = (len(groups), len(values), round(max(rate) - min(rate), 9), round(max(tpr) - min(tpr), 9))
            edges = own
    return out


def _got(df):
    return {(r.window_start, r.attribute): (r.n_groups, r.n_rows, round(r.dpd, 9), round(r.eod, 9))
            for r in df.collect()}


def test_batch_twin_equals_plain(spark):
    rows = _rows(range(6), 1)
    got = _got(bias_by_value_window(spark.createDataFrame(rows, SCHEMA), "ts", _attrs(), F.col("p"), F.col("y")))
    assert got == _plain(rows)
    assert bias_by_value_window(spark.createDataFrame([], SCHEMA), "ts", _attrs(), F.col("p"), F.col("y")).count() == 0


def test_stream_restarts_and_closes_the_last_window(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    early, late = _rows(range(3), 2), _rows(range(3, 5), 3)

    def run():
        return run_value_monitor(spark, src, schema, "ts", _attrs(), F.col("p"), F.col("y"), out, idle=3)

    first = spark.createDataFrame(early, SCHEMA)
    schema = first.schema
    first.repartition(3).write.parquet(src)
    assert _got(run()) == _plain(early)
    # rows of a closed window are late; the next windows use the edges kept in the state
    again = spark.createDataFrame(late + _rows([1], 4), SCHEMA)
    again.coalesce(1).write.mode("append").parquet(src)
    got = run()
    assert _got(got) == _plain(early + late) and got.count() == 10


def test_edges_on_ties():
    assert quartile_edges([(1.0, 5)]) == [1.0]
    assert quartile_edges([(1.0, 1), (2.0, 1), (3.0, 1), (4.0, 1)]) == [1.0, 2.0, 3.0]
    assert quartile_edges([]) == []


def test_a_task_reduces_all_its_batches():
    """One row per cell of a task, whatever the number of Arrow batches it reads."""
    batch = pd.DataFrame({"attribute": ["v"] * 4, "w": [0, 0, 1, 1], "cell": [1.0, 1.0, 2.0, 3.0], "n": 1, "n_pred_pos": 0,
                          "n_pos": 1, "n_true_pos": 0, "last": [3, 4, 5, 6]})
    out = list(values._partial(iter([batch] * 50)))
    assert len(out) == 1 and len(out[0]) == 3 and out[0]["n"].tolist() == [100, 50, 50]
    assert out[0]["last"].tolist() == [4, 5, 6] and list(values._partial(iter([]))) == []


def test_state_is_read_and_written_once_a_window():
    class State:
        def __init__(self):
            self.kept, self.calls = {}, 0

        def containsKey(self, key):
            self.calls += 1
            return key in self.kept

        def getValue(self, key):
            self.calls += 1
            return self.kept[key]

        def updateValue(self, key, value):
            self.calls += 1
            self.kept[key] = value

        def removeKey(self, key):
            del self.kept[key]

        def keys(self):
            return iter(list(self.kept))

    class Handle:
        def __init__(self):
            self.cells, self.own = State(), None

        def getMapState(self, *a):
            return self.cells

        def getValueState(self, *a):
            return self

        def get(self):
            return self.own

        def update(self, value):
            self.own = value

        def listTimers(self):
            return iter([])

        def registerTimer(self, at):
            pass

    class Now:
        def getCurrentProcessingTimeInMs(self):
            return 0

    monitor, handle = values.ValueMonitor(100, 0, 5), Handle()
    monitor.init(handle)
    part = pd.DataFrame({"w": [0] * 300, "cell": [float(i) for i in range(300)], "n": 1, "n_pred_pos": 1, "n_pos": 1,
                         "n_true_pos": 1, "last": 50})
    for _ in range(2):
        assert list(monitor.handleInputRows(("v",), iter([part] * 20), Now())) == []
    assert handle.cells.calls <= 6 and handle.cells.kept[(0,)][1] == [40] * 300
    late = part[:1].assign(w=100, last=250)
    out = next(monitor.handleInputRows(("v",), iter([late]), Now()))
    assert out["n_rows"].tolist() == [12_000, 1] and out["n_groups"].tolist() == [4, 1] and not handle.cells.kept
