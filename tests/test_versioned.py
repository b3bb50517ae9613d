import json
import random

import pytest
from pyspark.sql import functions as F

from tests.test_load import COLUMNS, SCHEMA, day, recompute, some_rows
from tideline import ColumnSpec, DailyLoad, DayStore, LoadConfig, VersionedLoad, quality_report
from tideline.plans.day_store import Conflict, State

ANY = 10**6


def loader(spark, root, columns=COLUMNS, **more):
    zones = spark.createDataFrame(
        [("A", "America/New_York"), ("B", "Europe/Madrid"), ("C", "Asia/Kolkata")], "iata_code string, iana_tz string"
    )
    more = {"tie_break": ("Id",)} | more
    return VersionedLoad(LoadConfig(columns, "unused", output_path=str(root), **more), zones)


def stored(load):
    return {r.Id: (r.FlightTime_next, r.Airline_next, r.diff_next) for r in load.table().collect()}


def check_report(load):
    wanted = quality_report(load.table()).orderBy("FlightDate").collect()
    assert load.store.report().orderBy("FlightDate").collect() == wanted


@pytest.mark.parametrize("lookback", [1, None])
@pytest.mark.parametrize("order", [(0, 3, 1, 2), (3, 2, 1, 0)])
def test_days_in_any_order(spark, tmp_path, order, lookback):
    rnd = random.Random(7)
    days = {n: some_rows(rnd, day(2 * n), 100 * n, 9) for n in range(4)}
    load = loader(spark, tmp_path / "s", lookback_days=lookback)
    assert load.table() is None
    for n in order:
        load.load(spark.createDataFrame(days[n], SCHEMA))
    assert stored(load) == recompute([r for rows in days.values() for r in rows], lookback or ANY)
    assert load.table().columns[-1] == "FlightDate"
    check_report(load)


@pytest.mark.parametrize("seed", range(3))
def test_random_batches_and_reloads(spark, tmp_path, seed):
    rnd = random.Random(seed)
    lookback = [1, 3, None][seed]
    load = loader(
        spark, tmp_path / "s", lookback_days=lookback,
        rows_per_task=rnd.choice([None, 3, 1000]), broadcast_rows=rnd.choice([0, 1000]),
    )
    truth = {}
    for step in range(6):
        batch = {n: some_rows(rnd, day(n), 1000 * step + 100 * n) for n in rnd.sample(range(8), rnd.choice([1, 1, 2, 3]))}
        truth |= batch
        written = load.load(spark.createDataFrame([r for rows in batch.values() for r in rows], SCHEMA))
        assert set(written) >= {day(n) for n in batch}
        assert stored(load) == recompute([r for rows in truth.values() for r in rows], lookback or ANY)
    check_report(load)
    assert load.store.clean(keep=1, older_than=-60) > 0
    assert stored(load) == recompute([r for rows in truth.values() for r in rows], lookback or ANY)
    assert load.store.clean(keep=1, older_than=-60) == 0


def test_ties_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    first = [(1, "A", day(0), 900, "p")]
    second = [(2, "A", day(1), 900, "B"), (3, "A", day(1), 900, "A")]
    for rows in (second, second[::-1]):
        load = loader(spark, tmp_path / str(rows[0][0]), tie_break=())
        load.load(spark.createDataFrame(first, SCHEMA))
        load.load(spark.createDataFrame(second[:1], SCHEMA))
        assert stored(load)[1][1] == "B"
        load.load(spark.createDataFrame(rows, SCHEMA))
        assert stored(load)[1][1] == "A" and stored(load)[3][1] == "B"


def test_a_repair_reads_no_body(spark, tmp_path, monkeypatch):
    load = loader(spark, tmp_path / "s")
    rows = {n: [(10 * n + i, "A", day(n), 100 * i, "p") for i in range(5)] for n in range(3)}
    load.load(spark.createDataFrame(rows[0] + rows[2], SCHEMA))
    before, asked = load.store.state(), []
    read = DayStore.read
    monkeypatch.setattr(DayStore, "read", lambda self, folders, schema: read(self, [asked.append(f) or f for f in folders], schema))
    assert load.load(spark.createDataFrame(rows[1], SCHEMA)) == [day(0), day(1)]
    monkeypatch.undo()
    old = before.versions()
    assert asked and not [f for f in asked if "/".join(f.split("/")[:2]) in old and "_part=body" in f]
    after = load.store.state()
    assert after.days[day(0)]["body"] == before.days[day(0)]["body"] and after.days[day(0)]["tails"] != before.days[day(0)]["tails"]
    assert after.days[day(2)] == before.days[day(2)]
    assert stored(load) == recompute(sum(rows.values(), []), 1)
    # Nothing has changed: only the day itself is written.
    assert load.load(spark.createDataFrame(rows[1], SCHEMA)) == [day(1)]


def test_a_lost_writer_leaves_the_old_days_whole(spark, tmp_path, monkeypatch):
    load = loader(spark, tmp_path / "s")
    old = [(i, "A", day(0), 100 * i, "p") for i in range(4)]
    load.load(spark.createDataFrame(old, SCHEMA))
    before, frame = stored(load), load.table()
    new = spark.createDataFrame([(9, "A", day(0), 900, "q"), (10, "A", day(1), 900, "q")], SCHEMA)
    write = DayStore.write
    for lost_at in ("days", "firsts", "tails", "commit"):
        def write_some(self, rows, kind, *parts):
            if kind == lost_at:
                write(self, rows.limit(1), kind, *parts)  # one file, then the writer is gone
                raise OSError("lost")
            return write(self, rows, kind, *parts)

        def lost(*args):
            raise OSError("lost")

        with monkeypatch.context() as patch:
            patch.setattr(DayStore, "write", write_some)
            if lost_at == "commit":
                patch.setattr(DayStore, "commit", lost)
            with pytest.raises(OSError):
                load.load(new)
        assert stored(load) == before
    load.load(new)
    assert set(stored(load)) == {9, 10}
    # A reader that had begun still finds its files.
    assert {r.Id for r in frame.collect()} == {0, 1, 2, 3}


@pytest.mark.parametrize("first, second", [(0, 1), (1, 0)])
def test_two_loads_at_once(spark, tmp_path, monkeypatch, first, second):
    """The second load commits after the first has read its state."""
    one, other = loader(spark, tmp_path / "s"), loader(spark, tmp_path / "s", (*COLUMNS, ColumnSpec("Gate", "string")))
    rows = {n: [(10 * n + i, "A", day(n), 100 * i, "p") for i in range(3)] for n in range(2)}
    commit, calls = DayStore.commit, []

    def interleaved(self, base, state):
        calls.append(base.number)
        if len(calls) == 1:
            other.load(spark.createDataFrame(rows[second], SCHEMA).withColumn("Gate", F.lit("G")))
        return commit(self, base, state)

    monkeypatch.setattr(DayStore, "commit", interleaved)
    one.load(spark.createDataFrame(rows[first], SCHEMA))
    assert calls == [0, 0, 1]
    assert stored(one) == recompute(rows[0] + rows[1], 1)
    assert {r.Id // 10: r.Gate for r in one.table().collect()} == {first: None, second: "G"}


def test_commits_are_taken_once(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "s"))
    assert store.state() == State()
    assert store.commit(State(), State(undated={"f": "x/version=1"})).number == 1
    with pytest.raises(Conflict):
        store.commit(State(), State())
    assert store.state().undated == {"f": "x/version=1"}
    assert sorted(p.name for p in (tmp_path / "s" / "_commits").iterdir() if not p.name.startswith(".")) == [f"{1:020}.json"]


def test_overwrite_replaces_days_in_one_step(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "s"))
    frame = lambda *rows: spark.createDataFrame([(day(n), v) for n, v in rows], "FlightDate date, v int")
    assert store.overwrite(frame((0, 1), (1, 2), (1, 3))) == [day(0), day(1)]
    store.write(frame((0, 100), (1, 100)), "days")  # never committed
    assert store.overwrite(frame((1, 4), (2, 5)).withColumn("w", F.lit("x"))) == [day(1), day(2)]
    assert sorted(tuple(r) for r in store.rows().collect()) == [(1, None, day(0)), (4, "x", day(1)), (5, "x", day(2))]
    assert [r.v for r in store.rows([day(2)]).collect()] == [5]
    assert len(store.rows([day(2)]).inputFiles()) == 1
    assert store.overwrite(frame()) == []
    with pytest.raises(ValueError, match="without"):
        store.overwrite(spark.createDataFrame([(None, 1)], "FlightDate date, v int"))


DELAYED = (*COLUMNS, ColumnSpec("DepDelay", "int"))


def rolled(row):
    _, _, d, clock, _, delay = row
    if clock is None or clock >= 2400 or delay is None:
        return d
    minutes = clock // 100 * 60 + clock % 100
    return day((d - day(0)).days - (minutes - delay) // 1440)


@pytest.mark.parametrize("seed", range(2))
def test_delayed_departures_go_to_their_true_day(spark, tmp_path, seed):
    rnd = random.Random(seed)
    load = loader(spark, tmp_path / "s", DELAYED, delay="DepDelay", lookback_days=[2, None][seed])
    truth = {}
    for step in range(6):
        n = rnd.randrange(4)
        truth[n] = [(*r, rnd.choice([None, 0, 30, 600, 1500, -200])) for r in some_rows(rnd, day(n), 100 * step, 8)]
        load.load(spark.createDataFrame(truth[n], f"{SCHEMA}, DepDelay int"), [day(n)])
        rows = [(r[0], r[1], rolled(r), r[3], r[4]) for v in truth.values() for r in v]
        assert stored(load) == recompute(rows, [2, ANY][seed])
        found = {r.Id: (r.FlightDate, r.SourceDate) for r in load.table().collect()}
        assert found == {r[0]: (rolled(r), day(n)) for n, v in truth.items() for r in v}
    check_report(load)
    with pytest.raises(ValueError, match="other days"):
        load.load(spark.createDataFrame(truth[n], f"{SCHEMA}, DepDelay int"), [day(9)])


def nested(rows):
    return [json.dumps({"place": {"Origin": r[1]}, "FlightDate": str(r[2]),
                        "legs": [{"Id": r[0], "DepTime": r[3], "Reporting_Airline": r[4]}]}) for r in rows]


JSON = "place struct<Origin:string>, FlightDate string, legs array<struct<Id:int,DepTime:int,Reporting_Airline:string>>"


@pytest.mark.parametrize("schema", [JSON, None])
def test_malformed_records_are_stored(spark, tmp_path, schema):
    load = loader(spark, tmp_path / "s", on_error="store", json_schema=schema)
    rows = {n: [(10 * n + i, "A", day(n), 100 * i, "p") for i in range(4)] for n in range(2)}
    lines = {n: nested(v) for n, v in rows.items()}
    broken = [lines[0][1][:-9], "not json", '{"FlightDate": 5, "legs": {"Id": 1}}'][: 3 if schema else 2]
    files = {n: tmp_path / f"{day(n)}.json" for n in range(3)}
    files[0].write_text("\n".join([lines[0][0], *broken, *lines[0][2:]]))
    files[1].write_text("\n".join(lines[1]))
    files[2].write_text("[}")
    load.run([str(f) for f in files.values()])
    kept = [r for n in rows for r in rows[n] if r != rows[0][1]]
    assert stored(load) == recompute(kept, 1)
    lost = {(r.file.split("/")[-1], r.day, r.text) for r in load.store.malformed().collect()}
    assert lost == {(files[0].name, day(0), t) for t in broken} | {(files[2].name, None, "[}")}
    # The files are mended: nothing is left of the old records.
    files[0].write_text("\n".join(lines[0]))
    files[2].write_text(nested([(99, "B", day(5), 100, "p")])[0])
    load.run([str(files[0]), str(files[2])])
    assert load.store.malformed().count() == 0
    assert stored(load) == recompute(rows[0] + rows[1] + [(99, "B", day(5), 100, "p")], 1)


def test_malformed_multiline_files_are_stored(spark, tmp_path):
    load = loader(spark, tmp_path / "s", on_error="store", json_schema=JSON, multiline=True)
    rows = [(i, "A", day(0), 100 * i, "p") for i in range(3)]
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text("[" + ",\n".join(nested(rows)) + "]")
    bad.write_text("[" + ",\n".join(nested(rows))[:-5])
    load.run([str(good), str(bad)])
    assert stored(load) == recompute(rows, 1)
    assert [(r.file.split("/")[-1], r.day, r.text) for r in load.store.malformed().collect()] == [("bad.json", None, bad.read_text())]


def test_refusals(spark, tmp_path):
    zones = spark.createDataFrame([("A", "UTC")], "iata_code string, iana_tz string")
    with pytest.raises(ValueError, match="output_path"):
        VersionedLoad(LoadConfig(COLUMNS, "t"), zones)
    for more in ({"delay": "DepDelay"}, {"lookback_days": None}):
        with pytest.raises(ValueError, match="VersionedLoad"):
            DailyLoad(LoadConfig(COLUMNS, "t", **more), zones)
    load = loader(spark, tmp_path / "s")
    with pytest.raises(ValueError, match="no day"):
        load.load(spark.createDataFrame([(1, "A", None, 5, "p")], SCHEMA))
    assert load.load(spark.createDataFrame([], SCHEMA)) == [] and load.table() is None


def test_tails_find_their_successors_in_one_shuffle(spark, tmp_path):
    load = loader(spark, tmp_path / "s", lookback_days=None)
    load.load(spark.createDataFrame([(1, "A", day(0), 900, "p"), (2, None, day(0), 900, "p")], SCHEMA))
    load.load(spark.createDataFrame([(3, "A", day(4), 900, "q")], SCHEMA))
    state = load.store.state()
    parts = {p: load.store.read(state.folders([p]), state.schema) for p in ("tails", "firsts")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        followed = load._followed(parts["tails"], parts["firsts"].select("Origin", "FlightTime_next", "Airline_next", "FlightDate"))
        plan = followed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert {(r.Id, r._after and r._after.Airline_next, r._known) for r in followed.collect()} == {(1, "q", True), (3, None, True)}


def test_firsts_cut_to_the_keys_of_a_small_load(spark, tmp_path, monkeypatch):
    """The table is the same whether the firsts of other days are cut to the keys of a load or not."""
    from tideline.plans import versioned_load

    rnd = random.Random(3)
    days = {n: some_rows(rnd, day(2 * n), 100 * n, 9) for n in range(3)}
    for factor in (0, 10**9):
        monkeypatch.setattr(versioned_load, "_FEW", factor)
        load = loader(spark, tmp_path / str(factor), lookback_days=None)
        for n in (2, 0, 1):
            load.load(spark.createDataFrame(days[n], SCHEMA))
        load.load(spark.createDataFrame(days[1][:1], SCHEMA))
        assert stored(load) == recompute([r for n in (0, 2) for r in days[n]] + days[1][:1], ANY)
        check_report(load)
