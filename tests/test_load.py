import datetime as dt
import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tideline import ColumnSpec, DailyLoad, LoadConfig, align_union, day_slice, overwrite_days
from tideline.sources import neighbouring_days

COLUMNS = (
    ColumnSpec("Id", "int", "the id"),
    ColumnSpec("Origin", "string", "place"),
    ColumnSpec("FlightDate", "date", "local date", "yyyy-MM-dd"),
    ColumnSpec("DepTime", "int", "hhmm"),
    ColumnSpec("Reporting_Airline", "string"),
)
SCHEMA = "Id int, Origin string, FlightDate date, DepTime int, Reporting_Airline string"


def day(n):
    return dt.date(2023, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def table(spark, request):
    name = "t_" + "".join(ch if ch.isalnum() else "_" for ch in request.node.name).lower()
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def loader(spark, table, columns=COLUMNS, **more):
    zones = spark.createDataFrame(
        [("A", "America/New_York"), ("B", "Europe/Madrid"), ("C", "Asia/Kolkata")],
        "iata_code string, iana_tz string",
    )
    return DailyLoad(LoadConfig(columns, table, tie_break=("Id",), **more), zones)


OFFSETS = {"A": -5, "B": 1, "C": 5.5}


def instant(row):
    _, place, d, clock, _ = row
    if clock is None or clock >= 2400 or place not in OFFSETS:
        return None
    local = dt.datetime.combine(d, dt.time(clock // 100, clock % 100))
    return local - dt.timedelta(hours=OFFSETS[place])


def recompute(rows, lookback):
    """What the table must hold, in plain Python: id -> (next time, airline, gap)."""
    out = {r[0]: (None, None, None) for r in rows}
    for place in {r[1] for r in rows}:
        timed = sorted(((instant(r), r[2], r[0], r[4]) for r in rows if r[1] == place and instant(r)))
        for (t, d, i, _), (t2, d2, _, airline) in zip(timed, timed[1:]):
            if (d2 - d).days <= lookback:
                out[i] = (t2, airline, int((t2 - t).total_seconds()))
    return out


def stored(spark, table):
    return {r.Id: (r.FlightTime_next, r.Airline_next, r.diff_next) for r in spark.table(table).collect()}


def some_rows(rnd, d, base, most=6):
    return [
        (base + i, rnd.choice(["A", "A", "B", "C", "X", None]), d,
         rnd.choice([None, 2400, 0, 5, 2359, rnd.randrange(24) * 100 + rnd.randrange(60)]), rnd.choice("pqr"))
        for i in range(rnd.randrange(1, most))
    ]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0), (0, 2, 1)])
def test_three_days_in_any_order(spark, table, order):
    rnd = random.Random(7)
    days = {n: some_rows(rnd, day(n), 100 * n, 9) for n in range(3)}
    load = loader(spark, table)
    for n in order:
        load.load(spark.createDataFrame(days[n], SCHEMA))
    assert stored(spark, table) == recompute([r for n in order for r in days[n]], 1)
    assert spark.table(table).columns[-1] == "FlightDate"


@pytest.mark.parametrize("seed", range(3))
def test_random_batches_and_reloads(spark, table, seed):
    rnd = random.Random(seed)
    lookback = rnd.choice([1, 2, 3])
    load = loader(
        spark, table, lookback_days=lookback,
        rows_per_task=rnd.choice([None, 3, 1000]), broadcast_rows=rnd.choice([0, 1000]),
    )
    truth = {}
    for step in range(7):
        chosen = rnd.sample(range(8), rnd.choice([1, 1, 2, 3]))
        batch = {n: some_rows(rnd, day(n), 1000 * step + 100 * n) for n in chosen}
        truth |= batch
        written = load.load(spark.createDataFrame([r for rows in batch.values() for r in rows], SCHEMA))
        assert set(written) >= {day(n) for n in batch}
        assert stored(spark, table) == recompute([r for rows in truth.values() for r in rows], lookback)


def test_repeating_a_load_writes_its_own_day_only(spark, table):
    load = loader(spark, table)
    rows = {n: [(10 * n + i, "A", day(n), 100 * i, "p") for i in range(3)] for n in range(3)}
    for n in range(3):
        load.load(spark.createDataFrame(rows[n], SCHEMA))
    before = stored(spark, table)
    assert load.load(spark.createDataFrame(rows[1], SCHEMA)) == [day(1)]
    assert stored(spark, table) == before


def test_reload_that_loses_rows_leaves_no_stale_successor(spark, table):
    load = loader(spark, table)
    load.load(spark.createDataFrame([(1, "A", day(0), 900, "p")], SCHEMA))
    load.load(spark.createDataFrame([(2, "A", day(1), 900, "q"), (3, "B", day(1), 900, "q")], SCHEMA))
    assert stored(spark, table)[1][1] == "q"
    assert load.load(spark.createDataFrame([(3, "B", day(1), 900, "q")], SCHEMA)) == [day(0), day(1)]
    assert stored(spark, table) == {1: (None, None, None), 3: (None, None, None)}


def test_empty_batch_is_nothing(spark, table):
    load = loader(spark, table)
    assert load.load(spark.createDataFrame([], SCHEMA)) == []
    assert not spark.catalog.tableExists(table)


def test_row_without_day_is_refused_and_staging_is_gone(spark, table):
    load = loader(spark, table)
    with pytest.raises(ValueError, match="no day"):
        load.load(spark.createDataFrame([(1, "A", None, 5, "p")], SCHEMA))
    assert spark.sql("SHOW TABLES IN tideline_staging").where("tableName like 'batch%'").count() == 0


def test_stray_day_is_refused(spark, table):
    load = loader(spark, table)
    first = [(i, "A", day(0), 100 * i, "p") for i in range(5)]
    load.load(spark.createDataFrame(first, SCHEMA), [day(0)])
    before = stored(spark, table)
    mixed = spark.createDataFrame([(10, "A", day(1), 900, "q"), (11, "A", day(0), 900, "q")], SCHEMA)
    with pytest.raises(ValueError, match="2023-01-01"):
        load.load(mixed, [day(1)])
    assert stored(spark, table) == before
    assert load.load(mixed.where("Id = 10"), [day(1)]) == [day(0), day(1)]


def test_failure_while_writing_keeps_a_copy_of_the_day_before(spark, table, monkeypatch):
    load = loader(spark, table)
    load.load(spark.createDataFrame([(1, "A", day(0), 900, "p")], SCHEMA))
    batch = spark.createDataFrame([(2, "A", day(1), 900, "q")], SCHEMA)

    def lost(*args, **more):
        raise OSError("no more disk")

    with monkeypatch.context() as patch:
        patch.setattr("tideline.plans.daily_load.overwrite_days", lost)
        with pytest.raises(OSError) as caught:
            load.load(batch)
    copy = caught.value.__notes__[0].split()[-1]
    assert [r.Id for r in spark.table(copy).collect()] == [1]
    spark.sql(f"DROP TABLE {copy}")
    assert stored(spark, table) == {1: (None, None, None)}
    load.load(batch)
    assert stored(spark, table)[1][1] == "q"
    assert spark.sql("SHOW TABLES IN tideline_staging").where("tableName like 'before%'").count() == 0


def test_files_with_explicit_path_and_new_column(spark, table, tmp_path):
    def write(n, **more):
        path = tmp_path / f"{day(n)}.json"
        rows = [{"place": {"Origin": "A"}, "FlightDate": str(day(n)),
                 "legs": [{"Id": 10 * n + i, "DepTime": 100 * i, "Reporting_Airline": "p"} for i in range(2)]} | more]
        path.write_text("\n".join(json.dumps(r) for r in rows))
        return str(path)

    load = loader(spark, table, output_path=str(tmp_path / "out"), output_partitions=10)
    load.run(write(0))
    load.run(write(1))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == [
        "FlightDate=2023-01-01", "FlightDate=2023-01-02"]
    specs = (*COLUMNS, ColumnSpec("Gate", "string", "it's a gate"))
    wider = loader(spark, table, specs)
    wider.run(write(2, Gate="G1"))
    got = {r.Id: (r.Gate, r.diff_next) for r in spark.table(table).collect()}
    assert got == {0: (None, 3600), 1: (None, 82800), 10: (None, 3600), 11: (None, 82800), 20: ("G1", 3600), 21: ("G1", None)}
    assert spark.table(table).schema["Gate"].metadata["comment"] == "it's a gate"
    assert spark.table(table).schema["Id"].metadata["comment"] == "the id"
    # A batch without the new column: nulls, the table keeps it.
    load.run(write(3))
    got = {r.Id: r.Gate for r in spark.table(table).collect()}
    assert got[20] == "G1" and got[30] is None and len(got) == 8


def test_day_must_be_a_date(spark, table):
    rows = spark.createDataFrame([(1, "A", "2023-01-01", 5, "p")], SCHEMA.replace("FlightDate date", "FlightDate string"))
    with pytest.raises(TypeError, match="FlightDate"):
        loader(spark, table).load(rows)


def test_errors_are_raised(spark, table, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        loader(spark, table).run(str(tmp_path / "missing.json"))


def test_config_from_file(tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({
        "data_columns": [{"name": "d", "type": "date", "format": "yyyy-MM-dd", "comment": "day"}],
        "output_table": "default.t", "output_partitions": 10, "EXECUTION_ENVIRONMENT": "local"}))
    config = LoadConfig.from_file(str(path), lookback_days=3)
    assert config.columns == (ColumnSpec("d", "date", "day", "yyyy-MM-dd"),)
    assert (config.output_table, config.output_partitions, config.lookback_days, config.output_path) == (
        "default.t", 10, 3, None)


def test_settings_from_file_and_misspelt_ones():
    settings = {"data_columns": [], "output_table": "t", "tie_break": ["a"], "outer": True, "maps": "drop", "on_error": "fail"}
    config = LoadConfig.from_dict(settings)
    assert (config.tie_break, config.outer, config.maps, config.on_error) == (("a",), True, "drop", "fail")
    with pytest.raises(ValueError, match="outputpath"):
        LoadConfig.from_dict(settings | {"outputpath": "x"})


def test_overwrite_keeps_other_days(spark, table):
    def frame(n, v):
        return spark.createDataFrame([(day(n), v)], "FlightDate date, v int")

    for n in range(3):
        overwrite_days(frame(n, n), table)
    overwrite_days(frame(1, 11), table)
    assert sorted((r.FlightDate, r.v) for r in spark.table(table).collect()) == [
        (day(0), 0), (day(1), 11), (day(2), 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"


def test_big_day_is_written_by_several_tasks(spark, table):
    rows = spark.range(0, 200_000, 1, 4).select("id", F.lit(day(0)).alias("FlightDate"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        overwrite_days(rows, table)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.table(table).count() == 200_000
    assert len(spark.table(table).inputFiles()) > 2


def test_unpartitioned_table_is_refused(spark, table):
    spark.range(1).write.saveAsTable(table)
    with pytest.raises(ValueError, match="not partitioned"):
        overwrite_days(spark.createDataFrame([(day(0), 1)], "FlightDate date, id long"), table)


def test_day_slice_reads_its_partition_only(spark, table):
    assert day_slice(spark, table, [day(0)]) is None
    for n in range(3):
        overwrite_days(spark.createDataFrame([(day(n), n)], "FlightDate date, v int"), table)
    part = day_slice(spark, table, [day(1)])
    assert [r.v for r in part.collect()] == [1]
    assert len(part.inputFiles()) >= 1
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "FlightDate" in filters and "2023-01-02" in filters
    assert day_slice(spark, table, [day(9)]).count() == 0


def test_neighbouring_days():
    assert neighbouring_days([day(1), day(4)], 1, 1) == [day(0), day(2), day(3), day(5)]
    assert neighbouring_days([day(1)], 2, 0) == [day(-1), day(0)]
    assert neighbouring_days([day(1)], 0, 0) == []


def test_align_union(spark):
    left = spark.createDataFrame([(1, "gone")], "a int, extra string")
    right = spark.createDataFrame([("x", 1), ("x", 1)], "b string, a int")
    out = align_union(left, right)
    assert out.columns == ["b", "a"]
    assert sorted(map(str, out.collect())) == sorted(["Row(b=None, a=1)", "Row(b='x', a=1)", "Row(b='x', a=1)"])


@pytest.mark.parametrize("seed", range(2))
def test_ties_without_a_tie_break(spark, table, seed):
    """Many rows of one minute and nothing to tell them apart: the table follows the stated order, however often
    and in whatever order of rows days are loaded."""
    rnd = random.Random(seed)
    load = loader(spark, table)
    load.config = replace(load.config, tie_break=())
    truth = {}
    for step in range(6):
        n = rnd.randrange(3)
        rows = truth.get(n, []) + [(100 * step + i, "A", day(n), rnd.choice([900, 1000]), rnd.choice("pqr")) for i in range(2)]
        rnd.shuffle(rows)
        truth[n] = rows
        load.load(spark.createDataFrame(rows, SCHEMA).repartition(rnd.randrange(1, 4)))
        timed = sorted(((instant(r), r[4], r[0], r[2]) for v in truth.values() for r in v))
        wanted = {
            a[2]: (b[0], b[1], int((b[0] - a[0]).total_seconds())) if (b[3] - a[3]).days <= 1 else (None, None, None)
            for a, b in zip(timed, timed[1:])
        } | {timed[-1][2]: (None, None, None)}
        assert stored(spark, table) == wanted


def test_reload_in_another_order_repairs_the_day_before(spark, table):
    first, second = [(1, "A", day(0), 900, "p")], [(2, "A", day(1), 900, "B"), (3, "A", day(1), 900, "A")]
    for rows in (second, second[::-1]):
        load = loader(spark, table)
        load.config = replace(load.config, tie_break=())
        load.load(spark.createDataFrame(first, SCHEMA))
        load.load(spark.createDataFrame(second[:1], SCHEMA))
        load.load(spark.createDataFrame(rows, SCHEMA))
        assert stored(spark, table)[1][1] == "A"
        spark.sql(f"DROP TABLE {table}")


def test_malformed_records_go_to_a_table(spark, table, tmp_path):
    path = tmp_path / "2023-01-01.json"
    line = '{"place":{"Origin":"A"},"FlightDate":"2023-01-01","legs":[{"Id":%d,"DepTime":100,"Reporting_Airline":"p"}]}'
    path.write_text("\n".join([line % 1, (line % 2)[:-9], line % 3]))
    nested = "place struct<Origin:string>, FlightDate string, legs array<struct<Id:int,DepTime:int,Reporting_Airline:string>>"
    load = loader(spark, table, on_error="store", json_schema=nested)
    try:
        assert load.run(str(path)) == [day(0)]
        assert sorted(r.Id for r in spark.table(table).collect()) == [1, 3]
        lost = spark.table(load.malformed_table).collect()
        assert [(r.file.split("/")[-1], r.day, r.text) for r in lost] == [(path.name, day(0), (line % 2)[:-9])]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {load.malformed_table}")


def test_only_days_that_can_follow_a_repaired_one_are_ordered(spark, table, monkeypatch):
    """And beside a large lookup rows that are given are stored once."""
    from tideline.plans import daily_load

    seen, copies, changed, staged = [], [], DailyLoad._changed, daily_load.staged

    def spy(self, batch, kept):
        seen.append([sorted({r.FlightDate for r in df.select("FlightDate").collect()}) for df in (batch, kept)])
        return changed(self, batch, kept)

    monkeypatch.setattr(DailyLoad, "_changed", spy)
    rows = {n: [(10 * n + i, "A", day(n), 900 + i, "p") for i in range(2)] for n in range(5)}
    load = loader(spark, table, broadcast_rows=0)
    load.load(spark.createDataFrame(sum(rows.values(), []), SCHEMA))
    monkeypatch.setattr(daily_load, "staged", lambda df, label="batch", keep=False: (copies.append(label), staged(df, label, keep))[1])
    rows[1] = [(10, "A", day(1), 800, "q")]
    assert load.load(spark.createDataFrame(rows[1] + rows[2] + rows[3], SCHEMA)) == [day(n) for n in range(4)]
    assert seen == [[[day(1)], [day(0)]]] and copies == ["batch", "before"]
    assert stored(spark, table) == recompute(sum(rows.values(), []), 1)
