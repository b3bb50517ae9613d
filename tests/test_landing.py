import json

import pytest

from tests.test_load import day, loader, recompute, stored
from tideline import land_stream

def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    keys = ["Id", "Origin", "FlightDate", "DepTime", "Reporting_Airline"]
    (folder / name).write_text("\n".join(json.dumps(dict(zip(keys, r)), default=str) for r in rows))


def rows_of(n, ids):
    return [(i, "A", day(n), 100 * (i % 24), "pq"[i % 2]) for i in ids]


def run(spark, *args, **more):
    query = land_stream(spark, *args, **more)
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive


def test_a_file_per_day(spark, tmp_path):
    load = loader(spark, "landed_files")
    days = {n: rows_of(n, range(30 * n, 30 * n + 5)) for n in range(3)}
    try:
        for n in (0, 2):
            put(tmp_path / "in", f"{day(n)}.json", days[n])
        run(spark, str(tmp_path / "in"), load, str(tmp_path / "cp"), max_files=1)
        assert stored(spark, "landed_files") == recompute(days[0] + days[2], 1)
        put(tmp_path / "in", f"{day(1)}.json", days[1])
        run(spark, str(tmp_path / "in"), load, str(tmp_path / "cp"), max_files=1)
        assert stored(spark, "landed_files") == recompute(sum(days.values(), []), 1)
    finally:
        spark.sql("DROP TABLE IF EXISTS landed_files")


def test_a_folder_per_day_is_loaded_whole(spark, tmp_path):
    load = loader(spark, "landed_folders")
    parts = {(n, p): rows_of(n, range(30 * n + 10 * p, 30 * n + 10 * p + 4)) for n in range(2) for p in range(2)}
    try:
        for n, p in [(0, 0), (1, 0), (0, 1)]:
            put(tmp_path / "in" / str(day(n)), f"part-{p}.json", parts[n, p])
        run(spark, str(tmp_path / "in"), load, str(tmp_path / "cp"), unit="folder", max_files=1)
        assert stored(spark, "landed_folders") == recompute(parts[0, 0] + parts[0, 1] + parts[1, 0], 1)
        put(tmp_path / "in" / str(day(1)), "part-1.json", parts[1, 1])
        run(spark, str(tmp_path / "in"), load, str(tmp_path / "cp"), unit="folder", max_files=1)
        assert stored(spark, "landed_folders") == recompute(sum(parts.values(), []), 1)
    finally:
        spark.sql("DROP TABLE IF EXISTS landed_folders")


@pytest.mark.parametrize("most", [1, 2, None])
def test_days_spread_over_files(spark, tmp_path, most):
    """Files of one day, a late one, one of two days; names with blanks and pattern characters."""
    table = f"landed_spread_{most}".lower()
    load = loader(spark, table)
    files = {
        "a.json": rows_of(0, range(4)),
        "b [1] {x} 50%20.json": rows_of(0, range(10, 14)) + rows_of(1, range(30, 33)),
        "c*.json": rows_of(1, range(40, 44)),
    }
    late = rows_of(0, range(20, 23))
    try:
        for name, rows in files.items():
            put(tmp_path / "in", name, rows)
        args = (str(tmp_path / "in"), load, str(tmp_path / "cp"))
        run(spark, *args, max_files=most)
        assert stored(spark, table) == recompute(sum(files.values(), []), 1)
        put(tmp_path / "in", "late.json", late)
        run(spark, *args, max_files=most)
        assert stored(spark, table) == recompute(sum(files.values(), late), 1)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_unit_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="unit"):
        land_stream(spark, str(tmp_path), None, str(tmp_path), unit="day")


def test_malformed_lines_are_stored_once(spark, tmp_path):
    load = loader(spark, "landed_broken", on_error="store")
    days = {n: rows_of(n, range(30 * n, 30 * n + 3)) for n in range(2)}
    try:
        put(tmp_path / "in", "a.json", days[0])
        with (tmp_path / "in" / "a.json").open("a") as file:
            file.write("\n{broken")
        run(spark, str(tmp_path / "in"), load, str(tmp_path / "cp"), max_files=1)
        put(tmp_path / "in", "b.json", rows_of(0, range(10, 12)) + days[1])
        run(spark, str(tmp_path / "in"), load, str(tmp_path / "cp"), max_files=1)
        assert stored(spark, "landed_broken") == recompute(sum(days.values(), rows_of(0, range(10, 12))), 1)
        assert [r.text for r in spark.table(load.malformed_table).collect()] == ["{broken"]
    finally:
        spark.sql("DROP TABLE IF EXISTS landed_broken")
        spark.sql("DROP TABLE IF EXISTS landed_broken_malformed")
