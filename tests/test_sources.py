import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from fettle.plans.session import work_path
from fettle.sources import records
from fettle.sources import tables as src
from fettle.sources.positions import read_csv_numbered, read_parquet_numbered, with_row_number
from fettle.sources.records import ends_inside


def put(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_csv_scan_is_text_with_null_tokens(spark, tmp_path):
    path = put(tmp_path, "t.csv", 'a,b,c\n1,"x, ""y""\nz",NA\n 2 ,  ,\nNone,é,n/a\n')
    df = src.read_text_table(spark, path, multi_line=True)
    assert [t for _, t in df.dtypes] == ["string"] * 3
    assert [tuple(r) for r in df.collect()] == [
        ("1", 'x, "y"\nz', None), (" 2 ", "  ", None), (None, "é", None)]
    kept = src.read_text_table(spark, path, ["c"], na_tokens=(), multi_line=True)
    assert [r.c for r in kept.collect()] == ["NA", None, "n/a"]


def test_report_round_trip(spark, tmp_path):
    rows = [("a", ' "q" ', 1), ("é|b", "line\nbreak", 2)]
    df = spark.createDataFrame(rows, "k string, t string, n long")
    path = str(tmp_path / "report")
    src.write_report(df, path)
    src.write_report(df, path)
    back = src.read_report(spark, path, "k string, t string, n long")
    assert sorted(map(tuple, back.collect())) == rows


def test_missing_report_is_empty(spark, tmp_path):
    df = src.read_report(spark, str(tmp_path / "none"), "k string, n long")
    assert df.columns == ["k", "n"] and df.count() == 0
    assert src.empty(spark, "a int").count() == 0


def test_snapshot_is_reused_until_forced(spark, tmp_path):
    path = str(tmp_path / "snap")
    one, two = spark.range(3).toDF("n"), spark.range(5).toDF("n")
    assert src.write_snapshot(one, path).count() == 3
    assert src.write_snapshot(two, path).count() == 3
    assert src.write_snapshot(two, path, force=True).count() == 5
    os.remove(os.path.join(path, "_SUCCESS"))  # some stores write none
    assert src.write_snapshot(one, path).count() == 5
    os.rename(os.path.join(path, "_manifest"), str(tmp_path / "gone"))  # as a lost job leaves it
    assert src.write_snapshot(one, path).count() == 3


def test_target_column(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert src.resolve_target(df, "b") == "b" and src.resolve_target(df, "z") == "a"
    with pytest.raises(ValueError):
        src.resolve_target(df.select(), "z")


def test_file_overview(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(3).write.parquet(path)
    row = src.file_overview(spark.read.parquet(path)).first()
    size = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part"))
    assert (row.bytes, row.files, row.rows, row.columns) == (size, 3, 100, 1)


def test_row_numbers_over_blocks_and_groups(spark):
    # Keys in several blocks and groups, negative ones and both ends of the range.
    keys = [-(2**63), -(2**45) - 3, -5, -1, 0, 1, 2**20 - 1, 2**20, 2**42 - 1, 2**42, 2**42 + 7, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k long").repartition(5)
    got = {r.k: r.row_number for r in with_row_number(df, "k").collect()}
    assert got == {k: i + 1 for i, k in enumerate(keys)}
    with pytest.raises(TypeError):
        with_row_number(spark.createDataFrame([("a",)], "k string"), "k")


def test_parquet_row_numbers_follow_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    rows = read_parquet_numbered(spark, path).collect()
    assert sorted((r.row_number, r.id) for r in rows) == [(i + 1, i) for i in range(1000)]


def test_row_numbers_of_a_large_scan_move_no_rows(spark, tmp_path):
    """All rows of a file went to one task where the table was beyond the size of a broadcast."""
    path = str(tmp_path / "t")
    rows = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.repartitionByRange(2, "id").sortWithinPartitions("id").write.parquet(path)
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)) > 1_000_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        df = read_parquet_numbered(spark, path)
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = df.agg(F.count(F.lit(1)), F.count_if(F.col("row_number") == F.col("id") + 1)).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning(_unit" not in plan
    assert tuple(found) == (40_000, 40_000)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_row_numbers_follow_splits(spark, tmp_path, multi_line):
    folder = tmp_path / "t"
    folder.mkdir()
    put(folder, "a.csv", "n,t\n" + "".join(f"{i},row {i}\n" for i in range(700)))
    put(folder, "b.csv", "n,t\n" + "".join(f"{i},row {i}\n" for i in range(700, 2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        df = read_csv_numbered(spark, str(folder), multi_line=multi_line)
        rows = sorted((r.row_number, int(r.n)) for r in df.collect())
        if not multi_line:  # several tasks read each file
            assert records._lines(spark, str(folder)).select("_unit").distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == [(i + 1, i) for i in range(2000)]


@pytest.mark.parametrize("keys", [[1, 2, None], [1, 2, 2], [5, 5]])
def test_row_numbers_refuse_bad_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    with pytest.raises(Exception, match="k is (null|not unique)"):
        with_row_number(df, "k").collect()


def test_sample_rows_in_source_order(spark):
    df = spark.range(50).repartition(4).select("id", (F.col("id") * 2).alias("x"))
    assert [r.x for r in src.sample_rows(df, 3, "id", ["x", "gone"]).collect()] == [0, 2, 4]


def test_work_path_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = work_path(spark, "a"), work_path(spark, "a")
    assert one.startswith(root) and one != two


def csv_rows(folder):
    """All records of a folder's files by Python's reader, null for empty cells."""
    rows = []
    for path in sorted(folder.glob("*.csv")):
        with open(path, newline="", encoding="utf-8") as file:
            rows += [[c or None for c in r] for r in csv.reader(file) if r][1:]
    return rows


def odd_files(folder, seed=1, n=300):
    """Cells with quotes, doubled quotes, commas and line breaks; stray quotes; both line ends."""
    rng = random.Random(seed)
    folder.mkdir()
    for k, end in enumerate(["\n", "\r\n", "\n"]):
        out = [f'id,a,"b\nc",d{end}']
        for i in range(n):
            cells = []
            for _ in range(3):
                text = "".join(rng.choice(["a", " ", "é", ",", "\n", "\r\n", '"', '""', "x" * 20]) for _ in range(rng.randrange(7)))
                quoted = any(c in text for c in ',\n\r"') or rng.random() < 0.1
                cells.append('"' + text.replace('"', '""') + '"' if quoted else text)
            if i % 20 == 0:
                cells = ['5" pipe', 'x"y"z', "plain"]
            if i % 31 == 0:
                out.append(end)
            out.append(",".join([f"{k}-{i}", *cells]) + (end if i < n - 1 or k < 2 else ""))
        put(folder, f"f{k}.csv", "".join(out))


@pytest.fixture
def small_splits(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", ["128m", "2000", "150"])
def test_records_with_line_breaks(spark, tmp_path, small_splits, size):
    """The same records and numbers wherever the borders of the splits fall."""
    odd_files(tmp_path / "t")
    small_splits(size)
    path = str(tmp_path / "t")
    found = read_csv_numbered(spark, path)
    assert found.columns == ["row_number", "id", "a", "b\nc", "d"]
    rows = sorted((tuple(r) for r in found.collect()), key=lambda r: r[0])
    want = csv_rows(tmp_path / "t")
    assert [r[0] for r in rows] == list(range(1, len(want) + 1))
    assert [[c or None for c in r[1:]] for r in rows] == want
    text = src.read_text_table(spark, path, ["id", "d"], na_tokens=())
    assert sorted(tuple(r) for r in text.select("id").collect()) == sorted((r[0],) for r in want)
    if size == "150":
        assert spark.read.text(path).rdd.getNumPartitions() > 100


def test_records_equal_the_reader_of_whole_files(spark, tmp_path, small_splits):
    """Where all line ends are alike, Spark's reader of one task a file is another version."""
    (tmp_path / "t").mkdir()
    cells = ["plain", '"a\nb"', '"say ""hi""\n\n"', '"\n"', '""', "", '",,\n,"', "é"]
    lines = ["n,a,b\n"] + [f"{i},{cells[i % 8]},{cells[i * 3 % 7]}\n" for i in range(400)]
    put(tmp_path / "t", "a.csv", "".join(lines))
    path = str(tmp_path / "t")
    want = sorted((tuple(r) for r in src.read_text_table(spark, path, multi_line=True).collect()), key=lambda r: int(r[0]))
    for size in ("128m", "60"):
        small_splits(size)
        got = sorted((tuple(r) for r in src.read_text_table(spark, path).collect()), key=lambda r: int(r[0]))
        assert got == want
    numbered = sorted(tuple(r) for r in read_csv_numbered(spark, path, multi_line=True).select("row_number", "n").collect())
    small_splits("60")
    assert numbered == sorted(tuple(r) for r in read_csv_numbered(spark, path).select("row_number", "n").collect())


def test_a_cell_over_many_splits(spark, tmp_path, small_splits):
    (tmp_path / "t").mkdir()
    cell = "".join(f"line {i}, of many\n" for i in range(200))
    put(tmp_path / "t", "a.csv", f'n,t\n1,"{cell}"\n2,"{cell}x"\n3,last\n')
    put(tmp_path / "t", "b.csv", "n,t\n")
    put(tmp_path / "t", "c.csv", 'n,"t\nt"\n4,"""\n"""')
    put(tmp_path / "t", "d.csv", "")
    small_splits("200")
    rows = sorted(tuple(r) for r in read_csv_numbered(spark, str(tmp_path / "t")).collect())
    assert rows == [(1, "1", cell), (2, "2", cell + "x"), (3, "3", "last"), (4, "4", '"\n"')]


def test_an_open_quote_is_an_error(spark, tmp_path, small_splits):
    path = put(tmp_path, "t.csv", 'n,t\n1,"never closed\n2,x\n3,y\n')
    with pytest.raises(Exception, match="a quote is not closed in .*t.csv"):
        src.read_text_table(spark, path).collect()


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("a,b", False, True),
        ('"a,b', True, False),
        ('a"b', False, False),
        ('a,"b', True, False),
        ('"a"', False, False),
        ('"a""', True, False),
        ('"', True, False),
        ('""', False, True),
        ('","', False, True),
        ('x","', True, True),
        ('x,"', True, False),
        ('x" y,"', True, True),
        ("", False, True),
    ],
)
def test_what_a_line_does(spark, line, outside, inside):
    row = spark.createDataFrame([(line,)], "v string").select(
        ends_inside(F.col("v"), False).alias("o"), ends_inside(F.col("v"), True).alias("i")
    ).first()
    assert (row.o, row.i) == (outside, inside)


def test_header(spark, tmp_path):
    (tmp_path / "a folder").mkdir()
    put(tmp_path / "a folder", "a.csv", "")
    put(tmp_path / "a folder", "b.csv", '\r\nn,"t\r\n""x""",,N\r\n1,2,3,4\r\n')
    put(tmp_path / "a folder", "c.csv", "other,x\n5,6\n")
    path = str(tmp_path / "a folder")
    assert records.header(spark, path) == ["n0", 't\r\n"x"', "_c2", "N3"]
    rows = [tuple(r) for r in read_csv_numbered(spark, path).orderBy("row_number").collect()]
    assert rows == [(1, "1", "2", "3", "4"), (2, "5", "6", None, None)]
    put(tmp_path / "a folder", "a.csv", '"' + "many\n" * 200 + '",b\n1,2\n')
    assert records.header(spark, path) == ["many\n" * 200, "b"]
    with pytest.raises(ValueError, match="no header"):
        read_csv_numbered(spark, put(tmp_path, "none.csv", "\n\n"))


def written(folder):
    return sorted((p.name, p.stat().st_mtime_ns) for p in folder.glob("*.parquet"))


def test_snapshot_follows_its_input(spark, tmp_path):
    """Written anew when an input file or the schema changes, else used again."""
    source, path = str(tmp_path / "the source"), str(tmp_path / "snapshot")
    spark.range(10).repartition(2).write.parquet(source)

    def snapshot(**kwargs):
        table = spark.read.parquet(source).select((F.col("id") * 2).alias("x"), *kwargs.pop("more", []))
        return sorted(r.x for r in src.write_snapshot(table, path, **kwargs).collect())

    assert snapshot() == list(range(0, 20, 2))
    first = written(tmp_path / "snapshot")
    assert first and snapshot() == list(range(0, 20, 2)) and written(tmp_path / "snapshot") == first
    spark.range(10, 12).write.mode("append").parquet(source)
    assert snapshot() == list(range(0, 24, 2))
    second = written(tmp_path / "snapshot")
    assert second != first
    snapshot(more=[F.lit(1).alias("y")])
    third = written(tmp_path / "snapshot")
    assert third != second and spark.read.parquet(path).columns == ["x", "y"]
    snapshot(more=[F.lit(1).alias("y")], force=True)
    assert written(tmp_path / "snapshot") != third


def test_snapshot_half_written_is_written_again(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    spark.range(3).write.parquet(path)  # committed by Spark, but without a manifest
    assert src.write_snapshot(spark.range(5), path).count() == 5
    assert src.write_snapshot(spark.range(9), path).count() == 5  # no input files: as it is
    # Cut off between the two renames of a replacement.
    (tmp_path / "snapshot").rename(tmp_path / ".snapshot.old")
    assert src.write_snapshot(spark.range(9), path).count() == 5


def test_snapshot_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    src.write_snapshot(spark.range(5), path)
    more = spark.read.parquet(path).select((F.col("id") + 1).alias("id"))
    assert sorted(r.id for r in src.write_snapshot(more, path, force=True).collect()) == [1, 2, 3, 4, 5]


def fail(c):
    return F.when(c > 2, F.raise_error(F.lit("broken on purpose"))).otherwise(c)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_report_is_replaced_whole_or_not(spark, tmp_path, fmt):
    path = str(tmp_path / "report")
    kind = "id long"
    src.write_report(spark.range(3), path, fmt)
    with pytest.raises(Exception, match="broken on purpose"):
        src.write_report(spark.range(5).select(fail(F.col("id")).alias("id")), path, fmt)

    def ids():
        return sorted(r.id for r in src.read_report(spark, path, kind, fmt).collect())

    assert ids() == [0, 1, 2]
    src.write_report(src.read_report(spark, path, kind, fmt).select((F.col("id") + 7).alias("id")), path, fmt)
    assert ids() == [7, 8, 9]
    assert [p.name for p in tmp_path.iterdir()] == ["report"]


def test_report_in_parts(spark, tmp_path):
    """All parts of a run, or none of them."""
    path = str(tmp_path / "report")
    with src.report_parts(spark, path) as add:
        for k in range(3):
            add(spark.range(k * 10, k * 10 + 2).withColumn("t", F.lit("a\nb")))
    rows = sorted(tuple(r) for r in src.read_report(spark, path, "id long, t string").collect())
    assert rows == [(i, "a\nb") for i in (0, 1, 10, 11, 20, 21)]
    with pytest.raises(RuntimeError, match="stopped"), src.report_parts(spark, path) as add:
        add(spark.range(1).withColumn("t", F.lit("x")))
        raise RuntimeError("stopped")
    assert src.read_report(spark, path, "id long, t string").count() == 6


def test_files_overview_counts_files_without_rows(spark, tmp_path):
    path = str(tmp_path / "some table")
    spark.range(100).repartition(3).write.parquet(path)
    spark.range(0).write.mode("append").parquet(path)
    files = list((tmp_path / "some table").glob("*.parquet"))
    row = src.files_overview(spark.read.parquet(path)).first().asDict()
    assert row == {"bytes": sum(f.stat().st_size for f in files), "files": 4, "rows": 100, "columns": 1}
