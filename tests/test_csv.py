"""CSV stacking against pandas on the FIXTURES.md section 4 files."""

import glob
import os
import tempfile
import uuid

import pandas as pd
import pytest
from pyspark.sql import types as Ty

from furlong.constants import race_input_schema
from furlong.sources import csv_stack as S

A_CSV = 'x,y\n1,NA\n1,\n" a b ","he said ""hi""\nnext line"\n4,n/a\n5,None\n6,""\n'


@pytest.fixture()
def tree():
    d = tempfile.mkdtemp(prefix="furlong-csv-")
    os.makedirs(os.path.join(d, "2020", "01"))
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write(A_CSV)
    with open(os.path.join(d, "2020", "01", "b.csv"), "w") as f:
        f.write("y,z\n7,8\n")
    with open(os.path.join(d, "2020", "n.txt"), "w") as f:
        f.write("not a csv\n")
    with open(os.path.join(d, "2020", "dup.csv"), "w") as f:
        f.write(A_CSV)
    return d


def pandas_stack(root):
    files = glob.glob(os.path.join(root, "**", "*.csv"), recursive=True)
    df = pd.concat([pd.read_csv(f, dtype="object") for f in files])
    return df.drop_duplicates()


def as_set(pdf, cols):
    return sorted((tuple(None if pd.isna(r[c]) else r[c] for c in cols) for _, r in pdf.iterrows()), key=repr)


def test_stack_matches_pandas(spark, tree):
    got = S.stack_csv(spark, tree).toPandas()
    want = pandas_stack(tree)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert as_set(got, cols) == as_set(want, cols)


def test_stack_without_dedup_keeps_copies(spark, tree):
    got = S.read_csv_stack(spark, tree)
    assert got.count() == 2 * 6 + 1


def test_headers_by_file(spark, tree):
    groups = S.header_groups(spark, tree)
    assert sorted(tuple(g[0]) for g in groups) == [("x", "y"), ("y", "z")]
    assert sum(len(g[1]) for g in groups) == 3


def test_single_header_reads_roots(spark):
    d = tempfile.mkdtemp(prefix="furlong-one-")
    os.makedirs(os.path.join(d, "x"))
    for name, body in [("a.csv", "k,v\n1,2\n"), ("x/b.csv", "k,v\n3,4\n1,2\n")]:
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    groups = S.header_groups(spark, d)
    assert groups == [(["k", "v"], None)]
    assert sorted(tuple(r) for r in S.stack_csv(spark, d).collect()) == [("1", "2"), ("3", "4")]


def test_no_files_raises(spark):
    with pytest.raises(S.NoCsvFilesError):
        S.stack_csv(spark, tempfile.mkdtemp(prefix="furlong-empty-"))


def test_ids_from_urls(spark):
    d = tempfile.mkdtemp(prefix="furlong-url-")
    with open(os.path.join(d, "r.csv"), "w") as f:
        f.write("race_url,v\nhttps://h.example/race/202004040406/,1\nhttps://h.example/race/x,2\n")
    got = {r.v: r.race_id for r in S.stack_csv(spark, d, url_col="race_url", id_col="race_id").collect()}
    assert got == {"1": "202004040406", "2": None}


def test_csv_sink_bytes_equal_pandas(spark):
    rows = [("a", " spaced ", None), ("b", 'say "x"', "multi\nline"), ("c", "1,2", "")]
    sdf = spark.createDataFrame(rows, "k string, v string, w string").coalesce(1)
    out = tempfile.mkdtemp(prefix="furlong-out-")
    S.write_csv(sdf, os.path.join(out, "s"))
    part = glob.glob(os.path.join(out, "s", "part-*.csv"))[0]
    pdf = pd.DataFrame(rows, columns=["k", "v", "w"])
    assert open(part, encoding="utf-8").read() == pdf.to_csv(index=False)


def test_roundtrip_and_typed_load(spark, tree):
    out = os.path.join(tempfile.mkdtemp(prefix="furlong-rt-"), "stacked")
    stacked = S.stack_csv(spark, tree)
    S.write_csv(stacked, out)
    back = S.read_csv_stack(spark, out)
    cols = sorted(stacked.columns)
    assert as_set(back.toPandas(), cols) == as_set(stacked.toPandas(), cols)
    typed = S.read_typed(spark, out, Ty.StructType([Ty.StructField("y", Ty.StringType()),
                                                    Ty.StructField("z", Ty.LongType()),
                                                    Ty.StructField("q", Ty.StringType())]))
    assert typed.columns == ["y", "z", "q"]
    assert sorted(r.z for r in typed.collect() if r.z is not None) == [8]


def test_typed_load_rejects_bad_numbers(spark):
    d = tempfile.mkdtemp(prefix="furlong-bad-")
    with open(os.path.join(d, "r.csv"), "w") as f:
        f.write("race_url,horse_ids\nu,notanumber\n")
    # FAILFAST surfaces as a read failure (a JVM error, not always a PySparkException)
    with pytest.raises(Exception, match="r.csv"):
        S.read_typed(spark, d, race_input_schema()).collect()


@pytest.mark.parametrize("body", ["\nx,y\n1,2\n", "x,x,x\n1,2,3\n", ",y,\n1,2,3\n", "\n\n,x,x\n4,5,6\n"])
def test_header_rules_equal_pandas(spark, tmp_path, body):
    (tmp_path / "h.csv").write_text(body)
    want = pd.read_csv(tmp_path / "h.csv", dtype="object")
    got = S.read_csv_stack(spark, str(tmp_path))
    assert got.columns == list(want.columns)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.itertuples(index=False)]


def test_replacing_a_table_twice(spark):
    name = "furlong_replaced_table"
    for rows in ([(1, "a")], [(2, "b"), (3, "c")]):
        S.write_table(spark.createDataFrame(rows, "k long, v string"), table=name)
        assert sorted(tuple(r) for r in spark.table(name).collect()) == rows
    spark.sql(f"drop table {name}")


def test_short_rows_are_filled_up_like_pandas(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y,z\n1\n1,2\n1,2,3\n"q\nr",5\n')
    (tmp_path / "b.csv").write_text("z,x\n7\n")
    got = S.stack_csv(spark, str(tmp_path)).toPandas()
    want = pandas_stack(str(tmp_path))
    assert as_set(got, list("xyz")) == as_set(want, list("xyz")) and len(got) == 5


def test_long_rows_are_an_error_that_names_the_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n1,2,3,4\n")
    with pytest.raises(Exception, match="more fields than its header.*a.csv"):
        S.read_csv_stack(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="more fields"):
        S.read_csv_stack(spark, str(tmp_path)).select("x").collect()


@pytest.mark.parametrize("body", ['x,"y\nz"\n1,2\n', '\n"a ""b""\n\nc",d\n1,2\n3,"4\n5"\n'])
def test_headers_with_line_breaks_equal_pandas(spark, tmp_path, body):
    (tmp_path / "h b.csv").write_text(body)
    (tmp_path / "plain.csv").write_text("d\n9\n")
    got = S.stack_csv(spark, str(tmp_path)).toPandas()
    want = pandas_stack(str(tmp_path))
    assert sorted(got.columns) == sorted(want.columns)
    assert as_set(got, sorted(want.columns)) == as_set(want, sorted(want.columns))


def test_a_given_header_saves_the_header_pass_and_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,NA\n")
    (tmp_path / "b.csv").write_text("x,y\n3,4\n")
    rows = S.read_csv_stack(spark, str(tmp_path), header=["x", "y"])
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == [("1", None), ("3", "4")]
    (tmp_path / "c.csv").write_text("y,x\n5,6\n")
    with pytest.raises(Exception):
        S.read_csv_stack(spark, str(tmp_path), header=["x", "y"]).collect()


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1,), (2,)], "k long")
    bad = good.selectExpr("k", "cast(assert_true(k < 2) as int) as v")
    name = f"furlong_kept_{uuid.uuid4().hex[:8]}"
    for target in ({"path": path}, {"table": name}):
        S.write_table(good, **target)
        with pytest.raises(Exception):
            S.write_table(bad, **target)
        read = (lambda: spark.read.parquet(path)) if "path" in target else (lambda: spark.table(name))
        assert sorted(r["k"] for r in read().collect()) == [1, 2]
        S.write_table(read().selectExpr("k + 1 as k"), **target)  # reads the table that it replaces
        assert sorted(r["k"] for r in read().collect()) == [2, 3]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    spark.sql(f"drop table {name}")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]


def test_typed_load_scans_once(spark, tmp_path):
    out = str(tmp_path / "s")
    S.write_csv(spark.createDataFrame([("u", 1)], "race_url string, horse_ids long"), out)
    plan = S.read_typed(spark, out, race_input_schema())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
