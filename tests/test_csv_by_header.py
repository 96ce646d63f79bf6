"""CSV by header and in file order, against pandas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.sources import batches as SB
from claimlens.sources import csvfiles as C

SCHEMA = T.StructType([T.StructField("OBJECT_ID", T.LongType()), T.StructField("MAKE", T.StringType()), T.StructField("PREMIUM", T.DoubleType())])


@pytest.fixture
def small_splits(spark):
    """A file of a few kilobytes is many splits."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def same(got, want):
    got = got.orderBy("row_index").toPandas()
    assert got.row_index.tolist() == list(range(len(want)))
    assert set(want.columns) <= set(got.columns)
    for c in want.columns:
        a, b = got[c].astype(object).where(got[c].notna(), None).tolist(), want[c].astype(object).where(want[c].notna(), None).tolist()
        assert a == b, c


def test_columns_go_by_name(spark, tmp_path):
    """Reordered, additional and absent columns, doubled quotes, backslashes, commas and line ends in quotes."""
    (tmp_path / "a.csv").write_text('PREMIUM,OBJECT_ID,MAKE\n7,1,FORD\n,2,"say ""hi"", ok"\n8.5,3,back\\slash\n9,4,"back\\"\n')
    (tmp_path / "b.csv").write_bytes("﻿OBJECT_ID,X,MAKE,FLAG,X\n5,1,\"two\nlines\",True,u\n\n6,2,\"a\r\nb\",False,\n7,3,NA,True,\"\"\"v\"\"\"\n".encode())
    (tmp_path / "c.csv").write_text("MAKE,OBJECT_ID\n")
    paths = [str(tmp_path / n) for n in ("b.csv", "a.csv", "c.csv")]
    got = SB.read_ordered(spark, paths, SCHEMA)
    assert got.columns == ["OBJECT_ID", "MAKE", "PREMIUM", "X", "FLAG", "X.1", "row_index"]
    assert [t for _, t in got.dtypes] == ["bigint", "string", "double", "double", "string", "string", "bigint"]
    want = pd.concat([pd.read_csv(p) for p in paths], ignore_index=True)
    same(got.drop("FLAG"), want.drop(columns="FLAG"))
    assert [r.FLAG for r in got.orderBy("row_index").collect()] == ["True", "False", "True", None, None, None, None]
    one = SB.read_policies(spark, paths[0], None)
    assert dict(one.dtypes) == {"OBJECT_ID": "bigint", "X": "bigint", "MAKE": "string", "FLAG": "boolean", "X.1": "string"}


def test_positions_over_split_files(spark, small_splits, tmp_path):
    """Pandas' order over files of many splits, one of them with records of two lines, without a sort or a shuffle of rows."""
    (tmp_path / "z.csv").write_text("OBJECT_ID,MAKE\n" + "".join(f"{i},make {i}\n" for i in range(700)))
    (tmp_path / "m.csv").write_text("MAKE,OBJECT_ID\n" + "".join(f'"make\n{i}",{i}\n' for i in range(300)))
    (tmp_path / "a.csv").write_text("PREMIUM,OBJECT_ID\n" + "".join(f"{i / 4},{i}\n" + "\n" * (i % 3) for i in range(900)))
    paths = [str(tmp_path / n) for n in ("z.csv", "m.csv", "a.csv", "z.csv")]     # one of them twice
    got = SB.read_ordered(spark, paths, SCHEMA)
    assert spark.read.text(paths[0]).rdd.getNumPartitions() > 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    same(got, pd.concat([pd.read_csv(p) for p in paths], ignore_index=True))
    folder = SB.read_ordered(spark, [str(tmp_path)], SCHEMA)
    same(folder, pd.concat([pd.read_csv(p) for p in sorted(paths[:3])], ignore_index=True))
    batches = SB.assign_batches(got, 500).groupBy("batch_id").agg(F.count("*").alias("n"), F.min("row_index").alias("lo"))
    assert sorted((r.batch_id, r.n, r.lo) for r in batches.collect()) == [(k, 500 if k < 5 else 100, 500 * k) for k in range(6)]


def test_odd_files(spark, tmp_path):
    """Empty files, short and long records, a quote inside a value, many headers, names with blanks."""
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text("OBJECT_ID,MAKE")
    (tmp_path / "s.csv").write_text('OBJECT_ID,MAKE,my col\n1\n2,a,b,c,d\n3,5" pipe,x\n4, b ," c "\n')
    got = SB.read_ordered(spark, [str(tmp_path / n) for n in ("e.csv", "h.csv", "s.csv")], SCHEMA).orderBy("row_index").collect()
    assert [(r.row_index, r.OBJECT_ID, r.MAKE, r["my col"]) for r in got] == [(0, 1, None, None), (1, 2, "a", "b"), (2, 3, '5" pipe', "x"), (3, 4, " b ", " c ")]
    for k in range(12):
        names = ["OBJECT_ID", "MAKE", f"own{k}"]
        order = names[k % 3:] + names[:k % 3]
        (tmp_path / f"k{k:02}.csv").write_text(",".join(order) + "\n" + ",".join({"OBJECT_ID": str(k), "MAKE": f"m{k}"}.get(n, "1") for n in order) + "\n")
    many = SB.read_ordered(spark, [str(tmp_path / f"k{k:02}.csv") for k in range(12)], SCHEMA).orderBy("row_index").collect()
    assert [(r.row_index, r.OBJECT_ID, r.MAKE) for r in many] == [(k, k, f"m{k}") for k in range(12)]
    assert all(sum(r[f"own{k}"] is not None for r in many) == 1 for k in range(12))
    only = SB.read_ordered(spark, [str(tmp_path / "e.csv")], SCHEMA)
    assert only.count() == 0 and only.columns == ["OBJECT_ID", "MAKE", "PREMIUM", "row_index"]


def test_header_names():
    assert C.header_names('﻿a,"b,c",a,,a') == ["a", "b,c", "a.1", "Unnamed: 3", "a.2"]
