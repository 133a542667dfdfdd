import datetime as dt
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from seriesmill import session
from seriesmill.sources.artifacts import load_model, load_object, save_object
from seriesmill.sources.readers import get_loader, preview, read_csv


def write(tmp_path, text, name="a.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_types_follow_all_rows(spark, tmp_path):
    path = write(
        tmp_path,
        "id,amount,gaps,flag,gapflag,day,mixed,empty,big\n"
        "1,1.5,1,True,true,2020-01-02,1,,1e5\n"
        "2,NA,,False,,2020-01-03,x,,-inf\n"
        "3,nan,3,true,false,N/A,2.5,null,.5\n",
    )
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {
        "id": "bigint", "amount": "double", "gaps": "double", "flag": "boolean", "gapflag": "string",
        "day": "string", "mixed": "string", "empty": "double", "big": "double",
    }
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    assert rows[1] == (2, None, None, False, None, "2020-01-03", "x", None, float("-inf"))
    assert rows[2][1:3] == (None, 3.0)


def test_csv_with_schema_and_separator(spark, tmp_path):
    path = write(tmp_path, 'order_date;sales amount;note\n2021-01-31;7;"a;b"\nNA;NULL;n/a\n')
    df = read_csv(spark, path, ";", "order_date timestamp_ntz, `sales amount` double, note string")
    assert [tuple(r) for r in df.collect()] == [(dt.datetime(2021, 1, 31), 7.0, "a;b"), (None, None, None)]


def test_csv_bad_value_raises(spark, tmp_path):
    path = write(tmp_path, "a\nx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, path, schema="a int").collect()


def test_csv_whole_numbers_keep_their_digits(spark, tmp_path):
    path = write(tmp_path, "a,b,c,d\n1234567890123456789,1234567890123456787, 1,92233720368547758070\n1,, 2 ,1\n")
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "bigint", "c": "bigint", "d": "string"}
    assert [tuple(r) for r in df.orderBy("c").collect()] == [
        (1234567890123456789, 1234567890123456787, 1, "92233720368547758070"), (1, None, 2, "1"),
    ]


def test_csv_line_breaks_in_texts(spark, tmp_path):
    path = write(tmp_path, 'n,t\n1,"x\ny, ""z"""\n2,w\n')
    with pytest.raises(ValueError, match="multi_line"):
        read_csv(spark, path)
    assert sorted(tuple(r) for r in read_csv(spark, path, multi_line=True).collect()) == [(1, 'x\ny, "z"'), (2, "w")]


@pytest.mark.parametrize("range_bytes", [16, 41, 1000])
def test_csv_line_breaks_over_small_ranges(spark, tmp_path, range_bytes):
    """A range holds a piece of a cell, some lines, or whole files; cells go over several ranges."""
    rng = random.Random(range_bytes)
    pieces = ["a", ",", "\n", '"', "\n\n", "é", " ", "\r\n", "long text without a break "]
    want, folder = [], tmp_path / "many"
    folder.mkdir()
    for n, rows in enumerate([60, 1, 0, 25]):
        cells = [(f"{n}-{k}", "x" + "".join(rng.choices(pieces, k=rng.randint(0, 9))) + "y") for k in range(rows)]
        want += [(i, t.replace("\r\n", "\n")) for i, t in cells]
        lines = [f'{i},"{t.replace(chr(34), chr(34) * 2)}"' + rng.choice(["\n", "\r\n", "\n\n"]) for i, t in cells]
        # the header is a record of two lines, after a blank one
        (folder / f"{n}.csv").write_bytes(("\n" * (n % 2) + 'id,"no\nte"\n' + "".join(lines)).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    try:
        df = read_csv(spark, str(folder), multi_line=True)
        assert df.columns == ["id", "no\nte"]
        assert sorted(tuple(r) for r in df.collect()) == sorted(want)
        if range_bytes == 16:
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_one_quoted_text_over_many_ranges_and_fields_of_records(spark, tmp_path):
    text = "\n".join(f"line {k}" for k in range(200))
    path = write(tmp_path, f'a,b\n1,"{text}"\n2,short\n3\n', "wide.csv")
    surplus = write(tmp_path, 'a,b\n1,"x\ny",\n', "surplus.csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        rows = sorted(tuple(r) for r in read_csv(spark, path, schema="a int, b string", multi_line=True).collect())
        assert rows == [(1, text), (2, "short"), (3, None)]
        with pytest.raises(Exception, match="more fields"):
            read_csv(spark, surplus, schema="a int, b string", multi_line=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(tuple(r) for r in read_csv(spark, path, multi_line="file").collect()) == rows
    empty = write(tmp_path, "a,b\n", "empty.csv")
    assert read_csv(spark, empty, multi_line=True).collect() == []


def test_csv_surplus_fields_raise_and_missing_ones_are_missing(spark, tmp_path):
    short = write(tmp_path, "a,b\n1,2\n3\n", "short.csv")
    assert sorted(tuple(r) for r in read_csv(spark, short, schema="a int, b int").collect()) == [(1, 2), (3, None)]
    for name, text in (("full.csv", "a,b\n1,2\n3,4,5\n"), ("blank.csv", "a,b\n1,2\n3,4,\n")):
        path = write(tmp_path, text, name)
        with pytest.raises(Exception, match="more fields than the header"):
            read_csv(spark, path)
        with pytest.raises(Exception, match="more fields than the header"):
            read_csv(spark, path, schema="a int, b int").count()


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        get_loader(spark, {"type": "csv", "filepath": f"{tmp_path}/none.csv"}).load()


def test_loader_factory(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    spark.range(5).createOrReplaceTempView("five")
    assert get_loader(spark, {"type": "parquet", "filepath": f"{tmp_path}/t"}).load().count() == 3
    assert get_loader(spark, {"type": "table", "table_id": "five"}).load().count() == 5
    assert get_loader(spark, {"type": "bigquery", "project_id": None, "dataset_id": None, "table_id": "five"}).load().count() == 5
    assert get_loader(spark, {"type": "table"}).load("SELECT * FROM five WHERE id > 2").count() == 2
    assert get_loader(spark, {"type": "sql", "query": "SELECT 1 AS a"}).load().first()[0] == 1
    with pytest.raises(ValueError, match="table_id"):
        get_loader(spark, {"type": "table"}).load()
    with pytest.raises(ValueError, match="xml"):
        get_loader(spark, {"type": "xml"})


def test_preview_is_ordered(spark):
    assert [r[0] for r in preview(spark.range(100).select((99 - F.col("id")).alias("k")), ["k"], 3).collect()] == [0, 1, 2]


def test_table_and_model_round_trip(spark, tmp_path):
    df = spark.range(20).selectExpr("id", "cast(id * 2 + 1 AS double) AS y", "cast(id AS double) AS x")
    path = f"{tmp_path}/deep/er/table"
    save_object(path, df)
    save_object(path, df.where("id < 5"))
    assert load_object(spark, path).count() == 5
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="y")]).fit(df)
    save_object(f"{tmp_path}/m", model)
    got = load_model(f"{tmp_path}/m").transform(df).where("abs(prediction - y) < 1e-6").count()
    assert got == 20
    with pytest.raises(TypeError):
        save_object(f"{tmp_path}/x", {"a": 1})


def test_a_failed_save_leaves_the_old_artifact(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = spark.range(10, numPartitions=4)
    save_object(path, first)
    with pytest.raises(Exception, match="stop here"):
        save_object(path, first.selectExpr("if(id < 8, id, raise_error('stop here')) AS id"))
    assert load_object(spark, path).count() == 10
    (tmp_path / "t" / f"v9999999999-{'0' * 32}").mkdir()  # a version that was never finished has no mark
    assert load_object(spark, path).count() == 10


def test_versions_are_read_as_snapshots_and_retired(spark, tmp_path):
    path = f"{tmp_path}/t/"
    save_object(path, spark.range(1))
    snapshot = load_object(spark, path)
    save_object(path, load_object(spark, path).unionByName(spark.range(1)))  # from itself
    assert snapshot.count() == 1 and load_object(spark, path).count() == 2
    for n in range(3, 6):
        save_object(path, spark.range(n))
    assert load_object(spark, path).count() == 5
    assert sum(p.name.startswith("v") for p in (tmp_path / "t").iterdir()) == 2
    spark.range(7).write.parquet(f"{tmp_path}/plain")
    assert load_object(spark, f"{tmp_path}/plain").count() == 7


class Session:
    """Stands for a session with the given settings."""

    def __init__(self, master, **settings):
        self.conf = self
        self.sparkContext = self
        self.master, self.applicationId, self.settings = master, f"app-{id(self)}", settings

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def getConf(self):
        return self


def test_shared_dir_follows_the_session():
    assert session.shared_dir(Session("yarn", **{"spark.checkpoint.dir": "/shared/x/"})) == "/shared/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("yarn"))
    alone = Session("local[2]")
    assert session.shared_dir(alone) == session.shared_dir(alone)
