import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore import sources


def write(path, text):
    path.write_text(text)
    return str(path)


PEOPLE = "id,x,y,name,age,mail\n1,1.5,-2,David,30,a@b\n2,3,4,Eve,41.5,c@d\n"


def test_people_with_header(spark, tmp_path):
    rows = sources.read_people(spark, write(tmp_path / "p.csv", PEOPLE)).collect()
    assert sorted(map(tuple, rows)) == [
        ("1", 1.5, -2.0, "David", 30.0, "a@b"),
        ("2", 3.0, 4.0, "Eve", 41.5, "c@d"),
    ]


def test_header_substring_drops_every_line_that_has_it(spark, tmp_path):
    path = write(tmp_path / "p.csv", PEOPLE)
    rows = sources.read_people(spark, path, header_substring="id").collect()
    assert [row.id for row in rows] == ["2"]


def test_status_is_the_seventh_column(spark, tmp_path):
    path = write(tmp_path / "s.csv", "id,x,y,a,b,c,shake\n1,1,2,n,3,m,yes\n")
    row = sources.read_people(spark, path, sources.STATUS_SCHEMA).first()
    assert (row.id, row.status) == ("1", "yes")


@pytest.mark.parametrize(
    "line", ["1,one,2,n,3,m", "1,1.0,2", "1,,2,n,3,m", "1,2.0,2,n,3,m,extra"]
)
def test_bad_people_fail(spark, tmp_path, line):
    path = write(tmp_path / "p.csv", f"id,x,y,a,b,c\n{line}\n")
    with pytest.raises(Exception):
        sources.read_people(spark, path).collect()


def test_empty_id_and_quotes_are_kept(spark, tmp_path):
    path = write(tmp_path / "p.csv", 'id,x,y,a,b,c\n,1,2,"n,3,m"\n')
    row = sources.read_people(spark, path).first()
    assert (row.id, row.f3, row.f5) == ("", '"n', 'm"')


RAW = T.StructType([
    T.StructField("Id", T.StringType()),
    T.StructField("Title", T.StringType()),
    T.StructField("Price", T.StringType()),
    T.StructField("User_id", T.StringType()),
    T.StructField("review/score", T.StringType()),
    T.StructField("review/text", T.StringType()),
])


def test_quoted_csv_round_trip(spark, tmp_path):
    texts = ["two\nlines", 'a "quoted" word', "a, b", "  blanks  ", "back\\slash\\", '\\"', None]
    raw = spark.createDataFrame(
        [(str(i), "T", "1.5", "u", "4.0", text) for i, text in enumerate(texts)], RAW
    )
    path = str(tmp_path / "reviews")
    sources.write_quoted_csv(raw, path)
    back = sources.read_reviews(spark, path, RAW)
    assert [r.text for r in back.orderBy("Id").collect()] == texts
    inferred = sources.read_reviews(spark, path)
    assert inferred.schema["score"].dataType == T.DoubleType()
    assert [r.text for r in inferred.orderBy("Id").collect()] == texts


def test_scores_that_are_no_numbers_are_null(spark):
    raw = spark.createDataFrame(
        [("1", "T", "free", "u", "abc", "t"), ("2", "T", "2", "u", "4", "t")], RAW
    )
    rows = sources.as_reviews(raw).orderBy("Id").collect()
    assert [(r.score, r.Price) for r in rows] == [(None, None), (4.0, 2.0)]


def test_parquet_keeps_names_with_a_slash(spark, tmp_path):
    raw = spark.createDataFrame([("1", "T", "2", "u", "4", "t")], RAW)
    path = str(tmp_path / "t1")
    back = sources.write_parquet(raw, path)
    again = sources.write_parquet(raw, path)
    assert back.columns == RAW.names
    assert again.count() == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path, plan):
    raw = spark.createDataFrame([("1", "T", "2", "u", "4", "t")], RAW)
    table = sources.write_parquet(raw, str(tmp_path / "t1"))
    text = plan(table.where(F.col("Title") == "T").select("Title", "Id"))
    assert "EqualTo(Title,T)" in text
    assert "ReadSchema: struct<Id:string,Title:string>" in text


def test_views_preview_and_count(spark):
    sources.register_views({"ratings": spark.range(30)})
    rows = spark.sql("SELECT id FROM ratings")
    assert [r.id for r in sources.preview(rows, ["id"], 3).collect()] == [0, 1, 2]
    assert [r.id for r in sources.sample_rows(rows, 2, "id").collect()] == [0, 1]
    assert sources.row_count(rows).first().n == 30


def test_spread(spark):
    one = spark.range(100).coalesce(1)
    assert sources.spread(one, "id").rdd.getNumPartitions() == 8
    many = spark.range(0, 100, 1, 20)
    assert sources.spread(many, "id") is many


def test_one_file_that_splits_is_not_spread(spark, tmp_path):
    spark.range(200_000).coalesce(1).write.parquet(f"{tmp_path}/one")
    table = spark.read.parquet(f"{tmp_path}/one")
    assert sources.spread(table, "id") is not table
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        table = spark.read.parquet(f"{tmp_path}/one")
        assert sources.spread(table, "id") is table
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scratch_is_in_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert sources.scratch_path(spark, "x").startswith(folder)


def test_written_tables_are_deleted(spark):
    from pathlib import Path

    from gridlore import sources

    def folder(table):
        return Path(table.inputFiles()[0].removeprefix("file://")).parent

    with sources.written_tables(spark):
        inner = folder(sources.materialize(spark.range(5)))
        assert inner.exists()
    assert not inner.exists()

    left = []

    def make():
        left.append(folder(sources.materialize(spark.range(5))))
        return spark.read.parquet(str(left[0])).where("id > 2")

    result = sources.settled(spark, make, "result")
    assert result.count() == 2 and not left[0].exists() and folder(result).exists()


def test_spread_reads_nothing(spark, tmp_path):
    from gridlore import sources

    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    spread = sources.spread(one, "id")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert spread.count() == 100
    made = spark.range(10)
    assert sources.spread(made) is made


def _samples(spark, rows, n, monkeypatch):
    from gridlore.sources import views

    monkeypatch.setattr(views, "_FEW", 3)
    monkeypatch.setattr(views, "_PARTS", 4)
    df = spark.createDataFrame(rows, "k double, v string").repartition(5)
    return [tuple(r) for r in sources.sample_rows(df, n, "k").collect()], df


@pytest.mark.parametrize("n", [0, 1, 3, 5, 17, 60, 150, 300, 1000])
def test_samples_are_the_smallest_keys(spark, monkeypatch, n):
    rows = [(float((i * 37) % 101), str(i)) for i in range(300)]
    rows += [(None, str(i)) for i in range(5)] + [(float("nan"), "x")] * 4
    found, _ = _samples(spark, rows, n, monkeypatch)
    order = lambda k: (k is not None, k != k, 0 if k is None or k != k else k)
    wanted = sorted((r[0] for r in rows), key=order)[:n]
    assert list(map(str, sorted((r[0] for r in found), key=order))) == list(map(str, wanted))
    assert len(set(found) - {r for r in found if r[1] == "x"}) == len([r for r in found if r[1] != "x"])


def test_samples_of_equal_keys_do_not_depend_on_partitions(spark, monkeypatch):
    rows = [(1.0, str(i % 40)) for i in range(200)] + [(0.0, "first")]
    found, df = _samples(spark, rows, 47, monkeypatch)
    again = [tuple(r) for r in sources.sample_rows(df.coalesce(1), 47, "k").collect()]
    assert sorted(found) == sorted(again) and len(found) == 47 and (0.0, "first") in found
    copies, _ = _samples(spark, [(1.0, "same")] * 90, 33, monkeypatch)
    assert copies == [(1.0, "same")] * 33


def test_a_large_sample_goes_through_no_single_task(spark, plan, tmp_path):
    spark.range(0, 50_000, 1, 8).selectExpr("id % 9973 AS k", "id").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    sample = sources.sample_rows(table, 20_000, "k")
    text = plan(sample)
    assert "Exchange" not in text and "TakeOrdered" not in text and "LessThan" in text
    assert sample.count() == 20_000
    assert sample.agg(F.max("k")).first()[0] == table.orderBy("k").limit(20_000).agg(F.max("k")).first()[0]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_put_together_from_blocks(spark, tmp_path, end):
    texts = [
        "plain", "two\nlines", 'a "quoted" word', "a, b", "\n\n\n", "x\n" * 40, '"', '""\n"', "",
        "  blanks  ", "long " * 60, 'quote "\nat the end of a line', "é\nü", "last\n",
    ]
    for part in range(3):
        lines = ["Id,Title,Price,User_id,review/score,review/text"]
        for i in range(120):
            text = texts[(i * 5 + part) % len(texts)].replace('"', '""')
            lines.append(f'{part}-{i},"T, {i % 7}",1.5,u,4.0,"{text}"')
        (tmp_path / f"{part}.csv").write_bytes(end.join([*lines, ""][: 122 - part % 2]).encode())
    (tmp_path / "empty.csv").write_text("Id,Title,Price,User_id,review/score,review/text\n")
    whole = sources.read_quoted_csv(spark, str(tmp_path), RAW)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        assert spark.read.text(f"{tmp_path}/0.csv").rdd.getNumPartitions() > 20
        parts = sources.read_split_csv(spark, str(tmp_path), RAW)
        found = sorted(map(str, parts.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == sorted(map(str, whole.collect())) and len(found) == 360


def test_records_of_a_file_without_rows(spark, tmp_path):
    path = write(tmp_path / "p.csv", "Id,text\n")
    assert sources.read_split_csv(spark, path, "Id string, text string").collect() == []
