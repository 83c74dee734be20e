import pytest
from pyspark.sql import functions as F

from gridlore import operators as op
from gridlore.operators.skew import Limits

REVIEW = "Id long, Title string, Price double, User_id string, score double, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, REVIEW)


def test_cleaning(spark):
    raw = spark.createDataFrame(
        [("4", "a"), ("4.0", "b"), ("abc", "c"), (None, "d"), ("3.99", "e"), ("5", None),
         ("5", ""), ("5", " ")],
        "score string, text string",
    )
    kept = op.clean_reviews(raw).collect()
    assert sorted(r.text for r in kept) == [" ", "a", "b"]
    assert op.clean_reviews(raw, min_score=3.0).count() == 4


def test_score_stats(spark):
    rows = [(1, "T", None, "u", 4.0, "ab"), (2, "T", None, "u", 4.0, "abcd"),
            (3, "T", None, "u", 5.0, "x")]
    stats = {r.score: r for r in op.score_stats(frame(spark, rows)).collect()}
    assert tuple(stats[4.0])[1:] == (2, 3.0, 2, 4)
    assert tuple(stats[5.0])[1:] == (1, 1.0, 1, 1)


def test_user_stats_keep_the_null_user(spark):
    rows = [(i, "T", None, user, 4.0, "ab") for i, user in enumerate([None] * 3 + ["u"] * 2)]
    stats = op.user_stats(frame(spark, rows)).collect()
    assert [tuple(r) for r in stats] == [(None, 3, 4.0, 2.0)]


@pytest.mark.parametrize("text, names", [
    ("['Fiction']", ["Fiction"]),
    ("['Juvenile Nonfiction, Animals', 'X']", ["Juvenile Nonfiction", "Animals", "X"]),
    ("[\"Children's stories\"]", ['"Childrens stories"']),
    ("", []), ("[]", []), ("null", []), (None, []),
    ("['A', '']", ["A"]), ("['A', 'null']", ["A"]),
])
def test_categories(spark, text, names):
    books = spark.createDataFrame([("T", text)], "Title string, categories string")
    assert [r.Category for r in op.explode_categories(books).collect()] == names


@pytest.mark.parametrize("limits", [Limits(), Limits(max_rows=0, parts=4, min_rows=2)])
def test_user_category_stats(spark, limits):
    reviews = frame(spark, [
        (1, "A", 2.0, "u", 4.0, "t"), (2, "A", None, "u", 5.0, "t"), (3, "B", None, "u", 4.0, "t"),
        (4, None, 9.0, "u", 4.0, "t"), (5, "A", 4.0, "v", 4.0, "t"), (6, "B", None, "w", 5.0, "t"),
    ])
    # A is listed twice with X, so its reviews count twice there.
    categories = spark.createDataFrame(
        [("A", "X"), ("A", "X"), ("A", "Y"), ("B", "Z"), ("B", "Z"), (None, "X")],
        "Title string, Category string",
    )
    stats = op.user_category_stats(reviews, categories, limits=limits).collect()
    assert {(r.User_id, r.Category): tuple(r)[2:] for r in stats} == {
        ("u", "X"): (4, 4.5, 2.0),
        ("u", "Y"): (2, 4.5, 2.0),
        ("u", "Z"): (2, 4.0, None),
        ("v", "X"): (2, 4.0, 4.0),
        ("w", "Z"): (2, 5.0, None),
    }
    joined = op.reviews_by_category(reviews, categories, limits=limits)
    direct = joined.groupBy("User_id", "Category").agg(
        F.count("*").alias("n"), F.avg("score").alias("s"), F.avg("Price").alias("p")
    ).where("n >= 2")
    assert sorted(map(str, direct.collect())) == sorted(
        map(str, op.user_category_stats(reviews, categories).toDF(*direct.columns).collect())
    )
