import pytest
from pyspark.sql import functions as F

from gridlore import operators as op
from gridlore import plans
from gridlore.functions import clean_words, tokenize

DOCS = [
    (1, "the cat sat", "en", "calm"), (2, "the dog ran", "en", "wild"), (3, "die Katze lag", "de", "calm"),
    (4, "der Hund lief", "de", "wild"), (5, None, "de", None), (6, "", None, "calm"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, text string, lang string, label string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def steps():
    return [
        ("words", "text", clean_words),
        plans.Fit(
            lambda docs: op.train_nb(docs, "lang", F.col("words")),
            lambda docs, model: op.predict_nb(docs, model, docs.columns, F.col("words"), "language"),
        ),
        lambda docs: docs.withColumn("both", F.array_append("words", F.col("language"))),
        plans.Fit(
            lambda docs: op.train_nb(docs.where("text <> ''"), "label", F.col("both")),
            lambda docs, model: op.predict_nb(docs, model, ["id", "language"], F.col("both"), "mood"),
        ),
        lambda docs: docs.withColumn("upper", F.upper("mood")),
    ]


def test_models_are_saved_and_loaded(spark, docs, tmp_path):
    words = clean_words(F.col("text"))
    model = op.train_nb(docs, "lang", words)
    model.save(f"{tmp_path}/nb")
    # Another session knows only the folder.
    other = spark.newSession()
    found = op.NaiveBayes.load(other, f"{tmp_path}/nb")
    assert (found.labels, found.priors) == (model.labels, model.priors)
    assert found.weights.sparkSession is not spark
    assert rows(found.table()) == rows(model.table())

    tagger = op.train_tagger(docs.select(F.explode(tokenize(F.col("text"))).alias("token"), F.col("lang").alias("tag")))
    tagger.save(f"{tmp_path}/tagger")
    assert rows(op.Tagger.load(other, f"{tmp_path}/tagger").table()) == rows(tagger.table())
    assert isinstance(plans.load_model(other, f"{tmp_path}/nb"), op.NaiveBayes)
    assert isinstance(plans.load_model(other, f"{tmp_path}/tagger"), op.Tagger)


def test_what_is_no_model_is_refused(spark, docs, tmp_path):
    model = op.train_nb(docs, "lang", clean_words(F.col("text")))
    model.save(f"{tmp_path}/nb")
    with pytest.raises(ValueError, match="kind"):
        op.Tagger.load(spark, f"{tmp_path}/nb")
    with pytest.raises(ValueError, match="no model"):
        plans.load_model(spark, f"{tmp_path}/nothing")
    # Without its facts, which come last, a model was not written to its end.
    model.weights.write.parquet(f"{tmp_path}/half/weights")
    with pytest.raises(ValueError, match="no model"):
        op.NaiveBayes.load(spark, f"{tmp_path}/half")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        model.save(f"{tmp_path}/nb")


def test_steps_are_fitted_on_what_comes_before(spark, docs, tmp_path):
    fitted = plans.fit_pipeline(docs, steps())
    assert [model.labels for model in fitted.models] == [("de", "en"), ("calm", "wild")]
    # The second model knows the first one's result as a word.
    assert {"de", "en"} <= {row.w for row in fitted.models[1].weights.collect()}
    new = spark.createDataFrame([(7, "the Hund ran"), (8, "Katze"), (9, None), (9, None)], "id long, text string")
    found = rows(fitted.transform(new))
    assert (8, "de", "calm", "CALM") in found and len(found) == 4
    fitted.save(f"{tmp_path}/pipeline")
    loaded = plans.load_pipeline(spark, f"{tmp_path}/pipeline", steps())
    assert rows(loaded.transform(new)) == found


def test_a_pipeline_without_fitted_steps(spark, docs):
    fitted = plans.fit_pipeline(docs, [("words", "text", clean_words)])
    assert fitted.models == ()
    assert fitted.transform(docs).columns == [*docs.columns, "words"]
