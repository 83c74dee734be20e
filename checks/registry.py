"""The registered queries."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as given
from gridlore import functions as fx
from gridlore import operators as op
from gridlore import plans, sources

Query = Callable[[SparkSession, str], DataFrame]


def _listed(df: DataFrame, key: Sequence[str], array: str, value: str) -> DataFrame:
    return df.select(*key, F.posexplode(array).alias("pos", value))


def _texts(spark, sf) -> DataFrame:
    return given.review_texts(spark, sf).where(F.col("text").isNotNull())


# --- sources -----------------------------------------------------------------

def scan_people_csv(spark, sf):
    path = sources.scratch_path(spark, "people")
    sources.write_quoted_csv(given.people(spark, sf), path)
    return sources.read_people(spark, path)


def scan_status_csv(spark, sf):
    path = sources.scratch_path(spark, "status")
    sources.write_quoted_csv(given.people_status(spark, sf), path)
    rows = sources.read_people(spark, path, sources.STATUS_SCHEMA)
    return rows.select("id", "x", "y", "status")


def scan_header_substring(spark, sf):
    path = sources.scratch_path(spark, "people")
    sources.write_quoted_csv(given.people(spark, sf), path)
    return sources.read_people(spark, path, header_substring="id")


def _reviews_csv(spark, sf):
    """The folder of a review CSV and its schema."""
    path = sources.scratch_path(spark, "reviews")
    raw = given.reviews(spark, sf).select(
        "Id",
        "Title",
        "Price",
        "User_id",
        F.col("score").alias("review/score"),
        F.col("text").alias("review/text"),
    )
    sources.write_quoted_csv(raw, path)
    return path, raw.schema


def scan_reviews_csv(spark, sf):
    return sources.read_reviews(spark, *_reviews_csv(spark, sf))


def scan_reviews_inferred(spark, sf):
    """The types are found by reading the files once more."""
    rows = sources.read_reviews(spark, _reviews_csv(spark, sf)[0])
    return rows.withColumn("Id", F.col("Id").cast("bigint"))


def scan_reviews_split(spark, sf):
    """Files with line breaks inside fields, read by blocks."""
    return sources.as_reviews(sources.read_split_csv(spark, *_reviews_csv(spark, sf)))


def scan_books_csv(spark, sf):
    path = sources.scratch_path(spark, "books")
    raw = given.books(spark, sf)
    sources.write_quoted_csv(raw, path)
    return sources.read_books(spark, path, raw.schema)


def parquet_roundtrip(spark, sf):
    path = sources.scratch_path(spark, "cleaned")
    return sources.write_parquet(clean_reviews(spark, sf), path)


def view_sql_preview(spark, sf):
    sources.register_views({"ratings": given.reviews(spark, sf)})
    rows = spark.sql("SELECT Id, Title, User_id, score FROM ratings")
    return sources.preview(rows, ["Id"], 20)


def sample_reviews(spark, sf):
    texts = given.reviews(spark, sf).where(F.col("text").isNotNull())
    return sources.sample_rows(texts.select("Id", "text"), 100, "Id")


def sample_orders(spark, sf):
    """A sample too large to gather."""
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return sources.sample_rows(orders, 5000, "o_orderkey")


# --- proximity ---------------------------------------------------------------

def distance_join(spark, sf):
    return op.distance_join(given.people(spark, sf), given.connected(spark, sf))


def distance_join_far(spark, sf):
    """So far out that doubles are 16 apart."""
    far = given.people_status(spark, sf).withColumn("x", F.col("x") + 1e17)
    return op.distance_join(far, far.where(F.col("status") == "yes"))


def _close_people(spark, sf):
    """All customers in a few cells."""
    key = F.col("id").cast("bigint")
    return given.people_status(spark, sf).withColumns(
        {"x": (key % 41) / 10.0, "y": (key % 307) / 50.0}
    )


def distance_join_dense(spark, sf):
    """Few other people, but so close together that finer cells are used."""
    near = _close_people(spark, sf)
    spread_out = near.withColumns({"x": F.col("x") * 16.0, "y": F.col("y") * 2.0})
    return op.distance_join(spread_out, spread_out.where(F.col("status") == "yes"), crowd=16)


def pair_count(spark, sf):
    return op.pair_count(given.people(spark, sf), given.connected(spark, sf))


def pair_count_crowded(spark, sf):
    """Pairs in a few cells, too many to list."""
    near = _close_people(spark, sf)
    return op.pair_count(near, near.where(F.col("status") == "yes"))


def near_ids(spark, sf):
    return op.near_ids(given.people(spark, sf), given.connected(spark, sf))


def near_people(spark, sf):
    return op.near_people(given.people(spark, sf), given.connected(spark, sf))


def neighbor_count(spark, sf):
    everyone = given.people_status(spark, sf)
    return op.neighbor_count(everyone.where(F.col("status") == "yes"), everyone)


def neighbor_count_crowded(spark, sf):
    """All customers in a few cells, with more places in one than are compared one by one."""
    everyone = _close_people(spark, sf)
    return op.neighbor_count(everyone.where(F.col("status") == "yes"), everyone)


# --- reviews -----------------------------------------------------------------

def clean_reviews(spark, sf):
    return op.clean_reviews(given.reviews(spark, sf)).drop("lang")


def score_stats(spark, sf):
    return op.score_stats(clean_reviews(spark, sf))


def user_stats(spark, sf):
    return op.user_stats(clean_reviews(spark, sf))


def explode_categories(spark, sf):
    return op.explode_categories(given.books(spark, sf))


def reviews_by_category(spark, sf):
    cleaned = clean_reviews(spark, sf).select("Id", "User_id", "Title", "score", "Price")
    return op.reviews_by_category(cleaned, explode_categories(spark, sf))


def _user_category_stats(spark, sf, min_reviews):
    stats = op.user_category_stats(
        clean_reviews(spark, sf), explode_categories(spark, sf), min_reviews
    )
    return stats.withColumn("avg_price", F.round("avg_price", 6))


def user_category_stats(spark, sf):
    return _user_category_stats(spark, sf, 2)


def user_category_stats_active(spark, sf):
    return _user_category_stats(spark, sf, 20)


# --- words -------------------------------------------------------------------

def tokenize(spark, sf):
    tokens = _texts(spark, sf).select("Id", fx.tokenize(F.col("text")).alias("tokens"))
    return _listed(tokens, ["Id"], "tokens", "value")


def normalize_tokens(spark, sf):
    words = fx.normalize_tokens(fx.tokenize(F.col("text")))
    return _listed(_texts(spark, sf).select("Id", words.alias("words")), ["Id"], "words", "value")


def remove_stopwords(spark, sf):
    words = fx.remove_stopwords(fx.clean_words(F.col("text")))
    return _listed(_texts(spark, sf).select("Id", words.alias("words")), ["Id"], "words", "value")


def remove_stopwords_named(spark, sf, limits=op.Limits()):
    """The list is a table: all words of the benchmark."""
    words = fx.clean_words(F.col("text"))
    listed = given.table(spark, sf, "benchmark").select(F.explode(words).alias("word"))
    left = op.drop_words(_texts(spark, sf), ["Id"], words, listed, limits=limits)
    return _listed(left, ["Id"], "words", "value")


def text_features(spark, sf):
    steps = [
        ("token", "text", fx.tokenize),
        ("normalized", "token", fx.normalize_tokens),
        ("cleanTokens", "normalized", fx.remove_stopwords),
    ]
    features = plans.text_features(_texts(spark, sf), steps)
    return features.select("Id", *[F.array_join(out, " ").alias(out) for out, _, _ in steps])


def mark_negation(spark, sf):
    words = fx.mark_negation(F.col("text"))
    marked = _texts(spark, sf).select("Id", F.explode(words).alias("word"))
    return marked.groupBy("Id", "word").agg(F.count("*").alias("n"))


def word_count(spark, sf):
    return op.word_count(_texts(spark, sf), fx.clean_words(F.col("text")))


def _dictionary(spark, sf) -> DataFrame:
    return op.build_lemma_dict(plans.review_vocabulary(given.review_texts(spark, sf)))


def build_lemma_dict(spark, sf):
    return _dictionary(spark, sf)


def lemmatize(spark, sf):
    dictionary = sources.materialize(_dictionary(spark, sf), "lemmas")
    words = fx.clean_words(F.col("text"))
    found = op.lemmatize(_texts(spark, sf), dictionary, ["Id"], words)
    return _listed(found, ["Id"], "result", "lemma")


def review_lemmas(spark, sf):
    dictionary = sources.materialize(_dictionary(spark, sf), "lemmas")
    found = plans.review_lemmas(given.review_texts(spark, sf), dictionary)
    return _listed(found, ["Id"], "result", "lemma")


def top_words(spark, sf):
    return plans.top_lemmas(given.review_texts(spark, sf))


# --- models ------------------------------------------------------------------

def _language_model(spark, sf):
    words = fx.clean_words(F.col("text"))
    return op.train_nb(given.documents(spark, sf), "lang", words)


def train_language(spark, sf):
    return _language_model(spark, sf).table()


def detect_language(spark, sf, model=None, limits=op.Limits()):
    words = fx.clean_words(F.col("text"))
    model = model or _language_model(spark, sf)
    return op.predict_nb(
        _texts(spark, sf), model, ["Id"], words, "language", scores=True, limits=limits
    )


def detect_language_large(spark, sf, model=None):
    """As if the model were too large for a broadcast."""
    return detect_language(spark, sf, model, op.Limits(max_rows=0))


def detect_language_saved(spark, sf):
    """With models that were saved and loaded again."""
    path = sources.scratch_path(spark, "language")
    _language_model(spark, sf).save(path)
    return detect_language(spark, sf, plans.load_model(spark, path))


def tag_tokens_saved(spark, sf):
    path = sources.scratch_path(spark, "tagger")
    _tagger(spark, sf).save(path)
    return tag_tokens(spark, sf, plans.load_model(spark, path))


def detect_turn_language(spark, sf):
    words = fx.clean_words(F.col("text"))
    turns = given.turns(spark, sf)
    model = _language_model(spark, sf)
    return op.predict_nb(turns, model, ["conv_id", "turn"], words, "language", scores=True)


def _sentiment_model(spark, sf):
    return plans.train_sentiment(given.labelled(spark, sf))


def train_sentiment(spark, sf):
    return _sentiment_model(spark, sf).table()


def predict_sentiment(spark, sf, model=None):
    model = model or _sentiment_model(spark, sf)
    return plans.predict_sentiment(given.review_texts(spark, sf), model)


def _tagger(spark, sf):
    return op.train_tagger(given.tagged(spark, sf))


def train_tagger(spark, sf):
    return _tagger(spark, sf).table()


def tag_tokens(spark, sf, model=None, limits=op.Limits()):
    turns = given.turns(spark, sf)
    words = fx.tokenize(F.col("text"))
    tags = op.tag_tokens(
        turns, model or _tagger(spark, sf), ["conv_id", "turn"], words, limits=limits
    )
    return _listed(tags, ["conv_id", "turn"], "pos_tags", "tag")


def tag_tokens_large(spark, sf, model=None):
    """As if the tagger were too large for a broadcast."""
    return tag_tokens(spark, sf, model, op.Limits(max_rows=0))


# --- reports -----------------------------------------------------------------

def _annotators(spark, sf):
    return _sentiment_model(spark, sf), _language_model(spark, sf), _tagger(spark, sf)


def annotate_reviews(spark, sf, model=None, limits=op.Limits()):
    models = model or _annotators(spark, sf)
    notes = plans.annotate_reviews(given.review_texts(spark, sf), *models, limits=limits)
    return notes.select("Id", "sentiment", "language", F.posexplode("pos").alias("pos", "tag"))


def annotate_reviews_large(spark, sf, model=None):
    """As if the models were too large for a broadcast."""
    return annotate_reviews(spark, sf, model, op.Limits(max_rows=0))


def remove_stopwords_named_large(spark, sf):
    """As if the list were too large for a broadcast."""
    return remove_stopwords_named(spark, sf, op.Limits(max_rows=0))


def pipeline_annotations(spark, sf):
    """Trained models as steps among others."""
    language, mood = _language_model(spark, sf), _sentiment_model(spark, sf)
    steps = [
        ("words", "text", fx.clean_words),
        lambda docs: op.predict_nb(docs, language, ["Id", "text"], F.col("words"), "language"),
        lambda docs: plans.predict_sentiment(docs, mood, ["Id", "language"]),
    ]
    return plans.text_features(_texts(spark, sf), steps)


def _staged(text, language):
    words = F.coalesce(fx.clean_words(text), F.array().cast("array<string>"))
    return F.concat(words, F.array(F.concat(F.lit("lang:"), language)))


def pipeline_fit_transform(spark, sf):
    """Fitted on the documents, saved, loaded and applied to the turns of conversations.

    The second model is trained on the language that the first one finds.
    """
    steps = [
        ("words", "text", fx.clean_words),
        plans.Fit(
            lambda docs: op.train_nb(docs, "lang", F.col("words")),
            lambda docs, model: op.predict_nb(
                docs, model, [x for x in docs.columns if x != "words"], F.col("words"), "language"
            ),
        ),
        lambda docs: docs.withColumn("staged", _staged(F.col("text"), F.col("language"))),
        plans.Fit(
            lambda docs: op.train_nb(docs, "label", F.col("staged")),
            lambda docs, model: op.predict_nb(
                docs, model, [x for x in docs.columns if x not in ("staged", "text")],
                F.col("staged"), "mood", scores=True,
            ),
        ),
    ]
    moods = given.labelled(spark, sf).select("doc_id", "label")
    docs = given.documents(spark, sf).select("doc_id", "text", "lang").join(moods, "doc_id", "left")
    path = sources.scratch_path(spark, "pipeline")
    plans.fit_pipeline(docs, steps).save(path)
    turns = given.turns(spark, sf).select("conv_id", "turn", "text")
    return plans.load_pipeline(spark, path, steps).transform(turns)


def title_sentiment(spark, sf, model=None):
    model = model or _sentiment_model(spark, sf)
    return plans.title_sentiment(given.review_texts(spark, sf), model)


def title_sentiment_counting_null(spark, sf):
    reviews = given.review_texts(spark, sf)
    return plans.title_sentiment(reviews, _sentiment_model(spark, sf), null_title="count")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_people_csv, scan_status_csv, scan_header_substring, scan_reviews_csv,
        scan_reviews_inferred, scan_reviews_split, sample_orders,
        scan_books_csv, parquet_roundtrip, view_sql_preview, sample_reviews,
        distance_join, distance_join_far, distance_join_dense, pair_count, pair_count_crowded,
        near_ids, near_people, neighbor_count, neighbor_count_crowded,
        clean_reviews, score_stats, user_stats, explode_categories,
        reviews_by_category, user_category_stats, user_category_stats_active,
        tokenize, normalize_tokens, remove_stopwords, remove_stopwords_named, remove_stopwords_named_large,
        text_features,
        mark_negation, word_count,
        build_lemma_dict, lemmatize, review_lemmas, top_words,
        train_language, detect_language, detect_language_large, detect_language_saved,
        detect_turn_language, train_sentiment, predict_sentiment, train_tagger, tag_tokens,
        tag_tokens_large, tag_tokens_saved,
        annotate_reviews, annotate_reviews_large, pipeline_annotations, pipeline_fit_transform, title_sentiment, title_sentiment_counting_null,
    )
}

# Queries that take a trained model, and what trains it.
TRAINERS = {
    "detect_language": _language_model,
    "detect_language_large": _language_model,
    "predict_sentiment": _sentiment_model,
    "tag_tokens": _tagger,
    "title_sentiment": _sentiment_model,
    "annotate_reviews": _annotators,
    "annotate_reviews_large": _annotators,
}
