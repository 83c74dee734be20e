"""The registered queries as SQL for DuckDB.

The proximity queries compare every two points instead of using a grid, and
negation is worked out with window functions, so that the SQL takes another
way than the library.
"""
from __future__ import annotations

import re

from gridlore.functions import ENGLISH_STOP_WORDS, NEGATORS


def _values(words) -> str:
    return ", ".join("('" + word.replace("'", "''") + "')" for word in words)


VIEWS = {
    "people_status": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               c_acctbal / CAST(20 AS DOUBLE) - 200 AS x,
               CAST((c_custkey * 7919) % 400 - 200 AS DOUBLE) AS y,
               CASE WHEN c_custkey % 10 = 0 THEN 'David' ELSE c_name END AS f3,
               CAST(c_nationkey AS DOUBLE) AS f4,
               c_mktsegment AS f5,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'yes' ELSE 'no' END AS status
        FROM customer""",
    "people": "SELECT id, x, y, f3, f4, f5 FROM people_status",
    "connected": "SELECT id AS cid, x AS cx, y AS cy FROM people_status WHERE status = 'yes'",
    "pairs": """
        SELECT id, cid FROM people JOIN connected
        ON id <> cid AND sqrt(pow(x - cx, 2) + pow(y - cy, 2)) <= 6.0""",
    "close_people": """
        SELECT id, CAST(id AS BIGINT) % 41 / CAST(10 AS DOUBLE) AS x,
               CAST(id AS BIGINT) % 307 / CAST(50 AS DOUBLE) AS y, status
        FROM people_status""",
    "far_people": "SELECT id, x + 1e17 AS x, y, status FROM people_status",
    "reviews": """
        SELECT doc_id AS "Id",
               CASE WHEN doc_id % 50 <> 7 THEN source END AS "Title",
               CASE WHEN doc_id % 3 <> 0
                    THEN CAST(n_chars % 5000 AS DOUBLE) / CAST(100 AS DOUBLE) END AS "Price",
               CASE WHEN doc_id % 40 <> 3
                    THEN 'u' || CAST((doc_id * 7919) % 400 AS VARCHAR) END AS "User_id",
               CAST(doc_id % 5 + 1 AS DOUBLE) AS score,
               CASE WHEN doc_id % 97 = 5 THEN '' WHEN doc_id % 97 <> 6 THEN text END AS text
        FROM documents""",
    "books": """
        SELECT DISTINCT source AS "Title",
               CASE WHEN doc_id % 200 = 1 THEN '[]'
                    WHEN doc_id % 200 <> 0
                    THEN '[''' || lang || ''', ''O''Cat ' || CAST(doc_id % 4 AS VARCHAR) || ''']'
               END AS categories
        FROM documents""",
    "cleaned": """
        SELECT * FROM reviews WHERE score >= 4 AND text IS NOT NULL AND length(text) > 0""",
    "categories": r"""
        SELECT "Title", "Category" FROM (
            SELECT "Title", unnest(string_split(
                regexp_replace(categories, '[\[\]'']', '', 'g'), ', ')) AS "Category"
            FROM books)
        WHERE "Category" <> '' AND "Category" <> 'null'""",
    "texts": """SELECT * FROM reviews WHERE text IS NOT NULL""",
    "stops": f"SELECT * FROM (VALUES {_values(ENGLISH_STOP_WORDS)}) AS v(word)",
    "negators": f"SELECT * FROM (VALUES {_values(NEGATORS)}) AS v(word)",
}


def _pieces(name: str, source: str, key: str, column: str, value: str) -> dict[str, str]:
    """``name``: the non-empty values of the pieces of a text, numbered from 0."""
    return {
        f"{name}_lists": rf"""
            SELECT {key}, string_split_regex(text, '\s+') AS pieces
            FROM {source} WHERE text IS NOT NULL""",
        f"{name}_pieces": f"""
            SELECT {key}, unnest(pieces) AS piece, unnest(range(len(pieces))) AS place
            FROM {name}_lists""",
        name: f"""
            SELECT {key}, {column},
                   CAST(row_number() OVER (PARTITION BY {key} ORDER BY place) - 1
                        AS INTEGER) AS pos
            FROM (SELECT {key}, place, {value} AS {column} FROM {name}_pieces)
            WHERE {column} <> ''""",
    }


def _raw(name: str, source: str, key: str) -> dict[str, str]:
    """The tokens of a table as written."""
    return _pieces(name, source, key, "token", "piece")


def _words(name: str, source: str, key: str) -> dict[str, str]:
    """The normalized words of a table."""
    clean = r"lower(regexp_replace(piece, '[^\pL+]', '', 'g'))"
    return _pieces(name, source, key, "word", clean)


def _marked(name: str, source: str, key: str) -> dict[str, str]:
    """``name``: the words of a table with ``not_`` before the negated ones."""
    raw = _raw(f"{name}_raw", source, key)
    return raw | {
        f"{name}_parts": rf"""
            SELECT {key}, pos, lower(regexp_replace(token, '[^\pL+]', '', 'g')) AS word,
                   coalesce(sum(CASE WHEN regexp_matches(token, '[.,;:!?]$') THEN 1 ELSE 0 END)
                       OVER (PARTITION BY {key} ORDER BY pos
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part
            FROM {name}_raw""",
        f"{name}_turns": f"""
            SELECT p.*, n.word IS NOT NULL AS negator,
                   sum(CASE WHEN n.word IS NOT NULL THEN 1 ELSE 0 END)
                       OVER (PARTITION BY {key}, part ORDER BY pos) AS turns
            FROM {name}_parts p LEFT JOIN negators n ON p.word = n.word""",
        name: f"""
            SELECT {key}, word AS plain,
                   CASE WHEN NOT negator AND turns % 2 = 1 THEN 'not_' || word ELSE word END AS word
            FROM {name}_turns WHERE word <> ''""",
        f"{name}_features": f"""
            SELECT DISTINCT {key}, word FROM {name}
            WHERE plain NOT IN (SELECT word FROM stops)""",
    }


def _bayes(name: str, features: str, priors: str) -> dict[str, str]:
    """``name_weights`` from ``features(label, w)`` and ``priors(label, texts)``."""
    return {
        f"{name}_counts": f"SELECT label, w, count(*) AS n FROM ({features}) GROUP BY label, w",
        f"{name}_priors": f"""
            SELECT label, CAST(round(ln(texts / sum(texts) OVER ()) * 1000000) AS BIGINT) AS prior
            FROM ({priors})""",
        f"{name}_weights": f"""
            SELECT v.w, t.label, CAST(round(ln((coalesce(c.n, 0) + 1) / (t.total + s.size))
                                            * 1000000) AS BIGINT) AS weight
            FROM (SELECT DISTINCT w FROM {name}_counts) v
            CROSS JOIN (SELECT p.label, coalesce(sum(n), 0) AS total
                        FROM {name}_priors p LEFT JOIN {name}_counts c ON p.label = c.label
                        GROUP BY p.label) t
            CROSS JOIN (SELECT count(DISTINCT w) AS size FROM {name}_counts) s
            LEFT JOIN {name}_counts c ON c.w = v.w AND c.label = t.label""",
    }


def _predict(name: str, model: str, texts: str, features: str, key: str) -> dict[str, str]:
    """``name(key, label, score)`` of ``texts(key)`` by their ``features(key, w)``."""
    keys = [part.strip() for part in key.split(",")]
    same = " AND ".join(f"s.{k} = d.{k}" for k in keys)
    listed = ", ".join(f"d.{k}" for k in keys)
    sums = ", ".join(f"f.{k}" for k in keys)
    return {
        f"{name}_sums": f"""
            SELECT {sums}, m.label, sum(m.weight) AS total
            FROM ({features}) f JOIN {model}_weights m ON f.w = m.w
            GROUP BY {sums}, m.label""",
        f"{name}_ranked": f"""
            SELECT {listed}, p.label, CAST(p.prior + coalesce(s.total, 0) AS BIGINT) AS score,
                   row_number() OVER (PARTITION BY {listed}
                       ORDER BY p.prior + coalesce(s.total, 0) DESC, p.label) AS place
            FROM ({texts}) d CROSS JOIN {model}_priors p
            LEFT JOIN {name}_sums s ON {same} AND s.label = p.label""",
        name: f"SELECT {key}, label, score FROM {name}_ranked WHERE place = 1",
    }


VIEWS |= _raw("tokens", "reviews", '"Id"')
VIEWS |= _words("words", "reviews", '"Id"')
VIEWS |= _raw("turn_tokens", "conversations", "conv_id, turn")
VIEWS |= _words("turn_words", "conversations", "conv_id, turn")
VIEWS |= _raw("doc_tokens", "documents", "doc_id, lang")
VIEWS |= _words("doc_words", "documents", "doc_id, lang")
VIEWS |= _words("item_words", "benchmark", "item_id")
VIEWS |= _marked("marked", "reviews", '"Id"')
VIEWS |= _marked("trained", "labelled", "doc_id, label")
VIEWS |= {
    "labelled": """
        SELECT doc_id, text, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS label
        FROM documents JOIN labels USING (doc_id)""",
    "vocabulary": "SELECT DISTINCT word FROM words",
    "stems": " UNION ALL ".join(
        f"SELECT word AS form, left(word, length(word) - {len(ending)}) AS lemma "
        f"FROM vocabulary WHERE ends_with(word, '{ending}')"
        for ending in ("s", "ed", "ing")
    ),
    "lemma_dict": "SELECT form, lemma FROM stems JOIN vocabulary ON lemma = word",
    "content": "SELECT * FROM words WHERE word NOT IN (SELECT word FROM stops)",
}
VIEWS |= _bayes(
    "language",
    "SELECT lang AS label, word AS w FROM doc_words",
    "SELECT lang AS label, count(*) AS texts FROM documents WHERE lang IS NOT NULL GROUP BY lang",
)
VIEWS |= _bayes(
    "mood",
    "SELECT label, word AS w FROM trained_features",
    "SELECT label, count(*) AS texts FROM labelled GROUP BY label",
)
VIEWS |= _predict(
    "languages", "language", 'SELECT "Id" FROM texts',
    'SELECT "Id", word AS w FROM words', '"Id"',
)
VIEWS |= _predict(
    "turn_languages", "language", "SELECT conv_id, turn FROM conversations",
    "SELECT conv_id, turn, word AS w FROM turn_words", "conv_id, turn",
)
VIEWS |= _predict(
    "moods", "mood", 'SELECT "Id" FROM texts',
    'SELECT "Id", word AS w FROM marked_features', '"Id"',
)
VIEWS |= _predict(
    "doc_languages", "language", "SELECT doc_id FROM documents",
    "SELECT doc_id, word AS w FROM doc_words", "doc_id",
)
VIEWS |= _bayes(
    "staged",
    """SELECT l.label, w.word AS w FROM labelled l JOIN doc_words w ON l.doc_id = w.doc_id
       UNION ALL SELECT l.label, 'lang:' || d.label FROM labelled l
       JOIN doc_languages d ON l.doc_id = d.doc_id""",
    "SELECT label, count(*) AS texts FROM labelled GROUP BY label",
)
VIEWS |= _predict(
    "staged_turns", "staged", "SELECT conv_id, turn FROM conversations",
    """SELECT conv_id, turn, word AS w FROM turn_words
       UNION ALL SELECT conv_id, turn, 'lang:' || label FROM turn_languages""", "conv_id, turn",
)


def _tags(name: str, key: str) -> str:
    return f"""
        SELECT key, tag FROM (
            SELECT {key} AS key, lang AS tag,
                   row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, lang) AS place
            FROM doc_tokens GROUP BY {key}, lang)
        WHERE place = 1"""


VIEWS |= {
    "token_tags": _tags("token_tags", "token"),
    "suffix_tags": _tags("suffix_tags", "right(token, 3)"),
    "any_tag": """
        SELECT lang AS tag FROM doc_tokens GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1""",
    "title_moods": """
        SELECT t."Title", t.score, m.label FROM texts t JOIN moods m ON t."Id" = m."Id" """,
}


def _tagged(tokens: str, key: str) -> str:
    return f"""
        SELECT {key}, pos, coalesce(t.tag, s.tag, (SELECT tag FROM any_tag)) AS tag
        FROM {tokens} w LEFT JOIN token_tags t ON w.token = t.key
        LEFT JOIN suffix_tags s ON right(w.token, 3) = s.key"""


def _user_category_stats(min_reviews: int) -> str:
    return f"""
        SELECT "User_id", "Category", count(*) AS num_reviews, avg(score) AS avg_score,
               round(avg("Price"), 6) AS avg_price
        FROM cleaned JOIN categories USING ("Title")
        GROUP BY "User_id", "Category" HAVING count(*) >= {min_reviews}"""


def _title_sentiment(positives: str) -> str:
    return f"""
        SELECT b."Title", b.total_reviews,
               coalesce(p.positive_count, 0) AS positive_count,
               round(coalesce(p.positive_count, 0) / b.total_reviews * 100, 2) AS percent_pos,
               round(b.mean_score, 2) AS avg_score
        FROM (SELECT "Title", count(*) AS total_reviews, avg(score) AS mean_score
              FROM title_moods GROUP BY "Title") b
        LEFT JOIN (SELECT "Title", count(*) AS positive_count FROM title_moods
                   WHERE label = 'positive' GROUP BY "Title") p
        ON {positives}"""


_REVIEW = '"Id", "Title", "Price", "User_id", score'

SELECTS = {
    "scan_people_csv": "SELECT * FROM people",
    "scan_status_csv": "SELECT id, x, y, status FROM people_status",
    "scan_header_substring": "SELECT * FROM people WHERE f3 NOT LIKE '%id%'",
    "scan_reviews_csv": f"SELECT {_REVIEW}, nullif(text, '') AS text FROM reviews",
    "scan_reviews_inferred": f"SELECT {_REVIEW}, nullif(text, '') AS text FROM reviews",
    "scan_reviews_split": f"SELECT {_REVIEW}, nullif(text, '') AS text FROM reviews",
    "sample_orders": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5000",
    "scan_books_csv": "SELECT * FROM books",
    "parquet_roundtrip": "SELECT * FROM cleaned",
    "view_sql_preview":
        'SELECT "Id", "Title", "User_id", score FROM reviews ORDER BY "Id" LIMIT 20',
    "sample_reviews": 'SELECT "Id", text FROM texts ORDER BY "Id" LIMIT 100',
    "distance_join": "SELECT id, cid FROM pairs",
    "distance_join_far": """
        SELECT p.id, c.id AS cid FROM far_people p JOIN far_people c
        ON p.id <> c.id AND sqrt(pow(p.x - c.x, 2) + pow(p.y - c.y, 2)) <= 6.0
        WHERE c.status = 'yes'""",
    "distance_join_dense": """
        SELECT p.id, c.id AS cid FROM close_people p JOIN close_people c
        ON p.id <> c.id
           AND sqrt(pow(p.x * 16 - c.x * 16, 2) + pow(p.y * 2 - c.y * 2, 2)) <= 6.0
        WHERE c.status = 'yes'""",
    "pair_count": "SELECT count(*) AS n FROM pairs",
    "pair_count_crowded": """
        SELECT count(*) AS n FROM close_people p JOIN close_people c
        ON p.id <> c.id AND sqrt(pow(p.x - c.x, 2) + pow(p.y - c.y, 2)) <= 6.0
        WHERE c.status = 'yes'""",
    "near_ids": "SELECT DISTINCT id FROM pairs",
    "near_people": "SELECT * FROM people WHERE id IN (SELECT id FROM pairs)",
    "neighbor_count": """
        SELECT f.id, (SELECT count(*) FROM people p WHERE p.id <> f.id
                      AND sqrt(pow(f.x - p.x, 2) + pow(f.y - p.y, 2)) <= 6.0) AS n
        FROM people_status f WHERE f.status = 'yes'""",
    "neighbor_count_crowded": """
        SELECT f.id, (SELECT count(*) FROM close_people p WHERE p.id <> f.id
                      AND sqrt(pow(f.x - p.x, 2) + pow(f.y - p.y, 2)) <= 6.0) AS n
        FROM close_people f WHERE f.status = 'yes'""",
    "clean_reviews": "SELECT * FROM cleaned",
    "score_stats": """
        SELECT score, count(*) AS num_reviews, avg(length(text)) AS avg_length,
               CAST(min(length(text)) AS INTEGER) AS min_length,
               CAST(max(length(text)) AS INTEGER) AS max_length
        FROM cleaned GROUP BY score""",
    "user_stats": """
        SELECT "User_id", count(*) AS num_reviews, avg(score) AS avg_score,
               avg(length(text)) AS avg_length
        FROM cleaned GROUP BY "User_id" HAVING count(*) >= 3""",
    "explode_categories": "SELECT * FROM categories",
    "reviews_by_category": """
        SELECT "Id", "User_id", "Title", score, "Price", "Category"
        FROM cleaned JOIN categories USING ("Title")""",
    "user_category_stats": _user_category_stats(2),
    "user_category_stats_active": _user_category_stats(20),
    "tokenize": 'SELECT "Id", pos, token AS value FROM tokens',
    "normalize_tokens": 'SELECT "Id", pos, word AS value FROM words',
    "remove_stopwords": """
        SELECT "Id", CAST(row_number() OVER (PARTITION BY "Id" ORDER BY pos) - 1 AS INTEGER) AS pos,
               word AS value FROM content""",
    "remove_stopwords_named": """
        SELECT "Id", CAST(row_number() OVER (PARTITION BY "Id" ORDER BY pos) - 1 AS INTEGER) AS pos,
               word AS value
        FROM words WHERE word NOT IN (SELECT word FROM item_words)""",
    "text_features": """
        SELECT t."Id", coalesce(a.n, '') AS token, coalesce(b.n, '') AS normalized,
               coalesce(c.n, '') AS "cleanTokens"
        FROM texts t
        LEFT JOIN (SELECT "Id", string_agg(token, ' ' ORDER BY pos) AS n FROM tokens GROUP BY "Id") a
        ON t."Id" = a."Id"
        LEFT JOIN (SELECT "Id", string_agg(word, ' ' ORDER BY pos) AS n FROM words GROUP BY "Id") b
        ON t."Id" = b."Id"
        LEFT JOIN (SELECT "Id", string_agg(word, ' ' ORDER BY pos) AS n FROM content GROUP BY "Id") c
        ON t."Id" = c."Id" """,
    "mark_negation": 'SELECT "Id", word, count(*) AS n FROM marked GROUP BY "Id", word',
    "word_count": """
        SELECT word, count(*) AS count FROM words WHERE length(word) > 2 GROUP BY word""",
    "build_lemma_dict": "SELECT form, lemma FROM lemma_dict",
    "lemmatize": """
        SELECT "Id", pos, coalesce(lemma, word) AS lemma
        FROM words LEFT JOIN lemma_dict ON word = form""",
    "review_lemmas": """
        SELECT "Id", CAST(row_number() OVER (PARTITION BY "Id" ORDER BY pos) - 1 AS INTEGER) AS pos,
               coalesce(lemma, word) AS lemma
        FROM content LEFT JOIN lemma_dict ON word = form""",
    "top_words": """
        SELECT coalesce(lemma, word) AS word, count(*) AS count
        FROM content LEFT JOIN lemma_dict ON word = form
        WHERE length(coalesce(lemma, word)) > 2
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "train_language": "SELECT w, label, weight FROM language_weights",
    "detect_language": 'SELECT "Id", label AS language, score AS best_score FROM languages',
    "detect_language_large":
        'SELECT "Id", label AS language, score AS best_score FROM languages',
    "detect_language_saved":
        'SELECT "Id", label AS language, score AS best_score FROM languages',
    "detect_turn_language":
        "SELECT conv_id, turn, label AS language, score AS best_score FROM turn_languages",
    "train_sentiment": "SELECT w, label, weight FROM mood_weights",
    "predict_sentiment": 'SELECT "Id", label AS sentiment FROM moods',
    "train_tagger": """
        SELECT 'token' AS kind, key, tag FROM token_tags
        UNION ALL SELECT 'suffix', key, tag FROM suffix_tags
        UNION ALL SELECT 'default', '', tag FROM any_tag""",
    "tag_tokens": _tagged("turn_tokens", "conv_id, turn"),
    "tag_tokens_large": _tagged("turn_tokens", "conv_id, turn"),
    "tag_tokens_saved": _tagged("turn_tokens", "conv_id, turn"),
    "annotate_reviews": f"""
        SELECT t."Id", m.label AS sentiment, l.label AS language, t.pos, t.tag
        FROM ({_tagged("tokens", '"Id"')}) t JOIN moods m ON t."Id" = m."Id"
        JOIN languages l ON t."Id" = l."Id" """,
    "pipeline_annotations": """
        SELECT l."Id", l.label AS language, m.label AS sentiment
        FROM languages l JOIN moods m ON l."Id" = m."Id" """,
    "pipeline_fit_transform": """
        SELECT s.conv_id, s.turn, l.label AS language, s.label AS mood, s.score AS best_score
        FROM staged_turns s JOIN turn_languages l ON s.conv_id = l.conv_id AND s.turn = l.turn""",
    "title_sentiment": _title_sentiment('b."Title" = p."Title"'),
    "title_sentiment_counting_null":
        _title_sentiment('b."Title" IS NOT DISTINCT FROM p."Title"'),
}


def _names(sql: str) -> set[str]:
    return set(re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql)) & set(VIEWS)


def _with_views(select: str) -> str:
    """Put the views that a query needs before it, each after those it needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in sorted(_names(VIEWS[name]) - {name}):
            if needed not in ordered:
                add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in sorted(_names(select)):
        add(name)
    # The vocabulary is used several times, and its size can't be guessed from the SQL.
    views = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name == 'vocabulary' else ''}({VIEWS[name].strip()})"
        for name in ordered
    )
    return f"WITH {views}\n{select.strip()}" if views else select.strip()


for small in ("annotate_reviews", "remove_stopwords_named"):
    SELECTS[f"{small}_large"] = SELECTS[small]

ORACLE: dict[str, str] = {key: _with_views(sql) for key, sql in SELECTS.items()}
