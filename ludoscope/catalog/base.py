"""Registry of checked queries and the SQL views their checks read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ludoscope.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VIEWS = {
    "ratings": """
        SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS game_id,
               round(avg(l_quantity) / 5, 4) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
    "users": "SELECT CAST(c_custkey AS INTEGER) AS user_id, c_name AS username FROM customer",
    "games": """
        SELECT CAST(p_partkey AS INTEGER) AS game_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS game,
               p_size * 5 AS playing_time,
               CAST(1 + p_partkey % 3 AS INTEGER) AS min_players,
               CAST(1 + p_partkey % 3 + p_partkey % 4 AS INTEGER) AS max_players,
               CAST(CASE WHEN p_partkey % 9 <> 8 THEN p_partkey % 9 END AS INTEGER) AS best_num_players,
               1 + (p_retailprice - 900) / 25 AS avg_weight,
               CAST(CASE WHEN p_partkey % 17 <> 0
                    THEN 1 + (p_partkey * 7919) % (SELECT count(*) FROM part) END AS INTEGER) AS rank
        FROM part""",
    "attrs": """
        SELECT DISTINCT CAST(p_partkey AS INTEGER) AS game_id, 'mechanic' AS kind,
               unnest(string_split(p_name, ' ')) AS name FROM part
        UNION SELECT CAST(p_partkey AS INTEGER), 'category', p_type FROM part
        UNION SELECT CAST(p_partkey AS INTEGER), 'category', p_brand FROM part""",
    "docs": "SELECT doc_id, text FROM documents",
    "comments": "SELECT conv_id AS game_id, role AS username, turn AS ord, text AS comment FROM conversations",
    "topics": """
        SELECT CAST(p_partkey AS INTEGER) AS game_id, CAST(1 + p_partkey % 9 AS INTEGER) AS topic FROM part""",
    "labeled": "SELECT games.*, topics.topic FROM games JOIN topics USING (game_id)",
    "predictions": """
        SELECT *, round(1 + ((CAST(user_id AS BIGINT) * 31 + CAST(game_id AS BIGINT) * 17) % 900) / 100.0, 2)
               AS prediction FROM ratings""",
    "poll": """
        SELECT CAST(user_id % (SELECT count(*) FROM part) AS INTEGER) AS game_id,
               CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'purchase' THEN '10'
                    WHEN 'signup' THEN '4' ELSE '4+' END AS numplayers, count(*) AS votes
        FROM events GROUP BY 1, 2""",
    "words": r"""
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM docs""",
    "tf": "SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term",
    "df": "SELECT term, count(*) AS df FROM tf GROUP BY term",
    "weighted": """
        SELECT doc_id, term, tf, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1.0 + df)) + 1) AS w
        FROM tf JOIN df USING (term)""",
    "tfidf": """
        SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM weighted""",
    "lemmas": r"""
        SELECT DISTINCT token, regexp_replace(token, 'ing$', '') AS lemma
        FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM documents)
        WHERE regexp_full_match(token, '[a-z]{3,}ing')""",
    "links": """
        SELECT page_id, url, html,
               CASE WHEN page_id % 4 = 0 THEN 'vox' ELSE 'src' || (page_id % 4) END AS source,
               make_timestamp((1704067200 + page_id % 3600) * 1000000 + h * 3600000000) AS ts
        FROM pages, (VALUES (0), (1), (24)) AS hours(h) WHERE h < 24 OR page_id % 2 = 0""",
}

NEEDS = {
    "labeled": ["games", "topics"],
    "predictions": ["ratings"],
    "words": ["docs"],
    "tf": ["words"],
    "df": ["tf"],
    "weighted": ["docs", "tf", "df"],
    "tfidf": ["weighted"],
}


def with_views(names: str, sql: str) -> str:
    """``sql`` behind the views it reads, each after the ones it needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    if not ordered:
        return sql
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {views},\n{text[5:]}"
    return f"WITH {views}\n{text}"


def checked(name: str, views: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(tune(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return fn

    return register
