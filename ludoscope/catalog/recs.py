"""Checked queries: collaborative filtering, serving and similarity.

What a fitted model predicts has no SQL twin. Its queries return facts that have one: how many rows,
which pairs, whether every value holds the stated property.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ludoscope import fixtures as fx
from ludoscope.catalog.base import checked
from ludoscope.operators import collab, ratings as rating_ops, serve, similar, titles
from ludoscope.operators.text import tfidf
from ludoscope.plans.recommend import recommend_for_user, recommend_similar
from ludoscope.session import cut_lineage, stored

KEYS = ["user_id", "game_id"]
_DRAW = "CAST('0x' || substr(md5('34|' || user_id || '|' || game_id), 1, 8) AS BIGINT) / 4294967296.0"
_SPLIT = f"""
    drawn AS (SELECT *, {_DRAW} AS u FROM ratings), train AS (SELECT * FROM drawn WHERE u < 0.7),
    test AS (SELECT * FROM drawn WHERE u >= 0.7)"""


def _fitted(spark, sf, **als):
    ratings = stored(fx.ratings(spark, sf), "ratings")
    train, test = rating_ops.hash_split(ratings, [0.7, 0.3], KEYS)
    return collab.fit_als(train, **{"max_iter": 20, **als}), train, test, ratings


@checked("A1_fit_als", "ratings", f"""
    WITH {_SPLIT} SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT game_id) AS n_games, 5 AS rank,
    true AS finite, true AS not_negative FROM train""")
def _(spark, sf):
    model, *_ = _fitted(spark, sf)

    def facts(factors, name):
        bad = F.exists("features", lambda x: F.isnan(x) | (x == float("inf")))
        return factors.agg(
            F.count(F.lit(1)).alias(name), F.count_if(bad).alias("bad"),
            F.count_if(F.exists("features", lambda x: x < 0)).alias("negative"),
            F.max(F.size("features")).alias("rank"))

    users = facts(model.userFactors, "n_users").withColumn("_k", F.lit(1))
    games = facts(model.itemFactors, "n_games").withColumn("_k", F.lit(1)).drop("rank")
    both = users.withColumnsRenamed({"bad": "b1", "negative": "m1"}).join(games, "_k")
    return both.select(
        "n_users", "n_games", "rank", (F.col("b1") + F.col("bad") == 0).alias("finite"),
        (F.col("m1") + F.col("negative") == 0).alias("not_negative"))


@checked("A2_score", "ratings", f"""
    WITH {_SPLIT} SELECT user_id, game_id, true AS is_dot_product FROM test
    WHERE user_id IN (SELECT user_id FROM train) AND game_id IN (SELECT game_id FROM train)""")
def _(spark, sf):
    model, _, test, _ = _fitted(spark, sf)
    pairs = rating_ops.feature_pairs(test)
    scored = collab.score(model, pairs)
    dots = collab.dot_products(model, pairs).withColumnRenamed("prediction", "dot")
    return scored.join(dots, KEYS).select(
        *KEYS, (F.abs(F.col("prediction") - F.col("dot")) < 1e-4).alias("is_dot_product"))


@checked("A3_rmse", "ratings", "SELECT count(*) AS n, true AS beats_mean FROM ratings")
def _(spark, sf):
    model, _, _, ratings = _fitted(spark, sf)
    error = collab.rmse(model, ratings)
    return ratings.agg(F.count(F.lit(1)).alias("n"), (F.lit(error) < F.stddev_pop("rating")).alias("beats_mean"))


@checked("A4_rmse_join", "predictions", "SELECT round(sqrt(avg((rating - prediction) ** 2)), 6) AS rmse FROM predictions")
def _(spark, sf):
    stored = fx.predictions(spark, sf)
    return collab.rmse_join(stored, stored).select(F.round("rmse", 6).alias("rmse"))


@checked("A5_grid_search", "ratings", """
    SELECT rank, CAST(reg AS DOUBLE) AS reg, max_iter, n_best
    FROM (VALUES (5, 0.2, 20, 1), (5, 0.75, 20, 1), (10, 0.2, 20, 1), (10, 0.75, 20, 1)) AS t(rank, reg, max_iter, n_best)""")
def _(spark, sf):
    ratings = stored(fx.ratings(spark, sf), "ratings")
    train, val, _ = rating_ops.hash_split(ratings, [0.6, 0.2, 0.2], KEYS)
    _, table = collab.grid_search(train, val, [5, 10], [0.2, 0.75], [20])
    best = table.where("best").agg(F.count(F.lit(1))).scalar()
    lowest = table.agg(F.min("rmse")).scalar() == table.where("best").agg(F.max("rmse")).scalar()
    return table.select("rank", "reg", "max_iter",
                        F.when(lowest, best).otherwise(-1).cast("int").alias("n_best"))


@checked("A6_holdout_eval", "ratings", f"""
    WITH {_SPLIT} SELECT (SELECT count(*) FROM test) AS n_pairs, count(*) AS n_scored, true AS finite FROM test
    WHERE user_id IN (SELECT user_id FROM train) AND game_id IN (SELECT game_id FROM train)""")
def _(spark, sf):
    model, _, test, _ = _fitted(spark, sf)
    return collab.holdout_eval(model, test).select("n_pairs", "n_scored", (F.col("rmse") > 0).alias("finite"))


@checked("A7_label_blind_check", "ratings", "SELECT 0::BIGINT AS n_changed")
def _(spark, sf):
    model, _, test, _ = _fitted(spark, sf)
    return collab.label_blind_check(model, test).agg(F.count(F.lit(1)).alias("n_changed"))


@checked("A8_rank_predictions", "predictions", """
    SELECT user_id, game_id, prediction, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, game_id) AS rank
    FROM predictions""")
def _(spark, sf):
    return collab.rank_predictions(fx.predictions(spark, sf)).select(*KEYS, "prediction", "rank")


@checked("A9_recommend_all", "ratings", """
    WITH per_user AS (SELECT user_id, count(*) AS rated FROM ratings GROUP BY user_id),
    games AS (SELECT count(DISTINCT game_id) AS n FROM ratings)
    SELECT user_id, least(10, n - rated) AS n_recs, 0::BIGINT AS n_rated, true AS in_order FROM per_user, games""")
def _(spark, sf):
    ratings = stored(fx.ratings(spark, sf), "ratings")
    model = collab.fit_als(ratings, max_iter=20)
    recs = collab.recommend_all(model, ratings, 10)
    seen = recs.join(ratings.select(*KEYS, F.lit(1).alias("_seen")), KEYS, "left")
    facts = seen.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"), F.count("_seen").alias("n_rated"),
        F.array_sort(F.collect_list(F.struct("rank", (-F.col("prediction")).alias("p")))).alias("l"))
    ordered = F.transform("l", lambda x: x["p"])
    return facts.select("user_id", "n_recs", "n_rated", (ordered == F.array_sort(ordered)).alias("in_order"))


@checked("A10_attach_labels", "predictions labeled", """
    SELECT user_id, game_id, prediction, game, topic FROM predictions JOIN labeled USING (game_id)""")
def _(spark, sf):
    labels = fx.labeled(spark, sf).select(F.col("game_id").cast("string").alias("game_id"), "game", "topic")
    return collab.attach_labels(fx.predictions(spark, sf), labels).select(*KEYS, "prediction", "game", "topic")


@checked("F1_filter_time", "games", "SELECT game_id, playing_time FROM games WHERE playing_time > 30 AND playing_time < 120")
def _(spark, sf):
    games = serve.filter_time(fx.games(spark, sf), "30", "", "playing_time")
    return serve.filter_time(games, "", 120).select("game_id", "playing_time")


@checked("F2_filter_players", "games", """
    SELECT game_id, best_num_players, 'any' AS choice FROM games WHERE best_num_players >= 1
    UNION ALL SELECT game_id, best_num_players, 'some' FROM games WHERE best_num_players IN (2, 4)
    UNION ALL SELECT game_id, best_num_players, 'many' FROM games WHERE best_num_players = 1 OR best_num_players >= 5""")
def _(spark, sf):
    games = fx.games(spark, sf).select("game_id", "best_num_players")
    some = serve.filter_players(games, ["2", "4"]).withColumn("choice", F.lit("some"))
    many = serve.filter_players(games, [1, 5]).withColumn("choice", F.lit("many"))
    return serve.filter_players(games, ["Any", "2"]).withColumn("choice", F.lit("any")).unionByName(some).unionByName(many)


@checked("F3_diversify", "predictions topics", """
    WITH ranked AS (SELECT user_id, game_id, topic,
                           row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, game_id) AS rank
                    FROM predictions JOIN topics USING (game_id)),
    marked AS (SELECT *, topic <= 8 AND row_number() OVER (PARTITION BY user_id, topic ORDER BY rank) = 1 AS promoted FROM ranked)
    SELECT user_id, game_id, rank, promoted,
           row_number() OVER (PARTITION BY user_id ORDER BY promoted DESC, rank) AS place FROM marked""")
def _(spark, sf):
    ranked = collab.rank_predictions(fx.predictions(spark, sf)).join(fx.topics(spark, sf), "game_id")
    return serve.diversify(ranked, by=["user_id"]).select(*KEYS, "rank", "promoted", "place")


@checked("F4_rank_cutoff", "games", "SELECT game_id, coalesce(rank, 0) AS rank FROM games WHERE rank < 3000 AND rank <> 0")
def _(spark, sf):
    games = fx.games(spark, sf).select("game_id", F.coalesce("rank", F.lit(0)).alias("rank"))
    return serve.rank_cutoff(games)


@checked("F5_top_n", "games", """
    SELECT * FROM (SELECT game_id, avg_weight, 'top' AS part FROM games ORDER BY avg_weight DESC, game_id LIMIT 20)
    UNION ALL SELECT * FROM (SELECT game_id, avg_weight, 'slice' FROM games ORDER BY avg_weight DESC, game_id LIMIT 20 OFFSET 1)""")
def _(spark, sf):
    games = fx.games(spark, sf).select("game_id", "avg_weight")
    order = [F.col("avg_weight").desc(), F.col("game_id")]
    return serve.top_n(games, order).withColumn("part", F.lit("top")).unionByName(
        serve.top_n(games, order, 20, skip=1).withColumn("part", F.lit("slice")))


USER = "Customer#000000042"


@checked("F6_recommend_for_user", "ratings labeled", """
    WITH chosen AS (
        SELECT DISTINCT game_id, topic FROM labeled
        WHERE game_id IN (SELECT game_id FROM ratings) AND game_id NOT IN (SELECT game_id FROM ratings WHERE user_id = 42)
          AND playing_time > 20 AND playing_time < 200 AND best_num_players >= 1)
    SELECT least(20, count(*)) AS n_served, count(DISTINCT topic) FILTER (topic <= 8) AS n_promoted,
           0::BIGINT AS n_wrong, true AS heads_lead
    FROM chosen""")
def _(spark, sf):
    ratings = stored(fx.ratings(spark, sf), "ratings")
    model = collab.fit_als(ratings, max_iter=20)
    served = cut_lineage(recommend_for_user(
        model, ratings, fx.users(spark, sf), fx.labeled(spark, sf), USER, ["Any"], "20", "200"))
    rated = ratings.where("user_id = 42").select("game_id", F.lit(1).alias("_rated"))
    wrong = F.col("_rated").isNotNull() | (F.col("Playing Time") <= 20) | (F.col("Playing Time") >= 200)
    best = served.groupBy("topic").agg(F.max("prediction").alias("_best"))
    heads = served.join(rated, "game_id", "left").join(best, "topic")
    lead = F.count_if(F.col("promoted") & (F.col("prediction") < F.col("_best"))) == 0
    return heads.agg(
        F.count(F.lit(1)).alias("n_served"), F.count_if("promoted").alias("n_promoted"),
        F.count_if(wrong).alias("n_wrong"), lead.alias("heads_lead"))


_SIMILAR = r"""
    WITH vocab AS (SELECT count(*) AS m FROM (SELECT DISTINCT kind, name FROM attrs)),
    sets AS (SELECT game_id, count(*) AS n FROM attrs GROUP BY game_id),
    probe AS (SELECT game_id FROM (
        SELECT game_id, game, list_aggregate(list_sort(regexp_extract_all(lower(game), '[\p{L}\p{N}_]+')), 'string_agg', ' ') AS s
        FROM games)
        ORDER BY 1 - levenshtein(s, '{q}') / greatest(length(s), length('{q}'), 1) DESC, game, game_id LIMIT 1),
    mine AS (SELECT kind, name FROM attrs WHERE game_id = (SELECT game_id FROM probe)),
    near AS (SELECT g.game_id, coalesce(s.n, 0) AS own,
                    (SELECT count(*) FROM attrs a JOIN mine USING (kind, name) WHERE a.game_id = g.game_id) AS shared,
                    (SELECT count(*) FROM mine) AS probe, m
             FROM games g LEFT JOIN sets s USING (game_id) CROSS JOIN vocab)"""
_QUERY, _SORTED = "Ring small 17", "17 ring small"


@checked("F7_recommend_similar", "games attrs", _SIMILAR.replace("{q}", _SORTED) + """
    SELECT rank AS "BGG Rank", game_id, game AS "Game", playing_time AS "Playing Time", min_players AS "Min Players",
           max_players AS "Max Players", best_num_players AS "Best Num Players",
           round_even(avg_weight, 1)::DOUBLE AS "Complexity", round(1 - (own + probe - 2 * shared) / m, 9) AS similarity
    FROM games JOIN near USING (game_id)
    WHERE game_id <> (SELECT game_id FROM probe) AND playing_time > 15 AND playing_time < 220
      AND (best_num_players IN (2, 3) OR best_num_players >= 5) AND rank < 3000 AND rank <> 0
    ORDER BY 1 - (own + probe - 2 * shared) / m DESC, game_id LIMIT 20""")
def _(spark, sf):
    served = recommend_similar(
        fx.games(spark, sf), fx.attrs(spark, sf), _QUERY, ["2", "3", "5"], "15", "220")
    return served.withColumn("similarity", F.round("similarity", 9))


@checked("K1_hamming_similarity", "games attrs", _SIMILAR.replace("{q}", _SORTED) + """
    SELECT game_id, round(1 - (own + probe - 2 * shared) / m, 9) AS similarity FROM near""")
def _(spark, sf):
    games = fx.games(spark, sf)
    probe = similar.fuzzy_match(games, _QUERY).first()["game_id"]
    near = similar.hamming_similarity(games, fx.attrs(spark, sf), probe)
    return near.withColumn("similarity", F.round("similarity", 9))


_PAIRS = """
    WITH vocab AS (SELECT count(*) AS m FROM (SELECT DISTINCT kind, name FROM attrs)),
    sets AS (SELECT game_id, count(*) AS n FROM attrs GROUP BY game_id),
    shared AS (SELECT a.game_id, b.game_id AS other_id, count(*) AS both_n
               FROM attrs a JOIN attrs b USING (kind, name) GROUP BY ALL),
    pairs AS (SELECT a.game_id, b.game_id AS other_id, a.n AS an, b.n AS bn, coalesce(both_n, 0) AS both_n, m
              FROM sets a JOIN sets b ON a.game_id <> b.game_id CROSS JOIN vocab
              LEFT JOIN shared s ON s.game_id = a.game_id AND s.other_id = b.game_id),
    scored AS (SELECT game_id, other_id, {score} AS similarity FROM pairs)
    SELECT game_id, other_id, round(similarity, 9) AS similarity, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY similarity DESC, other_id) AS rank FROM scored)
    WHERE rank <= 9"""


def _nearest(df):
    return df.select(
        F.col("game_id").cast("int").alias("game_id"), F.col("other_id").cast("int").alias("other_id"),
        F.round("similarity", 9).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@checked("K2_hamming_topk", "attrs", _PAIRS.replace("{score}", "1 - (an + bn - 2 * both_n) / m"))
def _(spark, sf):
    return _nearest(similar.hamming_topk(fx.games(spark, sf), fx.attrs(spark, sf), 9))


@checked("K3_jaccard_topk", "attrs", _PAIRS.replace("{score}", "both_n / (an + bn - both_n)"))
def _(spark, sf):
    return _nearest(similar.jaccard_topk(fx.games(spark, sf), fx.attrs(spark, sf), 9))


@checked("K3_jaccard_similarity", "games attrs", _SIMILAR.replace("{q}", _SORTED) + """
    SELECT game_id, round(shared / (own + probe - shared), 9) AS similarity FROM near""")
def _(spark, sf):
    games = fx.games(spark, sf)
    probe = similar.fuzzy_match(games, _QUERY).first()["game_id"]
    near = similar.jaccard_similarity(games, fx.attrs(spark, sf), probe)
    return near.withColumn("similarity", F.round("similarity", 9))


@checked("K4_cosine_topk", "docs tfidf", """
    WITH pairs AS (SELECT a.doc_id, b.doc_id AS other_id, round(sum(a.tfidf * b.tfidf), 9) AS similarity
                   FROM tfidf a JOIN tfidf b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY ALL),
    everyone AS (SELECT a.doc_id, b.doc_id AS other_id FROM docs a JOIN docs b ON a.doc_id <> b.doc_id
                 WHERE a.doc_id IN (SELECT doc_id FROM tfidf) AND b.doc_id IN (SELECT doc_id FROM tfidf)),
    scored AS (SELECT doc_id, other_id, coalesce(similarity, 0.0) AS similarity
               FROM everyone LEFT JOIN pairs USING (doc_id, other_id))
    SELECT doc_id, other_id, round(similarity, 6) AS similarity, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, other_id) AS rank FROM scored)
    WHERE rank <= 10""")
def _(spark, sf):
    near = similar.cosine_topk(tfidf(fx.docs(spark, sf), numbered=True), 10)
    return near.select("doc_id", "other_id", F.round("similarity", 6).alias("similarity"),
                       F.col("rank").cast("long").alias("rank"))


@checked("K4_cosine_similarity", "tfidf", """
    SELECT a.doc_id, round(coalesce(sum(a.tfidf * b.tfidf), 0.0), 6) AS similarity
    FROM tfidf a LEFT JOIN tfidf b ON a.term = b.term AND b.doc_id = 1 WHERE a.doc_id <> 1 GROUP BY a.doc_id""")
def _(spark, sf):
    near = similar.cosine_similarity(tfidf(fx.docs(spark, sf)), 1)
    return near.withColumn("similarity", F.round("similarity", 6))


@checked("K5_fuzzy_match", "games", r"""
    SELECT game_id, game, round(score, 9) AS score FROM (
        SELECT game_id, game, 1 - levenshtein(s, '1042 smal widgt') / greatest(length(s), 15) AS score FROM (
            SELECT game_id, game, list_aggregate(list_sort(regexp_extract_all(lower(game), '[\p{L}\p{N}_]+')), 'string_agg', ' ') AS s
            FROM games))
    ORDER BY score DESC, game, game_id LIMIT 1""")
def _(spark, sf):
    return similar.fuzzy_match(fx.games(spark, sf), "Smal Widgt 1042").withColumn("score", F.round("score", 9))


@checked("K6_neighbours_by_text", "tfidf games", """
    WITH near AS (SELECT a.doc_id, round(coalesce(sum(a.tfidf * b.tfidf), 0.0), 9) AS similarity
                  FROM tfidf a LEFT JOIN tfidf b ON a.term = b.term AND b.doc_id = 1 WHERE a.doc_id <> 1 GROUP BY a.doc_id
                  ORDER BY 2 DESC, 1 LIMIT 10)
    SELECT doc_id, game, round(similarity, 6) AS similarity FROM near JOIN games ON doc_id = game_id""")
def _(spark, sf):
    near = similar.neighbours_by_text(tfidf(fx.docs(spark, sf)), fx.games(spark, sf), 1, 10)
    return near.withColumn("similarity", F.round("similarity", 6))


@checked("K5_match_names", "games", r"""
    WITH forms AS (SELECT game_id, game, list_aggregate(list_sort(regexp_extract_all(lower(game), '[\p{L}\p{N}_]+')), 'string_agg', ' ') AS s FROM games),
    names AS (SELECT name, list_aggregate(list_sort(regexp_extract_all(lower(name), '[\p{L}\p{N}_]+')), 'string_agg', ' ') AS s
              FROM (SELECT DISTINCT replace(substr(game, 2), 'g', 'gg') AS name FROM games)),
    scored AS (SELECT name, game_id, game, 1 - levenshtein(n.s, f.s) / greatest(length(n.s), length(f.s)) AS score FROM names n, forms f
               WHERE abs(length(n.s) - length(f.s)) <= 0.3 * greatest(length(n.s), length(f.s)))
    SELECT name, game_id, game, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, game, game_id) AS r FROM scored)
    WHERE r = 1 AND score >= 0.7 - 1e-9""")
def _(spark, sf):
    games = fx.games(spark, sf).select("game_id", "game")
    names = games.select(F.replace(F.substr("game", F.lit(2)), F.lit("g"), F.lit("gg")).alias("name"))
    return titles.match_names(titles.build_title_index(games), names).withColumn("score", F.round("score", 9))
