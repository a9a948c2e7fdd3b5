"""Checked queries: clustering and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ludoscope import fixtures as fx
from ludoscope.catalog.base import checked
from ludoscope.operators import clusters, collab, foldin
from ludoscope.plans.recommend import refresh
from ludoscope.session import cut_lineage, scratch_path, stored
from ludoscope.sources import landed, tables
from ludoscope.streaming import feeds


def _facts(found, games, mismatch):
    """Facts any clustering has to hold, one row."""
    falls = all(a > b for a, b in zip(found.costs, found.costs[1:]))
    placed = games.select("game_id").join(found.labels, "game_id", "left")
    return placed.agg(
        F.count("cluster").alias("n_games"), F.count_if(F.col("cluster").isNull()).alias("n_unplaced"),
        F.lit(falls).alias("cost_falls"), F.lit(mismatch).alias("cost_holds"))


def _attr_cost(games, attrs, found):
    """The cost once more, from labels and centroids alone."""
    sets = clusters.attribute_sets(games, attrs).join(found.labels, "game_id")
    tables_ = F.array(*[F.array(*[F.lit(t) for t in c]).cast("array<long>") for c in found.centroids])
    mine = F.get(tables_, F.col("cluster"))
    shared = F.size(F.array_intersect("terms", mine))
    return sets.agg(F.sum(F.size("terms") + F.size(mine) - 2 * shared)).first()[0]


@checked("G1_kmodes", "games", """
    SELECT init, count(*) AS n_games, 0::BIGINT AS n_unplaced, true AS cost_falls, true AS cost_holds
    FROM games, (VALUES ('Cao'), ('Huang')) AS t(init) GROUP BY init""")
def _(spark, sf):
    games, attrs = cut_lineage(fx.games(spark, sf)), cut_lineage(fx.attrs(spark, sf))
    out = None
    for init in ("Cao", "Huang"):
        found = clusters.kmodes(games, attrs, 8, init)
        facts = _facts(found, games, _attr_cost(games, attrs, found) == found.cost).withColumn("init", F.lit(init))
        out = facts if out is None else out.unionByName(facts)
    return out


@checked("G1_kmodes_pass", "games attrs", """
    WITH sets AS (SELECT game_id, list_sort(list(kind || '|' || name)) AS s FROM attrs GROUP BY game_id),
    starts AS (SELECT s, row_number() OVER (ORDER BY min(game_id)) - 1 AS c FROM sets GROUP BY s ORDER BY min(game_id) LIMIT 4),
    far AS (SELECT game_id, c, len(sets.s) + len(starts.s) - 2 * len(list_intersect(sets.s, starts.s)) AS d FROM sets, starts),
    near AS (SELECT game_id, c, d FROM (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY d, c) AS r FROM far) WHERE r = 1),
    sizes AS (SELECT c, count(*) AS size, CAST(sum(d) AS BIGINT) AS cost FROM near GROUP BY c),
    modes AS (SELECT c, kind || '|' || name AS attr FROM near JOIN attrs USING (game_id) JOIN sizes USING (c)
              GROUP BY c, kind, name, size HAVING 2 * count(*) > size)
    SELECT (SELECT CAST(sum(cost) AS DOUBLE) FROM sizes) AS cost, CAST(c AS INTEGER) AS cluster, attr FROM modes""")
def _(spark, sf):
    games, attrs = fx.games(spark, sf), fx.attrs(spark, sf)
    _, groups = clusters.signatures(games, attrs)
    starts = [list(r["terms"]) for r in groups.orderBy("key").limit(4).collect()]
    moved, cost = clusters.kmodes_pass(groups, starts)
    names = clusters.with_position(
        attrs.select("kind", "name").distinct(), [F.col("kind"), F.col("name")], "term", start=0)
    modes = spark.createDataFrame([(i, t) for i, c in enumerate(moved) for t in c], "cluster int, term long")
    return modes.join(names, "term").select(
        F.lit(cost).alias("cost"), "cluster", F.concat_ws("|", "kind", "name").alias("attr"))


_NUM, _CAT = ["avg_weight", "playing_time"], ["best_num_players", "min_players"]


@checked("G2_kprototypes", "games", """
    WITH rows AS (SELECT game_id, avg_weight, playing_time::DOUBLE AS playing_time, best_num_players, min_players
                  FROM games WHERE best_num_players IS NOT NULL),
    starts AS (SELECT *, row_number() OVER (ORDER BY draw) - 1 AS c FROM (
        SELECT avg_weight, playing_time, best_num_players, min_players, min(md5('34|' || game_id)) AS draw
        FROM rows GROUP BY ALL ORDER BY draw LIMIT 5)),
    far AS (SELECT r.game_id, c, (r.avg_weight - s.avg_weight) * (r.avg_weight - s.avg_weight)
                   + (r.playing_time - s.playing_time) * (r.playing_time - s.playing_time)
                   + 0.5 * (CAST(r.best_num_players <> s.best_num_players AS INTEGER) + CAST(r.min_players <> s.min_players AS INTEGER)) AS d
            FROM rows r, starts s)
    SELECT game_id, CAST(c AS INTEGER) AS cluster FROM (
        SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY d, c) AS r FROM far) WHERE r = 1""")
def _(spark, sf):
    return clusters.kprototypes(fx.games(spark, sf), _NUM, _CAT, 5, gamma=0.5, max_iter=1).labels


def _cao_sql(k: int) -> str:
    """The start written out, one choice after the other."""
    parts = ["""rows AS (SELECT game_id, avg_weight, playing_time::DOUBLE AS playing_time, best_num_players, min_players FROM games WHERE best_num_players IS NOT NULL),
    combos AS (SELECT best_num_players AS b, min_players AS m, avg(avg_weight) AS w, avg(playing_time) AS t FROM rows GROUP BY ALL),
    dense AS (SELECT *, (SELECT count(*) FROM rows WHERE best_num_players = b) + (SELECT count(*) FROM rows WHERE min_players = m) AS d FROM combos)"""]
    for c in range(k):
        apart = [f"(SELECT CAST(dense.b <> p{o}.b AS INTEGER) + CAST(dense.m <> p{o}.m AS INTEGER) FROM p{o})" for o in range(c)]
        score = "d" if not apart else f"d * least({', '.join([*apart, apart[0]])})"
        parts.append(f"p{c} AS (SELECT {c} AS c, b, m, w, t FROM dense WHERE {score} > 0 ORDER BY {score} DESC, b, m LIMIT 1)")
    return "WITH " + ",\n".join(parts) + ",\nstarts AS (" + " UNION ALL ".join(f"SELECT * FROM p{c}" for c in range(k)) + ")"


@checked("G2_kprototypes_cao", "games", _cao_sql(5) + """,
    far AS (SELECT r.game_id, c, (r.avg_weight - s.w) * (r.avg_weight - s.w) + (r.playing_time - s.t) * (r.playing_time - s.t)
                   + 0.5 * (CAST(r.best_num_players <> s.b AS INTEGER) + CAST(r.min_players <> s.m AS INTEGER)) AS d FROM rows r, starts s)
    SELECT game_id, CAST(c AS INTEGER) AS cluster FROM (
        SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY round(d, 9), c) AS r FROM far) WHERE r = 1""")
def _(spark, sf):
    return clusters.kprototypes(fx.games(spark, sf), _NUM, _CAT, 5, gamma=0.5, max_iter=1, init="Cao").labels


@checked("G2_kprototypes_loop", "games", """
    SELECT count(*) AS n_games, 0::BIGINT AS n_unplaced, true AS cost_falls, true AS cost_holds
    FROM games WHERE best_num_players IS NOT NULL""")
def _(spark, sf):
    games = cut_lineage(fx.games(spark, sf))
    found = clusters.kprototypes(games, _NUM, _CAT, 5)
    return _facts(found, games.na.drop("any", subset=["best_num_players"]), found.cost > 0)


@checked("G3_cluster_sizes", "topics", "SELECT topic, count(*) AS n FROM topics GROUP BY topic")
def _(spark, sf):
    return clusters.cluster_sizes(fx.topics(spark, sf), "topic")


_SILHOUETTE = """
    WITH sets AS (SELECT game_id, topic, list(kind || '|' || name) AS s FROM attrs JOIN topics USING (game_id) GROUP BY ALL),
    far AS (SELECT a.game_id, a.topic, b.topic AS other,
                   sum(len(a.s) + len(b.s) - 2 * len(list_intersect(a.s, b.s))) AS total, count(*) AS n
            FROM sets a, sets b GROUP BY ALL),
    own AS (SELECT game_id, topic, total / greatest(n - 1, 1) AS a FROM far WHERE other = topic),
    rest AS (SELECT game_id, min(total / n) AS b FROM far WHERE other <> topic GROUP BY game_id),
    scores AS (SELECT game_id, topic AS cluster, (b - a) / greatest(a, b) AS silhouette FROM own JOIN rest USING (game_id))"""


@checked("G4_silhouette", "attrs topics", _SILHOUETTE + "SELECT round(avg(silhouette), 6) AS silhouette FROM scores")
def _(spark, sf):
    score = clusters.silhouette(fx.attrs(spark, sf), fx.topics(spark, sf), "topic")
    return score.select(F.round("silhouette", 6).alias("silhouette"))


@checked("G5_silhouette_samples", "attrs topics", _SILHOUETTE + """
    SELECT game_id, cluster, round(silhouette, 6) AS silhouette FROM scores""")
def _(spark, sf):
    scores = clusters.silhouette_samples(fx.attrs(spark, sf), fx.topics(spark, sf), "topic")
    return scores.withColumn("silhouette", F.round("silhouette", 6)).orderBy("cluster", "silhouette")


@checked("G6_silhouette_sweep", "games", """
    SELECT CAST(k AS INTEGER) AS k, true AS in_range FROM range(2, 30) AS r(k) WHERE (SELECT count(*) FROM games) > 0""")
def _(spark, sf):
    games, attrs = cut_lineage(fx.games(spark, sf)), cut_lineage(fx.attrs(spark, sf))
    table = clusters.silhouette_sweep(games, attrs, range(2, 30))
    return table.select("k", F.col("silhouette").between(-1, 1).alias("in_range"))


_KEPT = "(source <> 'vox' OR url LIKE '%politics%')"


_STREAMED = f"""
    SELECT DISTINCT source, url, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM links WHERE {_KEPT}
      AND trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', ' ', 'g')) <> ''
      AND trim(regexp_replace(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1), '<[^>]*>', ' ', 'g')) <> ''"""


def _streamed(spark, sf, **options):
    landing, out, mark = (scratch_path(spark, n) for n in ("links", "articles", "articles-mark"))
    links = fx.links(spark, sf)
    # Two landings, the second one holding the first again: what was seen is not added twice.
    for part in (links.where("page_id % 3 = 0"), links):
        tables.append_records(part, landing)
        feeds.stream_articles(spark, landing, links.schema, out, mark, **options).awaitTermination()
    return out


@checked("W1_stream_articles", "links", _STREAMED)
def _(spark, sf):
    # A horizon that holds all these days: what was seen is in the stream's state.
    out = _streamed(spark, sf, horizon_days=36_500)
    return feeds.read_articles(spark, out).select("source", "url", F.date_format("date_published", "yyyy-MM-dd").alias("day"))


@checked("W1_late_articles", "links", _STREAMED)
def _(spark, sf):
    # The days are older than the horizon: the store says what was seen. Then all batches but the last become one.
    out = _streamed(spark, sf)
    feeds.compact_articles(spark, out)
    return feeds.read_articles(spark, out).select("source", "url", F.date_format("date_published", "yyyy-MM-dd").alias("day"))


@checked("W1_batch_articles", "links", f"""
    SELECT source, url, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, min(ts)::VARCHAR AS first_seen FROM links WHERE {_KEPT}
      AND trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', ' ', 'g')) <> ''
      AND trim(regexp_replace(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1), '<[^>]*>', ' ', 'g')) <> ''
    GROUP BY ALL""")
def _(spark, sf):
    return feeds.articles_from(fx.links(spark, sf)).select(
        "source", "url", F.date_format("date_published", "yyyy-MM-dd").alias("day"),
        F.date_format("date_published", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@checked("W2_feed_link_filter", "links", f"SELECT source, url, page_id FROM links WHERE {_KEPT}")
def _(spark, sf):
    return feeds.feed_link_filter(fx.links(spark, sf)).select("source", "url", "page_id")


@checked("W3_already_exists", "", "SELECT page_id, url FROM pages WHERE page_id % 4 <> 1")
def _(spark, sf):
    pages = fx.pages(spark, sf).select("page_id", "url")
    return feeds.without_known(pages, pages.where("page_id % 4 = 1")).select("page_id", "url")


@checked("W4_stream_ratings", "ratings users games", """
    SELECT game, count(*) AS n, count(DISTINCT username) AS n_names,
           count(*) FILTER (user_id % 2 = 0 OR user_id % 10 <> 9) AS n_known
    FROM ratings JOIN users USING (user_id) JOIN games USING (game_id) GROUP BY game""")
def _(spark, sf):
    landing, store, names, mark = (scratch_path(spark, n) for n in ("pages", "store", "names", "store-mark"))
    rated = fx.ratings(spark, sf).join(fx.users(spark, sf), "user_id").join(
        fx.games(spark, sf).select("game_id", "game"), "game_id").select(
        "game", F.col("game_id").cast("string").alias("game_id"), "username", "rating", F.lit("").alias("comment"))
    raw, _ = landed.parse_user_xml(fx.spread(fx.user_pages(spark, sf)))
    raw = cut_lineage(raw)
    users = fx.users(spark, sf).where("user_id % 2 = 0")
    # The second landing repeats the rows of the first one, copied from there; they are skipped.
    for even in (True, False):
        part = rated.where("game_id % 2 = 0") if even else rated.where("game_id % 2 <> 0").unionByName(tables.load_table(spark, landing))
        tables.append_records(part, landing)
        feeds.stream_ratings(spark, landing, rated.schema, raw, users, store, names, mark).awaitTermination()
    return spark.read.parquet(store).groupBy("game").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("username").alias("n_names"), F.count("user_id").alias("n_known"))


@checked("W5_refresh", "ratings", """
    SELECT 5 AS rank, true AS error_known, (SELECT count(DISTINCT user_id) FROM ratings
        WHERE CAST('0x' || substr(md5('34|' || user_id || '|' || game_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.6) AS n_users,
        5::BIGINT AS most_recs, 0::BIGINT AS n_rated""")
def _(spark, sf):
    ratings = stored(fx.ratings(spark, sf), "ratings")
    model, recs = scratch_path(spark, "model"), scratch_path(spark, "recs")
    table = refresh(ratings, model, recs, n=5)
    listed = spark.read.parquet(recs)
    n_users = listed.agg(F.count_distinct("user_id")).scalar()
    most = listed.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    rated = listed.join(ratings, ["user_id", "game_id"], "left_semi").agg(F.count(F.lit(1))).scalar()
    known = collab.load_model(model).rank == 5
    return table.select("rank", (F.lit(known) & (F.col("test_rmse") > 0)).alias("error_known"), n_users.alias("n_users"),
                        most.alias("most_recs"), rated.alias("n_rated"))


@checked("W5_fold_in", "ratings", """
    WITH f AS (SELECT user_id, rating, 1.0 + game_id % 3 AS x, 0.5 + game_id % 7 AS y FROM ratings),
    s AS (SELECT user_id, sum(x * x) + 0.2 * count(*) AS xx, sum(x * y) AS xy, sum(y * y) + 0.2 * count(*) AS yy, sum(rating * x) AS bx, sum(rating * y) AS b_y
          FROM f WHERE user_id % 5 = 0 GROUP BY user_id),
    free AS (SELECT *, (bx * yy - b_y * xy) / (xx * yy - xy * xy) AS px, (b_y * xx - bx * xy) / (xx * yy - xy * xy) AS py FROM s)
    SELECT user_id, round(CASE WHEN px < 0 THEN 0 WHEN py < 0 THEN bx / xx ELSE px END, 3)::DOUBLE AS first_place,
           round(CASE WHEN py < 0 THEN 0 WHEN px < 0 THEN b_y / yy ELSE py END, 3)::DOUBLE AS second_place FROM free""")
def _(spark, sf):
    ratings = fx.ratings(spark, sf)
    # Factors of the games by rule, so that the users' can be worked out in SQL.
    place = [1.0 + F.col("id") % 3, 0.5 + F.col("id") % 7]
    games = ratings.select(F.col("game_id").alias("id")).distinct().select("id", F.array(*[p.cast("float") for p in place]).alias("features"))
    found = foldin.fold_in(games, ratings.where("user_id % 5 = 0"), "user_id", "game_id", 2, 0.2)
    return found.select(F.col("id").alias("user_id"), *[F.round(F.col("features")[i].cast("double"), 3).alias(n) for i, n in enumerate(("first_place", "second_place"))])
