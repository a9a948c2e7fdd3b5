"""Checked queries: sources, sinks and landed payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ludoscope import fixtures as fx, schemas
from ludoscope.catalog.base import checked
from ludoscope.operators import collab
from ludoscope.session import scratch_path, stored
from ludoscope.sources import landed, merged, tables


@checked("S1_read_ratings_csv", "ratings", "SELECT * FROM ratings WHERE (user_id + game_id) % 13 <> 0")
def _(spark, sf):
    path = scratch_path(spark, "ratings-csv")
    blank = F.when((F.col("user_id") + F.col("game_id")) % 13 != 0, F.col("rating"))
    fx.ratings(spark, sf).withColumn("rating", blank).write.csv(path, header=True)
    return tables.read_ratings_csv(spark, path)


@checked("S2_read_ratings_docs", "ratings", "SELECT * FROM ratings WHERE (user_id + game_id) % 13 <> 0")
def _(spark, sf):
    path = scratch_path(spark, "ratings-json")
    blank = F.when((F.col("user_id") + F.col("game_id")) % 13 != 0, F.col("rating").cast("string"))
    fx.ratings(spark, sf).select(
        F.col("user_id").cast("string"), F.col("game_id").cast("string"), blank.alias("rating"),
        F.lit("fine").alias("comment"),
    ).write.json(path)
    return tables.read_ratings_docs(spark, path)


@checked("S3_read_games", "games", """
    SELECT CAST(game_id AS BIGINT) AS game_id, game, playing_time, min_players, max_players,
           best_num_players, rank, round(avg_weight, 6) AS avg_weight FROM games""")
def _(spark, sf):
    path = scratch_path(spark, "games-json")
    fx.games(spark, sf).write.json(path)
    return tables.read_games(spark, path).select(
        "game_id", "game", "playing_time", "min_players", "max_players", "best_num_players", "rank",
        F.round("avg_weight", 6).alias("avg_weight"))


def _records(spark, sf):
    """Game records with a field per attribute, as the store has them; every seventh holds one more."""
    held = fx.attrs(spark, sf).select("game_id", F.concat("name", F.lit("_"), "kind").alias("field"))
    flags = held.groupBy("game_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", F.lit(True))))).alias("flags"))
    game = fx.games(spark, sf).join(flags, "game_id")
    core = F.to_json(F.struct("game_id", "game", "rank", F.when(F.col("game_id") % 7 == 0, F.struct((F.col("game_id") * 2).alias("votes"))).alias("award")))
    path = scratch_path(spark, "records")
    game.select(core.alias("core"), F.to_json("flags").alias("more")).select(
        F.concat(F.expr("left(core, length(core) - 1)"), F.lit(","), F.substr("more", F.lit(2))).alias("value")).write.text(path)
    return tables.read_game_records(spark, path)


@checked("S3_record_attributes", "attrs", "SELECT CAST(game_id AS BIGINT) AS game_id, kind, name FROM attrs")
def _(spark, sf):
    return tables.record_attributes(_records(spark, sf))


@checked("S3_record_fields", "games attrs", """
    SELECT name || '_' || kind AS field, count(*) AS n FROM attrs GROUP BY ALL
    UNION ALL SELECT 'game_id', count(*) FROM games UNION ALL SELECT 'game', count(*) FROM games
    UNION ALL SELECT 'rank', count(rank) FROM games UNION ALL SELECT 'award', count(*) FROM games WHERE game_id % 7 = 0""")
def _(spark, sf):
    return tables.record_fields(_records(spark, sf)).groupBy("field").agg(F.sum("n").alias("n"))


@checked("S3_record_field", "games", """
    SELECT CAST(game_id AS BIGINT) AS game_id, game, rank, CASE WHEN game_id % 7 = 0 THEN CAST(game_id * 2 AS BIGINT) END AS votes FROM games""")
def _(spark, sf):
    return _records(spark, sf).select(
        "game_id", tables.record_field("game").alias("game"), tables.record_field("rank", "int").alias("rank"),
        F.try_variant_get("record", "$.award.votes", "bigint").alias("votes"))


@checked("S4_read_descriptions", "docs", "SELECT doc_id, text FROM docs")
def _(spark, sf):
    games = fx.docs(spark, sf).withColumnsRenamed({"doc_id": "game_id", "text": "description"})
    return tables.read_descriptions(games)


@checked("S5_read_game_list", "ratings games", """
    SELECT game_id, game, count(*) AS n FROM ratings LEFT JOIN games USING (game_id) GROUP BY ALL""")
def _(spark, sf):
    path = scratch_path(spark, "game-list")
    tables.save_table(fx.games(spark, sf).select("game_id", "game", "rank"), path)
    named = tables.name_games(fx.ratings(spark, sf), tables.read_game_list(spark, path))
    return named.groupBy("game_id", "game").agg(F.count(F.lit(1)).alias("n"))


@checked("S6_append_records", "ratings", "SELECT * FROM ratings")
def _(spark, sf):
    path = scratch_path(spark, "appended")
    ratings = fx.ratings(spark, sf)
    tables.append_records(ratings.where("user_id % 2 = 0"), path)
    tables.append_records(ratings.where("user_id % 2 = 1"), path)
    return tables.load_table(spark, path)


_UPSERT = """
    WITH updates AS (SELECT game_id * 2 AS game_id, CASE WHEN game_id % 3 <> 0 THEN game_id END AS playing_time,
                            'yes' AS seen FROM games)
    SELECT coalesce(g.game_id, u.game_id) AS game_id, g.game AS game,
           CASE WHEN u.game_id IS NOT NULL THEN u.playing_time ELSE g.playing_time END AS playing_time,
           u.seen AS seen
    FROM (SELECT game_id, game, playing_time FROM games) g FULL JOIN updates u ON g.game_id = u.game_id"""


def _games_and_updates(spark, sf):
    games = fx.games(spark, sf).select("game_id", "game", "playing_time")
    return games, games.select(
        (F.col("game_id") * 2).alias("game_id"),
        F.when(F.col("game_id") % 3 != 0, F.col("game_id")).alias("playing_time"),
        F.lit("yes").alias("seen"))


@checked("S7_upsert", "games", _UPSERT)
def _(spark, sf):
    games, updates = _games_and_updates(spark, sf)
    return tables.upsert(games, updates, "game_id")


@checked("S7_merge_upsert", "games", _UPSERT)
def _(spark, sf):
    games, updates = _games_and_updates(spark, sf)
    path = scratch_path(spark, "merged-games")
    merged.create_merged(games, path, "game_id", 16)
    merged.merge_upsert(spark, path, updates)
    return merged.read_merged(spark, path)


@checked("S8_update_where", "ratings users", """
    SELECT username, game_id, CASE WHEN user_id % 3 <> 0 THEN user_id + 1 ELSE -1 END AS user_id
    FROM ratings JOIN users USING (user_id)""")
def _(spark, sf):
    users = fx.users(spark, sf)
    target = fx.ratings(spark, sf).join(users, "user_id").select("username", "game_id", F.lit(-1).alias("user_id"))
    mapping = users.where("user_id % 3 <> 0").select("username", (F.col("user_id") + 1).alias("user_id"))
    return tables.update_where(target, mapping, "username", "user_id")


@checked("S8_merge_update", "users", """
    SELECT username, CASE WHEN user_id % 3 <> 0 THEN user_id + 1 ELSE -1 END AS user_id FROM users""")
def _(spark, sf):
    users = fx.users(spark, sf)
    path = scratch_path(spark, "merged-users")
    merged.create_merged(users.select("username", F.lit(-1).alias("user_id")), path, "username", 16)
    mapping = users.where("user_id % 3 <> 0").select("username", (F.col("user_id") + 1).alias("user_id"))
    merged.merge_update(spark, path, mapping.unionByName(mapping.select(F.concat("username", F.lit("?")).alias("username"), "user_id")), "user_id")
    return merged.read_merged(spark, path)


@checked("S9_distinct_values", "", "SELECT DISTINCT source FROM documents")
def _(spark, sf):
    return tables.distinct_values(fx.table(spark, sf, "documents"), "source")


@checked("S10_lookup_user", "users", "SELECT user_id, username FROM users WHERE username = 'Customer#000000042'")
def _(spark, sf):
    return tables.lookup_user(fx.users(spark, sf), "Customer#000000042")


@checked("S11_save_load_model", "ratings", "SELECT count(*) AS n_pairs, count(*) AS n_equal FROM ratings")
def _(spark, sf):
    path = scratch_path(spark, "als-model")
    ratings = stored(fx.ratings(spark, sf), "ratings")
    model = collab.fit_als(ratings, max_iter=20)
    collab.save_model(model, path)
    before = collab.score(model, ratings).select("user_id", "game_id", "prediction")
    after = collab.score(collab.load_model(path), ratings).select(
        "user_id", "game_id", F.col("prediction").alias("loaded"))
    return before.join(after, ["user_id", "game_id"]).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("prediction") == F.col("loaded")).alias("n_equal"))


@checked("S12_save_load_table", "labeled", "SELECT game_id, game, topic FROM labeled")
def _(spark, sf):
    path = scratch_path(spark, "labeled")
    tables.save_table(fx.labeled(spark, sf).select("game_id", "game", "topic"), path, ["topic"])
    return tables.load_table(spark, path)


@checked("S13_sample_rows", "ratings", """
    SELECT * FROM ratings ORDER BY md5('0|' || user_id || '|' || game_id), user_id, game_id LIMIT 500""")
def _(spark, sf):
    return tables.sample_rows(fx.ratings(spark, sf), 500, ["user_id", "game_id"])


@checked("I1_parse_items", "games", """
    SELECT CAST(game_id AS BIGINT) AS game_id, 'img' || game_id || '.jpg' AS image,
           'About "' || game || '" and more' AS description, min_players, max_players,
           playing_time AS min_playtime, playing_time, game_id % 12 AS min_age, game_id % 50 + 1970 AS year_published,
           round(avg_weight, 3) AS avg_rating, 5.5::DOUBLE AS bayesavg_rating, round(avg_weight, 3) AS avg_weight,
           game_id * 3 AS num_comments, game_id * 2 AS users_rated
    FROM games""")
def _(spark, sf):
    return landed.parse_items(fx.item_payloads(spark, sf)).drop("link", "poll", "ranks", "num_weights")


@checked("I2_links_of_type", "attrs", "SELECT CAST(game_id AS BIGINT) AS game_id, kind, name FROM attrs")
def _(spark, sf):
    stats = landed.game_stats(fx.item_payloads(spark, sf), fx.games(spark, sf))
    return landed.attrs_from_stats(stats)


@checked("I3_flag_link", "games", """
    SELECT CAST(game_id AS BIGINT) AS game_id, CASE WHEN game_id % 3 = 0 THEN 'yes' ELSE 'no' END AS kickstarter
    FROM games""")
def _(spark, sf):
    items = landed.parse_items(fx.item_payloads(spark, sf))
    flag = landed.flag_link(F.col("link"), "8374", "boardgamefamily", "Crowdfunding: Kickstarter")
    return items.select("game_id", flag.alias("kickstarter"))


@checked("I4_poll_winner", "games poll", """
    WITH best AS (
        SELECT game_id, numplayers, row_number() OVER (PARTITION BY game_id ORDER BY votes DESC, numplayers) AS r,
               sum(votes) OVER (PARTITION BY game_id) AS total FROM poll)
    SELECT CAST(g.game_id AS BIGINT) AS game_id, CAST(regexp_extract(numplayers, '^[0-9]+') AS INTEGER) AS best_num_players,
           CAST(coalesce(total, 0) AS INTEGER) AS bnp_total_votes
    FROM games g LEFT JOIN best b ON g.game_id = b.game_id AND b.r = 1""")
def _(spark, sf):
    stats = landed.game_stats(fx.item_payloads(spark, sf), fx.games(spark, sf))
    return stats.select("game_id", "best_num_players", "bnp_total_votes")


@checked("I5_normalize_ranks", "games", """
    SELECT CAST(game_id AS BIGINT) AS game_id, 'Board Game Rank' AS name, '1' AS id, rank FROM games
    UNION ALL SELECT CAST(game_id AS BIGINT), 'Family Rank', '2', game_id + 1 FROM games WHERE game_id % 2 = 0""")
def _(spark, sf):
    items = landed.parse_items(fx.item_payloads(spark, sf))
    return items.select("game_id", F.inline(landed.normalize_ranks(F.col("ranks"))))


@checked("I6_ranks_to_columns", "games", """
    SELECT CAST(game_id AS BIGINT) AS game_id, rank AS "Board Game Rank",
           CASE WHEN game_id % 2 = 0 THEN game_id + 1 END AS "Family Rank" FROM games""")
def _(spark, sf):
    stats = landed.game_stats(fx.item_payloads(spark, sf), fx.games(spark, sf))
    return landed.ranks_to_columns(stats, ["Board Game Rank", "Family Rank"])


@checked("I7_parse_rating_comments", "ratings users games", """
    SELECT game, CAST(game_id AS VARCHAR) AS game_id,
           CASE WHEN (user_id + game_id) % 11 <> 0 THEN username END AS username,
           CASE WHEN (user_id + game_id) % 7 <> 0 THEN rating END AS rating,
           CASE WHEN (user_id + game_id) % 5 <> 0 THEN 'says ' || user_id END AS comment
    FROM ratings JOIN users USING (user_id) JOIN games USING (game_id)""")
def _(spark, sf):
    return landed.parse_rating_comments(fx.rating_pages(spark, sf))


@checked("I8_parse_comments_v1", "ratings users games", """
    SELECT game, CAST(game_id AS VARCHAR) AS game_id, username,
           CASE WHEN (user_id + game_id) % 7 <> 0 THEN CAST(floor(rating) AS INTEGER) END AS rating,
           'says ' || user_id AS comment
    FROM ratings JOIN users USING (user_id) JOIN games USING (game_id) WHERE (user_id + game_id) % 5 <> 0""")
def _(spark, sf):
    return landed.parse_comments_v1(fx.rating_pages_v1(spark, sf), fx.games(spark, sf))


@checked("I9_parse_user_xml", "users", """
    SELECT username, CASE WHEN user_id % 10 <> 9 THEN CAST(user_id AS BIGINT) END AS user_id,
           user_id % 10 <> 9 AS found FROM users""")
def _(spark, sf):
    good, bad = landed.parse_user_xml(fx.user_pages(spark, sf))
    return good.withColumn("found", F.lit(True)).unionByName(
        bad.withColumn("found", F.lit(False)), allowMissingColumns=True)


@checked("I10_extract_game_links", "games", """
    SELECT CAST(game_id AS BIGINT) AS game_id,
           list_aggregate(list_transform(string_split(game, ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS game,
           row_number() OVER (ORDER BY game_id) AS rank
    FROM games""")
def _(spark, sf):
    return landed.extract_game_links(fx.catalogue_pages(spark, sf))


@checked("I11_extract_thumbnails", "games", """
    SELECT CAST(game_id AS VARCHAR) AS game_id, replace(game, ' ', '-') AS slug,
           CAST(game_id + 100000 AS VARCHAR) AS picture_id FROM games""")
def _(spark, sf):
    return landed.extract_thumbnails(fx.catalogue_pages(spark, sf))


@checked("I12_image_links", "games", """
    SELECT CAST(game_id AS VARCHAR) AS game_id, size,
           'https://cf.geekdo-images.com/images/pic' || (game_id + 100000) || suffix AS url
    FROM games, (VALUES ('small', '_t.jpg'), ('medium', '_md.jpg')) AS s(size, suffix)""")
def _(spark, sf):
    thumbs = landed.extract_thumbnails(fx.catalogue_pages(spark, sf))
    small = landed.image_links(thumbs, "small").withColumn("size", F.lit("small"))
    return small.unionByName(landed.image_links(thumbs, "medium").withColumn("size", F.lit("medium")))


@checked("I13_batch_ids", "games", """
    SELECT b AS batch, string_agg(game_id, ',' ORDER BY pos) AS ids, count(*) AS n
    FROM (SELECT game_id, row_number() OVER (ORDER BY playing_time, game_id) AS pos,
                 (row_number() OVER (ORDER BY playing_time, game_id) - 1) // 100 AS b FROM games) GROUP BY b""")
def _(spark, sf):
    batches = landed.batch_ids(fx.games(spark, sf), "playing_time", 100)
    return batches.select(
        "batch", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"),
        F.size("ids").cast("long").alias("n"))


@checked("I14_rejects", "ratings", """
    SELECT DISTINCT game_id, CAST(user_id // 100 AS BIGINT) AS page, game_id % 10 <> 3 AS readable FROM ratings""")
def _(spark, sf):
    pages = fx.rating_pages(spark, sf)
    cut = F.when(F.col("game_id") % 10 == 3, F.expr("substring(xml, 1, length(xml) - 30)")).otherwise(F.col("xml"))
    good, bad = landed.split_rejects(pages.withColumn("xml", cut), schemas.COMMENTS_XML, "items")
    return good.select("game_id", "page", F.lit(True).alias("readable")).unionByName(
        bad.select("game_id", "page", F.lit(False).alias("readable")))


@checked("I15_skip_loaded_games", "ratings games", """
    SELECT game, CASE WHEN game_id % 3 = 0 THEN 'old' ELSE 'new' END AS status, count(*) AS n
    FROM ratings JOIN games USING (game_id) GROUP BY ALL""")
def _(spark, sf):
    games = fx.games(spark, sf)
    new = fx.ratings(spark, sf).join(games.select("game_id", "game"), "game_id")
    fresh, old = landed.skip_loaded_games(new, games.where("game_id % 3 = 0"))
    both = fresh.withColumn("status", F.lit("new")).unionByName(old.withColumn("status", F.lit("old")))
    return both.groupBy("game", "status").agg(F.count(F.lit(1)).alias("n"))


@checked("I16_resolve_user_ids", "ratings users", """
    WITH said AS (SELECT user_id, username, count(*) AS n FROM ratings JOIN users USING (user_id) GROUP BY ALL)
    SELECT username, CASE WHEN user_id % 2 = 0 OR user_id % 10 <> 9 THEN CAST(user_id AS BIGINT) END AS user_id, n,
           user_id % 2 = 0 OR user_id % 10 <> 9 AS listed
    FROM said""")
def _(spark, sf):
    users = fx.users(spark, sf).withColumn("user_id", F.col("user_id").cast("long"))
    said = fx.ratings(spark, sf).join(fx.users(spark, sf), "user_id").select("username", "game_id")
    raw, _ = landed.parse_user_xml(fx.user_pages(spark, sf))
    resolved, directory = landed.resolve_user_ids(said, users.where("user_id % 2 = 0"), raw)
    counts = resolved.groupBy("username", "user_id").agg(F.count(F.lit(1)).alias("n"))
    listed = directory.select("username", F.lit(True).alias("listed"))
    return counts.join(listed, "username", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


_TEXT = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace({0}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'),
    '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
    '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '[\s\x0B]+', ' ', 'g'))"""


@checked("I17_parse_article", "", f"""
    SELECT url, 'src' || (page_id % 4) AS source,
           {_TEXT.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS headline,
           {_TEXT.format("regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)")} AS article_text,
           len(regexp_extract_all(html, '(?i)<meta name="author" content="([^"]*)"')) AS n_authors,
           '2024-05-01' AS day
    FROM pages
    WHERE {_TEXT.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} <> ''
      AND {_TEXT.format("regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)")} <> ''""")
def _(spark, sf):
    source = F.concat(F.lit("src"), (F.col("page_id") % 4).cast("string"))
    now = F.lit("2024-05-01 00:00:00").cast("timestamp")
    return landed.parse_article(fx.pages(spark, sf), source, now).select(
        "url", "source", "headline", "article_text", F.size("author").cast("long").alias("n_authors"),
        F.date_format("date_published", "yyyy-MM-dd").alias("day"))
