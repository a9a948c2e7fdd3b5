"""Views over the driver's tables that stand in for the catalogue's own (see FIXTURES.md).

Each view has a twin in ``catalog/base.py``, written in SQL for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A plain scan dealt out to all cores, and to more tasks where a shuffle would have more: the test tables are few files."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    pairs = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).groupBy("o_custkey", "l_partkey")
    return pairs.agg(F.round(F.avg("l_quantity") / 5, 4).alias("rating")).select(
        F.col("o_custkey").cast("int").alias("user_id"), F.col("l_partkey").cast("int").alias("game_id"), "rating"
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id"), F.col("c_name").alias("username")
    )


def games(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    key = F.col("p_partkey")
    n_games = part.agg(F.count(F.lit(1))).scalar()
    return part.select(
        key.cast("int").alias("game_id"),
        F.concat("p_name", F.lit(" "), key.cast("string")).alias("game"),
        (F.col("p_size") * 5).alias("playing_time"),
        (1 + key % 3).cast("int").alias("min_players"),
        (1 + key % 3 + key % 4).cast("int").alias("max_players"),
        F.when(key % 9 != 8, key % 9).cast("int").alias("best_num_players"),
        (1 + (F.col("p_retailprice") - 900) / 25).alias("avg_weight"),
        F.when(key % 17 != 0, 1 + (key * 7919) % n_games).cast("int").alias("rank"),
    )


def attrs(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("game_id"), "p_name", "p_type", "p_brand")
    words = part.select("game_id", F.lit("mechanic").alias("kind"), F.explode(F.split("p_name", " ")).alias("name"))
    groups = part.select(
        "game_id", F.lit("category").alias("kind"), F.explode(F.array("p_type", "p_brand")).alias("name")
    )
    return words.unionByName(groups).distinct()


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


def comments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("game_id"), F.col("role").alias("username"), F.col("turn").alias("ord"),
        F.col("text").alias("comment"),
    )


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"))


def topics(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in for fitted topics: 1 to 8, and 9 for none."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("game_id"), (1 + F.col("p_partkey") % 9).cast("int").alias("topic")
    )


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    return games(spark, sf).join(topics(spark, sf), "game_id")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in for stored predictions of the rated pairs, exact to two digits."""
    value = 1 + ((F.col("user_id").cast("long") * 31 + F.col("game_id").cast("long") * 17) % 900) / 100
    return ratings(spark, sf).withColumn("prediction", F.round(value, 2))


def _tag(name: str, value) -> object:
    return F.concat(F.lit(f"<{name} value=\""), value.cast("string"), F.lit("\"/>"))


def escape(col):
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(plain), F.lit(entity))
    return col


def poll(spark: SparkSession, sf: str) -> DataFrame:
    """(game_id, numplayers, votes, pos): events by type stand for the options of a poll."""
    event = table(spark, sf, "events").select("user_id", "event_type")
    n_games = table(spark, sf, "part").agg(F.count(F.lit(1))).scalar()
    option = (
        F.when(F.col("event_type") == "click", "1").when(F.col("event_type") == "view", "2")
        .when(F.col("event_type") == "purchase", "10").when(F.col("event_type") == "signup", "4")
        .otherwise("4+")
    )
    return event.groupBy((F.col("user_id") % n_games).cast("int").alias("game_id"), option.alias("numplayers")).agg(
        F.count(F.lit(1)).alias("votes")
    )


def item_payloads(spark: SparkSession, sf: str, per_page: int = 20) -> DataFrame:
    """Statistics payloads in XML, 20 items each, built from games, attributes and polls."""
    game = games(spark, sf)
    held = attrs(spark, sf).withColumn(
        "x", F.concat(F.lit('<link type="boardgame'), "kind", F.lit('" id="'), F.length("name").cast("string"),
                      F.lit('" value="'), escape(F.col("name")), F.lit('"/>')))
    links = held.groupBy("game_id").agg(F.array_join(F.array_sort(F.collect_list("x")), "").alias("links"))
    options = poll(spark, sf).withColumn(
        "x", F.struct("numplayers", F.concat(
            F.lit('<results numplayers="'), "numplayers", F.lit('"><result value="Best" numvotes="'),
            F.col("votes").cast("string"), F.lit('"/><result value="Recommended" numvotes="0"/></results>')).alias("s"),
            F.col("votes").alias("v")))
    polls = options.groupBy("game_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["s"]), "").alias("poll"),
        F.sum("votes").alias("total"))
    g = game.join(links, "game_id", "left").join(polls, "game_id", "left")
    empty = F.lit("")
    ranks = F.concat(
        F.lit('<rank friendlyname="Board Game Rank" id="1" value="'),
        F.coalesce(F.col("rank").cast("string"), F.lit("Not Ranked")), F.lit('"/>'),
        F.when(F.col("game_id") % 2 == 0, F.concat(
            F.lit('<rank friendlyname="Family Rank" id="2" value="'), (F.col("game_id") + 1).cast("string"),
            F.lit('"/>'))).otherwise(empty))
    crowd = F.when(
        F.col("game_id") % 3 == 0,
        F.lit('<link type="boardgamefamily" id="8374" value="Crowdfunding: Kickstarter"/>')).otherwise(empty)
    item = F.concat(
        F.lit('<item type="boardgame" id="'), F.col("game_id").cast("string"), F.lit('"><image>img'),
        F.col("game_id").cast("string"), F.lit(".jpg</image><description>About &amp;ldquo;"), F.col("game"),
        F.lit("&amp;rdquo;&amp;#10;&amp;#10;and  more</description>"),
        _tag("yearpublished", F.col("game_id") % 50 + 1970), _tag("minplayers", F.col("min_players")),
        _tag("maxplayers", F.col("max_players")), _tag("playingtime", F.col("playing_time")),
        _tag("minplaytime", F.col("playing_time")), _tag("minage", F.col("game_id") % 12),
        F.coalesce("links", empty), crowd,
        F.lit('<poll name="suggested_numplayers" totalvotes="'), F.coalesce("total", F.lit(0)).cast("string"),
        F.lit('">'), F.coalesce("poll", empty), F.lit("</poll><statistics><ratings>"),
        _tag("usersrated", F.col("game_id") * 2), _tag("average", F.round(F.col("avg_weight"), 3)),
        _tag("bayesaverage", F.lit("5.5")), _tag("averageweight", F.round(F.col("avg_weight"), 3)),
        _tag("numcomments", F.col("game_id") * 3), _tag("numweights", F.lit("n/a")), F.lit("<ranks>"), ranks,
        F.lit("</ranks></ratings></statistics></item>"))
    batch = F.floor(F.col("game_id") / per_page).alias("page")
    return g.groupBy(batch).agg(
        F.concat(F.lit("<items>"), F.array_join(F.array_sort(F.collect_list(item)), ""), F.lit("</items>")).alias("xml"))


def catalogue_pages(spark: SparkSession, sf: str, per_page: int = 100) -> DataFrame:
    """Catalogue pages in HTML, 100 games each in id order."""
    cell = F.concat(
        F.lit('<tr><td class="collection_thumbnail"><a href="/boardgame/'), F.col("game_id").cast("string"), F.lit("/"),
        F.replace(F.col("game"), F.lit(" "), F.lit("-")), F.lit('"><img src="https://cf.example.com/images/pic'),
        (F.col("game_id") + 100000).cast("string"), F.lit('_mt.jpg"></a></td></tr>'))
    rows = games(spark, sf).select("game_id", cell.alias("cell"))
    cells = F.transform(F.array_sort(F.collect_list(F.struct("game_id", "cell"))), lambda x: x["cell"])
    page = F.floor(F.col("game_id") / per_page).alias("page")
    return rows.groupBy(page).agg(
        F.concat(F.lit("<html><table>"), F.array_join(cells, "\n"), F.lit("</table></html>")).alias("html"))


def rating_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Rating pages in XML: 100 ratings each at most, with some blank and non-numeric fields."""
    r = ratings(spark, sf).join(users(spark, sf), "user_id").join(games(spark, sf).select("game_id", "game"), "game_id")
    pair = F.col("user_id") + F.col("game_id")
    tag = F.concat(
        F.lit('<comment username="'), F.when(pair % 11 == 0, "").otherwise(F.col("username")),
        F.lit('" rating="'), F.when(pair % 7 == 0, "N/A").otherwise(F.format_string("%.4f", "rating")),
        F.lit('" value="'), F.when(pair % 5 == 0, "").otherwise(F.concat(F.lit("says "), F.col("user_id").cast("string"))),
        F.lit('"/>'))
    page = F.floor(F.col("user_id") / 100).alias("page")
    return r.groupBy("game_id", "game", page).agg(F.array_join(F.array_sort(F.collect_list(tag)), "").alias("tags")).select(
        "game_id", "page",
        F.concat(
            F.lit('<items><item type="boardgame" id="'), F.col("game_id").cast("string"),
            F.lit('"><name type="primary" value="'), F.col("game"), F.lit('"/><comments page="1">'), F.col("tags"),
            F.lit("</comments></item></items>")).alias("xml"))


def rating_pages_v1(spark: SparkSession, sf: str) -> DataFrame:
    """Rating pages of the first interface: whole ratings, 'N/A' comments."""
    r = ratings(spark, sf).join(users(spark, sf), "user_id")
    pair = F.col("user_id") + F.col("game_id")
    tag = F.concat(
        F.lit('<comment username="'), F.col("username"), F.lit('" rating="'),
        F.when(pair % 7 == 0, "N/A").otherwise(F.floor("rating").cast("string")), F.lit('">'),
        F.when(pair % 5 == 0, "N/A").otherwise(F.concat(F.lit("says "), F.col("user_id").cast("string"))),
        F.lit("</comment>"))
    page = F.floor(F.col("user_id") / 100).alias("page")
    return r.groupBy("game_id", page).agg(F.array_join(F.array_sort(F.collect_list(tag)), "").alias("tags")).select(
        "game_id", "page",
        F.concat(
            F.lit('<boardgames><boardgame objectid="'), F.col("game_id").cast("string"), F.lit('">'), F.col("tags"),
            F.lit("</boardgame></boardgames>")).alias("xml"))


def user_pages(spark: SparkSession, sf: str) -> DataFrame:
    """User payloads in XML; every tenth one names no id."""
    key = F.col("user_id")
    return users(spark, sf).select(
        "username",
        F.when(key % 10 == 9, F.lit("<user><error/></user>")).otherwise(
            F.concat(F.lit('<user id="'), key.cast("string"), F.lit('" name="'), F.col("username"), F.lit('"><x/></user>'))
        ).alias("xml"))


def lemmas(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary by rule: words of the corpus on -ing lose the ending."""
    from ludoscope.functions.text import tokens

    words = docs(spark, sf).select(F.explode(tokens(F.lower("text"))).alias("token")).distinct()
    long = words.where(F.col("token").rlike("^[a-z]{3,}ing$"))
    return long.select("token", F.regexp_replace("token", "ing$", "").alias("lemma"))


def links(spark: SparkSession, sf: str) -> DataFrame:
    """Feed links: every page seen twice in a day by its source, then once more the next day."""
    page = pages(spark, sf).select("page_id", "url", "html")
    source = F.when(F.col("page_id") % 4 == 0, "vox").otherwise(F.concat(F.lit("src"), (F.col("page_id") % 4).cast("string")))
    day = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") % 3600)
    first = page.select("page_id", "url", "html", source.alias("source"), day.alias("ts"))
    again = first.withColumn("ts", F.col("ts") + F.expr("interval 1 hour"))
    later = first.where(F.col("page_id") % 2 == 0).withColumn("ts", F.col("ts") + F.expr("interval 24 hours"))
    return first.unionByName(again).unionByName(later)
