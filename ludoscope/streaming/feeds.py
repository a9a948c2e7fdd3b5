"""Structured Streaming ingest of articles and ratings (inventory W1-W4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ludoscope.functions.scale import first_per_key
from ludoscope.schemas import ARTICLES
from ludoscope.sources.landed import parse_article

# The one source whose feed covers more than its topic, and the mark of the links kept.
MIXED_SOURCE, MIXED_MARK = "vox", "politics"


#: Days for which the stream itself knows what it has seen, and where Spark keeps that.
HORIZON_DAYS = 7
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Parts of a batch of ratings, by a hash of the game.
RATING_BUCKETS = 64
#: Ratings of a batch to a file of the store, about; a bucket with more is dealt out to several tasks by game.
FILE_ROWS = 1_000_000
#: So many known games of a batch are sent to all tasks, to leave the store's other games where they lie.
FEW_GAMES = 100_000


def _bucket(game: str) -> Column:
    return F.pmod(F.xxhash64(game), F.lit(RATING_BUCKETS)).cast("int")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def feed_link_filter(links: DataFrame, source: str = "source", url: str = "url") -> DataFrame:
    """From the mixed source only links with the mark, from the others all."""
    return links.where((F.col(source) != MIXED_SOURCE) | F.col(url).contains(MIXED_MARK))


def without_known(articles: DataFrame, stored: DataFrame) -> DataFrame:
    """Articles whose link is not in the store yet."""
    return articles.join(stored.select("url").distinct(), "url", "left_anti")


def first_links(links: DataFrame, ts: str = "ts") -> DataFrame:
    """The earliest row of each (source, day, url)."""
    keys = ["source", "day", "url"]
    dated = links.withColumn("day", F.to_date(ts))
    return first_per_key(dated, keys, F.col(ts), [c for c in dated.columns if c not in keys])


def articles_from(links: DataFrame, ts: str = "ts", now: Column | None = None) -> DataFrame:
    """Articles of the feeds' links, each link once per source and day."""
    fresh = first_links(feed_link_filter(links), ts)
    return parse_article(fresh, F.col("source"), now if now is not None else F.col(ts), keep=["day"])


def _stored_keys(spark: SparkSession, out: str, batch_id: int, first: object, last: object) -> DataFrame:
    """(source, day, url) that earlier batches have stored for some days."""
    seen = spark.read.schema("source string, url string, batch long, day date").parquet(out)
    stored = seen.where((F.col("batch") < batch_id) & F.col("day").between(F.lit(first), F.lit(last)))
    return stored.select("source", "day", "url")


def load_articles_batch(batch: DataFrame, batch_id: int, out: str, ts: str = "ts", horizon_days: int | None = None) -> None:
    """W1, one batch: links no earlier batch has stored for their source and day, parsed and stored.

    Each batch owns one folder and overwrites it, so doing it again after a failure adds nothing
    twice. With ``horizon_days`` the batch holds no link that came in the last days, so the store is asked only for links of
    older days, and for those of days to come. Folders hold one part per day, and of the store only days between the
    first and the last of those links are read. A batch without any reads nothing of the store.
    """
    keys = ["source", "day", "url"]
    dated = feed_link_filter(batch).withColumn("day", F.to_date(ts))
    known = F.lit(True)
    if horizon_days is not None:
        today = F.current_date()
        known = F.coalesce((F.col("day") <= F.date_sub(today, horizon_days - 1)) | (F.col("day") > today), F.lit(False))
    dated = dated.withColumn("_late", known).persist()
    late = dated.where("_late")
    days = late.agg(F.min("day"), F.max("day")).first()
    fresh = dated
    if days[0] is not None:
        stored = _stored_keys(batch.sparkSession, out, batch_id, *days)
        stored = stored.join(late.select(*keys).distinct(), keys, "left_semi")
        fresh = dated.where("not _late").unionByName(late.join(stored, keys, "left_anti"))
    articles_from(fresh.drop("day", "_late"), ts).write.mode("overwrite").partitionBy("day").parquet(f"{out}/batch={batch_id}")
    dated.unpersist()


def stream_articles(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    ts: str = "ts",
    every: str | None = None,
    horizon_days: int = HORIZON_DAYS,
) -> StreamingQuery:
    """Append the articles of newly landed feed files; stop when done, or poll at ``every``.

    What was seen in the last ``horizon_days`` days, by the time of arrival, is the stream's state, which Spark keeps in
    RocksDB beside the checkpoint and forgets after that. The time of arrival never runs backwards, so no link is late for the
    state. One of a day so old that its state may be gone is looked up in the store instead, so a link that lands late
    is neither lost nor stored twice. Of equal links of one batch any counts.
    """
    nothing = spark.createDataFrame([], StructType([*ARTICLES.fields]).add("day", "date"))
    nothing.write.mode("ignore").partitionBy("day").parquet(f"{out}/batch=-1")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    links = feed_link_filter(spark.readStream.schema(schema).parquet(landing)).withColumn("_day", F.to_date(ts))
    arrived = links.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", f"{horizon_days} days")
    unseen = arrived.dropDuplicatesWithinWatermark(["source", "_day", "url"]).drop("_arrived", "_day")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        unseen.writeStream.foreachBatch(lambda df, batch_id: load_articles_batch(df, batch_id, out, ts, horizon_days))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def compact_articles(spark: SparkSession, out: str) -> int:
    """Put the folders of all batches but the last in one, with one part per day; the number of folders it took.

    For a store whose stream is stopped and that nobody reads meanwhile. The last batch stays, as the stream may have to do it again. The
    new folder is complete before an old one goes, and a compaction that was cut short is ended by the next one.
    """
    fs, place = _file_system(spark, out)
    draft, done = f"{out}/_compact", f"{out}/_compact_done"

    def numbers() -> list[int]:
        return sorted(int(s.getPath().getName()[6:]) for s in fs.listStatus(place) if s.getPath().getName().startswith("batch="))

    def finish(last: int) -> None:
        for n in [n for n in numbers() if n <= last]:
            fs.delete(_file_system(spark, f"{out}/batch={n}")[1], True)
        fs.rename(_file_system(spark, draft)[1], _file_system(spark, f"{out}/batch={last}")[1])
        fs.delete(_file_system(spark, done)[1], True)

    if fs.exists(_file_system(spark, done)[1]):
        marks = [s.getPath().getName() for s in fs.listStatus(_file_system(spark, done)[1])]
        if fs.exists(_file_system(spark, draft)[1]):
            finish(int(marks[0]))
        else:
            fs.delete(_file_system(spark, done)[1], True)
    found = numbers()[:-1]
    if len(found) < 2:
        return 0
    rows = spark.read.schema(StructType([*ARTICLES.fields]).add("batch", "long").add("day", "date")).parquet(out)
    rows.where(F.col("batch") <= found[-1]).drop("batch").repartition("day").write.mode("overwrite").partitionBy("day").parquet(draft)
    fs.mkdirs(_file_system(spark, f"{done}/{found[-1]}")[1])
    finish(found[-1])
    return len(found)


def read_articles(spark: SparkSession, out: str) -> DataFrame:
    """The stored articles."""
    return spark.read.schema(
        StructType([*ARTICLES.fields]).add("batch", "long").add("day", "date")
    ).parquet(out).drop("batch")


def load_ratings_batch(
    batch: DataFrame, batch_id: int, raw_users: DataFrame, store: str, directory: str
) -> None:
    """W4, one batch: ratings whose game and user are not in the store, and new names to the user directory.

    Pages of one game may land in different batches, so a game that is known does not make its later pages known.

    Which games are known is a table of its own beside the store (``.games``), with a row per game. Only if the batch has games
    that are in it is the store read, and of the store only the buckets of those games; a batch of new games reads nothing of it.

    Rows are moved twice: by name, to get their user's id, and by bucket, where those that are stored are met and the others
    are written. The batch is read twice, first for its games only, so it has to be the same each time.

    Each batch owns one folder of either table and overwrites it, so doing a batch again after a
    failure gives the same tables. Its own folder is left out when asking what is loaded.
    """
    spark = batch.sparkSession

    def earlier(path: str, schema: str) -> DataFrame:
        folders = spark.read.schema(f"{schema}, batch long").parquet(path)
        return folders.where(F.col("batch") < batch_id).drop("batch")

    listed = earlier(f"{store}.games", "game string").distinct().withColumn("_again", F.lit(True))
    games = batch.groupBy("game").agg(F.count(F.lit(1)).alias("n")).join(listed, "game", "left").persist()
    again = games.where("_again").select("game")
    held = games.groupBy(_bucket("game").alias("b")).agg(F.count_if("_again").alias("again"), F.sum("n").alias("n")).collect()
    buckets = [r["b"] for r in held if r["again"]]
    parts = 1 + sum(r["n"] for r in held) // (RATING_BUCKETS * FILE_ROWS)

    known = earlier(directory, "user_id long, username string")
    answers = raw_users.groupBy("username").agg(F.min("user_id").alias("user_id"))
    new = answers.join(known, "username", "left_anti").select("user_id", "username").persist()
    # Names are few beside ratings, and a hash of them spares sorting the ratings.
    names = known.unionByName(new).hint("shuffle_hash")
    resolved = batch.join(names, "username", "left").select(
        "game", "game_id", "user_id", "username", "rating", "comment"
    )
    loaded = None
    if buckets:
        # Only the parts of the store that hold the batch's known games. A null game is never known.
        loaded = earlier(store, "game string, username string, bucket int").where(F.col("bucket").isin(buckets) & F.col("game").isNotNull())
        if sum(r["again"] for r in held) <= FEW_GAMES:
            loaded = loaded.join(F.broadcast(again), "game", "left_semi")
    fresh = _by_bucket(resolved, loaded, parts)
    # A game is listed before its ratings are stored.
    games.where("_again IS NULL").select("game").write.mode("overwrite").parquet(f"{store}.games/batch={batch_id}")
    fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/batch={batch_id}")
    # Of the new names those that the stored rows have.
    used = spark.read.schema("user_id long, username string").parquet(f"{store}/batch={batch_id}").select("user_id", "username")
    added = new.limit(0) if new.isEmpty() else used.join(new.select("username"), "username", "left_semi").distinct()
    added.write.mode("overwrite").parquet(f"{directory}/batch={batch_id}")
    new.unpersist()
    games.unpersist()


def _by_bucket(rows: DataFrame, loaded: DataFrame | None, parts: int) -> DataFrame:
    """Rows whose game and name are not among the loaded ones, each bucket in ``parts`` tasks of its own.

    Both meet in the one shuffle that the write by bucket needs anyway, which a join by game and name could not use.
    """
    if loaded is not None:
        rows = rows.withColumn("_stored", F.lit(False)).unionByName(loaded.drop("bucket").withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    part = F.pmod(F.shiftright(F.xxhash64("game"), RATING_BUCKETS.bit_length() - 1), F.lit(parts)).cast("int")
    rows = rows.withColumn("bucket", _bucket("game")).withColumn("_task", F.col("bucket") * parts + part)
    rows = rows.repartitionById(RATING_BUCKETS * parts, "_task")
    if loaded is not None:
        # The hash comes first, as it is compared faster than texts.
        same = Window.partitionBy("_hash", "_task", "game", "username")
        rows = rows.withColumn("_hash", F.xxhash64("game", "username")).withColumn("_known", F.max("_stored").over(same))
        rows = rows.where(~F.col("_known")).drop("_stored", "_hash", "_known")
    return rows.drop("_task")


def stream_ratings(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    raw_users: DataFrame,
    users: DataFrame,
    store: str,
    directory: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Append newly landed rating pages, skipping ratings that are loaded, and extend the directory.

    Batch -1 of both tables holds what was known before the stream began.
    """
    empty = spark.createDataFrame(
        [], "game string, game_id string, user_id long, username string, rating double, comment string"
    )
    empty.withColumn("bucket", F.lit(0)).write.mode("ignore").partitionBy("bucket").parquet(f"{store}/batch=-1")
    empty.select("game").write.mode("ignore").parquet(f"{store}.games/batch=-1")
    users.select(F.col("user_id").cast("long").alias("user_id"), "username").write.mode("ignore").parquet(
        f"{directory}/batch=-1"
    )
    pages = spark.readStream.schema(schema).parquet(landing)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        pages.writeStream.foreachBatch(
            lambda df, batch_id: load_ratings_batch(df, batch_id, raw_users, store, directory)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
