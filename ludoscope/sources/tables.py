"""Reading and writing the catalogue's tables (inventory S1-S13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ludoscope.functions.scale import with_position
from ludoscope import schemas


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ratings from headed CSV files; rows without a rating are dropped, ids become int."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.RATINGS])
    return as_ratings(spark.read.csv(path, header=True, schema=text))


def read_ratings_docs(spark: SparkSession, path: str, fmt: str = "json", **options: str) -> DataFrame:
    """Ratings from stored documents. ``fmt`` may be any Spark source, such as a document store's."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "json":
        reader = reader.schema(schemas.RATING_DOCS)
    return as_ratings(reader.load(path))


def as_ratings(df: DataFrame) -> DataFrame:
    """The three rating columns with one id type; values that do not convert become null, null ratings go."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.RATINGS]
    ).where(F.col("rating").isNotNull())


def read_games(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """S3: game records with the fixed core schema."""
    reader = spark.read.format(fmt)
    return (reader.schema(schemas.GAMES) if fmt == "json" else reader).load(path)


def read_game_records(spark: SparkSession, path: str) -> DataFrame:
    """S3: game records of any fields, one JSON object per line: (game_id, record), the record as a variant.

    No schema is needed, so a field nobody has seen before loads like any other. A line that is no JSON has a null record.
    """
    record = F.try_parse_json("value")
    return spark.read.text(path).select(F.try_variant_get(record, "$.game_id", "bigint").alias("game_id"), record.alias("record"))


def record_field(field: str, kind: str = "string", record: str = "record") -> Column:
    """S3: one top-level field of a record as a type; null where it is missing or does not convert. A name may hold one kind of quotes."""
    quote = next((q for q in "'\"" if q not in field), None)
    if quote is None:
        raise ValueError("a path cannot name a field with both kinds of quotes")
    return F.try_variant_get(F.col(record), f"$[{quote}{field}{quote}]", kind)


def record_schema(records: DataFrame) -> DataFrame:
    """S3: one row (schema): the type that holds every record there is, found from the data."""
    return records.agg(F.schema_of_variant_agg("record").alias("schema"))


def record_fields(records: DataFrame) -> DataFrame:
    """S3: (field, type, n): every top-level field of the records, its type and how many hold it. A field of several types has several rows."""
    members = F.from_json(F.to_json("record"), "map<string,variant>")
    return records.select(F.explode(members).alias("field", "v")).groupBy("field", F.schema_of_variant("v").alias("type")).agg(F.count(F.lit(1)).alias("n"))


def record_attributes(records: DataFrame, kinds: Sequence[str] = ("mechanic", "category")) -> DataFrame:
    """S3: (game_id, kind, name) of the fields ``<name>_<kind>`` that are true, whatever names there are."""
    members = F.from_json(F.to_json("record"), "map<string,variant>")
    fields = records.select("game_id", F.explode(members).alias("field", "v")).where(F.try_variant_get("v", "$", "boolean"))
    kind = F.coalesce(*[F.when(F.col("field").endswith(f"_{k}"), F.lit(k)) for k in kinds])
    return fields.withColumn("kind", kind).where("kind IS NOT NULL").select(
        "game_id", "kind", F.expr("left(field, length(field) - length(kind) - 1)").alias("name")).distinct()


def read_descriptions(games: DataFrame) -> DataFrame:
    """The description column as a corpus; the id is carried, row order is never relied on."""
    return games.select(F.col("game_id").alias("doc_id"), F.col("description").alias("text"))


def read_game_list(spark: SparkSession, path: str) -> DataFrame:
    """The id to name lookup table."""
    return spark.read.parquet(path).select("game_id", "game")


def name_games(df: DataFrame, game_list: DataFrame) -> DataFrame:
    """Put the listed name on each row; unknown ids keep a null name."""
    return df.join(game_list, "game_id", "left")


def append_records(df: DataFrame, path: str) -> None:
    """Add rows to a stored table."""
    df.write.mode("append").parquet(path)


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Insert or update by key, field by field.

    Every column of ``updates`` replaces the stored value, nulls too; columns it lacks stay as they
    are, and new columns are null on rows it does not name. ``updates`` holds one row per key.
    """
    old = set(target.columns)
    new = [c for c in updates.columns if c != key]
    both = target.withColumnsRenamed({c: f"_old_{c}" for c in old if c != key}).join(
        updates.withColumn("_set", F.lit(True)), key, "full_outer"
    )
    columns: list[Column] = [F.col(key)]
    for name in [c for c in target.columns if c != key]:
        stored = F.col(f"_old_{name}")
        columns.append((F.when(F.col("_set"), F.col(name)).otherwise(stored) if name in new else stored).alias(name))
    columns += [F.col(c) for c in new if c not in old]
    return both.select(*columns)


def update_where(target: DataFrame, mapping: DataFrame, key: str, col: str) -> DataFrame:
    """Set ``col`` on every row whose key the mapping ``(key, col)`` names."""
    if col not in target.columns:
        target = target.withColumn(col, F.lit(None).cast(mapping.schema[col].dataType))
    found = mapping.select(key, F.col(col).alias("_new"))
    return (
        target.join(found, key, "left")
        .withColumn(col, F.coalesce("_new", col))
        .select(*target.columns)
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The different values of one column."""
    return df.select(col).distinct()


def lookup_user(users: DataFrame, username: str) -> DataFrame:
    """The user of that name, at most one row; an unknown name gives no row and no error."""
    return users.where(F.col("username") == username).orderBy("user_id").limit(1).select("user_id", "username")


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Keep an intermediate table, replacing an earlier one."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """Read it back."""
    return spark.read.parquet(path)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows drawn by the digest of their key, so the draw does not depend on partitioning."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    drawn = df.withColumn("_draw", draw)
    total = df.count()
    # A little more than the share of digests that n rows need; if chance has it that they are fewer, all rows are numbered.
    share = (n + 8 * n**0.5 + 16) / max(total, 1)
    if share < 1:
        near = drawn.where(F.col("_draw") < F.lit(f"{int(share * (1 << 60)):015x}"))
        drawn = near if near.count() >= n else drawn
    placed = with_position(drawn, [F.col("_draw"), *[F.col(k) for k in keys]], "_place")
    return placed.where(F.col("_place") <= n).drop("_draw", "_place")
