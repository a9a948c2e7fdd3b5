"""Schemas of the tables the library works on."""

from __future__ import annotations

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("game_id", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
])

# As landed: ids and ratings may be text, and any field may be missing.
RATING_DOCS = T.StructType([
    T.StructField("game", T.StringType()),
    T.StructField("game_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("comment", T.StringType()),
])

GAMES = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("game", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("kickstarter", T.StringType()),
    T.StructField("min_players", T.IntegerType()),
    T.StructField("max_players", T.IntegerType()),
    T.StructField("min_playtime", T.IntegerType()),
    T.StructField("playing_time", T.IntegerType()),
    T.StructField("min_age", T.IntegerType()),
    T.StructField("best_num_players", T.IntegerType()),
    T.StructField("bnp_total_votes", T.IntegerType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("bayesavg_rating", T.DoubleType()),
    T.StructField("avg_weight", T.DoubleType()),
    T.StructField("num_comments", T.IntegerType()),
    T.StructField("num_weights", T.IntegerType()),
    T.StructField("users_rated", T.IntegerType()),
    T.StructField("year_published", T.IntegerType()),
    T.StructField("rank", T.IntegerType()),
])

# One <items> payload of the statistics feed.
ITEMS_XML = """item array<struct<
  _id:string, image:string, description:string,
  yearpublished:struct<_value:string>, minplayers:struct<_value:string>, maxplayers:struct<_value:string>,
  playingtime:struct<_value:string>, minplaytime:struct<_value:string>, minage:struct<_value:string>,
  link:array<struct<_type:string,_id:string,_value:string>>,
  poll:array<struct<_name:string,_totalvotes:string,
    results:array<struct<_numplayers:string,result:array<struct<_value:string,_numvotes:string>>>>>>,
  statistics:struct<ratings:struct<
    usersrated:struct<_value:string>, average:struct<_value:string>, bayesaverage:struct<_value:string>,
    averageweight:struct<_value:string>, numcomments:struct<_value:string>, numweights:struct<_value:string>,
    ranks:struct<rank:array<struct<_friendlyname:string,_id:string,_value:string>>>>>>>,
  _corrupt string"""

COMMENTS_XML = """item struct<
  _id:string, name:array<struct<_type:string,_value:string>>,
  comments:struct<comment:array<struct<_username:string,_rating:string,_value:string>>>>,
  _corrupt string"""

COMMENTS_V1_XML = """boardgame struct<
  _objectid:string, name:string,
  comment:array<struct<_username:string,_rating:string,_VALUE:string>>>,
  _corrupt string"""

ARTICLES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("date_published", T.TimestampType()),
    T.StructField("author", T.ArrayType(T.StringType())),
    T.StructField("article_text", T.StringType()),
])
