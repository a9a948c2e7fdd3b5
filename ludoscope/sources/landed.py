"""From landed payloads (XML, HTML) to tables (inventory I1-I17).

Every function takes a table of payloads and stays inside Catalyst: one payload row is parsed where
it lies, and a payload that does not parse is kept aside by ``split_rejects`` instead of failing the job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

from ludoscope import schemas
from ludoscope.functions.scale import with_position
from ludoscope.functions.text import clean_description, title_words
from ludoscope.session import stored

XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _xml(df: DataFrame, col: str, schema: str, row_tag: str) -> DataFrame:
    options = {**XML_OPTIONS, "rowTag": row_tag}
    return df.withColumn("_doc", F.from_xml(F.col(col), schema, options))


def _int(col: Column) -> Column:
    return col.try_cast("int")


def _double(col: Column) -> Column:
    return col.try_cast("double")


def _blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def parse_items(payloads: DataFrame, col: str = "xml") -> DataFrame:
    """One row per item of the statistics payloads, scalars cast, lists kept nested."""
    item = F.explode("_doc.item").alias("i")
    rows = _xml(payloads, col, schemas.ITEMS_XML, "items").select(item)
    r = "i.statistics.ratings."
    return rows.select(
        F.col("i._id").try_cast("long").alias("game_id"),
        F.col("i.image").alias("image"),
        clean_description(F.col("i.description")).alias("description"),
        _int(F.col("i.minplayers._value")).alias("min_players"),
        _int(F.col("i.maxplayers._value")).alias("max_players"),
        _int(F.col("i.minplaytime._value")).alias("min_playtime"),
        _int(F.col("i.playingtime._value")).alias("playing_time"),
        _int(F.col("i.minage._value")).alias("min_age"),
        _int(F.col("i.yearpublished._value")).alias("year_published"),
        _double(F.col(r + "average._value")).alias("avg_rating"),
        _double(F.col(r + "bayesaverage._value")).alias("bayesavg_rating"),
        _double(F.col(r + "averageweight._value")).alias("avg_weight"),
        _int(F.col(r + "numcomments._value")).alias("num_comments"),
        _int(F.col(r + "numweights._value")).alias("num_weights"),
        _int(F.col(r + "usersrated._value")).alias("users_rated"),
        F.col("i.link").alias("link"),
        F.get("i.poll", F.lit(0)).alias("poll"),
        F.col(r + "ranks.rank").alias("ranks"),
    )


def links_of_type(link: Column, kind: str, empty_to_null: bool = True) -> Column:
    """The (id, name) pairs of one link type; an empty list becomes null unless told otherwise."""
    pairs = F.transform(
        F.filter(F.coalesce(link, F.array()), lambda x: x["_type"] == kind),
        lambda x: F.struct(x["_id"].alias("id"), x["_value"].alias("name")),
    )
    return F.when(F.size(pairs) > 0, pairs) if empty_to_null else pairs


def flag_link(link: Column, link_id: str, kind: str, value: str) -> Column:
    """I3: 'yes' when exactly this link is present, else 'no'."""
    same = F.exists(
        F.coalesce(link, F.array()),
        lambda x: (x["_id"] == link_id) & (x["_type"] == kind) & (x["_value"] == value),
    )
    return F.when(same, "yes").otherwise("no")


def poll_votes(poll: Column) -> Column:
    """I4: (numplayers, votes for "best") per option; options without either are left out."""
    whole = F.filter(
        F.coalesce(poll["results"], F.array()),
        lambda r: r["_numplayers"].isNotNull() & (F.size(r["result"]) > 0),
    )
    return F.transform(
        whole,
        lambda r: F.struct(
            r["_numplayers"].alias("numplayers"),
            _int(F.get(r["result"], F.lit(0))["_numvotes"]).alias("votes"),
        ),
    )


def poll_winner(poll: Column) -> Column:
    """I4: the option with the most votes as a number ("4+" gives 4); the first one wins a tie."""
    ranked = F.transform(
        poll_votes(poll),
        lambda v, i: F.struct(v["votes"].alias("votes"), (-i).alias("place"), v["numplayers"].alias("option")),
    )
    best = F.array_max(F.filter(ranked, lambda v: v["votes"].isNotNull()))
    return _int(F.regexp_extract(best["option"], r"^(\d+)", 1))


def normalize_ranks(ranks: Column) -> Column:
    """Always an array of (name, id, rank); "Not Ranked" and other text become null ranks."""
    return F.transform(
        F.coalesce(ranks, F.array()),
        lambda r: F.struct(
            r["_friendlyname"].alias("name"), r["_id"].alias("id"), _int(r["_value"]).alias("rank")
        ),
    )


def game_stats(payloads: DataFrame, game_list: DataFrame, col: str = "xml") -> DataFrame:
    """I1-I5 together: the statistics table, named from the game list."""
    items = parse_items(payloads, col)
    return items.join(game_list.select("game_id", "game"), "game_id", "left").select(
        "game",
        *[c for c in items.columns if c not in ("link", "poll", "ranks")],
        links_of_type(F.col("link"), "boardgamecategory").alias("categories"),
        links_of_type(F.col("link"), "boardgamemechanic").alias("mechanics"),
        links_of_type(F.col("link"), "boardgamedesigner", empty_to_null=False).alias("designer"),
        flag_link(F.col("link"), "8374", "boardgamefamily", "Crowdfunding: Kickstarter").alias("kickstarter"),
        poll_winner(F.col("poll")).alias("best_num_players"),
        _int(F.col("poll._totalvotes")).alias("bnp_total_votes"),
        normalize_ranks(F.col("ranks")).alias("rankings"),
    )


def attrs_from_stats(stats: DataFrame) -> DataFrame:
    """I2 -> long attributes: (game_id, kind, name), the form every content operator works on."""
    lists = F.array(
        F.struct(F.lit("mechanic").alias("kind"), F.col("mechanics").alias("pairs")),
        F.struct(F.lit("category").alias("kind"), F.col("categories").alias("pairs")),
    )
    kinds = stats.select("game_id", F.inline(lists))
    return kinds.select("game_id", "kind", F.explode("pairs.name").alias("name")).distinct()


def ranks_to_columns(stats: DataFrame, names: list[str], ranks: str = "rankings") -> DataFrame:
    """One column per ranking name; a game without that rank holds null."""
    long = stats.select("game_id", F.inline_outer(ranks).alias("name", "id", "rank"))
    return long.groupBy("game_id").pivot("name", names).agg(F.max("rank"))


def parse_rating_comments(payloads: DataFrame, col: str = "xml") -> DataFrame:
    """Comment tags of the second interface; blank fields and ratings that are no number are null."""
    docs = _xml(payloads, col, schemas.COMMENTS_XML, "items").select("_doc.item")
    rows = docs.select(
        F.get("item.name", F.lit(0))["_value"].alias("game"),
        F.col("item._id").alias("game_id"),
        F.explode("item.comments.comment").alias("c"),
    )
    return rows.select(
        "game",
        "game_id",
        _blank_to_null(F.col("c._username")).alias("username"),
        _double(F.col("c._rating")).alias("rating"),
        _blank_to_null(F.col("c._value")).alias("comment"),
    )


def parse_comments_v1(payloads: DataFrame, game_list: DataFrame, col: str = "xml") -> DataFrame:
    """I8: comment tags of the first interface: whole ratings only, comments 'N/A' left out."""
    docs = _xml(payloads, col, schemas.COMMENTS_V1_XML, "boardgames").select("_doc.boardgame")
    rows = docs.select(F.col("boardgame._objectid").alias("game_id"), F.explode("boardgame.comment").alias("c"))
    text = F.col("c._VALUE")
    kept = rows.where(text.isNull() | (text != "N/A"))
    names = game_list.select(F.col("game_id").cast("string").alias("game_id"), "game")
    return kept.join(names, "game_id", "left").select(
        "game",
        "game_id",
        F.col("c._username").alias("username"),
        _int(F.col("c._rating")).alias("rating"),
        text.alias("comment"),
    )


def parse_user_xml(payloads: DataFrame, col: str = "xml") -> tuple[DataFrame, DataFrame]:
    """(users, failures): the id in each user payload by username; payloads without one apart."""
    found = _xml(payloads, col, "_id string, _name string, _corrupt string", "user").select(
        "username", F.col("_doc._id").try_cast("long").alias("user_id")
    )
    good = F.col("user_id").isNotNull()
    return found.where(good), found.where(~good).select("username")


# A catalogue entry: a cell of this class, the link to /<type>/<id>/<slug> in it, and perhaps a picture.
_CELL = r'(?s)class="collection_thumbnail"(.*?)(?=class="collection_thumbnail"|</td>|$)'
_LINK = r'href="/[^/"]*/(\d+)/([^"/]*)"'
_PICTURE = r'src="[^"]*/pic([^"/]*?)_mt\.jpg"'


def _cells(html: Column) -> Column:
    """The cells of a page, each looked at by itself: (id, slug, picture), null where a cell has none."""

    def part(cell: Column, pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(cell, pattern, group), F.lit(""))

    return F.transform(F.regexp_extract_all(html, F.lit(_CELL), 1), lambda cell: F.struct(
        part(cell, _LINK, 1).alias("id"), F.when(part(cell, _LINK, 1).isNotNull(), F.regexp_extract(cell, _LINK, 2)).alias("slug"),
        part(cell, _PICTURE, 1).alias("picture")))


def extract_game_links(pages: DataFrame, page: str = "page", col: str = "html") -> DataFrame:
    """(game_id, game, rank) from catalogue pages; the rank is the place over all pages."""
    cells = pages.select(page, F.posexplode(_cells(F.col(col))).alias("pos", "m")).where("m.id is not null")
    listed = cells.select(
        page,
        "pos",
        F.col("m.id").try_cast("long").alias("game_id"),
        title_words(F.col("m.slug")).alias("game"),
    )
    return with_position(listed, [F.col(page), F.col("pos")], "rank").select("game_id", "game", "rank")


def extract_thumbnails(pages: DataFrame, col: str = "html") -> DataFrame:
    """(game_id, slug, picture_id) from the cells of catalogue pages; no picture gives a null."""
    cells = pages.select(F.inline(_cells(F.col(col)))).where("id is not null")
    return cells.select(F.col("id").alias("game_id"), "slug", F.col("picture").alias("picture_id"))


# Where the pictures lie and how their sizes are named.
IMAGE_URL = "https://cf.geekdo-images.com/images/pic"
IMAGE_SUFFIX = {"small": "_t.jpg", "medium": "_md.jpg"}


def image_links(thumbnails: DataFrame, size: str) -> DataFrame:
    """The address of each picture in one size."""
    url = F.concat(F.lit(IMAGE_URL), "picture_id", F.lit(IMAGE_SUFFIX[size]))
    return thumbnails.select("game_id", url.alias("url"))


def batch_ids(games: DataFrame, order: str, n: int = 100) -> DataFrame:
    """The ids in their order, cut in lists of at most ``n``."""
    placed = with_position(games.select("game_id", order), [F.col(order), F.col("game_id")], "_place", start=0)
    batch = F.floor(F.col("_place") / n).alias("batch")
    pairs = F.array_sort(F.collect_list(F.struct("_place", "game_id")))
    return placed.groupBy(batch).agg(F.transform(pairs, lambda p: p["game_id"]).alias("ids"))


def split_rejects(payloads: DataFrame, schema: str, row_tag: str, col: str = "xml") -> tuple[DataFrame, DataFrame]:
    """(readable, rejected) payloads; the rejected ones keep their keys for another try.

    Payloads are parsed once and stored with what came of it, so either part reads the columns it is asked for.
    """
    parsed = _xml(payloads, col, schema, row_tag).select(*payloads.columns, "_doc._corrupt", F.col("_doc").isNull().alias("_none"))
    bad = F.col("_none") | F.col("_corrupt").isNotNull()
    judged = stored(parsed.select(*payloads.columns, bad.alias("_bad")), "payloads")
    return judged.where(~F.col("_bad")).drop("_bad"), judged.where("_bad").drop("_bad")


def skip_loaded_games(new: DataFrame, loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fresh, old) rows by whether their game is in the store."""
    games = loaded.select("game").distinct()
    return new.join(games, "game", "left_anti"), new.join(games, "game", "left_semi")


def resolve_user_ids(comments: DataFrame, users: DataFrame, raw_users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I16: (comments with user_id, extended dictionary).

    The dictionary answers first; names it lacks are looked up among the parsed user payloads.
    """
    fresh = raw_users.groupBy("username").agg(F.min("user_id").alias("user_id"))
    fresh = fresh.join(users, "username", "left_anti").join(comments.select("username"), "username", "left_semi")
    directory = users.select("user_id", "username").unionByName(fresh.select("user_id", "username"))
    return comments.join(directory, "username", "left"), directory


def unescape_html(text: Column) -> Column:
    """Character references resolved once: the names of HTML 4 and ``apos``, decimal and hexadecimal numbers; unknown ones stay."""
    names = F.map_from_arrays(F.array(*[F.lit(n) for n in _NAMES]), F.array(*[F.lit(c) for c in _NAMES.values()]))

    def resolved(part: Column) -> Column:
        end = F.locate(";", part)
        name = F.substring(part, F.lit(2), end - 2)
        digits = F.regexp_extract(part, r"^&#([0-9]{1,7});", 1)
        hexes = F.regexp_extract(part, r"^&#[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.when(digits != "", digits.cast("int")).when(hexes != "", F.conv(hexes, 16, 10).cast("int"))
        whole = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        # The code's four bytes, read as UTF-32.
        sign = F.coalesce(F.when(whole, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")), F.element_at(names, name))
        return F.when(part.startswith("&") & (end > 2) & sign.isNotNull(), F.concat(sign, F.substr(part, end + 1))).otherwise(part)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "(?=&)"), resolved), "")).otherwise(text)


#: From the standard library, so that the table is not written out here.
_NAMES = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}


def html_text(html: Column) -> Column:
    """The readable text of an HTML fragment: no scripts, no tags, entities resolved, blanks collapsed."""
    html = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    text = F.replace(unescape_html(F.regexp_replace(html, r"<[^>]*>", " ")), F.lit("\u00a0"), F.lit(" "))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def first_article(html: Column) -> Column:
    """What stands inside the first article element, others nested in it included; empty without one, all to the end if it stays open."""
    parts = F.split(html, r"(?i)(?=</?article\b)")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.lit(False).alias("done"))

    def step(state: Column, part: Column) -> Column:
        opens, closes = part.rlike(r"(?i)^<article\b"), part.rlike(r"(?i)^</article\b")
        depth = state["depth"] + F.when(opens, 1).when(closes & (state["depth"] > 0), -1).otherwise(0)
        done = state["done"] | (closes & (state["depth"] == 1))
        behind = F.regexp_replace(part, r"(?i)^</?article\b[^>]*>", "")
        text = F.when(state["done"] | (depth == 0), state["text"]).otherwise(F.concat(state["text"], F.lit(" "), behind))
        return F.struct(depth.alias("depth"), text.alias("text"), done.alias("done"))

    return F.aggregate(parts, start, step)["text"]


def meta_contents(html: Column, names: Sequence[str]) -> Column:
    """The contents of the meta elements whose name or property is one of ``names``, whatever the order of attributes and the quotes."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), 0)
    wanted = "|".join(re.escape(n) for n in names)
    mine = F.filter(tags, lambda t: t.rlike(rf"(?is)\s(?:name|property|itemprop)\s*=\s*[\"']?(?:{wanted})[\"'\s/>]"))
    content = r"(?is)\scontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
    found = F.transform(mine, lambda t: F.trim(unescape_html(F.concat(F.regexp_extract(t, content, 1), F.regexp_extract(t, content, 2)))))
    return F.filter(found, lambda x: x != "")


def parse_article(
    pages: DataFrame,
    source: Column,
    now: Column | None = None,
    url: str = "url",
    col: str = "html",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Article records; pages without a title or text are dropped, a missing date becomes ``now``.

    ``keep`` names columns of ``pages`` to carry along.
    """
    html = F.col(col)
    body = html_text(first_article(html))
    authors = meta_contents(html, ["author", "article:author"])
    date = F.get(meta_contents(html, ["article:published_time"]), 0)
    parsed = pages.where(html.isNotNull() & (html != "")).select(
        F.col(url).alias("url"),
        source.alias("source"),
        html_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("headline"),
        F.coalesce(date.try_cast("timestamp"), now if now is not None else F.current_timestamp()).alias(
            "date_published"
        ),
        authors.alias("author"),
        body.alias("article_text"),
        *keep,
    )
    return parsed.where((F.col("headline") != "") & (F.col("article_text") != ""))
