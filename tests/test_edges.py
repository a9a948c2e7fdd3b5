"""Edge rows: blanks, nulls, ties, unknown names, empty sets."""

import pytest
from pyspark.sql import functions as F

from ludoscope import fixtures as fx, schemas
from ludoscope.functions import columns, text
from ludoscope.operators import ratings as rating_ops, serve, similar, text as text_ops, topics
from ludoscope.plans.recommend import recommend_similar
from ludoscope.sources import landed, tables


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect() if cols else df.collect()), key=str)


def test_clean_description(spark):
    raw = "a&#10;&#10;b &rsquo; &ndash; &mdash; &ldquo;q&rdquo; &quot;  end "
    df = spark.createDataFrame([(raw,)], "t string")
    got = df.select(text.clean_description(F.col("t")), text.clean_description(F.col("t"), strict=True)).first()
    assert got[0] == "a b ' – — \"q\" \" end"
    assert got[1] == "a b ' – —; \"q\" \" end"


def test_printable_and_titles(spark):
    df = spark.createDataFrame([("Été-a b\n", "star-wars x-Wing game"), ("", "")], "t string, s string")
    got = df.select(text.keep_printable(F.col("t")), text.title_words(F.col("s"))).collect()
    assert tuple(got[0]) == ("t-a b\n", "Star Wars X Wing Game") and tuple(got[1]) == ("", "")


POLL = "struct<_totalvotes:string,results:array<struct<_numplayers:string,result:array<struct<_value:string,_numvotes:string>>>>>"


@pytest.mark.parametrize("options, winner", [
    ([("1", "5"), ("2", "5")], 1),
    ([("4", "1"), ("10", "7")], 10),
    ([("4", "1"), ("4+", "7")], 4),
    ([("3", "0"), ("2", "0")], 3),
    ([("1", None), ("2", "1")], 2),
    ([], None),
])
def test_poll_winner(spark, options, winner):
    results = [(n, [("Best", v)] if v is not None else []) for n, v in options]
    df = spark.createDataFrame([(("9", results),)], f"p {POLL}")
    assert df.select(landed.poll_winner(F.col("p"))).first()[0] == winner


def test_ranks_are_always_arrays(spark):
    xml = (
        '<items><item type="boardgame" id="7"><statistics><ratings><average value="x"/><ranks>'
        '<rank friendlyname="Board Game Rank" id="1" value="Not Ranked"/></ranks></ratings></statistics></item>'
        '<item type="boardgame" id="8"></item></items>')
    items = landed.parse_items(spark.createDataFrame([(xml,)], "xml string"))
    got = {r["game_id"]: r for r in items.withColumn("r", landed.normalize_ranks(F.col("ranks"))).collect()}
    assert [tuple(x) for x in got[7]["r"]] == [("Board Game Rank", "1", None)] and got[8]["r"] == []
    assert got[7]["avg_rating"] is None and got[8]["description"] is None


def test_links_empty_lists(spark):
    df = spark.createDataFrame([([("a", "1", "x")],), (None,)], "l array<struct<_type:string,_id:string,_value:string>>")
    got = df.select(landed.links_of_type(F.col("l"), "b"), landed.links_of_type(F.col("l"), "b", False)).collect()
    assert all(r[0] is None and r[1] == [] for r in got)


def test_rejects(spark):
    df = spark.createDataFrame([(1, '<items><item id="1"></item></items>'), (2, "<items><item"), (3, None)], "page int, xml string")
    good, bad = landed.split_rejects(df, schemas.COMMENTS_XML, "items")
    assert rows(good, "page") == [(1,)] and rows(bad, "page") == [(2,), (3,)]


def test_article_needs_title_and_text(spark):
    html = '<title>T &amp; U</title><meta name="author" content="A B"><article><p>x<br>y</p><script>z()</script></article>'
    pages = spark.createDataFrame([("u1", html), ("u2", "<title>T</title>"), ("u3", ""), ("u4", None)], "url string, html string")
    got = landed.parse_article(pages, F.lit("s")).collect()
    assert [(r["url"], r["headline"], r["article_text"], r["author"]) for r in got] == [("u1", "T & U", "x y", ["A B"])]
    assert got[0]["date_published"] is not None


def test_upsert_fieldwise_and_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, n int")
    updates = spark.createDataFrame([(2, None, "x"), (3, 30, "y")], "id int, n int, extra string")
    once = tables.upsert(target, updates, "id")
    assert rows(once, "id", "name", "n", "extra") == [(1, "a", 10, None), (2, "b", None, "x"), (3, None, 30, "y")]
    twice = tables.upsert(once, updates, "id")
    assert rows(twice, *once.columns) == rows(once, *once.columns)


def test_unknown_user_gives_no_rows(spark):
    users = spark.createDataFrame([(1, "ann"), (2, "bob"), (0, "bob")], "user_id int, username string")
    ratings = spark.createDataFrame([(1, 5, 3.0), (1, 6, 3.0), (2, 6, 4.0)], schemas.RATINGS)
    assert rows(tables.lookup_user(users, "bob")) == [(0, "bob")]
    assert rating_ops.unrated_games(ratings, tables.lookup_user(users, "zoe")).count() == 0
    assert rating_ops.unrated_games(ratings, tables.lookup_user(users, "ann")).count() == 0
    assert rows(rating_ops.unrated_all(ratings, users.where("username = 'bob'")), "user_id", "game_id") == [
        (0, 5), (0, 6), (2, 5)]


def test_split_is_a_partition(spark):
    df = spark.range(500).select((F.col("id") % 20).alias("user_id"), F.col("id").alias("game_id"))
    parts = rating_ops.hash_split(df, [6, 2, 2], ["user_id", "game_id"])
    again = rating_ops.hash_split(df.repartition(9), [6, 2, 2], ["user_id", "game_id"])
    assert sum(p.count() for p in parts) == 500
    assert [rows(p) for p in parts] == [rows(p) for p in again]


def test_histogram_of_one_value(spark):
    got = rating_ops.histogram(spark.createDataFrame([(3,), (3,), (None,)], "n int"), "n", 4).orderBy("bin").collect()
    assert [r["n"] for r in got] == [0, 0, 2, 0] and got[0]["left_edge"] == 2.5


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, 30, None, None), (2, 60, 0, 0), (3, 61, 5, 2999), (4, 119, 8, 3000), (5, 120, 1, 4)],
        "game_id int, playing_time int, best_num_players int, rank int")
    assert rows(serve.filter_time(df, 30, "120"), "game_id") == [(2,), (3,), (4,)]
    assert rows(serve.filter_time(df, "", None), "game_id") == [(i,) for i in range(1, 6)]
    assert rows(serve.filter_players(df, []), "game_id") == [(3,), (4,), (5,)]
    assert rows(serve.filter_players(df, ["5"]), "game_id") == [(3,), (4,)]
    assert rows(serve.filter_players(df, ["1"]), "game_id") == [(5,)]
    assert rows(serve.rank_cutoff(df), "game_id") == [(3,), (5,)]


def test_diversify_is_a_permutation(spark):
    ranked = spark.createDataFrame(
        [(i, t, i) for i, t in enumerate([1, 1, 9, 2, 1, None, 8, 2], start=1)], "game_id int, topic int, rank long")
    got = serve.diversify(ranked).orderBy("place").collect()
    assert [r["game_id"] for r in got] == [1, 4, 7, 2, 3, 5, 6, 8]
    assert [r["place"] for r in got] == list(range(1, 9))
    assert [r["game_id"] for r in got if r["promoted"]] == [1, 4, 7]


def test_diversify_without_heads(spark):
    ranked = spark.createDataFrame([(7, 9, 1), (8, None, 2)], "game_id int, topic int, rank long")
    assert [r["place"] for r in serve.diversify(ranked).orderBy("rank").collect()] == [1, 2]


def test_one_hot_without_attributes(spark):
    games = spark.createDataFrame([(1,), (2,)], "game_id int")
    attrs = spark.createDataFrame([(1, "mechanic", "dice")], "game_id int, kind string, name string")
    got = columns.one_hot(games, attrs, "mechanic", ["dice", "cards"])
    assert rows(got, "game_id", "dice_mechanic", "cards_mechanic") == [(1, True, False), (2, False, False)]


def test_fuzzy_match_ignores_order_and_breaks_ties(spark):
    games = spark.createDataFrame([(2, "War of the Ring"), (1, "Ring War"), (3, "Ring War")], "game_id int, game string")
    assert similar.fuzzy_match(games, "war RING").first()["game_id"] == 1
    assert similar.fuzzy_match(games, "the ring of war").first()["game_id"] == 2


def test_similar_query_without_games(spark):
    games = spark.createDataFrame([], schemas.GAMES)
    attrs = spark.createDataFrame([], "game_id int, kind string, name string")
    assert recommend_similar(games, attrs, "x").count() == 0


def test_corpus_goes_on_in_parts(spark):
    said = spark.createDataFrame(
        [(1, i, f"c{i}") for i in range(5)] + [(1, 9, None), (2, 0, "z")], "game_id int, ord int, comment string")
    got = text_ops.comments_corpus(said, ["ord"], part_rows=2)
    assert rows(got, "game_id", "part", "text") == [(1, 0, "c0 c1"), (1, 1, "c2 c3"), (1, 2, "c4"), (2, 0, "z")]


def test_part_edges_cannot_be_seen(spark):
    said = spark.createDataFrame(
        [(1, i, t) for i, t in enumerate(["alpha beta gamma", "", "delta", "alpha beta", "gamma delta alpha"])] + [(2, 0, "alpha"), (3, 0, "beta x1 beta"), (3, 1, "alpha")],
        "game_id int, ord int, comment string")

    def of(rows_per_part):
        return text_ops.comments_corpus(said, ["ord"], part_rows=rows_per_part).withColumnRenamed("game_id", "doc_id")

    def lda_input(corpus):
        found = topics.lda(corpus, 2, 3)
        names = found.words.vocabulary
        return sorted((r["doc_id"], names[i], r["features"][int(i)]) for r in found.vectors.collect() for i in r["features"].indices)

    def every(corpus):
        return [
            rows(text_ops.term_counts(corpus, ngram_range=(1, 3)), "doc_id", "term", "tf"),
            rows(text_ops.count_vectorize(corpus, max_df=0.5), "doc_id", "term", "tf", "df"),
            rows(text_ops.tfidf(corpus, ngram_range=(1, 2)).withColumn("tfidf", F.round("tfidf", 12)), "doc_id", "term", "tfidf"),
            lda_input(corpus),
        ]

    whole = every(of(10_000))
    assert every(of(1)) == whole and every(of(2)) == whole


def test_catalogue_cells_are_read_one_by_one(spark):
    page = (
        '<td class="collection_thumbnail"><a href="/boardgame/1/no-picture">x</a></td><td class="collection_thumbnail"><a href="/boardgame/2/two">'
        '<img src="https://x/pic7_mt.jpg"></a></td><td class="collection_thumbnail">empty</td><td class="collection_thumbnail"><a href="/boardgame/3/three"></a></td>')
    pages = spark.createDataFrame([(1, page)], "page int, html string")
    assert rows(landed.extract_thumbnails(pages), "game_id", "picture_id") == [("1", None), ("2", "7"), ("3", None)]
    assert rows(landed.extract_game_links(pages), "game_id", "game", "rank") == [(1, "No Picture", 1), (2, "Two", 2), (3, "Three", 3)]


def test_lemmas_and_stop_words_keep_repeats(spark):
    docs = spark.createDataFrame([(1, "Running dogs, dogs run"), (2, "")], "doc_id int, text string")
    lemmas = spark.createDataFrame([("running", "run"), ("dogs", "dog")], "token string, lemma string")
    got = text_ops.lemmatize(text_ops.tokenize(docs), lemmas)
    assert rows(got, "doc_id", "tokens") == [(1, ["run", "dog", "dog", "run"]), (2, [])]
    assert rows(text_ops.remove_stopwords(got, ["run"]), "tokens") == [(["dog", "dog"],), ([],)]


def test_label_games_needs_topic_and_title(spark):
    games = spark.createDataFrame([(3,), (1,), (2,)], "game_id long")
    for c, t in [("rank", "int"), ("game", "string"), ("description", "string"), ("playing_time", "int"),
                 ("min_players", "int"), ("max_players", "int"), ("best_num_players", "int"), ("avg_rating", "double"),
                 ("avg_weight", "double")]:
        games = games.withColumn(c, F.lit(None).cast(t))
    topic = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "game_id long, topic int")
    official = spark.createDataFrame([(1, "One"), (3, "Three")], "game_id long, title string")
    assert rows(topics.label_games(games, topic, official), "game_id", "Game", "nmf") == [(1, "One", 4), (3, "Three", 6)]


def test_assign_topic_first_wins(spark):
    w = spark.createDataFrame([(1, [0.2, 0.5, 0.5]), (2, [0.0, 0.0, 0.0])], "row int, f array<double>")
    assert rows(topics.assign_topic(w)) == [(1, 2), (2, 1)]


def test_records_of_any_fields(spark, tmp_path):
    path = str(tmp_path / "records")
    lines = [
        '{"game_id": 1, "game": "a", "Dice_mechanic": true, "odd \'name\'": {"x": [1, 2]}}', '{"game_id": "2", "Dice_mechanic": false, "War_category": true}',
        "broken", "", '{"game": null, "War_category": "yes", "n": 1.5}', "[1]", '{"game_id": 9, "_mechanic": true}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    records = tables.read_game_records(spark, path)
    assert records.count() == 7 and records.where("record is null").count() == 2
    assert sorted((r["game_id"], r["kind"], r["name"]) for r in tables.record_attributes(records).where("game_id is not null").collect()) == [
        (1, "mechanic", "Dice"), (2, "category", "War"), (9, "mechanic", "")]
    one = records.where("game_id = 1").select(tables.record_field("odd 'name'").alias("x"), tables.record_field("none", "int").alias("y")).first()
    assert one["x"] == '{"x":[1,2]}' and one["y"] is None
    fields = {(r["field"], r["n"]) for r in tables.record_fields(records).collect()}
    assert ("Dice_mechanic", 2) in fields and ("n", 1) in fields
    assert "odd" in tables.record_schema(records.where("game_id = 1")).first()["schema"]


def test_terms_are_counted_without_shuffling_them(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (1, "bb cc"), (None, "aa bb"), (2, None), (3, "")], "doc_id long, text string")
    counts = text_ops.term_counts(docs, ngram_range=(1, 2))
    assert sorted(map(tuple, counts.where("doc_id = 1").collect())) == [
        (1, "aa", 2), (1, "aa bb", 1), (1, "bb", 2), (1, "bb aa", 1), (1, "bb cc", 1), (1, "cc", 1)]
    assert sorted(r["term"] for r in counts.where("doc_id IS NULL").collect()) == ["aa", "aa bb", "bb"]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(doc_id" in plan and ", term#" not in plan.split("hashpartitioning")[1].split(")")[0]


def test_weights_are_shuffled_twice_and_a_probe_not_at_all(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (None, "aa bb"), (3, "dd")], "doc_id long, text string")
    weights = text_ops.tfidf(docs)
    assert {r["doc_id"] for r in weights.collect()} == {1, 2, 3}
    near = similar.cosine_similarity(weights, 1)
    norms = {r["doc_id"]: r["n"] for r in weights.groupBy("doc_id").agg(F.sum(F.col("tfidf") * F.col("tfidf")).alias("n")).collect()}
    assert all(abs(n - 1) < 1e-12 for n in norms.values())
    found = {r["doc_id"]: r["similarity"] for r in near.collect()}
    assert found[3] == 0 and 0 < found[2] < 1
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [term" in plan


def test_wide_rows_of_many_games_equal_the_columns(spark):
    given = [(1, 3, 2.0), (1, 3, 1.0), (1, 4, 0.0), (2, 5, 4.0), (None, 3, 1.5), (3, 4, None), (3, 5, 1.0)]
    ratings = spark.createDataFrame(given, "user_id int, game_id int, rating double")
    wide = {(r["user_id"], c): r[c] for r in rating_ops.utility_wide(ratings).collect() for c in ("3", "4", "5") if r[c]}
    got = rating_ops.utility_rows(ratings).collect()
    assert {(r["user_id"], c["game_id"]): c["rating"] for r in got for c in r["cells"]} == wide and {r["n_cells"] for r in got} == {3}
    # 30,000 games took as many columns, whose plan alone took minutes.
    many = spark.range(60_000).select(F.floor(F.col("id") / 6).alias("user_id"), (F.col("id") % 30_000).alias("game_id"), F.lit(1.0).alias("rating"))
    assert rating_ops.utility_rows(many).agg(F.sum(F.size("cells")), F.max("n_cells")).first()[:] == (60_000, 30_000)


def test_rejects_are_parsed_once(spark):
    """Either part reads stored rows; before, each parsed all payloads again."""
    df = spark.createDataFrame([(1, '<items><item id="1"></item></items>'), (2, "<items><item"), (None, None)], "page int, xml string")
    good, bad = landed.split_rejects(df, schemas.COMMENTS_XML, "items")
    assert good.columns == bad.columns == ["page", "xml"] and rows(bad, "page", "xml") == [(2, "<items><item"), (None, None)]
    assert all("xml_to_structs" not in plan and "from_xml" not in plan for plan in (str(d._jdf.queryExecution()) for d in (good, bad)))


def test_lemmas_leave_texts_in_lists(spark):
    """Rows of one document are one text, missing texts and ids stay; words and their places are not taken apart, as they were before."""
    docs = spark.createDataFrame([(1, "b Running a"), (1, "dogs c"), (2, None), (3, ""), (None, "Dogs x dogs"), (4, "none here")], "doc_id int, text string")
    lemmas = spark.createDataFrame([("running", "run"), ("dogs", "dog"), ("x", None), (None, "y")], "token string, lemma string")
    found = text_ops.lemmatize(text_ops.tokenize(docs), lemmas)
    got = {r["doc_id"]: r["tokens"] for r in found.collect()}
    assert got == {1: ["b", "dog", "c", "run", "a"], 2: [], 3: [], 4: ["none", "here"], None: ["dog", "x", "dog"]}
    assert "posexplode" not in str(found._jdf.queryExecution())


def test_scans_are_dealt_out_as_shuffles_are(spark, sf):
    """As many tasks as cores, as before, would let a task grow with the table."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert fx.docs(spark, sf).rdd.getNumPartitions() == 37
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
