"""Checked queries: text, topics and factorisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ludoscope import fixtures as fx
from ludoscope.catalog.base import checked
from ludoscope.functions.stopwords import DOMAIN, STOP
from ludoscope.functions.text import terms
from ludoscope.operators import lemmas, text as ops, topics
from ludoscope.session import cut_lineage


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


@checked("T1_comments_corpus", "comments", """
    SELECT game_id, 0::BIGINT AS part, string_agg(comment, ' ' ORDER BY ord, comment) AS text
    FROM comments WHERE comment IS NOT NULL GROUP BY game_id""")
def _(spark, sf):
    return ops.comments_corpus(fx.comments(spark, sf), ["ord"])


@checked("T2_tokenize", "docs", r"""
    SELECT doc_id, array_to_string(regexp_extract_all(text, '[\p{L}\p{N}_]+'), '|') AS tokens FROM docs""")
def _(spark, sf):
    return ops.tokenize(fx.docs(spark, sf)).select("doc_id", F.array_join("tokens", "|").alias("tokens"))


@checked("T3_lemmatize", "docs lemmas", r"""
    WITH split AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS t FROM docs),
    placed AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM split),
    joined AS (SELECT doc_id, string_agg(coalesce(lemma, token), '|' ORDER BY pos) AS lemmas
               FROM placed LEFT JOIN lemmas USING (token) GROUP BY doc_id)
    SELECT docs.doc_id, coalesce(lemmas, '') AS lemmas FROM docs LEFT JOIN joined USING (doc_id)""")
def _(spark, sf):
    found = ops.lemmatize(ops.tokenize(fx.docs(spark, sf)), fx.lemmas(spark, sf))
    return found.select("doc_id", F.array_join("tokens", "|").alias("lemmas"))


@checked("T4_remove_stopwords", "docs", r"""
    SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'),
                                               lambda w: w NOT IN (""" + _list(STOP) + r""")), '|') AS tokens
    FROM docs""")
def _(spark, sf):
    found = ops.remove_stopwords(ops.lemmatize(ops.tokenize(fx.docs(spark, sf))), STOP)
    return found.select("doc_id", F.array_join("tokens", "|").alias("tokens"))


@checked("T5_count_vectorize", "docs tf df", """
    SELECT doc_id, term, tf FROM tf JOIN df USING (term)
    WHERE df >= 20 AND df <= 0.2 * (SELECT count(*) FROM docs)""")
def _(spark, sf):
    return ops.count_vectorize(fx.docs(spark, sf), min_df=20, max_df=0.2).select("doc_id", "term", "tf")


@checked("T6_tfidf", "tfidf", "SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM tfidf")
def _(spark, sf):
    return ops.tfidf(fx.docs(spark, sf)).withColumn("tfidf", F.round("tfidf", 6))


@checked("T7_vocabulary", "df", "SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM df")
def _(spark, sf):
    return ops.vocabulary(ops.term_counts(fx.docs(spark, sf)))


_RUNS = r"""
    split AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM docs),
    runs AS (SELECT doc_id, unnest(t) AS term FROM split
             UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM split
             UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t) - 1),
                              lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM split),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM runs GROUP BY ALL)"""


@checked("T8_ngrams", "docs", f"WITH {_RUNS} SELECT doc_id, term, tf FROM counts")
def _(spark, sf):
    return ops.term_counts(fx.docs(spark, sf), ngram_range=(1, 3))


@checked("T9_top_phrases", "docs", f"""
    WITH {_RUNS},
    heavy AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1.0 + df)) + 1) AS w
              FROM counts JOIN (SELECT term, count(*) AS df FROM counts GROUP BY term) USING (term)),
    weights AS (SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS tfidf FROM heavy)
    SELECT doc_id, term, round(tfidf, 6) AS tfidf, rank FROM (
        SELECT doc_id, term, tfidf, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank FROM weights)
    WHERE rank <= 20""")
def _(spark, sf):
    weights = ops.tfidf(fx.docs(spark, sf), ngram_range=(1, 3)).withColumn("tfidf", F.round("tfidf", 9))
    return ops.top_phrases(weights, 20).select(
        "doc_id", "term", F.round("tfidf", 6).alias("tfidf"), F.col("rank").cast("long").alias("rank"))


@checked("T10_domain_stop", "docs tf df", f"""
    WITH kept AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1.0 + df)) + 1) AS w
                  FROM tf JOIN df USING (term)
                  WHERE term NOT IN ({_list(DOMAIN)}) AND df <= 0.5 * (SELECT count(*) FROM docs))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM kept""")
def _(spark, sf):
    weights = ops.tfidf(fx.docs(spark, sf), max_df=0.5, stop=DOMAIN)
    return weights.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


def _cells(spark, sf):
    return fx.attrs(spark, sf).select(
        F.col("game_id").alias("row"), F.concat_ws("|", "kind", "name").alias("col"), F.lit(1.0).alias("value"))


_V = "v AS (SELECT game_id AS row, kind || '|' || name AS col, 1.0::DOUBLE AS value FROM attrs)"


def _start_sql(name: str, key: str, k: int, scale: str) -> str:
    draw = f"(CAST('0x' || substr(md5('{key}34|' || {key} || '|' || i), 1, 6) AS BIGINT) + 1) / 16777216.0"
    return (f"{name} AS (SELECT {key}, CAST(i AS INTEGER) AS i, {draw} * {scale} AS f "
            f"FROM (SELECT DISTINCT {key} FROM v), range({k}) AS r(i))")


def _nmf_sql(k: int, iters: int, alpha: float) -> str:
    """CTEs w0, h0, ... of the updates written out, one sum at a time."""
    scale = f"(SELECT sqrt(sum(value) / (count(DISTINCT row) * count(DISTINCT col)) / {k}) FROM v)"
    parts = [_V, _start_sql("w0", "row", k, scale), _start_sql("h0", "col", k, scale)]

    def step(new, old, key, other, other_key):
        parts.append(f"g_{new} AS (SELECT a.i, b.i AS j, sum(a.f * b.f) AS g FROM {other} a JOIN {other} b USING ({other_key}) GROUP BY ALL)")
        parts.append(f"n_{new} AS (SELECT v.{key}, o.i, sum(v.value * o.f) AS s FROM v JOIN {other} o USING ({other_key}) GROUP BY ALL)")
        parts.append(f"d_{new} AS (SELECT x.{key}, g.i, sum(g.g * x.f) AS d FROM {old} x JOIN g_{new} g ON g.j = x.i GROUP BY ALL)")
        parts.append(
            f"{new} AS (SELECT x.{key}, x.i, x.f * coalesce(s, 0) / (d + {alpha} * x.f + 1e-12) AS f FROM {old} x "
            f"JOIN d_{new} USING ({key}, i) LEFT JOIN n_{new} USING ({key}, i))")

    for t in range(iters):
        step(f"h{t + 1}", f"h{t}", "col", f"w{t}", "row")
        step(f"w{t + 1}", f"w{t}", "row", f"h{t + 1}", "col")
    return "WITH " + ",\n".join(parts)


@checked("M1_nmf", "attrs", _nmf_sql(3, 2, 0.01) + """
    SELECT 'w' AS side, CAST(row AS VARCHAR) AS id, i, round(f, 6) AS f FROM w2
    UNION ALL SELECT 'h', col, i, round(f, 6) FROM h2""")
def _(spark, sf):
    found = topics.nmf(_cells(spark, sf), 3, iters=2, alpha=0.01)

    def long(df, key, side):
        return df.select(F.lit(side).alias("side"), F.col(key).cast("string").alias("id"),
                         F.posexplode("f").alias("i", "f"))

    both = long(found.w, "row", "w").unionByName(long(found.h, "col", "h"))
    return both.withColumn("f", F.round("f", 6))


@checked("M2_nmf_error", "attrs", _nmf_sql(3, 1, 0.0) + """,
    fitted AS (SELECT w1.row, h1.col, sum(w1.f * h1.f) AS x FROM w1 JOIN h1 USING (i) GROUP BY ALL)
    SELECT round(sqrt(sum((coalesce(value, 0) - x) ** 2)), 4) AS error FROM fitted LEFT JOIN v USING (row, col)""")
def _(spark, sf):
    cells = cut_lineage(_cells(spark, sf))
    error = topics.nmf_error(cells, topics.nmf(cells, 3, iters=1))
    return cells.agg(F.round(F.lit(error) + 0 * F.count(F.lit(1)), 4).alias("error"))


@checked("M3_nmf_sweep", "attrs", """
    SELECT k, true AS error_falls, true AS explains, true AS kl_not_negative, true AS sparse_in_range
    FROM (VALUES (2), (4)) AS t(k)""")
def _(spark, sf):
    table = topics.nmf_sweep(_cells(spark, sf), [2, 4], iters=4)
    worse = table.alias("a").join(table.alias("b"), F.col("a.k") > F.col("b.k")).where("a.error > b.error")
    n_worse = worse.agg(F.count(F.lit(1))).scalar()

    def within(c):
        return F.col(c).between(0, 1)

    return table.select(
        "k", (n_worse == 0).alias("error_falls"), within("evar").alias("explains"), (F.col("kl") >= 0).alias("kl_not_negative"),
        (within("sparseness_w") & within("sparseness_h")).alias("sparse_in_range"))


def _start(spark, sf, key, k):
    return topics.start_factor(_cells(spark, sf).select(key).distinct(), key, k, 34, F.lit(1.0))


@checked("M4_topic_terms", "attrs", f"""
    WITH {_V}, {_start_sql("h0", "col", 4, "1.0")}
    SELECT topic, rank, term, round(weight, 6) AS weight FROM (
        SELECT i + 1 AS topic, col AS term, f AS weight, row_number() OVER (PARTITION BY i ORDER BY f DESC, col) AS rank FROM h0)
    WHERE rank <= 10""")
def _(spark, sf):
    terms = topics.topic_terms(_start(spark, sf, "col", 4), 10)
    return terms.select(
        "topic", F.col("rank").cast("long").alias("rank"), "term", F.round("weight", 6).alias("weight"))


@checked("M5_assign_topic", "attrs", f"""
    WITH {_V}, {_start_sql("w0", "row", 8, "1.0")}
    SELECT row, topic FROM (SELECT row, i + 1 AS topic, row_number() OVER (PARTITION BY row ORDER BY f DESC, i) AS r FROM w0)
    WHERE r = 1""")
def _(spark, sf):
    return topics.assign_topic(_start(spark, sf, "row", 8))


@checked("M6_topic_sizes", "topics", """
    SELECT CAST(t AS INTEGER) AS topic, count(game_id) AS n FROM range(1, 13) AS r(t) LEFT JOIN topics ON topic = t GROUP BY t""")
def _(spark, sf):
    return topics.topic_sizes(fx.topics(spark, sf), 12)


@checked("M7_label_games", "games topics", """
    SELECT rank AS "Board Game Rank", game_id, game AS bgg_game, 'Title ' || game_id AS "Game", 'about ' || game AS "Description",
           topic AS nmf, playing_time AS "Playing Time", min_players AS "Min Players", max_players AS "Max Players",
           best_num_players AS "Best Num Players", round(avg_weight * 2, 6) AS avg_rating, round(avg_weight, 6) AS "Avg Weight"
    FROM games JOIN topics USING (game_id) WHERE game_id % 5 <> 0""")
def _(spark, sf):
    games = fx.games(spark, sf).withColumns({
        "description": F.concat(F.lit("about "), "game"), "avg_rating": F.round(F.col("avg_weight") * 2, 6),
        "avg_weight": F.round("avg_weight", 6)})
    official = games.where("game_id % 5 <> 0").select(
        "game_id", F.concat(F.lit("Title "), F.col("game_id").cast("string")).alias("title"))
    return topics.label_games(games, fx.topics(spark, sf), official)


@checked("M8_cluster_members", "games topics", "SELECT game_id, game FROM games JOIN topics USING (game_id) WHERE topic = 5")
def _(spark, sf):
    return topics.cluster_members(fx.topics(spark, sf), fx.games(spark, sf), 5)


_LDA = {"k": 25, "max_iter": 10, "min_df": 20, "max_df": 0.2}


@checked("M9_lda", "docs tf df", """
    WITH kept AS (SELECT DISTINCT doc_id FROM tf JOIN df USING (term)
                  WHERE df >= 20 AND df <= 0.2 * (SELECT count(*) FROM docs))
    SELECT doc_id, kept.doc_id IS NOT NULL AS has_terms, 25::BIGINT AS n_topics,
           CASE WHEN kept.doc_id IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS total
    FROM docs LEFT JOIN kept USING (doc_id)""")
def _(spark, sf):
    found = topics.lda(fx.docs(spark, sf), **_LDA)
    shares = topics.doc_topics(found).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_topics"), F.abs(F.round(F.sum("share"), 6)).alias("total"))
    return shares.select("doc_id", (F.col("total") > 0).alias("has_terms"), "n_topics", "total")


@checked("M9_lda_100", "docs tf df", """
    WITH kept AS (SELECT DISTINCT doc_id FROM tf JOIN df USING (term)
                  WHERE df >= 20 AND df <= 0.2 * (SELECT count(*) FROM docs))
    SELECT doc_id, 100::BIGINT AS n_topics, CASE WHEN kept.doc_id IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS total
    FROM docs LEFT JOIN kept USING (doc_id)""")
def _(spark, sf):
    found = topics.lda(fx.docs(spark, sf), **(_LDA | {"k": 100}))
    return topics.doc_topics(found).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_topics"), F.abs(F.round(F.sum("share"), 6)).alias("total"))


@checked("M9_lda_on_tfidf", "docs tf df", """
    SELECT count(DISTINCT doc_id) AS n_docs, 250::BIGINT AS n_terms, true AS sums_to_one FROM tf JOIN df USING (term)
    WHERE df >= 20 AND df <= 0.2 * (SELECT count(*) FROM docs)""")
def _(spark, sf):
    found = topics.lda(fx.docs(spark, sf), 25, 10, min_df=20, max_df=0.2, weighted=True)
    n_terms = topics.lda_terms(found, 10).agg(F.count(F.lit(1))).scalar()
    totals = topics.doc_topics(found).groupBy("doc_id").agg(F.sum("share").alias("total")).where("total > 0")
    return totals.agg(
        F.count(F.lit(1)).alias("n_docs"), F.max(n_terms).alias("n_terms"),
        (F.count_if(F.abs(F.col("total") - 1) > 1e-6) == 0).alias("sums_to_one"))


@checked("M10_lda_summary", "docs", """
    SELECT 'shares' AS part, 25::BIGINT AS n, true AS holds FROM (SELECT count(*) FROM docs)
    UNION ALL SELECT 'relevance', 750, true UNION ALL SELECT 'distances', 300, true""")
def _(spark, sf):
    found = topics.lda(fx.docs(spark, sf), **_LDA)
    n = F.count(F.lit(1)).alias("n")
    shares = topics.topic_shares(found).agg(n, (F.abs(F.sum("share") - 1) < 1e-6).alias("holds"))
    relevance = topics.term_relevance(found).agg(n, (F.max("relevance") < 10).alias("holds"))
    far = topics.topic_distances(found).agg(
        n, ((F.min("divergence") >= 0) & (F.max("divergence") <= 0.6932)).alias("holds"))
    parts = [d.withColumn("part", F.lit(p)) for p, d in (("shares", shares), ("relevance", relevance), ("distances", far))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Languages stand in for topics: their words' shares are p(term | topic).
_LANGUAGES = r"""
    by_lang AS (SELECT lang AS topic, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents WHERE lang IN ('de', 'en', 'fr')),
    n AS (SELECT topic, term, count(*) AS n FROM by_lang GROUP BY ALL),
    tbl AS (SELECT topic, term, n / sum(n) OVER (PARTITION BY topic) AS p FROM n),
    shares AS (SELECT topic, sum(n) / (SELECT sum(n) FROM n) AS share FROM n GROUP BY topic)"""


def _languages(spark, sf):
    words = fx.table(spark, sf, "documents").where(F.col("lang").isin("de", "en", "fr"))
    counts = cut_lineage(words.select(F.col("lang").alias("topic"), F.explode(terms(F.col("text"))).alias("term")).groupBy("topic", "term").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("topic").agg(F.sum("n").alias("total"))
    table = counts.join(totals, "topic").select("topic", "term", (F.col("n") / F.col("total")).alias("p"))
    return table, totals.select("topic", (F.col("total") / totals.agg(F.sum("total")).scalar()).alias("share"))


@checked("M10_term_saliency", "", f"""
    WITH {_LANGUAGES},
    joint AS (SELECT term, topic, p, share, p * share AS j, sum(p * share) OVER (PARTITION BY term) AS p_all FROM tbl JOIN shares USING (topic)),
    scored AS (SELECT term, max(p_all) AS p, sum(j / p_all * ln(j / p_all / share)) AS told FROM joint GROUP BY term)
    SELECT term, round(p, 6) AS p, round(told, 6) AS distinctiveness, round(p * told, 6) AS saliency FROM scored
    ORDER BY round(p * told, 12) DESC, term LIMIT 30""")
def _(spark, sf):
    return topics.term_saliency(*_languages(spark, sf)).select("term", *[F.round(c, 6).alias(c) for c in ("p", "distinctiveness", "saliency")])


@checked("M10_topic_map", "", f"""
    WITH {_LANGUAGES},
    every AS (SELECT a.topic AS topic_a, b.topic AS topic_b, t.term FROM shares a JOIN shares b ON a.topic < b.topic, (SELECT DISTINCT term FROM tbl) t),
    met AS (SELECT e.topic_a, e.topic_b, coalesce(x.p, 0) AS pa, coalesce(y.p, 0) AS pb FROM every e
             LEFT JOIN tbl x ON x.topic = e.topic_a AND x.term = e.term LEFT JOIN tbl y ON y.topic = e.topic_b AND y.term = e.term)
    SELECT topic_a, topic_b, round(sum(CASE WHEN pa > 0 THEN pa * ln(2 * pa / (pa + pb)) ELSE 0 END + CASE WHEN pb > 0 THEN pb * ln(2 * pb / (pa + pb)) ELSE 0 END) / 2, 6) AS apart
    FROM met GROUP BY ALL""")
def _(spark, sf):
    # Three points fit in a plane, so their distances on the map are the divergences.
    placed = topics.topic_map(*_languages(spark, sf))
    a, b = (placed.select(*[F.col(c).alias(f"{c}_{s}") for c in ("topic", "x", "y")]) for s in "ab")
    apart = F.hypot(F.col("x_a") - F.col("x_b"), F.col("y_a") - F.col("y_b"))
    return a.join(b, F.col("topic_a") < F.col("topic_b")).select("topic_a", "topic_b", F.round(apart, 6).alias("apart"))


# Rules by hand, the longest suffix first in the SQL.
_RULES = {"ing": "3:", "nning": "4:", "ies": "3:y", "es": "2:", "s": "1:", "ss": "0:", "ed": "2:", "tion": "3:e"}
_CASES = " ".join(f"WHEN length(token) > {len(x)} AND ends_with(token, '{x}') THEN left(token, length(token) - {r.split(':')[0]}) || '{r.split(':')[1]}'"
                  for x, r in sorted(_RULES.items(), key=lambda t: (-len(t[0]), t[0])))


@checked("T3_lemmas_by_rule", "", rf"""
    WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS token FROM documents)
    SELECT token, CASE WHEN token = 'des' THEN 'de' WHEN token = 'les' THEN 'le' {_CASES} ELSE token END AS lemma FROM words""")
def _(spark, sf):
    words = fx.docs(spark, sf).select(F.explode(terms(F.col("text"))).alias("token"))
    exceptions = spark.sql("SELECT * FROM VALUES ('des', 'de'), ('les', 'le') AS t(token, lemma)")
    return lemmas.lemmas_of(words, _RULES, exceptions)


@checked("T3_learnt_lemmas", "lemmas", "SELECT token, lemma FROM lemmas")
def _(spark, sf):
    # Learnt from the pairs, rules and exceptions give them back.
    pairs = fx.lemmas(spark, sf)
    rules, exceptions = lemmas.learn_rules(pairs)
    return lemmas.lemmas_of(pairs, rules, exceptions)


def _vcol_sql(key: str, other: str, k: int) -> str:
    """The means of drawn lines; with these ids every topic draws some."""
    draw = f"CAST('0x' || substr(md5('vcol34|' || {other} || '|' || i), 1, 6) AS BIGINT) / 16777216.0 < 0.2"
    return f"""
        SELECT v.{key}, l.i, sum(v.value * l.drawn) / max(l.n) AS f
        FROM v JOIN (SELECT {other}, i, CAST({draw} AS INTEGER) AS drawn, sum(CAST({draw} AS INTEGER)) OVER (PARTITION BY i) AS n
                     FROM (SELECT DISTINCT {other} FROM v), range({k}) AS r(i)) l ON l.{other} = v.{other} GROUP BY v.{key}, l.i"""


@checked("M1_vcol_start", "attrs", f"""
    WITH {_V}, w AS ({_vcol_sql("row", "col", 8)}), h AS ({_vcol_sql("col", "row", 8)})
    SELECT 'w' AS side, CAST(row AS VARCHAR) AS id, i, round(f, 6) AS f FROM w UNION ALL SELECT 'h', col, i, round(f, 6) FROM h""")
def _(spark, sf):
    cells = cut_lineage(_cells(spark, sf))

    def long(key, other, side):
        start = topics.vcol_start(cells, key, other, 8, 34)
        return start.select(F.lit(side).alias("side"), F.col(key).cast("string").alias("id"), F.posexplode("f").alias("i", "f"))

    both = long("row", "col", "w").unionByName(long("col", "row", "h"))
    return both.select("side", "id", F.col("i").cast("long").alias("i"), F.round("f", 6).alias("f"))


_SEEDS = (34, 35, 36)
_LABELS = " UNION ALL ".join(
    f"SELECT row, {run} AS run, arg_max(i, f) AS topic FROM (SELECT row, i, (CAST('0x' || substr(md5('row{seed}|' || row || '|' || i), 1, 6) AS BIGINT) + 1) AS f "
    f"FROM (SELECT DISTINCT row FROM v), range(4) AS r(i)) GROUP BY row" for run, seed in enumerate(_SEEDS))


@checked("M3_consensus", "attrs", f"""
    WITH {_V}, labels AS ({_LABELS}),
    pairs AS (SELECT a.row AS x, b.row AS y, avg(CASE WHEN a.topic = b.topic THEN 1.0 ELSE 0.0 END) AS c FROM labels a JOIN labels b ON a.run = b.run GROUP BY ALL)
    SELECT (SELECT count(DISTINCT row) FROM v) AS n, 3::BIGINT AS runs, round(avg(4 * (c - 0.5) * (c - 0.5)), 9) AS dispersion FROM pairs""")
def _(spark, sf):
    # Labels by rule, so that the table of all pairs can be made in SQL.
    rows = _cells(spark, sf).select("row").distinct()
    labels = [topics.assign_topic(topics.start_factor(rows, "row", 4, seed, F.lit(1.0))).withColumn("run", F.lit(run)) for run, seed in enumerate(_SEEDS)]
    found = topics.consensus_dispersion(labels[0].unionByName(labels[1]).unionByName(labels[2]))
    return found.withColumn("dispersion", F.round("dispersion", 9))


def _sweep_sql(ranks) -> str:
    """The error after one step at each rank, every update written out."""
    parts, errors = [_V], []
    for k in ranks:
        body = _nmf_sql(k, 1, 0.0)
        body = "\n" + body[len("WITH ") + len(_V) + 2:]
        for name in ("w0", "h0", "w1", "h1", "g_", "n_", "d_"):
            body = body.replace(f" {name}", f" r{k}_{name}").replace(f"\n{name}", f"\nr{k}_{name}")
        parts.append(body)
        parts.append(f"r{k}_fitted AS (SELECT a.row, b.col, sum(a.f * b.f) AS x FROM r{k}_w1 a JOIN r{k}_h1 b USING (i) GROUP BY ALL)")
        errors.append(f"SELECT {k} AS k, round(sqrt(sum((coalesce(value, 0) - x) ** 2)), 4) AS error FROM r{k}_fitted LEFT JOIN v USING (row, col)")
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(errors)


@checked("M3_sweep_ranks", "attrs", _sweep_sql((10, 15, 20, 25)))
def _(spark, sf):
    return topics.nmf_sweep(_cells(spark, sf), [10, 15, 20, 25], iters=1).select("k", F.round("error", 4).alias("error"))
