"""The queries of these operators, each over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ludoscope.llm import archives, bpe, chat, collocations, edit_walk, html_text, merkle, mixing, near_dups, packing, quality, repeats, toxicity

# The tokenizer's files are not part of the library; their place is a parameter of the operators.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Of the same vocabulary as the tokenizers library reads it: the text of these tokens is one id.
ADDED = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[f.__name__] = f
    return f


@query
def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate group at a similarity of 0.85."""
    out = near_dups.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


ORACLES["op1_near_dups"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.m, d.doc_id) AS component_id,
       coalesce(l.m, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and the cascade's verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.grade(docs, counts=True)
    return out.select("doc_id", *quality.REPORTED, "base_failed", "kept")


ORACLES["op5_quality_rules"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) > 7)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
counts AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter,
         length(regexp_replace(text, '[^A-Za-z\x{C0}-\x{FFFF}]', '', 'g')) AS n_letters
  FROM words t LEFT JOIN lines l ON l.doc_id = t.doc_id LEFT JOIN repeats r ON r.doc_id = t.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR 100 * n_stutter > 30 * n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 2 * n_letters < word_chars) AS kept
FROM counts
"""


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and what they decode to, as digests."""
    return bpe.encode_texts(table(spark, sf_dir, "documents"), RANKS, PATTERN, ids=False, digests=True)


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 ids."""
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), RANKS, PATTERN, added=ADDED))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is kept for the test of a model."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record, read back from the packages."""
    packages = archives.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return archives.read_archives(packages, payloads=False)


ORACLES["op8_warc_zip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op3_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document."""
    return edit_walk.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps once passages of 50 words that stand in an earlier one are gone."""
    return repeats.count_repeats(table(spark, sf_dir, "documents"))


ORACLES["op9_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) > 49)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM late, (SELECT unnest(range(0, 50)) AS k)),
kept AS (
  SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.i) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words) p
  LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i WHERE g.i IS NULL GROUP BY p.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations read as tool use, of which the table has none.

    Every assistant's turn makes a call on its text, with the identifier c<turn>; every later user's turn is the result of the call in
    the turn before. Calls name three tools in turn, of which one has a schema that fits, one that does not, and one has none.
    """
    name = F.when(F.col("turn") % 3 == 0, "summarise").when(F.col("turn") % 3 == 1, "search").otherwise("guess")
    words = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    call = F.struct(F.concat(F.lit("c"), "turn").alias("id"), name.alias("name"), F.struct(words.alias("words"), F.coalesce("text", F.lit("")).alias("text")).alias("arguments"))
    answers = (F.col("role") == "user") & (F.col("turn") > 0)
    return conversations.select(
        "conv_id", "turn", F.when(answers, "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.coalesce(F.col("role") != "assistant", F.lit(True)), F.col("text")).alias("text"),
        F.when(F.col("role") == "assistant", F.to_json(F.array(call))).alias("calls"),
        F.when(answers, F.concat(F.lit("c"), F.col("turn") - 1)).alias("call_id"),
    )


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's messages as canonical JSON lines, calls linked with their results."""
    schemas = spark.sql("SELECT * FROM VALUES ('search', map('text', 'string', 'words', 'integer')), ('summarise', map('text', 'string', 'words', 'string?')) AS t(name, params)")
    return chat.format_messages(tool_messages(table(spark, sf_dir, "conversations")), schemas)


ORACLES["op4_chat_format"] = """
WITH m AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' AND turn > 0 THEN 'tool' ELSE role END AS role, coalesce(text, '') AS text,
         CASE turn % 3 WHEN 0 THEN 'summarise' WHEN 1 THEN 'search' ELSE 'guess' END AS name FROM conversations),
k AS (
  SELECT m.*, EXISTS (SELECT 1 FROM m o WHERE o.conv_id = m.conv_id AND o.turn = m.turn + 1 AND o.role = 'tool') AS answered,
         EXISTS (SELECT 1 FROM m o WHERE o.conv_id = m.conv_id AND o.turn = m.turn - 1 AND o.role = 'assistant') AS called FROM m)
SELECT conv_id, turn, role, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS place,
  CASE role
    WHEN 'assistant' THEN '{"calls":[{"arguments":{"text":' || to_json(text)::VARCHAR || ',"words":' || len(string_split(text, ' '))
      || '},"id":"c' || turn || '","name":"' || name || '"}],"role":"assistant"}'
    WHEN 'tool' THEN '{"call_id":"c' || (turn - 1) || '","content":' || to_json(text)::VARCHAR || ',"role":"tool"}'
    ELSE '{"content":' || to_json(text)::VARCHAR || ',"role":"' || role || '"}' END AS line,
  CASE role WHEN 'assistant' THEN CASE WHEN answered THEN 'ok' ELSE 'missing' END
            WHEN 'tool' THEN CASE WHEN called THEN 'ok' ELSE 'orphan' END END AS status,
  CASE WHEN role = 'assistant' THEN CASE name WHEN 'summarise' THEN 'wrong type: words' WHEN 'guess' THEN 'unknown tool' END END AS problem
FROM k
"""


@query
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of sources takes."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


# Stopped sources come first by size over weight: the first one that need not stop tells what is left for all from there on.
ORACLES["op12_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, text, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS s FROM d GROUP BY source),
placed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM sums),
run AS (
  SELECT *, row_number() OVER (ORDER BY s / w, source NULLS LAST) AS i, sum(s) OVER () AS total, sum(w) OVER () AS weights,
         sum(s) OVER (ORDER BY s / w, source NULLS LAST) - s AS s_before, sum(w) OVER (ORDER BY s / w, source NULLS LAST) - w AS w_before FROM placed),
level AS (
  SELECT i AS first, 150 * total - 200 * s_before AS left_over, weights - w_before AS weight FROM run
  WHERE w * (150 * total - 200 * s_before) <= 200 * s * (weights - w_before) ORDER BY i LIMIT 1),
targets AS (
  SELECT source, s, CASE WHEN i < first THEN CAST(2 * s AS DOUBLE) ELSE CAST(w AS DOUBLE) * CAST(left_over AS DOUBLE) / CAST(100 * weight AS DOUBLE) END AS target
  FROM run, level),
rates AS (
  SELECT d.doc_id, d.size, t.s AS source_size, t.target, CASE WHEN t.s = 0 THEN 0.0 ELSE t.target / CAST(t.s AS DOUBLE) END AS rate,
         CAST('0x' || substr(md5('0|' || coalesce(CAST(d.doc_id AS VARCHAR), d.text, '-')), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
  FROM d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rates
"""


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and the root that its tampered leaf folds to."""
    edited = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.FIELDS]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    manifest = merkle.build(table(spark, sf_dir, "documents"), keep={"edited": F.when(tampered, merkle.leaf_digest(edited))})
    changes = manifest.leaves.select("tree", "at", F.coalesce("edited", "leaf").alias("digest"), "doc_id", "leaf")
    digest = lambda c: F.lower(F.hex(c))
    root = F.lit(manifest.root).cast("binary")
    return merkle.fold(manifest, changes).select(
        "doc_id", digest("leaf").alias("leaf"), digest("root").alias("subroot"), digest(root).alias("root"),
        digest("proof").alias("proof_sha256"), digest("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id AS id, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
         lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
                                  lambda x, y: xor(x >> 1, (x % 2) * 3988292384))) AS c FROM (SELECT DISTINCT doc_id FROM documents)),
leaves AS (
  SELECT doc_id, source, {_LEAF.format("text")} AS leaf,
         CASE WHEN xor(c, 4294967295) % 2 = 0 THEN {_LEAF.format("replace(text, chr(10), '')")} END AS edited
  FROM documents LEFT JOIN crc ON id = doc_id),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, i, leaf AS h, n FROM numbered
  UNION ALL
  SELECT tree, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), max((n + 2) // 3) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 3),
subroots AS (SELECT tree, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS i, h, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), max((n + 2) // 3) FROM tops WHERE n > 1 GROUP BY level, i // 3),
depth AS (SELECT tree, max(level) AS d FROM nodes GROUP BY tree),
steps AS (
  SELECT l.tree, l.i, o.level, string_agg(CASE WHEN o.i < l.i // (3 ** o.level)::BIGINT THEN o.h END, '' ORDER BY o.i) AS before,
         string_agg(CASE WHEN o.i > l.i // (3 ** o.level)::BIGINT THEN o.h END, '' ORDER BY o.i) AS after
  FROM numbered l JOIN nodes o ON o.tree = l.tree AND o.n > 1 AND o.i // 3 = l.i // (3 ** (o.level + 1))::BIGINT AND o.i <> l.i // (3 ** o.level)::BIGINT
  GROUP BY l.tree, l.i, o.level),
top_steps AS (
  SELECT s.tree, o.level, string_agg(CASE WHEN o.i < s.tree // (3 ** o.level)::BIGINT THEN o.h END, '' ORDER BY o.i) AS before,
         string_agg(CASE WHEN o.i > s.tree // (3 ** o.level)::BIGINT THEN o.h END, '' ORDER BY o.i) AS after
  FROM subroots s JOIN tops o ON o.n > 1 AND o.i // 3 = s.tree // (3 ** (o.level + 1))::BIGINT AND o.i <> s.tree // (3 ** o.level)::BIGINT
  GROUP BY s.tree, o.level),
top AS (SELECT max(level) AS d FROM tops),
ways AS (
  SELECT l.tree, l.i, g.k AS level, coalesce(CASE WHEN g.k < d.d THEN s.before ELSE t.before END, '') AS before,
         coalesce(CASE WHEN g.k < d.d THEN s.after ELSE t.after END, '') AS after
  FROM numbered l JOIN depth d ON d.tree = l.tree JOIN (SELECT unnest(range(0, 64)) AS k) g ON g.k < d.d + (SELECT d FROM top)
  LEFT JOIN steps s ON s.tree = l.tree AND s.i = l.i AND s.level = g.k
  LEFT JOIN top_steps t ON t.tree = l.tree AND t.level = g.k - d.d),
folds AS (
  SELECT tree, i, 0 AS level, coalesce(edited, leaf) AS h FROM numbered
  UNION ALL
  SELECT f.tree, f.i, f.level + 1, sha256(w.before || f.h || w.after) FROM folds f JOIN ways w ON w.tree = f.tree AND w.i = f.i AND w.level = f.level),
folded AS (SELECT tree, i, arg_max(h, level) AS h FROM folds GROUP BY tree, i),
proofs AS (SELECT tree, i, sha256(string_agg(before || after, '' ORDER BY level)) AS p FROM ways GROUP BY tree, i),
root AS (SELECT h FROM tops WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM numbered l JOIN subroots s ON s.tree = l.tree JOIN folded f ON f.tree = l.tree AND f.i = l.i
LEFT JOIN proofs p ON p.tree = l.tree AND p.i = l.i, root r
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's phrases that stand together most."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
found AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM places, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)),
grams AS (SELECT lang, m, phrase, count(*) AS f FROM found GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE m > 1),
cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
         FROM candidates, (SELECT unnest(range(1, 5)) AS k) WHERE k < m),
weighed AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, s.n, ((1000::HUGEINT * c.a * s.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN grams l ON l.lang = c.lang AND l.phrase = c.x JOIN grams r ON r.lang = c.lang AND r.phrase = c.y JOIN sizes s ON s.lang = c.lang),
scored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM weighed) WHERE o = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[i:i + q - 1], ' ') AS phrase, max(f) AS around
  FROM candidates, (SELECT unnest(range(1, 5)) AS i), (SELECT unnest(range(2, 5)) AS q) WHERE q < m AND i + q - 1 <= m GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN inner_parts p ON p.lang = s.lang AND p.phrase = s.phrase WHERE p.around IS NULL OR p.around < s.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
SELECT * FROM ranked WHERE rank <= 2000
"""
