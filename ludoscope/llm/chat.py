"""Chat formatting with tool calls, in DataFrame functions only: link calls to results, order them, check arguments, write canonical JSON.

Message rows are (conv_id, turn, role, text, calls, call_id): an assistant's message may hold calls, a JSON array of objects
{"id", "name", "arguments"}; a tool's message holds the result of the call ``call_id``. A schema row is (name, params), where params
maps each parameter to "type" or "type?" (optional), type being string, integer, number, boolean, array, object or any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ludoscope.functions.scale import with_position
from ludoscope.llm.frames import ready
from ludoscope.session import stored


def json_string(text: Column) -> Column:
    """Text as a JSON string: short escapes where JSON has them, \\u00xx for other control characters, all else as it is."""
    return F.when(text.isNotNull(), F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", ""))


def json_type(value: Column) -> Column:
    """The JSON type of a value in JSON text; null where it is not one."""
    v = F.trim(value)
    return (
        F.when(v.startswith('"'), "string").when(v.startswith("{"), "object").when(v.startswith("["), "array")
        .when(v.isin("true", "false"), "boolean").when(v == "null", "null")
        .when(v.rlike(r"^-?(0|[1-9][0-9]*)$"), "integer").when(v.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), "number")
    )


def _fields(arguments: Column) -> Column:
    """An object's members in the order of their names: array of (name, raw value). Variants keep keys sorted and types apart."""
    parsed = F.try_parse_json(arguments)
    members = F.from_json(F.to_json(parsed), "map<string,variant>")
    entries = F.transform(F.map_entries(members), lambda e: F.struct(e["key"].alias("name"), F.to_json(e["value"]).alias("value")))
    return F.array_sort(entries)


def _canonical_number(token: Column) -> Column:
    """A number as RFC 8785 writes it: the shortest decimal of its double, without exponent from 1e-6 up to below 1e21."""
    value = token.try_cast("double")
    text = F.abs(value).cast("string")
    whole, fraction = F.regexp_extract(text, r"^([0-9]+)", 1), F.regexp_extract(text, r"\.([0-9]+)", 1)
    exponent = F.coalesce(F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    every = F.concat(whole, fraction)
    stripped = F.regexp_replace(every, "^0+", "")
    digits = F.regexp_replace(stripped, "0+$", "")
    n = F.length(whole) + exponent - (F.length(every) - F.length(stripped))
    k = F.length(digits)
    power = F.concat(F.when(n > 0, "+").otherwise("-"), F.abs(n - 1).cast("string"))
    plain = (
        F.when(k == 0, "0").when((k <= n) & (n <= 21), F.concat(digits, F.repeat(F.lit("0"), n - k)))
        .when((n > 0) & (n <= 21), F.concat(F.substring(digits, 1, n), F.lit("."), F.substring(digits, n + 1, k)))
        .when((n > -6) & (n <= 0), F.concat(F.lit("0."), F.repeat(F.lit("0"), -n), digits))
        .when(k == 1, F.concat(digits, F.lit("e"), power))
        .otherwise(F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, F.lit(2), k), F.lit("e"), power))
    )
    infinite = F.coalesce(F.abs(value) == float("inf"), F.lit(True))
    return F.when(infinite, token).when(value < 0, F.concat(F.lit("-"), plain)).otherwise(plain)


# Strings, numbers, and all between them.
_JSON_TOKENS = r'"(?:[^"\\]++|\\.)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++'
#: Without one of these outside or inside of strings, all numbers are short integers and stand as they should.
_ODD_NUMBER = r"[0-9][.eE]|[0-9]{16}|-0"


def canonical_json(value: Column) -> Column:
    """JSON text as RFC 8785 has it: no white space, members in the order of their names, numbers as those of doubles.

    Null if it is no JSON; an object that has a name twice is none.
    """
    text = F.to_json(F.try_parse_json(value))
    tokens = F.regexp_extract_all(text, F.lit(_JSON_TOKENS), 0)
    numbered = F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), _canonical_number(t)).otherwise(t))
    return F.when(text.rlike(_ODD_NUMBER), F.array_join(numbered, "")).otherwise(text)


def arguments_json(arguments: Column) -> Column:
    """A call's arguments in canonical JSON, given as a value or, as on the wire, as a string that holds one; other text as a string."""
    return F.coalesce(canonical_json(arguments), json_string(arguments))


def calls_json(calls: Column) -> Column:
    """A message's calls in canonical JSON, their arguments as ``arguments_json`` has them; what is no array of objects as it is."""
    given = F.from_json(calls, "array<struct<arguments:string>>")
    members = F.from_json(F.to_json(F.try_parse_json(calls)), "array<map<string,variant>>")

    def one(call: Column, i: Column) -> Column:
        arguments = F.coalesce(arguments_json(F.get(given, i)["arguments"]), F.lit("null"))
        pairs = F.transform(
            F.map_entries(call),
            lambda e: F.struct(e["key"].alias("key"), F.when(e["key"] == "arguments", arguments).otherwise(canonical_json(F.to_json(e["value"]))).alias("value")),
        )
        return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(json_string(p["key"]), F.lit(":"), p["value"])), ","), F.lit("}"))

    objects = F.coalesce(~F.exists(members, lambda m: m.isNull()), F.lit(False)) & F.trim(calls).startswith("[")
    listed = F.concat(F.lit("["), F.array_join(F.transform(members, one), ","), F.lit("]"))
    return F.coalesce(F.when(objects, listed), canonical_json(calls), json_string(calls))


def _problem(fields: Column, params: Column) -> Column:
    """Why arguments do not fit a schema, null if they do: the first of unknown, missing, wrong type, in the order of names."""
    names = F.transform(fields, lambda f: f["name"])
    unknown = F.filter(names, lambda n: ~F.map_contains_key(params, n))
    needed = F.map_keys(F.map_filter(params, lambda _, t: ~t.endswith("?")))
    missing = F.array_sort(F.array_except(needed, names))
    wrong = F.filter(
        fields,
        lambda f: ~F.coalesce(
            (F.element_at(params, f["name"]).substr(F.lit(1), F.length(json_type(f["value"]))) == json_type(f["value"]))
            | F.element_at(params, f["name"]).startswith("any")
            | ((json_type(f["value"]) == "integer") & F.element_at(params, f["name"]).startswith("number"))
            | ((json_type(f["value"]) == "null") & F.element_at(params, f["name"]).endswith("?")),
            F.lit(False),
        ),
    )
    return (
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown: "), F.get(unknown, 0)))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.get(missing, 0)))
        .when(F.size(wrong) > 0, F.concat(F.lit("wrong type: "), F.get(wrong, 0)["name"]))
    )


def _with_first(rows: DataFrame) -> DataFrame:
    """Rows with ``n``: 1 for the first under its identifier and for one without, else 2. A minimum joined back, so no key is gathered."""
    first = rows.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "place", "id")).alias("first"))
    first = first.select(F.col("conv_id").alias("_c"), F.col("call_id").alias("_k"), "first")
    both = rows.join(first, rows["conv_id"].eqNullSafe(F.col("_c")) & (rows["call_id"] == F.col("_k")), "left")
    later = F.coalesce(F.struct("turn", "place", "id") != F.col("first"), F.lit(False))
    return both.withColumn("n", F.when(later, 2).otherwise(1)).drop("_c", "_k", "first")


def link_calls(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result: conv_id, call_id, name, arguments (canonical), call_turn, result_turn, result, status, problem.

    Calls and results meet in a full hash join on (conv_id, call_id). Status is ``ok``; ``early`` (the result stands before its
    call); ``missing`` (no result); ``orphan`` (no call). Of calls, and of results, repeated under one identifier
    the first counts, in the order of turns and then of rows; later ones are ``repeated`` and linked with nothing. Problem says why
    the arguments do not fit the tool's schema: no JSON object, unknown tool, or see ``_problem``; null if they fit. Of schemas
    repeated under one name that with the most params counts, of those the largest as text. A call that is no object, or without id, is dropped
    from none of the counts: its identifier is null, and null identifiers never meet.
    """
    return _link(_numbered(messages), schemas).drop("call_row", "result_row")


def _numbered(messages: DataFrame) -> DataFrame:
    """The messages with numbers that tell equal rows apart, stored so that every later step sees the same ones."""
    return stored(messages.select("conv_id", "turn", "role", "text", "calls", "call_id", F.monotonically_increasing_id().alias("id")), "messages")


def _link(rows: DataFrame, schemas: DataFrame) -> DataFrame:
    """``link_calls`` on numbered rows, with the numbers of the call's and the result's message."""
    parsed = F.from_json("calls", "array<struct<id:string,name:string,arguments:string>>")
    calls = rows.where(F.col("calls").isNotNull()).select("conv_id", "turn", "id", F.posexplode(parsed).alias("place", "c"))
    calls = calls.select("conv_id", "turn", "id", "place", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"))
    results = rows.where("role = 'tool'").select("conv_id", "turn", "id", F.lit(0).alias("place"), "call_id", F.col("text").alias("result"))
    calls, results = _with_first(calls), _with_first(results)
    best = schemas.groupBy("name").agg(F.max_by("params", F.struct(F.size("params"), F.to_json("params"))).alias("params"))
    calls = calls.join(best, "name", "left").withColumn("fields", _fields(F.col("arguments")))
    problem = (
        F.when(F.col("fields").isNull() | ~F.coalesce(F.trim("arguments").startswith("{"), F.lit(False)), "no object")
        .when(F.col("params").isNull(), "unknown tool").otherwise(_problem(F.col("fields"), F.col("params")))
    )
    calls = calls.select(
        "conv_id", "call_id", "n", "name", arguments_json(F.col("arguments")).alias("arguments"), F.col("id").alias("call_row"),
        F.col("turn").alias("call_turn"), F.col("place").alias("call_place"), problem.alias("problem"), F.lit(True).alias("called"),
    )
    results = results.select("conv_id", "call_id", "n", F.col("id").alias("result_row"), F.col("turn").alias("result_turn"), "result", F.lit(True).alias("answered"))
    both = calls.alias("c").join(
        results.hint("shuffle_hash").alias("r"),
        (F.col("c.conv_id") == F.col("r.conv_id")) & (F.col("c.call_id") == F.col("r.call_id")) & (F.col("c.n") == 1) & (F.col("r.n") == 1), "full",
    )
    status = (
        F.when((F.coalesce(F.col("c.n"), F.lit(1)) > 1) | (F.coalesce(F.col("r.n"), F.lit(1)) > 1), "repeated")
        .when(F.col("called").isNull(), "orphan").when(F.col("answered").isNull(), "missing")
        .when(F.col("result_turn") < F.col("call_turn"), "early").otherwise("ok")
    )
    return both.select(
        F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"), F.coalesce("c.call_id", "r.call_id").alias("call_id"), "name", "arguments",
        "call_turn", "call_place", "result_turn", "result", status.alias("status"), "problem", "call_row", "result_row",
    )


def topological_order(messages: DataFrame, links: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text, ...) with ``place``: 0, 1, 2 ... per conversation, every result after its call.

    Turns give the order, and a result that stands before its call moves right behind it (after calls at that turn, before later
    ones; several by their own turns). Moving results only back and calls never leaves no cycle. Equal turns go by
    role, call and text. All rows are numbered in one global order of even ranges, less the number of the conversation's
    first row, so a very long conversation is dealt over many tasks.
    """
    early = links.where("status = 'early'")
    if "result_row" in links.columns and "id" in messages.columns:
        early = early.select(F.col("result_row").alias("id"), F.col("call_turn").alias("_after"))
        moved = messages.join(early, "id", "left")
    else:
        early = early.select("conv_id", "call_id", F.col("call_turn").alias("_after"), F.col("result_turn").alias("turn"), F.lit("tool").alias("role"))
        moved = messages.join(early.dropDuplicates(["conv_id", "call_id", "turn"]), ["conv_id", "call_id", "turn", "role"], "left")
    rows = moved.withColumn("_rank", F.coalesce("_after", "turn")).withColumn("_late", F.when(F.col("_after").isNull(), 0).otherwise(1))
    rows = rows.drop("_after")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "_rank", "_late", "turn", "role", "call_id", "text", "calls") if c in rows.columns]
    numbered = with_position(rows, order, "_global")
    first = numbered.groupBy(F.col("conv_id").alias("_c")).agg(F.min("_global").alias("_first"))
    both = numbered.join(first, F.col("conv_id").eqNullSafe(F.col("_c")))
    return both.select(*messages.columns, (F.col("_global") - F.col("_first")).alias("place"))


def format_messages(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Every message in topological order as a canonical JSON line: conv_id, turn, role, place, line, status, problem.

    The line has the keys call_id, calls, content, role in this order, those without a value left out, with calls in canonical JSON.
    Status and problem are those of the message's result or of its worst call (no status: neither calls nor result): the
    largest status by (orphan, repeated, missing, early, ok) and the first problem by text. Every row gives a line; null text
    is no content, an unknown role stays, a null role is no role. Columns beyond those named are ignored.
    """
    rows = _numbered(ready(messages))
    links = stored(_link(rows, schemas), "links")
    ranks = {"ok": 0, "early": 1, "missing": 2, "repeated": 3, "orphan": 4}
    rank = F.coalesce(*[F.when(F.col("status") == s, F.lit(r)) for s, r in ranks.items()])
    worst = F.max_by("status", rank).alias("status")
    # By the numbers of rows, not by keys: keys can be null, and two messages can stand at one turn.
    of_calls = links.where("call_row is not null").groupBy(F.col("call_row").alias("id")).agg(worst, F.min("problem").alias("problem"))
    of_results = links.where("result_row is not null").select(F.col("result_row").alias("id"), F.col("status").alias("answer"))
    placed = topological_order(rows, links)
    every = placed.join(of_calls, "id", "left").join(of_results, "id", "left")
    calling = F.col("calls").isNotNull()
    every = every.withColumn("status", F.when(calling, F.col("status")).otherwise(F.col("answer")))

    def member(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}":'), value)  # Null without a value.

    line = F.concat_ws(
        ",", member("call_id", json_string(F.col("call_id"))), member("calls", calls_json(F.col("calls"))),
        member("content", json_string(F.col("text"))), member("role", json_string(F.col("role"))),
    )
    return every.select("conv_id", "turn", "role", "place", F.concat(F.lit("{"), line, F.lit("}")).alias("line"), "status", "problem")
