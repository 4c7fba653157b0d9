"""Tool calls of chats: linked to results, ordered, checked against schemas, serialised.

Everything here is DataFrame and SQL functions. Calls and results meet in a hash join by
conversation and identifier (an identifier is unique in its conversation only); results of one identifier are
reduced to the first before it. A call's level is the
length of the longest chain of calls it must follow: pointer doubling where each call follows
one other at most, else rounds that peel off calls nothing waits for. Arguments are parsed as variants,
whose objects hold their keys in order, so that ``to_json`` of a variant is canonical: sorted keys,
no white space, plain numbers.

Defined results: of several results of one call the one with the least turn (then content) is taken;
a result without a call is a row of status ``orphan``; calls that wait for each other have status
``cycle`` and a null level; unknown, repeated or own identifiers in ``after`` are ignored; calls with a null id
are ``unnamed`` and link to nothing; equal identifiers of several calls of a conversation give a row each, all linked
to the same result; rows of a null conversation form one; arguments that are no JSON object are invalid and appear as null; tools without schema
are invalid; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import realigned, written

#: Rows of a schema table that is broadcast, at most.
BROADCAST_SCHEMAS = 10_000
#: Rounds of a deep graph whose levels are put together in one table.
FOLD = 16


def canonical(json: Column) -> Column:
    """Canonical text of a JSON text, null if it is none."""
    return F.to_json(F.try_parse_json(json))


def identifier(conversation: Column, call: Column) -> Column:
    """One text for a call's name inside its conversation; null for calls without a name."""
    return F.when(call.isNotNull(), F.to_json(F.struct(conversation.alias("v"), call.alias("c"))))


def levels(calls: DataFrame, key: str = "call_id", after: str = "after", conversation: str = "conv_id") -> DataFrame:
    """``_call`` (``identifier``) and ``level`` of every call that follows another, null level in and behind cycles.

    Identifiers count inside their conversation only.
    """
    of = F.col(conversation)
    named = calls.where(F.col(key).isNotNull())
    known = named.select(identifier(of, F.col(key)).alias("_parent")).distinct()
    edges = named.select(of.alias("_v"), F.col(key).alias("_c"), F.explode(after).alias("_p")).where("_c <> _p")
    edges = edges.select(identifier(F.col("_v"), F.col("_c")).alias("_call"), identifier(F.col("_v"), F.col("_p")).alias("_parent")).distinct()
    edges = written(edges.join(realigned(known, "_parent"), "_parent", "left_semi").select("_call", "_parent"), "call-order")
    total, children = edges.agg(F.count("*"), F.count_distinct("_call")).first()
    if not total:
        return edges.select("_call", F.lit(0).alias("level"))
    if total == children:
        return _levels_of_forest(edges, total)
    return _levels_by_peeling(edges)


def _levels_of_forest(edges: DataFrame, total: int) -> DataFrame:
    """Each call follows one other: distances to the first call double each round."""
    far = edges.select("_call", F.col("_parent").alias("_end"), F.lit(1).cast("long").alias("level"))
    for _ in range(total.bit_length() + 1):
        step = far.select(F.col("_call").alias("_end"), F.col("_end").alias("_next"), F.col("level").alias("_more"))
        far = written(far.join(step, "_end", "left").select("_call", F.coalesce("_next", "_end").alias("_end"), (F.col("level") + F.coalesce("_more", F.lit(0))).alias("level"), F.col("_next").isNotNull().alias("_moved")), "call-levels")
        if not far.where("_moved").head(1):
            break
    # Whoever still moves after so many rounds goes round in a circle.
    return far.select("_call", F.when(~F.col("_moved"), F.col("level")).cast("int").alias("level"))


def _levels_by_peeling(edges: DataFrame) -> DataFrame:
    """In round r the calls left that follow another have level r at least; as many rounds as the graph is deep."""

    def highest(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("_call").agg(F.max("level").alias("level"), F.max("_stuck").alias("_stuck"))

    left, parts, size, r = edges, [], -1, 1
    while now := left.count():
        stuck = now == size  # only circles and what waits for them are left
        parts.append(left.select("_call", F.lit(r).alias("level"), F.lit(stuck).alias("_stuck")))
        if stuck:
            break
        if len(parts) >= FOLD:
            parts = [written(highest(parts), "call-levels")]
        waiting = left.select(F.col("_call").alias("_parent")).distinct()
        left = written(left.join(realigned(waiting, "_parent"), "_parent", "left_semi").select("_call", "_parent"), "call-order")
        size, r = now, r + 1
    return highest(parts).select("_call", F.when(~F.col("_stuck"), F.col("level")).alias("level"))


def type_fits(kind: Column, wanted: Column) -> Column:
    """Whether the type of a variant is what a schema asks for."""
    number = kind.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$")
    return (
        F.when(wanted == "string", kind == "STRING")
        .when(wanted == "integer", kind == "BIGINT")
        .when(wanted == "number", number)
        .when(wanted == "boolean", kind == "BOOLEAN")
        .when(wanted == "object", kind.startswith("OBJECT"))
        .when(wanted == "array", kind.startswith("ARRAY"))
        .when(wanted == "null", kind == "VOID")
        .otherwise(F.lit(True))
    )


def argument_errors(kinds: Column, fields: Column) -> Column:
    """Sorted complaints about arguments: ``kinds`` maps each to its type, ``fields`` is the schema."""

    def of(f: Column) -> Column:
        kind = F.try_element_at(kinds, f["field"])
        return (
            F.when(kind.isNull() & f["required"], F.concat(f["field"], F.lit(": missing")))
            .when(kind.isNotNull() & ~type_fits(kind, f["type"]), F.concat(f["field"], F.lit(": not "), f["type"]))
        )

    wrong = F.filter(F.transform(fields, of), lambda e: e.isNotNull())
    extra = F.array_except(F.map_keys(kinds), F.transform(fields, lambda f: f["field"]))
    return F.array_sort(F.concat(wrong, F.transform(extra, lambda k: F.concat(k, F.lit(": unknown")))))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result without a call.

    ``calls``: ``conv_id``, ``call_id``, ``turn``, ``name``, ``arguments`` (JSON), ``after`` (array of ids).
    ``results``: ``conv_id``, ``call_id``, ``turn``, ``content``. ``schemas``: ``name``, ``fields`` (array of
    ``field``, ``type``, ``required``). Returns ``conv_id``, ``call_id``, ``name``, ``turn``, ``level``, ``status``,
    ``valid``, ``errors`` (joined by "; "), ``message`` (canonical JSON). ``level``, then ``turn`` and
    ``call_id``, is an order in which every call comes after those it follows.
    """
    of = identifier(F.col("conv_id"), F.col("call_id")).alias("_id")
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments", "after", of)
    first = results.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("_r")).select(of, F.struct("conv_id", "call_id", "_r.turn", "_r.content").alias("_r"))
    ids = calls.where("call_id is not null").select("_id").distinct()
    schemas = schemas.groupBy("name").agg(F.min("fields").alias("_fields"))
    if schemas.limit(BROADCAST_SCHEMAS + 1).count() <= BROADCAST_SCHEMAS:
        schemas = F.broadcast(schemas)
    order = levels(calls)
    parsed = F.try_parse_json("arguments")
    rows = calls.join(realigned(first, "_id").hint("shuffle_hash"), "_id", "left").join(order, F.col("_id") == F.col("_call"), "left").join(schemas, "name", "left")
    rows = rows.withColumn("_kinds", F.transform_values(F.expr("try_cast(try_parse_json(arguments) as map<string, variant>)"), lambda k, v: F.schema_of_variant(v)))
    errors = (
        F.when(F.col("_kinds").isNull(), F.array(F.lit("arguments: no object")))
        .when(F.col("_fields").isNull(), F.array(F.lit("schema: unknown")))
        .otherwise(argument_errors(F.col("_kinds"), F.col("_fields")))
    )
    in_circle = F.col("_call").isNotNull() & F.col("level").isNull()
    status = F.when(F.col("call_id").isNull(), "unnamed").when(in_circle, "cycle").when(F.col("_r").isNull(), "open").otherwise("linked")
    arguments = F.when(F.col("_kinds").isNotNull(), parsed)
    message = F.to_json(F.struct(arguments.alias("arguments"), F.col("call_id"), F.col("name"), F.col("_r.content").alias("result")), {"ignoreNullFields": "false"})
    level = F.when(~in_circle, F.coalesce("level", F.lit(0)).cast("int"))
    text = F.array_join(errors, "; ")
    made = rows.select("conv_id", "call_id", "name", "turn", level.alias("level"), status.alias("status"), (F.size(errors) == 0).alias("valid"), text.alias("errors"), message.alias("message"))
    lost = realigned(first, "_id").join(realigned(ids, "_id"), "_id", "left_anti").select("_r", F.col("_r.call_id").alias("call_id"))
    nothing = F.lit(None).cast("string")
    message = F.to_json(F.struct(F.lit(None).cast("string").alias("arguments"), F.col("call_id"), nothing.alias("name"), F.col("_r.content").alias("result")), {"ignoreNullFields": "false"})
    orphans = lost.select(F.col("_r.conv_id").alias("conv_id"), "call_id", nothing.alias("name"), F.col("_r.turn").alias("turn"), F.lit(None).cast("int").alias("level"), F.lit("orphan").alias("status"), F.lit(False).alias("valid"), F.lit("call: missing").alias("errors"), message.alias("message"))
    return made.unionByName(orphans)


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and schemas that a plain chat log stands for.

    A user turn calls ``open`` (turn 0) or ``follow``, after the call two turns before; an assistant turn
    is the result of the turn before it. ``follow`` must name its previous call.
    """
    c = conversations
    name = F.when(F.col("turn") == 0, "open").otherwise("follow")
    before = F.when(F.col("turn") >= 2, F.concat_ws(":", "conv_id", F.col("turn") - 2))
    given = F.to_json(F.struct("turn", "text", before.alias("previous")), {"ignoreNullFields": "true"})
    user = c.where("role = 'user'")
    calls = user.select("conv_id", F.concat_ws(":", "conv_id", "turn").alias("call_id"), "turn", name.alias("name"), given.alias("arguments"), F.when(before.isNotNull(), F.array(before)).otherwise(F.array().cast("array<string>")).alias("after"))
    results = c.where("role = 'assistant'").select("conv_id", F.concat_ws(":", "conv_id", F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    field = "array<struct<field: string, type: string, required: boolean>>"
    common = "struct('text', 'string', true), struct('turn', 'integer', true)"
    schemas = c.sparkSession.range(1).select(F.explode(F.expr(f"array(struct('open' as name, cast(array({common}) as {field}) as fields), struct('follow' as name, cast(array({common}, struct('previous', 'string', true)) as {field}) as fields))")).alias("s")).select("s.*")
    return calls, results, schemas


def chat_log(conversations: DataFrame) -> DataFrame:
    """Linked, ordered, checked and serialised calls of a table of turns (``conv_id``, ``turn``, ``role``, ``text``)."""
    return linked(*calls_of(conversations))


#: DuckDB SQL of ``chat_log`` over the table ``conversations``.
CHAT_LOG_SQL = """
with calls as (
  select conv_id, concat_ws(':', conv_id, turn) as call_id, turn, case when turn = 0 then 'open' else 'follow' end as name,
    text, case when turn >= 2 then concat_ws(':', conv_id, turn - 2) end as previous
  from conversations where role = 'user'),
results as (
  select conv_id, concat_ws(':', conv_id, turn - 1) as call_id, min({'turn': turn, 'content': text}) as r
  from conversations where role = 'assistant' group by 1, 2),
ids as (select distinct call_id from calls),
depth as (
  with recursive walk(call_id, level) as (
    select c.call_id, 0 from ids c where not exists (select 1 from calls x join ids p on x.previous = p.call_id where x.call_id = c.call_id)
    union all
    select x.call_id, w.level + 1 from walk w join (select distinct call_id, previous from calls) x on x.previous = w.call_id)
  select call_id, max(level) as level from walk group by 1),
checked as (
  select c.*, r.r, d.level,
    array_to_string(list_sort(list_filter([
      case when text is null then 'text: missing' end,
      case when name = 'open' and previous is not null then 'previous: unknown' when name = 'follow' and previous is null then 'previous: missing' end], lambda x: x is not null)), '; ') as errors,
    '{' || array_to_string(list_filter([
      case when previous is not null then '"previous":' || cast(to_json(previous) as varchar) end,
      case when text is not null then '"text":' || cast(to_json(text) as varchar) end,
      '"turn":' || turn], lambda x: x is not null), ',') || '}' as arguments
  from calls c left join results r on r.call_id = c.call_id left join depth d on d.call_id = c.call_id)
select conv_id, call_id, name, turn, cast(level as integer) as level, case when r is null then 'open' else 'linked' end as status, errors = '' as valid, errors,
  '{"arguments":' || arguments || ',"call_id":' || cast(to_json(call_id) as varchar) || ',"name":"' || name || '","result":' || coalesce(cast(to_json(r.content) as varchar), 'null') || '}' as message
from checked
union all
select r2.conv_id, r2.call_id, null, r.turn, null, 'orphan', false, 'call: missing',
  '{"arguments":null,"call_id":' || cast(to_json(r2.call_id) as varchar) || ',"name":null,"result":' || coalesce(cast(to_json(r.content) as varchar), 'null') || '}'
from results r2 where r2.call_id not in (select call_id from ids)
"""
