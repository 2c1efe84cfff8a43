"""Places of pattern matches in a text, in code points, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def none() -> Column:
    return F.array().cast(SPANS)


def found(text: Column, pattern: str, kind: str, value_group: int = 0) -> Column:
    """All leftmost non-overlapping matches: kind, start, exclusive end, and the match or one of its groups.

    The places come from the lengths of the matches and of what lies between them. The pattern must not match nothing.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)).alias("gap"),
        whole.alias("match"),
        (whole if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))).alias("value"),
    )

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["out"], span).alias("out"))

    first = F.struct(F.lit(0).alias("at"), none().alias("out"))
    return F.aggregate(pairs, first, step, lambda s: s["out"])


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then by kind in the given order, comma-joined."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(order, s["kind"]).alias("place"), s["end"], s["kind"]))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def sql_found(text: str, pattern: str, kind: str, value_group: int = 0) -> str:
    """The same as DuckDB SQL: a list of structs."""
    quoted = pattern.replace("'", "''")
    matches = f"regexp_extract_all({text}, '{quoted}')"
    values = f"regexp_extract_all({text}, '{quoted}', {value_group})"
    length = "list_sum(list_transform({}, lambda x: length(x)))"
    start = f"({length.format('g[1:i]')} + coalesce({length.format('m[1:i-1]')}, 0))::INT"
    return (
        f"(SELECT list_transform(range(1, len(m) + 1), lambda i: {{'kind': '{kind}', 'start': {start}, 'end': ({start} + length(m[i]))::INT, 'value': v[i]}}) "
        f"FROM (SELECT {matches} AS m, string_split_regex({text}, '{quoted}') AS g, {values} AS v))"
    )


def sql_joined(spans: str, kinds: tuple[str, ...]) -> str:
    order = "[" + ", ".join(f"'{k}'" for k in kinds) + "]"
    keyed = f"list_sort(list_transform({spans}, lambda s: {{'a': s.start, 'p': list_position({order}, s.kind), 'e': s.end, 'k': s.kind}}))"
    return f"coalesce(array_to_string(list_transform({keyed}, lambda s: s.k || ':' || s.a || ':' || s.e), ','), '')"
