"""Dashboard panels as named, parameterised queries."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyloom.functions.scalar import VARIABLE_PATTERN as _VARIABLE, slugify
from skyloom.operators.fulltext import KEYWORD_COLUMNS

# Known panel variables and their parameter types, fixed values.
VARIABLES = {
    "region": "string",
    "keyword": "string",
    "search_categories": "string",
    "latitude": "number",
    "longitude": "number",
}
# Variables whose value is a column name.
COLUMN_VARIABLES = ("search_categories",)
# The time macro of a dashboard, fixed value.
_TIME_MACRO = "$__timeFilter"
# SQL text apart from code: comments, texts, quoted names. An unfinished one runs to the end.
_PARTS = re.compile(
    r"--[^\n]*"
    r"|/\*.*?(?:\*/|\Z)"
    r"|'(?:[^'\\]|\\.|'')*(?:'|\Z)"
    r'|"(?:[^"]|"")*(?:"|\Z)'
    r"|`(?:[^`]|``)*(?:`|\Z)",
    re.S,
)

DASHBOARD_SCHEMA = T.StructType(
    [
        T.StructField(
            "panels",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType()),
                        T.StructField("type", T.StringType()),
                        T.StructField("title", T.StringType()),
                        T.StructField(
                            "targets",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("refId", T.StringType()),
                                        T.StructField("rawSql", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def panels_of(dashboards: DataFrame) -> DataFrame:
    """Panels that carry SQL: ``(dashboard, position, id, title, name, raw_sql)``.

    ``dashboards`` has a ``dashboard`` column and the ``panels`` array of one document. Row headers are
    skipped, the first target with SQL counts. Names are unique within a document: a name already taken
    gets ``_<id>``, and a further number if that is taken too.
    """

    def sqls(panel: Column) -> Column:
        return F.filter(panel["targets"], lambda t: t["rawSql"].isNotNull() & (t["rawSql"] != ""))

    def is_query(panel: Column) -> Column:
        is_row = F.coalesce(panel["type"] == "row", F.lit(False))
        return ~is_row & (F.coalesce(F.size(sqls(panel)), F.lit(0)) > 0)

    def describe(panel: Column) -> Column:
        title = F.coalesce(panel["title"], F.concat(F.lit("panel_"), panel["id"].cast("string")))
        return F.struct(
            panel["id"].alias("id"),
            title.alias("title"),
            slugify(title).alias("slug"),
            F.get(sqls(panel), F.lit(0))["rawSql"].alias("raw_sql"),
        )

    def next_name(taken: Column, panel: Column) -> Column:
        numbered = F.concat(panel["slug"], F.lit("_"), panel["id"].cast("string"))
        # one of so many candidates is free, as the names taken are fewer
        more = F.transform(
            F.sequence(F.lit(2), F.size(taken) + 2), lambda k: F.concat(numbered, F.lit("_"), k.cast("string"))
        )
        candidates = F.concat(F.array(panel["slug"], numbered), more)
        free = F.filter(candidates, lambda name: name.isNotNull() & ~F.array_contains(taken, name))
        return F.concat(taken, F.array(F.get(free, F.lit(0))))

    described = dashboards.select("dashboard", F.transform(F.filter("panels", is_query), describe).alias("ps"))
    named = described.withColumn(
        "names", F.aggregate("ps", F.array().cast("array<string>"), next_name)
    )
    rows = named.select("dashboard", "names", F.posexplode("ps").alias("position", "p"))
    return rows.select(
        "dashboard", "position", "p.id", "p.title", F.get("names", F.col("position")).alias("name"), "p.raw_sql"
    )


def load_panels(spark: SparkSession, path: str) -> DataFrame:
    """Panels of dashboard JSON documents: a file or a folder of them."""
    docs = spark.read.schema(DASHBOARD_SCHEMA).option("multiLine", True).json(path)
    return panels_of(docs.select(F.input_file_name().alias("dashboard"), "panels"))


def dedupe_slug(df: DataFrame, slug: str, id_col: str, order_col: str, out: str = "name") -> DataFrame:
    """Names over a whole table: the first row of a slug keeps it, later ones get ``_<id>``.

    Rows of one slug get different names; a slug that itself ends in another row's slug and id may still meet it.
    """
    firsts = df.groupBy(slug).agg(F.min(order_col).alias("_first"))
    joined = df.join(firsts, [slug])
    numbered = F.concat(F.col(slug), F.lit("_"), F.col(id_col).cast("string"))
    return joined.withColumn(
        out, F.when(F.col(order_col) == F.col("_first"), F.col(slug)).otherwise(numbered)
    ).drop("_first")


def panel_variables(panels: DataFrame) -> DataFrame:
    """Parameters of each panel: ``(dashboard, name, parameter, type)``.

    Built-ins (``$__…``) and unknown variables are no parameters; a time filter adds ``time_from`` and
    ``time_to``.
    """
    used = F.array_distinct(F.regexp_extract_all("raw_sql", F.lit(_VARIABLE), F.lit(1)))
    known = F.filter(used, lambda v: v.isin(*VARIABLES))
    times = F.when(
        F.contains("raw_sql", F.lit("$__timeFilter")), F.array(F.lit("time_from"), F.lit("time_to"))
    ).otherwise(F.array().cast("array<string>"))
    numbers = [v for v, kind in VARIABLES.items() if kind == "number"]
    rows = panels.select("dashboard", "name", F.explode(F.concat(known, times)).alias("parameter"))
    kind = F.when(F.col("parameter").isin(*numbers), "number").otherwise("string")
    return rows.withColumn("type", kind)


def render_panel(raw_sql: str, args: dict[str, Any]) -> tuple[str, dict[str, Any]]:
    """Panel SQL with named parameters in place of variables, and the values they take.

    ``'$x'`` and ``$x`` become ``:x``, text around a variable inside quotes is concatenated, and a
    variable that stands for a column becomes an identifier. Values never become SQL text.
    """
    values: dict[str, Any] = {}

    def parameter(name: str) -> str:
        if name not in VARIABLES:
            raise ValueError(f"unknown panel variable ${name}")
        if args.get(name) is None:
            raise ValueError(f"no value given for ${name}")
        value = args[name]
        if name in COLUMN_VARIABLES and value not in KEYWORD_COLUMNS:
            raise ValueError(f"{name} must be exactly one of {KEYWORD_COLUMNS}, not {value!r}")
        values[name] = float(value) if VARIABLES[name] == "number" else str(value)
        return f":{name}"

    def time_filter(column: str) -> str:
        for bound in ("time_from", "time_to"):
            if not args.get(bound):
                raise ValueError(f"{_TIME_MACRO} takes its bounds from time_from and time_to; {bound} is missing")
            values[bound] = str(args[bound])
        column = re.sub(r'"([^"]+)"', r"`\1`", column.strip())
        return f"({column} BETWEEN :time_from AND :time_to)"

    def quoted(match: re.Match) -> str:
        pieces = re.split(_VARIABLE, match.group(0)[1:-1])
        if len(pieces) == 1:
            return match.group(0)
        parts = []
        for i, piece in enumerate(pieces):
            if i % 2:
                parts.append(parameter(piece))
            elif piece:
                parts.append(f"'{piece}'")
        return parts[0] if len(parts) == 1 else "concat(" + ", ".join(parts) + ")"

    def bare(match: re.Match) -> str:
        name = match.group(1)
        placeholder = parameter(name)
        return f"IDENTIFIER({placeholder})" if name in COLUMN_VARIABLES else placeholder

    rendered = []
    for kind, chunk in _sql_parts(_expanded(raw_sql, time_filter)):
        if kind == "text":
            rendered.append(re.sub(r"^'.*'$", quoted, chunk, flags=re.S))
        else:
            rendered.append(re.sub(_VARIABLE, bare, chunk) if kind == "code" else chunk)
    return "".join(rendered), values


def _sql_parts(sql: str) -> Iterator[tuple[str, str]]:
    """``sql`` in order as (kind, chunk): ``code``, ``text`` in single quotes, or ``other``, which stays as it is."""
    at = 0
    for match in _PARTS.finditer(sql):
        yield "code", sql[at : match.start()]
        yield ("text" if match.group(0).startswith("'") else "other"), match.group(0)
        at = match.end()
    yield "code", sql[at:]


def _expanded(sql: str, filter_of: Callable[[str], str]) -> str:
    """``sql`` with each time macro in its code replaced; its argument ends at the matching parenthesis."""
    out, depth, argument = [], 0, []
    for kind, chunk in _sql_parts(sql):
        while chunk:
            if depth:
                if kind != "code":
                    argument.append(chunk)
                    break
                for end, c in enumerate(chunk):
                    depth += (c == "(") - (c == ")")
                    if depth == 0:
                        break
                else:
                    argument.append(chunk)
                    break
                out.append(filter_of("".join([*argument, chunk[:end]])))
                chunk, argument = chunk[end + 1 :], []
            else:
                start = re.search(re.escape(_TIME_MACRO) + r"\s*\(", chunk) if kind == "code" else None
                out.append(chunk[: start.start()] if start else chunk)
                chunk = chunk[start.end() :] if start else ""
                depth = 1 if start else 0
    if depth:
        raise ValueError(f"{_TIME_MACRO} without a closing parenthesis")
    return "".join(out)


def panel_query(spark: SparkSession, raw_sql: str, **args: Any) -> DataFrame:
    """Run one panel over the registered tables."""
    sql, values = render_panel(raw_sql, args)
    return spark.sql(sql, args=values)


def query_sql(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, schema: str | None = None) -> DataFrame:
    """Ad-hoc SQL over the registered tables; unqualified names resolve in ``schema``."""
    if schema is None:
        return spark.sql(sql, args=args or {})
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(schema)
    try:
        return spark.sql(sql, args=args or {})
    finally:
        spark.catalog.setCurrentDatabase(before)


def discover(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Tables and their columns: ``(table_name, column_name, data_type)``."""
    rows = [
        (table.name, column.name, column.dataType)
        for table in spark.catalog.listTables(schema)
        for column in spark.catalog.listColumns(
            table.name if table.isTemporary else ".".join([*(table.namespace or []), table.name])
        )
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
