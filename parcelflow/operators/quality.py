"""Declarative data tests.

Each test returns its failing rows as a DataFrame, and :func:`run_suite`
turns a list of tests into one result row each. Failure counts follow the
usual data-test semantics:

* ``not_null`` - rows where the column is NULL;
* ``unique`` - distinct non-NULL values (or expression values) that occur
  more than once;
* ``accepted_values`` - distinct non-NULL values outside the list;
* ``relationships`` - non-NULL child values with no parent row.

Cost: the suite is compiled into one plan (:func:`suite_counts`): every table
is read once, whatever the number of its tests, and there is one shuffle of
(test, value) counts.
A test naming a column the table does not have reports ``error`` (T9),
distinct from ``fail``; ``severity='warn'`` reports ``warn`` instead of
``fail``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import minutes_between
from .joins import orphans


@dataclass(frozen=True)
class Check:
    model: str
    kind: str                      # not_null | unique | accepted_values | relationships
    column: str                    # column name, or a SQL expression for unique
    values: tuple = ()             # accepted values
    to: str | None = None          # parent model for relationships
    field: str | None = None       # parent column for relationships
    severity: str = "error"
    quote: bool = True             # accepted values are strings (else numbers)

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.model}.{self.column}" + (f"->{self.to}.{self.field}" if self.to else "")


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Failing rows."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, expr: str) -> DataFrame:
    """Values (column or SQL expression) occurring more than once."""
    v = df.select(F.expr(expr).alias("value")).filter(F.col("value").isNotNull())
    return v.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Distinct non-NULL values outside ``values``."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
              .groupBy(col).agg(F.count(F.lit(1)).alias("n")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str | None = None) -> DataFrame:
    """E5: child rows whose non-NULL ``column`` has no ``field`` in ``parent``."""
    return orphans(child, column, parent, field)


def freshness(df: DataFrame, ts: str, now, warn_after_minutes: int = 30, error_after_minutes: int = 120,
              filter_days: int | None = 3,
              partition_col: str = "event_date") -> DataFrame:
    """One row ``(max_loaded_at, age_minutes, status)``. Only rows of the
    last ``filter_days`` days are scanned (a partition-bounded read on a
    day-partitioned table); no rows at all is ``error``."""
    now_c = F.lit(str(now)).cast("timestamp")
    if filter_days is not None:
        since = F.timestamp_add("DAY", F.lit(-int(filter_days)), now_c)
        df = df.filter(F.col(ts) >= since)
        if partition_col in df.columns:
            df = df.filter(F.col(partition_col) >= F.to_date(since))   # prunes the day folders
    m = df.agg(F.max(ts).alias("max_loaded_at"))
    age = minutes_between(F.col("max_loaded_at"), now_c)
    status = (F.when(F.col("max_loaded_at").isNull() | (age >= error_after_minutes), "error")
              .when(age >= warn_after_minutes, "warn").otherwise("pass"))
    return m.select("max_loaded_at", age.alias("age_minutes"), status.alias("status"))


RESULT_SCHEMA = T.StructType([
    T.StructField("test", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
])


def _status(n, severity):
    if n is None:
        return "error"
    if n == 0:
        return "pass"
    return "warn" if severity == "warn" else "fail"


def _missing_columns(expr: str, df: DataFrame) -> list[str]:
    """The column of a test expression that ``df`` does not have, as Spark's
    own analysis names it (no data is read)."""
    from pyspark.errors import AnalysisException
    try:
        df.selectExpr(f"({expr}) AS _test")
    except AnalysisException as e:
        name = (e.getMessageParameters() or {}).get("objectName")
        if not (e.getCondition() or "").startswith("UNRESOLVED_COLUMN") or not name:
            raise
        return [name.replace("`", "")]
    return []


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _key(expr: str, kind: str | None = None) -> str:
    """A value as text; numbers of two types in one form."""
    return f"cast(cast({expr} as {kind}) as string)" if kind else f"cast({expr} as string)"


def _compile(tables: dict[str, DataFrame], checks) -> tuple[dict[str, list[str]], dict[int, tuple]]:
    """(tags, failed): for each table the SQL of what a row says about each
    check - a struct(check, value, child, parent), or null - and the checks
    that can't run, with their message."""
    tags: dict[str, list[str]] = {}
    failed: dict[int, tuple] = {}
    types = {m: dict(df.dtypes) for m, df in tables.items() if df is not None}

    def tag(model, k, cond, value, child, parent=0):
        tags.setdefault(model, []).append(f"case when {cond} then struct({k} as check, {value} as value, {child}L as child, {parent}L as parent) end")

    for k, c in enumerate(checks):
        if c.model not in types:
            failed[k] = (None, f"missing model {c.model}")
        elif c.kind == "unique":
            missing = _missing_columns(c.column, tables[c.model])
            if missing:
                failed[k] = (None, f"missing column {missing[0]}")
            else:
                tag(c.model, k, f"({c.column}) is not null", _key(f"({c.column})"), 1)
        elif c.column not in types[c.model]:
            failed[k] = (None, f"missing column {c.column}")
        elif c.kind == "not_null":
            tag(c.model, k, f"`{c.column}` is null", "cast(null as string)", 1)
        elif c.kind == "accepted_values":
            allowed = ", ".join("'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else repr(v) for v in c.values)
            tag(c.model, k, f"`{c.column}` is not null and `{c.column}` not in ({allowed})" if allowed else f"`{c.column}` is not null", _key(f"`{c.column}`"), 1)
        elif c.kind == "relationships":
            field = c.field or c.column
            if c.to not in types or field not in types[c.to]:
                failed[k] = (None, f"missing parent {c.to}.{field}")
                continue
            one, other = types[c.model][c.column], types[c.to][field]
            wide = "decimal(38,10)" if one != other and one.startswith(NUMBERS) and other.startswith(NUMBERS) else None
            tag(c.model, k, f"`{c.column}` is not null", _key(f"`{c.column}`", wide), 1)
            tag(c.to, k, f"`{field}` is not null", _key(f"`{field}`", wide), 0, 1)
        else:
            raise ValueError(f"unknown kind of test {c.kind}")
    return tags, failed


def suite_counts(tables: dict[str, DataFrame], checks) -> DataFrame | None:
    """(check, n): failures of the checks, numbered as they come, that have any.

    One plan for the whole suite: each table is read once, and each row says
    what it has for all its tests at once - a null, a value of a unique key, a
    value outside its list, a child's or a parent's key. These are counted per
    (check, value) before and after one shuffle, so a value that fills the table
    is one row per task, and then per check."""
    tags, _ = _compile(tables, checks)
    said = None
    for model, cases in tags.items():
        d = tables[model].select(F.expr(f"inline(filter(array({', '.join(cases)}), t -> t is not null))"))
        said = d if said is None else said.unionByName(d)
    if said is None:
        return None
    kind = {k: c.kind for k, c in enumerate(checks)}
    by = said.groupBy("check", "value").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    of = lambda name: F.col("check").isin([k for k, v in kind.items() if v == name])
    n = (F.when(of("not_null"), F.col("child")).when(of("unique"), (F.col("child") > 1).cast("long")).when(of("accepted_values"), F.lit(1).cast("long"))
         .otherwise(F.when(F.col("parent") == 0, F.col("child")).otherwise(0)))
    return by.groupBy("check").agg(F.sum(n).alias("n"))


def run_suite(spark: SparkSession, tables: dict[str, DataFrame], checks) -> DataFrame:
    """Run ``checks`` over ``tables`` and return one result row per check,
    by one job over all of them (:func:`suite_counts`); one small row per test
    reaches the driver."""
    checks = list(checks)
    _, failed = _compile(tables, checks)
    counts = suite_counts(tables, checks)
    found = {r["check"]: int(r["n"]) for r in counts.collect()} if counts is not None else {}
    rows = []
    for k, c in enumerate(checks):
        n, msg = failed.get(k, (found.get(k, 0), None))
        rows.append((c.name, c.model, c.kind, c.column, c.severity, n, _status(n, c.severity), msg))
    return spark.createDataFrame(rows, RESULT_SCHEMA)
