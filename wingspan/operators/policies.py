"""Row filters and column masks that live on the table (SE1, SE2, SE4, SRC13, UD1, UD2, SNK14).

A policy is a property of a catalog table, ``wingspan.row_filter.<column>`` or
``wingspan.column_mask.<column>`` with the name of its function, so it goes
where the table goes.  :func:`read_secured` is the one way to the rows: it looks
up the policies in force at each read and applies them
(:mod:`wingspan.operators.security`).  :func:`inventory` lists what the tables
carry at that moment.

A policy whose function is unknown, or whose column the table no longer has,
stops the read: nothing is shown without its policy.  A table has one row
filter at most and any number of masks; without a filter every row is shown,
without any policy also every value.  Callers without a grant see no row of a
filtered table and no masked value of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.operators import security as sec

# The functions that a policy may name, by kind.
FUNCTIONS = {"row_filter": "airline_row_filter", "column_mask": "financial_mask"}
_PREFIX = "wingspan."


def _quoted(table: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in table.split("."))


def _property(kind: str, column: str) -> str:
    if kind not in FUNCTIONS:
        raise ValueError(f"unknown kind of policy: {kind}")
    return (_PREFIX + kind + "." + column).replace("\\", "\\\\").replace("'", "\\'")


def policies(spark: SparkSession, table: str) -> list[tuple[str, str, str]]:
    """(kind, column, function) of the policies in force on a table, in order."""
    found = []
    for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").collect():  # the properties of one table
        kind, _, column = r["key"].removeprefix(_PREFIX).partition(".")
        if r["key"].startswith(_PREFIX) and kind in FUNCTIONS:
            found.append((kind, column, r["value"]))
    return sorted(found, key=lambda p: (p[0] != "row_filter", p[1]))


def set_policy(spark: SparkSession, table: str, kind: str, column: str) -> None:
    """Put a policy on a column of a table; a second row filter is an error."""
    name = _property(kind, column)
    if column not in spark.table(_quoted(table)).columns:
        raise ValueError(f"{table} has no column {column}")
    if kind == "row_filter" and any(k == kind and c != column for k, c, _ in policies(spark, table)):
        raise ValueError(f"{table} has a row filter already")
    spark.sql(f"ALTER TABLE {_quoted(table)} SET TBLPROPERTIES ('{name}' = '{FUNCTIONS[kind]}')")


def drop_policy(spark: SparkSession, table: str, kind: str, column: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(table)} UNSET TBLPROPERTIES IF EXISTS ('{_property(kind, column)}')")


def read_secured_many(spark: SparkSession, table: str, ents: DataFrame,
                      callers: list[tuple[str, list[str]]]) -> DataFrame:
    """The table as each of the callers may see it, with a ``caller`` column, in one pass."""
    df = spark.table(_quoted(table))
    filters, masked = [], []
    for kind, column, function in policies(spark, table):
        if function != FUNCTIONS[kind] or column not in df.columns:
            raise PermissionError(f"{table}: the {kind} {function} on {column} cannot be applied")
        (filters if kind == "row_filter" else masked).append(column)
    if len(filters) > 1:
        raise PermissionError(f"{table} has several row filters")
    plain = {c: f"col_{i}" for i, c in enumerate(df.columns)}  # columns may have any name
    rows, masked = df.toDF(*plain.values()), [plain[c] for c in masked]
    if filters:
        return sec.secure_many(rows, ents, callers, plain[filters[0]], tuple(masked)).toDF("caller", *df.columns)
    see = sec.caller_grants(ents, callers).filter("_see").agg(F.collect_set("caller")).scalar()
    every = rows.withColumn("caller", F.explode(F.array(*[F.lit(c) for c, _ in callers])))
    shown = every.withColumns({c: F.when(F.array_contains(see, F.col("caller")), F.col(c)) for c in masked})
    return shown.select("caller", *plain.values()).toDF("caller", *df.columns)


def read_secured(spark: SparkSession, table: str, ents: DataFrame, caller: str, groups: list[str]) -> DataFrame:
    """SE1 + SE2: the table as one caller may see it, by the policies in force."""
    seen = read_secured_many(spark, table, ents, [(caller, groups)])
    names = seen.columns
    return seen.toDF(*[f"col_{i}" for i in range(len(names))]).drop("col_0").toDF(*names[1:])


def export_guard(spark: SparkSession, table: str) -> None:
    """SNK14: refuse to export a table that carries a policy."""
    held = policies(spark, table)
    if held:
        raise PermissionError(f"{table} has {len(held)} policies; refusing to export")


def inventory(spark: SparkSession, database: str, ents: DataFrame) -> DataFrame:
    """SE4 + SRC13: one row a policy in force in a database, with the principals that it lets see everything."""
    rows = [(t.name, *p) for t in spark.catalog.listTables(database) if not t.isTemporary
            for p in policies(spark, f"{database}.{t.name}")]  # catalog entries
    held = spark.createDataFrame(rows, "table_name string, kind string, column_name string, function string")
    star = F.col("airline") == "*"
    n = ents.agg(F.count(F.lit(1)).alias("principals"), F.count_if(star).alias("every"),
                 F.count_if(F.coalesce("can_see_financials", F.lit(False))).alias("money"))
    unseen = F.when(F.col("kind") == "column_mask", n.select("money").scalar()).otherwise(n.select("every").scalar())
    return held.select("*", n.select("principals").scalar().alias("principals"), unseen.alias("unrestricted"))
