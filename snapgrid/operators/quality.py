"""Data contracts as tables of violations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapgrid.functions.time import parse_instant
from snapgrid.operators.rows import quoted
from snapgrid.session import use_utc


def contract_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) in one aggregation. A rule is a condition each row must meet; null fails."""
    checks = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"n{i}") for i, ok in enumerate(rules.values())]
    empty = F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("empty")
    lines = [F.struct(F.lit(name).alias("rule"), F.col(f"n{i}").alias("violations")) for i, name in enumerate(rules)]
    lines.append(F.struct(F.lit("not empty").alias("rule"), F.col("empty").alias("violations")))
    return df.agg(*checks, empty).select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")


@dataclass(frozen=True)
class Field:
    """A column that a table must have. ``kind`` is a Spark type, such as ``bigint``.

    With ``coerce`` values may come as another type if they convert without loss (a number in text, a whole number as
    a fraction); otherwise the column must be of that type. Bounds and ``among`` hold for values, not for nulls.
    """

    name: str
    kind: str
    nullable: bool = False
    low: float | None = None
    high: float | None = None
    among: tuple = ()
    coerce: bool = True


@dataclass(frozen=True)
class Rule:
    """A condition (SQL) that every row must meet, and the columns it reads; null fails."""

    name: str
    condition: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    """What a table has to be. ``strict`` forbids further columns, ``least`` is its least number of rows."""

    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    strict: bool = False
    least: int = 1


WHOLE = ("tinyint", "smallint", "int", "bigint")


def _converted(value: Column, have: str, want: str) -> Column | None:
    """The value as another type, null where it does not convert without loss; none if the types never do."""
    nested = ("array", "map", "struct", "variant", "binary")
    if have == want:
        return value
    if have.startswith(nested) or want.startswith(nested):
        return None
    times = ("timestamp", "date")
    if (have.startswith(times) or want.startswith(times)) and have != "string" and want != "string" and not (have.startswith(times) and want.startswith(times)):
        return None
    if want.startswith("timestamp") and have == "string":
        return parse_instant(value)
    found = value.try_cast(want)
    if want in WHOLE and have not in (*WHOLE, "string", "boolean"):
        return F.when(value == F.floor(value), found)
    return found


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, violations) for everything a contract says, kept or broken, from one aggregation over the table.

    Columns that are missing, forbidden or of another type than they must be count one; what cannot be checked without
    them counts one too. Values that do not convert, nulls, values out of bounds and rows that break a rule count each.
    """
    use_utc(df.sparkSession)
    kinds = dict(df.dtypes)
    lines: list[tuple[str, Column]] = []
    raws: list[Column] = []
    values: dict[str, Column] = {}

    def found(name: str, broken: bool) -> None:
        lines.append((name, F.lit(int(broken)).cast("long")))

    def each(name: str, broken: Column) -> None:
        lines.append((name, F.count_if(F.coalesce(broken, F.lit(False)))))

    for i, f in enumerate(contract.fields):
        have = kinds.get(f.name)
        found(f"{f.name} present", have is None)
        if have is None:
            continue
        raw = F.col(quoted(f.name))
        if have in ("double", "float"):
            raw = F.nullif(raw, F.lit(float("nan")).cast(have))  # no number is no value
        value = _converted(raw, have, f.kind) if f.coerce or have == f.kind else None
        if value is None:
            found(f"{f.name} is {f.kind}", True)
            continue
        raws.append(raw.isNull().alias(f"_null{i}"))
        values[f.name] = value
        there, own = ~F.col(f"_null{i}"), F.col(quoted(f.name))
        each(f"{f.name} is {f.kind}", there & own.isNull())
        if not f.nullable:
            each(f"{f.name} not null", ~there)
        if f.low is not None:
            each(f"{f.name} >= {f.low}", own < F.lit(f.low))
        if f.high is not None:
            each(f"{f.name} <= {f.high}", own > F.lit(f.high))
        if f.among:
            each(f"{f.name} among {len(f.among)} values", ~own.isin(*f.among))
    if contract.strict:
        expected = {f.name for f in contract.fields}
        for c in df.columns:
            if c not in expected:
                found(f"{c} unexpected", True)
    for rule in contract.rules:
        if set(rule.columns) <= set(values):
            each(rule.name, ~F.coalesce(F.expr(rule.condition), F.lit(False)))
        else:
            found(rule.name, True)
    few = F.count(F.lit(1)) < contract.least
    lines.append((f"rows >= {contract.least}", F.when(few, F.lit(1)).otherwise(F.lit(0)).cast("long")))
    checked = df.select(*raws, *[value.alias(name) for name, value in values.items()])
    counts = checked.agg(*[count.alias(f"n{i}") for i, (_, count) in enumerate(lines)])
    told = [F.struct(F.lit(name).alias("rule"), F.col(f"n{i}").alias("violations")) for i, (name, _) in enumerate(lines)]
    return counts.select(F.inline(F.array(*told)))


#: The contract of the selected station series.
SERIES_CONTRACT = Contract(
    (
        Field("snapshot_ts", "timestamp"),
        Field("st_id", "bigint"),
        Field("st_location_id", "bigint"),
        *[Field(c, "bigint", low=0) for c in ("total_ports", "available_ports", "unavailable_ports")],
        Field("unavailable_rate", "double", low=0.0, high=1.0),
    ),
    tuple(Rule(f"{c} <= total_ports", f"{c} <= total_ports", (c, "total_ports")) for c in ("available_ports", "unavailable_ports")),
)


def series_rules() -> dict[str, Column]:
    """The contract of the selected station series."""
    rules = {f"{c} not null": F.col(c).isNotNull() for c in ("snapshot_ts", "st_id", "st_location_id")}
    rules |= {f"{c} >= 0": F.col(c) >= 0 for c in ("total_ports", "available_ports", "unavailable_ports")}
    rules["unavailable_rate in [0, 1]"] = F.col("unavailable_rate").between(0.0, 1.0)
    rules["available_ports <= total_ports"] = F.col("available_ports") <= F.col("total_ports")
    rules["unavailable_ports <= total_ports"] = F.col("unavailable_ports") <= F.col("total_ports")
    return rules


def enforce(violations: DataFrame) -> None:
    """Raise if any rule of a violations table is broken."""
    broken = [(r["rule"], r["violations"]) for r in violations.filter("violations > 0").collect()]
    if broken:
        raise ValueError(f"contract broken: {broken}")


def invalid_instants(df: DataFrame, ts: str) -> DataFrame:
    """How many values of a time column are no instants."""
    use_utc(df.sparkSession)
    return df.agg(F.count_if(parse_instant(F.col(ts)).isNull()).alias("invalid"))


def metric_gate(metrics: DataFrame, min_auc: float = 0.5, max_logloss: float = 1.5) -> DataFrame:
    """Violations of the model quality limits; an unknown AUC passes."""
    return contract_violations(
        metrics,
        {
            "horizons present": F.col("requested_horizon_minutes").isNotNull()
            & F.col("effective_horizon_minutes").isNotNull(),
            "auc": F.col("auc").isNull() | (F.col("auc") >= min_auc),
            "logloss": F.col("logloss") <= max_logloss,
            "brier": F.col("brier").between(0.0, 1.0),
        },
    )
