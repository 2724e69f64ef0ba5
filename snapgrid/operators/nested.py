"""Flattening of nested records and unnesting of child lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    found = []
    for field in schema.fields:
        here = path + (field.name,)
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, here)
        else:
            found.append((here, field.dataType))
    return found


def _field(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def flatten(df: DataFrame, separator: str = "_", keep: tuple[str, ...] = ()) -> DataFrame:
    """Structs become ``a_b_c`` columns after the plain ones; lists become JSON text unless kept."""
    plain, nested = [], []
    for path, kind in _leaves(df.schema):
        as_text = isinstance(kind, (T.ArrayType, T.MapType)) and path[-1] not in keep
        value = F.to_json(_field(path)) if as_text else _field(path)
        (plain if len(path) == 1 else nested).append(value.alias(separator.join(path)))
    return df.select(*plain, *nested)


def parse_json(text: Column) -> Column:
    """JSON text to a variant; null or broken text becomes null."""
    return F.try_parse_json(text)


def _json_path(*names: str) -> str:
    return "$" + "".join(f"['{n}']" for n in names)


def first_object_field(value: Column, name: str, kind: str) -> Column:
    """``name`` of the first object in a variant: of a list's first element or of a lone object."""
    return F.coalesce(
        F.try_variant_get(value, f"$[0]['{name}']", kind), F.try_variant_get(value, _json_path(name), kind)
    )


def unnest(
    df: DataFrame,
    column: str,
    child: T.StructType,
    parents: list[str],
    lift: dict[str, tuple[str, str, str]] | None = None,
    drop: tuple[str, ...] = ("coordinates",),
    separator: str = ".",
    rest: str | None = None,
) -> DataFrame:
    """One row per child object of the list in ``column``, with the parent's keys.

    ``column`` is JSON text or an already typed array of structs, whose inner lists stay typed. Items
    that are no objects, and cells that are no lists, give no row. ``lift`` moves a field of the first
    element of an inner list (or its JSON text) up, as ``new name: (list, field, type)``, and drops the
    list. A parent key wins over a child field.

    Fields that ``child`` does not name are kept: those of a typed array as columns of their own, those of
    JSON text, whose names only the data know, together as one JSON text column ``rest`` (null if an item has
    none; without a name for it they are left out).
    """
    lift = lift or {}
    gone = set(drop) | {source for source, _, _ in lift.values()}
    if isinstance(df.schema[column].dataType, T.ArrayType):
        child = df.schema[column].dataType.elementType
        lift = {name: spec for name, spec in lift.items() if spec[0] in child.fieldNames()}
    leaves = [(p, k) for p, k in _leaves(child) if p[0] not in gone and separator.join(p) not in parents]
    typed = isinstance(df.schema[column].dataType, T.ArrayType)
    if typed:
        rows = df.select(*parents, F.explode(column).alias("_item")).filter("_item is not null")
        values = [_field(("_item",) + p) for p, _ in leaves]
        lifted = {}
        for name, (source, field, kind) in lift.items():
            inner = F.col(f"_item.{source}")
            if isinstance(df.schema[column].dataType.elementType[source].dataType, T.StringType):
                lifted[name] = first_object_field(parse_json(inner), field, kind)
            else:
                lifted[name] = F.get(inner, F.lit(0))[field].try_cast(kind)
    else:
        items = F.try_variant_get(parse_json(F.col(column)), "$", "array<variant>")
        rows = df.select(*parents, F.explode(items).alias("_item"))
        rows = rows.filter(F.try_variant_get("_item", "$", "map<string,variant>").isNotNull())
        item = F.col("_item")
        if rest is not None and rest not in parents:
            named = F.array(*[F.lit(f.name) for f in child.fields], *[F.lit(name) for name in gone])
            others = F.map_filter(
                F.try_variant_get(item, "$", "map<string,variant>"),
                lambda name, _: ~F.array_contains(named, name) & ~name.isin(parents),
            )
            rest_text = F.when(F.size(others) > 0, F.to_json(others))
        values = [
            F.try_variant_get(
                item, _json_path(*p), "string" if isinstance(k, (T.ArrayType, T.MapType)) else k.simpleString()
            )
            for p, k in leaves
        ]
        lifted = {}
        for name, (source, field, kind) in lift.items():
            inner = F.try_variant_get(item, _json_path(source), "variant")
            text = parse_json(F.try_variant_get(item, _json_path(source), "string"))
            lifted[name] = F.coalesce(first_object_field(inner, field, kind), first_object_field(text, field, kind))
    remaining = [rest_text.alias(rest)] if not typed and rest is not None and rest not in parents else []
    return rows.select(
        *[v.alias(separator.join(p)) for v, (p, _) in zip(values, leaves)],
        *[v.alias(n) for n, v in lifted.items() if n not in parents],
        *remaining,
        *parents,
    )


def opening_hours(df: DataFrame, column: str = "opening_hours") -> DataFrame:
    """The first opening rule as four columns in place of ``column``; a table without it is unchanged.

    Text that is no JSON, or whose first element is no object, gives nulls.
    """
    if column not in df.columns:
        return df
    # The fields of an opening rule.
    fields = {"weekday_begin": "string", "weekday_end": "string", "hour_begin": "string", "hour_end": "string"}
    if isinstance(df.schema[column].dataType, T.ArrayType):
        first = F.get(F.col(column), F.lit(0))
        parts = {f: first[f] for f in fields}
    else:
        value = parse_json(F.col(column))
        parts = {f: first_object_field(value, f, k) for f, k in fields.items()}
    return df.select("*", *[v.alias(f"{column}_{f}") for f, v in parts.items()]).drop(column)


def unreadable_hours(df: DataFrame, column: str = "opening_hours") -> DataFrame:
    """How many opening-hour cells hold text that is no list or object."""
    value = parse_json(F.col(column))
    usable = F.coalesce(
        F.try_variant_get(value, "$[0]", "map<string,variant>"), F.try_variant_get(value, "$", "map<string,variant>")
    ).isNotNull()
    empty = F.size(F.try_variant_get(value, "$", "array<variant>")) == 0
    bad = F.col(column).isNotNull() & ~usable & ~F.coalesce(empty, F.lit(False))
    return df.agg(F.count_if(bad).alias("unreadable"))
