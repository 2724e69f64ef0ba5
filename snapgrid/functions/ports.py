"""Predicates on port attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapgrid.functions.values import number

# Attribute codes of the charging data.
DC_CONNECTORS = ["CCS_TYPE_2", "CHADEMO"]
TYPE2_CONNECTORS = ["TYPE_2", "MENNEKES"]
WALL_CONNECTORS = ["WALL_OUTLET"]
FIXED_CABLE = "CABLE"
DC_ABOVE_KW = 22
AVAILABLE = "AVAILABLE"
MOTORCYCLE_NOTE = "MOTORCYCLE_ONLY"


def is_one_of(value: Column, options: list[str]) -> Column:
    """Membership where null is simply not a member."""
    return F.coalesce(value.isin(options), F.lit(False))


def is_dc_fast(power_kw: Column, connector: Column, mechanism: Column) -> Column:
    """Power above 22 kW, a DC connector or a fixed cable; unknown power counts as 0."""
    power = F.coalesce(number(power_kw), F.lit(0.0))
    return (power > DC_ABOVE_KW) | is_one_of(connector, DC_CONNECTORS) | mechanism.eqNullSafe(F.lit(FIXED_CABLE))


def port_flags(power_kw: Column, connector: Column, mechanism: Column) -> dict[str, Column]:
    """The 0/1 attribute flags that station totals are summed from."""
    return {
        "dc": is_dc_fast(power_kw, connector, mechanism).cast("int"),
        "ccs": is_one_of(connector, ["CCS_TYPE_2"]).cast("int"),
        "chademo": is_one_of(connector, ["CHADEMO"]).cast("int"),
        "type2": is_one_of(connector, TYPE2_CONNECTORS).cast("int"),
        "wall": is_one_of(connector, WALL_CONNECTORS).cast("int"),
    }
