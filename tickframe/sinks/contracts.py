"""Output contracts: per-column cast / quantize / enum-to-int rules, table
layout and null sentinels, applied as ONE ``select`` (OUT-1..8).

A contract is validated when the plan is built (missing ``to_type``, unknown
enum, sentinel outside the target type) and every column carries its rule as
Spark column metadata, so sinks can describe the output without re-deriving
it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..enums import ENUMS


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Rule:
    transform: str  # cast | quantize | enum_to_int
    to_type: str | None
    scale: float | None = None
    enum_key: str | None = None
    null_encoding: float | int | None = None


@dataclass(frozen=True)
class Contract:
    columns: dict[str, Rule] = field(default_factory=dict)
    layout: str | None = None  # row-major-mixed | columnar
    null_encoding: float | int | None = None


def cast(to_type, null_encoding=None):
    return Rule("cast", to_type, null_encoding=null_encoding)


def quantize(scale, to_type, null_encoding=None):
    return Rule("quantize", to_type, scale=scale, null_encoding=null_encoding)


def enum_to_int(enum_key, to_type, null_encoding=None):
    return Rule("enum_to_int", to_type, enum_key=enum_key, null_encoding=null_encoding)


# Logical output types: Spark storage type, integer range (None = no check),
# binary packing code (little-endian), float flag.
TYPES = {
    "Int8": (T.ByteType(), (-2**7, 2**7 - 1), "<i1"),
    "Int16": (T.ShortType(), (-2**15, 2**15 - 1), "<i2"),
    "Int32": (T.IntegerType(), (-2**31, 2**31 - 1), "<i4"),
    "Int64": (T.LongType(), (-2**63, 2**63 - 1), "<i8"),
    "UInt8": (T.ShortType(), (0, 2**8 - 1), "<u1"),
    "UInt16": (T.IntegerType(), (0, 2**16 - 1), "<u2"),
    "UInt32": (T.LongType(), (0, 2**32 - 1), "<u4"),
    "UInt64": (T.DecimalType(20, 0), (0, 2**64 - 1), "<u8"),
    "Float32": (T.FloatType(), None, "<f4"),
    "Float64": (T.DoubleType(), None, "<f8"),
    "Boolean": (T.BooleanType(), None, "|u1"),
    "Utf8": (T.StringType(), None, None),
}
UNSIGNED = {"UInt8", "UInt16", "UInt32", "UInt64"}
SPARK_TO_LOGICAL = {
    T.ByteType: "Int8", T.ShortType: "Int16", T.IntegerType: "Int32", T.LongType: "Int64",
    T.FloatType: "Float32", T.DoubleType: "Float64", T.BooleanType: "Boolean",
    T.StringType: "Utf8",
}


def logical_type(dt: T.DataType) -> str | None:
    return SPARK_TO_LOGICAL.get(type(dt))


# --- fixed values: output contracts (column rules in table order) -------------
_TEAM_QUANTIZED = [
    "metal_used", "metal_produced", "metal_excess", "metal_received", "metal_sent",
    "energy_used", "energy_produced", "energy_excess", "energy_received", "energy_sent",
    "damage_dealt", "damage_received",
    "metal_current", "metal_storage", "metal_pull", "metal_income", "metal_expense",
    "metal_share", "metal_Rsent", "metal_Rreceived", "metal_Rexcess",
    "energy_current", "energy_storage", "energy_pull", "energy_income", "energy_expense",
    "energy_share", "energy_Rsent", "energy_Rreceived", "energy_Rexcess",
]
_TEAM_COUNTS = ["units_killed", "units_died", "units_captured", "units_out_captured",
                "units_received", "units_sent", "current_unit_count"]

CONTRACTS: dict[str, Contract] = {
    "army_value_timeline": Contract({
        "frame": cast("UInt32"),
        "team_id": cast("UInt32"),
        "army_value": quantize(0.1, "UInt32"),
    }, layout="row-major-mixed"),
    "unit_economic_contribution_binned": Contract({
        "team_id": cast("UInt16", 0),
        "unit_def_id": cast("UInt16", 0),
        "time_bin_start_frame": cast("UInt32", 0),
        "units_alive_in_bin": cast("UInt16", 0),
        "total_unit_seconds_in_bin": cast("Float32", 0),
        "total_units_produced_in_bin": cast("UInt16", 0),
        "total_metal_produced_in_bin": cast("Float32", 0),
        "total_metal_consumed_in_bin": cast("Float32", 0),
        "total_energy_produced_in_bin": cast("Float32", 0),
        "total_energy_consumed_in_bin": cast("Float32", 0),
    }, layout="columnar"),
    "unit_positions": Contract({
        # unit ids pass 65535 where replays share one numbering
        "frame": cast("UInt32"), "unit_id": cast("Int32"), "unit_def_id": cast("UInt16"),
        "team_id": cast("UInt16"), "x": cast("Int16"), "y": cast("Int16"), "z": cast("Int16"),
        "vx": cast("Int16"), "vy": cast("Int16"), "vz": cast("Int16"),
    }, layout="row-major-mixed"),
    "unit_events": Contract({
        "frame": cast("Int32"), "unit_id": cast("Int32"), "unit_def_id": cast("Int32"),
        "unit_team_id": cast("Int32"), "x": cast("Int32"), "y": cast("Int32"), "z": cast("Int32"),
        "attacker_unit_id": cast("Int32"), "attacker_unit_def_id": cast("Int32"),
        "attacker_team_id": cast("Int32"),
        "event_type": enum_to_int("UnitEventsEnum", "Int32"),
        "old_team_id": cast("Int32"), "new_team_id": cast("Int32"),
        "builder_id": cast("Int32"), "factory_queue_len": cast("Int32"),
    }, layout="row-major-mixed", null_encoding=0),
    "team_stats": Contract({
        "frame": cast("Float64"), "team_id": cast("Float64"),
        **{c: quantize(0.1, "Float64") for c in _TEAM_QUANTIZED},
        **{c: cast("Float64") for c in _TEAM_COUNTS},
    }, layout="row-major-mixed"),
    "damage_log": Contract({
        "frame": cast("Int32"),
        "unit_id": cast("Int16"),
        "attacker_team_id": cast("Int16", -1),
        "victim_unit_id": cast("Int32"),
        "victim_def_id": cast("Int32"),
        # unsigned columns cannot hold -1: no attacker is the type's largest value
        "attacker_unit_id": cast("UInt16", 65535),
        "attacker_def_id": cast("UInt16", 65535),
        "weapon_def_id": cast("Int32"),
        "projectile_id": cast("Int32", -1),
        "damage": cast("Float64"),
        "is_paralyzer": cast("Boolean"),
        "victim_pos_x": cast("Int16"),
        "victim_pos_y": cast("Int16"),
        "victim_pos_z": cast("Int16"),
    }, layout="columnar"),
}
# Lookup-map asset built from the unit definition names.
DEFS_LOOKUP = {"key_column": "unit_def_id", "value_columns": ["unit_name", "translated_human_name"]}
# -----------------------------------------------------------------------------

INTERNAL = ("replay_id", "row_ord")


def _validate(name: str, rule: Rule, present: bool) -> None:
    if rule.to_type is None:
        raise ContractError(f"contract for {name!r} is missing 'to_type'")
    if rule.to_type not in TYPES:
        raise ContractError(f"contract for {name!r}: unknown type {rule.to_type!r}")
    if rule.transform == "enum_to_int" and rule.enum_key not in ENUMS:
        raise ContractError(f"contract for {name!r}: unknown enum {rule.enum_key!r}")
    if rule.transform == "quantize" and not rule.scale:
        raise ContractError(f"contract for {name!r}: quantize needs a non-zero scale")
    if present and rule.null_encoding is not None:
        rng = TYPES[rule.to_type][1]
        if rng is not None and not (rng[0] <= rule.null_encoding <= rng[1]):
            raise ContractError(
                f"contract for {name!r}: null sentinel {rule.null_encoding} does not fit "
                f"{rule.to_type}")


def _typed(c: Column, name: str, to_type: str) -> Column:
    spark_type, rng, _ = TYPES[to_type]
    if to_type in UNSIGNED:
        lo, hi = rng
        wide = c.cast(T.DecimalType(20, 0)) if to_type == "UInt64" else c.cast("long")
        check = F.when(wide.isNotNull() & ((wide < F.lit(lo)) | (wide > F.lit(hi))),
                       F.raise_error(F.concat(F.lit(f"{name}: value out of {to_type} range: "),
                                              c.cast("string"))))
        return F.coalesce(check.cast(spark_type), wide.cast(spark_type))
    return c.cast(spark_type)  # ANSI cast: overflow raises


def column_expr(name: str, dtype: T.DataType, rule: Rule | None) -> tuple[Column, dict]:
    src = F.col(name)
    if rule is None:
        return src, {"transform": "none", "original_dtype": dtype.simpleString()}
    meta = {"transform": rule.transform, "to_type": rule.to_type,
            "original_dtype": dtype.simpleString()}
    if rule.null_encoding is not None:
        meta["null_encoding"] = rule.null_encoding
    if rule.transform == "enum_to_int":
        m = ENUMS[rule.enum_key]
        lookup = F.create_map(*[x for k, v in m.items() for x in (F.lit(v), F.lit(k))])
        src = F.try_element_at(lookup, src)
        meta.update(enum_key=rule.enum_key, enum_map={str(k): v for k, v in m.items()})
    elif rule.transform == "quantize":
        src = F.bround(src.cast("double") / F.lit(rule.scale), 0)
        meta.update(transform="static_quantize", scale=rule.scale)
    elif rule.transform != "cast":
        raise ContractError(f"unknown transform {rule.transform!r} for {name!r}")
    return _typed(src, name, rule.to_type), meta


def apply_contract(df: DataFrame, contract: Contract | None) -> DataFrame:
    """One select: every contracted column transformed and typed, others
    passed through; rules recorded as column metadata (key ``contract``)."""
    contract = contract or Contract()
    cols = []
    for f in df.schema.fields:
        rule = contract.columns.get(f.name)
        if rule is not None:
            _validate(f.name, rule, True)
        expr, meta = column_expr(f.name, f.dataType, rule)
        if f.name not in INTERNAL:
            meta["table"] = {"layout": contract.layout, "null_encoding": contract.null_encoding}
        cols.append(expr.alias(f.name, metadata={"contract": meta}))
    return df.select(*cols)


def encode_nulls(df: DataFrame, contract: Contract | None, layout: str | None = None) -> DataFrame:
    """Replace nulls by sentinels (OUT-7/8).

    Row-major: the table-level sentinel applies to every column; without one
    any null is an error.  Columnar: the column sentinel, falling back to the
    table one; float columns may keep nulls, other columns without a rule
    raise when a null actually occurs."""
    contract = contract or Contract()
    layout = layout or contract.layout
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in INTERNAL or not isinstance(
                f.dataType, (T.NumericType, T.BooleanType, T.StringType)):
            out.append(c)
            continue
        rule = contract.columns.get(f.name)
        if layout == "row-major-mixed":
            sentinel = contract.null_encoding
        else:
            sentinel = rule.null_encoding if rule and rule.null_encoding is not None \
                else contract.null_encoding
        is_float = isinstance(f.dataType, (T.FloatType, T.DoubleType))
        if sentinel is not None:
            if isinstance(f.dataType, T.BooleanType):
                lit = F.lit(bool(sentinel))
            elif isinstance(f.dataType, T.StringType):
                lit = F.lit(str(sentinel))
            else:
                lit = F.lit(sentinel).cast(f.dataType)
            out.append(F.coalesce(c, lit).alias(f.name, metadata=f.metadata))
        elif is_float and layout != "row-major-mixed":
            out.append(c)
        else:
            out.append(F.when(c.isNull(), F.raise_error(F.lit(
                f"column {f.name!r} has nulls but its contract has no null_encoding")))
                .otherwise(c).alias(f.name, metadata=f.metadata))
    return df.select(*out)


def lookup_rows(defs: DataFrame, key_column: str | None = None,
                value_columns: list[str] | None = None) -> DataFrame:
    """Lookup-map asset (OUT-9) as rows ``(key, values)``; distributed, never
    gathered into one map."""
    key_column = key_column or DEFS_LOOKUP["key_column"]
    value_columns = value_columns or DEFS_LOOKUP["value_columns"]
    return defs.select(F.col(key_column).alias("key"),
                       F.array(*[F.col(c).cast("string") for c in value_columns]).alias("values"))
