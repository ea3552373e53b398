"""Aspect schemas: positional raw layout -> typed clean table.

Each aspect is a list of ``Field`` in positional order (the raw record is a
list with no names).  A field may be dequantized (raw integer / divisor ->
double) or enum-coded (raw integer code -> member name string).  The clean
Spark schema is derived from this one declaration, plus the ``replay_id`` key
and the ``row_ord`` file-order column added by the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from .enums import ENUMS


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "long"  # long | double | bool | string
    nullable: bool = False
    divisor: float | None = None  # dequantize: raw int / divisor -> double
    enum: str | None = None  # enum-coded: raw int code -> member name

    @property
    def clean_type(self) -> T.DataType:
        if self.enum is not None:
            return T.StringType()
        if self.divisor is not None:
            return T.DoubleType()
        return _KINDS[self.kind]

    @property
    def clean_nullable(self) -> bool:
        # Enum names become null for unknown codes when on_bad_enum="null".
        return self.nullable or self.enum is not None


_KINDS = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
}


def _f(name, kind="long", nullable=False, divisor=None, enum=None):
    return Field(name, kind, nullable, divisor, enum)


def _q10(name):
    return _f(name, divisor=10.0)


_TEAM_RESOURCES = [
    "metal_used", "metal_produced", "metal_excess", "metal_received", "metal_sent",
    "energy_used", "energy_produced", "energy_excess", "energy_received", "energy_sent",
    "damage_dealt", "damage_received",
]
_TEAM_COUNTS = [
    "units_killed", "units_died", "units_captured", "units_out_captured",
    "units_received", "units_sent", "current_unit_count",
]
_TEAM_LEVELS = [
    f"{res}_{what}"
    for res in ("metal", "energy")
    for what in ("current", "storage", "pull", "income", "expense", "share",
                 "Rsent", "Rreceived", "Rexcess")
]

ASPECTS: dict[str, list[Field]] = {
    "commands_log": [
        _f("frame"), _f("teamId"), _f("unitId"), _f("cmd_id"),
        _f("cmd_name", nullable=True, enum="CommandsEnum"),
        _f("cmd_tag"), _f("target_unit_id", nullable=True),
        _f("x"), _f("y"), _f("z"),
    ],
    "construction_log": [
        _f("frame"), _f("event", enum="ConstructionActionsEnum"),
        _f("builder_unit_id"), _f("builder_unit_def_id"), _f("builder_player_id"),
        _f("target_unit_id"), _f("target_unit_def_id"),
        _f("target_player_id", nullable=True),
        _f("buildpower", divisor=1000.0),
    ],
    "damage_log": [
        _f("frame"), _f("victim_team_id"), _f("attacker_team_id", nullable=True),
        _f("victim_unit_id"), _f("victim_def_id"),
        _f("attacker_unit_id", nullable=True), _f("attacker_def_id", nullable=True),
        _f("weapon_def_id"), _f("projectile_id"), _q10("damage"),
        _f("is_paralyzer", "bool"),
        _f("victim_pos_x"), _f("victim_pos_y"), _f("victim_pos_z"),
    ],
    "map_envir_econ": [_f("frame"), _f("wind_strength"), _f("tidal_strength")],
    "start_pos": [
        _f("player_id"), _f("player_name", "string"), _f("commander_def_name", "string"),
        _f("unit_def_id"), _f("x"), _f("y"), _f("z"),
    ],
    "team_stats": (
        [_f("frame"), _f("team_id")]
        + [_q10(c) for c in _TEAM_RESOURCES]
        + [_f(c) for c in _TEAM_COUNTS]
        + [_q10(c) for c in _TEAM_LEVELS]
    ),
    "unit_economy": [
        _f("frame"), _f("unit_id"), _f("unit_def_id"), _f("team_id"),
        _f("event_type", enum="UnitEconomyEventsEnum"),
        _q10("metal_make"), _q10("metal_use"), _q10("energy_make"), _q10("energy_use"),
    ],
    "unit_events": [
        _f("frame"), _f("unit_id"),
        _f("unit_def_id", nullable=True), _f("unit_team_id", nullable=True),
        _f("x"), _f("y"), _f("z"),
        _f("attacker_unit_id", nullable=True), _f("attacker_unit_def_id", nullable=True),
        _f("attacker_team_id", nullable=True),
        _f("event_type", enum="UnitEventsEnum"),
        _f("old_team_id", nullable=True), _f("new_team_id", nullable=True),
        _f("builder_id", nullable=True), _f("factory_queue_len", nullable=True),
    ],
    "unit_positions": [
        _f("frame"), _f("unit_id"), _f("unit_def_id"), _f("team_id"),
        _f("x"), _f("y"), _f("z"),
        _f("vx", divisor=1000.0), _f("vy", divisor=1000.0), _f("vz", divisor=1000.0),
        _f("heading"),
    ],
    "unit_state_snapshots": [
        _f("frame"), _f("unit_id"), _f("team_id"),
        _f("currentHealth"), _f("currentMaxHealth"),
        _f("experience", divisor=1000.0),
        _f("is_being_built", "bool"), _f("is_stunned", "bool"), _f("is_cloaked", "bool"),
        _f("is_transporting_count"), _f("current_max_range"),
        _f("is_firing", "bool"),
    ],
}

ASPECT_NAMES = list(ASPECTS)


def clean_schema(aspect: str, with_keys: bool = True) -> T.StructType:
    """Typed schema of a clean aspect table (optionally with replay_id/row_ord)."""
    fields = [T.StructField(f.name, f.clean_type, f.clean_nullable) for f in ASPECTS[aspect]]
    if with_keys:
        fields = (
            [T.StructField("replay_id", T.StringType(), False)]
            + fields
            + [T.StructField("row_ord", T.LongType(), False)]
        )
    return T.StructType(fields)


def enum_names(enum_key: str) -> dict[int, str]:
    return ENUMS[enum_key]
