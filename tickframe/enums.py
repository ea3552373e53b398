"""Enumerations used by the aspect schemas and output contracts.

Fixed values: they must equal the telemetry producer's codes.
"""

# --- fixed values (code -> member name), natural order -----------------------
COMMANDS = {
    1: "BUILD", 2: "ATTACK", 3: "CAPTURE", 4: "FIGHT", 5: "GUARD",
    6: "LOAD_UNITS", 7: "MANUAL_FIRE", 8: "MOVE", 9: "PATROL", 10: "RECLAIM",
    11: "REPAIR", 12: "RESURRECT", 13: "STOP", 14: "UNLOAD_UNITS", 15: "WAIT",
}
CONSTRUCTION_ACTIONS = {
    1: "CONSTRUCTION_START", 2: "CONSTRUCTION_SNAPSHOT", 3: "CONSTRUCTION_END",
    4: "ASSIST_START", 5: "ASSIST_SNAPSHOT", 6: "ASSIST_END",
}
UNIT_ECONOMY_EVENTS = {1: "PRODUCTION_STARTED", 2: "SNAPSHOT", 3: "DESTROYED"}
UNIT_EVENTS = {
    1: "CREATED", 2: "FINISHED", 3: "DESTROYED", 4: "GIVEN", 5: "TAKEN",
    6: "IDLE", 7: "MOVE_FAILED", 8: "CLOAKED", 9: "DECLOAKED",
}
# -----------------------------------------------------------------------------

ENUMS = {
    "UnitEventsEnum": UNIT_EVENTS,
    "CommandsEnum": COMMANDS,
    "ConstructionActionsEnum": CONSTRUCTION_ACTIONS,
    "UnitEconomyEventsEnum": UNIT_ECONOMY_EVENTS,
}

# Command groups used by the stats (fixed values).
COMBAT_COMMANDS = ["ATTACK", "FIGHT", "MANUAL_FIRE"]
ECONOMY_COMMANDS = ["BUILD", "RECLAIM", "REPAIR"]
RESPONSE_COMMANDS = ["ATTACK", "FIGHT", "REPAIR", "RECLAIM", "GUARD", "MOVE"]
