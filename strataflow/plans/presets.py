"""The battery cycler telemetry set-up: columns, sources and cleaning rules."""

from __future__ import annotations

from strataflow.plans.clean import CleanSpec

# Column names of the landing files. Their order in a file is free,
# headers decide.
TELEMETRY_COLUMNS = (
    "start_time", "time", "mode", "voltage_charger", "temperature_battery",
    "voltage_load", "current_load", "temperature_mosfet", "temperature_resistor", "mission_type",
)

# Landing folder -> label in the merged table, and the merged table.
TELEMETRY_SOURCES = {
    "recommissioned_batteries": "recommissioned",
    "regular_alt_batteries": "regular_alt",
    "second_life_batteries": "second_life",
}
TELEMETRY_GOLD = "all_batteries_gold"
TELEMETRY_LINEAGE = "battery_number"
TELEMETRY_LABEL = "battery_type"

# The columns each rule names. The load-board columns are filled during
# discharge only, so requiring them keeps discharge rows and drops rest and charge rows.
# The keys leave out time, start time and pack: equal readings collapse across them.
TELEMETRY_SPEC = CleanSpec(
    not_null=(
        "voltage_charger", "voltage_load", "current_load",
        "temperature_battery", "temperature_mosfet", "temperature_resistor",
        "mode", "mission_type", "start_time", "time", "battery_number", "created_at",
    ),
    trim=("mode", "mission_type", "battery_number"),
    to_double=(
        "voltage_charger", "voltage_load", "current_load",
        "temperature_battery", "temperature_mosfet", "temperature_resistor", "time",
    ),
    dedup_keys=(
        "voltage_charger", "voltage_load", "current_load",
        "temperature_battery", "temperature_mosfet", "temperature_resistor",
        "mode", "mission_type",
    ),
    dedup_order=("time", "battery_number", "start_time"),
)
