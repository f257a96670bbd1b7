"""Schemas of the stored tables and of the landed JSON payloads."""

from __future__ import annotations

MAINS = (
    "site_id string, sample_time timestamp_ntz, sample_epoch bigint, exp bigint, imp bigint, "
    "gen bigint, gep bigint, evn bigint, evp bigint, v1 int, frq int"
)
PRODUCTION = "site_id string, sample_time timestamp_ntz, sample_epoch bigint, solar bigint"
PRICES = "market_id string, sample_time timestamp_ntz, sample_epoch bigint, price double"
BATTERY = "site_id string, sample_time timestamp_ntz, sample_epoch bigint, soc double, soh double"

# Older layouts: two-tariff meter, cumulative production, charger.
MAINS_TARIFF = (
    "site_id string, sample_time timestamp_ntz, sample_epoch bigint, T1in bigint, T2in bigint, "
    "powerin int, T1out bigint, T2out bigint, powerout int, tarif int, swits int"
)
PRODUCTION_CUMULATIVE = (
    "site_id string, sample_time timestamp_ntz, sample_epoch bigint, energy bigint"
)
CHARGER = (
    "site_id string, sample_time timestamp_ntz, sample_epoch bigint, exp bigint, imp bigint, "
    "gen bigint, gep bigint, h1b bigint, h1d bigint, v1 int, frq int"
)

TABLES = {
    "mains": MAINS,
    "production": PRODUCTION,
    "prices": PRICES,
    "battery": BATTERY,
    "mains_tariff": MAINS_TARIFF,
    "production_cumulative": PRODUCTION_CUMULATIVE,
    "charger": CHARGER,
}

# Amounts are read as text, so one bad number spoils its item and not the payload.
_PRICE_ITEMS = "array<struct<startsAt: string, total: string>>"
PRICE_PAYLOAD = (
    "data struct<viewer: struct<homes: array<struct<currentSubscription: "
    f"struct<priceInfo: struct<today: {_PRICE_ITEMS}, tomorrow: {_PRICE_ITEMS}>>>>>>"
)
SOLAR_PAYLOAD = "energy struct<values: array<struct<date: string, value: string>>>"

_METER = (
    "struct<energy_import_kwh: double, energy_export_kwh: double, "
    "voltage_v: double, frequency_hz: double>"
)
METER_TELEGRAM = (
    f"site_id string, sample_time timestamp_ntz, ev {_METER}, pv {_METER}, "
    "p1 struct<energy_import_kwh: double, energy_export_kwh: double>"
)
_SESSY = "struct<sessy: struct<state_of_charge: double>>"
BATTERY_TELEGRAM = f"site_id string, sample_time timestamp_ntz, b1 {_SESSY}, b2 {_SESSY}"

CHARGER_MINUTES = (
    "site_id string, yr int, mon int, dom int, hr int, min int, exp bigint, imp bigint, "
    "gen bigint, gep bigint, h1b bigint, h1d bigint, v1 int, frq int"
)
