"""Record schemas, category limits and business defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_KINDS = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}


def _schema(fields: str) -> T.StructType:
    return T.StructType([
        T.StructField(name, _KINDS[kind], True) for name, kind in map(str.split, fields.strip().splitlines())
    ])


# Field names, types, enumerations and category limits of the event data.
GPS_EVENT = _schema("""
event_id string
vehicle_id string
timestamp string
latitude double
longitude double
speed_mph double
heading int
fuel_level double
engine_status string
odometer_miles double
""")

DELIVERY_EVENT = _schema("""
event_id string
delivery_id string
order_id string
vehicle_id string
driver_id string
event_type string
timestamp string
latitude double
longitude double
customer_id string
package_weight_lbs double
estimated_delivery_time string
actual_delivery_time string
delay_minutes int
notes string
""")

ENGINE_STATUSES = ("ON", "OFF", "IDLE")

# allowed next statuses; the two empty ones end a delivery
LIFECYCLE = {
    "ORDER_PLACED": ("ORDER_CONFIRMED",),
    "ORDER_CONFIRMED": ("PICKED_UP",),
    "PICKED_UP": ("IN_TRANSIT",),
    "IN_TRANSIT": ("OUT_FOR_DELIVERY",),
    "OUT_FOR_DELIVERY": ("DELIVERED", "FAILED_ATTEMPT"),
    "FAILED_ATTEMPT": ("OUT_FOR_DELIVERY", "RETURNED"),
    "DELIVERED": (),
    "RETURNED": (),
}
TERMINAL_STATUSES = ("DELIVERED", "FAILED_ATTEMPT", "RETURNED")

SPEED_LIMITS = ((25, "SLOW"), (45, "NORMAL"), (65, "FAST"))
FUEL_LIMITS = ((0.1, "CRITICAL"), (0.25, "LOW"), (0.5, "MEDIUM"))
DELAY_LIMITS = ((0, "ON_TIME"), (15, "SLIGHT_DELAY"), (30, "MODERATE_DELAY"), (60, "SIGNIFICANT_DELAY"))
WEIGHT_LIMITS = ((1, "SMALL"), (5, "MEDIUM"), (20, "LARGE"))

DELAY_ALERT_MINUTES = 30
REPEATED_FAILURES = 3
LOW_FUEL = 0.25
MILES_PER_DEGREE = 69.0
TANK_GALLONS = 20.0
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# end of fixed values

# names seen in older landing files
GPS_ALIASES = {"odometer": "odometer_miles"}
DELIVERY_ALIASES = {"status": "event_type"}
STATUS_ALIASES = {"FAILED": "FAILED_ATTEMPT"}


@dataclass(frozen=True)
class Rates:
    """Business parameters nobody but the operator of the vehicles can know."""

    fuel_price: float = 3.5
    operating_cost_per_mile: float = 0.6
    tank_gallons: float = TANK_GALLONS
    on_time_weight: float = 0.5
    moving_weight: float = 0.5
    trip_gap_minutes: int = 30


RATES = Rates()
