"""Fixed values that results depend on."""

# fixed values: inclusive (low, high) latitude and longitude of the country's bounding box
BOUNDING_BOX = {"lat": (-33.75, 5.27), "lng": (-73.99, -34.79)}

# fixed values: order states
DELIVERED = "delivered"
CANCELED = "canceled"
UNAVAILABLE = "unavailable"

# fixed values: first day and (exclusive) last day of the default calendar
CALENDAR_START = "2016-01-01"
CALENDAR_END = "2019-01-01"

# fixed values: rows above which the four anomaly monitors warn
WARN_ABOVE = {
    "is_late_delivery": 9000,
    "is_carrier_before_approved": 1600,
    "is_delivered_missing_date": 20,
    "has_no_line_items": 900,
}

# fixed values: customer segments
GOLD, SILVER, REPEAT, LAPSED, STANDARD = "gold", "silver", "repeat", "lapsed", "standard"
