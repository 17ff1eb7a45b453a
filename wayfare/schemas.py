"""Record layouts of the platform, as DDL. All names, types and key orders here are fixed values: they are
the interface that other systems read and write."""

# Trip history as published, one row per trip; POLYLINE is JSON text [[lon, lat], ...].
TRIP_HISTORY = (
    "TRIP_ID string, CALL_TYPE string, ORIGIN_CALL int, ORIGIN_STAND int, TAXI_ID int, "
    "TIMESTAMP bigint, DAY_TYPE string, MISSING_DATA boolean, POLYLINE string"
)
TRIP_REMAPPED = "TRIP_ID string, TAXI_ID int, TIMESTAMP bigint, CASA_POLYLINE string"

# Fields of the messages. They are read as text first: numbers may arrive quoted.
GPS_FIELDS = ["taxi_id", "timestamp", "latitude", "longitude", "speed", "status"]
GPS_NORMALISED_FIELDS = [
    "schema_version", "event_type", "event_time", "ingested_at", "taxi_id", "zone_id",
    "zone_name", "centroid_lat", "centroid_lon", "speed_kmh", "status",
]
TRIP_FIELDS = [
    "trip_id", "rider_id", "origin_zone", "destination_zone", "requested_at", "call_type",
    "origin_lat", "origin_lon",
]

MATCH = (
    "city string, date_bucket string, created_at bigint, trip_id string, rider_id int, "
    "origin_zone int, destination_zone int, call_type string, matched_taxi string, "
    "eta_seconds int, status string"
)

# Serving tables: partition columns, then the rest of the primary key.
SERVING_KEYS = {
    "vehicle_positions": (["city", "zone_id"], ["event_time", "taxi_id"]),
    "trips": (["city", "date_bucket"], ["created_at", "trip_id"]),
    "demand_zones": (["city", "zone_id"], ["window_start"]),
}

# Contract of the normalised ping, as a JSON Schema document.
GPS_CONTRACT = {
    "additionalProperties": False,
    "required": [
        "schema_version", "event_type", "event_time", "ingested_at", "taxi_id", "zone_id",
        "centroid_lat", "centroid_lon", "speed_kmh", "status",
    ],
    "properties": {
        "schema_version": {"type": "string", "const": "1.0.0"},
        "event_type": {"type": "string", "const": "GPS_NORMALIZED"},
        "event_time": {"type": "integer"},
        "ingested_at": {"type": "integer"},
        "taxi_id": {"type": "integer", "minimum": 1},
        "zone_id": {"type": "integer", "minimum": 1, "maximum": 16},
        "zone_name": {"type": "string"},
        "centroid_lat": {"type": "number", "minimum": 33.4, "maximum": 33.7},
        "centroid_lon": {"type": "number", "minimum": -7.8, "maximum": -7.4},
        "speed_kmh": {"type": "number", "minimum": 0, "maximum": 150},
        "status": {"type": "string", "enum": ["AVAILABLE", "ASSIGNED", "OFFLINE"]},
    },
}
