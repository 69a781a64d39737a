"""Values that results depend on: column names, codes, patterns and display texts."""

# --- fixed values -----------------------------------------------------------

# Source column -> (engine column, engine type). Segment columns hold one entry
# per leg, separated by SEGMENT_SEPARATOR, and stay strings until exploded.
SOURCE_COLUMNS = {
    "legId": ("leg_id", "string"),
    "searchDate": ("search_date", "date"),
    "flightDate": ("flight_date", "date"),
    "startingAirport": ("starting_airport", "string"),
    "destinationAirport": ("destination_airport", "string"),
    "fareBasisCode": ("fare_basis_code", "string"),
    "travelDuration": ("travel_duration", "string"),
    "elapsedDays": ("elapsed_days", "int"),
    "isBasicEconomy": ("is_basic_economy", "boolean"),
    "isRefundable": ("is_refundable", "boolean"),
    "isNonStop": ("is_nonstop", "boolean"),
    "baseFare": ("base_fare", "decimal(18,2)"),
    "totalFare": ("total_fare", "decimal(18,2)"),
    "seatsRemaining": ("seats_remaining", "int"),
    "totalTravelDistance": ("total_travel_distance", "int"),
    "segmentsDepartureTimeEpochSeconds": ("segments_departure_time_epoch_seconds", "string"),
    "segmentsDepartureTimeRaw": ("segments_departure_time_raw", "string"),
    "segmentsArrivalTimeEpochSeconds": ("segments_arrival_time_epoch_seconds", "string"),
    "segmentsArrivalTimeRaw": ("segments_arrival_time_raw", "string"),
    "segmentsArrivalAirportCode": ("segments_arrival_airport_code", "string"),
    "segmentsDepartureAirportCode": ("segments_departure_airport_code", "string"),
    "segmentsAirlineName": ("segments_airline_name", "string"),
    "segmentsAirlineCode": ("segments_airline_code", "string"),
    "segmentsEquipmentDescription": ("segments_equipment_description", "string"),
    "segmentsDurationInSeconds": ("segments_duration_in_seconds", "string"),
    "segmentsDistance": ("segments_distance", "string"),
    "segmentsCabinCode": ("segments_cabin_code", "string"),
}

# The documented header spells one column without its plural.
SOURCE_ALIASES = {
    "segmentsDepartureTimeEpochSecond": "segmentsDepartureTimeEpochSeconds",
}

# Columns kept by the extract, in the engine's names.
EXTRACT_COLUMNS = [
    "leg_id",
    "search_date",
    "flight_date",
    "starting_airport",
    "destination_airport",
    "is_refundable",
    "is_nonstop",
    "base_fare",
    "total_fare",
    "seats_remaining",
    "travel_duration",
    "total_travel_distance",
    "segments_airline_name",
]

# Segment columns -> (column of the exploded row, its type).
SEGMENT_COLUMNS = {
    "segments_departure_time_epoch_seconds": ("departure_epoch", "bigint"),
    "segments_departure_time_raw": ("departure_time", "string"),
    "segments_arrival_time_epoch_seconds": ("arrival_epoch", "bigint"),
    "segments_arrival_time_raw": ("arrival_time", "string"),
    "segments_departure_airport_code": ("departure_airport", "string"),
    "segments_arrival_airport_code": ("arrival_airport", "string"),
    "segments_airline_name": ("airline_name", "string"),
    "segments_airline_code": ("airline_code", "string"),
    "segments_equipment_description": ("equipment", "string"),
    "segments_duration_in_seconds": ("duration_seconds", "int"),
    "segments_distance": ("distance", "int"),
    "segments_cabin_code": ("cabin_code", "string"),
}

SEGMENT_SEPARATOR = "||"

# Columns read from the dimension files.
AIRPORT_COLUMNS = {"iata": "string", "long": "double", "lat": "double"}
PATH_COLUMNS = {
    "cnt": "bigint",
    "start_lon": "double",
    "start_lat": "double",
    "end_lon": "double",
    "end_lat": "double",
}

# Leg-count patterns over the airline list.
TWO_LEGS = r"^[^|]*\|{2}[^|]*$"
THREE_LEGS = r"^([^|]*\|{2}[^|]*){2}$"

# Travel time: days, hours and minutes, each optional, at least one.
DURATION = r"^P(\d+D)?(T(\d+H)?(\d+M)?)?(?<=[DHM])$"

# Offset from UTC at the end of a date and time.
TIME_OFFSET = r"[T ].*?(Z|[+-]\d{2}:?\d{2})$"

# Airports shown on the map.
MAP_AIRPORTS = [
    "ATL", "BOS", "CLT", "DEN", "DFW", "DTW", "EWR", "IAD",
    "JFK", "LAX", "LGA", "MIA", "OAK", "ORD", "PHL", "SFO",
]

# Labels of the layover comparison.
LAYOVER_CHEAPER = "Layover Cheaper"
LAYOVER_DEARER = "Layovers More Expensive"

# Text shown for a missing number.
MISSING_TEXT = "nan"

# Hover text of an airport, one line per entry, and of a requested route.
LINE_BREAK = "<br>"
AIRPORT_HOVER = [
    "Airport: %s",
    "Avg Basefare: $%s",
    "Avg Cost of Flight: $%s",
    "Avg Amount of Flights per Day: %s",
    "Avg Travel Distance: %s Miles",
    "Min Basefare: $%s",
    "Max Basefare: $%s",
    "Avg Layover Basefare Difference: $%s, %s",
    "Avg 2-Layover Basefare Difference: $%s, %s",
]
ROUTE_HOVER = [
    "Average Layover Basefare Difference Between %1$s and %2$s: $%3$s",
    "Average 2-Layover Basefare Difference Between %1$s and %2$s: $%4$s",
]

# Rows shown by a preview.
PREVIEW_ROWS = 20

# The extract keeps every fifth row.
SAMPLE_STEP = 5
