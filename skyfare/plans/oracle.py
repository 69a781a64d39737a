"""The registered queries in plain SQL, written against the raw tables.

They are an independent statement of the same results: global windows, self joins
and one wide derived relation, with none of the rewrites used on the Spark side.
"""

from skyfare.functions.constants import (
    LAYOVER_CHEAPER,
    LAYOVER_DEARER,
    MISSING_TEXT,
    PREVIEW_ROWS,
    SAMPLE_STEP,
)
from skyfare.plans.registry import BUDGET, CHUNK_ROWS, CODES, DEST, PERIOD, ROLLING_MONTHS, START, SUMMER, TOP, YEAR

LEG_ORDER = "l_linenumber, l_partkey, l_suppkey"

ITINERARIES = f"""
legs AS (
  SELECT l_orderkey,
         CAST(count(*) AS INTEGER) AS num_legs,
         CAST(min(l_quantity) AS INTEGER) AS seats,
         CAST(sum(l_quantity) AS INTEGER) + 30 AS minutes,
         CAST(sum(p_size) AS INTEGER) AS miles,
         string_agg(coalesce(n_name, ''), '||' ORDER BY {LEG_ORDER}) AS airlines,
         last(s_nationkey ORDER BY {LEG_ORDER}) AS last_nation
  FROM lineitem
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey
),
itineraries AS (
  SELECT o_orderkey AS leg_id,
         CAST(o_orderdate AS DATE) AS flight_date,
         'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS starting_airport,
         'N' || lpad(CAST(last_nation AS VARCHAR), 2, '0') AS destination_airport,
         num_legs = 1 AS is_nonstop,
         o_orderstatus = 'F' AS is_refundable,
         CAST(o_totalprice AS DECIMAL(18,2)) AS base_fare,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 4.50 * num_legs AS DECIMAL(18,2))
           AS total_fare,
         seats AS seats_remaining,
         'PT' || CAST(minutes // 60 AS VARCHAR) || 'H' || CAST(minutes % 60 AS VARCHAR) || 'M'
           AS travel_duration,
         CASE WHEN miles % 10 <> 0 THEN miles END AS total_travel_distance,
         airlines AS segments_airline_name,
         num_legs,
         minutes
  FROM orders
  JOIN legs ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
)"""

AIRPORTS = """
airports AS (
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iata,
         CAST(2 * n_nationkey - 120 AS DOUBLE) AS long,
         CAST(n_nationkey + 25 AS DOUBLE) AS lat
  FROM nation
)"""


def avg(c: str, keep: str | None = None) -> str:
    f = f" FILTER (WHERE {keep})" if keep else ""
    return f"CAST(sum({c}){f} AS DOUBLE) / nullif(count({c}){f}, 0)"


def dbl(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {name or c}"


SEASON = f"year(flight_date) = {YEAR} AND month(flight_date) IN (6, 7, 8)"
CODE_LIST = ", ".join(f"'{c}'" for c in CODES)
ONE = "NOT contains(segments_airline_name, '||')"
TWO = r"regexp_full_match(segments_airline_name, '[^|]*\|{2}[^|]*')"
THREE = r"regexp_full_match(segments_airline_name, '([^|]*\|{2}[^|]*){2}')"


def top(keep: str) -> str:
    return f"""SELECT airline_name, starting_airport, destination_airport, base_fare FROM (
  SELECT segments_airline_name AS airline_name, starting_airport, destination_airport, base_fare,
         row_number() OVER (PARTITION BY segments_airline_name
           ORDER BY base_fare DESC, starting_airport, destination_airport, leg_id) AS rn
  FROM itineraries WHERE {keep}) WHERE rn = 1"""


def money_rows(source: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)}, {dbl('base_fare')} FROM {source}"


STATS = f"""
stats AS (
  SELECT destination_airport, min(base_fare) AS min_base_fare, max(base_fare) AS max_base_fare,
         {avg('base_fare')} AS fare
  FROM itineraries GROUP BY destination_airport
)"""

DAILY = """
daily AS (
  SELECT starting_airport, flight_date, count(leg_id) AS n
  FROM itineraries GROUP BY starting_airport, flight_date
)"""

FLIGHTS = f"""
flights AS (
  SELECT starting_airport, CAST(round({avg('n')}) AS INTEGER) AS average_flights_per_day
  FROM daily GROUP BY starting_airport
),
costs AS (
  SELECT starting_airport, round({avg('base_fare')}, 2) AS average_cost
  FROM itineraries GROUP BY starting_airport
)"""

DISTANCES = f"""
distances AS (
  SELECT starting_airport, {avg('total_travel_distance')} AS average_travel_distance
  FROM itineraries GROUP BY starting_airport
)"""

SUMMARY = f"""{STATS},{DAILY},{FLIGHTS},{DISTANCES},
summary AS (
  SELECT s.starting_airport, s.average_base_fare, f.average_flights_per_day, c.average_cost,
         d.average_travel_distance, CAST(st.min_base_fare AS DOUBLE) AS min_fare_inbound,
         CAST(st.max_base_fare AS DOUBLE) AS max_fare_inbound
  FROM (SELECT starting_airport, round_even({avg('base_fare')}, 2) AS average_base_fare
        FROM itineraries WHERE {SEASON} GROUP BY starting_airport) s
  LEFT JOIN flights f ON f.starting_airport = s.starting_airport
  LEFT JOIN costs c ON c.starting_airport = s.starting_airport
  LEFT JOIN distances d ON d.starting_airport = s.starting_airport
  LEFT JOIN stats st ON st.destination_airport = s.starting_airport
)"""

TOPS = f"""
top2 AS ({top(TWO)}),
top3 AS ({top(THREE)})"""

LAYOVERS = f"""{SUMMARY},{TOPS},
compared AS (
  SELECT *, round_even(average_base_fare - (SELECT {avg('base_fare')} FROM top2), 2) AS d1,
         round_even(average_base_fare - (SELECT {avg('base_fare')} FROM top3), 2) AS d2
  FROM summary
),
layovers AS (
  SELECT * EXCLUDE (d1, d2), abs(d1) AS one_layover_difference, abs(d2) AS two_layover_difference,
         CASE WHEN d1 >= 0 THEN '{LAYOVER_CHEAPER}' ELSE '{LAYOVER_DEARER}' END
           AS one_layover_label,
         CASE WHEN d2 >= 0 THEN '{LAYOVER_CHEAPER}' ELSE '{LAYOVER_DEARER}' END
           AS two_layover_label
  FROM compared
)"""

PATHS = """
paths AS (
  SELECT starting_airport, destination_airport, count(*) AS cnt
  FROM itineraries GROUP BY starting_airport, destination_airport
)"""

VALID = """
requests AS (
  SELECT starting_airport, destination_airport FROM paths
  UNION ALL SELECT 'X' || starting_airport, destination_airport FROM paths
  UNION ALL SELECT starting_airport, 'X' || destination_airport FROM paths
),
valid AS (
  SELECT starting_airport, destination_airport FROM requests
  WHERE starting_airport IN (SELECT starting_airport FROM summary)
    AND destination_airport IN (SELECT starting_airport FROM summary)
)"""


def text(c: str, scale: int = 2) -> str:
    return f"coalesce(CAST(CAST({c} AS DECIMAL(18,{scale})) AS VARCHAR), '{MISSING_TEXT}')"


EXTRACT = [
    "leg_id", "flight_date", "starting_airport", "destination_airport", "is_refundable",
    "is_nonstop", "base_fare", "total_fare", "seats_remaining", "travel_duration",
    "total_travel_distance", "segments_airline_name",
]
EXTRACT_OUT = ", ".join(dbl(c) if c.endswith("_fare") else c for c in EXTRACT)
ROW_BYTES = " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 0)" for c in EXTRACT)
RUNNING = f"""
placed AS (
  SELECT *, row_number() OVER (ORDER BY leg_id) - 1 AS pos,
         coalesce(sum({ROW_BYTES}) OVER (ORDER BY leg_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bytes_before
  FROM itineraries
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join((ITINERARIES, *ctes)) + "\n"


def season_fares(value: str = "base_fare") -> str:
    return f"SELECT starting_airport, {avg(value)} AS fare FROM itineraries WHERE {SEASON} " \
        "GROUP BY starting_airport"


def period_avg(start: str, name: str, keys: str, keep: str, rounded: bool) -> str:
    value = f"CAST(round({avg('n')}) AS INTEGER)" if rounded else avg("n")
    return with_() + f"""SELECT {keys}, {value} AS {name} FROM (
  SELECT {keys}, {start} AS period, count(leg_id) AS n
  FROM itineraries WHERE {keep} GROUP BY ALL) GROUP BY {keys}"""


ROUTE = "starting_airport, destination_airport"
MONTH = "date_trunc('month', flight_date)"

# A segment and what its order says, numbered in leg order.
SEGMENTS = f"""
WITH segments AS (
  SELECT o_orderkey AS leg_id,
         row_number() OVER w AS segment_no,
         CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) + l_linenumber * 3600
           AS departure_epoch,
         CAST(l_quantity AS INTEGER) * 300 AS duration_seconds,
         'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS arrival_airport,
         'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS home,
         n_name AS airline_name, CASE WHEN o_orderkey % 7 <> 0 THEN p_type END AS equipment, p_size AS distance,
         l_returnflag AS cabin_code
  FROM orders
  JOIN lineitem ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
  WINDOW w AS (PARTITION BY o_orderkey ORDER BY {LEG_ORDER}, l_quantity, l_returnflag)
)
SELECT leg_id, CAST(segment_no AS INTEGER) AS segment_no,
       departure_epoch,
       strftime(make_timestamp(departure_epoch * 1000000), '%Y-%m-%dT%H:%M') AS departure_time,
       departure_epoch + duration_seconds AS arrival_epoch,
       strftime(make_timestamp((departure_epoch + duration_seconds) * 1000000),
         '%Y-%m-%dT%H:%M') AS arrival_time,
       coalesce(lag(arrival_airport) OVER (PARTITION BY leg_id ORDER BY segment_no), home)
         AS departure_airport,
       arrival_airport, airline_name, arrival_airport AS airline_code, equipment,
       duration_seconds, distance, cabin_code
FROM segments"""

# The times of segments with the offsets that the query gives them.
TIMES = f"""
WITH legs AS (
  SELECT o_orderkey AS leg_id, row_number() OVER w AS segment_no,
         CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) + l_linenumber * 3600 AS leaves,
         CAST(l_quantity AS INTEGER) * 300 AS seconds
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WINDOW w AS (PARTITION BY o_orderkey ORDER BY {LEG_ORDER}, l_quantity, l_returnflag)
),
clocks AS (
  SELECT leg_id, segment_no, side, z, CASE WHEN z % 11 <> 0 THEN clock + 30 END AS clock,
         CASE WHEN z % 11 = 0 OR z % 7 = 6 THEN NULL WHEN z % 3 = 0 THEN 330 WHEN z % 3 = 1 THEN -240 ELSE 0 END AS ahead
  FROM (SELECT leg_id, segment_no, 'd' AS side, leaves AS clock, leg_id + segment_no - 1 AS z FROM legs
        UNION ALL SELECT leg_id, segment_no, 'a', leaves + seconds, leg_id + segment_no FROM legs)
),
times AS (
  SELECT leg_id, segment_no, side, ahead, clock - 60 * coalesce(ahead, 0) AS utc, make_timestamp(clock * 1000000) AS local FROM clocks
),
segments AS (
  SELECT d.leg_id, CAST(d.segment_no AS INTEGER) AS segment_no,
         d.local AS departure_local, CAST(d.ahead AS INTEGER) AS departure_offset_minutes,
         make_timestamp(d.utc * 1000000) AS departure_utc, d.utc AS departure_epoch,
         a.local AS arrival_local, CAST(a.ahead AS INTEGER) AS arrival_offset_minutes,
         make_timestamp(a.utc * 1000000) AS arrival_utc, a.utc AS arrival_epoch,
         CAST(floor((n.utc - a.utc) / 60) AS BIGINT) AS layover_minutes,
         CAST(n.local AS DATE) > CAST(a.local AS DATE) AS overnight_stop
  FROM times d JOIN times a ON a.leg_id = d.leg_id AND a.segment_no = d.segment_no AND a.side = 'a'
  LEFT JOIN times n ON n.leg_id = d.leg_id AND n.segment_no = d.segment_no + 1 AND n.side = 'd'
  WHERE d.side = 'd'
)"""

TOP_DESTINATIONS = """
  SELECT CAST({} AS DATE) AS period_start, destination_airport, count(*) AS num_flights, {} AS average_base_fare
  FROM itineraries GROUP BY ALL"""
MONTH_START = "date_trunc('month', flight_date)"
SEASON_START = "date_trunc('quarter', flight_date + INTERVAL 1 MONTH) - INTERVAL 1 MONTH"


def top_destinations(start: str, measure: str) -> str:
    cells = TOP_DESTINATIONS.format(start, avg("base_fare"))
    return with_(f"cells AS ({cells})") + f"""SELECT * FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY period_start ORDER BY {measure} DESC) AS INTEGER) AS place
  FROM cells WHERE {measure} IS NOT NULL
) WHERE place <= {TOP}"""


# Which records the damaged files have, by layout.
MARKED = """
marked AS (SELECT *, leg_id % 40 AS m, CASE WHEN leg_id // 40 % 2 = 0 THEN 'a' ELSE 'b' END AS layout FROM itineraries)"""

HOVER = " || ".join(
    [
        "'Airport: ' || starting_airport",
        f"'<br>Avg Basefare: $' || {text('average_base_fare')}",
        f"'<br>Avg Cost of Flight: $' || {text('average_cost')}",
        f"'<br>Avg Amount of Flights per Day: ' || {text('average_flights_per_day', 0)}",
        f"'<br>Avg Travel Distance: ' || {text('average_travel_distance')} || ' Miles'",
        f"'<br>Min Basefare: $' || {text('min_fare_inbound')}",
        f"'<br>Max Basefare: $' || {text('max_fare_inbound')}",
        f"'<br>Avg Layover Basefare Difference: $' || {text('one_layover_difference')}"
        " || ', ' || one_layover_label",
        f"'<br>Avg 2-Layover Basefare Difference: $' || {text('two_layover_difference')}"
        " || ', ' || two_layover_label",
    ]
)
BETWEEN = "' Between ' || v.starting_airport || ' and ' || v.destination_airport || ': $'"

INSERT = f"""
fares AS (
  SELECT segments_airline_name AS airline_name, {ROUTE}, flight_date,
         CASE WHEN leg_id % 10 <> 0 THEN CAST(base_fare AS DOUBLE) END AS base_fare
  FROM itineraries WHERE {ONE}
),
existing AS (SELECT DISTINCT * EXCLUDE (flight_date) FROM fares WHERE flight_date < DATE '1999-01-01'),
incoming AS (SELECT * EXCLUDE (flight_date) FROM fares WHERE flight_date >= DATE '1997-01-01')"""

ORACLE = {
    "extract_columns": with_() + f"SELECT {EXTRACT_OUT} FROM itineraries",
    "systematic_sample": with_(RUNNING)
    + f"SELECT {EXTRACT_OUT} FROM placed WHERE pos % {SAMPLE_STEP} = 0",
    "size_capped_extract": with_(RUNNING)
    + f"SELECT {EXTRACT_OUT} FROM placed WHERE bytes_before <= {BUDGET}",
    "size_capped_chunks": with_(RUNNING)
    + f"""SELECT {EXTRACT_OUT} FROM placed WHERE pos // {CHUNK_ROWS} IN (
  SELECT pos // {CHUNK_ROWS} FROM placed
  WHERE pos % {CHUNK_ROWS} = 0 AND bytes_before <= {BUDGET})""",
    "systematic_sample_text_id": with_(
        """
named AS (
  SELECT *, CASE WHEN leg_id % 50 <> 0 THEN 'id' || (leg_id % 500) END AS text_id FROM itineraries
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY flight_date NULLS FIRST, text_id NULLS FIRST, leg_id) - 1 AS pos
  FROM named
)"""
    )
    + money_rows("placed", "leg_id", "flight_date", ROUTE, "text_id")
    + f" WHERE pos % {SAMPLE_STEP} = 0",
    "chunk_union": with_(
        """
dated AS (
  SELECT * REPLACE (CASE WHEN leg_id % 20 <> 0 THEN flight_date END AS flight_date) FROM itineraries
)"""
    )
    + money_rows("dated", "leg_id", "flight_date", ROUTE)
    + f" WHERE flight_date < DATE '{YEAR}-01-01' OR flight_date IS NULL UNION ALL "
    + money_rows("dated", "leg_id", "flight_date", ROUTE)
    + f" WHERE flight_date >= DATE '{YEAR - 1}-01-01' OR flight_date IS NULL",
    "cast_flight_date": with_() + "SELECT leg_id, flight_date FROM itineraries",
    "drop_index_column": with_() + money_rows("itineraries", "leg_id", "flight_date"),
    "filter_season": with_()
    + money_rows("itineraries", "leg_id", "flight_date", "starting_airport")
    + f" WHERE {SEASON}",
    "filter_one_leg": with_()
    + money_rows("itineraries", "leg_id", "segments_airline_name")
    + f" WHERE {ONE}",
    "filter_two_leg": with_()
    + money_rows("itineraries", "leg_id", "segments_airline_name")
    + f" WHERE {TWO}",
    "filter_three_leg": with_()
    + money_rows("itineraries", "leg_id", "segments_airline_name")
    + f" WHERE {THREE}",
    "filter_airport_list": f"WITH {AIRPORTS} SELECT * FROM airports WHERE iata IN ({CODE_LIST})",
    "avg_fare_season": with_()
    + f"""SELECT starting_airport, round_even(fare, 2) AS average_base_fare,
  format('{{:,.2f}}', fare) AS average_base_fare_text FROM ({season_fares()})""",
    "route_avg_fare": with_()
    + f"""SELECT {avg('base_fare')} AS average_base_fare FROM itineraries
WHERE starting_airport = '{START}' AND destination_airport = '{DEST}'""",
    "avg_cost_by_airport": with_(DAILY, FLIGHTS) + "SELECT * FROM costs",
    "max_fare_by_dest": with_(STATS)
    + f"SELECT destination_airport, {dbl('max_base_fare')} FROM stats",
    "min_fare_by_dest": with_(STATS)
    + f"SELECT destination_airport, {dbl('min_base_fare')} FROM stats",
    "dest_max_fare": with_(STATS)
    + f"""SELECT destination_airport, {dbl('max_base_fare')} FROM stats
WHERE max_base_fare = (SELECT max(max_base_fare) FROM stats)""",
    "dest_min_fare": with_(STATS)
    + f"""SELECT destination_airport, {dbl('min_base_fare')} FROM stats
WHERE min_base_fare = (SELECT min(min_base_fare) FROM stats)""",
    "dest_fare_stats": with_(STATS)
    + f"""SELECT destination_airport, {dbl('min_base_fare')}, {dbl('max_base_fare')},
  round_even(fare, 2) AS average_base_fare,
  format('{{:,.2f}}', fare) AS average_base_fare_text FROM stats""",
    "format_fare": with_(STATS)
    + """SELECT destination_airport, round_even(fare, 2) AS average_base_fare,
  format('{:,.2f}', fare) AS average_base_fare_text FROM stats""",
    "flights_per_airport_day": with_(DAILY)
    + "SELECT starting_airport, flight_date, n AS num_flights FROM daily",
    "avg_flights_per_day": period_avg(
        "flight_date", "average_flights_per_day", "starting_airport", "true", True
    ),
    "avg_flights_per_month": period_avg(
        MONTH, "average_flights_per_month", "starting_airport", "true", True
    ),
    "airport_daily_flights_and_cost": with_(DAILY, FLIGHTS)
    + "SELECT * FROM flights JOIN costs USING (starting_airport)",
    "avg_distance_by_airport": with_(DISTANCES)
    + "SELECT * FROM distances ORDER BY average_travel_distance DESC NULLS LAST, starting_airport",
    "top_distance_airports": with_(DISTANCES)
    + f"""SELECT * FROM distances
ORDER BY average_travel_distance DESC NULLS LAST, starting_airport LIMIT {PREVIEW_ROWS}""",
    "top_fare_one_leg": with_(f"\ntop1 AS ({top(ONE)})")
    + money_rows("top1", "airline_name", ROUTE),
    "top_fare_two_leg": with_(TOPS) + money_rows("top2", "airline_name", ROUTE),
    "top_fare_three_leg": with_(TOPS) + money_rows("top3", "airline_name", ROUTE),
    "carrier_max_fare_join": with_()
    + f"""SELECT i.segments_airline_name AS airline_name, starting_airport, destination_airport,
  {dbl('base_fare')}, count(*) AS num_itineraries
FROM itineraries i
JOIN (SELECT segments_airline_name, max(base_fare) AS best
      FROM itineraries GROUP BY segments_airline_name) m
  ON i.segments_airline_name = m.segments_airline_name AND base_fare = best
GROUP BY ALL""",
    "carrier_dedupe": with_()
    + f"""SELECT airline_name, starting_airport, destination_airport, {dbl('base_fare')} FROM (
  SELECT *, segments_airline_name AS airline_name,
         row_number() OVER (PARTITION BY segments_airline_name
           ORDER BY starting_airport, destination_airport, base_fare, leg_id) AS rn
  FROM itineraries) WHERE rn = 1""",
    "layover_mean_fares": with_(TOPS)
    + f"""SELECT (SELECT {avg('base_fare')} FROM top2) AS one_layover_mean,
  (SELECT {avg('base_fare')} FROM top3) AS two_layover_mean""",
    "avg_fare_by_airline_period": with_()
    + f"""SELECT airline_name, count(*) AS num_itineraries, {avg('base_fare')} AS average_base_fare
FROM (SELECT DISTINCT leg_id, base_fare,
        unnest(string_split(segments_airline_name, '||')) AS airline_name
      FROM itineraries
      WHERE flight_date >= DATE '{PERIOD[0]}' AND flight_date < DATE '{PERIOD[1]}')
GROUP BY airline_name""",
    "avg_fare_by_airline_rolling": with_(
        f"""
months AS (
  SELECT airline_name, year(flight_date) * 12 + month(flight_date) - 1 AS m, count(*) AS n, sum(base_fare) AS s, count(base_fare) AS c
  FROM (SELECT DISTINCT leg_id, flight_date, base_fare, unnest(string_split(segments_airline_name, '||')) AS airline_name FROM itineraries)
  GROUP BY ALL
),
periods AS (
  SELECT airline_name, m + k - {ROLLING_MONTHS - 1} AS first, CAST(sum(n) AS BIGINT) AS num_itineraries, CAST(sum(s) AS DOUBLE) / nullif(sum(c), 0) AS average_base_fare
  FROM months, range({ROLLING_MONTHS}) t(k) GROUP BY ALL
)"""
    )
    + f"""SELECT airline_name, make_date(first // 12, first % 12 + 1, 1) AS period_start,
  make_date((first + {ROLLING_MONTHS}) // 12, (first + {ROLLING_MONTHS}) % 12 + 1, 1) AS period_end, num_itineraries, average_base_fare FROM periods""",
    "legs_histogram": with_()
    + """SELECT CAST(len(string_split(segments_airline_name, '||')) AS INTEGER) AS num_legs,
  count(*) AS num_itineraries FROM itineraries GROUP BY ALL""",
    "explode_segments": SEGMENTS,
    "segment_times": TIMES + " SELECT * FROM segments",
    "itinerary_layovers": TIMES
    + """ SELECT leg_id, count(layover_minutes) AS stops, max(layover_minutes) AS longest_layover,
  CAST(sum(layover_minutes) AS BIGINT) AS layover_minutes, count(*) FILTER (overnight_stop) AS overnight_stops
FROM segments GROUP BY leg_id""",
    "flights_between": with_(PATHS) + "SELECT * FROM paths",
    "avg_duration_by_route": with_()
    + f"SELECT {ROUTE}, {avg('minutes')} AS average_minutes FROM itineraries GROUP BY {ROUTE}",
    "route_popularity": with_()
    + f"""SELECT *, rank() OVER (ORDER BY average_seats_remaining) AS popularity_rank
FROM (SELECT {ROUTE}, {avg('seats_remaining')} AS average_seats_remaining
      FROM itineraries GROUP BY {ROUTE})""",
    "avg_nonstop_per_route": period_avg(
        "flight_date", "average_nonstop_per_day", ROUTE, "is_nonstop", False
    ),
    "avg_nonstop_per_route_month": period_avg(
        MONTH, "average_nonstop_per_month", ROUTE, "is_nonstop", False
    ),
    "popularity_by_season": with_()
    + f"""SELECT CAST(year(flight_date) AS INTEGER) AS year,
  CAST(month(flight_date) AS INTEGER) AS month, destination_airport,
  count(*) AS num_flights, {avg('base_fare')} AS average_base_fare
FROM itineraries GROUP BY ALL""",
    "most_popular_by_month": top_destinations(MONTH_START, "num_flights"),
    "most_popular_by_season": top_destinations(SEASON_START, "num_flights"),
    "most_expensive_by_season": top_destinations(SEASON_START, "average_base_fare"),
    "route_direct_vs_layover": with_()
    + f"""SELECT {ROUTE}, {avg('base_fare', 'num_legs = 1')} AS direct_average,
  {avg('base_fare', 'num_legs > 1')} AS layover_average,
  {avg('base_fare', 'num_legs = 2')} AS one_layover_average,
  {avg('base_fare', 'num_legs = 3')} AS two_layover_average
FROM itineraries GROUP BY {ROUTE}""",
    "path_weight": with_(PATHS, AIRPORTS)
    + """SELECT starting_airport, destination_airport, cnt,
  CAST(cnt AS DOUBLE) / (SELECT max(cnt) FROM paths) AS weight,
  a.long AS start_lon, a.lat AS start_lat, b.long AS end_lon, b.lat AS end_lat
FROM paths LEFT JOIN airports a ON a.iata = starting_airport
LEFT JOIN airports b ON b.iata = destination_airport""",
    "route_fare_lookup": with_(TOPS)
    + f"""SELECT {dbl('base_fare')} FROM (SELECT * FROM top2 UNION ALL SELECT * FROM top3)
WHERE starting_airport = '{START}' AND destination_airport = '{DEST}'""",
    "airport_summary": with_(SUMMARY) + "SELECT * FROM summary",
    "airport_summary_from_tables": with_(SUMMARY) + "SELECT * FROM summary",
    "airport_layover_difference": with_(LAYOVERS) + "SELECT * FROM layovers",
    "airport_map_points": with_(LAYOVERS, AIRPORTS)
    + f"""SELECT iata, long AS lon, lat, {HOVER} AS hover_text
FROM airports LEFT JOIN layovers ON starting_airport = iata WHERE iata IN ({CODE_LIST})""",
    "route_request_valid": with_(SUMMARY, PATHS, VALID) + "SELECT * FROM valid",
    "route_layover_difference": with_(LAYOVERS, PATHS, VALID)
    + f"""SELECT v.starting_airport, v.destination_airport,
  one_layover_difference, two_layover_difference,
  (SELECT count(*) FROM top2 t WHERE t.starting_airport = v.starting_airport
     AND t.destination_airport = v.destination_airport) AS one_layover_fares,
  (SELECT CAST(max(base_fare) AS DOUBLE) FROM top2 t
     WHERE t.starting_airport = v.starting_airport
     AND t.destination_airport = v.destination_airport) AS one_layover_top_fare,
  (SELECT count(*) FROM top3 t WHERE t.starting_airport = v.starting_airport
     AND t.destination_airport = v.destination_airport) AS two_layover_fares,
  (SELECT CAST(max(base_fare) AS DOUBLE) FROM top3 t
     WHERE t.starting_airport = v.starting_airport
     AND t.destination_airport = v.destination_airport) AS two_layover_top_fare
FROM valid v JOIN layovers l ON l.starting_airport = v.starting_airport""",
    "route_line": with_(LAYOVERS, PATHS, VALID, AIRPORTS)
    + f"""SELECT v.starting_airport, v.destination_airport,
  a.long AS start_lon, a.lat AS start_lat, b.long AS end_lon, b.lat AS end_lat,
  'Average Layover Basefare Difference' || {BETWEEN} || {text('one_layover_difference')}
  || '<br>Average 2-Layover Basefare Difference' || {BETWEEN} || {text('two_layover_difference')}
    AS hover_text
FROM valid v JOIN layovers l ON l.starting_airport = v.starting_airport
LEFT JOIN airports a ON a.iata = v.starting_airport
LEFT JOIN airports b ON b.iata = v.destination_airport""",
    "mart_insert_ignore": with_(INSERT) + "SELECT * FROM existing UNION SELECT * FROM incoming",
    "mart_unseen_rows": with_(INSERT) + "SELECT * FROM incoming EXCEPT SELECT * FROM existing",
    "csv_round_trip": with_()
    + f"""SELECT CAST(leg_id AS VARCHAR) AS leg_id, flight_date, starting_airport, {dbl('base_fare')},
  is_nonstop, segments_airline_name, num_legs FROM itineraries""",
    "mart_insert_by_month": with_(
        """
rows AS (SELECT CASE WHEN leg_id % 30 <> 0 THEN flight_date END AS flight_date, starting_airport, destination_airport,
           CAST(CASE WHEN leg_id % 10 <> 0 THEN base_fare END AS DOUBLE) AS base_fare FROM itineraries)"""
    )
    + "SELECT DISTINCT * FROM rows",
    "rollup_differences": with_()
    + f"""SELECT flight_date, CASE WHEN month(flight_date) = {SUMMER[0]} THEN starting_airport ELSE 'ZZZ' END AS starting_airport,
  destination_airport, count(*) AS itineraries, CASE WHEN month(flight_date) = {SUMMER[0]} THEN 'missing' ELSE 'extra' END AS side
FROM itineraries WHERE year(flight_date) = {YEAR} AND month(flight_date) IN ({SUMMER[0]}, {SUMMER[1]}) AND starting_airport = '{START}'
GROUP BY ALL""",
    "csv_two_layouts": with_()
    + f"""SELECT CAST(leg_id AS VARCHAR) AS leg_id, CASE WHEN year(flight_date) < {YEAR} THEN flight_date END AS flight_date,
  starting_airport, destination_airport, {dbl('base_fare')}, CASE WHEN year(flight_date) >= {YEAR} THEN is_nonstop END AS is_nonstop
FROM itineraries""",
    "csv_accepted": with_(MARKED)
    + f"""SELECT CAST(leg_id AS VARCHAR) AS leg_id, CASE WHEN layout = 'a' THEN flight_date END AS flight_date,
  starting_airport, destination_airport, {dbl('base_fare')}, CASE WHEN layout = 'b' THEN is_nonstop END AS is_nonstop
FROM marked WHERE m NOT IN (3, 11, 13, 17) AND NOT (m = 7 AND layout = 'a')""",
    "csv_quarantine": with_(MARKED)
    + """SELECT layout, reason, column_name, count(*) AS num_problems FROM (
  SELECT layout, 'bad cell' AS reason, 'base_fare' AS column_name FROM marked WHERE m = 3
  UNION ALL SELECT layout, 'bad cell', 'flight_date' FROM marked WHERE m IN (3, 7) AND layout = 'a'
  UNION ALL SELECT layout, CASE m WHEN 11 THEN 'short record' WHEN 13 THEN 'long record' ELSE 'broken quote' END, NULL
  FROM marked WHERE m IN (11, 13, 17)
) GROUP BY ALL""",
    "airport_file_round_trip": f"WITH {AIRPORTS} SELECT * FROM airports",
    "path_file_round_trip": with_(PATHS, AIRPORTS)
    + """SELECT cnt, a.long AS start_lon, a.lat AS start_lat, b.long AS end_lon, b.lat AS end_lat
FROM paths LEFT JOIN airports a ON a.iata = starting_airport
LEFT JOIN airports b ON b.iata = destination_airport""",
    "lake_season": with_()
    + money_rows("itineraries", "leg_id", "flight_date", ROUTE)
    + f" WHERE {SEASON}",
    "stored_table_differences": with_(STATS)
    + f"""SELECT destination_airport, {dbl('max_base_fare')}, 'missing' AS side FROM stats
WHERE destination_airport = '{DEST}'
UNION ALL SELECT 'ZZZ', {dbl('max_base_fare')}, 'extra' FROM stats
WHERE destination_airport = '{DEST}'""",
    "squares_even": """SELECT CAST(p_size AS BIGINT) * p_size AS square FROM part
WHERE p_size % 2 = 0""",
    "tokenize_text": "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents",
}

# The ten result tables: the query that each is, its texts and its numbers.
_RESULTS = {
    "average_flight_prices": ("avg_fare_season", "starting_airport", ["average_base_fare"]),
    "route_average": ("route_avg_fare", "''", ["average_base_fare"]),
    "starting_flights": ("airport_daily_flights_and_cost", "starting_airport", ["average_flights_per_day", "average_cost"]),
    "max_airport_base_fare": ("dest_max_fare", "destination_airport", ["max_base_fare"]),
    "min_airport_base_fare": ("dest_min_fare", "destination_airport", ["min_base_fare"]),
    "min_max_flights": ("dest_fare_stats", "destination_airport", ["min_base_fare", "max_base_fare", "average_base_fare"]),
    **{
        f"{n}_leg_flights": (f"top_fare_{n}_leg", "airline_name || '|' || starting_airport || '|' || destination_airport", ["base_fare"])
        for n in ("one", "two", "three")
    },
    "travel_distance": ("avg_distance_by_airport", "starting_airport", ["average_travel_distance"]),
}
ORACLE["mart_build"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, {key} AS row_key, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM ({ORACLE[query]})"
    for table, (query, key, columns) in _RESULTS.items()
    for c in columns
)
ORACLE["mart_update"] = ORACLE["mart_build"]
