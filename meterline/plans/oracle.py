"""The registered queries in plain SQL, written independently of the operators."""

from __future__ import annotations

_TRIPS = """
trips AS (
  SELECT t.*, strftime(tpep_pickup_datetime, '%Y-%m') AS source_month,
         fare_amount + tip_amount + tolls_amount - CAST(10 AS DOUBLE) AS total_amount,
         date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS secs
  FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      o_orderdate + to_seconds(l_orderkey * 7919 % 86400) AS tpep_pickup_datetime,
      o_orderdate + to_seconds(l_orderkey * 7919 % 86400 + l_partkey * 37 % 12000 - 300)
        AS tpep_dropoff_datetime,
      CAST(l_suppkey % 2 + 1 AS BIGINT) AS vendorid,
      CAST(l_suppkey % 8 AS BIGINT) AS payment_type,
      CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END
        AS passenger_count,
      CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber % 6 + 1 AS BIGINT) END
        AS ratecodeid,
      CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END
        AS store_and_fwd_flag,
      CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
      CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(l_suppkey % 2 AS DOUBLE) END AS airport_fee,
      CAST(l_partkey % 265 + 1 AS BIGINT) AS pulocationid,
      CAST(l_suppkey % 265 + 1 AS BIGINT) AS dolocationid,
      l_quantity * CAST(2.1 AS DOUBLE) AS trip_distance,
      l_extendedprice / 200 AS fare_amount,
      (l_extendedprice / 200) * (l_discount - CAST(0.005 AS DOUBLE)) * 3 AS tip_amount,
      l_tax * 100 AS tolls_amount,
      CAST(0.5 AS DOUBLE) AS mta_tax, CAST(1 AS DOUBLE) AS improvement_surcharge,
      CAST(l_linenumber % 3 AS DOUBLE) AS extra
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
)"""

_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# The trip view without the helper column.
_RAW = (
    f"{_KEYS}, tpep_pickup_datetime, tpep_dropoff_datetime, vendorid, payment_type, "
    "passenger_count, ratecodeid, store_and_fwd_flag, congestion_surcharge, airport_fee, "
    "pulocationid, dolocationid, trip_distance, fare_amount, tip_amount, tolls_amount, mta_tax, "
    "improvement_surcharge, extra, source_month, total_amount"
)

_CLEAN_COLUMNS = (
    "source_month, vendorid, passenger_count, trip_distance, ratecodeid, store_and_fwd_flag, "
    "payment_type, pulocationid, dolocationid, is_airport_trip, fare_amount, extra, mta_tax, "
    "tip_amount, tolls_amount, improvement_surcharge, congestion_surcharge, airport_fee, "
    "total_amount, trip_duration_min, pickup_hour, pickup_dayofweek, is_weekend, time_of_day, "
    "avg_speed_mph, tip_pct, fare_per_mile, generous_tipper"
)

_LEAKY = {"tip_amount", "tip_pct", "total_amount", "fare_per_mile", "source_month"}
_NO_LEAKAGE = ", ".join(c for c in _CLEAN_COLUMNS.split(", ") if c not in _LEAKY)


def _half_up(value: str, digits: int) -> str:
    """Round half up on the shortest decimal text of a double, as Spark does."""
    return f"CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(30,{digits})) AS DOUBLE)"


_SCALE = f"{2**74}::DOUBLE"


def _mean(column: str, digits: int | None = None) -> str:
    """Mean from the exact sum of doubles: 2^74 times a value of these columns is a whole number."""
    value = f"(CAST(sum(CAST({column} * {_SCALE} AS HUGEINT)) AS DOUBLE) / {_SCALE} / count({column}))"
    return value if digits is None else _half_up(value, digits)


def _percent(part: str, whole: str) -> str:
    return _half_up(f"(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * CAST(100 AS DOUBLE))", 1)


_DERIVED = f"""
derived AS (
  SELECT d.*,
    CASE WHEN pickup_dayofweek IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN pickup_hour <= 5 THEN 'night' WHEN pickup_hour <= 11 THEN 'morning'
         WHEN pickup_hour <= 17 THEN 'afternoon' ELSE 'evening' END AS time_of_day,
    CASE WHEN tip_pct > CAST(0.2 AS DOUBLE) THEN 1 ELSE 0 END AS generous_tipper
  FROM (
    SELECT *,
      {_half_up("secs / CAST(60 AS DOUBLE)", 2)} AS trip_duration_min,
      CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
      CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
      CASE WHEN secs <> 0 THEN
        {_half_up("trip_distance / (secs / CAST(3600 AS DOUBLE))", 2)} END AS avg_speed_mph,
      {_half_up("tip_amount / fare_amount", 4)} AS tip_pct,
      CASE WHEN pulocationid IN (1, 132, 138) OR dolocationid IN (1, 132, 138) THEN 1 ELSE 0 END
        AS is_airport_trip,
      {_half_up("fare_amount / trip_distance", 2)} AS fare_per_mile
    FROM trips) d
)"""

_RULES = {
    "fare_in_range": "fare_amount BETWEEN 2.5 AND 500",
    "distance_in_range": "trip_distance BETWEEN CAST(0.01 AS DOUBLE) AND 100",
    "tip_not_negative": "tip_amount >= 0",
    "total_positive": "total_amount > 0",
    "dropoff_after_pickup": "tpep_dropoff_datetime > tpep_pickup_datetime",
    "known_payment_code": "payment_type IN (1, 2, 3, 4, 5, 6)",
    "pickup_in_period": "year(tpep_pickup_datetime) = 1998",
    "duration_in_range": "trip_duration_min BETWEEN 0.5 AND 180",
    "speed_possible": "avg_speed_mph <= 100",
}

_NO_PERIOD = " AND ".join(f"({r})" for name, r in _RULES.items() if name != "pickup_in_period")

_CLEAN = f"""
clean AS (
  SELECT * REPLACE (
    coalesce(passenger_count, 1) AS passenger_count,
    coalesce(ratecodeid, 1) AS ratecodeid,
    coalesce(congestion_surcharge, CAST(2.5 AS DOUBLE)) AS congestion_surcharge,
    coalesce(airport_fee, CAST(0 AS DOUBLE)) AS airport_fee,
    coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag)
  FROM (SELECT DISTINCT * FROM derived) WHERE {_NO_PERIOD}
)"""

_FROM_TRIPS = f"WITH {_TRIPS}"
_FROM_DERIVED = f"WITH {_TRIPS}, {_DERIVED}"
_FROM_CLEAN = f"WITH {_TRIPS}, {_DERIVED}, {_CLEAN}"


def _score(hours: str) -> str:
    card = _half_up(
        "(CAST(0.72 AS DOUBLE)"
        " + CASE WHEN is_airport_trip <> 0 THEN CAST(0.08 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        f" + CASE WHEN {hours} THEN CAST(0.04 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        " + CASE WHEN trip_distance > 5 THEN CAST(0.03 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        " + CASE WHEN fare_amount > 20 THEN CAST(0.03 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)",
        4,
    )
    return (
        "CASE payment_type WHEN 2 THEN CAST(0.06 AS DOUBLE) "
        f"WHEN 1 THEN least({card}, CAST(0.97 AS DOUBLE)) ELSE CAST(0.5 AS DOUBLE) END"
    )


def _scored(hours: str = "pickup_hour >= 18", source: str = "clean") -> str:
    return (
        f"scored AS (SELECT *, CASE WHEN confidence >= 0.5 THEN CAST(1 AS DOUBLE) "
        f"ELSE CAST(0 AS DOUBLE) END AS prediction FROM "
        f"(SELECT *, {_score(hours)} AS confidence FROM {source}) s)"
    )


_FROM_SCORED = f"{_FROM_CLEAN}, {_scored()}"

_CELLS = """
cells AS (SELECT
  count(*) FILTER (generous_tipper = 0 AND prediction = 0) AS tn,
  count(*) FILTER (generous_tipper = 0 AND prediction = 1) AS fp,
  count(*) FILTER (generous_tipper = 1 AND prediction = 0) AS fn,
  count(*) FILTER (generous_tipper = 1 AND prediction = 1) AS tp
  FROM scored)"""

_REQUEST_RULES = {
    "payment_type": "payment_type BETWEEN 1 AND 6",
    "pickup_hour": "pickup_hour BETWEEN 0 AND 23",
    "pickup_dayofweek": "pickup_dayofweek BETWEEN 1 AND 7",
    "passenger_count": "passenger_count BETWEEN 1 AND 6",
    "is_airport_trip": "is_airport_trip BETWEEN 0 AND 1",
    "ratecodeid": "ratecodeid BETWEEN 1 AND 6",
    "pulocationid": "pulocationid BETWEEN 1 AND 265",
    "dolocationid": "dolocationid BETWEEN 1 AND 265",
    "trip_distance": "trip_distance > 0 AND trip_distance <= 100",
    "trip_duration_min": "trip_duration_min > 0 AND trip_duration_min <= 180",
    "fare_amount": "fare_amount BETWEEN 2.5 AND 500",
    "congestion_surcharge": "congestion_surcharge >= 0",
}

_SPEEDING = (
    "trip_distance > 0 AND trip_distance <= 100 AND trip_duration_min > 0 AND "
    "trip_duration_min <= 180 AND trip_distance / (trip_duration_min / 60) > 100"
)

_VIOLATIONS = ", ".join(
    [f"CASE WHEN NOT ({r}) THEN '{name}' END" for name, r in _REQUEST_RULES.items()]
    + [f"CASE WHEN {_SPEEDING} THEN 'average_speed' END"]
)

_FROM_REQUESTS = f"""{_FROM_DERIVED},
requests AS (
  SELECT * REPLACE (
    secs / CAST(60 AS DOUBLE) AS trip_duration_min,
    coalesce(passenger_count, 1) AS passenger_count,
    coalesce(ratecodeid, 1) AS ratecodeid,
    coalesce(congestion_surcharge, CAST(2.5 AS DOUBLE)) AS congestion_surcharge)
  FROM derived),
checked AS (SELECT *, concat_ws(',', {_VIOLATIONS}) AS violations FROM requests)"""

_HASH = f"CAST('0x' || substr(md5(concat_ws('|', '42', {_KEYS})), 1, 13) AS BIGINT)"


def _below(fraction: float) -> int:
    return int(fraction * (1 << 52))


def _histogram(source: str, value: str, bins: int) -> str:
    return f"""{source},
x AS (SELECT CAST({value} AS DOUBLE) AS x FROM SOURCE WHERE {value} IS NOT NULL),
span AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS low,
                CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS high FROM x),
w AS (SELECT low, (high - low) / CAST({bins} AS DOUBLE) AS width FROM span),
edges AS (SELECT CAST(i AS BIGINT) AS bin, low + (i - 1) * width AS bin_start,
                 low + i * width AS bin_end
          FROM w, range(1, {bins + 1}) r(i))
SELECT bin, bin_start, bin_end,
  CAST((SELECT count(*) FROM x WHERE
    CASE WHEN bin = 1 THEN x < bin_end
         WHEN bin = {bins} THEN x >= bin_start
         ELSE x >= bin_start AND x < bin_end END) AS BIGINT) AS row_count
FROM edges"""


_EXPLORED = (
    "source_month IN ('1995-03', '1995-04', '1996-07') AND time_of_day IN ('morning', 'evening') "
    "AND is_airport_trip = 0 AND payment_type = 2"
)

_FIGURES = f"""count(*) AS trips, {_mean("fare_amount")} AS avg_fare,
  {_mean("tip_amount")} AS avg_tip, {_mean("trip_distance")} AS avg_distance,
  {_mean("trip_duration_min")} AS avg_duration_min,
  CAST(sum(generous_tipper) AS DOUBLE) / count(*) * 100 AS pct_generous"""

_SUMMARY = f"""SELECT source_month, time_of_day, is_airport_trip, count(*) AS total_trips,
  {_mean("fare_amount", 2)} AS avg_fare, {_mean("tip_amount", 2)} AS avg_tip,
  {_mean("trip_distance", 2)} AS avg_distance,
  {_mean("trip_duration_min", 2)} AS avg_duration_min, {_mean("tip_pct", 4)} AS avg_tip_pct,
  {_half_up("(CAST(sum(generous_tipper) AS DOUBLE) / count(*))", 3)} AS generous_tipper_rate,
  CAST(sum(generous_tipper) AS BIGINT) AS generous_tippers
FROM clean GROUP BY ALL"""

_REMOVED = f"""raw_rows - clean_rows AS removed_rows,
  {_percent("(raw_rows - clean_rows)", "raw_rows")} AS removed_pct"""

_RESPONSE = f"""{_KEYS}, CAST(prediction AS INTEGER) AS prediction,
  CASE WHEN prediction = 1 THEN 'Generous Tipper' ELSE 'Not a Generous Tipper' END
    AS prediction_label,
  {_half_up("confidence", 4)} AS confidence,
  printf('%.1f%%', confidence * 100) AS confidence_pct,
  'rule_based_fallback' AS inference_method,
  CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
    WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided'
    ELSE CAST(payment_type AS VARCHAR) END AS payment,
  trip_distance AS trip_distance_mi, fare_amount AS fare_amount_usd,
  trip_duration_min AS duration_min, pickup_hour, time_of_day,
  is_airport_trip <> 0 AS is_airport_trip, is_weekend <> 0 AS is_weekend"""


def _summary_row(label: str, measure: str) -> str:
    columns = ["trip_distance", "fare_amount", "tip_amount", "total_amount", "passenger_count"]
    cells = ", ".join(f"{_half_up(measure.replace('#', c), 6)} AS {c}" for c in columns)
    return f"SELECT '{label}' AS summary, {cells} FROM trips"


def _audit(rules: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS rows_total, "
        f"count(*) FILTER (NOT coalesce({rule}, FALSE)) AS rows_failed FROM {source}"
        for name, rule in rules.items()
    )


_FIRST = (
    "CASE "
    + " ".join(f"WHEN NOT coalesce({r}, FALSE) THEN '{name}'" for name, r in _RULES.items())
    + " ELSE 'accepted' END"
)


def _metrics(klass: int, hits: str, guessed: str, support: str) -> str:
    def ratio(whole: str) -> str:
        value = f"CASE WHEN {whole} > 0 THEN CAST({hits} AS DOUBLE) / ({whole}) ELSE 0 END"
        return _half_up(f"({value})", 4)

    f1 = "CASE WHEN p + r > 0 THEN CAST(2 AS DOUBLE) * p * r / (p + r) ELSE 0 END"
    return f"""SELECT {klass} AS generous_tipper, p AS precision, r AS recall,
  {_half_up(f"({f1})", 4)} AS f1, support,
  {_half_up("(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn))", 4)} AS accuracy
  FROM (SELECT *, {ratio(guessed)} AS p, {ratio(support)} AS r, {support} AS support FROM cells)"""


def _scaling() -> str:
    """Mean and deviation of each vector position: numbers, then category slots by count."""
    numbers = (
        "vendorid, passenger_count, trip_distance, ratecodeid, payment_type, pulocationid, "
        "dolocationid, is_airport_trip, fare_amount, extra, mta_tax, tolls_amount, "
        "improvement_surcharge, congestion_surcharge, airport_fee, trip_duration_min, "
        "pickup_hour, pickup_dayofweek, is_weekend, avg_speed_mph"
    ).split(", ")
    parts = [
        f"SELECT {i} AS position, '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS m, "
        f"stddev_samp(CAST({c} AS DOUBLE)) AS s FROM clean"
        for i, c in enumerate(numbers)
    ]
    offset = len(numbers)
    for c, slots in (("time_of_day", 4), ("store_and_fwd_flag", 2)):
        parts.append(
            f"""SELECT CAST({offset} + rk - 1 AS INTEGER), '{c}_enc_' || v,
  CAST(n AS DOUBLE) / t, sqrt((n - CAST(n AS DOUBLE) * n / t) / (t - 1))
  FROM (SELECT {c} AS v, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rk,
               sum(count(*)) OVER () AS t FROM clean GROUP BY {c})"""
        )
        offset += slots
    body = " UNION ALL ".join(parts)
    return (
        f"SELECT position, feature, {_half_up('m', 6)} AS mean, {_half_up('s', 6)} AS stddev "
        f"FROM ({body})"
    )


def statements() -> dict[str, str]:
    """Query name to SQL."""
    in_year = " AND ".join(f"({r})" for r in _RULES.values())
    split = f"CASE WHEN {_HASH} < {_below(0.8)} THEN 'train' ELSE 'test' END"
    null_columns = ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}" for c in _RAW.replace("\n", " ").split(", ")
    )
    complete = " AND ".join(f"{c} IS NOT NULL" for c in _RAW.split(", "))
    scored_requests = _scored(source="(SELECT * FROM checked WHERE violations = '')")
    slot = """CASE WHEN dayofweek(ts) IN (0, 6) THEN '1' ELSE '0' END || '/' ||
      CASE WHEN hour(ts) <= 5 THEN 'night' WHEN hour(ts) <= 11 THEN 'morning'
           WHEN hour(ts) <= 17 THEN 'afternoon' ELSE 'evening' END"""
    audited_optional = {
        "passengers_in_range": "passenger_count BETWEEN 1 AND 6",
        "cash_without_tip": "(payment_type <> 2 OR tip_amount = 0)",
    }
    weighted = {
        "accuracy": "(tp + tn) / t",
        "weighted_precision": "(p0 * (tn + fp) / t + p1 * (tp + fn) / t)",
        "weighted_recall": "(r0 * (tn + fp) / t + r1 * (tp + fn) / t)",
        "f1": "(f0 * (tn + fp) / t + f1_ * (tp + fn) / t)",
    }
    return {
        "trip_summary": f"{_FROM_CLEAN} {_SUMMARY}",
        "months_summary": f"{_FROM_CLEAN} {_SUMMARY}",
        "trip_summary_after_dedup": f"""WITH {_TRIPS.replace("trips AS (", "single AS (", 1)},
            trips AS (SELECT DISTINCT * FROM (SELECT * FROM single UNION ALL SELECT * FROM single)),
            {_DERIVED}, {_CLEAN} {_SUMMARY}""",
        "summary_csv_delivery": f"{_FROM_CLEAN} {_SUMMARY}",
        "clean_trips_count_by_month": f"""{_FROM_CLEAN}
            SELECT source_month, count(*) AS row_count FROM clean GROUP BY ALL""",
        "partitioned_roundtrip": f"""{_FROM_CLEAN}
            SELECT source_month, count(*) AS row_count FROM clean GROUP BY ALL""",
        "clean_trips_in_year": f"""{_FROM_DERIVED}
            SELECT source_month, time_of_day, count(*) AS row_count FROM derived
            WHERE {in_year} GROUP BY ALL""",
        "reduction_report": f"""{_FROM_CLEAN} SELECT raw_rows, clean_rows, {_REMOVED}
            FROM (SELECT (SELECT count(*) FROM trips) AS raw_rows,
                         (SELECT count(*) FROM clean) AS clean_rows)""",
        "reduction_report_by_month": f"""{_FROM_CLEAN}
            SELECT source_month, raw_rows, clean_rows, {_REMOVED}
            FROM (SELECT source_month, count(*) AS raw_rows FROM trips GROUP BY ALL)
            LEFT JOIN (SELECT source_month, count(*) AS clean_rows FROM clean GROUP BY ALL)
            USING (source_month)""",
        "derived_features": f"""{_FROM_DERIVED} SELECT {_KEYS}, trip_duration_min, pickup_hour,
            pickup_dayofweek, is_weekend, time_of_day, avg_speed_mph, tip_pct, is_airport_trip,
            fare_per_mile, generous_tipper FROM derived
            WHERE {_RULES["duration_in_range"]} AND {_RULES["speed_possible"]}""",
        "final_projection": f"{_FROM_CLEAN} SELECT {_CLEAN_COLUMNS} FROM clean",
        "leakage_free_columns": f"{_FROM_CLEAN} SELECT {_NO_LEAKAGE} FROM clean",
        "regressor_inputs": f"""{_FROM_CLEAN} SELECT trip_distance, trip_duration_min, pickup_hour,
            pickup_dayofweek, is_weekend, is_airport_trip, passenger_count, pulocationid,
            dolocationid, avg_speed_mph, fare_amount FROM clean""",
        "dedup_rows": f"""{_FROM_TRIPS}
            SELECT {_KEYS}, fare_amount, tip_amount, total_amount, source_month FROM (
              SELECT DISTINCT * FROM (SELECT * FROM trips UNION ALL SELECT * FROM trips))""",
        "rule_audit": f"{_FROM_DERIVED} {_audit(_RULES, 'derived')}",
        "optional_rule_audit": f"{_FROM_TRIPS} {_audit(audited_optional, 'trips')}",
        "first_failing_rule": f"""{_FROM_DERIVED}
            SELECT {_FIRST} AS rule, count(*) AS row_count FROM derived GROUP BY ALL""",
        "validated_requests": f"""{_FROM_REQUESTS}
            SELECT {_KEYS}, violations, congestion_surcharge FROM checked""",
        "quarantine_counts": f"""{_FROM_REQUESTS}
            SELECT rule, count(*) AS row_count
            FROM (SELECT unnest(string_split(violations, ',')) AS rule FROM checked
                  WHERE violations <> '') GROUP BY ALL""",
        "sorted_out_audit": f"{_FROM_DERIVED} {_audit(_RULES, 'derived')}",
        "sorted_out_requests": f"""{_FROM_REQUESTS}
            SELECT rule, count(*) AS row_count
            FROM (SELECT unnest(string_split(CASE WHEN violations = '' THEN 'accepted' ELSE violations END, ',')) AS rule FROM checked) GROUP BY ALL""",
        "null_counts": f"{_FROM_TRIPS} SELECT {null_columns} FROM trips",
        "null_defaults_profile": f"""{_FROM_TRIPS}
            SELECT coalesce(passenger_count, 1) AS passenger_count,
              coalesce(ratecodeid, 1) AS ratecodeid,
              coalesce(congestion_surcharge, CAST(2.5 AS DOUBLE)) AS congestion_surcharge,
              coalesce(airport_fee, CAST(0 AS DOUBLE)) AS airport_fee,
              coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, count(*) AS row_count
            FROM trips GROUP BY ALL""",
        "dropna_count": f"""{_FROM_TRIPS} SELECT source_month, count(*) AS row_count
            FROM trips WHERE {complete} GROUP BY ALL""",
        "describe_numeric": f"{_FROM_TRIPS} "
        + " UNION ALL ".join(
            [
                _summary_row("count", "CAST(count(#) AS DOUBLE)"),
                _summary_row("mean", _mean("#")),
                _summary_row("stddev", "stddev_samp(CAST(# AS DOUBLE))"),
                _summary_row("min", "CAST(min(#) AS DOUBLE)"),
                _summary_row("max", "CAST(max(#) AS DOUBLE)"),
            ]
        ),
        "class_distribution": f"""{_FROM_CLEAN} SELECT generous_tipper, count(*) AS row_count,
            {_percent("count(*)", "(SELECT count(*) FROM clean)")} AS pct
            FROM clean GROUP BY generous_tipper""",
        "tip_by_hour": f"""{_FROM_CLEAN} SELECT pickup_hour, count(*) AS trips,
            {_mean("tip_pct")} AS avg_tip_pct FROM clean GROUP BY ALL""",
        "tip_by_time_of_day": f"""{_FROM_CLEAN} SELECT time_of_day, count(*) AS trips,
            {_mean("tip_pct", 4)} AS avg_tip_pct FROM clean GROUP BY ALL""",
        "fare_by_bucket_and_payment": f"""{_FROM_CLEAN}
            SELECT time_of_day, payment_type, count(*) AS trips, {_mean("fare_amount")} AS avg_fare
            FROM clean GROUP BY ALL""",
        "one_month_filtered": f"""{_FROM_CLEAN}
            SELECT time_of_day, payment_type, count(*) AS trips, {_mean("fare_amount")} AS avg_fare
            FROM clean WHERE source_month = '1995-03' GROUP BY ALL""",
        "one_partition": f"""{_FROM_CLEAN} SELECT source_month, time_of_day, count(*) AS row_count
            FROM clean WHERE source_month = '1995-03' GROUP BY ALL""",
        "fare_by_time_of_day": f"""{_FROM_CLEAN} SELECT time_of_day, count(*) AS trips,
            {_mean("fare_amount", 2)} AS avg_fare FROM clean GROUP BY ALL""",
        "filtered_counts": f"""{_FROM_CLEAN} SELECT count(*) AS total,
            count(*) FILTER (generous_tipper = 1) AS generous,
            count(*) FILTER (is_airport_trip = 1) AS airport,
            count(*) FILTER (source_month = '1995-03') AS one_month FROM clean""",
        "global_avg": f"{_FROM_CLEAN} SELECT {_mean('fare_amount')} AS avg_fare_amount FROM clean",
        "kpis": f"{_FROM_CLEAN} SELECT {_FIGURES} FROM clean",
        "explorer_filtered": f"{_FROM_CLEAN} SELECT {_FIGURES} FROM clean WHERE {_EXPLORED}",
        "explorer_unfiltered_by_hour": f"""{_FROM_CLEAN}
            SELECT pickup_hour, count(*) AS trips FROM clean GROUP BY ALL""",
        "explorer_payment_code_by_hour": f"""{_FROM_CLEAN}
            SELECT pickup_hour, count(*) AS trips FROM clean WHERE payment_type = 5 GROUP BY ALL""",
        "describe_small_values": "WITH s AS (SELECT l_discount / 1e9::DOUBLE AS d FROM lineitem) "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS summary, {value} AS l_discount FROM s"
            for name, value in {
                "count": "CAST(count(d) AS DOUBLE)",
                **{n: f"round({f}(d) * 1e15::DOUBLE, 0)" for n, f in (("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"))},
            }.items()
        ),
        "means_of_small_values": f"""
            SELECT l_returnflag, l_linestatus, count(*) AS row_count,
              CAST(sum(CAST(l_extendedprice / 1e8::DOUBLE * {_SCALE} AS HUGEINT)) AS DOUBLE) / {_SCALE} AS sum_price,
              {_mean("(l_extendedprice / 1e8::DOUBLE)")} AS avg_price FROM lineitem GROUP BY ALL""",
        "reduction_report_null_months": f"""{_FROM_CLEAN},
            r AS (SELECT CASE WHEN l_orderkey % 5 <> 0 THEN source_month END AS source_month, count(*) AS raw_rows FROM trips GROUP BY 1),
            c AS (SELECT CASE WHEN l_orderkey % 5 <> 0 THEN source_month END AS source_month, count(*) AS clean_rows FROM clean GROUP BY 1)
            SELECT source_month, raw_rows, clean_rows, {_REMOVED} FROM (
              SELECT r.source_month, raw_rows, coalesce(clean_rows, 0) AS clean_rows
              FROM r LEFT JOIN c ON r.source_month IS NOT DISTINCT FROM c.source_month)""",
        "dropped_columns": """SELECT m AS source_month, count(*) AS row_count, CAST(sum(o_custkey) AS BIGINT) AS customers,
            'o_orderpriority,only_here' AS dropped
            FROM (SELECT '1994-12' AS m, * FROM orders UNION ALL SELECT '1995-01', * FROM orders) GROUP BY m""",
        "written_sample": f"""{_FROM_CLEAN} SELECT least(500, count(*)) AS row_count, least(500, count(*)) AS valid FROM clean""",
        "rewritten_partitions": f"""{_FROM_CLEAN} SELECT source_month, count(*) AS row_count FROM clean
            WHERE source_month <> '1995-03' OR vendorid = 1 GROUP BY ALL""",
        "generous_by_payment": f"""{_FROM_CLEAN} SELECT
            CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
              WHEN 4 THEN 'Dispute' ELSE CAST(payment_type AS VARCHAR) END AS payment,
            count(*) AS trips, {_percent("sum(generous_tipper)", "count(*)")} AS pct_generous
            FROM clean GROUP BY payment_type""",
        "fare_histogram": _histogram(_FROM_CLEAN, "greatest(0, least(80, fare_amount))", 40).replace(
            "SOURCE", "clean"
        ),
        "value_histogram": _histogram("WITH e AS (SELECT * FROM events)", "value", 40).replace(
            "SOURCE", "e"
        ),
        "confidence_histogram": _histogram(_FROM_SCORED, "confidence", 30).replace(
            "SOURCE", "scored"
        ),
        "events_by_hour": """SELECT CAST(hour(ts) AS INTEGER) AS pickup_hour, count(*) AS trips
            FROM events GROUP BY ALL""",
        "events_weekend_share": f"""SELECT {slot} AS slot, count(*) AS row_count,
            {_percent("count(*)", "(SELECT count(*) FROM events)")} AS pct
            FROM events GROUP BY slot""",
        "filter_menu_values": f"{_FROM_CLEAN} SELECT DISTINCT source_month FROM clean",
        "topn_trips": f"""{_FROM_CLEAN} SELECT {_KEYS}, fare_amount, tip_amount FROM clean
            ORDER BY fare_amount DESC, {_KEYS} LIMIT 10""",
        "fixed_sample": f"""{_FROM_CLEAN} SELECT {_KEYS}, fare_amount, generous_tipper FROM clean
            ORDER BY {_HASH}, {_KEYS}, fare_amount LIMIT 500""",
        "bernoulli_sample": f"""{_FROM_CLEAN} SELECT {_KEYS}, fare_amount, generous_tipper
            FROM clean WHERE {_HASH} < {_below(0.2)}""",
        "split_sizes": f"""{_FROM_CLEAN} SELECT {split} AS part, generous_tipper,
            count(*) AS row_count FROM clean GROUP BY ALL""",
        "random_split_total": f"""{_FROM_CLEAN}
            SELECT generous_tipper, count(*) AS row_count FROM clean GROUP BY ALL""",
        "reconciled_union": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
            o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS ratecodeid,
            CASE WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN '1994-12' ELSE '1998-12' END
              AS source_month FROM orders""",
        "lookup_csv_roundtrip": """SELECT c_custkey AS locationid, c_mktsegment AS borough,
            c_name AS zone, CAST(c_nationkey AS VARCHAR) AS service_zone FROM customer""",
        "category_positions": """SELECT category, n AS rows, row_number() OVER (ORDER BY n DESC, category) - 1 AS position
            FROM (SELECT CAST(l_partkey AS VARCHAR) AS category, count(*) AS n FROM lineitem GROUP BY ALL)""",
        "category_positions_of_lines": """WITH ranked AS (
              SELECT n, row_number() OVER (ORDER BY n DESC, category) - 1 AS position
              FROM (SELECT CAST(l_partkey AS VARCHAR) AS category, count(*) AS n FROM lineitem GROUP BY ALL))
            SELECT CAST(least(position, 50) AS DOUBLE) AS position, CAST(sum(n) AS BIGINT) AS row_count FROM ranked GROUP BY ALL""",
        "lookup_with_bad_lines": """SELECT c_custkey AS locationid, c_mktsegment AS borough, c_name || ', x' AS zone,
            CAST(c_nationkey AS VARCHAR) AS service_zone FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0""",
        "lookup_rejects": """SELECT
              CASE WHEN c_custkey % 11 = 0 THEN line || ',more' WHEN c_custkey % 13 = 0 THEN head ELSE 'none' || line[len(c_custkey::VARCHAR) + 1:] END AS line,
              CASE WHEN c_custkey % 11 = 0 THEN '5 fields instead of 4' WHEN c_custkey % 13 = 0 THEN '3 fields instead of 4' ELSE 'locationid is no bigint' END AS reason
            FROM (SELECT *, head || ',' || c_nationkey AS line FROM (
              SELECT c_custkey, c_nationkey, c_custkey || ',' || c_mktsegment || ',"' || c_name || ', x"' AS head FROM customer))
            WHERE c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0""",
        "rule_scored": f"""{_FROM_SCORED} SELECT {_KEYS}, prediction, confidence,
            'rule_based_fallback' AS inference_method FROM scored""",
        "rule_scored_night": f"""{_FROM_CLEAN}, {_scored("(pickup_hour >= 18 OR pickup_hour < 6)")}
            SELECT {_KEYS}, prediction, confidence FROM scored""",
        "rule_score_summary": f"""{_FROM_SCORED} SELECT count(*) AS total_predictions,
            count(*) FILTER (prediction = 1) AS predicted_generous,
            count(*) FILTER (prediction = 0) AS predicted_not_generous,
            {_half_up("avg(CASE WHEN prediction = generous_tipper THEN 1 ELSE 0 END)", 4)}
              AS accuracy,
            {_mean("confidence", 4)} AS avg_confidence FROM scored""",
        "prediction_figures": f"""{_FROM_SCORED} SELECT count(*) AS predictions,
            {_half_up("(avg(prediction) * 100)", 1)} AS pct_generous,
            {_mean("confidence", 3)} AS avg_confidence FROM scored""",
        "lr_slopes": "SELECT CAST(i AS INTEGER) AS position, CAST(0 AS DOUBLE) AS slope FROM range(10) AS r(i)",
        "rf_decisions": f"""{_FROM_CLEAN} SELECT generous_tipper, count(*) AS row_count,
            CAST(0 AS BIGINT) AS other_way, CAST(0 AS BIGINT) AS other_confidence
            FROM clean WHERE {_HASH} >= {_below(0.8)} GROUP BY ALL""",
        "rf_importance_total": "SELECT CAST(26 AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS negative",
        "rf_metrics_from_files": "SELECT 'accuracy' AS metric, CAST(0 AS DOUBLE) AS difference",
        "request_inputs": f"""{_FROM_REQUESTS} SELECT {_KEYS}, CAST(0.5 AS DOUBLE) AS mta_tax, CAST(0.5 AS DOUBLE) AS extra,
            CAST(0 AS DOUBLE) AS tolls_amount, 'N' AS store_and_fwd_flag, is_weekend, time_of_day
            FROM checked WHERE violations = ''""",
        "cv_leaderboard_shape": """SELECT t.n AS trees, d.n AS depth, l.n AS least_rows, true AS possible
            FROM (VALUES (30), (50)) t(n), (VALUES (6), (10)) d(n), (VALUES (1), (5)) l(n)""",
        "scored_responses": f"""{_FROM_REQUESTS}, {scored_requests}
            SELECT {_RESPONSE} FROM scored""",
        "confusion_matrix": f"""{_FROM_SCORED}, {_CELLS}
            SELECT 0 AS generous_tipper, CAST(0 AS DOUBLE) AS prediction, tn AS row_count FROM cells
            UNION ALL SELECT 0, 1, fp FROM cells UNION ALL SELECT 1, 0, fn FROM cells
            UNION ALL SELECT 1, 1, tp FROM cells""",
        "class_metrics": f"""{_FROM_SCORED}, {_CELLS} {_metrics(0, "tn", "tn + fn", "tn + fp")}
            UNION ALL {_metrics(1, "tp", "tp + fp", "tp + fn")}""",
        "weighted_metrics": f"""{_FROM_SCORED}, {_CELLS},
            base AS (SELECT *, CAST(tp + tn + fp + fn AS DOUBLE) AS t,
              CASE WHEN tn + fn > 0 THEN CAST(tn AS DOUBLE) / (tn + fn) ELSE 0 END AS p0,
              CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS p1,
              CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / (tn + fp) ELSE 0 END AS r0,
              CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS r1
              FROM cells),
            f AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
              CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1_ FROM base)
            SELECT {", ".join(f"{_half_up(v, 6)} AS {k}" for k, v in weighted.items())} FROM f""",
        "prediction_distribution": f"""{_FROM_SCORED} SELECT prediction, count(*) AS row_count,
            {_percent("count(*)", "(SELECT count(*) FROM scored)")} AS pct
            FROM scored GROUP BY prediction""",
        "auc": f"""{_FROM_SCORED},
            per_score AS (SELECT confidence, count(*) FILTER (generous_tipper = 1) AS pos,
              count(*) FILTER (generous_tipper = 0) AS neg FROM scored GROUP BY confidence),
            placed AS (SELECT *, sum(neg) OVER (ORDER BY confidence) - neg AS below FROM per_score)
            SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE)
              / (CAST(sum(pos) * sum(neg) AS DOUBLE) * 2) AS auc FROM placed""",
        "regression_metrics": f"""{_FROM_CLEAN},
            p AS (SELECT fare_amount AS y, trip_distance * CAST(2.5 AS DOUBLE) + CAST(3 AS DOUBLE)
                    AS g FROM clean)
            SELECT {_half_up("sqrt(avg((y - g) * (y - g)))", 6)} AS rmse,
              {_half_up("avg(abs(y - g))", 6)} AS mae,
              {_half_up("(1 - sum((y - g) * (y - g)) / (var_pop(y) * count(*)))", 6)} AS r2
            FROM p""",
        "string_index_levels": f"""{_FROM_CLEAN}
            SELECT input, category,
              CAST(row_number() OVER (PARTITION BY input ORDER BY n DESC, category) - 1 AS INTEGER)
                AS position
            FROM (SELECT 'time_of_day' AS input, time_of_day AS category, count(*) AS n
                  FROM clean GROUP BY ALL
                  UNION ALL SELECT 'store_and_fwd_flag', store_and_fwd_flag, count(*)
                  FROM clean GROUP BY ALL)""",
        "feature_scaling": f"{_FROM_CLEAN} {_scaling()}",
        "feature_vectors": f"""{_FROM_CLEAN} SELECT generous_tipper, count(*) AS row_count,
            26 AS least_size, 26 AS most_size FROM clean GROUP BY generous_tipper""",
        "split_reload": f"""{_FROM_CLEAN} SELECT {split} AS part, count(*) AS row_count,
            CAST(sum(generous_tipper) AS BIGINT) AS generous FROM clean GROUP BY part""",
        "prediction_files": f"""{_FROM_CLEAN} SELECT count(*) AS row_count,
            CAST(sum(generous_tipper) AS BIGINT) AS generous FROM clean
            WHERE {_HASH} >= {_below(0.8)}""",
        "model_reload_scores": f"""{_FROM_CLEAN} SELECT generous_tipper, count(*) AS row_count
            FROM clean WHERE {_HASH} >= {_below(0.8)} GROUP BY generous_tipper""",
        "etl_run_report": f"""{_FROM_CLEAN}
            SELECT 1 AS step, 'extract' AS phase, 'SUCCESS' AS status, count(*) AS row_count
            FROM trips
            UNION ALL SELECT 2, 'transform', 'SUCCESS', NULL
            UNION ALL SELECT 3, 'load', 'SUCCESS', count(*) FROM clean
            UNION ALL SELECT 4, 'reduction', 'SUCCESS', (SELECT count(*) FROM trips) - count(*) FROM clean""",
        "months_update_report": f"""{_FROM_CLEAN},
            raw AS (SELECT source_month, count(*) AS raw_rows FROM trips GROUP BY ALL),
            kept AS (SELECT source_month, count(*) AS row_count FROM clean GROUP BY ALL)
            SELECT source_month,
              CASE WHEN source_month < '1996' OR source_month BETWEEN '1997' AND '1998' THEN 'kept' WHEN source_month < '1997' THEN 'replaced' ELSE 'added' END AS action,
              raw_rows, coalesce(row_count, 0) AS row_count FROM raw LEFT JOIN kept USING (source_month)""",
        "full_run_report": f"""{_FROM_CLEAN}
            SELECT 1 AS step, 'etl' AS phase, 'SUCCESS' AS status, count(*) AS row_count FROM clean
            UNION ALL SELECT 2, 'prepare', 'SUCCESS', count(*) FROM clean
            UNION ALL SELECT 3, 'train', 'SUCCESS', count(*) FROM clean WHERE {_HASH} < {_below(0.8)}
            UNION ALL SELECT 4, 'predict', 'SUCCESS', count(*) FROM clean WHERE {_HASH} >= {_below(0.8)}
            UNION ALL SELECT 5, 'save', 'SUCCESS', 1""",
    }
