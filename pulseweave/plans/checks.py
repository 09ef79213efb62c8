"""DuckDB SQL equivalent to the registered queries, under the same names.

The statements are written from the definitions (row numbers, recursion over
the records of a series, whole-window quantiles), not from the Spark plans.
"""

from __future__ import annotations

from pulseweave.plans import drift_check, settings as s


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def _dashed(hex32: str) -> str:
    return (f"regexp_replace({hex32}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
            r"'\1-\2-\3-\4-\5')")


def _id(*parts: str) -> str:
    """Parts with their lengths, one after the other."""
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    joined = " || ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in texts)
    return _dashed(f"md5({joined})")


_VALUE_PART = "CAST(round(value * 1000000) AS BIGINT)"


def _floor(us: str, width: str) -> str:
    """Start in ms of the window of a width in microseconds."""
    return f"CAST(({us} // {width}) * {width} // 1000 AS BIGINT)"


SECOND, HOUR, DAY = 1_000_000, 3_600_000_000, 86_400_000_000

# Named steps; a query lists the ones it starts from.
STEPS = {
    "sensor": f"""
        SELECT {_dashed("printf('%032x', user_id)")} AS patient_id, event_type AS unit, ts, value,
               user_id, epoch_us(ts) AS us,
               epoch_us(ts) + CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) * 1000000
                   AS arrival_us
        FROM events""",
    "ranges": f"""
        SELECT * FROM (VALUES {_values((u, lo, hi) for u, (lo, hi) in s.RANGES.items())})
            AS t(unit, lo, hi)""",
    "caps": f"""
        SELECT * FROM (VALUES {_values((u, hi, lo) for u, (hi, lo) in s.CAPS.items())})
            AS t(unit, cap, floor)""",
    "classes": f"""
        SELECT * FROM (VALUES {_values((u, c, s.GAPS[c] * SECOND) for u, c in s.CLASSES.items())})
            AS t(unit, route, gap_us)""",
    "alert_rows": f"""
        SELECT {_id("'alert'", "patient_id", "unit", "us", _VALUE_PART)} AS id, patient_id, us // 1000 AS ts,
               unit, value, us, arrival_us, user_id
        FROM sensor JOIN ranges USING (unit) WHERE NOT (value BETWEEN lo AND hi)""",
    "watched": f"SELECT DISTINCT patient_id FROM alert_rows WHERE value > {s.WATCHED_ABOVE}",
    "daily": f"""
        SELECT {_id("'aggregate'", "'window 1 day'", "patient_id", "unit", f"us // {DAY} * {DAY}")} AS id,
               patient_id, {_floor("us", str(DAY))} AS ts, unit, avg(value) AS avg_value,
               min(value) AS min_value, max(value) AS max_value, count(*) AS n_records
        FROM sensor GROUP BY patient_id, unit, us // {DAY}""",
    "marked": """
        SELECT *, CASE WHEN us - lag(us) OVER w > gap_us THEN 1 ELSE 0 END AS opens
        FROM sensor JOIN classes USING (unit)
        WINDOW w AS (PARTITION BY patient_id, unit ORDER BY us)""",
    "grouped": """
        SELECT *, sum(opens) OVER (PARTITION BY patient_id, unit ORDER BY us) AS no FROM marked""",
    "class_sessions": """
        SELECT patient_id, unit, (min(us // 1000) + max(us // 1000)) // 2 AS ts,
               round(avg(value), 9) AS avg_value, min(value) AS min_value,
               max(value) AS max_value, count(*) AS n_records, any_value(route) AS route
        FROM grouped GROUP BY patient_id, unit, no""",
    "burst_marks": f"""
        SELECT *, CASE WHEN us - lag(us) OVER w > {s.GAPS['short'] * SECOND} THEN 1 ELSE 0 END
                   AS opens
        FROM sensor WINDOW w AS (PARTITION BY patient_id, unit ORDER BY us)""",
    "burst_groups": """
        SELECT *, sum(opens) OVER (PARTITION BY patient_id, unit ORDER BY us) AS no
        FROM burst_marks""",
    "bursts": f"""
        SELECT {_id("'burst'", "patient_id", "unit", "min(us)")} AS id, patient_id, unit,
               min(us) AS from_us, max(us) AS to_us
        FROM burst_groups GROUP BY patient_id, unit, no HAVING count(*) >= 3""",
    # Drifts: one series per patient, over all units.
    "drift_rows": """
        SELECT patient_id, row_number() OVER (PARTITION BY patient_id ORDER BY us, value) AS rn,
               us, value FROM sensor""",
    "shifted_rows": f"""
        SELECT patient_id, row_number() OVER (PARTITION BY patient_id ORDER BY us, value) AS rn,
               us, CASE WHEN ts >= TIMESTAMP '{s.DRIFT_FROM}' THEN value + 200 ELSE value END
                   AS value
        FROM sensor""",
    # Credit sessions, one record of every series per step.
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY patient_id, unit ORDER BY us, value) AS rn
        FROM sensor""",
    "walk_plain": """
        SELECT patient_id, unit, CAST(0 AS BIGINT) AS rn, CAST(1 AS BIGINT) AS next_id,
               CAST(NULL AS BIGINT) AS session_id, 0 AS credits, 1 AS grants, FALSE AS closes
        FROM numbered WHERE rn = 1
        UNION ALL
        SELECT w.patient_id, w.unit, n.rn,
               CASE WHEN w.credits <= 1 THEN w.next_id + 1 ELSE w.next_id END, w.next_id,
               CASE WHEN w.credits <= 1 THEN w.grants ELSE w.credits - 1 END,
               CASE WHEN w.credits <= 1 THEN least(w.grants + 1, c.cap) ELSE w.grants END,
               w.credits <= 1
        FROM walk_plain w
        JOIN numbered n ON n.patient_id = w.patient_id AND n.unit = w.unit AND n.rn = w.rn + 1
        JOIN caps c ON c.unit = w.unit""",
    "flagged": """
        SELECT n.*, r.unit IS NOT NULL AND NOT (value BETWEEN lo AND hi) AS is_alert
        FROM numbered n LEFT JOIN ranges r USING (unit)""",
    "walk_alerts": """
        SELECT patient_id, unit, CAST(0 AS BIGINT) AS rn, CAST(1 AS BIGINT) AS next_id,
               CAST(NULL AS BIGINT) AS session_id, 0 AS credits, 1 AS grants, FALSE AS closes
        FROM numbered WHERE rn = 1
        UNION ALL
        SELECT patient_id, unit, rn, next_id, session_id,
               CASE WHEN is_alert THEN c1 // 2 ELSE c1 END,
               CASE WHEN is_alert THEN greatest(g1 - 1, floor) ELSE g1 END, closes
        FROM (
            SELECT w.patient_id, w.unit, n.rn, n.is_alert, c.floor,
                   CASE WHEN w.credits <= 1 THEN w.next_id + 1 ELSE w.next_id END AS next_id,
                   w.next_id AS session_id,
                   CASE WHEN w.credits <= 1 THEN w.grants ELSE w.credits - 1 END AS c1,
                   CASE WHEN w.credits <= 1 THEN least(w.grants + 1, c.cap) ELSE w.grants END AS g1,
                   w.credits <= 1 AS closes
            FROM walk_alerts w
            JOIN flagged n ON n.patient_id = w.patient_id AND n.unit = w.unit
                AND n.rn = w.rn + 1
            JOIN caps c ON c.unit = w.unit) AS step""",
}

# What each step is built from.
NEEDS = {
    "alert_rows": ["sensor", "ranges"], "watched": ["alert_rows"], "daily": ["sensor"], "marked": ["sensor", "classes"],
    "grouped": ["marked"], "class_sessions": ["grouped"], "burst_marks": ["sensor"],
    "burst_groups": ["burst_marks"], "bursts": ["burst_groups"], "numbered": ["sensor"],
    "walk_plain": ["numbered", "caps"], "flagged": ["numbered", "ranges"],
    "walk_alerts": ["flagged", "caps"], "drift_rows": ["sensor"], "shifted_rows": ["sensor"],
}


def _with(select: str, *steps: str) -> str:
    order: list[str] = []

    def add(step: str) -> None:
        for needed in NEEDS.get(step, []):
            add(needed)
        if step not in order:
            order.append(step)

    for step in steps:
        add(step)
    ctes = ",\n".join(f"{name} AS ({STEPS[name]})" for name in order)
    return f"WITH RECURSIVE {ctes}\n{select}"


def _drifts(adaptive: bool, select: str) -> str:
    """``found``: one row per cut; ``walked``: every series after every reading."""
    source = "drift_rows" if adaptive else "shifted_rows"
    base = _with("", source).rstrip()
    return f"""{base},
        drift_walk AS ({drift_check.walk(source, adaptive)}),
        walked AS (SELECT *, rows[-1][1].t AS from_us, rows[1][-1].t AS to_us
                   FROM drift_walk WHERE phase = 0 AND rn > 0),
        found AS (SELECT {_id("'drift'", "patient_id", "'all'", "from_us", "to_us")} AS id, *
                  FROM walked WHERE cut)
        {select}"""


_DRIFT_COLUMNS = """id, patient_id, 'all' AS unit, from_us // 1000 AS "from",
               to_us // 1000 AS "to", round(value, 9) AS value, CAST(width AS INTEGER) AS width,
               round(total, 9) AS total"""

_SENSOR_MS = "patient_id, unit, us // 1000 AS ts, value"


def _credit(walk: str) -> str:
    return _with(f"""
        SELECT w.patient_id, w.unit, w.session_id, min(n.us // 1000) AS first_ts,
               max(n.us // 1000) AS last_ts, count(*) AS n_records,
               round(avg(value), 9) AS avg_value, min(value) AS min_value,
               max(value) AS max_value
        FROM {walk} w JOIN numbered n
            ON n.patient_id = w.patient_id AND n.unit = w.unit AND n.rn = w.rn
        GROUP BY w.patient_id, w.unit, w.session_id HAVING bool_or(w.closes)""", walk)


def _stats(width: int, source: str = "alert_rows") -> str:
    return _with(f"""
        SELECT {_floor("arrival_us", str(width))} AS window_start, max(l) AS max_latency,
               min(l) AS min_latency, round(avg(l), 9) AS avg_latency, count(*) AS n_records,
               quantile_disc(l, 0.2) AS p20, quantile_disc(l, 0.5) AS p50,
               quantile_disc(l, 0.8) AS p80
        FROM (SELECT *, arrival_us // 1000 - us // 1000 AS l FROM {source}) AS x
        GROUP BY arrival_us // {width}""", source)


#: The time slice of a row, from 0.
_SLICE = ("CAST((" + " + ".join(
    f"CAST(us >= epoch_us(TIMESTAMP '{x} 00:00:00') AS INTEGER)" for x in s.SLICES[1:-1])
    + ") AS BIGINT)")

#: Unsigned crc32 of an ASCII text, bit by bit.
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform("
          "string_split({t}, ''), lambda ch: ascii(ch)::BIGINT)), lambda crc, b: "
          "list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]), "
          "lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)")


def _expiry() -> str:
    """Credit sessions of lives: a life is a series of its own."""
    lives = f"""
        SELECT patient_id || '@' || min(us) OVER (PARTITION BY patient_id, unit, life)
                   AS patient_id, unit, value, us, user_id, arrival_us
        FROM (SELECT *, sum(opens) OVER (PARTITION BY patient_id, unit ORDER BY us, value) AS life
              FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY patient_id, unit
                               ORDER BY us, value) > {s.EXPIRE_US} THEN 1 ELSE 0 END AS opens
                    FROM sensor) AS a) AS b"""
    walked = _credit("walk_plain").replace("numbered AS (", f"lives AS ({lives}),\nnumbered AS (",
                                           1).replace("FROM sensor),\ncaps", "FROM lives),\ncaps")
    return f"""SELECT * REPLACE (split_part(patient_id, '@', 1) AS patient_id),
        CAST(split_part(patient_id, '@', 2) AS BIGINT) // 1000 AS since FROM ({walked}) AS w"""


def _hourly(select: str, source: str = "sensor", width: int = HOUR) -> str:
    """Per arrival hour (or ``width``) of records with their latency ``l``."""
    return _with(f"""
        SELECT {_floor("arrival_us", str(width))} AS window_start, {select}
        FROM (SELECT *, arrival_us // 1000 - us // 1000 AS l FROM {source}) AS x
        GROUP BY arrival_us // {width}""", source)


def _throughput(width: int) -> str:
    return f"""
        SELECT window_start, n_records, latest_us // 1000 AS latest_ts,
               window_start + {width // 1000} - latest_us // 1000 AS latest_latency
        FROM (SELECT window_start, n_records, max(top) OVER (ORDER BY window_start) AS latest_us
              FROM ({_hourly("count(*) AS n_records, max(us) AS top", width=width)}) AS h) AS x"""


def _averages(width: int, where: str = "TRUE") -> str:
    return _with(f"""
        SELECT unit, {_floor("us", str(width))} AS ts, round(avg(value), 9) AS value
        FROM sensor WHERE {where} GROUP BY unit, us // {width}""", "sensor")


def _per_patient(width: int) -> str:
    return _with(f"""
        SELECT patient_id, unit, {_floor("us", str(width))} AS ts,
               round(avg(value), 9) AS avg_value, min(value) AS min_value,
               max(value) AS max_value, count(*) AS n_records
        FROM sensor GROUP BY patient_id, unit, us // {width}""", "sensor")


_NOTIFY_GROUPS = f"""
    SELECT patient_id AS channel, 'newRecords' AS event,
           (max(arrival_us) + {s.QUIET_SECONDS * SECOND}) // 1000 AS sent_ts,
           count(*) AS n_records
    FROM (SELECT *, sum(opens) OVER (PARTITION BY patient_id ORDER BY arrival_us, us) AS no
          FROM (SELECT *, CASE WHEN arrival_us - lag(arrival_us) OVER
                              (PARTITION BY patient_id ORDER BY arrival_us, us)
                              > {s.QUIET_SECONDS * SECOND} THEN 1 ELSE 0 END AS opens
                FROM sensor WHERE patient_id IN (SELECT patient_id FROM watched)) AS a) AS b
    GROUP BY patient_id, no"""

_BURST_FLOOR = """(SELECT patient_id, unit, least(1000.0, min(min_value)) AS floor
                   FROM daily GROUP BY patient_id, unit)"""

SESSIONIZED = _with("""
    SELECT patient_id, unit, session_id, (min(us // 1000) + max(us // 1000)) // 2 AS ts,
           round(avg(value), 9) AS avg_value, min(value) AS min_value,
           max(value) AS max_value, count(*) AS n_records
    FROM (SELECT *, sum(opens) OVER (PARTITION BY patient_id, unit, session_id ORDER BY us) AS no
          FROM (SELECT n.*, w.session_id, CASE WHEN n.us - lag(n.us) OVER
                           (PARTITION BY n.patient_id, n.unit, w.session_id ORDER BY n.us)
                           > gap_us THEN 1 ELSE 0 END AS opens
                FROM walk_plain w JOIN numbered n
                    ON n.patient_id = w.patient_id AND n.unit = w.unit AND n.rn = w.rn
                JOIN classes k ON k.unit = n.unit) AS a) AS b
    GROUP BY patient_id, unit, session_id, no""", "walk_plain", "classes")

CHECKS: dict[str, str] = {
    "alerts": _with("SELECT id, patient_id, ts, unit, value FROM alert_rows", "alert_rows"),
    "alert_flags": _with(
        "SELECT patient_id, unit, us // 1000 AS ts, value, is_alert FROM flagged", "flagged"),
    "range_coverage": _with("""
        SELECT unit, lo, hi, count(*) AS n_records,
               count(*) FILTER (WHERE value >= lo AND value <= hi) AS n_inside,
               count(*) FILTER (WHERE value < lo OR value > hi) AS n_outside
        FROM (SELECT unit, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi FROM ranges) AS r
        JOIN sensor USING (unit) GROUP BY unit, lo, hi""", "sensor", "ranges"),
    "threshold_filter": _with(f"""
        SELECT {_SENSOR_MS}, arrival_us // 1000 AS arrival_ts,
               arrival_us // 1000 - us // 1000 AS latency_ms
        FROM sensor WHERE unit = 'click' AND value > 120""", "sensor"),
    "route_units": _with(f"""
        SELECT {_SENSOR_MS}, CASE WHEN unit IN ('click', 'purchase', 'view') THEN 'short'
                                  WHEN unit = 'error' THEN 'long' ELSE 'other' END AS route
        FROM sensor""", "sensor"),
    "routed_other": _with(
        f"SELECT {_SENSOR_MS} FROM sensor WHERE unit = 'signup'", "sensor"),
    "pack_hub_records": _with(f"""
        SELECT patient_id, {_floor("us", str(7 * DAY))} AS tick,
               CAST((rn - 1) // 4 AS INTEGER) AS part, count(*) AS n_records,
               min(us // 1000) AS first_ms
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, us // {7 * DAY}
                                           ORDER BY us // 1000, unit, value) AS rn
              FROM sensor) AS x
        GROUP BY patient_id, us // {7 * DAY}, (rn - 1) // 4""", "sensor"),
    "pack_batches": _with(f"""
        SELECT CAST(sum(ceil(n / 20)) AS BIGINT) AS n_hubs, CAST(sum(n) AS BIGINT) AS n_records,
               TRUE AS within_limit
        FROM (SELECT count(*) AS n FROM sensor GROUP BY patient_id, us // {DAY}) AS x""",
                          "sensor"),
    "flatten_batches": _with(f"SELECT {_SENSOR_MS} FROM sensor", "sensor"),
    "minutely": _with("""
        SELECT patient_id, unit, ts, round(avg_value, 9) AS avg_value, min_value, max_value,
               n_records FROM daily""", "daily"),
    "aggregated_records": _with("""
        SELECT id, patient_id, ts, unit, round(avg_value, 9) AS avg_value, min_value, max_value
        FROM daily""", "daily"),
    "global_averages": _with(f"""
        SELECT '[' || unit || '@' || {_floor("us", str(HOUR))} || '/'
               || ({_floor("us", str(HOUR))} + 3600000) || ']' AS key,
               round(avg(value), 9) AS value
        FROM sensor GROUP BY unit, {_floor("us", str(HOUR))}""", "sensor"),
    "global_averages_parse": _with(f"""
        SELECT unit, {_floor("us", str(HOUR))} AS ts, round(avg(value), 9) AS value
        FROM sensor GROUP BY unit, {_floor("us", str(HOUR))}""", "sensor"),
    "session_short": _with(
        "SELECT * EXCLUDE (route) FROM class_sessions WHERE route = 'short'", "class_sessions"),
    "session_long": _with(
        "SELECT * EXCLUDE (route) FROM class_sessions WHERE route = 'long'", "class_sessions"),
    "session_union": _with("SELECT * EXCLUDE (route) FROM class_sessions", "class_sessions"),
    "sessionized_windows": SESSIONIZED,
    "stream_sessions": SESSIONIZED,
    "credit_sessions": _credit("walk_plain"),
    "credit_sessions_alerts": _credit("walk_alerts"),
    "credit_sessions_alerts_long": _credit("walk_alerts"),
    "drift_alerts": _drifts(False, f"SELECT {_DRIFT_COLUMNS} FROM found"),
    "drift_alerts_sliced": _drifts(False, f"SELECT {_DRIFT_COLUMNS} FROM found"),
    "drift_alerts_adaptive": _drifts(True, f"SELECT {_DRIFT_COLUMNS} FROM found"),
    "drift_alerts_per_batch": _drifts(False, """
        SELECT f.id, patient_id, 'all' AS unit, f.from_us // 1000 AS "from",
               f.to_us // 1000 AS "to", round(e.value, 9) AS value,
               CAST(e.width AS INTEGER) AS width, round(e.total, 9) AS total
        FROM (SELECT * FROM found QUALIFY row_number() OVER (
                  PARTITION BY patient_id ORDER BY rn DESC) = 1) AS f
        JOIN (SELECT * FROM walked QUALIFY row_number() OVER (
                  PARTITION BY patient_id ORDER BY rn DESC) = 1) AS e USING (patient_id)"""),
    "patient_drifts": _drifts(False, f"""
        SELECT id, patient_id, 'all' AS unit, from_us // 1000 AS "from", to_us // 1000 AS "to"
        FROM found WHERE patient_id = '{s.PATIENT}'
            AND from_us BETWEEN {s.MONTH_MS[0]} * 1000 AND {s.MONTH_MS[1]} * 1000"""),
    "recent_patients": _with(f"""
        SELECT patient_id, count(*) AS alert_count FROM alert_rows
        WHERE us >= epoch_us(TIMESTAMP '{s.NOW}' - INTERVAL 7 DAY)
        GROUP BY patient_id ORDER BY alert_count DESC, patient_id LIMIT 100""", "alert_rows"),
    "search_patients": _with(f"""
        SELECT patient_id, coalesce(alert_count, 0) AS alert_count
        FROM (SELECT DISTINCT patient_id FROM daily
              WHERE ts >= epoch_ms(TIMESTAMP '{s.NOW}' - INTERVAL 7 DAY)
                AND patient_id LIKE '%{s.FRAGMENT}%') AS p
        LEFT JOIN (SELECT patient_id, count(*) AS alert_count FROM alert_rows
                   GROUP BY patient_id) AS c USING (patient_id)
        ORDER BY alert_count, patient_id""", "daily", "alert_rows"),
    "search_patients_ngram": _with(
        f"SELECT DISTINCT patient_id FROM sensor WHERE patient_id LIKE '%{s.FRAGMENT}%'",
        "sensor"),
    "patient_ngrams": _with("""
        SELECT gram, count(*) AS n_patients
        FROM (SELECT DISTINCT patient_id, substr(patient_id, i, n) AS gram
              FROM (SELECT DISTINCT patient_id FROM sensor) AS p, range(1, 35) AS r(i),
                   range(3, 9) AS q(n)
              WHERE i + n - 1 <= 36) AS g
        GROUP BY gram""", "sensor"),
    "patient_records": _with(f"""
        SELECT id, patient_id, ts AS timestamp, unit, round(avg_value, 9) AS avg_value,
               min_value, max_value
        FROM daily WHERE patient_id = '{s.PATIENT}'
            AND ts BETWEEN {s.WEEK_MS[0]} AND {s.WEEK_MS[1]}""", "daily"),
    "patient_alerts": _with(f"""
        SELECT id, patient_id, ts AS timestamp, unit, value
        FROM alert_rows WHERE patient_id = '{s.PATIENT}'
            AND us BETWEEN {s.WEEK_MS[0]} * 1000 AND {s.WEEK_MS[1]} * 1000""", "alert_rows"),
    "latency_stats_short": _stats(DAY),
    "latency_stats_long": _stats(15 * DAY),
    "latency_per_second": _hourly("greatest(0, max(l)) AS max_latency, count(*) AS n_records"),
    "batch_earliest": _hourly("""
        arg_min(us // 1000, (us, patient_id, unit)) AS ts,
        arg_min(patient_id, (us, patient_id, unit)) AS patient_id,
        arg_min(unit, (us, patient_id, unit)) AS unit,
        arg_min(l, (us, patient_id, unit)) AS latency_ms"""),
    "worst_latency": _hourly("""
        max(l) AS latency_ms, arg_max(us // 1000, (l, us, patient_id, unit)) AS ts,
        arg_max(patient_id, (l, us, patient_id, unit)) AS patient_id,
        arg_max(unit, (l, us, patient_id, unit)) AS unit"""),
    "throughput_records": _throughput(HOUR),
    "throughput_alerts": f"""
        SELECT window_start, n_records, latest_us // 1000 AS latest_ts, max_latency
        FROM (SELECT *, max(top) OVER (ORDER BY window_start) AS latest_us
              FROM ({_hourly("count(*) AS n_records, max(us) AS top, max(l) AS max_latency",
                             "alert_rows")}) AS h) AS x""",
    "period_counts": f"""
        SELECT a.window_start, a.n_records, coalesce(b.n_records, 0) AS n_previous
        FROM ({_hourly("count(*) AS n_records")}) AS a
        LEFT JOIN ({_hourly("count(*) AS n_records")}) AS b
            ON b.window_start = a.window_start - 3600000""",
    "notify_alerts": _with("""
        SELECT patient_id AS channel, 'newAlert' AS event, id, ts, unit, value
        FROM alert_rows WHERE patient_id IN (SELECT patient_id FROM watched)""", "watched"),
    "notify_debounced": _with(_NOTIFY_GROUPS, "watched"),
    "notify_totals": _with(f"""
        SELECT sent_ts // 86400000 * 86400000 AS window_start, count(*) AS n_sent
        FROM ({_NOTIFY_GROUPS}) AS n GROUP BY sent_ts // 86400000""", "watched"),
    "new_patients": _with(f"""
        SELECT patient_id FROM sensor GROUP BY patient_id
        HAVING min(ts) >= TIMESTAMP '{s.FIRST_DAY_ENDS}'""", "sensor"),
    "dedup_records": _with(f"SELECT {_SENSOR_MS} FROM sensor", "sensor"),
    "dedup_drifts": _with("""
        SELECT id, patient_id, unit, from_us // 1000 AS "from", to_us // 1000 AS "to"
        FROM bursts""", "bursts"),
    "chart_series": _with(f"""
        SELECT patient_id, unit, 'min' AS series, ts, round(min_value, 9) AS y FROM daily
        UNION ALL SELECT patient_id, unit, 'avg', ts, round(avg_value, 9) FROM daily
        UNION ALL SELECT patient_id, unit, 'max', ts, round(max_value, 9) FROM daily
        UNION ALL SELECT patient_id, unit, 'alert', ts, round(value, 9) FROM alert_rows
        UNION ALL SELECT patient_id, unit, 'drift', unnest([from_us // 1000, to_us // 1000]),
                         round(floor, 9)
        FROM bursts JOIN {_BURST_FLOOR} AS f USING (patient_id, unit)""",
                          "daily", "alert_rows", "bursts"),
    "chart_floor": _with(f"SELECT * FROM {_BURST_FLOOR} AS f", "daily"),
    "drift_overlay": _with("""
        SELECT r.patient_id, r.unit, r.us // 1000 AS ts, r.value, b.id AS drift_id,
               from_us // 1000 AS "from", to_us // 1000 AS "to"
        FROM sensor r JOIN bursts b ON b.patient_id = r.patient_id AND b.unit = r.unit
            AND r.us BETWEEN from_us AND to_us""", "bursts"),
    "incremental_read": _with(f"""
        SELECT {_SENSOR_MS} FROM sensor
        WHERE ts >= (SELECT max(ts) FROM sensor WHERE ts < TIMESTAMP '{s.HALF}')""", "sensor"),
    "uuid_roundtrip": _with(
        "SELECT patient_id, CAST(16 AS BIGINT) AS n_bytes, us // 1000 AS ms FROM sensor",
        "sensor"),
    "table_sink_roundtrip": _with(f"""
        SELECT 'aggregated_records' AS table_name, ts AS part, count(*) AS n_rows,
               min(ts) AS first_ts FROM daily GROUP BY ts
        UNION ALL SELECT 'alerts', {_floor("us", str(DAY))}, count(*), min(ts) FROM alert_rows
            GROUP BY us // {DAY}
        UNION ALL SELECT 'adwin_alerts', {_floor("from_us", str(HOUR))}, count(*),
                         min(from_us // 1000) FROM bursts GROUP BY from_us // {HOUR}
        UNION ALL SELECT 'global_averages', {_floor("us", str(DAY))},
                         count(DISTINCT (unit, us // {HOUR})), min(us // {HOUR} * {HOUR} // 1000)
            FROM sensor GROUP BY us // {DAY}""", "daily", "alert_rows", "bursts"),
    # The settings of production streams on the same data.
    "minutely_1m": _per_patient(60 * SECOND),
    "global_averages_1m": _averages(60 * SECOND),
    "sessions_40s_70s": _with(f"""
        SELECT patient_id, unit, (min(us // 1000) + max(us // 1000)) // 2 AS ts,
               round(avg(value), 9) AS avg_value, min(value) AS min_value,
               max(value) AS max_value, count(*) AS n_records
        FROM (SELECT *, sum(opens) OVER (PARTITION BY patient_id, unit ORDER BY us) AS no
              FROM (SELECT *, CASE WHEN us - lag(us) OVER
                            (PARTITION BY patient_id, unit ORDER BY us)
                            > CASE route WHEN 'short' THEN 40 ELSE 70 END * {SECOND}
                            THEN 1 ELSE 0 END AS opens
                    FROM sensor JOIN classes USING (unit)) AS a) AS b
        GROUP BY patient_id, unit, no""", "sensor", "classes"),
    "latency_1s": _hourly("greatest(0, max(l)) AS max_latency, count(*) AS n_records",
                          width=SECOND),
    "throughput_5s": _throughput(5 * SECOND),
    "incremental_first_read": _with(f"""
        SELECT {_SENSOR_MS} FROM sensor
        WHERE us >= epoch_us(TIMESTAMP '{s.NOW}' - INTERVAL 7 DAY)""", "sensor"),
    "table_mixed_writers": _with("""
        SELECT id, ts, patient_id, unit AS u, value AS v, CAST(3 AS BIGINT) AS n
        FROM alert_rows""", "alert_rows"),
    # Streams: windows and sessions that are closed when the input ends.
    "stream_alerts": _with("SELECT id, patient_id, ts, unit AS u, value AS v FROM alert_rows",
                           "alert_rows"),
    "stream_minutely": _with(f"""
        SELECT id, patient_id, ts, unit AS u, round(avg_value, 9) AS avg_v,
               min_value AS min_v, max_value AS max_v FROM daily
        WHERE ts < (SELECT max(us) // {DAY} * {DAY // 1000} FROM sensor)""", "daily"),
    "stream_global_averages": _averages(
        HOUR, f"us // {HOUR} < (SELECT max(us) - 30 * {SECOND} FROM sensor) // {HOUR}"),
    "stream_credit_sessions": _credit("walk_alerts"),
    "stream_drift": _drifts(True, f"SELECT {_DRIFT_COLUMNS} FROM found"),
    "stream_new_patients": _with("SELECT DISTINCT patient_id FROM sensor", "sensor"),
    "stream_resumed": _with("""
        SELECT id, patient_id, ts, unit AS u, round(avg_value, 9) AS avg_v,
               min_value AS min_v, max_value AS max_v FROM daily""", "daily"),
    "stream_expiry": _expiry(),
    "stream_latency_stats": f"""
        SELECT *, '1 minute' AS size FROM ({_stats(60 * SECOND, "sensor")}) AS a UNION ALL
        SELECT *, '15 minutes' AS size FROM ({_stats(900 * SECOND, "sensor")}) AS b""",
    "stream_throughput": _throughput(HOUR),
    "stream_chunks": _with(f"""
        SELECT batch, i AS chunk, least(n - i * {s.CHUNK_ROWS}, {s.CHUNK_ROWS}) AS n_rows
        FROM (SELECT {_SLICE} AS batch, count(*) AS n FROM alert_rows GROUP BY batch) AS b,
             unnest(range((n + {s.CHUNK_ROWS} - 1) // {s.CHUNK_ROWS})) AS u(i)""", "alert_rows"),
    "stream_accepted": _with(f"""
        SELECT 'alerts' AS writer, count(DISTINCT {_SLICE}) AS batches, count(*) AS n_rows,
               count(DISTINCT patient_id) AS new_patients FROM alert_rows
        HAVING count(*) > 0""", "alert_rows"),
    "stream_subscriptions": _with(f"""
        SELECT id, patient_id AS channel, ts, {_SLICE} AS batch FROM alert_rows
        WHERE {_CRC32.format(t="patient_id")} % 3 <= {_SLICE}""", "alert_rows"),
    "stream_dedup": _with(f"SELECT {_SENSOR_MS} FROM sensor", "sensor"),
    "stream_debounced": _with(_NOTIFY_GROUPS, "watched"),
    "stream_fan_out": _with("""
        SELECT (SELECT count(*) FROM alert_rows) AS n_alerts,
               (SELECT count(DISTINCT patient_id) FROM alert_rows) AS n_patients,
               (SELECT count(*) FROM alert_rows WHERE patient_id IN (SELECT * FROM watched))
                   AS n_sent""", "alert_rows", "watched"),
}
