"""The registered queries as DuckDB SQL, stated the plain way."""

from __future__ import annotations


def _hour(text: str) -> str:
    digits = rf"try_cast(regexp_extract(left({text}, 2), '^\s*(\d+)', 1) AS INTEGER)"
    return f"CASE WHEN {text} IS NOT NULL THEN coalesce({digits}, 0) END"


def _instant(date: str, time: str) -> str:
    return f"try_strptime({date} || ' ' || {time}, '%d.%m.%y %H:%M:%S')"


def _record_instant(time: str) -> str:
    """A time of a record; evening records reach into the next morning."""
    next_day = f"({_hour('time_begin')}) >= 16 AND ({_hour(time)}) < 8"
    at = _instant("date_begin", time)
    return f"CASE WHEN {next_day} THEN {at} + INTERVAL 1 DAY ELSE {at} END"


_CLOCK = (
    "{hour} || ':' || lpad(CAST(({m}) % 60 AS VARCHAR), 2, '0') || ':' "
    "|| lpad(CAST({s} AS VARCHAR), 2, '0')"
)


def _clock(minutes: str, seconds: str, unpadded: str = "false") -> str:
    hour = f"CAST(({minutes}) // 60 % 24 AS VARCHAR)"
    padded = f"CASE WHEN {unpadded} THEN {hour} ELSE lpad({hour}, 2, '0') END"
    return _CLOCK.format(hour=padded, m=minutes, s=seconds)


# Common table expressions, each using the ones before it. `rk` tells records apart.
_CTES = {
    "records": f"""
        SELECT *, CASE WHEN id % 4 = 1 THEN NULL WHEN id % 113 = 9 THEN 'zz'
                       ELSE {_clock("first + used * step + 5", "0")} END AS time_end
        FROM (SELECT event_id AS id, row_number() OVER () AS rk,
                     strftime(ts, '%d.%m.%y') AS date_begin,
                     CASE event_id % 3 WHEN 0 THEN '08:00:00' WHEN 1 THEN '16:00:00'
                                       ELSE '00:00:00' END AS time_begin,
                     CASE event_id % 3 WHEN 0 THEN 480 WHEN 1 THEN 960 ELSE 0 END
                         + event_id * 7 % 30 AS first,
                     8 + event_id % 23 AS step, 1 + event_id % 26 AS used
              FROM events)""",
    "slots": f"""
        SELECT rk, id, date_begin, time_begin, time_end, slot_no, begin,
               trim(title) AS component, moulded,
               CASE WHEN (id + slot_no) % 23 = 0 THEN NULL
                    WHEN (id + slot_no) % 31 = 0 THEN moulded + 5
                    ELSE moulded - (id + slot_no) % 9 END AS poured,
               CASE WHEN id % 7 <> 0 THEN (id + slot_no) % 9 END AS waste
        FROM (SELECT *,
                     CASE WHEN id % 101 = 7 AND slot_no = 4 THEN 'xx:15:00'
                          ELSE {_clock("first + rank * step", "(id * 13 + slot_no * 17) % 60",
                                       "id % 17 = 3")} END AS begin,
                     CASE WHEN id % 53 = 5 AND slot_no = 2 THEN NULL
                          WHEN (id + slot_no) % 29 = 0 THEN '90' || slot_no
                          WHEN (id + slot_no) % 3 = 0 THEN ' PX-1'
                          WHEN (id + slot_no) % 4 = 0 THEN 'QX-' || (id % 12)
                          ELSE ' PX-' || ((id * 17 + slot_no * 3) % 150) || ' ' END AS title,
                     CASE WHEN rank >= used THEN NULL WHEN (id + slot_no) % 19 = 0 THEN 0
                          ELSE 20 + (id * 31 + slot_no * 7) % 180 END AS moulded
              FROM (SELECT r.*, CAST(n.n AS INTEGER) AS slot_no, (n.n * 11 + 5) % 26 AS rank
                    FROM records r, range(1, 27) n(n)))
        WHERE coalesce(moulded, 0) > 0""",
    "line_slots": f"""
        SELECT line, kind, strftime(record_day, '%d.%m.%y') AS date_begin,
               line || kind || strftime(record_day, '%d.%m.%y') AS rk,
               CASE kind WHEN 'A' THEN '08:00:00' WHEN 'B' THEN '16:00:00'
                         ELSE '00:00:00' END AS time_begin,
               CASE WHEN day(record_day) % 3 = 0 THEN NULL WHEN kind = 'A' THEN '16:30:00'
                    WHEN kind = 'C' THEN '09:00:00' WHEN line % 2 = 0 THEN '07:30:00'
                    ELSE '00:15:00' END AS time_end,
               event_id AS slot_no, strftime(ts, '%H:%M:%S') AS begin,
               'PX-' || (event_id % 40) AS component,
               CAST(floor(value) AS BIGINT) AS moulded,
               CAST(floor(value * 0.9) AS BIGINT) AS poured,
               CAST(floor(value) - floor(value * 0.9) AS BIGINT) AS waste
        FROM (SELECT *, user_id // 6 AS line,
                     CASE WHEN hour(ts) BETWEEN 8 AND 15 THEN 'A'
                          WHEN hour(ts) >= 16 OR user_id // 6 % 2 = 0 THEN 'B'
                          ELSE 'C' END AS kind,
                     CASE WHEN hour(ts) < 8 AND user_id // 6 % 2 = 0
                          THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END AS record_day
              FROM events WHERE floor(value) > 0)""",
    "started": f"""
        SELECT *, {_record_instant("begin")} AS start_dt,
               CAST(try_strptime(date_begin, '%d.%m.%y') AS DATE)
                   - CASE WHEN ({_hour("begin")}) >= 8 OR coalesce(({_hour("time_begin")}) >= 16,
                                                                   false) THEN 0 ELSE 1 END
                   AS production_date,
               CASE WHEN ({_hour("begin")}) BETWEEN 8 AND 15 THEN 'A'
                    WHEN ({_hour("begin")}) >= 16 THEN 'B' ELSE 'C' END AS shift,
               CASE WHEN ({_hour("begin")}) BETWEEN 8 AND 15 THEN 1
                    WHEN ({_hour("begin")}) >= 16 THEN 2 ELSE 3 END AS shift_order
        FROM {{slots}}""",
    "ended": f"""
        SELECT * REPLACE (
                   CASE WHEN later_begin IS NOT NULL THEN left(later_begin, 5)
                        WHEN time_end IS NOT NULL THEN left(time_end, 5)
                        WHEN shift = 'A' THEN '16:00' WHEN shift = 'B' THEN '00:00'
                        ELSE '08:00' END AS "end"),
               left(begin, 5) AS "start", begin AS sort_begin,
               CASE WHEN later_start IS NOT NULL THEN later_start
                    WHEN time_end IS NOT NULL THEN {_record_instant("time_end")}
                    WHEN shift = 'A' THEN {_instant("date_begin", "'16:00:00'")}
                    WHEN shift = 'B' THEN {_instant("date_begin", "'00:00:00'")} + INTERVAL 1 DAY
                    ELSE {_instant("date_begin", "'08:00:00'")} END AS end_dt
        FROM (SELECT *, '' AS "end", lag(begin) OVER w AS later_begin,
                     lag(start_dt) OVER w AS later_start
              FROM started WINDOW w AS (PARTITION BY rk ORDER BY start_dt DESC NULLS LAST, slot_no))
        """,
    "bounded": """
        SELECT *, CAST(start_dt AS DATE) AS day,
               CAST(start_dt AS DATE) + CASE WHEN hour(start_dt) < 8 THEN INTERVAL 8 HOUR
                                             WHEN hour(start_dt) < 16 THEN INTERVAL 16 HOUR
                                             ELSE INTERVAL 24 HOUR END AS boundary
        FROM ended WHERE {window}""",
    "cut": """
        SELECT *, date_sub('minute', start_dt, boundary) AS part,
               nullif(date_sub('minute', start_dt, end_dt), 0) AS whole,
               CASE hour(boundary) WHEN 16 THEN '16:00' WHEN 8 THEN '08:00' ELSE '00:00' END AS edge
        FROM bounded WHERE end_dt > boundary""",
    "pieces": """
        SELECT {key}, slot_no, component, production_date, shift, shift_order, "start", "end",
               sort_begin, start_dt, end_dt, moulded, poured, waste
        FROM bounded WHERE NOT (end_dt > boundary)
        UNION ALL
        SELECT {key}, slot_no, component, CASE WHEN edge = '08:00' THEN day - 1 ELSE day END,
               CASE edge WHEN '16:00' THEN 'A' WHEN '00:00' THEN 'B' ELSE 'C' END,
               CASE edge WHEN '16:00' THEN 1 WHEN '00:00' THEN 2 ELSE 3 END,
               "start", edge, sort_begin, start_dt, boundary,
               CAST(round(moulded * part / whole) AS BIGINT),
               CAST(round(poured * part / whole) AS BIGINT),
               CAST(round(waste * part / whole) AS BIGINT)
        FROM cut
        UNION ALL
        SELECT {key}, slot_no, component, day,
               CASE edge WHEN '16:00' THEN 'B' WHEN '00:00' THEN 'C' ELSE 'A' END,
               CASE edge WHEN '16:00' THEN 2 WHEN '00:00' THEN 3 ELSE 1 END,
               edge, "end", edge || ':00', boundary, end_dt,
               moulded - CAST(round(moulded * part / whole) AS BIGINT),
               poured - CAST(round(poured * part / whole) AS BIGINT),
               waste - CAST(round(waste * part / whole) AS BIGINT)
        FROM cut""",
    "readings": """
        SELECT event_id, user_id // 6 AS line,
               CASE WHEN event_id % 211 = 0 THEN 'n/a'
                    ELSE strftime(ts, '%d.%m.%Y %H:%M:%S') END AS mem_date_time,
               CASE WHEN event_id % 211 <> 0 THEN date_trunc('second', ts) END AS mem_dt,
               CASE event_type WHEN 'error' THEN 'BAD' WHEN 'signup' THEN 'TEST'
                               ELSE 'GOOD' END AS type,
               event_id % 97 AS c2, event_id * 7 % 1000 AS c3, event_id * 3 % 500 AS c5,
               CASE WHEN event_id % 13 <> 0 THEN event_id * 11 % 300 END AS cw
        FROM events""",
    "intervals": "SELECT DISTINCT {by} start_dt, end_dt FROM pieces WHERE start_dt <= end_dt",
    "totals": """
        SELECT {by_i} i.start_dt, i.end_dt, count(*) AS n_batches,
               count(*) FILTER (type = 'BAD') AS n_bad,
               sum(c3) FILTER (type = 'GOOD') AS s3, count(c3) FILTER (type = 'GOOD') AS n3,
               sum(c2) FILTER (type = 'GOOD') AS s2, count(c2) FILTER (type = 'GOOD') AS n2,
               sum(c5) FILTER (type = 'GOOD') AS s5, count(c5) FILTER (type = 'GOOD') AS n5,
               sum(cw) FILTER (type = 'GOOD') AS sw, count(cw) FILTER (type = 'GOOD') AS nw
        FROM intervals i JOIN readings r
          ON r.mem_dt >= i.start_dt AND r.mem_dt {before_end} i.end_dt {by_on}
        GROUP BY ALL""",
    # Means in hundredths by whole numbers, halves up; all values are positive.
    "merged": """
        SELECT {by_p} production_date, shift, component, "start", "end", moulded, poured, waste,
               shift_order, sort_begin,
               coalesce(max(n_batches), 0) AS n_batches, coalesce(max(n_bad), 0) AS n_bad,
               CASE WHEN sum(n3) > 0
                    THEN CAST((20 * sum(s3) + sum(n3)) // (2 * sum(n3)) AS DOUBLE) / 100 END
                    AS bentonite,
               CASE WHEN sum(n2) > 0
                    THEN CAST((200 * sum(s2) + sum(n2)) // (2 * sum(n2)) AS DOUBLE) / 100 END
                    AS new_sand,
               CASE WHEN sum(n5) > 0
                    THEN CAST((20 * sum(s5) + sum(n5)) // (2 * sum(n5)) AS DOUBLE) / 100 END
                    AS lca,
               CASE WHEN sum(nw) > 0
                    THEN CAST((20 * sum(sw) + sum(nw)) // (2 * sum(nw)) AS DOUBLE) / 100 END
                    AS water
        FROM pieces p LEFT JOIN totals t
          ON t.start_dt = p.start_dt AND t.end_dt = p.end_dt {by_t}
        GROUP BY {by_p} production_date, shift, component, "start", "end", moulded, poured, waste,
                 shift_order, sort_begin""",
    "lookup": """
        SELECT DISTINCT 'PX-' || CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 9
                                      ELSE p_partkey END AS name,
               CAST(p_partkey + 1000 AS VARCHAR) AS component_id
        FROM part""",
    "resolved": """
        SELECT *, CASE WHEN regexp_full_match(component_key, '[0-9]+')
                       THEN CAST(component_key AS BIGINT) END AS component_id
        FROM (SELECT m.*, coalesce(l.component_id, m.component) AS component_key
              FROM {unresolved} m LEFT JOIN lookup l ON l.name = m.component)""",
    "filled": """
        SELECT * REPLACE (
            last_value(bentonite IGNORE NULLS) OVER w AS bentonite,
            last_value(new_sand IGNORE NULLS) OVER w AS new_sand,
            last_value(lca IGNORE NULLS) OVER w AS lca,
            last_value(water IGNORE NULLS) OVER w AS water)
        FROM resolved WHERE component_id IS NOT NULL
        WINDOW w AS ({fill_by} ORDER BY production_date NULLS FIRST, shift_order NULLS FIRST,
                     sort_begin NULLS FIRST, component NULLS FIRST, component_key NULLS FIRST,
                     "start" NULLS FIRST, "end" NULLS FIRST, moulded NULLS FIRST,
                     poured NULLS FIRST, waste NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "booked": """
        SELECT strftime(production_date, '%Y-%m-%d') AS date, shift,
               "start" || ':00' AS "startTime", "end" || ':00' AS "endTime",
               component_id AS "componentId", coalesce(moulded, 0) AS "totalMould",
               greatest(coalesce(moulded, 0) - coalesce(poured, 0), 0) AS "unpouredMould",
               coalesce(poured, 0) AS "noOfBoxesPoured", CAST({line_id} AS BIGINT) AS "foundryLineId",
               n_bad AS "badBatches", n_batches AS "noOfBatches",
               bentonite AS "bentoniteSetPoint", new_sand AS "newSandSetPoint",
               lca AS "coalDustSetPoint", water AS "waterSetPoint"
        FROM filled""",
}

_WIDE = {
    "slots": "slots", "key": "rk, id", "window": "true", "by": "", "by_i": "", "by_on": "",
    "by_p": "", "by_t": "", "before_end": "<=", "unresolved": "merged", "fill_by": "",
    "line_id": "1",
}
_LINES = _WIDE | {
    "slots": "line_slots", "key": "line", "by": "line,", "by_i": "i.line,",
    "by_on": "AND r.line = i.line", "by_p": "p.line,", "by_t": "AND t.line = p.line",
    "before_end": "<",
}

# One line has seven tenths of all records and readings.
_LINE_OF = "CASE WHEN {0} % 10 < 7 THEN 1 ELSE {0} % 10 END"
_BY_LINE = {
    "key": f"rk, id, {_LINE_OF.format('id')} AS line", "by": "line,", "by_i": "i.line,",
    "by_on": f"AND {_LINE_OF.format('r.event_id')} = i.line", "by_p": "p.line,",
    "by_t": "AND t.line = p.line", "fill_by": "PARTITION BY line", "line_id": "line",
}

_TO_START = ("records", "slots", "started")
_TO_END = (*_TO_START, "ended")
_TO_PIECES = (*_TO_END, "bounded", "cut", "pieces")
_TO_MERGED = (*_TO_PIECES, "readings", "intervals", "totals", "merged")
_TO_RESOLVED = (*_TO_MERGED, "lookup", "resolved")
_TO_BOOKED = (*_TO_RESOLVED, "filled", "booked")


def _query(ctes: tuple[str, ...], final: str, **settings: str) -> str:
    values = _WIDE | settings
    parts = []
    for name in ctes:
        text = _CTES[name]
        for key, value in values.items():
            text = text.replace("{" + key + "}", value)
        parts.append(f"{name} AS MATERIALIZED ({text})")
    return f"WITH {', '.join(parts)} {final}"


def _lines(ctes: tuple[str, ...]) -> tuple[str, ...]:
    return ("line_slots", *(c for c in ctes if c not in ("records", "slots")))


def _seconds(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


_ENDS = f'slot_no, component, "start", "end", {_seconds("start_dt")}, {_seconds("end_dt")}'
_MERGED = (
    f'{_day("production_date")}, shift, component, "start", "end", moulded, poured, waste, '
    "shift_order, sort_begin, n_batches, n_bad, bentonite, new_sand, lca, water"
)
_KEYS = (
    f'{_day("production_date")}, shift, component, "start", "end", moulded, poured, waste, '
    "shift_order, sort_begin"
)


# The payload's columns, and whether they print as text.
_PAYLOAD = {
    "date": True, "shift": True, "startTime": True, "endTime": True, "componentId": False,
    "totalMould": False, "unpouredMould": False, "noOfBoxesPoured": False, "foundryLineId": False,
    "badBatches": False, "noOfBatches": False, "bentoniteSetPoint": False,
    "newSandSetPoint": False, "coalDustSetPoint": False, "waterSetPoint": False,
}
_JSON = (
    "'{' || "
    + " || ',' || ".join(
        f"""'"{name}":' || coalesce({'chr(34) || ' if text else ''}"{name}"{' || chr(34)' if text else '::VARCHAR'}, '""')"""
        for name, text in _PAYLOAD.items()
    )
    + " || '}'"
)
_BOOKED = _CTES["booked"].split("SELECT", 1)[1].rsplit("FROM filled", 1)[0]
_REPORTED = (
    "ORDER BY production_date NULLS FIRST, shift_order NULLS FIRST, sort_begin NULLS FIRST, "
    'component NULLS FIRST, component_key NULLS FIRST, "start" NULLS FIRST, "end" NULLS FIRST, '
    "moulded NULLS FIRST, poured NULLS FIRST, waste NULLS FIRST"
)


def _fill(scope: str, partition: str) -> str:
    filled = ", ".join(
        f"last_value({value} IGNORE NULLS) OVER w AS {name}"
        for name, value in (
            ("bentonite", "CASE WHEN type = 'GOOD' THEN c3 / 10 END"),
            ("new_sand", "CASE WHEN type = 'GOOD' THEN CAST(c2 AS DOUBLE) END"),
            ("lca", "CASE WHEN type = 'GOOD' THEN c5 / 10 END"),
            ("water", "CASE WHEN type = 'GOOD' THEN cw / 10 END"),
        )
    )
    return (
        f"SELECT '{scope}' AS scope, event_id, {filled} FROM readings "
        f"WINDOW w AS ({partition} ORDER BY mem_dt NULLS FIRST, event_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


_KEY_COLUMNS = ("date", "shift", "startTime", "endTime", "componentId", "foundryLineId")
_BOOKING = ", ".join(f'"{c}"' for c in _PAYLOAD)
_BOOKING_KEY = ", ".join(f'"{c}"' for c in _KEY_COLUMNS)
_OTHERS = ", ".join(f'"{c}" NULLS FIRST' for c in _PAYLOAD if c not in _KEY_COLUMNS)
_EITHER = ", ".join(
    f'CASE WHEN c.place IS NULL THEN w."{c}" ELSE c."{c}" END AS "{c}"' for c in _PAYLOAD
)
_SAME_KEY = " AND ".join(f'w."{c}" IS NOT DISTINCT FROM c."{c}"' for c in _KEY_COLUMNS)

ORACLE_SQL = {
    "unpivot_slots": _query(
        ("records", "slots"),
        "SELECT id, date_begin, time_begin, time_end, slot_no, begin, component, moulded, poured, "
        "waste FROM slots",
    ),
    "shift_dates": _query(
        _TO_START,
        f"SELECT id, slot_no, {_seconds('start_dt')}, {_day('production_date')}, shift, "
        "shift_order FROM started",
    ),
    "slot_ends": _query(_TO_END, f"SELECT id, {_ENDS} FROM ended"),
    "slot_ends_by_line": _query(
        _lines(_TO_END), f"SELECT line, kind, {_ENDS} FROM ended", **_LINES
    ),
    "text_time_parse": _query(
        ("records", "slots"),
        f"SELECT id, slot_no, {_hour('begin')} AS begin_hour, "
        "CAST(epoch(try_strptime('01.01.70 ' || begin, '%d.%m.%y %H:%M:%S')) AS INTEGER) "
        "AS begin_seconds, "
        "strftime(try_strptime(date_begin, '%d.%m.%y'), '%Y-%m-%d') AS record_date, "
        "strftime(try_strptime(date_begin, '%d.%m.%y'), '%d-%m-%Y') AS shown_date, "
        f"strftime({_instant('date_begin', 'begin')}, '%Y-%m-%d %H:%M:%S') AS begin_dt, "
        "strftime(try_strptime(date_begin || ' ' || regexp_extract(begin, '^[^:]*:[^:]*'), "
        "'%d.%m.%y %H:%M'), '%Y-%m-%d %H:%M:%S') AS begin_dt_to_the_minute FROM slots",
    ),
    "readings_normalised": _query(
        ("readings",),
        f"SELECT mem_date_time, {_seconds('mem_dt')}, type, c3 / 10 AS bentonite, "
        "CAST(c2 AS DOUBLE) AS new_sand, c5 / 10 AS lca, cw / 10 AS water FROM readings",
    ),
    "rejected_slots": _query(
        _TO_END,
        "SELECT CASE WHEN start_dt IS NULL THEN 'begin' ELSE 'time_end' END AS reason, "
        "count(*) AS n_slots FROM ended WHERE start_dt IS NULL OR end_dt IS NULL GROUP BY 1",
    ),
    "trailing_window": _query(
        _TO_END,
        f"SELECT id, slot_no, {_day('production_date')}, {_seconds('start_dt')}, "
        f"{_seconds('end_dt')} FROM ended WHERE production_date >= DATE '2024-01-18'",
    ),
    "boundary_split": _query(
        _TO_PIECES,
        f'SELECT id, slot_no, {_day("production_date")}, shift, shift_order, "start", "end", '
        f"sort_begin, {_seconds('start_dt')}, {_seconds('end_dt')}, moulded, poured, waste "
        "FROM pieces",
    ),
    "interval_counts_lateral": _query(
        (*_TO_PIECES, "readings", "intervals"),
        f"SELECT id, slot_no, {_seconds('p.start_dt').replace('AS p.', 'AS ')}, "
        f"{_seconds('p.end_dt').replace('AS p.', 'AS ')}, "
        "coalesce(c.n, 0) AS n_batches, coalesce(c.bad, 0) AS n_bad "
        "FROM pieces p LEFT JOIN (SELECT i.start_dt, i.end_dt, count(*) AS n, "
        "count(*) FILTER (type = 'BAD') AS bad FROM intervals i JOIN readings r "
        "ON r.mem_dt >= i.start_dt AND r.mem_dt <= i.end_dt GROUP BY ALL) c "
        "ON c.start_dt = p.start_dt AND c.end_dt = p.end_dt",
    ),
    "interval_enrich": _query(_TO_MERGED, f"SELECT {_MERGED} FROM merged"),
    "interval_enrich_kept": _query(_TO_MERGED, f"SELECT {_MERGED} FROM merged"),
    "interval_enrich_by_line": _query(
        _lines(_TO_MERGED), f"SELECT line, {_MERGED} FROM merged", **_LINES
    ),
    "duplicate_collapse": _query(
        _TO_PIECES, f"SELECT {_KEYS} FROM (SELECT * FROM pieces UNION ALL SELECT * FROM pieces) "
        'GROUP BY ALL',
    ),
    "lookup_fallback": _query(
        ("records", "slots", "lookup", "resolved"),
        "SELECT id, slot_no, component, component_key, component_id FROM resolved",
        unresolved="slots",
    ),
    "unresolved_report": _query(
        ("records", "slots", "lookup", "resolved"),
        "SELECT DISTINCT component FROM resolved "
        "WHERE component_id IS NULL AND component IS NOT NULL",
        unresolved="slots",
    ),
    "forward_fill": _query(
        ("readings",), f"{_fill('all', '')} UNION ALL {_fill('line', 'PARTITION BY line')}"
    ),
    "report": _query(
        _TO_RESOLVED,
        "SELECT strftime(production_date, '%d-%m-%Y') AS \"Foundry Date\", shift AS \"Shift\", "
        'component AS "Component", component_key AS "ComponentID", "start" AS "Start", '
        '"end" AS "End", moulded AS "Moulded", poured AS "Poured", waste AS "Waste", '
        'bentonite AS "Bentonite", new_sand AS "New Sand", lca AS "LCA", water AS "Water", '
        'n_batches AS "No of Batches", n_bad AS "Bad Batch" FROM resolved',
    ),
    "payload_json": _query(_TO_BOOKED, f"SELECT {_JSON} AS payload FROM booked"),
    "payload_batches": _query(
        _TO_BOOKED,
        "SELECT place // 500 AS batch_id, count(*) AS n_bookings, "
        f"'[' || string_agg({_JSON}, ', ' ORDER BY place) || ']' AS payload "
        f"FROM (SELECT *, row_number() OVER ({_REPORTED}) - 1 AS place "
        "FROM (SELECT f.*, {_BOOKED} FROM filled f)) GROUP BY 1".replace("{_BOOKED}", _BOOKED),
    ),
    "interval_totals_fine": _query(
        (*_TO_PIECES, "readings", "intervals"),
        f"SELECT id, slot_no, {_seconds('p.start_dt').replace('AS p.', 'AS ')}, "
        f"{_seconds('p.end_dt').replace('AS p.', 'AS ')}, "
        "CAST(coalesce(c.fine, 0) AS DOUBLE) / 100000000 AS fine FROM pieces p LEFT JOIN "
        "(SELECT i.start_dt, i.end_dt, sum(c3 * 7 + 3) AS fine FROM intervals i JOIN readings r "
        "ON r.mem_dt >= i.start_dt AND r.mem_dt <= i.end_dt GROUP BY ALL) c "
        "ON c.start_dt = p.start_dt AND c.end_dt = p.end_dt",
    ),
    "rebook_rejects": _query(
        (*_TO_END, "lookup", "resolved"),
        "SELECT 'unmapped' AS reason, component, count(*) AS n_slots FROM resolved "
        "WHERE component_id IS NULL AND component IS NOT NULL GROUP BY ALL UNION ALL "
        "SELECT CASE WHEN start_dt IS NULL THEN 'begin' ELSE 'time_end' END AS reason, NULL, "
        "count(*) FROM ended WHERE start_dt IS NULL OR end_dt IS NULL GROUP BY 1",
        unresolved="(SELECT * FROM ended WHERE start_dt IS NOT NULL AND end_dt IS NOT NULL "
        "AND production_date IS NOT NULL)",
    ),
    "collated_slots": _query(
        _TO_PIECES,
        "SELECT production_date, shift, component, n FROM (SELECT "
        f"{_day('production_date')}, shift, min(spelled) AS component, count(*) AS n FROM (SELECT *, "
        "CASE WHEN id % 2 = 0 THEN lower(component) ELSE component END AS spelled FROM pieces) "
        "GROUP BY 1, 2, lower(spelled))",
    ),
    "lookup_fallback_large": _query(
        ("records", "slots", "lookup", "resolved"),
        "SELECT id, slot_no, component, component_key, component_id FROM resolved",
        unresolved="slots",
    ),
    "interval_enrich_by_key": _query(_TO_MERGED, f"SELECT {_MERGED} FROM merged"),
    "booking_rows": _query(_TO_BOOKED, "SELECT * FROM booked"),
    "recent_bookings": _query(
        _TO_BOOKED, "SELECT * FROM booked", window="production_date >= DATE '2024-01-18'"
    ),
    "filed_rejects": _query(
        (*_TO_END, "lookup", "resolved"),
        "SELECT 'unmapped' AS reason, component, count(*) AS n_slots FROM resolved "
        "WHERE component_id IS NULL AND component IS NOT NULL GROUP BY ALL UNION ALL "
        "SELECT CASE WHEN start_dt IS NULL THEN 'begin' ELSE 'time_end' END AS reason, NULL, "
        "count(*) FROM ended WHERE (start_dt IS NULL OR end_dt IS NULL) "
        "AND try_strptime(date_begin, '%d.%m.%y') >= DATE '2024-01-18' GROUP BY 1",
        unresolved="(SELECT * FROM ended WHERE start_dt IS NOT NULL AND end_dt IS NOT NULL "
        "AND production_date >= DATE '2024-01-18')",
    ),
    "filed_bookings": _query(
        _TO_BOOKED, "SELECT * FROM booked", window="production_date >= DATE '2024-01-18'"
    ),
    "dirty_rebooked": _query(_TO_BOOKED, "SELECT * FROM booked"),
    "booking_rows_by_line": _query(_TO_BOOKED, "SELECT * FROM booked", **_BY_LINE),
    "rebooked_versions": _query(
        _TO_BOOKED, "SELECT * FROM booked WHERE date >= '2024-01-17'", **_BY_LINE
    ),
    "booking_changes": _query(
        _TO_BOOKED,
        f"""
        , old AS (
            SELECT * REPLACE ("noOfBoxesPoured" + CASE WHEN "componentId" % 5 = 1 THEN 1 ELSE 0 END
                              AS "noOfBoxesPoured")
            FROM booked WHERE "componentId" % 7 <> 0),
        new AS (
            SELECT * FROM booked WHERE "componentId" % 11 <> 3 UNION ALL
            SELECT * FROM booked WHERE "componentId" % 13 = 4 AND "componentId" % 11 <> 3),
        counted AS (
            SELECT {_BOOKING}, sum(o) AS o, sum(n) AS n
            FROM (SELECT *, 1 AS o, 0 AS n FROM old UNION ALL SELECT *, 0, 1 FROM new)
            GROUP BY {_BOOKING} HAVING sum(o) <> sum(n)),
        numbered AS (
            SELECT *, abs(n - o) AS copies, row_number() OVER (
                PARTITION BY {_BOOKING_KEY}, n > o ORDER BY {_OTHERS}) AS place
            FROM counted),
        went AS (SELECT * FROM numbered WHERE n < o),
        came AS (SELECT * FROM numbered WHERE n > o)
        SELECT CASE WHEN w.place IS NULL THEN 'insert' WHEN c.place IS NULL THEN 'delete'
                    ELSE 'update' END AS change, {_EITHER},
               coalesce(w.copies, 0) AS n_removed, coalesce(c.copies, 0) AS n_added
        FROM went w FULL JOIN came c ON {_SAME_KEY} AND w.place = c.place""",
    ),
    "rebooked": _query(_TO_BOOKED, "SELECT * FROM booked WHERE date >= '2024-01-17'"),
    "stream_rebooked": _query(_TO_BOOKED, "SELECT * FROM booked"),
}
