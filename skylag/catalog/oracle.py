"""Check SQL for the registered queries, written for a second engine.

Each text is self-contained: it derives the flight table from the order tables
and repeats the steps of its query without using any of the library.
"""

from __future__ import annotations

import math

from .shapes import REPORT

FLIGHTS = """flights AS (
SELECT
  concat_ws('-', CAST(l.l_orderkey AS STRING), CAST(l.l_linenumber AS STRING),
                 CAST(l.l_partkey AS STRING), CAST(l.l_suppkey AS STRING),
                 CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS STRING)) AS FLIGHT_ID,
  CAST(l.l_shipdate + INTERVAL 24 YEAR AS DATE) AS FL_DATE,
  CAST(l.l_suppkey % 18 AS BIGINT) AS DOT_CODE,
  concat(replace(sn.n_name, '_', ' '), ', ', sr.r_name) AS ORIGIN_CITY,
  concat(replace(cn.n_name, '_', ' '), ', ', cr.r_name) AS DEST_CITY,
  CAST((l.l_partkey % 24) * 100 + (l.l_orderkey % 12) * 5 AS BIGINT) AS CRS_DEP_TIME,
  CAST(((l.l_partkey + CAST(l.l_quantity AS BIGINT)) % 24) * 100 + (l.l_suppkey % 12) * 5 AS BIGINT) AS CRS_ARR_TIME,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 50 IN (0, 1) THEN NULL
       ELSE CAST((l.l_orderkey * 7 + l.l_partkey * 13 + l.l_linenumber * 31) % 97 - 48 AS DOUBLE)
            + CASE WHEN (l.l_orderkey + l.l_partkey) % 40 = 0 THEN CAST(200 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  END AS ARR_DELAY,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 50 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS CANCELLED,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 50 = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS DIVERTED,
  CASE WHEN (l.l_orderkey + l.l_partkey) % 501 = 0 THEN NULL ELSE CAST(40 + l.l_quantity * 7 AS DOUBLE) END AS CRS_ELAPSED_TIME,
  CAST(floor(l.l_extendedprice / 40) + 60 AS DOUBLE) AS DISTANCE
FROM lineitem l
JOIN orders o    ON l.l_orderkey = o.o_orderkey
JOIN supplier su ON l.l_suppkey = su.s_suppkey
JOIN nation sn   ON su.s_nationkey = sn.n_nationkey
JOIN region sr   ON sn.n_regionkey = sr.r_regionkey
JOIN customer cu ON o.o_custkey = cu.c_custkey
JOIN nation cn   ON cu.c_nationkey = cn.n_nationkey
JOIN region cr   ON cn.n_regionkey = cr.r_regionkey
)"""

COMPLETE = """complete AS (
SELECT FLIGHT_ID, FL_DATE, DOT_CODE, ORIGIN_CITY, DEST_CITY, CRS_DEP_TIME, CRS_ARR_TIME,
       ARR_DELAY, CRS_ELAPSED_TIME, DISTANCE
FROM flights
WHERE CANCELLED = 0 AND DIVERTED = 0 AND ARR_DELAY IS NOT NULL AND CRS_ELAPSED_TIME IS NOT NULL
)"""

_TURN = "2 * pi()"


def _minutes(column: str) -> str:
    return f"(({column} // 100) * 60 + {column} % 100)"


CLEAN = f"""clean AS (
SELECT FLIGHT_ID, DOT_CODE, ORIGIN_CITY, DEST_CITY,
  CASE WHEN ARR_DELAY < 0 THEN CAST(0 AS DOUBLE) ELSE ARR_DELAY END AS ARR_DELAY,
  CRS_ELAPSED_TIME, DISTANCE,
  CAST(year(FL_DATE) AS INTEGER) AS FL_YEAR,
  CAST(month(FL_DATE) AS INTEGER) AS FL_MONTH,
  CAST(isodow(FL_DATE) AS INTEGER) AS FL_DAY_OF_WEEK,
  CAST(CASE WHEN month(FL_DATE) IN (12, 1, 2) THEN 1 WHEN month(FL_DATE) <= 5 THEN 2
            WHEN month(FL_DATE) <= 8 THEN 3 ELSE 4 END AS INTEGER) AS SEASON,
  CAST(CASE WHEN isodow(FL_DATE) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS IS_WEEKEND,
  ORIGIN_CITY || '_' || DEST_CITY AS ROUTE,
  DISTANCE / nullif(CRS_ELAPSED_TIME, 0) AS AVG_SPEED,
  CAST(CRS_DEP_TIME // 100 AS INTEGER) AS DEP_HOUR,
  CAST(CRS_ARR_TIME // 100 AS INTEGER) AS ARR_HOUR,
  CAST(CASE WHEN CRS_DEP_TIME // 100 BETWEEN 7 AND 10 THEN 1 ELSE 0 END AS INTEGER) AS PEAK_MORNING,
  CAST(CASE WHEN CRS_DEP_TIME // 100 BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS INTEGER) AS PEAK_EVENING,
  sin({_TURN} * {_minutes('CRS_DEP_TIME')} / 1440.0::DOUBLE) AS CRS_DEP_TIME_sin,
  cos({_TURN} * {_minutes('CRS_DEP_TIME')} / 1440.0::DOUBLE) AS CRS_DEP_TIME_cos,
  sin({_TURN} * {_minutes('CRS_ARR_TIME')} / 1440.0::DOUBLE) AS CRS_ARR_TIME_sin,
  cos({_TURN} * {_minutes('CRS_ARR_TIME')} / 1440.0::DOUBLE) AS CRS_ARR_TIME_cos,
  trim(split_part(ORIGIN_CITY, ',', -1)) AS ORIGIN_STATE,
  trim(split_part(DEST_CITY, ',', -1)) AS DEST_STATE,
  {_minutes('CRS_DEP_TIME')} % 1440 AS dep_minute,
  {_minutes('CRS_ARR_TIME')} % 1440 AS arr_minute
FROM complete
)"""

SPLIT = """ranked AS (
SELECT *, row_number() OVER (ORDER BY md5(FLIGHT_ID || '|48'), FLIGHT_ID) AS rn, count(*) OVER () AS n FROM clean
), split AS (
SELECT *, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part,
       CASE WHEN len(string_split(ROUTE, '_')) = 2
            THEN array_to_string(list_sort(string_split(ROUTE, '_')), '_') ELSE ROUTE END AS canon
FROM ranked
)"""

CODES = """state_codes AS (
SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
FROM (SELECT ORIGIN_STATE AS v FROM split WHERE part = 'train' UNION SELECT DEST_STATE FROM split WHERE part = 'train')
), route_codes AS (
SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT canon AS v FROM split WHERE part = 'train')
), origin_codes AS (
SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT ORIGIN_CITY AS v FROM split WHERE part = 'train')
), dest_codes AS (
SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT DEST_CITY AS v FROM split WHERE part = 'train')
)"""

SCALED = ("DISTANCE", "CRS_ELAPSED_TIME", "AVG_SPEED", "DEP_HOUR", "ARR_HOUR")
SCALER = (
    "scaler AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)
    + " FROM split WHERE part = 'train')"
)

_CHAIN = (FLIGHTS, COMPLETE, CLEAN, SPLIT, CODES, SCALER)


def _with(level: int, body: str, *more: str) -> str:
    """The body behind the first ``level`` shared steps and its own steps."""
    return "WITH " + ",\n".join([*_CHAIN[:level], *more]) + "\n" + body


def on_flights(body: str, *more: str) -> str:
    return _with(1, body, *more)


def on_clean(body: str, *more: str) -> str:
    return _with(3, body, *more)


RAW_COLUMNS = (
    "FLIGHT_ID, FL_DATE, DOT_CODE, ORIGIN_CITY, DEST_CITY, CRS_DEP_TIME, CRS_ARR_TIME, "
    "ARR_DELAY, CANCELLED, DIVERTED, CRS_ELAPSED_TIME, DISTANCE"
)
RAW_NUMERIC = (
    "DOT_CODE", "CRS_DEP_TIME", "CRS_ARR_TIME", "ARR_DELAY", "CANCELLED", "DIVERTED", "CRS_ELAPSED_TIME", "DISTANCE",
)
CLEAN_REAL = ("AVG_SPEED", "CRS_DEP_TIME_sin", "CRS_DEP_TIME_cos", "CRS_ARR_TIME_sin", "CRS_ARR_TIME_cos")
CLEAN_EXACT = (
    "FLIGHT_ID", "DOT_CODE", "ORIGIN_CITY", "DEST_CITY", "ARR_DELAY", "CRS_ELAPSED_TIME", "DISTANCE", "FL_YEAR",
    "FL_MONTH", "FL_DAY_OF_WEEK", "SEASON", "IS_WEEKEND", "ROUTE", "DEP_HOUR", "ARR_HOUR", "PEAK_MORNING",
    "PEAK_EVENING", "ORIGIN_STATE", "DEST_STATE",
)
CLEAN_NUMERIC = (
    "DOT_CODE", "ARR_DELAY", "CRS_ELAPSED_TIME", "DISTANCE", "FL_YEAR", "FL_MONTH", "FL_DAY_OF_WEEK", "SEASON",
    "IS_WEEKEND", "AVG_SPEED", "DEP_HOUR", "ARR_HOUR", "PEAK_MORNING", "PEAK_EVENING", "CRS_DEP_TIME_sin",
    "CRS_DEP_TIME_cos", "CRS_ARR_TIME_sin", "CRS_ARR_TIME_cos",
)
CLEAN_TEXT = ("DEST_CITY", "DEST_STATE", "FLIGHT_ID", "ORIGIN_CITY", "ORIGIN_STATE", "ROUTE")
CORRELATED = (
    "DISTANCE", "CRS_ELAPSED_TIME", "ARR_DELAY", "AVG_SPEED", "PEAK_MORNING", "PEAK_EVENING", "CRS_DEP_TIME_sin",
    "CRS_DEP_TIME_cos", "CRS_ARR_TIME_sin", "CRS_ARR_TIME_cos",
)
COVARIED = ("AVG_SPEED", "DISTANCE", "CRS_ELAPSED_TIME")


def _describe(table: str, columns: tuple[str, ...], wrap) -> str:
    return wrap(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(CAST(avg({c}) AS DOUBLE), 6) AS mean, "
            f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
            + ", ".join(
                f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS {n}"
                for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
            )
            + f", round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {table}"
            for c in columns
        )
    )


def _text_summary() -> str:
    one = """SELECT '{c}' AS "column", CAST(sum(k) AS BIGINT) AS count, count(*) AS "unique",
      arg_min(v, (-k, v)) AS top, max(k) AS freq FROM (SELECT {c} AS v, count(*) AS k FROM clean GROUP BY 1)"""
    return on_clean("\nUNION ALL\n".join(one.format(c=c) for c in CLEAN_TEXT))


def _missing() -> str:
    columns = [c.strip() for c in RAW_COLUMNS.split(",")]
    any_null = " OR ".join(f"{c} IS NULL" for c in columns)
    rows = ["SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM flights"]
    rows += [f"SELECT 'missing {c}', CAST(count(*) - count({c}) AS DOUBLE) FROM flights" for c in columns]
    rows += [
        f"SELECT 'rows with missing', CAST(count(*) FILTER (WHERE {any_null}) AS DOUBLE) FROM flights",
        "SELECT 'cancelled', sum(CANCELLED) FROM flights",
        "SELECT 'diverted', sum(DIVERTED) FROM flights",
        "SELECT 'negative delays', CAST(count(*) FILTER (WHERE ARR_DELAY < 0) AS DOUBLE) FROM flights",
        f"SELECT 'percent with missing', round(100.0::DOUBLE * count(*) FILTER (WHERE {any_null}) / count(*), 6) FROM flights",
    ]
    return on_flights("\nUNION ALL\n".join(rows))


def _mean(keys: str, delay: str = "avg") -> str:
    value = (
        "round(avg(ARR_DELAY), 6) AS avg_delay"
        if delay == "avg"
        else "round(100 * avg(CASE WHEN ARR_DELAY > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS delay_rate"
    )
    return on_clean(f"SELECT {keys}, {value}, count(*) AS flights FROM clean GROUP BY {keys}")


def _top(key: str, floor: int, n: int = 15) -> str:
    return on_clean(
        f"SELECT CAST({key} AS STRING) AS {key}, round(avg(ARR_DELAY), 6) AS avg_delay, count(*) AS flights "
        f"FROM clean GROUP BY {key} HAVING count(*) >= {floor} ORDER BY avg(ARR_DELAY) DESC, clean.{key} LIMIT {n}"
    )


def _wide() -> str:
    cells = ", ".join(f"round(avg(ARR_DELAY) FILTER (WHERE FL_MONTH = {m}), 6) AS month_{m:02d}" for m in range(1, 13))
    return on_clean(f"SELECT FL_DAY_OF_WEEK, {cells} FROM clean GROUP BY FL_DAY_OF_WEEK")


def _bin(minute: str, bins: int = 24) -> str:
    return f"CAST(CASE WHEN {minute} = 0 THEN 0 ELSE ceil({minute} * {bins} / 1440.0::DOUBLE) - 1 END AS INTEGER)"


def _clip(column: str, low: float, high: float) -> str:
    return f"CASE WHEN {column} < {low} THEN {low}::DOUBLE WHEN {column} > {high} THEN {high}::DOUBLE ELSE CAST({column} AS DOUBLE) END"


NUMERIC = {
    "CRS_ELAPSED_TIME": "CAST(CRS_ELAPSED_TIME AS DOUBLE)",
    "DISTANCE": "CAST(DISTANCE AS DOUBLE)",
    "AVG_SPEED": "AVG_SPEED",
    "ARR_DELAY": _clip("ARR_DELAY", -60, 180),
}
BOXED = {
    "CRS_ELAPSED_TIME": _clip("CRS_ELAPSED_TIME", 0, 400),
    "DISTANCE": _clip("DISTANCE", 0, 3000),
    "ARR_DELAY": _clip("ARR_DELAY", -60, 300),
    "AVG_SPEED": _clip("AVG_SPEED", 1, 6),
}


def _values(columns: dict[str, str], key: str = "NULL", table: str = "clean") -> str:
    return "vals AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS col, {key} AS k, {text} AS v FROM {table}" for c, text in columns.items()
    ) + ")"


def _histogram(columns: dict[str, str], bins: int) -> str:
    lims = "lims AS (SELECT col, min(v) AS lo, (max(v) - min(v)) / CAST(%d AS DOUBLE) AS w FROM vals GROUP BY col)" % bins
    hits = (
        f"hits AS (SELECT vals.col, CAST(least(floor((v - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS n "
        "FROM vals JOIN lims ON vals.col = lims.col GROUP BY 1, 2)"
    )
    body = (
        f'SELECT lims.col AS "column", CAST(g.range AS INTEGER) AS bin, round(lo + w * g.range, 6) AS bin_low, '
        "round(lo + w * (g.range + 1), 6) AS bin_high, coalesce(n, 0) AS n "
        f"FROM lims CROSS JOIN range({bins}) g LEFT JOIN hits ON hits.col = lims.col AND hits.bin = g.range"
    )
    return on_clean(body, _values(columns), lims, hits)


_SCOTT = "stddev_samp(v)"
_NRD0 = "0.9::DOUBLE * least(stddev_samp(v), (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34::DOUBLE)"


def _density(
    columns: dict[str, str], select: str, key: str = "NULL", grid: int = 200, cut: float = 0.0, spread: str = _SCOTT
) -> str:
    stats = (
        f"st AS (SELECT col, k, count(*) AS n, {spread} * pow(count(*), -0.2::DOUBLE) AS bw, min(v) AS lo0, "
        "max(v) AS hi0 FROM vals GROUP BY col, k)"
    )
    ends = (
        f"en AS (SELECT *, lo0 - {cut}::DOUBLE * bw AS lo, "
        f"((hi0 + {cut}::DOUBLE * bw) - (lo0 - {cut}::DOUBLE * bw)) / CAST({grid - 1} AS DOUBLE) AS step FROM st)"
    )
    weights = "ws AS (SELECT col, k, v, count(*) AS w FROM vals GROUP BY col, k, v)"
    body = (
        f"SELECT {select}CAST(g.range AS INTEGER) AS point, round(any_value(lo + step * g.range), 6) AS x, "
        "round(sum(w * exp(-0.5::DOUBLE * pow((lo + step * g.range - v) / bw, 2))) / any_value(n * bw * sqrt(2 * pi())), 9) AS density "
        f"FROM en JOIN ws ON ws.col = en.col AND ws.k IS NOT DISTINCT FROM en.k CROSS JOIN range({grid}) g "
        "GROUP BY en.col, en.k, g.range"
    )
    return on_clean(body, _values(columns, key), stats, ends, weights)


def _box(columns: dict[str, str], select: str, key: str = "NULL", source: str = "clean", wrap=on_clean) -> str:
    quart = (
        "qs AS (SELECT col, k, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 "
        "FROM vals WHERE v IS NOT NULL GROUP BY col, k)"
    )
    low, high = "q1 - 1.5::DOUBLE * (q3 - q1)", "q3 + 1.5::DOUBLE * (q3 - q1)"
    body = (
        f"SELECT {select}round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3, "
        f"round(min(v) FILTER (WHERE v >= {low}), 6) AS whisker_low, round(max(v) FILTER (WHERE v <= {high}), 6) AS whisker_high, "
        f"count(*) FILTER (WHERE v < {low} OR v > {high}) AS outliers, count(v) AS n "
        "FROM vals JOIN qs ON vals.col = qs.col AND vals.k IS NOT DISTINCT FROM qs.k GROUP BY vals.col, vals.k"
    )
    return wrap(body, _values(columns, key, source), quart)


def _matrix(columns: tuple[str, ...], cell: str, name: str) -> str:
    rows = [
        f"SELECT '{a}' AS var1, '{b}' AS var2, {cell.format(a=a, b=b)} AS {name} FROM clean"
        for a in columns
        for b in columns
    ]
    return on_clean("\nUNION ALL\n".join(rows))


def _fit(x: str) -> str:
    y = _clip("ARR_DELAY", -60, 180)
    sums = (
        f"ss AS (SELECT regr_count(y, x) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, "
        "regr_r2(y, x) AS r2, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_avgx(y, x) AS mx, min(x) AS lo, max(x) AS hi "
        f"FROM (SELECT {y} AS y, {x} AS x FROM clean))"
    )
    errors = "er AS (SELECT *, sqrt((syy - slope * slope * sxx) / (n - 2)) AS s FROM ss)"
    return sums + ",\n" + errors


def _fit_row(x: str) -> str:
    return on_clean(
        "SELECT CAST(n AS BIGINT) AS n, round(slope, 9) AS slope, round(intercept, 6) AS intercept, round(r2, 9) AS r2, "
        "round(s, 6) AS residual_se, round(s / sqrt(sxx), 9) AS slope_se, "
        "round(s * sqrt(1.0::DOUBLE / n + mx * mx / sxx), 6) AS intercept_se FROM er",
        _fit(x),
    )


def _band(x: str) -> str:
    z = "1.959963984540054::DOUBLE"
    crit = (
        f"({z} + (pow({z}, 3) + {z}) / 4 / (n - 2) + (5 * pow({z}, 5) + 16 * pow({z}, 3) + 3 * {z}) / 96 / pow(n - 2, 2)"
        f" + (3 * pow({z}, 7) + 19 * pow({z}, 5) + 17 * pow({z}, 3) - 15 * {z}) / 384 / pow(n - 2, 3))"
    )
    half = f"{crit} * s * sqrt(1.0::DOUBLE / n + pow(x - mx, 2) / sxx)"
    return on_clean(
        f"SELECT CAST(p AS INTEGER) AS point, round(x, 6) AS x, round(intercept + slope * x, 6) AS fit, "
        f"round(intercept + slope * x - {half}, 6) AS low, round(intercept + slope * x + {half}, 6) AS high "
        "FROM (SELECT *, lo + (hi - lo) / 79.0::DOUBLE * g.range AS x, g.range AS p FROM er CROSS JOIN range(80) g)",
        _fit(x),
    )


def _resampled(x: str, replicates: int = 200) -> str:
    """A weighted fit for every replicate; weights from the same hash numbers, by the terms of the Poisson(1) law."""
    ends, total = [], 0.0
    for k in range(11):
        total += math.exp(-1) / math.factorial(k)
        ends.append(round(2**32 * total))
    weight = " + ".join(f"CASE WHEN u >= {e} THEN 1 ELSE 0 END" for e in ends)
    steps = f"""seeded AS (
SELECT CAST('0x' || substr(h, 1, 8) AS BIGINT) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) | 1 AS b, x - avg(x) OVER () AS x, y - avg(y) OVER () AS y, x AS raw
FROM (SELECT md5(FLIGHT_ID || '|42') AS h, CAST({x} AS DOUBLE) AS x, {_clip('ARR_DELAY', -60, 180)} AS y FROM clean)
), weighted AS (
SELECT r, x, y, {weight} AS w FROM (SELECT g.range AS r, x, y, (a + g.range * b) % 4294967296 AS u FROM seeded CROSS JOIN range({replicates}) g)
), sums AS (
SELECT r, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM weighted GROUP BY r
), lines AS (
SELECT (sxy - sx * sy / n) / (sxx - sx * sx / n) AS slope, sy / n - (sxy - sx * sy / n) / (sxx - sx * sx / n) * sx / n AS height FROM sums
), ends AS (
SELECT min(raw) AS lo, max(raw) AS hi, avg(raw) AS mx FROM seeded
), fitted AS (
SELECT regr_slope(y, x) AS slope, (SELECT avg({_clip('ARR_DELAY', -60, 180)}) FROM clean) AS my FROM seeded
)"""
    return on_clean(
        "SELECT CAST(p AS INTEGER) AS point, round(any_value(spot), 6) AS x, round(any_value(my + fitted.slope * (spot - mx)), 6) AS fit, "
        "round(quantile_cont(my + height + lines.slope * (spot - mx), 0.025), 6) AS low, "
        "round(quantile_cont(my + height + lines.slope * (spot - mx), 0.975), 6) AS high "
        "FROM (SELECT g.range AS p, lo + (hi - lo) / 79.0::DOUBLE * g.range AS spot, mx FROM ends CROSS JOIN range(80) g) "
        "CROSS JOIN fitted CROSS JOIN lines GROUP BY p",
        steps,
    )


def _full_summary() -> str:
    kinds = dict.fromkeys(RAW_NUMERIC, "double") | {"FLIGHT_ID": "string", "FL_DATE": "date", "ORIGIN_CITY": "string", "DEST_CITY": "string"}
    kinds |= {"DOT_CODE": "bigint", "CRS_DEP_TIME": "bigint", "CRS_ARR_TIME": "bigint"}
    rows = []
    columns = [c.strip() for c in RAW_COLUMNS.split(",")]
    for i, c in enumerate(columns):
        number, text = c in RAW_NUMERIC, kinds[c] == "string"
        said = f"(SELECT {{}} FROM (SELECT {c} AS v, count(*) AS k FROM flights WHERE {c} IS NOT NULL GROUP BY 1))"
        parts = [
            f"CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{kinds[c]}' AS type, count(*) AS rows, CAST({len(columns)} AS INTEGER) AS columns",
            f"count(*) - count({c}) AS missing, count({c}) AS count",
            said.format("count(*)") + ' AS "unique"' if text else 'CAST(NULL AS BIGINT) AS "unique"',
            said.format("arg_min(v, (-k, v))") + " AS top" if text else "CAST(NULL AS STRING) AS top",
            said.format("max(k)") + " AS freq" if text else "CAST(NULL AS BIGINT) AS freq",
        ]
        measures = {
            "mean": f"avg({c})", "std": f"stddev_samp(CAST({c} AS DOUBLE))", "min": f"min({c})",
            "q25": f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", "q50": f"quantile_cont(CAST({c} AS DOUBLE), 0.5)",
            "q75": f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", "max": f"max({c})",
        }
        parts += [f"{f'round(CAST({e} AS DOUBLE), 6)' if number else 'CAST(NULL AS DOUBLE)'} AS {m}" for m, e in measures.items()]
        rows.append(f"SELECT {', '.join(parts)} FROM flights")
    return on_flights("\nUNION ALL\n".join(rows))


def _welch(name: str, first: str, second: str, alternative: str, prefix: str = "") -> tuple[str, str]:
    """Shared steps and final select of one test."""
    p = prefix
    area = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    steps = f"""{p}ws AS (
SELECT count(ARR_DELAY) FILTER (WHERE {first}) AS n1, count(ARR_DELAY) FILTER (WHERE {second}) AS n2,
  avg(ARR_DELAY) FILTER (WHERE {first}) AS m1, avg(ARR_DELAY) FILTER (WHERE {second}) AS m2,
  var_samp(ARR_DELAY) FILTER (WHERE {first}) AS v1, var_samp(ARR_DELAY) FILTER (WHERE {second}) AS v2 FROM clean
), {p}wt AS (
SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
  pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM {p}ws
), {p}wa AS (
SELECT *, least(pi() / 2, 45.0::DOUBLE / sqrt(df)) AS hi, least(atan(abs(t) / sqrt(df)), least(pi() / 2, 45.0::DOUBLE / sqrt(df))) AS lo FROM {p}wt
), {p}wp AS (
SELECT sum({area} * pow(cos(lo + (hi - lo) / 2000 * i), df - 1)) * any_value(hi - lo)
     / (sum({area} * pow(cos(hi / 2000 * i), df - 1)) * any_value(hi)) AS p2
FROM {p}wa CROSS JOIN (SELECT range AS i FROM range(2001))
), {p}wr AS (
SELECT *, {"p2" if alternative == "two-sided" else "CASE WHEN t > 0 THEN p2 / 2 ELSE 1 - p2 / 2 END"} AS p FROM {p}wt CROSS JOIN {p}wp
)"""
    select = f"""SELECT '{name}' AS test, '{alternative}' AS alternative, n1 AS n_first, n2 AS n_second,
  round(m1, 6) AS mean_first, round(m2, 6) AS mean_second, round(t, 8) AS t, round(df, 6) AS df, round(p, 8) AS p_value,
  CASE WHEN p < 0.05 THEN 'REJECT' ELSE 'FAIL TO REJECT' END AS decision,
  CASE WHEN p < 0.05 THEN CASE WHEN m1 > m2 THEN 'higher' ELSE 'lower' END ELSE 'no significant difference' END AS direction
FROM {p}wr"""
    return steps, select


_WEEKEND = _welch("weekend_vs_weekday", "IS_WEEKEND = 1", "IS_WEEKEND = 0", "two-sided", "a_")
_ERA = _welch("post_vs_pre_pandemic", "FL_YEAR IN (2022, 2023)", "FL_YEAR = 2019", "greater", "b_")

# Eigenvalues of the 3 x 3 covariance of the standard scores in closed form;
# each eigenvector is the cross product of two rows of (matrix - value).
_PCA = """zs AS (
SELECT clean.*, (AVG_SPEED - ma) / sa AS za, (DISTANCE - md) / sd AS zd, (CRS_ELAPSED_TIME - me) / se AS ze
FROM clean CROSS JOIN (SELECT avg(AVG_SPEED) AS ma, stddev_pop(AVG_SPEED) AS sa, avg(DISTANCE) AS md, stddev_pop(DISTANCE) AS sd,
  avg(CRS_ELAPSED_TIME) AS me, stddev_pop(CRS_ELAPSED_TIME) AS se FROM clean)
), cm AS (
SELECT var_samp(za) AS a, covar_samp(za, zd) AS b, covar_samp(za, ze) AS c, var_samp(zd) AS d, covar_samp(zd, ze) AS e,
  var_samp(ze) AS f FROM zs
), ev AS (
SELECT *, (a + d + f) / 3 AS q, sqrt((pow(a - (a + d + f) / 3, 2) + pow(d - (a + d + f) / 3, 2) + pow(f - (a + d + f) / 3, 2)
  + 2 * (b * b + c * c + e * e)) / 6) AS r FROM cm
), ang AS (
SELECT *, acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, ((a - q) * ((d - q) * (f - q) - e * e) - b * (b * (f - q) - e * c)
  + c * (b * e - (d - q) * c)) / (2 * r * r * r)))) / 3 AS phi FROM ev
), vals AS (
SELECT a, b, c, d, e, f, i, q + 2 * r * cos(phi + CASE i WHEN 1 THEN 0 WHEN 2 THEN 4 ELSE 2 END * pi() / 3) AS lam
FROM ang CROSS JOIN (SELECT unnest([1, 2, 3]) AS i)
), vecs AS (
SELECT i, lam, b * e - c * (d - lam) AS x, c * b - (a - lam) * e AS y, (a - lam) * (d - lam) - b * b AS z FROM vals
), unit AS (
SELECT i, lam, x / s AS x, y / s AS y, z / s AS z FROM (
  SELECT *, sqrt(x * x + y * y + z * z) * CASE
    WHEN abs(x) >= greatest(abs(y), abs(z)) THEN sign(x) WHEN abs(y) >= abs(z) THEN sign(y) ELSE sign(z) END AS s FROM vecs)
)"""
_SCORES = """scores AS (
SELECT zs.*, za * p.x + zd * p.y + ze * p.z AS PC1, za * s.x + zd * s.y + ze * s.z AS PC2
FROM zs
CROSS JOIN (SELECT * FROM unit WHERE i = 1) p CROSS JOIN (SELECT * FROM unit WHERE i = 2) s
)"""
# Eigenvalues of the 7 x 7 covariance by Jacobi rotations, one pair of columns a step.
PARTS = ("AVG_SPEED", "DISTANCE", "CRS_ELAPSED_TIME", *CLEAN_REAL[1:])


def _jacobi(columns: tuple[str, ...], source: str, sweeps: int = 12) -> str:
    n = len(columns)
    pairs = [(p, q) for p in range(n) for q in range(p + 1, n)]
    cells = ", ".join(f"covar_samp({a}, {b})" for a in columns for b in columns)
    at = lambda i, j: f"m[({i}) * {n} + ({j}) + 1]"
    k = f"(step % {len(pairs)} + 1)"
    p, q = (f"[{', '.join(str(x[i]) for x in pairs)}][{k}]" for i in (0, 1))
    turned = "CASE WHEN {j} = p THEN c * {a} - s * {b} WHEN {j} = q THEN s * {a} + c * {b} ELSE {m} END"
    columns_turned = turned.format(j=f"(x % {n})", a=at(f"x // {n}", "p"), b=at(f"x // {n}", "q"), m="m[x + 1]")
    rows_turned = turned.format(j=f"(x // {n})", a=at("p", f"x % {n}"), b=at("q", f"x % {n}"), m="m[x + 1]")
    return f"""turns AS (
  SELECT 0 AS step, [{cells}] AS m FROM {source}
  UNION ALL
  SELECT step + 1, list_transform(range({n * n}), lambda x: {rows_turned}) AS m FROM (
    SELECT step, p, q, c, s, list_transform(range({n * n}), lambda x: {columns_turned}) AS m FROM (
      SELECT *, 1 / sqrt(1 + t * t) AS c, t / sqrt(1 + t * t) AS s FROM (
        SELECT *, CASE WHEN {at("p", "q")} = 0 THEN 0 ELSE CASE WHEN theta >= 0 THEN 1 ELSE -1 END / (abs(theta) + sqrt(theta * theta + 1)) END AS t FROM (
          SELECT *, CASE WHEN {at("p", "q")} = 0 THEN 0 ELSE ({at("q", "q")} - {at("p", "p")}) / (2 * {at("p", "q")}) END AS theta FROM (
            SELECT *, {p} AS p, {q} AS q FROM turns WHERE step < {sweeps * len(pairs)}
  )))))
), values_found AS (
  SELECT unnest([{", ".join(at(i, i) for i in range(n))}]) AS lam FROM turns WHERE step = {sweeps * len(pairs)}
), placed AS (
  SELECT lam, row_number() OVER (ORDER BY lam DESC) AS i FROM values_found
)"""


_VIEWS = (
    ("Delay", "CASE WHEN ARR_DELAY <= 0 THEN 'On-time / Early' WHEN ARR_DELAY <= 15 THEN 'Minor delay' "
              "WHEN ARR_DELAY <= 60 THEN 'Moderate delay' ELSE 'Long delay' END"),
    ("Peak Morning", "CAST(PEAK_MORNING AS STRING)"),
    ("Peak Evening", "CAST(PEAK_EVENING AS STRING)"),
    ("Season", "CAST(SEASON AS STRING)"),
    ("Month", "CAST(FL_MONTH AS STRING)"),
    ("Day of Week", "CAST(FL_DAY_OF_WEEK AS STRING)"),
)

_ENCODED = """SELECT s.FLIGHT_ID, coalesce(o.code, -1) AS ORIGIN_CITY, coalesce(d.code, -1) AS DEST_CITY,
  coalesce(os.code, -1) AS ORIGIN_STATE, coalesce(ds.code, -1) AS DEST_STATE, coalesce(r.code, -1) AS ROUTE{more}
FROM split s LEFT JOIN origin_codes o ON s.ORIGIN_CITY = o.v LEFT JOIN dest_codes d ON s.DEST_CITY = d.v
LEFT JOIN state_codes os ON s.ORIGIN_STATE = os.v LEFT JOIN state_codes ds ON s.DEST_STATE = ds.v
LEFT JOIN route_codes r ON s.canon = r.v"""
_ZSCORES = ", ".join(f"round((s.{c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in SCALED)

ROUTE_FLOOR, CITY_FLOOR, AIRLINE_FLOOR, CAPPED = 230, 2000, 3200, 20_000


_KNN = (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) "
    "SELECT src, dst, CAST(rn AS INTEGER) AS rank, round(d, 6) AS distance FROM ("
    "SELECT src, dst, d, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS rn FROM ("
    "SELECT a.vec_id AS src, b.vec_id AS dst, list_distance(a.v, b.v) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id)) WHERE rn <= 15"
)


def _event_box() -> str:
    return _box({"value": "value"}, "vals.k AS event_type, ", "event_type", "events", lambda body, *more: "WITH " + ",\n".join(more) + "\n" + body)


REPORT_TEXTS = {
    "describe_numeric": "describe_clean",
    "describe_text": "summary_categorical",
    "delay_histogram": "delay_histogram",
    "delay_density": "delay_kde",
    "numeric_histograms": "numeric_histograms",
    "numeric_densities": "numeric_kde",
    "box_stats": "box_stats",
    "cyclical_points": "cyclical_points",
    "correlation_matrix": "correlation_matrix",
    "delay_by_weekday": "delay_by_dow",
    "delay_rate_by_weekday": "delay_rate_by_dow",
    "delay_by_month": "delay_by_month",
    "delay_vs_distance": "fit_delay_distance",
    "delay_vs_elapsed": "fit_delay_elapsed",
    "delay_by_weekday_and_month": "delay_month_dow",
    "delay_by_time_and_month": "delay_timebin_month",
    "delay_by_time_of_day": "delay_by_timebin",
    "route_delay_rate": "route_delay_rate",
    "season_box": "season_box",
    "season_density": "season_kde",
    "origin_volume": "origin_volume_delay",
    "top_airlines": "top_airlines",
    "top_origins": "top_origins",
    "top_destinations": "top_dests",
}


def _contents(texts: dict[str, str]) -> str:
    """Every value of every report table, by the query that has the table."""
    rows = []
    for table, (keys, digits) in REPORT.items():
        place = "concat_ws('|', " + ", ".join(f'CAST("{k}" AS STRING)' for k in keys) + ")" if keys else "''"
        names = ", ".join(f"'{m}'" for m in digits)
        values = ", ".join(f'CAST("{m}" AS DOUBLE)' for m in digits)
        rows.append(
            f"SELECT '{table}' AS table_name, {place} AS place, unnest([{names}]) AS measure, unnest([{values}]) AS value "
            f"FROM ({texts[REPORT_TEXTS[table]]})"
        )
    return "\nUNION ALL\n".join(rows)


# The clean rows with small delays as none, and as many of the zero delays as there are others.
_BALANCED = CLEAN.replace("clean AS (", "every AS (", 1) + """, minor AS (
SELECT * REPLACE (CASE WHEN ARR_DELAY <= 15 THEN CAST(0 AS DOUBLE) ELSE ARR_DELAY END AS ARR_DELAY) FROM every
), clean AS (
SELECT * EXCLUDE (rn, other) FROM (
  SELECT *, row_number() OVER (PARTITION BY ARR_DELAY = 0 ORDER BY md5(FLIGHT_ID || '|48'), FLIGHT_ID) AS rn,
    count(*) FILTER (WHERE ARR_DELAY <> 0) OVER () AS other FROM minor
) WHERE ARR_DELAY <> 0 OR rn <= other
)"""


def _index(texts: dict[str, str]) -> str:
    # Metrics of the missing-value table: one per column and four totals.
    rows = [f"SELECT 'missing_values' AS table_name, CAST({len(CLEAN_EXACT) + len(CLEAN_REAL) + 4} AS BIGINT) AS rows"]
    rows += [f"SELECT '{table}', (SELECT count(*) FROM ({texts[name]}))" for table, name in REPORT_TEXTS.items()]
    return "\nUNION ALL\n".join(rows)


def _job(texts: dict[str, str]) -> str:
    """Row counts of the job's tables beside those of the report."""
    train = "SELECT count(*) FROM split WHERE part = '{}'"
    known = " AND ".join(f"{c} IS NOT NULL" for c in (*PARTS, "FL_MONTH", "FL_DAY_OF_WEEK", "SEASON", "PEAK_MORNING", "PEAK_EVENING"))
    tables = {
        "missing_before": f"SELECT CAST({len(RAW_COLUMNS.split(',')) + 6} AS BIGINT)",
        "train": train.format("train"),
        "test": train.format("test"),
        "component_variance": f"SELECT CAST({len(PARTS)} AS BIGINT)",
        "component_loadings": f"SELECT CAST({len(PARTS) ** 2} AS BIGINT)",
        "component_scores": train.format("train"),
        "component_labels": "SELECT " + " + ".join(f"(SELECT count(DISTINCT {label}) FROM split WHERE part = 'train')" for _, label in _VIEWS),
        "neighbours": f"SELECT CAST(n * least(15, n - 1) AS BIGINT) FROM ({train.format('train').replace('count(*)', 'count(*) AS n')} AND {known})",
        "hypothesis_tests": "SELECT CAST(2 AS BIGINT)",
    }
    own = "\nUNION ALL\n".join(f"SELECT '{name}' AS table_name, ({text}) AS rows" for name, text in tables.items())
    return _with(4, own) + "\nUNION ALL\nSELECT * FROM (" + texts["report_index"] + ")"


def oracle_sql() -> dict[str, str]:
    exact = ", ".join(CLEAN_EXACT)
    real = ", ".join(f"round({c}, 6) AS {c}" for c in CLEAN_REAL)
    delay_view = {"ARR_DELAY": _clip("ARR_DELAY", -60, 180)}
    texts = {
        "scan_flights": on_flights(f"SELECT {RAW_COLUMNS} FROM flights"),
        "preview": on_flights(f"SELECT {RAW_COLUMNS} FROM flights ORDER BY FLIGHT_ID LIMIT 5"),
        "describe_numeric": _describe("flights", RAW_NUMERIC, on_flights),
        "describe_clean": _describe("clean", CLEAN_NUMERIC, on_clean),
        "export_roundtrip": on_clean(
            "SELECT FL_YEAR, count(*) AS flights, round(sum(ARR_DELAY), 6) AS total_delay, round(sum(AVG_SPEED), 4) AS total_speed, "
            "count(DISTINCT ROUTE) AS routes, min(ORIGIN_STATE) AS first_state FROM clean GROUP BY FL_YEAR"
        ),
        "encoding_mappings": _with(
            5,
            "SELECT 'STATE_SHARED' AS \"Column\", v AS Original_Value, code AS Encoded_Code FROM state_codes UNION ALL "
            "SELECT 'ROUTE', v, code FROM route_codes UNION ALL SELECT 'ORIGIN_CITY', v, code FROM origin_codes UNION ALL "
            "SELECT 'DEST_CITY', v, code FROM dest_codes",
        ),
        "drop_leakage": on_flights(f"SELECT {RAW_COLUMNS} FROM flights"),
        "filter_completed": on_flights(
            "SELECT FLIGHT_ID, FL_DATE, DOT_CODE, ORIGIN_CITY, DEST_CITY, CRS_DEP_TIME, CRS_ARR_TIME, ARR_DELAY, "
            "CRS_ELAPSED_TIME, DISTANCE FROM flights WHERE CANCELLED = 0 AND DIVERTED = 0"
        ),
        "clean_na": on_flights(
            f"SELECT {RAW_COLUMNS} FROM flights WHERE ARR_DELAY IS NOT NULL AND CRS_ELAPSED_TIME IS NOT NULL"
        ),
        "fix_negative_delays": on_flights(
            "SELECT FLIGHT_ID, CASE WHEN ARR_DELAY < 0 THEN CAST(0 AS DOUBLE) ELSE ARR_DELAY END AS ARR_DELAY FROM flights"
        ),
        "clip_columns": on_flights(
            "SELECT FLIGHT_ID, " + _clip("ARR_DELAY", -20, 30) + " AS ARR_DELAY, " + _clip("CRS_ELAPSED_TIME", 100, 300)
            + " AS CRS_ELAPSED_TIME, " + _clip("DISTANCE", 0, 1000) + " AS DISTANCE FROM flights"
        ),
        "date_features": on_flights(
            "SELECT FLIGHT_ID, CAST(year(FL_DATE) AS INTEGER) AS FL_YEAR, CAST(month(FL_DATE) AS INTEGER) AS FL_MONTH, "
            "CAST(isodow(FL_DATE) AS INTEGER) AS FL_DAY_OF_WEEK FROM flights"
        ),
        "cyclical_time": on_flights(
            "SELECT FLIGHT_ID, " + ", ".join(
                f"round({f}({_TURN} * {_minutes(c)} / 1440.0::DOUBLE), 6) AS {c}_{f}"
                for c in ("CRS_DEP_TIME", "CRS_ARR_TIME") for f in ("sin", "cos")
            ) + " FROM flights"
        ),
        "season": on_flights(
            "SELECT FLIGHT_ID, CAST(month(FL_DATE) AS INTEGER) AS FL_MONTH, "
            "CAST(((month(FL_DATE) % 12) // 3) + 1 AS INTEGER) AS SEASON FROM flights"
        ),
        "weekend_flag": on_flights(
            "SELECT FLIGHT_ID, CAST(isodow(FL_DATE) AS INTEGER) AS FL_DAY_OF_WEEK, "
            "CAST(CASE WHEN isodow(FL_DATE) IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS IS_WEEKEND FROM flights"
        ),
        "route": on_flights("SELECT FLIGHT_ID, ORIGIN_CITY || '_' || DEST_CITY AS ROUTE FROM flights"),
        "avg_speed": on_flights("SELECT FLIGHT_ID, round(DISTANCE / nullif(CRS_ELAPSED_TIME, 0), 6) AS AVG_SPEED FROM flights"),
        "dep_hour": on_flights(
            "SELECT FLIGHT_ID, CAST(CRS_DEP_TIME // 100 AS INTEGER) AS hhmm_hour, CAST(CRS_DEP_TIME // 60 AS INTEGER) AS minutes_hour FROM flights"
        ),
        "arr_hour": on_flights(
            "SELECT FLIGHT_ID, CAST(CRS_ARR_TIME // 100 AS INTEGER) AS hhmm_hour, CAST(CRS_ARR_TIME // 60 AS INTEGER) AS minutes_hour FROM flights"
        ),
        "peak_flags": on_flights(
            "SELECT FLIGHT_ID, " + ", ".join(
                f"CAST(CASE WHEN CRS_DEP_TIME // {d} BETWEEN {a} AND {b} THEN 1 ELSE 0 END AS INTEGER) AS {n}_{p}"
                for n, d in (("hhmm", 100), ("minutes", 60)) for p, a, b in (("morning", 7, 10), ("evening", 16, 19))
            ) + " FROM flights"
        ),
        "states": on_flights(
            "SELECT FLIGHT_ID, trim(split_part(ORIGIN_CITY, ',', -1)) AS ORIGIN_STATE, trim(split_part(DEST_CITY, ',', -1)) AS DEST_STATE FROM flights"
        ),
        "delay_category": on_flights(
            "SELECT FLIGHT_ID, CASE WHEN ARR_DELAY <= 0 THEN 'On-time / Early' WHEN ARR_DELAY <= 15 THEN 'Minor delay' "
            "WHEN ARR_DELAY <= 60 THEN 'Moderate delay' ELSE 'Long delay' END AS DELAY_CATEGORY FROM flights"
        ),
        "canonical_route": on_flights(
            "SELECT FLIGHT_ID, CASE WHEN len(string_split(r, '_')) = 2 THEN array_to_string(list_sort(string_split(r, '_')), '_') "
            "ELSE r END AS ROUTE FROM (SELECT FLIGHT_ID, ORIGIN_CITY || '_' || DEST_CITY AS r FROM flights)"
        ),
        "missing_report": _missing(),
        "summary_categorical": _text_summary(),
        "summary_full": _full_summary(),
        "resampled_band_distance": _resampled("DISTANCE"),
        "resampled_band_elapsed": _resampled("CRS_ELAPSED_TIME"),
        "delay_by_dow": _mean("FL_DAY_OF_WEEK"),
        "delay_rate_by_dow": _mean("FL_DAY_OF_WEEK", "rate"),
        "delay_by_month": _mean("FL_MONTH"),
        "delay_month_dow": _mean("FL_DAY_OF_WEEK, FL_MONTH"),
        "delay_month_dow_wide": _wide(),
        "delay_grouping_sets": on_clean(
            "SELECT FL_DAY_OF_WEEK, FL_MONTH, SEASON, CAST(grouping(FL_DAY_OF_WEEK, FL_MONTH, SEASON) AS INTEGER) AS grouping_id, "
            "round(avg(ARR_DELAY), 6) AS avg_delay, round(100 * avg(CASE WHEN ARR_DELAY > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS delay_rate, "
            "count(*) AS flights FROM clean GROUP BY GROUPING SETS ((FL_DAY_OF_WEEK), (FL_MONTH), (FL_DAY_OF_WEEK, FL_MONTH), (SEASON))"
        ),
        "delay_timebin_month": on_clean(
            f"SELECT lpad(CAST({_bin('dep_minute')} AS STRING), 2, '0') || ':00' AS time_bin, FL_MONTH, round(avg(ARR_DELAY), 6) AS avg_delay, "
            "count(*) AS flights FROM clean GROUP BY 1, 2"
        ),
        "delay_by_timebin": on_clean(
            "SELECT CAST(g.range AS INTEGER) AS time_bin, round(avg(ARR_DELAY), 6) AS avg_delay, count(ARR_DELAY) AS flights "
            f"FROM range(24) g LEFT JOIN (SELECT {_bin('dep_minute')} AS b, ARR_DELAY FROM clean) c ON c.b = g.range GROUP BY g.range"
        ),
        "route_delay_rate": on_clean(
            "SELECT ROUTE, round(100 * avg(CASE WHEN ARR_DELAY > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS delay_rate, count(*) AS flights "
            f"FROM clean GROUP BY ROUTE HAVING count(*) >= {ROUTE_FLOOR} ORDER BY count(*) DESC, ROUTE LIMIT 15"
        ),
        "origin_volume_delay": on_clean(
            "SELECT ORIGIN_CITY, round(avg(ARR_DELAY), 6) AS avg_delay, count(*) AS flights FROM clean GROUP BY ORIGIN_CITY "
            f"HAVING count(*) >= {CITY_FLOOR}"
        ),
        "top_airlines": _top("DOT_CODE", AIRLINE_FLOOR),
        "top_origins": _top("ORIGIN_CITY", CITY_FLOOR),
        "top_dests": _top("DEST_CITY", CITY_FLOOR),
        "correlation_matrix": _matrix(CORRELATED, "round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0), 6)", "corr"),
        "delay_histogram": _histogram(delay_view, 80),
        "numeric_histograms": _histogram(NUMERIC, 40),
        "delay_kde": _density(delay_view, ""),
        "numeric_kde": _density(NUMERIC, 'en.col AS "column", '),
        "box_stats": _box(BOXED, 'vals.col AS "column", '),
        "season_box": _box(delay_view, 'vals.k AS "SEASON", vals.col AS "column", ', "SEASON"),
        "delay_kde_nrd0": _density(delay_view, "", spread=_NRD0),
        "season_kde_nrd0": _density(delay_view, 'en.k AS "SEASON", ', "SEASON", 100, 2.0, _NRD0),
        "season_kde": _density(delay_view, 'en.k AS "SEASON", ', "SEASON", 100, 2.0),
        "fit_delay_distance": _fit_row("DISTANCE"),
        "fit_delay_elapsed": _fit_row("CRS_ELAPSED_TIME"),
        "band_delay_distance": _band("DISTANCE"),
        "band_delay_elapsed": _band("CRS_ELAPSED_TIME"),
        **{
            f"points_delay_{name}": on_clean(
                f"SELECT {x}, {_clip('ARR_DELAY', -60, 180)} AS ARR_DELAY, count(*) AS n FROM clean GROUP BY 1, 2"
            )
            for name, x in (("distance", "DISTANCE"), ("elapsed", "CRS_ELAPSED_TIME"))
        },
        "cyclical_points": on_clean(
            "SELECT c AS time_column, CAST(m AS INTEGER) AS minute, round(sin(2 * pi() * m / 1440.0::DOUBLE), 6) AS sin, "
            "round(cos(2 * pi() * m / 1440.0::DOUBLE), 6) AS cos, count(*) AS n FROM (SELECT 'CRS_DEP_TIME' AS c, dep_minute AS m FROM clean "
            "UNION ALL SELECT 'CRS_ARR_TIME', arr_minute FROM clean) GROUP BY c, m"
        ),
        "train_test_split": _with(4, "SELECT FLIGHT_ID, part FROM split"),
        "state_codes": _with(5, "SELECT v AS Original_Value, code AS Encoded_Code FROM state_codes"),
        "route_codes": _with(5, "SELECT v AS Original_Value, code AS Encoded_Code FROM route_codes"),
        "city_codes": _with(
            5,
            "SELECT 'ORIGIN_CITY' AS \"Column\", v AS Original_Value, code AS Encoded_Code FROM origin_codes "
            "UNION ALL SELECT 'DEST_CITY', v, code FROM dest_codes",
        ),
        "encode_test": _with(5, _ENCODED.format(more="") + " WHERE s.part = 'test'"),
        "encode_unseen": on_clean(
            _ENCODED.format(more=""),
            "split AS (SELECT *, CASE WHEN len(string_split(ROUTE, '_')) = 2 THEN array_to_string(list_sort(string_split(ROUTE, '_')), '_') "
            "ELSE ROUTE END AS canon, CASE WHEN FL_MONTH <= 4 AND DOT_CODE < 2 AND FL_DAY_OF_WEEK = 1 THEN 'train' END AS part FROM clean)",
            CODES,
        ),
        "scale_numeric": _with(6, f"SELECT s.FLIGHT_ID, s.part, {_ZSCORES} FROM split s CROSS JOIN scaler"),
        "balanced_sample": on_clean(
            "SELECT FLIGHT_ID, ARR_DELAY FROM (SELECT *, row_number() OVER (PARTITION BY ARR_DELAY = 0 ORDER BY md5(FLIGHT_ID || '|48'), FLIGHT_ID) AS rn, "
            "count(*) FILTER (WHERE ARR_DELAY <> 0) OVER () AS other FROM clean) WHERE ARR_DELAY <> 0 OR rn <= other"
        ),
        "balanced_minor": on_clean(
            "SELECT FLIGHT_ID, d AS ARR_DELAY FROM (SELECT *, row_number() OVER (PARTITION BY d = 0 ORDER BY md5(FLIGHT_ID || '|48'), FLIGHT_ID) AS rn, "
            "count(*) FILTER (WHERE d <> 0) OVER () AS other "
            "FROM (SELECT FLIGHT_ID, CASE WHEN ARR_DELAY <= 15 THEN 0 ELSE ARR_DELAY END AS d FROM clean)) WHERE d <> 0 OR rn <= other"
        ),
        "capped_sample": on_clean(
            "SELECT FLIGHT_ID FROM (SELECT FLIGHT_ID, row_number() OVER (ORDER BY md5(FLIGHT_ID || '|42'), FLIGHT_ID) AS rn FROM clean) "
            f"WHERE rn <= {CAPPED}"
        ),
        "welch_weekend": on_clean(_WEEKEND[1], _WEEKEND[0]),
        "welch_pandemic": on_clean(_ERA[1], _ERA[0]),
        "welch_all": on_clean(_WEEKEND[1] + "\nUNION ALL\n" + _ERA[1], _WEEKEND[0], _ERA[0]),
        "era_delays": on_clean(
            "SELECT CASE WHEN FL_YEAR = 2019 THEN 'Pre' ELSE 'Post' END AS era, round(avg(ARR_DELAY), 6) AS avg_delay, count(*) AS flights "
            "FROM clean WHERE FL_YEAR IN (2019, 2022, 2023) GROUP BY 1"
        ),
        "covariance_matrix": _matrix(COVARIED, "round(covar_samp({a}, {b}), 6)", "cov"),
        "pca_variance": on_clean(
            "SELECT 'PC' || i AS component, round(lam, 6) AS variance, round(lam / sum(lam) OVER (), 6) AS ratio, "
            "round(sum(lam) OVER (ORDER BY i) / sum(lam) OVER (), 6) AS cumulative FROM unit",
            _PCA,
        ),
        "pca_loadings": on_clean(
            "SELECT 'PC' || i AS component, 'AVG_SPEED' AS feature, round(x, 6) AS loading FROM unit UNION ALL "
            "SELECT 'PC' || i, 'DISTANCE', round(y, 6) FROM unit UNION ALL SELECT 'PC' || i, 'CRS_ELAPSED_TIME', round(z, 6) FROM unit",
            _PCA,
        ),
        "pca_scores": on_clean("SELECT FLIGHT_ID, round(PC1, 6) AS PC1, round(PC2, 6) AS PC2 FROM scores", _PCA, _SCORES),
        "pca_by_label": on_clean(
            "\nUNION ALL\n".join(
                f"SELECT '{view}' AS view, {label} AS label, round(avg(PC1), 6) AS mean_pc1, round(avg(PC2), 6) AS mean_pc2, count(*) AS n "
                f"FROM scores GROUP BY {label}" for view, label in _VIEWS
            ),
            _PCA,
            _SCORES,
        ),
        "pca_delay_points": on_clean("SELECT ARR_DELAY AS label, round(PC1, 6) AS PC1, round(PC2, 6) AS PC2 FROM scores", _PCA, _SCORES),
        "pca_train_features": _with(
            6,
            "SELECT 'PC' || i AS component, round(lam, 6) AS variance, round(lam / sum(lam) OVER (), 6) AS ratio, "
            "round(sum(lam) OVER (ORDER BY i) / sum(lam) OVER (), 6) AS cumulative FROM placed",
            "scaled AS (SELECT " + ", ".join(
                f"(s.{c} - m_{c}) / s_{c} AS {c}" if c in SCALED else f"s.{c}" for c in PARTS
            ) + " FROM split s CROSS JOIN scaler WHERE s.part = 'train')",
            _jacobi(PARTS, "scaled"),
        ).replace("WITH ", "WITH RECURSIVE ", 1),
        "knn_graph": _KNN,
        "knn_blocks": _KNN,
        "knn_routes": on_clean(
            "SELECT src, dst, CAST(rn AS INTEGER) AS rank, round(d, 6) AS distance FROM ("
            "SELECT src, dst, d, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS rn FROM ("
            "SELECT a.ROUTE AS src, b.ROUTE AS dst, list_distance(a.v, b.v) AS d FROM means a JOIN means b ON a.ROUTE <> b.ROUTE)) WHERE rn <= 15",
            "means AS (SELECT ROUTE, ["
            + ", ".join(f"round(CAST(avg({c}) AS DOUBLE), 6)" for c in (*PARTS, "FL_MONTH", "FL_DAY_OF_WEEK", "SEASON", "PEAK_MORNING", "PEAK_EVENING"))
            + "] AS v FROM clean GROUP BY ROUTE)",
        ),
        "knn_recall": on_clean("SELECT CAST(sum(least(15, n - 1)) AS BIGINT) AS links, 1 AS reached FROM (SELECT count(*) OVER () AS n FROM clean GROUP BY ROUTE)"),
        "clean_pipeline": on_clean(f"SELECT {exact}, {real} FROM clean"),
        "model_matrix": _with(
            6,
            _ENCODED.format(
                more=", s.part, s.ARR_DELAY, s.DOT_CODE, s.FL_YEAR, s.FL_MONTH, s.FL_DAY_OF_WEEK, s.SEASON, s.IS_WEEKEND, "
                "s.PEAK_MORNING, s.PEAK_EVENING, " + _ZSCORES + ", "
                + ", ".join(f"round(s.{c}, 6) AS {c}" for c in CLEAN_REAL if c != "AVG_SPEED")
            ) + " CROSS JOIN scaler",
        ),
        "events_mean": "SELECT event_type, round(avg(value), 6) AS avg_delay, count(*) AS flights FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
        "events_box": _event_box(),
    }
    texts["report_index"] = _index(texts)
    texts["job_index"] = _job(texts)
    texts["malformed_rows"] = on_flights(
        "SELECT 'kept' AS part, count(*) FILTER (WHERE DOT_CODE NOT IN (3, 5)) AS rows FROM flights UNION ALL "
        "SELECT 'set aside', count(*) FILTER (WHERE DOT_CODE IN (3, 5)) FROM flights"
    )
    texts["report_contents"] = _contents(texts)
    texts["report_balanced"] = texts["report_contents"].replace(CLEAN, _BALANCED)
    return texts
