"""SQL for the registered queries, straight from the event table.

It states what the results are, without documents, extraction or stored tables.
"""

from __future__ import annotations

from pulsegrid.sources.events import BLOOD_TYPES, MEALS, METRIC_SLOTS

# Fixed values, written out here and not taken from the engine, so that a wrong mapping there shows: fact table, unit
# in the event documents, food columns or not, in the order of the facts.
_FACTS = (
    ("ACTIVE_ENERGY_BURNED", "Cal", False), ("APPLESTANDTIME", "s", False), ("BASALENERGYBURNED", "Cal", False),
    ("BODYMASS", "lb", False), ("CARBS", "g", True), ("CHOLESTEROL", "g", True), ("DIETARYENERGY", "Cal", True),
    ("ENVIRONMENTAUDIO", "dBASPL", False), ("EXERCISETIME", "min", False), ("FATMONO", "g", True),
    ("FATPOLY", "g", True), ("FATSAT", "g", True), ("FATTOTAL", "g", True), ("FLIGHTSCLIMBED", "count", False),
    ("HEAPHONEAUDIO", "dBASPL", False), ("HEARTRATE", "g", False), ("HEARTRATESDNN", "ms", False),
    ("PROTEIN", "g", True), ("RESTINGHEARTRATE", "count/s", False), ("SLEEP", "g", None), ("SODIUM", "g", True),
    ("STEPCOUNT", "count", False), ("SUGAR", "g", True), ("WALKINGHEARTAVG", "count/s", True),
    ("WALKRUNDISTANCE", "mi", True),
)
# Column of the wide table and the fact it sums: daily, hourly and as a series.
DAILY_SUMS = (
    ("ACTIVE_ENERGY_BURNED", "ACTIVE_ENERGY_BURNED"), ("APPLE_STAND_TIME", "APPLESTANDTIME"),
    ("BASAL_ENERGY_BURNED", "BASALENERGYBURNED"), ("CARBS", "CARBS"), ("CHOLESTEROL", "CHOLESTEROL"),
    ("DIETARY_ENERGY", "DIETARYENERGY"), ("FATMONO", "FATMONO"), ("FATPOLY", "FATPOLY"), ("FATSAT", "FATSAT"),
    ("FATTOTAL", "FATTOTAL"), ("FLIGHTSCLIMBED", "FLIGHTSCLIMBED"), ("PROTEIN", "PROTEIN"), ("SODIUM", "SODIUM"),
    ("STEPS", "STEPCOUNT"), ("SUGAR", "SUGAR"), ("WALK_RUN", "WALKRUNDISTANCE"), ("EXERCISE_TIME", "EXERCISETIME"),
    ("BODYMASS", "BODYMASS"),
)
HOURLY_SUMS = (
    ("STAND_TIME_ARR", "APPLESTANDTIME"), ("FLIGHTS_ARR", "FLIGHTSCLIMBED"), ("WALK_RUN_ARR", "WALKRUNDISTANCE"),
    ("STEPS_ARR", "STEPCOUNT"), ("ACTIVE_ENERGY_ARR", "ACTIVE_ENERGY_BURNED"), ("BASAL_ARR", "BASALENERGYBURNED"),
    ("EXERCISE_TIME_ARR", "EXERCISETIME"),
)
RAW_SERIES = (
    ("REST_HEART_RATE_ARR", "RESTINGHEARTRATE"), ("SDNN_HEART_RATE_ARR", "HEARTRATESDNN"),
    ("WALK_HEART_RATE_ARR", "WALKINGHEARTAVG"), ("ENVIRONMENT_AUDIO_ARR", "ENVIRONMENTAUDIO"),
    ("HEADPHONE_AUDIO_ARR", "HEAPHONEAUDIO"),
)
SLEEP_STAGES = ((0, "InBed"), (1, "Unknown"), (2, "awake"), (3, "Core"), (4, "Deep"), (5, "REM"))


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _array(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def d(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name or expr}"


def t(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name or expr}"


def n(expr: str, name: str | None = None) -> str:
    return f"round(round({expr}, 9), 4) AS {name or expr}"


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def dbl(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"


def EV(expr: str) -> str:
    return f"round_even(round({expr}, 9), 0)"


_FOODS = [f for f, _, food in _FACTS if food]
_MEASURES = [f for f, _, food in _FACTS if food is False]
_UNIT_OF = {f: unit for f, unit, _ in _FACTS}
_UNIT_CASE = " ".join(f"WHEN '{f}' THEN '{u}'" for f, u in _UNIT_OF.items())
_STAGE_CASE = " ".join(f"WHEN {v} THEN '{s}'" for v, s in SLEEP_STAGES)
_NY = "(({0} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"

BASE = f"""
WITH ev AS (
  SELECT event_id, user_id, value, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         date_trunc('second', ts) AS st,
         date_trunc('second', ts) + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS en,
         CASE WHEN event_id % {METRIC_SLOTS} < {len(_FACTS)}
              THEN ({_array([f for f, _, _ in _FACTS])})[CAST(event_id % {METRIC_SLOTS} AS INTEGER) + 1]
              ELSE 'SLEEP' END AS METRIC
  FROM events),
sent AS (
  SELECT *, CAST(user_id AS VARCHAR) AS ID, METRIC IN {_list(_FOODS)} AND k % 2 = 0 AS meal FROM ev),
s AS (
  SELECT DISTINCT ID, METRIC,
    CASE WHEN METRIC = 'BASALENERGYBURNED' THEN st ELSE {_NY.format('st')} END AS STARTTIME,
    CASE WHEN METRIC = 'BASALENERGYBURNED' THEN en ELSE {_NY.format('en')} END AS ENDTIME,
    CASE WHEN METRIC = 'SLEEP' THEN CAST(k % 6 AS DOUBLE)
         WHEN METRIC = 'HEARTRATE' AND k % 2 = 0 THEN value * 60 ELSE value END AS VALUE,
    CASE WHEN METRIC = 'SLEEP' THEN 'Sleep'
         WHEN METRIC = 'HEARTRATE' THEN CASE WHEN k % 2 = 0 THEN 'count/s' ELSE 'count/min' END
         ELSE CASE METRIC {_UNIT_CASE} END END AS UNIT,
    CASE WHEN METRIC <> 'BODYMASS' THEN CAST(event_id AS VARCHAR) END AS UUID,
    CASE WHEN k % 4 < 3 THEN 'Watch6,1' ELSE 'iPhone14,2' END AS DEVICE,
    CASE WHEN meal THEN 'Food' END AS FOODIMAGENAME,
    CASE WHEN meal THEN 'Food ' || k END AS FOODTYPE,
    CASE WHEN meal THEN CAST(k AS VARCHAR) END AS FOODUSDANUMBER,
    CASE WHEN meal THEN ({_array(MEALS)})[k % 4 + 1] END AS FOODMEAL
  FROM sent),
sd AS (SELECT *, CAST(STARTTIME AS DATE) AS DATE FROM s),
pop AS (
  SELECT CAST(user_id AS VARCHAR) AS ID,
    20 + user_id % 50 + CASE WHEN last > DATE '2024-01-15' THEN 1 ELSE 0 END AS AGE,
    ({_array(BLOOD_TYPES)})[CAST(user_id % 8 AS INTEGER) + 1] AS BLOODTYPE,
    CASE WHEN user_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS GENDER,
    last + INTERVAL 1 DAY + to_hours(CASE WHEN user_id % 3 = 0 THEN 5 ELSE 4 END) AS LOADTIME
  FROM (SELECT user_id, max(CAST(ts AS DATE)) AS last FROM events GROUP BY user_id)),
cal AS (SELECT min(CAST(ts AS DATE)) - 1 AS a, max(CAST(ts AS DATE)) + 9 AS z FROM events),
rng AS (SELECT a AS r1, a + 21 AS r2 FROM cal),
days AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS DATE FROM cal),
spine AS (SELECT ID, DATE FROM (SELECT DISTINCT ID FROM pop), days),
sleep AS (
  SELECT ID, STARTTIME, ENDTIME, CAST(VALUE AS INTEGER) AS VALUE, UNIT, UUID, DEVICE,
    CASE CAST(VALUE AS INTEGER) {_STAGE_CASE} END AS CYCLE,
    date_diff('minute', STARTTIME, ENDTIME) AS MINS,
    CAST(STARTTIME + INTERVAL 6 HOUR AS DATE) AS NIGHT
  FROM s WHERE METRIC = 'SLEEP' AND DEVICE ILIKE 'Watch%'),
seg AS (
  SELECT ID, NIGHT AS DATE, date_trunc('minute', STARTTIME) AS T, CYCLE, sum(MINS) AS val
  FROM sleep WHERE VALUE <> 0 GROUP BY ALL),
nightly AS (
  SELECT ID, NIGHT AS DATE, sum(MINS) AS SLEEP FROM sleep WHERE VALUE IN (3, 4, 5) GROUP BY ALL),
hrs AS (SELECT ID, DATE, DATE + to_hours(CAST(h AS INTEGER)) AS T FROM spine, range(24) r(h)),
energy AS (
  SELECT ID, DATE AS TIME,
    coalesce(sum(VALUE) FILTER (METRIC = 'DIETARYENERGY'), 0.0) AS CONSUMED,
    coalesce(sum(VALUE) FILTER (METRIC = 'ACTIVE_ENERGY_BURNED'), 0.0) AS ACTIVE_ENERGY,
    coalesce(sum(VALUE) FILTER (METRIC = 'BASALENERGYBURNED'), 0.0) AS BASAL_ENERGY
  FROM sd WHERE METRIC IN ('DIETARYENERGY', 'ACTIVE_ENERGY_BURNED', 'BASALENERGYBURNED')
  GROUP BY ALL),
hist AS (
  SELECT p.ID, p.DATE, e.TIME, e.CONSUMED, e.ACTIVE_ENERGY, e.BASAL_ENERGY
  FROM spine p JOIN energy e ON p.ID = e.ID AND e.TIME BETWEEN p.DATE - 9 AND p.DATE),
sums AS (
  SELECT ID, DATE, {", ".join(f"sum(VALUE) FILTER (METRIC = '{f}') AS {c}" for c, f in DAILY_SUMS)}
  FROM sd GROUP BY ID, DATE),
hr_hours AS (
  SELECT DISTINCT ID, DATE, date_trunc('hour', STARTTIME) AS T, VALUE AS V
  FROM sd WHERE METRIC = 'HEARTRATE'),
hr AS (SELECT h.ID, h.DATE, h.T, x.V FROM hrs h LEFT JOIN hr_hours x USING (ID, DATE, T)),
laid AS (
  SELECT ID, DATE, CYCLE, val, minute(first_value(T) OVER w) AS m0,
    date_trunc('hour', first_value(T) OVER w) AS h0,
    sum(val) OVER w - val + minute(first_value(T) OVER w) AS off,
    sum(val) OVER (PARTITION BY ID, DATE) AS total
  FROM seg WHERE CYCLE IS NOT NULL
  WINDOW w AS (PARTITION BY ID, DATE ORDER BY T, CYCLE ROWS UNBOUNDED PRECEDING)),
tr AS (
  SELECT p.ID, p.DATE, pop.AGE, pop.GENDER, pop.BLOODTYPE, u.* EXCLUDE (ID, DATE), nightly.SLEEP
  FROM spine p JOIN pop ON p.ID = pop.ID JOIN rng ON p.DATE BETWEEN r1 AND r2
  LEFT JOIN sums u ON u.ID = p.ID AND u.DATE = p.DATE
  LEFT JOIN nightly ON nightly.ID = p.ID AND nightly.DATE = p.DATE),
macros AS (
  SELECT ID, DATE + 1 AS date, {EV('PROTEIN')} * 4 AS Protein,
    {EV('CARBS')} * 4 AS Carbs, {EV('FATTOTAL')} * 9 AS Fat FROM tr),
burned AS (
  SELECT ID, DATE + 1 AS date, {EV('BASAL_ENERGY_BURNED')} AS Basal,
    {EV('ACTIVE_ENERGY_BURNED')} AS Active FROM tr)
"""

_DIM = """year(DATE) AS YEAR, month(DATE) AS MONTH, strftime(DATE, '%b') AS MONTH_NAME,
  day(DATE) AS DAY_OF_MON"""
_DIM_END = """CAST(dayofweek(DATE) + 1 AS VARCHAR) AS DAY_OF_WEEK,
  weekofyear(DATE) AS WEEK_OF_YEAR, dayofyear(DATE) AS DAY_OF_YEAR"""

_SUM_COLUMNS = ", ".join(n(c) for c, _ in DAILY_SUMS)
_WIDE = f"""SELECT p.ID, {d('p.DATE', 'DATE')}, {_SUM_COLUMNS}
  FROM spine p LEFT JOIN sums u ON u.ID = p.ID AND u.DATE = p.DATE"""
_CENTS = "CAST(CAST(round({0} * 100) AS BIGINT) AS VARCHAR)"
_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def _normalised(buckets: str) -> str:
    """Minutes per clock hour and stage; ``buckets`` is the number of hours of a night."""
    return f"""
    SELECT ID, {d('DATE')}, CAST(b * 4 + c AS BIGINT) AS POS, {t('h0 + to_hours(CAST(b AS INTEGER))', 'T')},
      (['REM', 'Core', 'Deep', 'awake'])[c + 1] AS cycle,
      CAST(sum(CASE WHEN CYCLE = (['REM', 'Core', 'Deep', 'awake'])[c + 1]
        THEN greatest(0, least(off + val, b * 60 + 60) - greatest(off, b * 60)) ELSE 0 END) AS BIGINT) AS val
    FROM (SELECT *, unnest(range(CAST({buckets} AS BIGINT))) AS b FROM laid), (SELECT unnest([0, 1, 2, 3]) AS c)
    GROUP BY ID, DATE, b, c, h0"""


def _history(active: str, basal: str, consumed: str) -> str:
    return f"""
    SELECT ID, {d('DATE')}, row_number() OVER (PARTITION BY ID, DATE ORDER BY TIME) - 1 AS POS,
      {t('CAST(TIME AS TIMESTAMP)', 'T')}, {n(active, 'ACTIVE')}, {n(basal, 'BASAL')},
      {n(consumed, 'CONSUMED')} FROM hist"""


def _pop_agg() -> str:
    hourly = ", ".join(
        f"sum(VALUE) FILTER (METRIC = '{f}') AS {c}" for c, f in HOURLY_SUMS
    )
    hourly_text = ", ".join(
        f"string_agg({_STAMP.format('h.T')} || '=' || {_CENTS.format(f'coalesce(x.{c}, 0)')}, ';' "
        f"ORDER BY h.T) AS {c}" for c, _ in HOURLY_SUMS
    )
    raw_text = ", ".join(
        f"string_agg({_STAMP.format('STARTTIME')} || '=' || {_CENTS.format('VALUE')}, ';' "
        f"ORDER BY STARTTIME, VALUE) FILTER (METRIC = '{f}') AS {c}" for c, f in RAW_SERIES
    )
    columns = ", ".join(
        ["p.ID AS ID", d("p.DATE", "DATE"), "CAST(AGE AS BIGINT) AS AGE", "BLOODTYPE", "GENDER",
         _SUM_COLUMNS, "CAST(SLEEP AS DOUBLE) AS SLEEP", "HEART_RATE_ARR", "WEEK_CALS_ARR",
         "SLEEP_ARR", *[c for c, _ in HOURLY_SUMS], *[c for c, _ in RAW_SERIES],
         "CAST(0 AS BIGINT) AS PART"]
    )
    return f""",
    hourly AS (SELECT ID, date_trunc('hour', STARTTIME) AS T, {hourly} FROM sd GROUP BY ALL),
    hourly_text AS (SELECT h.ID, h.DATE, {hourly_text}
      FROM hrs h LEFT JOIN hourly x ON x.ID = h.ID AND x.T = h.T GROUP BY h.ID, h.DATE),
    raw_text AS (SELECT ID, DATE, {raw_text} FROM sd GROUP BY ID, DATE),
    hr_text AS (SELECT ID, DATE, string_agg({_STAMP.format('T')} || '=' ||
      coalesce({_CENTS.format('V')}, ''), ';' ORDER BY T, V) AS HEART_RATE_ARR
      FROM hr GROUP BY ID, DATE),
    seg_text AS (SELECT ID, DATE, string_agg({_STAMP.format('T')} || '=' || CYCLE || '=' ||
      {_CENTS.format('val')}, ';' ORDER BY T, CYCLE) AS SLEEP_ARR FROM seg GROUP BY ID, DATE),
    week_text AS (SELECT ID, DATE, string_agg({_STAMP.format('CAST(TIME AS TIMESTAMP)')} || '=' ||
      {_CENTS.format('ACTIVE_ENERGY')} || '=' || {_CENTS.format('BASAL_ENERGY')} || '=' ||
      {_CENTS.format('CONSUMED')}, ';' ORDER BY TIME) AS WEEK_CALS_ARR FROM hist GROUP BY ID, DATE)
    SELECT {columns} FROM spine p JOIN pop USING (ID)
      LEFT JOIN sums u ON u.ID = p.ID AND u.DATE = p.DATE
      LEFT JOIN nightly g ON g.ID = p.ID AND g.DATE = p.DATE
      LEFT JOIN hourly_text a ON a.ID = p.ID AND a.DATE = p.DATE
      LEFT JOIN raw_text b ON b.ID = p.ID AND b.DATE = p.DATE
      LEFT JOIN hr_text c ON c.ID = p.ID AND c.DATE = p.DATE
      LEFT JOIN seg_text e ON e.ID = p.ID AND e.DATE = p.DATE
      LEFT JOIN week_text f ON f.ID = p.ID AND f.DATE = p.DATE"""


_POP_AGG = _pop_agg()

_HEART = """SELECT ID,
  CAST(CAST(round(round(avg(VALUE) FILTER (METRIC = 'HEARTRATE'), 9)) AS INTEGER) AS DOUBLE) AS HEART_RATE,
  CAST(CAST(round(round(avg(VALUE) FILTER (METRIC = 'RESTINGHEARTRATE') * 60, 9)) AS INTEGER) AS DOUBLE) AS RESTING_HR,
  CAST(CAST(round(round(avg(VALUE) FILTER (METRIC = 'WALKINGHEARTAVG') * 60, 9)) AS INTEGER) AS DOUBLE) AS WALKING_HR,
  CAST(CAST(round(round(avg(VALUE) FILTER (METRIC = 'HEARTRATESDNN'), 9)) AS INTEGER) AS DOUBLE) AS HR_SDNN
  FROM s, rng
  WHERE METRIC IN ('HEARTRATE', 'RESTINGHEARTRATE', 'WALKINGHEARTAVG', 'HEARTRATESDNN')
    AND STARTTIME BETWEEN r1 AND r2 GROUP BY ID"""

_WEIGHT_DATE = "date_trunc('second', ts)"


def _trunc(expr: str, name: str) -> str:
    return f"trunc(round({expr}, 9)) AS {name}"


def _stream(part: str) -> str:
    return f"""SELECT ID, METRIC, UNIT, {t(f"date_trunc('{part}', STARTTIME)", 'START')},
      {n('sum(VALUE)', 'VALUE')} FROM s GROUP BY ID, METRIC, UNIT, date_trunc('{part}', STARTTIME)"""


_GRADES = """
  , diet AS (
  SELECT ID, round(round(coalesce(avg(DIETARY_ENERGY), 0) - coalesce(avg(ACTIVE_ENERGY_BURNED), 0), 9), 4) AS CAL_DIFF,
    round(round(coalesce(avg(SUGAR), 0), 9), 4) AS SUGAR
  FROM sums JOIN days USING (DATE)
  WHERE coalesce(""" + ", ".join(c for c, _ in DAILY_SUMS) + """) IS NOT NULL GROUP BY ID)
  SELECT CAST(GRADE AS BIGINT) AS GRADE, count(*) AS N, CAST(sum(CAST(round(CAL_DIFF) AS INTEGER)) AS BIGINT) AS CAL_DIFF,
    round(sum(SUGAR), 4) AS SUGAR
  FROM (SELECT *, CASE WHEN CAL_DIFF < -40 THEN 1 WHEN CAL_DIFF < -10 THEN 2 WHEN CAL_DIFF < 10 THEN 3
    WHEN CAL_DIFF < 40 THEN 4 ELSE 5 END AS GRADE FROM diet) GROUP BY GRADE"""

def _mixed_units() -> str:
    """One join a metric, as the wide table is defined: units multiply the rows of a day."""
    columns = (("STEPS", "STEPCOUNT"), ("ACTIVE_ENERGY_BURNED", "ACTIVE_ENERGY_BURNED"), ("CARBS", "CARBS"),
               ("PROTEIN", "PROTEIN"), ("BODYMASS", "BODYMASS"))
    joins = "\n".join(
        f"""LEFT JOIN (SELECT DISTINCT ID, DATE, v AS {c} FROM (SELECT ID, DATE, UNIT, sum(VALUE) AS v FROM m
          WHERE METRIC = '{f}' GROUP BY ALL)) USING (ID, DATE)""" for c, f in columns)
    return f""", m AS (
      SELECT CAST(user_id % 5 AS VARCHAR) AS ID, METRIC, value AS VALUE,
        CAST(CASE WHEN METRIC = 'BASALENERGYBURNED' THEN st ELSE {_NY.format('st')} END AS DATE) AS DATE,
        METRIC IN ('STEPCOUNT', 'ACTIVE_ENERGY_BURNED', 'CARBS') AND k % 2 = 1 AS UNIT
      FROM ev WHERE METRIC <> 'BODYMASS'
      UNION ALL
      SELECT ID, 'BODYMASS', VALUE, DATE, false
      FROM (SELECT DISTINCT CAST(CAST(ID AS BIGINT) % 5 AS VARCHAR) AS ID, STARTTIME, ENDTIME, VALUE, DEVICE, DATE
        FROM sd WHERE METRIC = 'BODYMASS'))
      SELECT ID, {d('DATE')}, {', '.join(n(c) for c, _ in columns)}
      FROM (SELECT * FROM (SELECT DISTINCT CAST(user_id % 5 AS VARCHAR) AS ID FROM ev), days)
      {joins}"""


_QUERIES = {
    "steps_daily": f"""SELECT p.ID, {d('p.DATE', 'DATE')}, {n('STEPS')}
      FROM spine p LEFT JOIN sums u ON u.ID = p.ID AND u.DATE = p.DATE""",
    "date_dim": f""", dim AS (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2025-01-03',
        INTERVAL 1 DAY)) AS DATE) AS DATE)
      SELECT {d('dim.DATE', 'DATE')}, {_DIM.replace('DATE)', 'dim.DATE)').replace('DATE,', 'dim.DATE,')},
        {_DIM_END.replace('(DATE)', '(dim.DATE)')}, coalesce(N, 0) AS N,
        round(coalesce(TOTAL, 0), 4) AS TOTAL
      FROM dim LEFT JOIN (SELECT DATE, count(*) AS N, sum(VALUE) AS TOTAL FROM sd GROUP BY DATE) x
        ON x.DATE = dim.DATE""",
    "date_dim_long": f""", dim AS (SELECT CAST(unnest(generate_series(DATE '2015-01-01', DATE '2015-01-01' + 9999,
        INTERVAL 1 DAY)) AS DATE) AS DATE)
      SELECT {d('dim.DATE', 'DATE')}, {_DIM.replace('DATE)', 'dim.DATE)').replace('DATE,', 'dim.DATE,')},
        {_DIM_END.replace('(DATE)', '(dim.DATE)')}, coalesce(N, 0) AS N
      FROM dim LEFT JOIN (SELECT DATE, count(*) AS N FROM sd GROUP BY DATE) x ON x.DATE = dim.DATE""",
    "hour_dim": f""", dim AS (SELECT unnest(generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2025-01-03 23:00:00',
        INTERVAL 1 HOUR)) AS DATE),
      x AS (SELECT date_trunc('hour', STARTTIME) AS T, count(*) AS N FROM s GROUP BY ALL)
      SELECT {t('DATE')}, {_DIM}, hour(DATE) AS HOUR, {_DIM_END}, coalesce(N, 0) AS N
      FROM dim LEFT JOIN x ON x.T = dim.DATE""",
    "population_latest": f"SELECT ID, {big('AGE')}, BLOODTYPE, GENDER, {t('LOADTIME')} FROM pop",
    "dated_pop": f"""SELECT ID, {d('DATE')} FROM pop, (SELECT CAST(unnest(generate_series(
      DATE '2020-01-01', DATE '2025-01-03', INTERVAL 1 DAY)) AS DATE) AS DATE)""",
    "hours_pop": """SELECT ID, strftime(D, '%Y-%m-%d') AS DAY, CAST(24 AS BIGINT) AS HOURS,
      strftime(D, '%Y-%m-%d 00:00:00') AS FIRST, strftime(D, '%Y-%m-%d 23:00:00') AS LAST
      FROM (SELECT DISTINCT ID FROM pop), (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2025-01-03',
        INTERVAL 1 DAY)) AS D)""",
    "extract_measure": f"""SELECT METRIC, ID, {t('STARTTIME')}, {t('ENDTIME')}, {n('VALUE')}, UNIT,
      UUID, DEVICE FROM s WHERE METRIC IN {_list(_MEASURES)}""",
    "extract_food": f"""SELECT METRIC, ID, {n('VALUE')}, UNIT, UUID, DEVICE, {t('STARTTIME')},
      {t('ENDTIME')}, FOODIMAGENAME, FOODMEAL, FOODTYPE, FOODUSDANUMBER
      FROM s WHERE METRIC IN {_list(_FOODS)}""",
    "extract_sleep": f"""SELECT ID, {t('STARTTIME')}, {t('ENDTIME')}, {big('VALUE')}, UNIT, UUID,
      DEVICE, CYCLE, {big('MINS')} FROM sleep""",
    "food_legacy_positions": """SELECT ID, UUID, FOODTYPE AS FOODMEAL, FOODUSDANUMBER AS FOODTYPE,
      FOODMEAL AS FOODUSDANUMBER FROM s WHERE METRIC = 'CARBS'""",
    "heart_rate_unit_norm": f"""SELECT ID, {t('STARTTIME')}, {n('VALUE')}, UNIT, UUID
      FROM s WHERE METRIC = 'HEARTRATE'""",
    "samples_long": f"""SELECT ID, METRIC, {t('STARTTIME')}, {t('ENDTIME')}, {n('VALUE')}, UNIT, UUID,
      DEVICE, {d('STARTTIME', 'DAY')} FROM s""",
    "dedupe_samples": """SELECT METRIC, a.SENT, b.KEPT
      FROM (SELECT METRIC, CAST(sum(CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS SENT
        FROM sent GROUP BY METRIC) a
      JOIN (SELECT METRIC, count(*) AS KEPT FROM s GROUP BY METRIC) b USING (METRIC)""",
    "tz_convert": f"SELECT event_id, {t('st', 'UTC')}, {t(_NY.format('st'), 'LOCAL')} FROM ev",
    "sleep_minutes": """SELECT event_id, date_diff('minute', ts,
      ts + to_seconds(CAST(floor(value * 60) AS BIGINT))) AS MINS FROM ev""",
    "device_filter": f"""SELECT ID, DEVICE, count(*) AS N, {big('sum(MINS)', 'MINS')}
      FROM sleep GROUP BY ID, DEVICE""",
    "legacy_weight_text": f"""SELECT ID, {t('st', 'DATE')}, {n('value', 'VALUE')}, 'lb' AS UNIT,
      'U' || event_id AS UUID, '"Scale App"' AS APP, 'iPhone14,2' AS DEVICE, 'X' || k AS EXTERNALUUID
      FROM sent""",
    "framed_documents": f"""SELECT ID, CAST(20 + user_id % 50 +
        CASE WHEN DATE > DATE '2024-01-15' THEN 1 ELSE 0 END AS BIGINT) AS AGE,
      {t('DATE + INTERVAL 1 DAY + to_hours(CAST(h AS INTEGER))', 'LOADTIME')},
      CAST(2 * count(DISTINCT block) AS BIGINT) AS DOCUMENTS, CAST(2 * count(*) AS BIGINT) AS ELEMENTS
      FROM (SELECT ID, user_id, CAST(st AS DATE) AS DATE, event_id // 4096 AS block,
        unnest(CASE WHEN user_id % 3 = 0 THEN [4, 5] ELSE [4] END) AS h FROM sent)
      GROUP BY ID, user_id, DATE, h""",
    "upload_backlog": f"""SELECT ID, CAST(20 + user_id % 50 +
        CASE WHEN DATE > DATE '2024-01-15' THEN 1 ELSE 0 END AS BIGINT) AS AGE,
      {t('DATE + INTERVAL 1 DAY + to_hours(CAST(h AS INTEGER))', 'LOADTIME')},
      CAST(2 * count(DISTINCT block) AS BIGINT) AS DOCUMENTS
      FROM (SELECT ID, user_id, CAST(st AS DATE) AS DATE, event_id // 4096 AS block,
        unnest(CASE WHEN user_id % 3 = 0 THEN [4, 5] ELSE [4] END) AS h FROM sent)
      GROUP BY ID, user_id, DATE, h""",
    "rejected_uploads": """, fate AS (
      SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'malformed' WHEN user_id % 11 = 0 THEN 'no identifier'
        WHEN user_id % 13 = 0 THEN 'empty' ELSE 'accepted' END AS REASON
      FROM (SELECT DISTINCT user_id FROM ev))
      SELECT REASON, CAST(sum(CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS N
      FROM (SELECT DISTINCT user_id, CAST(st AS DATE) AS DATE, event_id // 4096 AS block FROM sent) JOIN fate USING (user_id)
      GROUP BY REASON
      UNION ALL SELECT 'samples', count(*) FROM s JOIN fate ON CAST(user_id AS VARCHAR) = ID WHERE REASON = 'accepted'""",
    "device_side_split": f"""SELECT e.event_type || ' ' || s.k AS PLAIN, {t('s.st', 'SENT')}, s.event_id,
      {n('s.value', 'VALUE')}, 'count/s' AS UNIT, ID, '10001' AS ZIP FROM sent s JOIN events e USING (event_id)""",
    "calendar_age": """SELECT o_orderkey, CAST(date_diff('year', CAST(o_orderdate AS DATE), DATE '2024-02-28')
      - CASE WHEN month(o_orderdate) * 100 + day(o_orderdate) > 228 THEN 1 ELSE 0 END AS BIGINT) AS AGE
      FROM orders""",
    "daily_sum": f"""SELECT ID, {d('DATE')}, UNIT, {n('sum(VALUE)', 'VALUE')} FROM sd
      WHERE METRIC = 'ACTIVE_ENERGY_BURNED' GROUP BY ID, DATE, UNIT""",
    "mixed_units": f"""SELECT ID, {d('DATE')}, 'STEPCOUNT' AS METRIC, min(UNIT) AS FIRST_UNIT,
      max(UNIT) AS LAST_UNIT FROM sd GROUP BY ID, DATE HAVING min(UNIT) <> max(UNIT)""",
    "daily_wide_pivot": _WIDE,
    "daily_wide_joins": _WIDE,
    "hourly_zero_fill": f"""SELECT h.ID, {t('h.T', 'DATE')}, {n('coalesce(x.V, 0)', 'VALUE')}
      FROM hrs h LEFT JOIN (SELECT ID, date_trunc('hour', STARTTIME) AS T, sum(VALUE) AS V FROM s
        WHERE METRIC = 'STEPCOUNT' GROUP BY ALL) x ON x.ID = h.ID AND x.T = h.T""",
    "hourly_array": f"""SELECT h.ID, {d('h.DATE', 'DATE')}, hour(h.T) AS POS, {t('h.T', 'T')},
      {n('coalesce(x.V, 0)', 'val')}
      FROM hrs h LEFT JOIN (SELECT ID, date_trunc('hour', STARTTIME) AS T, sum(VALUE) AS V FROM s
        WHERE METRIC = 'BASALENERGYBURNED' GROUP BY ALL) x ON x.ID = h.ID AND x.T = h.T""",
    "raw_series_array": f"""SELECT ID, {d('DATE')}, CAST(0 AS BIGINT) AS PART,
      row_number() OVER (PARTITION BY ID, DATE ORDER BY STARTTIME, VALUE) - 1 AS POS,
      {t('STARTTIME', 'T')}, {n('VALUE', 'val')} FROM sd WHERE METRIC = 'ENVIRONMENTAUDIO'""",
    "hr_hourly_distinct": f"""SELECT ID, {d('DATE')}, CAST(0 AS BIGINT) AS PART,
      row_number() OVER (PARTITION BY ID, DATE ORDER BY T, V) - 1 AS POS, {t('T')}, {n('V', 'val')}
      FROM hr""",
    "sleep_nightly": f"SELECT ID, {d('DATE')}, {big('SLEEP')} FROM nightly",
    "sleep_segments": f"""SELECT ID, {d('DATE')},
      row_number() OVER (PARTITION BY ID, DATE ORDER BY T, CYCLE) - 1 AS POS, {t('T')},
      {dbl('val')}, CYCLE AS cycle FROM seg WHERE CYCLE IS NOT NULL""",
    "sleep_hour_normalised": _normalised("ceil(total / 60.0)"),
    "sleep_hour_keep_tail": _normalised("CASE WHEN total = 0 THEN 0 ELSE ceil((m0 + total) / 60.0) END"),
    "sleep_timeline": f"""SELECT ID, {t('T', 'STARTTIME')}, {big('val', 'SLEEP')}, CYCLE,
      {d('DATE', 'DAY')} FROM seg, rng WHERE DATE BETWEEN r1 AND r2""",
    "sleep_minute_strip": f"""SELECT ID, CAST(off + i AS BIGINT) AS X, {d('DATE', 'Y')}, CYCLE AS "Cat"
      FROM (SELECT *, unnest(range(1, CAST(val AS BIGINT) + 1)) AS i FROM (
        SELECT ID, DATE, CYCLE, val, sum(val) OVER (PARTITION BY ID, DATE ORDER BY T, CYCLE
          ROWS UNBOUNDED PRECEDING) - val AS off FROM seg, rng WHERE DATE BETWEEN r1 AND r2))""",
    "energy_daily": f"""SELECT ID, {d('TIME')}, {n('CONSUMED')}, {n('ACTIVE_ENERGY')},
      {n('BASAL_ENERGY')} FROM energy""",
    "energy_history_10d": _history("ACTIVE_ENERGY", "BASAL_ENERGY", "CONSUMED"),
    "energy_history_legacy": _history("CONSUMED", "ACTIVE_ENERGY", "BASAL_ENERGY"),
    "energy_history_window": _history("ACTIVE_ENERGY", "BASAL_ENERGY", "CONSUMED"),
    "pop_agg": _POP_AGG,
    "pop_agg_run_date": f"""SELECT ID, {t('CAST(z AS TIMESTAMP)', 'RUN_DATE')},
      CAST(z - a + 1 AS BIGINT) AS N, (SELECT count(DISTINCT date_trunc('month', DATE)) FROM days) AS MONTHS
      FROM (SELECT DISTINCT ID FROM pop), cal""",
    "pop_agg_bucketed": _POP_AGG,
    "clustered_fact": f"""SELECT ID, {t('STARTTIME')}, {n('VALUE')}, UNIT, UUID FROM sd, rng
      WHERE METRIC = 'HEARTRATE' AND DATE BETWEEN r1 AND r2""",
    "pop_agg_mixed_units": _mixed_units(),
    "full_refresh": _POP_AGG,
    "incremental_refresh": _POP_AGG,
    "many_small_batches": _POP_AGG,
    "upload_stream_refresh": _POP_AGG,
    "refresh_restarted_checkpoint": _POP_AGG,
    "pop_agg_in_parts": _POP_AGG,
    "macro_calories_in_parts": f"SELECT ID, {d('date')}, Protein, Carbs, Fat FROM macros",
    "trend_user": f"""SELECT ID, {d('DATE')}, {big('AGE')}, {n('STEPS')}, {dbl('SLEEP')}, {n('CARBS')}
      FROM tr WHERE ID = (SELECT min(ID) FROM pop)""",
    "trend_slice": f"""SELECT ID, {d('DATE')}, {big('AGE')}, GENDER, BLOODTYPE, {n('STEPS')},
      {dbl('SLEEP')}, {n('CARBS')} FROM tr""",
    "kpi_averages": f"""SELECT ID, {dbl('min_by(AGE, DATE)', 'AGE')}, min(GENDER) AS GENDER,
      min(BLOODTYPE) AS BLOODTYPE, {_trunc('avg(BODYMASS)', 'WEIGHT')}, {_trunc('avg(STEPS)', 'STEPS')},
      {_trunc('avg(EXERCISE_TIME)', 'EXERCISE_MINS')}, {_trunc('avg(APPLE_STAND_TIME) / 60', 'STAND_MINS')},
      {_trunc('avg(FLIGHTSCLIMBED)', 'FLIGHTS')}, {_trunc('avg(ACTIVE_ENERGY_BURNED)', 'ACTIVE_ENERGY')},
      {_trunc('avg(BASAL_ENERGY_BURNED)', 'BASAL_ENERGY')},
      {_trunc('avg(ACTIVE_ENERGY_BURNED + BASAL_ENERGY_BURNED)', 'CALS_BURNED')},
      {_trunc('avg(DIETARY_ENERGY)', 'CALS_CONSUMED')},
      round_even(round(avg(SLEEP) / 60, 9), 2) AS SLEEP_HOURS FROM tr GROUP BY ID""",
    "kpi_nutrition": f"""SELECT ID, {_trunc('avg(CARBS)', 'CARBS_G')}, {_trunc('avg(PROTEIN)', 'PROTEIN_G')},
      {_trunc('avg(FATTOTAL)', 'FAT_G')}, {_trunc('avg(SODIUM) * 1000', 'SODIUM_MG')},
      {_trunc('avg(SUGAR)', 'SUGAR_G')} FROM tr GROUP BY ID""",
    "macro_calories": f"SELECT ID, {d('date')}, Protein, Carbs, Fat FROM macros",
    "burned_calories": f"SELECT ID, {d('date')}, Basal, Active FROM burned",
    "melt_macros": f"""SELECT ID, {d('date')}, v AS variable, CASE v WHEN 'Protein' THEN Protein
      WHEN 'Carbs' THEN Carbs ELSE Fat END AS value
      FROM macros, (SELECT unnest(['Protein', 'Carbs', 'Fat']) AS v)""",
    "calories_long": """, long AS (
      SELECT ID, date, 'Protein' AS variable, Protein AS value FROM macros
      UNION ALL SELECT ID, date, 'Carbs', Carbs FROM macros
      UNION ALL SELECT ID, date, 'Fat', Fat FROM macros
      UNION ALL SELECT ID, date, 'Basal', Basal FROM burned
      UNION ALL SELECT ID, date, 'Active', Active FROM burned)
      SELECT ID, strftime(date, '%b %d') AS monthdate, variable,
        round(sum(round_even(round(value / 1000, 9), 1)), 4) AS value
      FROM long GROUP BY ID, strftime(date, '%b %d'), variable""",
    "chart_ceiling": f"""SELECT ID, round(round(greatest(max(ACTIVE_ENERGY_BURNED + BASAL_ENERGY_BURNED),
      max({EV('PROTEIN')} * 4 + {EV('CARBS')} * 4 + {EV('FATTOTAL')} * 9)) / 1000, 9), 4) AS CEILING
      FROM tr GROUP BY ID""",
    "weight_domain": f"""SELECT ID, {n('min(BODYMASS)', 'LOW')}, {n('max(BODYMASS)', 'HIGH')}
      FROM tr GROUP BY ID""",
    "calorie_balance": f""", bal AS (
      SELECT ID, trunc(coalesce(sum({EV('PROTEIN')} * 4), 0) + coalesce(sum({EV('CARBS')} * 4), 0)
          + coalesce(sum({EV('FATTOTAL')} * 9), 0))
        - trunc(coalesce(sum({EV('BASAL_ENERGY_BURNED')}), 0)
          + coalesce(sum({EV('ACTIVE_ENERGY_BURNED')}), 0)) AS diff FROM tr GROUP BY ID)
      SELECT ID, CAST(diff AS BIGINT) AS CAL_DIFF, CASE WHEN diff < 0 THEN 'lose' ELSE 'gain' END AS DIRECTION,
        CAST(abs(floor(3500 / nullif(trunc(round(diff / 21, 9)), 0))) AS DOUBLE) AS DAYS_PER_POUND FROM bal""",
    "heart_kpis": _HEART,
    "heart_points": f"""SELECT DISTINCT ID, {d('DATE + 1', 'DATE')}, CAST(round(round(VALUE, 9)) AS BIGINT) AS HR
      FROM sd, rng WHERE METRIC = 'HEARTRATE' AND STARTTIME BETWEEN r1 AND r2""",
    "heart_domain": """SELECT ID, CAST(min(round(round(VALUE, 9))) AS BIGINT) AS LOW,
      CAST(max(round(round(VALUE, 9))) AS BIGINT) AS HIGH
      FROM sd, rng WHERE METRIC = 'HEARTRATE' AND STARTTIME BETWEEN r1 AND r2 GROUP BY ID""",
    "heart_domain_end_day": """SELECT ID, CAST(min(round(round(VALUE, 9))) AS BIGINT) AS LOW,
      CAST(max(round(round(VALUE, 9))) AS BIGINT) AS HIGH
      FROM sd, rng WHERE METRIC = 'HEARTRATE' AND DATE BETWEEN r1 AND r2 GROUP BY ID""",
    "meal_calories": f"""SELECT ID, {d('DATE')}, strftime(STARTTIME, '%H:%M:%S') AS TIME,
      {n('sum(VALUE)', 'CALS')} FROM sd WHERE METRIC = 'DIETARYENERGY' AND VALUE > 0
      GROUP BY ID, DATE, strftime(STARTTIME, '%H:%M:%S')""",
    "meal_calories_top": """SELECT ID, strftime(DATE, '%Y-%m-%d') AS DATE, TIME, round(CALS, 4) AS CALS
      FROM (SELECT ID, DATE, strftime(STARTTIME, '%H:%M:%S') AS TIME, sum(VALUE) AS CALS FROM sd
        WHERE METRIC = 'DIETARYENERGY' AND VALUE > 0 GROUP BY ALL)
      ORDER BY ID, DATE, TIME LIMIT 10""",
    "today_total": f"""SELECT ID, {n('sum(VALUE)', 'VALUE')} FROM sd, cal
      WHERE METRIC = 'STEPCOUNT' AND DATE = a + 10 GROUP BY ID""",
    "latest_sample": f"""SELECT ID, METRIC, {t('STARTTIME')}, {t('ENDTIME')}, {n('VALUE')}, UNIT, UUID,
      DEVICE FROM s QUALIFY row_number() OVER (PARTITION BY ID, METRIC
        ORDER BY STARTTIME DESC, ENDTIME DESC, VALUE DESC, UNIT DESC, UUID DESC, DEVICE DESC) = 1""",
    "sql_query": f"SELECT ID, {d('DATE')}, {n('STEPS')} FROM tr WHERE STEPS > 100",
    "published_versions": f"""SELECT ID, {d('DATE')}, UNIT, {n('sum(VALUE)', 'VALUE')} FROM sd
      WHERE METRIC = 'STEPCOUNT' GROUP BY ID, DATE, UNIT""",
    "graded_csv": _GRADES,
    "diet_grade_predict": _GRADES[: _GRADES.index("  SELECT CAST(GRADE")] + """
  SELECT CASE WHEN SUGAR > 50 THEN 'SWEET' ELSE 'NEUTRAL' END AS DIET_NAME, count(*) AS N,
    count(DISTINCT CASE WHEN CAL_DIFF < -40 THEN 1 WHEN CAL_DIFF < -10 THEN 2 WHEN CAL_DIFF < 10 THEN 3
      WHEN CAL_DIFF < 40 THEN 4 ELSE 5 END) AS GRADES,
    round(sum(CAL_DIFF), 2) AS CAL_DIFF, true AS KNOWN, true AS ACCURATE, true AS SAME
  FROM diet GROUP BY SUGAR > 50""",
    "diet_grade_held_out": _GRADES[: _GRADES.index("  SELECT CAST(GRADE")] + """
  SELECT 'ALL' AS MODEL_NAME, count(*) AS N, true AS DEALT, CASE WHEN count(*) >= 100 THEN true END AS ACCURATE
  FROM diet""",
    "landing_change_stream": f"""SELECT x.*, UPLOADS FROM ({_stream("day")}) x JOIN (
      SELECT ID, CAST(sum(CASE WHEN user_id % 3 = 0 THEN 4 ELSE 2 END) AS BIGINT) AS UPLOADS
      FROM (SELECT DISTINCT ID, user_id, CAST(st AS DATE) AS DATE, event_id // 4096 AS block FROM sent) GROUP BY ID) u
      USING (ID)""",
    "stream_late_totals": _stream("day"),
    "stream_restarted_totals": _stream("day"),
    "stream_daily_totals": _stream("day"),
    "stream_hourly_totals": _stream("hour"),
    "stream_dedupe": f"SELECT METRIC, count(*) AS KEPT, {n('sum(VALUE)', 'TOTAL')} FROM s GROUP BY METRIC",
}


_QUERIES |= {"fetched_meals": _QUERIES["meal_calories_top"], "scanned_table": _QUERIES["population_latest"]}


def oracle_sql() -> dict[str, str]:
    return {name: BASE + sql for name, sql in _QUERIES.items()}
