"""SQL with the same result as each query, for a check against another engine."""

from itertools import combinations_with_replacement

from towerlens import fixed
from towerlens.plans.queries import CHANNEL_SHARE, CHANNELS, INFINITE, MAX_SHARE, MIN_DISTINCT, OFF_GRID, PAIR
from towerlens.sources.standins import kpi_select_list

COUNTED = [c for columns in fixed.SCORED_BY_LAYER.values() for c in columns]


def kpi(cell: str = "l_suppkey") -> str:
    return (
        "kpi AS (SELECT strftime(l_shipdate, '%d.%m') AS T_DATE, CAST(l_shipdate AS DATE) AS KPI_DATE,"
        f" {cell} AS CELL_LAC_ID, l_orderkey * 10 + l_linenumber AS ROW_ID, "
        + ", ".join(kpi_select_list())
        + " FROM lineitem)"
    )


COUNTS = (
    "counts AS (SELECT CELL_LAC_ID, "
    + ", ".join(f"count({c}) AS {c}" for c in COUNTED)
    + " FROM kpi GROUP BY CELL_LAC_ID)"
)
SCORES = (
    "scores AS (SELECT CELL_LAC_ID, "
    + ", ".join(f'greatest({", ".join(c)}) AS "{g}"' for g, c in fixed.SCORED_BY_LAYER.items())
    + " FROM counts)"
)
GEN = """gen AS (SELECT CELL_LAC_ID, CASE WHEN "2G" >= "3G" AND "2G" >= "4G" THEN '2G'
  WHEN "3G" >= "4G" THEN '3G' ELSE '4G' END AS GEN FROM scores)"""
TO_SCORES = f"{kpi()}, {COUNTS}, {SCORES}"
TO_GEN = f"{TO_SCORES}, {GEN}"
SMALL_TO_SCORES = f"{kpi('l_orderkey')}, {COUNTS}, {SCORES}"
N_GROUPS = '("2G" > 0)::INT + ("3G" > 0)::INT + ("4G" > 0)::INT'
SESSIONS = """sessions AS (SELECT user_id AS SK_ID,
  CAST(json_extract_string(props, '$.k') AS BIGINT) + 5 AS CELL_LAC_ID,
  strftime(ts, '%d.%m %H') AS START_TIME, value AS DATA_VOL_MB FROM events)"""
VOICE = """voice AS (SELECT o_custkey AS SK_ID, l_suppkey AS CELL_LAC_ID,
  strftime(l_shipdate, '%d.%m %H') AS START_TIME, l_quantity AS VOICE_MIN
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
FEATURES = """features AS (SELECT o_custkey AS SK_ID, strftime(o_orderdate, '%d.%m.%y') AS SNAP_DATE,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS MONTH, CAST(o_orderdate AS DATE) AS SNAP,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END END AS INTERNET_TYPE_ID,
  o_totalprice AS REVENUE, o_orderkey AS SNAP_ID FROM orders)"""
PHONE = "CASE INTERNET_TYPE_ID WHEN 1 THEN '3G' WHEN 2 THEN '4G' WHEN 3 THEN '2G' END"
USAGE = """consumption AS (SELECT o_custkey AS SK_ID, l_suppkey AS CELL_LAC_ID,
  '01.' || strftime(l_shipdate, '%m') AS MON, CAST(date_trunc('month', l_shipdate) AS DATE) AS MONTH,
  l_quantity AS SUM_MINUTES, l_extendedprice AS SUM_DATA_MB, l_quantity * l_discount AS SUM_DATA_MIN
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
ANSWERS = "answers AS (SELECT c_custkey AS SK_ID, CAST(c_acctbal < 0 AS INT) AS CSI FROM customer)"
SCORED = """scored AS (SELECT c_custkey AS SK_ID, floor(c_acctbal / 100) / 1000 AS SCORE,
  CAST(c_mktsegment = 'BUILDING' AS INT) AS CSI, -c_custkey AS POSITION FROM customer)"""
SLOT = "CAST(('0x' || substr(md5(CAST(SK_ID AS VARCHAR)), 1, 8)) AS BIGINT) % 100"
SUMMARY = f"""summary AS (SELECT SK_ID, count(*) AS CNT_MONTHS, avg(REVENUE) AS AVG_REVENUE,
  first(PHONE_GEN ORDER BY SNAP DESC, SNAP_ID DESC) FILTER (WHERE PHONE_GEN IS NOT NULL) AS PHONE_GEN
  FROM (SELECT *, {PHONE} AS PHONE_GEN FROM features) GROUP BY SK_ID)"""


def traffic(name: str, table: str, volume: str, volume_name: str) -> str:
    measures = []
    for layer in fixed.LAYERS:
        mine = f"FILTER (WHERE GEN = '{layer}')"
        measures += [
            f'coalesce(sum({volume}) {mine}, 0.0) AS "{volume_name}_{layer}"',
            f'count(DISTINCT substr(START_TIME, 1, 5)) {mine} AS "CNT_DAYS_{layer}"',
            f'count(DISTINCT START_TIME) {mine} AS "CNT_HOURS_{layer}"',
        ]
    return (
        f"{name} AS (SELECT SK_ID, {', '.join(measures)}"
        f" FROM {table} JOIN gen USING (CELL_LAC_ID) GROUP BY SK_ID)"
    )


DATA_TRAFFIC = traffic("traffic", "sessions", "DATA_VOL_MB", "DATA_VOL")
TO_TRAFFIC = f"{TO_GEN}, {SESSIONS}, {DATA_TRAFFIC}"
TO_MART = f"""{TO_TRAFFIC}, {FEATURES}, {SUMMARY}, {ANSWERS},
  mart AS (SELECT * FROM answers JOIN summary USING (SK_ID) JOIN traffic USING (SK_ID))"""


def traffic_columns(volume: str, digits: int) -> str:
    return ", ".join(
        f'round("{volume}_{g}", {digits}) AS "{volume}_{g}", "CNT_DAYS_{g}", CAST("CNT_HOURS_{g}" AS BIGINT)'
        f' AS "CNT_HOURS_{g}"'
        for g in fixed.LAYERS
    )


def layer_rows(layer: str, columns: list[str]) -> str:
    return (
        f"SELECT ROW_ID, T_DATE, CELL_LAC_ID, {', '.join(columns)}"
        f" FROM kpi JOIN gen USING (CELL_LAC_ID) WHERE GEN = '{layer}'"
    )


def kept(layer: str) -> list[str]:
    dropped = {"3G": fixed.MOSTLY_MISSING_3G, "4G": fixed.MOSTLY_MISSING_4G + fixed.FEW_VALUES_4G}
    return [c for c in fixed.KPI_BY_LAYER[layer] if c not in dropped[layer]]


def per_layer(name: str, expression: str) -> str:
    parts = [
        f"SELECT '{c}' AS METRIC, {expression.format(c=c)} AS {name}, '{layer}' AS GEN"
        f" FROM placed WHERE GEN = '{layer}'"
        for layer, columns in fixed.KPI_BY_LAYER.items()
        for c in columns
    ]
    placed = "placed AS (SELECT kpi.*, GEN FROM kpi JOIN gen USING (CELL_LAC_ID))"
    return f"WITH {TO_GEN}, {placed} " + " UNION ALL ".join(parts)


def correlation(layer: str, columns: list[str]) -> str:
    values = ", ".join(
        f"{{'x': '{x}', 'y': '{y}', 'c': CASE WHEN NOT isnan(corr({x}, {y})) THEN corr({x}, {y}) END}}"
        for x, y in combinations_with_replacement(columns, 2)
    )
    return f"""WITH {TO_GEN}, wide AS (SELECT [{values}] AS pairs FROM ({layer_rows(layer, columns)})),
      pairs AS (SELECT unnest(pairs) AS p FROM wide)
      SELECT p.x AS "X", p.y AS "Y", round(p.c, 6) AS CORR FROM pairs
      UNION ALL SELECT p.y, p.x, round(p.c, 6) FROM pairs WHERE p.x <> p.y"""


def null_patterns(groups: dict[str, list[str]]) -> str:
    flags = ", ".join(
        f'CAST({" OR ".join(f"{c} IS NOT NULL" for c in columns)} AS INT) AS "HAS_{layer}"'
        for layer, columns in groups.items()
    )
    names = ", ".join(f'"HAS_{layer}"' for layer in groups)
    return f"WITH {kpi()} SELECT {names}, count(*) AS N FROM (SELECT {flags} FROM kpi) GROUP BY {names}"


def anomalies(threshold: float) -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in fixed.KPI_COLUMNS)
    return f"""{kpi()}, means AS (SELECT CELL_LAC_ID, {means} FROM kpi GROUP BY CELL_LAC_ID),
      long AS (UNPIVOT means ON {", ".join(fixed.KPI_COLUMNS)} INTO NAME METRIC VALUE VALUE),
      usual AS (SELECT METRIC, avg(VALUE) AS mu, stddev_pop(VALUE) AS sd FROM long GROUP BY METRIC),
      anomalies AS (SELECT CELL_LAC_ID, METRIC, VALUE, (VALUE - mu) / sd AS Z
        FROM long JOIN usual USING (METRIC) WHERE sd > 0 AND abs((VALUE - mu) / sd) > {threshold})"""


def histogram(values: str, ctes: str) -> str:
    bins = fixed.HISTOGRAM_BINS
    return f"""WITH {ctes}, v AS ({values}),
      b AS (SELECT CASE WHEN min(x) < max(x) THEN min(x) ELSE min(x) - 0.5 END AS lo,
        CASE WHEN min(x) < max(x) THEN max(x) ELSE max(x) + 0.5 END AS hi FROM v),
      n AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * {bins}) AS INT) + 1, {bins}) AS BIN,
        count(*) AS N FROM v, b GROUP BY 1)
      SELECT CAST(r.BIN AS INT) AS BIN, round(lo + (r.BIN - 1) * ((hi - lo) / {bins}), 6) AS LOWER,
        round(lo + r.BIN * ((hi - lo) / {bins}), 6) AS UPPER, coalesce(n.N, 0) AS N
      FROM (SELECT unnest(range(1, {bins + 1})) AS BIN) r, b LEFT JOIN n ON n.BIN = r.BIN"""


ITEMS = f"{USAGE}, items AS (SELECT SK_ID, count(DISTINCT CELL_LAC_ID) AS N_ITEMS FROM consumption GROUP BY SK_ID)"


def top(measure: str, k: int = fixed.TOP_CELLS) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID
      ORDER BY TOTAL DESC, CELL_LAC_ID) AS PLACE FROM (SELECT SK_ID, CELL_LAC_ID, sum({measure}) AS TOTAL
      FROM consumption WHERE {measure} > 0 GROUP BY SK_ID, CELL_LAC_ID)) WHERE PLACE <= {k}"""


def top_cells(measure: str) -> str:
    return f"""WITH {USAGE} SELECT SK_ID, CELL_LAC_ID, round(TOTAL, 4) AS TOTAL,
      CAST(PLACE AS INT) AS PLACE FROM ({top(measure)})"""


def mean_by_code(on: str, month: str = "TRUE") -> str:
    return f"""WITH {FEATURES}, {USAGE}, last AS (SELECT max(MONTH) AS last_month FROM features)
      SELECT INTERNET_TYPE_ID, round(avg(SUM_DATA_MB), 4) AS MEAN, count(SUM_DATA_MB) AS N
      FROM features f JOIN consumption c USING ({on}) WHERE INTERNET_TYPE_ID IS NOT NULL AND {month}
      GROUP BY INTERNET_TYPE_ID"""


MEAN_BY_CODE = mean_by_code("SK_ID, MONTH")
LAST_MONTH = "f.MONTH = (SELECT last_month FROM last) AND c.MONTH = (SELECT last_month FROM last)"


def auc(by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    partition = f"PARTITION BY {by}" if by else ""
    comma = f"{by}, " if by else ""
    split = f"CASE WHEN {SLOT} < 40 THEN 'preliminary' ELSE 'final' END AS SCORING"
    return f"""WITH {SCORED}, s AS (SELECT *, {split} FROM scored),
      m AS (SELECT {comma}SCORE, sum(CSI) AS pos, sum(1 - CSI) AS neg FROM s GROUP BY {comma}SCORE),
      r AS (SELECT *, coalesce(sum(neg) OVER ({partition} ORDER BY SCORE
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM m)
      SELECT {comma}CAST(sum(pos) AS BIGINT) AS N_POSITIVE, CAST(sum(neg) AS BIGINT) AS N_NEGATIVE,
        round(sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS AUC
      FROM r {group}"""


def spark_type(place: int) -> str:
    return {0: "string", 1: "date", 2: "bigint", 3: "bigint"}.get(place, "double")


def table_profile() -> str:
    columns = ["T_DATE", "KPI_DATE", "CELL_LAC_ID", "ROW_ID", *fixed.KPI_COLUMNS]
    parts = [
        f"SELECT {place} AS POSITION, '{c}' AS METRIC, '{spark_type(place)}' AS DTYPE,"
        f" count({c}) AS NON_NULL FROM kpi"
        for place, c in enumerate(columns)
    ]
    return f"WITH {kpi()} " + " UNION ALL ".join(parts)


def filled(metric: str) -> str:
    return (
        f"floor(({OFF_GRID} + coalesce({metric}, avg({metric}) OVER (PARTITION BY CELL_LAC_ID, isodow(KPI_DATE) >= 6),"
        f" avg({metric}) OVER (PARTITION BY CELL_LAC_ID))) * 1e6 + 0.5) / 1e6 AS {metric}"
    )


def named(columns: list[str]) -> str:
    """Names of the columns that hold a value, and how many they are."""
    has = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '{c}' END" for c in columns)
    return f"concat_ws(',', {has}) AS FILLED, CAST({' + '.join(f'({c} IS NOT NULL)::INT' for c in columns)} AS INT) AS N_FILLED"


def patterns_by_layer() -> str:
    parts = " UNION ALL ".join(
        f"SELECT GEN, FILLED, N_FILLED, count(*) AS N FROM (SELECT GEN, {named(columns)} FROM placed WHERE GEN = '{layer}') GROUP BY ALL"
        for layer, columns in fixed.KPI_BY_LAYER.items()
    )
    return f"WITH {TO_GEN}, {PLACED} {parts}"


def missing_together(columns: list[str]) -> str:
    pairs = ", ".join(
        f"{{'X': '{x}', 'Y': '{y}', 'mx': count(*) FILTER ({x} IS NULL), 'my': count(*) FILTER ({y} IS NULL),"
        f" 'b': count(*) FILTER ({x} IS NULL AND {y} IS NULL)}}"
        for i, x in enumerate(columns)
        for y in columns[i + 1 :]
    )
    return f"""WITH {kpi()}, pairs AS (SELECT unnest([{pairs}]) AS p FROM kpi)
      SELECT p.X AS "X", p.Y AS "Y", p.mx AS MISSING_X, p.my AS MISSING_Y, p.b AS MISSING_BOTH,
        round(p.b / nullif(p.mx + p.my - p.b, 0)::DOUBLE, 6) AS OVERLAP FROM pairs"""


def cell_fences() -> str:
    means = ", ".join(f"floor(avg({c}) * 1e4 + 0.5) / 1e4 AS {c}" for c in fixed.KPI_COLUMNS)
    parts = " UNION ALL ".join(
        f"SELECT GEN, '{c}' AS METRIC, count({c}) AS N, quantile_disc({c}, 0.25) AS Q1, quantile_disc({c}, 0.75) AS Q3"
        f" FROM means WHERE GEN = '{layer}' GROUP BY GEN HAVING count({c}) > 0"
        for layer, columns in fixed.KPI_BY_LAYER.items()
        for c in columns
    )
    return f"""{TO_GEN}, means AS (SELECT * FROM (SELECT CELL_LAC_ID, {means} FROM kpi GROUP BY CELL_LAC_ID) JOIN gen USING (CELL_LAC_ID)),
      fences AS (SELECT *, Q1 - 1.5 * (Q3 - Q1) AS LOWER, Q3 + 1.5 * (Q3 - Q1) AS UPPER FROM ({parts}))"""


def fences_hold() -> str:
    parts = " UNION ALL ".join(
        f"SELECT GEN, '{c}' AS METRIC, count({c}) AS N FROM placed WHERE GEN = '{layer}' GROUP BY GEN HAVING count({c}) > 0"
        for layer, columns in fixed.KPI_BY_LAYER.items()
        for c in columns
    )
    return f"WITH {TO_GEN}, {PLACED} SELECT *, true AS Q1_HOLDS, true AS Q3_HOLDS FROM ({parts})"


def joint_pair(shrinkage: float = 0.1) -> str:
    one, other = PAIR
    z = ", ".join(f"coalesce(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 0) AS z{i}" for i, c in enumerate(PAIR))
    return f"""WITH {kpi()}, means AS (SELECT CELL_LAC_ID, avg({one}) AS {one}, avg({other}) AS {other} FROM kpi GROUP BY CELL_LAC_ID),
      r AS (SELECT {1 - shrinkage} * coalesce(corr({one}, {other}), 0) AS r FROM means),
      z AS (SELECT CELL_LAC_ID, {one} IS NOT NULL OR {other} IS NOT NULL AS known, {z} FROM means),
      d AS (SELECT CELL_LAC_ID, sqrt((z0 * z0 - 2 * r * z0 * z1 + z1 * z1) / (1 - r * r)) AS d FROM z, r WHERE known)
      SELECT CELL_LAC_ID, round(d, 6) AS DISTANCE FROM d WHERE d > 0"""


def explained_pair() -> str:
    one, other = PAIR
    return f"""WITH {kpi()}, filled AS (SELECT {", ".join(
        f"coalesce({c}, avg({c}) OVER (PARTITION BY CELL_LAC_ID, isodow(KPI_DATE) >= 6),"
        f" avg({c}) OVER (PARTITION BY CELL_LAC_ID)) AS {c}" for c in PAIR)} FROM kpi),
      r AS (SELECT abs(corr({one}, {other})) AS r FROM filled)
      SELECT 1 AS COMPONENT, round(1 + r, 6) AS VARIANCE, round((1 + r) / 2, 6) AS SHARE, round((1 + r) / 2, 6) AS CUMULATED FROM r
      UNION ALL SELECT 2, round(1 - r, 6), round((1 - r) / 2, 6), 1.0 FROM r"""


METRIC_DAYS = f"""{kpi()}, d AS (SELECT CELL_LAC_ID, CAST(try_strptime(T_DATE || '.02', '%d.%m.%y') AS DATE) AS "DATE", DL_VOLUME_LTE FROM kpi),
  days AS (SELECT CELL_LAC_ID, "DATE", count(*) AS N_ROWS, count(DL_VOLUME_LTE) AS N_KNOWN FROM d WHERE "DATE" IS NOT NULL GROUP BY ALL),
  spine AS (SELECT CELL_LAC_ID, CAST(unnest(generate_series(min("DATE"), max("DATE"), INTERVAL 1 DAY)) AS DATE) AS "DATE"
    FROM days GROUP BY CELL_LAC_ID),
  every AS (SELECT CELL_LAC_ID, "DATE", coalesce(N_ROWS, 0) AS N_ROWS, coalesce(N_KNOWN, 0) AS N_KNOWN
    FROM spine LEFT JOIN days USING (CELL_LAC_ID, "DATE"))"""


def one_step() -> str:
    """One Newton step of a logistic model from no weights is a least-squares line through 4 (y - 1/2)."""
    return f"""WITH {TO_MART}, m AS (SELECT SK_ID, CSI, CNT_MONTHS AS x, {SLOT} % 5 AS FOLD FROM mart),
      lines AS (SELECT f.FOLD, regr_slope(4 * (CSI - 0.5), x) AS b, regr_intercept(4 * (CSI - 0.5), x) AS a
        FROM (SELECT unnest(range(5)) AS FOLD) f JOIN m ON m.FOLD <> f.FOLD GROUP BY f.FOLD)
      SELECT SK_ID, CSI, CAST(m.FOLD AS BIGINT) AS FOLD, round(1 / (1 + exp(-(a + b * x))), 6) AS SCORE FROM m JOIN lines USING (FOLD)"""


DAMAGED = """SELECT 'set' || (l_linenumber % 3) AS FOLDER, count(*) AS N_LINES,
  count(*) FILTER (l_orderkey % 7 IN (1, 2, 3)) AS N_DAMAGED, count(*) FILTER (l_orderkey % 7 = 1) AS N_FEW,
  count(*) FILTER (l_orderkey % 7 = 2) AS N_MANY, count(*) FILTER (l_orderkey % 7 = 3) AS N_QUOTES,
  0 AS N_BLANK, CAST(l_linenumber % 3 = 2 AS INT) AS N_OTHER_HEADERS FROM lineitem GROUP BY l_linenumber % 3"""


def channel_rows(layer: str) -> str:
    return f"SELECT CELL_LAC_ID, {', '.join(CHANNELS)} FROM channel JOIN gen USING (CELL_LAC_ID) WHERE GEN = '{layer}'"


def pruned_channel(layer: str) -> str:
    weak = " UNION ALL ".join(
        f"SELECT '{c}' AS METRIC FROM rows HAVING 1 - count({c}) / count(*)::DOUBLE <= {CHANNEL_SHARE} AND count(DISTINCT {c}) >= {MIN_DISTINCT}"
        for c in CHANNELS
    )
    return f"""WITH {TO_GEN}, {CHANNEL}, rows AS ({channel_rows(layer)}), kept AS ({weak}),
      long AS (FROM rows UNPIVOT INCLUDE NULLS (VALUE FOR METRIC IN ({", ".join(CHANNELS)})))
      SELECT CELL_LAC_ID, METRIC, round(VALUE, 6) AS VALUE FROM long WHERE METRIC IN (SELECT METRIC FROM kept)"""


FEATURE_COLUMNS = "SK_ID, SNAP_DATE, INTERNET_TYPE_ID, round(REVENUE, 6) AS REVENUE, SNAP_ID"
CHANNEL = """channel AS (SELECT l_suppkey AS CELL_LAC_ID,
  CASE WHEN l_linenumber > 1 THEN l_quantity END AS CHANNEL_LOAD,
  CASE WHEN l_linestatus = 'O' THEN l_tax END AS CHANNEL_LOSS,
  CASE WHEN l_discount > 0 THEN l_extendedprice END AS CHANNEL_VOLUME FROM lineitem)"""
SMALL_CONFLICTS = f"""WITH {SMALL_TO_SCORES} SELECT CELL_LAC_ID, "2G", "3G", "4G",
  {N_GROUPS} AS N_GROUPS FROM scores WHERE {N_GROUPS}"""

PLACED = "placed AS (SELECT kpi.*, GEN FROM kpi JOIN gen USING (CELL_LAC_ID))"
KEPT = " UNION ALL ".join(
    f"SELECT '{layer}' AS GEN, '{c}' AS METRIC, round(1 - count({c}) / count(*)::DOUBLE, 6) AS SHARE,"
    f" count(DISTINCT {c}) AS N_DISTINCT FROM placed WHERE GEN = '{layer}'"
    f" HAVING 1 - count({c}) / count(*)::DOUBLE <= {MAX_SHARE} AND count(DISTINCT {c}) >= {MIN_DISTINCT}"
    for layer, columns in fixed.KPI_BY_LAYER.items()
    for c in columns
)
# The last label of a day goes to the faster layer where the files have no further column to tell.
FILE_SUMMARY = f"""summary AS (SELECT SK_ID, first(PHONE_GEN ORDER BY SNAP DESC, PHONE_GEN DESC)
  FILTER (WHERE PHONE_GEN IS NOT NULL) AS PHONE_GEN FROM (SELECT *, {PHONE} AS PHONE_GEN FROM features) GROUP BY SK_ID)"""
TO_FILE_MART = f"""{TO_TRAFFIC}, {FEATURES}, {FILE_SUMMARY}, {ANSWERS},
  mart AS (SELECT * FROM answers JOIN summary USING (SK_ID) JOIN traffic USING (SK_ID))"""
SAME_MONTH_MEANS = f"""WITH {FEATURES}, {USAGE} SELECT INTERNET_TYPE_ID, round(avg(SUM_DATA_MB), 4) AS MEAN,
  count(SUM_DATA_MB) AS N FROM features f JOIN consumption c ON f.SK_ID = c.SK_ID AND month(f.MONTH) = month(c.MONTH)
  WHERE INTERNET_TYPE_ID IS NOT NULL GROUP BY INTERNET_TYPE_ID"""
LABELLED = """SELECT INTERNET_TYPE_ID, MEAN, N, ['2G', '3G', '4G'][row_number() OVER
  (ORDER BY MEAN, INTERNET_TYPE_ID)] AS LABEL FROM ({})"""
SORTED_KPI = ", ".join(f"{c} NULLS LAST" for c in fixed.KPI_COLUMNS)


def infinite_correlation() -> str:
    values = []
    for x, y in combinations_with_replacement(INFINITE, 2):
        spoiled = f"count(*) FILTER (WHERE (isinf({x}) OR isinf({y})) AND {x} IS NOT NULL AND {y} IS NOT NULL)"
        known = f"corr({x}, {y}) FILTER (WHERE NOT isinf({x}) AND NOT isinf({y}))"
        values.append(f"{{'x': '{x}', 'y': '{y}', 'c': CASE WHEN {spoiled} = 0 THEN {known} END}}")
    rows = ", ".join(f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in INFINITE.items())
    return f"""WITH wide AS (SELECT [{", ".join(values)}] AS pairs FROM (SELECT {rows} FROM lineitem)),
      pairs AS (SELECT unnest(pairs) AS p FROM wide)
      SELECT p.x AS "X", p.y AS "Y", round(p.c, 6) AS CORR FROM pairs
      UNION ALL SELECT p.y, p.x, round(p.c, 6) FROM pairs WHERE p.x <> p.y"""


def component_pair() -> str:
    one, other = PAIR
    return f"""WITH {kpi()}, filled AS (SELECT ROW_ID, {", ".join(
        f"coalesce({c}, avg({c}) OVER (PARTITION BY CELL_LAC_ID, isodow(KPI_DATE) >= 6),"
        f" avg({c}) OVER (PARTITION BY CELL_LAC_ID)) AS {c}" for c in PAIR)} FROM kpi),
      whole AS (SELECT ROW_ID, {", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in PAIR)} FROM filled),
      z AS (SELECT ROW_ID, {", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in PAIR)} FROM whole),
      s AS (SELECT corr({one}, {other}) AS r FROM z)
      SELECT ROW_ID, round(CASE WHEN r > 0 THEN {one} + {other} ELSE {one} - {other} END / sqrt(2), 4) AS PC1,
        round(CASE WHEN r > 0 THEN {one} - {other} ELSE {one} + {other} END / sqrt(2), 4) AS PC2 FROM z, s"""


ORACLES: dict[str, str] = {
    # cell layers
    "cell_generation": f"WITH {TO_GEN} SELECT * FROM gen",
    "cell_generation_small_cells": f"WITH {SMALL_TO_SCORES}, {GEN} SELECT * FROM gen",
    "coverage_counts": f"WITH {kpi()}, {COUNTS} SELECT * FROM counts",
    "coverage_scores": f"WITH {TO_SCORES} SELECT * FROM scores",
    "coverage_conflicts": f"{SMALL_CONFLICTS} >= 2",
    "coverage_conflicts_and_gaps": f"{SMALL_CONFLICTS} <> 1",
    "shared_cells": f"WITH {SMALL_TO_SCORES} SELECT CELL_LAC_ID FROM scores WHERE {N_GROUPS} >= 2",
    "conflict_rows": f"WITH {SMALL_TO_SCORES} SELECT counts.* FROM counts JOIN scores USING (CELL_LAC_ID)"
    f" WHERE {N_GROUPS} >= 2",
    "transpose_conflicts": " UNION ALL ".join(
        f"""SELECT CELL_LAC_ID, '{g}' AS METRIC, "{g}" AS VALUE FROM ({SMALL_CONFLICTS} >= 2)"""
        for g in fixed.LAYERS
    ),
    "transpose_counts": f"WITH {SMALL_TO_SCORES}, c AS (SELECT counts.* FROM counts JOIN scores USING (CELL_LAC_ID)"
    f" WHERE {N_GROUPS} >= 2) UNPIVOT c ON {', '.join(COUNTED)} INTO NAME METRIC VALUE VALUE",
    "split_3g_large_lookup": f"WITH {TO_GEN} {layer_rows('3G', fixed.KPI_3G)}",
    "split_2g": f"WITH {TO_GEN} {layer_rows('2G', fixed.KPI_2G)}",
    "split_3g": f"WITH {TO_GEN} {layer_rows('3G', fixed.KPI_3G)}",
    "split_4g": f"WITH {TO_GEN} {layer_rows('4G', fixed.KPI_4G)}",
    "null_patterns": null_patterns(fixed.KPI_BY_LAYER),
    "null_pattern_columns": f"WITH {kpi()}, p AS (SELECT {named(fixed.KPI_COLUMNS)} FROM kpi) SELECT FILLED, N_FILLED, count(*) AS N,"
    " round(count(*) / (SELECT count(*) FROM p)::DOUBLE, 6) AS SHARE FROM p GROUP BY FILLED, N_FILLED",
    "null_pattern_columns_by_layer": patterns_by_layer(),
    "frequent_null_patterns": f"WITH {kpi()}, p AS (SELECT {named(fixed.KPI_COLUMNS)} FROM kpi)"
    " SELECT FILLED, N_FILLED, count(*) AS N FROM p GROUP BY FILLED, N_FILLED",
    "missing_together": missing_together(fixed.KPI_4G),
    "null_patterns_scored": null_patterns(fixed.SCORED_BY_LAYER),
    # profiles
    "table_profile": table_profile(),
    "missing_share": per_layer("SHARE", "round(1 - count({c}) / count(*)::DOUBLE, 6)"),
    "distinct_counts": per_layer("N_DISTINCT", "count(DISTINCT {c})"),
    "distinct_counts_hold": per_layer("N_DISTINCT", "count(DISTINCT {c})").replace(" AS GEN", " AS GEN, true AS HOLDS"),
    "kept_columns": f"WITH {TO_GEN}, {PLACED} {KEPT}",
    "pruned_by_threshold_3g": f"WITH {TO_GEN}, {PLACED}, kept AS ({KEPT}), long AS (SELECT ROW_ID, METRIC, VALUE FROM ("
    f"SELECT ROW_ID, {', '.join(fixed.KPI_3G)} FROM placed WHERE GEN = '3G')"
    f" UNPIVOT INCLUDE NULLS (VALUE FOR METRIC IN ({', '.join(fixed.KPI_3G)})))"
    " SELECT ROW_ID, METRIC, round(VALUE, 6) AS VALUE FROM long"
    " WHERE METRIC IN (SELECT METRIC FROM kept WHERE GEN = '3G')",
    "pruned_3g": f"WITH {TO_GEN} {layer_rows('3G', kept('3G'))}",
    "pruned_4g": f"WITH {TO_GEN} {layer_rows('4G', kept('4G'))}",
    "correlation_2g": correlation("2G", fixed.KPI_2G),
    "correlation_3g": correlation("3G", fixed.KPI_3G),
    "correlation_4g": correlation("4G", fixed.KPI_4G),
    "correlation_pruned_3g": correlation("3G", kept("3G")),
    "correlation_pruned_4g": correlation("4G", kept("4G")),
    "metric_history": f"WITH {kpi()} SELECT CELL_LAC_ID, CAST(try_strptime(T_DATE || '.02', '%d.%m.%y')"
    ' AS DATE) AS "DATE", DL_VOLUME_LTE FROM kpi',
    "missing_metric_rows": f"WITH {kpi()} SELECT ROW_ID, T_DATE, CELL_LAC_ID FROM kpi"
    " WHERE DL_VOLUME_LTE IS NULL",
    "presence_flags": f"WITH {kpi()} SELECT ROW_ID, CELL_LAC_ID, "
    + ", ".join(f"CAST({c} IS NOT NULL AS INT) AS HAS_{c}" for c in fixed.KPI_COLUMNS)
    + " FROM kpi",
    "impute_daytype": f"WITH {kpi()} SELECT ROW_ID, KPI_DATE, CELL_LAC_ID,"
    f" {', '.join(map(filled, fixed.KPI_COLUMNS))} FROM kpi",
    "kpi_anomalies": f"WITH {anomalies(2.0)} SELECT CELL_LAC_ID, METRIC, round(Z, 6) AS Z FROM anomalies",
    "kpi_anomaly_counts": f"WITH {anomalies(1.5)} SELECT CELL_LAC_ID, count(*) AS N_METRICS,"
    " round(max(abs(Z)), 6) AS MAX_Z FROM anomalies GROUP BY CELL_LAC_ID HAVING count(*) >= 2",
    "kpi_fences_hold": fences_hold(),
    "cell_fences": f"WITH {cell_fences()} SELECT GEN, METRIC, N, round(Q1, 4) AS Q1, round(Q3, 4) AS Q3, round(LOWER, 4) AS LOWER,"
    " round(UPPER, 4) AS UPPER FROM fences",
    "cells_outside_fences": f"WITH {cell_fences()}, long AS (UNPIVOT (SELECT CELL_LAC_ID, GEN, {', '.join(fixed.KPI_COLUMNS)} FROM means)"
    f" ON {', '.join(fixed.KPI_COLUMNS)} INTO NAME METRIC VALUE VALUE) SELECT CELL_LAC_ID, GEN, METRIC, round(VALUE, 4) AS VALUE"
    " FROM long JOIN fences USING (GEN, METRIC) WHERE VALUE < LOWER OR VALUE > UPPER",
    "joint_anomalies_pair": joint_pair(),
    "metric_days": f"WITH {METRIC_DAYS} SELECT * FROM every",
    "metric_gaps": f"""WITH {METRIC_DAYS}, gaps AS (SELECT *, "DATE" - CAST(row_number() OVER (PARTITION BY CELL_LAC_ID ORDER BY "DATE") AS INT)
      AS run FROM every WHERE N_KNOWN = 0) SELECT CELL_LAC_ID, min("DATE") AS FIRST, max("DATE") AS LAST, count(*) AS N_DAYS,
      count(*) FILTER (N_ROWS = 0) AS N_ABSENT FROM gaps GROUP BY CELL_LAC_ID, run""",
    **{f"channel_split_{layer.lower()}": f"WITH {TO_GEN}, {CHANNEL} {channel_rows(layer)}" for layer in fixed.LAYERS},
    "pruned_channel_3g": pruned_channel("3G"),
    "channel_missing_share": f"WITH {TO_GEN}, {CHANNEL}, placed AS (SELECT channel.*, GEN FROM channel"
    " JOIN gen USING (CELL_LAC_ID)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS METRIC, round(1 - count({c}) / count(*)::DOUBLE, 6) AS SHARE, GEN"
        " FROM placed GROUP BY GEN"
        for c in ("CHANNEL_LOAD", "CHANNEL_LOSS", "CHANNEL_VOLUME")
    ),
    "channel_distinct_counts": f"WITH {TO_GEN}, {CHANNEL}, placed AS (SELECT channel.*, GEN FROM channel"
    " JOIN gen USING (CELL_LAC_ID)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS METRIC, count(DISTINCT {c}) AS N_DISTINCT, GEN FROM placed GROUP BY GEN"
        for c in ("CHANNEL_LOAD", "CHANNEL_LOSS", "CHANNEL_VOLUME")
    ),
    "metric_history_4g": f"""WITH {TO_GEN}, h AS (SELECT CELL_LAC_ID,
      CAST(try_strptime(T_DATE || '.02', '%d.%m.%y') AS DATE) AS "DATE", DL_VOLUME_LTE
      FROM kpi JOIN gen USING (CELL_LAC_ID) WHERE GEN = '4G')
      SELECT *, row_number() OVER (ORDER BY CELL_LAC_ID NULLS LAST, "DATE" NULLS LAST, DL_VOLUME_LTE NULLS LAST) AS PLACE FROM h""",
    "missing_metric_rows_4g": f"WITH {TO_GEN} SELECT ROW_ID, T_DATE, CELL_LAC_ID FROM kpi JOIN gen USING (CELL_LAC_ID)"
    " WHERE GEN = '4G' AND DL_VOLUME_LTE IS NULL",
    "correlation_with_infinities": infinite_correlation(),
    "kpi_components_pair": component_pair(),
    "component_checks": " UNION ALL ".join(
        f"SELECT '{layer}' AS GEN, {len(columns)} AS N_COLUMNS, 0.0::DOUBLE AS VARIANCE_OFF, 0.0::DOUBLE AS CORRELATION,"
        f" {len(columns)}.0::DOUBLE AS VARIANCES"
        for layer, columns in fixed.KPI_BY_LAYER.items()
    ),
    "explained_variance": explained_pair(),
    "separated_clusters": """WITH k AS (SELECT DISTINCT l_suppkey AS CELL_LAC_ID, l_suppkey % 4 AS kind FROM lineitem),
      f AS (SELECT kind, row_number() OVER (ORDER BY min(CELL_LAC_ID)) - 1 AS CLUSTER FROM k GROUP BY kind)
      SELECT CELL_LAC_ID, CAST(CLUSTER AS INT) AS CLUSTER FROM k JOIN f USING (kind)""",
    # phone layers
    "code_frequency": f"WITH {FEATURES} SELECT INTERNET_TYPE_ID, count(*) AS N FROM features"
    " GROUP BY INTERNET_TYPE_ID",
    "code_frequency_last_month": f"WITH {FEATURES} SELECT INTERNET_TYPE_ID, count(*) AS N FROM features"
    " WHERE MONTH = (SELECT max(MONTH) FROM features) GROUP BY INTERNET_TYPE_ID",
    "month_frequency": f"WITH {USAGE} SELECT MON, count(*) AS N FROM consumption GROUP BY MON",
    "mean_by_code": MEAN_BY_CODE,
    "mean_by_code_last_month": mean_by_code("SK_ID", LAST_MONTH),
    "mean_by_code_last_full_month": f"""WITH {FEATURES}, {USAGE},
      codes AS (SELECT DISTINCT MONTH, INTERNET_TYPE_ID FROM features JOIN consumption USING (SK_ID, MONTH)
        WHERE INTERNET_TYPE_ID IS NOT NULL AND SUM_DATA_MB IS NOT NULL),
      last AS (SELECT max(MONTH) AS m FROM (SELECT MONTH, count(*) AS n FROM codes GROUP BY MONTH)
        WHERE n = (SELECT count(DISTINCT INTERNET_TYPE_ID) FROM codes))
      SELECT INTERNET_TYPE_ID, round(avg(SUM_DATA_MB), 4) AS MEAN, count(SUM_DATA_MB) AS N
      FROM features f JOIN consumption c USING (SK_ID) WHERE INTERNET_TYPE_ID IS NOT NULL
        AND f.MONTH = (SELECT m FROM last) AND c.MONTH = (SELECT m FROM last) GROUP BY INTERNET_TYPE_ID""",
    "code_labels_from_files": LABELLED.format(SAME_MONTH_MEANS),
    "phone_generation_derived": f"""WITH {FEATURES}, labelled AS ({LABELLED.format(MEAN_BY_CODE)})
      SELECT SK_ID, SNAP_DATE, MONTH, INTERNET_TYPE_ID, REVENUE, SNAP_ID, LABEL AS PHONE_GEN
      FROM features LEFT JOIN labelled USING (INTERNET_TYPE_ID)""",
    "mean_per_subject": f"""WITH {FEATURES}, {USAGE},
      used AS (SELECT SK_ID, sum(SUM_DATA_MB) AS total FROM consumption GROUP BY SK_ID),
      holders AS (SELECT DISTINCT SK_ID, INTERNET_TYPE_ID FROM features WHERE INTERNET_TYPE_ID IS NOT NULL)
      SELECT INTERNET_TYPE_ID, round(avg(total), 4) AS MEAN, count(*) AS N_SUBJECTS
      FROM holders JOIN used USING (SK_ID) GROUP BY INTERNET_TYPE_ID""",
    "code_labels": f"""SELECT INTERNET_TYPE_ID, MEAN, N, ['2G', '3G', '4G'][row_number() OVER
      (ORDER BY MEAN, INTERNET_TYPE_ID)] AS LABEL FROM ({MEAN_BY_CODE})""",
    "phone_generation": f"WITH {FEATURES} SELECT SK_ID, SNAP_DATE, MONTH, INTERNET_TYPE_ID, REVENUE,"
    f" SNAP_ID, {PHONE} AS PHONE_GEN FROM features",
    # important cells
    "cells_per_subject": f"WITH {ITEMS} SELECT * FROM items",
    "cells_per_subject_hist": histogram("SELECT N_ITEMS::DOUBLE AS x FROM items", ITEMS),
    "cells_per_subject_frequency_hist": histogram(
        "SELECT count(*)::DOUBLE AS x FROM items GROUP BY N_ITEMS", ITEMS
    ),
    "top_cells_minutes": top_cells("SUM_MINUTES"),
    "top_cells_data": top_cells("SUM_DATA_MB"),
    "top_cells_time": top_cells("SUM_DATA_MIN"),
    "rank_disagreement": f"""WITH {USAGE}, a AS ({top('SUM_DATA_MB')}), b AS ({top('SUM_DATA_MIN')})
      SELECT coalesce(a.SK_ID, b.SK_ID) AS SK_ID, count(a.PLACE) AS N_FIRST, count(b.PLACE) AS N_SECOND,
        count(a.PLACE - b.PLACE) AS N_COMMON, round(avg(abs(a.PLACE - b.PLACE)), 6) AS MEAN_GAP,
        CAST(max(abs(a.PLACE - b.PLACE)) AS INT) AS MAX_GAP,
        CAST(max(CASE WHEN a.PLACE = 1 THEN CASE WHEN b.PLACE = 1 THEN 1 ELSE 0 END END) AS INT) AS SAME_TOP
      FROM a FULL JOIN b ON a.SK_ID = b.SK_ID AND a.CELL_LAC_ID = b.CELL_LAC_ID GROUP BY 1""",
    "cell_presence": f"""WITH {SESSIONS}, d AS (SELECT DISTINCT SK_ID, CELL_LAC_ID,
        substr(START_TIME, 1, 5) AS day FROM sessions),
      active AS (SELECT SK_ID, count(DISTINCT day) AS ACTIVE_DAYS FROM d GROUP BY SK_ID)
      SELECT SK_ID, CELL_LAC_ID, count(*) AS N_DAYS, any_value(ACTIVE_DAYS) AS ACTIVE_DAYS,
        round(count(*) / any_value(ACTIVE_DAYS)::DOUBLE, 6) AS SHARE
      FROM d JOIN active USING (SK_ID) GROUP BY SK_ID, CELL_LAC_ID""",
    # exposure to the wrong layer
    "sessions_with_layer": f"WITH {TO_GEN}, {SESSIONS} SELECT CELL_LAC_ID, SK_ID, START_TIME, DATA_VOL_MB,"
    " substr(START_TIME, 1, 5) AS START_DATE, GEN FROM sessions LEFT JOIN gen USING (CELL_LAC_ID)",
    "traffic_by_layer": f"WITH {TO_TRAFFIC} SELECT SK_ID, {traffic_columns('DATA_VOL', 6)} FROM traffic",
    "traffic_by_layer_bitmaps": f"WITH {TO_TRAFFIC} SELECT SK_ID, {traffic_columns('DATA_VOL', 6)} FROM traffic",
    "traffic_by_layer_large_lookup": f"WITH {TO_TRAFFIC} SELECT SK_ID, {traffic_columns('DATA_VOL', 6)} FROM traffic",
    "exposure_from_files": f"""WITH {TO_FILE_MART} SELECT CSI, round(avg("CNT_HOURS_2G"), 6) AS MEAN,
      count(*) AS N FROM mart WHERE PHONE_GEN = '4G' GROUP BY CSI""",
    "voice_by_layer": f"WITH {TO_GEN}, {VOICE}, {traffic('traffic', 'voice', 'VOICE_MIN', 'VOICE_MIN')}"
    f" SELECT SK_ID, {traffic_columns('VOICE_MIN', 6)} FROM traffic",
    "voice_only_subscribers": f"WITH {VOICE} SELECT DISTINCT SK_ID FROM voice"
    " WHERE SK_ID NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)",
    "subject_summary": f"WITH {FEATURES}, {SUMMARY} SELECT SK_ID, CNT_MONTHS,"
    " round(AVG_REVENUE, 6) AS AVG_REVENUE, PHONE_GEN FROM summary",
    "feature_mart": f"WITH {TO_MART} SELECT SK_ID, CSI, CNT_MONTHS, round(AVG_REVENUE, 6) AS AVG_REVENUE,"
    f" PHONE_GEN, {traffic_columns('DATA_VOL', 6)} FROM mart",
    "feature_mart_incremental": f"WITH {TO_MART} SELECT SK_ID, CSI, CNT_MONTHS, round(AVG_REVENUE, 6) AS AVG_REVENUE,"
    f" PHONE_GEN, {traffic_columns('DATA_VOL', 6)} FROM mart",
    "layer_exposure_by_outcome": f"""WITH {TO_MART} SELECT CSI, round(avg("CNT_HOURS_2G"), 6) AS MEAN,
      count(*) AS N FROM mart WHERE PHONE_GEN = '4G' GROUP BY CSI""",
    "wrong_layer_share": f"""WITH {TO_TRAFFIC}, {FEATURES}, {SUMMARY},
      b AS (SELECT SK_ID, PHONE_GEN, CASE PHONE_GEN WHEN '2G' THEN 0.0 WHEN '3G' THEN "DATA_VOL_2G"
        WHEN '4G' THEN "DATA_VOL_2G" + "DATA_VOL_3G" END AS BELOW,
        "DATA_VOL_2G" + "DATA_VOL_3G" + "DATA_VOL_4G" AS total
        FROM traffic JOIN summary USING (SK_ID) WHERE PHONE_GEN IS NOT NULL)
      SELECT SK_ID, PHONE_GEN, round(BELOW, 6) AS BELOW,
        round(CASE WHEN total <> 0 THEN BELOW / total END, 6) AS SHARE FROM b""",
    # scores
    "roc_auc": auc(),
    "auc_by_scoring": auc("SCORING"),
    "scores_in_order": f"WITH {SCORED} SELECT POSITION, SK_ID, SCORE FROM scored",
    "out_of_fold_one_step": one_step(),
    "held_out_scores": f"""WITH {TO_MART}, m AS (SELECT SK_ID, CSI, coalesce(PHONE_GEN = '4G', false) AS flag,
        {SLOT} < 60 AS is_train FROM mart),
      rate AS (SELECT flag, avg(CSI) AS r FROM m WHERE is_train GROUP BY flag),
      test AS (SELECT SK_ID FROM answers WHERE {SLOT} >= 60)
      SELECT row_number() OVER (ORDER BY t.SK_ID DESC) AS PLACE, t.SK_ID, round(r, 4) AS SCORE
      FROM test t LEFT JOIN m ON m.SK_ID = t.SK_ID AND NOT is_train LEFT JOIN rate USING (flag)""",
    # files and rows
    "csv_preview": "WITH " + USAGE + """ SELECT CAST(SK_ID AS VARCHAR) AS SK_ID, CAST(CELL_LAC_ID AS VARCHAR) AS CELL_LAC_ID, MON,
      replace(CAST(SUM_MINUTES AS VARCHAR), '.', ',') AS SUM_MINUTES, replace(CAST(SUM_DATA_MB AS VARCHAR), '.', ',') AS SUM_DATA_MB,
      replace(CAST(SUM_DATA_MIN AS VARCHAR), '.', ',') AS SUM_DATA_MIN
      FROM (FROM consumption ORDER BY consumption.SK_ID, consumption.CELL_LAC_ID, MON, consumption.SUM_MINUTES,
        consumption.SUM_DATA_MB, consumption.SUM_DATA_MIN LIMIT 10)""",
    "csv_preview_bounded": "SELECT least(10, count(*)) AS N_LINES, least(10, count(*)) AS N_IN_TABLE FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "csv_damaged_lines": DAMAGED,
    "csv_typed_scan": f"WITH {USAGE} SELECT SK_ID, CELL_LAC_ID, MON, round(SUM_MINUTES, 6) AS SUM_MINUTES,"
    " round(SUM_DATA_MB, 6) AS SUM_DATA_MB, round(SUM_DATA_MIN, 6) AS SUM_DATA_MIN FROM consumption",
    "csv_parse_failures": "SELECT 'CELL_LAC_ID' AS METRIC, CAST(0 AS BIGINT) AS N_FAILED UNION ALL"
    " SELECT 'CSSR_2G', count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem"
    " UNION ALL SELECT 'PSSR_2G', 0",
    "train_test_features": f"WITH {FEATURES} SELECT {FEATURE_COLUMNS},"
    f" CASE WHEN {SLOT} < 60 THEN 'train' ELSE 'test' END AS SPLIT FROM features",
    "first_rows": f"WITH {FEATURES} SELECT SK_ID, SNAP_DATE, MONTH, INTERNET_TYPE_ID, REVENUE, SNAP_ID"
    " FROM features ORDER BY SK_ID, SNAP_ID LIMIT 5",
    "random_rows": f"WITH {kpi()} SELECT ROW_ID, T_DATE, CELL_LAC_ID FROM kpi"
    f" ORDER BY md5(ROW_ID || '|0'), ROW_ID LIMIT {fixed.SAMPLE_ROWS}",
    "sorted_sample": f"""WITH {kpi()}, s AS (SELECT * FROM kpi ORDER BY md5(ROW_ID || '|0'), ROW_ID LIMIT {fixed.SAMPLE_ROWS})
      SELECT row_number() OVER (ORDER BY {SORTED_KPI}, ROW_ID) AS PLACE, ROW_ID, T_DATE, CELL_LAC_ID FROM s""",
    "sorted_rows": f"WITH {kpi()} SELECT ROW_ID, {', '.join(fixed.KPI_2G)} FROM kpi",
}
