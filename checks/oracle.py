"""The same results in SQL, for DuckDB."""

from __future__ import annotations

from rowmill.sources.delimited import NULL_TOKENS

DIRTY = """
events_dirty AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
         replace(CAST(value AS VARCHAR), '.', ',') AS value_text,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS day_text,
         CAST(user_id AS VARCHAR) AS user_text,
         props
  FROM events)"""

NET = """
lineitem_net AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) AS net,
         CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_quantity END AS qty_null
  FROM lineitem)"""

DIRTY_COLUMNS = [
    "event_id", "ts", "user_id", "event_type", "value", "value_text", "day_text", "user_text",
    "props",
]
DIRTY_TYPES = {
    "event_id": "int64", "ts": "datetime64[ns]", "user_id": "int64", "event_type": "object",
    "value": "float64", "value_text": "object", "day_text": "object", "user_text": "object",
    "props": "object",
}
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NET_COLUMNS = [*LINE_NUMBERS, "net", "qty_null"]

PICKED = {
    "l_orderkey": "int64", "l_partkey": "int64", "l_suppkey": "int64", "l_returnflag": "object",
    "l_linestatus": "object",
}

MISSING_BAND = """CASE WHEN pct < 1 THEN 'trivial' WHEN pct < 5 THEN 'manageable'
  WHEN pct < 15 THEN 'sophisticated' ELSE 'harmful' END"""
OUTLIER_BAND = """CASE WHEN pct = 0 THEN 'none' WHEN pct < 1 THEN 'mild'
  WHEN pct < 5 THEN 'moderate' WHEN pct < 15 THEN 'high' ELSE 'critical' END"""


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def dirty(body: str) -> str:
    return f"WITH {DIRTY.strip()}\n{body}"


def dirty_then(ctes: str, body: str) -> str:
    return f"WITH {DIRTY.strip()},\n{ctes}\n{body}"


def nulls_of(columns) -> str:
    return " + ".join(f"count(CASE WHEN {c} IS NULL THEN 1 END)" for c in columns)


def missing_rows(digits: int) -> str:
    return union(
        f"SELECT '{c}' AS column_, count(CASE WHEN {c} IS NULL THEN 1 END) AS nulls, "
        f"round_even(100.0::DOUBLE * count(CASE WHEN {c} IS NULL THEN 1 END) / count(*), {digits})"
        f" AS pct FROM events_dirty"
        for c in DIRTY_COLUMNS
    )


def report_rows(source: str, types: dict[str, str]) -> str:
    return union(
        f"SELECT '{c}' AS \"column\", '{'num' if t in ('int64', 'float64') else 'cat'}' AS class, "
        f"'{t}' AS dtype, count(DISTINCT {c}) AS \"distinct\", "
        f"count(CASE WHEN {c} IS NULL THEN 1 END) AS nulls FROM {source}"
        for c, t in types.items()
    )


def stats_rows(source: str, columns) -> str:
    return union(
        f"""SELECT '{c}' AS "column", round_even(avg({c}), 3) AS mean,
  round_even(quantile_cont({c}::DOUBLE, 0.25), 3) AS q1,
  round_even(quantile_cont({c}::DOUBLE, 0.5), 3) AS median,
  round_even(quantile_cont({c}::DOUBLE, 0.75), 3) AS q3,
  round_even(min({c}::DOUBLE), 3) AS min, round_even(max({c}::DOUBLE), 3) AS max,
  round_even(max({c}::DOUBLE) - min({c}::DOUBLE), 3) AS range,
  round_even(quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25), 3) AS iqr,
  round_even(var_samp({c}), 3) AS variance, round_even(stddev_samp({c}), 3) AS sd,
  round_even(stddev_samp({c}) / avg({c}), 3) AS cv,
  round_even(skewness({c}), 3) AS skewness, round_even(kurtosis({c}), 3) AS kurtosis,
  count({c}) AS count, round_even(sum({c}::DOUBLE), 3) AS sum FROM {source}"""
        for c in columns
    )


def category_rows(columns) -> str:
    return union(
        f"""SELECT '{c}' AS "column",
  (SELECT count(DISTINCT {c}) FROM events_dirty) AS "distinct",
  (SELECT count(*) FROM events_dirty) AS rows,
  coalesce(v, 'nan') AS mode, n AS mode_count,
  round(n::DOUBLE / (SELECT count(*) FROM events_dirty), 6) AS mode_share
FROM (SELECT {c} AS v, count(*) AS n FROM events_dirty GROUP BY 1
      ORDER BY n DESC, v ASC NULLS LAST LIMIT 1)"""
        for c in columns
    )


def share_rows(source: str, columns, most: int | None = None) -> str:
    parts, few = [], "k >= 2" if most is None else f"k BETWEEN 2 AND {most}"
    for c in columns:
        parts.append(f"""SELECT '{c}' AS "column",
  CASE WHEN {few} THEN v END AS value,
  CASE WHEN {few} THEN n END AS n,
  CASE WHEN {few} THEN round(n::DOUBLE / total, 6) END AS share,
  k AS "distinct",
  CASE WHEN k < 2 THEN 'fewer than 2 values' WHEN NOT ({few}) THEN 'too many values' END AS reason
FROM (SELECT v, n, count(*) OVER () AS k, CAST(sum(n) OVER () AS BIGINT) AS total,
             row_number() OVER (ORDER BY v) AS place
      FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {source}
            WHERE {c} IS NOT NULL GROUP BY 1))
WHERE {few} OR place = 1""")
    return union(parts)


def first_values(c: str) -> str:
    return f"""SELECT '{c}' AS "column",
  (SELECT count(DISTINCT {c}) FROM events_dirty) AS "distinct",
  (SELECT string_agg(v, ', ' ORDER BY seen) FROM (
     SELECT coalesce({c}, 'nan') AS v, min(event_id) AS seen FROM events_dirty
     GROUP BY {c} ORDER BY seen LIMIT 5)) AS "values" """


def moment_rows(source: str, columns, digits: int) -> str:
    return union(
        f"""SELECT '{c}' AS "column", round(avg({c}), {digits}) AS mean,
  round(stddev_samp({c}), {digits}) AS sd, round(min({c}::DOUBLE), {digits}) AS min,
  round(max({c}::DOUBLE), {digits}) AS max FROM {source}"""
        for c in columns
    )


def fences(c: str, source: str) -> str:
    return f"""(SELECT q1, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi
  FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3
        FROM {source}))"""


def iqr_rows(source: str, columns, digits: int) -> str:
    return union(
        f"""SELECT '{c}' AS "column", n, outliers, pct, {OUTLIER_BAND} AS severity, 'IQR' AS method
FROM (SELECT count({c}) AS n, count(CASE WHEN {c} < lo OR {c} > hi THEN 1 END) AS outliers,
        round_even(100.0::DOUBLE * count(CASE WHEN {c} < lo OR {c} > hi THEN 1 END) / count({c}),
                   {digits}) AS pct
      FROM {source}, {fences(c, source)} f)"""
        for c in columns
    )


CLIP = "CASE WHEN value IS NOT NULL THEN round(least(greatest(value, lo), hi), 6) END AS value"


def pairs_of(columns):
    return [(a, b) for a in columns for b in columns]


def covariance_rows(columns) -> str:
    return union(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_samp({a}, {b}), 3) AS covariance "
        f"FROM lineitem_net"
        for a, b in pairs_of(columns)
    )


def pearson_rows(columns, digits: int | None) -> str:
    def r(a, b):
        if a == b:
            return "1.0::DOUBLE AS r"
        value = f"corr({a}, {b})"
        return (value if digits is None else f"round({value}, {digits})") + " AS r FROM lineitem_net"

    return union(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(a, b)}"
        for a, b in pairs_of(columns)
    )


def average_rank(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) "
        f"+ (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE END"
    )


def spearman_rows(columns) -> str:
    return union(
        f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(ra, rb), 6) AS r FROM (
  SELECT {average_rank(a)} AS ra, {average_rank(b)} AS rb FROM (
    SELECT {a}, {b} AS {b}{'_' if a == b else ''} FROM lineitem_net
    WHERE {a} IS NOT NULL AND {b} IS NOT NULL))"""
        if a != b
        else f"SELECT '{a}' AS col_a, '{b}' AS col_b, 1.0::DOUBLE AS r"
        for a, b in pairs_of(columns)
    )


KENDALL = """WITH p AS (
  SELECT c_nationkey::DOUBLE AS x, c_acctbal AS y FROM customer),
s AS (
  SELECT sum(sign(a.x - b.x) * sign(a.y - b.y))::DOUBLE AS s,
         sum(abs(sign(a.x - b.x)))::DOUBLE AS nx, sum(abs(sign(a.y - b.y)))::DOUBLE AS ny
  FROM p a, p b),
t AS (SELECT round(s / (sqrt(nx) * sqrt(ny)), 6) AS r FROM s)
SELECT 'c_nationkey' AS col_a, 'c_nationkey' AS col_b, 1.0::DOUBLE AS r
UNION ALL SELECT 'c_acctbal', 'c_acctbal', 1.0::DOUBLE
UNION ALL SELECT 'c_nationkey', 'c_acctbal', r FROM t
UNION ALL SELECT 'c_acctbal', 'c_nationkey', r FROM t"""


KENDALL_GAPS = {
    "c_nationkey": "c_nationkey::DOUBLE", "c_acctbal": "c_acctbal", "mixed": "(c_custkey * 7919 % 1000)::DOUBLE",
    "gappy": "(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey END)::DOUBLE",
}


def kendall_rows() -> str:
    """Over all ordered pairs of rows that have both values."""
    rows = []
    for a, x in KENDALL_GAPS.items():
        for b, y in KENDALL_GAPS.items():
            if a == b:
                rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, 1.0::DOUBLE AS r")
                continue
            rows.append(f"""SELECT '{a}', '{b}', round(sum(sign(p.x - q.x) * sign(p.y - q.y))::DOUBLE
  / (sqrt(sum(abs(sign(p.x - q.x)))::DOUBLE) * sqrt(sum(abs(sign(p.y - q.y)))::DOUBLE)), 6)
FROM (SELECT {x} AS x, {y} AS y FROM customer WHERE ({x}) IS NOT NULL AND ({y}) IS NOT NULL) p,
  (SELECT {x} AS x, {y} AS y FROM customer WHERE ({x}) IS NOT NULL AND ({y}) IS NOT NULL) q""")
    return union(rows)


def bins_of(source: str, column: str, bins: str, extra: str = "") -> str:
    """bins: an expression in n."""
    return f"""SELECT '{column}' AS "column", g.b::INTEGER AS bin,
  round(lo + g.b * w, 6) AS low,
  round(CASE WHEN g.b = k - 1 THEN hi ELSE lo + (g.b + 1) * w END, 6) AS high,
  count(d.bin) AS n{extra}
FROM (SELECT *, (hi - lo) / k AS w FROM (
        SELECT *, {bins} AS k FROM (
          SELECT min({column}::DOUBLE) AS lo, max({column}::DOUBLE) AS hi, count({column}) AS n
          FROM {source}))) f
JOIN (SELECT unnest(range(50)) AS b) g ON g.b < k
LEFT JOIN (
  SELECT least(floor(({column} - lo) / ((hi - lo) / k)), k - 1) AS bin
  FROM {source}, (SELECT *, {bins} AS k FROM (
          SELECT min({column}::DOUBLE) AS lo, max({column}::DOUBLE) AS hi, count({column}) AS n
          FROM {source})) f2
  WHERE {column} IS NOT NULL) d ON d.bin = g.b
GROUP BY g.b, lo, hi, w, k, f.n"""


AUTO_BINS = "least(30, greatest(10, floor(sqrt(n))))::INTEGER"

SCATTER = """pts AS (
  SELECT user_id::DOUBLE AS x, value AS y, event_type AS colour FROM events_dirty
  WHERE value IS NOT NULL AND event_type IS NOT NULL),
ext AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts)"""

KDE = """v AS (SELECT value AS x FROM events_dirty WHERE value IS NOT NULL),
f AS (SELECT min(x) AS lo, (max(x) - min(x)) / 199 AS step, count(*)::DOUBLE AS n,
             stddev_samp(x) * power(count(*)::DOUBLE, -0.2::DOUBLE) AS h FROM v)"""


def scaled(expression: str, fit: str) -> str:
    return f"""SELECT c_custkey, c_acctbal AS _c_acctbal, round({expression}, 6) AS c_acctbal_scaled
FROM customer, (SELECT {fit} FROM customer) f"""


# Acklam's published approximation of the normal quantile, highest power first.
QUANTILE_CENTRE_A = ["-3.969683028665376e+01", "2.209460984245205e+02", "-2.759285104469687e+02",
                     "1.383577518672690e+02", "-3.066479806614716e+01", "2.506628277459239e+00"]
QUANTILE_CENTRE_B = ["-5.447609879822406e+01", "1.615858368580409e+02", "-1.556989798598866e+02",
                     "6.680131188771972e+01", "-1.328068155288572e+01", "1.0"]
QUANTILE_TAIL_C = ["-7.784894002430293e-03", "-3.223964580411365e-01", "-2.400758277161838e+00",
                   "-2.549732539343734e+00", "4.374664141464968e+00", "2.938163982698783e+00"]
QUANTILE_TAIL_D = ["7.784695709041462e-03", "3.224671290700398e-01", "2.445134137142996e+00",
                   "3.754408661907416e+00", "1.0"]


def polynomial(coefficients, x: str) -> str:
    """Horner's rule, highest power first."""
    out = f"{coefficients[0]}::DOUBLE"
    for c in coefficients[1:]:
        out = f"(({out}) * {x} + ({c}::DOUBLE))"
    return out


def normal_quantile(p: str) -> str:
    """For 0 < p < 1, through a lower tail, a centre and an upper tail."""
    def tail(q: str) -> str:
        q = f"sqrt(-2 * ln({q}))"
        return f"{polynomial(QUANTILE_TAIL_C, q)} / {polynomial(QUANTILE_TAIL_D, q)}"

    r = f"(({p} - 0.5::DOUBLE) * ({p} - 0.5::DOUBLE))"
    centre = (
        f"{polynomial(QUANTILE_CENTRE_A, r)} * ({p} - 0.5::DOUBLE) "
        f"/ {polynomial(QUANTILE_CENTRE_B, r)}"
    )
    return (
        f"CASE WHEN {p} < 0.02425 THEN {tail(p)} "
        f"WHEN {p} > 0.97575 THEN -({tail(f'(1 - {p})')}) ELSE {centre} END"
    )


def shapiro(source: str, c: str) -> str:
    """For at least 6 values; the normal distribution by Simpson's rule."""
    last = polynomial(["-2.706056", "4.434685", "-2.071190", "-0.147981", "0.221157", "0"], "u")
    second = polynomial(["-3.582633", "5.682633", "-1.752461", "-0.293762", "0.042981", "0"], "u")
    mean = polynomial(["0.0038915", "-0.083751", "-0.31082", "-1.5861"], "ln(n)")
    log_sd = polynomial(["0.0030302", "-0.082676", "-0.4803"], "ln(n)")
    small_mean = polynomial(["-0.0006714", "0.025054", "-0.39978", "0.5440"], "n")
    small_log_sd = polynomial(["-0.0020322", "0.062767", "-0.77857", "1.3822"], "n")
    small = f"(-ln(-2.273 + 0.459 * n - ln(1 - w)) - {small_mean}) / exp({small_log_sd})"
    large = f"(ln(1 - w) - {mean}) / exp({log_sd})"
    return f"""SELECT '{c}' AS "column", n::BIGINT AS n, round_even(w, 4) AS w,
  CASE WHEN w >= 0.99 THEN 'very close' WHEN w >= 0.95 THEN 'close'
       WHEN w >= 0.90 THEN 'similar' ELSE 'not normal' END AS closeness,
  greatest(round_even(p, 4), 0.0::DOUBLE) AS p, CASE WHEN p > 0.05 THEN 'yes' ELSE 'no' END AS normal
FROM (
  SELECT n, w, 0.5::DOUBLE - sum(
      CASE WHEN k = 0 OR k = 4000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
      * exp(-0.5::DOUBLE * (z * k / 4000) * (z * k / 4000))) * z / 4000 / 3 / sqrt(2 * pi()) AS p
  FROM (
    SELECT n, w, CASE WHEN n <= 11 THEN {small} ELSE {large} END AS z FROM (
      SELECT any_value(n) AS n, power(sum(a * x), 2) / sum((x - mx) * (x - mx)) AS w FROM (
        SELECT x, n, mx, CASE WHEN i = n THEN an WHEN i = 1 THEN -an WHEN i = n - 1 THEN an1
            WHEN i = 2 THEN -an1 ELSE m / sqrt((mm - 2 * mn * mn - 2 * mn1 * mn1)
                                               / (1 - 2 * an * an - 2 * an1 * an1)) END AS a
        FROM (
          SELECT *, mn / sqrt(mm) + {last} AS an, mn1 / sqrt(mm) + {second} AS an1 FROM (
            SELECT *, 1 / sqrt(n) AS u, sum(m * m) OVER () AS mm, max(m) OVER () AS mn,
                   max(CASE WHEN i = n - 1 THEN m END) OVER () AS mn1 FROM (
              SELECT *, {normal_quantile("q")} AS m FROM (
                SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS q FROM (
                  SELECT {c}::DOUBLE AS x, row_number() OVER (ORDER BY {c}) AS i,
                         (count(*) OVER ())::DOUBLE AS n, avg({c}) OVER () AS mx
                  FROM {source} WHERE {c} IS NOT NULL))))))))
  , (SELECT unnest(range(4001)) AS k) g
  GROUP BY n, w, z)"""


TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"

ORACLE: dict[str, str] = {
    "overview_shape": dirty(
        f"""SELECT count(*) AS rows, 9::BIGINT AS columns, {nulls_of(DIRTY_COLUMNS)} AS nulls,
  round_even(100.0::DOUBLE * ({nulls_of(DIRTY_COLUMNS)}) / (count(*) * 9), 1) AS null_pct
FROM events_dirty"""
    ),
    "table_status": dirty(
        f"""SELECT count(*) AS rows, 9::BIGINT AS columns, {nulls_of(DIRTY_COLUMNS)} AS nulls,
  5::BIGINT AS categorical, 1::BIGINT AS operations FROM events_dirty"""
    ),
    "run_summary": dirty(
        """SELECT (SELECT count(*) FROM events_dirty) AS rows_before, count(*) AS rows_after,
  9::BIGINT AS columns_before, 8::BIGINT AS columns_after,
  count(CASE WHEN value IS NULL THEN 1 END) AS nulls_left, 3::BIGINT AS operations
FROM events_dirty WHERE event_type IS NOT NULL"""
    ),
    "null_counts": dirty(
        f"""SELECT column_ AS "column", nulls, pct FROM ({missing_rows(1)}) WHERE nulls > 0"""
    ),
    "missing_report": dirty(
        f"""SELECT column_ AS "column", nulls, pct, {MISSING_BAND} AS severity
FROM ({missing_rows(2)})"""
    ),
    "column_report": dirty(report_rows("events_dirty", DIRTY_TYPES)),
    "column_report_documents": report_rows(
        "documents",
        {"doc_id": "int64", "text": "object", "lang": "object", "source": "object",
         "n_chars": "int64"},
    ),
    "numeric_stats": stats_rows("lineitem", LINE_NUMBERS),
    "numeric_stats_gaps": dirty(stats_rows("events_dirty", ["value", "user_id"])),
    "describe_numeric": f"""SELECT "column", count, mean, sd, min, q1, median, q3, max
FROM ({stats_rows("lineitem", LINE_NUMBERS)})""",
    "quantiles": union(
        f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS p, "
        f"round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
        for c in LINE_NUMBERS
        for p in (0.01, 0.25, 0.5, 0.75, 0.99)
    ),
    "categorical_stats": dirty(category_rows(["event_type", "day_text", "user_text"])),
    "value_counts": """SELECT o_orderpriority AS value, count(*) AS n FROM orders
WHERE o_orderpriority IS NOT NULL GROUP BY 1""",
    "category_shares": dirty(share_rows("events_dirty", ["event_type", "user_text"], 15)),
    "category_shares_part": share_rows("part", ["p_brand", "p_type"]),
    "category_shares_dates": dirty(
        share_rows("events_dirty", ["day_text"])
        + """
UNION ALL SELECT 'ts', NULL, NULL, NULL, NULL, 'datetime'"""
    ),
    "default_picks": f"""SELECT *, 3::BIGINT AS selected_numeric, 2::BIGINT AS selected_categorical
FROM ({report_rows("lineitem", PICKED)})""",
    "figure_density": dirty_then(
        KDE,
        f"""SELECT 'bar' AS part, bin AS place, low AS x, density AS height FROM (
  {bins_of("events_dirty", "value", AUTO_BINS, ", round(count(d.bin) / (f.n * w), 9) AS density")})
UNION ALL
SELECT 'curve', g.i::INTEGER, round(lo + g.i * step, 6),
  round(sum(exp(-0.5::DOUBLE * power((v.x - (lo + g.i * step)) / h, 2))) / (n * h * sqrt(2 * pi())), 9)
FROM v, f, (SELECT unnest(range(200)) AS i) g GROUP BY g.i, lo, step, n, h""",
    ),
    "figure_box": dirty(
        f"""SELECT value, round(q1, 6) AS q1, round(q3, 6) AS q3,
  round((SELECT quantile_cont(value::DOUBLE, 0.5) FROM events_dirty), 6) AS median
FROM events_dirty, {fences('value', 'events_dirty')} f WHERE value < lo OR value > hi"""
    ),
    "scale_infinite_refused": """SELECT c_custkey, c_acctbal,
  CASE WHEN c_custkey % 50 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE c_acctbal END AS balance,
  'infinite values in balance' AS refused FROM customer""",
    "keep_suggested": """SELECT o_orderkey, o_orderstatus, o_orderpriority,
  round(sqrt(greatest(o_totalprice, 0)), 6) AS o_totalprice_scaled,
  round(sqrt(greatest(o_custkey, 0)::DOUBLE), 6) AS o_custkey_scaled, 2::BIGINT AS hidden FROM orders""",
    "encoding_status": dirty(union(first_values(c) for c in ("event_type", "user_text"))),
    "raw_stats": moment_rows("orders", ["o_custkey", "o_totalprice"], 3),
    "outlier_report_iqr": dirty(iqr_rows("events_dirty", ["value", "user_id"], 2)),
    "outlier_report_z": f"""SELECT 'n_chars' AS "column", n, outliers, pct,
  {OUTLIER_BAND} AS severity, 'Z-score 3' AS method
FROM (SELECT count(n_chars) AS n, count(CASE WHEN abs(n_chars - m) > 3 * s THEN 1 END) AS outliers,
        round_even(100.0::DOUBLE * count(CASE WHEN abs(n_chars - m) > 3 * s THEN 1 END)
                   / count(n_chars), 2) AS pct
      FROM documents, (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s FROM documents) f)""",
    "outlier_summary": f"""SELECT "column", n, outliers, pct, q1, q3, lower, upper,
  {OUTLIER_BAND} AS severity
FROM (SELECT 'n_chars' AS "column", count(n_chars) AS n,
        count(CASE WHEN n_chars < lo OR n_chars > hi THEN 1 END) AS outliers,
        round_even(100.0::DOUBLE * count(CASE WHEN n_chars < lo OR n_chars > hi THEN 1 END)
                   / count(n_chars), 1) AS pct,
        round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
        round(any_value(lo), 6) AS lower, round(any_value(hi), 6) AS upper
      FROM documents, {fences("n_chars", "documents")} f)""",
    "outlier_iqr_clip": dirty(
        f"SELECT event_id, {CLIP} FROM events_dirty, {fences('value', 'events_dirty')} f"
    ),
    "outlier_iqr_drop": dirty(
        f"""SELECT event_id, round(value, 6) AS value
FROM events_dirty, {fences('value', 'events_dirty')} f WHERE value BETWEEN lo AND hi"""
    ),
    "outlier_z_clip": dirty(
        f"""SELECT event_id, {CLIP} FROM events_dirty, (
  SELECT avg(value) - 2 * stddev_samp(value) AS lo, avg(value) + 2 * stddev_samp(value) AS hi
  FROM events_dirty) f"""
    ),
    "outlier_z_drop": dirty(
        """SELECT event_id, round(value, 6) AS value FROM events_dirty, (
  SELECT avg(value) AS m, stddev_samp(value) AS s FROM events_dirty) f
WHERE abs(value - m) <= 2 * s"""
    ),
    "outlier_cap_pct": dirty(
        f"""SELECT event_id, {CLIP} FROM events_dirty, (
  SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
  FROM events_dirty) f"""
    ),
    "outlier_iqr_drop_seq": dirty_then(
        f"""two AS (SELECT event_id, value, value * value AS squared FROM events_dirty),
first AS (SELECT two.* FROM two, {fences('value', 'two')} f WHERE value BETWEEN lo AND hi)""",
        f"""SELECT event_id, round(value, 6) AS value, round(squared, 6) AS squared
FROM first, {fences('squared', 'first')} f WHERE squared BETWEEN lo AND hi""",
    ),
    "outlier_iqr_drop_joint": dirty_then(
        "two AS (SELECT event_id, value, value * value AS squared FROM events_dirty)",
        f"""SELECT event_id, round(value, 6) AS value, round(squared, 6) AS squared
FROM two, {fences('value', 'two')} f, {fences('squared', 'two')} g
WHERE value BETWEEN f.lo AND f.hi AND squared BETWEEN g.lo AND g.hi""",
    ),
    "impute_mean": dirty(
        """SELECT event_id, event_type,
  round(coalesce(value, (SELECT avg(value) FROM events_dirty)), 6) AS value FROM events_dirty"""
    ),
    "impute_median": dirty(
        """SELECT event_id, event_type,
  round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM events_dirty)), 6) AS value
FROM events_dirty"""
    ),
    "impute_mode": dirty(
        """SELECT event_id,
  coalesce(event_type, (SELECT event_type FROM events_dirty WHERE event_type IS NOT NULL
     GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS event_type,
  round(coalesce(value, (SELECT value FROM events_dirty WHERE value IS NOT NULL
     GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)), 6) AS value
FROM events_dirty"""
    ),
    "impute_constant": dirty(
        """SELECT event_id, coalesce(event_type, 'unknown') AS event_type,
  round(coalesce(value, -1.5::DOUBLE), 6) AS value FROM events_dirty"""
    ),
    "impute_drop_rows": dirty(
        """SELECT event_id, event_type, round(value, 6) AS value FROM events_dirty
WHERE value IS NOT NULL"""
    ),
    "impute_drop_col": dirty("SELECT event_id, event_type FROM events_dirty"),
    "impute_all": dirty_then(
        "kept AS (SELECT * FROM events_dirty WHERE event_type IS NOT NULL)",
        """SELECT event_id, event_type,
  round(coalesce(value, (SELECT avg(value) FROM kept)), 6) AS value FROM kept""",
    ),
    "encode_label": """SELECT o_orderkey,
  dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority,
  dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS o_orderstatus FROM orders""",
    "encode_label_wide": dirty(
        """SELECT event_id, dense_rank() OVER (ORDER BY user_text) - 1 AS user_text
FROM events_dirty"""
    ),
    "encode_label_null": dirty(
        """SELECT event_id, dense_rank() OVER (ORDER BY coalesce(event_type, 'nan')) - 1
  AS event_type FROM events_dirty"""
    ),
    "encode_onehot": dirty(
        "SELECT event_id, event_type, "
        + ", ".join(
            f"CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END::BIGINT "
            f"AS event_type_{v}_encoded"
            for v in ("click", "error", "purchase", "signup", "view")
        )
        + " FROM events_dirty"
    ),
    "encode_ordinal": """SELECT o_orderkey, o_orderpriority,
  CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
    WHEN '5-LOW' THEN 1 END::BIGINT AS o_orderpriority_encoded FROM orders""",
    "encode_binary": """SELECT l_orderkey,
  CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END::BIGINT AS l_linestatus, l_returnflag
FROM lineitem""",
    "encode_binary_first_seen": """WITH o AS (SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS outcome FROM events)
SELECT event_id, CASE WHEN outcome = (SELECT outcome FROM o ORDER BY event_id LIMIT 1)
  THEN 0 ELSE 1 END::BIGINT AS outcome FROM o""",
    "scale_standard": scaled(
        "(c_acctbal - m) / s", "avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s"
    ),
    "scale_minmax": scaled(
        "(c_acctbal - lo) / (hi - lo)", "min(c_acctbal) AS lo, max(c_acctbal) AS hi"
    ),
    "scale_robust": scaled(
        "(c_acctbal - m) / (q3 - q1)",
        "quantile_cont(c_acctbal, 0.5) AS m, quantile_cont(c_acctbal, 0.25) AS q1, "
        "quantile_cont(c_acctbal, 0.75) AS q3",
    ),
    "scale_log": scaled("ln(1 + greatest(c_acctbal, 0))", "max(1) AS one"),
    "scale_sqrt": scaled("sqrt(greatest(c_acctbal, 0))", "max(1) AS one"),
    "scaled_stats": f"""WITH s AS (
  SELECT (o_totalprice - lo) / (hi - lo) AS o_totalprice_scaled
  FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) f)
{moment_rows("s", ["o_totalprice_scaled"], 6)}""",
    "covariance": f"WITH {NET.strip()}\n{covariance_rows(NET_COLUMNS)}",
    "corr_pearson": f"WITH {NET.strip()}\n{pearson_rows(NET_COLUMNS, 6)}",
    "corr_spearman": f"WITH {NET.strip()}\n{spearman_rows(NET_COLUMNS)}",
    "corr_kendall": KENDALL,
    "corr_kendall_gaps": kendall_rows(),
    "mean_abs_corr": f"""WITH {NET.strip()}
SELECT round(avg(m), 6) AS mean_abs_corr FROM (
  SELECT col_a, avg(abs(r)) AS m FROM ({pearson_rows(NET_COLUMNS, None)}) GROUP BY col_a)""",
    "average_ranks": f"""WITH {NET.strip()}
SELECT {average_rank("l_extendedprice")} AS l_extendedprice, {average_rank("qty_null")} AS qty_null
FROM lineitem_net""",
    "histogram": union(
        bins_of("lineitem", c, AUTO_BINS) for c in ("l_extendedprice", "l_quantity")
    ),
    "density_histogram": dirty(
        bins_of("events_dirty", "value", AUTO_BINS,
                ", round(count(d.bin) / (f.n * w), 9) AS density")
    ),
    "numeric_distribution": union(bins_of("lineitem", c, "50") for c in LINE_NUMBERS),
    "kde": dirty_then(
        KDE,
        """SELECT g.i::INTEGER AS point, round(lo + g.i * step, 6) AS x,
  round(sum(exp(-0.5::DOUBLE * power((v.x - (lo + g.i * step)) / h, 2)))
        / (n * h * sqrt(2 * pi())), 9) AS density
FROM v, f, (SELECT unnest(range(200)) AS i) g GROUP BY g.i, lo, step, n, h""",
    ),
    "box_stats": dirty(
        union(
            f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
  round(any_value(q1), 6) AS q1,
  round((SELECT quantile_cont({c}::DOUBLE, 0.5) FROM events_dirty), 6) AS median,
  round(any_value(q3), 6) AS q3,
  round(min(CASE WHEN {c} BETWEEN lo AND hi THEN {c}::DOUBLE END), 6) AS whisker_low,
  round(max(CASE WHEN {c} BETWEEN lo AND hi THEN {c}::DOUBLE END), 6) AS whisker_high,
  count(CASE WHEN {c} < lo OR {c} > hi THEN 1 END) AS outliers
FROM events_dirty, {fences(c, 'events_dirty')} f"""
            for c in ("value", "user_id")
        )
    ),
    "box_outliers": dirty(
        f"""SELECT value FROM events_dirty, {fences('value', 'events_dirty')} f
WHERE value < lo OR value > hi"""
    ),
    "scatter_cells": dirty_then(
        SCATTER,
        """SELECT least(floor((x - x0) / ((x1 - x0) / 20)), 19)::INTEGER AS bin_x,
  least(floor((y - y0) / ((y1 - y0) / 20)), 19)::INTEGER AS bin_y, colour, count(*) AS n
FROM pts, ext GROUP BY 1, 2, 3""",
    ),
    "scatter_points": dirty_then(
        SCATTER.replace("AS colour FROM", "AS colour, ('0x' || substr(md5('42:' || event_id), 1, 15))::BIGINT AS spot FROM"),
        """SELECT x, y, colour FROM (
  SELECT x, y, colour, row_number() OVER (
      PARTITION BY least(floor((x - x0) / ((x1 - x0) / 20)), 19), least(floor((y - y0) / ((y1 - y0) / 20)), 19), colour
      ORDER BY spot, x, y) AS k FROM pts, ext)
WHERE k <= 5""",
    ),
    "scatter_margin": dirty_then(
        SCATTER, f"SELECT bin, low, high, n FROM ({bins_of('pts', 'y', '20')})"
    ),
    "retype_float_comma": dirty(
        """SELECT event_id, TRY_CAST(replace(trim(value_text), ',', '.') AS DOUBLE) AS value_text
FROM events_dirty"""
    ),
    "retype_int": dirty(
        "SELECT event_id, TRY_CAST(user_text AS BIGINT) AS user_text FROM events_dirty"
    ),
    "retype_datetime": dirty(
        "SELECT event_id, TRY_CAST(day_text AS TIMESTAMP) AS day_text FROM events_dirty"
    ),
    "retype_text": dirty(
        "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id FROM events_dirty"
    ),
    "retype_refused": dirty(
        """SELECT DISTINCT event_type AS sample FROM events_dirty
WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS DOUBLE) IS NULL ORDER BY 1 LIMIT 3"""
    ),
    "restore_column": dirty(
        "SELECT event_id, value, value_text FROM events_dirty WHERE value IS NOT NULL"
    ),
    "restore_by_key": dirty(
        "SELECT event_id, value, value_text FROM events_dirty WHERE value > 10"
    ),
    "keep_columns": dirty("SELECT user_id, event_id FROM events_dirty"),
    "drop_columns": dirty(
        """SELECT event_id, user_id, event_type, value, value_text, day_text, user_text
FROM events_dirty"""
    ),
    "drop_temporary": """SELECT * EXCLUDE (c_acctbal),
  round(sqrt(greatest(c_acctbal, 0)), 6) AS c_acctbal_scaled FROM customer""",
    "preview": dirty(
        """SELECT CAST(event_id AS VARCHAR) AS event_id, coalesce(event_type, 'NaN') AS event_type,
  CAST(user_id AS VARCHAR) AS user_id, day_text FROM events_dirty ORDER BY events_dirty.event_id
LIMIT 8"""
    ),
    "normality": union(shapiro("customer", c) for c in ("c_acctbal", "c_nationkey")),
    "normality_events": dirty(shapiro("events_dirty", "value")),
    "normality_sample": dirty(
        shapiro(
            """(SELECT value FROM events_dirty WHERE value IS NOT NULL
  ORDER BY ('0x' || substr(md5('42:' || event_id), 1, 15))::BIGINT, value LIMIT 500)""",
            "value",
        )
    ),
    "normality_supplier": union(
        shapiro("supplier", c) for c in ("s_acctbal", "s_nationkey")
    ),
    "retype_datetime_day_first": """SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_text
FROM events""",
    "csv_quoted_breaks": f"""SELECT doc_id, source, CASE WHEN text NOT IN ({TOKENS}) THEN text END AS text
FROM documents""",
    "csv_mixed_encodings": """SELECT o_orderkey, 'señal ' || o_orderpriority AS note FROM orders""",
    "csv_ragged": """SELECT o_orderkey AS "0", o_orderstatus AS "1",
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS "2" FROM orders""",
    "csv_control_character": """SELECT o_orderkey, o_orderstatus || chr(1) || o_orderpriority AS note
FROM orders""",
    "csv_by_name": ORDERS,
    "csv_written": ORDERS,
    "pipeline_log": dirty(
        """SELECT 1 AS step_no, 'event_type' AS "column", count(*) AS rows_before,
  count(event_type) AS rows_after FROM events_dirty
UNION ALL SELECT 3, 'value', count(*), count(value) FROM events_dirty WHERE event_type IS NOT NULL"""
    ),
    "pipeline_reset": dirty(
        f"""SELECT count(*) AS rows, 9::BIGINT AS columns, {nulls_of(DIRTY_COLUMNS)} AS nulls,
  5::BIGINT AS categorical, 1::BIGINT AS operations FROM events_dirty"""
    ),
    "csv_round_trip": ORDERS,
    "csv_custom_separator": ORDERS,
    "csv_regex_separator": ORDERS,
    "csv_headerless": """SELECT o_orderkey AS "0", o_custkey AS "1", o_orderstatus AS "2",
  o_totalprice AS "3", o_orderpriority AS "4" FROM orders""",
    "csv_latin1_fallback": """SELECT o_orderkey, 'señal ' || o_orderpriority AS note
FROM orders""",
    "csv_load_record": """SELECT ';' AS separator, 'infer' AS header, 'utf-8' AS encoding,
  count(*) AS rows, 5::BIGINT AS columns FROM orders""",
}
