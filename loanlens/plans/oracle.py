"""DuckDB SQL for the parity check: one text per registered SQL query.

Each text rebuilds the raw borrower export from the driver's tables with
plain SQL (same rules as ``sources.fixture``), cleans it with SQL
expressions and computes the query's table, independently of the Spark code.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values, written out here so that the check does not share a constant
# with the code it checks
# ---------------------------------------------------------------------------
AS_OF = "2026-01-01"
OVERDUE_DAYS = 270
FOLD_COUNT = 5
DEALING_SEED = 42
SMALLEST_SUBGROUP = 10
SMALLEST_GROUP, SMALLEST_PROGRAM, SMALLEST_STATE = 5, 10, 10
FALLBACK_TOP = 15
NEAR_BAND = 0.03
TOP_STATES, TOP_PROGRAMS = 10, 15
PAGE_STATES, PAGE_PROGRAMS, PAGE_FEATURES = 10, 12, 10
IDR_PATTERN = ("income.based repayment|pay as you earn|revised pay as you earn"
               "|income contingent|saving on a valuable education")
NUMERIC_RE = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
BANNER_WITHDRAWN = ("WD", "W4", "W6", "W7")
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
GPA_EDGES, GPA_LABELS = (0, 2, 2.5, 3, 3.5, 4), ("< 2.0", "2.0–2.5", "2.5–3.0", "3.0–3.5", "3.5–4.0")
AGE_EDGES, AGE_LABELS = (0, 20, 25, 30, 40, 120), ("< 20", "20–24", "25–29", "30–39", "40+")
LOAN_EDGES = (0, 5000, 15000, 30000, 50000, 999999)
LOAN_LABELS = ("< $5K", "$5K–$15K", "$15K–$30K", "$30K–$50K", "> $50K")
LEVEL_LABELS = {"UG": "UG — Undergraduate", "GR": "GR — Graduate"}
PLAN_BY_PRIORITY = {"1": "Standard Repayment", "2": "Revised Pay As You Earn (REPAYE)",
                    "3": "Income-Based Repayment - Partial Financial Hardship",
                    "4": "Graduated 10-Year Repayment", "5": "Income Contingent Repayment"}
FINAL_COLUMNS = ("student_id", "level", "program", "major", "student_type", "campus_code", "age", "state", "gpa",
                 "credits_earned", "graduated", "withdrawn", "num_loans", "original_loan_amount",
                 "current_balance", "payment_plan", "default_flag")
FEATURES = FINAL_COLUMNS[1:-1]
NUMERIC_COLS = ("gpa", "original_loan_amount", "current_balance", "credits_earned", "num_loans")
CORRELATION_COLS = ("gpa", "credits_earned", "original_loan_amount", "current_balance", "num_loans",
                    "graduated", "withdrawn")
MODEL_CATEGORIES = ("level", "program", "student_type", "campus_code", "payment_plan")
MODEL_NUMBERS = ("gpa", "graduated", "withdrawn", "credits_earned", "num_loans", "original_loan_amount",
                 "current_balance")
SEGMENTS = (("level", "Level (LEVL_CODE)"), ("student_type", "Student type"), ("campus", "Campus"),
            ("gpa_band", "GPA band"), ("age_band", "Age band"), ("state", "State"),
            ("loan_amount", "Loan amount"), ("payment_plan", "Payment plan"), ("program", "Program"))
STATUS_TITLE, IDR_TITLE = "Graduation / Withdrawal", "IDR Policy Finding"
STATUS_LABELS = ("Not graduated", "Graduated", "Not withdrawn", "Withdrawn")
IDR_LABELS = ("IDR enrolled", "Non-IDR")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def nn(x: str) -> str:
    toks = ", ".join(q(t) for t in NA_TOKENS)
    return f"(CASE WHEN {strip(x)} IN ({toks}) THEN NULL ELSE {strip(x)} END)"


def num(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN regexp_full_match({s}, {q(NUMERIC_RE)}) THEN TRY_CAST({s} AS DOUBLE) END)"


def money(x: str) -> str:
    return num(rf"regexp_replace({x}, '[\$,]', '', 'g')")


def rate(d: str, n: str) -> str:
    return f"(CASE WHEN {n} > 0 THEN CAST({d} AS DOUBLE) / {n} END)"


def band(x: str, edges, labels) -> str:
    parts = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN {q(lab)}"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"(CASE {parts} END)"


def band_ord(x: str, edges) -> str:
    parts = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN {i}"
                     for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])))
    return f"(CASE {parts} END)"


_PLAN_CASE = " ".join(f"WHEN pr = {q(d)} THEN {q(p)}" for d, p in PLAN_BY_PRIORITY.items())

RAW_CTE = f"""
li AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
src AS (
  SELECT o.o_orderkey AS k, substr(o.o_orderpriority, 1, 1) AS pr, o.o_orderstatus AS ostatus,
         c.c_acctbal AS bal, c.c_mktsegment AS seg, n.n_name AS nname, n.n_regionkey AS reg,
         coalesce(li.n_lines, 0) AS n_lines,
         CAST(floor(o.o_totalprice / CAST(8 AS DOUBLE)) AS BIGINT) AS amt,
         CAST(floor((c.c_acctbal + CAST(1000 AS DOUBLE)) * CAST(420 AS DOUBLE)
                    / CAST(11000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS gh
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
),
raw AS (
  SELECT
    (CASE WHEN k % 9 = 0 THEN '  ' ELSE '' END) || 'S'
      || lpad(CAST(k AS VARCHAR), CAST(greatest(8, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS "ID",
    CASE WHEN k % 20 < 4 THEN 'GR' WHEN k % 20 = 4 THEN ' gr ' WHEN k % 20 = 5 THEN 'CE'
         WHEN k % 20 = 6 THEN NULL ELSE 'UG' END AS "LEVL_CODE",
    CASE WHEN k % 50 <> 0 THEN ' ' || seg || ' ' END AS "PROGRAM",
    seg || ' ' || ostatus AS "MAJR_DESC",
    CASE WHEN ostatus = 'F' THEN 'First time student' WHEN ostatus = 'P' THEN 'Transfer Student'
         ELSE 'Returning Student' END AS "STYP_DESC",
    nname AS "CAMP_CODE",
    CASE WHEN k % 41 = 0 THEN 'unknown' WHEN k % 43 = 0 THEN NULL
         WHEN k % 47 = 0 THEN CAST(1 + k % 12 AS VARCHAR) || '/' || CAST(1 + k % 28 AS VARCHAR)
              || '/' || CAST(1950 + k % 61 AS VARCHAR)
         WHEN k % 53 = 0 THEN CAST(1950 + k % 61 AS VARCHAR) || '-' || lpad(CAST(1 + k % 12 AS VARCHAR), 2, '0')
              || '-' || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') || 'T00:00:00'
         ELSE CAST(1950 + k % 61 AS VARCHAR) || '-' || lpad(CAST(1 + k % 12 AS VARCHAR), 2, '0')
              || '-' || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') END AS "BIRTH_DATE",
    CASE WHEN reg = 0 THEN 'NH' WHEN reg = 1 THEN 'ma' WHEN reg = 2 THEN ' Ny '
         WHEN reg = 3 THEN 'VT' END AS "STATE1",
    CASE WHEN k % 37 = 0 THEN 'N/A'
         ELSE CAST(gh // 100 AS VARCHAR) || '.' || lpad(CAST(gh % 100 AS VARCHAR), 2, '0')
    END AS "OVERALL_LGPA_GPA",
    CAST(k % 131 AS VARCHAR) AS "OVERALL_LGPA_HOURS_EARNED",
    CASE WHEN k % 5 = 0 THEN 'Y' WHEN k % 5 = 1 THEN 'y ' WHEN k % 5 = 2 THEN NULL
         ELSE 'N' END AS "GRADUATED_IND",
    CASE WHEN k % 19 = 0 THEN 'WD' WHEN k % 19 = 1 THEN 'w7' WHEN k % 19 = 2 THEN 'W4'
         ELSE 'EL' END AS "SFBETRM_ESTS_CODE",
    CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN '270'
         WHEN (k * 37) % 100 < (CASE WHEN pr IN ('2', '3', '5') THEN 1 ELSE 6 END)
                               + (CASE WHEN bal < 4000 THEN 10 ELSE 2 END)
         THEN CAST(271 + k % 200 AS VARCHAR)
         ELSE CAST(k % 270 AS VARCHAR) END AS "Days Delinquent",
    CAST(n_lines AS VARCHAR) AS "# of Loans",
    '$' || (CASE WHEN amt >= 1000
                 THEN CAST(amt // 1000 AS VARCHAR) || ',' || lpad(CAST(amt % 1000 AS VARCHAR), 3, '0')
                 ELSE CAST(amt AS VARCHAR) END) || '.00' AS "Original Loan Amount",
    CASE WHEN k % 31 = 0 THEN 'unknown'
         ELSE '$' || CAST((amt * (k % 10)) // 10 AS VARCHAR) END AS "Current Principal Balance",
    CASE WHEN k % 97 = 0 THEN 'IBR' {_PLAN_CASE} END AS "Payment Plan"
  FROM src
)"""

CONFORMED_CTE = f"""
conformed AS (
  SELECT "ID" AS student_id,
         coalesce(CASE upper({strip('"LEVL_CODE"')}) WHEN 'UG' THEN 'UG' WHEN 'GR' THEN 'GR' END,
                  upper({strip('"LEVL_CODE"')})) AS level,
         "PROGRAM" AS program, "MAJR_DESC" AS major, "STYP_DESC" AS student_type,
         "CAMP_CODE" AS campus_code, "BIRTH_DATE" AS birth_date, "STATE1" AS state,
         "OVERALL_LGPA_GPA" AS gpa, "OVERALL_LGPA_HOURS_EARNED" AS credits_earned,
         "GRADUATED_IND" AS graduated_ind, "SFBETRM_ESTS_CODE" AS enrollment_status,
         "Days Delinquent" AS days_delinquent, "# of Loans" AS num_loans,
         "Original Loan Amount" AS original_loan_amount,
         "Current Principal Balance" AS current_balance, "Payment Plan" AS payment_plan
  FROM raw
)"""

_birth = "coalesce(" + ", ".join(
    f"try_strptime({strip('birth_date')}, {q(f)})"
    for f in ("%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S")) + ")"


def cleanall_cte(withdrawn_codes=BANNER_WITHDRAWN, graduated_value: str = "Y") -> str:
    """Typed rows of a profile: only the withdrawn codes and graduated value differ."""
    _withdrawn = ", ".join(q(c) for c in withdrawn_codes)
    return f"""
cleanall AS (
  SELECT coalesce(level IN ('UG', 'GR'), false) AS valid,
         enrollment_status AS raw_enrollment_status,
         {nn('student_id')} AS student_id,
         level,
         {nn('program')} AS program,
         {nn('major')} AS major,
         {nn('student_type')} AS student_type,
         {nn('campus_code')} AS campus_code,
         CAST(floor(date_diff('day', CAST({_birth} AS DATE), DATE '{AS_OF}') / 365.25) AS DOUBLE) AS age,
         upper({nn('state')}) AS state,
         {num('gpa')} AS gpa,
         {num('credits_earned')} AS credits_earned,
         CAST(coalesce(upper({strip('graduated_ind')}) = {q(graduated_value)}, false) AS INTEGER) AS graduated,
         CAST(coalesce(upper({strip('enrollment_status')}) IN ({_withdrawn}), false) AS INTEGER) AS withdrawn,
         {num('num_loans')} AS num_loans,
         {money('original_loan_amount')} AS original_loan_amount,
         {money('current_balance')} AS current_balance,
         {nn('payment_plan')} AS payment_plan,
         CAST(coalesce({num('days_delinquent')}, 0) > {OVERDUE_DAYS} AS INTEGER) AS default_flag
  FROM conformed
),
clean AS (SELECT {", ".join(FINAL_COLUMNS)} FROM cleanall WHERE valid)"""


CLEANALL_CTE = cleanall_cte()

BASE = "WITH " + RAW_CTE.strip() + "," + CONFORMED_CTE + "," + CLEANALL_CTE


def _with(*ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return BASE + extra + "\n"


def _level_label(x: str) -> str:
    parts = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in LEVEL_LABELS.items())
    return f"coalesce(CASE {x} {parts} END, {x})"


def _segment_long() -> str:
    none = "CAST(-1 AS INTEGER)"
    src = {
        "level": (_level_label("level"), none),
        "student_type": ("student_type", none),
        "campus": ("campus_code", none),
        "gpa_band": (band("gpa", GPA_EDGES, GPA_LABELS), f"coalesce({band_ord('gpa', GPA_EDGES)}, -1)"),
        "age_band": (band("age", AGE_EDGES, AGE_LABELS), f"coalesce({band_ord('age', AGE_EDGES)}, -1)"),
        "state": ("state", none),
        "loan_amount": (band("original_loan_amount", LOAN_EDGES, LOAN_LABELS),
                        f"coalesce({band_ord('original_loan_amount', LOAN_EDGES)}, -1)"),
        "payment_plan": ("payment_plan", none),
        "program": ("program", none),
    }
    sel = "\n  UNION ALL ".join(
        f"SELECT {q(k)} AS segment, {src[k][0]} AS value, {src[k][1]} AS band_ord, default_flag FROM clean"
        for k, _ in SEGMENTS)
    return f"""seglong AS (
  {sel}
),
segcounts AS (
  SELECT segment, value, min(band_ord) AS band_ord, count(*) AS n,
         CAST(sum(default_flag) AS BIGINT) AS defaults
  FROM seglong WHERE value IS NOT NULL GROUP BY segment, value
)"""


def _title(x: str) -> str:
    parts = " ".join(f"WHEN {q(k)} THEN {q(t)}" for k, t in SEGMENTS)
    return f"(CASE {x} {parts} END)"


def _segment_rates_ctes(min_n_sql: str) -> list[str]:
    return [
        _segment_long(),
        f"""segm AS (
  SELECT *, {min_n_sql} AS min_n, max(n) OVER (PARTITION BY segment) AS seg_max,
         row_number() OVER (PARTITION BY segment ORDER BY n DESC, value ASC) AS rn
  FROM segcounts
)""",
        f"""ov AS (SELECT {rate('sum(default_flag)', 'count(*)')} AS o FROM clean)""",
        f"""segrates AS (
  SELECT segment, {_title('segment')} AS title, value, band_ord, n, defaults,
         {rate('defaults', 'n')} AS default_rate,
         CASE WHEN {rate('defaults', 'n')} > o + {NEAR_BAND} THEN 'above'
              WHEN {rate('defaults', 'n')} < o - {NEAR_BAND} THEN 'below' ELSE 'near' END AS flag
  FROM segm, ov
  WHERE n >= min_n OR (seg_max < min_n AND rn <= {FALLBACK_TOP})
)"""]


_DEFAULT_MIN_N = (f"(CASE segment WHEN 'state' THEN {SMALLEST_STATE} "
                  f"WHEN 'program' THEN {SMALLEST_PROGRAM} ELSE {SMALLEST_GROUP} END)")


def _status_cte() -> str:
    conds = ("graduated = 0", "graduated = 1", "withdrawn = 0", "withdrawn = 1")
    rows = "\n  UNION ALL ".join(
        f"SELECT {i} AS position, {q(lab)} AS status, count_if({c}) AS n, "
        f"CAST(coalesce(sum(CASE WHEN {c} THEN default_flag END), 0) AS BIGINT) AS defaults FROM clean"
        for i, (lab, c) in enumerate(zip(STATUS_LABELS, conds)))
    return f"statusc AS (\n  {rows}\n)"


_IDR = f"coalesce(regexp_matches(lower({strip('payment_plan')}), {q(IDR_PATTERN)}), false)"

IDR_CTE = f"""idr AS (
  SELECT count_if({_IDR}) AS idr_n,
         CAST(coalesce(sum(CASE WHEN {_IDR} THEN default_flag END), 0) AS BIGINT) AS idr_defaults,
         count_if(NOT {_IDR}) AS non_idr_n,
         CAST(coalesce(sum(CASE WHEN NOT {_IDR} THEN default_flag END), 0) AS BIGINT) AS non_idr_defaults
  FROM clean
)"""


_dealing_text = " || '|' || ".join([f"coalesce(student_id, '') || ':{DEALING_SEED}'",
                                    *(f"coalesce({c}, '')" for c in MODEL_CATEGORIES)])


def _sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["conform_headers"] = _with() + "SELECT * FROM conformed"
    out["reject_report"] = _with() + (
        "SELECT level, count(*) AS n FROM conformed "
        "WHERE NOT coalesce(level IN ('UG', 'GR'), false) GROUP BY level")
    out["clean_dataset"] = _with() + "SELECT * FROM clean"
    out["population_counts"] = _with() + f"""
SELECT count(*) AS total_raw, count(*) - count_if(valid) AS excluded_invalid_level,
       count_if(valid) AS valid_population,
       CAST(coalesce(sum(CASE WHEN valid THEN default_flag END), 0) AS BIGINT) AS defaults,
       {rate('coalesce(sum(CASE WHEN valid THEN default_flag END), 0)', 'count_if(valid)')} AS default_rate,
       count_if(valid) AS n_rows, CAST({len(FINAL_COLUMNS)} AS BIGINT) AS n_cols
FROM cleanall"""
    out["level_breakdown"] = _with() + "\nUNION ALL\n".join(
        f"SELECT {q(c)} AS level, count_if(level = {q(c)}) AS n, "
        f"{rate(f'count_if(level = {q(c)})', 'count(*)')} AS share FROM clean" for c in ("UG", "GR"))
    out["default_rate_by_level"] = _with() + f"""
SELECT level, count(*) AS n, CAST(sum(default_flag) AS BIGINT) AS defaults,
       {rate('sum(default_flag)', 'count(*)')} AS default_rate
FROM clean GROUP BY level"""
    out["enrollment_breakdown"] = _with() + """
SELECT raw_enrollment_status AS enrollment_status, count(*) AS n FROM cleanall
WHERE valid AND raw_enrollment_status IS NOT NULL GROUP BY raw_enrollment_status"""
    out["feature_completeness"] = _with() + "\nUNION ALL\n".join(
        f"SELECT {q(f)} AS feature, count({f}) AS non_null, {rate(f'count({f})', 'count(*)')} AS share FROM clean"
        for f in FEATURES)
    out["class_balance"] = _with() + f"""
SELECT default_flag, count(*) AS n,
       {rate('count(*)', '(SELECT count(*) FROM clean)')} AS pct
FROM clean GROUP BY default_flag"""
    out["missing_values"] = _with() + "\nUNION ALL\n".join(
        f"SELECT {q(c)} AS column_name, count_if({c} IS NULL) AS missing_n, "
        f"{rate(f'count_if({c} IS NULL)', 'count(*)')} AS missing_pct FROM clean"
        for c in FINAL_COLUMNS)
    out["numeric_distribution"] = _with() + "\nUNION ALL\n".join(
        f"""SELECT {q(c)} AS feature, min({c}) AS min, max({c}) AS max,
       round(avg({c}), 9) AS mean, round(quantile_cont({c}, 0.5), 9) AS median,
       round(stddev_samp({c}), 9) AS std, round(quantile_cont({c}, 0.25), 9) AS p25,
       round(quantile_cont({c}, 0.75), 9) AS p75
FROM clean WHERE {c} IS NOT NULL""" for c in NUMERIC_COLS)
    corr_rows = "\n  UNION ALL ".join(
        f"""SELECT {q(c)} AS feature, count(*) AS n_pairs,
         CASE WHEN stddev_pop(x) * stddev_pop(y) <> 0
              THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END AS r
  FROM (SELECT CAST({c} AS DOUBLE) AS x, CAST(default_flag AS DOUBLE) AS y FROM clean
        WHERE {c} IS NOT NULL AND default_flag IS NOT NULL)"""
        for c in CORRELATION_COLS)
    out["correlation_with_default"] = _with(f"corr AS (\n  {corr_rows}\n)") + """
SELECT feature, round(r, 9) AS r, CASE WHEN r >= 0 THEN '+' WHEN r < 0 THEN '-' END AS direction,
       round(abs(r), 9) AS abs_r
FROM corr WHERE n_pairs >= 2"""
    out["band_counts"] = _with(_segment_long()) + f"""
SELECT segment, value, band_ord, n, defaults, {rate('defaults', 'n')} AS default_rate
FROM segcounts WHERE segment IN ('gpa_band', 'age_band', 'loan_amount')"""
    out["segment_rates"] = _with(*_segment_rates_ctes(_DEFAULT_MIN_N)) + "SELECT * FROM segrates"
    out["segment_fallback"] = (_with(*_segment_rates_ctes("9223372036854775807"))
                               + "SELECT * FROM segrates")
    out["status_rates"] = _with(_status_cte()) + (
        f"SELECT position, status, n, defaults, {rate('defaults', 'n')} AS default_rate FROM statusc")
    out["idr_finding"] = _with(IDR_CTE) + f"""
SELECT idr_n, idr_defaults, {rate('idr_defaults', 'idr_n')} AS idr_rate,
       non_idr_n, non_idr_defaults, {rate('non_idr_defaults', 'non_idr_n')} AS non_idr_rate,
       {rate('non_idr_defaults', 'non_idr_n')} - {rate('idr_defaults', 'idr_n')} AS idr_differential
FROM idr"""
    seg_pos = "(CASE segment " + " ".join(
        f"WHEN {q(k)} THEN {i}" for i, (k, _) in enumerate(SEGMENTS)) + " END)"
    out["segment_report"] = _with(*_segment_rates_ctes(_DEFAULT_MIN_N), _status_cte(), IDR_CTE,
                                  f"""report AS (
  SELECT {seg_pos} AS seg_pos, title AS segment, value, n, defaults, default_rate FROM segrates
  UNION ALL
  SELECT {len(SEGMENTS)} AS seg_pos, {q(STATUS_TITLE)} AS segment, status AS value, n, defaults,
         {rate('defaults', 'n')} AS default_rate FROM statusc
  UNION ALL
  SELECT {len(SEGMENTS) + 1}, {q(IDR_TITLE)}, {q(IDR_LABELS[0])}, idr_n, idr_defaults,
         {rate('idr_defaults', 'idr_n')} FROM idr
  UNION ALL
  SELECT {len(SEGMENTS) + 1}, {q(IDR_TITLE)}, {q(IDR_LABELS[1])}, non_idr_n, non_idr_defaults,
         {rate('non_idr_defaults', 'non_idr_n')} FROM idr
)""") + "SELECT *, printf('%.1f', default_rate * 100) || '%' AS default_rate_text FROM report"
    out["top_segments"] = _with(*_segment_rates_ctes(_DEFAULT_MIN_N)) + f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY segment
         ORDER BY default_rate DESC, n DESC, value ASC) AS BIGINT) AS seg_rank
  FROM segrates WHERE segment IN ('state', 'program')
) WHERE (segment = 'state' AND seg_rank <= {TOP_STATES})
     OR (segment = 'program' AND seg_rank <= {TOP_PROGRAMS})"""
    out["page_cuts"] = out["top_segments"].replace(
        f"seg_rank <= {TOP_PROGRAMS}", f"seg_rank <= {PAGE_PROGRAMS}").replace(
        f"seg_rank <= {TOP_STATES}", f"seg_rank <= {PAGE_STATES}")
    day = "regexp_replace(" + strip("birth_date") + ", '[T ].*$', '')"
    tries = {c: "coalesce(" + ", ".join(f"try_strptime({day}, {q(f)})" for f in fs) + ") IS NOT NULL" for c, fs in {
        "y": ("%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d"), "p": ("%Y%m%d",), "m": ("%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y"),
        "d": ("%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y")}.items()}
    shape = {"y": r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}", "p": r"\d{8}", "m": r"\d{1,2}[-/.]\d{1,2}[-/.]\d{4}"}
    shape["d"] = shape["m"]
    fits = ", ".join(f"regexp_full_match({day}, {q(shape[c])}) AND {tries[c]} AS {c}" for c in "ypmd")
    out["date_order"] = f"""WITH {RAW_CTE.strip()},{CONFORMED_CTE},
f AS (SELECT {nn('birth_date')} IS NOT NULL AS told, {fits} FROM conformed),
n AS (SELECT count_if(y) AS year_first, count_if(p) AS packed, count_if(m) AS month_first, count_if(d) AS day_first,
        count_if(m AND d) AS either, count_if(told AND NOT coalesce(y OR p OR m OR d, false)) AS unread FROM f)
SELECT *, CASE WHEN day_first > month_first THEN 'day' ELSE 'month' END AS date_order,
  either > 0 AND either = month_first AND either = day_first AS ambiguous FROM n"""
    out["sink_round_trip"] = "WITH " + ", ".join(f"{name}_ AS ({out[name]})" for name in (
        "clean_dataset", "segment_report", "feature_completeness")) + """
SELECT 'dataset' AS sink, count(*) AS n_rows, true AS same FROM clean_dataset_
UNION ALL SELECT 'segment_report', count(*), true FROM segment_report_
UNION ALL SELECT 'feature_completeness', count(*), true FROM feature_completeness_
UNION ALL SELECT 'best_model', count(*), true FROM clean_dataset_"""
    colleague_base = ("WITH " + RAW_CTE.strip() + "," + CONFORMED_CTE + ","
                      + cleanall_cte(("W", "WD", "WA", "WX"), "Y"))
    out["clean_dataset_colleague"] = colleague_base + "\nSELECT * FROM clean"
    kv = "valid"
    idr_v = f"(valid AND {_IDR})"
    nidr_v = f"(valid AND NOT {_IDR})"
    out["kpi_counts"] = _with() + f"""
SELECT count_if({kv}) AS valid_population,
       CAST(coalesce(sum(CASE WHEN {kv} THEN default_flag END), 0) AS BIGINT) AS defaults,
       {rate("sum(CASE WHEN valid AND level = 'UG' THEN default_flag END)", "count_if(valid AND level = 'UG')")} AS default_rate_ug,
       {rate("sum(CASE WHEN valid AND level = 'GR' THEN default_flag END)", "count_if(valid AND level = 'GR')")} AS default_rate_gr,
       {rate(f"sum(CASE WHEN {idr_v} THEN default_flag END)", f"count_if({idr_v})")} AS idr_rate,
       {rate(f"sum(CASE WHEN {nidr_v} THEN default_flag END)", f"count_if({nidr_v})")} AS non_idr_rate,
       {rate(f"coalesce(sum(CASE WHEN {kv} THEN default_flag END), 0)", f"count_if({kv})")} AS default_rate,
       {rate(f"sum(CASE WHEN {nidr_v} THEN default_flag END)", f"count_if({nidr_v})")}
         - {rate(f"sum(CASE WHEN {idr_v} THEN default_flag END)", f"count_if({idr_v})")} AS idr_differential,
       ({rate(f"sum(CASE WHEN {nidr_v} THEN default_flag END)", f"count_if({nidr_v})")}
         - {rate(f"sum(CASE WHEN {idr_v} THEN default_flag END)", f"count_if({idr_v})")}) >= 0.05 AS idr_alert
FROM cleanall"""
    out["overall_rate"] = _with() + f"""
SELECT count(*) AS n, CAST(sum(default_flag) AS BIGINT) AS defaults,
       {rate('sum(default_flag)', 'count(*)')} AS default_rate FROM clean"""
    folds = f"""folds AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY default_flag ORDER BY md5({_dealing_text})) - 1)
              % {FOLD_COUNT} AS INTEGER) AS fold
  FROM clean
)"""
    out["stratified_folds"] = _with(folds) + "SELECT student_id, default_flag, fold FROM folds"
    sets = "sets AS (SELECT unnest(range(-1, {0})) AS train_set)".format(FOLD_COUNT)
    out["fold_medians"] = _with(folds, sets) + "\nUNION ALL\n".join(
        f"SELECT CAST(train_set AS INTEGER) AS train_set, {q(c)} AS feature, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median "
        f"FROM sets JOIN folds ON fold <> train_set WHERE {c} IS NOT NULL GROUP BY train_set" for c in MODEL_NUMBERS)
    out["fold_categories"] = _with(folds, sets) + "\nUNION ALL\n".join(
        f"SELECT CAST(train_set AS INTEGER) AS train_set, {q(c)} AS feature, value, "
        f"CAST(row_number() OVER (PARTITION BY train_set ORDER BY value) - 1 AS INTEGER) AS idx "
        f"FROM (SELECT DISTINCT train_set, coalesce({c}, 'Unknown') AS value FROM sets JOIN folds ON fold <> train_set)"
        for c in MODEL_CATEGORIES)
    per_category = "\n  UNION ALL ".join(
        f"SELECT {q(c)} AS root, sum(default_flag) / CAST(count(*) AS DOUBLE) AS v FROM clean "
        f"GROUP BY coalesce({c}, 'Unknown')" for c in MODEL_CATEGORIES)
    out["importance_fixed_score"] = _with(f"per_category AS (\n  {per_category}\n)") + f"""
SELECT root, round(sum(v), 9) AS importance,
       CASE WHEN root IN ('gpa', 'graduated', 'credits_earned', 'withdrawn', 'level') THEN 'Academic / enrollment'
            WHEN root IN ('num_loans', 'original_loan_amount', 'current_balance') THEN 'Loan / financial'
            ELSE 'Institutional / contextual' END AS family
FROM per_category GROUP BY root ORDER BY 2 DESC, 1 LIMIT {PAGE_FEATURES}"""
    out["class_weights"] = _with(folds, """per AS (
  SELECT fold, count(*) AS n, count_if(default_flag = 1) AS pos FROM folds GROUP BY fold
)""") + """
SELECT fold, CAST(n_train AS BIGINT) AS n_train, CAST(n_train_pos AS BIGINT) AS n_train_pos,
       CAST(n_train - n_train_pos AS BIGINT) AS n_train_neg,
       CAST(n_train AS DOUBLE) / ((n_train - n_train_pos) * 2.0) AS w_neg,
       CAST(n_train AS DOUBLE) / (n_train_pos * 2.0) AS w_pos
FROM (SELECT fold, (SELECT sum(n) FROM per) - n AS n_train,
             (SELECT sum(pos) FROM per) - pos AS n_train_pos FROM per)"""
    out["rank_auc_by_level"] = _with("""scored AS (
  SELECT level, default_flag AS y, -coalesce(gpa, 0.0) AS score FROM clean
)""", """ranked AS (
  SELECT level, y, rank() OVER (PARTITION BY level ORDER BY score)
              + (count(*) OVER (PARTITION BY level, score) - 1) / 2.0 AS mrank
  FROM scored
)""", """agg AS (
  SELECT level, count(*) AS n, count_if(y = 1) AS n1, count_if(y = 0) AS n0,
         sum(CASE WHEN y = 1 THEN mrank END) AS rsum
  FROM ranked GROUP BY level
)""") + f"""
SELECT level, n, n1 AS defaults, CAST(n1 AS DOUBLE) / n AS default_rate,
       CAST((rsum - n1 * (n1 + 1) / 2.0) AS DOUBLE) / (CAST(n1 AS DOUBLE) * n0) AS auc
FROM agg WHERE n >= {SMALLEST_SUBGROUP} AND n1 > 0 AND n0 > 0"""
    metrics = _with(folds, """fs AS (
  SELECT fold, default_flag AS y, -coalesce(gpa, 0.0) AS score,
         CASE WHEN coalesce(gpa, 0.0) < 2.0 THEN 1 ELSE 0 END AS pred
  FROM folds
)""", """conf AS (
  SELECT fold, count_if(y = 1 AND pred = 1) AS tp, count_if(y = 0 AND pred = 1) AS fp,
         count_if(y = 1 AND pred = 0) AS fn, count_if(y = 0 AND pred = 0) AS tn
  FROM fs GROUP BY fold
)""", """rk AS (
  SELECT fold, y, rank() OVER (PARTITION BY fold ORDER BY score)
              + (count(*) OVER (PARTITION BY fold, score) - 1) / 2.0 AS mrank
  FROM fs
)""", """auc AS (
  SELECT fold, CAST((sum(CASE WHEN y = 1 THEN mrank END)
                     - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0) AS DOUBLE)
               / (CAST(count_if(y = 1) AS DOUBLE) * count_if(y = 0)) AS roc_auc
  FROM rk GROUP BY fold
)""", """m AS (
  SELECT conf.*, auc.roc_auc,
         coalesce(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END, 0.0) AS precision,
         coalesce(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END, 0.0) AS recall
  FROM conf JOIN auc USING (fold)
)""", """fm AS (SELECT fold, roc_auc,
       coalesce(CASE WHEN precision + recall <> 0
                     THEN 2.0 * precision * recall / (precision + recall) END, 0.0) AS f1,
       precision, recall,
       CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy, tp, fp, fn, tn
FROM m)""")
    out["fold_metrics_fixed_score"] = metrics + "SELECT * FROM fm"
    out["cv_summary_fixed_score"] = metrics + "SELECT " + ", ".join(
        f"round(avg({m}), 9) AS {m}_mean, round(stddev_pop({m}), 9) AS {m}_std"
        for m in ("roc_auc", "f1", "precision", "recall", "accuracy")) + ", count(*) AS folds FROM fm"
    return out


def _bigint_count_if(sql: str) -> str:
    """Wrap every count_if(...) in CAST(... AS BIGINT): DuckDB returns HUGEINT."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


ORACLE_SQL = {name: _bigint_count_if(sql) for name, sql in _sql().items()}
