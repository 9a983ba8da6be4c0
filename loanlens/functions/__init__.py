"""Column -> Column functions.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# A plain decimal number; what a CSV reader would turn into a float.
NUMERIC_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
CURRENCY_SYMBOLS = r"[\$,]"
# Text a CSV reader treats as missing (pandas' default NA tokens).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
LEVEL_LABELS = {"UG": "UG — Undergraduate", "GR": "GR — Graduate"}
GPA_EDGES = (0.0, 2.0, 2.5, 3.0, 3.5, 4.0)
GPA_LABELS = ("< 2.0", "2.0–2.5", "2.5–3.0", "3.0–3.5", "3.5–4.0")
AGE_EDGES = (0.0, 20.0, 25.0, 30.0, 40.0, 120.0)
AGE_LABELS = ("< 20", "20–24", "25–29", "30–39", "40+")
LOAN_EDGES = (0.0, 5000.0, 15000.0, 30000.0, 50000.0, 999999.0)
LOAN_LABELS = ("< $5K", "$5K–$15K", "$15K–$30K", "$30K–$50K", "> $50K")
ACADEMIC_FEATURES = ("gpa", "graduated", "credits_earned", "withdrawn", "level")
LOAN_FEATURES = ("num_loans", "original_loan_amount", "current_balance")
FAMILY_ACADEMIC = "Academic / enrollment"
FAMILY_LOAN = "Loan / financial"
FAMILY_OTHER = "Institutional / contextual"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.strip() removes, derived from str.isspace()
# (tabs, newlines, no-break space, ...). Trimming a character set is a plain
# scan of both ends, much cheaper per row than a regex replace.
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def normalize_str(c: ColumnOrName) -> Column:
    """Strip all leading/trailing white space (tabs, newlines too)."""
    return F.btrim(_c(c).cast("string"), F.lit(WHITESPACE))


def normalize_str_upper(c: ColumnOrName) -> Column:
    """D1 then upper case."""
    return F.upper(normalize_str(c))


# Largest finite double; a decimal beyond it would be read as infinity.
MAX_DOUBLE = 1.7976931348623157e308


def to_numeric(c: ColumnOrName) -> Column:
    """D3: text -> finite double; anything that is not a plain number becomes null.

    The pattern guard keeps Spark's lenient casts ('1.5d', 'NaN', 'Infinity')
    out, ``try_cast`` keeps ANSI mode from failing the job, and a number too
    large for a double is null rather than infinity.
    """
    return finite(plain_number(normalize_str(c)))


def plain_number(stripped: ColumnOrName) -> Column:
    """D3 on stripped text, before infinity is taken out."""
    s = _c(stripped)
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def finite(v: ColumnOrName) -> Column:
    return F.when(F.abs(_c(v)) <= F.lit(MAX_DOUBLE), _c(v))


def without_currency(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c).cast("string"), CURRENCY_SYMBOLS, "")


def clean_currency(c: ColumnOrName) -> Column:
    """Drop '$' and ',' then D3."""
    return to_numeric(without_currency(c))


def delinquent_days(c: ColumnOrName) -> Column:
    """Missing or unparseable days count as 0."""
    return F.coalesce(to_numeric(c), F.lit(0.0))


def default_flag(days: ColumnOrName, threshold: int) -> Column:
    """1 when days are strictly above the threshold."""
    return (_c(days) > F.lit(float(threshold))).cast("int")


def na_to_null(c: ColumnOrName) -> Column:
    """D7 + D1: stripped text, with CSV missing-value tokens as null."""
    return known(normalize_str(c))


def known(stripped: ColumnOrName) -> Column:
    """Stripped text, with missing-value tokens as null."""
    s = _c(stripped)
    return F.when(~s.isin(*NA_TOKENS), s)


# Dates as exports write them: three numbers with one kind of separator, or eight
# digits, padded or not, with an optional time of day that does not matter here.
_TIME = r"(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?: ?[AaPp][Mm])?(?:Z|[+-]\d{2}:?\d{2})?)?"
DATE_SHAPE = rf"^(\d{{1,4}}([-/.])\d{{1,2}}\2\d{{1,4}}|\d{{8}}){_TIME}$"


def date_parts(c: ColumnOrName) -> Column:
    """The numbers of a date text in the order written (eight digits: one element); empty for other texts."""
    return parts_of(date_text(c))


def date_text(c: ColumnOrName) -> Column:
    """The date in a text, without its time of day; empty for other texts."""
    return F.regexp_extract(normalize_str(c), DATE_SHAPE, 1)


def parts_of(date: ColumnOrName) -> Column:
    return F.when(_c(date) != "", F.split(_c(date), "[-/.]"))


def _date(parts: Column, order: tuple[int, int, int]) -> Column:
    return F.to_date(F.try_to_timestamp(F.concat_ws("-", *[F.get(parts, F.lit(k)) for k in order]), F.lit("yyyy-M-d")))


def year_first(parts: Column) -> Column:
    return F.coalesce((F.size(parts) == 3) & (F.length(F.get(parts, F.lit(0))) == 4)
                      & (F.length(F.get(parts, F.lit(2))) <= 2), F.lit(False))


def year_last(parts: Column) -> Column:
    return F.coalesce((F.size(parts) == 3) & (F.length(F.get(parts, F.lit(0))) <= 2)
                      & (F.length(F.get(parts, F.lit(2))) == 4), F.lit(False))


def parse_date(c: ColumnOrName, day_first: bool = False) -> Column:
    """Date of a text that begins or ends with its year; otherwise null (never fails).

    ``day_first`` reads the two numbers before a final year as day and month;
    :func:`loanlens.operators.dates.date_order` finds out which a column has.
    """
    return date_of(date_parts(c), day_first)


def date_of(parts: Column, day_first: bool = False) -> Column:
    """D8 on the parts of a date text."""
    packed = F.to_date(F.try_to_timestamp(F.get(parts, F.lit(0)), F.lit("yyyyMMdd")))
    return (F.when(year_first(parts), _date(parts, (0, 1, 2)))
            .when(year_last(parts), _date(parts, (2, 1, 0) if day_first else (2, 0, 1)))
            .when(F.size(parts) == 1, packed))


def age_years(birth: ColumnOrName, as_of: str) -> Column:
    """Whole years as floor(days / 365.25), as a double."""
    days = F.datediff(F.to_date(F.lit(as_of)), _c(birth))
    return F.floor(days / F.lit(365.25)).cast("double")


def flag_equals(c: ColumnOrName, value: str) -> Column:
    """1 when the stripped, upper-cased text equals ``value``; null -> 0."""
    return F.coalesce(normalize_str_upper(c) == F.lit(value.upper()), F.lit(False)).cast("int")


def flag_in(c: ColumnOrName, codes: Iterable[str]) -> Column:
    """1 when the stripped, upper-cased text is one of ``codes``; null -> 0."""
    codes = [x.upper() for x in codes]
    return F.coalesce(normalize_str_upper(c).isin(*codes), F.lit(False)).cast("int")


def map_or_keep(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Look ``c`` up in a literal map; keep the value when it is not a key."""
    if not mapping:
        return _c(c)
    if isinstance(c, str):
        x = _ident(c)
        arms = " ".join(f"WHEN {_sql_str(k)} THEN {_sql_str(v)}" for k, v in mapping.items())
        return F.expr(f"coalesce(CASE {x} {arms} END, {x})")
    col = _c(c)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col), col)


def level_code(c: ColumnOrName, level_map: dict[str, str]) -> Column:
    """Strip + upper, then map through the profile's level map."""
    return map_or_keep(normalize_str_upper(c), level_map)


def level_label(c: ColumnOrName) -> Column:
    """Display label of a level code."""
    return map_or_keep(c, LEVEL_LABELS)


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def band(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ...; null outside.

    Given a column name, the CASE is built as one SQL expression (one JVM
    call instead of dozens of Column calls; same plan).
    """
    pairs = list(zip(edges[:-1], edges[1:], labels))
    if isinstance(c, str):
        x = _ident(c)
        arms = " ".join(f"WHEN {x} > {float(lo)!r}D AND {x} <= {float(hi)!r}D THEN {_sql_str(lab)}"
                        for lo, hi, lab in pairs)
        return F.expr(f"CASE {arms} END")
    col = _c(c)
    expr = None
    for lo, hi, label in pairs:
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def band_ordinal(c: ColumnOrName, edges: Sequence[float]) -> Column:
    """Position (0-based) of the right-closed bin; null outside."""
    pairs = list(zip(edges[:-1], edges[1:]))
    if isinstance(c, str):
        x = _ident(c)
        arms = " ".join(f"WHEN {x} > {float(lo)!r}D AND {x} <= {float(hi)!r}D THEN {i}"
                        for i, (lo, hi) in enumerate(pairs))
        return F.expr(f"CASE {arms} END")
    col = _c(c)
    expr = None
    for i, (lo, hi) in enumerate(pairs):
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def gpa_band(c: ColumnOrName) -> Column:
    return band(c, GPA_EDGES, GPA_LABELS)


def age_band(c: ColumnOrName) -> Column:
    return band(c, AGE_EDGES, AGE_LABELS)


def loan_band(c: ColumnOrName) -> Column:
    return band(c, LOAN_EDGES, LOAN_LABELS)


def idr_flag(plan: ColumnOrName, pattern: str) -> Column:
    """Plan name matches an income-driven plan; null plan -> False."""
    return F.coalesce(F.lower(normalize_str(plan)).rlike(pattern), F.lit(False))


def rate_flag(rate: ColumnOrName, overall: ColumnOrName, band_width: float) -> Column:
    """D17: 'above' / 'below' the overall rate by more than the band, else 'near'."""
    r, o = _c(rate), _c(overall)
    return (F.when(r > o + F.lit(band_width), F.lit("above"))
            .when(r < o - F.lit(band_width), F.lit("below"))
            .otherwise(F.lit("near")))


def percent_text(rate: ColumnOrName) -> Column:
    """One-decimal percent text.

    ``format_number`` rounds the exact binary value half-to-even, which is
    what Python's ``f"{x:.1%}"`` does (1/16 -> '6.2%', 3/2000 -> '0.1%');
    ``format_string``/``bround`` round the shortest decimal text instead.
    """
    return F.concat(F.format_number(_c(rate) * F.lit(100.0), 1), F.lit("%"))


def display_round(c: ColumnOrName, digits: int = 4) -> Column:
    """Half-to-even rounding for display views; tables keep full precision."""
    return F.bround(_c(c), digits)


def safe_rate(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Num / den as double, null for an empty population."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def feature_family(name: ColumnOrName) -> Column:
    """Feature family of a (rolled-up) feature name."""
    n = _c(name)
    return (F.when(n.isin(*ACADEMIC_FEATURES), F.lit(FAMILY_ACADEMIC))
            .when(n.isin(*LOAN_FEATURES), F.lit(FAMILY_LOAN))
            .otherwise(F.lit(FAMILY_OTHER)))


def corr_direction(r: ColumnOrName) -> Column:
    """D23: '+' for r >= 0, '-' otherwise."""
    return F.when(_c(r) >= 0, F.lit("+")).when(_c(r) < 0, F.lit("-"))


def pair_complete(x: ColumnOrName, y: ColumnOrName) -> tuple[Column, Column]:
    """both inputs nulled where either is null."""
    xc, yc = _c(x), _c(y)
    both = xc.isNotNull() & yc.isNotNull()
    return F.when(both, xc.cast("double")), F.when(both, yc.cast("double"))


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson r as an aggregate; null (not an error) for a constant input.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant column, so r
    is built from covar_pop / (stddev_pop * stddev_pop) with ``try_divide``.
    """
    xp, yp = pair_complete(x, y)
    return F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp))
