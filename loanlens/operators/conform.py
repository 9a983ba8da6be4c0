"""Header conformance (P1-P4) and the level filter / reject report (F1, F2).

Header matching is pure driver-side metadata work on ``df.columns``; it runs
before any job and costs nothing at scale. The rename goes through ``toDF``
so headers with dots or blanks never have to be resolved as column paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions import level_code
from loanlens.sources.profiles import Profile


class HeaderError(ValueError):
    """Headers that a profile needs are absent or ambiguous."""


def resolve_headers(columns: list[str], profile: Profile) -> dict[str, str]:
    """Stripped file header -> canonical name.

    A header with the profile's exact spelling wins; otherwise exactly one
    header may equal it ignoring case. All problems are reported together.
    """
    headers = [str(c).strip() for c in columns]
    folded: dict[str, set[str]] = {}
    for h in headers:
        folded.setdefault(h.casefold(), set()).add(h)
    wanted = {}
    for header, canonical in profile.column_map:
        spellings = folded.get(header.casefold(), set())
        wanted[header] = (canonical, {header} if header in spellings else spellings)
    absent = [h for h, (_, found) in wanted.items() if not found]
    unclear = {h: sorted(found) for h, (_, found) in wanted.items() if len(found) > 1}
    problems = []
    if absent:
        problems.append(f"missing {len(absent)} column(s): {', '.join(absent)}")
    if unclear:
        problems.append("several columns differ only in case: " + "; ".join(
            f"{h} could be {' or '.join(found)}" for h, found in unclear.items()))
    if problems:
        raise HeaderError(f"profile {profile.display_name}: " + ". ".join(problems))
    return {found.pop(): canonical for canonical, found in wanted.values()}


def conform(df: DataFrame, profile: Profile) -> DataFrame:
    """Strip headers, rename to canonical names, map level codes.

    Columns the profile does not name are kept unchanged.
    """
    stripped = [str(c).strip() for c in df.columns]
    rename = resolve_headers(df.columns, profile)
    renamed = df.toDF(*[rename.get(c, c) for c in stripped])
    return renamed.withColumn("level", level_code("level", dict(profile.level_map)))


def valid_level(level_codes) -> F.Column:
    """F1 predicate (null level is not valid)."""
    return F.coalesce(F.col("level").isin(*level_codes), F.lit(False))


def filter_valid(df: DataFrame, level_codes) -> DataFrame:
    """keep canonical levels only."""
    return df.where(valid_level(level_codes))


def reject_report(conformed: DataFrame, level_codes) -> DataFrame:
    """rejected rows counted per (mapped) level value, null included."""
    return (conformed.where(~valid_level(level_codes))
            .groupBy("level").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "level"))                      # L8
