import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loanlens.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app_name="loanlens-tests")
    yield s
    s.stop()


# The two students that FIXTURES.md prescribes, by canonical field.
STUDENTS = (
    {
        "student_id": "U001",
        "level": "UG",
        "program": "CS",
        "major": "Computer Science",
        "student_type": "New",
        "campus_code": "MAIN",
        "birth_date": "2000-05-15",
        "state": "NH",
        "gpa": "3.5",
        "credits_earned": "60",
        "graduated_ind": "Y",
        "enrollment_status": "EE",
        "days_delinquent": "0",
        "num_loans": "1",
        "original_loan_amount": "$10,000",
        "current_balance": "$8,000",
        "payment_plan": "Standard",
    },
    {
        "student_id": "U002",
        "level": "GR",
        "program": "MBA",
        "major": "Business",
        "student_type": "Transfer",
        "campus_code": "ONLINE",
        "birth_date": "1998-03-20",
        "state": "ma",
        "gpa": "2.8",
        "credits_earned": "30",
        "graduated_ind": "N",
        "enrollment_status": "WD",
        "days_delinquent": "300",
        "num_loans": "2",
        "original_loan_amount": "$20,000",
        "current_balance": "$20,000",
        "payment_plan": "IBR",
    },
)


def banner_rows(**cells):
    """(headers, rows) of the two students; ``cells`` replaces whole columns by header."""
    from loanlens.sources.profiles import get_profile

    table = {h: cells.get(h, [s[f] for s in STUDENTS]) for h, f in get_profile("banner").column_map}
    return list(table), list(zip(*table.values()))


def text_df(spark, names, rows):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame(rows, schema)
