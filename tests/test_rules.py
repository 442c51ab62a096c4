from datetime import date
from itertools import product

import pytest
from pyspark.sql import functions as F

from tillstone.functions import rules



def test_title_case(evaluate):
    values = [" aNNA  lee ", "o'BRIEN-smith", None, ""]
    assert evaluate(lambda c: rules.title_case(c), values) == ["Anna  Lee", "O'brien-smith", None, ""]


def test_validate_email(evaluate):
    values = ["a@b.c", "a@b@c.d", "a.b@c.d", "ab.c", "a@bc", "", None]
    assert evaluate(lambda c: rules.validate_email(c), values) == ["a@b.c", "", "", "", "", "", None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2019-03-04", date(2019, 3, 4)),
        ("2019/3/4", date(2019, 3, 4)),
        ("2019-3-04", date(2019, 3, 4)),
        ("03/04/2019", date(2019, 3, 4)),  # month first
        ("3-4-2019", date(2019, 3, 4)),
        ("13/04/2019", date(2019, 4, 13)),  # can only be day first
        ("31-12-2019", date(2019, 12, 31)),
        (" 2019-03-04 ", date(2019, 3, 4)),
        ("2019-02-30", None),
        ("2019-03/04", None),
        ("31/31/2019", None),
        ("20190304", None),
        ("2019-03-04 10:00", None),
        ("-201-01-01", None),
        ("+201-01-01", None),
        ("2019-03", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_normalise_date(evaluate, text, expected):
    assert evaluate(lambda c: rules.normalise_date(c), [text]) == [expected]


def test_normalise_date_equals_the_twelve_patterns(evaluate):
    """Same results as trying every accepted pattern in order."""
    # The accepted patterns in order.
    patterns = [
        "yyyy-MM-dd", "yyyy/MM/dd", "yyyy-M-d", "yyyy/M/d", "MM-dd-yyyy", "MM/dd/yyyy",
        "M-d-yyyy", "M/d/yyyy", "dd-MM-yyyy", "dd/MM/yyyy", "d-M-yyyy", "d/M/yyyy",
    ]
    parts = ["1", "02", "12", "13", "29", "31", "00", "x", ""]
    years = ["2019", "2020", "1899", "19"]
    texts = [s.join(p) for s in "-/" for p in product(years, parts, parts)]
    texts += [s.join(p) for s in "-/" for p in product(parts, parts, years)]
    by_patterns = evaluate(lambda c: F.coalesce(*[F.try_to_date(c, p) for p in patterns]), texts)
    assert evaluate(rules.normalise_date, texts) == by_patterns


def test_bound_date(evaluate):
    values = [date(1899, 12, 31), date(1900, 1, 1), date(2019, 4, 30), date(2019, 5, 1), None]
    expected = [None, date(1900, 1, 1), date(2019, 4, 30), None, None]
    assert evaluate(lambda c: rules.bound_date(c, F.lit(date(2019, 4, 30))), values, "date") == expected
    far = [date(2999, 1, 1)]
    assert evaluate(lambda c: rules.bound_date(c), far, "date") == [None]


def test_standardise_gender(evaluate):
    values = ["m", "MALE", "f", "Female", "o", "OTHER", "mALE", "x", None]
    expected = ["Male", "Male", "Female", "Female", "Other", "Other", "mALE", "x", None]
    assert evaluate(lambda c: rules.standardise_gender(c), values) == expected


def test_standardise_flag(evaluate):
    values = ["y", "Yes", "TRUE", "true", "N", "1", "", None]
    assert evaluate(lambda c: rules.standardise_flag(c), values) == ["Y", "Y", "Y", "Y", "N", "N", "N", "N"]


def test_units(evaluate):
    values = ["12 oz", "1 lb", ".5 lb", ".9 oz", "3.0 OZ", "pump", "single", "box", "1.2.3 oz", None]
    assert evaluate(lambda c: rules.uom_value(c), values) == [12.0, 1.0, 0.5, 0.9, 3.0, None, None, None, None, None]
    unit = ["oz", "lb", "lb", "oz", "oz", "pump", "single", "unknown", "oz", "unknown"]
    assert evaluate(lambda c: rules.uom_class(c), values) == unit
    pounds = [0.75, 1.0, 0.5, 0.0563, 0.1875, None, None, None, None, None]
    assert evaluate(lambda c: rules.uom_to_lb(rules.uom_class(c), rules.uom_value(c)), values) == pounds


def test_strip_special_chars(evaluate):
    assert evaluate(lambda c: rules.strip_special_chars(c), ["An#na!", None]) == ["Anna", None]
    assert evaluate(lambda c: rules.strip_special_chars(c, keep="a-z"), ["A b-c"]) == ["bc"]


def test_blank_to_null(evaluate):
    assert evaluate(lambda c: rules.blank_to_null(c), [" a ", "  ", "", None]) == ["a", None, None, None]
