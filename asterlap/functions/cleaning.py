"""Column expressions that clean staged values. All stay inside Spark's own expressions, no Python UDF."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import literals as L

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"


# A plain number, with a decimal comma or point; no exponents, no digit groups.
_NUMBER = r"^\s*[+-]?(\d+([.,]\d*)?|[.,]\d+)\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"


def parse_number(text: Column, target: str) -> Column:
    """Lenient number: a decimal comma is accepted, anything unreadable becomes NULL."""
    return F.replace(F.when(text.rlike(_NUMBER), text), F.lit(","), F.lit(".")).try_cast(target)


def _or_fail(text: Column, readable: Column, where: Column | str) -> Column:
    where = F.lit(where) if isinstance(where, str) else where
    message = F.concat(where, F.lit("is not a number: "), F.coalesce(text, F.lit("<NULL>")))
    return F.when(readable, text).otherwise(F.raise_error(message))


def parse_number_strict(text: Column, target: str, where: Column | str = "value ") -> Column:
    """The same reading, but an unreadable value fails the job, with ``where`` in its message."""
    plain = _or_fail(text, text.isNull() | text.rlike(_NUMBER), where)
    return F.replace(plain, F.lit(","), F.lit(".")).cast(target)


def parse_whole_strict(text: Column, target: str, where: Column | str = "value ") -> Column:
    """A whole number, which must be there."""
    return F.trim(_or_fail(text, text.isNotNull() & text.rlike(_WHOLE), where)).cast(target)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def phone_digits(phone: Column) -> Column:
    """Phone without outer blanks, spaces, plus and minus signs."""
    return F.translate(phone, " +-", "")


def first_match(cases: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first case whose test holds."""
    result = F.lit(default)
    for test, label in reversed(cases):
        result = F.when(test, label).otherwise(result)
    return result


def age_band(age: Column) -> Column:
    cases = [(age.isNull(), L.UNDEFINED)]
    cases += [(age <= highest, label) for _, highest, label in L.AGE_BANDS if highest is not None]
    return first_match(cases, L.AGE_BANDS[-1][2])


def age_is_valid(age: Column) -> Column:
    return age.isNull() | age.between(L.MIN_AGE, L.MAX_AGE)


def specialty_group(specialty: Column) -> Column:
    """Tested on the value as delivered, before trimming."""
    return first_match([(specialty == name, group) for name, group in L.SPECIALTY_GROUPS.items()], L.OTHER_GROUP)


def diagnosis_class(icd_code: Column) -> Column:
    """Class by ICD prefix, tested on the value as delivered, before trimming."""
    cases = [(icd_code.startswith(prefix), label) for prefix, label in L.DIAGNOSIS_CLASSES.items()]
    return first_match(cases, L.OTHER_DIAGNOSIS)


def visit_category(code: Column) -> Column:
    cleaned = F.upper(F.trim(code))
    return first_match([(cleaned == key, label) for key, label in L.VISIT_CATEGORIES.items()], L.OTHER_VISIT)


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """Date of three integers, NULL when no such day exists.

    The ranges are tested first because ``lpad`` would cut a longer number short.
    """
    in_range = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    text = F.concat(
        F.lpad(year.cast("string"), 4, "0"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(day.cast("string"), 2, "0"),
    )
    return F.try_to_date(F.when(in_range, text), "yyyyMMdd")


def is_weekend(date: Column) -> Column:
    return F.coalesce(F.weekday(date).isin(5, 6), F.lit(False))


def weekday_name(date: Column) -> Column:
    names = F.array(*[F.lit(name) for name in L.WEEKDAYS])
    return F.get(names, F.weekday(date))


def academic_period(month: Column) -> Column:
    return first_match([(month.between(first, last), label) for first, last, label in L.PERIODS], L.UNDEFINED)


def margin_percent(cost: Column, profit: Column) -> Column:
    """Profit in percent of cost; 0 without a cost, NULL when only the profit is unknown."""
    no_cost = cost.isNull() | (cost == 0)
    percent = F.round(profit / F.when(cost != 0, cost) * F.lit(100).cast("decimal(4,1)"), 4)
    return F.when(no_cost, F.lit(0).cast(RATE)).otherwise(percent.cast(RATE))


def shown(value: Column) -> Column:
    """Value as it appears inside a payload text."""
    return F.coalesce(value.cast("string"), F.lit("<NULL>"))


def shown_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))
