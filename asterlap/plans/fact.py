"""From staged visits to the fact table: number parsing, key resolution, unknown members, margins, rollups."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.measures import SCALES, from_units, quantity, to_units, units, visit_amount, visit_mean
from ..operators.joins import BROADCAST_ROWS, hot_keys, lookup, worth_broadcasting
from ..operators.members import member_totals
from ..schemas import STAGING
from .dims import UNKNOWN

_TEXTS = {
    "ServiceCost": ("ServiceCostText", C.MONEY),
    "Profit": ("ProfitText", C.MONEY),
    "RepeatRate": ("RepeatRateText", C.RATE),
    "AvgTreatmentCost": ("AvgTreatmentCostText", C.MONEY),
}
_ORDER = [
    "FactID", "DateID", "PatientID", "DoctorID", "DiagnosisID", "VisitTypeID",
    "ServiceCost", "VisitCount", "Profit", "PatientCount", "RepeatRate", "AvgTreatmentCost",
]

# Per dimension: business key, surrogate key, attributes as the wide visit table names them.
LOOKUPS = {
    "date": ("DateID", "DateKey", {c: c for c in [
        "FullDate", "Year", "Month", "QuarterNumber", "MonthName", "WeekDayName", "IsWeekend", "AcademicPeriod",
    ]}),
    "visit_type": ("VisitTypeID", "VisitTypeKey", {"VisitName": "VisitName", "VisitCategory": "VisitCategory"}),
    "patient": ("PatientID", "PatientKey", {"FullName": "PatientName", "Age": "Age", "AgeBand": "AgeBand"}),
    "doctor": ("DoctorID", "DoctorKey", {
        "FullName": "DoctorName", "Specialty": "Specialty", "SpecialtyGroup": "SpecialtyGroup",
    }),
    "diagnosis": ("DiagnosisID", "DiagnosisKey", {
        "ICDCode": "ICDCode", "DiagnosisName": "DiagnosisName", "DiagnosisClass": "DiagnosisClass",
    }),
}


def normalise_visits(raw: DataFrame) -> DataFrame:
    """Visits with their number texts read, unreadable ones as NULL; other columns, such as the lineage, stay."""
    extra = [c for c in raw.columns if c not in _ORDER and c not in [text for text, _ in _TEXTS.values()]]
    return raw.select(
        *[C.parse_number(F.col(_TEXTS[c][0]), _TEXTS[c][1]).alias(c) if c in _TEXTS else F.col(c) for c in _ORDER], *extra
    )


def strict_visits(text: DataFrame, file_name: str = "FactVisits.csv") -> DataFrame:
    """Visits of a file whose columns all came as text, every value read strictly.

    A value that can't be read, or a whole number that is missing, fails the job with the file, the row's FactID, the
    column and the value: the first such column of the row.
    """
    row = F.concat(F.lit(f"{file_name}, FactID "), F.coalesce("FactID", F.lit("<NULL>")), F.lit(": "))
    kinds = {f.name: f.dataType.simpleString() for f in STAGING["visits"].fields}
    read = {c: C.parse_number_strict(F.col(t), kind, F.concat(row, F.lit(f"{t} "))) for c, (t, kind) in _TEXTS.items()}
    whole = {c: C.parse_whole_strict(F.col(c), kinds[c], F.concat(row, F.lit(f"{c} "))) for c in _ORDER if c not in _TEXTS}
    return text.select(*[(read | whole)[c].alias(c) for c in _ORDER])


def current_members(name: str, dimension: DataFrame) -> DataFrame:
    """Current members with both keys and the attributes as the wide visit table names them."""
    business_key, surrogate_key, attributes = LOOKUPS[name]
    current = dimension.filter("IsCurrent") if "IsCurrent" in dimension.columns else dimension
    return current.select(business_key, surrogate_key, *[F.col(c).alias(a) for c, a in attributes.items()])


def resolve_visits(
    visits: DataFrame, dimensions: dict[str, DataFrame], spread: str = "VisitKey", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Normalised visits with the surrogate key and attributes of each dimension's current row (NULL if none).

    Five lookups, each a broadcast behind a size check or a shuffle that spreads hot keys. The shuffled ones come
    first, while the rows are still narrow. All hot keys are found in one pass over the visits.
    """
    members = {name: current_members(name, dimensions[name]) for name in LOOKUPS}
    small = {name: worth_broadcasting(df, visits, broadcast_rows) for name, df in members.items()}
    large_keys = [LOOKUPS[name][0] for name in LOOKUPS if not small[name]]
    hot = hot_keys(visits, large_keys) if large_keys else {}
    result = visits
    for name in sorted(LOOKUPS, key=small.get):
        business_key = LOOKUPS[name][0]
        result = lookup(result, members[name], business_key, spread, hot.get(business_key), broadcast=small[name])
    return result


def _delivered(business_key: str) -> str:
    return f"Delivered{business_key}"


def _measures() -> dict[str, Column]:
    zero = F.lit(0)
    return {
        "ServiceCost": F.coalesce("ServiceCost", zero.cast(C.MONEY)),
        "VisitCount": F.coalesce("VisitCount", zero),
        "Profit": F.coalesce("Profit", zero.cast(C.MONEY)),
        "PatientCount": F.coalesce("PatientCount", zero),
        "RepeatRate": F.coalesce("RepeatRate", zero.cast(C.RATE)),
        "AvgTreatmentCost": F.coalesce("AvgTreatmentCost", zero.cast(C.MONEY)),
        "MarginPercent": C.margin_percent(F.col("ServiceCost"), F.col("Profit")),
    }


MEASURES = [
    "ServiceCost", "Profit", "MarginPercent", "VisitCount", "PatientCount", "RepeatRate", "AvgTreatmentCost",
]
_MEASURE_TYPES = {
    "ServiceCost": C.MONEY, "Profit": C.MONEY, "AvgTreatmentCost": C.MONEY, "RepeatRate": C.RATE, "MarginPercent": C.RATE,
}


def wide_visits(resolved: DataFrame, batch_id: int | None, loaded_at: Column) -> DataFrame:
    """The stored form of the visits: IDs as delivered, surrogate keys, attributes, measures, batch and load time.

    An unresolved reference has key 0 and the unknown member's attributes; an unreadable number is 0. Decimals are
    kept as whole numbers of their smallest unit. The fact table, the detailed visits and the missing-reference
    report are projections of this one table, and filters on its attributes reach the files.
    """
    columns = [F.col("VisitKey"), F.col("FactID")]
    for name, (business_key, surrogate_key, attributes) in LOOKUPS.items():
        unresolved = F.col(surrogate_key).isNull()
        columns.append(F.col(business_key).alias(_delivered(business_key)))
        columns.append(F.coalesce(surrogate_key, F.lit(0)).alias(surrogate_key))
        for source, alias in attributes.items():
            value = UNKNOWN[name].get(source)
            filled = F.col(alias) if value is None else F.when(unresolved, value).otherwise(F.col(alias))
            columns.append(filled.alias(alias))
    measures = _measures()
    return resolved.select(
        *columns, *[to_units(measures[c], c) if c in SCALES else measures[c].alias(c) for c in MEASURES],
        F.lit(batch_id).cast("int").alias("SourceBatchID"), loaded_at.alias("LoadedAt"),
    )


def laid_out(wide: DataFrame) -> DataFrame:
    """The wide visits as they are stored: sorted within each task, without another shuffle, by what visits are picked by,
    fewest values first: kind of visit, month, doctor. Readers then pass over the row groups and pages of a file whose
    least and largest values don't fit a filter. The keys make one number, which sorts fastest."""
    place = F.shiftleft(F.coalesce("VisitTypeKey", F.lit(0)).cast("long"), 56) + F.shiftleft(F.coalesce("Month", F.lit(0)).cast("long"), 48)
    return wide.sortWithinPartitions(place + F.col("DoctorKey"))


def identified(normalised: DataFrame) -> DataFrame:
    """Visits that become facts. They are stored on their own, so that no query has to read FactID to tell."""
    return normalised.filter("FactID IS NOT NULL")


def unidentified(normalised: DataFrame) -> DataFrame:
    """Visits without a FactID: never facts, but their references are checked like all others."""
    return normalised.filter("FactID IS NULL")


def _facts(wide: DataFrame, wanted: list[str], with_units: bool) -> DataFrame:
    """Columns of the facts; a business ID is 0 where its reference is unresolved.

    ``with_units`` adds the measures in their smallest units, which the aggregations add up.
    """
    known = {
        business_key: F.when(F.col(key) == 0, 0).otherwise(F.col(_delivered(business_key)))
        for business_key, key, _ in LOOKUPS.values()
    }
    known |= {c: from_units(F.col(units(c)), c, dtype) for c, dtype in _MEASURE_TYPES.items()}
    extra = [units(c) for c in SCALES] if with_units else []
    return wide.select(*[known.get(c, F.col(c)).alias(c) for c in wanted], *extra)


def fact_visits(wide: DataFrame, with_units: bool = False) -> DataFrame:
    """The fact table: surrogate keys and measures, and the batch that loaded them."""
    keys = [key for _, key, _ in LOOKUPS.values()]
    return _facts(wide, ["VisitKey", "FactID", *keys, *MEASURES, "SourceBatchID", "LoadedAt"], with_units)


def visit_detailed(wide: DataFrame, with_units: bool = False) -> DataFrame:
    """Each fact row beside its dimension attributes: the star join, without a join."""
    return _facts(wide, [
        "VisitKey", "FactID",
        "FullDate", "Year", "Month", "QuarterNumber", "MonthName", "WeekDayName", "IsWeekend", "AcademicPeriod",
        "PatientID", "PatientName", "Age", "AgeBand",
        "DoctorID", "DoctorName", "Specialty", "SpecialtyGroup",
        "DiagnosisID", "ICDCode", "DiagnosisName", "DiagnosisClass",
        "VisitTypeID", "VisitName", "VisitCategory", *MEASURES,
    ], with_units)


def compat_visits(wide: DataFrame, with_units: bool = False) -> DataFrame:
    """Fact rows by business ID."""
    return _facts(wide, _ORDER, with_units)


def orphan_tests() -> dict[str, Column]:
    """For each reference, whether a row of ``wide_visits`` names a member that its dimension doesn't know."""
    return {
        business_key: (F.col(key) == 0) & F.col(_delivered(business_key)).isNotNull() & (F.col(_delivered(business_key)) != 0)
        for business_key, key, _ in LOOKUPS.values()
    }


def orphan_report(wide: DataFrame) -> DataFrame:
    """Reference, ErrorType, KeyValue, KeyRows of all keys that were not found, from one scan."""
    named = F.array_compact(F.array(*[
        F.when(test, F.struct(F.lit(c).alias("Reference"), F.col(_delivered(c)).cast("string").alias("KeyValue")))
        for c, test in orphan_tests().items()
    ]))
    each = wide.select(F.inline(named)).groupBy("Reference", "KeyValue").agg(F.count(F.lit(1)).alias("KeyRows"))
    return each.select("Reference", F.lit("KeyNotFound").alias("ErrorType"), "KeyValue", "KeyRows")


def unresolved_visits(wide: DataFrame) -> DataFrame:
    """Visits with at least one reference no dimension knows, by the IDs as delivered."""
    missing = F.lit(False)
    for business_key, key, _ in LOOKUPS.values():
        delivered = F.col(_delivered(business_key))
        missing = missing | ((F.col(key) == 0) & (delivered.isNull() | (delivered != 0)))
    ids = [F.col(_delivered(business_key)).alias(business_key) for business_key, _, _ in LOOKUPS.values()]
    return wide.filter(missing).select("FactID", *ids)


def _month_totals(wide: DataFrame, key: str, members: DataFrame | None, *means: Column) -> DataFrame:
    """Totals per year, month and ``key``; facts of the unknown date keep their own NULL month."""
    totals = member_totals(wide, key, [], ["Year", "Month"], [
        quantity("VisitCount", "VisitQty"),
        visit_amount("ServiceCost", "RevenueAmount"),
        visit_amount("Profit", "ProfitAmount"),
        *means,
        F.max("LoadedAt").alias("LoadedAt"),
    ], members)
    return totals.select("Year", "Month", key, *[c for c in totals.columns if c not in ("Year", "Month", key)])


def doctor_months(wide: DataFrame, members: DataFrame | None = None) -> DataFrame:
    return _month_totals(
        wide, "DoctorKey", members,
        visit_mean("ServiceCost", C.MONEY, "AvgRevenuePerVisit"), visit_mean("Profit", C.MONEY, "AvgProfitPerVisit"),
    )


def diagnosis_months(wide: DataFrame, members: DataFrame | None = None) -> DataFrame:
    return _month_totals(wide, "DiagnosisKey", members, visit_mean("RepeatRate", C.RATE, "RepeatRateAvg"))
