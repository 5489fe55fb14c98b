"""The seventy analytic queries. Each takes a warehouse and returns a DataFrame in its report order.

V, D, G, P and T below are the detailed visits and the doctor, diagnosis, patient and day marts. Where the
measure alone does not order the rows, names are added as last sort keys so that results are repeatable.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec

from .. import literals as L
from ..functions.cleaning import MONEY, RATE
from ..functions.measures import (
    AMOUNT, amount, mean, per, percent_of, quantity, rows, visit_amount, visit_mean,
)
from ..operators import audit, olap
from ..operators.olap import descending, totals
from ..operators.ordered import previous_value, rank_descending
from .warehouse import Warehouse

TOP_N = 5  # unless a query is asked for another number
# Means that are reported as computed keep six digits.
RAW_MEAN = "decimal(22,6)"

VISITS = {"VisitQty": "VisitCount"}
REVENUE = {"RevenueAmount": "ServiceCost"}
PROFIT = {"ProfitAmount": "Profit"}
ALL = VISITS | REVENUE | PROFIT
MART_ALL = {c: c for c in ALL}


def _v(wh: Warehouse) -> DataFrame:
    return wh.visits(with_units=True)


def _d(wh: Warehouse) -> DataFrame:
    return wh.table("doctor_performance")


def _g(wh: Warehouse) -> DataFrame:
    return wh.table("diagnosis_performance")


def _p(wh: Warehouse) -> DataFrame:
    return wh.table("patient_segment")


def _t(wh: Warehouse) -> DataFrame:
    return wh.table("time_series")


def _by_visits(dims: list[str], measures: dict[str, str], order: str):
    """Query that totals the detailed visits by some dimensions, largest ``order`` first."""
    return lambda wh: totals(_v(wh), dims, measures).orderBy(*descending(order, *dims))


def kpi_totals(wh: Warehouse) -> DataFrame:
    return _v(wh).agg(
        rows("FactRowQty"),
        quantity("VisitCount", "TotalVisits"),
        visit_amount("ServiceCost", "TotalRevenue"),
        visit_amount("Profit", "TotalProfit"),
        visit_mean("AvgTreatmentCost", RAW_MEAN, "MeanTreatmentCost"),
        visit_mean("RepeatRate", RAW_MEAN, "MeanRepeatRate"),
    )


def object_counts(wh: Warehouse) -> DataFrame:
    return audit.row_counts({
        "DimPatient": wh.dimension("patient").filter("IsCurrent"),
        "DimDoctor": wh.dimension("doctor").filter("IsCurrent"),
        "DimDate": wh.dimension("date").filter("FullDate IS NOT NULL"),
        "DimVisitType": wh.dimension("visit_type").filter("VisitTypeKey > 0"),
        "DimDiagnosis": wh.dimension("diagnosis").filter("IsCurrent"),
        "FactVisit": _v(wh),
    })


def by_year(wh: Warehouse) -> DataFrame:
    return totals(_t(wh), ["Year"], MART_ALL).orderBy("Year")


def by_month(wh: Warehouse) -> DataFrame:
    return totals(_t(wh), ["Year", "Month"], MART_ALL).orderBy("Year", "Month")


def avg_check_by_date(wh: Warehouse) -> DataFrame:
    check = per(F.col("RevenueAmount"), F.col("VisitQty")).alias("AvgCheck")
    return _t(wh).select("FullDate", "RevenueAmount", "VisitQty", check).orderBy("FullDate")


def date_range(wh: Warehouse) -> DataFrame:
    return _t(wh).agg(F.min("FullDate").alias("MinVisitDate"), F.max("FullDate").alias("MaxVisitDate"))


def drill_down_time(wh: Warehouse) -> DataFrame:
    dims = ["Year", "QuarterNumber", "Month"]
    return totals(_v(wh), dims, ALL).orderBy(*dims)


def _slice(category: str):
    def query(wh: Warehouse) -> DataFrame:
        chosen = _v(wh).filter(F.col("VisitCategory") == category)
        return totals(chosen, ["FullDate"], REVENUE | VISITS).orderBy("FullDate")

    return query


def dice(wh: Warehouse) -> DataFrame:
    chosen = _v(wh).filter(F.col("Specialty").isin("Terapevt", "Ortoped") & (F.col("AcademicPeriod") == L.AUTUMN))
    dims = ["Specialty", "AcademicPeriod"]
    return totals(chosen, dims, REVENUE | PROFIT).orderBy(*descending("RevenueAmount", *dims))


def season_by_class(wh: Warehouse) -> DataFrame:
    dims = ["AcademicPeriod", "DiagnosisClass"]
    return totals(_v(wh), dims, REVENUE | VISITS).orderBy("AcademicPeriod", *descending("RevenueAmount"))


def weekend_share(wh: Warehouse) -> DataFrame:
    day_type = F.when(F.col("IsWeekend"), L.WEEKEND).otherwise(L.WORKDAY)
    return totals(_v(wh).withColumn("DayType", day_type), ["DayType"], ALL).orderBy("DayType")


def _days() -> WindowSpec:
    """All days in order. The day mart has one row per calendar day, so the calendar bounds this window."""
    return Window.partitionBy().orderBy("FullDate")


def moving_average(wh: Warehouse) -> DataFrame:
    average = F.avg("RevenueAmount").over(_days().rowsBetween(-2, 0)).cast(MONEY)
    return _t(wh).select("FullDate", "RevenueAmount", average.alias("MovingAvg3")).orderBy("FullDate")


def _running(measure: str, alias: str):
    def query(wh: Warehouse) -> DataFrame:
        total = F.sum(measure).over(_days().rowsBetween(Window.unboundedPreceding, 0)).cast(AMOUNT)
        return _t(wh).select("FullDate", measure, total.alias(alias)).orderBy("FullDate")

    return query


def _doctor_rank(measure: str, alias: str):
    def query(wh: Warehouse) -> DataFrame:
        by_doctor = totals(_d(wh), ["DoctorName", "Specialty"], {measure: measure})
        ranked = rank_descending(by_doctor, measure, ["DoctorName", "Specialty"], rank=alias)
        return ranked.orderBy(alias, "DoctorName", "Specialty")

    return query


def _top_mean(mart, dims: list[str], measure: str, target: str):
    """The leading groups by the mean of a monthly mean."""
    def query(wh: Warehouse, top: int = TOP_N) -> DataFrame:
        return mart(wh).groupBy(*dims).agg(mean(measure, target)).orderBy(*descending(measure, *dims)).limit(top)

    return query


def rank_within_specialty(wh: Warehouse) -> DataFrame:
    by_doctor = totals(_d(wh), ["Specialty", "DoctorName"], {"RevenueAmount": "RevenueAmount"})
    ranked = rank_descending(
        by_doctor, "RevenueAmount", ["DoctorName"], ["Specialty"], dense_rank="RankWithinSpecialty"
    )
    return ranked.orderBy("Specialty", "RankWithinSpecialty", "DoctorName")


def doctor_margin(wh: Warehouse) -> DataFrame:
    dims = ["DoctorName", "Specialty"]
    margins = _d(wh).groupBy(*dims).agg(mean("AvgMarginPercent", RATE))
    return margins.orderBy(*descending("AvgMarginPercent", *dims))


def doctor_month(wh: Warehouse) -> DataFrame:
    return _d(wh).select("DoctorName", "Year", "Month", "RevenueAmount").orderBy("DoctorName", "Year", "Month")


def doctor_month_delta(wh: Warehouse) -> DataFrame:
    months = _d(wh).select("DoctorName", "Year", "Month", "DoctorID", "RevenueAmount")
    lagged = previous_value(months, "RevenueAmount", ["Year", "Month", "DoctorID"], "_before", ["DoctorName"])
    delta = (F.col("RevenueAmount") - F.col("_before")).cast(AMOUNT).alias("DeltaToPreviousMonth")
    return lagged.select("DoctorName", "Year", "Month", "RevenueAmount", delta).orderBy("DoctorName", "Year", "Month")


def _share(mart, dim: str, measure: str, alias: str):
    def query(wh: Warehouse) -> DataFrame:
        grouped = totals(mart(wh), [dim], {measure: measure})
        return olap.with_share(grouped, measure, mart(wh), alias).orderBy(*descending(measure, dim))

    return query


def _top_diagnosis(measure: str):
    def query(wh: Warehouse, top: int = TOP_N) -> DataFrame:
        dims = ["DiagnosisName", "ICDCode"]
        return totals(_g(wh), dims, {measure: measure}).orderBy(*descending(measure, *dims)).limit(top)

    return query


def diagnosis_frequency(wh: Warehouse) -> DataFrame:
    counted = totals(_g(wh), ["DiagnosisClass", "DiagnosisName"], {"VisitQty": "VisitQty"})
    return counted.orderBy(*descending("VisitQty", "DiagnosisName", "DiagnosisClass"))


def _diagnosis_mean(measure: str, target: str):
    def query(wh: Warehouse) -> DataFrame:
        means = _g(wh).groupBy("DiagnosisName").agg(mean(measure, target))
        return means.orderBy(*descending(measure, "DiagnosisName"))

    return query


def best_diagnosis_trend(wh: Warehouse) -> DataFrame:
    best = olap.leader(_g(wh), "DiagnosisName", "RevenueAmount")
    return (
        _g(wh).filter(F.col("DiagnosisName") == best)
        .select("DiagnosisName", "Year", "Month", "VisitQty", "RevenueAmount", "ProfitAmount")
        .orderBy("Year", "Month")
    )


def top_profit_per_visit(wh: Warehouse, top: int = TOP_N) -> DataFrame:
    summed = totals(_g(wh), ["DiagnosisName"], {"ProfitAmount": "ProfitAmount", "VisitQty": "VisitQty"})
    ratio = per(F.col("ProfitAmount"), F.col("VisitQty")).alias("ProfitPerVisit")
    return summed.select("DiagnosisName", ratio).orderBy(*descending("ProfitPerVisit", "DiagnosisName")).limit(top)


def _top_patient(measure: str, columns: list[str]):
    def query(wh: Warehouse, top: int = TOP_N) -> DataFrame:
        leading = _p(wh).orderBy(*descending(measure, "PatientName", "PatientID")).limit(top)
        return leading.select("PatientName", "AgeBand", *columns)

    return query


def span_by_age(wh: Warehouse) -> DataFrame:
    return _p(wh).groupBy("AgeBand").agg(
        rows("PatientQty"),
        F.avg(F.col("VisitSpanDays").cast("decimal(12,1)")).cast("decimal(18,6)").alias("AvgVisitSpanDays"),
        amount("RevenueAmount"),
    ).orderBy(*descending("AvgVisitSpanDays", "AgeBand"))


def abc_patients(wh: Warehouse) -> DataFrame:
    patients = _p(wh).select("PatientName", "PatientID", "Age", "RevenueAmount")
    groups = olap.abc_groups(
        patients, "RevenueAmount", ["PatientName", "PatientID", "Age"], "CumulativeShare", "AbcGroup"
    )
    return groups.orderBy(*descending("RevenueAmount", "PatientName", "PatientID")).select(
        "PatientName", "RevenueAmount", "CumulativeShare", "AbcGroup"
    )


def age_avg_check(wh: Warehouse) -> DataFrame:
    summed = totals(_p(wh), ["AgeBand"], {"RevenueAmount": "RevenueAmount", "VisitQty": "VisitQty"})
    check = per(F.col("RevenueAmount"), F.col("VisitQty")).alias("AvgCheck")
    return summed.select("AgeBand", check).orderBy(*descending("AvgCheck", "AgeBand"))


def high_potential(wh: Warehouse) -> DataFrame:
    """Both averages are compared as sums, value * rows >= total, which needs no rounding."""
    patients = _p(wh)
    overall = patients.agg(
        F.sum("VisitQty").alias("visits"), F.sum("RevenueAmount").alias("revenue"), rows("patients")
    )
    patient_rows = overall.select("patients").scalar()
    often = F.col("VisitQty") * patient_rows >= overall.select("visits").scalar()
    valuable = F.col("RevenueAmount") * patient_rows.cast("decimal(12,0)") >= overall.select("revenue").scalar()
    label = F.when(often & valuable, L.HIGH_POTENTIAL).otherwise(L.STANDARD_PROFILE)
    return patients.select("PatientName", "AgeBand", "VisitQty", "RevenueAmount", label.alias("SegmentLabel")).orderBy(
        F.desc("RevenueAmount"), F.desc("VisitQty"), "PatientName"
    )


def revenue_per_day(wh: Warehouse) -> DataFrame:
    days = F.when(F.col("VisitSpanDays") == 0, 1).otherwise(F.col("VisitSpanDays"))
    density = per(F.col("RevenueAmount"), days).alias("RevenuePerLifecycleDay")
    return _p(wh).select("PatientName", "VisitSpanDays", "RevenueAmount", density).orderBy(
        *descending("RevenuePerLifecycleDay", "PatientName")
    )


def doctor_by_age(wh: Warehouse) -> DataFrame:
    crossed = totals(_v(wh), ["DoctorName", "AgeBand"], REVENUE | VISITS)
    return crossed.orderBy("DoctorName", *descending("RevenueAmount", "AgeBand"))


def _rollup(dims: list[str], measures: dict[str, str]):
    return lambda wh: olap.rollup(_v(wh), dims, measures).orderBy(*dims)


def _cube(dims: list[str], measures: dict[str, str]):
    return lambda wh: olap.cube(_v(wh), dims, measures).orderBy(*dims)


def five_grouping_sets(wh: Warehouse) -> DataFrame:
    dims = ["Year", "DoctorName", "DiagnosisClass"]
    sets = [["Year"], ["DoctorName"], ["DiagnosisClass"], ["Year", "DoctorName"], ["Year", "DiagnosisClass"]]
    return olap.grouping_sets(_v(wh), dims, sets, REVENUE | PROFIT).orderBy(*dims)


def pivot_visit_type(wh: Warehouse) -> DataFrame:
    cells = {L.PRIMARY: "PrimaryRevenue", L.REPEAT: "SecondaryRevenue", L.OTHER_VISIT: "OtherRevenue"}
    return olap.cross_table(_v(wh), "DoctorName", "VisitCategory", "ServiceCost", cells).orderBy("DoctorName")


def pivot_age(wh: Warehouse) -> DataFrame:
    # Output names, in the order of the age bands.
    names = ["U18", "18_25", "26_35", "36_45", "46_60", "60Plus", "Unknown"]
    cells = {label: f"Profit_{name}" for label, name in zip(L.AGE_LABELS, names)}
    return olap.cross_table(_v(wh), "Specialty", "AgeBand", "Profit", cells).orderBy("Specialty")


def _drill_through(mart, name: str, columns: list[str]):
    """Visits of the member with the largest revenue.

    One patient may have a great many of them on one day, so the row number ends the sort key: equal sort keys
    would all go to one task.
    """
    def query(wh: Warehouse) -> DataFrame:
        best = olap.leader(mart(wh), name, "RevenueAmount")
        detail = _v(wh).filter(F.col(name) == best).select(*columns, "VisitKey")
        return detail.orderBy("FullDate", "PatientName", "VisitKey").drop("VisitKey")

    return query


def drill_across(wh: Warehouse) -> DataFrame:
    crossed = totals(_v(wh), ["DoctorName", "DiagnosisClass"], ALL)
    return crossed.orderBy("DoctorName", *descending("RevenueAmount", "DiagnosisClass"))


def _pareto(mart, dim: str):
    def query(wh: Warehouse) -> DataFrame:
        summed = totals(mart(wh), [dim], {"RevenueAmount": "RevenueAmount"})
        return olap.pareto(summed, "RevenueAmount", [dim]).orderBy(*descending("RevenueAmount", dim))

    return query


def _margin(mart, dim: str, measures: dict[str, str]):
    """Profit in percent of revenue, from sums."""
    def query(wh: Warehouse) -> DataFrame:
        summed = totals(mart(wh), [dim], measures)
        margin = percent_of(F.col("ProfitAmount"), F.col("RevenueAmount")).alias("MarginPercent")
        return summed.select(dim, "ProfitAmount", "RevenueAmount", margin).orderBy(*descending("MarginPercent", dim))

    return query


def _outliers(measure: str, suffix: str):
    def query(wh: Warehouse) -> DataFrame:
        days = _t(wh).select("FullDate", measure)
        banded = olap.outlier_bands(days, measure, f"Avg{suffix}", f"Std{suffix}", f"{suffix}Band")
        return banded.orderBy(*descending(measure, "FullDate"))

    return query


def management_panel(wh: Warehouse) -> DataFrame:
    def active(name: str, key: str):
        return audit.loaded_members(name, wh.dimension(name), key).agg(rows("n")).scalar()

    return _v(wh).agg(
        quantity("VisitCount", "TotalVisits"),
        visit_amount("ServiceCost", "TotalRevenue"),
        visit_amount("Profit", "TotalProfit"),
        visit_mean("RepeatRate", RAW_MEAN, "AvgRepeatRate"),
        visit_mean("AvgTreatmentCost", RAW_MEAN, "AvgTreatmentCost"),
    ).select(
        "TotalVisits", "TotalRevenue", "TotalProfit",
        active("patient", "PatientKey").alias("ActivePatients"),
        active("doctor", "DoctorKey").alias("ActiveDoctors"),
        active("diagnosis", "DiagnosisKey").alias("ActiveDiagnoses"),
        "AvgRepeatRate", "AvgTreatmentCost",
    )


def multidim_slice(wh: Warehouse) -> DataFrame:
    dims = ["Year", "DoctorName", "DiagnosisClass", "VisitCategory"]
    return _v(wh).groupBy(*dims).agg(
        visit_amount("ServiceCost", "RevenueAmount"),
        visit_amount("Profit", "ProfitAmount"),
        quantity("VisitCount", "VisitQty"),
        visit_mean("MarginPercent", RATE, "AvgMarginPercent"),
    ).orderBy(*dims)


QUERIES = {
    "q01_kpi_totals": kpi_totals,
    "q02_object_counts": object_counts,
    "q03_by_year": by_year,
    "q04_by_month": by_month,
    "q05_avg_check_by_date": avg_check_by_date,
    "q06_date_range": date_range,
    "q07_by_visit_type": _by_visits(["VisitName", "VisitCategory"], ALL, "RevenueAmount"),
    "q08_by_age_band": _by_visits(["AgeBand"], ALL, "RevenueAmount"),
    "q09_by_specialty": _by_visits(["Specialty"], ALL, "RevenueAmount"),
    "q10_by_diagnosis_class": _by_visits(["DiagnosisClass"], ALL, "RevenueAmount"),
    "q11_drill_down_time": drill_down_time,
    "q12_slice_primary": _slice(L.PRIMARY),
    "q13_slice_repeat": _slice(L.REPEAT),
    "q14_dice": dice,
    "q15_season_by_class": season_by_class,
    "q16_by_weekday": _by_visits(["WeekDayName"], ALL, "ProfitAmount"),
    "q17_weekend_share": weekend_share,
    "q18_moving_avg3": moving_average,
    "q19_running_revenue": _running("RevenueAmount", "RunningRevenue"),
    "q20_running_profit": _running("ProfitAmount", "RunningProfit"),
    "q21_rank_doctor_revenue": _doctor_rank("RevenueAmount", "RevenueRank"),
    "q22_rank_doctor_profit": _doctor_rank("ProfitAmount", "ProfitRank"),
    "q23_top_doctor_check": _top_mean(_d, ["DoctorName", "Specialty"], "AvgCheck", RAW_MEAN),
    "q24_top_doctor_repeat": _top_mean(_d, ["DoctorName", "Specialty"], "AvgRepeatRate", RAW_MEAN),
    "q25_rank_within_specialty": rank_within_specialty,
    "q26_doctor_margin": doctor_margin,
    "q27_doctor_month": doctor_month,
    "q28_doctor_mom_delta": doctor_month_delta,
    "q29_doctor_share": _share(_d, "DoctorName", "RevenueAmount", "RevenueSharePercent"),
    "q30_specialty_profit_share": _share(_d, "Specialty", "ProfitAmount", "ProfitSharePercent"),
    "q31_top_diag_revenue": _top_diagnosis("RevenueAmount"),
    "q32_top_diag_profit": _top_diagnosis("ProfitAmount"),
    "q33_diag_frequency": diagnosis_frequency,
    "q34_diag_avg_cost": _diagnosis_mean("AvgTreatmentCost", MONEY),
    "q35_diag_avg_repeat": _diagnosis_mean("AvgRepeatRate", RATE),
    "q36_class_revenue_share": _share(_g, "DiagnosisClass", "RevenueAmount", "RevenueSharePercent"),
    "q37_class_visit_share": _share(_g, "DiagnosisClass", "VisitQty", "VisitSharePercent"),
    "q38_best_diag_trend": best_diagnosis_trend,
    "q39_top_diag_repeat": _top_mean(_g, ["DiagnosisName"], "AvgRepeatRate", RAW_MEAN),
    "q40_top_diag_profit_per_visit": top_profit_per_visit,
    "q41_top_patient_revenue": _top_patient("RevenueAmount", ["RevenueAmount", "ProfitAmount", "VisitQty"]),
    "q42_top_patient_visits": _top_patient("VisitQty", ["VisitQty", "RevenueAmount"]),
    "q43_top_patient_repeat": _top_patient("AvgRepeatRate", ["AvgRepeatRate"]),
    "q44_span_by_age": span_by_age,
    "q45_abc_patients": abc_patients,
    "q46_age_avg_check": age_avg_check,
    "q47_age_profit_share": _share(_p, "AgeBand", "ProfitAmount", "ProfitSharePercent"),
    "q48_high_potential": high_potential,
    "q49_revenue_per_day": revenue_per_day,
    "q50_doctor_by_age": doctor_by_age,
    "q51_rollup_time": _rollup(["Year", "Month"], REVENUE | PROFIT),
    "q52_rollup_specialty": _rollup(["Specialty", "VisitCategory"], REVENUE | VISITS),
    "q53_cube_age_visit": _cube(["AgeBand", "VisitCategory"], REVENUE | PROFIT),
    "q54_cube_specialty_class": _cube(["Specialty", "DiagnosisClass"], REVENUE | VISITS),
    "q55_grouping_sets": five_grouping_sets,
    "q56_pivot_visit_type": pivot_visit_type,
    "q57_pivot_age": pivot_age,
    "q58_drill_through_doctor": _drill_through(_d, "DoctorName", [
        "FullDate", "DoctorName", "PatientName", "DiagnosisName", "VisitName", "ServiceCost", "Profit",
    ]),
    "q59_drill_through_diag": _drill_through(_g, "DiagnosisName", [
        "FullDate", "DiagnosisName", "PatientName", "DoctorName", "VisitName", "ServiceCost", "Profit",
    ]),
    "q60_drill_across": drill_across,
    "q61_pareto_doctor": _pareto(_d, "DoctorName"),
    "q62_pareto_diag": _pareto(_g, "DiagnosisName"),
    "q63_pareto_age": _pareto(_p, "AgeBand"),
    "q64_specialty_margin": _margin(_d, "Specialty", MART_ALL),
    "q65_class_margin": _margin(_g, "DiagnosisClass", MART_ALL),
    "q66_category_margin": _margin(_v, "VisitCategory", PROFIT | REVENUE),
    "q67_anomaly_revenue": _outliers("RevenueAmount", "Revenue"),
    "q68_anomaly_profit": _outliers("ProfitAmount", "Profit"),
    "q69_management_panel": management_panel,
    "q70_multidim_slice": multidim_slice,
}
