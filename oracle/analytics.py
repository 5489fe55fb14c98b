"""DuckDB SQL of the seventy analytic queries. Marts: mv visits, md doctors, mg diagnoses, mp patients, mt days."""

from .base import (
    PROFIT, REVENUE, VISIT_QTY, cents, count_of, mean_money, mean_of, mean_rate, percent, query, ratio, total,
)

M_VISITS = count_of("VisitQty", "VisitQty")
M_REVENUE = total("RevenueAmount", "RevenueAmount")
M_PROFIT = total("ProfitAmount", "ProfitAmount")


def grouped(mart: str, dims: str, *measures: str, where: str = "true", by: str | None = None) -> str:
    return query(f"select {dims}, {', '.join(measures)} from {mart} where {where} group by {by or 'all'}")


def all_of(dims: str) -> str:
    return grouped("mv", dims, VISIT_QTY, REVENUE, PROFIT)


def share(mart: str, dim: str, measure: str, alias: str, unit: int) -> str:
    """Share of each group in the whole; ``unit`` turns the measure into whole numbers."""
    s = count_of(measure, measure) if unit == 1 else total(measure, measure)
    part = f"cast({measure} * {unit} as hugeint)"
    return query(
        f"select {dim}, {measure}, {percent(part, f'sum({part}) over ()')} as {alias} from by_member",
        by_member=f"select {dim}, {s} from {mart} group by all",
    )


def running_share(mart: str, names: str, columns: str, alias: str, extra: str = "") -> str:
    """Cumulative share of revenue, largest first."""
    part = cents("RevenueAmount")
    body = f"select {columns}, {percent('running', 'whole')} as {alias}{extra} from ordered"
    return query(
        body,
        by_member=f"select {names}, {M_REVENUE} from {mart} group by all",
        ordered=f"""select *, sum({part}) over (order by RevenueAmount desc, {names} rows unbounded preceding) as running,
                    sum({part}) over () as whole from by_member""",
    )


def top(mart: str, dims: str, measure: str, alias: str) -> str:
    return query(f"select {dims}, {measure} from {mart} group by {dims} order by {alias} desc, {dims} limit 5")


def top_mean(mart: str, dims: str, mean: str, alias: str) -> str:
    return query(f"select {dims}, measure as {alias} from by_member order by measure desc, {dims} limit 5",
                 by_member=f"select {dims}, {mean} as measure from {mart} group by all")


def margin(mart: str, dim: str, profit: str, revenue: str) -> str:
    return query(
        f"""select {dim}, ProfitAmount, RevenueAmount,
            {percent(cents('ProfitAmount'), cents('RevenueAmount'))} as MarginPercent from by_member""",
        by_member=f"select {dim}, {profit}, {revenue} from {mart} group by all",
    )


def outliers(measure: str, name: str) -> str:
    value = f"cast({measure} as double)"
    return query(f"""
        select FullDate, {measure}, round(m, 4) as Avg{name}, round(s, 4) as Std{name},
               case when {value} > m + s then 'Vyshe normy' when {value} < m - s then 'Nizhe normy' else 'Norma' end
                 as {name}Band
        from mt, (select avg({value}) as m, stddev_samp({value}) as s from mt)""")


def best(mart: str, name: str) -> str:
    return f"(select {name} from {mart} group by {name} order by sum(RevenueAmount) desc, {name} limit 1)"


def by_category(category: str) -> str:
    return grouped("mv", "FullDate", REVENUE, VISIT_QTY, where=f"VisitCategory = '{category}'")


def cell(column: str, member: str, value: str, alias: str) -> str:
    return f"cast(coalesce(sum({value}) filter ({column} = '{member}'), 0) as decimal(28,2)) as {alias}"


BANDS = {
    "Do 18 let": "U18", "18-25": "18_25", "26-35": "26_35", "36-45": "36_45", "46-60": "46_60", "60+": "60Plus",
    "Ne opredeleno": "Unknown",
}

SQL = {
    "q01_kpi_totals": query(f"""
        select count(*) as FactRowQty, {count_of('VisitCount', 'TotalVisits')}, {total('ServiceCost', 'TotalRevenue')},
               {total('Profit', 'TotalProfit')}, {mean_money('AvgTreatmentCost', 6, 22)} as MeanTreatmentCost,
               {mean_rate('RepeatRate', 6, 22)} as MeanRepeatRate from fact"""),
    "q02_object_counts": query("""
        select 'DimPatient' as ObjectName, count(*) as RowQty from dim_patient union all
        select 'DimDoctor', count(*) from dim_doctor union all
        select 'DimDate', count(FullDate) from dim_date union all
        select 'DimVisitType', count(*) from ok_visit_types union all
        select 'DimDiagnosis', count(*) from dim_diagnosis union all
        select 'FactVisit', count(*) from fact"""),
    "q03_by_year": grouped("mt", "Year", M_VISITS, M_REVENUE, M_PROFIT),
    "q04_by_month": grouped("mt", "Year, Month", M_VISITS, M_REVENUE, M_PROFIT),
    "q05_avg_check_by_date": query(
        f"select FullDate, RevenueAmount, VisitQty, {ratio(cents('RevenueAmount'), 'VisitQty')} as AvgCheck from mt"),
    "q06_date_range": query("select min(FullDate) as MinVisitDate, max(FullDate) as MaxVisitDate from mt"),
    "q07_by_visit_type": all_of("VisitName, VisitCategory"),
    "q08_by_age_band": all_of("AgeBand"),
    "q09_by_specialty": all_of("Specialty"),
    "q10_by_diagnosis_class": all_of("DiagnosisClass"),
    "q11_drill_down_time": all_of("Year, QuarterNumber, Month"),
    "q12_slice_primary": by_category("Pervichnyy vizit"),
    "q13_slice_repeat": by_category("Povtornyy vizit"),
    "q14_dice": grouped("mv", "Specialty, AcademicPeriod", REVENUE, PROFIT,
                        where="Specialty in ('Terapevt', 'Ortoped') and AcademicPeriod = 'Osen'"),
    "q15_season_by_class": grouped("mv", "AcademicPeriod, DiagnosisClass", REVENUE, VISIT_QTY),
    "q16_by_weekday": all_of("WeekDayName"),
    "q17_weekend_share": all_of("case when IsWeekend then 'Vykhodnye' else 'Budni' end as DayType"),
    "q18_moving_avg3": query(f"""
        select FullDate, RevenueAmount, {mean_of('c', 'n::hugeint', 2, 2, 18)} as MovingAvg3 from (
          select FullDate, RevenueAmount, sum({cents('RevenueAmount')}) over w as c, count(*) over w as n from mt
          window w as (order by FullDate nulls first rows between 2 preceding and current row))"""),
    "q19_running_revenue": query("""
        select FullDate, RevenueAmount, cast(sum(RevenueAmount) over (order by FullDate nulls first
          rows unbounded preceding) as decimal(28,2)) as RunningRevenue from mt"""),
    "q20_running_profit": query("""
        select FullDate, ProfitAmount, cast(sum(ProfitAmount) over (order by FullDate nulls first
          rows unbounded preceding) as decimal(28,2)) as RunningProfit from mt"""),
    "q21_rank_doctor_revenue": query(f"""
        select *, cast(rank() over (order by RevenueAmount desc) as int) as RevenueRank from
          (select DoctorName, Specialty, {M_REVENUE} from md group by all)"""),
    "q22_rank_doctor_profit": query(f"""
        select *, cast(rank() over (order by ProfitAmount desc) as int) as ProfitRank from
          (select DoctorName, Specialty, {M_PROFIT} from md group by all)"""),
    "q23_top_doctor_check": top_mean("md", "DoctorName, Specialty", mean_money("AvgCheck", 6, 22), "AvgCheck"),
    "q24_top_doctor_repeat": top_mean("md", "DoctorName, Specialty", mean_rate("AvgRepeatRate", 6, 22), "AvgRepeatRate"),
    "q25_rank_within_specialty": query(f"""
        select *, cast(dense_rank() over (partition by Specialty order by RevenueAmount desc) as int)
          as RankWithinSpecialty from (select Specialty, DoctorName, {M_REVENUE} from md group by all)"""),
    "q26_doctor_margin": grouped("md", "DoctorName, Specialty", mean_rate("AvgMarginPercent") + " as AvgMarginPercent"),
    "q27_doctor_month": query("select DoctorName, Year, Month, RevenueAmount from md"),
    "q28_doctor_mom_delta": query("""
        select DoctorName, Year, Month, RevenueAmount, cast(RevenueAmount - lag(RevenueAmount) over (
          partition by DoctorName order by Year nulls first, Month nulls first, DoctorID) as decimal(28,2))
          as DeltaToPreviousMonth from md"""),
    "q29_doctor_share": share("md", "DoctorName", "RevenueAmount", "RevenueSharePercent", 100),
    "q30_specialty_profit_share": share("md", "Specialty", "ProfitAmount", "ProfitSharePercent", 100),
    "q31_top_diag_revenue": top("mg", "DiagnosisName, ICDCode", M_REVENUE, "sum(RevenueAmount)"),
    "q32_top_diag_profit": top("mg", "DiagnosisName, ICDCode", M_PROFIT, "sum(ProfitAmount)"),
    "q33_diag_frequency": grouped("mg", "DiagnosisClass, DiagnosisName", M_VISITS),
    "q34_diag_avg_cost": grouped("mg", "DiagnosisName", mean_money("AvgTreatmentCost") + " as AvgTreatmentCost"),
    "q35_diag_avg_repeat": grouped("mg", "DiagnosisName", mean_rate("AvgRepeatRate") + " as AvgRepeatRate"),
    "q36_class_revenue_share": share("mg", "DiagnosisClass", "RevenueAmount", "RevenueSharePercent", 100),
    "q37_class_visit_share": share("mg", "DiagnosisClass", "VisitQty", "VisitSharePercent", 1),
    "q38_best_diag_trend": query(f"""
        select DiagnosisName, Year, Month, VisitQty, RevenueAmount, ProfitAmount from mg
        where DiagnosisName = {best('mg', 'DiagnosisName')}"""),
    "q39_top_diag_repeat": top_mean("mg", "DiagnosisName", mean_rate("AvgRepeatRate", 6, 22), "AvgRepeatRate"),
    "q40_top_diag_profit_per_visit": top_mean(
        "mg", "DiagnosisName", ratio(f"sum({cents('ProfitAmount')})", "sum(VisitQty)"), "ProfitPerVisit"),
    "q41_top_patient_revenue": query("""
        select PatientName, AgeBand, RevenueAmount, ProfitAmount, VisitQty from mp
        order by RevenueAmount desc, PatientName, PatientID limit 5"""),
    "q42_top_patient_visits": query("""
        select PatientName, AgeBand, VisitQty, RevenueAmount from mp
        order by VisitQty desc, PatientName, PatientID limit 5"""),
    "q43_top_patient_repeat": query("""
        select PatientName, AgeBand, AvgRepeatRate from mp order by AvgRepeatRate desc, PatientName, PatientID limit 5"""),
    "q44_span_by_age": grouped(
        "mp", "AgeBand", "count(*) as PatientQty",
        mean_of("sum(VisitSpanDays)::hugeint * 10", "count(VisitSpanDays)::hugeint", 1, 6, 18) + " as AvgVisitSpanDays",
        M_REVENUE),
    "q45_abc_patients": running_share(
        "mp", "PatientName, PatientID, Age", "PatientName, RevenueAmount", "CumulativeShare",
        ", case when running * 100 <= whole * 80 then 'A' when running * 100 <= whole * 95 then 'B' else 'C' end"
        " as AbcGroup"),
    "q46_age_avg_check": query(f"""
        select AgeBand, {ratio(f"sum({cents('RevenueAmount')})", 'sum(VisitQty)')} as AvgCheck from mp group by all"""),
    "q47_age_profit_share": share("mp", "AgeBand", "ProfitAmount", "ProfitSharePercent", 100),
    "q48_high_potential": query("""
        select PatientName, AgeBand, VisitQty, RevenueAmount,
               case when VisitQty * n >= visits and RevenueAmount * n >= revenue then 'Vysokiy potentsial'
                    else 'Standartnyy profil' end as SegmentLabel
        from mp, (select count(*) as n, sum(VisitQty) as visits, sum(RevenueAmount) as revenue from mp)"""),
    "q49_revenue_per_day": query(f"""
        select PatientName, VisitSpanDays, RevenueAmount,
               {ratio(cents('RevenueAmount'), 'case when VisitSpanDays = 0 then 1 else VisitSpanDays end')}
                 as RevenuePerLifecycleDay from mp"""),
    "q50_doctor_by_age": grouped("mv", "DoctorName, AgeBand", REVENUE, VISIT_QTY),
    "q51_rollup_time": grouped("mv", "Year, Month", REVENUE, PROFIT, by="rollup (Year, Month)"),
    "q52_rollup_specialty": grouped("mv", "Specialty, VisitCategory", REVENUE, VISIT_QTY,
                                    by="rollup (Specialty, VisitCategory)"),
    "q53_cube_age_visit": grouped("mv", "AgeBand, VisitCategory", REVENUE, PROFIT, by="cube (AgeBand, VisitCategory)"),
    "q54_cube_specialty_class": grouped("mv", "Specialty, DiagnosisClass", REVENUE, VISIT_QTY,
                                        by="cube (Specialty, DiagnosisClass)"),
    "q55_grouping_sets": grouped(
        "mv", "Year, DoctorName, DiagnosisClass", REVENUE, PROFIT,
        by="grouping sets ((Year), (DoctorName), (DiagnosisClass), (Year, DoctorName), (Year, DiagnosisClass))"),
    "q56_pivot_visit_type": grouped(
        "mv", "DoctorName",
        cell("VisitCategory", "Pervichnyy vizit", "ServiceCost", "PrimaryRevenue"),
        cell("VisitCategory", "Povtornyy vizit", "ServiceCost", "SecondaryRevenue"),
        cell("VisitCategory", "Inoy stsenariy", "ServiceCost", "OtherRevenue")),
    "q57_pivot_age": grouped(
        "mv", "Specialty", *[cell("AgeBand", band, "Profit", f"Profit_{name}") for band, name in BANDS.items()]),
    "q58_drill_through_doctor": query(f"""
        select FullDate, DoctorName, PatientName, DiagnosisName, VisitName, ServiceCost, Profit from mv
        where DoctorName = {best('md', 'DoctorName')}"""),
    "q59_drill_through_diag": query(f"""
        select FullDate, DiagnosisName, PatientName, DoctorName, VisitName, ServiceCost, Profit from mv
        where DiagnosisName = {best('mg', 'DiagnosisName')}"""),
    "q60_drill_across": all_of("DoctorName, DiagnosisClass"),
    "q61_pareto_doctor": running_share("md", "DoctorName", "DoctorName, RevenueAmount", "CumulativeSharePercent"),
    "q62_pareto_diag": running_share("mg", "DiagnosisName", "DiagnosisName, RevenueAmount", "CumulativeSharePercent"),
    "q63_pareto_age": running_share("mp", "AgeBand", "AgeBand, RevenueAmount", "CumulativeSharePercent"),
    "q64_specialty_margin": margin("md", "Specialty", M_PROFIT, M_REVENUE),
    "q65_class_margin": margin("mg", "DiagnosisClass", M_PROFIT, M_REVENUE),
    "q66_category_margin": margin("mv", "VisitCategory", PROFIT, REVENUE),
    "q67_anomaly_revenue": outliers("RevenueAmount", "Revenue"),
    "q68_anomaly_profit": outliers("ProfitAmount", "Profit"),
    "q69_management_panel": query(f"""
        select {count_of('VisitCount', 'TotalVisits')}, {total('ServiceCost', 'TotalRevenue')},
               {total('Profit', 'TotalProfit')},
               (select count(*) from ok_patients) as ActivePatients, (select count(*) from ok_doctors) as ActiveDoctors,
               (select count(*) from ok_diagnoses) as ActiveDiagnoses,
               {mean_rate('RepeatRate', 6, 22)} as AvgRepeatRate,
               {mean_money('AvgTreatmentCost', 6, 22)} as AvgTreatmentCost from fact"""),
    "q70_multidim_slice": grouped("mv", "Year, DoctorName, DiagnosisClass, VisitCategory", REVENUE, PROFIT, VISIT_QTY,
                                  mean_rate("MarginPercent") + " as AvgMarginPercent"),
}
