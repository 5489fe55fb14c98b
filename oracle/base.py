"""DuckDB SQL that derives the star schema from the driver's tables, independently of the Spark code.

``query(body)`` puts exactly the common table expressions a query needs in front of it. Means and ratios are
computed with whole numbers, because the engine would otherwise answer them as floating point.
"""

import re

NOW = "2024-01-01 00:00:00"
END = "9999-12-31 00:00:00"


def half_up(num: str, den: str) -> str:
    """Whole number nearest to num/den (den > 0), halves away from zero."""
    return f"(case when ({num}) < 0 then -1 else 1 end * ((2 * abs(({num})::hugeint) + ({den})) // (2 * ({den}))))"


def scaled(units: str, scale: int, width: int) -> str:
    """A whole number of 10^-scale units as a decimal."""
    one = "0." + "0" * (scale - 1) + "1"
    return f"cast(({units})::decimal(30,0) * '{one}'::decimal({scale + 1},{scale}) as decimal({width},{scale}))"


def cents(expr: str) -> str:
    return f"cast(({expr}) * 100 as hugeint)"


def rate_units(expr: str) -> str:
    return f"cast(({expr}) * 10000 as hugeint)"


def mean_of(total: str, count: str, scale: int, out_scale: int, width: int) -> str:
    """Mean of a total in 10^-scale units: four more digits, then rounded to the output's."""
    fine = half_up(f"({total}) * 10000", count)
    drop = scale + 4 - out_scale
    units = half_up(fine, str(10**drop)) if drop > 0 else f"{fine} * {10 ** -drop}"
    return scaled(units, out_scale, width)


def mean_money(column: str, out_scale: int = 2, width: int = 18) -> str:
    return mean_of(f"sum({cents(column)})", "count(*)::hugeint", 2, out_scale, width)


def mean_rate(column: str, out_scale: int = 4, width: int = 9) -> str:
    return mean_of(f"sum({rate_units(column)})", "count(*)::hugeint", 4, out_scale, width)


def percent(part: str, whole: str) -> str:
    """100 * part / whole for whole numbers, at two digits; a negative whole is folded into the part."""
    fine = half_up(f"({part})::hugeint * 100000000 * sign({whole})::hugeint", f"abs(({whole})::hugeint)")
    return f"case when ({whole}) <> 0 then {scaled(half_up(fine, '10000'), 2, 9)} end"


def ratio(total: str, count: str) -> str:
    """A total in cents over a whole number, at two digits."""
    fine = half_up(f"({total})::hugeint * 10000000000", f"({count})::hugeint")
    return f"case when ({count}) <> 0 then {scaled(half_up(fine, '10000000000'), 2, 18)} end"


def total(column: str, alias: str) -> str:
    return f"cast(sum({column}) as decimal(28,2)) as {alias}"


def count_of(column: str, alias: str) -> str:
    return f"cast(sum({column}) as bigint) as {alias}"


VISIT_QTY = count_of("VisitCount", "VisitQty")
REVENUE = total("ServiceCost", "RevenueAmount")
PROFIT = total("Profit", "ProfitAmount")

def one_per_id(source: str, key: str, attributes: list[str]) -> str:
    """The smallest row of each ID, NULL first."""
    order = ", ".join(f"{c} nulls first" for c in attributes)
    return f"select * from {source} qualify row_number() over (partition by {key} order by {order}) = 1"


_WEEKDAY = "['ponedelnik','vtornik','sreda','chetverg','pyatnitsa','subbota','voskresene']"
BAND = """case when Age is null then 'Ne opredeleno' when Age <= 17 then 'Do 18 let' when Age <= 25 then '18-25'
  when Age <= 35 then '26-35' when Age <= 45 then '36-45' when Age <= 60 then '46-60' else '60+' end"""
_DATE_OF = "try_cast(printf('%04d-%02d-%02d', Year, Month, Day) as date)"

TABLES = {
    "stg_patients": """
      select c_custkey + 1 as PatientID,
             case when c_custkey % 83 = 0 then '   ' else '  ' || c_name || ' ' end as FullName,
             cast(case when c_custkey % 50 <> 7 then (c_custkey * 37) % 131 - 5 end as int) as Age,
             '+7 9' || lpad(cast(case when c_custkey % 40 = 0 then c_custkey + 1 else c_custkey end as varchar), 7, '0')
               || '-0' as Phone
      from customer""",
    "stg_doctors": """
      select s_suppkey + 1 as DoctorID, s_name as FullName,
             case s_nationkey % 5 when 0 then 'Terapevt' when 1 then 'Khirurg' when 2 then 'Ortoped'
               when 3 then 'Ortodont' else 'Rentgenolog' end as Specialty
      from supplier""",
    "stg_diagnoses": """
      select p_partkey + 1 as DiagnosisID,
             case when p_size % 10 = 0 then 'K10' else
               case p_type when 'ECONOMY' then 'K02' when 'SMALL' then 'K04' when 'MEDIUM' then 'K05'
                 when 'PROMO' then 'K07' when 'STANDARD' then 'K08' when 'LARGE' then 'K12' end
             end || '.' || p_size as ICDCode,
             case when p_partkey % 89 = 0 then ' ' else p_name end as DiagnosisName,
             p_brand as TreatmentMethod
      from part""",
    "stg_visit_types": """
      select distinct cast(case l_returnflag when 'N' then 1 when 'R' then 2 else 3 end as int) as VisitTypeID,
             case l_returnflag when 'N' then 'Primary' when 'R' then 'Secondary' else 'Other' end as VisitName,
             case l_returnflag when 'N' then ' pr ' when 'R' then 'SC' else 'XX' end as VisitCode
      from lineitem""",
    "stg_dates": f"""
      select cast(id as int) as DateID, cast(case when id % 97 = 0 then 44 else day(dt) end as int) as Day,
             cast(month(dt) as int) as Month, cast(year(dt) as int) as Year,
             case when id % 41 = 0 then 'ponedelnik' else ({_WEEKDAY})[isodow(dt)] end as WeekDay
      from (select distinct cast(o_orderdate as date) as dt,
                   year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as id from orders)""",
    "stg_visits": """
      select FactID, DateID, PatientID, DoctorID, DiagnosisID, VisitTypeID,
             case when FactID % 401 = 0 then 'n/a' else replace(cast(cost as varchar), '.', ',') end as ServiceCostText,
             1 as VisitCount,
             replace(cast(cast(cast(cost * rate as decimal(20,4)) as decimal(18,2)) as varchar), '.', ',') as ProfitText,
             1 as PatientCount,
             case when FactID % 1009 = 0 then '1,5' when VisitTypeID = 2 then '1' else '0' end as RepeatRateText,
             replace(cast(cast(case when FactID % 503 = 0 then cost + 10 else cost end as decimal(18,2)) as varchar),
               '.', ',') as AvgTreatmentCostText
      from (select l_orderkey * 10 + l_linenumber as FactID,
                   cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as int) as DateID,
                   o_custkey + 1 as PatientID, l_suppkey + 1 as DoctorID,
                   case when l_partkey % 211 = 0 then l_partkey + 10000000 else l_partkey + 1 end as DiagnosisID,
                   cast(case l_returnflag when 'N' then 1 when 'R' then 2 else 3 end as int) as VisitTypeID,
                   cast(l_extendedprice as decimal(18,2)) as cost,
                   cast(l_discount as decimal(4,2)) * 4 - 0.05 as rate
            from lineitem join orders on o_orderkey = l_orderkey)""",
    "clean_patients": f"""
      select distinct PatientID, trim(FullName) as FullName, Age, {BAND} as AgeBand, trim(Phone) as Phone,
             replace(replace(replace(trim(Phone), ' ', ''), '+', ''), '-', '') as PhoneNormalized
      from stg_patients""",
    "ok_patients": one_per_id(
        "clean_patients where PatientID is not null and coalesce(FullName, '') <> ''"
        " and (Age is null or Age between 0 and 120)",
        "PatientID", ["FullName", "Age", "AgeBand", "Phone", "PhoneNormalized"]),
    "clean_doctors": """
      select distinct DoctorID, trim(FullName) as FullName, trim(Specialty) as Specialty,
             case when Specialty in ('Terapevt', 'Khirurg') then 'Lechebnyy personal'
                  when Specialty in ('Ortoped', 'Ortodont') then 'Vosstanovitelnaya stomatologiya'
                  else 'Prochee' end as SpecialtyGroup
      from stg_doctors where DoctorID is not null and trim(coalesce(FullName, '')) <> ''""",
    "ok_doctors": one_per_id("clean_doctors", "DoctorID", ["FullName", "Specialty", "SpecialtyGroup"]),
    "clean_diagnoses": """
      select distinct DiagnosisID, trim(ICDCode) as ICDCode, trim(DiagnosisName) as DiagnosisName,
             trim(TreatmentMethod) as TreatmentMethod,
             case substr(ICDCode, 1, 3)
               when 'K02' then 'Karioznye porazheniya' when 'K04' then 'Porazheniya pulpy'
               when 'K05' then 'Parodontologicheskie zabolevaniya' when 'K07' then 'Anomalii chelyustey'
               when 'K08' then 'Prochie izmeneniya zubochelyustnoy sistemy'
               when 'K11' then 'Zabolevaniya slizistoy i slyunnykh zhelez'
               when 'K12' then 'Zabolevaniya slizistoy i slyunnykh zhelez'
               when 'K13' then 'Zabolevaniya slizistoy i slyunnykh zhelez'
               else 'Prochie diagnozy' end as DiagnosisClass
      from stg_diagnoses where DiagnosisID is not null and trim(coalesce(DiagnosisName, '')) <> ''""",
    "ok_diagnoses": one_per_id(
        "clean_diagnoses", "DiagnosisID", ["ICDCode", "DiagnosisName", "TreatmentMethod", "DiagnosisClass"]),
    "ok_visit_types": """
      select VisitTypeID, trim(VisitName) as VisitName, trim(VisitCode) as VisitCode,
             case upper(trim(VisitCode)) when 'PR' then 'Pervichnyy vizit' when 'PRI' then 'Pervichnyy vizit'
               when 'SC' then 'Povtornyy vizit' when 'SEC' then 'Povtornyy vizit' else 'Inoy stsenariy' end as VisitCategory
      from stg_visit_types""",
    "ok_dates": f"""
      select DateID, FullDate, Day, Month, Year, cast(quarter(FullDate) as int) as QuarterNumber,
             monthname(FullDate) as MonthName, trim(WeekDay) as WeekDayName,
             cast(weekofyear(FullDate) as int) as WeekOfYear, isodow(FullDate) in (6, 7) as IsWeekend,
             case when Month >= 9 then 'Osen' when Month <= 2 then 'Zima' when Month <= 5 then 'Vesna' else 'Leto' end
               as AcademicPeriod
      from (select *, {_DATE_OF} as FullDate from stg_dates) where FullDate is not null""",
    "dim_patient": f"""
      select PatientID as PatientKey, * from ok_patients
      union all select 0, 0, 'Neizvestnyy patsient', null, 'Ne opredeleno', null, null""",
    "dim_doctor": f"""
      select DoctorID as DoctorKey, * from ok_doctors
      union all select 0, 0, 'Neizvestnyy vrach', 'Ne opredeleno', 'Prochee'""",
    "dim_diagnosis": f"""
      select DiagnosisID as DiagnosisKey, * from ok_diagnoses
      union all select 0, 0, 'UNK', 'Neizvestnyy diagnoz', 'Ne opredelen', 'Prochee'""",
    "dim_visit_type": """
      select * from ok_visit_types union all select 0, 'Neizvestnyy tip vizita', 'UNK', 'Prochee'""",
    "dim_date": """
      select * from ok_dates union all
      select 0, null, null, null, null, null, 'Ne opredeleno', 'Ne opredeleno', null, false, 'Ne opredeleno'""",
    "norm_visits": """
      select FactID, DateID, PatientID, DoctorID, DiagnosisID, VisitTypeID,
             try_cast(replace(ServiceCostText, ',', '.') as decimal(18,2)) as ServiceCost, VisitCount,
             try_cast(replace(ProfitText, ',', '.') as decimal(18,2)) as Profit, PatientCount,
             try_cast(replace(RepeatRateText, ',', '.') as decimal(9,4)) as RepeatRate,
             try_cast(replace(AvgTreatmentCostText, ',', '.') as decimal(18,2)) as AvgTreatmentCost
      from stg_visits""",
    "fact": f"""
      select n.FactID,
             coalesce(dd.DateID, 0) as DateID, coalesce(pp.PatientID, 0) as PatientID,
             coalesce(dr.DoctorID, 0) as DoctorID, coalesce(dg.DiagnosisID, 0) as DiagnosisID,
             coalesce(vt.VisitTypeID, 0) as VisitTypeID,
             cast(coalesce(ServiceCost, 0) as decimal(18,2)) as ServiceCost, coalesce(VisitCount, 0) as VisitCount,
             cast(coalesce(Profit, 0) as decimal(18,2)) as Profit, coalesce(PatientCount, 0) as PatientCount,
             cast(coalesce(RepeatRate, 0) as decimal(9,4)) as RepeatRate,
             cast(coalesce(AvgTreatmentCost, 0) as decimal(18,2)) as AvgTreatmentCost,
             case when coalesce(ServiceCost, 0) = 0 then cast(0 as decimal(9,4))
                  else {scaled(half_up(f"{cents('Profit')} * 1000000", cents('ServiceCost')), 4, 9)} end as MarginPercent
      from norm_visits n
      left join dim_date dd on dd.DateID = n.DateID
      left join dim_patient pp on pp.PatientID = n.PatientID
      left join dim_doctor dr on dr.DoctorID = n.DoctorID
      left join dim_diagnosis dg on dg.DiagnosisID = n.DiagnosisID
      left join dim_visit_type vt on vt.VisitTypeID = n.VisitTypeID""",
    "mv": """
      select f.FactID, FullDate, Year, Month, QuarterNumber, MonthName, WeekDayName, IsWeekend, AcademicPeriod,
             f.PatientID, p.FullName as PatientName, Age, AgeBand,
             f.DoctorID, r.FullName as DoctorName, Specialty, SpecialtyGroup,
             f.DiagnosisID, ICDCode, DiagnosisName, DiagnosisClass,
             f.VisitTypeID, VisitName, VisitCategory,
             ServiceCost, Profit, MarginPercent, VisitCount, PatientCount, RepeatRate, AvgTreatmentCost
      from fact f
      join dim_date using (DateID) join dim_patient p on p.PatientID = f.PatientID
      join dim_doctor r on r.DoctorID = f.DoctorID join dim_diagnosis g on g.DiagnosisID = f.DiagnosisID
      join dim_visit_type t on t.VisitTypeID = f.VisitTypeID""",
    "md": f"""
      select DoctorID, DoctorName, Specialty, SpecialtyGroup, Year, Month, count(*) as RowCountForIndexedUse,
             {VISIT_QTY}, {REVENUE}, {PROFIT}, {mean_money('ServiceCost')} as AvgCheck,
             {mean_rate('MarginPercent')} as AvgMarginPercent, {mean_rate('RepeatRate')} as AvgRepeatRate
      from mv group by all""",
    "mg": f"""
      select DiagnosisID, ICDCode, DiagnosisName, DiagnosisClass, Year, Month, {VISIT_QTY}, {REVENUE}, {PROFIT},
             {mean_rate('RepeatRate')} as AvgRepeatRate, {mean_money('AvgTreatmentCost')} as AvgTreatmentCost
      from mv group by all""",
    "mp": f"""
      select PatientID, PatientName, Age, AgeBand, count(*) as VisitRows, {VISIT_QTY}, {REVENUE}, {PROFIT},
             min(FullDate) as FirstVisitDate, max(FullDate) as LastVisitDate,
             cast(max(FullDate) - min(FullDate) as int) as VisitSpanDays, {mean_rate('RepeatRate')} as AvgRepeatRate
      from mv group by all""",
    "mt": f"""
      select FullDate, Year, Month, MonthName, QuarterNumber, {VISIT_QTY}, {REVENUE}, {PROFIT},
             {mean_money('AvgTreatmentCost')} as AvgTreatmentCost, {mean_rate('RepeatRate')} as AvgRepeatRate
      from mv group by all""",
}


def _used(body: str) -> set[str]:
    words = set(re.findall(r"[a-z_]+", body))
    direct = {name for name in TABLES if name in words}
    return direct.union(*[_used(TABLES[name]) for name in direct]) if direct else direct


def query(body: str, **extra: str) -> str:
    """``body`` with the tables it mentions in front; ``extra`` adds tables of its own, in order."""
    used = _used(" ".join([body, *extra.values()]))
    tables = {name: sql for name, sql in TABLES.items() if name in used} | extra
    if not tables:
        return body
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in tables.items()) + f"\n{body}"
