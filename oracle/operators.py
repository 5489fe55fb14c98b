"""DuckDB SQL of the loading, checking, cube and audit operators."""

import re

from .base import (
    BAND, END, NOW, PROFIT, REVENUE, TABLES, VISIT_QTY, cents, count_of, half_up, mean_money, mean_rate,
    one_per_id, percent, query, scaled, total,
)

STAGED = ["patients", "doctors", "dates", "visit_types", "diagnoses", "visits"]
SECOND = "2024-02-01 00:00:00"
CLOSED = "2024-01-31 23:59:59"
FIRST = "1900-01-01 00:00:00"


def counts(*pairs: tuple[str, str]) -> str:
    return " union all ".join(f"select '{name}' as ObjectName, count(*) as RowQty from {table}" for name, table in pairs)


def shown(column: str) -> str:
    return f"coalesce(cast({column} as varchar), '<NULL>')"


def rejected(table: str, key: str, reason: str, payload: str, source: str, where: str) -> str:
    return (f"select '{table}' as SourceTable, cast({key} as varchar) as BusinessKey, '{reason}' as RejectionReason, "
            f"{payload} as Payload from {source} where {where}")


REJECTS = {
    "reject_patients": rejected(
        "stg.DimPatients_Raw", "PatientID", "Nekorrektnye dannye patsienta",
        f"'FullName=' || {shown('FullName')} || '; Age=' || {shown('Age')}", "clean_patients",
        "PatientID is null or coalesce(FullName, '') = '' or Age < 0 or Age > 120"),
    "reject_doctors": rejected(
        "stg.DimDoctors_Raw", "DoctorID", "Otsutstvuyut klyuchevye atributy vracha",
        f"'FullName=' || {shown('FullName')} || '; Specialty=' || {shown('Specialty')}", "stg_doctors",
        "DoctorID is null or trim(coalesce(FullName, '')) = ''"),
    "reject_dates": rejected(
        "stg.DimDate_Raw", "DateID", "Nekorrektnaya kalendarnaya data",
        f"'Day=' || {shown('Day')} || '; Month=' || {shown('Month')} || '; Year=' || {shown('Year')}"
        f" || '; WeekDay=' || {shown('WeekDay')}", "stg_dates",
        "DateID is null or try_cast(printf('%04d-%02d-%02d', Year, Month, Day) as date) is null"),
    "reject_diagnoses": rejected(
        "stg.DimDiagnoses_Raw", "DiagnosisID", "Ne ukazan diagnoz ili kod MKB",
        f"'ICDCode=' || {shown('ICDCode')} || '; DiagnosisName=' || {shown('DiagnosisName')}", "stg_diagnoses",
        "DiagnosisID is null or trim(coalesce(DiagnosisName, '')) = ''"),
    "reject_visits": rejected(
        "stg.FactVisits_Raw", "FactID", "Nevozmozhno preobrazovat chislovye pokazateli vizita",
        f"'ServiceCost=' || {shown('ServiceCostText')} || '; Profit=' || {shown('ProfitText')}"
        f" || '; RepeatRate=' || {shown('RepeatRateText')}", "stg_visits s",
        "FactID is null or FactID not in (select FactID from norm_visits where FactID is not null"
        " and ServiceCost is not null and Profit is not null and AvgTreatmentCost is not null)"),
}


def issue(rule: str, entity: str, key: str, severity: str, text: str, source: str) -> str:
    return (f"select '{rule}' as RuleCode, '{entity}' as EntityName, cast({key} as varchar) as EntityKey, "
            f"'{severity}' as Severity, {text} as IssueDescription from {source}")


_DAYS = "['ponedelnik','vtornik','sreda','chetverg','pyatnitsa','subbota','voskresene']"
ISSUES = {
    "dq_date_weekday": issue(
        "DATE_WEEKDAY", "dw.DimDate", "DateID", "MEDIUM",
        "'Den nedeli iz iskhodnykh dannykh (' || WeekDayName || ') ne sovpadaet s rasschitannoy kalendarnoy datoy.'",
        f"ok_dates where lower(WeekDayName) <> ({_DAYS})[isodow(FullDate)]"),
    "dq_phone_duplicate": issue(
        "PHONE_DUPLICATE", "dw.DimPatient", "PhoneNormalized", "LOW",
        "'Odin telefon ispolzuetsya neskolkimi patsientami: ' || PhoneNormalized",
        "ok_patients where PhoneNormalized <> '' group by PhoneNormalized having count(*) > 1"),
    "dq_negative_margin": issue(
        "NEGATIVE_MARGIN", "dw.FactVisit", "FactID", "MEDIUM",
        "'Marzhinalnost po vizitu otritsatelna, trebuetsya proverka sebestoimosti ili vyruchki.'",
        "fact where MarginPercent < 0"),
    "dq_repeat_rate_range": issue(
        "REPEAT_RATE_RANGE", "dw.FactVisit", "FactID", "HIGH",
        "'Pokazatel RepeatRate nakhoditsya vne diapazona [0;1].'", "fact where RepeatRate not between 0 and 1"),
    "dq_avg_check_gap": issue(
        "AVG_CHECK_GAP", "dw.FactVisit", "FactID", "LOW",
        "'Srednyaya stoimost lecheniya zametno otlichaetsya ot ServiceCost, trebuetsya biznes-proverka.'",
        "fact where abs(ServiceCost - AvgTreatmentCost) > 0.01"),
}
ALL_ISSUES = " union all ".join(ISSUES.values())
MISSING = issue(
    "FK_MISSING", "FactVisits", "n.FactID", "HIGH",
    "'Otsutstvuet izmerenie dlya fakta. DateID=' || n.DateID || ', PatientID=' || n.PatientID || ', DoctorID='"
    " || n.DoctorID || ', DiagnosisID=' || n.DiagnosisID || ', VisitTypeID=' || n.VisitTypeID",
    """norm_visits n where n.DateID not in (select DateID from dim_date)
       or n.PatientID not in (select PatientID from dim_patient) or n.DoctorID not in (select DoctorID from dim_doctor)
       or n.DiagnosisID not in (select DiagnosisID from dim_diagnosis)
       or n.VisitTypeID not in (select VisitTypeID from dim_visit_type)""")


def summary(issues: str, resolved_rule: str = "") -> str:
    done = f"RuleCode = '{resolved_rule}'"
    return f"""select RuleCode, EntityName, Severity, count(*) as IssueCount,
               count(*) filter ({done}) as ResolvedCount, count(*) filter (not {done}) as OpenCount
               from ({issues}) group by all"""


def second_batch(name: str, key: str, columns: dict[str, str]) -> str:
    """The raw rows of the second batch: changed, without every eleventh, with new IDs past the highest."""
    raw = f"stg_{name}"
    changed = ", ".join(f"{sql} as {c}" for c, sql in columns.items())
    plain = ", ".join(columns)
    kind = "int" if key in ("DateID", "VisitTypeID") else "bigint"
    return f"""select {key}, {changed} from {raw} where {key} % 11 <> 0 union all
               select cast({key} + (select max({key}) from {raw}) as {kind}), {plain} from {raw} where {key} % 13 = 0"""


BATCH_2 = {
    "stg_patients": second_batch("patients", "PatientID", {
        "FullName": "FullName", "Age": "case when PatientID % 10 = 0 then Age + 1 else Age end", "Phone": "Phone"}),
    "stg_doctors": second_batch("doctors", "DoctorID", {
        "FullName": "FullName", "Specialty": "case when DoctorID % 7 = 0 then 'Ortodont' else Specialty end"}),
    "stg_diagnoses": second_batch("diagnoses", "DiagnosisID", {
        "ICDCode": "ICDCode", "DiagnosisName": "DiagnosisName",
        "TreatmentMethod": "case when DiagnosisID % 9 = 0 then TreatmentMethod || '-2' else TreatmentMethod end"}),
    "stg_dates": second_batch("dates", "DateID", {
        "Day": "Day", "Month": "Month", "Year": "Year",
        "WeekDay": f"({_DAYS})[isodow(try_cast(printf('%04d-%02d-%02d', Year, Month, Day) as date))]"}),
    "stg_visit_types": second_batch("visit_types", "VisitTypeID", {
        "VisitName": "VisitName || ' visit'", "VisitCode": "VisitCode"}),
}


def second_source(staging: str, *steps: str) -> dict[str, str]:
    """Extra tables that clean the second batch with the statements that clean the first."""
    extra, previous = {"raw_2": BATCH_2[staging]}, ("raw_2", staging)
    for step in steps:
        extra[f"{step}_2"] = TABLES[step].replace(f"from {previous[1]}", f"from {previous[0]}")
        previous = (f"{step}_2", step)
    return extra


def versions(name: str, key: str, surrogate: str, attributes: list[str], tracked: list[str], *steps: str) -> str:
    """State of a versioned dimension after both batches, from the cleaned rows of each."""
    first, second = steps[-1], f"{steps[-1]}_2"
    differs = " or ".join(f"o.{c} is distinct from n.{c}" for c in tracked)
    old = ", ".join(f"o.{c}" for c in attributes)
    new = ", ".join(f"n.{c}" for c in attributes)
    unknown = ", ".join(attributes)
    body = f"""
      select 1 as Version, {key}, {unknown}, '{FIRST}' as EffectiveFrom, '{END}' as EffectiveTo, true as IsCurrent,
             cast(null as int) as SourceBatchID from dim_{name} where {surrogate} = 0
      union all
      select 1, o.{key}, {old}, '{NOW}', case when n.{key} is not null and ({differs}) then '{CLOSED}'
             else '{END}' end, n.{key} is null or not ({differs}), 1
      from {first} o left join {second} n using ({key})
      union all
      select case when o.{key} is null then 1 else 2 end, n.{key}, {new}, '{SECOND}', '{END}', true, 2
      from {second} n left join {first} o using ({key}) where o.{key} is null or {differs}"""
    return query(body, **second_source({"patient": "stg_patients", "doctor": "stg_doctors",
                                        "diagnosis": "stg_diagnoses"}[name], *steps))


def overwritten(name: str, key: str, surrogate: str, staging: str, step: str) -> str:
    """State of an overwriting dimension after both batches."""
    body = f"""
      select *, {key} as {surrogate}, 2 as SourceBatchID from {step}_2
      union all select *, {key}, 1 from {step} where {key} not in (select {key} from {step}_2)
      union all select *, 0, cast(null as int) from dim_{name} where {key} = 0"""
    return query(body, **second_source(staging, step))


def months(key: str, *measures: str) -> str:
    return query(f"""select Year, Month, {key}, {VISIT_QTY}, {REVENUE}, {PROFIT},
                     {', '.join(measures)}, '{NOW}' as LoadedAt from mv group by Year, Month, {key}""")


LOADED = counts(
    ("patient", "ok_patients"), ("doctor", "ok_doctors"), ("date", "ok_dates"), ("visit_type", "ok_visit_types"),
    ("diagnosis", "ok_diagnoses"), ("fact", "fact"))
READ = counts(*[(name, f"stg_{name}") for name in STAGED])
BATCH_COUNTS = f"""(select sum(RowQty)::bigint from ({READ})) as RowsRead,
  (select sum(RowQty)::bigint from ({LOADED})) as RowsLoaded,
  (select count(*) from ({' union all '.join(REJECTS.values())})) as RowsRejected"""
BATCH = f"""1 as BatchID, 'Full load' as BatchName, 'CSV' as SourceSystem, '{NOW}' as StartedAt,
  '2024-01-01 00:05:00' as FinishedAt, 'SUCCESS' as Status, {BATCH_COUNTS}"""
DESCRIBED = query(
    counts(
        *[(f"dim_{n}", f"dim_{n}") for n in ["patient", "doctor", "date", "visit_type", "diagnosis"]],
        ("fact_visit", "fact"),
        ("agg_doctor_month", "(select distinct Year, Month, DoctorID from mv)"),
        ("agg_diagnosis_month", "(select distinct Year, Month, DiagnosisID from mv)")))

CUBE_SUMS = f"{total('ServiceCost', '\"Service Cost\"')}, {total('Profit', 'Profit')}, {count_of('VisitCount', '\"Visit Count\"')}"

# Measures and their descriptions.
MEASURES = {
    "ServiceCost": "Vyruchka po uslugam", "Profit": "Pribyl po vizitam", "VisitCount": "Kolichestvo vizitov",
    "PatientCount": "Kolichestvo patsientov", "RepeatRate": "Dolya povtornykh vizitov",
    "AvgTreatmentCost": "Srednyaya stoimost lecheniya", "MarginPercent": "Marzhinalnost vizita",
}
DASHBOARD = f"""
  select DiagnosisClass, ICDCode, DiagnosisName, Year, Month, VisitQty, RevenueAmount, ProfitAmount, AvgRepeatRate,
         AvgTreatmentCost, {scaled('class_cents', 2, 28)} as ClassRevenue,
         {percent(cents('RevenueAmount'), 'class_cents')} as ShareWithinClass
  from (select *, sum({cents('RevenueAmount')}) over (partition by DiagnosisClass) as class_cents from mg)"""

FILES = {
    "patients": "DimPatients.csv", "doctors": "DimDoctors.csv", "dates": "DimDate.csv", "visit_types": "DimVisitType.csv",
    "diagnoses": "DimDiagnoses.csv", "visits": "FactVisits.csv",
}
COLUMNS = {
    "patients": "PatientID FullName Age Phone", "doctors": "DoctorID FullName Specialty", "dates": "DateID Day Month Year WeekDay",
    "visit_types": "VisitTypeID VisitName VisitCode", "diagnoses": "DiagnosisID ICDCode DiagnosisName TreatmentMethod",
    "visits": "FactID DateID PatientID DoctorID DiagnosisID VisitTypeID ServiceCostText VisitCount ProfitText PatientCount RepeatRateText AvgTreatmentCostText",
}
REFERENCES = {"date": "DateID", "visit_type": "VisitTypeID", "patient": "PatientID", "doctor": "DoctorID", "diagnosis": "DiagnosisID"}
STAGED_AS = {"patient": "patients", "doctor": "doctors", "diagnosis": "diagnoses", "date": "dates", "visit_type": "visit_types"}


def row_text(name: str) -> str:
    return "concat_ws(';', " + ", ".join(f"coalesce({c}::varchar, '')" for c in COLUMNS[name].split()) + ")"


def again(sql: str) -> str:
    """A statement about the first delivery as one about the second."""
    return re.sub(r"\b(" + "|".join(TABLES) + r")\b", r"\1_2", sql)


def _seen_ids(name: str) -> str:
    key, table = REFERENCES[name], "ok_" + STAGED_AS[name]
    return f"select {key} from {table} union select {key} from {table}_2 union select 0"


#: The second delivery on top of the first: its files, cleaned by the statements of the first, and what can be referred to.
SECOND_DELIVERY = {f"{name}_2": sql for name, sql in BATCH_2.items()} | {
    "stg_visits_2": "select * replace (case when FactID % 5 = 0 then '100,5' else ServiceCostText end as ServiceCostText) from stg_visits where FactID % 7 <> 0",
} | {f"{name}_2": again(TABLES[name]) for name in [
    "clean_patients", "ok_patients", "clean_doctors", "ok_doctors", "clean_diagnoses", "ok_diagnoses", "ok_visit_types", "ok_dates", "norm_visits",
]} | {f"dim_{name}_2": _seen_ids(name) for name in REFERENCES} | {
    "all_dates": "select DateID, Year, Month from ok_dates_2 union all select DateID, Year, Month from ok_dates where DateID not in (select DateID from ok_dates_2)",
}
#: Keys of the second delivery's visits that neither delivery's dimensions have.
LOST = " union all ".join(
    f"""select '{key}' as Reference, 'KeyNotFound' as ErrorType, cast({key} as varchar) as KeyValue, count(*) as KeyRows from norm_visits_2
        where {key} not in (select {key} from {'ok_' + STAGED_AS[n]}_2) group by {key}""" for n, key in REFERENCES.items())


def state(name: str, batch: str, source: str, current: str = "null", amount: str = "null") -> str:
    return (f"select '{name}' as ObjectName, ({batch})::int as BatchID, ({current})::boolean as IsCurrent, count(*) as RowQty, "
            f"cast({amount} as decimal(28,2)) as Amount from {source} group by all having count(*) > 0")


def counted(batch: int, counts: str) -> str:
    return f"""select unnest(['RowsRead', 'RowsLoaded', 'RowsRejected']) as ObjectName, {batch}::int as BatchID, null::boolean as IsCurrent,
      unnest([RowsRead::bigint, RowsLoaded::bigint, RowsRejected::bigint]) as RowQty, null::decimal(28,2) as Amount from (select {counts})"""


_UNKNOWN = [(n, "true" if n in ("patient", "doctor", "diagnosis") else "null") for n in REFERENCES]
_MONTHS = "(select Year, Month, {key}, sum(ServiceCost) as s from mv group by Year, Month, {key})"
STATE_1 = " union all ".join([
    *[state(f"dim_{n}", "null", f"(select 1 from dim_{n} where coalesce({REFERENCES[n]}, 0) = 0)", c) for n, c in _UNKNOWN],
    *[state(f"dim_{n}", "1", f"ok_{STAGED_AS[n]}", c) for n, c in _UNKNOWN],
    state("fact_visit", "1", "fact", amount="sum(ServiceCost)"),
    state("agg_doctor_month", "null", _MONTHS.format(key="DoctorID"), amount="sum(s)"),
    state("agg_diagnosis_month", "null", _MONTHS.format(key="DiagnosisID"), amount="sum(s)"),
    state("rejected_rows", "1", f"({' union all '.join(REJECTS.values())})"), state("data_quality_issue", "1", f"({MISSING})"),
    counted(1, BATCH_COUNTS),
])
_VERSIONS = {
    "patient": ("PatientID", ["FullName", "Age", "PhoneNormalized"], "ok_patients"),
    "doctor": ("DoctorID", ["FullName", "Specialty", "SpecialtyGroup"], "ok_doctors"),
    "diagnosis": ("DiagnosisID", ["ICDCode", "DiagnosisName", "TreatmentMethod", "DiagnosisClass"], "ok_diagnoses"),
}


def _history(name: str) -> str:
    """(ID, EffectiveFrom, EffectiveTo, IsCurrent, SourceBatchID) of all versions after both deliveries."""
    key, tracked, table = _VERSIONS[name]
    differs = " or ".join(f"o.{c} is distinct from n.{c}" for c in tracked)
    return f"""select 0 as ID, '{FIRST}' as EffectiveFrom, '{END}' as EffectiveTo, true as IsCurrent, null::int as SourceBatchID
      union all select o.{key}, '{NOW}', case when n.{key} is not null and ({differs}) then '{CLOSED}' else '{END}' end,
        n.{key} is null or not ({differs}), 1 from {table} o left join {table}_2 n using ({key})
      union all select n.{key}, '{SECOND}', '{END}', true, 2 from {table}_2 n left join {table} o using ({key}) where o.{key} is null or {differs}"""


_FACTS_2 = """(select FactID, coalesce(d.DateID, 0) as DateID, d.Year, d.Month, coalesce(r.DoctorID, 0) as DoctorID, coalesce(g.DiagnosisID, 0) as DiagnosisID,
  coalesce(ServiceCost, 0) as ServiceCost from norm_visits_2 n left join all_dates d on d.DateID = n.DateID
  left join dim_doctor_2 r on r.DoctorID = n.DoctorID left join dim_diagnosis_2 g on g.DiagnosisID = n.DiagnosisID)"""
_MONTHS_2 = "(select Year, Month, {key}, sum(ServiceCost) as s from " + _FACTS_2 + " group by Year, Month, {key})"
_REJECTED_2 = again(" union all ".join(REJECTS.values()))
_MEMBERS_2 = " + ".join([
    *[f"(select count(*) from ({_history(n)}) where IsCurrent and ID <> 0)" for n in _VERSIONS],
    *[f"(select count(*) from dim_{n}_2 where {REFERENCES[n]} <> 0)" for n in ("date", "visit_type")], "(select count(*) from norm_visits_2)"])
_READ_2 = " + ".join(f"(select count(*) from stg_{n}_2)" for n in STAGED)
STATE_1_AND_2 = " union all ".join([
    *[f"select 'dim_{n}' as ObjectName, SourceBatchID as BatchID, IsCurrent, count(*) as RowQty, null::decimal(28,2) as Amount from ({_history(n)}) group by all" for n in _VERSIONS],
    *[state(f"dim_{n}", b, f"({rows})") for n in ("date", "visit_type") for b, rows in [
        ("2", f"select 1 from ok_{STAGED_AS[n]}_2"), ("null", "select 1"),
        ("1", f"select 1 from ok_{STAGED_AS[n]} where {REFERENCES[n]} not in (select {REFERENCES[n]} from ok_{STAGED_AS[n]}_2)")]],
    state("fact_visit", "2", _FACTS_2, amount="sum(ServiceCost)"),
    state("agg_doctor_month", "null", _MONTHS_2.format(key="DoctorID"), amount="sum(s)"),
    state("agg_diagnosis_month", "null", _MONTHS_2.format(key="DiagnosisID"), amount="sum(s)"),
    state("rejected_rows", "1", f"({' union all '.join(REJECTS.values())})"), state("rejected_rows", "2", f"({_REJECTED_2})"),
    state("data_quality_issue", "1", f"({MISSING})"), state("data_quality_issue", "2", f"({again(MISSING)})"),
    counted(1, BATCH_COUNTS),
    counted(2, f"{_READ_2} as RowsRead, {_MEMBERS_2} as RowsLoaded, (select count(*) from ({_REJECTED_2})) as RowsRejected"),
])


def _damage_faults(name: str) -> str:
    """Duplicates, overlaps and IDs with not one current version in a damaged history."""
    key = _VERSIONS[name][0]
    damaged = f"""(select ID, EffectiveFrom, IsCurrent or ID % 5 = 0 as IsCurrent,
      case when not IsCurrent and ID % 3 = 0 then strftime(EffectiveTo::timestamp + interval 1 day, '%Y-%m-%d %H:%M:%S') else EffectiveTo end as EffectiveTo
      from ({_history(name)}))"""
    return f"""select 'damaged {name}' as TableName, '{key}+EffectiveTo+IsCurrent' as KeyName, 'duplicate' as ErrorType,
        concat_ws('|', ID, EffectiveTo, IsCurrent) as KeyValue, count(*) as KeyRows
        from (select * from {damaged} union all select * from {damaged} where ID % 7 = 0) group by ID, EffectiveTo, IsCurrent having count(*) > 1
      union all select 'damaged {name}', '{key}', 'overlap', ID::varchar, count(*) from
        (select ID, lag(EffectiveTo) over (partition by ID order by EffectiveFrom) >= EffectiveFrom as o from {damaged}) where o group by ID
      union all select 'damaged {name}', '{key}', 'not one current version', ID::varchar, count(*) filter (IsCurrent) from {damaged}
        group by ID having count(*) filter (IsCurrent) <> 1"""


UNIQUE_KEYS = query(
    """select 'stg.FactVisits_Raw' as TableName, 'FactID' as KeyName, 'duplicate' as ErrorType, FactID::varchar as KeyValue, count(*) as KeyRows
       from stg_visits group by FactID having count(*) > 1 union all """ + " union all ".join(_damage_faults(n) for n in _VERSIONS), **SECOND_DELIVERY)

_VERSIONED_KEYS = [("EffectiveFrom", "1"), ("EffectiveTo", "1"), ("IsCurrent", "1")]
MANDATORY = [
    ("stg.vw_FactVisits_Normalized", "norm_visits", [(c, c) for c in ["FactID", "DateID", "PatientID", "ServiceCost", "Profit", "RepeatRate", "AvgTreatmentCost"]]),
    ("dw.FactVisit", "fact", [("VisitKey", "1"), ("FactID", "FactID"), *[(k.replace("ID", "Key"), k) for k in REFERENCES.values()],
                              *[(c, c) for c in ["ServiceCost", "Profit", "VisitCount", "PatientCount", "RepeatRate", "AvgTreatmentCost"]], ("LoadedAt", "1")]),
    ("dw.DimPatient", "dim_patient", [("PatientKey", "PatientKey"), ("PatientID", "PatientID"), ("FullName", "FullName"), *_VERSIONED_KEYS]),
    ("dw.DimDoctor", "dim_doctor", [("DoctorKey", "DoctorKey"), ("DoctorID", "DoctorID"), ("FullName", "FullName"), *_VERSIONED_KEYS]),
    ("dw.DimDiagnosis", "dim_diagnosis", [("DiagnosisKey", "DiagnosisKey"), ("DiagnosisID", "DiagnosisID"), *_VERSIONED_KEYS]),
    ("dw.DimDate", "dim_date", [("DateKey", "DateID"), ("DateID", "DateID"), ("IsWeekend", "IsWeekend")]),
    ("dw.DimVisitType", "dim_visit_type", [("VisitTypeKey", "VisitTypeID"), ("VisitTypeID", "VisitTypeID"), ("VisitName", "VisitName"), ("VisitCode", "VisitCode")]),
]

SQL = {
    "stg_read_csv": query("select * from stg_visits"),
    "stg_read_csv_codepage": query("select * replace ('Пациент ' || FullName as FullName) from stg_patients"),
    "stg_malformed_lines": query(
        """select case when FactID % 97 = 0 then short when FactID % 89 = 0 then short || ';' || last || ';more'
                  else short || ';' || last end as Line
           from (select FactID, coalesce(AvgTreatmentCostText, '') as last,
                   concat_ws(';', coalesce(FactID::varchar, ''), coalesce(DateID::varchar, ''),
                     coalesce(PatientID::varchar, ''), coalesce(DoctorID::varchar, ''),
                     coalesce(DiagnosisID::varchar, ''), coalesce(VisitTypeID::varchar, ''),
                     coalesce(ServiceCostText, ''), case when FactID % 83 = 0 then 'x' else coalesce(VisitCount::varchar, '') end,
                     coalesce(ProfitText, ''), coalesce(PatientCount::varchar, ''), coalesce(RepeatRateText, '')) as short
                 from stg_visits)
           where FactID % 97 = 0 or FactID % 89 = 0 or FactID % 83 = 0"""),
    "stg_load_all": query(READ),
    "stg_lineage": query(" union all ".join(
        f"select {row_text(n)} as RowText, '{FILES[n]}' as SourceFileName, '{NOW}' as LoadedAt, 1 as BatchID from stg_{n}" for n in STAGED)),
    "stg_truncate": query(" union all ".join(f"select '{n}' as TableName, {row_text(n)} as RowText from stg_{n}" for n in STAGED)),
    "stg_visits_normalized": query(f"select *, 'FactVisits.csv' as SourceFileName, '{NOW}' as LoadedAt, 1 as BatchID from norm_visits"),
    "stg_visits_strict": query("select * replace (coalesce(ServiceCost, AvgTreatmentCost) as ServiceCost) from norm_visits"),
    "sink_clear_and_load": query(counts(
        *[(n, f"dim_{n}") for n in ["patient", "doctor", "date", "visit_type", "diagnosis"]], ("fact", "fact"))),
    "param_upsert": query(
        f"""select coalesce(s.Specialty, f.Specialty) as ParameterName,
              cast(coalesce(s.n, f.n) as varchar) as ParameterValue, 'doctors' as ParameterDescription,
              case when s.n is null then '{NOW}' else '{SECOND}' end as UpdatedAt
            from (select Specialty, count(*) as n from stg_doctors group by all) f
            full join (select Specialty, count(*) as n from raw_2 where Specialty <> 'Khirurg' group by all) s
              using (Specialty)""",
        raw_2=BATCH_2["stg_doctors"]),
    "dim_patient_clean": query("select * from clean_patients"),
    "age_band": query(f"select PatientID, Age, {BAND} as AgeBand from stg_patients"),
    "dim_patient_dedupe": query(
        one_per_id(
            "rebanded where coalesce(FullName, '') <> '' and (Age is null or Age between 0 and 120)",
            "PatientID", ["FullName", "Age", "AgeBand", "Phone", "PhoneNormalized"]),
        rebanded=f"""select distinct PatientID, FullName, Age, {BAND} as AgeBand, Phone, PhoneNormalized from
          (select * from clean_patients union all
           select * replace (Age + case when PatientID % 10 = 0 then 1 else 0 end as Age) from clean_patients)"""),
    "dim_doctor_clean": query("select * from clean_doctors"),
    "dim_diagnosis_clean": query("select * from clean_diagnoses"),
    "dim_visit_type_clean": query("select * from ok_visit_types"),
    "dim_date_build": query("select * from ok_dates"),
    "academic_period": query(
        """select DateID, Month, case when Month >= 9 then 'Osen' when Month <= 2 then 'Zima' when Month <= 5 then 'Vesna'
             else 'Leto' end as AcademicPeriod from stg_dates"""),
    "is_weekend": query(
        "select s.DateID, FullDate, coalesce(IsWeekend, false) as IsWeekend from stg_dates s left join ok_dates using (DateID)"),
    "margin_percent": query(
        f"""select FactID, ServiceCost, Profit,
              case when coalesce(ServiceCost, 0) = 0 then cast(0 as decimal(9,4))
                   else {scaled(half_up(f"{cents('Profit')} * 1000000", cents('ServiceCost')), 4, 9)} end as MarginPercent
            from norm_visits"""),
    **{name: query(sql) for name, sql in REJECTS.items()},
    "reject_doctors": query(
        REJECTS["reject_doctors"].replace("from stg_doctors", "from delivered"),
        delivered="""select case when DoctorID % 11 <> 0 then DoctorID end as DoctorID,
          case when DoctorID % 9 = 0 then '  ' else FullName end as FullName, Specialty from stg_doctors"""),
    "reject_all": query(" union all ".join(REJECTS.values())),
    "dq_fk_missing": query(MISSING),
    "validate_unique_key": UNIQUE_KEYS,
    "validate_fk": query(" union all ".join(
        f"""select '{key}' as Reference, cast({key} as varchar) as KeyValue, count(*) as KeyRows from stg_visits
            where {key} is not null and {key} not in (select {key} from dim_{n} where {key} is not null) group by {key}"""
        for n, key in REFERENCES.items())),
    "validate_not_null": query(" union all ".join(
        f"select '{t}' as TableName, '{c}' as ColumnName, count(*) - count({expr}) as NullRows from {source}"
        for t, source, columns in MANDATORY for c, expr in columns)),
    "validate_key_policy": query(" union all ".join(
        f"""select '{key}' as Reference, 'KeyNotFound' as ErrorType, cast({key} as varchar) as KeyValue, count(*) as KeyRows
              from stg_visits where {key} not in (select {key} from delivered_{n} where {key} is not null) group by {key}
            union all select '{key}', 'KeyDuplicate', cast({key} as varchar), count(*) from delivered_{n}
              where {key} is not null group by {key} having count(*) > 1
            union all select '{key}', 'NullKey', null, count(*) from delivered_{n} where {key} is null having count(*) > 0"""
        for n, key in REFERENCES.items()), **{
        f"delivered_{n}": f"""select case when {key} % 11 <> 0 then {key} end as {key} from
          (select {key} from stg_{STAGED_AS[n]} union all select {key} from stg_{STAGED_AS[n]} where {key} % 7 = 0)"""
        for n, key in REFERENCES.items()}),
    "validate_key_policy_in_load": query(f"select 2 as BatchID, * from ({LOST})", **SECOND_DELIVERY),
    "scd2_patient": versions(
        "patient", "PatientID", "PatientKey", ["FullName", "Age", "AgeBand", "Phone", "PhoneNormalized"],
        ["FullName", "Age", "PhoneNormalized"], "clean_patients", "ok_patients"),
    "scd2_doctor": versions(
        "doctor", "DoctorID", "DoctorKey", ["FullName", "Specialty", "SpecialtyGroup"],
        ["FullName", "Specialty", "SpecialtyGroup"], "clean_doctors", "ok_doctors"),
    "scd2_diagnosis": versions(
        "diagnosis", "DiagnosisID", "DiagnosisKey", ["ICDCode", "DiagnosisName", "TreatmentMethod", "DiagnosisClass"],
        ["ICDCode", "DiagnosisName", "TreatmentMethod", "DiagnosisClass"], "clean_diagnoses", "ok_diagnoses"),
    "scd2_latest_version_lookup": query(
        """select n.DoctorID, n.Specialty as NewSpecialty, o.DoctorID is not null as Known, o.FullName, o.Specialty
           from ok_doctors_2 n left join dim_doctor o using (DoctorID)""",
        **second_source("stg_doctors", "clean_doctors", "ok_doctors")),
    "scd1_date": overwritten("date", "DateID", "DateKey", "stg_dates", "ok_dates"),
    "scd1_visit_type": overwritten("visit_type", "VisitTypeID", "VisitTypeKey", "stg_visit_types", "ok_visit_types"),
    "surrogate_key": query("select PatientID, true as IsUnique, true as IsPositive from dim_patient"),
    "unknown_member": query(" union all ".join(
        f"select '{n}' as Dimension, count(*) filter ({k} = 0) as VisitRows from fact" for n, k in [
            ("date", "DateID"), ("patient", "PatientID"), ("doctor", "DoctorID"), ("diagnosis", "DiagnosisID"),
            ("visit_type", "VisitTypeID")])),
    "fact_visit_load": query(
        """select FactID, DateID as DateKey, PatientID, DoctorID, DiagnosisID, VisitTypeID as VisitTypeKey, ServiceCost,
              VisitCount, Profit,
              PatientCount, RepeatRate, AvgTreatmentCost, MarginPercent, 1 as SourceBatchID, '""" + NOW + """' as LoadedAt from fact"""),
    "agg_doctor_month": months(
        "DoctorID", mean_money("ServiceCost") + " as AvgRevenuePerVisit", mean_money("Profit") + " as AvgProfitPerVisit"),
    "agg_diagnosis_month": months("DiagnosisID", mean_rate("RepeatRate") + " as RepeatRateAvg"),
    "full_load": query(f"{STATE_1_AND_2}", **SECOND_DELIVERY),
    "rebuild_stopped": query(STATE_1),
    "rebuild": query(summary(f"{MISSING} union all {ALL_ISSUES}")),
    "compat_patients": query("select PatientID, FullName as Name, Age, Phone from dim_patient"),
    "compat_doctors": query("select DoctorID, FullName as Name, Specialty from dim_doctor"),
    "compat_date": query("select DateID, Day, Month, Year, WeekDayName as WeekDay from dim_date"),
    "compat_visit_type": query("select VisitTypeID, VisitName, VisitCode from dim_visit_type"),
    "compat_diagnoses": query("select DiagnosisID, ICDCode, DiagnosisName, TreatmentMethod from dim_diagnosis"),
    "compat_fact": query("select * exclude (MarginPercent) from fact"),
    "mart_visit_detailed": query("select * from mv"),
    "mart_doctor_performance": query("select * from md"),
    "mart_diagnosis_performance": query("select * from mg"),
    "mart_patient_segment": query("select * from mp"),
    "mart_time_series": query("select * from mt"),
    "report_doctor_dashboard": query(
        """select * exclude (RowCountForIndexedUse), cast(dense_rank() over (
             partition by Year, Month order by RevenueAmount desc) as int) as RevenueRank from md"""),
    "report_doctor_dashboard_month": query(
        """select * exclude (RowCountForIndexedUse), cast(dense_rank() over (order by RevenueAmount desc) as int)
             as RevenueRank from md where Year = 1997 and Month = 5"""),
    "report_diagnosis_dashboard_class": query(DASHBOARD + " where DiagnosisClass = 'Porazheniya pulpy'"),
    "report_diagnosis_dashboard": query(DASHBOARD),
    "report_patient_age": query(
        f"""select AgeBand, count(*) as PatientQty, {count_of('VisitQty', 'VisitQty')},
              {total('RevenueAmount', 'RevenueAmount')}, {total('ProfitAmount', 'ProfitAmount')},
              {mean_rate('AvgRepeatRate')} as AvgRepeatRate from mp group by all"""),
    "cube_query": query(
        f"""select DoctorID, VisitTypeID, cast(grouping(DoctorID, VisitTypeID) as int) as Level, {CUBE_SUMS}
            from fact group by cube (DoctorID, VisitTypeID)"""),
    "cube_slice": query(
        f"select PatientID, DiagnosisID, {total('ServiceCost', '\"Доход\"')} from fact where VisitTypeID = 2 group by all"),
    "cube_measures": query(
        f"""select VisitTypeID, {CUBE_SUMS}, {total('AvgTreatmentCost', '"Avg Treatment Cost"')},
              {total('Profit', '"Прибыль"')}, {total('ServiceCost', '"Доход"')} from fact group by all"""),
    "cube_unknown_member": query(
        f"select DiagnosisID, {count_of('VisitCount', '\"Visit Count\"')}, {total('Profit', 'Profit')} from fact group by all"),
    "cube_visits_by_diag_age": query(
        f"select DiagnosisID, Age, {count_of('VisitCount', 'VisitCount')} from mv group by all"),
    "cube_profit_by_doctor": query(f"select DoctorID, {total('Profit', 'Profit')} from fact group by all"),
    "cube_visits_by_date": query(f"select DateID, {count_of('VisitCount', '\"Visit Count\"')} from fact group by all"),
    "cube_revenue_by_service": query(
        f"select VisitTypeID, {total('ServiceCost', '\"Service Cost\"')} from fact group by all"),
    "measure_avg_treatment_cost": query(
        f"select DoctorID, {mean_money('AvgTreatmentCost')} as MeanTreatmentCost from fact group by all"),
    **{name: query(sql) for name, sql in ISSUES.items()},
    "dq_run_all": query(ALL_ISSUES),
    "dq_summary": query(f"select *, '{NOW}' as LastIssueAt from ({summary(ALL_ISSUES)})"),
    "dq_close_issues": query(f"select *, '{NOW}' as LastIssueAt from ({summary(ALL_ISSUES, 'NEGATIVE_MARGIN')})"),
    "audit_batch_counts": query(f"select {BATCH_COUNTS}"),
    "audit_start_finish": query(f"select {BATCH}, 'etl' as Initiator, 'Load complete' as CommentText"),
    "audit_failed_batch": query(
        f"""select BatchID, 'Full load' as BatchName, 'CSV' as SourceSystem, StartedAt, StartedAt as FinishedAt, Status, RowsRead, RowsLoaded,
              RowsRejected, 0 as DurationSeconds, 'etl' as Initiator, CommentText, ErrorLines, ErrorMessage from
              (select 1 as BatchID, '{NOW}' as StartedAt, 'SUCCESS' as Status, {BATCH_COUNTS}, 'Load complete' as CommentText,
                 0::bigint as ErrorLines, null as ErrorMessage
               union all select 2, '{SECOND}', 'FAILED', 0, 0, 0, why, 1, why from
                 (select 'visits with keys that were not found: ' || string_agg(Reference || ' ' || n, ', ' order by Reference) as why
                  from (select Reference, sum(KeyRows) as n from ({LOST}) group by Reference)))""", **SECOND_DELIVERY),
    "audit_log": query(
        f"""select 1 as BatchID, 'load_fact_visit' as ProcedureName, 'INFO' as LogLevel, 'Fact load' as StepName,
              'Visits loaded' as LogMessage, count(*) as AffectedRows, '{NOW}' as CreatedAt from fact"""),
    "audit_batch_status": query(
        f"select {BATCH}, 300 as DurationSeconds, 'etl' as Initiator, 'Load complete' as CommentText"),
    "describe_warehouse": DESCRIBED,
    "measure_catalog": query(" union all ".join(
        f"select '{name}' as MeasureName, '{text}' as MeasureDescription, cast(sum({name}) as decimal(28,4)) as Total from fact"
        for name, text in MEASURES.items())),
}
