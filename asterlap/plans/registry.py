"""Every operator bound to the driver's tables: name -> function of (session, folder)."""

import hashlib
from collections.abc import Callable
from datetime import datetime
from functools import reduce
from threading import Lock
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import literals as L
from ..functions import cleaning as C
from ..operators import audit, merge, olap, quality, star_cube, validate
from ..operators.joins import lookup
from ..schemas import FILES, STAGING
from ..session import checkpointed, shared_dir
from ..sources import binding, delimited, sinks
from . import dims, fact, marts, rejects, reports
from .pipeline import STOP, Loader
from .queries import QUERIES
from .warehouse import LOAD_TIME, Warehouse

FIRST_LOAD = datetime(2024, 1, 1)
SECOND_LOAD = datetime(2024, 2, 1)

_warehouses: dict[tuple, Warehouse] = {}
_lock = Lock()
_exported: dict[str, str] = {}
_loaders: dict[str, Loader] = {}
_loading = Lock()


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Digest of the input files' paths, sizes and times, so that a rewritten folder is loaded anew. Contents are not
    read."""
    files = spark.read.format("binaryFile").load(binding.paths(folder))
    each = F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string"))
    return tuple(files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(each)), "\n"), 256)).first())


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The session's warehouse over a folder of input tables."""
    key = (spark.sparkContext.applicationId, folder, _fingerprint(spark, folder))
    with _lock:
        if key not in _warehouses:
            digest = hashlib.sha256(repr(key).encode()).hexdigest()[:16]
            root = f"{shared_dir(spark)}/asterlap/{key[0]}/{digest}"
            _warehouses[key] = Warehouse(spark, binding.staging(spark, folder), root)
        return _warehouses[key]


def _exported_files(wh: Warehouse) -> str:
    """The staging tables as delimited text files, written once."""
    if wh.root not in _exported:
        base = f"{wh.root}/files"
        sinks.export_staging({name: wh.raw(name) for name in STAGING}, base)
        _exported[wh.root] = base
    return _exported[wh.root]


def _text_times(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that results do not depend on a session's time zone."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times})


# --- sources, sinks, staging -----------------------------------------------------------------------------------

def stg_read_csv(wh: Warehouse) -> DataFrame:
    return delimited.read_delimited(wh.spark, f"{_exported_files(wh)}/FactVisits.csv", STAGING["visits"])


def stg_read_csv_codepage(wh: Warehouse) -> DataFrame:
    """Written and read in a one-byte Cyrillic charset, in a session that allows it."""
    session = wh.spark.newSession()
    session.conf.set("spark.sql.legacy.javaCharsets", "true")
    path = f"{wh.root}/files_cp1251/DimPatients.csv"
    patients = binding.staging(session, _folder_of(wh))["patients"]()
    patients = patients.withColumn("FullName", F.concat(F.lit("Пациент "), "FullName"))
    sinks.write_delimited(patients, path, encoding="windows-1251")
    return delimited.read_delimited(session, path, STAGING["patients"], encoding="windows-1251")


def _folder_of(wh: Warehouse) -> str:
    return next(folder for (_, folder, _), known in _warehouses.items() if known is wh)


def stg_malformed_lines(wh: Warehouse) -> DataFrame:
    """Visits as text lines, some with a field too few or too many or an unreadable count: those, as they are."""
    key = F.col("FactID")
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in STAGING["visits"].names}
    text["VisitCount"] = F.when(key % 83 == 0, "x").otherwise(text["VisitCount"])
    short = F.concat_ws(";", *list(text.values())[:-1])
    whole = F.concat_ws(";", *text.values())
    line = F.when(key % 97 == 0, short).when(key % 89 == 0, F.concat(whole, F.lit(";more"))).otherwise(whole)
    path = f"{wh.root}/files_damaged/FactVisits.csv"
    wh.raw("visits").select(line.alias("value")).write.mode("overwrite").text(path)
    return delimited.malformed_lines(wh.spark, path, STAGING["visits"], header=False)


def _staged_files(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: read() for name, read in delimited.staging(wh.spark, _exported_files(wh), LOAD_TIME, 1).items()}


def stg_load_all(wh: Warehouse) -> DataFrame:
    return audit.row_counts(_staged_files(wh))


def _row_text(name: str) -> Column:
    """A staged row as one text, so that rows of all six tables fit one result."""
    return F.concat_ws(";", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in STAGING[name].names]).alias("RowText")


def stg_lineage(wh: Warehouse) -> DataFrame:
    """Every row of all six staging tables, with where it came from."""
    tables = {name: delimited.with_lineage(wh.raw(name), FILES[name], LOAD_TIME, 1) for name in STAGING}
    return _text_times(reduce(DataFrame.unionByName, [df.select(_row_text(n), *delimited.LINEAGE) for n, df in tables.items()]))


def stg_truncate(wh: Warehouse) -> DataFrame:
    """Loading the six files twice leaves one copy of each row: the second load replaces the first."""
    base = f"{wh.root}/files_twice"
    for _ in range(2):
        sinks.export_staging({name: wh.raw(name) for name in STAGING}, base)
    read = {name: delimited.read_delimited(wh.spark, f"{base}/{FILES[name]}", STAGING[name]) for name in STAGING}
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("TableName"), _row_text(name)) for name, df in read.items()])


def stg_visits_normalized(wh: Warehouse) -> DataFrame:
    staged = delimited.with_lineage(wh.raw("visits").drop("VisitKey"), FILES["visits"], LOAD_TIME, 1)
    return _text_times(fact.normalise_visits(staged))


def stg_visits_strict(wh: Warehouse) -> DataFrame:
    """All visits from a file read as text, after a redelivery that corrects the unreadable costs by the average."""
    path = f"{wh.root}/files_corrected/FactVisits.csv"
    corrected = F.when(F.col("ServiceCostText") == "n/a", F.col("AvgTreatmentCostText")).otherwise(F.col("ServiceCostText"))
    sinks.write_delimited(wh.raw("visits").select(*STAGING["visits"].names).withColumn("ServiceCostText", corrected), path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in STAGING["visits"].names])
    return fact.strict_visits(delimited.read_delimited(wh.spark, path, text))


def sink_clear_and_load(wh: Warehouse) -> DataFrame:
    """Two refreshes of the business-ID tables, read back."""
    tables = {name: marts.compat_dimension(name, df) for name, df in wh.dimensions().items()}
    for _ in range(2):
        written = sinks.clear_and_load(fact.compat_visits(wh.wide()), tables, f"{wh.root}/sink")
    return audit.row_counts({name: wh.spark.read.parquet(path) for name, path in written.items()})


def param_upsert(wh: Warehouse) -> DataFrame:
    """Doctors per specialty as parameters: those of the first delivery, updated by the second."""
    def parameters(doctors: DataFrame, now: datetime) -> DataFrame:
        return doctors.groupBy(F.col("Specialty").alias("ParameterName")).agg(
            F.count(F.lit(1)).cast("string").alias("ParameterValue"),
            F.lit("doctors").alias("ParameterDescription"),
            F.lit(now).cast("timestamp").alias("UpdatedAt"),
        )

    second = _second_batch(wh, "doctor").filter("Specialty <> 'Khirurg'")
    known = parameters(wh.raw("doctors"), FIRST_LOAD)
    return _text_times(merge.upsert(known, parameters(second, SECOND_LOAD), "ParameterName"))


# --- cleaning ----------------------------------------------------------------------------------------------------

def age_band(wh: Warehouse) -> DataFrame:
    return wh.raw("patients").select("PatientID", "Age", C.age_band(F.col("Age")).alias("AgeBand"))


def dim_patient_dedupe(wh: Warehouse) -> DataFrame:
    """Patients delivered twice, every tenth a year older the second time: one row each remains."""
    once = wh.raw("patients")
    again = once.withColumn("Age", F.col("Age") + F.when(F.col("PatientID") % 10 == 0, 1).otherwise(0))
    return dims.source_rows("patient", once.unionByName(again))


def academic_period(wh: Warehouse) -> DataFrame:
    return wh.raw("dates").select("DateID", "Month", C.academic_period(F.col("Month")).alias("AcademicPeriod"))


def is_weekend(wh: Warehouse) -> DataFrame:
    dated = wh.raw("dates").withColumn("FullDate", dims.full_date())
    return dated.select("DateID", "FullDate", C.is_weekend(F.col("FullDate")).alias("IsWeekend"))


def margin_percent(wh: Warehouse) -> DataFrame:
    margin = C.margin_percent(F.col("ServiceCost"), F.col("Profit")).alias("MarginPercent")
    return wh.normalised().select("FactID", "ServiceCost", "Profit", margin)


# --- rejects and validation --------------------------------------------------------------------------------------

def reject_doctors(wh: Warehouse) -> DataFrame:
    """Doctors delivered with every ninth name blank and every eleventh without its ID."""
    key = F.col("DoctorID")
    return rejects.doctors(wh.raw("doctors").select(
        F.when(key % 11 != 0, key).alias("DoctorID"),
        F.when(key % 9 == 0, "  ").otherwise(F.col("FullName")).alias("FullName"),
        "Specialty",
    ))


def reject_all(wh: Warehouse) -> DataFrame:
    return rejects.all_rejects({name: wh.raw(name) for name in STAGING})


def dq_fk_missing(wh: Warehouse) -> DataFrame:
    return quality.missing_references(wh.unresolved())


def validate_fk(wh: Warehouse) -> DataFrame:
    """Keys in the visits that no loaded dimension has, of all five references."""
    return validate.orphans_of_all(wh.raw("visits"), {k: (wh.dimension(n), k) for n, (k, _, _) in fact.LOOKUPS.items()})


def _damaged_history(wh: Warehouse, name: str) -> DataFrame:
    """A versioned dimension after two batches, damaged: of every third ID the closed versions end a day late, of every
    fifth they are still current, and every seventh ID is there twice."""
    business_key, _, _ = dims.VERSIONED[name]
    key = F.col(business_key)
    state = dims.load_dimension(name, wh.dimension(name), _second_batch(wh, name), F.lit(SECOND_LOAD).cast("timestamp"), 2)
    late = F.when(~F.col("IsCurrent") & (key % 3 == 0), F.col("EffectiveTo") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("EffectiveTo"))
    changed = state.withColumns({"EffectiveTo": late, "IsCurrent": F.col("IsCurrent") | (key % 5 == 0)})
    return checkpointed(changed.unionByName(changed.filter(key % 7 == 0)))


def validate_unique_key(wh: Warehouse) -> DataFrame:
    """Every declared key of the warehouse as loaded, of the visits as delivered, and of damaged histories."""
    loaded = [("dw.FactVisit", wh.fact(), ["VisitKey"]), ("stg.FactVisits_Raw", wh.raw("visits"), ["FactID"])]
    loaded += [(f"dw.{n}", wh.dimension(n), [dims.surrogate_key(n)]) for n in dims.STAGED]
    loaded += [(f"dw.{n}", wh.dimension(n), [k]) for n, (k, _) in dims.OVERWRITTEN.items()]
    visits = wh.wide().count()
    for name, months, key in [("doctor", fact.doctor_months, "DoctorKey"), ("diagnosis", fact.diagnosis_months, "DiagnosisKey")]:
        keys = ["Year", "Month", key]
        loaded.append((f"dw.agg_{name}_month", checkpointed(months(validate.spread_by(wh.wide(), keys, visits)).select(*keys)), keys))
    histories = {n: _damaged_history(wh, n) for n in dims.VERSIONED}
    for name, (k, _, _) in dims.VERSIONED.items():
        loaded += [(f"dw.{name}", wh.dimension(name), [k, "EffectiveTo", "IsCurrent"]), (f"damaged {name}", histories[name], [k, "EffectiveTo", "IsCurrent"])]
    faults = [validate.version_faults(f"dw.{n}", wh.dimension(n), k, key) for n, (k, key, _) in dims.VERSIONED.items()]
    # A row that is there twice is a duplicate, not a version that overlaps with itself.
    once = {n: df.dropDuplicates([dims.surrogate_key(n)]) for n, df in histories.items()}
    faults += [validate.version_faults(f"damaged {n}", once[n], k, key) for n, (k, key, _) in dims.VERSIONED.items()]
    return reduce(DataFrame.unionByName, [validate.duplicates_of_all(loaded), *faults])


def _mandatory(wh: Warehouse) -> dict[str, tuple[DataFrame, list[str]]]:
    versioned = ["EffectiveFrom", "EffectiveTo", "IsCurrent"]
    return {
        "stg.vw_FactVisits_Normalized": (wh.normalised().drop("VisitKey"), STAGED_MEASURES),
        "dw.FactVisit": (wh.fact(), ["VisitKey", "FactID", *[k for _, k, _ in fact.LOOKUPS.values()], *[m for m in fact.MEASURES if m != "MarginPercent"], "LoadedAt"]),
        "dw.DimPatient": (wh.dimension("patient"), ["PatientKey", "PatientID", "FullName", *versioned]),
        "dw.DimDoctor": (wh.dimension("doctor"), ["DoctorKey", "DoctorID", "FullName", *versioned]),
        "dw.DimDiagnosis": (wh.dimension("diagnosis"), ["DiagnosisKey", "DiagnosisID", *versioned]),
        "dw.DimDate": (wh.dimension("date"), ["DateKey", "DateID", "IsWeekend"]),
        "dw.DimVisitType": (wh.dimension("visit_type"), ["VisitTypeKey", "VisitTypeID", "VisitName", "VisitCode"]),
    }


def validate_key_policy(wh: Warehouse) -> DataFrame:
    """All five dimensions delivered with every seventh member twice and every eleventh without its ID, against the
    visits."""
    delivered = {}
    for name, (key, _, _) in fact.LOOKUPS.items():
        raw = wh.raw(dims.STAGED[name]).select(key)
        twice = raw.unionByName(raw.filter(F.col(key) % 7 == 0))
        delivered[key] = twice.withColumn(key, F.when(F.col(key) % 11 != 0, F.col(key))), key
    return validate.key_policy(wh.raw("visits"), delivered)


# --- dimension and fact loads ------------------------------------------------------------------------------------

# The second batch: how each dimension's source differs from the first one.
def _second_batch(wh: Warehouse, name: str) -> DataFrame:
    raw = wh.raw(dims.STAGED[name])
    key = raw.columns[0]
    changed = {
        "patient": {"Age": F.when(F.col(key) % 10 == 0, F.col("Age") + 1).otherwise(F.col("Age"))},
        "doctor": {"Specialty": F.when(F.col(key) % 7 == 0, "Ortodont").otherwise(F.col("Specialty"))},
        "diagnosis": {
            "TreatmentMethod": F.when(F.col(key) % 9 == 0, F.concat("TreatmentMethod", F.lit("-2")))
            .otherwise(F.col("TreatmentMethod")),
        },
        "date": {"WeekDay": C.weekday_name(dims.full_date())},
        "visit_type": {"VisitName": F.concat("VisitName", F.lit(" visit"))},
    }[name]
    kept = raw.filter(F.col(key) % 11 != 0)
    highest = raw.agg(F.max(key)).first()[0]
    added = raw.filter(F.col(key) % 13 == 0).withColumn(key, (F.col(key) + highest).cast(raw.schema[key].dataType))
    return kept.withColumns(changed).unionByName(added)


def _second_state(wh: Warehouse, name: str) -> DataFrame:
    moment = F.lit(SECOND_LOAD).cast("timestamp")
    state = dims.load_dimension(name, wh.dimension(name), _second_batch(wh, name), moment, 2)
    if name in dims.VERSIONED:
        # Keys are arbitrary numbers; what they stand for is the order of an ID's versions.
        business_key, key, _ = dims.VERSIONED[name]
        version = F.row_number().over(Window.partitionBy(business_key).orderBy(key))
        state = state.withColumn("Version", version).drop(key)
    return _text_times(state)


def scd2_latest_version_lookup(wh: Warehouse) -> DataFrame:
    """Second batch of doctors beside the version each had before."""
    source = dims.source_rows("doctor", _second_batch(wh, "doctor")).select("DoctorID", F.col("Specialty").alias("NewSpecialty"))
    target = wh.dimension("doctor").select("DoctorKey", "DoctorID", "FullName", "Specialty", "IsCurrent")
    found = merge.latest_version(target, source, "DoctorID", "DoctorKey")
    return found.withColumn("Known", F.col("DoctorKey").isNotNull()).drop("DoctorKey")


def surrogate_key(wh: Warehouse) -> DataFrame:
    """Of every patient version, whether its key is its own, and positive unless it is the unknown member."""
    own = F.count(F.lit(1)).over(Window.partitionBy("PatientKey")) == 1
    positive = (F.col("PatientKey") > 0) | ((F.col("PatientKey") == 0) & (F.col("PatientID") == 0))
    return wh.dimension("patient").select("PatientID", own.alias("IsUnique"), positive.alias("IsPositive"))


def _by_business_id(wh: Warehouse, rows: DataFrame, spread: str | None = None) -> DataFrame:
    """Rows with the business IDs that their surrogate keys of versioned dimensions stand for."""
    for name, (business_key, key, _) in dims.VERSIONED.items():
        if key in rows.columns:
            members = wh.dimension(name).select(key, business_key)
            rows = (lookup(rows, members, key, spread) if spread else rows.join(members, key, "left")).drop(key)
    return rows


def fact_visit_load(wh: Warehouse) -> DataFrame:
    return _text_times(_by_business_id(wh, wh.fact(), "VisitKey").drop("VisitKey"))


def unknown_member(wh: Warehouse) -> DataFrame:
    """Visits standing on the unknown member of each dimension."""
    visits = wh.fact()
    keys = {name: key for name, (_, key, _) in fact.LOOKUPS.items()}
    counted = visits.agg(*[F.count_if(F.col(key) == 0).alias(name) for name, key in keys.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("Dimension"), F.col(n).alias("VisitRows")) for n in keys])
    return counted.select(F.inline(pairs))


def _second_files(wh: Warehouse) -> str:
    """The second delivery as files: changed dimensions, and visits without every seventh, every fifth at another cost."""
    base = f"{wh.root}/files_second"
    if base not in _exported:
        visits = wh.raw("visits").filter("FactID % 7 <> 0")
        cost = F.when(F.col("FactID") % 5 == 0, F.lit("100,5")).otherwise(F.col("ServiceCostText"))
        tables = {table: _second_batch(wh, name) for name, table in dims.STAGED.items()}
        sinks.export_staging(tables | {"visits": visits.withColumn("ServiceCostText", cost)}, base)
        _exported[base] = base
    return base


def _loader(wh: Warehouse, name: str, loads: Callable[[Loader], None]) -> Loader:
    """A warehouse folder of its own after ``loads``, which run once in a session."""
    with _loading:
        key = f"{wh.root}/{name}"
        if key not in _loaders:
            loader = Loader(wh.spark, f"{key}-{uuid4().hex[:8]}")
            loads(loader)
            _loaders[key] = loader
        return _loaders[key]


def _loaded_state(loader: Loader) -> DataFrame:
    """Rows and money of every table of a loaded warehouse, by batch and by whether a version is current, and the counts
    of the batches that succeeded."""
    read, money = loader.store.read, "decimal(28,2)"

    def part(name: str, df: DataFrame, batch: Column, current: Column, amount: Column) -> DataFrame:
        grouped = df.groupBy(F.lit(name).alias("ObjectName"), batch.cast("int").alias("BatchID"), current.cast("boolean").alias("IsCurrent"))
        return grouped.agg(F.count(F.lit(1)).alias("RowQty"), amount.cast(money).alias("Amount"))

    none, of_batch, nothing = F.lit(None), F.col("BatchID"), F.max(F.lit(None))
    parts = []
    for name in dims.STAGED:
        df = read(f"dim_{name}")
        parts.append(part(f"dim_{name}", df, F.col("SourceBatchID"), F.col("IsCurrent") if "IsCurrent" in df.columns else none, nothing))
    parts.append(part("fact_visit", loader.visits(), F.col("SourceBatchID"), none, F.sum("ServiceCost")))
    parts += [part(n, read(n), none, none, F.sum("RevenueAmount")) for n in ("agg_doctor_month", "agg_diagnosis_month")]
    parts += [part(n, read(n), of_batch, none, nothing) for n in ("rejected_rows", "data_quality_issue")]
    counted = F.array(*[F.struct(F.lit(c).alias("ObjectName"), F.col(c).alias("RowQty")) for c in ("RowsRead", "RowsLoaded", "RowsRejected")])
    batches = loader.batches().filter("Status = 'SUCCESS'").select("BatchID", F.inline(counted))
    parts.append(batches.select("ObjectName", "BatchID", none.cast("boolean").alias("IsCurrent"), "RowQty", none.cast(money).alias("Amount")))
    return reduce(DataFrame.unionByName, parts)


def full_load(wh: Warehouse) -> DataFrame:
    """Two deliveries, the second on top of the first: versions carried on, rejects and issues added, facts replaced."""
    def loads(loader: Loader) -> None:
        loader.full_load(_exported_files(wh), FIRST_LOAD)
        loader.full_load(_second_files(wh), SECOND_LOAD)

    return _loaded_state(_loader(wh, "full_load", loads))


def rebuild(wh: Warehouse) -> DataFrame:
    """Issues by rule after the warehouse was loaded with the second delivery, rebuilt from the first and checked."""
    def loads(loader: Loader) -> None:
        loader.full_load(_second_files(wh), FIRST_LOAD)
        loader.rebuild(_exported_files(wh), SECOND_LOAD)

    return quality.summary(_loader(wh, "rebuild", loads).store.read("data_quality_issue")).drop("LastIssueAt")


def _stopped(wh: Warehouse) -> Loader:
    """A warehouse whose rebuild from the second delivery stopped at the facts, at keys that were not found."""
    def loads(loader: Loader) -> None:
        loader.full_load(_exported_files(wh), FIRST_LOAD)
        try:
            loader.rebuild(_second_files(wh), SECOND_LOAD, on_orphans=STOP)
        except validate.KeyPolicyError:
            return
        raise AssertionError("the load didn't stop")

    return _loader(wh, "stopped", loads)


def audit_failed_batch(wh: Warehouse) -> DataFrame:
    """The batches around a failed load, with the error lines of their log."""
    loader = _stopped(wh)
    errors = loader.store.read("etl_log").filter("LogLevel = 'ERROR'").groupBy("BatchID").agg(
        F.count(F.lit(1)).alias("ErrorLines"), F.max("LogMessage").alias("ErrorMessage"))
    status = audit.batch_status(loader.batches()).join(errors, "BatchID", "left")
    return _text_times(status.withColumn("ErrorLines", F.coalesce("ErrorLines", F.lit(0).cast("long"))))


# --- cube --------------------------------------------------------------------------------------------------------

def cube_facts(wh: Warehouse) -> DataFrame:
    return fact.compat_visits(wh.wide(), with_units=True)


def null_keyed_facts(wh: Warehouse) -> DataFrame:
    """Visits by business ID, NULL where the dimension does not know the ID."""
    return cube_facts(wh).withColumns({c: F.nullif(c, F.lit(0)) for c in star_cube.DIMENSIONS})


# --- audit -------------------------------------------------------------------------------------------------------

def _keys(name: str) -> str:
    return (dims.VERSIONED | dims.OVERWRITTEN)[name][1]


def audit_batch_counts(wh: Warehouse) -> DataFrame:
    loaded = {n: audit.loaded_members(n, df, _keys(n)) for n, df in wh.dimensions().items()}
    return audit.batch_counts(
        audit.row_counts({name: wh.raw(name) for name in STAGING}),
        audit.row_counts(loaded | {"fact": wh.fact()}),
        audit.row_counts({"rejected": reject_all(wh)}),
    )


def _finished_batch(wh: Warehouse) -> DataFrame:
    counts = audit_batch_counts(wh).first()
    opened = audit.start_batch(wh.spark, 1, "Full load", FIRST_LOAD, "etl")
    return audit.finish_batch(
        opened, 1, audit.SUCCESS, FIRST_LOAD.replace(minute=5),
        counts["RowsRead"], counts["RowsLoaded"], counts["RowsRejected"], "Load complete",
    )


def audit_log(wh: Warehouse) -> DataFrame:
    rows = wh.fact().count()
    line = audit.log_line(wh.spark, 1, "load_fact_visit", "INFO", "Fact load", "Visits loaded", rows, FIRST_LOAD)
    return _text_times(line)


def describe_warehouse(wh: Warehouse) -> DataFrame:
    tables = {f"dim_{name}": df for name, df in wh.dimensions().items()}
    tables |= {"fact_visit": wh.fact()}
    tables |= {
        "agg_doctor_month": fact.doctor_months(wh.wide()), "agg_diagnosis_month": fact.diagnosis_months(wh.wide()),
    }
    return audit.row_counts(tables)


def measure_catalog(wh: Warehouse) -> DataFrame:
    """The measures on offer, with the total each has over all visits."""
    visits = wh.visits()
    summed = visits.agg(*[F.sum(name).cast("decimal(28,4)").alias(name) for name in L.MEASURES])
    listed = F.array(*[F.struct(F.lit(name).alias("MeasureName"), F.col(name).alias("Total")) for name in L.MEASURES])
    return audit.measure_catalog(wh.spark).join(F.broadcast(summed.select(F.inline(listed))), "MeasureName")


def dq_run_all(wh: Warehouse) -> DataFrame:
    return quality.run_all(wh.dimension("date"), wh.dimension("patient"), wh.fact())


def _registered_issues(wh: Warehouse) -> DataFrame:
    return quality.register(dq_run_all(wh), 1, wh.now)


OPERATORS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_read_csv": stg_read_csv,
    "stg_read_csv_codepage": stg_read_csv_codepage,
    "stg_malformed_lines": stg_malformed_lines,
    "stg_load_all": stg_load_all,
    "stg_lineage": stg_lineage,
    "stg_truncate": stg_truncate,
    "stg_visits_normalized": stg_visits_normalized,
    "stg_visits_strict": stg_visits_strict,
    "sink_clear_and_load": sink_clear_and_load,
    "param_upsert": param_upsert,
    "dim_patient_clean": lambda wh: dims.clean_patients(wh.raw("patients")),
    "age_band": age_band,
    "dim_patient_dedupe": dim_patient_dedupe,
    "dim_doctor_clean": lambda wh: dims.clean_doctors(wh.raw("doctors")),
    "dim_diagnosis_clean": lambda wh: dims.clean_diagnoses(wh.raw("diagnoses")),
    "dim_visit_type_clean": lambda wh: dims.clean_visit_types(wh.raw("visit_types")),
    "dim_date_build": lambda wh: dims.clean_dates(wh.raw("dates")),
    "academic_period": academic_period,
    "is_weekend": is_weekend,
    "margin_percent": margin_percent,
    "reject_patients": lambda wh: rejects.patients(wh.raw("patients")),
    "reject_doctors": reject_doctors,
    "reject_dates": lambda wh: rejects.dates(wh.raw("dates")),
    "reject_diagnoses": lambda wh: rejects.diagnoses(wh.raw("diagnoses")),
    "reject_visits": lambda wh: rejects.visits(wh.raw("visits")),
    "reject_all": reject_all,
    "dq_fk_missing": dq_fk_missing,
    "validate_unique_key": validate_unique_key,
    "validate_fk": validate_fk,
    "validate_not_null": lambda wh: validate.null_counts_of_all(_mandatory(wh)),
    "validate_key_policy": validate_key_policy,
    "validate_key_policy_in_load": lambda wh: _stopped(wh).store.read("key_error"),
    "scd2_patient": lambda wh: _second_state(wh, "patient"),
    "scd2_doctor": lambda wh: _second_state(wh, "doctor"),
    "scd2_diagnosis": lambda wh: _second_state(wh, "diagnosis"),
    "scd2_latest_version_lookup": scd2_latest_version_lookup,
    "scd1_date": lambda wh: _second_state(wh, "date"),
    "scd1_visit_type": lambda wh: _second_state(wh, "visit_type"),
    "surrogate_key": surrogate_key,
    "unknown_member": unknown_member,
    "fact_visit_load": fact_visit_load,
    "agg_doctor_month": lambda wh: _text_times(_by_business_id(wh, fact.doctor_months(wh.wide(), wh.members("doctor")))),
    "agg_diagnosis_month": lambda wh: _text_times(_by_business_id(wh, fact.diagnosis_months(wh.wide(), wh.members("diagnosis")))),
    "full_load": full_load,
    "rebuild": rebuild,
    "rebuild_stopped": lambda wh: _loaded_state(_stopped(wh)),
    "compat_patients": lambda wh: marts.compat_dimension("patient", wh.dimension("patient")),
    "compat_doctors": lambda wh: marts.compat_dimension("doctor", wh.dimension("doctor")),
    "compat_date": lambda wh: marts.compat_dimension("date", wh.dimension("date")),
    "compat_visit_type": lambda wh: marts.compat_dimension("visit_type", wh.dimension("visit_type")),
    "compat_diagnoses": lambda wh: marts.compat_dimension("diagnosis", wh.dimension("diagnosis")),
    "compat_fact": lambda wh: fact.compat_visits(wh.wide()),
    "mart_visit_detailed": lambda wh: wh.visits().drop("VisitKey"),
    "mart_doctor_performance": lambda wh: marts.doctor_performance(wh.visits(with_units=True), wh.members("doctor")),
    "mart_diagnosis_performance": lambda wh: marts.diagnosis_performance(wh.visits(with_units=True), wh.members("diagnosis")),
    "mart_patient_segment": lambda wh: marts.patient_segment(wh.visits(with_units=True), wh.members("patient")),
    "mart_time_series": lambda wh: marts.time_series(wh.visits(with_units=True)),
    "report_doctor_dashboard": lambda wh: reports.doctor_dashboard(wh.table("doctor_performance")),
    "report_doctor_dashboard_month": lambda wh: reports.doctor_dashboard(wh.table("doctor_performance"), 1997, 5),
    "report_diagnosis_dashboard_class": lambda wh: reports.diagnosis_dashboard(
        wh.table("diagnosis_performance"), "Porazheniya pulpy"
    ),
    "report_diagnosis_dashboard": lambda wh: reports.diagnosis_dashboard(wh.table("diagnosis_performance")),
    "report_patient_age": lambda wh: reports.patient_age(wh.table("patient_segment")),
    "cube_query": lambda wh: star_cube.cube_query(
        cube_facts(wh), ["DoctorID", "VisitTypeID"], ["Service Cost", "Profit", "Visit Count"], subtotals=True
    ),
    "cube_slice": lambda wh: star_cube.cube_query(
        cube_facts(wh), ["PatientID", "DiagnosisID"], ["Доход"], filters=F.col("VisitTypeID") == 2
    ),
    "cube_measures": lambda wh: star_cube.cube_query(cube_facts(wh), ["VisitTypeID"], list(star_cube.MEASURES)),
    "cube_unknown_member": lambda wh: star_cube.cube_query(
        null_keyed_facts(wh), ["DiagnosisID"], ["Visit Count", "Profit"]
    ),
    "cube_visits_by_diag_age": lambda wh: olap.totals(
        wh.visits(), ["DiagnosisID", "Age"], {"VisitCount": "VisitCount"}
    ),
    "cube_profit_by_doctor": lambda wh: star_cube.cube_query(cube_facts(wh), ["DoctorID"], ["Profit"]),
    "cube_visits_by_date": lambda wh: star_cube.cube_query(cube_facts(wh), ["DateID"], ["Visit Count"]),
    "cube_revenue_by_service": lambda wh: star_cube.cube_query(cube_facts(wh), ["VisitTypeID"], ["Service Cost"]),
    "measure_avg_treatment_cost": lambda wh: star_cube.average_treatment_cost(cube_facts(wh), ["DoctorID"]),
    "dq_date_weekday": lambda wh: quality.wrong_weekday(wh.dimension("date")),
    "dq_phone_duplicate": lambda wh: quality.shared_phone(wh.dimension("patient")),
    "dq_negative_margin": lambda wh: quality.fact_rule(wh.fact(), "NEGATIVE_MARGIN"),
    "dq_repeat_rate_range": lambda wh: quality.fact_rule(wh.fact(), "REPEAT_RATE_RANGE"),
    "dq_avg_check_gap": lambda wh: quality.fact_rule(wh.fact(), "AVG_CHECK_GAP"),
    "dq_run_all": dq_run_all,
    "dq_summary": lambda wh: _text_times(quality.summary(_registered_issues(wh))),
    "dq_close_issues": lambda wh: _text_times(
        quality.summary(quality.close_issues(_registered_issues(wh), "NEGATIVE_MARGIN"))
    ),
    "audit_batch_counts": audit_batch_counts,
    "audit_start_finish": lambda wh: _text_times(_finished_batch(wh)),
    "audit_log": audit_log,
    "audit_failed_batch": audit_failed_batch,
    "audit_batch_status": lambda wh: _text_times(audit.batch_status(_finished_batch(wh))),
    "describe_warehouse": describe_warehouse,
    "measure_catalog": measure_catalog,
}

STAGED_MEASURES = ["FactID", "DateID", "PatientID", "ServiceCost", "Profit", "RepeatRate", "AvgTreatmentCost"]


def _bound(operator: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(warehouse(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(operator) for name, operator in (OPERATORS | QUERIES).items()}
