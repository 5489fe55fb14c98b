"""Declared schemas of the staging files and of the warehouse tables."""

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """Nullable columns from "name type, name type"; unlike a DDL string this needs no running session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of each delimited file, in file order. IDs are bigint so that they outlive 2^31 members.
STAGING = {
    "patients": _schema("PatientID bigint, FullName string, Age int, Phone string"),
    "doctors": _schema("DoctorID bigint, FullName string, Specialty string"),
    "dates": _schema("DateID int, Day int, Month int, Year int, WeekDay string"),
    "visit_types": _schema("VisitTypeID int, VisitName string, VisitCode string"),
    "diagnoses": _schema("DiagnosisID bigint, ICDCode string, DiagnosisName string, TreatmentMethod string"),
    "visits": _schema(
        "FactID bigint, DateID int, PatientID bigint, DoctorID bigint, DiagnosisID bigint, VisitTypeID int, "
        "ServiceCostText string, VisitCount int, ProfitText string, PatientCount int, "
        "RepeatRateText string, AvgTreatmentCostText string"
    ),
}

# File name of each staging table under the base folder.
FILES = {
    "patients": "DimPatients.csv",
    "doctors": "DimDoctors.csv",
    "dates": "DimDate.csv",
    "visit_types": "DimVisitType.csv",
    "diagnoses": "DimDiagnoses.csv",
    "visits": "FactVisits.csv",
}

_VERSIONED = ", EffectiveFrom timestamp, EffectiveTo timestamp, IsCurrent boolean, SourceBatchID int"

DIMENSIONS = {
    "patient": _schema(
        "PatientKey bigint, PatientID bigint, FullName string, Age int, AgeBand string, "
        "Phone string, PhoneNormalized string" + _VERSIONED
    ),
    "doctor": _schema(
        "DoctorKey bigint, DoctorID bigint, FullName string, Specialty string, SpecialtyGroup string" + _VERSIONED
    ),
    "diagnosis": _schema(
        "DiagnosisKey bigint, DiagnosisID bigint, ICDCode string, DiagnosisName string, "
        "TreatmentMethod string, DiagnosisClass string" + _VERSIONED
    ),
    "date": _schema(
        "DateKey int, DateID int, FullDate date, Day int, Month int, Year int, QuarterNumber int, "
        "MonthName string, WeekDayName string, WeekOfYear int, IsWeekend boolean, AcademicPeriod string, "
        "SourceBatchID int"
    ),
    "visit_type": _schema(
        "VisitTypeKey int, VisitTypeID int, VisitName string, VisitCode string, VisitCategory string, "
        "SourceBatchID int"
    ),
}

BATCH = _schema(
    "BatchID int, BatchName string, SourceSystem string, StartedAt timestamp, FinishedAt timestamp, Status string, "
    "RowsRead bigint, RowsLoaded bigint, RowsRejected bigint, Initiator string, CommentText string"
)
LOG = _schema(
    "BatchID int, ProcedureName string, LogLevel string, StepName string, LogMessage string, "
    "AffectedRows bigint, CreatedAt timestamp"
)
ISSUE = _schema(
    "BatchID int, RuleCode string, EntityName string, EntityKey string, Severity string, "
    "IssueDescription string, RegisteredAt timestamp, IsResolved boolean"
)
REJECT = _schema(
    "SourceTable string, BusinessKey string, RejectionReason string, Payload string, "
    "BatchID int, RejectedAt timestamp"
)
KEY_ERROR = _schema("BatchID int, Reference string, ErrorType string, KeyValue string, KeyRows bigint")
PARAMETER = _schema("ParameterName string, ParameterValue string, ParameterDescription string, UpdatedAt timestamp")
