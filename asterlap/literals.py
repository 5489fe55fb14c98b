"""Business literals that results must carry verbatim."""

# Label for anything that could not be classified.
UNDEFINED = "Ne opredeleno"

# Age bands as (lowest age, highest age, label); None is open-ended.
AGE_BANDS = [
    (None, 17, "Do 18 let"),
    (18, 25, "18-25"),
    (26, 35, "26-35"),
    (36, 45, "36-45"),
    (46, 60, "46-60"),
    (61, None, "60+"),
]
AGE_LABELS = [label for _, _, label in AGE_BANDS] + [UNDEFINED]
MIN_AGE, MAX_AGE = 0, 120

# Specialty -> specialty group.
SPECIALTY_GROUPS = {
    "Terapevt": "Lechebnyy personal",
    "Khirurg": "Lechebnyy personal",
    "Ortoped": "Vosstanovitelnaya stomatologiya",
    "Ortodont": "Vosstanovitelnaya stomatologiya",
}
OTHER_GROUP = "Prochee"

# ICD-10 prefix -> diagnosis class.
DIAGNOSIS_CLASSES = {
    "K02": "Karioznye porazheniya",
    "K04": "Porazheniya pulpy",
    "K05": "Parodontologicheskie zabolevaniya",
    "K07": "Anomalii chelyustey",
    "K08": "Prochie izmeneniya zubochelyustnoy sistemy",
    "K11": "Zabolevaniya slizistoy i slyunnykh zhelez",
    "K12": "Zabolevaniya slizistoy i slyunnykh zhelez",
    "K13": "Zabolevaniya slizistoy i slyunnykh zhelez",
}
OTHER_DIAGNOSIS = "Prochie diagnozy"

# Visit code -> visit category.
PRIMARY = "Pervichnyy vizit"
REPEAT = "Povtornyy vizit"
OTHER_VISIT = "Inoy stsenariy"
VISIT_CATEGORIES = {"PR": PRIMARY, "PRI": PRIMARY, "SC": REPEAT, "SEC": REPEAT}

# Months (first, last) -> academic period.
PERIODS = [(9, 12, "Osen"), (1, 2, "Zima"), (3, 5, "Vesna"), (6, 8, "Leto")]
AUTUMN = "Osen"

# Weekday names, Monday first.
WEEKDAYS = ["ponedelnik", "vtornik", "sreda", "chetverg", "pyatnitsa", "subbota", "voskresene"]
WEEKEND, WORKDAY = "Vykhodnye", "Budni"

# Labels of the outlier bands, the ABC groups and the potential segments.
ABOVE, BELOW, NORMAL = "Vyshe normy", "Nizhe normy", "Norma"
ABC_LIMITS = [(80, "A"), (95, "B")]
ABC_REST = "C"
HIGH_POTENTIAL, STANDARD_PROFILE = "Vysokiy potentsial", "Standartnyy profil"

# Reasons written with rejected rows, by source table.
REJECT_REASONS = {
    "stg.DimPatients_Raw": "Nekorrektnye dannye patsienta",
    "stg.DimDoctors_Raw": "Otsutstvuyut klyuchevye atributy vracha",
    "stg.DimDate_Raw": "Nekorrektnaya kalendarnaya data",
    "stg.DimDiagnoses_Raw": "Ne ukazan diagnoz ili kod MKB",
    "stg.FactVisits_Raw": "Nevozmozhno preobrazovat chislovye pokazateli vizita",
}
MALFORMED_LINE = "Malformed line"

# Descriptions written with data-quality issues.
NEGATIVE_MARGIN_TEXT = "Marzhinalnost po vizitu otritsatelna, trebuetsya proverka sebestoimosti ili vyruchki."
REPEAT_RATE_TEXT = "Pokazatel RepeatRate nakhoditsya vne diapazona [0;1]."
AVG_CHECK_TEXT = "Srednyaya stoimost lecheniya zametno otlichaetsya ot ServiceCost, trebuetsya biznes-proverka."

# Measures offered to analysts.
MEASURES = {
    "ServiceCost": "Vyruchka po uslugam",
    "Profit": "Pribyl po vizitam",
    "VisitCount": "Kolichestvo vizitov",
    "PatientCount": "Kolichestvo patsientov",
    "RepeatRate": "Dolya povtornykh vizitov",
    "AvgTreatmentCost": "Srednyaya stoimost lecheniya",
    "MarginPercent": "Marzhinalnost vizita",
}

# Members standing in for an unresolved key (key 0, business ID 0).
UNKNOWN_PATIENT = {"PatientID": 0, "FullName": "Neizvestnyy patsient", "AgeBand": UNDEFINED}
UNKNOWN_DOCTOR = {
    "DoctorID": 0, "FullName": "Neizvestnyy vrach",
    "Specialty": UNDEFINED, "SpecialtyGroup": OTHER_GROUP,
}
UNKNOWN_DIAGNOSIS = {
    "DiagnosisID": 0, "ICDCode": "UNK", "DiagnosisName": "Neizvestnyy diagnoz",
    "TreatmentMethod": "Ne opredelen", "DiagnosisClass": "Prochee",
}
UNKNOWN_VISIT_TYPE = {
    "VisitTypeID": 0, "VisitName": "Neizvestnyy tip vizita", "VisitCode": "UNK", "VisitCategory": "Prochee",
}
UNKNOWN_DATE = {
    "DateID": 0, "MonthName": UNDEFINED, "WeekDayName": UNDEFINED,
    "IsWeekend": False, "AcademicPeriod": UNDEFINED,
}

# Validity bounds of a dimension row.
FIRST_MOMENT, LAST_MOMENT = "1900-01-01 00:00:00", "9999-12-31 00:00:00"

# Parameters of a load and what they are for. Fixed values.
PARAMETERS = {
    "BaseCsvPath": "Katalog s CSV-faylami dlya iskhodnoy zagruzki",
    "EnableVerboseLogging": "Flag podrobnogo protokolirovaniya ETL-protsessa",
}
