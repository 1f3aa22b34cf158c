"""Names, codes and dates the results depend on. Kept as plain text, spellings included."""

# validity bounds
FIRST_DATE = "1900-01-01"
LAST_DATE = "2999-12-31"
OPEN_END = "2999-12-31 23:59:59"
HASH_ORIGIN = "1900-01-01 00:00:00"
HASH_MISSING_CREATE = "1901-01-01 00:00:00"

# phone mart: accepted sources and their score
MASTER_SOURCE = "MDMP"
CONTACT_SOURCES = ["MDMP", "RTLL", "RTLS", "CFTB", "WAYN"]
SOURCE_SCORE = {"MDMP": 5, "WAYN": 4, "RTLL": 3, "RTLS": 2, "CFTB": 1}
TYPE_SCORE = {
    "NotificPhone": 5,
    "ATMPhone": 4,
    "MobilePersonalPhone": 3,
    "MobileWorkNumber": 2,
    "HomePhone": 1,
}
INDIVIDUAL = "физическое лицо"
WEIGHT_NO_DUPLICATE = 100000000
WEIGHT_TRUST = 10000000
WEIGHT_QUALITY = 1000000
WEIGHT_SOURCE = 100000
WEIGHT_TYPE = 10000

# request warehouse
ACCEPTED = "accepted"
EXECUTED = "executed"
PAUSED = "paused"
COMPLITED = "complited"
CANSELLED = "canselled"
FINISHED = [COMPLITED, CANSELLED]
MEASURES = [
    "complited_per_day",
    "canselled_per_day",
    "accepted_per_day",
    "paused_per_day",
    "deleted_per_day",
    "executed_during_day",
    "paused_during_day",
]
CALENDAR_COLUMNS = [
    "date_key",
    "date_actual",
    "year",
    "quarter",
    "month",
    "week",
    "day_of_month",
    "day_of_week",
    "is_weekday",
    "is_holiday",
    "fiscal_year",
]
HOLIDAYS_2023 = [
    "2023-01-01",
    "2023-01-02",
    "2023-01-03",
    "2023-01-04",
    "2023-01-05",
    "2023-01-06",
    "2023-01-07",
    "2023-01-08",
    "2023-02-23",
    "2023-03-08",
    "2023-05-01",
    "2023-05-09",
    "2023-06-12",
    "2023-11-04",
]
MOVED_DAYS_OFF_2023 = ["2023-02-24", "2023-05-08"]

# account dictionary seeds
ACCOUNT_STATUSES = ["Закрыт", "Открыт", "Заблокирован", "Арестован", "Зарезервирован"]
COUNTERPARTY_TYPES = [("0", "Юридическое лицо"), ("1", "Физическое  лицо")]

# metadata snapshots: copied columns
DAG_CODE_COLUMNS = ["fileloc", "source_code"]
DAG_INFORMATION_COLUMNS = [
    "dag_id",
    "is_paused",
    "is_subdag",
    "is_active",
    "last_parsed_time",
    "last_pickled",
    "last_expired",
    "scheduler_lock",
    "pickle_id",
    "fileloc",
    "owners",
    "description",
    "default_view",
    "schedule_interval",
    "root_dag_id",
    "next_dagrun",
    "next_dagrun_create_after",
    "max_active_tasks",
    "has_task_concurrency_limits",
    "max_active_runs",
    "next_dagrun_data_interval_start",
    "next_dagrun_data_interval_end",
    "has_import_errors",
]
