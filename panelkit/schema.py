"""Client-month snapshot schema, column groups and the product dimension.

The raw snapshot has 48 columns keyed by (``id``, ``fetch_date``): 24
demographic / account fields and 24 product flags with prefix ``ind_1m_``.
Everything is declared; nothing is inferred at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source column names and their English names, in file order.
# ---------------------------------------------------------------------------
SOURCE_TO_NAME = [
    ("fecha_dato", "fetch_date"),
    ("ncodpers", "id"),
    ("ind_empleado", "ind_employee"),
    ("pais_residencia", "country_of_residence"),
    ("sexo", "gender"),
    ("age", "age"),
    ("fecha_alta", "registration_date"),
    ("ind_nuevo", "ind_new_client"),
    ("antiguedad", "tenure_months"),
    ("indrel", "client_relationship_status"),
    ("ult_fec_cli_1t", "last_date_as_primary"),
    ("indrel_1mes", "client_type_1m"),
    ("tiprel_1mes", "client_activity_1m"),
    ("indresi", "ind_resident"),
    ("indext", "ind_foreigner"),
    ("conyuemp", "ind_spouse_employee"),
    ("canal_entrada", "entry_channel"),
    ("indfall", "ind_deceased"),
    ("tipodom", "address_type"),
    ("cod_prov", "province_code"),
    ("nomprov", "province_name"),
    ("ind_actividad_cliente", "ind_client_activity"),
    ("renta", "income"),
    ("segmento", "client_segment"),
    ("ind_ahor_fin_ult1", "ind_1m_savings_acc"),
    ("ind_aval_fin_ult1", "ind_1m_guarantee"),
    ("ind_cco_fin_ult1", "ind_1m_checking_acc"),
    ("ind_cder_fin_ult1", "ind_1m_derivatives"),
    ("ind_cno_fin_ult1", "ind_1m_payroll_acc"),
    ("ind_ctju_fin_ult1", "ind_1m_junior_acc"),
    ("ind_ctma_fin_ult1", "ind_1m_mature_acc_3"),
    ("ind_ctop_fin_ult1", "ind_1m_operations_acc"),
    ("ind_ctpp_fin_ult1", "ind_1m_pension_acc_2"),
    ("ind_deco_fin_ult1", "ind_1m_short_term_deposit"),
    ("ind_deme_fin_ult1", "ind_1m_medium_term_deposit"),
    ("ind_dela_fin_ult1", "ind_1m_long_term_deposit"),
    ("ind_ecue_fin_ult1", "ind_1m_digital_account"),
    ("ind_fond_fin_ult1", "ind_1m_cash_funds"),
    ("ind_hip_fin_ult1", "ind_1m_mortgage"),
    ("ind_plan_fin_ult1", "ind_1m_pension_plan"),
    ("ind_pres_fin_ult1", "ind_1m_loans"),
    ("ind_reca_fin_ult1", "ind_1m_tax_account"),
    ("ind_tjcr_fin_ult1", "ind_1m_credit_card"),
    ("ind_valo_fin_ult1", "ind_1m_securities"),
    ("ind_viv_fin_ult1", "ind_1m_home_acc"),
    ("ind_nomina_ult1", "ind_1m_salary_acc"),
    ("ind_nom_pens_ult1", "ind_1m_pension_obligation_account"),
    ("ind_recibo_ult1", "ind_1m_debit_account"),
]

# ---------------------------------------------------------------------------
# Product display names (Russian, English), in column order.
# ---------------------------------------------------------------------------
PRODUCT_NAMES = [
    ("ind_1m_savings_acc", "Сберегательный счёт", "Savings Account"),
    ("ind_1m_guarantee", "Банковская гарантия", "Bank Guarantee"),
    ("ind_1m_checking_acc", "Текущие счета", "Checking Account"),
    ("ind_1m_derivatives", "Деривативный счёт", "Derivatives Account"),
    ("ind_1m_payroll_acc", "Зарплатный проект", "Payroll Account"),
    ("ind_1m_junior_acc", "Детский счёт", "Junior Account"),
    ("ind_1m_mature_acc_3", "Особый счёт 3", "Special Account 3"),
    ("ind_1m_operations_acc", "Особый счёт", "Operations Account"),
    ("ind_1m_pension_acc_2", "Особый счёт 2", "Special Account 2"),
    ("ind_1m_short_term_deposit", "Краткосрочный депозит", "Short-Term Deposit"),
    ("ind_1m_medium_term_deposit", "Среднесрочный депозит", "Medium-Term Deposit"),
    ("ind_1m_long_term_deposit", "Долгосрочный депозит", "Long-Term Deposit"),
    ("ind_1m_digital_account", "Цифровой счёт", "Digital Account"),
    ("ind_1m_cash_funds", "Денежный средства", "Cash Funds"),
    ("ind_1m_mortgage", "Ипотека", "Mortgage"),
    ("ind_1m_pension_plan", "Пенсионный план", "Pension Plan"),
    ("ind_1m_loans", "Кредит", "Loans"),
    ("ind_1m_tax_account", "Налоговый счёт", "Tax Account"),
    ("ind_1m_credit_card", "Кредитная карта", "Credit Card"),
    ("ind_1m_securities", "Ценные бумаги", "Securities"),
    ("ind_1m_home_acc", "Домашний счёт", "Home Account"),
    ("ind_1m_salary_acc", "Аккаунт для выплаты зарплаты", "Salary Account"),
    ("ind_1m_pension_obligation_account", "Аккаунт для пенсионных обязательств",
     "Pension Obligation Account"),
    ("ind_1m_debit_account", "Дебетовый аккаунт", "Debit Account"),
]

# ---------------------------------------------------------------------------
# Column groups, code meanings, constants of the method.
# ---------------------------------------------------------------------------
PRODUCT_PREFIX = "ind_1m_"
TARGET_PREFIX = "target__"
STRING_COLUMNS = ["age", "tenure_months", "client_type_1m", "ind_spouse_employee"]
DATE_COLUMNS = ["fetch_date", "registration_date", "last_date_as_primary"]
NUMERICAL_COLUMNS = ["age", "tenure_months", "income", "fetch_year", "fetch_month",
                     "number_of_products"]
FREQ_ENCODE_COLUMNS = ["entry_channel", "province_code"]
ONE_HOT_COLUMNS = ["gender", "client_type_1m", "client_activity_1m", "ind_foreigner",
                   "client_segment"]
SEGMENT_CODES = [("01 - TOP", 1), ("02 - PARTICULARES", 2), ("03 - UNIVERSITARIO", 3)]
SEGMENT_NULL_CODE = 0
FILL_VALUES = {"province_code": 0, "gender": "V", "client_activity_1m": "N",
               "entry_channel": "UNK", "client_type_1m": 0}
INT_COLUMNS = ["age", "tenure_months", "ind_new_client", "client_relationship_status",
               "ind_client_activity", "province_code", "client_type_1m", "number_of_products"]
DROP_COLUMNS = ["fetch_date", "id", "ind_deceased", "ind_spouse_employee",
                "last_date_as_primary", "address_type", "ind_employee",
                "country_of_residence", "ind_resident", "province_name", "registration_date"]
CODE_MEANINGS = [
    ("ind_employee", "A", "employed"),
    ("ind_employee", "B", "unemployed, worked before"),
    ("ind_employee", "F", "dependent"),
    ("ind_employee", "N", "unemployed"),
    ("ind_employee", "P", "passive"),
    ("ind_new_client", "1", "registered in the last 6 months"),
    ("client_relationship_status", "1", "primary client"),
    ("client_relationship_status", "99", "primary during the month, not at its end"),
    ("client_type_1m", "1", "premium"),
    ("client_type_1m", "2", "owner"),
    ("client_type_1m", "P", "potential"),
    ("client_type_1m", "3", "former premium"),
    ("client_type_1m", "4", "former owner"),
    ("client_activity_1m", "A", "active"),
    ("client_activity_1m", "I", "inactive"),
    ("client_activity_1m", "P", "former"),
    ("client_activity_1m", "R", "potential"),
    ("ind_spouse_employee", "1", "spouse of an employee"),
    ("address_type", "1", "main address"),
    ("ind_client_activity", "1", "active"),
    ("ind_client_activity", "0", "inactive"),
    ("client_segment", "1", "VIP"),
    ("client_segment", "2", "individuals"),
    ("client_segment", "3", "college graduates"),
]
RANDOM_STATE = 42
NAN_THRESHOLD = 10
CLASS_WEIGHTS = (1.0, 4.0)
PROBA_THRESHOLD = 0.01
REFRESH_PERIOD_SECONDS = 10
TRAIN_TEST_SPLIT_DATE = "2016-02-28"
START_TRAIN_DATE = "2015-07-28"

_STRING = T.StringType()
_DOUBLE = T.DoubleType()
_DATE = T.DateType()
_TYPES = {
    "fetch_date": _DATE, "id": T.LongType(), "registration_date": _DATE,
    "last_date_as_primary": _DATE, "ind_new_client": _DOUBLE,
    "client_relationship_status": _DOUBLE, "address_type": _DOUBLE,
    "province_code": _DOUBLE, "ind_client_activity": _DOUBLE, "income": _DOUBLE,
}


def column_names() -> list[str]:
    return [new for _, new in SOURCE_TO_NAME]


def product_columns(columns, prefix: str = PRODUCT_PREFIX) -> list[str]:
    """Columns selected by name prefix, in schema order."""
    return [c for c in columns if c.startswith(prefix)]


def snapshot_schema(raw: bool = False) -> T.StructType:
    """48-field declared schema of the client-month snapshot.

    ``raw=True`` is the CSV read schema: product flags are read as DOUBLE
    because two of them are written as floats ("0.0"), which an INT field
    would turn into NULL; ``cast_products`` makes them INT afterwards.
    """
    fields = []
    for name in column_names():
        if name.startswith(PRODUCT_PREFIX):
            dtype = T.DoubleType() if raw else T.IntegerType()
        else:
            dtype = _TYPES.get(name, _STRING)
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def cast_products(df: DataFrame, prefix: str = PRODUCT_PREFIX) -> DataFrame:
    """Product flags to INT after a raw read (NULL stays NULL)."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(c).cast("int").alias(c) if c.startswith(prefix) else F.col(c)
                       for c in df.columns])


def product_dim(spark: SparkSession, rows=None) -> DataFrame:
    """Product dimension (column, name_ru, name_en); 24 rows by default."""
    rows = rows if rows is not None else PRODUCT_NAMES
    return spark.createDataFrame(
        list(rows), "column string, name_ru string, name_en string")


def code_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CODE_MEANINGS, "column string, code string, meaning string")
