"""The data model: 19 tables with their columns, keys, references and rules.

Spark does not enforce keys or checks, so they are kept here as data. Readers
take the schemas, the audit (`operators.quality`) takes the rules, and the purge
(`operators.purge`) takes the references.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The domains, rates and formats the business rules prescribe.
CLIENT_TYPES = ("PERSON", "ENTREPRENEUR", "LEGAL")
MARKUP = {"PERSON": 1.0, "ENTREPRENEUR": 1.1, "LEGAL": 1.3}
PAYMENT_TYPES = ("ADVANCE", "PAYMENT")
GENDERS = ("M", "F")
ADVANCE_AMOUNT = 15000
ADVANCE_DAY = 25
SALARY_DAY = 10
HOLIDAY_LAST_DAY_OF_JANUARY = 14
VALUE_ADDED_TAX = 0.2
YEARLY_INFLATION = 1.02
SURCHARGE_PER_QUARTER = 5
BIK_FORMAT = r"^04\d{7}$"
ACCOUNT_FORMAT = r"^\d{20}$"
PASSPORT_FORMAT = r"^\d{4} \d{6}$"
INN_PERSON_FORMAT = r"^\d{12}$"
INN_COMPANY_FORMAT = r"^\d{10}$"
OGRN_FORMAT = r"^\d{13}$"
OGRNIP_FORMAT = r"^\d{15}$"
OGRN_DIVISOR = 11
OGRNIP_DIVISOR = 13

CASCADE, SET_NULL, RESTRICT = "cascade", "set null", "restrict"

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_delete: str = RESTRICT


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    formats: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _schema(spec: str) -> T.StructType:
    """Build a schema from "name type, name type?" where ? marks nullable."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


def _fk(columns: str, parent: str, parent_columns: str, on_delete: str = RESTRICT) -> ForeignKey:
    return ForeignKey(tuple(columns.split()), parent, tuple(parent_columns.split()), on_delete)


def _check_digit(column: str, length: int, divisor: int) -> str:
    """SQL for: the last digit equals (leading digits) mod divisor mod 10."""
    base = f"try_cast(substring({column}, 1, {length - 1}) AS BIGINT)"
    last = f"try_cast(substring({column}, {length}, 1) AS BIGINT)"
    return f"pmod(pmod({base}, {divisor}), 10) = {last}"


_ASSIGNMENT = "assignment_agreement_no cooperation_agreement_no id_client"

# id_service is a long here so that a catalogue larger than an int can hold is safe.
_ALL = [
    Table(
        "client",
        _schema("id_client long, client_type string, created_at timestamp"),
        ("id_client",),
        domains={"client_type": CLIENT_TYPES},
    ),
    Table(
        "client_person",
        _schema("id_client long, fio string, passport_data string, inn string"),
        ("id_client",),
        unique=("passport_data", "inn"),
        foreign_keys=(_fk("id_client", "client", "id_client", CASCADE),),
        formats={
            "passport_format": f"passport_data RLIKE r'{PASSPORT_FORMAT}'",
            "inn_format": f"inn RLIKE r'{INN_PERSON_FORMAT}'",
        },
    ),
    Table(
        "client_entrepreneur",
        _schema("id_client long, fio string, inn string, ogrnip string?"),
        ("id_client",),
        unique=("inn", "ogrnip"),
        foreign_keys=(_fk("id_client", "client", "id_client", CASCADE),),
        formats={
            "inn_format": f"inn RLIKE r'{INN_PERSON_FORMAT}'",
            "ogrnip_format": f"ogrnip RLIKE r'{OGRNIP_FORMAT}'",
            "ogrnip_check_digit": _check_digit("ogrnip", 15, OGRNIP_DIVISOR),
        },
    ),
    Table(
        "client_legal",
        _schema("id_client long, company_name string, inn string, ogrn string?, representative string"),
        ("id_client",),
        unique=("inn", "ogrn"),
        foreign_keys=(_fk("id_client", "client", "id_client", CASCADE),),
        formats={
            "inn_format": f"inn RLIKE r'{INN_COMPANY_FORMAT}'",
            "ogrn_format": f"ogrn RLIKE r'{OGRN_FORMAT}'",
            "ogrn_check_digit": _check_digit("ogrn", 13, OGRN_DIVISOR),
        },
    ),
    Table(
        "bank",
        _schema("bik string, bank_name string, bank_legal_address string?, bank_cor_account string"),
        ("bik",),
        unique=("bank_cor_account",),
        checks={"bik_format": f"bik RLIKE r'{BIK_FORMAT}'"},
        formats={"bank_cor_account_format": f"bank_cor_account RLIKE r'{ACCOUNT_FORMAT}'"},
    ),
    Table(
        "bank_account",
        _schema("account_no string, bik string"),
        ("account_no", "bik"),
        foreign_keys=(_fk("bik", "bank", "bik", CASCADE),),
        formats={"account_format": f"account_no RLIKE r'{ACCOUNT_FORMAT}'"},
    ),
    Table(
        "job_position",
        _schema("id_job_position int, job_name string"),
        ("id_job_position",),
        unique=("job_name",),
    ),
    Table(
        "employee",
        _schema(
            "employee_number long, fio string, id_job_position int?, account_no string, bik string,"
            "birth_date date, hire_date date, fire_date date?, salary long, gender string"
        ),
        ("employee_number",),
        # The account reference asks for set-null, but its columns are required,
        # so a delete can only be refused: it is a restriction in effect.
        foreign_keys=(
            _fk("id_job_position", "job_position", "id_job_position", SET_NULL),
            _fk("account_no bik", "bank_account", "account_no bik", RESTRICT),
        ),
        checks={
            "salary_not_negative": "salary >= 0",
            "fired_after_hired": "fire_date IS NULL OR fire_date >= hire_date",
        },
        domains={"gender": GENDERS},
    ),
    Table(
        "price_list",
        _schema("creation_date date, nds double, extra_charge int, inflation_rate double"),
        ("creation_date",),
    ),
    Table(
        "service",
        _schema(
            "id_service long, name_service string, service_description string?, price long,"
            "required_documents string?"
        ),
        ("id_service",),
        unique=("name_service",),
        checks={"price_not_negative": "price >= 0"},
    ),
    Table(
        "price_list_service",
        _schema("id_service long, creation_date date, price long, client_type string"),
        ("id_service", "creation_date", "client_type"),
        foreign_keys=(
            _fk("id_service", "service", "id_service", CASCADE),
            _fk("creation_date", "price_list", "creation_date", CASCADE),
        ),
        checks={"price_not_negative": "price >= 0"},
        domains={"client_type": CLIENT_TYPES},
    ),
    Table(
        "cooperation_agreement",
        _schema(
            "id_client long, cooperation_agreement_no long, start_date date, end_date date?,"
            "manager_number long?, lawyer_number long?"
        ),
        ("id_client", "cooperation_agreement_no"),
        foreign_keys=(
            _fk("id_client", "client", "id_client"),
            _fk("manager_number", "employee", "employee_number"),
            _fk("lawyer_number", "employee", "employee_number"),
        ),
        checks={"ends_after_start": "end_date IS NULL OR end_date >= start_date"},
    ),
    Table(
        "assignment_agreement",
        _schema(
            "assignment_agreement_no long, cooperation_agreement_no long, id_client long,"
            "creation_price_list_date date?, created_at date, completion_date date?, deadline date,"
            "result boolean?"
        ),
        tuple(_ASSIGNMENT.split()),
        foreign_keys=(
            _fk("cooperation_agreement_no id_client", "cooperation_agreement",
                "cooperation_agreement_no id_client"),
            _fk("creation_price_list_date", "price_list", "creation_date"),
        ),
        checks={
            "completed_by_deadline": "completion_date IS NULL OR completion_date <= deadline",
            "completed_after_created": "completion_date IS NULL OR created_at <= completion_date",
        },
    ),
    Table(
        "contract_service",
        _schema(
            "id long, id_service long, assignment_agreement_no long, cooperation_agreement_no long,"
            "id_client long, price long"
        ),
        ("id",),
        foreign_keys=(
            _fk("id_service", "service", "id_service", CASCADE),
            _fk(_ASSIGNMENT, "assignment_agreement", _ASSIGNMENT, CASCADE),
        ),
    ),
    Table(
        "payment_bundle",
        _schema(
            "id_payment_bundle long, parent_cooperation_agreement_no long, id_client long,"
            "total_amount long, created_at date"
        ),
        ("id_payment_bundle",),
        foreign_keys=(
            _fk("parent_cooperation_agreement_no id_client", "cooperation_agreement",
                "cooperation_agreement_no id_client"),
        ),
        checks={"total_not_negative": "total_amount >= 0"},
    ),
    Table(
        "payment_document",
        _schema(
            "id_payment_document long, id_payment_bundle long?, assignment_agreement_no long,"
            "cooperation_agreement_no long, id_client long, amount long"
        ),
        ("id_payment_document",),
        foreign_keys=(
            _fk("id_payment_bundle", "payment_bundle", "id_payment_bundle", CASCADE),
            _fk(_ASSIGNMENT, "assignment_agreement", _ASSIGNMENT),
        ),
        checks={"amount_not_negative": "amount >= 0"},
    ),
    Table(
        "income_pay_document",
        _schema("id_income_pay_document long, account_no string, bik string, amount long, payment_date date"),
        ("id_income_pay_document",),
        foreign_keys=(_fk("account_no bik", "bank_account", "account_no bik"),),
        checks={"amount_not_negative": "amount >= 0"},
    ),
    Table(
        "income_payment_bundle",
        _schema("id_income_pay_document long, id_payment_bundle long"),
        ("id_income_pay_document",),
        unique=("id_payment_bundle",),
        foreign_keys=(
            _fk("id_income_pay_document", "income_pay_document", "id_income_pay_document", CASCADE),
            _fk("id_payment_bundle", "payment_bundle", "id_payment_bundle", CASCADE),
        ),
    ),
    Table(
        "outgoing_pay_document",
        _schema(
            "payment_date date, account_no string, bik string, employee_number long?, amount long,"
            "payment_type string, result boolean?"
        ),
        ("payment_date", "account_no", "bik"),
        foreign_keys=(
            _fk("account_no bik", "bank_account", "account_no bik", CASCADE),
            _fk("employee_number", "employee", "employee_number", SET_NULL),
        ),
        checks={"amount_not_negative": "amount >= 0"},
        domains={"payment_type": PAYMENT_TYPES},
    ),
]

TABLES: dict[str, Table] = {table.name: table for table in _ALL}

ASSIGNMENT_KEY = TABLES["assignment_agreement"].primary_key

# Tables that grow by date are stored in month folders, so a year's report, a payroll
# run's month check or a price list's reader reads only the folders it needs.
MONTH_PARTITIONS = {
    "income_pay_document": "payment_date",
    "outgoing_pay_document": "payment_date",
    "price_list_service": "creation_date",
}

# Columns by which such a table's months are stored apart, so that writing one kind's
# month again leaves the other kind's rows alone.
KIND_PARTITIONS = {"outgoing_pay_document": ("payment_type",)}
