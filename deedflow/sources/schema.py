"""The brokerage tables as data: columns, keys, domains, checks and references."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cache

from pyspark.sql import types as T

SET_NULL = "set null"
RESTRICT = "restrict"

# The members of the enumerated columns.
PROPERTY_TYPES = (
    "House",
    "Apartment",
    "Condominium",
    "Townhouse",
    "Duplex",
    "Triplex",
    "Quadplex",
    "Villa",
    "Cottage",
    "Mobile Home",
    "Commercial Property",
    "Land/Plot",
    "Industrial Property",
    "Farm/Ranch",
)
STATUSES = ("Sold", "On Hold", "For Sale")
EXCLUSIVITY = ("Yes", "No")
APPOINTMENT_TYPES = ("Viewing", "Meeting", "")
OUTCOMES = ("Y", "N", "Waiting")


@dataclass(frozen=True)
class Field:
    """One column; ``digits`` bounds an integer, ``length`` a string."""

    name: str
    type: T.DataType
    required: bool = False
    digits: int | None = None
    length: int | None = None
    domain: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Reference:
    """A foreign key and what a delete in the parent does to it.

    A key that is set to NULL on delete also follows key changes of its parent.
    """

    column: str
    parent: str
    on_delete: str = SET_NULL


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: str
    unique: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    checks: tuple[tuple[str, str], ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, True) for f in self.fields])


def _id(name: str, digits: int = 6, required: bool = False) -> Field:
    return Field(name, T.IntegerType(), required=required, digits=digits)


def _text(name: str, length: int | None = None, required: bool = False) -> Field:
    return Field(name, T.StringType(), required=required, length=length)


def _choice(name: str, domain: tuple[str, ...], required: bool = False) -> Field:
    return Field(name, T.StringType(), required=required, domain=domain)


def _number(name: str, precision: int, scale: int = 0, required: bool = False) -> Field:
    return Field(name, T.DecimalType(precision, scale), required=required)


def _day(name: str, required: bool = False) -> Field:
    return Field(name, T.DateType(), required=required)


# In loading order: every table after the tables it refers to.
TABLES: dict[str, Table] = {
    table.name: table
    for table in (
        Table(
            "companies",
            (
                _id("company_ID", required=True),
                _text("comp_name", 90, required=True),
                _text("city", 90, required=True),
            ),
            key="company_ID",
        ),
        Table(
            "owners",
            (
                _id("owner_ID", required=True),
                _text("first_name", 30, required=True),
                _text("last_name", 30, required=True),
                _text("contact", 16, required=True),
            ),
            key="owner_ID",
            unique=("contact",),
        ),
        Table(
            "properties",
            (
                _id("property_ID", required=True),
                _id("owner_ID"),
                _choice("property_TYPE", PROPERTY_TYPES, required=True),
                _choice("prop_status", STATUSES, required=True),
                _text("city", 30, required=True),
                _number("size", 6, required=True),
                _number("listing_price", 11, required=True),
            ),
            key="property_ID",
            references=(Reference("owner_ID", "owners"),),
            checks=(("positive_size_and_price", "size > 0 AND listing_price > 0"),),
        ),
        Table(
            "contracts_owner",
            (
                _id("contract_ID", required=True),
                _id("property_ID"),
                _id("company_ID"),
                _day("date_contract", required=True),
                _choice("exclusivity", EXCLUSIVITY),
                _text("aditional_terms", 200),
            ),
            key="contract_ID",
            references=(
                Reference("company_ID", "companies"),
                Reference("property_ID", "properties"),
            ),
        ),
        Table(
            "agents",
            (
                _id("agent_ID", required=True),
                _id("company_ID"),
                _text("first_name_agent", 20, required=True),
                _text("last_name_agent", 20, required=True),
                _text("contact", 18, required=True),
                _number("comission_rate", 2, 1),
            ),
            key="agent_ID",
            unique=("contact",),
            references=(Reference("company_ID", "companies"),),
            checks=(("positive_rate", "comission_rate > 0"),),
        ),
        Table(
            "clients",
            (
                _id("client_ID", required=True),
                _text("first_name", 20, required=True),
                _text("last_name", 20, required=True),
                _text("contact", 16, required=True),
                _text("email", 60),
                _choice("preferred_property_type", PROPERTY_TYPES),
            ),
            key="client_ID",
            unique=("contact",),
        ),
        Table(
            "appointments",
            (
                _id("appointment_ID", required=True),
                _id("agent_ID"),
                _id("client_ID"),
                _id("property_ID"),
                _day("date_appointment", required=True),
                _choice("type_appointment", APPOINTMENT_TYPES, required=True),
            ),
            key="appointment_ID",
            references=(
                Reference("agent_ID", "agents"),
                Reference("client_ID", "clients"),
                Reference("property_ID", "properties"),
            ),
        ),
        Table(
            "transactions",
            (
                _id("transaction_ID", required=True),
                _id("property_ID"),
                _id("client_ID"),
                _id("agent_ID"),
                _number("review_process", 2, 1),
                _day("date_transaction", required=True),
                _text("terms_contract"),
            ),
            key="transaction_ID",
            references=(
                Reference("property_ID", "properties"),
                Reference("client_ID", "clients"),
                Reference("agent_ID", "agents"),
            ),
        ),
        Table(
            "visits",
            (
                _id("visit_ID", required=True),
                _id("appointment_id"),
                _choice("outcome", OUTCOMES, required=True),
            ),
            key="visit_ID",
            references=(Reference("appointment_id", "appointments", RESTRICT),),
        ),
        Table(
            "reviews",
            (
                _id("review_ID", digits=5, required=True),
                _id("property_ID"),
                _id("client_ID"),
                _number("rating_property", 2, 1),
                _text("review_comment"),
                _day("date_review", required=True),
            ),
            key="review_ID",
            references=(
                Reference("property_ID", "properties"),
                Reference("client_ID", "clients"),
            ),
        ),
        Table(
            "log_transactions",
            (
                Field("log_ID", T.LongType(), required=True),
                _day("event_date"),
                _id("transaction_id"),
                _text("event_type", 50),
                _text("details", 100),
            ),
            key="log_ID",
            references=(Reference("transaction_id", "transactions", RESTRICT),),
        ),
    )
}

# Ids have so many digits as declared.
ID_DIGITS = 6


@cache
def tables_with(id_digits: int = ID_DIGITS) -> dict[str, Table]:
    """The tables with wider ids; an id declared with fewer digits than others keeps its distance to them."""
    if not ID_DIGITS <= id_digits <= 18:
        raise ValueError(f"ids have {ID_DIGITS} to 18 digits, not {id_digits}")

    def widened(field: Field) -> Field:
        if field.digits is None or id_digits == ID_DIGITS:
            return field
        digits = field.digits + id_digits - ID_DIGITS
        return replace(field, digits=digits, type=T.LongType() if digits > 9 else field.type)

    return {name: replace(t, fields=tuple(map(widened, t.fields))) for name, t in TABLES.items()}


LOAD_ORDER = [name for name in TABLES if name != "log_transactions"]


def children_of(parent: str) -> list[tuple[Table, Reference]]:
    return [(t, r) for t in TABLES.values() for r in t.references if r.parent == parent]


def clear_order() -> list[str]:
    """Children before their parents."""
    return list(reversed(TABLES))
