"""Silver table of employees: one row per person, employment and job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.json import strings, struct_of
from tidemark.functions.scalars import code_map, first_where, strip_zero_width
from tidemark.operators.nested import explode_parsed, explode_path, parse_object
from tidemark.operators.sinks import conform

# Silver column, type, how it is made, and from which level and member.
# p person, e employment, j job.
FIELDS = """
UserId int text e.userId
firstName string text p.firstName
lastName string text p.lastName
busEmail string email p.personNav.emailNav.results
empStatus string text j.emplStatusNav.externalCode
isContingentWorker string text e.isContingentWorker
createdDateTime timestamp tick p.createdDateTime
lastModifiedDateTime timestamp tick p.lastModifiedDateTime
startDate string day e.startDate
timeZone string text p.personNav.userAccountNav.timeZone
businessUnit string text j.businessUnit
jobInfoNavLastModifiedDateTime timestamp tick j.lastModifiedDateTime
endDate string day_or_never e.endDate
managerEmail string text j.managerUserNav.email
jobTitle string title j.jobTitle
positionTitle string title j.positionNav.externalName_en_US
location string text j.location
department string text j.department
locationNavLastModifiedDateTime timestamp tick j.locationNav.lastModifiedDateTime
locationNavName string text j.locationNav.name
jobCodeNavLastModifiedDateTime timestamp tick j.jobCodeNav.lastModifiedDateTime
jobCodeName string title j.jobCodeNav.name
departmentNavLastModifiedDateTime timestamp tick j.departmentNav.lastModifiedDateTime
departmentNavName string text j.departmentNav.name
companyNavLastModifiedDateTime timestamp tick j.companyNav.lastModifiedDateTime
companyNavName string text j.companyNav.name
employmentNavLastModifiedDateTime timestamp tick e.lastModifiedDateTime
terminationDate string day_or_never p.personNav.personEmpTerminationInfoNav.latestTerminationDate
costCenter string text j.costCenter
division string text j.division
employeeClass string class j.employeeClass
employeeId string text e.employmentId
LoadDateUTC timestamp load -
PersonIdExternal int text p.personIdExternal
"""

# Employee classes and the type of a business address.
CLASSES = {"1260": "P", "1261": "T", "1262": "N", "1264": "I", "1265": "B"}
BUSINESS_EMAIL = "2624"


def lines() -> list[list[str]]:
    return [line.split() for line in FIELDS.split("\n") if line]


def _members(level: str) -> list[tuple[str, str]]:
    return [
        (path[2:], f"array<{strings('emailAddress emailType')}>" if kind == "email" else "string")
        for _, _, kind, path in lines() if path.startswith(f"{level}.")
    ]


def page_schema() -> str:
    job = struct_of(_members("j"))
    employment = struct_of([*_members("e"), ("jobInfoNav.results", f"array<{job}>")])
    person = struct_of(
        [*_members("p"), ("personNav.employmentNav.results", f"array<{employment}>")]
    )
    return struct_of([("d.results", f"array<{person}>"), ("d.__next", "string")])


def _value(kind: str, path: str, legacy_sign: bool, load_ts: Column | None) -> Column:
    match kind:
        case "tick":
            return dates.tick_date(path, legacy_sign)
        case "day":
            return dates.iso_midnight(dates.millis_date(path, legacy_sign=legacy_sign))
        case "day_or_never":
            return dates.iso_or_never(dates.millis_date(path, legacy_sign=legacy_sign))
        case "title":
            return strip_zero_width(path)
        case "class":
            return code_map(path, CLASSES)
        case "email":
            return first_where(path, lambda x: x.emailType == BUSINESS_EMAIL, "emailAddress")
        case "load":
            return F.current_timestamp() if load_ts is None else load_ts
    return F.col(path)


def employees(
    pages: DataFrame, load_ts: Column | None = None, legacy_sign: bool = False
) -> DataFrame:
    """Persons without an employment and employments without a job have no row."""
    people = explode_parsed(parse_object(pages, "Raw_data", page_schema()), ["_parsed.d.results"], into="p")
    employed = explode_path(people, ["p.personNav.employmentNav.results"], ["p"], into="e")
    jobs = explode_path(employed, ["e.jobInfoNav.results"], ["p", "e"], into="j")
    flat = jobs.select(
        *[_value(kind, path, legacy_sign, load_ts).alias(name) for name, _, kind, path in lines()]
    )
    return conform(flat, ", ".join(f"{name} {kind}" for name, kind, _, _ in lines()))
