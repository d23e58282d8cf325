"""Fixed values of the reporting domain: types, keys, columns, schemas, limits."""

# Value types and the way their text is read.
INTEGER_TYPES = ["INTEGER", "INTEGER_POSITIVE", "INTEGER_ZERO_OR_POSITIVE"]
FLOAT_TYPES = ["NUMBER", "PERCENTAGE"]
BOOLEAN_TYPES = ["BOOLEAN", "TRUE_ONLY"]

# Hierarchy levels from the top of the path downwards.
HIERARCHY_LEVELS = ["country", "region", "district", "facility"]

# Business key of a reported value, fact partitioning, deadline.
BUSINESS_KEY = ["dataelement", "period", "orgunit", "categoryoptioncombo"]
FACT_PARTITION = "year_month"
LATE_REPORTING_DAYS = 60

# Limits of the run gate.
MAX_QUARANTINE_RATE = 0.25
MAX_UNRESOLVED_RATE = 0.15
MIN_FACT_ROWS = 1

# Attributes a reported value takes from its data element
# (new name: lookup column).
DATA_ELEMENT_ATTRIBUTES = {
    "data_element_name": "name",
    "shortname": "shortname",
    "code": "code",
    "value_type": "valuetype",
    "domaintype": "domaintype",
    "aggregationtype": "aggregationtype",
    "zeroissignificant": "zeroissignificant",
    "categorycombo": "categorycombo",
    "dataelementgroups": "dataelementgroups",
}
CATEGORY_COMBO_ATTRIBUTES = {"category_option_combo_name": "name"}

# Raw columns of a reported value after name standardisation.
DATA_VALUE_COLUMNS = [
    "dataelement", "period", "orgunit", "categoryoptioncombo",
    "attributeoptioncombo", "value", "storedby", "created", "lastupdated",
    "followup",
]
PERIOD_COLUMNS = [
    "year_month", "period_start_date", "period_end_date", "year", "month",
    "quarter",
]

# Columns kept for quality work; they define "identical row".
QUALITY_COLUMNS = DATA_VALUE_COLUMNS + PERIOD_COLUMNS + [
    "data_element_name", "category_option_combo_name", "country_name",
    "region_name", "district_name", "facility_name", "value_type",
]

# Fact columns in order, before load_timestamp
# (clean column: fact column).
FACT_COLUMNS = {
    "dataelement": "data_element_id",
    "orgunit": "org_unit_id",
    "categoryoptioncombo": "category_option_combo_id",
    "year_month": "year_month",
    "period_start_date": "period_start_date",
    "period_end_date": "period_end_date",
    "year": "year",
    "month": "month",
    "quarter": "quarter",
    "data_element_name": "data_element_name",
    "category_option_combo_name": "category_option_combo_name",
    "country_name": "country_name",
    "region_name": "region_name",
    "district_name": "district_name",
    "facility_name": "facility_name",
    "value": "value",
    "numeric_value": "numeric_value",
    "boolean_value": "boolean_value",
    "value_type": "value_type",
    "is_null_value": "is_null_value",
    "is_blank_value": "is_blank_value",
    "is_zero_value": "is_zero_value",
    "has_reported_value": "has_reported_value",
    "has_valid_numeric_value": "has_valid_numeric_value",
    "is_late_submission": "is_late_submission",
    "created": "created",
    "lastupdated": "lastupdated",
}

# Dimension columns (source column: dimension column).
DIM_DATA_ELEMENT = {
    "id": "data_element_id", "name": "data_element_name",
    "shortname": "shortname", "code": "code", "valuetype": "valuetype",
    "aggregationtype": "aggregationtype", "domaintype": "domaintype",
    "created": "created", "lastupdated": "lastupdated",
}
DIM_ORG_UNIT = {
    "id": "org_unit_id", "name": "org_unit_name", "shortname": "shortname",
    "code": "code", "level": "level", "country_name": "country_name",
    "region_name": "region_name", "district_name": "district_name",
    "facility_name": "facility_name", "created": "created",
    "lastupdated": "lastupdated",
}
DIM_PROGRAM = {
    "id": "program_id", "name": "program_name", "shortname": "shortname",
    "healtharea": "healtharea", "country": "country",
    "reportingfrequency": "reportingfrequency", "created": "created",
    "lastupdated": "lastupdated",
}

# Document schemas as Spark DDL.
METADATA_SCHEMA = """
    date string, version string,
    dataElements array<struct<
        id: string, name: string, shortName: string, code: string,
        valueType: string, domainType: string, aggregationType: string,
        zeroIsSignificant: boolean,
        categoryCombo: struct<id: string, name: string>,
        dataElementGroups: array<struct<id: string, name: string>>,
        created: string, lastUpdated: string>>,
    categoryOptionCombos array<struct<
        id: string, name: string, created: string, lastUpdated: string>>
"""
ORG_UNITS_SCHEMA = """
    date string, version string,
    organisationUnits array<struct<
        id: string, name: string, shortName: string, code: string,
        level: int, path: string, parent: struct<id: string, name: string>,
        groups: array<struct<id: string, name: string>>,
        created: string, lastUpdated: string>>
"""
PROGRAMS_SCHEMA = """
    date string, version string,
    programs array<struct<
        id: string, name: string, shortName: string, healthArea: string,
        country: string, reportingFrequency: string,
        dataElements: array<string>, created: string, lastUpdated: string>>
"""
DATA_VALUES_SCHEMA = """
    responseType string, version string, exportDate string,
    dataValues array<struct<
        dataElement: string, period: string, orgUnit: string,
        categoryOptionCombo: string, attributeOptionCombo: string,
        value: string, storedBy: string, created: string,
        lastUpdated: string, followup: string>>
"""

# Contract of the published fact table.
FACT_CONTRACT = {
    "table_name": "fact_service_delivery",
    "primary_grain": [
        "data_element_id", "org_unit_id", "category_option_combo_id",
        "year_month",
    ],
    "columns": [
        {"name": "data_element_id", "type": "string", "nullable": False},
        {"name": "org_unit_id", "type": "string", "nullable": False},
        {"name": "category_option_combo_id", "type": "string", "nullable": False},
        {"name": "year_month", "type": "string", "nullable": False},
        {"name": "data_element_name", "type": "string", "nullable": False},
        {"name": "country_name", "type": "string", "nullable": False},
        {"name": "facility_name", "type": "string", "nullable": False},
        {"name": "numeric_value", "type": "double", "nullable": True,
         "min_value": 0, "max_value": 1000000},
        {"name": "boolean_value", "type": "boolean", "nullable": True},
        {"name": "value_type", "type": "string", "nullable": False},
        {"name": "is_late_submission", "type": "boolean", "nullable": False},
        {"name": "has_reported_value", "type": "boolean", "nullable": False},
        {"name": "load_timestamp", "type": "timestamp", "nullable": False},
    ],
}
