"""SQL counterparts of the registered queries, over the given tables."""

# ---- inputs, as in fixtures.py

INPUTS = {
    "fx_data_element": """
        select p_type as id, concat('Indicator ', p_type) as name,
            case p_type when 'STANDARD' then 'INTEGER_POSITIVE'
                when 'SMALL' then 'INTEGER_ZERO_OR_POSITIVE' when 'PROMO' then 'NUMBER'
                when 'ECONOMY' then 'PERCENTAGE' when 'MEDIUM' then 'BOOLEAN'
                else 'TEXT' end as valuetype
        from (select distinct p_type from part)""",
    "fx_registry_newest": """
        select concat('P', p_partkey) as id, p_name as name, p_brand as shortname,
            concat(p_brand, '-', p_partkey) as code, valuetype, 'AGGREGATE' as domaintype,
            case when p_type = 'ECONOMY' then 'AVERAGE' else 'SUM' end as aggregationtype,
            p_size > 25 as zeroissignificant, '2024-01-01 00:00:00' as created,
            '2024-02-01 08:30:00' as lastupdated, p_size
        from part join fx_data_element e on p_type = e.id""",
    "fx_registry": """
        select * exclude (p_size) from fx_registry_newest
        union all
        select * exclude (p_size) replace (concat('old ', name) as name,
            '2024-01-15 00:00:00' as lastupdated)
        from fx_registry_newest where p_size <= 5""",
    "fx_coc": """
        select distinct concat(l_returnflag, l_linestatus) as id,
            concat('Combo ', l_returnflag, l_linestatus) as name
        from lineitem""",
    "fx_unit_base": """
        select concat('R', r_regionkey) as id, r_name as name, 1 as level,
            concat('/R', r_regionkey) as path
        from region
        union all
        select concat('N', n_nationkey), n_name, 2, concat('/R', n_regionkey, '/N', n_nationkey)
        from nation
        union all
        select distinct concat('S', n_nationkey, c_mktsegment),
            concat(c_mktsegment, ' of ', n_name), 3,
            concat('/R', n_regionkey, '/N', n_nationkey, '/S', n_nationkey, c_mktsegment)
        from customer join nation on c_nationkey = n_nationkey
        union all
        select concat('C', c_custkey), c_name, 4,
            concat('/R', n_regionkey, '/N', n_nationkey, '/S', n_nationkey, c_mktsegment,
                '/C', c_custkey)
        from customer join nation on c_nationkey = n_nationkey
        where c_acctbal >= -500""",
    "fx_org_unit": """
        select id, name, concat('short ', name) as shortname, concat('code ', id) as code,
            cast(level as integer) as level, path, '2023-06-01 00:00:00' as created,
            '2023-07-01 12:00:00' as lastupdated
        from fx_unit_base""",
    "fx_levels": """
        select *, nullif(split_part(path, '/', 2), '') as country_uid,
            nullif(split_part(path, '/', 3), '') as region_uid,
            nullif(split_part(path, '/', 4), '') as district_uid,
            coalesce(nullif(split_part(path, '/', 5), ''), id) as facility_uid
        from fx_org_unit""",
    "fx_hierarchy": """
        select u.*, c.name as country_name, r.name as region_name, d.name as district_name,
            f.name as facility_name
        from fx_levels u
        left join fx_org_unit c on u.country_uid = c.id
        left join fx_org_unit r on u.region_uid = r.id
        left join fx_org_unit d on u.district_uid = d.id
        left join fx_org_unit f on u.facility_uid = f.id""",
    "fx_program": """
        select distinct concat('PR', n_nationkey, c_mktsegment) as id,
            concat(c_mktsegment, ' program ', n_name) as name, c_mktsegment as shortname,
            c_mktsegment as healtharea, n_name as country, 'MONTHLY' as reportingfrequency,
            'ECONOMY,PROMO,STANDARD' as dataelements, '2023-01-01 00:00:00' as created,
            '2023-02-01 00:00:00' as lastupdated
        from customer join nation on c_nationkey = n_nationkey""",
    "fx_sent": """
        select case when p_size = 50 then 'GHOST_DE' else p_type end as dataelement,
            strftime(o_orderdate, '%Y%m') as period, concat('C', o_custkey) as orgunit,
            case when l_tax > 0.075 then 'GHOST_COC'
                else concat(l_returnflag, l_linestatus) end as categoryoptioncombo,
            concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)
                as attributeoptioncombo,
            case when l_discount > 0.095 then null when l_tax < 0.005 then '0'
                when l_quantity = 13 then ''
                when p_type = 'MEDIUM'
                    then case when l_quantity <= 25 then 'true' else 'false' end
                when p_type in ('PROMO', 'ECONOMY')
                    then cast(cast(l_extendedprice as decimal(15, 2)) as varchar)
                else cast(cast(l_quantity as integer) as varchar) end as value,
            concat('clerk', l_suppkey) as storedby, o_orderdate as created,
            l_shipdate as lastupdated, 'false' as followup, l_discount < 0.005 as resent
        from lineitem join orders on l_orderkey = o_orderkey
        join part on l_partkey = p_partkey""",
    "fx_value": """
        select * exclude (resent) from fx_sent
        union all
        select * exclude (resent) from fx_sent where resent""",
    "fx_dated": """
        select *, period as year_month, start_date as period_start_date,
            last_day(start_date) as period_end_date,
            cast(year(start_date) as integer) as year,
            cast(month(start_date) as integer) as month,
            cast(quarter(start_date) as integer) as quarter
        from (select *, cast(strptime(concat(period, '01'), '%Y%m%d') as date) as start_date
            from fx_value)""",
    "fx_known": """
        select v.* exclude (start_date), e.name as data_element_name, e.valuetype as value_type,
            c.name as category_option_combo_name, h.country_name, h.region_name,
            h.district_name, h.facility_name
        from fx_dated v
        left join fx_data_element e on v.dataelement = e.id
        left join fx_coc c on v.categoryoptioncombo = c.id
        left join fx_hierarchy h on v.orgunit = h.id""",
    "fx_reasoned": """
        select *, case when data_element_name is null then 'unresolved_data_elements'
            when category_option_combo_name is null then 'unresolved_category_option_combos'
            when facility_name is null then 'unresolved_org_units' end as reason
        from fx_known""",
    "fx_ranked": """
        select *, row_number() over (
            partition by dataelement, period, orgunit, categoryoptioncombo
            order by lastupdated desc nulls last, created desc nulls last,
                value desc nulls last, attributeoptioncombo desc, storedby desc) as latest_rank
        from (select distinct * exclude (reason) from fx_reasoned where reason is null)""",
    "fx_number": """
        select *, case when value_type in ('INTEGER_POSITIVE', 'INTEGER_ZERO_OR_POSITIVE')
                then cast(try_cast(value as integer) as double)
            when value_type in ('NUMBER', 'PERCENTAGE') then try_cast(value as double)
            end as numeric_value,
            case when value_type = 'BOOLEAN' and value in ('true', 'false')
                then value = 'true'
                when value_type = 'BOOLEAN' and value = '0' then false end as boolean_value
        from fx_ranked where latest_rank = 1""",
    "fx_clean": """
        select *, value is null as is_null_value, value = '' as is_blank_value,
            value = '0' as is_zero_value, value is not null as has_reported_value,
            numeric_value is not null as has_valid_numeric_value,
            cast(period_end_date + interval 60 day as date) as reporting_deadline,
            lastupdated > period_end_date + interval 60 day as is_late_submission
        from fx_number""",
    "fx_fact": """
        select dataelement as data_element_id, orgunit as org_unit_id,
            categoryoptioncombo as category_option_combo_id, year_month,
            cast(period_start_date as varchar) as period_start_date,
            cast(period_end_date as varchar) as period_end_date, year, month, quarter,
            data_element_name, category_option_combo_name, country_name, region_name,
            district_name, facility_name, value, numeric_value, boolean_value, value_type,
            is_null_value, is_blank_value, is_zero_value, has_reported_value,
            has_valid_numeric_value, is_late_submission, cast(created as varchar) as created,
            cast(lastupdated as varchar) as lastupdated
        from fx_clean""",
    "fx_silenced": """
        select * replace (has_reported_value
            and not (country_name = 'AFRICA' and quarter <= 2) as has_reported_value)
        from fx_fact""",
    "fx_outcome": """
        select reason as outcome, count(*) as row_count from fx_reasoned
        where reason is not null group by reason
        union all
        select case when latest_rank = 1 then 'clean' else 'superseded_records' end, count(*)
        from fx_ranked group by 1
        union all
        select 'exact_duplicates', (select count(*) from fx_reasoned where reason is null)
            - (select count(*) from fx_ranked)""",
    "fx_monthly": """
        select country_name, data_element_name, year_month, sum(numeric_value) as monthly_total,
            cast(left(year_month, 4) as integer) * 12
                + cast(right(year_month, 2) as integer) as month_number
        from fx_fact group by all""",
    "fx_mixed": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey,
            case l_linenumber when 1 then cast(cast(l_quantity as integer) as varchar)
                when 2 then concat(' ', cast(l_quantity as integer), ' ')
                when 3 then concat('-', cast(l_quantity as integer), '.7')
                when 4 then concat('n', cast(l_quantity as integer))
                when 5 then concat(cast(l_quantity as integer), '00000000')
                when 6 then case when l_quantity <= 25 then 'true' else 'FALSE' end
                else case when l_quantity <= 25 then '' end end as value,
            case concat(l_returnflag, l_linestatus) when 'RF' then 'INTEGER'
                when 'RO' then 'INTEGER_POSITIVE' when 'AF' then 'NUMBER'
                when 'AO' then 'PERCENTAGE' when 'NF' then 'BOOLEAN'
                else 'TEXT' end as value_type
        from lineitem""",
    "fx_mixed_typed": """
        select *, case when value_type in ('INTEGER', 'INTEGER_POSITIVE')
                then cast(try_cast(regexp_extract(value, '^\\s*([+-]?\\d+)(\\.\\d*)?\\s*$', 1)
                    as integer) as double)
            when value_type in ('NUMBER', 'PERCENTAGE')
                then try_cast(trim(value) as double) end as numeric_value,
            case when value_type = 'BOOLEAN' then
                case when lower(trim(value)) in ('true', 't', 'yes', 'y', '1') then true
                    when lower(trim(value)) in ('false', 'f', 'no', 'n', '0') then false end
                end as boolean_value
        from fx_mixed""",
    "fx_current": """
        select concat('P', p_partkey) as id, p_name as name, p_brand as shortname
        from part where p_size <> 9""",
    "fx_reference": """
        select concat('P', p_partkey) as id,
            case when p_size in (1, 2) then concat('old ', p_name) else p_name end as name,
            p_brand as shortname
        from part where p_size <> 3""",
    "fx_added": "select * from fx_current where id not in (select id from fx_reference)",
    "fx_removed": "select * from fx_reference where id not in (select id from fx_current)",
    "fx_renamed": """
        select c.id, r.name as old_name, c.name as new_name
        from fx_current c join fx_reference r on c.id = r.id where c.name <> r.name""",
    "fx_event": """
        select * from (select *, row_number() over (
            partition by user_id, event_type, cast(ts as date)
            order by ts desc nulls last, value desc nulls last, event_id desc,
                props desc nulls last) as latest_rank,
            cast(ts as date) as day from events)""",
}

# ---- fragments shared by several statements

VALUE = """dataelement, period, orgunit, categoryoptioncombo, attributeoptioncombo, value,
    storedby, cast(created as varchar) as created, cast(lastupdated as varchar) as lastupdated,
    followup"""
PERIOD = """year_month, cast(period_start_date as varchar) as period_start_date,
    cast(period_end_date as varchar) as period_end_date, year, month, quarter"""
ENRICHED = f"""{VALUE}, {PERIOD}, data_element_name, category_option_combo_name, country_name,
    region_name, district_name, facility_name, value_type"""
EVENT = "event_id, cast(ts as varchar) as ts, user_id, event_type, value, props, cast(day as varchar) as day"
SINK = "data_element_id, org_unit_id, category_option_combo_id, value, numeric_value, year_month"
DEADLINE = "cast(reporting_deadline as varchar) as reporting_deadline"


def share(flag: str) -> str:
    """Share of true rows, rounded as a decimal so that halves go up."""
    return (f"cast(round(cast(avg(case when {flag} then 1 else 0 end) as decimal(18, 12)), 4) "
            "as double)")


def quotient(part: str, whole: str) -> str:
    return (f"cast(round(cast(coalesce({part} / nullif(cast({whole} as double), 0), 0) "
            "as decimal(18, 12)), 4) as double)")


def total(column: str) -> str:
    return f"cast(coalesce(sum({column}), 0) as bigint)"


def violation(rule: str, column: str, detail: str, count: str) -> str:
    return (f"select '{rule}' as rule, '{column}' as column_name, {detail} as detail, "
            f"cast({count} as bigint) as violating_rows from fx_fact having {count} > 0")


NULL_DETAIL = "'NULL in a non-nullable column'"
NULL_NUMBER = violation("nullability", "numeric_value", NULL_DETAIL,
                        "count(*) filter (numeric_value is null)")
NULL_VALUE = violation("nullability", "value", NULL_DETAIL, "count(*) filter (value is null)")
RANGE = violation("numeric_ranges", "numeric_value", "'outside 1 to 50000'",
                  "count(*) filter (numeric_value < 1 or numeric_value > 50000)")

PROFILED = """data_element_id org_unit_id category_option_combo_id year_month period_start_date
    period_end_date year month quarter data_element_name category_option_combo_name country_name
    region_name district_name facility_name value numeric_value boolean_value value_type
    is_null_value is_blank_value is_zero_value has_reported_value has_valid_numeric_value
    is_late_submission created lastupdated""".split()

COUNTS = """select cast(sum(row_count) as bigint) as input_rows,
    cast(sum(row_count) filter (outcome <> 'clean') as bigint) as quarantine_rows,
    cast(sum(row_count) filter (starts_with(outcome, 'unresolved_')) as bigint)
        as unresolved_rows,
    cast(sum(row_count) filter (outcome = 'clean') as bigint) as fact_rows
    from fx_outcome"""


def resolved_count(*conditions: str) -> str:
    kept = " and ".join(conditions) or "true"
    return f"(select count(*) from fx_known where {kept})"


ELEMENT_KNOWN = "data_element_name is not null"
COMBO_KNOWN = "category_option_combo_name is not null"
UNIT_KNOWN = "facility_name is not null"

TYPED = """
    typed_fact as (
        select *, case data_element_name when 'Indicator ECONOMY' then 'AVERAGE'
            when 'Indicator PROMO' then 'LAST' when 'Indicator SMALL' then 'MAX' else 'SUM' end
            as aggregationtype from fx_fact),
    typed_month as (
        select country_name, data_element_name, aggregationtype, year_month,
            case aggregationtype when 'AVERAGE' then avg(numeric_value)
                when 'MAX' then max(numeric_value) else sum(numeric_value) end as monthly_amount
        from typed_fact group by country_name, data_element_name, aggregationtype, year_month)"""
VERSIONS = """
    current_version as (
        select concat('P', p_partkey) as id, p_name as name, p_brand as shortname,
            case when p_size <> 6 then p_type end as code from part where p_size <> 9),
    reference_version as (
        select concat('P', p_partkey) as id, case when p_size in (1, 2) then concat('old ', p_name)
                when p_size = 8 then null else p_name end as name,
            case when p_size <> 5 then p_brand end as shortname,
            case when p_size in (2, 4) then 'X' else p_type end as code
        from part where p_size <> 3),
    attribute_change as (
        select id, attribute, old_value, new_value from (
            select r.id, unnest(['name', 'shortname', 'code']) as attribute,
                unnest([r.name, r.shortname, r.code]) as old_value,
                unnest([c.name, c.shortname, c.code]) as new_value
            from reference_version r join current_version c on r.id = c.id)
        where old_value is distinct from new_value)"""

STATEMENTS = {
    "src_json_document": """
        select '1' as version, cast(1 as integer) as units, id as first_id from fx_org_unit""",
    "flatten_nested_array": """
        select dataelement as "dataElement", orgunit as "orgUnit",
            attributeoptioncombo as "attributeOptionCombo", value from fx_value""",
    "guard_not_empty": "select level, count(*) as units from fx_org_unit group by level",
    "ingest_metadata": """
        select 'element' as kind, id, name, created, lastupdated, valuetype from fx_registry
        union all
        select 'combo', id, name, '2024-01-01 00:00:00', '2024-01-02 00:00:00', null
        from fx_coc""",
    "ingest_reference_metadata": "select * from fx_registry",
    "ingest_org_units": "select * from fx_org_unit",
    "ingest_programs": "select * from fx_program",
    "ingest_data_values": f"select {VALUE}, {PERIOD} from fx_dated",
    "standardize_column_names": """
        select s_suppkey, s_name as supplier_name, s_nationkey as nationkey,
            s_acctbal as acct_bal from supplier""",
    "select_existing_columns": "select c_mktsegment, c_custkey from customer",
    "prune_columns": f"select {VALUE}, {PERIOD} from fx_dated",
    "period_dates": """
        select o_orderkey, period, period as year_month,
            cast(day_one as varchar) as period_start_date,
            cast(last_day(day_one) as varchar) as period_end_date,
            cast(year(day_one) as integer) as year, cast(month(day_one) as integer) as month,
            cast(quarter(day_one) as integer) as quarter
        from (select *, cast(try_strptime(concat(period, '01'), '%Y%m%d') as date) as day_one
            from (select o_orderkey, case o_orderpriority
                    when '5-LOW' then concat(year(o_orderdate), '13')
                    when '4-NOT SPECIFIED' then null
                    else strftime(o_orderdate, '%Y%m') end as period
                from orders)
            ) where period is null or period is not null""",
    "standardize_timestamps": """
        select o_orderkey, cast(o_orderdate as varchar) as created,
            case when o_orderstatus = 'F'
                then concat(strftime(o_orderdate, '%Y-%m-%d'), ' 00:00:00') end
                as lastupdated
        from orders""",
    "late_reporting": f"""
        select attributeoptioncombo, period, cast(lastupdated as varchar) as lastupdated,
            cast(cast(deadline as date) as varchar) as reporting_deadline,
            lastupdated > deadline as is_late_submission
        from (select *, period_end_date + interval 60 day as deadline from fx_dated)""",
    "cast_typed_values": "select * from fx_mixed_typed",
    "missing_value_flags": """
        select attributeoptioncombo, value, value is null as is_null_value,
            value = '' as is_blank_value, value = '0' as is_zero_value from fx_value""",
    "completeness_flags": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, value_type,
            value is not null as has_reported_value,
            numeric_value is not null as has_valid_numeric_value
        from fx_mixed_typed""",
    "resolve_data_elements": f"""
        select {VALUE}, data_element_name, value_type from fx_known where {ELEMENT_KNOWN}""",
    "unresolved_data_elements": f"""
        select {VALUE}, data_element_name, value_type from fx_known
        where data_element_name is null""",
    "resolve_category_combos": f"""
        select {VALUE}, data_element_name, value_type, category_option_combo_name
        from fx_known where {ELEMENT_KNOWN} and {COMBO_KNOWN}""",
    "unresolved_category_combos": f"""
        select {VALUE}, data_element_name, value_type, category_option_combo_name
        from fx_known where {ELEMENT_KNOWN} and category_option_combo_name is null""",
    "enrich_org_hierarchy": f"""
        select {VALUE}, data_element_name, value_type, category_option_combo_name,
            country_name, region_name, district_name, facility_name
        from fx_known where {ELEMENT_KNOWN} and {COMBO_KNOWN} and {UNIT_KNOWN}""",
    "unresolved_org_units": f"""
        select {VALUE}, data_element_name, value_type, category_option_combo_name,
            country_name, region_name, district_name, facility_name
        from fx_known where {ELEMENT_KNOWN} and {COMBO_KNOWN} and facility_name is null""",
    "resolve_registry": """
        select l_orderkey, l_linenumber, l_suppkey, l.dataelement,
            name as data_element_name, shortname, code, valuetype as value_type, domaintype,
            aggregationtype, zeroissignificant, id is not null as is_known
        from (select *, case when l_tax > 0.075 then 'GHOST'
                else concat('P', l_partkey) end as dataelement from lineitem) l
        left join fx_registry_newest r on l.dataelement = r.id""",
    "hierarchy_levels": "select * from fx_levels",
    "hierarchy_names": "select * from fx_hierarchy",
    "exact_dup_clean": f"select distinct {VALUE} from fx_value",
    "exact_dup_surplus": f"""
        select {VALUE} from fx_value except all select distinct {VALUE} from fx_value""",
    "near_dup_latest": f"""
        select {VALUE} from (select *, row_number() over (
            partition by dataelement, period, orgunit, categoryoptioncombo
            order by lastupdated desc nulls last, created desc nulls last,
                value desc nulls last, attributeoptioncombo desc, storedby desc) as latest_rank
            from fx_value) where latest_rank = 1""",
    "near_dup_superseded": f"""
        select {VALUE} from (select *, row_number() over (
            partition by dataelement, period, orgunit, categoryoptioncombo
            order by lastupdated desc nulls last, created desc nulls last,
                value desc nulls last, attributeoptioncombo desc, storedby desc) as latest_rank
            from fx_value) where latest_rank > 1""",
    "near_dup_events_latest": f"select {EVENT} from fx_event where latest_rank = 1",
    "near_dup_events_superseded": f"select {EVENT} from fx_event where latest_rank > 1",
    "duplicate_rate": f"""
        select total_rows, duplicate_rows,
            {quotient('duplicate_rows', 'total_rows')} as duplicate_rate
        from (select (select count(*) from fx_value) as total_rows,
            (select count(*) from fx_value) - (select count(*) from
                (select distinct * from fx_value)) as duplicate_rows)""",
    "dq_clean_fact": f"""
        select {ENRICHED}, numeric_value, boolean_value, is_null_value, is_blank_value,
            is_zero_value, {DEADLINE}, is_late_submission, has_reported_value,
            has_valid_numeric_value
        from fx_clean""",
    "dq_exact_duplicates": f"""
        select {ENRICHED} from fx_reasoned where reason is null
        except all
        select distinct {ENRICHED} from fx_reasoned where reason is null""",
    "dq_superseded": f"select {ENRICHED} from fx_ranked where latest_rank > 1",
    "fact_build": "select *, '2024-03-01 00:00:00' as load_timestamp from fx_fact",
    "dim_data_element": """
        select id as data_element_id, name as data_element_name, shortname, code, valuetype,
            aggregationtype, domaintype, created, lastupdated from fx_registry_newest""",
    "dim_org_unit": """
        select id as org_unit_id, name as org_unit_name, shortname, code, level, country_name,
            region_name, district_name, facility_name, created, lastupdated
        from fx_hierarchy""",
    "dim_program": """
        select id as program_id, name as program_name, shortname, healtharea, country,
            reportingfrequency, created, lastupdated from fx_program""",
    "dim_period": f"select distinct {PERIOD} from fx_clean",
    "contract_schema": """
        with held as (select column_name, lower(column_type) as found from (describe orders)),
        wanted(column_name, type, known) as (values ('o_orderkey', 'string', 'varchar'),
            ('o_orderstatus', 'string', 'varchar'), ('o_approved', 'boolean', 'boolean'))
        select case when found is null then 'required_columns' else 'column_types' end as rule,
            column_name, case when found is null then 'column is absent'
                else concat('expected ', type, ' but found ', found) end as detail,
            cast(null as bigint) as violating_rows
        from wanted left join held using (column_name)
        where found is null or found <> known""",
    "contract_nullability": f"({NULL_NUMBER}) union all ({NULL_VALUE})",
    "contract_ranges": RANGE,
    "contract_grain": """
        select 'primary_grain' as rule,
            'data_element_id, org_unit_id, category_option_combo_id, year_month' as column_name,
            concat('duplicate rows out of ', sum(n)) as detail,
            cast(sum(n - 1) as bigint) as violating_rows
        from (select count(*) as n from fx_value
            group by dataelement, orgunit, categoryoptioncombo, period)""",
    "contract_violations": f"""
        ({NULL_NUMBER}) union all ({NULL_VALUE}) union all ({RANGE})
        union all
        select 'primary_grain', 'data_element_id, org_unit_id, year_month',
            concat('duplicate rows out of ', sum(n)), cast(sum(n - 1) as bigint)
        from (select count(*) as n from fx_fact
            group by data_element_id, org_unit_id, year_month)
        union all
        select 'min_rows', '*', concat('expected 1000000000 rows but found ', count(*)),
            1000000000 - count(*) from fx_fact""",
    "contract_passes": """
        select count(*) filter (numeric_value < 0 or numeric_value > 1000000
            or country_name is null or is_late_submission is null) as violations
        from fx_fact""",
    "drift_changed": f"""
        with {VERSIONS}
        select 'added' as status, c.id, null as attribute, null as old_value, null as new_value
        from current_version c anti join reference_version r using (id)
        union all
        select 'removed', r.id, null, null, null from reference_version r
        anti join current_version c using (id)
        union all
        select 'changed', id, attribute, old_value, new_value from attribute_change""",
    "drift_written": f"""
        with {VERSIONS}
        select 'added_data_elements' as drift_table, c.id, null as old_value,
            concat_ws('|', name, shortname, code) as new_value
        from current_version c anti join reference_version r using (id)
        union all
        select 'removed_data_elements', r.id, concat_ws('|', name, shortname, code), null
        from reference_version r anti join current_version c using (id)
        union all
        select case when attribute = 'name' and old_value is not null and new_value is not null
                then 'renamed_data_elements' else 'changed_data_elements' end, id,
            case when attribute = 'name' and old_value is not null and new_value is not null
                then old_value else concat_ws('|', attribute, old_value) end,
            case when attribute = 'name' and old_value is not null and new_value is not null
                then new_value else concat_ws('|', attribute, new_value) end
        from attribute_change""",
    "ingest_pretty_documents": """
        select 'element' as entity, concat('P', p_partkey) as id,
            concat('{"id":"CC', p_size, '","name":"Combo ', p_size, '"}') as one,
            case p_size % 3 when 0 then concat('[{"id":"G1","name":"', p_brand,
                ' 1"},{"id":"G0","name":"', p_brand, ' 0"}]')
                when 1 then concat('[{"id":"G1","name":"', p_brand, ' 1"}]')
                else concat('[{"id":"G1","name":"', p_brand, ' 1"},{"id":"G2","name":"', p_brand,
                    ' 2"}]') end as many
        from part
        union all
        select 'unit', concat('C', c_custkey),
            case when c_acctbal >= 0 then concat('{"id":"N', c_nationkey, '","name":"', c_mktsegment,
                '"}') end,
            concat('[{"id":"', c_mktsegment, '","name":"Group ', c_mktsegment, '"}]')
        from customer
        union all
        select 'metadata', '{ "dataElements": [', null, null
        union all
        select 'org_units', '{ "organisationUnits": [', null, null""",
    "drift_added": "select * from fx_added",
    "drift_removed": "select * from fx_removed",
    "drift_renamed": "select * from fx_renamed",
    "drift_summary": """
        select (select count(*) from fx_added) as added_data_elements,
            (select count(*) from fx_removed) as removed_data_elements,
            (select count(*) from fx_renamed) as renamed_data_elements""",
    "dq_profile": " union all ".join(
        f"select '{name}' as column_name, count(*) as row_count, "
        f"count(*) filter ({name} is null) as null_count, "
        f"{quotient(f'count(*) filter ({name} is null)', 'count(*)')} as null_rate "
        "from fx_fact" for name in PROFILED),
    "completeness_score": f"""
        select reported_count, expected_count,
            {quotient('reported_count', 'expected_count')} as completeness_score
        from (select count(*) filter (has_reported_value) as reported_count,
            count(*) as expected_count from fx_fact)""",
    "quarantine_counts": "select outcome, cast(row_count as bigint) as row_count from fx_outcome",
    "quarantine_rate": f"""
        select input_rows, quarantine_rows,
            {quotient('quarantine_rows', 'input_rows')} as quarantine_rate from ({COUNTS})""",
    "quarantine_union": """
        select reason, dataelement, period, orgunit, categoryoptioncombo, attributeoptioncombo,
            value, cast(lastupdated as varchar) as lastupdated
        from fx_reasoned where reason is not null
        union all
        select 'superseded_records', dataelement, period, orgunit, categoryoptioncombo,
            attributeoptioncombo, value, cast(lastupdated as varchar)
        from fx_ranked where latest_rank > 1
        union all
        select 'exact_duplicates', dataelement, period, orgunit, categoryoptioncombo,
            attributeoptioncombo, value, cast(lastupdated as varchar)
        from (select * from fx_reasoned where reason is null
            except all select distinct * from fx_reasoned where reason is null)""",
    "quarantine_gate": f"""
        select gate, cast(observed as double) as observed, threshold,
            case when gate = 'min_fact_rows' then observed >= threshold
                else observed <= threshold end as passed
        from (
            select 'max_quarantine_rate' as gate,
                {quotient('quarantine_rows', 'input_rows')} as observed,
                cast(0.25 as double) as threshold from ({COUNTS})
            union all
            select 'min_fact_rows', fact_rows, 1 from ({COUNTS})
            union all
            select 'max_unresolved_rate', {quotient('unresolved_rows', 'input_rows')}, 0.10
            from ({COUNTS}))""",
    "stage_row_counts": f"""
        select 'input' as stage, {resolved_count()} as row_count
        union all select 'data_elements', {resolved_count(ELEMENT_KNOWN)}
        union all select 'category_combos', {resolved_count(ELEMENT_KNOWN, COMBO_KNOWN)}
        union all select 'org_units', {resolved_count(ELEMENT_KNOWN, COMBO_KNOWN, UNIT_KNOWN)}""",
    "run_metrics": f"""
        select 'success' as status, '2024-03-01 00:00:00' as completed_at_utc, input_rows,
            fact_rows, quarantine_rows from ({COUNTS})""",
    "incremental_existing_partitions": """
        select distinct year_month from fx_fact where year_month < '199801'""",
    "incremental_filter_periods": f"""
        select {VALUE}, {PERIOD} from fx_dated d where year_month is not null and not exists
            (select 1 from (select distinct year_month from fx_fact where year_month < '199801') f
            where f.year_month = d.year_month)""",
    "job_two_loads": """
        select load, outcome, count(*) as row_count from (
            select period, reason as outcome from fx_reasoned where reason is not null
            union all
            select period, case when latest_rank = 1 then 'fact' else 'superseded_records' end
            from fx_ranked
            union all
            select period, 'exact_duplicates' from (select * from fx_reasoned where reason is null
                except all select distinct * from fx_reasoned where reason is null))
        cross join lateral (select case when period < '199801' then 'first' else 'second' end as load)
        group by all""",
    "job_reopened_month": """
        select data_element_id, org_unit_id, category_option_combo_id, year_month,
            case when year_month = '199706' and regexp_matches(org_unit_id, '[02468]$')
                then '7' else value end as value from fx_fact""",
    "job_stale_resend": """
        with rejected as (
            select reason as outcome, period from fx_reasoned where reason is not null
            union all
            select 'superseded_records', period from fx_ranked where latest_rank > 1
            union all
            select 'exact_duplicates', period from (select * from fx_reasoned where reason is null
                except all select distinct * from fx_reasoned where reason is null))
        select 'fact' as outcome, concat_ws('|', data_element_id, org_unit_id,
                category_option_combo_id, year_month) as key,
            case when year_month = '199706' and not regexp_matches(org_unit_id, '[02468]$')
                then '9' else value end as value, cast(1 as bigint) as row_count
        from fx_fact
        union all
        select outcome, null, null, count(*) from (
            select outcome from rejected
            union all
            select outcome from rejected where period = '199706'
            union all
            select case when regexp_matches(org_unit_id, '[02468]$') then 'superseded_records'
                else 'replaced_records' end from fx_fact where year_month = '199706')
        group by outcome""",
    "job_interrupted": f"""
        select 'fact' as part, year_month as key, cast(count(*) as double) as amount
        from fx_fact group by year_month
        union all
        select 'statistics', year_month, count(*) from fx_fact group by year_month
        union all
        select 'monthly', concat_ws('|', country_name, data_element_name, year_month),
            round(monthly_total, 6) from fx_monthly
        union all
        select 'coverage', concat_ws('|', country_name, data_element_name),
            {share('has_reported_value')} from fx_fact group by country_name, data_element_name
        union all
        select 'metrics', unnest(['input_rows', 'fact_rows', 'quarantine_rows', 'runs']),
            unnest([input_rows, fact_rows, quarantine_rows, 2]) from ({COUNTS})""",
    "incremental_required": """
        select 'second' as load,
            (select count(*) from fx_fact where year_month >= '199801') > 0 as required
        union all
        select 'third', false""",
    "incremental_changed_periods": """
        select v.year_month from (select year_month, max(lastupdated) as incoming
            from fx_dated group by year_month) v
        join (select year_month, max(lastupdated) as stored from fx_clean
            where lastupdated < timestamp '1999-01-01' group by year_month) f
            on v.year_month = f.year_month
        where incoming > stored""",
    "sink_parquet_dynamic_overwrite": f"""
        select {SINK} from (select * replace (
            case when year_month >= '199801' then 'revised' else value end as value)
            from fx_fact)""",
    "sink_csv_roundtrip": """
        select data_element_id, org_unit_id, category_option_combo_id, year_month,
            numeric_value, has_reported_value from fx_fact""",
    "sink_fact_partitioned": "select * from fx_fact",
    "sink_named_tables": """
        select 'dim_data_element' as table_name, count(*) as row_count from part
        union all select 'dim_org_unit', count(*) from fx_org_unit
        union all select 'dim_program', count(*) from fx_program""",
    "materialize_roundtrip": f"select {SINK} from fx_fact",
    "monthly_by_type": f"""
        with {TYPED}
        select * replace (round(monthly_amount + 1.3e-7, 6) as monthly_amount) from typed_month""",
    "monthly_change_by_type": f"""
        with {TYPED}
        select country_name, data_element_name, aggregationtype, year_month,
            round(monthly_amount + 1.3e-7, 6) as monthly_amount, round(previous + 1.3e-7, 6) as previous_amount, round(monthly_amount - previous + 1.3e-7, 6) as mom_change
        from (select *, lag(monthly_amount) over (
            partition by country_name, data_element_name order by year_month) as previous
            from typed_month)
        """,
    "rolling_3month_by_type": f"""
        with {TYPED},
        ranked as (
            select *, dense_rank() over (partition by country_name, data_element_name
                order by year_month) as nth from typed_fact),
        months as (
            select distinct country_name, data_element_name, aggregationtype, year_month, nth
            from ranked),
        together as (
            select m.*, r.nth as held, sum(r.numeric_value) as total,
                count(r.numeric_value) as counted, max(r.numeric_value) as greatest
            from months m join ranked r on m.country_name = r.country_name
                and m.data_element_name = r.data_element_name and r.nth between m.nth - 2 and m.nth
            group by m.country_name, m.data_element_name, m.aggregationtype, m.year_month, m.nth,
                r.nth)
        select country_name, data_element_name, aggregationtype, year_month,
            round(case aggregationtype when 'AVERAGE' then sum(total) / sum(counted)
                when 'MAX' then max(greatest)
                when 'LAST' then arg_max(total, held) filter (total is not null)
                else sum(total) / count(total) end + 1.3e-7, 6) as rolling_amount
        from together group by country_name, data_element_name, aggregationtype, year_month""",
    "quarterly_by_type": f"""
        with {TYPED},
        last_month as (
            select year, quarter, data_element_name, max(year_month) as year_month
            from typed_fact where numeric_value is not null group by all)
        select t.year, t.quarter, t.data_element_name, t.aggregationtype,
            round(case t.aggregationtype when 'AVERAGE' then avg(numeric_value)
                when 'MAX' then max(numeric_value)
                when 'LAST' then sum(numeric_value) filter (t.year_month = l.year_month)
                else sum(numeric_value) end + 1.3e-7, 6) as quarterly_amount
        from typed_fact t left join last_month l on t.year = l.year and t.quarter = l.quarter
            and t.data_element_name = l.data_element_name
        group by t.year, t.quarter, t.data_element_name, t.aggregationtype""",
    "monthly_mom_change": """
        select country_name, data_element_name, year_month,
            round(monthly_total, 6) as monthly_total, round(previous, 6) as previous_month_total,
            round(monthly_total - previous, 6) as mom_change
        from (select *, lag(monthly_total) over (
            partition by country_name, data_element_name order by year_month) as previous
            from fx_monthly)""",
    "monthly_mom_change_calendar": """
        select m.country_name, m.data_element_name, m.year_month,
            round(m.monthly_total, 6) as monthly_total,
            round(p.monthly_total, 6) as previous_month_total,
            round(m.monthly_total - p.monthly_total, 6) as mom_change
        from fx_monthly m left join fx_monthly p on m.country_name = p.country_name
            and m.data_element_name = p.data_element_name
            and m.month_number = p.month_number + 1""",
    "rolling_3month_avg": """
        select country_name, data_element_name, year_month,
            round(monthly_total, 6) as monthly_total,
            round(avg(monthly_total) over (partition by country_name, data_element_name
                order by year_month rows between 2 preceding and current row), 6)
                as rolling_3month_avg
        from fx_monthly""",
    "rolling_3month_avg_calendar": """
        select country_name, data_element_name, year_month,
            round(monthly_total, 6) as monthly_total,
            round(avg(monthly_total) over (partition by country_name, data_element_name
                order by month_number range between 2 preceding and current row), 6)
                as rolling_3month_avg
        from fx_monthly""",
    "country_reporting_rate": f"""
        select *, {quotient('reporting_facilities', 'expected_facilities')} as reporting_rate
        from (select country_name, year_month,
            count(distinct case when has_reported_value then facility_name end)
                as reporting_facilities,
            count(distinct facility_name) as expected_facilities
            from fx_silenced group by country_name, year_month)""",
    "reporting_rate_rolled": f"""
        select country_name, period, reporting_facilities, expected_facilities,
            {quotient('reporting_facilities', 'expected_facilities')} as reporting_rate
        from (select country_name, period,
            count(distinct case when has_reported_value then facility_name end)
                as reporting_facilities,
            count(distinct facility_name) as expected_facilities
            from (select *, concat(substr(year_month, 1, 4), 'Q', quarter) as period from fx_silenced
                union all select *, substr(year_month, 1, 4) from fx_silenced)
            group by country_name, period)""",
    "underreporting_facilities": f"""
        select country_name, facility_name, {share('has_reported_value')} as reporting_score
        from fx_silenced group by country_name, facility_name
        having {share('has_reported_value')} < 0.5""",
    "quarterly_global_totals": """
        select year, quarter, data_element_name,
            round(sum(numeric_value), 6) as quarterly_total
        from fx_fact group by year, quarter, data_element_name""",
    "completeness_comparison": f"""
        select country_name, {share('has_reported_value')} as completeness_score
        from fx_silenced group by country_name""",
    "coverage_matrix": f"""
        select country_name, data_element_name,
            {share('has_reported_value')} as coverage_score
        from fx_silenced group by country_name, data_element_name""",
    "low_completeness": f"""
        select country_name, {share('has_reported_value')} as completeness_score
        from fx_silenced group by country_name
        having {share('has_reported_value')} < 0.7""",
}


STATEMENTS["near_dup_hot_events"] = """
    select event_type, event_id, cast(ts as varchar) as ts from (select *, row_number() over (
        partition by event_type order by ts desc nulls last, event_id desc) as latest_rank
    from events) where latest_rank = 1"""
STATEMENTS["sink_marts"] = " union all ".join(
    f"select '{mart}' as mart, {key} as key, {score} as score from ({STATEMENTS[name]})"
    for mart, name, key, score in [
        ("completeness_comparison", "completeness_comparison", "country_name", "completeness_score"),
        ("indicator_coverage_matrix", "coverage_matrix",
         "concat(country_name, '|', data_element_name)", "coverage_score"),
        ("underreporting_facilities", "underreporting_facilities",
         "concat(country_name, '|', facility_name)", "reporting_score"),
        ("country_reporting_rate", "country_reporting_rate",
         "concat(country_name, '|', year_month)", "reporting_rate")])

STATEMENTS["sink_amount_marts"] = " union all ".join(
    f"select '{mart}' as mart, {key} as key, {amount} as amount from ({STATEMENTS[name]})"
    for mart, name, key, amount in [
        ("monthly_mom_change", "monthly_mom_change",
         "concat_ws('|', country_name, data_element_name, year_month)", "mom_change"),
        ("rolling_3month_avg", "rolling_3month_avg",
         "concat_ws('|', country_name, data_element_name, year_month)", "rolling_3month_avg"),
        ("quarterly_global_totals", "quarterly_global_totals",
         "concat_ws('|', year, quarter, data_element_name)", "quarterly_total"),
        ("low_completeness_countries", "low_completeness", "country_name", "completeness_score")])


def needed(sql: str) -> list[str]:
    """Inputs a statement refers to, directly or through others, in order."""
    names, text = set(), [sql]
    while text:
        body = text.pop()
        for name in INPUTS:
            if name not in names and name in body:
                names.add(name)
                text.append(INPUTS[name])
    return [name for name in INPUTS if name in names]


def statements() -> dict[str, str]:
    def complete(sql: str) -> str:
        views = ",\n".join(f"{name} as ({INPUTS[name]})" for name in needed(sql))
        own = sql.strip()
        if views and own.startswith("with "):
            return f"with {views},\n{own.removeprefix('with ')}"
        return f"with {views}\n{sql}" if views else sql

    return {name: complete(sql) for name, sql in STATEMENTS.items()}
