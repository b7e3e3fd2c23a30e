"""DuckDB SQL for the registered queries, written apart from the Spark jobs.

``QUERIES`` maps a key to a body over named relations; ``oracle_sql`` puts the
relations that a body needs in front of it as common table expressions.
"""

from __future__ import annotations

import re

from contract import views
from fleetlake import schemas

_STAMP = (
    "timestamp '2026-01-01 00:00:00' as created_at, timestamp '2026-01-01 00:00:00' as updated_at"
)
_AS_OF = "date '2026-01-01'"


def _num(c: str) -> str:
    return (
        f"case when regexp_matches({c}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') "
        f"then try_cast({c} as double) end"
    )


def _date(c: str) -> str:
    return f"case when regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast({c} as date) end"


def _stamp(c: str) -> str:
    form = "^\\d{4}-\\d{2}-\\d{2}([ T]\\d{2}:\\d{2}(:\\d{2}(\\.\\d+)?)?)?$"
    return f"case when regexp_matches({c}, '{form}') then try_cast({c} as timestamp) end"


def _flag(c: str, default: str) -> str:
    return f"case lower({c}) when 'true' then true when 'false' then false else {default} end"


def _word(c: str, other: str) -> str:
    return (
        f"case when lower({c}) in ('true','t','yes','y','1') then true "
        f"when lower({c}) in ('false','f','no','n','0') then false else {other} end"
    )


def _filled(table: str, c: str, low: float, high: float) -> str:
    """abs, then median of the non-null values by explicit rank, then bounds."""
    source = f"t_{table}_dirty"
    median = (
        f"(select (l[(len(l) + 1) // 2] + l[len(l) // 2 + 1]) / 2 from "
        f"(select list_sort(list(abs({_num(c)})) filter (where {_num(c)} is not null)) as l from {source}))"
    )
    return f"least(greatest(coalesce(abs({_num(c)}), {median}), {float(low)}), {float(high)}) as {c}"


def _int(expression: str, low: int | None = None, high: int | None = None) -> str:
    e = f"trunc({expression})"
    if low is not None:
        e = f"greatest({e}, {low})"
    if high is not None:
        e = f"least({e}, {high})"
    return f"cast({e} as int)"


def _typed(table: str, source: str) -> str:
    """The silver casts of a cleaned table."""
    kinds = {"string": "varchar", "timestamp_ntz": "timestamp"}
    columns = []
    for name, kind in schemas.silver_types(table).items():
        # doubles hold two-place money or half cents of a median; text keeps them exact
        value = f"cast({name} as varchar)" if kind.startswith("decimal") else name
        columns.append(f"cast({value} as {kinds.get(kind, kind)}) as {name}")
    return f"select {', '.join(columns)} from {source}"


def _dim(table: str, key: str, id_column: str, columns: str) -> str:
    return (
        f"select cast(row_number() over (order by {id_column}) as bigint) as {key}, {columns} "
        f"from s_{table}"
    )


_NAME = "coalesce(first_name, '') || ' ' || coalesce(last_name, '') as full_name"

RELATIONS = {
    "c_locations": f"""
        select location_id, city, address, phone, opening_hours,
          {_flag('is_active', 'true')} as is_active, {_STAMP} from t_locations_dirty""",
    "c_cars": f"""
        select car_id, brand, model,
          {_int(f"coalesce({_num('year')}, 2020)", 2010, 2024)} as year, color, license_plate, vin,
          current_location_id, {_date('purchase_date')} as purchase_date,
          {_filled('cars', 'purchase_price', 10000, 200000)},
          {_filled('cars', 'daily_rental_price', 10, 500)},
          fuel_type, transmission, seats, coalesce(status, 'Available') as status,
          {_int(f"coalesce({_num('mileage')}, 0)", 0, 500000)} as mileage, {_STAMP}
        from t_cars_dirty""",
    "c_customers": f"""
        select customer_id, first_name, last_name,
          coalesce(lower(email), 'unknown@example.com') as email, phone,
          case when {_date('date_of_birth')} is null or {_date('date_of_birth')} > {_AS_OF} - 6570
            then {_AS_OF} - 9125 else {_date('date_of_birth')} end as date_of_birth,
          case when count(*) over (partition by coalesce(driving_license, '')) > 1
            then coalesce(driving_license, '') || '_' || customer_id
            else coalesce(driving_license, '') end as driving_license,
          {_date('license_issue_date')} as license_issue_date,
          {_date('license_expiry_date')} as license_expiry_date, address, city,
          {_date('registration_date')} as registration_date, loyalty_level, {_STAMP}
        from t_customers_dirty""",
    "c_employees": f"""
        select employee_id, first_name, last_name,
          coalesce(lower(email), 'employee@rental.by') as email, phone, position,
          {_date('hire_date')} as hire_date, {_filled('employees', 'salary', 500, 5000)},
          location_id, {_flag('is_active', 'true')} as is_active, {_STAMP} from t_employees_dirty""",
    "c_tariffs": f"""
        select tariff_id, tariff_name, {_filled('tariffs', 'base_price_per_day', 10, 500)},
          {_int(f"coalesce({_num('km_included_per_day')}, 1)")} as km_included_per_day,
          {_filled('tariffs', 'additional_km_price', 0.1, 10)},
          {_filled('tariffs', 'deposit_amount', 100, 3000)},
          {_int(f"coalesce({_num('min_rental_days')}, 1)")} as min_rental_days,
          greatest({_int(f"coalesce({_num('min_rental_days')}, 1)")},
            {_int(f"coalesce({_num('max_rental_days')}, 1)")}) as max_rental_days,
          insurance_type, cancellation_policy, {_STAMP} from t_tariffs_dirty""",
    "p_rentals": f"""
        select * replace (
          {_date('rental_date')} as rental_date,
          {_date('scheduled_return_date')} as scheduled_return_date,
          {_date('actual_return_date')} as actual_return_date,
          {_num('rental_days')} as rental_days, {_num('km_driven')} as km_driven,
          {_num('additional_km')} as additional_km, abs({_num('base_cost')}) as base_cost,
          abs({_num('additional_km_cost')}) as additional_km_cost,
          abs({_num('total_cost')}) as total_cost, {_num('deposit_amount')} as deposit_amount,
          {_num('deposit_returned')} as deposit_returned)
        from t_rentals_dirty""",
    "q_rentals": """
        select * replace (
          case when scheduled_return_date < rental_date then rental_date + 1
            else scheduled_return_date end as scheduled_return_date,
          case when actual_return_date < rental_date then rental_date + 1
            else actual_return_date end as actual_return_date)
        from p_rentals""",
    "c_rentals": f"""
        select rental_id, car_id, customer_id, employee_id, tariff_id, pickup_location_id,
          return_location_id, rental_date, scheduled_return_date, actual_return_date,
          cast(greatest(trunc(coalesce(rental_days,
            cast(scheduled_return_date - rental_date as double), 1)), 1) as int) as rental_days,
          cast(trunc(coalesce(km_driven, 100)) as int) as km_driven,
          cast(trunc(coalesce(additional_km, 0)) as int) as additional_km, base_cost,
          additional_km_cost,
          case when total_cost is null then base_cost + additional_km_cost else total_cost end
            as total_cost, deposit_amount,
          case when deposit_returned is null then null
            when deposit_amount is null then greatest(deposit_returned, 0)
            else least(greatest(deposit_returned, 0), deposit_amount) end as deposit_returned,
          coalesce(status, 'Completed') as status, coalesce(notes, '') as notes, {_STAMP},
          coalesce(actual_return_date > scheduled_return_date, false) as is_late_return,
          cast(case when actual_return_date is null or scheduled_return_date is null then null
            when actual_return_date > scheduled_return_date
              then actual_return_date - scheduled_return_date else 0 end as int) as late_days
        from q_rentals""",
    "c_payments": f"""
        select payment_id, rental_id, cast({_date('payment_date')} as timestamp) as payment_date,
          coalesce(payment_method, 'Cash') as payment_method,
          {_filled('payments', 'amount', 0, 10000)},
          coalesce(payment_type, 'Rental') as payment_type, coalesce(status, 'Completed') as status,
          {_STAMP} from t_payments_dirty""",
    "q_car_condition": f"""
        select * replace ({_stamp('entry_date')} as entry_date,
          case when {_date('repair_date')} < {_stamp('entry_date')}
            then cast({_stamp('entry_date')} + interval 1 day as date)
            else {_date('repair_date')} end as repair_date)
        from t_car_condition_dirty""",
    "c_car_condition": f"""
        select condition_id, car_id, cast(entry_date as timestamp) as entry_date,
          coalesce(entry_type, 'Maintenance') as entry_type,
          coalesce(description, 'Regular check') as description,
          {_filled('car_condition', 'cost', 0, 20000)},
          coalesce(reported_by, 'Employee') as reported_by,
          case when repair_date is not null then true else {_flag('is_repaired', 'false')} end
            as is_repaired,
          repair_date, coalesce(notes, '') as notes, {_STAMP} from q_car_condition""",
    "s_locations": f"select * replace ({_word('is_active', 'null')} as is_active) from t_locations",
    "s_cars": "select * from t_cars",
    "s_customers": "select * from t_customers",
    "s_employees": f"select * replace ({_word('is_active', 'null')} as is_active) from t_employees",
    "s_tariffs": "select * from t_tariffs",
    "s_rentals": """
        select *, coalesce(actual_return_date > scheduled_return_date, false) as is_late_return,
          cast(greatest(actual_return_date - scheduled_return_date, 0) as int) as late_days
        from t_rentals""",
    "s_payments": "select * from t_payments",
    "s_car_condition": "select * from t_car_condition",
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as date) as full_date,
          cast(year(d) as int) as year, cast(month(d) as int) as month, cast(day(d) as int) as day,
          monthname(d) as month_name, cast(dayofweek(d) as int) as day_of_week,
          case when isodow(d) >= 6 then 'Weekend' else 'Weekday' end as day_type
        from (select unnest(generate_series(date '2020-01-01', date '2030-12-31', interval 1 day)) as d)""",
    "dim_car": _dim(
        "cars", "car_key", "car_id",
        "car_id, brand, model, year, color, license_plate, vin, status, daily_rental_price, "
        "current_location_id, purchase_date, purchase_price",
    ),
    "dim_client": _dim(
        "customers", "client_key", "customer_id",
        f"customer_id, first_name, last_name, {_NAME}, email, phone, city, loyalty_level, "
        "date_of_birth, driving_license, license_issue_date, license_expiry_date, registration_date",
    ),
    "dim_employee": _dim(
        "employees", "employee_key", "employee_id",
        f"employee_id, {_NAME}, email, position, hire_date, is_active",
    ),
    "dim_location": _dim(
        "locations", "location_key", "location_id",
        "location_id, city, address, opening_hours, is_active",
    ),
    "dim_tariff": _dim(
        "tariffs", "tariff_key", "tariff_id",
        "tariff_id, tariff_name, base_price_per_day, km_included_per_day, additional_km_price, "
        "min_rental_days, insurance_type, cancellation_policy",
    ),
    "rollup": """
        select rental_id, cast(sum(amount) as decimal(18,2)) as total_paid,
          count(*) as payment_count, count(distinct payment_method) as unique_payment_methods
        from s_payments where status = 'Completed' group by all""",
    "rentals_paid": """
        select r.*, cast(coalesce(p.total_paid, 0) as decimal(18,2)) as total_paid,
          coalesce(p.payment_count, 0) as payment_count,
          coalesce(p.unique_payment_methods, 0) as unique_payment_methods
        from s_rentals r left join rollup p using (rental_id)""",
    "fact_rentals": """
        select r.rental_id,
          (select car_key from dim_car where car_id = r.car_id) as car_key,
          (select client_key from dim_client where customer_id = r.customer_id) as client_key,
          (select employee_key from dim_employee where employee_id = r.employee_id) as employee_key,
          (select tariff_key from dim_tariff where tariff_id = r.tariff_id) as tariff_key,
          (select location_key from dim_location where location_id = r.pickup_location_id)
            as pickup_location_key,
          (select location_key from dim_location where location_id = r.return_location_id)
            as return_location_key,
          (select date_key from dim_date where full_date = r.rental_date) as rental_date_key,
          (select date_key from dim_date where full_date = r.actual_return_date)
            as actual_return_date_key,
          rental_days, total_cost, base_cost, additional_km_cost,
          cast(coalesce(deposit_returned, 0) as decimal(10,2)) as deposit_returned, status,
          km_driven, additional_km, scheduled_return_date, is_late_return, late_days, rental_date,
          actual_return_date, cast(actual_return_date - rental_date as int) as duration_days,
          total_paid, payment_count, unique_payment_methods
        from rentals_paid r""",
    "broken_keys": """
        select 'locations' as table_name, cast(location_id as bigint) as key from t_locations
        union all select 'cars', car_id from t_cars_broken
        union all select 'customers', customer_id from t_customers
        union all select 'employees', employee_id from t_employees
        union all select 'tariffs', tariff_id from t_tariffs
        union all select 'rentals', rental_id from t_rentals_broken
        union all select 'payments', payment_id from t_payments_broken
        union all select 'car_condition', condition_id from t_car_condition""",
    "pk_violations": """
        select table_name, case when key is null then 'null_key' else 'duplicate_key' end as rule,
          key, count(*) as n
        from broken_keys group by table_name, key having key is null or count(*) > 1""",
    "broken_references": """
        select 'cars' as table_name, 'fk_cars_location' as rule, current_location_id as key,
          current_location_id in (select location_id from t_locations) as known from t_cars_broken
        union all select 'employees', 'fk_employees_location', location_id,
          location_id in (select location_id from t_locations) from t_employees
        union all select 'rentals', 'fk_rentals_car', car_id,
          car_id in (select car_id from t_cars_broken) from t_rentals_broken
        union all select 'rentals', 'fk_rentals_customer', customer_id,
          customer_id in (select customer_id from t_customers) from t_rentals_broken
        union all select 'rentals', 'fk_rentals_employee', employee_id,
          employee_id in (select employee_id from t_employees) from t_rentals_broken
        union all select 'rentals', 'fk_rentals_tariff', tariff_id,
          tariff_id in (select tariff_id from t_tariffs) from t_rentals_broken
        union all select 'rentals', 'fk_rentals_pickup_location', pickup_location_id,
          pickup_location_id in (select location_id from t_locations) from t_rentals_broken
        union all select 'rentals', 'fk_rentals_return_location', return_location_id,
          return_location_id in (select location_id from t_locations) from t_rentals_broken
        union all select 'payments', 'fk_payments_rental', rental_id,
          rental_id in (select rental_id from t_rentals_broken where rental_id is not null)
          from t_payments_broken
        union all select 'car_condition', 'fk_car_condition_car', car_id,
          car_id in (select car_id from t_cars_broken) from t_car_condition""",
    "broken_fact": """
        select * replace (case when rental_id % 7 = 0 then -1 else car_key end as car_key)
        from fact_rentals
        union all select * from fact_rentals where rental_id % 11 = 0""",
    "fk_violations": """
        select table_name, rule, key, count(*) as n from broken_references
        where key is not null and not known group by all""",
}


def _foreign_check(name: str, child: str, column: str, parent: str, keys: dict[str, str]) -> str:
    return (
        f"select '{child}' as table_name, '{name}' as rule, count({column}) as checked, "
        f"count(*) filter (where {column} is not null and {column} not in "
        f"(select {keys[parent]} from {parent})) as violations from {child}"
    )


def _gold_checks() -> str:
    keys = schemas.GOLD_PRIMARY_KEYS
    primary = [
        f"select '{t}' as table_name, 'primary_key' as rule, count(distinct {k}) as checked, "
        f"count(*) - count(distinct {k}) as violations from {t}"
        for t, k in keys.items()
    ]
    # 'checked' of a foreign key counts its distinct keys
    foreign = [
        _foreign_check(n, c, f"{col}", p, keys).replace(
            f"from {c}", f"from (select distinct {col} from {c})"
        )
        for n, c, col, p in schemas.GOLD_FOREIGN_KEYS
    ]
    return " union all ".join(primary + foreign)


def _raw_lines() -> str:
    """Every raw table's rows as (table, id, all columns joined as text)."""

    def text(table: str, name: str, kind: str) -> str:
        value = f"cast({name} as {kind})" if kind.startswith("decimal") else name
        if name == "entry_date":
            value = f"date_trunc('second', {name})"
        return f"coalesce(cast({value} as varchar), '-')"

    parts = []
    for table in schemas.TABLES:
        kinds = schemas.raw_types(table)
        line = " || '|' || ".join(text(table, n, k) for n, k in kinds.items())
        key = schemas.PRIMARY_KEYS[table]
        parts.append(f"select '{table}' as table_name, {key} as id, {line} as line from t_{table}")
    return " union all ".join(parts)


def _counts(prefix: str) -> str:
    parts = " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {prefix}{t}"
        for t in schemas.TABLES
    )
    return (
        f"with counts as ({parts}) select * from counts union all "
        "select 'total', cast(sum(row_count) as bigint) from counts"
    )


def _money(expression: str) -> str:
    return f"cast({expression} as decimal(20,2))"


_PAID_DUE = "cast(coalesce(total_cost, 0) + coalesce(deposit_amount, 0) as decimal(18,2))"

QUERIES = {
    **{f"clean_{t}": f"select * from c_{t}" for t in schemas.TABLES},
    **{f"silver_{t}": _typed(t, f"c_{t}") for t in schemas.TABLES if t != "rentals"},
    "silver_types": _typed("rentals", "c_rentals"),
    "load_raw": """
        select * replace (cast(rental_date as varchar) as rental_date,
          cast(scheduled_return_date as varchar) as scheduled_return_date,
          cast(actual_return_date as varchar) as actual_return_date) from t_rentals""",
    "load_raw_all": _raw_lines(),
    "load_raw_counts": _counts("t_"),
    "load_raw_missing": f"""
        with t as (select table_name, table_name in ('tariffs', 'payments') as is_named,
            case when table_name in ('tariffs', 'payments') then 0 else row_count end as row_count
          from ({_counts("t_")}) where table_name <> 'total')
        select table_name, row_count, is_named from t union all
        select 'total', cast(sum(row_count) as bigint), false from t""",
    "load_silver_text": "select * from t_car_condition_dirty",
    "load_line_breaks": """
        select * replace (concat(coalesce(notes, ''), chr(10), '"', condition_id, '",', chr(10))
            as notes) from t_car_condition_dirty""",
    "silver_bool_parse": f"""
        select condition_id, word, {_word('word', 'null')} as or_null, {_word('word', 'false')} as or_false
        from t_flags""",
    "check_primary_keys": "select * from pk_violations",
    "check_foreign_keys": "select * from fk_violations",
    "integrity_report": "select * from pk_violations union all select * from fk_violations",
    "profile_keys": """
        select table_name, count(*) as row_count, count(distinct key) as unique_keys
        from broken_keys group by table_name""",
    "layer_row_counts": _counts("t_"),
    "publish_layer": "select * from dim_client",
    "dim_date": """
        select d.*, coalesce(r.rentals_count, 0) as rentals_count from dim_date d
        left join (select rental_date, count(*) as rentals_count from t_rentals group by all) r
          on d.full_date = r.rental_date""",
    **{d: f"select * from {d}" for d in schemas.GOLD_PRIMARY_KEYS if d != "dim_date"},
    "surrogate_key": """
        select cast(row_number() over (order by o_orderkey) as bigint) as order_key, o_orderkey,
          o_custkey from orders""",
    "surrogate_key_nulls": """
        select cast(row_number() over (order by id nulls last) as bigint) as number, id
        from (select case when o_orderkey % 10 <> 0 then o_orderkey // 3 end as id from orders)""",
    "stable_keys": """
        select cast(row_number() over (order by first_load, customer_id) as bigint) as client_key,
          customer_id, city, first_load
        from (select customer_id, city, case when customer_id % 10 < 5 then 1
            when customer_id % 10 < 8 then 2 else 3 end as first_load from t_customers)""",
    "insert_if_absent": """
        with loaded as (select customer_id, city, loyalty_level from t_customers
            where loyalty_level <> 'Bronze'),
          incoming as (select customer_id, 'new ' || city as city, loyalty_level from t_customers
            union all select customer_id, 'old ' || city, loyalty_level from t_customers)
        select * from loaded union all
        select customer_id, min(city), min(loyalty_level) from incoming
        where customer_id not in (select customer_id from loaded) group by customer_id""",
    "payment_rollup": "select * from rollup",
    "fact_dim_lookup": """
        select rental_id, car_key, client_key, employee_key, tariff_key, pickup_location_key,
          return_location_key from fact_rentals""",
    "fact_dim_lookup_large": """
        select rental_id, car_key, client_key, employee_key, tariff_key, pickup_location_key,
          return_location_key from fact_rentals""",
    "fact_changes": """
        select *, case when coalesce(bool_or((month(rental_date) % 4 = 1 and rental_id % 5 = 0) or
              (month(rental_date) % 4 = 2 and rental_id % 7 = 0 and total_cost is not null))
            over (partition by date_trunc('month', rental_date)), false) then 2 else 1 end as written_by
        from fact_rentals""",
    "fact_date_keys_outside": """
        with moved as (select rental_id,
            rental_date + cast((rental_id % 3 - 1) * 3653 as int) as rental_date,
            actual_return_date + cast((rental_id % 3 - 1) * 3653 as int) as actual_return_date
          from t_rentals)
        select rental_id, rental_date, actual_return_date,
          (select date_key from dim_date where full_date = rental_date) as rental_date_key,
          (select date_key from dim_date where full_date = actual_return_date)
            as actual_return_date_key
        from moved""",
    "fact_date_keys": """
        select rental_id, rental_date, actual_return_date, rental_date_key, actual_return_date_key
        from fact_rentals""",
    "fact_payments": """
        select rental_id, total_paid, payment_count, unique_payment_methods from rentals_paid""",
    "fact_duration": """
        select rental_id, rental_date, actual_return_date,
          cast(date_diff('day', rental_date, actual_return_date) as int) as duration_days
        from t_rentals""",
    "check_gold_keys": _gold_checks(),
    "check_gold_keys_broken": _gold_checks().replace("from fact_rentals", "from broken_fact"),
    "report_tariffs": f"""
        select tariff_name, base_price_per_day, count(*) as rentals_count,
          {_money('sum(total_cost)')} as total_revenue, {_money('sum(total_paid)')} as received_payments
        from fact_rentals join dim_tariff using (tariff_key) group by 1, 2""",
    "report_top_cars": f"""
        select brand, model, license_plate, daily_rental_price, count(*) as rentals_count,
          {_money('sum(total_cost)')} as total_revenue
        from fact_rentals join dim_car using (car_key) group by 1, 2, 3, 4
        order by total_revenue desc nulls first, brand, model, license_plate, daily_rental_price
        limit 10""",
    "report_brands": """
        select brand, count(*) as rentals_count
        from fact_rentals join dim_car using (car_key) group by 1""",
    "report_top_clients": f"""
        select full_name, city, loyalty_level, count(*) as rentals_count,
          {_money('sum(total_cost)')} as total_revenue
        from fact_rentals join dim_client using (client_key) group by 1, 2, 3
        order by total_revenue desc nulls first, full_name, city, loyalty_level limit 10""",
    "report_client_cities": """
        select city as client_city, count(*) as rentals_count
        from fact_rentals join dim_client using (client_key) group by 1""",
    "report_rentals_by_month": """
        select cast(date_trunc('month', rental_date) as date) as month, count(*) as rentals_count
        from t_rentals group by 1""",
    "report_revenue_by_month": f"""
        select cast(date_trunc('month', rental_date) as date) as month,
          {_money('sum(total_cost)')} as total_revenue from t_rentals group by 1""",
    "report_revenue_null_dates": f"""
        select cast(date_trunc('month', case when rental_id % 4 <> 0 then rental_date end) as date)
          as month, {_money('sum(total_cost)')} as total_revenue from t_rentals group by 1""",
    "report_employees": f"""
        select full_name as employee_name, count(*) as rentals_count,
          {_money('sum(total_cost)')} as total_revenue,
          cast(cast((cast(sum(total_cost) * 100 as hugeint) * 2 + count(total_cost))
            // (2 * count(total_cost)) as decimal(20,0)) * 0.01 as decimal(20,2))
            as average_rental_value
        from fact_rentals join dim_employee using (employee_key) group by 1""",
    "report_month_year_pivot": f"""
        select cast(month(rental_date) as int) as month_number, monthname(rental_date) as month_name,
          {_money('sum(total_cost) filter (where year(rental_date) = 2023)')} as revenue_2023,
          {_money('sum(total_cost) filter (where year(rental_date) = 2024)')} as revenue_2024,
          {_money('sum(total_cost) filter (where year(rental_date) = 2025)')} as revenue_2025
        from t_rentals where year(rental_date) between 2023 and 2025 group by 1, 2""",
    "rate_rentals": """
        with x as (select r.rental_id, r.tariff_id, r.total_cost,
            cast(base_price_per_day * rental_days as decimal(18,2)) as expected_base_cost,
            case when km_driven > km_included_per_day * rental_days
              then km_driven - km_included_per_day * rental_days
              when t.tariff_id is not null then 0 end as expected_additional_km,
            additional_km_price
          from t_rentals r left join t_tariffs t using (tariff_id)),
          y as (select *, cast(expected_additional_km * additional_km_price as decimal(18,2))
            as expected_additional_km_cost from x)
        select rental_id, tariff_id, expected_base_cost,
          cast(expected_additional_km as bigint) as expected_additional_km,
          expected_additional_km_cost,
          cast(expected_base_cost + expected_additional_km_cost as decimal(18,2)) as expected_total_cost,
          total_cost,
          cast(total_cost - expected_base_cost - expected_additional_km_cost as decimal(18,2))
            as billed_difference
        from y""",
    "classify_payments": """
        select payment_id, p.rental_id, amount,
          case when row_number() over (partition by p.rental_id order by payment_id) = 1
            and amount >= deposit_amount * 0.8 then 'Deposit' else 'Rental' end as payment_type,
          payment_type as declared_type
        from t_payments p left join t_rentals r on p.rental_id = r.rental_id""",
    "rental_balance": f"""
        select rental_id, {_PAID_DUE} as amount_due,
          cast(coalesce(p.paid, 0) as decimal(18,2)) as amount_paid,
          cast({_PAID_DUE} - coalesce(p.paid, 0) as decimal(18,2)) as balance
        from t_rentals r left join (select rental_id, sum(amount) as paid from t_payments
          where status = 'Completed' group by 1) p using (rental_id)""",
    "anomaly_counts": f"""
        select 'rentals' as table_name, 'negative_total_cost' as anomaly,
          count(*) filter (where {_num('total_cost')} < 0) as row_count from t_rentals_dirty
        union all select 'payments', 'negative_amount',
          count(*) filter (where {_num('amount')} < 0) from t_payments_dirty
        union all select 'payments', 'zero_amount',
          count(*) filter (where {_num('amount')} = 0) from t_payments_dirty
        union all select 'car_condition', 'negative_cost',
          count(*) filter (where {_num('cost')} < 0) from t_car_condition_dirty
        union all select 'car_condition', 'outlier_cost',
          count(*) filter (where abs({_num('cost')}) > 20000) from t_car_condition_dirty
        union all select 'car_condition', 'missing_repair_date',
          count(*) filter (where {_date('repair_date')} is null) from t_car_condition_dirty
        union all select 'car_condition', 'repaired_without_date',
          count(*) filter (where {_date('repair_date')} is null and lower(is_repaired) = 'true')
          from t_car_condition_dirty""",
    "full_refresh": f"""
        select cast(date_trunc('month', rental_date) as date) as month,
          {_money("sum(cast(cast(total_cost as varchar) as decimal(10,2)))")} as total_revenue
        from c_rentals group by 1""",
}

QUERIES["rate_rentals_large"] = QUERIES["rate_rentals"]

_ALL = {f"t_{v}": views.duckdb_sql(v) for v in views.VIEWS} | RELATIONS
_NAMES = re.compile(r"\b(" + "|".join(sorted(_ALL, key=len, reverse=True)) + r")\b")


def _needed(sql: str, seen: dict[str, None], own: str = "") -> None:
    for name in _NAMES.findall(sql):
        if name != own and name not in seen:
            _needed(_ALL[name], seen, name)
            seen[name] = None


def oracle_sql(key: str) -> str:
    needed: dict[str, None] = {}
    _needed(QUERIES[key], needed)
    if not needed:
        return QUERIES[key]
    ctes = ",\n".join(f"{name} as ({_ALL[name]})" for name in needed)
    return f"with {ctes}\nselect * from ({QUERIES[key]})"
