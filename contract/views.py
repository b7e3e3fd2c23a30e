"""Rental tables derived from the driver's tables, in SQL that Spark and DuckDB both run.

order = rental, lineitem = payment, part = car, event = car condition, and each
supplier is an employee, a location and a tariff, so that every rental table
grows with the driver's data. Dates are moved by
10 227 days (28 years) into the calendar. Every view is row-local but for the
first and last line of an order, which are aggregates.

``*_dirty`` views hold text only, with faults planted by id; they feed the
cleaning jobs.
"""

from __future__ import annotations

import re

# {hash56(text)} is a 56-bit integer from the MD5 of the text, written per engine.
_HASH = re.compile(r"hash56\((.*?)\)hash56", re.S)
_SPARK_HASH = r"cast(conv(substr(md5(\1), 1, 14), 16, 10) as bigint)"
_DUCKDB_HASH = r"cast('0x' || substr(md5(\1), 1, 14) as bigint)"

SOURCES = ["customer", "supplier", "part", "orders", "lineitem", "events"]

VIEWS = {
    "locations": """
        select s_suppkey + 1 as location_id, concat('NATION_', cast(s_nationkey as string)) as city,
          concat('Street ', cast(s_suppkey as string)) as address,
          concat('+37529', cast(3000000 + s_suppkey as string)) as phone,
          '08:00-20:00' as opening_hours,
          case when s_suppkey % 3 = 0 then 'false' else 'true' end as is_active
        from {supplier}""",
    "tariffs": """
        select s_suppkey + 1 as tariff_id, concat('Tariff ', cast(s_suppkey % 400 as string)) as tariff_name,
          cast(5 + s_suppkey % 520 as decimal(10,2)) as base_price_per_day,
          cast(200 + 100 * (s_suppkey % 5) as int) as km_included_per_day,
          cast(0.70 + 1.20 * (s_suppkey % 9) as decimal(10,2)) as additional_km_price,
          cast(180 + 400 * (s_suppkey % 8) as decimal(10,2)) as deposit_amount,
          cast(1 + s_suppkey % 3 as int) as min_rental_days,
          cast(case when s_suppkey % 2 = 0 then 30 else 60 end as int) as max_rental_days,
          'Standard' as insurance_type, 'Flexible' as cancellation_policy
        from {supplier}""",
    "cars": """
        select p_partkey as car_id, p_brand as brand, p_type as model,
          cast(2008 + p_size % 20 as int) as year, p_name as color,
          concat('AB', cast(p_partkey as string)) as license_plate,
          concat('VIN', cast(p_partkey as string)) as vin,
          cast(p_partkey % 10 + 1 as bigint) as current_location_id,
          date '2018-01-01' + cast(p_partkey % 2000 as int) as purchase_date,
          cast(cast(p_retailprice as decimal(10,2)) * 50 as decimal(10,2)) as purchase_price,
          cast(cast(p_retailprice as decimal(10,2)) - 450 as decimal(10,2)) as daily_rental_price,
          case p_partkey % 3 when 0 then 'Petrol' when 1 then 'Diesel' else 'Hybrid' end as fuel_type,
          case when p_partkey % 2 = 0 then 'Automatic' else 'Manual' end as transmission,
          cast(4 + p_partkey % 2 as int) as seats,
          case p_partkey % 4 when 0 then 'Available' when 1 then 'Rented'
            when 2 then 'Maintenance' else 'Reserved' end as status,
          cast(p_size * 3000 as int) as mileage
        from {part}""",
    "customers": """
        select c_custkey as customer_id, c_mktsegment as first_name, c_name as last_name,
          upper(concat(c_name, '@EXAMPLE.COM')) as email,
          concat('+37529', cast(1000000 + c_custkey as string)) as phone,
          date '1950-01-01' + cast((c_custkey * 13) % 25000 as int) as date_of_birth,
          concat('AB', cast(c_custkey % 1000 as string)) as driving_license,
          date '2012-01-01' + cast(c_custkey % 3000 as int) as license_issue_date,
          date '2026-01-01' + cast(c_custkey % 1500 as int) as license_expiry_date,
          concat('Street ', cast(c_custkey % 100 as string)) as address,
          concat('NATION_', cast(c_nationkey as string)) as city,
          date '2020-01-01' + cast(c_custkey % 1500 as int) as registration_date,
          case c_custkey % 4 when 0 then 'Bronze' when 1 then 'Silver'
            when 2 then 'Gold' else 'Platinum' end as loyalty_level
        from {customer}""",
    "employees": """
        select s_suppkey as employee_id, concat('First', cast(s_suppkey % 12 as string)) as first_name,
          concat('Last', cast(s_suppkey % 7 as string)) as last_name,
          concat(s_name, '@rental.example') as email,
          concat('+37529', cast(2000000 + s_suppkey as string)) as phone,
          case s_suppkey % 4 when 0 then 'Rental Agent' when 1 then 'Manager'
            when 2 then 'Support Agent' else 'Car Inspector' end as position,
          date '2019-01-01' + cast(s_suppkey % 2000 as int) as hire_date,
          cast(s_acctbal as decimal(10,2)) as salary,
          s_suppkey + 1 as location_id,
          case when s_suppkey % 2 = 0 then 'true' else 'false' end as is_active
        from {supplier}""",
    # Lines have no key of their own, so the id is a hash of the line, led by its
    # number within the order: it needs no numbering, and the lowest id is the first line.
    "payment_lines": """
        select l_linenumber * cast(72057594037927936 as bigint) + hash56(concat_ws('|',
            cast(l_orderkey as string), cast(l_partkey as string), cast(l_suppkey as string),
            cast(cast(floor(l_quantity) as bigint) as string),
            cast(cast(floor(l_extendedprice * 100 + 0.5) as bigint) as string),
            cast(cast(floor(l_discount * 100 + 0.5) as bigint) as string),
            cast(cast(floor(l_tax * 100 + 0.5) as bigint) as string),
            l_returnflag, l_linestatus, cast(cast(l_shipdate as date) as string)))hash56
          as payment_id, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
          l_returnflag, l_linestatus, l_shipdate
        from {lineitem}""",
    # Line number and key in one integer (40 bits for the key): the least one gives the
    # lowest part or supplier of the first line, the greatest one that of the last line.
    "order_lines": """
        select l_orderkey,
          min(l_linenumber * 1099511627776 + l_partkey) % 1099511627776 as first_part,
          min(l_linenumber * 1099511627776 + l_suppkey) % 1099511627776 as first_supplier,
          max(l_linenumber * 1099511627776 + l_suppkey) % 1099511627776 as last_supplier
        from {lineitem} group by l_orderkey""",
    # Some rentals have no tariff; orders without lines have no car, employee or location.
    "rentals": """
        select o_orderkey as rental_id, first_part as car_id, o_custkey as customer_id,
          first_supplier as employee_id,
          case when o_orderkey % 79 <> 0 then last_supplier + 1 end as tariff_id,
          first_supplier + 1 as pickup_location_id, last_supplier + 1 as return_location_id,
          cast(o_orderdate as date) + 10227 as rental_date,
          cast(o_orderdate as date) + cast(10227 + o_orderkey % 30 + 1 as int) as scheduled_return_date,
          cast(o_orderdate as date) + cast(10227 + o_orderkey % 30 + 1 + (o_orderkey % 37) % 6 - 2 as int)
            as actual_return_date,
          cast(o_orderkey % 30 + 1 as int) as rental_days,
          cast(50 + (o_orderkey * 31) % 9000 as int) as km_driven,
          cast((o_orderkey * 7) % 400 as int) as additional_km,
          cast(cast(o_totalprice as decimal(10,2)) * 0.9 as decimal(10,2)) as base_cost,
          cast(cast(o_totalprice as decimal(10,2))
            - cast(cast(o_totalprice as decimal(10,2)) * 0.9 as decimal(10,2)) as decimal(10,2))
            as additional_km_cost,
          cast(o_totalprice as decimal(10,2)) as total_cost,
          cast(cast(o_totalprice as decimal(10,2)) * 0.2 as decimal(10,2)) as deposit_amount,
          cast(cast(o_totalprice as decimal(10,2)) * (0.1 + 0.05 * (o_orderkey % 4)) as decimal(10,2))
            as deposit_returned,
          case o_orderstatus when 'F' then 'Completed' when 'O' then 'Active' else 'Cancelled' end
            as status,
          case when o_orderkey % 5 = 0 then null else o_orderpriority end as notes
        from {orders} left join {order_lines} on o_orderkey = l_orderkey""",
    "payments": """
        select payment_id, l_orderkey as rental_id, cast(l_shipdate as date) + 10227 as payment_date,
          case l_returnflag when 'A' then 'Credit Card' when 'N' then 'Cash' else 'Bank Transfer' end
            as payment_method,
          cast(l_extendedprice as decimal(10,2)) as amount,
          case when l_linenumber = 1 then 'Deposit' else 'Rental' end as payment_type,
          case l_linestatus when 'F' then 'Completed' else 'Pending' end as status
        from {payment_lines}""",
    "car_condition": """
        select event_id as condition_id, user_id as car_id, ts as entry_date,
          case when event_type = 'error' then 'Damage' else 'Maintenance' end as entry_type,
          event_type as description, cast(value as decimal(10,2)) as cost,
          case event_id % 3 when 0 then 'Customer' when 1 then 'Employee' else 'System' end as reported_by,
          case when event_id % 2 = 0 then 'true' else 'false' end as is_repaired,
          case when event_id % 2 = 0 then cast(ts as date) + cast(event_id % 15 - 1 as int) end
            as repair_date, props as notes
        from {events}""",
    "locations_dirty": """
        select cast(location_id as string) as location_id, city, address, phone, opening_hours,
          case when location_id % 4 = 0 then null else is_active end as is_active
        from {locations}""",
    "cars_dirty": """
        select cast(car_id as string) as car_id, brand, model,
          case when car_id % 41 = 0 then 'n/k' when car_id % 43 = 0 then null
            else cast(year as string) end as year, color, license_plate, vin,
          cast(current_location_id as string) as current_location_id,
          case when car_id % 37 = 0 then '2024-02-30' else cast(purchase_date as string) end
            as purchase_date,
          case when car_id % 31 = 0 then null when car_id % 29 = 0 then '900000'
            else cast(purchase_price as string) end as purchase_price,
          case when car_id % 23 = 0 then null
            when car_id % 19 = 0 then concat('-', cast(daily_rental_price as string))
            when car_id % 17 = 0 then '3' else cast(daily_rental_price as string) end
            as daily_rental_price,
          fuel_type, transmission, cast(seats as string) as seats,
          case when car_id % 13 = 0 then null else status end as status,
          case when car_id % 11 = 0 then '3.7' when car_id % 7 = 0 then '-20'
            when car_id % 53 = 0 then '900000' else cast(mileage as string) end as mileage
        from {cars}""",
    "customers_dirty": """
        select cast(customer_id as string) as customer_id, first_name, last_name,
          case when customer_id % 17 = 0 then null else email end as email, phone,
          case when customer_id % 19 = 0 then null when customer_id % 23 = 0 then '2020-01-01'
            else cast(date_of_birth as string) end as date_of_birth,
          case when customer_id % 29 = 0 then null when customer_id % 31 = 0 then 'AB77'
            when customer_id % 3 = 0 then concat('X', cast(customer_id as string))
            else driving_license end as driving_license,
          cast(license_issue_date as string) as license_issue_date,
          case when customer_id % 37 = 0 then 'soon' else cast(license_expiry_date as string) end
            as license_expiry_date,
          address, city, cast(registration_date as string) as registration_date, loyalty_level
        from {customers}""",
    "employees_dirty": """
        select cast(employee_id as string) as employee_id, first_name, last_name,
          case when employee_id % 7 = 0 then null else email end as email, phone, position,
          case when employee_id % 9 = 0 then 'x' else cast(hire_date as string) end as hire_date,
          case when employee_id % 5 = 0 then null else cast(salary as string) end as salary,
          cast(location_id as string) as location_id,
          case when employee_id % 11 = 0 then null else is_active end as is_active
        from {employees}""",
    "tariffs_dirty": """
        select cast(tariff_id as string) as tariff_id, tariff_name,
          case when tariff_id % 11 = 2 then null else cast(base_price_per_day as string) end
            as base_price_per_day,
          case when tariff_id % 7 = 3 then 'many' else cast(km_included_per_day as string) end
            as km_included_per_day,
          cast(additional_km_price as string) as additional_km_price,
          case when tariff_id % 5 = 4 then '-50' else cast(deposit_amount as string) end as deposit_amount,
          cast(min_rental_days as string) as min_rental_days,
          case when tariff_id % 5 = 0 then '1' else cast(max_rental_days as string) end as max_rental_days,
          insurance_type, cancellation_policy
        from {tariffs}""",
    "rentals_dirty": """
        select cast(rental_id as string) as rental_id, cast(car_id as string) as car_id,
          cast(customer_id as string) as customer_id, cast(employee_id as string) as employee_id,
          cast(tariff_id as string) as tariff_id,
          cast(pickup_location_id as string) as pickup_location_id,
          cast(return_location_id as string) as return_location_id,
          cast(rental_date as string) as rental_date,
          case when rental_id % 101 = 0 then cast(rental_date + (-3) as string)
            when rental_id % 103 = 0 then null else cast(scheduled_return_date as string) end
            as scheduled_return_date,
          case when rental_id % 97 = 0 then null when rental_id % 89 = 0 then 'later'
            else cast(actual_return_date as string) end as actual_return_date,
          case when rental_id % 47 = 0 then null when rental_id % 83 = 0 then '0'
            else cast(rental_days as string) end as rental_days,
          case when rental_id % 43 = 0 then null else cast(km_driven as string) end as km_driven,
          case when rental_id % 41 = 0 then null else cast(additional_km as string) end as additional_km,
          cast(base_cost as string) as base_cost,
          case when rental_id % 59 = 0 then null else cast(additional_km_cost as string) end
            as additional_km_cost,
          case when rental_id % 50 = 0 then concat('-', cast(total_cost as string))
            when rental_id % 53 = 0 then 'abc' when rental_id % 59 = 0 then null
            else cast(total_cost as string) end as total_cost,
          case when rental_id % 61 = 0 then null else cast(deposit_amount as string) end as deposit_amount,
          case when rental_id % 67 = 0 then '-5' when rental_id % 71 = 0 then null
            else cast(deposit_returned as string) end as deposit_returned,
          case when rental_id % 73 = 0 then null else status end as status, notes
        from {rentals}""",
    "payments_dirty": """
        select cast(payment_id as string) as payment_id, cast(rental_id as string) as rental_id,
          case when payment_id % 97 = 0 then '' else cast(payment_date as string) end as payment_date,
          case when payment_id % 31 = 0 then null else payment_method end as payment_method,
          case when rental_id % 29 = 0 and payment_type = 'Deposit' then null
            when rental_id % 37 = 0 then concat('-', cast(amount as string))
            when rental_id % 41 = 0 then '0' else cast(amount as string) end as amount,
          case when payment_id % 23 = 0 then null else payment_type end as payment_type,
          case when payment_id % 19 = 0 then null else status end as status
        from {payments}""",
    "car_condition_dirty": """
        select cast(condition_id as string) as condition_id, cast(car_id as string) as car_id,
          cast(date_trunc('second', entry_date) as string) as entry_date,
          case when condition_id % 13 = 0 then null else entry_type end as entry_type,
          case when condition_id % 17 = 0 then null else description end as description,
          case when condition_id % 19 = 0 then null
            when condition_id % 23 = 0 then concat('-', cast(cost as string))
            when condition_id % 29 = 0 then '99999' else cast(cost as string) end as cost,
          case when condition_id % 31 = 0 then null else reported_by end as reported_by, is_repaired,
          case when condition_id % 37 = 0 then '' else cast(repair_date as string) end as repair_date,
          notes
        from {car_condition}""",
    # The rental tables with broken keys: payments numbered by line (not unique),
    # rentals and cars that point to missing parents.
    "payments_broken": """
        select case when l_orderkey % 500 <> 0 then l_orderkey * 8 + l_linenumber end as payment_id,
          case when l_orderkey % 300 = 0 then -l_orderkey - 1 else l_orderkey end as rental_id
        from {lineitem}""",
    "rentals_broken": """
        select case when rental_id % 900 = 1 then null else rental_id end as rental_id,
          case when rental_id % 400 = 0 then -rental_id - 1 else car_id end as car_id,
          customer_id, employee_id,
          case when rental_id % 3 = 0 then -99 else tariff_id end as tariff_id,
          pickup_location_id, return_location_id
        from {rentals}""",
    "cars_broken": """
        select car_id, case when car_id % 50 = 0 then -77 else current_location_id end
          as current_location_id
        from {cars}""",
    "flags": """
        select condition_id,
          case condition_id % 9 when 0 then 'T' when 1 then 'Yes' when 2 then '0' when 3 then 'maybe'
            when 4 then null when 5 then 'FALSE' when 6 then 'y' when 7 then 'n' else '1' end as word
        from {car_condition}""",
}


def sources_of(view: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", VIEWS[view])


def spark_sql(view: str) -> str:
    return _HASH.sub(_SPARK_HASH, VIEWS[view])


def duckdb_sql(view: str) -> str:
    """The view's SQL; derived views are named ``t_*``, driver tables as they are."""
    names = {s: s if s in SOURCES else f"t_{s}" for s in sources_of(view)}
    return _HASH.sub(_DUCKDB_HASH, VIEWS[view]).format(**names)
