"""Named building blocks: source model (s_*) and star (d_*, f_*)."""

from __future__ import annotations

import re

CTES = {
    "s_regions": "select r_regionkey as region_id, r_name as region_name from region",
    "s_countries": """
        select cast(n_nationkey as varchar) as country_id, n_name as country_name, n_regionkey as region_id
        from nation""",
    "s_locations": """
        select s_suppkey as location_id, '1 ' || s_name || ' street' as address,
               case when s_acctbal >= 0 then lpad(cast(s_suppkey as varchar), 6, '0') end as postal_code,
               n_name as city, case when s_suppkey % 4 <> 0 then r_name end as state,
               cast(s_nationkey as varchar) as country_id
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "s_warehouses": "select s_suppkey as warehouse_id, s_name as warehouse_name, s_suppkey as location_id from supplier",
    "s_employees": """
        select s_suppkey as employee_id, split_part(s_name, '#', 1) as first_name,
               split_part(s_name, '#', 2) as last_name, lower(replace(s_name, '#', '.')) || '@example.com' as email,
               '555.' || split_part(s_name, '#', 2) as phone,
               cast(date '1993-01-01' + cast(s_suppkey % 700 as integer) as date) as hire_date,
               case when s_suppkey <> 0 then s_suppkey // 10 end as manager_id,
               'Sales ' || cast(s_suppkey % 5 as varchar) as job_title
        from supplier""",
    "s_products": """
        select p_partkey as product_id, p_name as product_name,
               p_brand || ' size ' || cast(p_size as varchar) as description,
               cast(round(cast(p_retailprice as decimal(9,2)) * (cast(0.70 as decimal(5,3))
                    + cast(p_size as decimal(5,0)) * cast(0.005 as decimal(5,3))), 2) as decimal(9,2)) as standard_cost,
               cast(p_retailprice as decimal(9,2)) as list_price, p_type as category_name
        from part""",
    "s_customers": """
        select c_custkey as customer_id, c_name as name, c_name || ', ' || n_name || ', ' || r_name as address,
               cast(c_acctbal as decimal(8,2)) as credit_limit
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "s_contacts": """
        select c_custkey as contact_id, split_part(c_name, '#', 1) as first_name,
               split_part(c_name, '#', 2) as last_name, c_custkey as customer_id
        from customer where c_acctbal >= 0""",
    "s_orders": """
        select o_orderkey as order_id, o_custkey as customer_id,
               case o_orderstatus when 'F' then 'Shipped' when 'O' then 'Pending' when 'P' then 'Canceled' end as status,
               case when o_orderkey % 3 <> 0 then o_orderkey % 10 end as salesman_id,
               cast(o_orderdate as date) as order_date
        from orders""",
    "s_items": """
        select l_orderkey as order_id, l_linenumber as item_id, l_partkey as product_id,
               cast(l_quantity as decimal(8,2)) as quantity,
               cast(round(cast(p_retailprice as decimal(9,2)) * (1 - cast(l_discount as decimal(4,2))), 2)
                    as decimal(8,2)) as unit_price
        from lineitem join part on l_partkey = p_partkey""",
    "s_inventories": """
        select l_partkey as product_id, l_suppkey as warehouse_id,
               cast(cast(sum(l_quantity) as bigint) % 60 as integer) as quantity
        from lineitem group by l_partkey, l_suppkey""",
    "d_date": """
        select 100001 + cast(calendar_date - first_day as bigint) as date_key, calendar_date,
               cast(dayofweek(calendar_date) + 1 as integer) as day_of_week,
               cast(day(calendar_date) as integer) as day_of_month,
               cast(dayofyear(calendar_date) as integer) as day_of_year,
               case when calendar_date = last_day(calendar_date) then 'Y' else 'N' end as last_day_in_month_ind,
               cast(calendar_date + cast(6 - dayofweek(calendar_date) as integer) as date) as cal_week_end_date,
               cast(weekofyear(calendar_date) as integer) as cal_week_no_in_year,
               rpad(upper(monthname(calendar_date)), 9, ' ') as cal_month_name,
               cast(month(calendar_date) as integer) as cal_month_no_in_year,
               strftime(calendar_date, '%Y-%m') as cal_year_month,
               'Q' || cast(quarter(calendar_date) as varchar) as cal_quarter,
               strftime(calendar_date, '%Y') || 'Q' || cast(quarter(calendar_date) as varchar) as cal_year_quarter,
               cast(year(calendar_date) as integer) as cal_year, 'N' as holiday_ind,
               case when dayofweek(calendar_date) between 1 and 5 then 'Y' else 'N' end as weekday_ind
        from (select first_day, cast(unnest(generate_series(cast(first_day as timestamp), cast(last_day as timestamp),
                                                            interval 1 day)) as date) as calendar_date
              from (select cast(date_trunc('year', min(order_date)) as date) as first_day,
                           cast(date_trunc('year', max(order_date)) + interval 1 year - interval 1 day as date) as last_day
                    from s_orders) span) days""",
    "d_products": """
        select 1000 + row_number() over (order by product_id) as product_key, product_id,
               upper(product_name) as product_name, upper(description) as product_description,
               upper(category_name) as product_category
        from s_products""",
    "d_customers": """
        select 10000000 + row_number() over (order by customer_id) as customer_key, customer_id,
               upper(name) as customer_name, coalesce(upper(first_name), 'UNDEFINED') as first_name,
               coalesce(upper(last_name), 'UNDEFINED') as last_name, upper(address) as address, credit_limit,
               if(coalesce(last_order >= date '2000-12-31', false), 'ACTIVE', 'INACTIVE') as customer_status,
               nullif(regexp_extract(upper(address), '^[^,]*,[^,]*,(.*)$', 1), '') as customer_geography
        from s_customers left join s_contacts using (customer_id)
             left join (select customer_id, max(order_date) as last_order from s_orders group by customer_id)
                  using (customer_id)""",
    "d_countries": """
        select 100 + row_number() over (order by country_id) as country_key, country_id,
               upper(country_name) as country_name, upper(region_name) as region_name
        from s_countries join s_regions using (region_id)""",
    "d_warehouses": """
        select 10000 + row_number() over (order by warehouse_id) as warehouse_key, warehouse_id,
               upper(warehouse_name) as warehouse_name, upper(address) as address, upper(postal_code) as postal_code,
               upper(city) as city, coalesce(upper(state), upper(city)) as state, country_key
        from s_warehouses join s_locations using (location_id) join d_countries using (country_id)""",
    "d_employees": """
        select 1000000 + row_number() over (order by employee_id) as employee_key, employee_id,
               upper(first_name) as first_name, upper(last_name) as last_name, email, upper(phone) as phone, hire_date,
               cast(date '2001-12-31' - hire_date as bigint) as no_of_days_employed, upper(job_title) as job_title
        from s_employees""",
    "d_employees_all": """
        select * from d_employees union all
        select 9999999, 9999, 'UNDEFINED', 'UNDEFINED', 'UNDEFINED', 'UNDEFINED', null, 0, 'UNDEFINED'""",
    "f_sales_raw": """
        select date_key, product_key, customer_key, employee_key, order_id, upper(status) as order_status, order_date,
               quantity as item_quantity, standard_cost, unit_price, unit_price - standard_cost as unit_profit,
               cast(quantity * unit_price as decimal(18,2)) as order_total_price,
               cast(quantity * (unit_price - standard_cost) as decimal(18,2)) as gross_profit
        from s_items join s_orders using (order_id)
             join (select product_id, standard_cost from s_products) using (product_id)
             join (select product_id, product_key from d_products) using (product_id)
             join (select customer_id, customer_key from d_customers) using (customer_id)
             join (select calendar_date as order_date, date_key from d_date) using (order_date)
             left join (select employee_id as salesman_id, employee_key from d_employees) using (salesman_id)""",
    "f_sales": "select * replace (coalesce(employee_key, 9999999) as employee_key) from f_sales_raw",
    "f_inventories": """
        select product_key, warehouse_key, quantity as inventory_quantity, standard_cost, list_price
        from s_inventories
             join (select product_id, standard_cost, list_price from s_products) using (product_id)
             join (select product_id, product_key from d_products) using (product_id)
             join (select warehouse_id, warehouse_key from d_warehouses) using (warehouse_id)""",
    # Sales with every attribute the reports show.
    "w_sales": """
        select * from f_sales join d_date using (date_key) join d_products using (product_key)
             join (select customer_key, customer_id, customer_name, credit_limit, customer_geography from d_customers)
                  using (customer_key)
             join (select employee_key, employee_id, concat_ws(' ', first_name, last_name) as employee_name, job_title
                   from d_employees_all) using (employee_key)""",
}


def _needs(sql: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", sql)]


def with_ctes(sql: str) -> str:
    """Prefix a statement with the building blocks it names, in dependency order."""
    wanted: set[str] = set()
    todo = _needs(sql)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _needs(CTES[name])
    parts = [f"{name} as ({CTES[name]})" for name in CTES if name in wanted]
    own = re.match(r"\s*with\s+(.*)", sql, flags=re.S)
    if own:
        return "with " + ",\n".join(parts) + ",\n" + own.group(1)
    return "with " + ",\n".join(parts) + "\n" + sql if parts else sql
