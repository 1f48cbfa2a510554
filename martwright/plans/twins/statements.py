"""One statement per registered query."""

from __future__ import annotations

from ...schemas import (
    SOURCE_DDL,
    SOURCE_FOREIGN_KEYS,
    SOURCE_PRIMARY_KEYS,
    STAR_DDL,
    STAR_FOREIGN_KEYS,
    STAR_LIMITS,
    STAR_NULLABLE,
    STAR_PRIMARY_KEYS,
    column_names,
)
from .ctes import with_ctes

_SOURCE = {name: f"s_{name}" for name in SOURCE_DDL} | {
    "order_items": "s_items",
    "product_categories": "(select distinct category_name as category_id, category_name from s_products)",
    "products": "(select *, category_name as category_id from s_products)",
}
_STAR = {name: name.replace("dim_", "d_") for name in STAR_DDL} | {
    "dim_employees": "d_employees_all",
    "sales_fact": "f_sales",
    "inventories_fact": "f_inventories",
}


def _half_up(num: str, den: str, times: int = 1) -> str:
    """round(times * num / den, 2) from whole hundredths, half away from zero."""
    n = f"cast(cast({num} as decimal(30,2)) * 100 as hugeint)"
    d = f"cast(cast({den} as decimal(30,2)) * 100 as hugeint)"
    return f"(cast(sign({n}) * ((abs({n}) * {200 * times} + {d}) // (2 * {d})) as double) / 100)"


def _money(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


def _text(*columns: str) -> str:
    return ", ".join(f"cast({c} as varchar) as {c}" for c in columns)


_DATE_COLUMNS = "* replace (cast(calendar_date as varchar) as calendar_date, cast(cal_week_end_date as varchar) as cal_week_end_date)"
_FACT_MONEY = ["item_quantity", "standard_cost", "unit_price", "unit_profit", "order_total_price", "gross_profit"]
_FACT_COLUMNS = (
    "date_key, product_key, customer_key, employee_key, order_id, order_status, "
    + _text("order_date")
    + ", "
    + _money(*_FACT_MONEY)
)
_CUSTOMER_COLUMNS = "* replace (cast(credit_limit as double) as credit_limit)"
_EMPLOYEE_COLUMNS = "* replace (cast(hire_date as varchar) as hire_date)"


SQL: dict[str, str] = {}

# ---- sources -------------------------------------------------------------------------------------------------

SQL["src_row_counts"] = " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count from {block}" for name, block in _SOURCE.items()
)
_COUNTED_LETTERS = {
    "regions": "region_name", "countries": "country_name", "locations": "address", "warehouses": "warehouse_name",
    "employees": "email", "product_categories": "category_name", "products": "product_name", "customers": "address",
    "contacts": "last_name", "orders": "status", "order_items": "cast(order_id as varchar)",
    "inventories": "cast(product_id as varchar)",
}
SQL["src_load_text"] = " union all ".join(
    f"""
    select '{name}' as table_name, count(*) as loaded, cast(sum(length({_COUNTED_LETTERS[name]})) as bigint) as letters,
           {"count(*) filter (where order_id % 50 = 0)" if name == "orders" else "cast(0 as bigint)"} as rejected
    from {block}"""
    for name, block in _SOURCE.items()
)
SQL["src_parse_dates"] = """
    select order_id, strftime(order_date, '%d-') || upper(strftime(order_date, '%b')) || strftime(order_date, '-%y')
           as date_text, cast(order_date as varchar) as order_date
    from s_orders"""
SQL["src_apply_corrections"] = """
    select product_id, product_name,
           case when category_name = 'SMALL' then description || ' corrected' else description end as description,
           cast(standard_cost as double) as standard_cost,
           cast(case when category_name = 'SMALL' then list_price + 10 else list_price end as double) as list_price
    from s_products"""
SQL["src_append_delta"] = "select * replace (cast(order_date as varchar) as order_date) from s_orders"
SQL["fn_calendar"] = """
    select cast(calendar_date as varchar) as order_date, day_of_week, day_of_month, day_of_year, last_day_in_month_ind,
           cast(cal_week_end_date as varchar) as cal_week_end_date, cal_week_no_in_year, cal_month_name,
           cal_month_no_in_year, cal_year_month, cal_quarter, cal_year_quarter, cal_year, weekday_ind,
           rpad(monthname(calendar_date), 9, ' ') as month_text, strftime(calendar_date, '%Y') as year_text,
           strftime(calendar_date, '%m') as month_digits, strftime(calendar_date, '%d/%m/%Y') as day_text,
           cast(cast(date_trunc('year', calendar_date) as date) as varchar) as year_start,
           cast(cast(calendar_date - interval 12 month as date) as varchar) as year_earlier,
           cast(calendar_date - 1 as varchar) as day_before, cast(calendar_date + 1 as varchar) as next_day,
           cast(calendar_date - cast(date_trunc('year', calendar_date) as date) as integer) as days_since_year_start
    from d_date where calendar_date in (select order_date from s_orders)"""
SQL["fn_text"] = """
    select customer_id, upper(name) as upper_name,
           nullif(regexp_extract(upper(address), '^[^,]*,[^,]*,(.*)$', 1), '') as geography,
           nullif(regexp_extract(upper(address || ',' || name), '^[^,]*,[^,]*,[^,]*,(.*)$', 1), '') as after_third_comma,
           case when address like '%,%,%' then 'Y' else 'N' end as has_two_commas,
           coalesce(first_name, '') || ' ' || coalesce(last_name, '') as contact_name,
           coalesce(first_name, 'UNDEFINED') as first_name, cast(round(credit_limit) as double) as credit_rounded,
           '[' || cast(customer_id as varchar) || '] ' || name as label
    from s_customers left join s_contacts using (customer_id)"""

# ---- dimensions and facts --------------------------------------------------------------------------------------

SQL["dim_surrogate_keys"] = "select order_id, row_number() over (order by order_id) as order_key from s_orders"
SQL["dim_date"] = f"select {_DATE_COLUMNS} from d_date"
SQL["dim_date_as_written"] = f"""
    select {_DATE_COLUMNS[:-1]},
           case when calendar_date >= (select min(calendar_date) from d_date where last_day_in_month_ind = 'Y') then 'Y' end
           as last_day_in_month_ind) from d_date"""
SQL["dim_products"] = "select * from d_products"
SQL["dim_customers"] = f"select {_CUSTOMER_COLUMNS} from d_customers"
SQL["dim_countries"] = "select * from d_countries"
SQL["dim_text_keys"] = "select row_number() over (order by name) as name_key, name, customer_id from s_customers"
SQL["dim_warehouses"] = "select * from d_warehouses"
SQL["dim_employees"] = f"select {_EMPLOYEE_COLUMNS} from d_employees"
SQL["dim_employees_unknown"] = f"select {_EMPLOYEE_COLUMNS} from d_employees_all"
SQL["fact_sales"] = f"select {_FACT_COLUMNS} from f_sales_raw"
SQL["fact_sales_unknown_employee"] = f"select {_FACT_COLUMNS} from f_sales"
SQL["fact_sales_reserved_id"] = f"""
    with sold as (
        select f.* replace (case when o.status = 'Pending' then 1000001 + (select count(*) from s_employees
                                 where employee_id < 9999) else f.employee_key end as employee_key)
        from f_sales f join s_orders o on o.order_id = f.order_id)
    select {_FACT_COLUMNS} from sold"""
SQL["fact_rejects"] = """
    with lines as (
        select order_id, item_id, order_date, customer_id, product_id from s_items join s_orders using (order_id))
    select order_id, item_id, 'date ' || cast(order_date as varchar) || ' has no member' as reject_reason
    from lines where year(order_date) = 1998
    union all
    select order_id, item_id, 'customer ' || cast(customer_id as varchar) || ' has no member'
    from lines where customer_id not in (select customer_id from d_customers where customer_geography <> ' EUROPE')
    union all
    select order_id, item_id, 'product ' || cast(product_id as varchar) || ' has no member'
    from lines where product_id in (select product_id from d_products where product_category = 'ECONOMY')"""
SQL["fact_inventories"] = f"""
    select product_key, warehouse_key, inventory_quantity, {_money("standard_cost", "list_price")} from f_inventories"""

# ---- quality -----------------------------------------------------------------------------------------------------

SQL["dq_duplicate_keys"] = """
    select order_id, item_id, count(*) as row_count from s_items group by order_id, item_id having count(*) > 1"""
SQL["dq_primary_keys"] = " union all ".join(
    f"""select '{table}' as table_name, '{", ".join(pk)}' as key_columns, count(*) as repeated_keys
        from (select 1 from {block} group by {", ".join(pk)} having count(*) > 1)"""
    for blocks, keys in ((_SOURCE, SOURCE_PRIMARY_KEYS), (_STAR, STAR_PRIMARY_KEYS))
    for table, pk in keys.items()
    for block in [blocks[table]]
)
SQL["dq_null_counts"] = " union all ".join(
    f"""select '{table}' as table_name, '{c}' as column_name, count(*) - count({c}) as null_count,
               {"'Y'" if c in STAR_NULLABLE.get(table, ()) else f"if(count(*) = count({c}), 'Y', 'N')"} as valid
        from {_STAR[table]}"""
    for table, ddl in STAR_DDL.items()
    for c in column_names(ddl)
)


def _orphans(blocks: dict[str, str], child: str, column: str, parent: str, parent_column: str) -> str:
    return f"""
    select '{child}.{column}' as reference, count(*) as orphans from {blocks[child]} c
    where c.{column} is not null and not exists (select 1 from {blocks[parent]} p where p.{parent_column} = c.{column})"""


SQL["dq_orphan_rows"] = (
    " union all ".join(
        [_orphans(_SOURCE, *k) for k in SOURCE_FOREIGN_KEYS] + [_orphans(_STAR, *k) for k in STAR_FOREIGN_KEYS]
    )
    + """ union all
    select 'orders.customer_id outside EUROPE', count(*) from s_orders
    where customer_id not in (select customer_id from s_customers where address not like '%, EUROPE')"""
)
SQL["dq_cascade_delete"] = """
    select order_status, count(*) as lines, cast(sum(order_total_price) as double) as sales,
           count(distinct product_key) as products
    from f_sales where product_key not in (select product_key from d_products where product_category = 'ECONOMY')
    group by order_status"""
SQL["dq_cascade_customers"] = """
    with gone as (select customer_id from s_customers where address like '%, EUROPE'),
    gone_orders as (select order_id from s_orders where customer_id in (from gone)),
    gone_members as (select customer_key from d_customers where customer_id in (from gone))
    select 'customers' as table_name, count(*) as row_count from s_customers where customer_id not in (from gone)
    union all select 'contacts', count(*) from s_contacts where customer_id not in (from gone)
    union all select 'orders', count(*) from s_orders where customer_id not in (from gone)
    union all select 'order_items', count(*) from s_items where order_id not in (from gone_orders)
    union all select 'dim_customers', count(*) from d_customers where customer_id not in (from gone)
    union all select 'sales_fact', count(*) from f_sales where customer_key not in (from gone_members)"""
SQL["dq_reconcile_counts"] = " union all ".join(
    f"""select '{loaded}' as table_name, s.n as expected_rows, t.n as actual_rows,
               case when s.n = t.n then 'Y' else 'N' end as matches
        from (select count(*) as n from {source}) s, (select count(*) as n from {block}) t"""
    for loaded, source, block in [
        ("dim_products", "s_products", "d_products"),
        ("dim_customers", "s_customers", "d_customers"),
        ("dim_countries", "s_countries", "d_countries"),
        ("dim_warehouses", "s_warehouses", "d_warehouses"),
        ("dim_employees", "s_employees", "d_employees"),
        ("sales_fact", "s_items", "f_sales"),
        ("inventories_fact", "s_inventories", "f_inventories"),
    ]
)

SQL["dq_reconcile_contents"] = " union all ".join(
    f"""select '{name}' as table_name, (select count(*) from {source}) as expected_rows,
               (select count(*) from {block}) as actual_rows,
               case when exists (select {wanted} from {source} except all select {held} from {block})
                      or exists (select {held} from {block} except all select {wanted} from {source})
                    then 'N' else 'Y' end as same_contents"""
    for name, source, wanted, block, held in [
        ("dim_products", "s_products", "product_id", "d_products", "product_id"),
        ("dim_customers", "s_customers", "customer_id, credit_limit", "d_customers", "customer_id, credit_limit"),
        ("dim_countries", "s_countries", "country_id", "d_countries", "country_id"),
        ("dim_warehouses", "s_warehouses", "warehouse_id", "d_warehouses", "warehouse_id"),
        ("dim_employees", "s_employees", "employee_id, hire_date", "d_employees", "employee_id, hire_date"),
        ("sales_fact", "s_items", "order_id, quantity, unit_price", "f_sales", "order_id, item_quantity, unit_price"),
        ("inventories_fact", "s_inventories", "quantity", "f_inventories", "inventory_quantity"),
        (
            "sales_fact at list prices",
            "(select * from s_items join (select product_id, list_price from s_products) using (product_id))",
            "order_id, quantity, list_price",
            "f_sales",
            "order_id, item_quantity, unit_price",
        ),
    ]
)


def _too_wide(column: str, limit) -> str:
    if isinstance(limit, int):
        return f"length({column}) > {limit}"
    return f"abs({column}) >= {10 ** (limit[0] - limit[1])}"


SQL["dq_width_violations"] = " union all ".join(
    f"""select '{table}' as table_name, '{c}' as column_name, count(*) filter ({_too_wide(c, limit)}) as violations
        from {_STAR[table]}"""
    for table, limits in STAR_LIMITS.items()
    for c, limit in limits.items()
)

# ---- incremental refresh -------------------------------------------------------------------------------------------

SQL["inc_date"] = f"""
    select {_DATE_COLUMNS} from d_date where calendar_date between date '2001-01-01' and date '2001-12-31'"""


def _refreshed(dim: str, key: str, natural: str, old: str) -> str:
    return f"""select * replace ((select max({key}) from {dim} where {old})
                      + row_number() over (order by {natural}) as {key}) from {dim} where not ({old})"""


_OLD_COUNTRY = "region_name <> 'EUROPE'"
_OLD_WAREHOUSE = "country_key in (select country_key from d_countries where region_name <> 'EUROPE')"
SQL["inc_products"] = _refreshed("d_products", "product_key", "product_id", "product_category <> 'PROMO'")
SQL["inc_customers"] = f"""
    select {_CUSTOMER_COLUMNS} from ({_refreshed("d_customers", "customer_key", "customer_id",
                                                 "customer_geography <> ' EUROPE'")})"""
SQL["inc_countries"] = _refreshed("d_countries", "country_key", "country_id", _OLD_COUNTRY)
SQL["inc_warehouses"] = _refreshed("d_warehouses", "warehouse_key", "warehouse_id", _OLD_WAREHOUSE)
SQL["inc_employees"] = f"""
    select {_EMPLOYEE_COLUMNS} from ({_refreshed("d_employees", "employee_key", "employee_id", "job_title <> 'SALES 4'")})"""
SQL["inc_sales"] = f"""
    select {_FACT_COLUMNS} from f_sales
    where order_date > (select max(order_date) from f_sales where order_date < date '2001-01-01')"""
SQL["inc_inventories"] = f"""
    select product_key, warehouse_key, inventory_quantity, {_money("standard_cost", "list_price")} from f_inventories
    where warehouse_key not in (select warehouse_key from d_warehouses where {_OLD_WAREHOUSE})"""
SQL["inc_sales_upsert"] = f"""
    with late as (
        select f.* replace ('SHIPPED' as order_status, cast(f.order_date + 14 as date) as order_date, d.date_key as date_key)
        from f_sales f join d_date d on d.calendar_date = cast(f.order_date + 14 as date)
        where f.order_status = 'PENDING' and year(f.order_date) = 2000)
    select {_FACT_COLUMNS} from late
    union all
    select {_FACT_COLUMNS} from f_sales where not (order_status = 'PENDING' and year(order_date) = 2000)"""
SQL["inc_refresh_all"] = " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count, {amount} as amount, 0 as added_again from {_STAR[name]}"
    for name in STAR_DDL
    for amount in [
        {"sales_fact": "cast(sum(order_total_price) as double)", "inventories_fact": "cast(sum(inventory_quantity) as double)"}.get(
            name, "cast(null as double)"
        )
    ]
)
SQL["inc_products_stream"] = (
    "select * from d_products where product_category <> 'PROMO' union all " + SQL["inc_products"]
)

# ---- slowly changing dimensions ----------------------------------------------------------------------------------------

_HOLIDAYS = """
    select make_date(y, 12, 25) as h from (select cal_year as y from d_date union select cal_year + 1 from d_date)
    union select make_date(y, 1, 1) from (select cal_year as y from d_date union select cal_year + 1 from d_date)"""
SQL["scd1_holidays"] = f"""
    select {_DATE_COLUMNS[:-1]}, case when calendar_date in ({_HOLIDAYS}) then 'Y' else 'N' end as holiday_ind) from d_date"""
SQL["scd1_missing"] = f"""
    select cast(h as varchar) as calendar_date from ({_HOLIDAYS}) where h not in (select calendar_date from d_date)"""
SQL["scd2_init"] = """
    select *, '1999-06-01' as start_date, '9999-12-31' as end_date, 'Y' as products_active_flag from d_products"""

_PRODUCT_VERSIONS = """
    economy as (select * from d_products where product_category = 'ECONOMY'),
    changes as (
        select product_id, date '2001-01-01' as start_date, product_description || ' REV 2' as description from economy
        union all
        select product_id, date '2001-07-01', product_description || ' REV 3' from economy where product_name like 'RED%'),
    opened as (
        select (select max(product_key) from d_products) + row_number() over (order by c.product_id, c.start_date)
                   as product_key,
               p.product_id, p.product_name, c.description as product_description, p.product_category, c.start_date,
               coalesce(cast(lead(c.start_date) over (partition by c.product_id order by c.start_date) - 1 as date),
                        date '9999-12-31') as end_date
        from changes c join d_products p on c.product_id = p.product_id),
    versions as (
        select *, case when end_date = date '9999-12-31' then 'Y' else 'N' end as products_active_flag from opened
        union all
        select p.*, date '1999-06-01',
               case when product_category = 'ECONOMY' then date '2000-12-31' else date '9999-12-31' end,
               case when product_category = 'ECONOMY' then 'N' else 'Y' end
        from d_products p)"""
_VERSION_DATES = "* replace (cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date)"
SQL["scd2_products"] = f"with {_PRODUCT_VERSIONS} select {_VERSION_DATES} from versions"
SQL["scd2_current"] = f"with {_PRODUCT_VERSIONS} select {_VERSION_DATES} from versions where products_active_flag = 'Y'"
SQL["scd2_as_of_join"] = f"""
    with {_PRODUCT_VERSIONS}
    select v.product_id, cast(v.start_date as varchar) as start_date, v.product_description, count(*) as lines,
           cast(sum(i.quantity) as double) as units
    from s_items i join s_orders o on i.order_id = o.order_id
         join versions v on v.product_id = i.product_id and o.order_date <= v.end_date
              and (o.order_date >= v.start_date or v.start_date = date '1999-06-01')
    group by v.product_id, v.start_date, v.product_description"""
SQL["scd2_fact_sales"] = f"""
    with {_PRODUCT_VERSIONS},
    sold as (
        select f.* replace (coalesce(late.product_key, f.product_key) as product_key)
        from f_sales f join d_products p using (product_key)
             left join opened late on late.product_id = p.product_id
                                  and f.order_date between late.start_date and late.end_date)
    select {_FACT_COLUMNS} from sold"""
SQL["scd2_rejects"] = """
    select product_id, '1990-01-01' as start_date, 'start date is not after the current version''s' as reject_reason
    from d_products where product_category = 'ECONOMY' and product_name like 'OLD%'
    union all
    select -1 - product_id, '2001-01-01', 'product_id ' || cast(-1 - product_id as varchar) || ' does not exist'
    from d_products where product_category = 'ECONOMY' and product_name like 'BLUE%'
    union all
    select product_id, '2001-07-01', 'another change of the day was preferred'
    from d_products where product_category = 'ECONOMY' and product_name like 'RED%'"""
SQL["scd2_customers"] = """
    select (select max(customer_key) from d_customers) + row_number() over (order by customer_id) as customer_key,
           customer_id, customer_name, first_name, last_name, address, cast(credit_limit + 500 as double) as credit_limit,
           customer_status, customer_geography, '2001-01-01' as start_date, '9999-12-31' as end_date,
           'Y' as customer_active_flag
    from d_customers where customer_geography = ' EUROPE'
    union all
    select customer_key, customer_id, customer_name, first_name, last_name, address, cast(credit_limit as double),
           customer_status, customer_geography, '1999-06-01',
           case when customer_geography = ' EUROPE' then '2000-12-31' else '9999-12-31' end,
           case when customer_geography = ' EUROPE' then 'N' else 'Y' end
    from d_customers"""
SQL["scd2_employees"] = """
    select (select max(employee_key) from d_employees) + row_number() over (order by employee_id) as employee_key,
           employee_id, first_name, last_name, email, phone, cast(hire_date as varchar) as hire_date,
           cast(date '2002-06-30' - hire_date as bigint) as no_of_days_employed, 'SALES MANAGER' as job_title,
           '2001-01-01' as start_date, '9999-12-31' as end_date, 'Y' as employee_active_flag
    from d_employees where job_title = 'SALES 1'
    union all
    select employee_key, employee_id, first_name, last_name, email, phone, cast(hire_date as varchar),
           no_of_days_employed, job_title, '1999-06-01',
           case when job_title = 'SALES 1' then '2000-12-31' else '9999-12-31' end,
           case when job_title = 'SALES 1' then 'N' else 'Y' end
    from d_employees_all"""

# ---- reports -----------------------------------------------------------------------------------------------------------


def _growth(monthly: str) -> str:
    return f"""
    with monthly as ({monthly}),
    paired as (select *, lag(sales_amount) over (order by month_no) as pre from monthly)
    select upper(monthname(make_date(2000, month_no, 1))) as sales_month, product_category,
           cast(sales_amount as double) as sales_amount, cast(coalesce(pre, 0) as double) as pre_sales_amount,
           coalesce({_half_up("(sales_amount - pre)", "pre", 100)}, 0) as growth,
           case when coalesce(sales_amount - pre, 0) > 0 then 'Improved Performance'
                when coalesce(sales_amount - pre, 0) = 0 then 'Constant Performance'
                else 'Reduced Performance' end as sales_performance
    from paired"""


SQL["rpt_monthly_growth"] = _growth("""
    select cal_month_no_in_year as month_no, product_category, sum(unit_price) as sales_amount
    from w_sales where cal_year = 1998 and product_category = 'ECONOMY' group by all""")
SQL["rpt_monthly_growth_as_written"] = _growth("""
    select days.cal_month_no_in_year as month_no, w_sales.product_category, sum(w_sales.unit_price) as sales_amount
    from w_sales, d_date days where days.cal_year = 1998 and w_sales.product_category = 'ECONOMY' group by all""")

_QUARTERS = ["quarter1", "quarter2", "quarter3", "quarter4"]


def _by_quarter(value: str) -> str:
    return ", ".join(
        f"cast(coalesce(sum({value}) filter (cal_quarter = 'Q{n}'), 0) as double) as quarter{n}" for n in (1, 2, 3, 4)
    )


SQL["rpt_employee_quarterly"] = f"""
    select employee_id, employee_name, job_title, {_by_quarter("order_total_price")},
           cast(sum(item_quantity) as double) as sales_quantity, cast(sum(order_total_price) as double) as sales_amount
    from w_sales where cal_year = 1998 and employee_id <> 9999 group by all"""
_PRODUCT = "product_id, product_name, product_description, product_category, standard_cost"
SQL["rpt_low_margin"] = f"""
    with margins as (
        select {_PRODUCT}, sum(item_quantity) as sales_unit, sum(order_total_price) as sales_revenue,
               sum(gross_profit) as profit
        from w_sales group by {_PRODUCT})
    select * exclude (profit) replace ({_money("standard_cost", "sales_unit", "sales_revenue")}),
           cast(round(profit, 0) as double) as gross_profit, {_half_up("profit", "sales_revenue", 100)} as gross_profit_margin
    from margins where sales_revenue <> 0 and profit / sales_revenue < 0.2"""
SQL["rpt_inventory_status"] = """
    with stock as (
        select format('[{}] {}', country_id, country_name) as country_name, warehouse_id, warehouse_name, product_id,
               product_name, product_category, cast(sum(inventory_quantity) as bigint) as total_inventory_quantity
        from f_inventories join d_products using (product_key) join d_warehouses using (warehouse_key)
             join d_countries using (country_key)
        where warehouse_id = 1 group by all)
    select *, if(total_inventory_quantity < 20, 'Reorder Needed', 'Sufficient Stock') as reorder_level,
           case when total_inventory_quantity <= 0 then 'Out of Stock' when total_inventory_quantity < 10 then 'Low Stock'
                when total_inventory_quantity < 50 then 'Medium Stock' else 'High Stock' end as inventory_status
    from stock"""


def _geo(extra: str) -> str:
    return f"""
    select customer_geography, customer_name, rpad(monthname(order_date), 9, ' ') as month{extra},
           cast(coalesce(sum(item_quantity * unit_price) filter (cal_year = 1998), 0) as double) as revenue,
           cast(coalesce(sum(item_quantity * unit_price) filter (cal_year = 1997), 0) as double) as prev_year_revenue
    from w_sales where cal_year between 1997 and 1998 group by all"""


SQL["rpt_geo_monthly"] = _geo(", cast(cal_year as varchar) as year")
SQL["rpt_geo_monthly_yoy"] = _geo("")
SQL["rpt_annual_category"] = f"""
    select product_category, cal_month_name as sales_month, count(distinct order_id) as num_orders,
           cast(sum(order_total_price) as double) as total_sales, cast(sum(gross_profit) as double) as total_profit,
           {_half_up("sum(order_total_price)", "count(*)")} as avg_sales_amount
    from w_sales where cal_year = 1998 group by product_category, cal_month_name"""
SQL["rpt_cltv_top10"] = f"""
    with history as (
        select customer_id, customer_name, credit_limit, sum(order_total_price) as amount, count(*) as lines,
               count(distinct order_id) as orders, count(distinct order_date) as days,
               cast(max(order_date) - min(order_date) as bigint) as span
        from w_sales where cal_year = 1998 group by customer_id, customer_name, credit_limit),
    valued as (
        select customer_id, customer_name, cast(credit_limit as double) as credit_limit,
               {_half_up("amount", "lines")} as avg_purchase_value_per_year, orders as num_of_purchases_per_year,
               {_half_up("span", "365")} as avg_customer_lifespan,
               {_half_up("amount * orders * span", "lines * days * 365")} as customer_lifetime_value
        from history where orders > 1)
    select cast(rank() over (order by customer_lifetime_value desc) as integer) as ranking, * from valued
    qualify ranking <= 10"""
SQL["rpt_retention"] = """
    with buyers as (
        select customer_geography, product_category, count(distinct customer_key) as total_customers,
               count(distinct customer_key) filter (cal_year = 1997) as acquired_customers,
               count(distinct customer_key) filter (cal_year = 1998 and item_quantity > 0) as retained_customers,
               cast(sum(unit_price) filter (cal_year = 1997) as double) as spent
        from w_sales where cal_year between 1997 and 1998 group by all)
    select * exclude (spent), spent / cast(acquired_customers as double) as cac,
           cast(retained_customers as double) / cast(total_customers as double) * 100 as retention_rate,
           cast(dense_rank() over (partition by customer_geography order by retention_rate desc) as integer) as ranking
    from buyers where acquired_customers > 0 and retained_customers > 0"""
SQL["rpt_employee_performance"] = f"""
    select employee_id, employee_name, job_title, count(*) as order_quantity,
           cast(sum(order_total_price) as double) as sales_amount,
           {_half_up("sum(order_total_price)", "count(*)")} as average_order_value,
           count(distinct customer_id) as new_customers_acquired,
           {_half_up("count(*) filter (order_status = 'SHIPPED')", "count(*)", 100)} as conversion_rate
    from w_sales where employee_id <> 9999 group by employee_id, employee_name, job_title"""
SQL["rpt_top_products"] = f"""
    with year_sales as (
        select {_PRODUCT}, sum(item_quantity) as units, sum(order_total_price) as sales,
               cast(sum(order_total_price - item_quantity * standard_cost) as decimal(30,2)) as profit
        from w_sales where cal_year = 1998 group by {_PRODUCT} order by sales desc, product_id limit 10)
    select * exclude (units, sales, profit) replace ({_money("standard_cost")}), 'ACTIVE' as product_status,
           cast(units as double) as sales_unit, cast(sales as double) as sales_amount,
           cast(profit as double) as sales_profit, {_half_up("profit", "sales", 100)} as profit_contribution
    from year_sales"""
SQL["rpt_market_trend"] = """
    with years as (
        select product_category,
               coalesce(sum(item_quantity) filter (cal_year = 1998), 0) as units,
               coalesce(sum(order_total_price) filter (cal_year = 1998), 0) as sales,
               coalesce(sum(item_quantity) filter (cal_year = 1997), 0) as other_units,
               coalesce(sum(order_total_price) filter (cal_year = 1997), 0) as other_sales
        from w_sales where cal_year between 1997 and 1998 group by product_category),
    trend as (
        select product_category, cast(units as double) as initial_quantity, cast(sales as double) as initial_sales,
               cast(other_units as double) as comparison_quantity, cast(other_sales as double) as comparison_sales,
               cast(other_units - units as double) as quantity_diff,
               if(sales <> 0, cast(100 * (sales - other_sales) as double) / cast(sales as double), null) as percent_diff
        from years)
    select cast(row_number() over (order by percent_diff desc nulls first, product_category) as integer) as ranking, *
    from trend"""
SQL["rpt_product_quarterly"] = f"""
    select product_id, product_name, {_by_quarter("unit_profit")}, cast(sum(item_quantity) as double) as quantity,
           cast(sum(unit_profit) as double) as total_profit, cast(sum(unit_price) as double) as total_revenue
    from w_sales where cal_year = 1998 group by product_id, product_name having bool_or(cal_quarter = 'Q1')"""
SQL["rpt_product_quarterly_all"] = f"""
    select product_id, product_name, {_by_quarter("gross_profit")},
           cast(coalesce(sum(item_quantity), 0) as double) as quantity,
           cast(coalesce(sum(gross_profit), 0) as double) as total_profit,
           cast(coalesce(sum(order_total_price), 0) as double) as total_revenue
    from d_products left join (select * exclude (product_id, product_name) from w_sales where cal_year = 1998)
         using (product_key)
    group by product_id, product_name"""

# ---- subtotals: folds of the report rows --------------------------------------------------------------------------------


def _fold(report: str, sums: list[str], by: str = "", averages: str = "") -> str:
    """Sums of printed values; they are money or counts, so cents stay exact in decimals."""
    folded = [f"cast(sum(cast({c} as decimal(30,2))) as double) as total_{c}" for c in sums]
    head = ", ".join(([by] if by else []) + folded + ([averages] if averages else []))
    return f"select {head} from ({with_ctes(SQL[report])}) r" + (f" group by {by}" if by else "")


def _counts(sql: str, *columns: str) -> str:
    for c in columns:
        sql = sql.replace(f"cast(sum(cast({c} as decimal(30,2))) as double)", f"cast(sum({c}) as bigint)")
    return sql


FOLDS = {
    "sub_monthly_growth": _fold(
        "rpt_monthly_growth",
        ["sales_amount"],
        averages=_half_up("sum(cast(sales_amount as decimal(30,2)))", "count(*)") + " as average_sales_amount",
    ),
    "sub_employee_quarterly": _fold("rpt_employee_quarterly", [*_QUARTERS, "sales_quantity", "sales_amount"]),
    "sub_low_margin": _fold("rpt_low_margin", ["standard_cost", "sales_unit", "sales_revenue", "gross_profit"]),
    "sub_geo_monthly": _fold("rpt_geo_monthly", ["revenue", "prev_year_revenue"], "customer_geography"),
    "sub_annual_category": _counts(
        _fold(
            "rpt_annual_category", ["num_orders", "total_sales", "total_profit", "avg_sales_amount"], "product_category"
        ),
        "num_orders",
    ),
    "sub_cltv": _fold("rpt_cltv_top10", ["avg_purchase_value_per_year"]),
    "sub_retention": _fold(
        "rpt_retention",
        [],
        "customer_geography",
        "round(avg(retention_rate), 6) as average_retention_rate, round(avg(cac), 6) as average_cac",
    ),
    "sub_employee_performance": _counts(
        _fold("rpt_employee_performance", ["order_quantity", "sales_amount"]), "order_quantity"
    ),
    "sub_top_products": _fold("rpt_top_products", ["standard_cost", "sales_unit", "sales_amount", "sales_profit"]),
    "sub_market_trend": _fold("rpt_market_trend", ["initial_sales", "comparison_sales"]),
    "sub_product_quarterly": _fold(
        "rpt_product_quarterly", [*_QUARTERS, "quantity", "total_profit", "total_revenue"]
    ),
}

TWIN_SQL = {name: with_ctes(sql) for name, sql in SQL.items()} | FOLDS
