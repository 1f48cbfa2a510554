from .dims import (
    UNKNOWN_EMPLOYEE_ID,
    UNKNOWN_EMPLOYEE_KEY,
    dim_countries,
    dim_customers,
    dim_date,
    dim_date_as_written,
    dim_date_spanning,
    dim_employees,
    dim_products,
    dim_warehouses,
    with_unknown_employee,
)
from .facts import fact_inventories, fact_sales, fact_sales_of, lines_of, sales_rejects
from .incremental import (
    refresh_countries,
    refresh_customers,
    refresh_dates,
    refresh_employees,
    refresh_inventories,
    refresh_products,
    refresh_sales,
    refresh_sales_rejects,
    refresh_warehouses,
    upsert_facts,
)
from .keys import with_surrogate_key
from .quality import (
    cascade_delete,
    cascade_delete_all,
    duplicate_keys,
    null_counts,
    orphan_count,
    orphan_rows,
    reconcile_contents,
    reconcile_counts,
    width_violations,
)
from .ranking import top_k_with_ties
from .scd import as_of_join, current, mark_holidays, scd2_apply, scd2_init
from .subtotal import subtotal

__all__ = [
    "UNKNOWN_EMPLOYEE_ID",
    "UNKNOWN_EMPLOYEE_KEY",
    "as_of_join",
    "cascade_delete",
    "cascade_delete_all",
    "current",
    "dim_countries",
    "dim_customers",
    "dim_date",
    "dim_date_as_written",
    "dim_date_spanning",
    "dim_employees",
    "dim_products",
    "dim_warehouses",
    "duplicate_keys",
    "fact_inventories",
    "fact_sales",
    "fact_sales_of",
    "lines_of",
    "mark_holidays",
    "null_counts",
    "orphan_count",
    "orphan_rows",
    "reconcile_contents",
    "reconcile_counts",
    "refresh_countries",
    "refresh_customers",
    "refresh_dates",
    "refresh_employees",
    "refresh_inventories",
    "refresh_products",
    "refresh_sales",
    "refresh_sales_rejects",
    "sales_rejects",
    "refresh_warehouses",
    "scd2_apply",
    "scd2_init",
    "subtotal",
    "top_k_with_ties",
    "upsert_facts",
    "width_violations",
    "with_surrogate_key",
    "with_unknown_employee",
]
