"""SQL counterparts of the profiling, cleaning and validation queries over the untidy raw tables."""

from __future__ import annotations

from checks.oracle import BASE, pct

FORMAT = "'%Y-%m-%d %H:%M:%S'"


def _stamp(expr: str) -> str:
    return f"strftime({expr}, {FORMAT})"


def _later(expr: str, days: str) -> str:
    return f"{expr} + to_days(CAST({days} AS INTEGER))"


# The columns of the raw datasets, and those that identify a row.
COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                    "freight_value"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                 "product_width_cm"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}
KEYS = {
    "customers": ["customer_id"], "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"], "products": ["product_id"],
    "category_translation": ["product_category_name"],
}
CLEANED = ("customers", "orders", "order_items", "payments", "products")

RAW = f"""
raw_customers AS (
  SELECT * EXCLUDE (k) FROM (
    SELECT c_custkey AS k, CASE WHEN c_custkey % 101 <> 7 THEN 'C' || c_custkey END AS customer_id,
           'U' || (c_custkey // 2) AS customer_unique_id,
           CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey % 10000 AS VARCHAR)
                ELSE lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS customer_zip_code_prefix,
           CASE WHEN c_custkey % 2 = 0 THEN '  ' || upper(c_mktsegment) || '  TOWN '
                ELSE lower(c_mktsegment) || ' town' END AS customer_city,
           CASE WHEN c_custkey % 3 = 0 THEN ' ' || lower(n_name) ELSE n_name END AS customer_state
    FROM customer JOIN nation ON c_nationkey = n_nationkey
  ), (VALUES (1), (2)) AS copies(i) WHERE i = 1 OR k % 10 = 0
),
raw_orders AS (
  SELECT * EXCLUDE (k) FROM (
    SELECT order_id AS k, CASE WHEN order_id % 499 <> 3 THEN 'O' || order_id END AS order_id,
           'C' || customer_id AS customer_id,
           CASE WHEN order_id % 4 = 0 THEN ' ' || upper(status) || ' ' ELSE status END AS order_status,
           CASE WHEN order_id % 211 = 5 THEN 'not a date' ELSE {_stamp('bought_at')} END AS order_purchase_timestamp,
           CASE WHEN order_id % 97 <> 0 THEN {_stamp(_later('bought_at', 'order_id % 3'))} END AS order_approved_at,
           {_stamp(_later('bought_at', 'order_id % 7 - 1'))} AS order_delivered_carrier_date,
           CASE WHEN order_id % 13 <> 0 THEN {_stamp(_later('bought_at', 'order_id % 11 - 1'))} END
             AS order_delivered_customer_date,
           {_stamp(_later('bought_at', '20'))} AS order_estimated_delivery_date
    FROM bought
  ), (VALUES (1), (2)) AS copies(i) WHERE i = 1 OR k % 20 = 0
),
raw_order_items AS (
  SELECT * EXCLUDE (k) FROM (
    SELECT product_id AS k, 'O' || order_id AS order_id,
           CASE WHEN product_id % 97 = 0 THEN 'x' ELSE CAST(item_id AS VARCHAR) END AS order_item_id,
           'P' || product_id AS product_id, 'S' || seller_id AS seller_id,
           {_stamp('ship_limit')} AS shipping_limit_date,
           CASE WHEN product_id % 50 = 0 THEN '-' || CAST(price_c / 100.0 AS DECIMAL(18,2))
                WHEN product_id % 53 = 0 THEN 'abc' WHEN product_id % 59 = 1 THEN '-0.004'
                WHEN product_id % 61 = 1 THEN '0.004' WHEN product_id % 67 = 1 THEN '10.005'
                WHEN product_id % 71 = 1 THEN '123456789.5'
                ELSE CAST(CAST(price_c / 100.0 AS DECIMAL(18,2)) AS VARCHAR) END AS price,
           CASE WHEN product_id % 7 = 0 THEN '0' WHEN product_id % 73 = 1 THEN '0.004'
                ELSE CAST(CAST(freight_c / 100.0 AS DECIMAL(18,2)) AS VARCHAR) END AS freight_value
    FROM lines
  ), (VALUES (1), (2)) AS copies(i) WHERE i = 1 OR k % 100 = 1
),
raw_payments AS (
  SELECT 'O' || event_id AS order_id, CAST(user_id % 4 + 1 AS VARCHAR) AS payment_sequential,
         CASE user_id % 3 WHEN 0 THEN ' Credit_Card' WHEN 1 THEN 'boleto' ELSE 'not_defined' END AS payment_type,
         CAST(user_id % 7 AS VARCHAR) AS payment_installments,
         CASE WHEN user_id % 37 = 1 THEN '-5.00' WHEN user_id % 41 = 2 THEN '0'
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS payment_value
  FROM events WHERE event_type = 'purchase'
),
raw_products AS (
  SELECT 'P' || p_partkey AS product_id,
         CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN ' ' || upper(p_brand) || ' '
              ELSE lower(p_brand) END AS product_category_name,
         p_size || '.5' AS product_name_lenght, CAST(p_size * 10 AS VARCHAR) AS product_description_lenght,
         CASE WHEN p_partkey % 61 = 0 THEN 'many' ELSE CAST(p_partkey % 4 AS VARCHAR) END AS product_photos_qty,
         CASE WHEN p_partkey % 29 = 0 THEN '0' ELSE CAST(p_size AS VARCHAR) END AS product_weight_g,
         CAST(p_size AS VARCHAR) AS product_length_cm, CAST(p_size AS VARCHAR) AS product_height_cm,
         CASE WHEN p_partkey % 31 <> 0 THEN CAST(p_size - 1 AS VARCHAR) END AS product_width_cm
  FROM part
),
raw_category_translation AS (
  SELECT DISTINCT lower(p_brand) AS product_category_name, 'English ' || lower(p_brand) AS product_category_name_english
  FROM part WHERE p_brand NOT IN ('Brand#13', 'Brand#7')
)
"""


def _fold(column: str, case: str = "lower") -> str:
    return f"{case}(trim(regexp_replace({column}, '\\s+', ' ', 'g')))"


def _moment(column: str) -> str:
    return f"try_strptime({column}, {FORMAT})"


def _amount(column: str) -> str:
    """The number as written; rows are tested on it before it is rounded."""
    return f"try_cast({column} AS DECIMAL(38,18))"


def _fitted(column: str) -> str:
    return f"try_cast({column} AS DECIMAL(10,2))"


def _whole(column: str) -> str:
    return f"CAST(round_even(try_cast({column} AS DOUBLE), 0) AS BIGINT)"


def _distinct(table: str) -> str:
    """Raw rows without identical copies, with the number of copies."""
    names = ", ".join(COLUMNS[table])
    keyed = " AND ".join(f"{c} IS NOT NULL" for c in KEYS[table])
    return f"(SELECT {names}, count(*) AS copies, {keyed} AS keyed FROM raw_{table} GROUP BY {names})"


DATES = COLUMNS["orders"][3:]
NUMBERS = {
    "product_name_lenght": "product_name_length", "product_description_lenght": "product_description_length",
    "product_photos_qty": "product_photos_qty", "product_weight_g": "product_weight_g",
    "product_length_cm": "product_length_cm", "product_height_cm": "product_height_cm",
    "product_width_cm": "product_width_cm",
}
MEASURES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
RULES = (
    ("order_approved_at", "order_purchase_timestamp"),
    ("order_delivered_carrier_date", "order_purchase_timestamp"),
    ("order_delivered_customer_date", "order_purchase_timestamp"),
    ("order_delivered_customer_date", "order_delivered_carrier_date"),
)


def _staged() -> str:
    """Cleaned values (c_*) next to the raw ones for every distinct raw row."""
    zip_code = "trim(customer_zip_code_prefix)"
    orders = ", ".join(f"{_moment(c)} AS c_{c}" for c in DATES)
    numbers = ", ".join(f"{_whole(raw)} AS w_{new}" for raw, new in NUMBERS.items())
    return f"""
s_customers AS (
  SELECT *, {_fold('customer_city')} AS c_city, {_fold('customer_state', 'upper')} AS c_state,
         CASE WHEN regexp_full_match({zip_code}, '[0-9]{{1,4}}') THEN lpad({zip_code}, 5, '0') ELSE {zip_code} END AS c_zip,
         keyed AS kept
  FROM {_distinct('customers')}
),
s_orders AS (
  SELECT *, {_fold('order_status')} AS c_status, {orders}, keyed AS kept FROM {_distinct('orders')}
),
s_order_items AS (
  SELECT *, keyed AND NOT coalesce(e_price < 0, FALSE) AND NOT coalesce(e_freight < 0, FALSE) AS kept,
         {_fitted('e_price')} AS c_price, {_fitted('e_freight')} AS c_freight FROM (
    SELECT *, {_whole('order_item_id')} AS c_item, {_amount('price')} AS e_price,
           {_amount('freight_value')} AS e_freight, {_moment('shipping_limit_date')} AS c_limit
    FROM {_distinct('order_items')})
),
s_payments AS (
  SELECT *, CASE WHEN w_installments > 0 THEN w_installments END AS c_installments,
         keyed AND NOT coalesce(e_value < 0, FALSE) AS kept, {_fitted('e_value')} AS c_value FROM (
    SELECT *, {_fold('payment_type')} AS c_type, {_whole('payment_sequential')} AS c_seq,
           {_whole('payment_installments')} AS w_installments, {_amount('payment_value')} AS e_value
    FROM {_distinct('payments')})
),
s_products AS (
  SELECT p.*, t.product_category_name IS NOT NULL AS listed,
         CASE WHEN p.c_category IS NULL THEN 'unknown'
              ELSE coalesce(lower(t.product_category_name_english), p.c_category) END AS c_english, keyed AS kept
  FROM (SELECT *, {_fold('product_category_name')} AS c_category, {numbers} FROM {_distinct('products')}) p
  LEFT JOIN raw_category_translation t ON t.product_category_name = p.c_category
)
"""


def _clean() -> str:
    """The clean tables, typed."""
    dates = ", ".join(f"c_{c} AS {c}" for c in DATES)
    broken = " OR ".join(f"coalesce(c_{later} < c_{earlier}, FALSE)" for later, earlier in RULES)
    numbers = ", ".join(
        f"CASE WHEN w_{n} > 0 THEN w_{n} END AS {n}" if n in MEASURES else f"w_{n} AS {n}" for n in NUMBERS.values()
    )
    return f"""
k_customers AS (
  SELECT customer_id, customer_unique_id, c_zip AS customer_zip_code_prefix, c_city AS customer_city,
         c_state AS customer_state FROM s_customers WHERE kept
),
k_orders AS (
  SELECT order_id, customer_id, c_status AS order_status, {dates}, ({broken}) AS has_invalid_dates
  FROM s_orders WHERE kept
),
k_order_items AS (
  SELECT order_id, c_item AS order_item_id, product_id, seller_id, c_limit AS shipping_limit_date, c_price AS price,
         c_freight AS freight_value FROM s_order_items WHERE kept
),
k_payments AS (
  SELECT order_id, c_seq AS payment_sequential, c_type AS payment_type, c_installments AS payment_installments,
         c_value AS payment_value FROM s_payments WHERE kept
),
k_products AS (
  SELECT product_id, c_category AS product_category_name, {numbers}, c_english AS product_category_name_english
  FROM s_products WHERE kept
)
"""


def _raw(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([BASE, RAW, *more]) + "\n" + body


def _tidy(body: str, *more: str) -> str:
    return _raw(body, _staged(), _clean(), *more)


# ------------------------------------------------------------------ profiles


def _is_date(column: str) -> bool:
    return column.endswith(("date", "timestamp", "_at"))


def _column_profile(table: str, position: int, column: str) -> str:
    source = f"raw_{table}"
    base = (
        f"'{table}' AS dataset, {position} AS position, '{column}' AS column_name, count({column}) AS non_null, "
        f"count(*) - count({column}) AS missing, coalesce({pct(f'count(*) - count({column})', 'count(*)')}, 0) "
        f'AS missing_pct, count(DISTINCT {column}) AS "unique"'
    )
    if _is_date(column):
        parsed = _moment(column)
        return (
            f"SELECT {base}, 'datetime' AS inferred_type, count({column}) - count({parsed}) AS unparseable, "
            f"{_stamp(f'min({parsed})')} AS min_value, {_stamp(f'max({parsed})')} AS max_value FROM {source}"
        )
    if column.endswith("zip_code_prefix"):
        return (
            f"SELECT {base}, 'text' AS inferred_type, 0 AS unparseable, NULL AS min_value, NULL AS max_value FROM {source}"
        )
    number = f"try_cast({column} AS DOUBLE)"
    numeric = f"(count({column}) > 0 AND count({number}) = count({column}))"

    def shown(which: str) -> str:
        value = f"{which}({number})"
        whole = f"format('{{:,}}', CAST({value} AS BIGINT))"
        broken = f"format('{{:,}}', CAST(floor({value}) AS BIGINT)) || substr(printf('%.2f', {value} - floor({value})), 2)"
        return f"CASE WHEN {numeric} THEN CASE WHEN {value} = floor({value}) THEN {whole} ELSE {broken} END END"

    return (
        f"SELECT {base}, CASE WHEN NOT {numeric} THEN 'text' WHEN bool_or(contains({column}, '.')) THEN 'decimal' "
        f"ELSE 'integer' END AS inferred_type, 0 AS unparseable, {shown('min')} AS min_value, "
        f"{shown('max')} AS max_value FROM {source}"
    )


def _profiles() -> str:
    parts = [
        _column_profile(table, i, column)
        for table, columns in COLUMNS.items()
        for i, column in enumerate(columns, 1)
    ]
    return "prof AS (" + " UNION ALL BY NAME ".join(parts) + ")"


def _dataset_profile(table: str) -> str:
    key = KEYS[table]
    names, keys = ", ".join(COLUMNS[table]), ", ".join(key)
    missing = " OR ".join(f"{c} IS NULL" for c in key)
    return (
        f"SELECT '{table}' AS dataset, count(*) AS row_count, {len(COLUMNS[table])} AS column_count, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM raw_{table})) AS duplicate_rows, "
        f"'{keys}' AS primary_key, count(*) FILTER (WHERE {missing}) AS missing_key_rows, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM raw_{table})) AS duplicate_key_rows "
        f"FROM raw_{table}"
    )


def _raw_checks() -> str:
    bought, approved = _moment("order_purchase_timestamp"), _moment("order_approved_at")
    carrier, received = _moment("order_delivered_carrier_date"), _moment("order_delivered_customer_date")
    price, freight, paid = _amount("price"), _amount("freight_value"), _amount("payment_value")
    last = f"(SELECT max({bought}) FROM raw_orders)"

    def where(table: str, condition: str) -> str:
        return f"(SELECT count(*) FROM raw_{table} WHERE {condition})"

    def absent(child: str, key: str, parent: str) -> str:
        known = f"SELECT {key} FROM raw_{parent} WHERE {key} IS NOT NULL"
        # Missing keys count as absent unless the parent misses one as well.
        return (
            f"(SELECT count(*) FROM raw_{child} WHERE ({key} IS NOT NULL AND {key} NOT IN ({known})) OR "
            f"({key} IS NULL AND NOT EXISTS (SELECT 1 FROM raw_{parent} p WHERE p.{key} IS NULL)))"
        )

    def bare(child: str) -> str:
        ids = "SELECT coalesce(order_id, '?') AS id FROM raw_{}"
        return f"(SELECT count(*) FROM ({ids.format('orders')} EXCEPT {ids.format(child)}))"

    checks = [
        ("order_items", "price <= 0", where("order_items", f"{price} <= 0")),
        ("order_items", "freight_value = 0", where("order_items", f"{freight} = 0")),
        ("order_items", "freight_value < 0", where("order_items", f"{freight} < 0")),
        ("order_items", "shipping_limit_date after latest purchase date",
         where("order_items", f"{_moment('shipping_limit_date')} > {last}")),
        ("payments", "payment_value = 0", where("payments", f"{paid} = 0")),
        ("payments", "payment_installments = 0", where("payments", "payment_installments = '0'")),
        ("payments", "payment_type = 'not_defined'", where("payments", "payment_type = 'not_defined'")),
        ("products", "product_weight_g = 0", where("products", "product_weight_g = '0'")),
        ("orders", "approved before purchase", where("orders", f"{approved} < {bought}")),
        ("orders", "handed to carrier before purchase", where("orders", f"{carrier} < {bought}")),
        ("orders", "delivered to customer before purchase", where("orders", f"{received} < {bought}")),
        ("orders", "delivered to customer before handed to carrier", where("orders", f"{received} < {carrier}")),
        ("orders", "orders with no order_items", bare("order_items")),
        ("orders", "orders with no payments", bare("payments")),
        ("order_items", "order_id not in orders", absent("order_items", "order_id", "orders")),
        ("order_items", "product_id not in products", absent("order_items", "product_id", "products")),
        ("payments", "order_id not in orders", absent("payments", "order_id", "orders")),
        ("orders", "customer_id not in customers", absent("orders", "customer_id", "customers")),
        ("customers", "customer_unique_id linked to more than one customer_id",
         "(SELECT count(*) FROM (SELECT 1 FROM raw_customers GROUP BY customer_unique_id "
         "HAVING count(DISTINCT customer_id) > 1))"),
    ]
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{t}' AS dataset, '{c.replace("'", "''")}' AS "check", {n} AS records"""
        for i, (t, c, n) in enumerate(checks, 1)
    )


# ------------------------------------------------------------------ cleaning audit


def _actions() -> dict[str, list[tuple[str, str, bool]]]:
    """Per dataset: label, rows it applies to, and whether it changes values."""
    lost = "{raw} IS NOT NULL AND {new} IS NULL"
    dates = [
        (f"{c}: unparseable dates set to NULL", f"keyed AND {lost.format(raw=c, new=f'c_{c}')}", True) for c in DATES
    ]
    flags = [
        (f"Flag: {later} before {earlier}", f"keyed AND c_{later} < c_{earlier}", False) for later, earlier in RULES
    ]
    any_flag = " OR ".join(f"coalesce(c_{later} < c_{earlier}, FALSE)" for later, earlier in RULES)

    def number(raw: str, new: str) -> tuple[str, str, bool]:
        name = NUMBERS.get(raw, raw)
        return f"{name}: non-numeric values set to NULL", f"keyed AND {lost.format(raw=raw, new=new)}", True

    def fitted(*columns: tuple[str, str]) -> list[tuple[str, str, bool]]:
        rounded = [(f"{n}: rounded to 2 decimals", f"kept AND e_{c} <> c_{c}", True) for n, c in columns]
        large = "{}: values too large for the column set to NULL"
        return rounded + [(large.format(n), f"kept AND e_{c} IS NOT NULL AND c_{c} IS NULL", True) for n, c in columns]

    english = "product_category_name_english"
    # The labels of the audit's actions.
    return {
        "customers": [
            ("customer_city: whitespace/case standardised", "keyed AND customer_city <> c_city", True),
            ("customer_state: whitespace/case standardised", "keyed AND customer_state <> c_state", True),
            ("customer_zip_code_prefix: left-padded to 5 digits",
             "keyed AND c_zip IS DISTINCT FROM customer_zip_code_prefix", True),
        ],
        "orders": [
            ("order_status: whitespace/case standardised", "keyed AND order_status <> c_status", True),
            *dates,
            *flags,
            ("Orders flagged has_invalid_dates (any rule)", f"keyed AND ({any_flag})", False),
        ],
        "order_items": [
            number("order_item_id", "c_item"),
            number("price", "e_price"),
            number("freight_value", "e_freight"),
            ("shipping_limit_date: unparseable dates set to NULL",
             f"keyed AND {lost.format(raw='shipping_limit_date', new='c_limit')}", True),
            ("Rows with negative price / freight_value removed", "keyed AND NOT kept", False),
            ("Info: freight_value = 0 kept (free shipping is plausible)", "kept AND e_freight = 0", False),
            ("Info: shipping_limit_date after 2018 kept (seller SLA date, not used in KPIs)",
             "kept AND year(c_limit) > 2018", False),
            *fitted(("price", "price"), ("freight_value", "freight")),
        ],
        "payments": [
            ("payment_type: whitespace/case standardised", "keyed AND payment_type <> c_type", True),
            number("payment_sequential", "c_seq"),
            number("payment_installments", "w_installments"),
            number("payment_value", "e_value"),
            ("Rows with negative payment_value removed", "keyed AND NOT kept", False),
            ("payment_installments: values <= 0 set to NULL", "kept AND w_installments <= 0", True),
            ("Info: payment_value = 0 kept (e.g. fully voucher-paid)", "kept AND e_value = 0", False),
            ("Info: payment_type = 'not_defined' kept", "kept AND c_type = 'not_defined'", False),
            *fitted(("payment_value", "value")),
        ],
        "products": [
            ("product_category_name: whitespace/case standardised",
             "keyed AND product_category_name <> c_category", True),
            *[number(raw, f"w_{new}") for raw, new in NUMBERS.items()],
            *[(f"{n}: values <= 0 set to NULL", f"keyed AND w_{n} <= 0", True) for n in MEASURES],
            (f"{english}: manual translation used", "FALSE", False),
            (f"{english}: no translation, Portuguese name kept", "keyed AND c_category IS NOT NULL AND NOT listed",
             False),
            (f"{english}: 'unknown' for missing category", "keyed AND c_category IS NULL", False),
        ],
    }


def _action_rows() -> str:
    parts = []
    for table, actions in _actions().items():
        key = ", ".join(KEYS[table])
        lines = [("Columns renamed (snake_case / spelling fixes)", "2")] if table == "products" else []
        lines += [
            ("Exact duplicate rows removed", f"(SELECT CAST(sum(copies - 1) AS BIGINT) FROM s_{table})"),
            (f"Rows with missing primary key ({key}) removed", f"(SELECT count(*) FROM s_{table} WHERE NOT keyed)"),
        ]
        lines += [(label, f"(SELECT count(*) FROM s_{table} WHERE {rows})") for label, rows, _ in actions]
        parts += [
            f"""SELECT '{table}' AS dataset, {i} AS position, '{label.replace("'", "''")}' AS action, {n} AS "rows" """
            for i, (label, n) in enumerate(lines, 1)
        ]
    return " UNION ALL ".join(parts)


def _audit_rows() -> str:
    parts = []
    for table, actions in _actions().items():
        changed = " OR ".join(f"coalesce({rows}, FALSE)" for _, rows, changes in actions if changes)
        parts.append(
            f"SELECT '{table}' AS dataset, CAST(sum(copies) AS BIGINT) AS rows_before, "
            "count(*) FILTER (WHERE kept) AS rows_after, "
            "CAST(sum(copies) - count(*) FILTER (WHERE kept) AS BIGINT) AS rows_removed, "
            f"count(*) FILTER (WHERE kept AND ({changed})) AS rows_modified FROM s_{table}"
        )
    return " UNION ALL ".join(parts)


POLICY = (
    ("all", "primary key columns", "Remove row"),
    ("orders", "order_approved_at", "Keep NULL"),
    ("orders", "order_delivered_carrier_date", "Keep NULL"),
    ("orders", "order_delivered_customer_date", "Keep NULL"),
    ("products", "product_category_name", "Keep NULL"),
    ("products", "product_name_length, product_description_length, product_photos_qty", "Keep NULL"),
    ("products", "product_weight_g, product_length_cm, product_height_cm, product_width_cm", "Keep NULL"),
    ("payments", "payment_installments", "Replace 0 with NULL"),
)


def _policy_rows() -> str:
    parts = []
    for i, (table, columns, decision) in enumerate(POLICY, 1):
        left = "'0'"
        if table != "all":
            counts = [
                f"(SELECT format('{{:,}}', count(*)) FROM k_{table} WHERE {c.strip()} IS NULL)"
                for c in columns.split(",")
            ]
            left = " || ', ' || ".join(counts)
        parts.append(
            f"SELECT {i} AS position, '{table}' AS dataset, '{columns}' AS \"columns\", '{decision}' AS decision, "
            f"{left} AS nulls_after_cleaning"
        )
    return " UNION ALL ".join(parts)


# ------------------------------------------------------------------ validation


def _where(table: str, condition: str) -> str:
    return f"(SELECT count(*) FROM k_{table} t WHERE {condition})"


def _repeats(table: str) -> str:
    key = ", ".join(KEYS[table])
    return f"(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM k_{table})) FROM k_{table})"


def _lacks(table: str, key: str, other: str) -> str:
    return _where(table, f"{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k_{other} x WHERE x.{key} = t.{key})")


REFERENCES = (
    ("orders", "customer_id", "customers"), ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"), ("payments", "order_id", "orders"),
)


def _rules() -> list[tuple[str, str, str, str]]:
    required = [
        ("customers", "customer_unique_id"), ("customers", "customer_state"), ("orders", "customer_id"),
        ("orders", "order_status"), ("orders", "order_purchase_timestamp"),
        ("orders", "order_estimated_delivery_date"), ("order_items", "product_id"), ("order_items", "seller_id"),
        ("order_items", "price"), ("order_items", "freight_value"), ("payments", "payment_type"),
        ("payments", "payment_value"),
    ]
    bought, got = "order_purchase_timestamp", "order_delivered_customer_date"
    states = ", ".join(f"'NATION_{n}'" for n in range(0, 25, 2))
    statuses = "'created', 'approved', 'invoiced', 'processing', 'shipped', 'delivered', 'canceled', 'unavailable'"
    rules = []
    for table in CLEANED:
        key = ", ".join(KEYS[table])
        empty = " OR ".join(f"{c} IS NULL" for c in KEYS[table])
        rules.append((f"Primary key ({key}) is not NULL", table, "critical", _where(table, empty)))
        rules.append((f"Primary key ({key}) is unique", table, "critical", _repeats(table)))
    rules += [(f"Required field {c} is not NULL", t, "critical", _where(t, f"{c} IS NULL")) for t, c in required]
    rules += [(f"{t}.{c} exists in {p}.{c}", t, "critical", _lacks(t, c, p)) for t, c, p in REFERENCES]
    rules += [
        ("price is not negative", "order_items", "critical", _where("order_items", "price < 0")),
        ("freight_value is not negative", "order_items", "critical", _where("order_items", "freight_value < 0")),
        ("payment_value is not negative", "payments", "critical", _where("payments", "payment_value < 0")),
        ("Delivered to customer on/after purchase date", "orders", "critical", _where("orders", f"{got} < {bought}")),
        ("Estimated delivery on/after purchase date", "orders", "critical",
         _where("orders", f"order_estimated_delivery_date < {bought}")),
        ("Orders with inconsistent lifecycle dates (flagged has_invalid_dates)", "orders", "warning",
         _where("orders", "has_invalid_dates")),
        ("Delivered orders missing delivery date", "orders", "warning",
         _where("orders", f"order_status = 'delivered' AND {got} IS NULL")),
        ("Orders without order items (orphan orders)", "orders", "warning", _lacks("orders", "order_id", "order_items")),
        ("Orders without payments", "orders", "warning", _lacks("orders", "order_id", "payments")),
        ("Customers without orders (orphan customers)", "customers", "warning",
         _lacks("customers", "customer_id", "orders")),
        ("Products never ordered (orphan products)", "products", "warning",
         _lacks("products", "product_id", "order_items")),
        ("order_status is a known status", "orders", "warning", _where("orders", f"order_status NOT IN ({statuses})")),
        ("customer_state is a valid Brazilian state", "customers", "warning",
         _where("customers", f"customer_state NOT IN ({states})")),
        ("customer_zip_code_prefix has 5 digits", "customers", "warning",
         _where("customers", "NOT coalesce(regexp_full_match(customer_zip_code_prefix, '[0-9]{5}'), FALSE)")),
        ("payment_type is a known type", "payments", "warning",
         _where("payments", "payment_type NOT IN ('credit_card', 'boleto', 'voucher', 'debit_card')")),
        ("price is greater than zero", "order_items", "warning", _where("order_items", "price = 0")),
        ("payment_value is greater than zero", "payments", "warning", _where("payments", "payment_value = 0")),
        ("Product has a category", "products", "warning", _where("products", "product_category_name IS NULL")),
    ]
    return rules


def _constraints() -> list[tuple[str, str, str, str]]:
    filled = {
        "customers": COLUMNS["customers"],
        "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                   "order_estimated_delivery_date", "has_invalid_dates"],
        "order_items": COLUMNS["order_items"],
        "payments": ["order_id", "payment_sequential", "payment_type", "payment_value"],
        "products": ["product_id", "product_category_name_english"],
    }
    lengths = {
        "customers": {"customer_id": 32, "customer_unique_id": 32, "customer_zip_code_prefix": 5,
                      "customer_city": 100, "customer_state": 2},
        "orders": {"order_id": 32, "customer_id": 32, "order_status": 20},
        "order_items": {"order_id": 32, "product_id": 32, "seller_id": 32},
        "payments": {"order_id": 32, "payment_type": 20},
        "products": {"product_id": 32, "product_category_name": 100, "product_category_name_english": 100},
    }
    rules = []
    for table in CLEANED:
        rules += [(f"{c} is filled", table, _where(table, f"{c} IS NULL")) for c in filled[table]]
        rules += [
            (f"{c} has at most {n} characters", table, _where(table, f"length({c}) > {n}"))
            for c, n in lengths[table].items()
        ]
        rules.append(("primary key is unique", table, _repeats(table)))
    rules += [(f"{c} refers to {p}", t, _lacks(t, c, p)) for t, c, p in REFERENCES]
    rules += [(f"{c} is positive", "products", _where("products", f"{c} <= 0")) for c in MEASURES]
    rules.append(("payment_installments is positive", "payments", _where("payments", "payment_installments <= 0")))
    rules += [
        (f"{c} fits a small integer", t, _where(t, f"abs({c}) > 32767"))
        for t, c in (("order_items", "order_item_id"), ("payments", "payment_sequential"),
                     ("payments", "payment_installments"))
    ]
    rules += [
        (f"{c} is a valid amount", t, _where(t, f"{c} < 0 OR {c} >= 100000000"))
        for t, c in (("order_items", "price"), ("order_items", "freight_value"), ("payments", "payment_value"))
    ]
    rules += [
        (f"{c} is not before the purchase", "orders", _where("orders", f"{c} < order_purchase_timestamp"))
        for c in ("order_delivered_customer_date", "order_estimated_delivery_date")
    ]
    return [(name, table, "critical", count) for name, table, count in rules]


def _rule_rows(rules: list[tuple[str, str, str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT {i} AS position, '{name}' AS "check", '{table}' AS dataset, '{severity}' AS severity, """
        f"{count} AS record_count"
        for i, (name, table, severity, count) in enumerate(rules, 1)
    )
    return (
        "SELECT *, CASE WHEN record_count = 0 THEN 'PASS' WHEN severity = 'critical' THEN 'FAIL' ELSE 'WARNING' END "
        f"AS status FROM ({rows})"
    )


def statements() -> dict[str, str]:
    bare_moment = ", ".join(f"{_stamp(c)} AS {c}" for c in DATES)
    amount = "CAST({0} AS DOUBLE) AS {0}"
    timestamps = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in DATES[1:4])
    return {
        "profile_datasets": _raw(" UNION ALL ".join(_dataset_profile(t) for t in COLUMNS)),
        "profile_columns": _raw("SELECT * FROM prof", _profiles()),
        "profile_date_ranges": _raw(
            "SELECT dataset, column_name, min_value AS earliest, max_value AS latest, missing, unparseable "
            "FROM prof WHERE inferred_type = 'datetime'",
            _profiles(),
        ),
        "profile_missing_values": _raw(
            "SELECT dataset, column_name, missing, missing_pct FROM prof WHERE missing > 0", _profiles()
        ),
        "raw_status_distribution": _raw(
            f"SELECT order_status, count(*) AS orders, {pct('count(*)', '(SELECT count(*) FROM raw_orders)')} AS pct "
            "FROM raw_orders GROUP BY order_status"
        ),
        "missing_timestamps_by_status": _raw(
            f"SELECT order_status, count(*) AS orders, {timestamps} FROM raw_orders "
            "WHERE order_status IS NOT NULL GROUP BY order_status"
        ),
        "untranslated_categories": _raw(
            "SELECT product_category_name, count(*) AS products FROM raw_products WHERE product_category_name NOT IN "
            "(SELECT product_category_name FROM raw_category_translation) GROUP BY 1"
        ),
        "raw_value_checks": _raw(_raw_checks()),
        "clean_customers": _tidy("SELECT * FROM k_customers"),
        "clean_orders": _tidy(
            f"SELECT order_id, customer_id, order_status, {bare_moment}, has_invalid_dates FROM k_orders"
        ),
        "clean_order_items": _tidy(
            f"SELECT order_id, order_item_id, product_id, seller_id, {_stamp('shipping_limit_date')} "
            f"AS shipping_limit_date, {amount.format('price')}, {amount.format('freight_value')} FROM k_order_items"
        ),
        "clean_payments": _tidy(
            "SELECT order_id, payment_sequential, payment_type, payment_installments, "
            f"{amount.format('payment_value')} FROM k_payments"
        ),
        "clean_products": _tidy("SELECT * FROM k_products"),
        "cleaning_summary": _tidy(_audit_rows()),
        "cleaning_actions": _tidy(_action_rows()),
        "missing_value_report": _tidy(_policy_rows()),
        "validation": _tidy(_rule_rows(_rules())),
        "validation_summary": _tidy(
            "SELECT count(*) FILTER (WHERE status = 'PASS') AS passed, "
            "count(*) FILTER (WHERE status = 'WARNING') AS warnings, "
            "count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) AS checks, "
            "CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAILED' ELSE 'PASSED' END AS overall FROM v",
            f"v AS ({_rule_rows(_rules())})",
        ),
        "publish_constraints": _tidy(_rule_rows(_constraints())),
    }
