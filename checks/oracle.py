"""SQL counterparts of the driver queries, written against the star tables.

Money is kept in whole cents and durations in microseconds; every ratio is rounded once, half away from zero, from
whole numbers. `ORDERS` lists one row per order with everything known about it.
"""

from __future__ import annotations

from merchlens.sources.states import STATES


def ratio(num: str, den: str, digits: int = 2) -> str:
    """num / den rounded half away from zero, NULL for an empty denominator."""
    n, d, unit = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10**digits
    steps = f"((abs({n}) * {2 * unit} + abs({d})) // nullif(2 * abs({d}), 0))"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    return f"(CAST({steps} * {sign} AS DOUBLE) / {unit})"


def pct(num: str, den: str) -> str:
    return ratio(f"100 * CAST({num} AS HUGEINT)", den)


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def mean_money(cents: str, count: str) -> str:
    return ratio(cents, f"100 * CAST({count} AS HUGEINT)")


def days(micros: str, count: str) -> str:
    return ratio(micros, f"86400000000 * CAST({count} AS HUGEINT)")


def text_day(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d')"


def text_time(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


def half(value: str) -> str:
    """Rounds half-steps of a cent upwards: exact for halves of whole numbers."""
    return f"(floor({value} + 0.5) / 100)"


BASE = """
states AS (
  SELECT n_name AS state_code, n_name AS state_name, r_name AS macro_region
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
people AS (
  SELECT c_custkey AS customer_id, c_custkey AS person, n_name AS state, n_name AS state_name, r_name AS region,
         CASE WHEN c_custkey % 200 <> 0 THEN lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')
              ELSE CAST(c_custkey % 1000 AS VARCHAR) END AS zip
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
goods AS (
  SELECT p_partkey AS product_id, p_type AS category,
         CASE WHEN p_partkey % 41 <> 0 THEN p_brand END AS source_category,
         CASE WHEN p_partkey % 53 <> 0 THEN p_size END AS weight, p_size AS len, p_size AS high,
         CASE WHEN p_partkey % 59 <> 0 THEN p_size END AS wide
  FROM part
),
lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_shipdate AS ship_limit,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS price_c,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) * 100 AS HUGEINT)
           AS freight_c
  FROM lineitem
),
paid AS (
  SELECT event_id AS order_id, user_id % 4 + 1 AS seq,
         CASE user_id % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto' WHEN 2 THEN 'voucher'
              WHEN 3 THEN 'debit_card' ELSE 'not_defined' END AS kind,
         nullif(user_id % 7, 0) AS installments,
         CAST(CAST(value AS DECIMAL(18,2)) * 100 AS HUGEINT) AS value_c
  FROM events WHERE event_type = 'purchase'
),
shipped AS (
  SELECT l_orderkey AS order_id, max(l_shipdate) AS got,
         min(l_shipdate) FILTER (WHERE l_shipdate >= o_orderdate) AS handed
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
),
bought AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS bought_at,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered'
              WHEN o_orderpriority = '1-URGENT' THEN 'canceled'
              WHEN o_orderpriority = '5-LOW' THEN 'unavailable'
              WHEN o_orderpriority = '2-HIGH' THEN 'shipped'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'processing'
              ELSE 'invoiced' END AS status,
         CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) END AS approved,
         handed, got,
         o_orderdate + to_days(1095) AS due,
         coalesce(got < o_orderdate, FALSE) AS bad
  FROM orders LEFT JOIN shipped ON shipped.order_id = o_orderkey
),
valued AS (
  SELECT order_id, count(*) AS n, sum(price_c) AS prod_c, sum(freight_c) AS freight_c,
         sum(price_c + freight_c) AS value_c
  FROM lines GROUP BY order_id
),
by_cat AS (
  SELECT order_id, category, count(*) AS n, sum(price_c) AS prod_c, sum(price_c + freight_c) AS value_c
  FROM lines JOIN goods USING (product_id) GROUP BY order_id, category
),
main_cat AS (
  SELECT order_id, category FROM by_cat
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY value_c DESC, category) = 1
),
ord AS (
  SELECT b.*, p.person, p.state, p.state_name, p.region, v.n, v.prod_c, v.freight_c, v.value_c, m.category,
         status NOT IN ('canceled', 'unavailable') AS earns,
         status = 'delivered' AND got IS NOT NULL AND NOT bad AS meas,
         CAST(date_trunc('month', bought_at) AS DATE) AS month,
         bought_at >= TIMESTAMP '1996-01-01' AND bought_at < TIMESTAMP '2001-01-01' AS trend,
         CAST(got AS DATE) > CAST(due AS DATE) AS tardy,
         CAST(got AS DATE) - CAST(due AS DATE) AS gap,
         epoch_us(got) - epoch_us(bought_at) AS act,
         epoch_us(due) - epoch_us(bought_at) AS prom,
         epoch_us(approved) - epoch_us(bought_at) AS wait,
         epoch_us(handed) - epoch_us(approved) AS handoff,
         epoch_us(got) - epoch_us(handed) AS transit
  FROM bought b JOIN people p USING (customer_id)
  LEFT JOIN valued v ON v.order_id = b.order_id LEFT JOIN main_cat m ON m.order_id = b.order_id
)
"""

BUCKET = """CASE WHEN gap < -14 THEN '1. More than 14 days early' WHEN gap < -7 THEN '2. 8-14 days early'
 WHEN gap < 0 THEN '3. 1-7 days early' WHEN gap = 0 THEN '4. On estimated day' WHEN gap <= 3 THEN '5. 1-3 days late'
 WHEN gap <= 7 THEN '6. 4-7 days late' WHEN gap > 7 THEN '7. More than 7 days late' END"""


def star(body: str, *more: str) -> str:
    """A statement over the base CTEs plus further ones."""
    return "WITH " + ",\n".join([BASE, *more]) + "\n" + body


def sales() -> dict[str, str]:
    rev = "value_c) FILTER (WHERE earns"
    monthly = "mon AS (SELECT month, sum(value_c) AS r FROM ord WHERE earns AND trend AND n > 0 GROUP BY month)"
    cat = (
        "cat AS (SELECT c.category, count(*) AS o, sum(c.n) AS i, sum(c.value_c) AS r, sum(c.prod_c) AS p "
        "FROM by_cat c JOIN bought b ON b.order_id = c.order_id "
        "WHERE status NOT IN ('canceled', 'unavailable') GROUP BY c.category)"
    )
    period = (
        "per AS (SELECT c.category, count(*) AS o, "
        "coalesce(sum(value_c) FILTER (WHERE bought_at < TIMESTAMP '2000-07-01'), 0) AS p, "
        "coalesce(sum(value_c) FILTER (WHERE bought_at >= TIMESTAMP '2000-07-01'), 0) AS r "
        "FROM by_cat c JOIN bought b ON b.order_id = c.order_id WHERE status NOT IN ('canceled', 'unavailable') "
        "AND bought_at >= TIMESTAMP '2000-01-01' AND bought_at < TIMESTAMP '2001-01-01' GROUP BY c.category),\n"
        "shared AS (SELECT *, sum(p) OVER () AS pa, sum(r) OVER () AS ra FROM per)"
    )
    return {
        "total_revenue": star(
            f"SELECT {money(f'sum({rev})')} AS total_revenue, "
            f"{money('sum(prod_c) FILTER (WHERE earns)')} AS product_revenue, "
            f"{money('sum(freight_c) FILTER (WHERE earns)')} AS freight_revenue, "
            f"{money('sum(value_c) FILTER (WHERE NOT earns)')} AS canceled_order_value, "
            f"{money('sum(value_c)')} AS gross_order_value_all_statuses FROM ord"
        ),
        "total_orders": star(
            "SELECT count(*) AS total_orders, count(*) FILTER (WHERE earns) AS revenue_orders, "
            "count(*) FILTER (WHERE status = 'delivered') AS delivered_orders, "
            "count(*) FILTER (WHERE n IS NULL) AS orders_without_items, "
            "count(DISTINCT person) AS total_customers FROM ord"
        ),
        "monthly_revenue": star(
            f"SELECT {text_day('month')} AS order_month, {money('r')} AS revenue FROM mon", monthly
        ),
        "monthly_revenue_mom": star(
            f"SELECT {text_day('month')} AS order_month, {money('r')} AS revenue, "
            f"{money('before')} AS previous_month_revenue, {money('r - before')} AS revenue_change, "
            f"{pct('r - before', 'before')} AS revenue_change_pct "
            "FROM (SELECT *, lag(r) OVER (ORDER BY month) AS before FROM mon)",
            monthly,
        ),
        "monthly_order_volume": star(
            f"SELECT {text_day('month')} AS order_month, count(*) AS orders_placed, "
            "count(*) FILTER (WHERE earns) AS revenue_orders, "
            "count(*) FILTER (WHERE NOT earns) AS canceled_or_unavailable FROM ord WHERE trend GROUP BY month"
        ),
        "average_order_value": star(
            f"SELECT count(*) AS orders, {mean_money('sum(value_c)', 'count(*)')} AS average_order_value, "
            f"{half('quantile_cont(CAST(value_c AS DOUBLE), 0.5)')} AS median_order_value, "
            f"{money('min(value_c)')} AS min_order_value, {money('max(value_c)')} AS max_order_value "
            "FROM ord WHERE earns AND n > 0"
        ),
        "revenue_by_category": star(
            f"SELECT category AS product_category, o AS orders, CAST(i AS BIGINT) AS items_sold, "
            f"{money('r')} AS revenue, {mean_money('p', 'i')} AS average_item_price FROM cat",
            cat,
        ),
        "top_10_categories": star(
            f"SELECT rank() OVER (ORDER BY r DESC) AS revenue_rank, category AS product_category, "
            f"{money('r')} AS revenue FROM cat QUALIFY revenue_rank <= 10",
            cat,
        ),
        "revenue_by_state": star(
            "SELECT state AS customer_state, o AS orders, c AS customers, "
            f"{money('r')} AS revenue, {pct('r', '(SELECT sum(r) FROM st)')} AS revenue_share_pct FROM st",
            "st AS (SELECT state, count(*) AS o, count(DISTINCT person) AS c, sum(value_c) AS r FROM ord "
            "WHERE earns AND n > 0 GROUP BY state)",
        ),
        "revenue_by_month_category": star(
            f"SELECT {text_day('month')} AS order_month, c.category AS product_category, "
            f"count(DISTINCT c.order_id) AS orders, {money('sum(c.value_c)')} AS revenue "
            "FROM by_cat c JOIN ord ON ord.order_id = c.order_id WHERE earns AND trend GROUP BY month, c.category"
        ),
        "average_freight_cost": star(
            f"SELECT {mean_money('sum(freight_c)', 'sum(n)')} AS average_freight_per_item, "
            f"{mean_money('sum(freight_c)', 'count(*)')} AS average_freight_per_order, "
            f"{pct('sum(freight_c)', 'sum(prod_c)')} AS freight_as_pct_of_product_value "
            "FROM ord WHERE earns AND n > 0"
        ),
        "completed_order_revenue": star(
            f"SELECT {money('a')} AS completed_revenue, {money('b')} AS in_progress_revenue, "
            f"{pct('a', 'a + b')} AS completed_share_pct FROM (SELECT "
            "sum(value_c) FILTER (WHERE status = 'delivered') AS a, "
            "sum(value_c) FILTER (WHERE status <> 'delivered') AS b FROM ord WHERE earns)"
        ),
        "cancellation_rate": star(
            "SELECT count(*) AS total_orders, count(*) FILTER (WHERE status = 'canceled') AS canceled_orders, "
            "count(*) FILTER (WHERE status = 'unavailable') AS unavailable_orders, "
            f"{pct(_n('canceled'), 'count(*)')} AS cancellation_rate_pct, "
            f"{pct('count(*) FILTER (WHERE NOT earns)', 'count(*)')} AS canceled_or_unavailable_rate_pct FROM ord"
        ),
        "category_revenue_contribution": star(
            f"SELECT rank() OVER (ORDER BY r DESC) AS revenue_rank, category AS product_category, "
            f"{money('r')} AS revenue, {pct('r', 'total')} AS revenue_share_pct, "
            f"{pct('running', 'total')} AS cumulative_share_pct FROM (SELECT *, sum(r) OVER () AS total, "
            "sum(r) OVER (ORDER BY r DESC, category ROWS UNBOUNDED PRECEDING) AS running FROM cat)",
            cat,
        ),
        "category_trend_recent_vs_prior": star(
            f"SELECT category AS product_category, {money('p')} AS prior_6m_revenue, "
            f"{money('r')} AS recent_6m_revenue, {pct('r - p', 'p')} AS revenue_change_pct, "
            f"{pct('p', 'pa')} AS prior_share_pct, {pct('r', 'ra')} AS recent_share_pct, "
            f"{pct('r * pa - p * ra', 'ra * pa')} AS share_change_pp FROM shared WHERE o >= 50",
            period,
        ),
    }


def _n(status: str) -> str:
    return f"count(*) FILTER (WHERE status = '{status}')"


def operations() -> dict[str, str]:
    late = "count(*) FILTER (WHERE tardy)"
    kpis = {
        "delivered_orders": "count(*) FILTER (WHERE meas)",
        "avg_delivery_days": days("sum(act) FILTER (WHERE meas)", "count(*) FILTER (WHERE meas)"),
        "avg_estimated_days": days("sum(prom) FILTER (WHERE meas)", "count(*) FILTER (WHERE meas)"),
        "late_delivery_pct": pct("count(*) FILTER (WHERE meas AND tardy)", "count(*) FILTER (WHERE meas)"),
        "cancellation_pct": pct(_n("canceled"), "count(*)"),
        "unavailable_pct": pct(_n("unavailable"), "count(*)"),
        "avg_freight_per_order": mean_money(
            "sum(freight_c) FILTER (WHERE earns)", "count(freight_c) FILTER (WHERE earns)"
        ),
    }

    def named(*names: str) -> str:
        return ", ".join(f"{kpis[name]} AS {name}" for name in names)

    on_time, behind = "meas AND NOT tardy", "meas AND tardy"
    middle = "quantile_cont(CAST(act AS DOUBLE) / 864000000, {}) "
    return {
        "delivery_time_summary": star(
            f"SELECT count(*) AS delivered_orders, {days('sum(act)', 'count(*)')} AS avg_delivery_days, "
            f"{half(middle.format(0.5))} AS median_delivery_days, {half(middle.format(0.9))} AS p90_delivery_days, "
            f"{days('min(act)', '1')} AS min_delivery_days, {days('max(act)', '1')} AS max_delivery_days "
            "FROM ord WHERE meas"
        ),
        "estimated_vs_actual_delivery": star(
            f"SELECT {days('sum(prom)', 'count(*)')} AS avg_estimated_days, "
            f"{days('sum(act)', 'count(*)')} AS avg_actual_days, "
            f"{days('sum(prom - act)', 'count(*)')} AS avg_days_delivered_before_estimate, "
            "quantile_cont(CAST(gap AS DOUBLE), 0.5) AS median_days_vs_estimate, "
            f"{ratio('sum(gap) FILTER (WHERE gap > 0)', 'count(*) FILTER (WHERE gap > 0)')} "
            "AS avg_days_late_when_late FROM ord WHERE meas"
        ),
        "delivery_timeliness_distribution": star(
            f"SELECT bucket AS timeliness_bucket, count(*) AS orders, "
            f"{pct('count(*)', '(SELECT count(*) FROM ord WHERE meas)')} AS pct_of_delivered "
            f"FROM (SELECT {BUCKET} AS bucket FROM ord WHERE meas) GROUP BY bucket"
        ),
        "late_delivery_rate": star(
            f"SELECT count(*) AS delivered_orders, count(*) FILTER (WHERE NOT tardy) AS on_time_orders, "
            f"{late} AS late_orders, {pct('count(*) FILTER (WHERE NOT tardy)', 'count(*)')} AS on_time_pct, "
            f"{pct(late, 'count(*)')} AS late_pct FROM ord WHERE meas"
        ),
        "late_deliveries_by_month": star(
            f"SELECT {text_day('month')} AS order_month, count(*) AS delivered_orders, {late} AS late_orders, "
            f"{pct(late, 'count(*)')} AS late_pct, {days('sum(act)', 'count(*)')} AS avg_delivery_days, "
            f"{days('sum(prom)', 'count(*)')} AS avg_estimated_days FROM ord WHERE meas AND trend GROUP BY month"
        ),
        "late_deliveries_by_state": star(
            f"SELECT state AS customer_state, count(*) AS delivered_orders, {late} AS late_orders, "
            f"{pct(late, 'count(*)')} AS late_pct, {days('sum(act)', 'count(*)')} AS avg_delivery_days, "
            f"rank() OVER (ORDER BY CAST({late} AS DOUBLE) / count(*) DESC) AS late_rate_rank "
            "FROM ord WHERE meas GROUP BY state"
        ),
        "late_deliveries_by_category": star(
            f"SELECT category AS product_category, count(*) AS delivered_orders, {late} AS late_orders, "
            f"{pct(late, 'count(*)')} AS late_pct, {days('sum(act)', 'count(*)')} AS avg_delivery_days "
            "FROM ord WHERE meas AND category IS NOT NULL GROUP BY category HAVING count(*) >= 100"
        ),
        "freight_cost_summary": star(
            f"SELECT {mean_money('sum(freight_c)', 'sum(n)')} AS avg_freight_per_item, "
            f"{mean_money('sum(freight_c)', 'count(*)')} AS avg_freight_per_order, "
            + ", ".join(
                f"{mean_money(f'sum(freight_c) FILTER (WHERE {c})', f'count(*) FILTER (WHERE {c})')} AS {name}"
                for c, name in ((on_time, "avg_freight_on_time_orders"), (behind, "avg_freight_late_orders"))
            )
            + " FROM ord WHERE earns AND n > 0"
        ),
        "cancellation_rate_by_month": star(
            f"SELECT {text_day('month')} AS order_month, count(*) AS orders, {_n('canceled')} AS canceled_orders, "
            f"{_n('unavailable')} AS unavailable_orders, {pct(_n('canceled'), 'count(*)')} AS cancellation_rate_pct, "
            f"{pct('count(*) FILTER (WHERE NOT earns)', 'count(*)')} AS canceled_or_unavailable_pct "
            "FROM ord WHERE trend GROUP BY month"
        ),
        "delivery_performance_by_status": star(
            f"SELECT status AS order_status, count(*) AS orders, "
            f"{pct('count(*)', '(SELECT count(*) FROM ord)')} AS pct_of_orders, count(approved) AS approved, "
            "count(handed) AS handed_to_carrier, count(got) AS delivered_to_customer, "
            f"{ratio('sum(wait)', '3600000000 * count(wait)')} AS avg_hours_to_approval FROM ord GROUP BY status"
        ),
        "fulfilment_stage_times": star(
            "SELECT CASE WHEN tardy THEN 'late' ELSE 'on_time' END AS delivery_outcome, "
            f"count(*) AS delivered_orders, {days('sum(wait)', 'count(*)')} AS avg_approval_days, "
            f"{days('sum(handoff)', 'count(*)')} AS avg_seller_handoff_days, "
            f"{days('sum(transit)', 'count(*)')} AS avg_carrier_transit_days "
            "FROM ord WHERE meas AND approved IS NOT NULL AND handed IS NOT NULL GROUP BY 1"
        ),
        "operations_kpis": star(
            f"SELECT count(*) AS total_orders, {named(*kpis)}, "
            f"(SELECT {half(middle.format(0.5))} FROM ord WHERE meas) AS median_delivery_days FROM ord"
        ),
        "operations_kpis_monthly": star(
            f"SELECT {text_day('month')} AS order_month, count(*) AS orders, "
            + named("delivered_orders", "avg_delivery_days", "late_delivery_pct", "cancellation_pct",
                    "avg_freight_per_order")
            + " FROM ord WHERE trend GROUP BY month"
        ),
    }


STATE = """
st AS (
  SELECT state, any_value(state_name) AS state_name, any_value(region) AS region,
         count(*) FILTER (WHERE earns) AS ro, count(DISTINCT person) AS people,
         sum(value_c) FILTER (WHERE earns) AS rev, count(value_c) FILTER (WHERE earns) AS vo,
         sum(freight_c) FILTER (WHERE earns) AS fr, count(freight_c) FILTER (WHERE earns) AS fo,
         count(*) FILTER (WHERE meas) AS del, count(*) FILTER (WHERE meas AND tardy) AS late,
         coalesce(sum(act) FILTER (WHERE meas), 0) AS act,
         coalesce(sum(value_c) FILTER (WHERE meas AND tardy), 0) AS late_c
  FROM ord GROUP BY state
),
nat AS (
  SELECT sum(rev) AS a_rev, sum(vo) AS a_vo, sum(del) AS a_del, sum(late) AS a_late, sum(act) AS a_act,
         quantile_cont(CAST(rev AS DOUBLE), 0.5) AS med FROM st
),
seg AS (
  SELECT *, CASE WHEN rev >= med THEN 'Higher revenue' ELSE 'Lower revenue' END AS tier,
         CASE WHEN late * a_del > a_late * del THEN 'above national' ELSE 'at/below national' END AS side
  FROM st, nat
)
"""
SEGMENT = "tier || ' / late rate ' || side"


def regional() -> dict[str, str]:
    share = pct("rev", "a_rev")
    pp = pct("late * a_del - a_late * del", "del * a_del")
    listing = "string_agg(state, ', ' ORDER BY rev DESC, state)"
    dashboard = (
        "dash AS (SELECT state AS customer_state, state_name, region AS macro_region, "
        f"{money('rev')} AS revenue, {share} AS revenue_share_pct, rank() OVER (ORDER BY rev DESC) AS revenue_rank, "
        f"ro AS revenue_orders, people AS customers, {mean_money('rev', 'vo')} AS avg_order_value, "
        f"{mean_money('fr', 'fo')} AS avg_freight_per_order, del AS delivered_orders, late AS late_orders, "
        f"{pct('late', 'del')} AS late_pct, {pct('a_late', 'a_del')} AS national_late_pct, "
        f"{pp} AS late_pct_vs_national_pp, {days('act', 'del')} AS avg_delivery_days, "
        f"{days('a_act', 'a_del')} AS national_avg_delivery_days, {money('late_c')} AS late_order_revenue, "
        f"tier AS revenue_tier, 'Late rate ' || side AS delivery_tier, {SEGMENT} AS segment, "
        "del < 250 AS small_sample FROM seg)"
    )
    regions = (
        "reg AS (SELECT region, sum(rev) AS rev, sum(ro) AS ro, sum(vo) AS vo, sum(fr) AS fr, sum(fo) AS fo, "
        "sum(late) AS late, sum(del) AS del, sum(act) AS act FROM st GROUP BY region)"
    )
    return {
        "state_performance": star(
            f"SELECT state AS customer_state, rank() OVER (ORDER BY rev DESC) AS revenue_rank, "
            f"{money('rev')} AS revenue, {share} AS revenue_share_pct, ro AS revenue_orders, people AS customers, "
            f"{mean_money('rev', 'vo')} AS avg_order_value, "
            f"{ratio('rev * a_vo - a_rev * vo', 'vo * a_vo * 100')} AS aov_vs_national, "
            f"{mean_money('fr', 'fo')} AS avg_freight_per_order, del AS delivered_orders, late AS late_orders, "
            f"{pct('late', 'del')} AS late_pct, {pp} AS late_pct_vs_national_pp, "
            f"{days('act', 'del')} AS avg_delivery_days, "
            f"{days('act * a_del - a_act * del', 'del * a_del')} AS delivery_days_vs_national, "
            f"{money('late_c')} AS late_order_revenue, del < 250 AS small_sample FROM seg",
            STATE,
        ),
        "state_segments": star(
            f"SELECT state AS customer_state, {money('rev')} AS revenue, {half('med')} AS median_state_revenue, "
            f"{pct('late', 'del')} AS late_pct, {pct('a_late', 'a_del')} AS national_late_pct, "
            f"tier AS revenue_tier, 'Late rate ' || side AS delivery_tier, {SEGMENT} AS segment, "
            "del < 250 AS small_sample FROM seg",
            STATE,
        ),
        "segment_summary": star(
            f"SELECT {SEGMENT} AS segment, count(*) AS states, {listing} AS state_list, "
            f"{money('sum(rev)')} AS revenue, {pct('sum(rev)', 'any_value(a_rev)')} AS revenue_share_pct, "
            "CAST(sum(ro) AS BIGINT) AS revenue_orders, CAST(sum(late) AS BIGINT) AS late_orders, "
            f"{pct('sum(late)', 'any_value(a_late)')} AS share_of_all_late_orders_pct, "
            f"{pct('sum(late)', 'sum(del)')} AS segment_late_pct FROM seg GROUP BY 1",
            STATE,
        ),
        "macro_region_performance": star(
            f"SELECT region AS macro_region, {money('rev')} AS revenue, "
            f"{pct('rev', '(SELECT sum(rev) FROM reg)')} AS revenue_share_pct, "
            f"CAST(ro AS BIGINT) AS revenue_orders, {mean_money('rev', 'vo')} AS avg_order_value, "
            f"{pct('late', 'del')} AS late_pct, {days('act', 'del')} AS avg_delivery_days FROM reg",
            STATE, regions,
        ),
        "regional_dashboard": star("SELECT * FROM dash", STATE, dashboard),
        "state_scorecard": star(
            "SELECT customer_state, state_name, revenue, revenue_orders, late_pct, avg_delivery_days, delivery_tier, "
            "segment, small_sample, national_late_pct, national_avg_delivery_days, "
            f"(SELECT {half('med')} FROM nat) AS median_state_revenue FROM dash",
            STATE, dashboard,
        ),
        "top_states_share": star(
            "SELECT string_agg(customer_state, ', ' ORDER BY revenue DESC, customer_state) AS states, "
            "round(sum(revenue_share_pct), 2) AS revenue_share_pct FROM "
            "(SELECT * FROM dash ORDER BY revenue DESC, customer_state LIMIT 3)",
            STATE, dashboard,
        ),
        "segment_rollup": star(
            "SELECT segment, count(*) AS states, "
            "string_agg(customer_state, ', ' ORDER BY revenue DESC, customer_state) AS state_list, "
            "round(sum(revenue_share_pct), 2) AS revenue_share_pct, "
            f"{pct('sum(late_orders)', '(SELECT sum(late_orders) FROM dash)')} AS share_of_late_orders_pct "
            "FROM dash GROUP BY segment",
            STATE, dashboard,
        ),
        "region_freight": star(
            f"SELECT region AS macro_region, {mean_money('fr', 'fo')} AS avg_freight_per_order, "
            f"{pct('fr', 'rev')} AS freight_pct_of_revenue FROM reg",
            STATE, regions,
        ),
        "region_value_premium": star(
            f"SELECT g.region AS macro_region, {mean_money('g.rev', 'g.vo')} AS avg_order_value, "
            f"{pct('g.rev * b.vo - b.rev * g.vo', 'b.rev * g.vo')} AS premium_pct "
            "FROM reg g, (SELECT rev, vo FROM reg WHERE region = 'EUROPE') b",
            STATE, regions,
        ),
        "state_late_shares": star(
            f"SELECT state AS customer_state, late AS late_orders, {pct('late', 'a_late')} AS share_pct FROM seg",
            STATE,
        ),
    }


def _flag(expr: str, numeric: bool) -> str:
    return f"CAST({expr} AS INTEGER)" if numeric else f"({expr})"


def _operations_rows(numeric: bool = False) -> str:
    """The operations dashboard, with flags as booleans or as 1/0."""
    def measured(expr: str) -> str:
        return f"CASE WHEN meas THEN {expr} END"

    def sound(expr: str) -> str:
        return f"CASE WHEN NOT bad THEN {expr} END"

    return (
        "SELECT ord.order_id, person AS customer_unique_id, state AS customer_state, state_name, "
        f"region AS macro_region, status AS order_status, {text_day('bought_at')} AS order_purchase_date, "
        f"{text_day('month')} AS order_month, {_flag('trend', numeric)} AS in_trend_window, "
        f"category AS primary_category, coalesce(n, 0) AS item_count, {money('freight_c')} AS freight_value, "
        f"{money('CASE WHEN earns THEN value_c END')} AS revenue, {_flag('earns', numeric)} AS is_revenue_order, "
        f"""{_flag("status = 'canceled'", numeric)} AS is_canceled, """
        f"""{_flag("status = 'unavailable'", numeric)} AS is_unavailable, """
        f"{_flag('meas', numeric)} AS is_measurable_delivery, {_flag(measured('tardy'), numeric)} AS is_late, "
        "CASE WHEN meas AND tardy THEN 'Late' WHEN meas THEN 'On time' END AS delivery_outcome, "
        f"CASE WHEN meas THEN {BUCKET} END AS timeliness_bucket, "
        f"{measured(days('act', '1'))} AS delivery_days, {measured(days('prom', '1'))} AS estimated_days, "
        f"{measured('gap')} AS days_vs_estimate, {sound(ratio('wait', '3600000000'))} AS approval_hours, "
        f"{sound(days('handoff', '1'))} AS seller_handoff_days, "
        f"{sound(days('transit', '1'))} AS carrier_transit_days, {_flag('bad', numeric)} AS has_invalid_dates FROM ord"
    )


SOLD = (
    "sold AS (SELECT ord.order_id, item_id, person, state, state_name, region, status, bought_at, month, trend, earns, "
    "g.category AS cat, l.price_c, l.freight_c AS ship_c, l.price_c + l.freight_c AS item_c "
    "FROM ord LEFT JOIN lines l ON l.order_id = ord.order_id LEFT JOIN goods g ON g.product_id = l.product_id)"
)
CHOSEN = (
    "bought_at >= TIMESTAMP '1997-03-01' AND bought_at < TIMESTAMP '1999-11-01' AND "
    "state_name IN ('NATION_1', 'NATION_3', 'NATION_8', 'NATION_13', 'NATION_21') AND "
    "status IN ('delivered', 'shipped', 'canceled') AND {} IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL')"
)


def model() -> dict[str, str]:
    fact_measures = {
        "delivery_days": ("meas", "act", 86400000000), "estimated_days": ("meas", "prom", 86400000000),
        "approval_hours": ("NOT bad", "wait", 3600000000), "seller_handoff_days": ("NOT bad", "handoff", 86400000000),
        "carrier_transit_days": ("NOT bad", "transit", 86400000000),
    }
    measures = ", ".join(
        f"CASE WHEN {on} THEN CAST({micros} AS DOUBLE) / {unit} END AS {name}"
        for name, (on, micros, unit) in fact_measures.items()
    )
    columns = (
        "order_id bigint|customer_unique_id bigint|customer_state string|state_name string|macro_region string|"
        "order_status string|order_purchase_timestamp timestamp_ntz|order_purchase_date date|order_month date|"
        "in_trend_window boolean|primary_category string|item_count bigint|product_value decimal(38,2)|"
        "freight_value decimal(38,2)|order_value decimal(38,2)|revenue decimal(38,2)|is_revenue_order boolean|"
        "is_canceled boolean|is_unavailable boolean|is_measurable_delivery boolean|is_late boolean|"
        "delivery_days double|estimated_days double|days_vs_estimate int|approval_hours double|"
        "seller_handoff_days double|carrier_transit_days double|has_invalid_dates boolean"
    )
    listed = " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, count({name}) AS filled_rows FROM facts"
        for i, (name, kind) in enumerate((c.split(" ") for c in columns.split("|")), 1)
    )
    codes = ", ".join(f"('{code}', '{name}', '{region}', {i})" for i, (code, name, region) in enumerate(STATES))
    facts = star(
        "SELECT ord.order_id, person AS customer_unique_id, state AS customer_state, state_name, "
        f"region AS macro_region, status AS order_status, {text_time('bought_at')} AS order_purchase_timestamp, "
        f"{text_day('bought_at')} AS order_purchase_date, {text_day('month')} AS order_month, trend AS in_trend_window, "
        f"category AS primary_category, coalesce(n, 0) AS item_count, {money('prod_c')} AS product_value, "
        f"{money('freight_c')} AS freight_value, {money('value_c')} AS order_value, "
        f"{money('CASE WHEN earns THEN value_c END')} AS revenue, earns AS is_revenue_order, "
        "status = 'canceled' AS is_canceled, status = 'unavailable' AS is_unavailable, "
        "meas AS is_measurable_delivery, CASE WHEN meas THEN tardy END AS is_late, "
        f"CASE WHEN meas THEN gap END AS days_vs_estimate, {measures}, bad AS has_invalid_dates FROM ord"
    )
    return {
        "state_reference": star("SELECT * FROM states"),
        "item_totals": star(
            f"SELECT order_id, n AS item_count, {money('prod_c')} AS product_value, "
            f"{money('freight_c')} AS freight_value, {money('value_c')} AS order_value FROM valued"
        ),
        "category_totals": star(
            f"SELECT order_id, category AS product_category, n AS items, n AS priced_items, "
            f"{money('prod_c')} AS product_value, {money('value_c')} AS value FROM by_cat"
        ),
        "primary_category": star("SELECT order_id, category AS product_category FROM main_cat"),
        "order_facts": facts,
        "order_base": star(
            "SELECT order_id, customer_id, person AS customer_unique_id, state AS customer_state, TRUE AS has_customer, "
            f"status AS order_status, {text_time('bought_at')} AS order_purchase_timestamp, {text_time('approved')} AS order_approved_at, "
            f"{text_time('handed')} AS order_delivered_carrier_date, {text_time('got')} AS order_delivered_customer_date, "
            f"{text_time('due')} AS order_estimated_delivery_date, bad AS has_invalid_dates, n AS item_count, "
            f"{money('prod_c')} AS product_value, {money('freight_c')} AS freight_value, {money('value_c')} AS order_value, "
            "CASE WHEN n IS NOT NULL THEN category IS NOT NULL END AS in_catalogue, category AS primary_category, "
            f"{text_day('month')} AS order_month FROM ord"
        ),
        "category_base": star(
            "SELECT l.order_id, category AS product_category, g.product_id IS NOT NULL AS in_catalogue, count(*) AS items, "
            f"count(price_c) AS priced_items, {money('sum(price_c)')} AS product_value, {money('sum(freight_c)')} AS freight_value, "
            f"{money('sum(price_c + freight_c)')} AS value, status AS order_status, {text_time('bought_at')} AS order_purchase_timestamp, "
            "strftime(bought_at, '%Y-%m-01') AS order_month "
            "FROM lines l LEFT JOIN goods g ON g.product_id = l.product_id LEFT JOIN bought b ON b.order_id = l.order_id GROUP BY l.order_id, category, g.product_id IS NOT NULL, status, bought_at"
        ),
        "sales_dashboard": star(
            "SELECT order_id, item_id AS order_item_id, person AS customer_unique_id, state AS customer_state, "
            f"state_name, region AS macro_region, status AS order_status, {text_day('bought_at')} AS order_purchase_date, "
            f"{text_day('month')} AS order_month, trend AS in_trend_window, earns AS is_revenue_order, "
            f"cat AS product_category, {money('price_c')} AS price, {money('ship_c')} AS freight_value, "
            f"{money('item_c')} AS item_value, {money('CASE WHEN earns THEN item_c END')} AS revenue FROM sold",
            SOLD,
        ),
        "operations_dashboard": star(_operations_rows()),
        "dashboard_export": star(_operations_rows(numeric=True)),
        "monthly_revenue_by_parameters": sales()["monthly_revenue"],
        "order_facts_columns": f"WITH facts AS MATERIALIZED ({facts}) {listed}",
        "customers_by_reference_state": (
            f"SELECT state_code, state_name, macro_region, count(c_custkey) AS customers FROM (VALUES {codes}) AS s(state_code, state_name, macro_region, place) "
            f"LEFT JOIN (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey) ON c_custkey % {len(STATES)} = place GROUP BY ALL"
        ),
    }


def dashboards() -> dict[str, str]:
    def sales_kpis(by: str | None, where: str = "TRUE") -> str:
        key = f"{by[0]} AS {by[1]}, " if by else ""
        earning = "CASE WHEN earns THEN item_c END"
        orders = f"count(DISTINCT CASE WHEN {earning} IS NOT NULL THEN order_id END)"
        return star(
            f"SELECT {key}{money(f'sum({earning})')} AS total_revenue, count(DISTINCT order_id) AS total_orders, "
            f"{orders} AS revenue_orders, {mean_money(f'sum({earning})', orders)} AS average_order_value, "
            f"count(DISTINCT person) AS total_customers FROM sold WHERE {where}" + (" GROUP BY 1" if by else ""),
            SOLD,
        )

    def tiles(by: tuple[str, str] | None, where: str = "TRUE") -> str:
        key = f"{by[0]} AS {by[1]}, " if by else ""

        # Means of values already rounded to two decimals, added up as whole hundredths.
        def mean(micros: str) -> str:
            hundredths = f"CAST(round({days(micros, '1')} * 100) AS HUGEINT)"
            return ratio(f"sum({hundredths}) FILTER (WHERE meas)", "100 * count(*) FILTER (WHERE meas)")

        return star(
            f"SELECT {key}count(*) AS orders, {mean('act')} AS avg_delivery_days, "
            f"{mean('prom')} AS avg_estimated_days, "
            f"{pct('count(*) FILTER (WHERE meas AND tardy)', 'count(*) FILTER (WHERE meas)')} AS late_delivery_pct, "
            f"{pct(_n('canceled'), 'count(*)')} AS cancellation_pct, "
            f"{mean_money('sum(freight_c) FILTER (WHERE earns)', 'count(freight_c) FILTER (WHERE earns)')} "
            "AS avg_freight_per_order, count(*) FILTER (WHERE meas) AS delivered_orders "
            f"FROM ord WHERE {where}" + (f" GROUP BY {by[0]}" if by else "")
        )

    national = "nat AS (SELECT count(*) FILTER (WHERE tardy) AS al, count(*) AS am FROM ord WHERE meas)"

    def late_rate(column: str, name: str, where: str, least: int, tail: str = "") -> str:
        return star(
            f"SELECT {name}, delivered_orders, late_orders, {pct('late_orders', 'delivered_orders')} "
            f"AS late_delivery_pct, {pct('al', 'am')} AS national_late_pct, "
            "late_orders * am > al * delivered_orders AS above_national FROM "
            f"(SELECT {column} AS {name}, count(*) FILTER (WHERE meas) AS delivered_orders, "
            f"count(*) FILTER (WHERE meas AND tardy) AS late_orders FROM ord WHERE {where} GROUP BY 1), nat "
            f"WHERE delivered_orders >= {least} {tail}",
            national,
        )

    shares = (
        "sh AS (SELECT cat, sum(item_c) FILTER (WHERE earns) AS r FROM sold WHERE cat IS NOT NULL GROUP BY cat)"
    )
    share_rows = (
        f"SELECT cat AS product_category, {money('r')} AS revenue, "
        f"{pct('r', '(SELECT sum(r) FROM sh)')} AS pct_of_total FROM sh"
    )
    return {
        "sales_kpis": sales_kpis(None),
        "sales_kpis_by_state": sales_kpis(("state", "customer_state")),
        "sales_kpis_selected": sales_kpis(("cat", "product_category"), CHOSEN.format("cat")),
        "month_over_month": star(
            f"SELECT {text_day('month')} AS order_month, {money('r')} AS revenue, "
            f"{pct('r - b', 'abs(b)')} AS mom_revenue_pct FROM (SELECT month, r, lag(r) OVER (ORDER BY month) AS b "
            "FROM (SELECT month, sum(item_c) FILTER (WHERE earns) AS r FROM sold WHERE trend GROUP BY month))",
            SOLD,
        ),
        "top_categories_by_revenue": star(
            share_rows + " ORDER BY r DESC, cat LIMIT 4", SOLD, shares
        ),
        "category_shares": star(share_rows, SOLD, shares),
        "top_category_concentration": star(
            f"SELECT count(*) AS categories, {money('sum(r) FILTER (WHERE k <= 3)')} AS top_revenue, "
            f"{pct('sum(r) FILTER (WHERE k <= 3)', 'sum(r)')} AS top_share_pct FROM "
            "(SELECT r, row_number() OVER (ORDER BY r DESC, cat) AS k FROM sh)",
            SOLD, shares,
        ),
        "operations_kpi_tiles": tiles(None),
        "operations_kpi_tiles_by_month": tiles((text_day("month"), "order_month"), "trend"),
        "operations_kpi_tiles_selected": tiles(("state_name", "state_name"), CHOSEN.format("category")),
        "late_rate_by_state": late_rate("state_name", "state_name", CHOSEN.format("category"), 0),
        "late_rate_by_category": late_rate(
            "category", "primary_category", "TRUE", 100,
            "ORDER BY late_delivery_pct DESC, primary_category NULLS FIRST LIMIT 15",
        ),
        "order_status_share": star(
            f"SELECT status AS order_status, count(*) AS orders, "
            f"{pct('count(*)', '(SELECT count(*) FROM ord)')} AS pct_of_orders FROM ord GROUP BY status"
        ),
        "timeliness_by_outcome": star(
            f"SELECT bucket AS timeliness_bucket, CASE WHEN tardy THEN 'Late' ELSE 'On time' END AS delivery_outcome, "
            f"count(*) AS orders, {pct('count(*)', '(SELECT count(*) FROM ord WHERE meas)')} AS pct_of_delivered "
            f"FROM (SELECT {BUCKET} AS bucket, tardy FROM ord WHERE meas) GROUP BY bucket, tardy"
        ),
    }


def _quality_checks() -> str:
    """All checks as rows (category, table, name, severity, records, rows of the table)."""
    sizes = {"customers": "people", "orders": "bought", "order_items": "lines", "payments": "paid",
             "products": "goods"}

    def rows_where(table: str, condition: str) -> str:
        return f"(SELECT count(*) FROM {sizes[table]} t WHERE {condition})"

    def repeats(table: str, key: str) -> str:
        return f"(SELECT count(*) - count(DISTINCT {key}) FROM {sizes[table]})"

    def lacking(table: str, key: str, other: str) -> str:
        return rows_where(table, f"NOT EXISTS (SELECT 1 FROM {sizes[other]} x WHERE x.{key} = t.{key})")

    statuses = "'created', 'approved', 'invoiced', 'processing', 'shipped', 'delivered', 'canceled', 'unavailable'"
    checks = [
        ("Missing values", "orders", "Delivered order without delivery date", "warning",
         rows_where("orders", "status = 'delivered' AND got IS NULL")),
        ("Missing values", "orders", "No delivery date (order not delivered)", "info",
         rows_where("orders", "status <> 'delivered' AND got IS NULL")),
        ("Missing values", "orders", "No approval date", "info", rows_where("orders", "approved IS NULL")),
        ("Missing values", "products", "Product category missing (shown as unknown)", "warning",
         rows_where("products", "source_category IS NULL")),
        ("Missing values", "products", "Weight or dimensions missing", "info",
         rows_where("products", "weight + len + high + wide IS NULL")),
        ("Missing values", "payments", "Installments missing (invalid 0 in source)", "warning",
         rows_where("payments", "installments IS NULL")),
        ("Duplicate records", "customers", "Duplicate customer_id", "critical", repeats("customers", "customer_id")),
        ("Duplicate records", "orders", "Duplicate order_id", "critical", repeats("orders", "order_id")),
        ("Duplicate records", "order_items", "Duplicate order_id + order_item_id", "critical",
         repeats("order_items", "(order_id, item_id)")),
        ("Duplicate records", "payments", "Duplicate order_id + payment_sequential", "critical",
         repeats("payments", "(order_id, seq)")),
        ("Duplicate records", "products", "Duplicate product_id", "critical", repeats("products", "product_id")),
        ("Invalid values", "order_items", "Negative price", "critical", rows_where("order_items", "price_c < 0")),
        ("Invalid values", "order_items", "Zero price", "warning", rows_where("order_items", "price_c = 0")),
        ("Invalid values", "order_items", "Negative freight", "critical", rows_where("order_items", "freight_c < 0")),
        ("Invalid values", "payments", "Negative payment value", "critical", rows_where("payments", "value_c < 0")),
        ("Invalid values", "payments", "Zero payment value", "warning", rows_where("payments", "value_c = 0")),
        ("Invalid values", "customers", "Zip code prefix not 5 digits", "warning",
         rows_where("customers", "NOT regexp_full_match(zip, '[0-9]{5}')")),
        ("Invalid dates", "orders", "Delivered before purchase", "critical", rows_where("orders", "got < bought_at")),
        ("Invalid dates", "orders", "Estimated delivery before purchase", "critical", rows_where("orders", "due < bought_at")),
        ("Invalid dates", "orders", "Approved before purchase", "warning", rows_where("orders", "approved < bought_at")),
        ("Invalid dates", "orders", "Handed to carrier before purchase", "warning", rows_where("orders", "handed < bought_at")),
        ("Invalid dates", "orders", "Delivered to customer before handed to carrier", "warning",
         rows_where("orders", "got < handed")),
        ("Invalid dates", "order_items", "Shipping limit after last purchase date in data", "warning",
         rows_where("order_items", "ship_limit > (SELECT max(bought_at) FROM bought)")),
        ("Orphan records", "orders", "Order without items", "warning", lacking("orders", "order_id", "order_items")),
        ("Orphan records", "orders", "Order without payments", "warning", lacking("orders", "order_id", "payments")),
        ("Orphan records", "customers", "Customer without orders", "warning",
         lacking("customers", "customer_id", "orders")),
        ("Orphan records", "products", "Product never ordered", "warning",
         lacking("products", "product_id", "order_items")),
        ("Unmatched foreign keys", "orders", "customer_id not in customers", "critical",
         lacking("orders", "customer_id", "customers")),
        ("Unmatched foreign keys", "order_items", "order_id not in orders", "critical",
         lacking("order_items", "order_id", "orders")),
        ("Unmatched foreign keys", "order_items", "product_id not in products", "critical",
         lacking("order_items", "product_id", "products")),
        ("Unmatched foreign keys", "payments", "order_id not in orders", "critical",
         lacking("payments", "order_id", "orders")),
        ("Inconsistent categories", "orders", "Unknown order status", "warning",
         rows_where("orders", f"status NOT IN ({statuses})")),
        ("Inconsistent categories", "orders", "Canceled order with a delivery date", "warning",
         rows_where("orders", "status = 'canceled' AND got IS NOT NULL")),
        ("Inconsistent categories", "payments", "Payment type not_defined or unknown", "warning",
         rows_where("payments", "kind NOT IN ('credit_card', 'boleto', 'voucher', 'debit_card')")),
        ("Inconsistent categories", "customers", "State code not a Brazilian state", "warning",
         rows_where("customers", "state NOT IN (SELECT state_code FROM states)")),
        ("Inconsistent categories", "products", "Category name variants differing only by case/spacing", "warning",
         "(SELECT count(*) FROM (SELECT 1 FROM goods WHERE source_category IS NOT NULL "
         "GROUP BY lower(trim(source_category)) HAVING count(DISTINCT source_category) > 1))"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{category}' AS check_category, '{table}' AS table_name, '{name}' AS check_name, "
        f"'{severity}' AS severity, {count} AS record_count, (SELECT count(*) FROM {sizes[table]}) AS total_records"
        for category, table, name, severity, count in checks
    )


def quality() -> dict[str, str]:
    dq = (
        f"dq AS (SELECT *, {pct('record_count', 'total_records')} AS pct_of_records, "
        "CASE WHEN record_count = 0 THEN 'PASS' WHEN severity = 'critical' THEN 'FAIL' "
        f"WHEN severity = 'warning' THEN 'WARNING' ELSE 'INFO' END AS status FROM ({_quality_checks()}))"
    )

    def n(status: str) -> str:
        return f"count(*) FILTER (WHERE status = '{status}')"

    return {
        "data_quality_summary": star("SELECT * FROM dq", dq),
        "data_quality_by_category": star(
            f"SELECT check_category, count(*) AS checks, {n('PASS')} AS passed, {n('WARNING')} AS warnings, "
            f"{n('FAIL')} AS failed, {n('INFO')} AS info, "
            "CAST(sum(record_count) FILTER (WHERE severity <> 'info') AS BIGINT) AS affected_records "
            "FROM dq GROUP BY 1",
            dq,
        ),
        "quality_tiles": star(
            f"SELECT {n('PASS')} AS checks_passed, {n('WARNING')} AS warnings, {n('FAIL')} AS failed_checks, "
            + ", ".join(
                f"CAST(sum(record_count) FILTER (WHERE {c}) AS BIGINT) AS {name}"
                for c, name in (
                    ("check_category = 'Missing values' AND severity <> 'info'", "missing_records"),
                    ("check_category = 'Duplicate records'", "duplicate_records"),
                    ("check_category IN ('Invalid values', 'Invalid dates')", "invalid_records"),
                )
            )
            + f", CASE WHEN {n('FAIL')} > 0 THEN 'FAILED' ELSE 'PASSED' END AS validation_status FROM dq",
            dq,
        ),
        "checks_by_category_and_status": star(
            "SELECT check_category, "
            + ", ".join(f"{n(s)} AS {s.lower()}_checks" for s in ("PASS", "INFO", "WARNING", "FAIL"))
            + " FROM dq GROUP BY 1",
            dq,
        ),
        "check_detail": star(
            "SELECT check_category, table_name, check_name, status, record_count, pct_of_records "
            "FROM dq WHERE status <> 'PASS'",
            dq,
        ),
    }


def exploration() -> dict[str, str]:
    early = "count(*) FILTER (WHERE month < DATE '{0}-09-01' AND month >= DATE '{0}-01-01')"
    mon = (
        "mon AS (SELECT month, sum(value_c) FILTER (WHERE earns) AS r, "
        "count(value_c) FILTER (WHERE earns) AS o FROM ord WHERE trend GROUP BY month)"
    )
    halves = (
        "hv AS (SELECT "
        + ", ".join(
            f"sum({c}) FILTER (WHERE year(month) = {y} AND month(month) <= 8) AS {c}{i}"
            for i, y in enumerate((1999, 2000)) for c in ("r", "o")
        )
        + " FROM mon)"
    )

    def hundredths(expr: str) -> str:
        return f"CAST(round({expr} * 100) AS HUGEINT)"

    def stage(expr: str, per_day: int) -> str:
        return ratio(f"sum({hundredths(expr)})", f"{100 * per_day} * CAST(count({expr}) AS HUGEINT)", 6)

    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
        for name, cte in (
            ("customers", "people"), ("orders", "bought"), ("order_items", "lines"), ("payments", "paid"),
            ("products", "goods"),
        )
    )
    return {
        "table_row_counts": star(counts),
        "coverage": star(
            f"SELECT {text_day('min(bought_at)')} AS first_order, {text_day('max(bought_at)')} AS last_order, count(*) AS orders, "
            f"count(DISTINCT person) AS customers, {money('sum(value_c) FILTER (WHERE earns)')} AS revenue FROM ord"
        ),
        "monthly_revenue_orders": star(
            f"SELECT {text_day('month')} AS order_month, {money('r')} AS revenue, o AS revenue_orders FROM mon", mon
        ),
        "peak_month": star(
            f"SELECT {text_day('month')} AS order_month, {money('r')} AS revenue, o AS revenue_orders FROM mon "
            "ORDER BY r DESC, month LIMIT 1",
            mon,
        ),
        "year_over_year": star(
            f"SELECT 'revenue' AS metric, {money('r0')} AS base_period, {money('r1')} AS compare_period, "
            f"{pct('r1 - r0', 'r0')} AS change_pct FROM hv UNION ALL "
            f"SELECT 'revenue_orders', CAST(o0 AS DOUBLE), CAST(o1 AS DOUBLE), {pct('o1 - o0', 'o0')} FROM hv "
            f"UNION ALL SELECT 'avg_order_value', {mean_money('r0', 'o0')}, {mean_money('r1', 'o1')}, "
            f"{pct('r1 * o0 - r0 * o1', 'r0 * o1')} FROM hv",
            mon, halves,
        ),
        "orders_year_over_year": star(
            f"SELECT a AS base_orders, b AS compare_orders, {pct('b - a', 'a')} AS change_pct FROM "
            f"(SELECT {early.format(1999)} AS a, {early.format(2000)} AS b FROM ord)"
        ),
        "early_and_late_share": star(
            f"SELECT count(*) AS delivered_orders, {pct('count(*) FILTER (WHERE gap < 0)', 'count(*)')} AS early_pct, "
            f"{pct('count(*) FILTER (WHERE gap > 0)', 'count(*)')} AS late_pct FROM ord WHERE meas"
        ),
        "worst_months": star(
            f"SELECT {text_day('month')} AS order_month, count(*) AS delivered_orders, "
            f"{pct('count(*) FILTER (WHERE tardy)', 'count(*)')} AS late_pct FROM ord WHERE meas AND trend "
            "GROUP BY month ORDER BY late_pct DESC, month LIMIT 3"
        ),
        "stage_means_from_view": star(
            "SELECT CASE WHEN tardy THEN 'Late' ELSE 'On time' END AS delivery_outcome, "
            f"{stage(ratio('wait', '3600000000'), 24)} AS approval_days, "
            f"{stage(days('handoff', '1'), 1)} AS seller_handoff_days, "
            f"{stage(days('transit', '1'), 1)} AS carrier_transit_days FROM ord WHERE meas GROUP BY tardy"
        ),
        "repeat_customers": star(
            "SELECT count(*) AS customers, count(*) FILTER (WHERE o > 1) AS repeat_customers, "
            f"{pct('count(*) FILTER (WHERE o > 1)', 'count(*)')} AS repeat_pct "
            "FROM (SELECT person, count(*) AS o FROM ord GROUP BY person)"
        ),
        "best_day": star(
            f"SELECT {text_day('bought_at')} AS day, o AS orders, {money('r')} AS revenue, {ratio('r', 'nxt')} "
            "AS times_next_best FROM (SELECT *, lead(r) OVER (ORDER BY r DESC, bought_at) AS nxt FROM "
            "(SELECT CAST(bought_at AS DATE) AS bought_at, count(*) AS o, sum(value_c) AS r FROM ord WHERE earns AND n > 0 GROUP BY 1)) "
            "ORDER BY r DESC, bought_at LIMIT 1"
        ),
        "decline_from_peak": star(
            f"SELECT {text_day('pm')} AS peak_month, {money('pr')} AS peak_revenue, {text_day('lm')} AS latest_month, "
            f"{money('lr')} AS latest_revenue, {pct('lr - pr', 'pr')} AS change_pct FROM "
            "(SELECT month AS pm, r AS pr FROM mon WHERE year(month) = 2000 ORDER BY r DESC, month LIMIT 1), "
            "(SELECT month AS lm, r AS lr FROM mon WHERE year(month) = 2000 ORDER BY month DESC LIMIT 1)",
            mon,
        ),
        "revenue_exposed_to_lateness": star(
            f"SELECT {money('sum(value_c) FILTER (WHERE tardy)')} AS late_order_revenue, "
            f"{pct('sum(value_c) FILTER (WHERE tardy)', 'sum(value_c)')} AS pct_of_delivered_revenue "
            "FROM ord WHERE meas"
        ),
        "undelivered_in_latest_month": star(
            f"SELECT {text_day('month')} AS order_month, count(*) AS orders, "
            "count(*) FILTER (WHERE status <> 'delivered') AS undelivered, "
            f"""{pct("count(*) FILTER (WHERE status <> 'delivered')", 'count(*)')} AS undelivered_pct """
            "FROM ord WHERE trend GROUP BY month ORDER BY month DESC LIMIT 1"
        ),
        "orders_across_categories": star(
            "SELECT count(*) AS orders, count(*) FILTER (WHERE k > 1) AS multi_category_orders, "
            f"{pct('count(*) FILTER (WHERE k > 1)', 'count(*)')} AS pct "
            "FROM (SELECT order_id, count(DISTINCT category) AS k FROM by_cat GROUP BY order_id)"
        ),
    }


def statements() -> dict[str, str]:
    from checks import oracle_untidy

    result: dict[str, str] = {}
    for part in (sales, operations, regional, model, dashboards, quality, exploration, oracle_untidy.statements):
        result.update(part())
    return result
