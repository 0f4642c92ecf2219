"""Data-quality checks and schema conformance."""

from __future__ import annotations

from pyspark.sql import functions as F

from depot.operators import quality as Q
from depot.registry import register
from depot.registry.aggregates import GIVEN_COLUMNS
from depot.sources.schemas import SPECS


# ---- K1
_UNIQUE = [("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"]), ("part", ["p_partkey"]),
           ("customer", ["c_custkey"]), ("supplier", ["s_suppkey"]), ("nation", ["n_nationkey"]), ("region", ["r_regionkey"]),
           ("events", ["event_id"]), ("documents", ["doc_id"]), ("labels", ["doc_id"]), ("pages", ["page_id"]),
           ("benchmark", ["item_id"]), ("embeddings", ["vec_id"]), ("conversations", ["conv_id", "turn"])]


@register("check_unique", " UNION ALL ".join(
    f"SELECT '{tb}' AS table_name, '{','.join(k)}' AS key_columns, "
    f"concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in k)}) AS key_value, count(*) AS n "
    f"FROM {tb} GROUP BY {', '.join(k)} HAVING count(*) > 1" for tb, k in _UNIQUE))
def q_check_unique(t):
    return Q.check_unique({tb: (getattr(t, tb), [k]) for tb, k in _UNIQUE})


# ---- K2
_FKS = [("order_lines.order_id", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("order_lines.item_id", "lineitem", "l_partkey", "part", "p_partkey"),
        ("order_lines.vendor_id", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders.customer_id", "orders", "o_custkey", "customer", "c_custkey"),
        ("customers.nation_id", "customer", "c_nationkey", "nation", "n_nationkey"),
        ("suppliers.nation_id", "supplier", "s_nationkey", "nation", "n_nationkey"),
        ("nations.region_id", "nation", "n_regionkey", "region", "r_regionkey"),
        ("events.customer_id", "events", "user_id", "customer", "c_custkey"),
        ("labels.doc_id", "labels", "doc_id", "documents", "doc_id")]


@register("check_foreign_keys", " UNION ALL ".join(
    f"SELECT '{fk}' AS foreign_key, count(*) AS orphans FROM {ct} c WHERE c.{cc} IS NOT NULL "
    f"AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pc} = c.{cc})" for fk, ct, cc, pt, pc in _FKS))
def q_check_foreign_keys(t):
    return Q.check_foreign_keys([(fk, getattr(t, ct), cc, getattr(t, pt), pc) for fk, ct, cc, pt, pc in _FKS])


# ---- K3: the given tables, and the business views as their declared tables
_NN = [("orders", "v_orders"), ("order_lines", "v_lines"), ("shipments", "v_shipments")]
#: Declared table -> (business view that holds it, columns of the view).
DECLARED_VIEWS = {
    "vendors": ("v_vendors", "vendor_id vendor_name"),
    "distribution_centers": ("v_dcs", "dc_id dc_name city state zip region capacity_units"),
    "items": ("v_items", "item_id item_sku item_description category subcategory lead_time_days length_in width_in height_in weight_lb cube_ft "
                         "unit_price unit_cost shipping_cost_per_unit"),
    "customers": ("v_customers", "customer_id master_id is_sub customer_name segment region credit_limit discount_percentage tax_exempt_flag risk_score"),
    "inventory_adjustments": ("v_adjustments", "adjustment_id dc_id item_id adjustment_type reason_code quantity adjustment_timestamp"),
    "carriers": ("v_carriers", "carrier_id carrier_name carrier_type"),
    "sales_reps": ("v_reps", "rep_id region"),
    "orders": ("v_orders", "order_id customer_id order_date dc_id ship_via order_status"),
    "order_lines": ("v_lines", "order_line_id order_id item_id vendor_id quantity_ordered unit_price extended_price return_flag line_ship_date"),
    "shipments": ("v_shipments", "shipment_id order_id dc_id carrier_id ship_date promised_date delivery_date shipment_type"),
    "promotions": ("v_promotions", "promo_id start_date end_date discount_type"),
}


def _have(name):
    return DECLARED_VIEWS[name][1].split()


def _nn_sql(spec_name, view):
    parts = [f"SELECT '{spec_name}' AS table_name, '{c}' AS column_name, "
             + (f"CAST(count_if({c} IS NULL) AS BIGINT)" if c in _have(spec_name) else "count(*)") + f" AS null_count FROM {view}"
             for c in SPECS[spec_name].not_null]
    return " UNION ALL ".join(parts)


_GIVEN_NN = [f"SELECT '{tb}' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM {tb}"
             for tb, cols in GIVEN_COLUMNS.items() for c in cols]


@register("check_not_null", " UNION ALL ".join([_nn_sql(s, v) for s, v in _NN] + _GIVEN_NN))
def q_check_not_null(t):
    declared = Q.check_not_null({s: (Q.conform_to_schema(getattr(t, v), SPECS[s].struct), SPECS[s].not_null) for s, v in _NN})
    return declared.unionByName(Q.check_not_null({tb: (getattr(t, tb), cols) for tb, cols in GIVEN_COLUMNS.items()}))


# ---- K4
def _empty_sql(name, source):
    return (f"SELECT '{name}' AS table_name, n = 0 AS failed, CASE WHEN n = 0 THEN 'empty' ELSE 'ok' END AS reason "
            f"FROM (SELECT count(*) AS n FROM (SELECT 1 FROM {source} LIMIT 1) x) a")


@register("check_non_empty", " UNION ALL ".join(
    [_empty_sql(tb, tb) for tb in GIVEN_COLUMNS] + [_empty_sql("lines_without_quantity", "lineitem WHERE l_quantity <= 0"), "SELECT 'categories', true, 'missing'"]))
def q_check_non_empty(t):
    return Q.check_non_empty({**{tb: getattr(t, tb) for tb in GIVEN_COLUMNS},
                              "lines_without_quantity": t.lineitem.filter(F.col("l_quantity") <= 0), "categories": None})


# ---- K1-K4 as the declared specs call for them
_SQL_TYPES = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DateType()": "DATE", "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN",
              "TimestampType()": "TIMESTAMP"}


def _sql_type(ty):
    return _SQL_TYPES.get(repr(ty)) or f"DECIMAL({ty.precision},{ty.scale})"


def _declared_sql():
    def finding(table, check, subject, n, source):
        return f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{subject}' AS subject, CAST({n} AS BIGINT) AS failures FROM {source}"

    out = []
    for name, (view, _) in DECLARED_VIEWS.items():
        spec, have = SPECS[name], _have(name)
        out.append(finding(name, "non_empty", "", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", view))
        cast = {c: f"TRY_CAST({c} AS {_sql_type(ty)})" if c in have else "NULL" for c, ty in spec.columns}
        out += [finding(name, "not_null", c, f"count_if({cast[c]} IS NULL)", view) for c in spec.not_null]
        out += [finding(name, "lost_in_cast", c, f"count_if({c} IS NOT NULL AND {cast[c]} IS NULL)", view) for c, _ in spec.columns if c in have]
        for key in spec.keys:
            if all(c in have for c in key):
                there = " AND ".join(f"{c} IS NOT NULL" for c in key)
                out.append(finding(name, "unique", ",".join(key), "count(*)", f"(SELECT 1 FROM {view} WHERE {there} GROUP BY {', '.join(key)} HAVING count(*) > 1) x"))
            else:
                out.append(f"SELECT '{name}', 'unique', '{','.join(key)}', CAST(0 AS BIGINT)")
        for c, parent, pc in spec.foreign:
            if parent in DECLARED_VIEWS:
                lone = (f"(SELECT 1 FROM {view} c WHERE c.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {DECLARED_VIEWS[parent][0]} p WHERE p.{pc} = c.{c})) x"
                        if c in have else "(SELECT 1 WHERE false) x")
                out.append(finding(name, "foreign_key", c, "count(*)", lone))
    return " UNION ALL ".join(out)


@register("check_declared", _declared_sql())
def q_check_declared(t):
    return Q.check_declared({name: getattr(t, view) for name, (view, _) in DECLARED_VIEWS.items()}, SPECS)


# ---- K5
@register("check_sequential_ids", """
SELECT 'order_lines' AS table_name, count(*) AS n, count(DISTINCT order_line_id) AS n_distinct,
       CAST(min(order_line_id) AS BIGINT) AS min_id, CAST(max(order_line_id) AS BIGINT) AS max_id,
       (count(*) = count(DISTINCT order_line_id) AND min(order_line_id) = 1 AND max(order_line_id) = count(*)) OR count(*) = 0 AS ok
FROM v_lines
UNION ALL
SELECT 'tracking_events', count(*), count(DISTINCT tracking_event_id), CAST(min(tracking_event_id) AS BIGINT),
       CAST(max(tracking_event_id) AS BIGINT),
       (count(*) = count(DISTINCT tracking_event_id) AND min(tracking_event_id) = 1 AND max(tracking_event_id) = count(*)) OR count(*) = 0
FROM x_tracking""")
def q_check_sequential_ids(t):
    from depot.plans.fulfillment import build_tracking_events
    return Q.check_sequential_ids({"order_lines": (t.v_lines, "order_line_id"),
                                   "tracking_events": (build_tracking_events(t.v_shipments, t.v_dcs),
                                                       "tracking_event_id")})


# ---- A7
def _conform_sql():
    have = [*_have("shipments"), "total_weight_lb", "total_cube_ft", "estimated_cost", "actual_cost"]
    cols = [f"TRY_CAST({c} AS {_sql_type(ty)}) AS {c}" if c in have else f"CAST(NULL AS {_sql_type(ty)}) AS {c}" for c, ty in SPECS["shipments"].columns]
    return "SELECT " + ", ".join(cols) + " FROM x_built_shipments"


@register("conform_to_schema", _conform_sql())
def q_conform_to_schema(t):
    from depot.registry.tables import plain_shipment_lines
    from depot.plans.fulfillment import build_shipments
    return Q.conform_to_schema(build_shipments(t.v_shipments, plain_shipment_lines(t), t.v_items), SPECS["shipments"].struct)


# what the declared types cannot hold: pages and documents carry text where the catalog
# has numbers, so their columns are read as an item's (a mapping by position)
_AS_ITEMS = {"doc_id": "item_id", "text": "item_description", "lang": "lead_time_days", "source": "weight_lb", "n_chars": "length_in"}


@register("conform_losses", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({src} IS NOT NULL AND TRY_CAST({src} AS {_sql_type(dict(SPECS['items'].columns)[c])}) IS NULL) AS lost FROM documents"
    for src, c in _AS_ITEMS.items()))
def q_conform_losses(t):
    return Q.conform_losses(t.documents.select(*[F.col(src).alias(c) for src, c in _AS_ITEMS.items()]), SPECS["items"].struct)
