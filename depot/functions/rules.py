"""Business-rule column functions (pure expressions, no UDFs).

Every function takes Columns (or column names) and returns a Column, so the
rules stay inside whole-stage codegen and compose with any DataFrame.
Where the source rule drew a random number from a range, the default is
the midpoint and the value is a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from depot import config as C


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def map_lookup(mapping: Mapping, key, default=None) -> Column:
    """Literal map lookup; a missing key gives ``default``."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    v = F.element_at(m, _c(key)) if not isinstance(key, str) else m[F.col(key)]
    return v if default is None else F.coalesce(v, F.lit(default))


# ---- B1 / B2: filters and clean numerics ---------------------------------
def status_is(col, status: str) -> Column:
    return _c(col) == F.lit(status)


def coerce_numeric(col, default=None, lo=None, hi=None, to: str = "double") -> Column:
    """Cast-or-null (``try_cast``), default fill, clip to [lo, hi]."""
    v = F.expr(f"try_cast({col} AS {to})") if isinstance(col, str) else _c(col).try_cast(to)
    if default is not None:
        v = F.coalesce(v, F.lit(default).cast(to))
    if lo is not None:
        v = F.greatest(v, F.lit(lo).cast(to))
    if hi is not None:
        v = F.least(v, F.lit(hi).cast(to))
    return v


# ---- B3: discounted line price -------------------------------------------
def discounted_price(unit_price, discount_pct) -> Column:
    """unit price x (1 - discount%), floored at 0, 2 dp."""
    d = F.coalesce(_c(discount_pct), F.lit(0))
    return F.round(F.greatest(F.lit(0), _c(unit_price) * (F.lit(1) - d / 100)), 2).cast("decimal(12,2)")


def extended_price(price, qty) -> Column:
    return F.round(_c(price) * _c(qty), 2).cast("decimal(14,2)")


# ---- B4 / B5: cube, density, dimensional weight --------------------------
def cube_from_dims(length, width, height) -> Column:
    return _c(length).cast("double") * _c(width) * _c(height) / C.CUBIC_INCHES_PER_FT


def fill_cube(cube, length, width, height) -> Column:
    """Keep a given cube; compute it from L x W x H only where it is null
    and all three dimensions are present."""
    dims_ok = _c(length).isNotNull() & _c(width).isNotNull() & _c(height).isNotNull()
    return F.when(_c(cube).isNotNull(), _c(cube).cast("double")).when(
        dims_ok, cube_from_dims(length, width, height))


def density(weight, cube) -> Column:
    """lb per cubic foot; null for a null or zero cube."""
    return F.when(_c(cube).isNull() | (_c(cube) == 0), F.lit(None).cast("double")).otherwise(
        _c(weight).cast("double") / _c(cube).cast("double"))


def dim_weight(length, width, height, divisor: float = C.DIM_WEIGHT_DIVISOR) -> Column:
    return _c(length).cast("double") * _c(width) * _c(height) / F.lit(divisor)


# ---- B6: freight class ----------------------------------------------------
def density_class(dens) -> Column:
    d = _c(dens)
    expr = F.when(d.isNull(), F.lit(C.NMFC_NULL_DENSITY))
    for bound, cls in C.NMFC_DENSITY_STEPS:
        expr = expr.when(d < bound, F.lit(cls))
    return expr.otherwise(F.lit(C.NMFC_DENSITY_TOP))


def freight_class(subcategory, category, dens) -> Column:
    """Subcategory override, then category override, then density steps."""
    return F.coalesce(map_lookup(C.NMFC_OVERRIDES, _c(subcategory)),
                      map_lookup(C.NMFC_OVERRIDES, _c(category)), density_class(dens))


# ---- B7 - B10: velocity and classes ---------------------------------------
def price_velocity(unit_price, base: float = 120.0, factor: float = 1.25) -> Column:
    """max(1, int(base / max(1, price) x factor)); factor: midpoint of 0.5..2."""
    return F.greatest(F.lit(1), (F.lit(base) / F.greatest(F.lit(1.0), _c(unit_price).cast("double"))
                                 * F.lit(factor)).cast("int"))


def velocity_class(velocity, a_min: float = 80, b_min: float = 30) -> Column:
    v = _c(velocity)
    return F.when(v > a_min, "A").when(v > b_min, "B").otherwise("C")


def abc_class(revenue, a_min: float | Column = 5000, b_min: float | Column = 1500) -> Column:
    r = _c(revenue)
    return F.when(r > a_min, "A").when(r > b_min, "B").otherwise("C")


def xyz_class(velocity, x_min: float | Column = 80, y_min: float | Column = 30) -> Column:
    v = _c(velocity)
    return F.when(v > x_min, "X").when(v > y_min, "Y").otherwise("Z")


def lifecycle_stage(item_id) -> Column:
    i = _c(item_id)
    return (F.when(i % 10 == 0, "End of Life").when(i % 7 == 0, "Mature")
            .when(i % 5 == 0, "Growth").otherwise("New"))


# ---- B11 - B13: item costs -------------------------------------------------
# duty rate by keyword in the category (midpoints of the source ranges)
DUTY_RATES = [(("chemical", "clean"), 0.085), (("electronics", "computer"), 0.04),
              (("furniture",), 0.055), (("industrial",), 0.07)]
DUTY_OTHER = 0.02


def duty_rate(category) -> Column:
    c = F.lower(_c(category))
    expr = F.when(c.isNull(), F.lit(0.0))
    for words, rate in DUTY_RATES:
        cond = None
        for w in words:
            cond = c.contains(w) if cond is None else (cond | c.contains(w))
        expr = expr.when(cond, F.lit(rate))
    return expr.otherwise(F.lit(DUTY_OTHER))


def unit_freight(cube, weight, per_cuft: float = 0.125, per_10lb: float = 0.065) -> Column:
    """0.15 + cube x a + weight/10 x b, at least 0.05 (a, b: range midpoints).
    Exact decimal arithmetic on 4-dp inputs."""
    cu = F.coalesce(_c(cube).cast("decimal(12,4)"), F.lit(0).cast("decimal(12,4)"))
    wt = F.coalesce(_c(weight).cast("decimal(12,4)"), F.lit(0).cast("decimal(12,4)"))
    return F.greatest(F.lit(0.05).cast("decimal(4,2)"),
                      F.lit(0.15).cast("decimal(4,2)") + cu * F.lit(per_cuft).cast("decimal(8,4)")
                      + wt * F.lit(per_10lb / 10).cast("decimal(8,5)"))


def landed_costs(unit_cost, unit_price, freight, duty, replacement_factor: float = 1.045,
                 margin_factor: float = 1.225) -> dict[str, Column]:
    """duty amount, landed, replacement and MAP price (4 dp, decimal)."""
    uc = _c(unit_cost).cast("decimal(18,6)")
    duty_amount = uc * _c(duty).cast("decimal(10,4)")
    landed = F.round(uc + _c(freight).cast("decimal(18,6)") + duty_amount, 4)
    repl = F.round(landed * F.lit(replacement_factor).cast("decimal(10,4)"), 4)
    map_price = F.round(F.greatest(_c(unit_price).cast("decimal(18,6)") * F.lit(0.8).cast("decimal(3,2)"),
                                   landed * F.lit(margin_factor).cast("decimal(10,4)")), 4)
    return {"duty_amount": F.round(duty_amount, 4).cast("decimal(18,4)"),
            "landed_cost": landed.cast("decimal(18,4)"),
            "replacement_cost": repl.cast("decimal(18,4)"),
            "map_price": map_price.cast("decimal(18,4)")}


# ---- B14 / B15: seasonality and forecast error -----------------------------
def seasonality_index(category, month) -> Column:
    """Category x month multiplier (midpoints of the source ranges)."""
    c = F.lower(_c(category))
    m = _c(month)
    return (F.when(c.contains("office"), F.when(m.isin(8, 9), 1.175).otherwise(1.0))
            .when(c.contains("clean"), F.when(m.isin(3, 4, 5), 1.2).otherwise(0.975))
            .when(c.contains("break"), F.when(m.isin(11, 12), 1.25).otherwise(0.975))
            .otherwise(1.0))


MAPE_BASE = C.MAPE_BASE
XYZ_VARIABILITY = C.XYZ_VARIABILITY


def forecast_error(abc, xyz, noise: float = 1.05, mad_factor: float = 14.0) -> tuple[Column, Column]:
    """MAPE = base[ABC] x variability[XYZ] x noise; MAD = MAPE x k (4 dp)."""
    mape = F.round(map_lookup(MAPE_BASE, _c(abc)) * map_lookup(XYZ_VARIABILITY, _c(xyz)) * F.lit(noise), 4)
    return mape, F.round(mape * F.lit(mad_factor), 4)


# ---- B16: DC time zone -----------------------------------------------------
def time_zone(state) -> Column:
    """State -> zone by scanning the zone map in order; default Central."""
    s = _c(state)
    expr = None
    for zone, states in C.TIME_ZONES.items():
        expr = (F.when(s.isin(*states), F.lit(zone)) if expr is None
                else expr.when(s.isin(*states), F.lit(zone)))
    return expr.otherwise(F.lit(C.DEFAULT_TIME_ZONE))


# ---- B17: business codes --------------------------------------------------
def invoice_number(order_id) -> Column:
    return F.format_string("INV-%08d", _c(order_id).cast("long"))


def po_number(dc_id, seq) -> Column:
    return F.format_string("PO-%03d-%08d", _c(dc_id).cast("long"), _c(seq).cast("long"))


def promo_code(year, seq) -> Column:
    return F.format_string("PROMO-%d-%04d", _c(year).cast("int"), _c(seq).cast("long"))


def account_number(prefix: str, n) -> Column:
    return F.format_string(f"{prefix}%06d", _c(n).cast("long"))


def vendor_item_number(vendor_name, item_id) -> Column:
    return F.concat(F.upper(F.substring(_c(vendor_name), 1, 3)), F.lit("-"),
                    F.format_string("%06d", _c(item_id).cast("long")))


def carton_code(order_id, seq) -> Column:
    return F.concat(_c(order_id).cast("string"), F.lit("-C"), _c(seq).cast("string"))


# ---- B18: timestamp normalisation -----------------------------------------
def normalize_timestamp(ts, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse-or-null, move the US spring-gap hour (2nd Sunday of March, 02h)
    and fall-ambiguous hour (1st Sunday of November, 01h) forward one hour,
    and format."""
    t = _c(ts) if not isinstance(ts, str) else F.expr(f"try_to_timestamp(CAST({ts} AS STRING))")
    month, day, hour = F.month(t), F.dayofmonth(t), F.hour(t)
    sunday = F.dayofweek(t) == 1
    spring = (month == 3) & day.between(8, 14) & sunday & (hour == 2)
    fall = (month == 11) & day.between(1, 7) & sunday & (hour == 1)
    shifted = F.when(spring | fall, t + F.expr("INTERVAL 1 HOUR")).otherwise(t)
    return F.date_format(shifted, fmt)


# ---- B19 - B21: invoices and receivables ------------------------------------
def tax_rate(exempt_flag, rate: float = C.DEFAULT_TAX_RATE) -> Column:
    """0 when the exempt flag is Y (any case), else ``rate``; missing -> rate."""
    return F.when(F.upper(F.coalesce(_c(exempt_flag), F.lit("N"))) == "Y", F.lit(0.0)).otherwise(F.lit(rate))


def days_past_due(as_of, due_date, balance) -> Column:
    d = F.greatest(F.lit(0), F.datediff(_c(as_of), _c(due_date)))
    return F.when(_c(balance) <= 0, F.lit(0)).otherwise(d)


def aging_bucket(days) -> Column:
    d = _c(days)
    return (F.when(d == 0, "Current").when(d.between(1, 30), "1-30").when(d.between(31, 60), "31-60")
            .when(d.between(61, 90), "61-90").when(d.between(91, 9999), "90+").otherwise("Unknown"))


# ---- B22: return credit -----------------------------------------------------
CONDITION_FACTOR = C.CONDITION_FACTOR


def return_credit(unit_price, qty, condition) -> Column:
    f = map_lookup(CONDITION_FACTOR, _c(condition)).cast("decimal(4,2)")
    return F.round(_c(unit_price).cast("decimal(12,2)") * _c(qty) * f, 2).cast("decimal(14,2)")


def restock_flag(condition) -> Column:
    return _c(condition) == F.lit("Resalable")


# ---- B23 / B24: slotting -----------------------------------------------------
def slotting_rank(velocity, cube, weight, offset: float = 0.0) -> Column:
    """max(1, int(100 - velocity + cube x 10 + weight x 0.5 + offset)); null
    or zero size -> 0.1 ft3 / 1.0 lb."""
    cu = F.coalesce(F.nullif(_c(cube).cast("double"), F.lit(0.0)), F.lit(0.1))
    wt = F.coalesce(F.nullif(_c(weight).cast("double"), F.lit(0.0)), F.lit(1.0))
    return F.greatest(F.lit(1), (F.lit(100) - _c(velocity) + cu * 10 + wt * 0.5 + F.lit(offset)).cast("int"))


def location_code(aisle, bay, level) -> Column:
    return F.format_string("A%02d-B%02d-L%02d", _c(aisle).cast("int"), _c(bay).cast("int"), _c(level).cast("int"))


def split_location(code) -> dict[str, Column]:
    pat = r"^A(\d+)-B(\d+)-L(\d+)$"
    return {p: F.regexp_extract(_c(code), pat, i + 1).cast("int")
            for i, p in enumerate(["aisle", "bay", "level"])}


# ---- B25: vendor rank and order quantities ------------------------------------
def vendor_rank(fill_rate, on_time_rate) -> Column:
    score = (_c(fill_rate) * 0.5 + _c(on_time_rate) * 0.5)
    return F.greatest(F.lit(1), F.least(F.lit(5), F.rint((F.lit(1) - score) * 5).cast("int")))


def scaled_qty(base, rank) -> Column:
    """max(1, int(base x rank / 3))."""
    return F.greatest(F.lit(1), (_c(base) * _c(rank) / F.lit(3.0)).cast("int"))


def order_multiple_base(cube, small: int = 2, medium: int = 5, large: int = 10) -> Column:
    """Cube band -> base multiple (the middle choice of each band)."""
    c = F.coalesce(_c(cube).cast("double"), F.lit(0.1))
    return F.when(c < 0.1, F.lit(small)).when(c < 0.5, F.lit(medium)).otherwise(F.lit(large))


# ---- B26 / B27: purchase orders ---------------------------------------------
def po_dates(restock_date, lead_days, status, offset_days: int = 1) -> dict[str, Column]:
    po = F.date_sub(_c(restock_date), _c(lead_days).cast("int"))
    expected = F.date_add(po, _c(lead_days).cast("int"))
    actual = F.greatest(F.date_add(expected, F.lit(offset_days)), po)
    return {"po_date": po, "expected_receipt_date": expected,
            "actual_receipt_date": F.when(_c(status) == "Open", F.lit(None).cast("date")).otherwise(actual)}


def po_received_qty(status, qty, fill_rate, partial_multiplier: float = 0.675) -> Column:
    q = _c(qty)
    fr = _c(fill_rate).cast("double")
    recv = F.least(F.greatest(F.rint(fr * q).cast("int"), F.lit(0)), q)
    part = F.least(F.greatest(F.rint(fr * q * partial_multiplier).cast("int"), F.lit(1)),
                   F.greatest(q, F.lit(1)))
    s = _c(status)
    return F.when(s == "Received", recv).when(s == "Partial", part).otherwise(F.lit(0))


# ---- B28 - B30: inventory ----------------------------------------------------
def cost_triplet(base_cost, region_factor: float = 1.015, dc_factor: float = 1.0,
                 last_factor: float = 1.005) -> dict[str, Column]:
    std = _c(base_cost).cast("double") * region_factor * dc_factor
    last = std * last_factor
    return {"std_cost": F.round(std, 2).cast("decimal(12,2)"),
            "last_cost": F.round(last, 2).cast("decimal(12,2)"),
            "avg_cost": F.round((std + last) / 2, 2).cast("decimal(12,2)")}


AGING_SHARES = (0.55, 0.175, 0.10)


def aging_split(qty, shares: Sequence[float] = AGING_SHARES) -> dict[str, Column]:
    """int-truncated shares; the remainder goes to 90+ so buckets sum to qty."""
    q = F.greatest(_c(qty), F.lit(0))
    a = (q * F.lit(shares[0])).cast("int")
    b = (q * F.lit(shares[1])).cast("int")
    c = (q * F.lit(shares[2])).cast("int")
    return {"aging_0_30": a, "aging_31_60": b, "aging_61_90": c,
            "aging_90_plus": F.greatest(F.lit(0), q - (a + b + c))}


# (obsolete share, excess share) by lifecycle: midpoints of the source ranges
LIFECYCLE_SHARES = {"End of Life": (0.35, 0.20), "Mature": (0.10, 0.125)}
LIFECYCLE_DEFAULT = (0.025, 0.05)


def stock_health(on_hand, allocated, velocity, lifecycle) -> dict[str, Column]:
    avail = F.greatest(F.lit(0), _c(on_hand) - _c(allocated))
    daily = F.greatest(F.lit(1.0), _c(velocity) / F.lit(30.0))
    lc = _c(lifecycle)

    def share(i):
        e = None
        for k, v in LIFECYCLE_SHARES.items():
            e = F.when(lc == k, F.lit(v[i])) if e is None else e.when(lc == k, F.lit(v[i]))
        return e.otherwise(F.lit(LIFECYCLE_DEFAULT[i]))

    return {"quantity_available": avail,
            "days_on_hand": (avail / daily).cast("int"),
            "obsolete_quantity": (_c(on_hand) * share(0)).cast("int"),
            "excess_quantity": (_c(on_hand) * share(1)).cast("int")}


CYCLE_COUNT_ACCURACY = {"A": 0.97, "B": 0.93, "C": 0.86}


# ---- B31: shipment dates -------------------------------------------------------
def shipment_dates(order_date, lag_days, transit_days, delay_days) -> dict[str, Column]:
    ship = F.date_add(_c(order_date), _c(lag_days).cast("int"))
    promised = F.date_add(ship, _c(transit_days).cast("int"))
    return {"ship_date": ship, "promised_date": promised,
            "delivery_date": F.date_add(promised, _c(delay_days).cast("int"))}


# ---- B32: labor ------------------------------------------------------------------
DEPARTMENT_BASE_HOURS = C.DEPARTMENT_BASE_HOURS
DEPARTMENT_ROLE = C.DEPARTMENT_ROLE
# hourly rate: midpoint of each department's range
DEPARTMENT_RATE = {k: (lo + hi) / 2 for k, (lo, hi) in C.DEPARTMENT_RATE_RANGE.items()}
OVERTIME_MULTIPLIER = C.OVERTIME_MULTIPLIER


def labor_hours(department, capacity, load_factor=1.0) -> Column:
    scale = F.greatest(F.coalesce(_c(capacity).cast("double"), F.lit(50000.0)) / 50000.0, F.lit(0.2))
    h = map_lookup(DEPARTMENT_BASE_HOURS, _c(department)).cast("double") * scale * _c(load_factor)
    return F.round(F.greatest(h, F.lit(1.0)), 2)


def labor_rate(department, labor_type) -> Column:
    r = map_lookup(DEPARTMENT_RATE, _c(department)).cast("double")
    return F.round(F.when(_c(labor_type) == "Overtime", r * OVERTIME_MULTIPLIER).otherwise(r), 2)


def headcount(hours) -> Column:
    return F.greatest(F.lit(1), F.floor(_c(hours) / 40.0).cast("int"))


# ---- B33: contact role ---------------------------------------------------------------
def contact_role(segment, is_sub) -> Column:
    return (F.when(_c(segment).isin("Government", "Education"), "CS Rep")
            .when(_c(is_sub), "Inside Sales").otherwise("Account Manager"))
