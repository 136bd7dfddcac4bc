"""Brute force: the pipeline against a plain-Python model on random raw tables.

The model restates the semantics row by row (typing, de-duplication,
enrichment, join fan-out, lead time by enumerating days, prices, exact money
sums, top-1 and averages); hypothesis draws small raw tables full of messy
text.
"""

import datetime as dt
import math
import re
from decimal import Decimal

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tidemark.plans import retail as R
from tidemark.plans.options import PipelineOptions
from tidemark.plans.retail import RawTables

KEY_RX = re.compile(r"^[ \t\n\x0b\f\r]*([+-]?[0-9]+)([.]0*)?[ \t\n\x0b\f\r]*$")
INT_RX = re.compile(r"^[ \t\n\x0b\f\r]*([+-]?[0-9]+)([.][0-9]*)?[ \t\n\x0b\f\r]*$")

ids = st.sampled_from(["1", "2", " 3", "03", "4", "4.0", "x", " x", None, "5", "12", "12.5", "99999999999999999999"])
qtys = st.sampled_from(["1", "2", "3.0", " 4 ", "-1", "x", None])
prices = st.sampled_from(["10.5", "0", "2.25", " 7 ", "n/a", None, "100", "0.123457", "NaN", "1e20", "-Infinity"])
discounts = st.sampled_from(["0.0", "0.1", "0.05", "n/a", None, "1"])
dates = st.sampled_from(
    ["2024-01-05", "2024-01-08 00:00:00", "2024-01-10", "2024-02-01", "2024-01", "garbage", None, "2023-12-30"]
)
flags = st.sampled_from(["true", "FALSE", "1", " true", None, "True"])
colors = st.sampled_from(["Red", " Blue ", "", "   ", None, "Black"])
cats = st.sampled_from(["Bikes", "", "  ", None, "Clothing"])
subs = st.sampled_from(["Gloves", "Helmets", "Road Frames", "gloves", "Wheels", None, "Other", "mountain FRAMES"])

detail_rows = st.lists(st.tuples(ids, st.sampled_from(["1", "2", "3"]), qtys, ids, prices, discounts), max_size=14)
header_rows = st.lists(st.tuples(ids, dates, dates, flags, prices), max_size=8)
product_rows = st.lists(st.tuples(ids, colors, cats, subs), max_size=10)


def t_int(s, bits=32):
    if s is None:
        return None
    m = INT_RX.match(s)
    if not m:
        return None
    v = int(m.group(1))
    lim = 2 ** (bits - 1)
    return v if -lim <= v < lim else None


def t_key(s):
    if s is None:
        return None
    m = KEY_RX.match(s)
    v = int(m.group(1)) if m else None
    return v if v is not None and -(2**63) <= v < 2**63 else None


def t_double(s):
    if s is None:
        return None
    try:
        return float(s.strip())
    except ValueError:
        return None


def t_flag(s):
    if s is None:
        return None
    return {"true": True, "false": False}.get(s.lower())


def t_ts(s):
    """Spark's text -> timestamp for the generated forms; a month-only text
    is the first of the month (only OrderDate has the 7-character rule)."""
    if s is None:
        return None
    for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y-%m"):
        try:
            return dt.datetime.strptime(s, fmt)
        except ValueError:
            pass
    return None


def trim(s):
    return None if s is None else s.strip(" ")


def key(v):
    """Ascending, NULLs first (Spark's asc_nulls_first)."""
    return (v is not None, v if v is not None else 0)


def model(details, headers, products, impute):
    # store layer
    det = [
        dict(SalesOrderID=t_key(a), SalesOrderDetailID=t_key(b), OrderQty=t_int(q), ProductID=t_key(p),
             UnitPrice=t_double(u), UnitPriceDiscount=t_double(d))
        for a, b, q, p, u, d in details
    ]
    hdr = []
    for k, od, sd, fl, fr in headers:
        if od is not None and len(od) == 7:
            ship = t_ts(sd)
            odt = dt.datetime.combine(ship.date() - dt.timedelta(days=7), dt.time()) if (impute and ship) else None
        else:
            odt = t_ts(od)
        hdr.append(dict(SalesOrderID=t_key(k), OrderDate=odt, ShipDate=t_ts(sd), OnlineOrderFlag=t_flag(fl),
                        Freight=t_double(fr)))
    prod_cols = ["ProductID", "Color", "ProductCategoryName", "ProductSubCategoryName"]
    typed = [dict(product=t_key(i) if t_key(i) is not None else trim(i), ProductID=t_key(i), Color=trim(c), ProductCategoryName=trim(g), ProductSubCategoryName=trim(s))
             for i, c, g, s in products]
    best = {}
    for r in typed:
        blank = 1 if r["ProductCategoryName"] in (None, "") else 0
        rank = (blank,) + tuple(key(r[c]) for c in prod_cols[1:])
        if r["product"] not in best or rank < best[r["product"]][0]:
            best[r["product"]] = (rank, r)
    # publish product
    pub = {}
    for _, r in best.values():
        color = "N/A" if r["Color"] in (None, "") else r["Color"]
        cat, sub = r["ProductCategoryName"], r["ProductSubCategoryName"]
        if cat in (None, ""):
            if sub in ("Gloves", "Shorts", "Socks", "Tights", "Vests"):
                cat = "Clothing"
            elif sub in ("Locks", "Lights", "Headsets", "Helmets", "Pedals", "Pumps"):
                cat = "Accessories"
            elif sub is not None and (sub in ("Wheels", "Saddles") or "frames" in sub.lower()):
                cat = "Components"
        pub[r["product"]] = (r["ProductID"], color, cat)
    # publish orders
    lines = []
    for d in det:
        for h in hdr:
            if d["SalesOrderID"] is None or d["SalesOrderID"] != h["SalesOrderID"]:
                continue
            o, s = h["OrderDate"], h["ShipDate"]
            if o is None or s is None:
                lead = None
            else:
                lead, day = 0, o.date()
                while day < s.date():
                    lead += day.weekday() < 5
                    day += dt.timedelta(days=1)
            q, u, dc = d["OrderQty"], d["UnitPrice"], d["UnitPriceDiscount"]
            spec = None if None in (q, u, dc) else float(q) * (u - dc)
            _, color, cat = pub.get(d["ProductID"], (None, None, None)) if d["ProductID"] is not None else (None, None, None)
            lines.append(dict(d, OrderDate=o, lead=lead, spec=spec, year=o.year if o else None, color=color, cat=cat))
    return lines, hdr, pub


def total(values):
    """Exact sum of the ordinary amounts plus the double sum of the others."""
    fine = [Decimal(repr(v)) for v in values if abs(v) < 1e9]
    odd = [v for v in values if not abs(v) < 1e9]
    if not values:
        return None
    return float(sum(fine)) + sum(odd) if fine and odd else sum(odd) if odd else float(sum(fine))


# No shrinking: every example is a Spark job, and shrinking would take minutes.
@settings(
    max_examples=12,
    deadline=None,
    derandomize=True,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(detail_rows, header_rows, product_rows, st.booleans())
def test_pipeline_matches_model(spark, details, headers, products, impute):
    raw = RawTables(
        products=spark.createDataFrame(
            products, "ProductID string, Color string, ProductCategoryName string, ProductSubCategoryName string"
        ),
        detail=spark.createDataFrame(
            details,
            "SalesOrderID string, SalesOrderDetailID string, OrderQty string, ProductID string, "
            "UnitPrice string, UnitPriceDiscount string",
        ),
        header=spark.createDataFrame(
            headers, "SalesOrderID string, OrderDate string, ShipDate string, OnlineOrderFlag string, Freight string"
        ),
    )
    layers = R.build(raw, PipelineOptions(impute_orderdate=impute))
    lines, hdr, pub = model(details, headers, products, impute)

    # typed headers and the published product table
    got_h = [
        (r.SalesOrderID, r.OrderDate, r.ShipDate, r.OnlineOrderFlag, r.Freight)
        for r in layers.store_header.collect()
    ]
    want_h = [(h["SalesOrderID"], h["OrderDate"], h["ShipDate"], h["OnlineOrderFlag"], h["Freight"]) for h in hdr]
    assert sorted(map(repr, got_h)) == sorted(map(repr, want_h))
    got_p = [(r.ProductID, r.Color, r.ProductCategoryName) for r in layers.publish_product.collect()]
    assert sorted(map(repr, got_p)) == sorted(map(repr, pub.values()))

    got = [
        (r.SalesOrderID, r.SalesOrderDetailID, r.LeadTimeInBusinessDays, r.TotalLineExtendedPrice)
        for r in layers.publish_orders.collect()
    ]
    want = [(x["SalesOrderID"], x["SalesOrderDetailID"], x["lead"], x["spec"]) for x in lines]
    assert sorted(map(repr, got)) == sorted(map(repr, want))

    # revenue per (year, colour) -> top colour per year
    rev = {}
    for x in lines:
        k = (x["year"], x["color"])
        rev.setdefault(k, [])
        if x["spec"] is not None:
            rev[k].append(x["spec"])
    top = {}
    for (year, color), v in rev.items():
        v = total(v)
        # NaN is the largest
        rank = (v is None, v is None or not math.isnan(v), -(0.0 if v is None or math.isnan(v) else v), key(color))
        if year not in top or rank < top[year][0]:
            top[year] = (rank, color, v)
    assert {r.OrderYear: (r.Color, repr(r.Revenue)) for r in layers.top_color_by_year.collect()} == {
        y: (c, repr(v)) for y, (_, c, v) in top.items()
    }

    # mean lead per category (NULL leads ignored; all-NULL group -> NULL)
    groups = {}
    for x in lines:
        groups.setdefault(x["cat"], []).append(x["lead"])
    want_avg = {}
    for cat, leads in groups.items():
        vals = [v for v in leads if v is not None]
        want_avg[cat] = sum(vals) / len(vals) if vals else None
    got_avg = {r.ProductCategoryName: r.AvgLeadTimeInBusinessDays for r in layers.avg_lead_by_category.collect()}
    assert got_avg == want_avg
