"""DuckDB SQL oracles, one per registered query.

Each oracle states the operator's definition directly (an edge list, a sum per
step, elimination of the normal equations), over the same mapped tables
(``mercato.sources.fixture``) and, for doubles, with the same final snapping.
Building blocks are SQL fragments (CTE bodies) composed per query.
"""

from __future__ import annotations

from mercato.compare import canonical_sql
from mercato.sources.fixture import CTE_NAMES, oracle_ctes
from mercato.sources.schemas import SCHEMAS

DAY = "86400000000.0"
MONTH = "2629746000000.0"


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    s_dlat = f"sin((radians({lat2}) - radians({lat1})) / 2.0)"
    s_dlon = f"sin((radians({lon2}) - radians({lon1})) / 2.0)"
    a = f"{s_dlat} * {s_dlat} + cos(radians({lat1})) * cos(radians({lat2})) * {s_dlon} * {s_dlon}"
    return f"12742.0 * asin(sqrt(least({a}, 1.0)))"


def days(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / {DAY})"


# ---------------------------------------------------------------- fragments
F = {}
F["wait"] = f"""
wait as (
  select order_id, order_status, wait_time, expected_wait_time,
    case when wait_time - expected_wait_time <= 0 then 0.0 else wait_time - expected_wait_time end as delay_vs_expected
  from (select order_id, order_status,
          {days('order_purchase_timestamp', 'order_delivered_customer_date')} as wait_time,
          {days('order_purchase_timestamp', 'order_estimated_delivery_date')} as expected_wait_time
        from m_orders where order_status = 'delivered') w0)"""
F["rev"] = """
rev as (
  select order_id, review_score,
    case when review_score = 5 then 1 else 0 end as dim_is_five_star,
    case when review_score = 1 then 1 else 0 end as dim_is_one_star
  from m_order_reviews)"""
F["istats"] = """
istats as (
  select order_id, count(*) as number_of_products, count(seller_id) as number_of_sellers,
    coalesce(sum(price), 0.0) as price, coalesce(sum(freight_value), 0.0) as freight_value
  from m_order_items where order_id is not null group by order_id)"""
F["geo"] = """
geo as (
  select geolocation_zip_code_prefix as zip,
    arg_min(geolocation_lat, ordinal) as lat, arg_min(geolocation_lng, ordinal) as lng
  from m_geolocation where geolocation_zip_code_prefix is not null group by 1)"""
F["idist"] = f"""
sloc as (select s.seller_id, g.lat as seller_lat, g.lng as seller_lng
         from m_sellers s join geo g on s.seller_zip_code_prefix = g.zip),
oloc as (select o.order_id, g.lat as customer_lat, g.lng as customer_lng
         from m_orders o join m_customers c on o.customer_id = c.customer_id
         join geo g on c.customer_zip_code_prefix = g.zip),
idist as (
  select i.order_id, i.order_item_id, i.product_id, i.seller_id,
    {haversine_sql('customer_lng', 'customer_lat', 'seller_lng', 'seller_lat')} as distance_seller_customer
  from m_order_items i join sloc using (seller_id) join oloc using (order_id))"""
F["dist"] = """
dist as (select order_id, avg(distance_seller_customer) as distance_seller_customer from idist group by order_id)"""
F["training"] = """
training as (
  select order_id, order_status, wait_time, expected_wait_time, delay_vs_expected,
    review_score, dim_is_five_star, dim_is_one_star, number_of_products, number_of_sellers,
    price, freight_value, distance_seller_customer
  from wait join rev using (order_id) join istats using (order_id) join dist using (order_id)
  where wait_time is not null and expected_wait_time is not null and delay_vs_expected is not null
    and review_score is not null and price is not null and freight_value is not null
    and distance_seller_customer is not null and order_status is not null)"""

TRAINING_DEPS = ["wait", "rev", "istats", "geo", "idist", "dist", "training"]


def with_fragments(names: list[str], body: str) -> str:
    return oracle_ctes() + "".join(",\n" + F[n].strip() for n in names) + "\n" + body


ORACLES: dict[str, tuple[str, list[str]]] = {}


def register(name: str, deps: list[str], body: str, doubles: list[str]) -> None:
    ORACLES[name] = (with_fragments(deps, body), doubles)


def oracle_sql() -> dict[str, str]:
    return {name: canonical_sql(core, doubles) for name, (core, doubles) in ORACLES.items()}


# ---------------------------------------------------------------- orders
register("order_wait_time", ["wait"], "select * from wait",
         ["wait_time", "expected_wait_time", "delay_vs_expected"])
register("order_review_score", ["rev"], "select * from rev", [])
register("order_number_products", ["istats"], "select order_id, number_of_products from istats", [])
register("order_number_sellers", ["istats"], "select order_id, number_of_sellers from istats", [])
register("order_price_freight", ["istats"], "select order_id, price, freight_value from istats",
         ["price", "freight_value"])
register("haversine_km", ["geo", "idist"], "select * from idist", ["distance_seller_customer"])
register("order_distance", ["geo", "idist", "dist"], "select * from dist", ["distance_seller_customer"])
register("order_training", TRAINING_DEPS, "select * from training",
         ["wait_time", "expected_wait_time", "delay_vs_expected", "price", "freight_value",
          "distance_seller_customer"])


F["wait_any"] = F["wait"].replace(" where order_status = 'delivered'", "")
F["istats_distinct"] = F["istats"].replace("count(seller_id)", "count(distinct seller_id)")
_no_distance = F["training"].replace("price, freight_value, distance_seller_customer", "price, freight_value").replace(" join dist using (order_id)", "").replace("\n    and distance_seller_customer is not null", "")
_DOUBLES = ["wait_time", "expected_wait_time", "delay_vs_expected", "price", "freight_value"]


def swapped(old: str, new: str) -> list[str]:
    return [new if d == old else d for d in TRAINING_DEPS]


F["training_without_distance"] = _no_distance
register("order_training_any_status", swapped("wait", "wait_any"), "select * from training", [*_DOUBLES, "distance_seller_customer"])
register("order_training_without_distance", ["wait", "rev", "istats", "training_without_distance"], "select * from training", _DOUBLES)
register("order_training_bucketed", ["wait", "rev", "istats", "training_without_distance"], "select * from training", _DOUBLES)
register("order_training_distinct_sellers", swapped("istats", "istats_distinct"), "select * from training", [*_DOUBLES, "distance_seller_customer"])
register("order_number_sellers_distinct", ["istats_distinct"], "select order_id, number_of_sellers from istats", [])

# ---------------------------------------------------------------- products
F["pfeat"] = """
pfeat as (
  select p.product_id, p.product_name_lenght as product_name_length,
    p.product_description_lenght as product_description_length, p.product_photos_qty,
    p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
    t.product_category_name_english as category
  from m_products p join m_translation t on p.product_category_name = t.product_category_name)"""
F["pstats"] = """
pstats as (
  select product_id, avg(price) as price, count(distinct order_id) as n_orders,
    count(order_id) as quantity, coalesce(sum(price), 0.0) as sales
  from m_order_items where product_id is not null group by product_id)"""
F["ppairs"] = """
ppairs as (select distinct order_id, product_id from m_order_items)"""
F["pwait"] = """
pwait as (
  select product_id, avg(wait_time) as wait_time
  from ppairs join wait using (order_id) where product_id is not null group by product_id)"""
F["prev"] = """
prev as (
  select product_id, avg(dim_is_one_star) as share_of_one_stars,
    avg(dim_is_five_star) as share_of_five_stars, avg(review_score) as review_score
  from ppairs join rev using (order_id) where product_id is not null group by product_id)"""
F["ptrain"] = """
ptrain as (
  select product_id, product_name_length, product_description_length, product_photos_qty,
    product_weight_g, product_length_cm, product_height_cm, product_width_cm, category,
    wait_time, price, share_of_one_stars, share_of_five_stars, review_score, n_orders, quantity, sales
  from pfeat join pwait using (product_id) join pstats using (product_id) join prev using (product_id))"""

register("product_features", ["pfeat"], "select * from pfeat", [])
register("product_price", ["pstats"], "select product_id, price from pstats", ["price"])
register("product_quantity", ["pstats"], "select product_id, n_orders, quantity from pstats", [])
register("product_sales", ["pstats"], "select product_id, sales from pstats", ["sales"])
register("product_wait_time", ["wait", "ppairs", "pwait"], "select * from pwait", ["wait_time"])
register("product_review_score", ["rev", "ppairs", "prev"], "select * from prev",
         ["share_of_one_stars", "share_of_five_stars", "review_score"])
register("product_training", ["wait", "rev", "pfeat", "pstats", "ppairs", "pwait", "prev", "ptrain"],
         "select * from ptrain",
         ["wait_time", "price", "share_of_one_stars", "share_of_five_stars", "review_score", "sales"])


# ---------------------------------------------------------------- sellers
F["sfeat"] = """
sfeat as (select distinct seller_id, seller_city, seller_state from m_sellers)"""
F["sdelay"] = f"""
sdelay as (
  select seller_id, case when avg(d) > 0 then avg(d) else 0.0 end as delay_to_carrier, avg(w) as wait_time
  from (select i.seller_id,
          {days('i.shipping_limit_date', 'o.order_delivered_carrier_date')} as d,
          {days('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} as w
        from m_order_items i join m_orders o on i.order_id = o.order_id
        where o.order_status = 'delivered') x
  where seller_id is not null group by seller_id)"""
F["sdates"] = f"""
sdates as (
  select seller_id, min(a) as date_first_sale, max(a) as date_last_sale,
    cast(round_even(date_diff('microsecond', min(a), max(a)) / {MONTH}, 0) as double) as months_on_olist
  from (select distinct o.order_id, i.seller_id, o.order_approved_at as a
        from m_orders o join m_order_items i on o.order_id = i.order_id
        where o.order_approved_at is not null and o.order_id is not null) x
  where seller_id is not null group by seller_id)"""
F["sstats"] = """
sstats as (
  select seller_id, count(distinct order_id) as n_orders, count(order_id) as quantity,
    case when count(distinct order_id) = 0 then null
         else count(order_id) / count(distinct order_id) end as quantity_per_order,
    coalesce(sum(price), 0.0) as sales
  from m_order_items where seller_id is not null group by seller_id)"""
F["spairs"] = """
spairs as (select distinct order_id, seller_id from m_order_items)"""
F["srev"] = """
srev as (
  select seller_id, avg(dim_is_one_star) as share_of_one_stars,
    avg(dim_is_five_star) as share_of_five_stars, avg(review_score) as review_score
  from spairs join rev using (order_id) where seller_id is not null group by seller_id)"""
F["scounts"] = """
scounts as (
  select seller_id,
    cast(sum(case when review_score = 5 then 1 else 0 end) as bigint) as dim_is_five_star,
    cast(sum(case when review_score = 4 then 1 else 0 end) as bigint) as dim_is_four_star,
    cast(sum(case when review_score = 3 then 1 else 0 end) as bigint) as dim_is_three_star,
    cast(sum(case when review_score = 2 then 1 else 0 end) as bigint) as dim_is_two_star,
    cast(sum(case when review_score = 1 then 1 else 0 end) as bigint) as dim_is_one_star
  from spairs join training using (order_id) where seller_id is not null group by seller_id)"""
F["scosts"] = """
scosts as (
  select seller_id, dim_is_three_star * 40 + dim_is_two_star * 50 + dim_is_one_star * 100 as review_costs
  from scounts)"""
F["srevenue"] = """
srevenue as (
  select seller_id, sales * 0.1 + months_on_olist * 80 as revenue from sstats join sdates using (seller_id))"""
F["sprofits"] = """
sprofits as (
  select seller_id, revenue, review_costs, revenue - review_costs as profits
  from srevenue join scosts using (seller_id))"""
F["strain"] = """
strain as (
  select seller_id, seller_city, seller_state, delay_to_carrier, wait_time, date_first_sale,
    date_last_sale, months_on_olist, n_orders, quantity, quantity_per_order, sales, revenue,
    review_costs, profits, share_of_one_stars, share_of_five_stars, review_score
  from sfeat join sdelay using (seller_id) join sdates using (seller_id) join sstats using (seller_id)
    join sprofits using (seller_id) join srev using (seller_id))"""

SELLER_TRAINING_DEPS = TRAINING_DEPS + [
    "sfeat", "sdelay", "sdates", "sstats", "spairs", "srev", "scounts", "scosts", "srevenue", "sprofits",
    "strain"]

register("seller_features", ["sfeat"], "select * from sfeat", [])
register("seller_delay_wait", ["sdelay"], "select * from sdelay", ["delay_to_carrier", "wait_time"])
register("seller_active_dates", ["sdates"], "select * from sdates", ["months_on_olist"])
register("seller_quantity", ["sstats"], "select seller_id, n_orders, quantity, quantity_per_order from sstats",
         ["quantity_per_order"])
register("seller_sales", ["sstats"], "select seller_id, sales from sstats", ["sales"])
register("seller_review_score", ["rev", "spairs", "srev"], "select * from srev",
         ["share_of_one_stars", "share_of_five_stars", "review_score"])
register("seller_review_counts", TRAINING_DEPS + ["spairs", "scounts"], "select * from scounts", [])
register("seller_review_costs", TRAINING_DEPS + ["spairs", "scounts", "scosts"], "select * from scosts", [])
register("seller_revenue", ["sdates", "sstats", "srevenue"], "select * from srevenue", ["revenue"])
register("seller_profits", TRAINING_DEPS + ["sdates", "sstats", "spairs", "scounts", "scosts", "srevenue",
                                            "sprofits"], "select * from sprofits", ["revenue", "profits"])
register("seller_training", SELLER_TRAINING_DEPS, "select * from strain",
         ["delay_to_carrier", "wait_time", "months_on_olist", "quantity_per_order", "sales", "revenue",
          "profits", "share_of_one_stars", "share_of_five_stars", "review_score"])


# ---------------------------------------------------------------- what-if
def it_sql(n: str, q: str) -> str:
    return f"(3157.27 * sqrt(cast({n} as double)) + 978.23 * sqrt(cast({q} as double)))"


F["wtot"] = """
wtot as (select count(*) as n, coalesce(sum(profits), 0.0) as p, coalesce(sum(quantity), 0) as q from strain)"""
F["wrank"] = """
wrank as (
  select seller_id, profits, quantity, row_number() over (order by profits, seller_id) as k from strain)"""
F["wcurve"] = f"""
wcurve as (
  select cast(j as bigint) as Dropped_sellers,
    coalesce(sum(profits) filter (where k > j), 0.0)
      - {it_sql('count(*) filter (where k > j)', 'coalesce(sum(quantity) filter (where k > j), 0)')} as profit
  from wrank, range((select n + 1 from wtot)) steps(j) group by j),
wfall as (
  select min(Dropped_sellers) as k from (
    select Dropped_sellers, profit, lag(profit) over (order by Dropped_sellers) as before from wcurve) w where profit < before)"""

WHATIF_DEPS = SELLER_TRAINING_DEPS + ["wtot", "wrank", "wcurve"]


def cents(x: str) -> str:
    return f"cast(round_even({x} * 100, 0) as double) / 100"


register("it_costs", SELLER_TRAINING_DEPS + ["wtot"],
         f"select n as n_sellers, cast(q as bigint) as n_products, {it_sql('n', 'q')} as it_costs from wtot",
         ["it_costs"])
register("global_profit", SELLER_TRAINING_DEPS + ["wtot"],
         f"""select n as n_sellers, cast(q as bigint) as n_products, p as total_profits,
               {it_sql('n', 'q')} as it_costs, p - {it_sql('n', 'q')} as global_profit from wtot""",
         ["total_profits", "it_costs", "global_profit"])
register("sellers_by_profit", SELLER_TRAINING_DEPS + ["wrank"],
         "select seller_id, profits, cast(quantity as bigint) as quantity, k as profit_rank from wrank",
         ["profits"])
register("whatif_curve", WHATIF_DEPS,
         f"select Dropped_sellers, {cents('profit')} as Profit from wcurve", ["Profit"])
register("whatif_greedy_optimum", WHATIF_DEPS,
         f"""select Dropped_sellers, {cents('profit')} as Profit from wcurve
             where Dropped_sellers = coalesce((select k - 1 from wfall), (select n from wtot))""", ["Profit"])
register("whatif_greedy_log", WHATIF_DEPS,
         f"""select Dropped_sellers, {cents('profit')} as Profit from wcurve
             where Dropped_sellers <= coalesce((select k from wfall), (select n from wtot))""", ["Profit"])
register("whatif_global_optimum", WHATIF_DEPS,
         f"""select Dropped_sellers, {cents('profit')} as Profit from wcurve
             order by profit desc, Dropped_sellers asc limit 1""", ["Profit"])
register("worst_sellers", SELLER_TRAINING_DEPS,
         "select * from strain order by profits, seller_id limit 200",
         ["delay_to_carrier", "wait_time", "months_on_olist", "quantity_per_order", "sales", "revenue",
          "profits", "share_of_one_stars", "share_of_five_stars", "review_score"])


# ---------------------------------------------------------------- statistics
ORDER_NUMERIC = [
    "wait_time", "expected_wait_time", "delay_vs_expected", "review_score", "dim_is_five_star",
    "dim_is_one_star", "number_of_products", "number_of_sellers", "price", "freight_value",
    "distance_seller_customer",
]
ZCOLS = ["wait_time", "delay_vs_expected", "number_of_products", "number_of_sellers", "price",
         "freight_value", "distance_seller_customer"]
TRAINING_DOUBLES = ["wait_time", "expected_wait_time", "delay_vs_expected", "price", "freight_value",
                    "distance_seller_customer"]


def dbl(v: float) -> str:
    return f"cast({float(v)!r} as double)"


def edges_sql(lo: str, hi: str, bins: int) -> str:
    """``bin, bin_lo, bin_hi`` of an equal-width grid."""
    edge = lambda i: f"(case when {i} = {bins} then {hi} else cast({i} as double) * (({hi} - {lo}) / {bins}) + {lo} end)"
    return f"(select cast(i as integer) as bin, {edge('i')} as bin_lo, {edge('(i + 1)')} as bin_hi from range({bins}) r(i))"


def inside(x: str, bins: int) -> str:
    return f"({x} >= bin_lo and ({x} < bin_hi or (bin = {bins - 1} and {x} = bin_hi)))"


def hist_sql(src: str, x: str, lo: float | str, hi: float | str, bins: int) -> str:
    lo, hi = (v if isinstance(v, str) else dbl(v) for v in (lo, hi))
    return f"""
select bin, bin_lo, bin_hi, count(s.v) as count from {edges_sql(lo, hi, bins)} e
left join (select cast({x} as double) as v from {src}) s on {inside('s.v', bins)} group by all"""


def hist_by_sql(src: str, x: str, by: str, lo: float, hi: float, bins: int) -> str:
    return f"""
select {by}, bin, bin_lo, bin_hi, count(*) filter ({inside(x, bins)}) as count
from {src}, {edges_sql(dbl(lo), dbl(hi), bins)} e where {by} is not null group by all"""


F["rounded"] = """
rounded as (select * replace (cast(round_even(wait_time, 0) as double) as wait_time) from training)"""

register("describe_column", TRAINING_DEPS,
         """select 'wait_time' as variable, count(wait_time) as count, avg(wait_time) as mean,
              stddev_samp(wait_time) as std, min(wait_time) as min,
              quantile_cont(wait_time, 0.25) as p25, quantile_cont(wait_time, 0.5) as p50,
              quantile_cont(wait_time, 0.75) as p75, max(wait_time) as max from training""",
         ["mean", "std", "min", "p25", "p50", "p75", "max"])
register("histogram", TRAINING_DEPS, hist_sql("training", "freight_value", 0.0, 80.0, 20), ["bin_lo", "bin_hi"])
register("histogram_by", TRAINING_DEPS + ["rounded"],
         hist_by_sql("rounded", "wait_time", "review_score", 0.0, 50.0, 10), ["bin_lo", "bin_hi"])
register("histogram_by_price", TRAINING_DEPS,
         hist_by_sql("training", "price", "review_score", 0.0, 50.0, 10), ["bin_lo", "bin_hi"])
register("histogram_by_freight", TRAINING_DEPS,
         hist_by_sql("training", "freight_value", "review_score", 0.0, 50.0, 10), ["bin_lo", "bin_hi"])
register("round_column", TRAINING_DEPS + ["rounded"], "select * from rounded", TRAINING_DOUBLES)
register("preview", TRAINING_DEPS, "select * from training order by order_id, review_score limit 5",
         TRAINING_DOUBLES)


def _corr_sql() -> str:
    aggs, rows = [], []
    for i, a in enumerate(ORDER_NUMERIC):
        for b in ORDER_NUMERIC[i:]:
            xa, xb = f"cast({a} as double)", f"cast({b} as double)"
            aggs.append(f"covar_pop({xa}, {xb}) as cov__{a}__{b}, var_pop({xa}) as va__{a}__{b}, "
                        f"var_pop({xb}) as vb__{a}__{b}")
    for i, a in enumerate(ORDER_NUMERIC):
        for j, b in enumerate(ORDER_NUMERIC):
            p, q = (a, b) if i <= j else (b, a)
            den = f"sqrt(va__{p}__{q} * vb__{p}__{q})"
            rows.append(f"select '{a}' as x, '{b}' as y, case when {den} > 0 then cov__{p}__{q} / {den} end as corr from mom")
    return "select * from (with mom as materialized (select " + ", ".join(aggs) + " from rounded)\n" + \
        "\nunion all\n".join(rows) + ")"


register("correlation_matrix", TRAINING_DEPS + ["rounded"], _corr_sql(), ["corr"])
register("histogram_review_score", TRAINING_DEPS,
         hist_sql("training", "review_score", "(select min(review_score)::double from training)",
                  "(select max(review_score)::double from training)", 10), ["bin_lo", "bin_hi"])

_zst = ", ".join(f"avg(cast({c} as double)) as m_{c}, stddev_pop(cast({c} as double)) as s_{c}" for c in ZCOLS)
_zrep = ", ".join(f"case when s_{c} > 0 then (cast({c} as double) - m_{c}) / s_{c} end as {c}" for c in ZCOLS)
register("zscore", TRAINING_DEPS,
         f"select t.* replace ({_zrep}) from training t, (select {_zst} from training) st",
         sorted(set(TRAINING_DOUBLES) | set(ZCOLS)))

F["kde"] = f"""
ksrc as (select review_score as g, wait_time as v from training
         where wait_time is not null and not isnan(wait_time) and review_score is not null),
kpar as (
  select g, n, bw, lo - bw * {dbl(3.0)} as g_lo, hi + bw * {dbl(3.0)} as g_hi,
    ((hi + bw * {dbl(3.0)}) - (lo - bw * {dbl(3.0)})) / 199 as g_step
  from (select g, count(*) as n, stddev_samp(v) * pow(cast(count(*) as double), {dbl(-0.2)}) as bw,
          min(v) as lo, max(v) as hi
        from ksrc group by g having count(*) >= 2 and stddev_samp(v) > 0) s),
kval as (select g, v, count(*) as w from ksrc group by g, v),
kgrid as (
  select g, n, bw, cast(p.range as integer) as point,
    case when p.range = 199 then g_hi else cast(p.range as double) * g_step + g_lo end as gx
  from kpar, range(200) p)"""
register("kde_curve", TRAINING_DEPS + ["kde"],
         f"""select kgrid.g as review_score, point, gx as x,
               sum(w * exp({dbl(-0.5)} * ((gx - v) / kgrid.bw) * ((gx - v) / kgrid.bw)))
                 / (kgrid.n * kgrid.bw * {dbl(2.5066282746310002)}) as density
             from kgrid join kval on kval.g = kgrid.g
             group by kgrid.g, point, gx, kgrid.n, kgrid.bw""", ["x", "density"])


# ---------------------------------------------------------------- regression
def simple_ols_sql(y: str, x: str) -> str:
    mom = f"""(select count(*) as n, avg({x}) as mx, avg(cast({y} as double)) as my, var_pop({x}) as vx,
                var_pop(cast({y} as double)) as vy, covar_pop({x}, cast({y} as double)) as cxy
              from training where {x} is not null and {y} is not null)"""
    co = f"""(select n, mx, my, vx, cxy / vx as b, my - (cxy / vx) * mx as a,
               n * (vy - (cxy / vx) * cxy) / (n - 2) as s2 from {mom} m)"""
    return f"""
select 'Intercept' as variable, a as coef, sqrt(s2 * (1.0 / n + mx * mx / (n * vx))) as std_err,
  a / sqrt(s2 * (1.0 / n + mx * mx / (n * vx))) as t_value from {co} c1
union all
select '{x}', b, sqrt(s2 / (n * vx)), b / sqrt(s2 / (n * vx)) from {co} c2"""


def two_ols_sql(y: str, x1: str, x2: str) -> str:
    yy = f"cast({y} as double)"
    mom = f"""(select count(*) as n, avg({x1}) as m1, avg({x2}) as m2, avg({yy}) as my,
                var_pop({x1}) as v1, var_pop({x2}) as v2, covar_pop({x1}, {x2}) as c12,
                covar_pop({x1}, {yy}) as c1y, covar_pop({x2}, {yy}) as c2y, var_pop({yy}) as vy
              from training where {x1} is not null and {x2} is not null and {y} is not null)"""
    sol = f"""(select *, (v2 * c1y - c12 * c2y) / det as b1, (v1 * c2y - c12 * c1y) / det as b2
              from (select *, v1 * v2 - c12 * c12 as det from {mom} m0) m1)"""
    fin = f"""(select *, my - b1 * m1 - b2 * m2 as a, n * (vy - b1 * c1y - b2 * c2y) / (n - 3) as s2
              from {sol} s)"""
    se_a = "sqrt(s2 / n * (1 + (v2 * m1 * m1 - 2 * c12 * m1 * m2 + v1 * m2 * m2) / det))"
    se1, se2 = "sqrt(s2 / n * v2 / det)", "sqrt(s2 / n * v1 / det)"
    return f"""
select 'Intercept' as variable, a as coef, {se_a} as std_err, a / {se_a} as t_value from {fin} f1
union all select '{x1}', b1, {se1}, b1 / {se1} from {fin} f2
union all select '{x2}', b2, {se2}, b2 / {se2} from {fin} f3"""


COEF_DOUBLES = ["coef", "std_err", "t_value"]
register("ols_coefficients", TRAINING_DEPS, simple_ols_sql("review_score", "wait_time"), COEF_DOUBLES)
register("ols_coefficients_delay", TRAINING_DEPS, simple_ols_sql("review_score", "delay_vs_expected"),
         COEF_DOUBLES)
register("ols_coefficients_two", TRAINING_DEPS, two_ols_sql("review_score", "wait_time", "delay_vs_expected"),
         COEF_DOUBLES)

F["score1"] = """
score1 as (
  select order_id, cast(review_score as double) as review_score,
    a + b * wait_time as predicted, cast(review_score as double) - (a + b * wait_time) as residual
  from training,
    (select covar_pop(wait_time, cast(review_score as double)) / var_pop(wait_time) as b,
            avg(cast(review_score as double))
              - covar_pop(wait_time, cast(review_score as double)) / var_pop(wait_time) * avg(wait_time) as a
     from training where wait_time is not null and review_score is not null) co
  where wait_time is not null and review_score is not null)"""
register("ols_score", TRAINING_DEPS + ["score1"], "select * from score1",
         ["review_score", "predicted", "residual"])
register("ols_error_simple", TRAINING_DEPS + ["score1"],
         """select avg(residual) as residual_mean, avg(residual * residual) as mse,
               sqrt(avg(residual * residual)) as rmse from score1""",
         ["residual_mean", "mse", "rmse"])


# ---------------------------------------------------------------- sources
#: Columns of the mapped tables, by table.
TABLE_COLUMNS = {
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_reviews": "review_id order_id review_score",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "customers": "customer_id customer_zip_code_prefix",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng",
    "products": "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    "product_category_name_translation": "product_category_name product_category_name_english",
}
def profile_sql(table: str, column: str) -> str:
    """A column of the mapped table as the declared type says it is to be read from CSV."""
    declared = SCHEMAS[table][column].simpleString()
    value = {"string": f"length({column}::varchar)", "timestamp_ntz": f"epoch({column}::timestamp)"}.get(declared, column)
    return (f"select '{table}' as \"table\", '{column}' as \"column\", '{declared}' as type, count(*) as rows, count(*) - count({column}) as nulls, "
            f"coalesce(sum({value}::double), 0.0::double) as checksum from {CTE_NAMES[table]}")


register("load_tables", [], "\nunion all\n".join(profile_sql(t, c) for t, cols in TABLE_COLUMNS.items() for c in cols.split()), ["checksum"])


# ---------------------------------------------------------------- regression by elimination
def normal_equations(src: str, y: str, xs: list[str]) -> list[str]:
    """CTEs that solve the centred normal equations of ``y`` on ``xs`` by Gauss-Jordan elimination.

    The last one, ``fin``, has one row: n, the means, the coefficients b0..bk,
    the residual and total sums of squares, and the variances s0..sk of the
    coefficients.
    """
    k = len(xs)
    x = [f"cast({c} as double)" for c in xs]
    yy = f"cast({y} as double)"
    moments = [f"avg({c}) as m{i}" for i, c in enumerate(x)] + [f"covar_pop({a}, {b}) as c{i}_{j}" for i, a in enumerate(x) for j, b in enumerate(x) if i <= j]
    moments += [f"covar_pop({c}, {yy}) as y{i}" for i, c in enumerate(x)]
    ctes = [f"mom as materialized (select count(*) as n, avg({yy}) as my, var_pop({yy}) as vy, {', '.join(moments)} from {src})"]
    keep = ", ".join(["n", "my", "vy"] + [f"m{i}" for i in range(k)] + [f"y{i}" for i in range(k)])
    # columns 0..k-1: the matrix, k..2k-1: the unit matrix, 2k: the right side
    first = [f"c{min(i, j)}_{max(i, j)} as a{i}_{j}" for i in range(k) for j in range(k)]
    first += [f"{1.0 if i == j else 0.0}::double as a{i}_{k + j}" for i in range(k) for j in range(k)] + [f"y{i} as a{i}_{2 * k}" for i in range(k)]
    ctes.append(f"e0 as materialized (select {keep}, {', '.join(first)} from mom)")
    for p in range(k):
        cells = [f"a{p}_{j} / a{p}_{p} as a{p}_{j}" for j in range(2 * k + 1)]
        cells += [f"a{i}_{j} - a{i}_{p} * (a{p}_{j} / a{p}_{p}) as a{i}_{j}" for i in range(k) if i != p for j in range(2 * k + 1)]
        ctes.append(f"e{p + 1} as materialized (select {keep}, {', '.join(cells)} from e{p})")
    b = [f"a{i}_{2 * k}" for i in range(k)]
    ssr = "n * (vy - (" + " + ".join(f"{b[i]} * y{i}" for i in range(k)) + "))"
    ctes.append(f"sol as materialized (select *, my - ({' + '.join(f'{b[i]} * m{i}' for i in range(k))}) as b0, {', '.join(f'{b[i]} as b{i + 1}' for i in range(k))}, "
                f"{ssr} as ssr, n * vy as tss, n - {k + 1} as df from e{k})")
    spread = " + ".join(f"m{i} * m{j} * a{i}_{k + j}" for i in range(k) for j in range(k))
    ctes.append(f"fin as materialized (select *, sqrt(ssr / df / n * (1 + {spread})) as s0, {', '.join(f'sqrt(ssr / df / n * a{i}_{k + i}) as s{i + 1}' for i in range(k))} from sol)")
    return ctes


def coefficients(xs: list[str], halves: tuple[str, str] | None = None) -> str:
    """``variable, coef, std_err, t_value, df`` of ``fin``.  ``halves``: of two equal columns the
    fitted one and the other, which share its coefficient evenly (the solution of least norm)."""
    rows = ["select 'Intercept' as variable, b0 as coef, s0 as std_err, df from fin"]
    for i, c in enumerate(xs, 1):
        if halves and c == halves[0]:
            rows += [f"select '{v}', b{i} / 2, s{i} / 2, df from fin" for v in halves]
        else:
            rows.append(f"select '{c}', b{i}, s{i}, df from fin")
    return "coefs as materialized (select *, coef / std_err as t_value from (" + " union all ".join(rows) + ") c)"


# Two-sided tail of Student's t: one minus twice the integral of its density from 0 to |t| (Simpson's rule,
# 4000 steps; beyond 40 nothing is left).  Quantile: Cornish-Fisher expansion to 1/df^4 around the normal one.
Z = "(1.959963984540054::double)"
PANELS = 4000
TAILS = f"""
dens as (
  select variable, case when abs(t_value) > 40 then 0.0 else greatest(1 - 2 * (least(abs(t_value), 40) / {PANELS} / 3) * sum(
      (case when i = 0 or i = {PANELS} then 1 when i % 2 = 1 then 4 else 2 end)
      * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi()) * pow(1 + pow(least(abs(t_value), 40) * i / {PANELS}, 2) / df, -(df + 1) / 2.0)), 0) end as p_value
  from coefs, range({PANELS + 1}) r(i) group by variable, t_value),
quant as (
  select df, {Z} + ({Z}**3 + {Z}) / (4.0 * df) + (5 * {Z}**5 + 16 * {Z}**3 + 3 * {Z}) / (96.0 * df**2)
    + (3 * {Z}**7 + 19 * {Z}**5 + 17 * {Z}**3 - 15 * {Z}) / (384.0 * df**3)
    + (79 * {Z}**9 + 776 * {Z}**7 + 1482 * {Z}**5 - 1920 * {Z}**3 - 945 * {Z}) / (92160.0 * df**4) as q
  from (select distinct df from coefs) d),
fitted as (
  select variable, coef, std_err, t_value, p_value, coef - q * std_err as ci_low, coef + q * std_err as ci_high
  from coefs join dens using (variable) join quant using (df))"""
FIT_DOUBLES = ["coef", "std_err", "t_value", "p_value", "ci_low", "ci_high"]


def regress(name: str, deps: list[str], parts: list[str], body: str, doubles: list[str]) -> None:
    ORACLES[name] = (with_fragments(deps, "").rstrip() + ",\n" + ",\n".join(x.strip() for x in parts) + "\n" + body, doubles)


for _name, _xs in (("ols_fit", ["wait_time"]), ("ols_fit_delay", ["delay_vs_expected"]), ("ols_fit_two", ["wait_time", "delay_vs_expected"])):
    regress(_name, TRAINING_DEPS, [*normal_equations("training", "review_score", _xs), coefficients(_xs), TAILS], "select * from fitted", FIT_DOUBLES)

F["zs"] = f"zs as materialized (select t.* replace ({_zrep}) from training t, (select {_zst} from training) st)"
ZDEPS = [*TRAINING_DEPS, "zs"]
# every item of the mapped data has a seller, so both counts are equal and one of them is left out of the equations
SIX = [c for c in ZCOLS if c != "number_of_sellers"]
STANDARD = normal_equations("zs", "review_score", SIX)
SPLIT = coefficients(SIX, ("number_of_products", "number_of_sellers"))
regress("ols_fit_standardized", ZDEPS, [*STANDARD, SPLIT, TAILS], "select * from fitted", FIT_DOUBLES)
regress("ols_fit_full_rank", [*swapped("istats", "istats_distinct"), "zs"],
        [*normal_equations("zs", "review_score", ZCOLS), coefficients(ZCOLS), TAILS], "select * from fitted", FIT_DOUBLES)
regress("ols_significant", ZDEPS, [*STANDARD, SPLIT, TAILS], "select variable, p_value, coef from fitted where p_value < 0.05", ["p_value", "coef"])
regress("ols_importance", ZDEPS, [*STANDARD, SPLIT], "select variable, abs(coef) as importance from coefs", ["importance"])
PREDICTED = ("pred as materialized (select order_id, review_score, b0 + " + " + ".join(f"b{i} * {c}" for i, c in enumerate(SIX, 1))
             + " as predicted, review_score - (b0 + " + " + ".join(f"b{i} * {c}" for i, c in enumerate(SIX, 1)) + ") as residual from zs, fin)")
regress("ols_error", ZDEPS, [*STANDARD, PREDICTED],
        "select avg(residual) as residual_mean, avg(residual * residual) as mse, sqrt(avg(residual * residual)) as rmse from pred", ["residual_mean", "mse", "rmse"])
regress("histogram_residuals", ZDEPS, [*STANDARD, PREDICTED], hist_sql("pred", "residual", -5.0, 5.0, 10), ["bin_lo", "bin_hi"])
regress("histogram_predicted", ZDEPS, [*STANDARD, PREDICTED],
        hist_sql("pred", "predicted", "(select min(predicted) from pred)", "(select max(predicted) from pred)", 10), ["bin_lo", "bin_hi"])

# The normal approximations of the sample skewness (D'Agostino) and kurtosis (Anscombe and Glynn).
SHAPE = """
mo as (
  select count(*) as nn, avg(residual) as r1, avg(pow(residual - (select avg(residual) from pred), 2)) as c2,
    avg(pow(residual - (select avg(residual) from pred), 3)) as c3, avg(pow(residual - (select avg(residual) from pred), 4)) as c4 from pred),
sh as (select nn::double as nn, c3 / pow(c2, 1.5) as g1, c4 / (c2 * c2) as g2 from mo),
zsk as (
  select *, sqrt(2 * (3.0 * (nn * nn + 27 * nn - 70) * (nn + 1) * (nn + 3) / ((nn - 2) * (nn + 5) * (nn + 7) * (nn + 9)) - 1)) - 1 as w2,
    g1 * sqrt((nn + 1) * (nn + 3) / (6.0 * (nn - 2))) as u from sh),
zku as (
  select *, asinh(u / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2) as z1,
    (g2 - 3.0 * (nn - 1) / (nn + 1)) / sqrt(24.0 * nn * (nn - 2) * (nn - 3) / (pow(nn + 1, 2) * (nn + 3) * (nn + 5))) as v,
    6.0 * (nn * nn - 5 * nn + 2) / ((nn + 7) * (nn + 9)) * sqrt(6.0 * (nn + 3) * (nn + 5) / (nn * (nn - 2) * (nn - 3))) as sb from zsk),
zk2 as (select *, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) as aa from zku),
omn as (
  select *, z1 * z1 + pow((1 - 2 / (9 * aa) - cbrt((1 - 2 / aa) / (1 + v * sqrt(2 / (aa - 4))))) / sqrt(2 / (9 * aa)), 2) as k2 from zk2),
dw as (
  select sum(pow(residual - prev, 2)) / sum(residual * residual) as d from (
    select residual, lag(residual) over (order by order_id, review_score) as prev from pred) l)"""
regress("ols_summary", ZDEPS, [*STANDARD, PREDICTED, SHAPE], """
select n, 6::bigint as df_model, df::bigint as df_resid, 1 - ssr / tss as r2, 1 - (n - 1) / df * (ssr / tss) as adj_r2,
  ((tss - ssr) / 6) / (ssr / df) as f_stat, case when ((tss - ssr) / 6) / (ssr / df) > 40 then 0.0::double end as prob_f,
  -n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1) as log_likelihood, n * (ln(2 * pi()) + ln(ssr / n) + 1) + 14 as aic,
  n * (ln(2 * pi()) + ln(ssr / n) + 1) + 7 * ln(n) as bic, g1 as skew, g2 as kurtosis, n / 6.0 * (g1 * g1 + pow(g2 - 3, 2) / 4) as jarque_bera,
  exp(-n / 12.0 * (g1 * g1 + pow(g2 - 3, 2) / 4)) as prob_jb, k2 as omnibus, exp(-k2 / 2) as prob_omnibus, d as durbin_watson
from fin, omn, dw""", ["r2", "adj_r2", "f_stat", "prob_f", "log_likelihood", "aic", "bic", "skew", "kurtosis", "jarque_bera", "prob_jb", "omnibus", "prob_omnibus", "durbin_watson"])

_Q = f"({Z} + ({Z}**3 + {Z}) / (4.0 * df) + (5 * {Z}**5 + 16 * {Z}**3 + 3 * {Z}) / (96.0 * df**2) + (3 * {Z}**7 + 19 * {Z}**5 + 17 * {Z}**3 - 15 * {Z}) / (384.0 * df**3))"
_BAND = "sqrt(ssr / df / n * (1 + pow(x - m0, 2) / c0))"
regress("regression_line", ZDEPS, [*normal_equations("zs", "review_score", ["delay_vs_expected"]), """
grid as (
  select f.*, cast(i as integer) as point, case when i = 99 then hi else i::double * ((hi - lo) / 99) + lo end as x, var_x as c0
  from fin f, (select min(delay_vs_expected) as lo, max(delay_vs_expected) as hi, var_pop(delay_vs_expected) as var_x from zs) r, range(100) g(i))"""],
        f"select point, x, b0 + b1 * x as fitted, b0 + b1 * x - {_Q} * {_BAND} as ci_low, b0 + b1 * x + {_Q} * {_BAND} as ci_high from grid",
        ["x", "fitted", "ci_low", "ci_high"])

# Poisson draws with mean 1 from 16 bits of a hash: one for each step of the distribution that the bits can tell.
_STEPS = "select k, floor(65536 * sum(exp(-1.0::double) / gamma(k + 1.0)) over (order by k)) as cut from range(8) s(k)"
regress("regression_line_resampled", TRAINING_DEPS, [*normal_equations("training", "review_score", ["wait_time"]), f"""
steps as materialized ({_STEPS}),
hashed as materialized (
  select wait_time - m0 as dx, review_score - my as dy, g, md5('0/' || order_id || '/' || g) as h from training, fin, range(25) r(g)),
drawn as (
  select dx, dy, g * 8 + p as replicate, ('0x' || substr(h, (p * 4 + 1)::int, 4))::int as draw from hashed, range(8) r(p)),
counted as (select dx, dy, replicate, (select count(*) from steps where cut <= draw) as w from drawn),
sums as (select replicate, sum(w) as n, sum(w * dx) as sx, sum(w * dy) as sy, sum(w * dx * dx) as sxx, sum(w * dx * dy) as sxy from counted group by replicate),
lines as (select sx / n as ux, sy / n as uy, (sxy - sx * sy / n) / (sxx - sx * sx / n) as slope from sums),
grid as (
  select f.*, cast(i as integer) as point, case when i = 99 then hi else i::double * ((hi - lo) / 99) + lo end as x
  from fin f, (select min(wait_time) as lo, max(wait_time) as hi from training) r, range(100) g(i))"""],
        "select point, x, b0 + b1 * x as fitted, quantile_cont(my + uy + slope * (x - m0 - ux), 0.025) as ci_low, "
        "quantile_cont(my + uy + slope * (x - m0 - ux), 0.975) as ci_high from grid, lines group by point, x, b0, b1",
        ["x", "fitted", "ci_low", "ci_high"])
