"""DuckDB twins of the registered queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

import re

import numpy as np

import fixtures as fx
from queries import BAND_LIMITS, BASE_URL, FEATURE_LIMIT, LIMIT

from skyfold.features import period
from skyfold.functions import special

ARCSEC = 1.0 / 3600.0
# Fixed values, written from the definitions: least epochs per band of a published curve, the factors of a period at
# which power is compared, the first grids of the template (start times, plateau, decline, rise, fall) and of the
# random walk (logarithms: low, high, count).
PUBLISH_LIMITS = {1: 5, 2: 5, 3: 1}
POWER_FACTORS = {
    "Power_rate_1/4": 0.25,
    "Power_rate_1/3": 1.0 / 3.0,
    "Power_rate_1/2": 0.5,
    "Power_rate_2": 2.0,
    "Power_rate_3": 3.0,
    "Power_rate_4": 4.0,
}
TEMPLATE_GRID = (12, (5.0, 20.0, 60.0, 120.0), (0.0, 0.4, 0.8), (1.0, 5.0, 20.0), (5.0, 20.0, 60.0, 150.0))
LOG_AMPLITUDE = (-14.0, 2.0, 17)
LOG_RATE = (-8.0, 5.0, 14)
EPOCHS = fx.epochs_sql(fx.DUCKDB_HMJD)
GOOD = "magerr <= 1e0 and catflags = 0"


def r(expression: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0e0"


def limit_condition(limit: int | dict[int, int], count: str) -> str:
    if isinstance(limit, int):
        return f"{count} >= {limit}"
    return "(" + " or ".join(f"(filterid = {b} and {count} >= {n})" for b, n in limit.items()) + ")"


def kept_sql(limit: int | dict[int, int], good: str = GOOD, recount: bool = True) -> str:
    """CTEs up to ``kept``: good epochs of curves with enough of them; n epochs, place i from 0."""
    first = limit_condition(limit, "stored")
    second = limit_condition(limit, "n") if recount else "true"
    return f"""
epochs as ({EPOCHS}),
counted as (select *, count(*) over (partition by objectid) as stored from epochs),
good as (select *, count(*) over (partition by objectid) as n from counted where {first} and {good}),
kept as (select *, row_number() over (partition by objectid order by hmjd, event_id) - 1 as i
         from good where {second})"""


def epoch_rows(limit: int | dict[int, int], single: bool = False, good: str = GOOD) -> str:
    def width(c: str) -> str:
        return f"cast(cast({c} as float) as double)" if single else c

    return f"""
with {kept_sql(limit, good)}
select objectid, cast(filterid as bigint) as filterid, n as nepochs, {r('hmjd')} as hmjd, {r(width('mag'))} as mag,
       {r(width('magerr'))} as magerr, {r(width('clrcoeff'))} as clrcoeff, cast(catflags as bigint) as catflags
from kept"""


def rounded(source: str, keys: str, values: tuple[str, ...], places: int = 6) -> str:
    columns = ", ".join(f'{r(chr(34) + v + chr(34), places)} as "{v}"' for v in values)
    return f"select {keys}, {columns} from {source}"


# --------------------------------------------------------------------- geometry


def distance_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    return f"""degrees(2e0*asin(sqrt(least(1e0,
 pow(sin((radians({dec2}) - radians({dec1}))/2e0), 2)
 + cos(radians({dec1}))*cos(radians({dec2}))*pow(sin((radians({ra2}) - radians({ra1}))/2e0), 2)))))"""


def pairs_sql(objects: str, catalogue: str, radius: float, payload: str) -> str:
    """Brute force over all pairs whose declinations are close enough."""
    apart = distance_sql("a.ra", "a.dec", "b.ra", "b.dec")
    return f"""
select * from (select a.objectid, a.filterid, a.ra, a.dec, {payload}, {apart} as distance
               from ({objects}) a join ({catalogue}) b on abs(a.dec - b.dec) <= {radius * 1.01!r}) x
where distance <= {radius!r}"""


def nearest_sql(pairs: str, tiebreak: str) -> str:
    return f"""
select * from (select *, row_number() over (partition by objectid, filterid
               order by round(distance*3600e0, 4), {tiebreak}) as place from ({pairs}) p) q where place = 1"""


INFRARED = "b.source_id as source_id_2, b.ra as ra_2, b.dec as dec_2, b.w1mpro_pm as w1mpro_pm_2, b.w2mpro_pm as w2mpro_pm_2"
OPTICAL_TABLE = f"select obj_id, RAJ2000 as ra, DEJ2000 as dec, brand from ({fx.optical_sql()}) o"
OPTICAL = "b.obj_id as obj_id_2, b.brand as brand_2"


def infrared_pairs(arcsec: float) -> str:
    return pairs_sql(fx.sky_sql(), fx.infrared_sql(), arcsec / 3600.0, INFRARED)


def galactic_sql(ra: str, dec: str) -> tuple[str, str]:
    pole, turn = "radians(27.12825e0)", f"(radians({ra}) - radians(192.85948e0))"
    height = f"sin(radians({dec}))*sin({pole}) + cos(radians({dec}))*cos({pole})*cos({turn})"
    east = f"cos(radians({dec}))*sin({turn})"
    north = f"sin(radians({dec}))*cos({pole}) - cos(radians({dec}))*sin({pole})*cos({turn})"
    longitude = f"122.93192e0 - degrees(atan2({east}, {north}))"
    return f"degrees(asin(greatest(-1e0, least(1e0, {height}))))", f"({longitude}) - 360e0*floor(({longitude})/360e0)"


def healpix_sql(level: int) -> str:
    nside = 1 << level
    bits = " + ".join(
        f"((x >> {b}) & 1)*{1 << (2 * b)}::bigint + ((y >> {b}) & 1)*{1 << (2 * b + 1)}::bigint" for b in range(level)
    )
    return f"""
with p as (select source_id, sin(radians(dec)) as z, (ra - 360e0*floor(ra/360e0))/90e0 as t, cos(radians(dec)) as c
           from ({fx.infrared_sql()}) s),
q as (select *, abs(z) <= 2e0/3e0 as belt,
        cast(floor((t + 0.5e0)*{nside} - z*{0.75 * nside!r}) as bigint) as down,
        cast(floor((t + 0.5e0)*{nside} + z*{0.75 * nside!r}) as bigint) as up,
        least(3, cast(floor(t) as bigint)) as sector, {nside}*sqrt(3e0)*c/sqrt(1e0 + abs(z)) as reach from p),
u as (select *, least({nside - 1}, cast(floor((t - sector)*reach) as bigint)) as near,
        least({nside - 1}, cast(floor((1e0 - (t - sector))*reach) as bigint)) as far,
        down // {nside} as fd, up // {nside} as fu from q),
v as (select source_id,
        case when belt then case when fd = fu then fd % 4 + 4 when fd < fu then fd else fu + 8 end
             when z >= 0 then sector else sector + 8 end as face,
        case when belt then up % {nside} when z >= 0 then {nside - 1} - far else near end as x,
        case when belt then {nside - 1} - down % {nside} when z >= 0 then {nside - 1} - near else far end as y from u)
select source_id, face*{nside * nside}::bigint + {bits} as ipix from v"""


# ------------------------------------------------------------------- statistics


def moments_sql() -> str:
    return f"""
with {kept_sql(LIMIT)},
a as (select objectid, n, avg(mag) as am, avg(hmjd) as ah from kept group by objectid, n),
s as (select k.objectid, a.n*1e0 as n, am, sum(pow(mag - am, 2)) as s2, sum(pow(mag - am, 3)) as s3,
        sum(pow(mag - am, 4)) as s4, sum(magerr*magerr) as e2, sum((hmjd - ah)*(mag - am)) as sx,
        sum(pow(hmjd - ah, 2)) as st from kept k join a on a.objectid = k.objectid group by k.objectid, a.n, am)
select objectid, {r('am')} as "Mean", {r('sqrt(s2/(n-1))')} as "Std", {r('sqrt(s2/(n-1))/am')} as "Meanvariance",
  {r('(s3/n)/pow(s2/n, 1.5e0)')} as "Skew",
  {r('n*(n+1)/((n-1)*(n-2)*(n-3))*s4/pow(s2/(n-1), 2) - 3*(n-1)*(n-1)/((n-2)*(n-3))')} as "SmallKurtosis",
  {r('(s2/n - e2/n)/(am*am)')} as "ExcessVar", {r('sx/st')} as "LinearTrend" from s"""


def quantiles_sql() -> str:
    return f"""
with {kept_sql(LIMIT)},
q as (select objectid, median(mag) as md, quantile_cont(mag, 0.25) as p25, quantile_cont(mag, 0.75) as p75,
        quantile_cont(mag, 0.03) as p3, quantile_cont(mag, 0.97) as p97, max(mag) as hi, min(mag) as lo
      from kept group by objectid),
k as (select k.*, q.* exclude (objectid), row_number() over (partition by k.objectid order by mag) as up,
        row_number() over (partition by k.objectid order by mag desc) as dn, ceil(0.05e0*n) as edge
      from kept k join q on q.objectid = k.objectid)
select objectid,
  {r('(median(case when dn <= edge then mag end) - median(case when up <= edge then mag end))/2')} as "Amplitude",
  {r('max(p75 - p25)')} as "Q31", {r('median(abs(mag - md))')} as "MedianAbsDev",
  {r('avg(case when abs(mag - md) < (hi - lo)/10 then 1e0 else 0e0 end)')} as "MedianBRP",
  {r('max(abs(mag - md))/max(md)')} as "PercentAmplitude",
  {r('median(case when mag <= p3 then mag end) + median(case when mag >= p97 then mag end) - 2*max(md)')} as "Gskew"
from k group by objectid"""


def weighted_sql() -> str:
    return f"""
with {kept_sql(LIMIT)},
a as (select objectid, n*1e0 as n, sum(mag/(magerr*magerr))/sum(1/(magerr*magerr)) as wm from kept group by objectid, n),
d as (select k.objectid, a.n, k.mag - wm as d, sqrt(a.n/(a.n-1))*(k.mag - wm)/k.magerr as z
      from kept k join a on a.objectid = k.objectid),
s as (select objectid, sqrt(sum(d*d)/(max(n)-1)) as sd, sum(abs(z))/sqrt(max(n)*sum(z*z)) as stetson from d group by objectid)
select d.objectid, {r('avg(case when abs(d) > sd then 1e0 else 0e0 end)')} as "Beyond1Std",
  {r('max(stetson)')} as "StetsonK" from d join s on s.objectid = d.objectid group by d.objectid"""


def ordered_sql() -> str:
    return f"""
with {kept_sql(LIMIT)},
a as (select objectid, avg(mag) as am, stddev_samp(mag) as sd, sum(1) as cnt, min(hmjd) as t0, max(hmjd) as t1
      from kept group by objectid),
k as (select k.objectid, i, n*1e0 as n, am, sd, t1 - t0 as span, mag,
        mag - lag(mag) over w as dm, hmjd - lag(hmjd) over w as dt,
        case when mag > am + 2*sd then 1 when mag < am - 2*sd then -1 else 0 end as side,
        sum(mag - am) over (partition by k.objectid order by i) as run
      from kept k join a on a.objectid = k.objectid window w as (partition by k.objectid order by i)),
c as (select *, case when side <> 0 and side = lead(side, 1) over w and side = lead(side, 2) over w then 1e0 else 0e0 end
        as three from k window w as (partition by objectid order by i))
select objectid, {r('sum(three)/(max(n)-2)')} as "Con",
  {r('avg(case when dt > 0 then pow(dm/dt, 2) end)*pow(max(span), 2)/((max(n)-1)*pow(max(sd), 2)*max(n))')} as "Eta_e",
  {r('max(case when dt > 0 then abs(dm/dt) end)')} as "MaxSlope",
  {r('sum(case when i >= n - 29 and i > 0 then case when dm > 0 then 1e0 else -1e0 end else 0e0 end)/30')} as "PairSlopeTrend",
  {r('(max(run) - min(run))/(max(n)*max(sd))')} as "Rcs"
from c group by objectid"""


def pvar_sql() -> str:
    # P(a, x) as a sum of Poisson-like terms, each from lgamma.
    return f"""
with {kept_sql(LIMIT)},
a as (select objectid, avg(mag) as am from kept group by objectid),
x as (select k.objectid, (max(n)-1)/2e0 as a, sum(pow((mag - am)/magerr, 2))/2e0 as x
      from kept k join a on a.objectid = k.objectid group by k.objectid),
t as (select objectid, a, x, unnest(range(0, cast(x + 20*sqrt(x) + 200 as bigint))) as k from x)
select objectid, {r('least(1e0, sum(exp((a + k)*ln(x) - x - lgamma(a + k + 1))))')} as "Pvar" from t group by objectid"""


def autocor_sql() -> str:
    return f"""
with {kept_sql(LIMIT)},
d as (select objectid, i, mag - avg(mag) over (partition by objectid) as d from kept),
v as (select objectid, sum(d*d) as v from d group by objectid),
c as (select a.objectid, b.i - a.i as lag, sum(a.d*b.d) as c from d a join d b on a.objectid = b.objectid and b.i > a.i
      group by a.objectid, b.i - a.i)
select c.objectid, min(lag)*1e0 as "Autocor_length" from c join v on v.objectid = c.objectid
where c/v < exp(-1e0) group by c.objectid"""


def _horner(x: str, coefficients: tuple[float, ...]) -> str:
    value = repr(coefficients[0]) + "::double"
    for c in coefficients[1:]:
        value = f"({value}*{x} + {c!r}::double)"
    return value


def anderson_sql() -> str:
    tail = f"(exp(-x*x/2)*{_horner('x', special.NORMAL_TOP)}/{_horner('x', special.NORMAL_BOTTOM)})"
    return f"""
with {kept_sql(LIMIT)},
z as (select objectid, n*1e0 as n, (mag - avg(mag) over w)/stddev_samp(mag) over w as z,
        row_number() over (partition by objectid order by mag) as k from kept window w as (partition by objectid)),
p as (select *, abs(z) as x from z),
u as (select objectid, n, k, case when z < 0 then ln({tail}) else ln(1 - {tail}) end as lo,
        case when z < 0 then ln(1 - {tail}) else ln({tail}) end as hi from p),
s as (select objectid, max(n) as n, sum((2*k - 1)*lo + (2*n + 1 - 2*k)*hi) as s from u group by objectid)
select objectid, {r('1/(1 + exp(-10*((-n - s/n) - 0.3e0)))')} as "AndersonDarling" from s"""


def structure_sql() -> str:
    return f"""
with {kept_sql(LIMIT)},
pairs as (select a.objectid, b.hmjd - a.hmjd as lag, pow(a.mag - b.mag, 2) - pow(a.magerr, 2) - pow(b.magerr, 2) as d
          from kept a join kept b on a.objectid = b.objectid and b.i > a.i),
sf as (select objectid, (floor(10*log10(lag)) + 0.5e0)/10 - log10(365.25e0) as x, avg(d) as v from pairs
       where lag > 0 group by objectid, x having count(*) >= 6),
line as (select objectid, regr_slope(0.5e0*log10(v), x) as g, regr_intercept(0.5e0*log10(v), x) as a
         from sf where v > 0 group by objectid having count(*) >= 2)
select o.objectid, {r('a')} as log_amplitude, {r('g')} as "SF_ML_gamma"
from (select distinct objectid from kept) o left join line l on l.objectid = o.objectid"""


def grid_values(low: float, high: float, count: int) -> str:
    return ", ".join(f"({v!r}::double)" for v in np.linspace(low, high, count).tolist())


def walk_sql(data: str, trials: str) -> str:
    """Kalman steps as a recursive query: data(objectid, i, gap, y, noise), trials(a, c)."""
    return f"""
{data},
trials as ({trials}),
steps as (
  select d.objectid, d.i, a, c, 0e0 as state, a as doubt, y, noise,
         -0.5e0*(ln(2*pi()*(a + noise)) + y*y/(a + noise)) as score
  from data d cross join trials where d.i = 0
  union all
  select d.objectid, d.i, s.a, s.c, s.f*s.up as state, s.a + (s.down - s.a)*s.f*s.f as doubt, d.y, d.noise,
         s.score - 0.5e0*(ln(2*pi()*(s.a + (s.down - s.a)*s.f*s.f + d.noise))
                          + pow(d.y - s.f*s.up, 2)/(s.a + (s.down - s.a)*s.f*s.f + d.noise)) as score
  from (select p.*, exp(-p.c*e.gap) as f, p.state + p.doubt/(p.doubt + p.noise)*(p.y - p.state) as up,
               p.doubt*(1 - p.doubt/(p.doubt + p.noise)) as down, e.i as next
        from steps p join data e on e.objectid = p.objectid and e.i = p.i + 1) s
  join data d on d.objectid = s.objectid and d.i = s.next)
select s.objectid, {r('max(score)')} as score from steps s
join (select objectid, max(i) as last from data group by objectid) l on l.objectid = s.objectid and l.last = s.i
group by s.objectid"""


def iar_sql() -> str:
    data = f"""
with recursive {kept_sql(FEATURE_LIMIT)},
data as (select objectid, i, hmjd - lag(hmjd) over (partition by objectid order by i) as gap,
           (mag - avg(mag) over w)/stddev_samp(mag) over w as y, pow(magerr/stddev_samp(mag) over w, 2) as noise
         from kept window w as (partition by objectid))"""
    return walk_sql(data, f"select 1e0 as a, -ln(phi) as c from (values {grid_values(0.01, 0.99, 50)}) t(phi)")


def drw_sql() -> str:
    data = f"""
with recursive {kept_sql(FEATURE_LIMIT)},
data as (select objectid, i, hmjd - lag(hmjd) over (partition by objectid order by i) as gap,
           mag - avg(mag) over (partition by objectid) as y, magerr*magerr as noise from kept)"""
    a, c = grid_values(*LOG_AMPLITUDE), grid_values(*LOG_RATE)
    return walk_sql(data, f"select exp(la) as a, exp(lc) as c from (values {a}) t(la) cross join (values {c}) u(lc)")


def search_sql(data: str, axes: list[tuple[float, float, int]], variance: str, rate: str) -> str:
    """The search of a best point to its end, as a recursive query: data(objectid, epochs), an axis for each trial value x0, x1.

    ``epochs`` is a list of structs with gap, y and noise, and room for state, doubt and value of the filter.
    """
    n = range(len(axes))
    expected = "(a + (z.doubt - a)*exp(-c*e.gap)*exp(-c*e.gap) + e.noise)"
    surprise = "(e.y - z.state*exp(-c*e.gap))"
    step = f"""{{'gap': e.gap, 'y': e.y, 'noise': e.noise,
      'state': z.state*exp(-c*e.gap) + (1 - e.noise/{expected})*{surprise}, 'doubt': ({expected} - e.noise)*e.noise/{expected},
      'value': z.value - 0.5e0*(ln(2*pi()*{expected}) + {surprise}*{surprise}/{expected})}}"""
    scored = f"""select *, case when isfinite(v) then v else '-inf'::double end as value
      from (select *, list_reduce(epochs, lambda z, e: {step}, {{'gap': 0e0, 'y': 0e0, 'noise': 0e0, 'state': 0e0, 'doubt': 0e0, 'value': 0e0}}).value as v
            from (select *, {variance} as a, {rate} as c from trials) t) t"""

    def chosen(trials: str) -> str:
        # The first of all trials within rounding of the best.
        return f"""select * from (select *, min(k) over (partition by objectid) as first from (
          select *, max(value) over (partition by objectid) as top from (with trials as ({trials}) {scored}) q) q
          where value >= top - 1e-9*(1 + abs(top))) q where k = first"""

    grid = " cross join ".join(f"(select {low!r}::double + i{j}*{(high - low) / (count - 1)!r}::double as x{j}, i{j} from range(0, {count}) g(i{j})) y{j}" for j, (low, high, count) in enumerate(axes))
    place = {1: "i0", 2: f"i0*{axes[-1][2]} + i1"}[len(axes)]
    halves = ", ".join(
        f"case when i{j} in (0, {count - 1}) then {(high - low) / 2 * 1.5!r}::double else {4 * (high - low) / (count - 1)!r}::double end as h{j}" for j, (low, high, count) in enumerate(axes)
    )
    near = ", ".join(f"greatest(-300e0, least(300e0, x{j} + h{j}*(i{j}*0.25e0 - 1))) as t{j}" for j in n)
    later = " cross join ".join(f"range(0, 9) g{j}(i{j})" for j in n)
    better = "(isfinite(value) and not (value <= score + 1e-9*(1 + abs(value))))"
    moved = ", ".join(f"case when {better} then t{j} else x{j} end as x{j}" for j in n)
    shrunk = ", ".join(f"case when {better} and i{j} in (0, 8) then least(h{j}*1.5e0, 300e0) else h{j}/2 end as h{j}" for j in n)
    names = ", ".join(f"x{j}, h{j}" for j in n)
    wide = " or ".join(f"h{j} >= 4e-4" for j in n)
    rest = [re.sub(r"\bx(\d)", r"t\1", text) for text in (variance, rate)]
    again = chosen(
        f"select objectid, epochs, turn, score, {names}, {near}, {', '.join(f'i{j}' for j in n)}, {'i0' if len(axes) == 1 else 'i0*9 + i1'} as k "
        f"from search join data using (objectid) cross join {later} where isfinite(score) and turn < 201 and ({wide})"
    ).replace(f"{variance} as a, {rate} as c", f"{rest[0]} as a, {rest[1]} as c")
    return f"""
{data},
search as (
  select objectid, 1 as turn, value as score, {', '.join(f'x{j}' for j in n)}, {halves}
  from ({chosen(f"select objectid, epochs, {', '.join(f'x{j}, i{j}' for j in n)}, {place} as k from data cross join {grid}")}) f
  union all
  select objectid, turn + 1, case when {better} then value else score end, {moved}, {shrunk} from ({again}) l),
ended as (select objectid, arg_max(score, turn) as score, {', '.join(f'arg_max(x{j}, turn) as x{j}' for j in n)} from search group by objectid)"""


def epoch_lists(y: str, noise: str) -> str:
    return f"""
with recursive {kept_sql(FEATURE_LIMIT)},
data as (select objectid, list({{'gap': gap, 'y': y, 'noise': noise, 'state': 0e0, 'doubt': 0e0, 'value': 0e0}} order by i) as epochs
  from (select objectid, i, coalesce(hmjd - lag(hmjd) over (partition by objectid order by i), 'inf'::double) as gap,
          {y} as y, {noise} as noise from kept window w as (partition by objectid)) q group by objectid)"""


def iar_full_sql() -> str:
    data = epoch_lists("(mag - avg(mag) over w)/stddev_samp(mag) over w", "pow(magerr/stddev_samp(mag) over w, 2)")
    found = search_sql(data, [(0.01, 0.99, 50)], "case when x0 > 0 and x0 < 1 then 1e0 else 'nan'::double end", "-ln(case when x0 > 0 and x0 < 1 then x0 else 0.5e0 end)")
    return f"""{found} select objectid, {r('x0')} as "IAR_phi", {r('score')} as score from ended"""


def drw_full_sql() -> str:
    found = search_sql(epoch_lists("mag - avg(mag) over w", "magerr*magerr"), [LOG_AMPLITUDE, LOG_RATE], "exp(x0)", "exp(x1)")
    return f"""{found} select objectid, {r('x0', 3)} as log_sigma, {r('-x1', 3)} as log_tau, {r('score', 5)} as score from ended"""


def mhps_sql() -> str:
    def scale(name: str, days: float) -> str:
        sigma = days / np.sqrt(2.0 * np.pi**2)
        narrow, broad = float(2 * sigma**2 / 1.01), float(2 * sigma**2 * 1.01)
        return f"""
{name}_w as (select a.objectid, a.i, b.mag - m.am as m, b.magerr as e, m.far, exp(-pow(b.hmjd - a.hmjd, 2)/{narrow!r}) as g1,
    exp(-pow(b.hmjd - a.hmjd, 2)/{broad!r}) as g2
  from kept a join kept b on a.objectid = b.objectid join m on m.objectid = a.objectid),
{name}_h as (select objectid, i, m, e, far, g1/sum(g1) over w - g2/sum(g2) over w as h from {name}_w
  window w as (partition by objectid, i)),
{name}_f as (select objectid, i, max(far) as far, sum(h*m) as f, sum(h*h*e*e) as noise from {name}_h group by objectid, i),
{name} as (select objectid, avg(f*f) - avg(noise) as v, cast(count(*) filter (abs(f) > 1e-12*far) as double) as filled
  from {name}_f group by objectid)"""

    return f"""
with {kept_sql(LIMIT)},
c as (select objectid, avg(mag) as am from kept group by objectid),
m as (select c.objectid, any_value(am) as am, max(abs(mag - am)) as far from kept join c on c.objectid = kept.objectid group by c.objectid),{scale('low', 100.0)},{scale('high', 10.0)}
select l.objectid, {r('l.v/h.v', 4)} as "MHPS_ratio", {r('l.v', 12)} as "MHPS_low", {r('h.v', 12)} as "MHPS_high", h.filled as "MHPS_non_zero",
  case when h.v < 0 then 1e0 else 0e0 end as "MHPS_PN_flag" from low l join high h on h.objectid = l.objectid"""


def template_sql() -> str:
    count, plateaus, slopes, rises, falls = TEMPLATE_GRID

    def values(name: str, items: tuple[float, ...]) -> str:
        return f"(values {', '.join(f'({v!r}::double)' for v in items)}) {name}({name})"

    shape = """(1/(1 + exp(-s/rise)))*((1 - slope*s/plateau)*(1 - 1/(1 + exp(-(s - plateau)/3)))
      + (1 - slope)*exp(-greatest(s - plateau, -50)/fall)*(1/(1 + exp(-(s - plateau)/3))))"""
    return f"""
with {kept_sql(FEATURE_LIMIT)},
b as (select objectid, min(hmjd) as t0, greatest(max(hmjd) - min(hmjd), 1) as span,
        quantile_cont(pow(10, -0.4e0*(mag - 16.4e0)), 0.05) as p5 from kept group by objectid),
f as (select k.objectid, hmjd - t0 as t, pow(10, -0.4e0*(mag - 16.4e0)) - p5 as f,
        1/pow(pow(10, -0.4e0*(mag - magerr - 16.4e0)) - pow(10, -0.4e0*(mag - 16.4e0)), 2) as w
      from kept k join b on b.objectid = k.objectid),
c as (select objectid, count(*) as n, sum(w) as sw, sum(w*f)/sum(w) as fm from f group by objectid),
g as (select b.objectid, -50 + k*(span + 50)/{count - 1} as peak, plateau, slope, rise, fall
      from b cross join range(0, {count}) p(k) cross join {values('plateau', plateaus)} cross join {values('slope', slopes)}
      cross join {values('rise', rises)} cross join {values('fall', falls)}),
x as (select g.*, f.w, f.f - c.fm as y, c.n, c.sw, f.t - g.peak as s
      from g join f on f.objectid = g.objectid join c on c.objectid = g.objectid),
h as (select *, {shape} as shape from x),
u as (select objectid, peak, plateau, slope, rise, fall, max(n) as n, sum(w*y*y) as yy, sum(w*shape) as s1,
        sum(w*shape*shape) as s2, sum(w*shape*y) as sy, max(sw) as sw from h group by all),
v as (select *, s2 - s1*s1/sw as d from u),
a as (select *, case when d > 1e-6*s2 then greatest(sy/d, 0) else 0 end as amp from v)
select objectid, {r('min((yy - 2*amp*sy + amp*amp*d)/n)')} as "SPM_chi" from a group by objectid"""


# ------------------------------------------------------------------- periodogram

CURVE = """
nw as (select objectid, sum(1/(magerr*magerr)) as sw, min(hmjd) as t0, avg(mag) as am from kept group by objectid),
curve as (select k.objectid, n, k.hmjd - t0 as t, k.mag - am as y, 1/(magerr*magerr)/sw as w
          from kept k join nw on nw.objectid = k.objectid),
base as (select objectid, max(n) as n, sum(w*y) as ym, sum(w*y*y) - pow(sum(w*y), 2) as yy from curve group by objectid)"""


def power_sql(name: str, trials: str) -> str:
    """CTE ``name``(objectid, f, power) for the rows of ``trials``(objectid, f)."""
    return f"""
{name}_x as (select g.objectid, g.f, w, y, cos(2*pi()*g.f*t) as c, sin(2*pi()*g.f*t) as s
  from ({trials}) g join curve on curve.objectid = g.objectid),
{name}_s as (select objectid, f, sum(w*c) as c, sum(w*s) as s, sum(w*c*c) as cc, sum(w*s*s) as ss, sum(w*c*s) as cs,
    sum(w*y*c) as yc, sum(w*y*s) as ys from {name}_x group by objectid, f),
{name}_d as (select z.objectid, f, n, yy, cc - c*c as cc, ss - s*s as ss, cs - c*s as cs, yc - ym*c as yc, ys - ym*s as ys
  from {name}_s z join base on base.objectid = z.objectid),
{name}_p as (select objectid, f, n, case when cc*ss - cs*cs > 1e-9 then greatest(0, least(1 - 1e-9::double,
    (ss*yc*yc + cc*ys*ys - 2*cs*yc*ys)/(yy*(cc*ss - cs*cs)))) else 0 end as p from {name}_d),
{name} as (select objectid, f, (n - 3)/2e0*p/(1 - p) as power from {name}_p)"""


def grid_sql(grid: period.FrequencyGrid) -> str:
    return f"select objectid, {grid.start!r}::double + k*{grid.step!r}::double as f from base cross join range(0, {grid.count}) g(k)"


def periodogram_sql() -> str:
    return f"""
with {kept_sql(FEATURE_LIMIT)},{CURVE},{power_sql('per', grid_sql(period.STANDARD_GRID))}
select objectid, {r('f', 4)} as freq, {r('power', 4)} as power from per"""


def topk_sql() -> str:
    return f"""
with {kept_sql(FEATURE_LIMIT)},{CURVE},{power_sql('per', grid_sql(period.STANDARD_GRID))},
ranked as (select objectid, power, row_number() over (partition by objectid order by power desc) - 1 as place from per)
select objectid, place, {r('power')} as power from ranked where place < {period.TOP}"""


def best_sql() -> str:
    """CTEs up to ``best``(objectid, f, power) after refinement, on the standard grid."""
    grid = period.STANDARD_GRID
    reach = round(grid.step / period.FINE_STEP)
    near = f"""select distinct objectid, f + k*{period.FINE_STEP!r}::double as f from peaks
               cross join range(-{reach}, {reach + 1}) g(k) where f + k*{period.FINE_STEP!r}::double > 1e-12"""
    return f"""
with {kept_sql(FEATURE_LIMIT)},{CURVE},{power_sql('per', grid_sql(grid))},
sides as (select objectid, f, power, lag(power) over w as l, lead(power) over w as h from per
          window w as (partition by objectid order by f)),
peaks as (select objectid, f from (select objectid, f, row_number() over (partition by objectid order by power desc, f) as place
          from sides where power >= l and power >= h) z where place <= {period.OPTIMA}),{power_sql('fine', near)},
best as (select objectid, arg_max(f, power) as f, max(power) as power
         from (select objectid, f, power from per union all select objectid, f, power from fine) z group by objectid)"""


def period_sql() -> str:
    return f"""{best_sql()},
ranked as (select objectid, power, row_number() over (partition by objectid order by power desc) as place from per),
top as (select objectid, power + 0.01e0 as v, sum(power + 0.01e0) over (partition by objectid) as s
        from ranked where place <= {period.TOP}),
ppe as (select objectid, 1 + sum(v/s*ln(v/s))/ln({period.TOP}) as ppe from top group by objectid)
select b.objectid, {r('1/f')} as "Multiband_period", {r('ppe')} as "PPE" from best b join ppe on ppe.objectid = b.objectid"""


def power_rate_sql() -> str:
    grid = period.STANDARD_GRID
    places = ", ".join(f"('{name}', {factor!r}::double)" for name, factor in POWER_FACTORS.items())
    nearest = (
        f"{grid.start!r}::double + greatest(0, least({grid.count - 1}, "
        f"round((best.f/factor - {grid.start!r}::double)/{grid.step!r}::double)))*{grid.step!r}::double"
    )
    columns = ", ".join(
        f'{r(f"max(case when name = {chr(39)}{name}{chr(39)} then a.power/best.power end)")} as "{name}"'
        for name in POWER_FACTORS
    )
    return f"""{best_sql()},
rates(name, factor) as (values {places}),
asked as (select objectid, name, {nearest} as f from best cross join rates),
{power_sql('chosen', 'select distinct objectid, f from asked')}
select best.objectid, {columns} from best join asked on asked.objectid = best.objectid
join chosen a on a.objectid = asked.objectid and a.f = asked.f group by best.objectid"""


TRIAL = "((objectid % 97)/50e0 + 0.5e0)"


def folded_sql() -> str:
    return f"""
with {kept_sql(LIMIT)},
p as (select objectid, n*1e0 as n, hmjd, event_id, mag, (hmjd - floor(hmjd/(2*{TRIAL}))*2*{TRIAL})/(2*{TRIAL}) as phase,
        avg(mag) over w as am, stddev_pop(mag) over w as sd from kept window w as (partition by objectid)),
s as (select objectid, n, sd, sum(mag - am) over w as run, mag - lag(mag) over w as dm
      from p window w as (partition by objectid order by phase, hmjd, event_id))
select objectid, {r('(max(run) - min(run))/(max(n)*max(sd))')} as "Psi_CS",
  {r('sum(dm*dm)/((max(n) - 1)*pow(max(sd), 2))')} as "Psi_eta" from s group by objectid"""


def first_harmonic_sql() -> str:
    """Weighted least squares of 1, cos, sin by Cramer's rule on centred sums."""
    return f"""
with {kept_sql(LIMIT)},
x as (select objectid, mag as y, pow(magerr + 0.01e0, -2) as w, cos(2*pi()*hmjd/{TRIAL}) as c,
        sin(2*pi()*hmjd/{TRIAL}) as s from kept),
m as (select objectid, sum(w*y)/sum(w) as ym, sum(w*c)/sum(w) as cm, sum(w*s)/sum(w) as sm from x group by objectid),
q as (select x.objectid, sum(w*pow(c - cm, 2)) as cc, sum(w*pow(s - sm, 2)) as ss, sum(w*(c - cm)*(s - sm)) as cs,
        sum(w*(c - cm)*(y - ym)) as yc, sum(w*(s - sm)*(y - ym)) as ys from x join m on m.objectid = x.objectid group by x.objectid),
b as (select objectid, (ss*yc - cs*ys)/(cc*ss - cs*cs) as b1, (cc*ys - cs*yc)/(cc*ss - cs*cs) as b2 from q)
select x.objectid, {r('max(sqrt(b1*b1 + b2*b2))')} as "Harmonics_mag_1",
  {r('avg(pow(y - ym - b1*(c - cm) - b2*(s - sm), 2))')} as "Harmonics_mse"
from x join m on m.objectid = x.objectid join b on b.objectid = x.objectid group by x.objectid"""


# ------------------------------------------------------------------------- all

SIZE_SQL = f"""
select *, case when regexp_matches(size, '^\\s*\\d+(\\.\\d+)?\\s*[BKMGT]\\s*$')
  then cast(round(cast(regexp_extract(size, '\\d+(\\.\\d+)?') as double)*case regexp_extract(size, '[BKMGT]')
    when 'B' then 1 when 'K' then 1000 when 'M' then 1000000 when 'G' then 1000000000 else 1000000000000 end) as bigint)
  else -1 end as bytes from ({fx.listing_sql()}) s"""

MANIFEST_SQL = f"""
select split_part(value, '  ', 1) as checksum, '{BASE_URL}' || substr(split_part(value, '  ', 2), 3) as file,
       regexp_extract(value, '.*(field[0-9]+)', 1) as field from ({fx.manifest_sql()}) m"""

SUMS = f"""
with epochs as ({EPOCHS})
select objectid, cast(filterid as bigint) as fid, count(*) as nepochs, {r('sum(mag)')} as mag_sum from epochs group by objectid, filterid"""


def counts_sql(limit: int | dict[int, int]) -> str:
    return f"""
select objectid, cast(filterid as bigint) as filterid, nepochs
from (select objectid, filterid, count(*) as nepochs from ({EPOCHS}) e group by objectid, filterid) c
where {limit_condition(limit, 'nepochs')}"""


FEATURES = f"""
with {kept_sql(LIMIT)}, features as (select objectid, cast(filterid as bigint) as filterid, count(*) as nepochs,
  avg(mag) as "Mean", stddev_samp(mag) as "Std" from kept group by objectid, filterid),
optical as ({nearest_sql(pairs_sql(fx.sky_sql(), OPTICAL_TABLE, 1.5 * ARCSEC, OPTICAL), 'obj_id_2')}),
infrared as ({nearest_sql(infrared_pairs(2.0), 'source_id_2')})"""


def published_sql(at: tuple[str, str]) -> str:
    """The features of the standard table that have a query of their own, side by side."""
    parts = [
        moments_sql(), quantiles_sql(), weighted_sql(), ordered_sql(), pvar_sql(), autocor_sql(), anderson_sql(), structure_sql(), mhps_sql(),
        iar_full_sql(), drw_full_sql(), period_sql(), power_rate_sql(),
    ]
    joins = " ".join(f"join ({part}) p{k} on p{k}.objectid = b.objectid" for k, part in enumerate(parts))
    columns = ", ".join(f"p{k}.* exclude (objectid)" if "as score" not in part else f"p{k}.* exclude (objectid, score)" for k, part in enumerate(parts))
    return f"""
with {kept_sql(FEATURE_LIMIT)},
base as (select objectid as "_id", objectid, count(*) as nepochs, {r(f'max({at[0]})')} as gal_b, {r(f'max({at[1]})')} as gal_l from kept group by objectid)
select b.* exclude (objectid), {columns} from base b {joins}"""


def build() -> dict[str, str]:
    sky, gal = fx.sky_sql(), galactic_sql("ra", "dec")
    at = galactic_sql("objra", "objdec")
    optical_pairs = pairs_sql(sky, OPTICAL_TABLE, 1.5 * ARCSEC, OPTICAL)
    label_pairs = pairs_sql(
        sky, fx.label_positions_sql(), 1.5 * ARCSEC, "b.source_id, b.source_cat, b.source_class, b.source_flag"
    )
    links = f"unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">', 1))"
    pair_columns = f"objectid, filterid, source_id_2, {r('distance', 9)} as distance"
    done = "select f.path from (" + fx.files_sql() + ") f join labels l on l.doc_id = f.page_id"
    return {
        "scan_lightcurves": epoch_rows(0, single=True, good="true"),
        "conform_schema": epoch_rows(0, single=True, good="true"),
        "conform_incremental": epoch_rows(0, single=True, good="true"),
        "manifest_parse": MANIFEST_SQL,
        "manifest_by_field": f"""select field, count(*) as files, min(file) as first_file, max(file) as last_file
            from ({MANIFEST_SQL}) p group by field""",
        "verify_checksums": f"""
            select m.checksum, m.file, m.field, case when s.found is null then 'missing' when s.found = m.checksum then 'ok'
              else 'mismatch' end as status
            from ({MANIFEST_SQL}) m left join (select path, md5(content) as found from ({fx.files_sql()}) f
              where page_id not in (select doc_id from labels where toxic = 1)) s
            on regexp_extract(s.path, '[^/]*$') = regexp_extract(m.file, '[^/]*$')""",
        "list_files": f"select cast(filterid as bigint) as filterid, count(*) as objects, true as listed from ({sky}) s group by 1",
        "file_checksums": f"select page_id, md5(content || chr(10)) as found from ({fx.files_sql()}) f",
        "listing_links": f"""
            select page_id, regexp_replace(url, '/+$', '') || '/' || regexp_replace(link, '^/+', '') as file,
                   link like '%/' as folder from (select page_id, url, {links} as link from pages) l""",
        "size_by_field": f"""
            select regexp_extract(file, '([^/]*)/[^/]*$', 1) as field, count(*) as files,
                   {r('sum(bytes)/1048576e0')} as total_size from ({SIZE_SQL}) s where file like '%parquet%' group by 1""",
        "split_by_band": SUMS,
        "split_by_epochs": SUMS,
        "publish_lightcurves": f"""
            with {kept_sql(PUBLISH_LIMITS)}
            select objectid as "_id", cast(filterid as bigint) as filterid, count(*) as nepochs, 'Point' as loc_type,
              {r('max(objra) - 180')} as lon, {r('max(objdec)')} as lat, {r('sum(hmjd)')} as hmjd_sum,
              {r('sum(mag)')} as mag_sum, {r('sum(magerr)')} as magerr_sum from kept group by objectid, filterid""",
        "publish_features": published_sql(at),
        "publish_again": f"""
            with epochs as ({EPOCHS}), c as (select objectid as "_id", count(*) as nepochs from epochs group by objectid)
            select "_id", nepochs, count(*) filter ("_id" % 3 = 0) over () as part, count(*) filter ("_id" % 3 <> 0) over () as rest,
              cast(0 as bigint) as again, count(*) over () as anew from c""",
        "insert_documents": f"""
            with epochs as ({EPOCHS}) select objectid as "_id", count(*) as nepochs, count(*) over () as inserted from epochs group by objectid""",
        "features_incremental": f"""
            with {kept_sql(20)}, base as (select objectid, count(*) as nepochs, {r(f'max({at[0]})', 1)} as gal_b, {r(f'max({at[1]})', 1)} as gal_l
              from kept group by objectid)
            select b.*, {r('"Mean"', 1)} as "Mean", {r('"Std"', 1)} as "Std", {r('"Amplitude"', 1)} as "Amplitude"
            from base b join ({moments_sql()}) m on m.objectid = b.objectid join ({quantiles_sql()}) q on q.objectid = b.objectid""",
        "fixed_file_count": f"select objectid, cast(filterid as bigint) as filterid, {r('ra')} as ra, {r('dec')} as dec from ({sky}) s",
        "lookup_layout": f"""
            select objectid, cast(filterid as bigint) as filterid, count(*) as nepochs, {r('sum(mag)')} as mag_sum
            from ({EPOCHS}) e group by objectid, filterid""",
        "nepochs_min": counts_sql(20),
        "nepochs_by_band": counts_sql(BAND_LIMITS),
        "epoch_filter": epoch_rows(0),
        "preprocess_int": epoch_rows(10),
        "preprocess_map": epoch_rows(BAND_LIMITS),
        "preprocess_incremental": epoch_rows(10),
        "geo_point": f"select objectid, 'Point' as loc_type, {r('ra - 180')} as lon, {r('dec')} as lat from ({sky}) s",
        "arrays_to_binary": f"""
            select objectid, 4*count(*) as bytes, {r('sum(cast(cast(mag as float) as double))')} as mag_sum
            from ({EPOCHS}) e group by objectid""",
        "objects_table": f"""
            select objectid, cast(filterid as bigint) as filterid, fieldid, rcid, count(*) as nepochs,
              {r('max(objra)')} as objra, {r('max(objdec)')} as objdec
            from ({EPOCHS}) e group by objectid, filterid, fieldid, rcid""",
        "strip_suffix": f"""
            select objectid, filterid, source_id_2 as source_id, {r('ra_2')} as ra, {r('dec_2')} as dec,
              {r('w1mpro_pm_2')} as w1mpro_pm, {r('w2mpro_pm_2')} as w2mpro_pm from ({infrared_pairs(1.5)}) p""",
        "healpix_index": healpix_sql(12),
        "xmatch_all": f"select {pair_columns} from ({infrared_pairs(1.5)}) p",
        "xmatch_stored": " union all ".join(
            f"select cast({x} as double) as radius, {pair_columns} from ({infrared_pairs(x)}) p" for x in (1.0, 1.5, 2.0)
        ),
        "xmatch_nearest": f"select {pair_columns} from ({nearest_sql(infrared_pairs(1.5), 'source_id_2')}) p",
        "xmatch_labels": f"""
            select objectid, filterid, source_id, source_cat, source_class, source_flag, {r('ra')} as objra,
              {r('dec')} as objdec from ({label_pairs}) p""",
        "xmatch_catwise": f"""
            select objectid, filterid, source_id_2, {r('w1mpro_pm_2')} as w1mpro_pm_2, {r('w2mpro_pm_2')} as w2mpro_pm_2
            from ({nearest_sql(infrared_pairs(2.0), 'source_id_2')}) p""",
        "xmatch_ps1": f"""
            select objectid, filterid, obj_id_2, brand_2, {r('distance', 9)} as distance
            from ({nearest_sql(optical_pairs, 'obj_id_2')}) p""",
        "nearest_rank_ties": f"""
            select objectid, filterid, source_id_2, {r('step')} as distance from (
              select *, rank() over (partition by filterid, objectid order by step) as place from (
                select *, round(distance*3600e0, 2) as step from ({infrared_pairs(2.0)}) p) s) q where place = 1""",
        "nearest_one": f"select {pair_columns} from ({nearest_sql(infrared_pairs(2.0), 'source_id_2')}) p",
        "join_labels": f"""
            select e.objectid, l.filterid, l.source_class, {r('hmjd')} as hmjd, {r('mag')} as mag, {r('magerr')} as magerr
            from ({EPOCHS}) e join ({fx.label_keys_sql()}) l on l.objectid = e.objectid and l.filterid = e.filterid""",
        "join_features_outer": f"""{FEATURES}
            select coalesce(f.objectid, o.objectid) as objectid, coalesce(f.filterid, o.filterid) as filterid, f.nepochs,
              {r('f."Mean"')} as "Mean", o.obj_id_2 as obj_id, o.brand_2 as brand
            from features f full join optical o on o.objectid = f.objectid and o.filterid = f.filterid""",
        "training_set": f"""{FEATURES}
            select k.objectid, k.filterid, f.nepochs, {r('f."Mean"')} as "Mean", {r('f."Std"')} as "Std",
              o.obj_id_2 as obj_id, o.brand_2 as brand, i.source_id_2 as source_id,
              {r('i.w1mpro_pm_2')} as w1mpro_pm, {r('i.w2mpro_pm_2')} as w2mpro_pm
            from (select objectid, filterid from features union select objectid, filterid from optical
                  union select objectid, filterid from infrared) k
            left join features f on f.objectid = k.objectid and f.filterid = k.filterid
            left join optical o on o.objectid = k.objectid and o.filterid = k.filterid
            left join infrared i on i.objectid = k.objectid and i.filterid = k.filterid""",
        "files_pending": f"""
            select page_id, path from ({fx.files_sql()}) f where regexp_extract(path, '[^/]*$') not in
              (select regexp_extract(path, '[^/]*$') from ({done}) d)""",
        "files_pending_by_path": f"select page_id, path from ({fx.files_sql()}) f where path not in ({done})",
        "insert_new_only": f"""
            select "_id", min(filterid) as filterid, arg_min(objectid, filterid*1000000000000000 + objectid) as objectid
            from (select cast(floor((objectid % 1000000000000)/10) as bigint) as "_id", cast(filterid as bigint) as filterid,
                    objectid from ({sky}) s) b where "_id" not in (select doc_id from labels) group by "_id\"""",
        "parse_size": f"select entry_id, bytes from ({SIZE_SQL}) s",
        "path_parts": """
            select page_id, split_part(url, '/', -1) as base,
              split_part(url, '/', -2) as folder,
              split_part(url, '/', -2) || '/' || split_part(url, '/', -1) as last_two, url like '%/' as is_folder from pages""",
        "uri_parts": f"""
            select page_id, 'release-' || (page_id % 7) as bucket, substr(path, 3) as path from ({fx.files_sql()}) f""",
        "galactic": f"select objectid, {r(gal[0])} as gal_b, {r(gal[1])} as gal_l from ({sky}) s",
        "mag_to_flux": f"""
            select objectid, {r('hmjd')} as hmjd, {r('pow(10, -0.4e0*(mag - 16.4e0))')} as flux from ({EPOCHS}) e""",
        "phase_fold": f"""
            select objectid, {r('hmjd')} as hmjd,
              {r(f'(hmjd - floor(hmjd/(2*{TRIAL}))*2*{TRIAL})/(2*{TRIAL})')} as phase from ({EPOCHS}) e""",
        "lc_center": f"""
            with epochs as ({EPOCHS}),
            b as (select objectid, min(mag) as lo, avg(mag) as am, quantile_cont(mag, 0.05) as p5 from epochs group by objectid)
            select e.objectid, {r('hmjd')} as hmjd, {r('mag - lo')} as by_min, {r('mag - am')} as by_mean,
              {r('mag - p5')} as by_p5 from epochs e join b on b.objectid = e.objectid""",
        "lc_moments": f"""
            select objectid, {r('avg(mag)')} as mean, {r('stddev_pop(mag)')} as std, {r('min(mag)')} as low,
              {r('max(mag)')} as high, {r('quantile_cont(mag, 0.05)')} as p5 from ({EPOCHS}) e group by objectid""",
        "lc_stats_moments": moments_sql(),
        "lc_stats_quantiles": quantiles_sql(),
        "lc_stats_weighted": weighted_sql(),
        "lc_stats_ordered": ordered_sql(),
        "pvar": pvar_sql(),
        "autocor_length": autocor_sql(),
        "anderson_darling": anderson_sql(),
        "structure_function": structure_sql(),
        "iar_grid": iar_sql(),
        "drw_grid": drw_sql(),
        "iar": iar_full_sql(),
        "drw": drw_full_sql(),
        "mhps": mhps_sql(),
        "template_fit": template_sql(),
        "periodogram": periodogram_sql(),
        "topk_power": topk_sql(),
        "period": period_sql(),
        "power_rate": power_rate_sql(),
        "folded_kim": folded_sql(),
        "harmonics_first": first_harmonic_sql(),
    }
