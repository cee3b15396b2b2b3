"""SQL texts, for DuckDB, that state the result of each registered query.

Written independently of the DataFrame code: plain joins instead of grids,
plain windows instead of spans. ``{…}`` names another text of this module.
"""

from __future__ import annotations

from segflow.schema import (
    BASE_FEATURES,
    CALENDAR_COLUMNS,
    DENSITY_COLUMNS,
    feature_columns,
    shifted_columns,
)

_SEGMENT_ATTRIBUTES = [
    "state", "county", "start_latitude", "start_longitude", "end_latitude", "end_longitude", "miles",
    "f_system", "aadt", "urban_code", "thrulanes", "thrulanes_unidir", "route_sign", "zip",
]


def _direction(column: str) -> str:
    return (
        f"cast(case {column} when 'NORTHBOUND' then 1 when 'EASTBOUND' then 3 "
        f"when 'SOUTHBOUND' then 5 when 'WESTBOUND' then 7 end as int)"
    )


def _variant(column: str) -> str:
    return (
        f"cast(case when lower({column}) like '%p%' then 0 when lower({column}) like '%n%' then 1 "
        f"when {column} like '%-%' then 2 when {column} like '%+%' then 3 else -1 end as int)"
    )


def _number(column: str) -> str:
    return f"cast(regexp_replace(lower({column}), '[pn+-]', '', 'g') as bigint)"


PROBES = """probes as (
  select a.tmc_code, a.measurement_tstamp,
         a.speed as speed_All, a.travel_time_seconds as travel_time_seconds_All, a.data_density as data_density_All,
         p.speed as speed_Pass, p.travel_time_seconds as travel_time_seconds_Pass, p.data_density as data_density_Pass,
         t.speed as speed_Truck, t.travel_time_seconds as travel_time_seconds_Truck, t.data_density as data_density_Truck
  from probe_all a
  join probe_pass p on p.tmc_code = a.tmc_code and p.measurement_tstamp = a.measurement_tstamp
  join probe_truck t on t.tmc_code = a.tmc_code and t.measurement_tstamp = a.measurement_tstamp)"""

SEGMENTS = f"""seg as (
  select tmc as tmc_code, {_direction('direction')} as DIR, {', '.join(_SEGMENT_ATTRIBUTES)}, active_start_date
  from segment_id)"""

#: every (line, station) pair, tested one by one; the lines of the stand-ins are straight
NEAR = f"""ends as (
  select h.Tmc, h.geometry, h.County, h.State, h.F_System as shape_class, {_direction('h.DIR')} as dir_num,
         g.start_longitude as x1, g.start_latitude as y1,
         g.end_longitude - g.start_longitude as dx, g.end_latitude - g.start_latitude as dy
  from shape h join segment_id g on g.tmc = h.Tmc),
placed as (
  select ends.*, s.STATION_ID, s.STATE_NAME, s.DIR as station_dir, s.F_SYSTEM as station_class, s.LAT, s.LONG,
         least(greatest(((s.LONG-x1)*dx+(s.LAT-y1)*dy)/(dx*dx+dy*dy), 0), 1) as t
  from ends, station s),
near as (
  select * from placed where power(LONG-(x1+t*dx),2)+power(LAT-(y1+t*dy),2) <= 0.001*0.001)"""

TIER1 = f"""{NEAR},
tier1 as (
  select Tmc, STATION_ID, station_dir as DIR, geometry, County, State, LAT, LONG, cast(1 as int) as tier
  from near where dir_num = station_dir and shape_class = station_class and (State is null or State not in ('',' ')))"""

DATASET = f"""{PROBES},
{SEGMENTS},
{TIER1},
dataset as (
  select p.*, m.STATION_ID, m.County as shape_county, m.State as shape_state, m.LAT as station_lat,
         m.LONG as station_long, m.tier, seg.DIR, {', '.join('seg.' + a for a in _SEGMENT_ATTRIBUTES)},
         c.YEAR, c.MONTH, c.DAY, c.HOUR, c.VOL
  from probes p
  join tier1 m on m.Tmc = p.tmc_code
  join seg on seg.tmc_code = p.tmc_code
  join count_hourly c on c.STATION_ID = m.STATION_ID and c.STATE_NAME = seg.state and c.DIR = seg.DIR
   and make_timestamp(2000+c.YEAR, c.MONTH, c.DAY, c.HOUR, 0, 0) = p.measurement_tstamp)"""


#: stations that have a file in the training dataset
TRAINED = """select distinct split_part(file_name, '_', 1) as STATION_ID from dataset_file
where suffix(file_name, '.pkl') and len(string_split(file_name, '_')) = 3"""


def _features() -> str:
    plain = [c for c in BASE_FEATURES if c not in ("tmc_code", "measurement_tstamp", *DENSITY_COLUMNS)]
    parts = {"year": "year", "month": "month", "day": "day", "hour": "hour", "dayofweek": "isodow"}
    codes = ", ".join(
        f"cast(case when {c} is null then (select count(distinct {c}) from dataset) else "
        f"dense_rank() over (order by {c} nulls last) - 1 end as int) as {c}"
        for c in DENSITY_COLUMNS
    )
    calendar = ", ".join(
        f"cast(extract({part} from measurement_tstamp){' - 1' if part == 'isodow' else ''} as int) as {name}"
        for name, part in parts.items()
    )
    shifts = ", ".join(
        f"lead({c}) over w as {c}_before, lag({c}) over w as {c}_after" for c in shifted_columns(feature_columns()[:26])
    )
    whole = " and ".join(f"{c} is not null" for c in feature_columns())
    return f"""{DATASET},
numbers as (
  select {_number('tmc_code')} as tmc_code, {_variant('tmc_code')} as TMC_Value,
         cast(epoch(measurement_tstamp) as bigint) as measurement_tstamp, {codes}, {calendar},
         {', '.join(plain)}, VOL
  from dataset),
neighbours as (
  select *, {shifts} from numbers
  window w as (partition by tmc_code, TMC_Value, DIR order by measurement_tstamp, VOL)),
features as (select {', '.join(feature_columns())}, VOL from neighbours where {whole} and VOL is not null)"""


FEATURES = _features()

_ZERO = "(coalesce(VOL = 0, false) or coalesce(Predicted_VOL = 0, false))"
_PERCENT = "abs(Predicted_VOL - VOL) / VOL * 100"

ERRORS = f"""errors as (
  select *, abs(Predicted_VOL - VOL) as diff, case when VOL <> 0 then {_PERCENT} end as pct, {_ZERO} as zero,
         extract(hour from measurement_tstamp) as hh
  from predictions)"""

METRICS = f"""{ERRORS},
metrics as (
  select count(*) filter (VOL = 0) as zeros_vol, count(*) filter (Predicted_VOL = 0) as zeros_predicted,
         count(*) filter (zero) as rows_with_zeros, count(*) filter (not zero) as rows_compared,
         avg(diff) filter (zero) as mean_abs_diff_zeros,
         avg(pct) filter (not zero) as percent_diff,
         avg(pct) filter (not zero and hh between 7 and 18) as percent_diff_day,
         avg(pct) filter (not zero and hh not between 7 and 18) as percent_diff_night,
         median(diff) filter (zero) as median_abs_diff_zeros
  from errors)"""


def _thresholds(last: int) -> str:
    return f"""with {ERRORS}
select cast(t.threshold as int) as threshold,
       round(count(*) filter (coalesce(pct <= t.threshold, false)) / count(*) * 100, 6) as pct_within
from errors, (select unnest(range(5, {last + 1}, 5)) as threshold) t where not zero group by t.threshold"""


def _histogram(source: str, value: str) -> str:
    return f"""with v as (select {value} as v from {source}),
ends as (select min(v) as lo, max(v) as hi from v),
filled as (select least(cast(floor((v-lo)/(hi-lo)*30) as int), 29) as bin, count(*) as n from v, ends group by 1)
select cast(b.bin as int) as bin, round(lo + b.bin*((hi-lo)/30), 6) as lower, round(lo + (b.bin+1)*((hi-lo)/30), 6) as upper,
       coalesce(n, 0) as n
from (select unnest(range(30)) as bin) b cross join ends left join filled f on f.bin = b.bin"""


LOG_COLUMNS = [
    "miles", "zip", "hour", "aadt", "DIR", "thrulanes", "speed_All", "urban_code", "route_sign", "start_latitude",
    "start_longitude", "f_system", "TMC_Value", "hour_before", "hour_after", "speed_All_before",
]
LONG = "long as (" + " union all ".join(
    f"select epoch, '{c}' as feature, cast({c} as double) as importance from importance_log"
    for c in ["feature1", "feature2", "feature3", *LOG_COLUMNS]
) + ")"
LATEST = f"""{LONG},
latest as (
  select * from long where epoch = (select max(epoch) from long) and not regexp_matches(feature, 'before|after|feature'))"""

_PROBE_SELECT = "tmc_code, measurement_tstamp, speed, travel_time_seconds, data_density"


def _zero_share(column: str) -> str:
    return (
        f"(select '{column}' as col, tmc_code, count(*) filter ({column} = 0) / count(*) * 100 as pct_zero "
        f"from predictions group by tmc_code having count(*) filter ({column} = 0) > 0)"
    )


def _split(keys: list[str]) -> str:
    text = ", ".join(f"cast({k} as string)" for k in keys)
    return f"md5(concat_ws('|', {text}))"


FEATURE_KEY = ["tmc_code", "TMC_Value", "DIR", "measurement_tstamp", "VOL"]


def fixed_weights() -> dict[str, float]:
    """A fixed linear scorer over standardised features, used by the checks of
    model operators: a plain rule, some weights are zero."""
    return {name: float((7 * i) % 11) - 5.0 for i, name in enumerate(feature_columns())}


def _scaled() -> str:
    f = feature_columns()
    stats = ", ".join(f"avg({c}) as m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) as s_{c}" for c in f)
    z = ", ".join(f"({c} - m_{c}) / s_{c} as z_{c}" for c in f)
    return f"""{FEATURES},
split as (
  select *, {_split(FEATURE_KEY)} as row_hash,
         cast(('0x' || substr({_split(FEATURE_KEY)}, 1, 8)) as bigint) % 1000 < 100 as test from features),
stats as (select {stats} from split where not test),
scaled as (select split.*, {z} from split, stats)"""


SCALED = _scaled()


def _importance(repeats: int = 3, seed: int = 42) -> str:
    weights = fixed_weights()
    score = " + ".join(f"({w}) * z_{c}" for c, w in weights.items())
    values = ", ".join(f"('{c}', {w}, z_{c})" for c, w in weights.items())
    return f"""with {SCALED},
tests as (
  select *, {score} as score, row_number() over (order by row_hash) - 1 as i, count(*) over () as n
  from scaled where test),
long as (select i, n, VOL, score, v.c, v.w, v.z from tests, lateral (values {values}) as v(c, w, z)),
digests as (
  select c, r, md5(concat('{seed}|', c, '|', r)) as d, n from (select distinct c, n from long), range({repeats}) as x(r)),
starts as (
  select c, r, n, 1 + cast(concat('0x', substr(d, 1, 8)) as bigint) % n as least_factor, cast(concat('0x', substr(d, 9, 8)) as bigint) % n as b from digests),
ways as (
  select c, r, b, list_filter(range(least_factor, least_factor + 200), lambda x: gcd(x, n) = 1)[1] as a from starts),
changed as (
  select l.c, ways.r, avg(power(l.VOL - (l.score + l.w * (o.z - l.z)), 2)) - avg(power(l.VOL - l.score, 2)) as growth
  from long l join ways on ways.c = l.c join long o on o.c = l.c and o.i = (ways.a * l.i + ways.b) % l.n group by l.c, ways.r)
select c as feature, round(avg(growth), 4) as importance, round(stddev_pop(growth), 4) as deviation from changed group by c"""


def _huber(result: str, inputs: tuple[str, str] = ("aadt", "speed_All"), bend: float = 20.0, rounds: int = 5) -> str:
    """Rounds of reweighted least squares with two inputs, the equations solved by determinants."""
    x, y = (f"z_{c}" for c in inputs)
    texts = [f"learn as (select VOL, {x} as x, {y} as y from scaled where not test)"]
    for t in range(1, rounds + 1):
        error = "abs(VOL - (b0 + b1*x + b2*y))"
        weight = "1.0" if t == 1 else f"case when {error} <= {bend} then 1.0 else {bend} / {error} end"
        texts.append(f"""w{t} as (select VOL, x, y, {weight} as w from learn{'' if t == 1 else f', c{t - 1}'}),
s{t} as (select sum(w) as n, sum(w*x) as a, sum(w*y) as b, sum(w*x*x) as aa, sum(w*x*y) as ab, sum(w*y*y) as bb,
  sum(w*VOL) as v, sum(w*x*VOL) as av, sum(w*y*VOL) as bv from w{t}),
d{t} as (select *, n*(aa*bb-ab*ab) - a*(a*bb-ab*b) + b*(a*ab-aa*b) as det from s{t}),
c{t} as (select (v*(aa*bb-ab*ab) - a*(av*bb-ab*bv) + b*(av*ab-aa*bv)) / det as b0,
  (n*(av*bb-ab*bv) - v*(a*bb-ab*b) + b*(a*bv-av*b)) / det as b1,
  (n*(aa*bv-av*ab) - a*(a*bv-av*b) + v*(a*ab-aa*b)) / det as b2 from d{t})""")
    return f"with {SCALED},\n" + ",\n".join(texts) + "\n" + result


def _huber_rounds(rounds: int = 5) -> str:
    names = (("intercept", "b0"), ("aadt", "b1"), ("speed_All", "b2"))
    return _huber(" union all ".join(f"select cast({t} as int) as round, '{n}' as input, round({c}, 6) as weight from c{t}" for t in range(1, rounds + 1) for n, c in names))


def _huber_measures(rounds: int = 5) -> str:
    return _huber(" union all ".join(f"""select cast({t - 1} as int) as model,
  round(avg(case when abs(VOL-score) <= 500 then 0.5*(VOL-score)*(VOL-score) else 500*(abs(VOL-score)-250) end), 6) as huber_loss,
  round(1 - sum((VOL-score)*(VOL-score)) / (var_pop(VOL)*count(*)), 6) as r2,
  round(count(*) filter (VOL <> 0 and abs(VOL-score)/VOL < 0.15) / count(*) * 100, 6) as pct_within
  from (select VOL, b0 + b1*z_aadt + b2*z_speed_All as score from scaled, c{t} where test)""" for t in range(1, rounds + 1)))


CHECKS: dict[str, str] = {
    # sources
    "scan_counts": "select * from count_file",
    "scan_cached": "select * from count_file",
    "station_parts": "select * exclude (STATE_NAME, YEAR, VOL), STATE_NAME as state, '2024' as year, "
    "case when cast(STATION_ID as int) % 2 = 0 then VOL else 0.0::double end as VOL from count_hourly",
    "scan_probe": f"select tmc_code, measurement_tstamp, speed, cast(null as double) as average_speed, "
    "travel_time_seconds, data_density from probe_all",
    "scan_segments": f"with {SEGMENTS} select tmc_code, DIR, {', '.join(_SEGMENT_ATTRIBUTES)}, active_start_date from seg",
    "wkt_vertices": """
select Tmc, cast(l as int) as line_no, cast(v as int) as vertex_no,
       round(start_longitude + step*0.0015, 6) as lon, round(start_latitude + step*0.002, 6) as lat
from (
  select tmc as Tmc, start_longitude, start_latitude, row_number() over (order by length(tmc), tmc) as ignored,
         cast(substr(tmc,5) as int)*4 + case substr(tmc,4,1) when 'P' then 0 when 'N' then 1 when '+' then 2 else 3 end as u
  from segment_id) g
join (values (0,0,0,0),(0,0,1,2),(1,0,0,0),(1,0,1,1),(1,0,2,2),(2,0,0,0),(2,0,1,1),(2,1,0,1),(2,1,1,2)) k(kind,l,v,step)
  on k.kind = g.u%3""",
    "union_datasets": f"""
select tmc_code, measurement_tstamp, speed, data_density, cast(null as double) as travel_time_seconds from probe_pass
union all select tmc_code, measurement_tstamp, speed, cast(null as string), travel_time_seconds from probe_truck""",
    "tmc_id_list": f"with {TIER1} select Tmc from tier1",
    "tmc_id_text": f"""with {TIER1},
numbered as (
  select Tmc, (row_number() over (order by {_split(['Tmc', 'STATION_ID', 'DIR'])}) - 1) // 100 as line from tier1)
select cast(line as bigint) as line, string_agg(Tmc, ',' order by Tmc) as ids from numbered group by line""",
    # projections and filters
    "combine_probe_legacy": f"""with {PROBES} select * from probes""",
    "filter_county": "select * from count_hourly where STATE_NAME = 'STATE_1' and COUNTY_NAME = 'County 1'",
    "filter_states": "select * from predictions where state in ('STATE_1', 'STATE_3')",
    "segments_in_state": f"""with {SEGMENTS}
select tmc_code, measurement_tstamp, state, speed from (
  select p.*, seg.state, row_number() over (partition by p.tmc_code order by measurement_tstamp) as rn
  from probe_all p join seg on seg.tmc_code = p.tmc_code where seg.state = 'STATE_2') where rn = 1""",
    "segments_in_county": f"""with {SEGMENTS}
select tmc_code, measurement_tstamp, county, speed from (
  select p.*, seg.county, row_number() over (partition by p.tmc_code order by measurement_tstamp) as rn
  from probe_all p join seg on seg.tmc_code = p.tmc_code where seg.county = 'County 3') where rn = 1""",
    "segment_rows": f"select {_PROBE_SELECT} from probe_all where tmc_code = '104N00007'",
    "segments_in_range": f"""
select {_PROBE_SELECT} from (
  select *, row_number() over (partition by tmc_code order by measurement_tstamp) as rn from probe_all
  where measurement_tstamp >= timestamp '2024-01-05 06:00:00' and measurement_tstamp < timestamp '2024-01-12 18:00:00')
where rn = 1""",
    "drop_blank_state": "select Tmc, State from shape where State is null or State not in ('', ' ')",
    "repair_codes": """
select replace(tmc_code, '00012', '00011') as tmc_code, measurement_tstamp, cast(3 as int) as DIR, VOL
from predictions where regexp_matches(tmc_code, '104.00012')""",
    "coerce_numeric": """
select event_id, try_cast(event_type as double) as event_type,
       try_cast(case when event_id%10 = 0 then 'n/a' else cast(user_id as string) end as double) as user_text from events""",
    "segment_day": f"select {_PROBE_SELECT} from probe_all where tmc_code = '104P00003' and cast(measurement_tstamp as date) = date '2024-01-10'",
    # joins
    "combine_probe": f"with {PROBES} select * from probes",
    "attach_segments": f"""with {PROBES},
{SEGMENTS}
select probes.*, seg.DIR, {', '.join(_SEGMENT_ATTRIBUTES)} from probes join seg on seg.tmc_code = probes.tmc_code""",
    "attach_stations": f"""with {PROBES},
{SEGMENTS},
{TIER1}
select p.tmc_code, p.measurement_tstamp, m.STATION_ID, m.LAT as station_lat, m.LONG as station_long, m.tier, seg.DIR,
       seg.state, seg.aadt, p.speed_All, p.speed_Pass, p.speed_Truck
from probes p join tier1 m on m.Tmc = p.tmc_code join seg on seg.tmc_code = p.tmc_code""",
    "conflate": f"""with {DATASET} select * from dataset""",
    "conflate_inference": f"""with {PROBES},
{SEGMENTS}
select p.tmc_code, p.measurement_tstamp, p.speed_All, p.data_density_Truck, seg.DIR, seg.state, seg.aadt
from probes p join seg on seg.tmc_code = p.tmc_code""",
    "conflate_legacy": f"""with {PROBES},
{SEGMENTS},
{TIER1}
select p.tmc_code, p.measurement_tstamp, m.STATION_ID, seg.DIR, seg.state, p.speed_All, c.VOL
from probes p join tier1 m on m.Tmc = p.tmc_code join seg on seg.tmc_code = p.tmc_code
join count_hourly c on c.STATION_ID = m.STATION_ID and c.STATE_NAME = 'STATE_1' and c.COUNTY_NAME = 'County 1'
 and make_timestamp(2000+c.YEAR, c.MONTH, c.DAY, c.HOUR, 0, 0) = p.measurement_tstamp""",
    "geo_match": f"with {NEAR} select Tmc, STATION_ID, STATE_NAME, dir_num, station_dir, shape_class, station_class, LAT, LONG from near",
    "geo_tier1": f"with {TIER1} select * from tier1",
    "merge_predictions": f"""with {FEATURES}
select d.tmc_code as tmc_code_raw, f.tmc_code, f.TMC_Value, d.measurement_tstamp, d.DIR, d.STATION_ID,
       d.VOL as VOL_raw, f.VOL as VOL_norm, f.hour, d.speed_All as speed_All_raw, f.speed_All_before,
       cast(floor(f.aadt / 100.0 + f.speed_All) as int) as Predicted_VOL
from dataset d join features f
  on f.tmc_code = {_number('d.tmc_code')} and f.TMC_Value = {_variant('d.tmc_code')} and f.DIR = d.DIR
 and make_timestamp(f.year, f.month, f.day, f.hour, 0, 0) = d.measurement_tstamp""",
    "holdout_anti": f"""with {TIER1}
select Tmc, STATION_ID, DIR, tier from tier1 where STATION_ID not in ({TRAINED})""",
    "holdout_removed": f"""with {TIER1}
select distinct STATION_ID from tier1 where STATION_ID in ({TRAINED})""",
    "attach_counties": """
select s.tmc as tmc_code, s.county, (select min_by(p.population, p.name) from county_population p
  where lower(p.name) = lower(concat(s.county, ', ', replace(s.state, '_', ' ')))) as county_population from segment_id s""",
    "top_stations": """
select p.STATION_ID, p.VOL, p.state, p.tmc_code, p.measurement_tstamp
from predictions p join (select STATION_ID, max(VOL) as top from predictions group by STATION_ID) m
  on m.STATION_ID = p.STATION_ID and m.top = p.VOL
order by p.VOL desc, p.STATION_ID, p.measurement_tstamp, p.tmc_code limit 10""",
    "find_counties": f"""with {SEGMENTS},
texts as (select tmc_code, case when f_system % 3 = 0 then upper(county) when f_system % 3 = 1 then concat(substr(county, 7, 9), ', s') else 'no such' end as part from seg)
select tmc_code, part, (select min(p.name) from county_population p where contains(lower(p.name), lower(part))) as found_name,
  (select min_by(p.population, p.name) from county_population p where contains(lower(p.name), lower(part))) as found_population from texts""",
    "county_lookup": "select name, population from county_population where lower(name) like '%county 7%' order by name limit 1",
    # aggregates
    "station_counts": "select STATION_ID, count(measurement_tstamp) as n from predictions group by STATION_ID",
    "availability_month": "select STATION_ID, YEAR, MONTH, count(*) as n from count_hourly where STATION_ID is not null group by all",
    "availability_hour": "select STATION_ID, " + ", ".join(
        f"count(*) filter (HOUR = {h}) as h{h}" for h in range(24)
    ) + " from count_hourly group by STATION_ID",
    "distinct_stations": "select count(distinct STATION_ID) as stations from count_hourly",
    "available_stations": "select distinct STATION_ID, STATE_NAME from count_hourly",
    "join_coverage": f"""with {DATASET}
select 'before' as side, count(distinct tmc_code) as segments, count(distinct (tmc_code, measurement_tstamp)) as segment_hours from probe_all
union all
select 'after', count(distinct tmc_code), count(distinct (tmc_code, measurement_tstamp)) from dataset""",
    "hourly_by_weekday": """
select cast(extract(isodow from measurement_tstamp)-1 as int) as dayofweek, cast(extract(hour from measurement_tstamp) as int) as hour,
       round(avg(VOL), 6) as avg_vol from predictions group by 1, 2""",
    "station_max": "select STATION_ID, max(VOL) as max_vol from predictions group by STATION_ID",
    "volume_histogram": _histogram("predictions", "VOL"),
    "station_max_histogram": _histogram("(select max(VOL) as m from predictions group by STATION_ID)", "m"),
    "worst_zero_histogram": _histogram(
        f"(select VOL from predictions where tmc_code = (select tmc_code from {_zero_share('VOL')} "
        "order by pct_zero desc, tmc_code limit 1))", "VOL"),
    "error_histogram": f"""with {ERRORS},
f as (select least(floor(pct/10), 29)*10 as lower, count(*) as n from errors where not zero and pct between 0 and 300 group by 1)
select cast(b.lower as double) as lower, coalesce(n, 0) as n
from (select unnest(range(0, 300, 10)) as lower) b left join f on f.lower = b.lower""",
    "error_histogram_fine": f"""with {ERRORS},
f as (select least(floor(pct/5), 29)*5 as lower, count(*) as n from errors where pct between 0 and 150 group by 1)
select cast(b.lower as double) as lower, coalesce(n, 0) as n
from (select unnest(range(0, 150, 5)) as lower) b left join f on f.lower = b.lower""",
    "dataset_year": """
select case when min(y) = max(y) then cast(min(y) as string) else concat(cast(min(y) as string), cast(max(y) as string)) end as dataset_year
from (select extract(year from measurement_tstamp) as y from probe_all)""",
    "accuracy_metrics": f"""with {METRICS}
select zeros_vol, zeros_predicted, rows_with_zeros, rows_compared, round(mean_abs_diff_zeros, 6) as mean_abs_diff_zeros,
       round(percent_diff, 6) as percent_diff, round(percent_diff_day, 6) as percent_diff_day,
       round(percent_diff_night, 6) as percent_diff_night, round(median_abs_diff_zeros, 6) as median_abs_diff_zeros from metrics""",
    "within_thresholds": _thresholds(75),
    "within_thresholds_50": _thresholds(50),
    "zero_share": f"""
select col, tmc_code, round(pct_zero, 6) as pct_zero from {_zero_share('VOL')}
union all select col, tmc_code, round(pct_zero, 6) from {_zero_share('Predicted_VOL')}""",
    "zero_share_summary": " union all ".join(
        f"select '{c}' as col, count(*) as segments, round(avg(pct_zero), 6) as avg_pct, round(min(pct_zero), 6) as min_pct, "
        f"round(max(pct_zero), 6) as max_pct, (select tmc_code from {_zero_share(c)} order by pct_zero desc, tmc_code limit 1) as max_tmc "
        f"from {_zero_share(c)}"
        for c in ("VOL", "Predicted_VOL")
    ),
    "peak_metrics": """with p as (select *, extract(hour from measurement_tstamp) as hh from predictions)
select (select measurement_tstamp from p order by Predicted_VOL desc, tmc_code, measurement_tstamp limit 1) as max_volume_time,
       max(Predicted_VOL) as max_volume,
       round(avg(Predicted_VOL) filter (hh between 6 and 9), 6) as avg_morning,
       round(median(Predicted_VOL) filter (hh between 6 and 9), 6) as median_morning,
       round(stddev_samp(Predicted_VOL) filter (hh between 6 and 9), 6) as std_morning,
       round(avg(Predicted_VOL) filter (hh between 16 and 19), 6) as avg_evening,
       round(median(Predicted_VOL) filter (hh between 16 and 19), 6) as median_evening,
       round(stddev_samp(Predicted_VOL) filter (hh between 16 and 19), 6) as std_evening
from p""",
    "max_error_row": """
select tmc_code, measurement_tstamp, abs(Predicted_VOL - VOL) as abs_error from predictions
order by abs_error desc, tmc_code, measurement_tstamp limit 1""",
    "hour_profile": """
select cast(extract(hour from measurement_tstamp) as int) as hour, min(DIR) as DIR, round(avg(VOL), 6) as VOL,
       round(avg(Predicted_VOL), 6) as Predicted_VOL
from predictions where tmc_code = '104P00003' and cast(measurement_tstamp as date) = date '2024-01-10' group by 1""",
    "volume_quintile": """with c as (select quantile_cont(VOL, [0.2, 0.4, 0.6, 0.8]) as q from predictions)
select tmc_code, measurement_tstamp, VOL,
       cast(1 + (VOL >= q[1])::int + (VOL >= q[2])::int + (VOL >= q[3])::int + (VOL >= q[4])::int as int) as quintile
from predictions, c""",
    "r2_within": """
select round(1 - sum((VOL-Predicted_VOL)*(VOL-Predicted_VOL)) / (var_pop(VOL)*count(*)), 6) as r2,
       round(count(*) filter (VOL <> 0 and abs(VOL-Predicted_VOL)/VOL < 0.15) / count(*) * 100, 6) as pct_within from predictions""",
    "huber_loss": """
select round(avg(case when abs(VOL-Predicted_VOL) <= 500 then 0.5*(VOL-Predicted_VOL)*(VOL-Predicted_VOL)
                 else 500*(abs(VOL-Predicted_VOL)-250) end), 6) as huber_loss from predictions""",
    "sanity_report": """
select count(*) as n_rows, count(*) filter (speed is null or travel_time_seconds is null or data_density is null) as rows_with_null,
       count(*) filter (isinf(speed) or isinf(travel_time_seconds)) as rows_with_infinite,
       count(*) - (select count(*) from (select distinct speed, travel_time_seconds, data_density from probe_all)) as duplicate_rows
from probe_all""",
    "importance_mean": f"""with {LONG}
select feature, round(avg(importance), 6) as mean_importance from long where importance is not null
group by feature order by avg(importance) desc, feature limit 10""",
    # windows
    "neighbour_features": f"""with {SEGMENTS},
rows_ as (
  select {_number('p.tmc_code')} as tmc_code, {_variant('p.tmc_code')} as TMC_Value, seg.DIR,
         cast(epoch(measurement_tstamp) as bigint) as measurement_tstamp, speed, travel_time_seconds
  from probe_all p join seg on seg.tmc_code = p.tmc_code)
select *, {', '.join(f'case when DIR is not null then lead({c}) over w end as {c}_before, case when DIR is not null then lag({c}) over w end as {c}_after' for c in ('measurement_tstamp', 'speed', 'travel_time_seconds'))}
from rows_ window w as (partition by tmc_code, TMC_Value, DIR order by measurement_tstamp)""",
    "neighbour_hours": f"""with {SEGMENTS},
rows_ as (
  select {_number('p.tmc_code')} as tmc_code, {_variant('p.tmc_code')} as TMC_Value, seg.DIR,
         cast(epoch(measurement_tstamp) as bigint) as measurement_tstamp, speed
  from probe_truck p join seg on seg.tmc_code = p.tmc_code)
select r.*, b.speed as speed_before, a.speed as speed_after from rows_ r
left join rows_ b on b.tmc_code = r.tmc_code and b.TMC_Value = r.TMC_Value and b.DIR = r.DIR and b.measurement_tstamp = r.measurement_tstamp + 3600
left join rows_ a on a.tmc_code = r.tmc_code and a.TMC_Value = r.TMC_Value and a.DIR = r.DIR and a.measurement_tstamp = r.measurement_tstamp - 3600""",
    "first_per_segment": f"""
select {_PROBE_SELECT} from (
  select *, row_number() over (partition by tmc_code order by measurement_tstamp) as rn from probe_all) where rn = 1""",
    "first_per_station": """
select STATION_ID, STATE_NAME, DIR, VOL, YEAR, MONTH, DAY, HOUR from (
  select *, row_number() over (partition by STATION_ID, STATE_NAME order by YEAR, MONTH, DAY, HOUR) as rn from count_hourly) where rn = 1""",
    # sorts, samples, sets
    "importance_top10": f"""with {LATEST}
select feature, epoch, round(importance, 6) as importance from long
where feature in (select feature from latest where importance is not null order by importance desc, feature limit 10)""",
    "importance_ranked": f"with {LATEST} select epoch, feature, round(importance, 6) as importance from latest",
    "importance_long": f"with {LONG} select epoch, feature, round(importance, 6) as importance from long",
    "distinct_segments": "select distinct tmc_code from probe_all",
    "segment_dates": "select distinct cast(measurement_tstamp as date) as day from probe_all where tmc_code = '104P00003'",
    "sample_stations": """
select * from station order by md5(concat_ws('|', '42', STATION_ID, STATE_NAME, cast(DIR as string))), STATION_ID limit 60""",
    "map_sample": f"""with {SEGMENTS}
select start_latitude, start_longitude, tmc_code, measurement_tstamp from (
  select seg.start_latitude, seg.start_longitude, p.tmc_code, p.measurement_tstamp,
         md5(concat_ws('|', '42', p.tmc_code, strftime(p.measurement_tstamp, '%Y-%m-%d %H:%M:%S'))) as h
  from probe_all p join seg on seg.tmc_code = p.tmc_code) order by h limit 500""",
    "training_stations": TRAINED,
    "missing_stations": f"""with {DATASET},
located as (
  select m.STATION_ID from probes p join tier1 m on m.Tmc = p.tmc_code join seg on seg.tmc_code = p.tmc_code)
select distinct STATION_ID from located where STATION_ID not in (select STATION_ID from dataset)""",
    # scalar functions
    "segment_code": f"""
select distinct tmc_code as tmc_code_raw, {_variant('tmc_code')} as TMC_Value, {_number('tmc_code')} as tmc_code from probe_all""",
    "calendar_features": """
select tmc_code, cast(epoch(measurement_tstamp) as bigint) as measurement_tstamp, """ + ", ".join(
        f"cast(extract({p} from measurement_tstamp){' - 1' if p == 'isodow' else ''} as int) as {n}"
        for n, p in zip(CALENDAR_COLUMNS, ["year", "month", "day", "hour", "isodow"])
    ) + " from probe_all",
    "startdate_epoch": "select tmc, cast(epoch(cast(active_start_date as timestamptz)) as bigint) as active_start_date from segment_id",
    "density_codes": """
select tmc_code, measurement_tstamp,
       cast(case when data_density is null then (select count(distinct data_density) from probe_all)
                 else dense_rank() over (order by data_density nulls last) - 1 end as int) as data_density from probe_all""",
    "direction_code": f"select tmc, direction, {_direction('direction')} as DIR from segment_id",
    "count_timestamp": """
select STATION_ID, VOL, make_timestamp(2000+YEAR, MONTH, DAY, HOUR, 0, 0) as measurement_tstamp from count_hourly""",
    # display
    "metrics_table": f"""with {METRICS},
worst as (select * from errors order by diff desc, tmc_code, measurement_tstamp limit 1)
select unnest(['Overall Percent Difference', 'Daytime Percent Difference (7 AM - 7 PM)', 'Nighttime Percent Difference (7 PM - 7 AM)',
  'Number of zeros in VOL', 'Number of zeros in Predicted_VOL', 'Number of rows with zero in either VOL or Predicted_VOL',
  'Average Absolute Difference for zeros', 'Median Absolute Difference for zeros', 'Time of Maximum Difference',
  'TMC Code of Maximum Difference']) as Metric,
  unnest([printf('%.2f%%', percent_diff), printf('%.2f%%', percent_diff_day), printf('%.2f%%', percent_diff_night),
  cast(zeros_vol as string), cast(zeros_predicted as string), cast(rows_with_zeros as string),
  printf('%.2f', mean_abs_diff_zeros), printf('%.2f', median_abs_diff_zeros),
  strftime(measurement_tstamp, '%Y-%m-%d %H:%M:%S'), tmc_code]) as Value
from metrics, worst""",
    "peak_table": """with p as (select *, extract(hour from measurement_tstamp) as hh from predictions)
select unnest(['Average Morning Peak (6 AM - 9 AM)', 'Average Evening Peak (4 PM - 7 PM)']) as Metric,
  unnest([printf('%.2f', avg(Predicted_VOL) filter (hh between 6 and 9)),
          printf('%.2f', avg(Predicted_VOL) filter (hh between 16 and 19))]) as Value from p""",
    "hold_out_table": f"""with {METRICS}
select unnest(['Zeros in VOL', 'Zeros in Predicted_VOL', 'Rows with a zero', 'Average absolute difference, rows with a zero',
  'Median absolute difference, rows with a zero', 'Rows compared', 'Percent difference', 'Percent difference, day',
  'Percent difference, night']) as Metric,
  unnest([cast(zeros_vol as string), cast(zeros_predicted as string), cast(rows_with_zeros as string),
  printf('%.2f', mean_abs_diff_zeros), printf('%.2f', median_abs_diff_zeros), cast(rows_compared as string),
  printf('%.2f', percent_diff), printf('%.2f', percent_diff_day), printf('%.2f', percent_diff_night)]) as Value
from metrics
""" + "".join(
        f"""union all select unnest(['Segments with zeros in {c}', 'Average share of zeros in {c}', 'Least share of zeros in {c}',
  'Largest share of zeros in {c}', 'Segment of the largest share in {c}']),
  unnest([cast(count(*) as string), printf('%.2f', avg(pct_zero)), printf('%.2f', min(pct_zero)), printf('%.2f', max(pct_zero)),
  arg_min(tmc_code, (-pct_zero, tmc_code))]) from {_zero_share(c)}
"""
        for c in ("VOL", "Predicted_VOL")
    ) + """union all
select printf('Within %d%%', t.threshold),
       printf('%.2f', count(*) filter (coalesce(pct <= t.threshold, false)) / count(*) * 100)
from errors, (select unnest(range(5, 51, 5)) as threshold) t where not zero group by t.threshold""",
    # model tables
    "feature_table": f"with {FEATURES} select * from features",
    "split_rows": f"""with {FEATURES}
select {', '.join(FEATURE_KEY)}, cast(('0x' || substr({_split(FEATURE_KEY)}, 1, 8)) as bigint) % 1000 < 100 as test from features""",
    "standardise": f"""with {SCALED}
select row_hash, {', '.join(f'round(z_{c}, 6) as {c}' for c in feature_columns())} from scaled""",
    "permutation_importance": _importance(),
    "huber_rounds": _huber_rounds(),
    "evaluate_huber": _huber_measures(),
    "fit_predict_huber": _huber(
        f"select {', '.join(FEATURE_KEY)}, round(b0 + b1*z_aadt + b2*z_speed_All, 4) as score from scaled, c5 where test"
    ),
    "evaluate_fixed": f"""with {SCALED},
scored as (select VOL, {' + '.join(f'({w}) * z_{c}' for c, w in fixed_weights().items())} as score from scaled where test)
select round(avg(case when abs(VOL-score) <= 500 then 0.5*(VOL-score)*(VOL-score) else 500*(abs(VOL-score)-250) end), 6) as huber_loss,
       round(1 - sum((VOL-score)*(VOL-score)) / (var_pop(VOL)*count(*)), 6) as r2,
       round(count(*) filter (VOL <> 0 and abs(VOL-score)/VOL < 0.15) / count(*) * 100, 6) as pct_within from scored""",
}

#: One station on each segment and hour: found by a join or carried along, rows are the same.
CHECKS["score_in_place"] = CHECKS["merge_predictions"]
