"""The same queries in DuckDB SQL over views of the provided tables.

The geohash is found another way than in the library: by counting, per axis, the cell
borders below the coordinate.
"""

from __future__ import annotations

REST = """
select c.c_custkey as id,
       cast(c.c_custkey % 50 as int) as franchise_id,
       concat('F', cast(c.c_custkey % 50 as varchar)) as franchise_name,
       cast(c.c_custkey % 1000 as int) as restaurant_franchise_id,
       case when c.c_custkey % 17 = 0 then null else n.n_name end as country,
       concat(n.n_name, '_C', cast(c.c_custkey % 4 as varchar)) as city,
       case when c.c_custkey % 10 in (0, 1) then null
            else cast(-60 + n.n_nationkey * 5 as double) + cast(c.c_custkey % 4 as double) * 0.25 end as lat,
       case when c.c_custkey % 10 in (0, 2) then null
            else cast(-150 + n.n_nationkey * 12 as double) + cast(c.c_custkey % 4 as double) * 0.5 end as lng
from customer c join nation n on c.c_nationkey = n.n_nationkey
"""

WEA = """
select case when event_id % 97 = 0 then null
            else cast(-60 + (user_id % 25) * 5 as double) + cast(event_id % 8 as double) * 0.125 end as lat,
       cast(-150 + (user_id % 25) * 12 as double) + cast(event_id % 8 as double) * 0.25 as lng,
       celsius as avg_tmpr_c,
       floor((celsius * 9.0::double / 5.0::double + 32.0::double) * 64.0::double) / 64.0::double as avg_tmpr_f,
       cast(cast(ts as date) as varchar) as w_date
from (select *, floor(value * 64.0::double) / 64.0::double as celsius from events)
"""

DATED = """
select lat, lng, avg_tmpr_c, avg_tmpr_f,
       cast(year(cast(w_date as date)) as int) as year,
       cast(month(cast(w_date as date)) as int) as month,
       cast(day(cast(w_date as date)) as int) as day
from wea
"""

GAZ = """
select n.n_name as country,
       concat(n.n_name, '_C', cast(t.k as varchar)) as city,
       cast(-60 + n.n_nationkey * 5 as double) + cast(t.k as double) * 0.25 as lat,
       cast(-150 + n.n_nationkey * 12 as double) + cast(t.k as double) * 0.5 as lng
from nation n cross join (values (0), (1), (2), (3)) t(k)
where not (n.n_nationkey % 7 = 3 and t.k = 3)
"""

REPLIES = """
select r.id,
       case when r.city is not null and r.country is not null
            then r.franchise_name || ', ' || r.city || ', ' || r.country end as query,
       case when r.id % 11 = 5 then 'junk'
            when r.id % 11 = 7 then null
            when g.lat is null then '{"results":[]}'
            else '{"results":[{"geometry":{"lat":' || cast(g.lat as varchar)
                 || ',"lng":' || cast(g.lng as varchar) || '}}]}' end as reply
from rest r left join gaz g on r.country = g.country and r.city = g.city
"""

ANSWERS = """
select id, query,
       case when json_valid(reply) then cast(json_extract(reply, '$.results[0].geometry.lat') as double) end as lat,
       case when json_valid(reply) then cast(json_extract(reply, '$.results[0].geometry.lng') as double) end as lng
from replies
"""

EDGES = """
select event_id as id,
       case event_id % 31
            when 1 then null when 2 then cast('nan' as double) when 3 then cast('infinity' as double)
            when 4 then 95.0::double when 5 then -95.0::double
            else -90 + (event_id % 1025) * (180.0::double / 1024)
                 + (event_id % 3 - 1) * pow(2.0::double, -30) end as lat,
       case user_id % 29
            when 1 then null when 2 then cast('nan' as double) when 3 then cast('-infinity' as double)
            when 4 then 200.0::double
            else -180 + ((event_id * 7 + user_id) % 1025) * (360.0::double / 1024)
                 - (event_id % 3 - 1) * pow(2.0::double, -30) end as lng
from events
"""

FILLED = """
select r.id, r.franchise_id, r.franchise_name, r.restaurant_franchise_id, r.country, r.city,
       case when r.lat is null then g.lat else r.lat end as lat,
       case when r.lng is null and r.lat is null then g.lng else r.lng end as lng
from rest r
left join gaz g on r.country = g.country and r.city = g.city and r.country <> '' and r.city <> ''
"""

REPLACED = """
select r.id, r.franchise_id, r.franchise_name, r.restaurant_franchise_id, r.country, r.city,
       case when r.lat is null or r.lng is null then g.lat else r.lat end as lat,
       case when r.lat is null or r.lng is null then g.lng else r.lng end as lng
from rest r left join gaz g on r.country = g.country and r.city = g.city
"""

MISSPELT = """
select id, franchise_id, franchise_name, restaurant_franchise_id, country,
       case id % 11
            when 1 then lower(city)
            when 2 then ' ' || translate(city, 'AEIOU_', 'ÁÈÎÕÜ-') || ' !'
            when 3 then substr(city, 1, 1) || substr(city, 3)
            when 4 then substr(city, 1, 1) || city
            when 5 then substr(city, 1, 1) || 'q' || substr(city, 3)
            when 6 then substr(city, 2, 1) || substr(city, 1, 1) || substr(city, 3)
            when 7 then substr(city, 3)
            when 8 then city || '7'
            when 9 then '?!'
            when 10 then city || ' city'
            else city end as city
from rest
"""

PLAIN = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"
DIGITS = "regexp_replace({0}, '[^0-9]+', ' ', 'g')"


def _similar(edits: int) -> str:
    """CTE body: for each asked place the most similar one, every pair compared."""
    a, b = (f"{PLAIN.format(f'{side}.city')} || '|' || {PLAIN.format(f'{side}.country')}" for side in "ab")
    distance = " + ".join(f"levenshtein({PLAIN.format(f'a.{x}')}, {PLAIN.format(f'b.{x}')})" for x in ("city", "country"))
    letters = f"length(regexp_replace({a}, '[^a-z]+', '', 'g'))"
    return f"""
select city, country, lat, lng, edits::int as edits, place from (
    select a.city, a.country, b.lat, b.lng, b.city || ', ' || b.country as place,
           case when a.city = b.city and a.country = b.country then 0 else {distance} end as edits,
           case when a.city = b.city and a.country = b.country then 0 else 1 end as other,
           row_number() over (partition by a.city, a.country order by other, edits, b.city, b.country) as nth
    from (select distinct city, country from misspelt where city is not null and country is not null) a, gaz b
    where (a.city = b.city and a.country = b.country)
       or ({PLAIN.format('a.city')} <> '' and {DIGITS.format(a)} = {DIGITS.format(b)}
           and {distance} <= least({edits}, {letters} // 4))
) where nth = 1
"""


CELL_MEANS = "avg(avg_tmpr_c) as avg_temp_c, avg(avg_tmpr_f) as avg_temp_f"


def _axis(value: str, limit: int) -> str:
    width = 2 * limit / 1024
    borders = f"list_filter(range(0, 1024), lambda k: k = 0 or {value} > {-limit} + k * {width}::double)"
    return f"case when {value} is null then null when isnan({value}) then 0 else list_max({borders}) end"


def _hash() -> str:
    letters = []
    for place in range(4):
        bits = []
        for j in range(5):
            i = 5 * place + j
            axis = "kx" if i % 2 == 0 else "ky"
            bits.append(f"((({axis} >> {9 - i // 2}) & 1) << {4 - j})")
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', cast(1 + {' + '.join(bits)} as int), 1)")
    return f"case when kx is not null and ky is not null then {' || '.join(letters)} end"


def _tagged(source: str) -> str:
    """CTE body: the rows of ``source`` with their geohash."""
    return f"""
select * exclude (kx, ky), {_hash()} as geohash
from (select *, {_axis("lng", 180)} as kx, {_axis("lat", 90)} as ky from {source})
"""


def _with(final: str, **ctes: str) -> str:
    return "with " + ", ".join(f"{name} as ({body})" for name, body in ctes.items()) + "\n" + final


def _cells(keys: str) -> str:
    return f"select {keys}, {CELL_MEANS} from tagged_wea group by {keys}"


COMPLETED = {"rest": REST, "gaz": GAZ, "filled": FILLED, "tagged": _tagged("filled")}
WEATHER = {"wea": WEA, "tagged_wea": _tagged("wea")}

BY_CELL = _with(
    "select t.*, avg_temp_c, avg_temp_f from tagged t left join cells c on t.geohash = c.geohash",
    **COMPLETED,
    **WEATHER,
    cells=_cells("geohash"),
)
BY_CELL_DATE = _with(
    "select t.*, c.w_date, avg_temp_c, avg_temp_f from tagged t left join cells c on t.geohash = c.geohash",
    **COMPLETED,
    **WEATHER,
    cells=_cells("geohash, w_date"),
)
BY_DATE_MEANS = _with(
    "select geohash, w_date, avg_temp_c, avg_temp_f from cells", **WEATHER, cells=_cells("geohash, w_date")
)
COUNTS = _with(
    "select franchise_name, city, count(id) as restaurant_count from rest "
    "where country is not null group by franchise_name, city",
    rest=REST,
)
DATED_ROWS = _with("select * from dated", wea=WEA, dated=DATED)

TWICE = """
select * replace (case when day(cast(w_date as date)) <= 10 then avg_tmpr_c + 1 else avg_tmpr_c end as avg_tmpr_c) from wea
"""
MIXED_ROWS = _with(
    "select * replace (case when day % 2 = 1 then floor(avg_tmpr_c) else avg_tmpr_c end as avg_tmpr_c), "
    "case when day % 2 = 0 then 'n' || month end as note from dated",
    wea=WEA,
    dated=DATED,
)

ORACLE: dict[str, str] = {
    "restaurant_counts": COUNTS,
    "restaurant_counts_top5": COUNTS
    + " order by restaurant_count desc nulls last, franchise_name nulls first, city nulls first limit 5",
    "missing_coords": _with("select * from rest where lat is null or lng is null", rest=REST),
    "complete_coords": _with("select * from rest where lat is not null and lng is not null", rest=REST),
    "by_franchise": _with("select * from rest where franchise_name = 'F7'", rest=REST),
    "preview_geohash": _with(
        "select id, franchise_name, city, lat, lng, geohash from tagged order by id limit 10",
        rest=REST,
        tagged=_tagged("rest"),
    ),
    "row_count": _with("select count(*) as row_count from rest", rest=REST),
    "query_text": _with(
        "select id, case when city is not null and country is not null then "
        "coalesce(case when id % 13 = 0 then null else franchise_name end, 'None') "
        "|| ', ' || city || ', ' || country end as query from rest",
        rest=REST,
    ),
    "parse_packed_coords": _with(
        "select id, try_cast(string_split(packed, ',')[1] as double) as lat, "
        "try_cast(string_split(packed, ',')[2] as double) as lng from packed",
        rest=REST,
        packed="select id, case id % 7 when 3 then 'abc,2' when 4 then cast(lng as varchar) when 5 then '' "
        "else cast(lat as varchar) || ',' || cast(lng as varchar) end as packed from rest",
    ),
    "gazetteer_from_replies": _with("select * from answers", rest=REST, gaz=GAZ, replies=REPLIES, answers=ANSWERS),
    "geocode_by_replies": _with(
        """
select r.id, r.franchise_id, r.franchise_name, r.restaurant_franchise_id, r.country, r.city,
       case when r.lat is null or r.lng is null then p.lat else r.lat end as lat,
       case when r.lat is null or r.lng is null then p.lng else r.lng end as lng
from rest r left join points p on p.query = r.franchise_name || ', ' || r.city || ', ' || r.country
""",
        rest=REST,
        gaz=GAZ,
        replies=REPLIES,
        answers=ANSWERS,
        points="select query, min(lat) as lat, min(lng) as lng from answers "
        "where lat is not null and lng is not null group by query",
    ),
    "open_questions": _with(
        "select distinct franchise_name, city, country, franchise_name || ', ' || city || ', ' || country as query "
        "from rest where (lat is null or lng is null) and city is not null and country is not null",
        rest=REST,
    ),
    "geocode_lookup": _with(
        "select r.*, g.lat as found_lat, g.lng as found_lng from rest r "
        "left join gaz g on r.country = g.country and r.city = g.city where r.lat is null or r.lng is null",
        rest=REST,
        gaz=GAZ,
    ),
    "geocode_replace": _with("select * from replaced", rest=REST, gaz=GAZ, replaced=REPLACED),
    "geocode_replace_shuffled": _with("select * from replaced", rest=REST, gaz=GAZ, replaced=REPLACED),
    "geocode_fill_gaps": _with("select * from filled", rest=REST, gaz=GAZ, filled=FILLED),
    "geocode_fill_gaps_shuffled": _with("select * from filled", rest=REST, gaz=GAZ, filled=FILLED),
    "geocode_asked_places": _with("select * from filled", rest=REST, gaz=GAZ, filled=FILLED),
    "geocode_forgiving": _with("select * from matched", rest=REST, misspelt=MISSPELT, gaz=GAZ, matched=_similar(2)),
    "geocode_job_forgiving": _with(
        "select m.id, franchise_id, franchise_name, restaurant_franchise_id, m.country, m.city, s.lat, s.lng "
        "from misspelt m left join matched s on m.city = s.city and m.country = s.country",
        rest=REST,
        misspelt=MISSPELT,
        gaz=GAZ,
        matched=_similar(1),
    ),
    "geohash_restaurants": _with("select * from tagged", rest=REST, tagged=_tagged("rest")),
    "geohash_weather": _with("select * from tagged_wea", **WEATHER),
    "geohash_edges": _with("select id, geohash from tagged", edges=EDGES, tagged=_tagged("edges")),
    "complete_restaurants": _with("select * from tagged", **COMPLETED),
    "weather_by_cell": _with("select geohash, avg_temp_c, avg_temp_f from cells", **WEATHER, cells=_cells("geohash")),
    "weather_by_cell_date": BY_DATE_MEANS,
    "weather_avg_auto_name": _with(
        'select geohash, avg(avg_tmpr_c) as "avg(avg_temp)" from tagged_wea group by geohash',
        **WEATHER,
    ),
    "weather_date_from_parts": BY_DATE_MEANS,
    "enrich_by_cell": BY_CELL,
    "enrich_by_cell_merged": BY_CELL,
    "enrich_by_cell_date": BY_CELL_DATE,
    "csv_fixed_schema": _with("select * from rest", rest=REST),
    "csv_inferred": _with("select * replace (cast(id as int) as id) from rest", rest=REST),
    "csv_inferred_types": "select * from (values ('id', 'int'), ('franchise_id', 'int'), ('franchise_name', 'string'), "
    "('restaurant_franchise_id', 'int'), ('country', 'string'), ('city', 'string'), ('lat', 'double'), "
    "('lng', 'double')) t(name, type)",
    "csv_types_of_new_files": "select * from (values "
    + ", ".join(
        f"({delivery}::int, '{name}', '{kind}')"
        for delivery, kinds in (
            (1, "int int string int string string double double date"),
            (2, "bigint int string double string string string double timestamp"),
        )
        for name, kind in zip(
            "id franchise_id franchise_name restaurant_franchise_id country city lat lng opened".split(), kinds.split()
        )
    )
    + ") t(delivery, name, type) where (select count(*) from customer) > 0",
    "geocode_job_set_aside": _with(
        "select * from filled where id % 19 <> 3 and id % 23 <> 5", rest=REST, gaz=GAZ, filled=FILLED
    ),
    "csv_lines_set_aside": _with(
        "select line, count(*) over () as counted from (select id || ',' "
        "|| case when id % 23 = 5 then '1.5' else franchise_id::varchar end || ',' || franchise_name || ',' "
        "|| restaurant_franchise_id || ',' || coalesce(country, '') || ',' || city || ',' "
        "|| case when id % 19 = 3 then 'north' else coalesce(lat::varchar, '') end || ',' "
        "|| coalesce(lng::varchar, '') as line from rest where id % 19 = 3 or id % 23 = 5)",
        rest=REST,
    ),
    "weather_csv_by_cell_date": BY_DATE_MEANS,
    "parquet_with_schema": _with(
        "select * exclude (franchise_id), cast(null as int) as franchise_id from rest", rest=REST
    ),
    "partitioned_roundtrip": _with("select * from tagged", **COMPLETED),
    "prefix_roundtrip": _with("select * from tagged", **COMPLETED),
    "prefix_some_cells": _with(
        "select * from tagged where regexp_matches(geohash, '^(3|s0|7x5|66c9|th)')", **COMPLETED
    ),
    "enrich_job_prefix_folders": BY_CELL,
    "weather_by_date_read": DATED_ROWS,
    "recompress": DATED_ROWS,
    "zip_ingest": DATED_ROWS,
    "zip_mixed_members": MIXED_ROWS,
    "unpack_mixed_read": MIXED_ROWS,
    "recompress_mixed": MIXED_ROWS,
    "unpack_mixed_then_enrich": _with(
        "select t.*, c.w_date, avg_temp_c, avg_temp_f from tagged t left join cells c on t.geohash = c.geohash",
        **COMPLETED,
        wea=WEA,
        mixed="select * replace (case when day(cast(w_date as date)) % 2 = 1 then floor(avg_tmpr_c) "
        "else avg_tmpr_c end as avg_tmpr_c) from wea",
        tagged_wea=_tagged("mixed"),
        cells=_cells("geohash, w_date"),
    ),
    "unpack_second_delivery": _with(
        "select * replace (case when day <= 10 then avg_tmpr_c + 1 else avg_tmpr_c end as avg_tmpr_c) from dated",
        wea=WEA,
        dated=DATED,
    ),
    "averages_second_delivery": _with(
        "select geohash, w_date, avg_temp_c, avg_temp_f from cells",
        wea=WEA,
        twice=TWICE,
        tagged_wea=_tagged("twice"),
        cells=_cells("geohash, w_date"),
    ),
    "enrich_job_from_averages": _with(
        "select t.*, avg_temp_c, avg_temp_f from tagged t left join cells c on t.geohash = c.geohash",
        **COMPLETED,
        wea=WEA,
        twice=TWICE,
        tagged_wea=_tagged("twice"),
        cells=_cells("geohash"),
    ),
    "counts_job": COUNTS,
    "geocode_job_replace": _with("select * from replaced", rest=REST, gaz=GAZ, replaced=REPLACED),
    "geocode_job_fill_gaps": _with("select * from filled", rest=REST, gaz=GAZ, filled=FILLED),
    "geocode_job_counts": _with(
        "select count(*) as rows_read, count(*) filter (lat is null or lng is null) as rows_to_mend, "
        "count(*) as rows_written from rest",
        rest=REST,
    ),
    "gzip_codec": "select unnest(['id', 'franchise_id', 'franchise_name', 'restaurant_franchise_id', 'country', "
    "'city', 'lat', 'lng']) as name, 'GZIP' as codec",
    "enrich_without_doubling": _with(
        "select t.id, 1::bigint as n, c.avg_temp_c as mean from tagged t left join cells c on t.geohash = c.geohash",
        **COMPLETED,
        **WEATHER,
        cells=_cells("geohash"),
    ),
    "enrich_job_from_cell_folders": _with(
        "select t.*, avg_temp_c, avg_temp_f from tagged t left join cells c on t.geohash = c.geohash",
        rest=REST,
        corner="select * replace (-89.9::double + (id % 2) * 0.25::double as lat, "
        "-179.9::double + (id % 4) * 0.125::double as lng) from rest",
        tagged=_tagged("corner"),
        wea=WEA,
        dated=DATED,
        corner_wea="select * replace (-89.9::double + ((month + day) % 2) * 0.25::double as lat, "
        "-179.9::double + ((month + day) % 4) * 0.125::double as lng) from dated",
        tagged_wea=_tagged("corner_wea"),
        cells=_cells("geohash"),
    ),
    "tag_geohash_job": _with("select * from tagged", rest=REST, tagged=_tagged("rest")),
    "enrich_job_by_cell_date": BY_CELL_DATE,
    "end_to_end": BY_CELL,
}
