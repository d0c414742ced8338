"""SQL for the registered queries, over the same whole tables, for a second engine (DuckDB)."""

from __future__ import annotations

import math

from calipers.functions.text import NUMBER_PATTERN
from calipers.operators.layout import ORDER, Glyphs
from calipers.plans import registry as Q
from calipers.plans.oracle_views import VIEWS, with_views

CONFIG, GAP, REACH = Q.CONFIG, Q.GAP, Q.REACH


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def _number(col: str, places: int) -> str:
    value = f"try_cast(nullif(regexp_extract({col}, '{NUMBER_PATTERN}'), '') as double)"
    return f"ceil({value}{' * 10' * places}){' / 10' * places}"


def _label(number: str, places: int) -> str:
    fixed = f"printf('%.{places}f', {number})"
    return (
        f"case when {number} is null then null when contains({fixed}, '.') "
        f"then rtrim(rtrim({fixed}, '0'), '.') || '\"' else {fixed} || '\"' end"
    )


def _feet(number: str) -> str:
    whole = f"try_cast(trunc({number}) as bigint)"
    return f"cast({whole} // 12 as varchar) || '''' || cast({whole} % 12 as varchar) || '\"'"


def _text_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _choice(source: str) -> str:
    return f"""select i.oms_id, c.attribute_id as dimension_guid, c.dimension_name
        from (select distinct oms_id, product_type from {source}) i join dimension_config c
        on c.product_type = case when i.product_type in (select product_type from dimension_config)
            then i.product_type else 'DEFAULT' end"""


def _pivot(choice: str) -> str:
    cols = ", ".join(f"min(attribute_value) filter (where dimension_name = '{n}') as {n}"
                     for n in ("width", "height", "depth"))
    return f"""select c.oms_id, {cols} from {choice} c left join item_attributes a
        on a.oms_id = c.oms_id and a.attribute_id = c.dimension_guid group by c.oms_id"""


def _numbers(wide: str) -> str:
    return f"select *, {', '.join(f'{_number(n, 2)} as {n}_in' for n in ('width', 'height', 'depth'))} from {wide}"


def _attribute(aid: str, name: str) -> str:
    return f"(select oms_id, attribute_value as {name} from item_attributes where attribute_id = '{aid}')"


def _product(columns: dict[str, str]) -> str:
    tables = [_attribute(a, n) for n, a in columns.items()]
    return tables[0] + "".join(f" join {t} using (oms_id)" for t in tables[1:])


V = dict(VIEWS)
V |= {
    "image_choice": (["merged_images", "dimension_config"], _choice("merged_images")),
    "item_choice": (["items", "dimension_config"], _choice("items")),
    "image_dims": (["image_choice", "item_attributes"], _pivot("image_choice")),
    "item_dims": (["item_choice", "item_attributes"], _pivot("item_choice")),
    "image_numbers": (["image_dims"], _numbers("image_dims")),
    "item_numbers": (["item_dims"], _numbers("item_dims")),
    "collection": (["item_attributes", "items"], f"""select distinct oms_id from item_attributes
        where attribute_value in ({_text_list(Q.COLLECTION_VALUES)}) and oms_id in (select oms_id from items)"""),
    "style_rows": (["item_attributes"],
                   "select oms_id, attribute_value as style from item_attributes where attribute_id = 'a-style'"),
    "style_freq": (["style_rows"], "select style, count(*) as style_freq from style_rows group by style"),
    "top_style_rows": (["style_freq"], """select oms_id, style from style_rows where style in
        (select style from style_freq order by style_freq desc, style limit 10)"""),
}


def _side(part: int) -> str:
    s = f"string_split(product_name, 'x')[{part}]"
    take = lambda unit: f"coalesce(try_cast(nullif(regexp_extract({s}, '([0-9]+) {unit}', 1), '') as double), 0.0)"
    return f"({take('ft')} * 12 + {take('in')})"


_two = "len(string_split(product_name, 'x')) = 2"
V["rug_sizes"] = (["rugs"], f"""select omsid, product_name,
    case when {_two} then least({_side(1)}, {_side(2)}) end as width,
    case when {_two} then greatest({_side(1)}, {_side(2)}) end as height from rugs""")
V["rug_rows"] = (["rug_sizes", "item_attributes"], f"""select oms_id, product_name, thickness_1, thickness_2, image_guid,
    width as width_in, height as height_in, try_cast(thickness_2 as double) as depth_in
    from (select *, cast(omsid as varchar) as oms_id from rug_sizes) join {_attribute('a-thick1', 'thickness_1')}
    using (oms_id) join {_attribute('a-thick2', 'thickness_2')} using (oms_id)
    join {_attribute('a-image', 'image_guid')} using (oms_id)""")

ORACLES: dict[str, str] = {}


def add(name: str, views: str, body: str) -> None:
    ORACLES[name] = with_views(views, body, V)


_in_text = ", ".join(f"{r6(f'{n}_in')} as {n}_in, {_label(f'{n}_in', 2)} as {n}_text" for n in ("width", "height", "depth"))
add("dim_lookup", "image_numbers", f"select oms_id, width, height, depth, {_in_text} from image_numbers")
add("dimension_job", "image_numbers", """select oms_id, width_in as width, height_in as height, depth_in as depth,
    '2021-05-07' as day from image_numbers""")
add("dim_guids", "image_choice", "select * from image_choice")
add("pivot_dims", "item_dims", "select * from item_dims")
add("eav_product", "item_attributes", f"select * from {_product(Q.EAV_COLUMNS)}")
add("parse_dim", "item_attributes", f"""select oms_id, attribute_id, attribute_value,
    {_number('attribute_value', 0)} as whole, {_number('attribute_value', 1)} as tenths,
    {_number('attribute_value', 2)} as hundredths from item_attributes""")
_first = r"try_cast(regexp_extract(trim(attribute_value), '^\S*') as double)"
add("first_token_num", "item_attributes", f"""select oms_id, attribute_id, attribute_value, {r6(_first)} as number,
    case when {_first} is null then 'bad' else 'ok' end as status from item_attributes""")
add("label_text", "item_attributes", f"""select oms_id, attribute_id, attribute_value,
    {_label(_number('attribute_value', 0), 0)} as label_0, {_label(_number('attribute_value', 2), 2)} as label_2
    from item_attributes""")
ORACLES["feet_inches"] = f"select l_orderkey, l_extendedprice, {_feet('l_extendedprice')} as label from lineitem"
add("rug_size", "rug_sizes", f"""select omsid, product_name, {r6('width')} as width, {r6('height')} as height,
    case when width is null then 'bad' else 'ok' end as status from rug_sizes""")
add("rug_dims", "rug_rows", f"""select oms_id, product_name, thickness_1, thickness_2, image_guid,
    {r6('width_in')} as width_in, {r6('height_in')} as height_in, {r6('depth_in')} as depth_in from rug_rows""")
add("rug_labels", "rug_rows", f"""select oms_id, dim_name, {r6('number')} as number, case dim_name
    when 'height' then {_feet('number')} || ' L' when 'width' then {_feet('number')} || ' W'
    else {_label('number', 2)} || chr(10) || ' thickness' end as label
    from (select distinct oms_id, unnest(['height', 'width', 'depth']) as dim_name,
        unnest([height_in, width_in, depth_in]) as number from rug_rows)""")
add("image_guid", "image_urls", """select oms_id, image_url, split_part(image_url, '/', 5) as image_guid,
    nullif(split_part(image_url, '/', 9), '') as past_end from image_urls""")
add("image_name", "merged_images image_urls", r"""select oms_id, image, guid, ext, guid || ext as filename,
    'https://images.example.com/assets/image/' || left(guid || ext, 2) || '/' || guid || ext as url from (
        select *, case when contains(name, '.') then regexp_replace(name, '\.[^.]*$', '') else name end as guid,
            case when contains(name, '.') then regexp_extract(name, '\.[^.]*$') else '.jpg' end as ext
        from (select *, string_split(image, '/')[-1] as name from (
            select oms_id, image_guid as image from merged_images
            union all select cast(oms_id as varchar), image_url from image_urls)))""")
add("output_path", "style_rows items", """select oms_id, oms_id || ',' || style as title,
    'out/2001-08-20/output_images/' || product_type || '/' || oms_id || ',' || style || '.jpg' as path
    from style_rows join items using (oms_id)""")
add("bucket_blob", "feed_paths", """select path, case when path like 'gs://%' then split_part(path, '/', 3) end as bucket,
    case when path like 'gs://%' then substr(path, 12) end as blob from (
        select case when path like '%staging%' then path else 'gs://feeds/' || path end as path from feed_paths)""")
ORACLES["date_format"] = """select o_orderkey, strftime(o_orderdate, '%Y/%m/%d') as written,
    strftime(o_orderdate, '%Y-%m-%d') as dashed, cast(null as varchar) as not_a_day from orders"""
_days = r"try_cast(nullif(regexp_extract(path, '^feed/items/(\d{4}-\d{2}-\d{2})(/.*)?$', 1), '') as date)"
add("newest_snapshot", "feed_paths", f"""select 'none' as bound, strftime(max({_days}), '%Y-%m-%d') as newest
    from feed_paths union all select '1999-06-15', strftime(max({_days}) filter (where {_days} <= date '1999-06-15'),
    '%Y-%m-%d') from feed_paths""")
add("lookback_snapshot", "attribute_snapshots", """select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, oms_id,
    attribute_value from attribute_snapshots where snapshot_date = (select max(snapshot_date) from attribute_snapshots
    where snapshot_date between date '2001-08-20' - 30 and date '2001-08-20')""")
add("images_with_dims", "merged_images image_numbers", f"""select m.*, {r6('width_in')} as width,
    {r6('height_in')} as height, {r6('depth_in')} as depth from merged_images m
    join (select oms_id, width_in, height_in, depth_in from image_numbers) n using (oms_id)
    where image_type = 'FRONT'""")
add("lighting_items", "collection", "select * from collection")
V["chosen_values"] = (["collection", "item_attributes"],
                      "select v.* from item_attributes v semi join collection c on v.oms_id = c.oms_id")
_wanted = list(Q.COLLECTION_COLUMNS.items())
_wide = " ".join(
    f"join (select oms_id, attribute_value as {n} from chosen_values where attribute_id = '{a}') using (oms_id)" for n, a in _wanted)
add("collection_dims", "chosen_values attributes", f"""select oms_id, p.attribute_value as image_guid, {", ".join(n for n, _ in _wanted)}
    from (select oms_id, attribute_value from chosen_values semi join (
        select attribute_id from attributes where lower(displayname) = 'product image') using (attribute_id)) p {_wide}""")
_front = {"width": "a-width", "depth": "a-depth", "height": "a-height", "canopy": "a-canopy", "image_guid": "a-image"}
add("front_items", "items image_urls item_attributes top_style_rows", f"""select distinct oms_id, taxonomy, width, depth,
    height, canopy, image_guid, style, {r6("try_cast(canopy as double)")} as canopy_in
    from items join {_product(_front)} using (oms_id) join top_style_rows using (oms_id)
    where lower(taxonomy) like '%ring%' and lower(taxonomy) not like '%new%' and lower(taxonomy) not like '%old%'
    and oms_id in (select cast(oms_id as varchar) from image_urls where prediction_labels like '%front%')""")
add("attr_search", "item_attributes attributes", """select distinct attribute_id, displayname
    from item_attributes join attributes using (attribute_id)
    where lower(displayname) like '%canopy%' and lower(displayname) like '%in.%'""")
ORACLES["sql_collection"] = ORACLES["collection_dims"]
ORACLES["sql_attr_search"] = ORACLES["attr_search"]
add("sql_measures", "item_attributes", f"""select oms_id, attribute_id, attribute_value, {_number('attribute_value', 2)}
    as hundredths, {_first} as first_number, {_feet(_number('attribute_value', 2))} as feet
    from item_attributes""")
add("sql_rugs", "rug_sizes", f"""select omsid, product_name, {r6('width')} as width, {r6('height')} as height,
    {_label('width', 2)} as label from rug_sizes""")
add("style_counts", "style_freq", "select * from style_freq order by style_freq desc, style")
add("style_tags", "style_rows", """select tag, count(*) as tag_freq from
    (select unnest(string_split(style, ',')) as tag from style_rows) group by tag""")
add("top_styles", "top_style_rows", "select * from top_style_rows")
add("image_arrays", "merged_images", """select oms_id, cast(count(distinct image_guid) as int) as n,
    string_agg(distinct image_guid, '|' order by image_guid) as all_image_guids from merged_images group by oms_id""")
add("review_json", "merged_images image_dims", """select oms_id, to_json({
        'oms_id': oms_id, 'dimension_image_location': 'out/output_images/' || product_type || '/' || oms_id || '.jpg',
        'dimensions': {'width': width, 'height': height, 'depth': depth}, 'selected_img_guid': pick.g,
        'selected_img_type': pick.t, 'all_image_guids': guids})::varchar as record
    from (select oms_id, product_type, min({'t': image_type, 'g': image_guid}) as pick,
        list_sort(list(distinct image_guid)) as guids from merged_images group by oms_id, product_type)
    join image_dims using (oms_id)""")
add("missing_images", "merged_images stored_images", r"""select distinct image_guid from merged_images
    where image_guid not in (select regexp_extract(path, '([^/]+)\.jpg$', 1) from stored_images where length > 0)""")
add("renditions", "items", """select oms_id, cast(size as int) as size, oms_id || '_' || size || '.jpg' as sized_name,
    'out/output_images/' || oms_id || '_' || size || '.jpg' as path
    from (select oms_id, unnest([100, 400, 1000]) as size from items)""")
ORACLES["debug_manifest"] = """select oms_id, cast(step as int) as step, oms_id || '_' || step || '.jpg' as filename from
    (select cast(p_partkey as varchar) as oms_id, unnest(range(0, p_size - 5)) as step from part)"""
add("view_choice", "view_labels view_candidates", """select product_type, oms_id, image_guid, image_view from (
    select l.product_type, oms_id, image_guid, image_view,
        row_number() over (partition by oms_id, image_view order by score desc, image_guid) as n
    from view_labels l join view_candidates c using (oms_id, image_view)) where n = 1""")
add("nth_row", "image_urls", """select cast(n as int) as position, oms_id, image_url,
    case when n = 6 then 'yes' else 'no' end as chosen from
    (select *, row_number() over (order by oms_id, image_url) as n from image_urls) where n <= 100""")

# --- pixels -------------------------------------------------------------------------------

_lum = "(r * 2125 + g * 7154 + b * 721)"
_grey = "((r * {} + g * 9617 + b * {} + 8192) // 16384)"


def _mirror(value: str, by: str, along: str) -> str:
    w = f"(partition by image_id, {by} order by {along})"
    back, ahead = f"lag({value}) over {w}", f"lead({value}) over {w}"
    return f"(2 * {value} + coalesce({back}, {ahead}) + coalesce({ahead}, {back}))"


def _component_views(p: str, mask: str, source: list[str], key: str = "image_id") -> None:
    """<p>_lab: runs with the label of their component; <p>_area: its area and first row."""
    V[f"{p}_mask"] = (source, mask)
    V[f"{p}_runs"] = ([f"{p}_mask"], f"""select {key}, y, min(x) as x0, max(x) as x1,
        cast(y as bigint) * 4294967296 + min(x) as node from (
            select *, x - row_number() over (partition by {key}, y order by x) as island from {p}_mask)
        group by {key}, y, island""")
    V[f"{p}_edge"] = ([f"{p}_runs"], f"""select u.{key}, u.node as a, w.node as b from {p}_runs u join {p}_runs w
        on u.{key} = w.{key} and w.y = u.y + 1 and u.x0 <= w.x1 and w.x0 <= u.x1""")
    V[f"{p}_both"] = ([f"{p}_edge"], f"select {key}, a, b from {p}_edge union all select {key}, b, a from {p}_edge")
    V[f"{p}_reach"] = ([f"{p}_both"], f"""select {key}, node, node as label from {p}_runs union
        select t.{key}, e.b, t.label from {p}_reach t join {p}_both e on e.{key} = t.{key} and e.a = t.node""")
    V[f"{p}_lab"] = ([f"{p}_reach"], f"""select u.{key}, u.y, u.x0, u.x1, m.label from {p}_runs u join
        (select {key}, node, min(label) as label from {p}_reach group by {key}, node) m using ({key}, node)""")
    V[f"{p}_area"] = ([f"{p}_lab"], f"""select {key}, label, cast(sum(x1 - x0 + 1) as bigint) as area,
        min(y) as top from {p}_lab group by {key}, label""")


V["smooth"] = (["pixels"], f"""select image_id, x, y, ({_mirror('v', 'y', 'x')} + 8) // 16 as level from (
    select image_id, x, y, {_mirror('v', 'x', 'y')} as v from (
        select image_id, x, y, {_grey.format(1868, 4899)} as v from pixels))""")
_component_views("lum", f"select image_id, x, y from pixels where {_lum} <= 95 * 25500", ["pixels"])
_component_views("con", "select image_id, x, y from smooth where level <= 220", ["smooth"])
_component_views("cut", f"""select image_id * 1000 + c as kid, x, y from pixels
    join (select unnest(range(95, 100)) as c) on {_lum} <= c * 25500""", ["pixels"], "kid")

add("grey_mask", "pixels", f"""select image_id, x, y, cast({_lum} as bigint) as luminance,
    cast({_grey.format(4899, 1868)} as int) as grey, cast({_grey.format(1868, 4899)} as int) as grey_swapped from pixels""")
add("smoothed_mask", "smooth", """select image_id, x, y, cast(level as int) as level,
    case when level <= 220 then 1 else 0 end as foreground from smooth""")
_share = Q.SPECK_SHARE
add("components", "lum_area", f"select image_id, label, area, top from lum_area where area > 24 * 20 * {_share}")
add("large_components", "lum_area", """select image_id, label, area, largest from (
    select *, max(area) over (partition by image_id) as largest from lum_area) where area >= largest * 0.15""")
V["cut_kept"] = (["cut_area"], f"select * from cut_area where area > 24 * 20 * {_share}")
V["cut_choice"] = (["cut_kept", "pixels"], """select p.image_id, coalesce(min(c), 100) as cutoff from
    (select distinct image_id from pixels) p left join (select kid // 1000 as image_id, kid % 1000 as c
    from cut_kept group by kid having sum(area) > 48.0) k using (image_id) group by p.image_id""")
V["cut_parts"] = (["cut_choice"], """select h.image_id, h.cutoff, k.label, k.area
    from cut_choice h join cut_kept k on k.kid = h.image_id * 1000 + h.cutoff
    union all select image_id, cutoff, 0, 480 from cut_choice where cutoff = 100""")
add("adaptive_mask", "cut_parts", """select image_id, cast(cutoff as int) as cutoff, count(*) as parts,
    cast(sum(area) as bigint) as area from cut_parts group by image_id, cutoff""")
V["cut_boxes"] = (["cut_parts"], """select p.image_id, p.area, min(x0) as min_x, max(x1) as max_x, min(y) as min_y,
    max(y) as max_y from cut_parts p join cut_lab l on l.kid = p.image_id * 1000 + p.cutoff and l.label = p.label
    group by p.image_id, p.area, p.label
    union all select image_id, area, 0, 23, 0, 19 from cut_parts where cutoff = 100""")
_big = "filter (where area >= largest * 0.15)"
add("bounding_boxes", "cut_boxes", f"""select image_id,
    cast(min(min_x) {_big} as int) as min_x, cast(max(max_x) {_big} as int) as max_x,
    cast(min(min_y) {_big} as int) as min_y, cast(max(max_y) {_big} as int) as max_y,
    cast(min(min_x) as int) as min_x_bb, cast(max(max_x) as int) as max_x_bb,
    cast(min(min_y) as int) as min_y_bb, cast(max(max_y) as int) as max_y_bb from (
    select *, max(area) over (partition by image_id) as largest from cut_boxes) group by image_id""")
V["con_best"] = (["con_area"], """select image_id, label, top from (select *,
    row_number() over (partition by image_id order by area desc, label) as n from con_area) where n = 1""")
add("cropped_check", "con_best", """select image_id, cast(top as int) as top,
    case when top <= 5 then 'cropped' else 'whole' end as verdict from con_best""")
V["shape"] = (["con_best"], """select image_id, l.y, l.x0, l.x1 from con_lab l join con_best b using (image_id, label)""")
V["shape_row"] = (["shape"], "select image_id, y, min(x0) as x0, max(x1) as x1 from shape group by image_id, y")
V["shape_end"] = (["shape_row"], """select image_id, cast(x0 as bigint) as x, cast(y as bigint) as y from shape_row
    union select image_id, x1, y from shape_row""")


def _extreme(name: str, order: str) -> str:
    return (f"first(x order by {order}) as {name}_x, first(y order by {order}) as {name}_y")


V["extreme"] = (["shape_end"], f"""select image_id, {_extreme('left', 'x, y')}, {_extreme('right', 'x desc, y')},
    {_extreme('top', 'y, x')}, {_extreme('bottom', 'y desc, x')} from shape_end group by image_id""")
_extreme_cols = ", ".join(f"cast({s}_{k} as int) as {s}_{k}" for s in ("left", "right", "top", "bottom") for k in "xy")
add("extreme_points", "extreme", f"select image_id, {_extreme_cols} from extreme")
_cross = "(q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x)"
_dot = "(q.x - p.x) * (r.x - p.x) + (q.y - p.y) * (r.y - p.y)"
_len = "(q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y)"
V["hull_edge"] = (["shape_end"], f"""select p.image_id, p.x as px, p.y as py, q.x as qx, q.y as qy
    from shape_end p join shape_end q on p.image_id = q.image_id and (p.x <> q.x or p.y <> q.y)
    join shape_end r on r.image_id = p.image_id group by all
    having bool_and({_cross} > 0 or ({_cross} = 0 and {_dot} between 0 and {_len}))""")
V["hull_pos"] = (["hull_edge", "extreme"], """select image_id, 0 as pos, top_x as x, top_y as y from extreme
    union all select h.image_id, h.pos + 1, e.qx, e.qy from hull_pos h join hull_edge e
        on e.image_id = h.image_id and e.px = h.x and e.py = h.y
        join extreme t on t.image_id = h.image_id where e.qx <> t.top_x or e.qy <> t.top_y""")
add("hull", "hull_pos", "select image_id, cast(pos as int) as pos, x, y from hull_pos")
V["hull_n"] = (["hull_pos"], "select *, count(*) over (partition by image_id) as n from hull_pos")
_d2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"
V["gap_fw"] = (["hull_n"], f"""select a.image_id, min(a.pos) as k from hull_n a join hull_n b
    on a.image_id = b.image_id and b.pos = a.pos - 1
    where a.pos < least(a.n, {REACH}) and {_d2} >= {GAP * GAP} group by a.image_id""")
V["gap_bw"] = (["hull_n"], f"""select a.image_id, min(a.n - a.pos) as j from hull_n a join hull_n b
    on a.image_id = b.image_id and b.pos = (a.pos + 1) % a.n
    where a.n - a.pos <= least(a.n, {REACH}) and {_d2} >= {GAP * GAP} group by a.image_id""")
V["canopy"] = (["gap_fw", "gap_bw", "extreme"], f"""select t.image_id, top_x, top_y,
    case when back or g.j is null then trunc(left_x * 5.0 / 8 + right_x * 3.0 / 8) else pl.x end as lx,
    case when back or g.j is null then trunc(top_y * 0.67::double) else pl.y end as ly,
    case when stuck or back or f.k is null then trunc(left_x * 3.0 / 8 + right_x * 5.0 / 8) else pr.x end as rx,
    case when stuck or back or f.k is null then trunc(top_y * 0.67::double) else pr.y end as ry
    from (select e.*, h.n, coalesce(f.k = 1, h.n = 1) as stuck, coalesce(g.j = 1, h.n <= {REACH}) as back
        from extreme e join hull_n h on h.image_id = e.image_id and h.pos = 0
        left join gap_fw f on f.image_id = e.image_id left join gap_bw g on g.image_id = e.image_id) t
    left join gap_fw f on f.image_id = t.image_id left join gap_bw g on g.image_id = t.image_id
    left join hull_n pr on pr.image_id = t.image_id and pr.pos = f.k - 1
    left join hull_n pl on pl.image_id = t.image_id and pl.pos = (t.n - g.j + 1) % t.n""")
V["canopy_low"] = (["canopy"], """select *, case when (ly + ry) * 0.5 >= top_y then top_y else ly end as line_y1,
    case when (ly + ry) * 0.5 >= top_y then top_y else ry end as line_y2 from canopy""")
add("canopy_ends", "canopy_low", """select image_id, top_x, top_y, cast(lx as bigint) as canopy_left_x,
    cast(ly as bigint) as canopy_left_y, cast(rx as bigint) as canopy_right_x, cast(ry as bigint) as canopy_right_y,
    cast(line_y1 as bigint) as line_y1, cast(line_y2 as bigint) as line_y2 from canopy_low""")

# --- layout -------------------------------------------------------------------------------

_glyphs = Glyphs()
_GLYPH_MAP = "map([{}], [{}])".format(
    ", ".join("'" + g.replace("'", "''") + "'" for g in _glyphs.widths), ", ".join(map(str, _glyphs.widths.values()))
)


def _text_w(text: str, size: str) -> str:
    chars = f"list_transform(string_split(line, ''), lambda ch: coalesce({_GLYPH_MAP}[ch], {_glyphs.other}))"
    widths = f"list_transform(string_split({text}, chr(10)), lambda line: coalesce(list_sum({chars}), 0))"
    return f"(list_max({widths}) * {size} / 1000.0::double)"


def _text_h(text: str, size: str) -> str:
    return f"(len(string_split({text}, chr(10))) * {_glyphs.line_height} * {size} / 1000.0::double)"


def _place(rows: str, box: float = CONFIG.text_box) -> str:
    """rows(.., x1, y1, x2, y2, ax, ay, tw, th, lm) -> the same with px1 .. py2, bx1 .. by2 of the moved line."""
    return f"""select *, x1 + sx as px1, y1 + sy as py1, x2 + sx as px2, y2 + sy as py2,
            (x1 + x2) / 2 + sx - bw / 2 as bx1, (y1 + y2) / 2 + sy - bh / 2 as by1,
            (x1 + x2) / 2 + sx + bw / 2 as bx2, (y1 + y2) / 2 + sy + bh / 2 as by2 from (
        select *, nx / len * turn * margin as sx, ny / len * turn * margin as sy from (
            select *, case when (ax - (x1 + x2) / 2) * nx + (ay - (y1 + y2) / 2) * ny > 0 then -1.0::double
                else 1.0::double end as turn, greatest(sqrt(bw * bw + bh * bh) * {box}::double / 2, lm) as margin,
                nullif(sqrt(nx * nx + ny * ny), 0) as len from (
                select *, y1 - y2 as nx, x2 - x1 as ny, tw * {box}::double as bw, th * {box}::double as bh from {rows})))"""


_b = "cast(trunc(greatest(img_w, img_h) * 0.15::double) as bigint)"
_corner_names = [f"{m}_{a}{s}" for s in ("", "_bb") for a in "xy" for m in ("min", "max")]


def _spec_views(boxes: str, bordered: str) -> tuple[tuple[list[str], str], tuple[list[str], str]]:
    """Boxes with a border, and everything moved into it, with the line sizes."""
    return ([boxes], f"""select *, img_w + 2 * border as bordered_w, img_h + 2 * border as bordered_h
        from (select *, {_b} as border from {boxes})"""), ([bordered], f"""select oms_id, product_type, border, bordered_w, bordered_h,
        {', '.join(f'{n} + border as {n}' for n in _corner_names)},
        cast(trunc(0.05::double * greatest(bordered_w, bordered_h)) as bigint) as line_margin,
        cast(trunc(0.005::double * greatest(bordered_w, bordered_h)) as bigint) as line_width,
        cast(trunc(0.04::double * greatest(img_w, img_h)) as bigint) as font_size from {bordered}""")


V["bordered"], V["specs"] = _spec_views("boxes", "bordered")
_tan = abs(math.tan(135 * math.pi / 180))


def _front_rows(rug: bool, specs: str = "specs") -> str:
    low, up = ("min_y * {0}::double + max_y * {1}::double".format(s, 1.0 - s) for s in (0.1, 0.3))
    depth = f"select *, min_x_bb as x1, {low} as y1, min_x_bb - (({low}) - ({up})) / {_tan!r}::double as x2, {up} as y2"
    if rug:
        half, y = f"(max_x - min_x) * {0.5 * 0.2!r}::double", "min_y * 0.4::double + max_y * 0.6::double"
        depth = f"select *, min_x_bb + {half} as x1, {y} as y1, min_x_bb - {half} as x2, {y} as y2"
    parts = {
        "height": "select *, max_x_bb as x1, max_y as y1, max_x_bb as x2, min_y as y2",
        "width": "select *, min_x as x1, max_y_bb as y1, max_x as x2, max_y_bb as y2",
        "depth": depth,
    }
    cols = "cast(x1 as double) as x1, cast(y1 as double) as y1, cast(x2 as double) as x2, cast(y2 as double) as y2"
    keep = "oms_id, product_type, border, bordered_w, bordered_h, line_margin, line_width, font_size"
    return " union all ".join(
        f"""select {keep}, '{n}' as dim_name, {cols}, (min_x + max_x) / 2.0::double as center_x,
        (min_y + max_y) / 2.0::double as center_y from ({p} from {specs})""" for n, p in parts.items()
    )


V["front"] = (["specs"], _front_rows(False))
V["front_rug"] = (["specs"], _front_rows(True))
_xy = ", ".join(f"{r6(k)} as {k}" for k in ("x1", "y1", "x2", "y2", "center_x", "center_y"))
add("border_boxes", "bordered", """select oms_id, img_w, img_h, border, bordered_w, bordered_h,
    min_x + border as min_x, max_y + border as max_y from bordered""")
add("line_specs", "specs", "select oms_id, line_margin, line_width, font_size from specs")
add("front_layout", "front", f"select oms_id, dim_name, {_xy} from front")
add("rug_layout", "front_rug", f"select oms_id, dim_name, {_xy} from front_rug")


def _length(n: str) -> str:
    return (f"sqrt(max((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) filter (where dim_name = '{n}'))")


_measured = f"({_length('height')} / nullif({_length('width')}, 0))"
V["swap"] = (["front", "item_numbers"], f"""select oms_id, coalesce(abs(m - depth_in / nullif(width_in, 0))
        / nullif(depth_in / nullif(width_in, 0), 0) <= abs(m - height_in / nullif(width_in, 0))
        / nullif(height_in / nullif(width_in, 0), 0) * 0.6::double, false) as fits, product_type
    from (select oms_id, product_type, {_measured} as m from front group by oms_id, product_type)
    join item_numbers using (oms_id)""")
_types = _text_list(CONFIG.swap_types)
add("swap_check", "swap", f"""select oms_id, product_type, case when fits then 'yes' else 'no' end as fits_better,
    case when fits and product_type in ({_types}) then 'yes' else 'no' end as swapped from swap""")
V["place_in"] = (["front"], """select *, center_x as ax, center_y as ay, font_size * 2.5::double as tw,
    font_size * 1.15::double as th, line_margin as lm from front""")
V["placed"] = (["place_in"], _place("place_in"))
_placed_cols = ", ".join(f"{r6('p' + k)} as {k}" for k in ("x1", "y1", "x2", "y2")) + ", " + ", ".join(
    f"{r6(k)} as {k}" for k in ("bx1", "by1", "bx2", "by2"))
add("label_place", "placed", f"select oms_id, dim_name, {_placed_cols} from placed")


def _texts(rug: bool) -> str:
    h, w, dd = (_label(f"{n}_in", 2) for n in ORDER)
    if rug:
        h, w, dd = f"{_feet('height_in')} || ' L'", f"{_feet('width_in')} || ' W'", f"{dd} || chr(10) || ' thickness'"
    return " union all ".join(
        f"select oms_id, '{n}' as dim_name, {t} as label from item_numbers" for n, t in zip(ORDER, (h, w, dd)))


V["texts"] = (["item_numbers"], _texts(False))
V["texts_rug"] = (["item_numbers"], _texts(True))


def _grown_views(p: str, placed: str, names: list[str], key: str, canvas: tuple[str, str]) -> None:
    """<p>_grown: one row per key with the final canvas and <name>_left / <name>_top shifts."""
    wide = ", ".join(
        f"max(least(px1, px2, bx1, bx2)) filter (where dim_name = '{n}') as {n}_x0, "
        f"max(greatest(px1, px2, bx1, bx2)) filter (where dim_name = '{n}') as {n}_x9, "
        f"max(least(py1, py2, by1, by2)) filter (where dim_name = '{n}') as {n}_y0, "
        f"max(greatest(py1, py2, by1, by2)) filter (where dim_name = '{n}') as {n}_y9" for n in names)
    sql = f"""select {key}, cast({canvas[0]} as bigint) as cw, cast({canvas[1]} as bigint) as ch, 0::bigint as al,
        0::bigint as adt, {wide} from {placed} group by {key}, {canvas[0]}, {canvas[1]}"""
    for n in names:
        for axis, size, shift, out in (("x", "cw", "al", "left"), ("y", "ch", "adt", "top")):
            sql = f"""select * exclude (fresh), {shift} as {n}_{out} from (
                select * replace ({size} + fresh + case when {n}_{axis}9 + {shift} + fresh + 25 > {size} + fresh - 1
                    then cast(ceil({n}_{axis}9 + {shift} + fresh + 25 - ({size} + fresh) + 1) as bigint)
                    else 0 end as {size}, {shift} + fresh as {shift})
                from (select *, case when {n}_{axis}0 + {shift} < 25
                    then cast(ceil(25 - ({n}_{axis}0 + {shift})) as bigint) else 0 end as fresh from ({sql})))"""
    V[f"{p}_grown"] = ([placed], sql)


def _annotated_views(p: str, front: str, texts: str) -> None:
    V[f"{p}_in"] = ([front, texts], f"""select f.*, t.label, center_x as ax, center_y as ay,
        {_text_w('t.label', 'font_size')} as tw, {_text_h('t.label', 'font_size')} as th, line_margin as lm
        from {front} f left join {texts} t using (oms_id, dim_name)""")
    V[f"{p}_placed"] = ([f"{p}_in"], _place(f"{p}_in"))
    _grown_views(p, f"{p}_placed", ORDER, "oms_id", ("bordered_w", "bordered_h"))
    moved = ", ".join(
        f"{k} + case dim_name " + " ".join(f"when '{n}' then {n}_{s}" for n in ORDER) + f" end as m{k}"
        for k, s in [("px1", "left"), ("py1", "top"), ("px2", "left"), ("py2", "top"),
                     ("bx1", "left"), ("by1", "top"), ("bx2", "left"), ("by2", "top")])
    V[f"{p}_moved"] = ([f"{p}_grown"], f"select p.*, cw, ch, {moved} from {p}_placed p join {p}_grown using (oms_id)")


_annotated_views("plain", "front", "texts")
_annotated_views("rug", "front_rug", "texts_rug")
_shift_cols = ", ".join(f"{n}_{k} as {n}_label_{k}" for n in ORDER for k in ("left", "top"))
add("extra_border", "plain_grown", f"select oms_id, cw as canvas_w, ch as canvas_h, {_shift_cols} from plain_grown")
_half = "0.05::double * case when vertical then dy when dim_name = 'depth' then dx * 2 else dx end"
add("end_caps", "rug_moved", f"""select oms_id, dim_name, cast(cap as int) as cap,
    {r6('case when vertical then x - half else x end')} as x1, {r6('case when vertical then y else y - half end')} as y1,
    {r6('case when vertical then x + half else x end')} as x2, {r6('case when vertical then y else y + half end')} as y2
    from (select *, {_half} as half, unnest([0, 1]) as cap, unnest([mpx1, mpx2]) as x, unnest([mpy1, mpy2]) as y
        from (select *, dx / ((mpx1 + mpx2) * 0.5) < dy / ((mpy1 + mpy2) * 0.5) as vertical
            from (select *, abs(mpx1 - mpx2) as dx, abs(mpy1 - mpy2) as dy from rug_moved)))""")
add("depth_text", "plain_moved", f"""select oms_id, label as depth_text,
    {r6('least(mpx1, mpx2) * 0.4::double')} as x,
    {r6('(mpy1 + mpy2) * 0.5 + abs(mpx1 - mpx2) * 0.1::double')} as y from plain_moved where dim_name = 'depth'""")
_anchor_x = """case x_align when 'center' then min_x - 45.0::double when 'right' then min_x - 90.0::double
    when 'left' then cast(min_x as double) end"""
_anchor_y = """case y_align when 'center' then min_y - 15.5::double when 'bottom' then min_y - 31.0::double
    when 'top' then cast(min_y as double) end"""
add("text_anchor", "boxes", f"""select oms_id, x_align, y_align, {r6(f"case when x_align <> 'middle' then {_anchor_x} end")} as x,
    {r6(f"case when x_align <> 'middle' then {_anchor_y} end")} as y,
    case when x_align = 'middle' then 'bad' else 'ok' end as status from (select *,
        ['center', 'right', 'left', 'middle'][img_w % 4 + 1] as x_align,
        ['center', 'bottom', 'top'][img_h % 3 + 1] as y_align from boxes)""")
add("text_size", "texts_rug specs", f"""select oms_id, dim_name, label, {r6(_text_w('label', 'font_size'))} as text_w,
    {r6(_text_h('label', 'font_size'))} as text_h from texts_rug join (select oms_id, font_size from specs) using (oms_id)""")

V["canopy_place"] = (["canopy_low"], f"""select image_id, 'at' as dim_name, cast(lx as double) as x1,
    cast(line_y1 as double) as y1, cast(rx as double) as x2, cast(line_y2 as double) as y2, 12.0::double as ax,
    30.0::double as ay, 24 as canvas_w, 20 as canvas_h, label, {_text_w('label', 'font_size')} as tw,
    {_text_h('label', 'font_size')} as th, lm, font_size from (select *, {_label('(p_size % 6 + 0.25::double)', 2)} as label,
        cast(trunc(0.04::double * 24) as bigint) as font_size, cast(trunc(0.05::double * 24) as bigint) as lm
        from canopy_low join part on p_partkey = image_id)""")
V["canopy_placed"] = (["canopy_place"], _place("canopy_place"))
_grown_views("canopy", "canopy_placed", ["at"], "image_id", ("canvas_w", "canvas_h"))
add("canopy_label", "canopy_grown", f"""select image_id, label, cast(trunc(trunc(0.005::double * 24) * 1.5) as bigint)
    as line_width, cw as canvas_w, ch as canvas_h, {', '.join(f"{r6('p' + k)} as {k}" for k in ("x1", "y1", "x2", "y2"))},
    at_left, at_top from canopy_placed join canopy_grown using (image_id)""")

# --- segments -----------------------------------------------------------------------------

_PAR = "least(abs({0} - {1}), abs({0} - {1} + pi()), abs({0} - {1} - pi())) < 8 * pi() / 180"


def _side_of(line: str, x: str, y: str) -> str:
    i = line
    return (f"((({i}.x2 - {i}.x1) * ({y} - {i}.y1) - ({i}.y2 - {i}.y1) * ({x} - {i}.x1)) / sqrt(({i}.x2 - {i}.x1) * "
            f"({i}.x2 - {i}.x1) + ({i}.y2 - {i}.y1) * ({i}.y2 - {i}.y1)))")


def _line_gap(line: str, seg: str) -> str:
    a, b = _side_of(line, f"{seg}.x1", f"{seg}.y1"), _side_of(line, f"{seg}.x2", f"{seg}.y2")
    return f"case when {a} * {b} <= 0 then 0 else greatest(abs({a}), abs({b})) end"


def _edge_views(p: str, source: str) -> None:
    """<p>_edges: image_id, edge_id, ex1 .. ey2, length, theta and the end segments s1*, s2*."""
    V[f"{p}_seg"] = ([source], f"select *, atan2(y2 - y1, x2 - x1) as theta from {source}")
    V[f"{p}_sim"] = ([f"{p}_seg"], f"""select i.image_id, i.seg_id as seg_i, j.seg_id as seg_j
        from {p}_seg i join {p}_seg j on i.image_id = j.image_id and i.seg_id > j.seg_id
        where {_PAR.format('i.theta', 'j.theta')} and greatest({_line_gap('i', 'j')}, {_line_gap('j', 'i')}) < 30""")
    V[f"{p}_par"] = ([f"{p}_sim"], f"""select image_id, seg_id, (select min(seg_j) from {p}_sim m
        where m.image_id = s.image_id and m.seg_i = s.seg_id) as parent from {p}_seg s""")
    V[f"{p}_grp"] = ([f"{p}_par"], f"""select image_id, seg_id, seg_id as edge_id from {p}_par where parent is null
        union all select c.image_id, c.seg_id, g.edge_id from {p}_par c join {p}_grp g
            on g.image_id = c.image_id and g.seg_id = c.parent""")
    V[f"{p}_mem"] = ([f"{p}_grp"], f"""select s.*, edge_id, avg(x1) over w as mx, avg(y1) over w as my
        from {p}_seg s join {p}_grp using (image_id, seg_id) window w as (partition by image_id, edge_id)""")
    V[f"{p}_end"] = ([f"{p}_mem"], f"""select *, unnest([1, 2]) as side, unnest([x1, x2]) as x, unnest([y1, y2]) as y
        from {p}_mem""")
    far = "row_number() over (partition by image_id, edge_id order by (x - {0}) * (x - {0}) + (y - {1}) * (y - {1}) desc, seg_id, side)"
    V[f"{p}_e1"] = ([f"{p}_end"], f"select * from (select *, {far.format('mx', 'my')} as n from {p}_end) where n = 1")
    V[f"{p}_e2"] = ([f"{p}_e1"], f"""select * from (select *, {far.format('hx', 'hy')} as n from (
        select e.*, (o.x + e.mx) / 2 as hx, (o.y + e.my) / 2 as hy from {p}_end e join {p}_e1 o
        using (image_id, edge_id))) where n = 1""")
    V[f"{p}_edges"] = ([f"{p}_e2"], f"""select image_id, edge_id, a.x as ex1, a.y as ey1, b.x as ex2, b.y as ey2,
        sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) as length, atan2(b.y - a.y, b.x - a.x) as theta,
        a.x1 as s1x1, a.y1 as s1y1, a.x2 as s1x2, a.y2 as s1y2, b.x1 as s2x1, b.y1 as s2y1, b.x2 as s2x2, b.y2 as s2y2
        from {p}_e1 a join {p}_e2 b using (image_id, edge_id)""")


def _ring_views(p: str) -> None:
    """<p>_ring: image_id, pos, edge_id, entry; <p>_kept: after the tail and corner steps are dropped."""
    V[f"{p}_walk"] = ([f"{p}_edges"], f"""select image_id, 0 as pos, edge_id, 1 as entry, [edge_id] as used,
            ex2 as x, ey2 as y from (select *, row_number() over (partition by image_id order by
            (ex2 - ex1) * (ex2 - ex1) + (ey2 - ey1) * (ey2 - ey1) desc, edge_id) as n from {p}_edges) where n = 1
        union all select image_id, pos + 1, pick.edge_id, pick.entry, list_append(used, pick.edge_id), pick.x, pick.y
        from (select w.image_id, w.pos, w.used, min({{'d2': (o.ix - w.x) * (o.ix - w.x) + (o.iy - w.y) * (o.iy - w.y),
                'edge_id': o.edge_id, 'entry': o.entry, 'x': o.ox, 'y': o.oy}}) as pick
            from {p}_walk w join {p}_ways o on o.image_id = w.image_id and not list_contains(w.used, o.edge_id)
            group by w.image_id, w.pos, w.used)""")
    V[f"{p}_ways"] = ([f"{p}_edges"], f"""select image_id, edge_id, unnest([1, 2]) as entry, unnest([ex1, ex2]) as ix,
        unnest([ey1, ey2]) as iy, unnest([ex2, ex1]) as ox, unnest([ey2, ey1]) as oy from {p}_edges""")
    V[f"{p}_walk"] = ([f"{p}_ways"], V[f"{p}_walk"][1])
    V[f"{p}_ring"] = ([f"{p}_walk"], f"select image_id, pos, edge_id, entry, x, y from {p}_walk")
    start = "select o.image_id, o.ix as sx, o.iy as sy from {0}_ring g join {0}_ways o using (image_id, edge_id, entry) where g.pos = 0"
    V[f"{p}_tail"] = ([f"{p}_ring"], f"""select image_id, first(pos order by (x - sx) * (x - sx) + (y - sy) * (y - sy),
        pos desc) as last from {p}_ring join ({start.format(p)}) using (image_id) group by image_id""")
    V[f"{p}_r0"] = ([f"{p}_tail"], f"""select g.image_id, g.pos, g.edge_id, g.entry, e.theta, e.length,
        count(*) over (partition by g.image_id) as n from {p}_ring g join {p}_tail t using (image_id)
        join {p}_edges e using (image_id, edge_id) where g.pos <= t.last""")
    step = lambda t, k: f"join {t} b{k} on b{k}.image_id = b0.image_id and b{k}.pos = (b0.pos + {k}) % b0.n"
    par = lambda i, j: _PAR.format(f"b{i}.theta", f"b{j}.theta")
    V[f"{p}_m4"] = ([f"{p}_r0"], f"""select b0.image_id, unnest([b1.pos, b2.pos]) as pos from {p}_r0 b0
        {step(p + '_r0', 1)} {step(p + '_r0', 2)} {step(p + '_r0', 3)} where {par(0, 2)} and {par(1, 3)}
        and 0.25 * b0.length > b2.length and 0.25 * b3.length > b1.length""")
    again = """select image_id, row_number() over (partition by image_id order by pos) - 1 as pos, edge_id, entry, theta,
        length, count(*) over (partition by image_id) as n from {0} r where not exists
        (select 1 from {1} m where m.image_id = r.image_id and m.pos = r.pos)"""
    V[f"{p}_r1"] = ([f"{p}_m4"], again.format(f"{p}_r0", f"{p}_m4"))
    V[f"{p}_m3"] = ([f"{p}_r1"], f"""select b0.image_id, b1.pos from {p}_r1 b0 {step(p + '_r1', 1)} {step(p + '_r1', 2)}
        where ({par(0, 1)} and 0.25 * b0.length > b1.length) or ({par(2, 1)} and 0.25 * b2.length > b1.length)""")
    V[f"{p}_kept"] = ([f"{p}_m3"], again.format(f"{p}_r1", f"{p}_m3"))


def _corner_views(p: str, edges: str, size: int) -> None:
    """<p>_match: greedy pairs of ends; <p>_corner: with their crossing points."""
    V[f"{p}_tip"] = ([edges], f"""select image_id, edge_id, unnest([1, 2]) as side, unnest([ex1, ex2]) as x,
        unnest([ey1, ey2]) as y, unnest([s1x1, s2x1]) as sx1, unnest([s1y1, s2y1]) as sy1,
        unnest([s1x2, s2x2]) as sx2, unnest([s1y2, s2y2]) as sy2 from {edges}""")
    V[f"{p}_opt"] = ([f"{p}_tip"], f"""select a.image_id, {{'d2': {_d2}, 'edge_i': a.edge_id, 'edge_j': b.edge_id,
        'side_i': a.side, 'side_j': b.side}} as pair, a.edge_id * 2 + a.side as ka, b.edge_id * 2 + b.side as kb
        from {p}_tip a join {p}_tip b on a.image_id = b.image_id and a.edge_id > b.edge_id""")
    V[f"{p}_greedy"] = ([f"{p}_opt"], f"""select image_id, cast([] as bigint[]) as used,
            {{'d2': 0::double, 'edge_i': 0::bigint, 'edge_j': 0::bigint, 'side_i': 0, 'side_j': 0}} as pair, 0 as step
            from (select distinct image_id from {p}_opt)
        union all select image_id, list_concat(used, [pick.edge_i * 2 + pick.side_i, pick.edge_j * 2 + pick.side_j]),
            pick, step + 1 from (select g.image_id, g.used, g.step, min(o.pair) as pick from {p}_greedy g
                join {p}_opt o on o.image_id = g.image_id and not list_contains(g.used, o.ka)
                    and not list_contains(g.used, o.kb) group by g.image_id, g.used, g.step)""")
    V[f"{p}_match"] = ([f"{p}_greedy"], f"""select image_id, pair.edge_i as edge_i, pair.side_i as side_i,
        pair.edge_j as edge_j, pair.side_j as side_j, pair.d2 as d2 from {p}_greedy where step > 0""")
    pad = size * 0.05
    V[f"{p}_corner"] = ([f"{p}_match"], f"""select image_id, edge_i * 2 + side_i - 1 as corner_id, edge_i, side_i, edge_j,
            side_j, case when inside then cx else mx end as x, case when inside then cy else my end as y from (
        select *, coalesce(cx >= -{pad} and cx < {size + pad} and cy >= -{pad} and cy < {size + pad}, false) as inside
        from (select *, s.sx1 + t * (s.sx2 - s.sx1) as cx, s.sy1 + t * (s.sy2 - s.sy1) as cy from (
            select m.*, i as s, (i.x + j.x) / 2 as mx, (i.y + j.y) / 2 as my,
                ((j.sx1 - i.sx1) * (j.sy2 - j.sy1) - (j.sy1 - i.sy1) * (j.sx2 - j.sx1)) / nullif(
                (i.sx2 - i.sx1) * (j.sy2 - j.sy1) - (i.sy2 - i.sy1) * (j.sx2 - j.sx1), 0) as t
            from {p}_match m join {p}_tip i on i.image_id = m.image_id and i.edge_id = m.edge_i and i.side = m.side_i
            join {p}_tip j on j.image_id = m.image_id and j.edge_id = m.edge_j and j.side = m.side_j)))""")


_edge_views("s", "segments")
_ring_views("s")
_corner_views("s", "s_edges", 500)
_edge_views("o", "outline_segments")
_ring_views("o")
V["o_left"] = (["o_kept"], "select e.* from o_edges e join o_kept using (image_id, edge_id)")
_corner_views("o", "o_left", Q.OUTLINE_SIZE)

add("segment_angles", "s_seg", f"select image_id, seg_id, {r6('theta')} as theta from s_seg")
add("similar_segments", "s_sim", "select * from s_sim")
add("segment_groups", "s_grp", "select * from s_grp")
_edge_cols = ", ".join(f"{r6(k)} as {k}" for k in ("ex1", "ey1", "ex2", "ey2", "length", "theta"))
add("edge_endpoints", "s_edges", f"select image_id, edge_id, {_edge_cols} from s_edges")
add("endpoint_pairs", "s_opt", f"""select image_id, pair.edge_i as edge_i, pair.side_i as side_i, pair.edge_j as edge_j,
    pair.side_j as side_j, {r6('sqrt(pair.d2)')} as dist from s_opt where pair.d2 <= 1600""")
add("ring_order", "s_ring", "select image_id, pos, edge_id, entry from s_ring")
add("ring_filter", "s_kept", "select image_id, cast(pos as int) as pos, edge_id, entry from s_kept")
add("corner_match", "s_match", f"""select image_id, cast(edge_i as int) as edge_i, side_i, cast(edge_j as int) as edge_j,
    side_j, {r6('d2')} as d2 from s_match""")
add("corner_points", "s_corner", f"""select image_id, cast(corner_id as bigint) as corner_id, cast(edge_i as int) as edge_i,
    side_i, cast(edge_j as int) as edge_j, side_j, {r6('x')} as x, {r6('y')} as y from s_corner""")

V["o_slot"] = (["o_corner"], """select image_id, corner_id, x, y, unnest([1, 2]) as slot,
    unnest([edge_i, edge_j]) as edge, unnest([side_i, side_j]) as side from o_corner""")
V["o_link"] = (["o_slot"], """select a.image_id, a.corner_id, a.x, a.y, max(b.corner_id) filter (where a.slot = 1) as n1,
    max(b.corner_id) filter (where a.slot = 2) as n2 from o_slot a left join o_slot b
    on b.image_id = a.image_id and b.edge = a.edge and b.side = 3 - a.side group by all""")
V["o_base"] = (["o_link"], """select * from (select *,
    row_number() over (partition by image_id order by y desc, corner_id) as n from o_link) where n = 1""")
V["o_named"] = (["o_base"], """select t.image_id, b, c, a, l4 as d from (
    select image_id, b, c, a, coalesce(case when coalesce(c.n1 <> b.corner_id, true) then c.n1
        when coalesce(c.n2 <> b.corner_id, true) then c.n2 end, -1) as top from (
        select b.image_id, b, case when abs(p1.x - b.x) >= abs(p2.x - b.x) then p1 else p2 end as c,
            case when abs(p1.x - b.x) >= abs(p2.x - b.x) then p2 else p1 end as a
        from o_base b join o_link p1 on p1.image_id = b.image_id and p1.corner_id = b.n1
        join o_link p2 on p2.image_id = b.image_id and p2.corner_id = b.n2)) t
    join o_link l4 on l4.image_id = t.image_id and l4.corner_id = t.top""")


def _named_lines(images: str) -> str:
    pairs = {"height": "dc", "width": "cb", "depth": "ba"}
    return " union all ".join(
        f"""select p_partkey as image_id, case when n.image_id is null then 'failed' else 'ok' end as status,
        '{name}' as dim_name, n.{p}.x as x1, n.{p}.y as y1, n.{q}.x as x2, n.{q}.y as y2,
        (n.b.x + n.c.x + n.a.x + n.d.x) / 4 as center_x, (n.b.y + n.c.y + n.a.y + n.d.y) / 4 as center_y
        from {images} left join o_named n on n.image_id = p_partkey""" for name, (p, q) in pairs.items())


V["side"] = (["o_named"], _named_lines("part"))
add("side_layout", "side", f"select image_id, status, dim_name, {_xy} from side")
_pick = lambda k, n: f"max({k}) filter (where dim_name = '{n}')"
_dh = {k: f"({_pick(k + '1', 'height')} - {_pick(k + '2', 'height')})" for k in "xy"}
_dd = {k: f"({_pick(k + '1', 'depth')} - {_pick(k + '2', 'depth')})" for k in "xy"}
V["side_flag"] = (["side"], f"""select image_id, status, coalesce(least(h, d) * 1.1::double >= greatest(h, d)
    and abs(dot / nullif(h * d, 0)) >= 0.98, false) as fronted from (select image_id, status, {_length('height')} as h,
    {_length('depth')} as d, {_dh['x']} * {_dd['x']} + {_dh['y']} * {_dd['y']} as dot from side group by image_id, status)""")
add("really_front", "side_flag", """select image_id, status, case when fronted then 'yes' else 'no' end as really_front
    from side_flag""")


def _plan_views(p: str, front: str) -> None:
    """<p>mode: each item's lines by its view; <p>plan_why: everything that is drawn, with the reasons of failures."""
    V[f"{p}mode"] = (["side_flag", "side", front, "view_labels"], f"""select f.oms_id, f.product_type, f.border, f.bordered_w, f.bordered_h,
    f.line_margin, f.line_width, f.font_size, f.dim_name, v.image_view as image_type,
    case when v.image_view = 'SIDE' and not g.fronted then 'SIDE' else 'FRONT' end as mode,
    case when v.image_view = 'SIDE' and g.status <> 'ok' then 'failed' else 'ok' end as status,
    case when v.image_view = 'SIDE' and not g.fronted then struct_pack(x1 := s.x1 + f.border,
        y1 := s.y1 + f.border, x2 := s.x2 + f.border, y2 := s.y2 + f.border,
        center_x := s.center_x + f.border, center_y := s.center_y + f.border) else struct_pack(x1 := f.x1, y1 := f.y1, x2 := f.x2, y2 := f.y2,
        center_x := f.center_x, center_y := f.center_y) end as spot
    from {front} f join view_labels v using (oms_id) join side s on cast(s.image_id as varchar) = f.oms_id
        and s.dim_name = f.dim_name join side_flag g on g.image_id = s.image_id where v.image_view <> 'neither'""")
    V[f"{p}mode_swap"] = ([f"{p}mode", "item_numbers"], f"""select oms_id, image_type = 'FRONT' and product_type in ({_types}) and
        coalesce(abs(m - depth_in / nullif(width_in, 0)) / nullif(depth_in / nullif(width_in, 0), 0)
            <= abs(m - height_in / nullif(width_in, 0)) / nullif(height_in / nullif(width_in, 0), 0) * 0.6::double, false)
            as swapped from (select oms_id, product_type, image_type,
            {_measured} as m from (select *, spot.* from {p}mode) group by all)
        join item_numbers using (oms_id)""")
    V[f"{p}swapped_lines"] = ([f"{p}mode_swap"], f"""select m.* exclude (dim_name), s.swapped, spot.*,
        case when s.swapped and dim_name = 'height' then 'depth' when s.swapped and dim_name = 'depth' then 'height'
            else dim_name end as dim_name from {p}mode m join {p}mode_swap s using (oms_id)""")
    _annotated_views(f"{p}plan", f"{p}swapped_lines", "texts")
    V[f"{p}plan_why"] = ([f"{p}plan_moved"], f"""select *, case when min(status) over w <> 'ok' then 'no corners'
        when bool_or(label is null) over w then 'no dimensions' when bool_or(px1 is null) over w then 'empty line' end as reason
        from {p}plan_moved window w as (partition by oms_id)""")


_plan_views("", "front")
add("layout_mode", "mode", f"""select oms_id, image_type, mode, status, dim_name,
    {', '.join(f"{r6('spot.' + k)} as {k}" for k in ("x1", "y1", "x2", "y2", "center_x", "center_y"))} from mode""")
# The depth text stands beside its line without a box, the others in the middle of theirs.
_beside = {"x": "least(mpx1, mpx2) * 0.4::double", "y": "(mpy1 + mpy2) * 0.5 + abs(mpx1 - mpx2) * 0.1::double"}
_plan_xy = ", ".join([
    *(f"{r6('mp' + k)} as {k}" for k in ("x1", "y1", "x2", "y2")),
    *(f"{r6(f"case when dim_name <> 'depth' then m{k} end")} as {k}" for k in ("bx1", "by1", "bx2", "by2")),
    *(f"{r6(f"case when dim_name = 'depth' then {_beside[k]} else (mb{k}1 + mb{k}2) / 2 end")} as text_{k}" for k in "xy"),
])


def _plan_rows(p: str) -> str:
    return f"""select oms_id, product_type, mode, case when swapped then 'yes' else 'no' end as swapped,
    cw as canvas_w, ch as canvas_h, line_width, font_size, case when reason is null then 'ok' else 'failed' end as status,
    reason, dim_name, label, case when dim_name = 'depth' then 'left' else 'center' end as text_align, {_plan_xy}
    from {p}plan_why"""


add("annotation_plan", "plan_why", _plan_rows(""))
# The pictures of several sizes are the small ones, scaled, and so are the boxes measured on them.
V["sized"] = (["cut_boxes"], f"""select image_id, cast(image_id as varchar) as oms_id, p_type as product_type, k * 24 as img_w,
    k * 20 as img_h, min(min_x) {_big} * k as min_x, (max(max_x) {_big} + 1) * k - 1 as max_x, min(min_y) {_big} * k as min_y,
    (max(max_y) {_big} + 1) * k - 1 as max_y, min(min_x) * k as min_x_bb, (max(max_x) + 1) * k - 1 as max_x_bb,
    min(min_y) * k as min_y_bb, (max(max_y) + 1) * k - 1 as max_y_bb from (select *, max(area) over (partition by image_id) as largest,
        case when image_id % 100 = 7 then 12 else p_size % 3 + 1 end as k from cut_boxes join part on p_partkey = image_id)
    group by image_id, p_type, k""")
add("measured_boxes", "sized", f"""select image_id, cast(img_w as int) as img_w, cast(img_h as int) as img_h,
    {', '.join(f'cast({n} as int) as {n}' for n in _corner_names)} from sized""")
V["m_bordered"], V["m_specs"] = _spec_views("sized", "m_bordered")
V["m_front"] = (["m_specs"], _front_rows(False, "m_specs"))
_plan_views("m_", "m_front")
add("measured_plan", "m_plan_why", _plan_rows("m_"))
V["rug_numbers"] = (["rug_rows"], """select oms_id, min(width_in) as width_in, min(height_in) as height_in,
    min(depth_in) as depth_in from rug_rows group by oms_id""")
V["rug_labels_of"] = (["rug_numbers"], f"""select oms_id, dim_name, case dim_name
    when 'height' then {_feet('number')} || ' L' when 'width' then {_feet('number')} || ' W'
    else {_label('number', 2)} || chr(10) || ' thickness' end as label
    from (select oms_id, unnest(['height', 'width', 'depth']) as dim_name,
        unnest([height_in, width_in, depth_in]) as number from rug_numbers)""")
V["rug_lines"] = (["front_rug", "rug_numbers"], "select f.* from front_rug f semi join rug_numbers n on f.oms_id = n.oms_id")
_annotated_views("carpet", "rug_lines", "rug_labels_of")
V["carpet_why"] = (["carpet_moved"], """select *, bool_or(label is null or px1 is null) over (partition by oms_id) as bad,
    abs(mpx1 - mpx2) as dx, abs(mpy1 - mpy2) as dy from carpet_moved""")
add("rug_plan", "carpet_why", f"""select oms_id, cw as canvas_w, ch as canvas_h, case when bad then 'failed' else 'ok' end as status,
    dim_name, label, {_plan_xy}, cast(cap as int) as cap,
    {r6('case when vertical then x - half else x end')} as cap_x1, {r6('case when vertical then y else y - half end')} as cap_y1,
    {r6('case when vertical then x + half else x end')} as cap_x2, {r6('case when vertical then y else y + half end')} as cap_y2
    from (select *, {_half} as half, unnest([0, 1]) as cap, unnest([mpx1, mpx2]) as x, unnest([mpy1, mpy2]) as y
        from (select *, dx / ((mpx1 + mpx2) * 0.5) < dy / ((mpy1 + mpy2) * 0.5) as vertical from carpet_why))""")
add("type_report", "plan_why items item_numbers merged_images stored_images", r"""select product_type, count(*) as items,
    cast(sum(full_dims) as bigint) as with_dims, cast(sum(1 - full_dims) as bigint) as missing_dims,
    cast(sum(1 - pictured) as bigint) as missing_images, cast(sum(failed) as bigint) as failed,
    cast(sum(swapped) as bigint) as swapped from (
        select i.product_type, case when width_in is null or height_in is null or depth_in is null then 0 else 1 end
            as full_dims, case when i.oms_id in (select oms_id from merged_images where image_guid in (
                select regexp_extract(path, '([^/]+)\.jpg$', 1) from stored_images where length > 0)) then 1 else 0 end
            as pictured, coalesce(p.failed, 0) as failed, coalesce(p.swapped, 0) as swapped
        from items i left join item_numbers n using (oms_id) left join (select oms_id,
            max(case when reason is not null then 1 else 0 end) as failed, max(case when swapped then 1 else 0 end) as swapped
            from plan_why group by oms_id) p using (oms_id)) group by product_type""")
