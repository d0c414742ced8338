"""The adapter views as plain SQL, with the views each one builds on."""

from __future__ import annotations

import re
from collections import Counter

from calipers.sources.adapters import ATTRIBUTE_NAMES, DIMENSION_CONFIG

GUID = "md5(cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar))"

_names = " union all ".join(
    f"select '{k}' as attribute_id, '{v}' as displayname" for k, v in ATTRIBUTE_NAMES.items()
)
_config = " union all ".join(
    f"select '{t}' as product_type, '{d}' as dimension_name, '{a}' as attribute_id"
    for t, dims in DIMENSION_CONFIG.items()
    for d, a in dims.items()
)

_ATTRIBUTE_RULES = [
    ("a-width", "cast(p_size as varchar) || ' in'", "true"),
    ("a-depth", "cast(p_size % 16 + 1 as varchar) || '.5 in'", "p_brand <> 'Brand#7'"),
    ("a-height", "cast(cast(floor(p_retailprice) as int) % 97 + 1 as varchar) || '.125'", "true"),
    ("a-length", "cast(p_size + 3 as varchar)", "p_type in ('PROMO', 'LARGE')"),
    ("a-canopy", "case when p_brand = 'Brand#11' then 'n/a' else cast(p_size % 6 as varchar) || '.25' end", "true"),
    ("a-group", "case when p_brand < 'Brand#15' then ' ' || p_type else p_type end", "true"),
    ("a-thick1", "cast(p_size % 4 as varchar) || '/8'", "split_part(p_name, ' ', 2) <> 'rod'"),
    ("a-thick2", "'0.' || cast(p_size % 9 + 1 as varchar)", "true"),
    ("a-style", "p_type", "true"),
    ("a-style", "p_type || ',' || split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2) = 'widget'"),
]
_measures = " union all ".join(
    f"select cast(p_partkey as varchar) as oms_id, '{a}' as attribute_id, {v} as attribute_value from part where {w}"
    for a, v, w in _ATTRIBUTE_RULES
)

_flat = "case when p_brand < 'Brand#12' then {} else {} end"
_shift = "cast(floor(p_retailprice) as int) % 10"
_CORNERS = {
    "a": (f"({_flat.format(58, 60)})", f"({_flat.format(100, 250)} + {_shift})"),
    "b": (f"({_flat.format(60, '100 + p_size')})", "330"),
    "c": ("300", f"({_flat.format(310, 290)})"),
    "d": ("305", f"(90 + {_shift})"),
    "e": ("(180 + p_size)", "60"),
    "f": (f"({_flat.format(100, 58)})", f"({_flat.format(70, 95)})"),
}


def _outline() -> str:
    rows = []
    for n, (s, e) in enumerate(["ab", "bc", "cd", "de", "ef", "fa"]):
        (xs, ys), (xe, ye) = _CORNERS[s], _CORNERS[e]
        where = "true" if n == 0 else "p_brand <> 'Brand#25'"
        mx, my = f"floor(({xs} + {xe}) / 2.0)", f"floor(({ys} + {ye}) / 2.0)"
        rows.append((2 * n + 1, f"{xs} + 1", ys, mx, my, where))
        rows.append((2 * n + 2, xe, f"{ye} - 1", mx, f"{my} + 1", where))
    rows.append((13, "150 + p_size", "200", "160 + p_size", "207", "p_type = 'LARGE'"))
    return " union all ".join(
        f"select p_partkey as image_id, {k} as seg_id, cast({a} as double) as x1, cast({b} as double) as y1, "
        f"cast({c} as double) as x2, cast({d} as double) as y2 from part where {w}"
        for k, a, b, c, d, w in rows
    )


VIEWS: dict[str, tuple[list[str], str]] = {
    "items": ([], """select cast(p_partkey as varchar) as oms_id, p_type as product_type,
        p_type || '>' || p_name as taxonomy from part"""),
    "attributes": ([], _names),
    "dimension_config": ([], _config),
    "item_attributes": ([], f"""{_measures} union all
        select distinct cast(l_partkey as varchar), 'a-image', {GUID} from lineitem"""),
    "merged_images": ([], f"""select distinct p_type as product_type, cast(l_partkey as varchar) as oms_id,
        {GUID} as image_guid, case when l_suppkey % 2 = 0 then 'FRONT' else 'SIDE' end as image_type
        from lineitem join part on l_partkey = p_partkey"""),
    "image_urls": ([], f"""select distinct l_partkey as oms_id,
        'https://images.example.com/productImages/' || {GUID} || '/svn/p' || cast(l_partkey as varchar)
            || '_1000.jpg' as image_url,
        case when l_suppkey % 2 = 0 then 'front,white' else 'side' end as prediction_labels from lineitem"""),
    "attribute_snapshots": ([], """select cast(o_orderdate as date) as snapshot_date,
        cast(o_custkey as varchar) as oms_id, o_orderpriority as attribute_value from orders"""),
    "feed_paths": ([], """select case when o_orderstatus = 'O' then 'feed/items/staging-' else 'feed/items/' end
        || strftime(o_orderdate, '%Y-%m-%d') || '/part-' || cast(o_orderkey as varchar) as path from orders"""),
    "rugs": ([], """select p_partkey as omsid, case when p_type = 'SMALL'
        then 'Round rug ' || cast(p_size as varchar) || ' in.'
        else 'Rug ' || cast(p_size % 12 + 1 as varchar) || ' ft. ' || cast(p_size % 11 as varchar) || ' in. x '
            || cast(p_size % 9 + 2 as varchar) || ' ft.' end as product_name from part"""),
    "boxes": ([], """select cast(p_partkey as varchar) as oms_id, p_type as product_type,
        p_size + 1000 as img_w, p_size + 800 as img_h, p_size + 100 as min_x, 700 - p_size * 4 as max_x,
        p_size * 3 + 120 as min_y, 640 - p_size as max_y, 100 as min_x_bb, 710 as max_x_bb, 115 as min_y_bb,
        650 as max_y_bb from part"""),
    "pixel_grid": ([], """select p_partkey as image_id, p_type, p_size, x, y, p_size % 7 + 2 as top
        from (select *, unnest(range(0, 24)) as x from (select *, unnest(range(0, 20)) as y from part))"""),
    "pixel_kind": (["pixel_grid"], """select *, case
        when x between 3 and p_size % 16 + 3 and y between top and top + 2 + (p_size * 7) % 9
            and not (x = 6 and y > top + 1) then 'main'
        when p_size % 2 = 1 and x between 20 and 22 and y between 14 and 16 + p_size % 3 then 'block'
        when x = 1 and y = 1 then 'speck'
        when p_type in ('LARGE', 'SMALL') and x between 2 and 19 and y between 1 and 15
            then case when p_type = 'LARGE' then 'halo250' else 'halo246' end
        else 'white' end as kind from pixel_grid"""),
    "pixels": (["pixel_kind"], """select image_id, cast(x as int) as x, cast(y as int) as y,
        case kind when 'main' then p_size + 40 when 'block' then p_size % 20 + 200 when 'speck' then p_size + 40
            when 'halo250' then 250 when 'halo246' then 246 else 255 end as r,
        case kind when 'main' then 90 when 'block' then 235
            when 'halo250' then 250 when 'halo246' then 246 else 255 end as g,
        case kind when 'main' then p_size * 3 + 100 when 'block' then 240
            when 'halo250' then 250 when 'halo246' then 246 else 255 end as b from pixel_kind"""),
    "segments": ([], """select image_id, seg_id, cast(p % 90 as double) as x1, cast((s * 37) % 90 as double) as y1,
        cast(case when seg_id % 2 = 0 then p % 90 + 3 else (p + 260) % 400 + 100 end as double) as x2,
        cast(case when seg_id % 2 = 0 then (s * 37 + 180) % 400 + 100 else (s * 37) % 90 + 2 end as double) as y2
        from (select l_orderkey as image_id, l_linenumber as seg_id, l_partkey as p, l_suppkey as s,
            row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey) as n
            from lineitem) where n = 1"""),
    "outline_segments": ([], _outline()),
    "view_candidates": ([], f"""select cast(l_partkey as varchar) as oms_id, {GUID} as image_guid,
        case when l_suppkey % 2 = 0 then 'FRONT' else 'SIDE' end as image_view, max(l_extendedprice) as score
        from lineitem group by l_partkey, l_suppkey"""),
    "view_labels": ([], """select cast(p_partkey as varchar) as oms_id, p_type as product_type,
        case when p_size % 5 < 2 then 'SIDE' when p_size % 5 < 4 then 'FRONT' else 'neither' end as image_view from part"""),
    "stored_images": ([], f"""select 'store/images/' || {GUID} || '.jpg' as path,
        cast(case when max(l_quantity) < 10 then 0 else max(l_quantity) * 1000 end as bigint) as length
        from lineitem where l_returnflag <> 'R' group by l_partkey, l_suppkey"""),
}


def with_views(names: str, body: str, views: dict[str, tuple[list[str], str]] = VIEWS) -> str:
    """`body` preceded by the named views and everything they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in views[name][0]:
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    # what several others read is computed once, and its size is known to them
    used = Counter(dep for name in ordered for dep in set(views[name][0])) + Counter(names.split())
    loops = {name for name in ordered if re.search(rf"\bfrom {name}\b|\bjoin {name}\b", views[name][1])}
    kind = {name: "materialized " if used[name] > 1 and name not in loops else "" for name in ordered}
    ctes = ",\n".join(f"{n} as {kind[n]}({views[n][1]})" for n in ordered)
    return f"with recursive {ctes}\n{body}"
