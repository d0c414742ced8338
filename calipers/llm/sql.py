"""DuckDB statements of the same results, written from the definitions."""

from __future__ import annotations

MIX = r"""
with base as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 12))::bigint as draw
    from documents
), sizes as (
    select source, sum(size)::bigint as s,
        row_number() over (order by source nulls last) - 1 as rank from base group by source
), weighed as (
    select *, (rank % 3 + 1)::bigint as w, 3 * s as cap, [-0.5, 0.0, 0.5][(rank % 3 + 1)::int]::double as ramp,
        (sum(s) over ())::bigint as total from sizes
), levels as (
    select *, (select sum(case when b.cap::double / b.w < a.cap::double / a.w
            or (b.cap::double / b.w = a.cap::double / a.w and b.rank < a.rank) then b.cap else 0 end) from weighed b)::bigint as filled,
        (select sum(case when b.cap::double / b.w < a.cap::double / a.w
            or (b.cap::double / b.w = a.cap::double / a.w and b.rank < a.rank) then 0 else b.w end) from weighed b)::bigint as rest
    from weighed a
), level as (
    select total - filled as left_, rest from levels
    where (total - filled)::double / rest <= cap::double / w order by cap::double / w, rank limit 1
), targets as (
    select source, s, ramp, coalesce(least((left_ * w)::double / rest, cap::double), 0.0) as target
    from weighed left join level on true
), placed as (
    select b.doc_id, b.size, t.s as source_size, t.target, t.ramp,
        case when t.s > 0 then floor(t.target / t.s) else 0 end::int as passes,
        sum(b.size) over (partition by b.source order by b.draw, b.doc_id rows unbounded preceding) - b.size as start
    from base b join targets t on b.source is not distinct from t.source
), counted as (
    select *, start + size / 2.0::double as middle,
        passes + (start + size / 2.0::double < target - passes * source_size)::int as copies from placed
), x as (
    select *, case when copies > 0 and target > 0 then least(middle / target, 1.0) end as share from counted
)
select doc_id, size, source_size, target, (copies * size)::bigint as taken, copies,
    round(case when share is null then null when abs(ramp) < 1e-9 then share
        else (sqrt(greatest((1 - ramp) * (1 - ramp) + 4 * ramp * share, 0.0)) - (1 - ramp)) / (2 * ramp) end, 9) as position
from x
"""

# The checksum is CRC-32 byte by byte; its table follows from the reversed polynomial.
SHARD = r"""
with recursive step as (
    select list_transform(range(256), lambda b: list_reduce([b::bigint, 0, 1, 2, 3, 4, 5, 6, 7],
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) as crc_of
), counted as (
    select doc_id, coalesce(strlen(text), 0) as bytes, coalesce(doc_id, -1)::bigint as key,
        list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda p: ('0x' || p)::bigint) as octets from documents
), summed as (
    select doc_id, key, bytes + 1 as size, case when bytes = 0 then 0 else xor(4294967295::bigint, list_reduce(octets,
        lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255)::bigint + 1]), 4294967295::bigint)) end::bigint as text_crc32 from counted, step
), jump as (
    select key, shards, case when key < 0 then key::hugeint + 18446744073709551616 else key end::uhugeint as state, -1::bigint as spot, 0::bigint as ahead
    from (select distinct key from counted), (select unnest([8, 9]) as shards)
    union all
    select key, shards, turned, ahead, floor((ahead + 1) * (2147483648.0::double / ((turned >> 33)::double + 1.0)))::bigint
    from (select *, (state * 2862933555777941757::uhugeint + 1) % 18446744073709551616::uhugeint as turned from jump where ahead < shards)
), placed as (
    select key, max(spot) filter (where shards = 8)::int as shard, max(spot) filter (where shards = 9)::int as grown_shard from jump group by key
)
select doc_id, size::bigint as size, text_crc32, 'key' as law, shard,
    row_number() over (partition by shard order by doc_id nulls first, text_crc32, size) - 1 as slot, grown_shard
from summed join placed using (key)
"""

RANK = r"""
with d as (
    select row_number() over () as r, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
    )) as term from documents
), held as (
    select r, any_value(doc_id) as doc_id, term, count(*)::bigint as tf from d group by r, term
), lengths as (
    select r, sum(tf)::bigint as n from held group by r
), totals as (
    select count(*)::bigint as docs, sum(n)::bigint as terms from lengths
), asked as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
    )) as term from benchmark
), weights as (
    select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from held cross join totals where term in (select term from asked) group by term
), scores as (
    select a.item_id, h.r, any_value(h.doc_id) as doc_id,
        sum(w.w * ((1000000000 * h.tf) // (1000 * h.tf + 20 * (50 + (50 * l.n * t.docs) // t.terms))))::bigint as score
    from asked a join weights w using (term) join held h using (term) join lengths l using (r) cross join totals t
    group by a.item_id, h.r
), ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
    from scores where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""
