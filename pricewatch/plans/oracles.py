"""SQL checks of the registered queries, for DuckDB over the same tables.

They go the long way on purpose: dense calendars, range joins, self-joins and
numbered windows, where the operators use runs, flags and aggregates. Agreement
then says something about both. Common steps are named parts; `_sql` puts the
parts a query needs in front of its body.
"""

from __future__ import annotations

import re

from ..operators.audit import MISMATCH_TYPES

VALID, COMMON, RECENT, ALL = 15, 20, 10, 40


def _pct(price: str, base: str) -> str:
    ratio = f"cast({price} as double) / nullif(cast({base} as double), 0)"
    return f"cast(round(cast(({ratio} - 1) * -100 as decimal(24,6)), 2) as decimal(18,2))"


def _mean(total: str, n: str) -> str:
    ratio = f"cast({total} as double) / nullif(cast({n} as double), 0)"
    return f"cast(round(cast({ratio} as decimal(24,6)), 2) as decimal(18,2))"


def _whole(value: str) -> str:
    return f"try_cast({value} as decimal(38,0))"


def _raw(shift: str = "", where: str = "", shared: bool = False) -> str:
    item = "(user_id // 5)" if shared else "user_id"
    origin = "'origin_' || (user_id % 5 % 2)" if shared else "'demo_origin'"
    return f"""
    select case user_id % 5 when 0 then 'alfa_cz' when 1 then 'beta.cz' when 2 then 'gama_sk'
                            when 3 then 'delta.sk' else 'omega' end as shop,
           {origin} as "shopOrigin",
           case when event_id % 211 = 0 then '' else 'i' || {item} end as "itemId",
           'Item ' || user_id as "itemName",
           'https://shop.example/p/' || user_id as "itemUrl",
           case when user_id % 37 = 0 then '' else 'p-' || {item} end as slug,
           case when event_type = 'error' then '' else cast(price as varchar) end as "currentPrice",
           case (user_id + blk) % 3
             when 1 then cast(cast(price * cast(1.25 as decimal(4,2)) as decimal(12,2)) as varchar)
             when 2 then cast(price as varchar) else '' end as "originalPrice",
           'https://img.example/' || user_id || '.jpg' as img,
           left(cast(ts as varchar), 19) as date,
           'true' as "inStock",
           date_trunc('day', ts) + interval 23 hour as _timestamp
    from (select *, cast((case when event_type = 'view' and value < 2 then 1
                          else 100 + 40 * ((user_id + 3 * blk) % 5) + case when value < 15 then 0 else 20 end
                          end) {shift} as decimal(12,2)) as price
          from (select *, cast(floor(day(ts) / 4) as int) as blk from events {where}))"""


def _unify(raw: str, scope: str, by: str = "", extra: str = "") -> str:
    group = by + ('"itemId", scraped' if scope == "scrape" else '"itemId", date')
    return f"""
    select shop, p_key, "itemId", "itemName", "itemUrl", slug, "currentPrice", "originalPrice",
           "officialSale", "itemImage", date, "inStock", {extra} max(_timestamp) as _timestamp
    from (select *, min(own) over (partition by {group}) as "currentPrice",
                 case when top > own then top when top <= own then null else top end as "originalPrice"
          from (select *, max(claim) over (partition by {by} "itemId", date) as top
                from (select shop, md5(shop || "itemId") as p_key, "itemId", "itemName", "itemUrl", slug,
                             try_cast("currentPrice" as decimal(12,2)) as own,
                             try_cast("originalPrice" as decimal(12,2)) as claim,
                             {_pct(_whole('"currentPrice"'), _whole('"originalPrice"'))} as "officialSale",
                             img as "itemImage", date as scraped, cast(date as date) as date, "inStock", {extra} _timestamp
                      from {raw}
                      where "currentPrice" <> '' and date <> '' and "itemId" <> '')))
    group by all"""


def _keyed(source: str, keys: str) -> str:
    return f"""
    select * from {source}
    qualify row_number() over (partition by {keys}, date
      order by "currentPrice" nulls last, "originalPrice" desc nulls last, shop, p_key, "itemName", "itemUrl",
               slug, "officialSale" nulls first, "itemImage", "inStock") = 1"""


def _on(keys: str, left: str, right: str) -> str:
    return " and ".join(f"{left}.{k.strip()} = {right}.{k.strip()}" for k in keys.split(","))


def _cols(keys: str, table: str) -> str:
    return ", ".join(f"{table}.{k.strip()}" for k in keys.split(","))


def _dense(tag: str, uni: str, keys: str, history: int, points: int, cal: int) -> dict[str, str]:
    """Calendar x items grid with gaps filled, as a table of days."""
    return {
        f"cal{tag}": f"""
        select cast(unnest(generate_series(m - to_days({cal} - 1), cast(m as timestamp), interval 1 day)) as date) as day
        from (select max(date) as m from {uni})""",
        f"items{tag}": f"select distinct {keys} from {uni}, today where date >= t - {history}",
        f"points{tag}": f"""
        select {keys}, date, "currentPrice", "originalPrice",
               case when "originalPrice" is not null and lag(date) over w is not null
                         and lag("originalPrice") over w is null then true end as "first_day_origPrice"
        from {uni}, today where date >= t - {points} and "currentPrice" is not null
        window w as (partition by {keys} order by date)""",
        f"filled{tag}": f"""
        select {_cols(keys, 'g')}, g.day as date, p."currentPrice" as own,
               last_value(p."currentPrice" ignore nulls) over (
                 partition by {_cols(keys, 'g')} order by g.day
                 rows between unbounded preceding and current row) as price
        from (select * from items{tag} cross join cal{tag}) g
        left join points{tag} p on {_on(keys, 'g', 'p')} and g.day = p.date""",
        f"dense{tag}": f"""
        select {keys}, date, price as "currentPrice", case when own is null then '0' else '1' end as filled_row,
               case when price < lag(price) over w then 'down' when price > lag(price) over w then 'up'
                    when price = lag(price) over w then 'steady' else 'price_init' end as price_trend
        from filled{tag}, today where date >= t - {history} and price is not null
        window w as (partition by {keys} order by date)""",
    }


def _reference(
    tag: str,
    uni: str = "uni",
    keys: str = '"itemId"',
    rule: str = "since_up",
    strict: bool = True,
    oldest: bool = False,
    history: int = VALID + 30,
    points: int | None = None,
    cal: int = 151,
    common: int | None = COMMON,
    change: int | None = VALID,
    limit: int | None = None,
) -> dict[str, str]:
    parts = _dense(tag, uni, keys, history, points or history, cal)
    since = "" if common is None else f"where date >= t - {common}"
    parts[f"common{tag}"] = f"""
        select {keys}, "currentPrice" as "commonPrice"
        from (select {keys}, "currentPrice", count(*) as n from dense{tag}, today {since} group by all)
        qualify row_number() over (partition by {keys} order by n desc, "currentPrice") = 1"""
    window = "" if change is None else f"and d.date >= t - {change}"
    parts[f"changes{tag}"] = f"""
        select {_cols(keys, 'd')}, d.date, d."currentPrice", d.price_trend,
               cast(row_number() over (partition by {_cols(keys, 'd')} order by d.date desc) as int) as row_number,
               p."first_day_origPrice"
        from dense{tag} d join today on true
        left join points{tag} p on {_on(keys, 'd', 'p')} and d.date = p.date
        where d.price_trend in ('up', 'down') {window}"""
    parts[f"since{tag}"] = f"""
        select c.* from changes{tag} c
        left join (select {keys}, max(date) as up from changes{tag} where price_trend = 'up' group by all) u
          on {_on(keys, 'c', 'u')}
        where u.up is null or c.date > u.up"""
    pick = "max" if oldest else "min"
    last = f"(select {keys}, max(row_number) + 1 as last from since{tag} group by all)"
    claim = f"(select {keys}, {pick}(row_number) + 1 as claim from since{tag} where \"first_day_origPrice\" group by all)"
    up = f"(select {keys}, min(row_number) as up from changes{tag} where price_trend = 'up' group by all)"
    total = f"(select {keys}, max(row_number) + 1 as total from changes{tag} group by all)"
    breaks = {
        "since_up": (
            "case when l.last is null or k.claim is null then null else least(l.last, k.claim) end"
            if strict
            else "least(l.last, k.claim)"
        ),
        "gradual_v2": "coalesce(u.up, n.total)",
        "last_change": "2",
    }
    within = "" if limit is None else f"and c.date >= t - {limit}"
    parts[f"valid{tag}"] = f"""
        select {keys}, date, "currentPrice", price_trend, row_number
        from (select c.*, {breaks[rule]} as brk from changes{tag} c join today on true
              left join {last} l on {_on(keys, 'c', 'l')}
              left join {claim} k on {_on(keys, 'c', 'k')}
              left join {up} u on {_on(keys, 'c', 'u')}
              left join {total} n on {_on(keys, 'c', 'n')}
              where true {within})
        where row_number = 1 or row_number = brk - 1
        qualify row_number = max(row_number) over (partition by {keys})"""
    parts[f"lowest{tag}"] = f"""
        select {_cols(keys, 'v')}, v.date, v."currentPrice", v.price_trend, min(d."currentPrice") as "min_currentPrice"
        from valid{tag} v
        left join dense{tag} d on {_on(keys, 'v', 'd')} and d.date < v.date and d.date >= v.date - 30
        where v.price_trend = 'down' group by all"""
    parts[f"refs{tag}"] = f"""
        select {_cols(keys, 'c')}, c."commonPrice", m."min_currentPrice" as "minPrice", t as date
        from common{tag} c join today on true left join lowest{tag} m on {_on(keys, 'c', 'm')}"""
    return parts


UNIFIED = (
    'shop, p_key, "itemId", "itemName", "itemUrl", slug, "currentPrice", "originalPrice", "officialSale", '
    '"itemImage", date, "inStock"'
)


def _complete(uni: str, refs: str, keys: str, where: str = "true", extra: str = "") -> str:
    base = 'coalesce(r."minPrice", r."commonPrice")'
    return f"""
    select u.*, {extra} r."commonPrice", r."minPrice", {base} as "originalPriceHS",
           {_pct('u."currentPrice"', base)} as "newSale"
    from {uni} u left join {refs} r on {_on(keys, 'u', 'r')} and u.date = r.date
    where {where}"""


def _history(tag: str, rows: str, keys: str = '"itemId"', recent: bool = True, like: str = "", shop: bool = False):
    """Dense history from a calendar range join, labelled day by day."""
    per = "shop, " if shop else ""
    limit = (
        f"select {per}_timestamp as lim from (select distinct {per}_timestamp from {rows}) "
        f"qualify dense_rank() over ({'partition by shop ' if shop else ''}order by _timestamp desc) = 2"
    )
    same_shop = lambda a, b: f"and {a}.shop = {b}.shop" if shop else ""
    included = (
        f"select distinct {_cols(keys, 'c')} from {rows} c join limit{tag} l on true {same_shop('c', 'l')} where c._timestamp >= l.lim"
        if recent
        else f"select distinct {keys} from {rows}"
    )
    slug_filter = f"and slug not ilike '{like}'" if like else ""
    attr_from = f"{rows} c join limit{tag} l on true {same_shop('c', 'l')} and c._timestamp >= l.lim" if recent else f"{rows} c"
    frame = "rows between unbounded preceding and unbounded following"
    return {
        f"limit{tag}": limit,
        f"included{tag}": included,
        f"daily{tag}": f"""
        select {_cols(keys, 'c')}, date, cast("originalPrice" as decimal(20,2)) as o, cast("currentPrice" as decimal(20,2)) as c
        from {rows} c join included{tag} i on {_on(keys, 'c', 'i')}
        qualify row_number() over (partition by {_cols(keys, 'c')}, date
                                   order by "currentPrice" nulls last, "originalPrice" desc nulls last) = 1""",
        f"range{tag}": f"""
        select {keys}, min(date) as min_d,
               case when max(date) < any_value(t) then max(date) + 1 else max(date) end as max_d
        from daily{tag}, today group by {keys}""",
        f"seq{tag}": f"""
        select {per}cast(unnest(generate_series(cast(a as timestamp), cast(b as timestamp), interval 1 day)) as date) as d
        from (select {per}min(date) as a, max(date) as b from daily{tag} group by all)""",
        f"fill{tag}": f"""
        select {_cols(keys, 'r')}, s.d, p.o, p.c
        from range{tag} r join seq{tag} s on s.d >= r.min_d and s.d <= r.max_d {same_shop('r', 's')}
        left join daily{tag} p on {_on(keys, 'r', 'p')} and p.date = s.d""",
        f"kept{tag}": f"""
        select * from fill{tag}
        qualify coalesce(lag(coalesce(cast(o as varchar), '') || '-' || coalesce(cast(c as varchar), ''))
                         over (partition by {keys} order by d)
                         <> coalesce(cast(o as varchar), '') || '-' || coalesce(cast(c as varchar), ''), true)""",
        f"attr{tag}": f"""
        select distinct {_cols(keys, 'c')}, {_domain('c.shop')} as shop_id,
               {"" if "slug" in keys else f'last_value(slug ignore nulls) over w as slug,'}
               last_value(p_key ignore nulls) over w as p_key,
               last_value("commonPrice") over w as "commonPrice", last_value("minPrice") over w as "minPrice"
        from {attr_from} where {"slug <> ''" if recent else "true"} {slug_filter}
        window w as (partition by {_cols(keys, 'c')} order by date {frame})""",
    }


def _domain(shop: str) -> str:
    return (
        f"case when {shop} like '%_cz' then replace({shop}, '_cz', '.cz') when {shop} like '%.cz' then {shop} "
        f"when {shop} like '%_sk' then replace({shop}, '_sk', '.sk') when {shop} like '%.sk' then {shop} "
        f"else {shop} || '.cz' end"
    )


_ENTRY = "{'d': d, 'o': cast(o as double), 'c': cast(c as double)}"


def _document(tag: str, keys: str = '"itemId"', wrap: bool = False) -> str:
    slug = "k.slug" if "slug" in keys else "a.slug"
    columns = ", ".join(c for c in _cols(keys, "k").split(", ") if c != "k.slug")
    entries = f"list({_ENTRY.replace('d,', 'k.d,').replace('o as', 'k.o as').replace('c as', 'k.c as')} order by k.d)"
    body = (
        f"{{'entries': {entries}, 'commonPrice': cast(a.\"commonPrice\" as double), 'minPrice': cast(a.\"minPrice\" as double)}}"
        if wrap
        else entries
    )
    return f"""
    select {columns}, {slug} as slug, a.shop_id, cast(to_json({body}) as varchar) as json, a."commonPrice", a."minPrice"
    from kept{tag} k join attr{tag} a on {_on(keys, 'k', 'a')}
    where a."commonPrice" is not null and {slug} <> ''
    group by {columns}, {slug}, a.shop_id, a."commonPrice", a."minPrice" """


OWN = "Reference"


def _audit(
    tag: str, rows: str, days: int, keys: str = '"itemId"', whole: bool = True, skip4: bool = True, by_shop: bool = False
) -> dict[str, str]:
    slug = "slug, " if "slug" in keys else ""
    label = {n: text.format(name=OWN) for n, text in MISMATCH_TYPES.items()}
    s, h = _whole("sleva_dle_shopu"), _whole(f'"sleva_dle_{OWN}"')
    projection = f"""
        select {'shop' if by_shop else '(select shop from stamp) as shop'}, "itemId", {slug} "itemName", "currentPrice" as prodejni_cena,
               "originalPrice" as "refCena_dle_shopu", "originalPriceHS" as "refCena_dle_{OWN}",
               coalesce({_pct('"currentPrice"', '"originalPrice"')}, 0) as sleva_dle_shopu,
               "newSale" as "sleva_dle_{OWN}", date as datum, "itemUrl"
        from {rows} r """
    same = "where x.shop = r.shop" if by_shop else ""
    gap = f'abs(sleva_dle_shopu - "sleva_dle_{OWN}")'
    count = "slug" if slug else '"itemId"'
    claim = s if whole else "sleva_dle_shopu"
    type4 = f"and typ_neshody <> '{label[4]}'" if skip4 else ""
    return {
        f"snap{tag}": projection + f"where date = (select max(date) from {rows} x {same})",
        f"win{tag}": projection + f"where date >= (select max(date) - {days} from {rows} x {same})",
        f"mism{tag}": f"""
        select case when {s} > {h} and {h} < 0 then '{label[1]}' when {s} > {h} and {h} = 0 then '{label[2]}'
                    when {s} > {h} and {h} > 0 then '{label[3]}' when {s} < {h} and {h} > 0 then '{label[4]}'
               end as typ_neshody, *
        from snap{tag} where {gap} >= 3 and {s} <> 0""",
        f"items_n{tag}": f'select shop, datum as aktualizace, count(distinct {count}) as "Produktu_celkem" from snap{tag} group by all',
        f"disc_n{tag}": f'select count(distinct {count}) as "Produktu_ve_sleve" from snap{tag} where sleva_dle_shopu > 3',
        f"false_n{tag}": f"""
        select nullif(count(distinct d.{count}), 0) as "Neshoda_ve_sleve" from mism{tag} d
        join (select * from mism{tag} where {claim} > 3 {type4}) s on {_on(keys, 'd', 's')}""",
        f"avg_shop{tag}": f"""
        select {_mean(f'sum({claim})', f'count({claim})')} as "Prumerna_uvadena_sleva" from snap{tag} where sleva_dle_shopu > 3""",
        f"avg_own{tag}": f"""
        select {_mean(f'sum("sleva_dle_{OWN}")', f'count("sleva_dle_{OWN}")')} as "Prumerna_realna_sleva" from snap{tag} where {s} > 3""",
        f"pairs{tag}": f"""
        select d.*, abs(d.sleva_dle_shopu - d."sleva_dle_{OWN}") as rozdil_slev
        from mism{tag} d join (select {keys} from mism{tag} where {s} > 3) o on {_on(keys, 'd', 'o')}""",
        f"moved{tag}": f"""
        select *, lag("refCena_dle_shopu") over w as before,
               last_value("refCena_dle_shopu" ignore nulls) over (partition by {keys} order by datum
                 rows between unbounded preceding and 1 preceding) as known
        from win{tag} window w as (partition by {keys} order by datum)""",
        f"raised{tag}": f"""
        select m.* from moved{tag} m
        join (select {keys} from snap{tag} where {claim} >= 3) d on {_on(keys, 'm', 'd')}
        where m.before is not null and m."refCena_dle_shopu" is not null and m.known <> m."refCena_dle_shopu"
        qualify row_number() over (partition by {_cols(keys, 'm')} order by m.datum desc) = 1""",
        f"raised_out{tag}": f"""
        select {keys if by_shop else 'shop, ' + keys}, "itemName", prodejni_cena, "refCena_dle_shopu" as "refCena_aktualni",
               before as "refCena_puvodni", datum as "datum_zmeny_refCeny", "refCena_dle_{OWN}", sleva_dle_shopu,
               "sleva_dle_{OWN}", "itemUrl", cast("refCena_dle_shopu" - before as decimal(18,2)) as "rozdil_refCen"
        from raised{tag}
        where known < "refCena_dle_shopu" and cast("refCena_dle_shopu" as double) / before * 100 - 100 > 3 and {gap} >= 3""",
        f"dash{tag}": f"""
        select i.shop as "Shop", i."Produktu_celkem", n."Produktu_ve_sleve",
               case when n."Produktu_ve_sleve" <> 0 then (select * from false_n{tag}) end as "Produktu_s_chybnou_slevou",
               case when n."Produktu_ve_sleve" <> 0 then (select count(distinct {count}) from raised_out{tag}) end as "Produktu_s_navysenou_refCenou",
               case when n."Produktu_ve_sleve" <> 0 then (select * from avg_shop{tag}) end as "Prumerna_uvadena_sleva",
               case when n."Produktu_ve_sleve" <> 0 then (select * from avg_own{tag}) end as "Prumerna_realna_sleva",
               timezone('Europe/Prague', timezone('UTC', cast((select aktualizace from stamp) || ':00' as timestamp))) as "Aktualizace"
        from items_n{tag} i, disc_n{tag} n""",
    }


ITEM, SLUG, SHOP = '"itemId"', '"itemId", slug', 'shop, "itemId"'


def _dashboard_by_shop(tag: str, raw: str) -> str:
    s = _whole("sleva_dle_shopu")
    own = f'case when {s} > 3 then "sleva_dle_{OWN}" end'
    claim = f"case when sleva_dle_shopu > 3 then {s} end"
    label = MISMATCH_TYPES[4].format(name=OWN)
    return f"""
    select i.shop as "Shop", "Produktu_celkem", "Produktu_ve_sleve",
           case when "Produktu_ve_sleve" <> 0 then f.n end as "Produktu_s_chybnou_slevou",
           case when "Produktu_ve_sleve" <> 0 then coalesce(r.n, 0) end as "Produktu_s_navysenou_refCenou",
           case when "Produktu_ve_sleve" <> 0 then claimed end as "Prumerna_uvadena_sleva",
           case when "Produktu_ve_sleve" <> 0 then real_mean end as "Prumerna_realna_sleva",
           timezone('Europe/Prague', timezone('UTC', cast(t.aktualizace || ':00' as timestamp))) as "Aktualizace"
    from (select shop, count(distinct "itemId") as "Produktu_celkem",
                 count(distinct case when sleva_dle_shopu > 3 then "itemId" end) as "Produktu_ve_sleve",
                 {_mean(f'sum({claim})', f'count({claim})')} as claimed, {_mean(f'sum({own})', f'count({own})')} as real_mean
          from snap{tag} group by shop) i
    left join (select shop, count(distinct "itemId") as n from mism{tag}
               where {s} > 3 and typ_neshody <> '{label}' group by shop) f on f.shop = i.shop
    left join (select shop, count(distinct "itemId") as n from raised_out{tag} group by shop) r on r.shop = i.shop
    left join stamps{tag} t on t.shop = i.shop"""


def _parts() -> dict[str, str]:
    every_day = "select r.* exclude (date), d.day as date from {refs} r, every_day d"
    parts = {
        "today": "select max(cast(ts as date)) as t from events",
        "raw": _raw(),
        "raw2": _raw("- 5", "where event_type = 'click'"),
        "rawm": _raw(shared=True),
        "rawu": """select *, case when "originalPrice" = '' then 'false' else 'true' end as "usedGoods" from raw""",
        "scraped": _unify("raw", "scrape"),
        "dailym": _unify("rawm", "day", "shop, "),
        "unim": _keyed("dailym", SHOP),
        "daily": _unify("raw", "day"),
        "daily2": _unify("raw2", "day"),
        "uni": _keyed("daily", ITEM),
        "uni2": _keyed("daily2", ITEM),
        "raw3": _raw("- 3", "where event_type = 'view'"),
        "daily3": _unify("raw3", "day"),
        "uni3": _keyed("daily3", ITEM),
        "dailyu": _unify("rawu", "day", extra='"usedGoods",'),
        "uniu": _keyed("dailyu", ITEM).replace('"inStock") = 1', '"inStock", "usedGoods") = 1'),
        "uni_slug": _keyed("daily", SLUG),
        "uni_shop": _keyed("daily", SHOP),
        "partner": """
        select 'i' || (o_custkey % 200) as "ITEM_ID",
               cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as varchar) as "CREATED",
               min(o_orderpriority) as "PARTNER"
        from orders group by 1, 2""",
        "partner_m": """
        select case u % 5 when 0 then 'alfa_cz' when 1 then 'beta.cz' when 2 then 'gama_sk' when 3 then 'delta.sk' else 'omega' end as shop,
               'i' || (u // 5) as "ITEM_ID", day as "CREATED", min(o_orderpriority) as "PARTNER"
        from (select *, o_custkey % 200 as u, cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as varchar) as day from orders)
        group by 1, 2, 3""",
        "stamp": """
        select min(case when "shopOrigin" <> '' then "shopOrigin" end) as shop, max(left(date, 16)) as aktualizace
        from raw where left(date, 16) = (select max(left(date, 16)) from raw)""",
        "every_day": """
        select cast(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), interval 1 day)) as date) as day
        from events""",
        **_reference(""),
        **_reference("_skip", strict=False),
        **_reference("_skipold", strict=False, oldest=True),
        **_reference("_v2", rule="gradual_v2"),
        **_reference("_v2lim", rule="gradual_v2", change=None, limit=12),
        **_reference(
            "_v1", rule="last_change", change=None, limit=VALID, common=None, history=25, points=29, cal=91
        ),
        **_reference("_slug", "uni_slug", SLUG, oldest=True),
        **_reference("_slugmin", "uni_slug", SLUG),
        **_reference("_shop", "uni_shop", SHOP),
        **_reference("_m", "unim", SHOP),
        "refs_daily_m": every_day.format(refs="refs_m"),
        "complete_m": _complete("unim", "refs_daily_m", SHOP),
        "refs_daily": every_day.format(refs="refs"),
        "refs_daily_slug": every_day.format(refs="refs_slugmin"),
        "refs_daily_shop": every_day.format(refs="refs_shop"),
        "complete": _complete("uni", "refs_daily", ITEM),
        "complete_slug": _complete("uni_slug", "refs_daily_slug", SLUG),
        "complete_shop": _complete("uni_shop", "refs_daily_shop", SHOP),
        **_history("_h", "complete"),
        **_history("_hall", "complete", recent=False),
        **_history("_hslug", "complete_slug", SLUG, like="%-11%"),
        **_history("_hslugwhole", "complete_slug", SLUG),
        **_history("_hshop", "complete_shop", SHOP, shop=True),
        **_audit("", "complete", 90),
        **_audit("_short", "complete", 12),
        **_audit("_slug", "complete_slug", 30, SLUG),
        **_audit("_older", "complete", 30, whole=False, skip4=False),
        **_audit("_m", "complete_m", 90, SHOP, by_shop=True),
        "stamps_m": "select shop, max(left(date, 16)) as aktualizace from rawm where date <> '' group by shop",
        "meta_m": _metadata("complete_m", SHOP, ALL, stamp=True),
        "recent_meta": f"""
        select * from complete, today where _timestamp >= cast(t - {RECENT} as timestamp)""",
        "meta": _metadata("complete", ITEM, RECENT),
        "meta_slug": _metadata("complete_slug", SLUG, RECENT),
        "meta_wide": _metadata("complete", ITEM, RECENT, wide=True),
        "meta_all": _metadata("complete", ITEM, ALL, stamp=True),
        "meta_wide_all": _metadata("complete", ITEM, ALL, wide=True, stamp=True),
        "documents_h": _document("_h"),
        "loads": 'select "itemId", max(_timestamp) as _timestamp from complete group by all',
        "first_load": "select uni.* from uni, today where date <= t - 10 or date is null",
        "second_load": """
        select uni.* replace (cast("currentPrice" - 10 as decimal(12,2)) as "currentPrice")
        from uni, today where date >= t - 15""",
        "upserted": """
        select * from second_load
        union all
        select f.* from first_load f
        where not exists (select 1 from second_load s where s."itemId" = f."itemId" and s.date = f.date)""",
        "inventory": _inventory({"unified": "uni", "raw": "raw", "second": "raw2"}),
        "published_meta": f"""
        select {_domain('shop')} as shop_id, slug, "itemId", "itemName", "itemImage" from meta_all
        where slug <> 'null' and slug in (
          select slug from meta_all, today where cast(_timestamp as date) > t - 1)""",
        "published_history": f"""
        select d.shop_id, d.slug, d.json from documents_wrapped d join loads using ("itemId"), today
        where cast(_timestamp as date) > t - 1""",
        "documents_wrapped": _document("_h", wrap=True),
    }
    return parts


def _metadata(rows: str, keys: str, days: int, wide: bool = False, stamp: bool = False) -> str:
    word = lambda c: f"case when trim(cast({c} as varchar)) = '' or {c} is null then 'null' else cast({c} as varchar) end as {c}"
    usable = "(\"itemId\" <> '' or slug <> '')" if wide else "\"itemId\" <> '' and slug <> '' and \"commonPrice\" is not null"
    names = ['"itemId"', '"itemName"', '"itemImage"', *(['"commonPrice"', '"minPrice"'] if wide else [])]
    lead = "shop, slug as \"itemUrl\", slug, shop || ':' || coalesce(slug, 'null') as pkey" if wide else "shop, slug"
    return f"""
    select {lead}, {', '.join(word(n) for n in names)} {', _timestamp' if stamp else ''}
    from (select {rows}.* from {rows}, today
          where _timestamp >= cast(t - {days} as timestamp) and {usable}
          qualify row_number() over (partition by {keys} order by date desc, slug, "itemName", "itemImage", shop) = 1)"""


def _inventory(tables: dict[str, str], before: str = "") -> str:
    return " union all ".join(
        f"""select '{name}' as name, '{name}' as "displayName", count(*) as "rowsCount", 'out' as bucket,
                   'out.{name}' as id, cast(max(_timestamp) as date) as "lastChange" from {source}"""
        for name, source in tables.items()
    )


def _bodies() -> dict[str, str]:
    at = "where date"
    bodies = {
        "recent_rows": f"select raw.* from raw, today where cast(_timestamp as date) >= t - {RECENT}",
        "recent_rows_by_date": f"select raw.* from raw, today where left(date, 10) >= cast(t - {RECENT} as varchar)",
        "unify_prices": "select * from scraped",
        "unify_prices_daily": "select * from daily",
        "unify_prices_keyed": "select * from uni",
        "item_count_check": f"""
        select o."shopOrigin", cast(r.date as date) as date, count(distinct "itemId") as "count_itemId_with_curPrice",
               count(distinct case when "originalPrice" <> '' then "itemId" end) as "count_itemId_with_origPrice"
        from (select distinct "shopOrigin" from raw, today where cast(_timestamp as date) >= t - {RECENT}) o
        left join raw r on true where "currentPrice" <> '' group by 1, 2""",
        "unify_prices_by_shop": "select * from unim",
        "unify_prices_used_goods": _unify("rawu", "day", extra='"usedGoods",'),
        "item_count_check_by_shop": f"""
        select r.shop, o."shopOrigin", cast(r.date as date) as date, count(distinct "itemId") as "count_itemId_with_curPrice",
               count(distinct case when "originalPrice" <> '' then "itemId" end) as "count_itemId_with_origPrice"
        from (select distinct shop, "shopOrigin" from rawm, today where cast(_timestamp as date) >= t - {RECENT}) o
        join rawm r on o.shop = r.shop where "currentPrice" <> '' group by 1, 2, 3""",
        "merge_feeds": f"""
        select *, md5(shop || "itemId") as p_key, {_pct('"currentPrice"', '"originalPrice"')} as "officialSale"
        from (select coalesce(a.shop, b.shop) as shop, coalesce(a."itemId", b."itemId") as "itemId",
                     coalesce(a."itemName", b."itemName") as "itemName", coalesce(a."itemUrl", b."itemUrl") as "itemUrl",
                     coalesce(a.slug, b.slug) as slug, least(a."currentPrice", b."currentPrice") as "currentPrice",
                     coalesce(b."originalPrice", a."originalPrice") as "originalPrice",
                     coalesce(a."itemImage", b."itemImage") as "itemImage", coalesce(a.date, b.date) as date,
                     coalesce(a."inStock", b."inStock") as "inStock", greatest(a._timestamp, b._timestamp) as _timestamp
              from uni a full join uni2 b on a."itemId" = b."itemId" and a.date = b.date)""",
        "merge_feeds_extra": f"""
        select *, md5(shop || "itemId") as p_key, {_pct('"currentPrice"', '"originalPrice"')} as "officialSale"
        from (select "itemId", date, coalesce(a.shop, b.shop, c.shop) as shop,
                     coalesce(a."itemName", b."itemName", c."itemName") as "itemName",
                     coalesce(a."itemUrl", b."itemUrl", c."itemUrl") as "itemUrl", coalesce(a.slug, b.slug, c.slug) as slug,
                     least(a."currentPrice", b."currentPrice", c."currentPrice") as "currentPrice",
                     coalesce(c."originalPrice", b."originalPrice", a."originalPrice") as "originalPrice",
                     coalesce(a."itemImage", b."itemImage", c."itemImage") as "itemImage",
                     coalesce(a."inStock", b."inStock", c."inStock") as "inStock",
                     coalesce(a."usedGoods", c."usedGoods") as "usedGoods",
                     greatest(a._timestamp, b._timestamp, c._timestamp) as _timestamp
              from (select *, 'click' as "usedGoods" from uni2) a
              full join uni3 b using ("itemId", date) full join uniu c using ("itemId", date))""",
        "active_items": "select * from items",
        "calendar_days": "select day as date from cal",
        "date_item_grid": 'select "itemId", day as date from items, cal',
        "price_points": "select * from points",
        "gap_fill": "select * exclude (price_trend) from dense",
        "price_trend": "select * from dense",
        "common_price": "select * from common",
        "price_changes": "select * from changes",
        "changes_since_up": "select * from since",
        "last_valid_change": "select * from valid",
        "last_valid_change_skip": "select * from valid_skip",
        "last_valid_change_skip_oldest": "select * from valid_skipold",
        "last_valid_change_v2": "select * from valid_v2",
        "last_change_v1": "select * from valid_v1",
        "min_price_30d": "select * from lowest",
        "ref_prices": "select * from refs",
        "ref_prices_skip": "select * from refs_skipold",
        "ref_prices_v2": "select * from refs_v2lim",
        "ref_prices_v1": "select * from refs_v1",
        "ref_prices_by_slug": "select * from refs_slug",
        "ref_prices_by_shop": "select * from refs_shop",
        "latest_batch": "select * from uni where _timestamp = (select max(_timestamp) from uni)",
        "latest_batch_by_shop": """
        select u.* from uni_shop u
        join (select shop, max(_timestamp) as m from uni_shop group by shop) s on u.shop = s.shop and u._timestamp = s.m""",
        "complete_prices": _complete("uni", "refs", ITEM, "u._timestamp = (select max(_timestamp) from uni)"),
        "complete_prices_window": _complete(
            "uni", "refs", ITEM, f"cast(u._timestamp as date) >= (select t - {ALL} from today)"
        ),
        "complete_prices_by_slug": _complete(
            "uni_slug", "refs_slugmin", SLUG, "u._timestamp = (select max(_timestamp) from uni_slug)", "'false' as \"usedGoods\","
        ),
        "suspicious_prices": f"""
        select shop, "itemId", "itemName", "itemUrl", slug, "currentPrice", "originalPrice", "officialSale", date, prev,
               cast(now as double) / nullif(cast(prev as double), 0) as narust
        from (select *, {_whole('"currentPrice"')} as now,
                     lag({_whole('"currentPrice"')} ignore nulls) over (partition by "itemId" order by date) as prev
              from uni where cast(date as timestamp) >= (select max(_timestamp) - interval 2 day from uni))
        where now / nullif(prev, 0) > 100 or now / nullif(prev, 0) < 0.01""",
        "suspicious_prices_by_slug": f"""
        select shop, "itemId", "itemName", "itemUrl", slug, "currentPrice", "originalPrice", "officialSale", date, prev,
               cast(now as double) / nullif(cast(prev as double), 0) as narust
        from (select *, {_whole('"currentPrice"')} as now,
                     lag({_whole('"currentPrice"')} ignore nulls) over (partition by {SLUG} order by date) as prev
              from uni_slug where cast(date as timestamp) >= (select max(_timestamp) - interval 2 day from uni_slug))
        where now / nullif(prev, 0) > 100 or now / nullif(prev, 0) < 0.01""",
        "latest_metadata": "select * from meta",
        "latest_metadata_by_slug": "select * from meta_slug",
        "latest_metadata_wide": "select * from meta_wide",
        "second_latest_load": "select lim as load_limit from limit_h",
        "recent_items_semi": 'select * from complete where "itemId" in (select "itemId" from included_h)',
        "dedupe_days": "select * from daily_hall",
        "item_date_range": "select * from range_hall",
        "fill_history": "select * from fill_hall",
        "history_changes": "select * from kept_hall",
        "last_attributes": "select * from attr_h",
        "price_history": "select * from documents_h",
        "price_history_by_slug": _document("_hslug", SLUG),
        "price_history_by_slug_whole": _document("_hslugwhole", SLUG),
        "price_history_by_shop": _document("_hshop", SHOP),
        "price_history_by_pkey": """
        select a.p_key, cast(to_json(list({'d': k.d, 'o': replace(coalesce(cast(k.o as varchar), ''), '.00', ''),
                                           'c': replace(coalesce(cast(k.c as varchar), ''), '.00', '')} order by k.d)) as varchar) as json
        from kept_hall k join attr_hall a using ("itemId") where a.p_key <> '' group by a.p_key""",
        "price_history_plain": f"""
        select k."itemId", a.slug, a.shop_id,
               cast(to_json(list({{'d': k.d, 'o': cast(k.o as double), 'c': cast(k.c as double)}} order by k.d)) as varchar) as json
        from kept_hall k join attr_hall a using ("itemId")
        where a.slug <> '' and k."itemId" in (select "itemId" from kept_hall, today where d > t - {RECENT})
        group by 1, 2, 3""",
        "price_history_plain_whole": """
        select k."itemId", a.slug, a.shop_id,
               cast(to_json(list({'d': k.d, 'o': cast(k.o as double), 'c': cast(k.c as double)} order by k.d)) as varchar) as json
        from kept_hall k join attr_hall a using ("itemId")
        where a.slug <> ''
        group by 1, 2, 3""",
        "shop_domain": f"""
        select shop, {_domain('shop')} as shop_id from (select shop from raw union select source from documents)""",
        "publish_metadata": "select * from published_meta",
        "publish_metadata_pkey": f"""
        select {_domain('shop')} as shop_id, "itemUrl" as slug, "itemId", "itemName", "itemImage", "commonPrice", "minPrice"
        from meta_wide_all where slug <> 'null' and "commonPrice" <> 'null' and pkey in (
          select pkey from meta_wide_all, today where cast(_timestamp as date) > t - 1)""",
        "publish_metadata_by_shop": f"""
        select {_domain('shop')} as shop_id, slug, "itemId", "itemName", "itemImage" from meta_m
        where slug <> 'null' and (shop, slug) in (
          select (shop, slug) from meta_m, today where cast(_timestamp as date) > t - 1)""",
        "publish_history": "select * from published_history",
        "publish_history_plain": """
        select d.shop_id, d.slug, d.json from documents_h d join loads using ("itemId"), today
        where cast(_timestamp as date) > t - 1""",
        "audit_stamp": "select * from stamp",
        "audit_snapshot": "select * from snap",
        "audit_window": "select * from win_short",
        "discount_mismatch": "select * from mism",
        "count_items": "select * from items_n",
        "count_discounted": "select * from disc_n",
        "count_false_discounts": "select * from false_n",
        "avg_claimed_discount": "select * from avg_shop",
        "avg_real_discount": "select * from avg_own",
        "false_discounts": f"""
        select * from pairs where typ_neshody <> '{MISMATCH_TYPES[4].format(name=OWN)}'""",
        "false_discounts_partner": f"""
        select p.*, s."PARTNER" as partnersky_prodej from pairs p
        left join (select * from partner where "CREATED" = (select cast(cast(max("CREATED") as date) - 1 as varchar) from partner)) s
          on p."itemId" = s."ITEM_ID" and cast(p.datum as varchar) = s."CREATED"
        where typ_neshody <> '{MISMATCH_TYPES[4].format(name=OWN)}'""",
        "false_discounts_partner_by_shop": f"""
        select p.*, s."PARTNER" as partnersky_prodej from pairs_m p
        left join (select *, max("CREATED") over (partition by shop) as last from partner_m) s
          on p.shop = s.shop and p."itemId" = s."ITEM_ID" and cast(p.datum as varchar) = s."CREATED"
             and s."CREATED" = cast(cast(s.last as date) - 1 as varchar)
        where typ_neshody <> '{MISMATCH_TYPES[4].format(name=OWN)}'""",
        "raised_ref_price_partner_by_shop": """
        select r.*, s."PARTNER" from raised_out_m r
        left join (select *, max("CREATED") over (partition by shop) as last from partner_m) s
          on r.shop = s.shop and r."itemId" = s."ITEM_ID" and cast(r."datum_zmeny_refCeny" as varchar) = s."CREATED"
             and s."CREATED" >= cast(cast(s.last as date) - 30 as varchar)""",
        "raised_ref_price": "select * from raised_out",
        "raised_ref_price_partner": """
        select r.*, s."PARTNER" from raised_out r
        left join (select * from partner where "CREATED" >= (select cast(cast(max("CREATED") as date) - 30 as varchar) from partner)) s
          on r."itemId" = s."ITEM_ID" and cast(r."datum_zmeny_refCeny" as varchar) = s."CREATED" """,
        "count_raised": 'select count(distinct "itemId") as "Produktu_s_navysenou_refCenou" from raised_out',
        "audit_dashboard": "select * from dash",
        "audit_dashboard_by_slug": "select * from dash_slug",
        "audit_dashboard_older": "select * from dash_older",
        "audit_stamp_by_shop": "select * from stamps_m",
        "audit_snapshot_by_shop": "select * from snap_m",
        "false_discounts_by_shop": f"select * from pairs_m where typ_neshody <> '{MISMATCH_TYPES[4].format(name=OWN)}'",
        "false_discounts_by_slug": f"select * from pairs_slug where typ_neshody <> '{MISMATCH_TYPES[4].format(name=OWN)}'",
        "false_discounts_older": "select * from pairs_older",
        "raised_ref_price_by_shop": "select * from raised_out_m",
        "raised_ref_price_by_slug": "select * from raised_out_slug",
        "audit_dashboard_by_shop": _dashboard_by_shop("_m", "rawm"),
        "dashboard_history": "select * from dash",
        "migrate_unified": f"""
        select * replace ({_pct('"currentPrice"', '"originalPrice"')} as "officialSale") from (select {UNIFIED} from uni)""",
        "migrate_reference": 'select "itemId", "commonPrice", "minPrice", date from complete',
        "migrate_complete": f"""
        select * replace ({_pct('"currentPrice"', '"originalPrice"')} as "officialSale")
        from (select {UNIFIED}, "commonPrice", "minPrice", "originalPriceHS", "newSale" from complete)""",
        "create_if_absent": "select * exclude (_timestamp) from raw",
        "upsert": "select * from upserted",
        "upsert_unpartitioned": "select * from upserted",
        "replace_table": "select * exclude (_timestamp) from uni",
        "upsert_whole": "select * from upserted",
        "upsert_unpartitioned_whole": "select * from upserted",
        "replace_table_whole": "select * exclude (_timestamp) from uni",
        "json_sink_roundtrip": "select shop_id, slug, json as document from published_history",
        "json_sink_metadata": """
        select shop_id, slug, cast(to_json({'itemId': "itemId", 'itemName': "itemName", 'itemImage': "itemImage"}) as varchar) as document
        from published_meta""",
        "table_inventory": "select * from inventory",
        "row_count_drift": """
        select n.name as "tableName", n.id as "tableId", case when b.name is null then 'no_previous'
                 when n."lastChange" <> t then 'missing_today' when n."lastChange" = b."lastChange" then 'already_checked'
                 else 'changed' end as state,
               case when state = 'changed' then b."rowsCount" end as yesterday,
               case when state = 'changed' then n."rowsCount" end as today,
               case when state = 'changed' then b."rowsCount" - n."rowsCount" end as diff,
               state = 'changed' and b."rowsCount" - n."rowsCount" < 1000 as flagged
        from inventory n join today on true
        left join (select 'unified' as name, count(*) as "rowsCount", cast(max(_timestamp) as date) as "lastChange"
                   from uni where cast(_timestamp as date) < (select t from today)
                   union all select name, "rowsCount", "lastChange" from inventory where name = 'raw') b on n.name = b.name""",
        "freshness": """
        select name, "lastChange", coalesce("lastChange" = t, false) as is_fresh
        from (select name, "lastChange" from inventory
              union all select 'stale', cast(max(_timestamp) as date) from raw
                        where cast(_timestamp as date) < (select t from today)), today""",
        "stream_unify": "select * from uni",
        "stream_unify_by_shop": "select * from unim",
    }
    return bodies | {name: bodies[same] for name, same in _OTHER_WAYS.items()}


#: Queries that reach the result of another one by other means: from stored loads, in buckets, day by day.
_OTHER_WAYS = {
    "audit_stamp_landed": "audit_stamp",
    "history_changes_incremental": "history_changes",
    "item_count_check_landed": "item_count_check",
    "latest_batch_by_shop_from_loads": "latest_batch_by_shop",
    "latest_batch_from_loads": "latest_batch",
    "price_history_incremental": "price_history",
    "stream_unify_by_day": "stream_unify",
    "suspicious_prices_from_loads": "suspicious_prices",
    "upsert_buckets": "upsert_unpartitioned_whole",
}


_WORD = re.compile(r"[a-z_0-9]+")


def _sql(body: str, parts: dict[str, str]) -> str:
    """`body` with the parts it reads, directly or through others, as CTEs."""
    needed: dict[str, None] = {}

    def need(text: str) -> None:
        for word in _WORD.findall(re.sub(r"\"[^\"]*\"|'[^']*'", " ", text)):
            if word in parts and word not in needed:
                # A word that only looks like a part costs an unused CTE.
                needed[word] = None
                need(parts[word])
                del needed[word]
                needed[word] = None

    need(body)
    ctes = ",\n".join(f"{name} as ({parts[name]})" for name in needed)
    return f"with {ctes}\n{body}" if needed else body


def oracle_sql() -> dict[str, str]:
    parts = _parts()
    return {name: _sql(body, parts) for name, body in sorted(_bodies().items())}
