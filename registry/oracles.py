"""SQL over the generic tables that gives each registered query's result.

Written for the checking engine and apart from the Spark code: it re-derives
the domain tables as common table expressions and computes with exact integers
where the engine's own division would be approximate.
"""

from __future__ import annotations

import re

from satlake.fixtures import MIXED_NETWORKS, PAYLOADS, UPSERT_SHIFT_DAYS, poll_slug
from satlake.sources.source_config import default_sources

AS_OF = "date '2001-11-04'"
SHIFT = str(UPSERT_SHIFT_DAYS)
INSERTED = "'2024-02-01 00:15:00'"

CTES: dict[str, str] = {}

# ---------------------------------------------------------------- domain tables

CTES["base"] = """
    select p_brand, cast(substr(p_brand, 7) as int) as b, r_regionkey as k, r_name, s_name, s_suppkey,
        cast(l_shipdate as date) as d, cast(l_quantity as decimal(20,8)) as q,
        cast(l_extendedprice as decimal(18,8)) as x
    from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
CTES["networks"] = """
    select r_name as slug, 'Net ' || r_name as name,
        case when r_regionkey = 4 then null else 'https://x.example/' || r_name end as explorer
    from region union all select 'native', 'Native', null"""
CTES["tokens"] = """
    select distinct p_brand as slug, 'Token ' || p_brand as name, p_brand as token_name,
        case when b % 5 = 0 then 'staking' when b % 5 = 1 then 'liquid_staking' when b % 5 = 2 then null
            else 'wrapped' end as type,
        case when b % 7 = 0 then true when b % 11 = 0 then null else false end as depegged
    from base"""
CTES["impls"] = """
    select distinct p_brand || '_' || r_name as slug, p_brand as token, r_name as network,
        case when k = 0 then 'native' when k in (1, 2, 3) then 'AFRICA' when b % 4 = 0 then null
            else 'AMERICA' end as network_origin,
        case when b % 3 = 0 then '18' else '8' end as token_decimals,
        case when k = 4 and b % 6 = 0 then null
            else (case when k = 2 then 'T' else '0x' end) || cast(b * 16 + k as varchar)
        end as token_address,
        b * 10 + k as bk
    from base"""
CTES["balances"] = """
    select d as date, p_brand || '_' || r_name as token_implementation,
        cast(sum(q) as decimal(20,8)) as balance,
        any_value(date_diff('day', date '1970-01-01', d) * 1000 + b * 10 + k) as id
    from base group by d, p_brand, r_name"""
CTES["reserves"] = """
    select d as date, cast(sum(q) as decimal(20,8)) as balance, r_name as reserve_network,
        p_brand || '_' || r_name as collateral_token,
        'Brand#' || cast(cast(floor((b - 1) / 5) as int) * 5 + 1 as varchar) || '_' || r_name
            as derivative_token,
        s_name as reserve_address, cast(s_suppkey * 100 + b as int) as reserve_id, b
    from base group by d, p_brand, b, r_name, s_name, s_suppkey"""
CTES["prices"] = """
    select d as date, p_brand as token_slug, 'Token ' || p_brand as token_name, max(x) as price_usd
    from base group by d, p_brand"""
CTES["reserve_impls"] = """
    select distinct reserve_id as id, reserve_address, reserve_network, derivative_token,
        collateral_token, cast(b as varchar) as tag,
        derivative_token || '__backedby__' || collateral_token || '__' || cast(b as varchar) as slug
    from reserves"""

# ---------------------------------------------------------------- views

CTES["star"] = """
    select i.slug as token_implementation, i.network, n.slug as network_slug, i.network_origin,
        n.name as network_name, t.slug as token_slug, t.name as token_name, i.token_address, n.explorer,
        t.type as token_type, t.depegged
    from impls i join networks n on n.slug = i.network join tokens t on t.slug = i.token"""
CTES["edges"] = """
    select t.slug || '_' || i.network_origin as parent, i.slug as child, t.slug as token_slug,
        t.token_name, t.type as token_type, i.network_origin as origin_network
    from impls i join tokens t on t.slug = i.token and not t.depegged
    where i.network_origin <> 'native' and ascii(i.token_address) between 48 and 57"""
CTES["recent"] = """
    select token_implementation, arg_max(balance, date) as balance, max(date) as date
    from balances group by 1"""
CTES["pegged_recent"] = """
    select r.* from recent r
    where token_implementation in
        (select i.slug from impls i join tokens t on t.slug = i.token where not t.depegged)"""
CTES["adjusted_now"] = """
    select token_implementation, date,
        cast(balance - coalesce((select sum(c.balance) from edges e join pegged_recent c
            on c.token_implementation = e.child where e.parent = r.token_implementation), 0)
            as decimal(38,8)) as balance
    from pegged_recent r"""
CTES["child_sums"] = """
    select e.parent, b.date, cast(sum(b.balance) as decimal(38,8)) as total
    from balances b join edges e on e.child = b.token_implementation group by 1, 2"""
CTES["adjusted"] = """
    select b.date, b.token_implementation,
        cast(b.balance - coalesce(c.total, 0) as decimal(20,8)) as balance, b.id
    from balances b left join child_sums c on c.parent = b.token_implementation and c.date = b.date"""
CTES["supply_now"] = """
    select a.token_implementation, a.balance, a.date, s.* exclude (token_implementation)
    from adjusted_now a join star s using (token_implementation)"""
CTES["network_totals"] = """
    select network_slug, network_name, cast(sum(balance) as decimal(38,8)) as total_balance,
        max(date) as latest_date,
        LISTED(token_slug) as tokens, LISTED(token_name) as token_names,
        LISTED(token_address) as token_addresses,
        rank() over (order by sum(balance) desc nulls first) as rank
    from supply_now group by 1, 2"""
CTES["token_totals"] = """
    select token_slug, token_name, cast(sum(balance) as decimal(38,8)) as total_balance,
        max(date) as latest_date,
        LISTED(network_slug) as networks, LISTED(network_name) as network_names,
        LISTED(token_address) as token_addresses,
        rank() over (order by sum(balance) desc nulls first) as rank
    from supply_now group by 1, 2"""
CTES["reserves_now"] = """
    select derivative_token as token_implementation, date, cast(sum(balance) as decimal(38,8)) as balance
    from reserves
    where (derivative_token, date) in (select (derivative_token, max(date)) from reserves group by derivative_token)
    group by reserve_network, collateral_token, derivative_token, date"""
CTES["reserves_adjusted"] = """
    select r.token_implementation, r.date,
        cast(r.balance - coalesce((select sum(c.balance) from edges e join reserves_now c
            on c.token_implementation = e.child where e.parent = r.token_implementation), 0)
            as decimal(38,8)) as balance
    from reserves_now r"""
CTES["anchors"] = f"""
    select * from (values ('daily', {AS_OF} - 1), ('weekly', {AS_OF} - 7),
        ('monthly', cast({AS_OF} - interval 1 month as date)),
        ('yearly', cast({AS_OF} - interval 1 year as date))) as a(period, date)"""
CTES["past"] = """
    select b.token_implementation, b.balance as past_balance, a.period
    from balances b join anchors a on a.date = b.date"""

DESCRIBED = """network, network_slug, network_origin, network_name, token_slug, token_name,
    token_address, explorer"""

ORACLE_BODIES: dict[str, str] = {}
O = ORACLE_BODIES

O["helper_current_supplies_raw"] = f"""
    select token_implementation, balance, date, {DESCRIBED},
        rank() over (order by balance desc nulls first) as rank
    from recent join star using (token_implementation)"""
O["helper_dependencies_bridges"] = """
    select token_slug, parent as token_implementation, token_name, token_type, origin_network,
        string_agg(child, ',' order by child) as tokens_to_subtract
    from edges group by all"""
O["helper_reserves_summed"] = """
    select date, derivative_token, cast(sum(balance) as decimal(38,8)) as total_balance, collateral_token
    from reserves group by date, derivative_token, collateral_token, reserve_network"""
O["helper_token_balances_adjusted"] = """
    select *, strftime(date + 1, '%Y-%m-%d') || ' 00:15:00' as created_at from adjusted"""
O["current_supplies_by_tokenimpl"] = f"""
    select token_implementation, balance, date, {DESCRIBED},
        rank() over (order by balance desc nulls first) as rank from supply_now"""
O["current_supplies_by_network"] = "select * from network_totals"
O["current_supplies_by_tokenproject"] = "select * from token_totals"
O["current_reserves_by_tokenimpl"] = f"""
    select token_implementation, balance, date, {DESCRIBED},
        rank() over (order by balance desc nulls first) as rank
    from reserves_adjusted join star using (token_implementation)"""
O["current_by_tokenimpl"] = f"""
    select s.token_implementation, r.balance as supply_balance, h.balance as reserve_balance,
        cast(r.balance - coalesce(h.balance, 0) as decimal(38,8)) as balance_difference,
        case when h.date > r.date then h.date else r.date end as latest_date, {DESCRIBED},
        rank() over (order by r.balance desc nulls first) as rank
    from star s join recent r on r.token_implementation = s.token_implementation
    left join reserves_adjusted h on h.token_implementation = s.token_implementation"""
O["historical_supplies_by_network"] = """
    select network_slug, network_name, cast(sum(balance) as decimal(38,8)) as total_balance, date,
        LISTED(token_slug) as tokens, LISTED(token_name) as token_names
    from adjusted join star using (token_implementation)
    where not depegged and token_type <> 'staking' group by network_slug, network_name, date"""
for _key, _test in {
    "tokenproject": "<> 'staking'",
    "staking": "= 'staking'",
    "liquidstaking": "= 'liquid_staking'",
}.items():
    O[f"historical_supplies_by_{_key}"] = f"""
    select *, rank() over (partition by date order by total_balance desc nulls first) as rank from (
        select token_slug, token_name, cast(sum(balance) as decimal(38,8)) as total_balance, date,
            LISTED(network_slug) as networks, LISTED(network_name) as network_names,
            LISTED(token_address) as token_addresses
        from adjusted join star using (token_implementation)
        where not depegged and token_type {_test} group by token_slug, token_name, date)"""
O["historical_supplies_by_tokenimpl"] = """
    select s.network_name, s.network_slug, s.token_name, s.network_slug || '_' || s.token_slug as identifier,
        a.balance as amount, a.date, s.token_slug as infra_slug,
        coalesce(n.rank, 0) as network_rank, coalesce(t.rank, 0) as project_rank
    from adjusted a join star s using (token_implementation)
    left join network_totals n on n.network_slug = s.network_slug
    left join token_totals t on t.token_slug = s.token_slug
    where not s.depegged"""

# Percent with two decimals, half away from zero, in whole hundred-millionths.
def _units(expr: str) -> str:
    return f"cast(cast({expr} as decimal(38,8)) * 100000000 as hugeint)"


def _percent(recent: str, past: str) -> str:
    r, p = _units(recent), _units(past)
    hundredths = (
        f"(case when {r} < {p} then -1 else 1 end)"
        f" * ((20000 * abs({r} - {p}) + abs({p})) // (2 * abs({p})))"
    )
    exact = f"cast({hundredths} as decimal(30,0)) * cast(0.01 as decimal(3,2))"
    return f"cast(case when {past} is null or {past} = 0 then 0 else {exact} end as decimal(38,2))"


O["top_gainers_by_tokenimpl"] = f"""
    select *, rank() over (partition by period order by percent_change desc nulls first) as rank from (
        select r.token_implementation, r.balance as recent_balance, p.past_balance,
            {_percent('r.balance', 'p.past_balance')} as percent_change, p.period, r.date, {DESCRIBED}
        from pegged_recent r left join past p on p.token_implementation = r.token_implementation
        join star s on s.token_implementation = r.token_implementation)"""
O["top_gainers_by_tokenimpl_absolute"] = f"""
    select *, rank() over (partition by period order by supply_change desc nulls first) as rank from (
        select r.token_implementation, r.balance as recent_balance,
            cast(coalesce(p.past_balance, 0) as decimal(20,8)) as past_balance,
            cast(r.balance - coalesce(p.past_balance, 0) as decimal(38,8)) as supply_change,
            a.period, r.date, {DESCRIBED}
        from pegged_recent r join star s on s.token_implementation = r.token_implementation
        cross join anchors a
        left join past p on p.token_implementation = r.token_implementation and p.period = a.period)"""
O["current_prices"] = """
    select token_slug, arg_max(token_name, date) as token_name, arg_max(price_usd, date) as price_usd,
        max(date) as most_recent_date
    from prices group by token_slug"""

# ---------------------------------------------------------------- scans, sources, sinks

O["scan_catalog"] = """
    select 'networks' as table_name, count(*) as n, min(slug) as lowest, max(slug) as highest from networks
    union all select 'tokens', count(*), min(slug), max(slug) from tokens
    union all select 'token_implementations', count(*), min(slug), max(slug) from impls
    union all select 'reserve_implementations', count(*), min(slug), max(slug) from reserve_impls
    union all select 'token_balances', count(*), min(token_implementation), max(token_implementation)
        from balances
    union all select 'reserve_balances', count(*), min(reserve_address), max(reserve_address) from reserves
    union all select 'price', count(*), min(token_slug), max(token_slug) from prices"""
O["scan_impl_by_network"] = """
    select slug, token_address, token_decimals,
        '["obj' || bk || '_0","obj' || bk || '_1","obj' || bk || '_2"]' as reserve_implementations
    from impls where network = 'EUROPE'"""
O["network_config"] = """
    select network, 'token' as kind, slug, token_address as address, token_decimals as decimals,
        cast(null as int) as id, cast(null as varchar) as collateral, cast(null as varchar) as derivative
    from impls
    union all select r.reserve_network, 'reserve', r.slug, r.reserve_address, c.token_decimals, r.id,
        c.slug, d.slug
    from reserve_impls r left join impls c on c.slug = r.collateral_token
    left join impls d on d.slug = r.derivative_token"""

CTES["block_outputs"] = """
    select event_id // 10 as block_height, 'bh' || cast(event_id // 10 as varchar) as block_hash,
        'tx' || cast(event_id as varchar) as txid, 0 as vout_index, cast(value as decimal(16,8)) as value,
        '0014ab' as script_hex, event_id
    from events
    union all select event_id // 10, 'bh' || cast(event_id // 10 as varchar),
        'tx' || cast(event_id as varchar), 1, cast(0 as decimal(16,8)),
        case when event_type = 'purchase' then '6a4762626e31ff' else '6a24aa21a9ed' end, event_id
    from events"""
CTES["block_times"] = """
    select event_id // 10 as block_height, max(cast(floor(epoch(ts)) as bigint)) as time, count(*) as n
    from events group by 1"""
CTES["hits"] = """
    select o.block_height, o.block_hash, o.txid, o.value, o.script_hex,
        strftime(make_timestamp(t.time * 1000000), '%Y-%m-%dT%H:%M:%S') as timestamp, event_id
    from block_outputs o join block_times t using (block_height)
    where script_hex like '6a4762626e31%'"""
O["scan_blocks"] = """
    select block_height as height, 'bh' || cast(block_height as varchar) as hash, time,
        cast(n as int) as transactions from block_times where block_height >= 6"""
O["skipped_blocks"] = """
    select block_height as height, case when block_height % 7 = 3 then 'absent' else 'malformed' end as reason
    from block_times where block_height % 7 = 3 or block_height % 11 = 5"""
O["missing_transactions"] = """
    select block_height, block_hash, txid, 'no_transaction' as reason from hits where block_height % 11 = 5"""
O["staking_outputs"] = "select * exclude (event_id) from hits"
O["staking_outputs_by_prefix"] = """
    select o.block_height, o.block_hash, o.txid, o.value, o.script_hex,
        strftime(make_timestamp(t.time * 1000000), '%Y-%m-%dT%H:%M:%S') as timestamp, p.prefix, p.project
    from block_outputs o join block_times t using (block_height)
    join (values ('6a', 'data'), ('6a4762626e31', 'staking'), ('6a24aa21a9ed', 'commitment'), ('0014', 'key'))
        p(prefix, project) on starts_with(o.script_hex, p.prefix)
    qualify row_number() over (partition by o.txid, o.vout_index order by length(p.prefix) desc) = 1"""
CTES["finished"] = """
    select block_height - block_height % 3 as first, block_height - block_height % 3 + 2 as last from hits"""
CTES["finished_heights"] = "select distinct unnest(range(first, last + 1)) as height from finished"
O["covered_intervals"] = """
    select min(height) as first, max(height) as last
    from (select height, height - row_number() over (order by height) as island from finished_heights) group by island"""
O["scan_uncovered"] = """
    select block_height as height, 'bh' || cast(block_height as varchar) as hash
    from block_times where block_height not in (select height from finished_heights)"""
O["sink_csv"] = """
    select cast(block_height as varchar) as block_height, block_hash, txid, cast(value as varchar) as value,
        script_hex, timestamp from hits"""
O["scan_csv_dict"] = O["staking_outputs"]
O["resume_checkpoint"] = O["staking_outputs"]
O["stream_blocks"] = O["staking_outputs"]
O["staking_values"] = """
    select h.block_height, h.txid, o.value from hits h
    join block_outputs o on o.txid = h.txid and o.block_hash = h.block_hash and o.vout_index = 0"""
O["staking_outputs_onepass"] = O["staking_values"]
O["join_tx_lookup"] = """
    select h.block_height, h.block_hash, h.txid, o.value from hits h
    join block_outputs o on o.txid = h.txid and o.block_hash = h.block_hash and o.vout_index = 0"""
O["distinct_first_txid"] = """
    select txid, block_height, block_hash, value from block_outputs where vout_index = 0"""

CTES["observed"] = """
    select event_id as seq, 'Brand#' || cast(user_id % 25 + 1 as varchar) || '_AFRICA' as token_implementation,
        ts, cast(ts as date) as day, event_type = 'error' as is_final,
        cast(round(value * 100) as bigint) as u
    from events"""
O["observation_source"] = """
    select seq, token_implementation, strftime(ts, '%Y-%m-%d %H:%M:%S') as observed_at,
        day as effective_day, is_final,
        '{"result":"0x' || lower(to_hex(u * 1000000)) || '"}' as payload, 200 as status
    from observed"""
CTES["final_days"] = """
    select token_implementation, day as date,
        cast(arg_max(u, (is_final, ts, seq)) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as balance
    from observed group by 1, 2"""
O["finalize_day"] = """
    select date, token_implementation, cast(balance as decimal(20,8)) as balance from final_days"""
O["daily_last_value"] = f"""
    select day as date, token_implementation,
        cast(cast(arg_max(u, (ts, seq)) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as decimal(20,8))
            as balance,
        {INSERTED} as created_at
    from observed group by 1, 2"""
CTES["merged_balances"] = f"""
    select coalesce(b.date, f.date) as date,
        coalesce(b.token_implementation, f.token_implementation) as token_implementation,
        cast(coalesce(f.balance, b.balance) as decimal(20,8)) as balance,
        case when b.id is null then {INSERTED}
            else strftime(b.date + 1, '%Y-%m-%d') || ' 00:15:00' end as created_at,
        b.id
    from balances b full join
        (select token_implementation, date - {SHIFT} as date, balance from final_days) f
        on f.token_implementation = b.token_implementation and f.date = b.date"""
O["upsert_token_balances"] = "select * from merged_balances"
O["stream_upsert"] = "select * exclude (id) from merged_balances"
O["stream_latest_state"] = """
    select token_implementation, cast(arg_max(balance, date) as decimal(20,8)) as balance, max(date) as date
    from final_days group by 1"""
O["stream_latest_store"] = O["stream_latest_state"]

# ---------------------------------------------------------------- polls and decoders

CTES["polls"] = """
    select *, lpad(lower(to_hex(n)), 64, '0') as hx,
        lpad(lower(to_hex(n % 2100000000000000)), 64, '0') as hs from (
        select event_id as seq, event_type, user_id, ts, cast(ts as date) as day, event_type = 'error' as is_final,
            case when event_type = 'signup' and user_id % 10 = 0 then 500 else 200 end as status,
            cast(user_id % 25 + 1 as int) as b,
            cast(event_id % 5 as int) as k, r_name,
            cast(round(value * 100) as bigint) as u,
            event_type = 'click' and user_id % 7 = 0 as bad,
            '{"error":{"code":-32000}}' as e,
            case when event_type = 'signup' and user_id % 4 = 1 then 0
                else cast(round(value * 100) as bigint) * 10000000000000 + (event_id % 1000003) * 1234567 end as n
        from events join region on r_regionkey = event_id % 5)"""
CTES["incoming_reserves"] = f"""
    select seq, day - {SHIFT} as date, cast(u as decimal(18,0)) * cast(0.01 as decimal(3,2)) as balance,
        m.id as reserve_id, m.reserve_network, m.collateral_token, m.reserve_address,
        case when event_type <> 'click' then m.derivative_token end as derivative_token
    from polls join (select *, row_number() over (partition by collateral_token order by id) as nth
        from reserve_impls) m
        on m.nth = 1 and m.collateral_token = 'Brand#' || cast(polls.b as varchar) || '_' || r_name"""
CTES["incoming_reserve_keys"] = """
    select date, reserve_network, reserve_address, collateral_token, derivative_token,
        arg_max(balance, seq) as balance, arg_min(reserve_id, seq) as reserve_id
    from incoming_reserves where derivative_token is not null group by all"""
O["upsert_reserve_balances"] = f"""
    select coalesce(b.date, f.date) as date,
        cast(coalesce(f.balance, b.balance) as decimal(20,8)) as balance,
        case when b.date is null then {INSERTED}
            else strftime(b.date + 1, '%Y-%m-%d') || ' 00:15:00' end as created_at,
        coalesce(b.reserve_id, f.reserve_id) as reserve_implementation_id,
        coalesce(b.reserve_network, f.reserve_network) as reserve_network,
        coalesce(b.collateral_token, f.collateral_token) as collateral_token,
        coalesce(b.derivative_token, f.derivative_token) as derivative_token,
        coalesce(b.reserve_address, f.reserve_address) as reserve_address
    from reserves b full join incoming_reserve_keys f
        on f.date = b.date and f.reserve_network = b.reserve_network
        and f.reserve_address = b.reserve_address and f.collateral_token = b.collateral_token
        and f.derivative_token = b.derivative_token
    union all select date, cast(balance as decimal(20,8)), {INSERTED}, reserve_id, reserve_network,
        collateral_token, derivative_token, reserve_address
    from incoming_reserves where derivative_token is null"""

def _hex(path: str) -> str:
    text = f"regexp_replace(json_extract_string(payload, '{path}'), '^0x(0701)?', '')"
    return f"cast('0x0' || ltrim({text}, '0') as hugeint)"


def _int(path: str) -> str:
    return f"cast(json_extract_string(payload, '{path}') as hugeint)"


def _scaled(number: str, places: str) -> str:
    """number / 10**places with eight decimals, half up, in whole units of 10^-8."""
    up = f"({number}) * cast(pow(10, greatest(8 - {places}, 0)) as hugeint)"
    down = f"cast(pow(10, greatest({places} - 8, 0)) as hugeint)"
    unit = f"(({up} + {down} // 2) // {down})"
    return f"cast({unit} as decimal(28,0)) * cast(0.00000001 as decimal(9,8))"


_CONFIG = "cast(token_decimals as int)"
# decoder -> (number, its places or None when the number is a decimal already,
#             checks the status, needs an address, needs decimals, no result reason)
_READ: dict[str, tuple[str, str | None, bool, bool, bool]] = {
    "evm_hex": (_hex("$.result"), _CONFIG, False, True, True),
    "evm_int": (_int("$.result"), _CONFIG, False, True, True),
    "evm_hex_default18": (_hex("$.result"), _CONFIG, False, True, False),
    "evm_hex_any_places": (_hex("$.result"), _CONFIG, False, True, True),
    "native_cap": (
        "21000000 * cast(1000000000000000000 as hugeint) - " + _hex("$.result"), "18", False, True, False
    ),
    "unminted_cap": ("21000000 * cast(100000000 as hugeint) - " + _hex("$.result"), "8", False, True, False),
    "explorer_json": (_int("$.total_supply"), _CONFIG, True, True, True),
    "explorer_self": (_int("$.total_supply"), "18", True, True, True),
    "token_amount": (_int("$.result.value.amount"), "9", False, True, False),
    "felt_hex": (_hex("$.result[0]"), _CONFIG, False, True, True),
    "clarity_hex": (_hex("$.result"), _CONFIG, True, True, True),
    "coin_value": (_int("$.result.value"), _CONFIG, False, False, True),
    "object_or_number": (
        "cast(coalesce(regexp_extract(payload, ':([0-9.]+)', 1), '') || regexp_extract(payload, '^[0-9]+$')"
        " as decimal(20,8))", None, True, False, False,
    ),
    "metrics_text": ("cast(regexp_extract(payload, 'ledger_total_supply ([0-9]+)', 1) as hugeint)", "8", True, True, False),
    "asset_string": ("cast(regexp_extract(payload, '\"Tok[0-9]+\":.\"supply\":\"([0-9.]+)', 1) as decimal(20,8))", None, True, False, False),
    "capacity_or_series": (
        "case when payload like '%series%' then cast(regexp_extract(payload, '\"d1\",([0-9.]+)', 1) as decimal(20,8))"
        " else cast(cast(json_extract_string(payload, '$.networkcapacity') as decimal(28,0))"
        " * cast(0.00000001 as decimal(9,8)) as decimal(20,8)) end", None, True, False, False,
    ),
    "bare_sats": ("cast(payload as hugeint)", "8", True, True, False),
    "active_tvl": (_int("$.data.active_tvl"), "8", True, False, False),
    "staked_amount": (_int("$.data.stakedBTCAmount"), "8", True, False, False),
    "utxo_sums": (
        _int("$.chain_stats.funded_txo_sum") + " - " + _int("$.chain_stats.spent_txo_sum"), "8", True, False, False
    ),
}
_KEEP_ZERO = {
    "evm_hex_default18", "evm_hex_any_places", "native_cap", "unminted_cap", "explorer_self", "token_amount",
    "coin_value", "object_or_number", "staked_amount", "utxo_sums",
}
# Reason of an error reply: the decoders of whole texts find text that is no number.
_BAD = {"bare_sats": "not_a_number", "clarity_hex": "not_okay"}
_FORMED = ("evm_hex_default18", "unminted_cap", "clarity_hex")


def _decoded(
    decoder: str, bad_forms: str | None = None, symbols: bool = True, wrong: str | None = None
) -> str:
    """seq, token_implementation, effective_day, is_final, balance, reason of all events."""
    number, places, status, address, decimals = _READ[decoder]
    if bad_forms is None:
        bad_forms = "false"
    balance = _scaled("number", places) if places else "number"
    rules = ["when known is null then 'unknown_implementation'"]
    if wrong:
        rules.append(f"when {wrong} then 'wrong_network'")
    known = "i.slug"
    if decoder == "asset_string" and symbols:
        known = "'Proj-Tok' || substr(i.token, 7) || '_' || i.network"
    if address:
        rules.append("when token_address is null then 'no_address'")
    rules.append(f"when {bad_forms} then 'bad_address'")
    if decimals:
        rules.append("when token_decimals is null then 'no_decimals'")
    if status:
        rules.append("when status <> 200 then 'bad_status'")
    rules.append(f"when bad then '{_BAD.get(decoder, 'no_result')}'")
    if decoder not in _KEEP_ZERO:
        rules.append("when number = 0 then 'zero_supply'")
    sql = f"""
    select seq, token_implementation, day as effective_day, ts, is_final, reason,
        case when reason is null then cast({balance} as decimal(20,8)) end as balance
    from (select *, case {' '.join(rules)} end as reason
        from (select *, case when not bad then {number} end as number
            from (select p.*, {poll_slug(decoder)} as token_implementation, {PAYLOADS[decoder]} as payload,
                    i.token_address, i.token_decimals, i.slug as known
                from polls p left join impls i on {known} = {poll_slug(decoder)})))"""
    if decoder not in _OTHER_PLACE:
        return sql
    table, key, reason = _OTHER_PLACE[decoder]
    served = f"d.reason = '{reason}' and o.balance is not null"
    return f"""
    select d.* replace (
        case when {served} then cast(o.balance as decimal(20,8)) else d.balance end as balance,
        case when {served} then null else d.reason end as reason)
    from ({sql}) d left join {table} o on o.{key} = d.token_implementation"""


# Second places to look: table, its key, and the reason of the rows that are looked up there.
_OTHER_PLACE = {
    "explorer_self": ("held_fallback", "derivative_token", "no_address"),
    "coin_value": ("object_values", "slug", "no_result"),
}


for _decoder in _READ:
    _forms = None
    if _decoder in _FORMED:
        # The plain region keeps its short address, which has no valid form.
        _forms = "r_name = 'MIDDLE EAST'"
    O[f"decode_{_decoder}"] = (
        f"select seq, token_implementation, balance, reason from ({_decoded(_decoder, _forms)})"
    )

O["agg_sum_by_derivative"] = f"""
    select token_implementation, effective_day, cast(sum(balance) as decimal(38,8)) as balance
    from ({_decoded('utxo_sums')}) where reason is null group by 1, 2"""

_SOURCES = default_sources()
_mixed_parts = []
for _i, (_source, _network, _decoder, *_rest) in enumerate(_SOURCES):
    _only = _source == "Hyperliquid"
    _mixed_parts.append((_decoder, _i, _source, _only))
_by_decoder: dict[str, list[tuple[int, str]]] = {}
for _decoder, _i, _source, _only in _mixed_parts:
    _by_decoder.setdefault(_decoder, []).append((_i, _source))
_unions = []
for _decoder, _members in _by_decoder.items():
    _names = " ".join(f"when {i} then '{s}'" for i, s in _members)
    _ids = ", ".join(str(i) for i, _ in _members)
    _forms = "true" if _decoder in _FORMED else None
    _label = {"unminted_cap": "'unsupported_token'", "staked_amount": "'unknown_implementation'"}.get(
        _decoder, "reason"
    )
    _wrong = " or ".join(
        f"(seq % {len(_SOURCES)} = {i} and r_name <> '{MIXED_NETWORKS[s]}')" for i, s in _members if s in MIXED_NETWORKS
    )
    _slug = "replace ('Core-stakedBTC_staking' as token_implementation)" if _decoder == "staked_amount" else ""
    _unions.append(
        f"""select * exclude (reason) {_slug}, case seq % {len(_SOURCES)} {_names} end as source, {_label} as reason
        from ({_decoded(_decoder, _forms, False, _wrong)}) where seq % {len(_SOURCES)} in ({_ids})"""
    )
CTES["mixed"] = " union all ".join(_unions)
O["decode_observations"] = """
    select seq, source, token_implementation, effective_day, is_final, balance from mixed where reason is null"""
O["dead_letter"] = "select seq, source, token_implementation, reason from mixed where reason is not null"

CTES["polled_days"] = f"""
    select token_implementation, effective_day - {SHIFT} as date,
        arg_max(balance, (is_final, ts, seq)) as balance
    from mixed where reason is null group by 1, 2"""
O["poll_to_balances"] = f"""
    select coalesce(b.date, f.date) as date,
        coalesce(b.token_implementation, f.token_implementation) as token_implementation,
        cast(coalesce(f.balance, b.balance) as decimal(20,8)) as balance,
        case when b.id is null then {INSERTED}
            else strftime(b.date + 1, '%Y-%m-%d') || ' 00:15:00' end as created_at,
        b.id
    from balances b full join polled_days f
        on f.token_implementation = b.token_implementation and f.date = b.date"""
O["replayed_letters"] = O["poll_to_balances"]
O["decode_evm_reserve"] = f"""
    select seq, reserve_implementation_id, reserve_address, collateral_token, derivative_token, reason,
        case when reason is null then cast({_scaled('number', _CONFIG)} as decimal(20,8)) end as balance
    from (select *, case when collateral_token is null then 'no_collateral_token'
            when token_address is null then 'no_address' when bad then 'no_result'
            when number = 0 then 'zero_supply' end as reason
        from (select p.seq, p.bad, p.n as number, p.rid as reserve_implementation_id, r.reserve_address,
                r.collateral_token, r.derivative_token, i.token_address, i.token_decimals
            from (select *, cast((seq % (select max(s_suppkey) from supplier) + 1) * 100 + b as int) as rid
                from polls) p
            left join reserve_impls r on r.id = p.rid left join impls i on i.slug = r.collateral_token))"""
CTES["polled_reserves"] = f"""
    select p.day - {SHIFT} as date, m.reserve_network, m.reserve_address, m.collateral_token, m.derivative_token,
        arg_max(d.balance, d.seq) as balance, arg_min(m.id, d.seq) as reserve_id
    from ({O['decode_evm_reserve']}) d join polls p on p.seq = d.seq
    join reserve_impls m on m.id = d.reserve_implementation_id
    where d.reason is null and m.reserve_network in ('AFRICA', 'ASIA', 'EUROPE') group by 1, 2, 3, 4, 5"""
O["poll_to_reserves"] = f"""
    select coalesce(b.date, f.date) as date,
        cast(coalesce(f.balance, b.balance) as decimal(20,8)) as balance,
        case when b.date is null then {INSERTED}
            else strftime(b.date + 1, '%Y-%m-%d') || ' 00:15:00' end as created_at,
        coalesce(b.reserve_id, f.reserve_id) as reserve_implementation_id,
        coalesce(b.reserve_network, f.reserve_network) as reserve_network,
        coalesce(b.collateral_token, f.collateral_token) as collateral_token,
        coalesce(b.derivative_token, f.derivative_token) as derivative_token,
        coalesce(b.reserve_address, f.reserve_address) as reserve_address
    from reserves b full join polled_reserves f
        on f.date = b.date and f.reserve_network = b.reserve_network
        and f.reserve_address = b.reserve_address and f.collateral_token = b.collateral_token
        and f.derivative_token = b.derivative_token"""
_names = ", ".join(f"'{s[0]}'" for s in _SOURCES)
O["assign_day"] = f"""
    select seq, source, invocation, day,
        case when source = 'Bitlayer' then cast(epoch(day::timestamp) as bigint)
            when day = seen then cast(floor(epoch(ts)) as bigint)
            else cast(epoch(day::timestamp) as bigint) + 86399 end as block_second
    from (select *, case when invocation = 'incremental' then seen
            when source in ('Sui', 'Tron', 'Hyperliquid') and invocation <> 'final' then seen
            else seen - 1 end as day
        from (select seq, ts, day as seen, ([{_names}])[seq % {len(_SOURCES)} + 1] as source,
                case event_type when 'view' then 'incremental' when 'error' then 'final'
                    else event_type end as invocation
            from polls))"""
O["scan_backed_reserves"] = """
    select derivative_token, reserve_address from reserve_impls
    where reserve_network = 'AFRICA' and derivative_token in ('Brand#1_AFRICA', 'Brand#11_AFRICA')"""
O["sui_fallback_objects"] = """
    select slug, arg_min(object_id, i) as object_id,
        arg_min(SCALED, i) as balance
    from (select b * 10 + k as bk, seq % 3 as i,
            'obj' || cast(b * 10 + k as varchar) || '_' || cast(seq % 3 as varchar) as object_id,
            cast(max(n) as hugeint) as number
        from polls group by all having not (any_value(seq % 3) = 0 and any_value(b) % 2 = 0)
            and not (any_value(seq % 3) = 1 and any_value(b) % 3 = 0)) o
    join impls using (bk) where number <> 0 group by slug""".replace(
    "SCALED", f"cast({_scaled('number', _CONFIG)} as decimal(20,8))"
)

# ---------------------------------------------------------------- joins

O["join_star_inner"] = f"""
    select date, token_implementation, balance, {DESCRIBED} from balances join star using (token_implementation)"""
O["join_left_dims"] = """
    select b.date, b.token_implementation, b.balance, o.name as origin_name, t.rank as origin_rank
    from balances b left join impls i on i.slug = b.token_implementation
    left join networks o on o.slug = i.network_origin
    left join network_totals t on t.network_slug = i.network_origin"""
O["join_left_adjust"] = """
    select b.date, b.token_implementation, b.balance, c.total as total_to_subtract
    from balances b left join child_sums c on c.parent = b.token_implementation and c.date = b.date"""
O["join_left_adjust_current"] = """
    select token_implementation, balance, date,
        cast((select sum(c.balance) from edges e join pegged_recent c on c.token_implementation = e.child
            where e.parent = r.token_implementation) as decimal(38,8)) as total_to_subtract
    from pegged_recent r"""
O["join_left_reserve"] = """
    select r.token_implementation, r.balance, r.date, h.balance as reserve_balance
    from recent r left join reserves_now h using (token_implementation)"""
O["join_left_past"] = """
    select r.token_implementation, r.balance, r.date, p.past_balance, p.period
    from pegged_recent r left join past p using (token_implementation)"""
O["join_array_any"] = """
    select d.parent, b.token_implementation as child, b.date, b.balance
    from (select parent, list(child) as children from edges group by parent) d
    join balances b on list_contains(d.children, b.token_implementation)"""
O["join_cross_periods"] = """
    select i.slug as token_implementation, a.period, a.date from impls i cross join anchors a"""
O["join_correlated_max"] = """
    select derivative_token, date, reserve_address, collateral_token, balance from reserves r
    where date = (select max(date) from reserves m where m.derivative_token = r.derivative_token)"""
O["asof_block"] = """
    with chain as (select 'chain_' || event_type as network, max(event_id) as height,
            cast(floor(epoch(ts)) as bigint) as ts from events group by 1, 3),
        asked as (select event_id as request,
            case when event_type = 'view' then 'chain_click' else 'chain_view' end as network,
            cast(floor(epoch(ts)) as bigint) as ts from events)
    select a.request, a.network, a.ts, c.height as block_number, c.ts as block_ts
    from asked a asof left join chain c on a.network = c.network and a.ts >= c.ts"""
O["join_reserve_to_impl"] = """
    select i.derivative_token, arg_max(b.balance, (b.date, -i.id)) as balance, max(b.date) as date
    from reserves b join reserve_impls i on i.id = b.reserve_id group by 1"""

# ---------------------------------------------------------------- aggregates, windows

O["agg_sum"] = """
    select collateral_token, reserve_network, cast(sum(balance) as decimal(38,8)) as total_balance
    from reserves group by 1, 2"""
O["agg_max_date"] = "select token_implementation, max(date) as latest_date from balances group by 1"
O["agg_array"] = """
    select token, network_origin, string_agg(slug, ',' order by slug) as slugs from impls group by 1, 2"""
O["agg_array_distinct"] = """
    select date, network_slug, LISTED(token_address) as token_addresses, LISTED(explorer) as explorers
    from balances join star using (token_implementation) group by 1, 2"""
O["rank_global"] = """
    select date, token_implementation, balance, rank() over (order by balance desc nulls first) as rank
    from balances"""
O["rank_over_aggregate"] = """
    select reserve_address, cast(sum(balance) as decimal(38,8)) as total_balance,
        rank() over (order by sum(balance) desc) as rank from reserves group by 1"""
O["rank_in_partition"] = """
    select date, token_implementation, balance,
        rank() over (partition by date order by balance desc nulls first) as rank from balances"""
O["rank_in_period"] = """
    select token_implementation, period, past_balance,
        rank() over (partition by period order by past_balance desc nulls first) as rank
    from pegged_recent left join past using (token_implementation)"""
O["row_number_latest"] = "select token_implementation, date, balance from recent"
O["topk_latest"] = """
    select date, balance, reserve_address, collateral_token from reserves
    order by date desc, balance desc, reserve_address, collateral_token limit 10"""
O["union_all_periods"] = """
    with days as (select distinct date as as_of from balances)
    select as_of, 'daily' as period, as_of - 1 as date from days
    union all select as_of, 'weekly', as_of - 7 from days
    union all select as_of, 'monthly', cast(as_of - interval 1 month as date) from days
    union all select as_of, 'yearly', cast(as_of - interval 1 year as date) from days"""

# ---------------------------------------------------------------- scalar functions

O["fn_percent_change"] = f"""
    select b.date, b.token_implementation, {_percent('b.balance', 'p.price_usd')} as percent_change
    from balances b join impls i on i.slug = b.token_implementation
    join prices p on p.date = b.date and p.token_slug = i.token"""
O["fn_hex_uint"] = """
    select seq, text, case when bad then null
        when hi > 5421010862427522170 then null
        else nullif(cast(hi * cast(18446744073709551616 as hugeint) + n as varchar), '') end as number
    from (select seq, bad, n, cast(u as hugeint) * seq * 100000 as hi,
            case when bad then '0x'
                else '0x' || lower(to_hex(u * seq * 100000)) || lpad(lower(to_hex(n)), 16, '0') end as text
        from polls)"""
O["fn_text"] = """
    select seq, lpad(lower(to_hex(u)), 64, '0') as padded, lpad(upper(to_hex(u)), 64, '0') as padded_case,
        'Tok' || cast(b as varchar) as symbol,
        concat('Proj-Tok', b, '_', r_name, '_', case when k <> 0 then r_name end) as joined,
        'a,' || event_type as entries,
        case when k <> 0 then r_name end as piece,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso
    from polls"""

# ---------------------------------------------------------------- data rules

O["check_unique"] = """
    select 'observations' as rule, token_implementation || '|' || strftime(day, '%Y-%m-%d') as key,
        count(*) as n
    from observed group by token_implementation, day having count(*) > 1"""
O["check_fk"] = """
    select 'polls' as rule, 'Brand#' || cast(user_id % 30 as varchar) || '_' || r_name as value, count(*) as n
    from polls group by 2 having value not in (select slug from impls)"""
O["cascade_delete"] = """
    with kept as (select i.slug from impls i join tokens t on t.slug = i.token
        where i.network <> 'ASIA' and coalesce(i.network_origin, '') <> 'ASIA'
        and t.depegged is distinct from true)
    select 'token' as kind, date, token_implementation as holder, cast(null as varchar) as address, balance
    from balances where token_implementation in (select slug from kept)
    union all select 'reserve', date, collateral_token, reserve_address, balance from reserves
    where collateral_token in (select slug from kept)
        and (derivative_token in (select slug from kept) or derivative_token not in (select slug from impls))"""
O["cascade_stored"] = O["cascade_delete"]
CTES["loose_days"] = f"""
    select 'Brand#' || cast(user_id % 30 as varchar) || '_' || r_name as token_implementation, day - {SHIFT} as date,
        cast(arg_max(u, (is_final, ts, seq)) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as balance
    from polls group by 1, 2"""
O["checked_upsert"] = """
    select coalesce(b.token_implementation, f.token_implementation) as token_implementation,
        coalesce(b.date, f.date) as date, cast(coalesce(f.balance, b.balance) as decimal(20,8)) as balance,
        cast(null as varchar) as broken
    from balances b
    full join (select * from loose_days where token_implementation in (select slug from impls)) f
        on f.token_implementation = b.token_implementation and f.date = b.date
    union all select token_implementation, date, cast(balance as decimal(20,8)),
        'token_balances.token_implementation->token_implementations'
    from loose_days where token_implementation not in (select slug from impls)"""
O["check_domain"] = """
    select 'tokens.type in domain: ' || type as rule, count(*) as n from tokens
    where type not in ('staking', 'liquid_staking') group by 1
    union all select rule, 0 from (values ('networks.slug not null'), ('networks.name not null'),
        ('tokens.slug not null'), ('tokens.name not null'), ('token_implementations.slug not null'),
        ('reserve_implementations.slug not null'), ('reserve_implementations.id not null'),
        ('token_balances.date not null'), ('token_balances.balance not null'), ('token_balances.id not null'),
        ('reserve_balances.date not null'), ('reserve_balances.balance not null'),
        ('reserve_balances.reserve_address not null'), ('price.id not null')) as r(rule)"""
O["fill_defaults"] = """
    select slug, depegged, 'given' as load from tokens union all select slug, false, 'absent' from tokens"""
O["derive_impl_slug"] = """
    select token, network, slug, slug as name from (
        select distinct split_part(collateral_token, '_', 1) as token, reserve_network as network,
            case when reserve_network = 'ASIA' then 'given_' || split_part(collateral_token, '_', 1)
                else collateral_token end as slug
        from reserves)"""
O["ordered_current_supplies_by_network"] = """
    select total_balance, row_number() over (order by total_balance desc nulls first) - 1 as place
    from network_totals"""
O["ordered_top_gainers_by_tokenimpl"] = f"""
    select period, percent_change,
        row_number() over (order by period asc nulls last, percent_change desc nulls first) - 1 as place
    from ({O['top_gainers_by_tokenimpl']})"""
CTES["held_fallback"] = O["join_reserve_to_impl"]
CTES["object_values"] = O["sui_fallback_objects"]
O["ordered_historical_supplies_by_tokenimpl"] = f"""
    select project_rank, network_rank, date, row_number() over (order by
        nullif(project_rank, 0) desc nulls last, nullif(network_rank, 0) desc nulls last, date desc nulls last) - 1 as place
    from ({O['historical_supplies_by_tokenimpl']})"""
O["ordered_helper_token_balances_adjusted"] = """
    select date, token_implementation,
        row_number() over (order by date desc nulls first, token_implementation asc nulls last) - 1 as place
    from adjusted"""

# ---------------------------------------------------------------- kept tables, dollars


def _over(source: str, replaced: str, suffix: str, names: list[str]) -> None:
    """The same tables derived from another one in place of ``replaced``."""
    renamed = {replaced: source, **{n: f"{n}_{suffix}" for n in names}}
    for name in names:
        sql = CTES[name]
        for old, new in renamed.items():
            sql = re.sub(rf"\b(from|join)(\s+){old}\b", rf"\1\2{new}", sql)
        CTES[f"{name}_{suffix}"] = sql


CTES["grown_balances"] = "select date, token_implementation, balance, created_at, id from merged_balances"
_over("grown_balances", "balances", "grown", ["recent", "pegged_recent", "adjusted_now", "supply_now", "child_sums"])
O["kept_latest_supplies"] = f"""
    select token_implementation, balance, date, {DESCRIBED},
        rank() over (order by balance desc nulls first) as rank from supply_now_grown"""
O["kept_adjusted_history"] = """
    select b.date, b.token_implementation,
        cast(b.balance - coalesce(c.total, 0) as decimal(20,8)) as balance, b.created_at, b.id
    from grown_balances b
    left join child_sums_grown c on c.parent = b.token_implementation and c.date = b.date"""
CTES["grown_reserves"] = O["upsert_reserve_balances"]
_over("grown_reserves", "reserves", "grown", ["reserves_now", "reserves_adjusted"])
O["kept_latest_reserves"] = f"""
    select token_implementation, balance, date, {DESCRIBED},
        rank() over (order by balance desc nulls first) as rank
    from reserves_adjusted_grown join star using (token_implementation)"""
_USD = "cast(round(cast({0} as decimal(20,8)) * price_usd, 8) as decimal(38,8)) as supply_usd"
O["supply_usd_current"] = f"""
    select token_implementation, network_slug, s.token_slug, balance, s.date, price_usd, p.date as price_date,
        {_USD.format('balance')}
    from (select *, {AS_OF} as valued_on from supply_now) s
    asof left join prices p on p.token_slug = s.token_slug and s.valued_on >= p.date"""
CTES["token_days"] = """
    select a.date, s.token_slug, cast(sum(a.balance) as decimal(38,8)) as total_balance
    from adjusted a join star s using (token_implementation) where not s.depegged group by 1, 2"""
O["supply_usd_history"] = f"""
    select t.date, t.token_slug, total_balance, price_usd, cast(p.known as date) as price_date,
        {_USD.format('total_balance')}
    from token_days t
    asof left join (select *, date + 1 as known from prices) p on p.token_slug = t.token_slug and t.date >= p.known"""
O["endpoint_read"] = f"select * from ({O['top_gainers_by_tokenimpl_absolute']}) where period = 'weekly'"

# ---------------------------------------------------------------- assembly

_LISTED = re.compile(r"LISTED\((\w+)\)")


def _expand(sql: str) -> str:
    """Sorted distinct values as text, a NULL at the end."""
    return _LISTED.sub(
        r"concat_ws(',', string_agg(distinct \1, ',' order by \1),"
        r" case when count(*) > count(\1) then '<null>' end)",
        sql,
    )


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in CTES:
        if name not in found and re.search(rf"\b(from|join)\s+\(?\s*{name}\b", sql):
            _needed(CTES[name], found)
            if name not in found:
                found.append(name)
    return found


def _assemble(body: str) -> str:
    names = _needed(body, [])
    parts = [f"{n} as materialized ({_expand(CTES[n])})" for n in names]
    final = _expand(body)
    if not parts:
        return final.strip()
    return f"with {', '.join(parts)} select * from ({final}) as result"


ORACLES: dict[str, str] = {name: _assemble(body) for name, body in ORACLE_BODIES.items()}
