"""The same results stated in SQL over the test tables, for DuckDB."""

from __future__ import annotations

from tidemark.catalogue.inputs import EVENT_SPLIT, SHIP_SPLIT, TABLES

ORACLE: dict[str, str] = {}


def r6(expression: str) -> str:
    return f"(round({expression}, 6) + 0.0)"


def draw(key: str, salt: str, word: int = 0) -> str:
    """The key hash as a number in [0, 1)."""
    return (
        f"(('0x' || substr(md5('{salt}|' || {key}), {1 + 8 * word}, 8))::bigint"
        " / 4294967296.0::double)"
    )


LINE_KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
LINE_KEY_TEXT = "l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber"
NORMAL = (
    f"(sqrt(-2.0 * ln(1.0 - {draw(LINE_KEY_TEXT, 'shift')}))"
    f" * cos(2.0 * pi() * {draw(LINE_KEY_TEXT, 'shift', 1)}))"
)

DIRTY = """dirty as (
  select o_orderkey, o_orderstatus, o_orderpriority,
         try_cast(case when o_orderpriority = '5-LOW' then ' '
                       else o_custkey::varchar end as double) amount
  from orders)"""

# --- sources and sinks

ORACLE["csv_roundtrip"] = "select * from part"
ORACLE["csv_inferred"] = "select * from customer"
_SPLIT_ORDERS = f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  case when {draw('o_orderkey', 'split')} < 0.2 then 'test' else 'train' end split from orders"""
ORACLE["snapshot_roundtrip"] = _SPLIT_ORDERS
ORACLE["snapshot_one_side"] = (
    f"select * exclude (split) from ({_SPLIT_ORDERS}) where split = 'test'"
)
ORACLE["snapshot_csv_roundtrip"] = "select * exclude (o_orderdate) from orders"
ORACLE["snapshot_ids"] = "select event_id, strftime(ts, '%Y%m%d%H%M%S') snapshot_id from events"
ORACLE["ledger_last"] = """select count(*) + 1 n, max(event_id) seq,
  arg_max(strftime(ts, '%Y%m%d%H%M%S'), event_id) snapshot_id, max(event_id) + 1 added
  from events"""
ORACLE["json_ledger"] = """select row_number() over (order by min(ts)) seq,
  strftime(min(ts), '%Y%m%d%H%M%S') snapshot_id from events group by ts::date"""
ORACLE["feature_files"] = "select p_partkey, p_size, p_retailprice from part"
ORACLE["ledger_folded"] = f"""with m as (
    select strftime(o_orderdate, '%Y-%m') "month", count(*) n, {r6('avg(o_totalprice)')} mean_price
    from orders group by 1)
  select *, (select count(*) from m) n_seq, (select count(*) from m) last_seq from m"""
ORACLE["snapshot_publish"] = f"""select o_orderstatus, split, count(*) n, {r6('sum(o_totalprice)')} total,
    case o_orderstatus when 'F' then 1 else 2 end::bigint seq,
    sum(count(*)) over (partition by o_orderstatus)::bigint n_rows, 1 n_swept
  from ({_SPLIT_ORDERS}) where o_orderstatus <> 'P' group by o_orderstatus, split"""
ORACLE["latest_record"] = """select event_type, max(event_id) event_id,
  arg_max(user_id, event_id) user_id, arg_max(ts, event_id) ts, arg_max(value, event_id) "value"
  from events group by event_type"""
ORACLE["row_counts"] = " union all ".join(
    f"select '{t}' table_name, count(*) n from {t}" for t in TABLES
)

# --- projections and filters

ORACLE["drop_columns"] = "select * exclude (c_name) from customer"
ORACLE["lenient_cast"] = f"with {DIRTY} select * from dirty"
ORACLE["drop_null_rows"] = f"""with {DIRTY}
  select *, 1.5::double rate from dirty where amount is not null and o_orderstatus <> 'P'"""
ORACLE["clean_losses"] = f"""with {DIRTY},
  t as (select count(*) n_read, count(amount) complete,
    (select count(*) from (select distinct o_orderstatus, o_orderpriority, amount from dirty
       where amount is not null)) kept from dirty)
  select unnest(['unparsable', 'read', 'incomplete', 'duplicate', 'kept']) step,
    unnest(['amount', null, null, null, null]) "column",
    unnest([n_read - complete, n_read, n_read - complete, complete - kept, kept]) n from t"""
ORACLE["dedup_by_digest"] = "select * from orders"
ORACLE["dedup_rows"] = """select distinct l_returnflag, l_linestatus, l_quantity, l_discount
  from lineitem"""
ORACLE["clean_table"] = f"""with {DIRTY}
  select distinct o_orderstatus, o_orderpriority, amount from dirty where amount is not null"""
_ROLES = {
    "numeric": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax",
    "categorical": "l_returnflag l_linestatus l_shipdate",
}
ORACLE["roles_of_columns"] = " union all ".join(
    f"select '{c}' column_name, '{role}' role, count({c}) n_values from lineitem"
    for role, names in _ROLES.items()
    for c in names.split()
)
ORACLE["select_by_name"] = """select c_custkey, c_nationkey * 2 a_scaled, c_nationkey * 3 b_indexed
  from customer"""
ORACLE["class_filter"] = "select * from labels where quality = 0"
ORACLE["feature_columns_only"] = "select doc_id, toxic from labels"
ORACLE["label_column_only"] = "select quality, count(*) n from labels group by 1"
ORACLE["derived_columns"] = f"""select {LINE_KEY},
  {r6('l_extendedprice * (1 - l_discount)')} revenue,
  {r6('l_extendedprice * (1 - l_discount) * (1 + l_tax)')} charge from lineitem"""

# --- feature transforms

ORACLE["numeric_stats"] = " union all ".join(
    f"""select '{c}' feature, count({c}) n, {r6(f'avg({c})')} mean,
    {r6(f'stddev_samp({c})')} stddev from lineitem"""
    for c in _ROLES["numeric"].split()[3:]  # without the keys
)


def zscore(table: str, key: str, columns: list[str]) -> str:
    stats = ", ".join(f"avg({c}) m_{c}, stddev_samp({c}) s_{c}" for c in columns)
    scaled = ", ".join(
        r6(f"({c} - m_{c}) / coalesce(nullif(s_{c}, 0), 1)") + f" {c}_scaled" for c in columns
    )
    return f"with s as (select {stats} from {table}) select {key}, {scaled} from {table}, s"


ORACLE["zscore"] = zscore("customer", "c_custkey", ["c_nationkey", "c_acctbal"])
ORACLE["zscore_parts"] = zscore("part", "p_partkey", ["p_size", "p_retailprice"])
ORACLE["zscore_constant"] = "select c_custkey, 0.0::double fixed_scaled from customer"


def frequency(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' feature, {c}::varchar value, count(*) n from {table} group by all"
        for c in columns
    )


def ranked(table: str, column: str, where: str = "true") -> str:
    """(value, n, index): most frequent first, ties in text order."""
    return f"""select {column}::varchar v, count(*) n,
      row_number() over (order by count(*) desc, {column}::varchar) - 1 "index"
      from {table} where {where} group by {column}::varchar"""


ORACLE["category_frequency"] = frequency(
    "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"]
)
ORACLE["category_map"] = " union all ".join(
    f"""select '{c}' feature, v "value", n, "index" from ({ranked('orders', c)})"""
    for c in ("o_orderstatus", "o_orderpriority")
)
ORACLE["category_map_any_size"] = (
    f"""select v "value", n, "index" from ({ranked('orders', 'o_custkey')})"""
)


def indexed(table: str, key: str, columns: list[str]) -> str:
    maps = ", ".join(f"m{i} as ({ranked(table, c)})" for i, c in enumerate(columns))
    joins = " ".join(f"join m{i} on m{i}.v = {c}::varchar" for i, c in enumerate(columns))
    picks = ", ".join(f'm{i}."index"::double {c}_indexed' for i, c in enumerate(columns))
    return f"with {maps} select {key}, {picks} from {table} {joins}"


ORACLE["category_index"] = indexed("orders", "o_orderkey", ["o_orderstatus", "o_orderpriority"])
ORACLE["category_index_long_list"] = indexed("part", "p_partkey", ["p_name", "p_brand"])
ORACLE["category_index_wide"] = indexed(
    "orders", "o_orderkey", ["o_custkey", "o_totalprice", "o_orderstatus"]
)
_KNOWN = "o_orderpriority <> '1-URGENT'"
ORACLE["features_of_other_table"] = f"""with m as ({ranked('orders', 'o_orderpriority', _KNOWN)}),
  t as (select avg(o_totalprice) a, stddev_samp(o_totalprice) d from orders where {_KNOWN})
  select o_orderkey, {r6("(o_totalprice - a) / d")} price,
    coalesce("index", (select count(*) from m))::double o_orderpriority_indexed
  from orders cross join t left join m on v = o_orderpriority"""
ORACLE["category_index_unseen"] = f"""with o as (
    select *, strftime(o_orderdate, '%Y-%m') cohort from orders),
  m as ({ranked('o', 'cohort', "o_orderdate < timestamp '1998-01-01'")})
  select o_orderkey, coalesce("index", (select count(*) from m))::double cohort_indexed
  from o left join m on v = cohort"""
ORACLE["category_index_hot_unseen"] = f"""with m as ({ranked('lineitem', 'l_partkey::varchar')})
  select coalesce("index", (select count(*) from m))::double l_partkey_indexed, count(*) n
  from (select case when l_quantity <= 20 then 'new' else l_partkey::varchar end k from lineitem)
  left join m on v = k group by 1"""
ORACLE["one_hot"] = f"""with m as ({ranked('customer', 'c_mktsegment')})
  select c_custkey, {", ".join(f'("index" = {i})::int::double oh_{i}' for i in range(4))}
  from customer join m on v = c_mktsegment"""


def scaled_column(column: str) -> str:
    return r6(f"({column} - avg({column}) over ()) / stddev_samp({column}) over ()")


_LINE_MAPS = f"f as ({ranked('lineitem', 'l_returnflag')}), s as ({ranked('lineitem', 'l_linestatus')})"
_LINE_JOIN = "lineitem join f on f.v = l_returnflag join s on s.v = l_linestatus"
ORACLE["feature_matrix"] = f"""with {_LINE_MAPS} select {LINE_KEY},
  {scaled_column('l_quantity')} l_quantity_scaled,
  {scaled_column('l_extendedprice')} l_extendedprice_scaled,
  {scaled_column('l_discount')} l_discount_scaled,
  f."index"::double l_returnflag_indexed, s."index"::double l_linestatus_indexed
  from {_LINE_JOIN}"""
ORACLE["feature_vector"] = f"""with {_LINE_MAPS} select {LINE_KEY},
  {scaled_column('l_quantity')} v0, {scaled_column('l_discount')} v1, f."index"::double v2
  from {_LINE_JOIN}"""


def prepared(split_first: bool) -> str:
    """Labelled documents made into features, split and balanced."""
    side = f"case when {draw('doc_id', 'split')} < 0.2 then 'test' else 'train' end"
    fit = "early_split = 'train'" if split_first else "true"
    repeat = (
        f"floor(ratio)::bigint + ({draw('doc_id', 'balance')} < ratio - floor(ratio))::bigint"
    )
    copies = f"case when {fit} then {repeat} else 1 end"
    late = draw("doc_id || '|' || copy_no", "split")
    final = "early_split" if split_first else f"case when {late} < 0.2 then 'test' else 'train' end"
    return f"""with d as (
      select doc_id, quality, toxic, n_chars::double n_chars, lang, source, {side} early_split
      from labels join documents using (doc_id)),
    t as (select avg(toxic) mt, stddev_samp(toxic) st, avg(n_chars) mn, stddev_samp(n_chars) sn
      from d where {fit}),
    l as ({ranked('d', 'lang', fit)}), s as ({ranked('d', 'source', fit)}),
    q as ({ranked('d', 'quality', fit)}),
    x as (select d.*,
        {r6("(toxic - mt) / coalesce(nullif(st, 0), 1)")} toxic_scaled,
        {r6("(n_chars - mn) / coalesce(nullif(sn, 0), 1)")} n_chars_scaled,
        coalesce(l."index", (select count(*) from l))::double lang_indexed,
        coalesce(s."index", (select count(*) from s))::double source_indexed,
        q."index"::double quality_indexed,
        (select max(n) from q) / q.n::double ratio
      from d cross join t left join l on l.v = lang left join s on s.v = source
      join q on q.v = quality::varchar),
    y as (select *, unnest(range(1, {copies} + 1)) copy_no from x)
    select {final} split, copy_no, toxic_scaled, n_chars_scaled, lang_indexed, source_indexed,
      quality_indexed from y"""


ORACLE["prepare_split_first"] = prepared(True)
ORACLE["prepare_balance_first"] = prepared(False)

# --- sampling, balancing, splitting

ORACLE["class_counts"] = "select quality, count(*) n from labels group by 1"


def balanced(table: str, label: str, key: str) -> str:
    copies = f"floor(r)::bigint + ({draw(key, 'balance')} < r - floor(r))::bigint"
    return f"""with c as (select {label}, count(*) n from {table} group by 1),
      x as (select t.*, (select max(n) from c) / c.n::double r
            from {table} t join c using ({label}))
      select * exclude (r), unnest(range(1, {copies} + 1)) copy_no from x"""


ORACLE["balance_minority"] = (
    f"select * exclude (copy_no) from ({balanced('labels', 'quality', 'doc_id')})"
)
ORACLE["balance_every_class"] = f"""select o_orderkey, o_orderstatus, copy_no::int copy_no
  from ({balanced('orders', 'o_orderstatus', 'o_orderkey')})"""
ORACLE["split_hash"] = f"""select o_orderkey,
  case when {draw('o_orderkey', 'split')} < 0.2 then 'test' else 'train' end split from orders"""
ORACLE["split_exact"] = """select o_orderkey,
  case when row_number() over (order by md5('split|' || o_orderkey))
            <= (select ceil(0.2 * count(*)) from orders) then 'test' else 'train' end split
  from orders"""
ORACLE["split_random_whole"] = "select * from orders"
ORACLE["split_random_facts"] = """select count(*) n, true share_is_near, 0::bigint n_both,
  0::bigint n_apart from orders"""
_POISSON_DRAW = """(('0x' || substr(md5(md5('poisson42|' || doc_id) || '|0'), 1, 8))::bigint
  / 4294967296.0::double)"""
ORACLE["balance_poisson"] = f"""with c as (select quality, count(*) n from labels group by quality),
  r as (select quality, max(n) over () / n mean from c),
  b as (select quality, mean, list_transform(range(0, 61), lambda k: list_sum(list_transform(
      range(0, k + 1), lambda j: exp(-mean + j * ln(mean) - lgamma(j + 1))))) bounds from r),
  d as (select doc_id, quality, case when mean = 1 then 1
      else len(list_filter(bounds, lambda x: x <= {_POISSON_DRAW})) end n from labels join b using (quality))
  select doc_id, quality, sum(n)::bigint n_copies from d where n > 0 group by doc_id, quality"""
ORACLE["balance_by_sampling"] = """select quality, count(*) n, true size_is_near,
  true largest_is_whole, true only_known_rows from labels group by quality"""
ORACLE["merge_splits"] = "select * from orders"

# --- ordering and choosing

ORACLE["recent_k"] = "select * from events order by ts desc, event_id desc limit 20"
ORACLE["recent_k_per_group"] = """select * from events
  qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 3"""
ORACLE["champion"] = """select * from
  (select * from events order by ts desc, event_id desc limit 10)
  order by "value" desc, ts desc, event_id desc limit 1"""
ORACLE["champion_per_group"] = """with r as (
    select *, case when event_type <> 'error' then "value" end metric from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 2)
  select * from r qualify row_number() over (partition by user_id
    order by coalesce(metric, 0) desc, ts desc, event_id desc) = 1"""

# --- histograms and drift

_RANGED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLE["feature_ranges"] = " union all ".join(
    f"select '{c}' feature, min({c}) lo, max({c}) hi from lineitem" for c in _RANGED
)


def binned(long: str, ranges: str, bins: int) -> str:
    """CTEs: values ``l`` (feature, v, side), ranges ``r``, and ``x`` with each value's bin."""
    return f"""l as ({long}), r as ({ranges}),
      g as (select feature, lo, hi, list_transform(range(0, {bins + 1}),
              lambda i: case when i = {bins} then hi else lo + i * ((hi - lo) / {bins}) end) es
            from r),
      x as (select feature, side, case when v is null then -2 when v < lo or v > hi then -1
              else least(len(list_filter(es, lambda e: e <= v)) - 1, {bins - 1}) end bin
            from l join g using (feature))"""


_LINES_LONG = """unpivot (select 'base' side, l_quantity, l_extendedprice, l_discount, l_tax
  from lineitem) on l_quantity, l_extendedprice, l_discount, l_tax into name feature value v"""
_OWN_RANGE = "select feature, min(v) lo, max(v) hi from l group by 1"
_BASE_RANGE = "select feature, min(v) lo, max(v) hi from l where side = 'base' group by 1"

ORACLE["histogram_fixed"] = f"""with {binned(_LINES_LONG, _OWN_RANGE, 10)}
  select feature, bin::bigint bin, count(*) n from x group by all"""
_EVENTS_LONG = """select 'value' feature, 'base' side, "value" v from events"""
ORACLE["histogram_partly_out_of_range"] = f"""with
  {binned(_EVENTS_LONG, "select 'value' feature, 5.0::double lo, 60.0::double hi", 25)}
  select 'value' feature, i bin, count(x.bin) n
  from range(0, 25) t(i) left join x on x.bin = i group by i"""
ORACLE["bin_densities"] = f"""with {binned(_EVENTS_LONG, _OWN_RANGE, 20)},
  c as (select i bin, greatest(count(x.bin), 0.0001)::double n
        from range(0, 20) t(i) left join x on x.bin = i group by i)
  select 'value' feature, bin, round(n / sum(n) over (), 12) density from c"""


def psi(long: str, ranges: str = _BASE_RANGE, bins: int = 10) -> str:
    """CTEs ending in ``p``: PSI and counts per feature."""
    return f"""{binned(long, ranges, bins)},
      c as (select feature, bin, count(*) filter (side = 'base') cb,
                   count(*) filter (side = 'new') cn from x group by all),
      f as (select r.feature, i bin,
              (case when coalesce(cb, 0) = 0 then 0.0001 else cb end)::double b,
              (case when coalesce(cn, 0) = 0 then 0.0001 else cn end)::double n
            from r cross join range(0, {bins}) t(i)
            left join c on c.feature = r.feature and c.bin = i),
      w as (select *, b / sum(b) over (partition by feature) pb,
                   n / sum(n) over (partition by feature) pn from f),
      p as (select feature, {r6("sum((pn - pb) * ln(pn / pb))")} psi from w group by 1),
      k as (select feature, sum(cb)::bigint n_base, sum(cn)::bigint n_new,
              coalesce(sum(cn) filter (bin = -1), 0)::bigint n_out_of_range,
              coalesce(sum(cb + cn) filter (bin = -2), 0)::bigint n_missing
            from c group by 1)"""


_PSI_COLUMNS = "feature, psi, n_base, n_new, n_out_of_range, n_missing"
_SIDES = f"""unpivot (select case when l_shipdate < timestamp '{SHIP_SPLIT}' then 'base' else 'new' end
  side, l_quantity, l_extendedprice, l_discount from lineitem)
  on l_quantity, l_extendedprice, l_discount into name feature value v"""
_EVENT_SIDE = f"case when ts < timestamp '{EVENT_SPLIT}' then 'base' else 'new' end"


def event_values(new: str = '"value"', base: str = '"value"') -> str:
    chosen = f"case when {_EVENT_SIDE} = 'base' then {base} else {new} end"
    return f"select 'value' feature, {_EVENT_SIDE} side, {chosen} v from events"


def psi_query(long: str, ranges: str = _BASE_RANGE, bins: int = 10) -> str:
    return f"with {psi(long, ranges, bins)} select {_PSI_COLUMNS} from p join k using (feature)"


ORACLE["psi_baseline"] = psi_query(_SIDES)
ORACLE["psi_combined"] = psi_query(_SIDES, _OWN_RANGE)
ORACLE["psi_events"] = psi_query(event_values(), bins=20)
ORACLE["psi_constant_baseline"] = psi_query(event_values('round("value")', "3.0::double"))
ORACLE["psi_out_of_range"] = psi_query(event_values('"value" + 1e6::double'))

_SHIFTED = f"""unpivot (select
    case when l_shipdate < timestamp '{SHIP_SPLIT}' then 'base' else 'new' end side, l_quantity,
    case when l_shipdate < timestamp '{SHIP_SPLIT}' then l_extendedprice
         else l_quantity * 1.5::double + {NORMAL} end l_extendedprice, l_discount from lineitem)
  on l_quantity, l_extendedprice, l_discount into name feature value v"""
ORACLE["psi_from_profile"] = psi_query(_SHIFTED)
ORACLE["psi_from_fine_profile"] = psi_query(_SHIFTED, bins=20)


def report(ranges: str) -> str:
    return f"""with {psi(_SHIFTED, ranges)},
      rep as (select {_PSI_COLUMNS}, psi > 0.25 drifted, 'compared' status
              from p join k using (feature))"""


_REPORT = report(_BASE_RANGE)
ORACLE["drift_report"] = f"{_REPORT} select * from rep"
ORACLE["drift_report_missing_feature"] = f"""{_REPORT} select * from rep union all
  select 'l_tax', null, null, null, null, null, null, 'missing_in_new'"""
_GATE = """select case when count(*) filter (drifted) > 0 then 'train_model'
    else 'no_model_drift' end decision,
  case when count(*) filter (drifted) > 0 then 'drift' else 'stable' end reason,
  count(*) filter (drifted) n_drifted, max(psi) max_psi"""
ORACLE["drift_gate"] = f"{_REPORT} {_GATE} from rep"
_GAPS = f"""{_REPORT},
  h as (select count(*) filter (l_shipdate < timestamp '{SHIP_SPLIT}') n_base,
          count(*) filter (l_shipdate >= timestamp '{SHIP_SPLIT}') n_new from lineitem),
  gaps as (select * from rep where feature <> 'l_discount' union all
    select 'l_discount', null, n_base, n_new, 0, n_new, null, 'no_new_values' from h union all
    select 'l_tax', null, n_base, n_new, 0, n_base, null, 'no_baseline_values' from h)"""
ORACLE["drift_report_gaps"] = f"{_GAPS} select * from gaps"
ORACLE["drift_gate_halt"] = f"""{_GAPS} select 'halt' decision, 'missing_feature' reason,
  count(*) filter (drifted) n_drifted, max(psi) max_psi from gaps"""
ORACLE["drift_gate_new_feature"] = f"""select 'train_model' decision,
  'no_baseline_values' reason, 0::bigint n_drifted, 0.0::double max_psi
  from (select 1 from lineitem where l_shipdate < timestamp '{SHIP_SPLIT}' limit 1)"""
ORACLE["drift_report_combined"] = f"{report(_OWN_RANGE)} select * from rep"
ORACLE["drift_gate_combined"] = f"{report(_OWN_RANGE)} {_GATE} from rep"
ORACLE["drift_gate_stable"] = f"""with {psi(_SIDES)}
  {_GATE} from (select psi, psi > 0.25 drifted from p)"""
ORACLE["inject_shift"] = f"""select {LINE_KEY},
  {r6(f"l_quantity * 1.5::double + {NORMAL}")} l_extendedprice from lineitem"""
ORACLE["inject_shift_random"] = """select count(*) n, true mean_is_near, true deviation_is_near
  from lineitem"""
ORACLE["schema_diff"] = """
  select 'l_tax' feature, 'missing_in_new' status, count(l_tax) n_values from lineitem union all
  select 'l_linenumber', 'type_changed', count(l_linenumber) from lineitem union all
  select 'l_discount', 'missing_in_base', count(l_discount) from lineitem"""

ORACLE["psi_from_summary"] = f"""select feature, true is_near,
  true error_is_small, psi exact from ({ORACLE["psi_combined"]})"""
ORACLE["drift_report_disjoint"] = """select unnest(['l_quantity', 'l_tax', 'l_discount']) feature,
  null::double psi, unnest(['missing_in_new', 'missing_in_new', 'missing_in_base']) status,
  'halt' decision, 'missing_feature' reason"""

# --- quality

_RULED = """ruled as (select case when l_linestatus = 'F' then 1.0 else 0.0 end::double label,
  case when l_discount > 0.03 then 1.0 else 0.0 end::double prediction from lineitem)"""
_PER_CLASS = f"""{_RULED},
  s as (select label, count(*) support, count(*) filter (prediction = label) hit
        from ruled group by 1),
  m as (select prediction label, count(*) predicted from ruled group by 1),
  cls as (select coalesce(s.label, m.label) label, coalesce(support, 0) support,
        coalesce(hit / nullif(support, 0)::double, 0) recall,
        coalesce(hit / nullif(predicted, 0)::double, 0) "precision",
        coalesce(2.0 * hit / nullif(coalesce(support, 0) + coalesce(predicted, 0), 0)::double, 0) f1
      from s full join m on s.label = m.label)"""
ORACLE["confusion"] = f"""with {_RULED} select label, prediction, count(*) n from ruled group by all"""
ORACLE["accuracy"] = f"""with {_RULED}
  select {r6("avg((label = prediction)::int)")} accuracy from ruled"""
ORACLE["class_metrics"] = f"""with {_PER_CLASS} select label, support, {r6("recall")} recall,
  {r6('"precision"')} "precision", {r6("f1")} f1 from cls"""
ORACLE["summary_metrics"] = f"""with {_PER_CLASS}
  select {r6("sum(recall * support) / sum(support)")} accuracy,
    {r6("max(recall) filter (label = 0)")} recall_0, {r6("max(recall) filter (label = 1)")} recall_1,
    {r6("sum(f1 * support) / sum(support)")} f1_weighted, {r6("avg(f1)")} f1_macro from cls"""

# --- models: each must find the rule that made its labels

_RULE = """rule as (select o_orderkey, (o_totalprice > 250000)::int::double rule from orders
  where abs(o_totalprice - 250000) > 60000)"""
for _algorithm in "logistic tree forest svc boosted deep_forest ridge_logistic".split():
    ORACLE[f"train_{_algorithm}"] = f"""with {_RULE}
      select o_orderkey, '{_algorithm}' algorithm, rule prediction from rule"""
ORACLE["batch_score"] = f"with {_RULE} select o_orderkey, rule prediction from rule"
ORACLE["score_resumed"] = ORACLE["batch_score"]
ORACLE["evaluate_model"] = ORACLE["summary_metrics"].replace(
    _RULED,
    f"""{_RULE}, ruled as (select rule prediction,
      case when o_orderkey % 10 = 0 then 1 - rule else rule end label from rule)""",
)

ORACLE["run_and_promote"] = f"""with y as ({prepared(True)})
  select '20240101000000' snapshot_id, count(*) n_rows, 'train_model' decision,
    'no_baseline' reason, 2::bigint n_runs, 1::bigint "version", 'Production' stage from y
  union all
  select '20240102000000', count(*), 'no_model_drift', 'stable', null, null, null from y"""
