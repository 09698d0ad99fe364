"""SQL for the registered queries, over the plain tables, in DuckDB's dialect.

Written from the definitions, with window functions and joins where the Spark
side uses buckets and broadcasts, so that the two are independent.
"""

from __future__ import annotations

NUMERIC = [
    "total_price", "acctbal", "n_lines", "sum_qty", "avg_disc",
    "drift_half", "drift_some", "drift_up", "sparse_col",
]
TEXT = ["seg_signal", "priority", "segment"]
FIXED = ["risk_id", "partition_date", "label"]
CONSTANT = "const_col"
DECILES = [i * 0.1 for i in range(10)] + [1.0]

RISK = """
la as (
  select l_orderkey, count(*) n, sum(l_quantity) sum_qty, sum(round(l_discount * 100)) cents
  from lineitem group by l_orderkey),
risk as (
  select o_orderkey as risk_id, o_orderdate as partition_date,
    case when (o_totalprice > 250000) <> (o_orderkey % 5 = 0) then 1 else 0 end as label,
    o_totalprice as total_price, c_acctbal as acctbal, cast(la.n as int) as n_lines, la.sum_qty,
    la.cents / (la.n * 100.0::double) as avg_disc,
    o_totalprice * case when o_orderdate >= timestamp '2001-01-01' then 0.5::double else 1.0::double end as drift_half,
    o_totalprice * case when o_orderdate >= timestamp '2001-01-01' and o_orderkey % 3 <> 0
      then 0.4::double else 1.0::double end as drift_some,
    o_totalprice * case when o_orderdate >= timestamp '2001-01-01' then 1.5::double else 1.0::double end as drift_up,
    1.0::double as const_col,
    case when o_orderkey % 20 = 0 then o_totalprice end as sparse_col,
    case when (o_totalprice > 250000) <> (o_orderkey % 5 = 0)
      then case when o_orderkey % 3 = 0 then 'A' else 'B' end
      else case when o_orderkey % 3 = 1 then 'A' else 'C' end end as seg_signal,
    o_orderpriority as priority, c_mktsegment as segment
  from orders left join customer on o_custkey = c_custkey left join la on la.l_orderkey = o_orderkey)"""

LINES = """
lines as (
  select l_orderkey, l_linenumber, l_shipdate as partition_date, strftime(l_shipdate, '%Y-%m') as month,
    case when l_returnflag = 'R' then 1 else 0 end as label,
    (l_quantity / 50.0::double + case when l_returnflag = 'R' then 0.2::double else 0.0::double end) / 1.2::double as score,
    l_quantity, l_discount, l_extendedprice
  from lineitem)"""

IN_TRAIN = "partition_date between timestamp '1995-01-01' and timestamp '2000-12-31'"
IN_OOT = "partition_date between timestamp '2001-01-01' and timestamp '2001-08-01'"


def _fill(c: str) -> str:
    if c in TEXT:
        return f"coalesce({c}, 'missing') as {c}"
    if c == "n_lines":
        return "coalesce(n_lines, -999999) as n_lines"
    return f"round_even(coalesce({c}, -999999::double) * 100, 0) / 100 as {c}"


def _split(name: str, source: str, columns: str) -> str:
    return f"""
{name} as (
  select {columns}, case when {IN_TRAIN} then 'train' else 'oot' end as split
  from {source} where {IN_TRAIN} or {IN_OOT})"""


def _long(name: str, source: str, columns: list[str], kind: str = "double") -> str:
    parts = " union all ".join(
        f"select '{c}' as feature, {c}::{kind} as x, label as y, split, partition_date from {source}" for c in columns
    )
    return f"\n{name} as ({parts})"


_PLAIN = ", ".join([*FIXED, *NUMERIC, *TEXT])
_FILLED = ", ".join([*FIXED, *(_fill(c) for c in [*NUMERIC, *TEXT])])
RAW = RISK + "," + _split("raw", "risk", _PLAIN)
FILLED = RISK + "," + _split("filled", "risk", _FILLED)
RAW_NUM = RAW + "," + _long("num", "raw", NUMERIC)
RAW_TEXT = RAW + "," + _long("txt", "raw", TEXT, "varchar")
FILLED_NUM = FILLED + "," + _long("num", "filled", NUMERIC)
FILLED_TEXT = FILLED + "," + _long("txt", "filled", TEXT, "varchar")


def _chi2(name: str, source: str, a: str, b: str, yates: bool = True) -> str:
    """Chi-square of x against two conditions, per feature; p for 2 and 4 degrees."""
    gap = "abs(a - ea)"
    if yates:
        gap = f"case when k = 2 then {gap} - least(0.5::double, {gap}) else {gap} end"
    return f"""
{name}_cells as (
  select feature, x, count(*) filter ({a})::double a, count(*) filter ({b})::double b
  from {source} group by 1, 2 having count(*) filter ({a} or {b}) > 0),
{name}_expected as (
  select *, (a + b) * sum(a) over f / sum(a + b) over f as ea, (a + b) * sum(b) over f / sum(a + b) over f as eb,
    count(*) over f as k
  from {name}_cells window f as (partition by feature)),
{name}_sums as (
  select feature, max(k) as n_categories, sum(power({gap}, 2) / ea + power({gap}, 2) / eb) as chi2, max(k) - 1 as dof
  from {name}_expected group by 1),
{name} as (
  select *, case dof when 2 then exp(-chi2 / 2) when 4 then exp(-chi2 / 2) * (1 + chi2 / 2) end as p from {name}_sums)"""


def _mi(name: str, source: str, where: str = "true") -> str:
    return f"""
{name}_cells as (select feature, x, y, count(*)::double n from {source} where {where} group by 1, 2, 3),
{name}_shares as (
  select feature, n / sum(n) over (partition by feature) as pxy,
    sum(n) over (partition by feature, x) / sum(n) over (partition by feature) as px,
    sum(n) over (partition by feature, y) / sum(n) over (partition by feature) as py
  from {name}_cells),
{name} as (select feature, greatest(sum(pxy * ln(pxy / (px * py))), 0) as mi from {name}_shares group by 1)"""


def _spearman(name: str, source: str, by: str = "feature") -> str:
    """Average ranks by counting ties, then plain correlation."""
    return f"""
{name}_ranks as (
  select {by}, y, rank() over (partition by {by} order by x) + (count(*) over (partition by {by}, x) - 1) / 2.0 as r
  from {source} where x is not null),
{name} as (
  select {by}, count(*) as n_valid,
    case when stddev_pop(r) > 0 and stddev_pop(y) > 0 then corr(r, y) end as rho from {name}_ranks group by all)"""


def _corr(x: str = "x", y: str = "y") -> str:
    return f"case when min({x}) <> max({x}) and min({y}) filter ({x} is not null) <> max({y}) filter ({x} is not null) then corr({x}, {y}) end"


def _quantiles(sorted_list: str, probs: list[float]) -> str:
    """Linear interpolation from the nearer neighbour, spelled out."""
    place = f"(p * (len({sorted_list}) - 1))"
    low, high = f"{sorted_list}[floor({place})::int + 1]", f"{sorted_list}[ceil({place})::int + 1]"
    part = f"({place} - floor({place}))"
    ps = ", ".join(f"{p!r}e0" for p in probs)
    return f"""list_transform([{ps}], lambda p: case when {part} >= 0.5 then {high} - ({high} - {low}) * (1 - {part})
      else {low} + ({high} - {low}) * {part} end)"""


def _psi(name: str, source: str, actual: str, keys: str = "feature", month: str = "") -> str:
    """Stability index by explicit bins; ``actual`` selects the compared rows."""
    return f"""
{name}_l as (
  select feature, list_sort(list(x)) as l, count(x) as n_e from {source} where split = 'train' and x is not null group by 1),
{name}_q as (select feature, {_quantiles("l", DECILES)} as q, n_e from {name}_l),
{name}_edges as (select feature, list_sort(list_distinct(q)) as e, n_e from {name}_q),
{name}_bins as (
  select feature, e, n_e, unnest(range(1, greatest(len(e), 2))) as b from {name}_edges),
{name}_e as (
  select s.feature, b.b, count(*) as n from {source} s join {name}_bins b on s.feature = b.feature and split = 'train'
    and x >= e[b.b] and (x < e[b.b + 1] or (b.b = len(e) - 1 and x = e[b.b + 1])) group by 1, 2),
{name}_a as (
  select {keys.replace('feature', 's.feature')}, b.b, count(*) as n from (select *{month} from {source}) s
    join {name}_bins b on s.feature = b.feature and {actual}
    and x >= e[b.b] and (x < e[b.b + 1] or (b.b = len(e) - 1 and x = e[b.b + 1])) group by all),
{name}_n as (select {keys}, count(x) as n_a, count(*) as samples from (select *{month} from {source}) where {actual} group by all),
{name}_cells as (
  select n.*, b.n_e, len(b.e) as k, b.b, coalesce(e.n, 0) as e, coalesce(a.n, 0) as a
  from {name}_n n join {name}_bins b using (feature)
    left join {name}_e e on e.feature = b.feature and e.b = b.b
    left join {name}_a a on {' and '.join(f'a.{c.strip()} = n.{c.strip()}' for c in keys.split(','))} and a.b = b.b),
{name}_shares as (
  select *, (e + 1e-8) / (sum(e) over w + 1e-7) as pe, (a + 1e-8) / (sum(a) over w + 1e-7) as pa, sum(a) over w as in_a
  from {name}_cells window w as (partition by {keys})),
{name} as (
  select {keys}, max(samples) as samples, max(n_a) as n_a, max(in_a) as in_a,
    max(n_e) >= 10 and max(n_a) >= 10 and max(k) >= 3 as enough,
    greatest(0, least(10, sum((pa - pe) * ln(pa / pe)))) as psi
  from {name}_shares group by all)"""


ORACLES: dict[str, str] = {}
SQL = ORACLES


def _with(ctes: str, body: str) -> str:
    return f"with {ctes.lstrip()} {body}"


# Sources and sinks

SQL["table_scan"] = "select * from customer"
SQL["first_columns"] = "select l_orderkey, l_partkey, l_suppkey, l_linenumber from lineitem"
SQL["table_shape"] = "with n as (select count(*) n from orders) " + " union all ".join(
    f"select {i} as position, '{c}' as column_name, '{t}' as dtype, {k} as columns_of_dtype, n as n_rows, 6 as n_columns from n"
    for i, (c, t, k) in enumerate([
        ("o_orderkey", "bigint", 2), ("o_custkey", "bigint", 2), ("o_orderstatus", "string", 2),
        ("o_totalprice", "double", 1), ("o_orderdate", "timestamp_ntz", 1), ("o_orderpriority", "string", 2),
    ])
)
SQL["stage_roundtrip"] = _with(
    RAW, "select split, count(*) as n, sum(n_lines)::bigint as lines, sum(label)::bigint as positives from raw group by 1"
)
_INT_TO = """case when lo > -128 and hi < 127 then 'tinyint' when lo > -32768 and hi < 32767 then 'smallint'
  when lo > -2147483648 and hi < 2147483647 then 'int' else from_type end"""
SQL["narrow_types"] = "with r as (" + " union all ".join(
    f"select '{c}' as column_name, '{t}' as from_type, min({c})::double as lo, max({c})::double as hi from lineitem"
    for c, t in [
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
        ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ]
) + f""") select column_name, from_type, round(lo, 6) as min_value, round(hi, 6) as max_value,
  case when from_type = 'double' then case when lo > -3.4028234663852886e38 and hi < 3.4028234663852886e38
    then 'float' else 'double' end else {_INT_TO} end as to_type from r"""

SQL["narrow_cast"] = f"""with p as ({SQL["narrow_types"]}), n as (select count(*) as n_rows from lineitem)
select column_name, to_type as dtype, n_rows from p, n union all
select c, t, n_rows from n, (values ('l_returnflag', 'string'), ('l_linestatus', 'string'), ('l_shipdate', 'timestamp_ntz')) v(c, t)"""

# Checks

SQL["duplicate_rows"] = """
select 'ids' as key, (count(*) - count(distinct (l_orderkey, l_linenumber)))::bigint as duplicates from lineitem union all
select 'ids and target', (count(*) - count(distinct (l_orderkey, l_linenumber, l_returnflag)))::bigint from lineitem"""
SQL["all_checks"] = _with(RISK, """,
s as (select count(*) n, count(distinct (risk_id, label)) d, count(distinct label) t, count(*) - count(label) nt,
  min(partition_date) lo, max(partition_date) hi from risk),
f as (select *, strftime(lo, '%Y-%m-%d %H:%M:%S') tlo, strftime(hi, '%Y-%m-%d %H:%M:%S') thi from s)
select 'duplicates' as "check", 'error' as severity, n = d as ok, (n - d)::varchar as observed, '0' as expected from f union all
select 'binary_target', 'error', t = 2, t::varchar, '2' from f union all
select 'null_target', 'error', nt = 0, nt::varchar, '0' from f union all
select 'train_coverage', 'error', lo <= timestamp '1995-01-01' and hi >= timestamp '2000-12-31', tlo || ' .. ' || thi,
  '1995-01-01 .. 2000-12-31' from f union all
select 'oot_present', 'error', hi >= timestamp '2001-01-01', thi, '>= 2001-01-01' from f union all
select 'oot_complete', 'warning', hi >= timestamp '2001-08-01', thi, '>= 2001-08-01' from f union all
select 'column_names', 'error', true, '', 'letters, digits, underscores' union all
select 'required_columns', 'error', true, '', 'partition_date, label'""")
SQL["null_profile"] = _with(RISK, " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as n_null from risk" for c in
    ["risk_id", "partition_date", "label", *NUMERIC[:8], CONSTANT, "sparse_col", *TEXT]
))
SQL["value_counts"] = "select l_partkey as value, count(*) as n from lineitem where l_partkey is not null group by 1"
SQL["head_per_month"] = _with(LINES, """
select month, l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount from lines
qualify row_number() over (partition by month order by l_orderkey, l_linenumber, l_extendedprice, l_quantity,
  l_discount, partition_date) <= 20""")
SQL["monthly_statistics"] = _with(RISK, """
select strftime(partition_date, '%Y-%m') as month, count(*) as samples, sum(label)::bigint as positive_count,
  round(avg(label), 6) as positive_rate from risk group by 1""")

# Projection and cleaning

_ALL = ["risk_id", "label", *NUMERIC[:8], CONSTANT, "sparse_col", *TEXT]
SQL["select_roles"] = _with(RISK, f"select {', '.join(c for c in _ALL if c not in (CONSTANT, 'sparse_col'))} from risk")
SQL["drop_constant"] = _with(RISK, f"select {', '.join(c for c in _ALL if c != CONSTANT)} from risk")
SQL["fill_sentinel"] = _with(RISK, "select risk_id, label, " + ", ".join(
    f"coalesce({c}, 'missing') as {c}" if c in TEXT else f"coalesce({c}, -999999) as {c}" for c in _ALL[2:]
) + " from risk")
SQL["round_features"] = _with(RISK, "select risk_id, label, " + ", ".join(
    c if c in TEXT or c == "n_lines" else f"round_even({c} * 100, 0) / 100 as {c}" for c in _ALL[2:]
) + " from risk")
SQL["parse_dates"] = "select o_orderkey, year(o_orderdate)::int as year, dayofyear(o_orderdate)::int as day from orders"
SQL["keep_features"] = _with(RISK, "select risk_id, label, total_price, segment from risk")
SQL["features_labels"] = _with(FILLED, """
select risk_id, label, total_price as f0, n_lines::double as f1, acctbal as f2 from filled""")
SQL["align_features"] = _with(RISK, """
select risk_id, coalesce(n_lines, -999999) as n_lines, 0 as acctbal, coalesce(sum_qty, -999999) as sum_qty,
  coalesce(sparse_col, -999999) as sparse_col, coalesce(segment, 'missing') as segment from risk""")
SQL["impute_median"] = _with(RAW, "select risk_id, split, " + ", ".join(
    f"round(coalesce({c}, median({c}) over (partition by split)), 6) as {c}"
    for c in NUMERIC
) + " from raw")
SQL["factorize"] = _with(RISK, "select risk_id, " + ", ".join(
    f"(dense_rank() over (order by coalesce({c}, 'missing')) - 1)::bigint as {c}" for c in TEXT
) + " from risk")

# Filters, split, sample

SQL["time_split"] = _with(RAW, "select risk_id, split, total_price from raw")
SQL["between_dates"] = """select o_orderkey, o_totalprice from orders
where o_orderdate >= timestamp '1996-03-01' and o_orderdate <= timestamp '1998-11-30'"""
SQL["by_month"] = _with(LINES, """select month, count(*) as n, round(min(l_extendedprice), 6) as least,
round(max(l_extendedprice), 6) as most from lines group by 1""")
SQL["group_sizes"] = _with(LINES, """select strftime(partition_date, '%Y-%m-%d') as day, count(*) as samples,
case when count(*) <= 10 or count(distinct label) < 2 then 'Insufficient data or no label variance' end as error
from lines group by 1""")
SQL["hash_sample"] = """select o_orderkey, o_custkey, o_totalprice from orders
order by md5('42:' || o_orderkey::varchar), o_orderkey limit 500"""

# Combining

SQL["union_splits"] = _with(RAW, "select risk_id, split, label, n_lines from raw")
SQL["align_categories"] = _with(FILLED_TEXT, """select feature, x as value, count(*) filter (split = 'train') as train,
count(*) filter (split = 'oot') as oot from txt group by 1, 2""")
SQL["reconcile_scores"] = """
with a as (select o_orderkey as id, o_totalprice / 500000.0::double as score from orders),
b as (select id, floor(score * 100) / 100 as score from a where id in (select l_orderkey from lineitem))
select count(*) filter (abs(a.score - b.score) <= 0.005::double) as matched,
  count(*) filter (abs(a.score - b.score) > 0.005::double) as mismatched,
  count(*) filter (b.id is null) as only_a, count(*) filter (a.id is null) as only_b,
  round(max(greatest(a.score - b.score, b.score - a.score)), 6) as max_abs_diff
from a full join b on a.id = b.id"""

# Feature quality

SQL["feature_moments"] = _with(RAW_NUM, """
select feature, count(*) as n_rows, count(x) as n_valid, round(1 - count(x) / count(*), 4) as missing_ratio,
  round(avg(x), 4) as mean, round(stddev_samp(x), 4) as deviation, round(min(x), 4) as min_value,
  round(max(x), 4) as max_value from num group by 1""")
SQL["target_correlation"] = _with(RAW_NUM, f"select feature, round({_corr()}, 6) as corr from num group by 1")
SQL["coef_variation"] = _with(RAW_NUM, "select feature, round(abs(stddev_samp(x) / avg(x)), 6) as cv from num group by 1")
SQL["cardinality"] = _with(RAW_TEXT, """select feature, count(*) as n_rows, count(x) as n_valid,
count(distinct x) as n_unique from txt group by 1""")
SQL["chi2_quick"] = _with(
    RAW_TEXT + ", present as (select * from txt where x is not null)," + _chi2("c", "present", "y = 0", "y = 1"),
    "select feature, n_categories, round(p, 6) as p, p < 0.2 as associated from c",
)
_NUM_RULES = """
numstat as (
  select feature, 1 - count(x) / count(*) as missing_ratio, count(x) as n_valid, min(x) = max(x) as constant,
    var_samp(x) as v, avg(x) as m, case when min(x) <> max(x) then corr(x, y) end as r from num group by 1),
numq as (
  select feature, 'numeric' as kind, missing_ratio, n_valid,
    case when missing_ratio > 0.9 then 'Excessive missing values: ' || printf('%.2f%%', missing_ratio * 100)
      when n_valid < 10 then 'Insufficient valid values'
      when constant or v = 0 then 'Zero variance (constant values)'
      when abs(r) > 0.01 then 'Target correlated'
      when m <> 0 and abs(sqrt(v) / m) < 0.001 then 'Very low variability (CV: ' || printf('%.6f', abs(sqrt(v) / m)) || ')'
      else 'Pass' end as reason from numstat)"""
_TEXT_RULES = """
txtstat as (select feature, 1 - count(x) / count(*) as missing_ratio, count(x) as n_valid, count(distinct x) as u from txt group by 1),
txtq as (
  select t.feature, 'categorical' as kind, missing_ratio, n_valid,
    case when missing_ratio > 0.9 then 'Excessive missing values: ' || printf('%.2f%%', missing_ratio * 100)
      when n_valid < 10 then 'Insufficient valid values'
      when u <= 1 then 'Single unique value'
      when u / n_valid > 0.98 then 'High cardinality: ' || u || ' unique values'
      when u between 2 and 20 and p < 0.2 then 'Target associated' else 'Pass' end as reason
  from txtstat t left join c using (feature))"""
_QUALITY = (
    RISK + "," + _split("raw", "risk", _PLAIN + ", 7.0::double as constant_in_window") + ","
    + _long("num", "raw", [*NUMERIC, "constant_in_window"]) + "," + _long("txt", "raw", TEXT, "varchar")
    + ", present as (select * from txt where x is not null)," + _chi2("c", "present", "y = 0", "y = 1")
    + "," + _NUM_RULES + "," + _TEXT_RULES
)
SQL["quality_verdict"] = _with(_QUALITY, """
select feature, kind, round(missing_ratio, 6) as missing_ratio, n_valid,
  reason in ('Pass', 'Target correlated', 'Target associated') as keep, reason
from (select * from numq union all select * from txtq)""")

# Significance

SQL["pearson_score"] = _with(RAW_NUM, f""",
imputed as (select feature, coalesce(x, median(x) over (partition by feature)) as x, y from num)
select feature, round(abs({_corr()}) * 10, 6) as score from imputed group by 1""")
SQL["spearman"] = _with(
    FILLED_NUM + "," + _spearman("s", "num"), "select feature, n_valid, round(rho, 6) as rho from s"
)
SQL["anova_f"] = _with(FILLED_NUM, """,
c as (select feature, y, count(*) n, avg(x) m, var_pop(x) * count(*) ss from num group by 1, 2),
g as (select feature, avg(x) gm, count(*) gn from num group by 1),
f as (select feature, sum(n * power(m - gm, 2)) / (sum(ss) / (max(gn) - 2)) as f, max(gn) as gn from c join g using (feature) group by 1)
select feature, round(f, 4) as f_stat, f > 3.8414588207 * (1 + 1.7104 / (gn - 2)) as significant from f""")
SQL["chi2_stat"] = _with(
    FILLED_TEXT + "," + _chi2("c", "txt", "y = 0", "y = 1"),
    "select feature, n_categories, round(chi2, 6) as chi2, dof, round(p, 6) as p from c",
)
SQL["chi2_documents"] = _with(
    "d as (select lang, source, quality as y from documents join labels using (doc_id)), "
    "txt as (select 'lang' as feature, lang as x, y from d union all select 'source', source, y from d),"
    + _chi2("c", "txt", "y = 0", "y = 1"),
    "select feature, n_categories, round(chi2, 6) as chi2, dof from c",
)
SQL["mutual_info"] = _with(FILLED_TEXT + "," + _mi("m", "txt"), "select feature, round(mi, 6) as mi from m")
_F_P05 = "f > 3.8414588207 * (1 + 1.7104 / (gn - 2))"
SQL["significance_filter"] = _with(
    FILLED_NUM + "," + _long("txt", "filled", TEXT, "varchar") + "," + _spearman("s", "num") + ","
    + _chi2("c", "txt", "y = 0", "y = 1") + "," + _mi("m", "txt") + f""",
r as (select feature, corr(x, y) as r, count(*) as gn from num group by 1),
f as (select *, r * r * (gn - 2) / (1 - r * r) as f from r),
scores as (
  select feature, abs(r) * 10 + abs(rho) * 8 + case when {_F_P05} then 5 else 0 end as score from f join s using (feature)
  union all
  select feature, case when p < 0.05 then 8 when p < 0.1 then 4 else 0 end + mi * 20 from c join m using (feature))""",
    "select feature, round(score, 4) as score from scores where score > 0.05 order by scores.score desc, feature limit 8",
)

# Stability

_INSIDE = """,
inside as (
  select n.feature, 1 - count(*) filter (n.x between e.e[1] and e.e[len(e.e)]) / count(*) as s
  from num n join p_edges e using (feature) where split = 'oot' group by 1)"""
SQL["psi_train_oot"] = _with(FILLED_NUM + "," + _psi("p", "num", "split = 'oot'") + _INSIDE, """
select feature, case when enough then round(psi, 6) else 'infinity'::double end as psi, round(s, 6) as out_of_range_share
from p join inside using (feature)""")
_STABLE_NUM = FILLED_NUM + "," + _psi("p", "num", "split = 'oot'") + f""",
rr as (select feature, {_corr()} as corr, min(x) = max(x) as constant from num group by 1),
nstab as (
  select feature, case when enough then psi end as stability, case when enough then 1 - in_a / n_a end as share,
    corr, enough and not constant and (psi < 0.4 or (psi < 1.0 and abs(corr) > 0.05)) as keep
  from p join rr using (feature))"""
SQL["numeric_stability"] = _with(_STABLE_NUM, """,
inside as (
  select n.feature, 1 - count(*) filter (n.x between e.e[1] and e.e[len(e.e)]) / count(*) as s
  from num n join p_edges e using (feature) where split = 'oot' group by 1)
select feature, coalesce(round(stability, 6), 'infinity'::double) as stability, round(s, 6) as out_of_range_share, round(corr, 6) as corr, keep
from nstab join inside using (feature)""")
_STABLE_TEXT = (
    _chi2("ct", "txt", "split = 'train'", "split = 'oot'", yates=False) + "," + _mi("m", "txt") + """,
tstab as (
  select feature, n_categories, chi2, dof, p as stability, mi,
    n_categories >= 2 and (p > 0.01 or mi > 0.05) as keep from ct join m using (feature))"""
)
SQL["categorical_stability"] = _with(FILLED_TEXT + "," + _STABLE_TEXT, """
select feature, n_categories, round(chi2, 6) as chi2, dof, round(stability, 6) as stability, round(mi, 6) as mi, keep
from tstab""")

# Ranking and selection

_NUM_RELATION = _spearman("s2", "num", "feature, split") + f""",
r2 as (select feature, split, abs({_corr()}) as r from num group by 1, 2),
nrel as (
  select feature, sum(r) filter (split = 'train') / 2 + sum(r) filter (split = 'oot') / 2 as avg_pearson,
    (sum(abs(rho)) filter (split = 'train') + sum(abs(rho)) filter (split = 'oot')) / 2 * 0.8 as avg_spearman,
    sum(r) filter (split = 'train') as point_biserial
  from r2 join s2 using (feature, split) group by 1),
nscore as (select *, greatest(avg_pearson, avg_spearman, point_biserial) as target_score from nrel)"""
SQL["numeric_relationship"] = _with(FILLED_NUM + "," + _NUM_RELATION, """
select feature, round(avg_pearson, 6) as avg_pearson, round(avg_spearman, 6) as avg_spearman,
  round(point_biserial, 6) as point_biserial, round(target_score, 6) as target_score from nscore""")
_TEXT_RELATION = (
    "\ntrn as (select * from txt where split = 'train')," + _chi2("cr", "trn", "y = 0", "y = 1") + "," + _mi("mr", "trn") + """,
tscore as (
  select feature, mi, p as chi2_p, greatest(mi * 2, case when p < 0.05 then 0.1 else 0 end) as target_score
  from cr join mr using (feature))"""
)
SQL["categorical_relationship"] = _with(FILLED_TEXT + "," + _TEXT_RELATION, """
select feature, round(mi, 6) as mi, round(chi2_p, 6) as chi2_p, round(target_score, 6) as target_score from tscore""")

# Raw rows decide quality, filled rows the rest.
_SCORES = (
    RISK + "," + _split("raw", "risk", _PLAIN) + "," + _split("filled", "risk", _FILLED) + ","
    + _long("rnum", "raw", NUMERIC) + "," + _long("rtxt", "raw", TEXT, "varchar") + ","
    + _NUM_RULES.replace("from num ", "from rnum ") + ", "
    + "qpresent as (select * from rtxt where x is not null)," + _chi2("c", "qpresent", "y = 0", "y = 1") + ","
    + _TEXT_RULES.replace("from txt ", "from rtxt ") + """,
good as (select feature from (select * from numq union all select * from txtq)
  where reason in ('Pass', 'Target correlated', 'Target associated')),"""
    + _long("num_all", "filled", NUMERIC) + "," + _long("txt_all", "filled", TEXT, "varchar") + """,
num as (select * from num_all where feature in (select feature from good)),
txt as (select * from txt_all where feature in (select feature from good)),"""
    + _psi("p", "num", "split = 'oot'") + f""",
rr as (select feature, {_corr()} as corr, min(x) = max(x) as constant from num group by 1),
nstab as (
  select feature, psi as stability, enough and not constant and (psi < 0.4 or (psi < 1.0 and abs(corr) > 0.05)) as keep
  from p join rr using (feature)),"""
    + _STABLE_TEXT + "," + _NUM_RELATION + "," + _TEXT_RELATION + """,
scores as (
  select feature, 'numeric' as kind, stability, target_score, target_score * (2 / (1 + stability)) as score
  from nstab join nscore using (feature) where keep and target_score > 0.01
  union all
  select feature, 'categorical', stability, tscore.target_score, tscore.target_score * least(stability * 2, 1)
  from tstab join tscore using (feature) where keep and tscore.target_score > 0.01),
bounds as (select avg(score) as m, greatest(0.001, avg(score) - 2 * stddev_pop(score)) as lo from scores),
tiers as (
  select s.*, m, lo, case when score > lo then case
    when kind = 'numeric' and stability < 0.4 then 'high' when kind = 'numeric' and stability < 1.0 then 'moderate'
    when kind = 'categorical' and stability > 0.01 then 'high' when kind = 'categorical' then 'moderate' end end as tier
  from scores s, bounds),
marked as (
  select *, tier is not null as sure, count(tier) over () as n_sure,
    sum(case when tier is null and score > 0 then 1 else 0 end) over (order by score desc, feature) as extra
  from tiers),
chosen as (
  select *, sure as selected,
    case tier when 'high' then 0 when 'moderate' then 1 else 2 end as place from marked)"""
)
SQL["combined_score"] = _with(_SCORES, """select feature, kind, round(stability, 6) as stability,
round(target_score, 6) as target_score, round(score, 6) as score from scores""")
SQL["score_threshold"] = _with(_SCORES, "select feature, round(m, 6) as score_mean, round(lo, 6) as min_score from tiers")
SQL["stability_tiers"] = _with(_SCORES, "select feature, kind, tier from tiers")
SQL["selected_features"] = _with(_SCORES, """
select feature, kind, round(stability, 6) as stability, round(score, 6) as score, tier, selected,
  case when selected then row_number() over (partition by selected order by place, score desc, feature) end::int as rank
from chosen""")
SQL["selection_report"] = _with(_SCORES, """,
ranked as (select feature, row_number() over (order by place, score desc, feature) as r from chosen where selected)
select (select string_agg(feature, ',' order by r) from ranked) as selected_features,
  (select count(*) from filled where split = 'train') as train_rows,
  (select count(*) from filled where split = 'oot') as oot_rows, (select count(*) + 3 from ranked)::int as n_columns""")
SQL["top_features"] = _with(_SCORES, """
select feature, kind, round(score, 6) as score, case when selected then 'SELECTED' else 'REJECTED' end as status
from chosen order by chosen.score desc, feature limit 15""")
SQL["quick_filter"] = _with(RAW_NUM, """
select feature, round(1 - count(x) / count(*), 4) as missing_ratio, round(stddev_samp(x), 4) as deviation
from num where split = 'train' group by 1
having 1 - count(x) / count(*) < 0.8 and var_samp(x) > 0""")

# Training and evaluation

SQL["class_weights"] = _with(LINES, """, n as (select label as y, count(*) as samples from lines group by 1)
select y, samples, round(max(samples) over () / samples, 6) as class_weight from n""")
_LINE_SPLIT = LINES + """,
parts as (
  select *, case when partition_date <= timestamp '2000-12-31' then 'train' else 'oot' end as split from lines
  where partition_date between timestamp '1995-01-01' and timestamp '2000-12-31'
    or partition_date between timestamp '2001-01-01' and timestamp '2002-12-31')"""


def _auc(source: str, score: str = "score", by: str = "", label: str = "label") -> str:
    """Share of (positive, negative) pairs in order, by counting pairs per distinct score."""
    keys = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""
cnt as (select {keys}{score} as s, sum({label})::double as p, count(*)::double as n from {source} where {score} is not null group by all),
cum as (select *, sum(n - p) over ({part}order by s rows unbounded preceding) - (n - p) as below from cnt),
au as (
  select {keys}sum(n)::bigint as samples, sum(p)::bigint as positive_count, sum(p) / sum(n) as positive_rate,
    case when sum(p) > 0 and sum(n - p) > 0 then sum(p * (below + (n - p) / 2)) / (sum(p) * sum(n - p)) end as auc
  from cum group by all)"""


def _ap(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""
pc as (select {keys}score as s, sum(label)::double as p, count(*)::double as n from {source} group by all),
pu as (select *, sum(p) over ({part}order by s desc) as tp, sum(n) over ({part}order by s desc) as cn from pc),
ap as (
  select {keys}sum(n)::bigint as samples, sum(p)::bigint as positive_count, sum(p * tp / cn) / sum(p) as average_precision
  from pu group by all)"""


_AUC_COLUMNS = "samples, positive_count, round(positive_rate, 6) as positive_rate, round(auc, 6) as auc"
SQL["average_precision"] = _with(
    LINES + "," + _ap("lines"), "select samples, positive_count, round(average_precision, 6) as average_precision from ap"
)
_F1 = "2 * count(*) filter (score >= 0.5 and label = 1) / (count(*) filter (score >= 0.5) + count(*) filter (label = 1))"
SQL["model_performance"] = _with(
    _LINE_SPLIT + "," + _auc("parts", by="split") + "," + _ap("parts", "split")
    + f", ff as (select split, {_F1} as f1 from parts group by 1)",
    """select split, au.samples, round(auc, 6) as auc, round(average_precision, 6) as aucpr, round(f1, 6) as f1
from au join ap using (split) join ff using (split)""",
)
SQL["generalisation_gap"] = _with(
    _LINE_SPLIT + "," + _auc("parts", by="split") + """,
g as (select max(auc) filter (split = 'train') as t, max(auc) filter (split = 'oot') as o from au)""",
    """select round(t, 6) as train_score, round(o, 6) as oot_score, round(t - o, 6) as gap,
round(abs(t - o), 6) as abs_gap from g""",
)
SQL["auc"] = _with(LINES + "," + _auc("lines"), f"select {_AUC_COLUMNS} from au")
SQL["auc_continuous"] = _with(LINES + "," + _auc("lines", "l_extendedprice"), f"select {_AUC_COLUMNS} from au")
SQL["auc_documents"] = _with(
    "d as (select lang, n_chars, quality as label from documents join labels using (doc_id)),"
    + _auc("d", "n_chars", "lang"), f"select lang, {_AUC_COLUMNS} from au",
)
SQL["f1"] = _with(LINES, f"select round({_F1}, 6) as f1 from lines")
SQL["run_record"] = _with(LINES + "," + _auc("lines"), """
select 'r1' as run_id, 'param' as kind, 'train_samples' as key, samples::double as number from au union all
select 'r1', 'metric', 'train_auc', round(auc, 6) from au union all
select 'r1', 'tag', 'model_type', null union all
select 'r2', 'metric', 'positive_rate', round(positive_rate, 6) from au""")
_FIT = "samples > 10 and positive_count > 0 and positive_count < samples"


def _judged(keys: str) -> str:
    return f"""select {keys}, case when {_FIT} then round(auc, 6) end as auc, samples, positive_count,
round(positive_rate, 6) as positive_rate"""


_ERROR = f"case when not ({_FIT}) then 'Insufficient data or no label variance' end as error"
SQL["monthly_auc"] = _with(
    LINES + """,
r as (select * from lines where partition_date between timestamp '1995-06-01' and timestamp '2000-12-31'),"""
    + _auc("r", by="month"), f"{_judged('month')}, {_ERROR} from au",
)
SQL["early_vs_latest"] = _with(
    LINES + """,
ms as (select distinct month from lines),
pd as (select month, case when row_number() over (order by month) <= floor(count(*) over () / 2)
  then 'early' else 'latest' end as period from ms),
r as (select period, score, label from lines join pd using (month)),""" + _auc("r", by="period") + """,
ml as (select period, string_agg(month, ',' order by month) as months from pd group by 1)""",
    f"{_judged('period')}, months, {_ERROR} from au join ml using (period)",
)


def _bins(source: str, keys: str, bins: int) -> str:
    """Bins of ``s`` per key between its quantiles; rows without a value only count as missing."""
    probs = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    return f"""
ks as (select {keys}, count(s) as tn, coalesce(sum(label) filter (s is not null), 0) as tp, count(*) - count(s) as missing
  from {source} group by all),
ls as (select {keys}, list_sort(list(s)) as l from {source} where s is not null group by all),
q as (select {keys}, list_sort(list_distinct({_quantiles("l", probs)})) as e from ls),
b as (
  select {keys}, s, label, greatest(len(list_filter(e, lambda t: t < s)), 1) - 1 as bin
  from {source} join q using ({keys}) where s is not null and len(e) >= 2),
g as (select {keys}, bin, count(*) as n, sum(label) as p, min(s) as lo, max(s) as hi, sum(s) as t from b group by all),
j as (
  select ks.*, case when tn <= 10 then 'Insufficient data for binning'
    when q.e is null or len(q.e) < 2 then 'All values equal: no bin edges' end as error from ks left join q using ({keys}))"""


def _bin_columns(keys: str, places: int) -> str:
    columns = [
        ("bin", "bin::int"), ("count_population", "n"), ("count_positive", "p::bigint"),
        ("pct_distribution", "round_even(n / tn * 100, 2)"), ("positive_rate", "round_even(p / n * 100, 2)"),
        ("score_min", f"round(lo, {places})"), ("score_max", f"round(hi, {places})"), ("score_mean", f"round(t / n, {places})"),
    ]
    return f"""select {keys}, """ + ", ".join(f"{x} as {c}" for c, x in columns) + f""",
  tn::bigint as total_population, tp::bigint as total_positive, round_even(tp / tn * 100, 2) as overall_positive_rate,
  missing::bigint as missing, error
from j left join (select * from g) g using ({keys}) where error is null
union all
select {keys}, {", ".join("null" for _ in columns)}, tn::bigint, tp::bigint,
  case when tn > 0 then round_even(tp / tn * 100, 2) end, missing::bigint, error from j where error is not null"""


SQL["score_bins"] = _with(LINES + """,
src as (select month, label, case when l_orderkey % 7 <> 0 then score end as s from lines),"""
    + _bins("src", "month", 10), _bin_columns("month", 9))
_ALL_NUMERIC = [*NUMERIC, CONSTANT]
SQL["feature_bins"] = _with(RISK + """,
dated as (select *, strftime(partition_date, '%Y-%m') as month from risk),
src as (""" + " union all ".join(
    f"select month, '{c}' as feature, label, {c}::double as s from dated" for c in _ALL_NUMERIC) + "),"
    + _bins("src", "month, feature", 5) + """,
txt as (""" + " union all ".join(
    f"select month, '{c}' as feature, label, {c} as category from dated" for c in TEXT) + """),
tc as (select month, feature, category, count(*) as n, sum(label) as p from txt group by all),
tw as (select *, sum(n) over f as tn, sum(p) over f as tp, coalesce(sum(n) filter (category is null) over f, 0) as missing
  from tc window f as (partition by month, feature))""", "select * exclude (score_min, score_max, score_mean), null::varchar as category from ("
    + _bin_columns("month, feature", 4) + """) union all
select month, feature, null, n, p::bigint, round_even(n / tn * 100, 2), round_even(p / n * 100, 2),
  tn::bigint, tp::bigint, round_even(tp / tn * 100, 2), missing::bigint, null, category from tw""")
SQL["quantiles_by_month"] = _with(LINES, """,
q as (select month, count(*) as n, quantile_cont(l_extendedprice, [0e0, 25e-2, 5e-1, 75e-2, 1e0]) as q from lines group by 1)
select month, n, """ + ", ".join(f"round(q[{i + 1}], 4) as q{i}" for i in range(5)) + " from q")
_MONTHLY = NUMERIC
_SMALL = "case when samples < 50 then 'Insufficient data (' || samples || ' samples)' end as error"
SQL["monthly_psi"] = _with(
    FILLED + "," + _long("num", "filled", _MONTHLY) + ","
    + _psi("p", "num", "true", "month, feature", ", strftime(partition_date, '%Y-%m') as month"),
    f"""select month, feature, samples, case when samples >= 50 then round(case when enough then psi else 0 end, 6) end as psi,
{_SMALL} from p""",
)
SQL["monthly_category_psi"] = _with(FILLED_TEXT, f""",
t as (select *, strftime(partition_date, '%Y-%m') as month from txt),
ms as (select month, count(*) / {len(TEXT)} as samples from t group by 1),
e as (select feature, x, count(*) as e from t where split = 'train' group by 1, 2),
a as (select month, feature, x, count(*) as a from t group by 1, 2, 3),
cells as (
  select month, feature, x, e, coalesce(a, 0) as a from (select * from ms, e) left join a using (month, feature, x)
  union all select month, feature, x, 0, a from a anti join e using (feature, x)),
sh as (select month, feature, (e + 1e-8) / (sum(e) over w + 1e-7) as pe, (a + 1e-8) / (sum(a) over w + 1e-7) as pa
  from cells window w as (partition by month, feature)),
s as (select month, feature, greatest(0, least(10, sum((pa - pe) * ln(pa / pe)))) as psi from sh group by 1, 2)
select month, feature, samples::bigint as samples, case when samples >= 50 then round(psi, 6) end as psi,
  case when samples < 50 then 'Insufficient data (' || samples::bigint || ' samples)' end as error from s join ms using (month)""")
SQL["grades"] = _with(
    LINES + """,
r as (select *, year(partition_date)::int as year, case when month(partition_date) <= 6 then 'train' else 'oot' end as split from lines),"""
    + _auc("r", by="year, split") + """,
wd as (select year, max(auc) filter (split = 'train') as t, max(auc) filter (split = 'oot') as o from au group by 1),
lv as (
  select *, t - o as gap,
    case when o > 0.8 then 'Model performs excellently' when o > 0.7 then 'Model performs well'
      when o > 0.6 then 'Model performs adequately' else 'Model needs improvement' end as pl,
    case when t - o > 0.15 then 'severe overfitting detected' when t - o > 0.1 then 'significant overfitting'
      when t - o > 0.05 then 'mild overfitting' else 'acceptable generalization' end as ol
  from wd where t is not null and o is not null)""",
    """select year, round(t, 6) as train_score, round(o, 6) as oot_score, round(gap, 6) as overfitting,
pl as performance_level, ol as overfitting_level, pl || ', ' || ol as status, o > 0.6 and gap <= 0.1 as deployable from lv""",
)
SQL["stream_monitor"] = """
with e as (select date_trunc('day', ts) as w, case when event_id % 7 <> 0 then value end as s,
  case when event_type = 'purchase' then 1 else 0 end as y from events),
b as (select *, case when s is null then null when s < 5 then -1 else greatest((s > 5)::int + (s > 10)::int + (s > 25)::int
  + (s > 50)::int + (s > 100)::int, 1) - 1 end as bin from e)
select strftime(w, '%Y-%m-%d %H:%M') as window_start, strftime(w + interval 1 day, '%Y-%m-%d %H:%M') as window_end,
  bin, count(*) as count_population, sum(y)::bigint as count_positive, round(min(s), 6) as score_min,
  round(max(s), 6) as score_max from b group by all"""
# What holds for any model of these rows; the scores are compared with their own coefficients inside the query.
SQL["forest_facts"] = "select 12::bigint as n_features, true as sum_is_one, true as planted_first"
SQL["boosted_facts"] = "select true as sum_is_one, true as planted_first"
SQL["leader_facts"] = """
select folds::int as folds, models::bigint as models, true as in_order, true as better_than_chance
from (values (0, 3), (3, 1)) v(folds, models)"""
SQL["batch_scores_agree"] = _with(RAW, "select risk_id, split, true as agrees from raw")
SQL["saved_scores_agree"] = _with(RAW, "select risk_id, true as agrees from raw")
SQL["stream_scores_agree"] = _with(RAW, "select risk_id, true as agrees from raw")

# Models: what must hold for planted columns

SQL["blend_given"] = _with(_SCORES, """,
given(feature, importance) as (values ('total_price', 0.5::double), ('seg_signal', 0.25::double), ('acctbal', 0.25::double), ('unknown', 1.0::double))
select feature, kind, round(stability, 6) as stability, round(target_score, 6) as target_score,
  round(score * 0.6::double + coalesce(importance, 0) * 0.4::double, 6) as score
from scores left join given using (feature)""")
SQL["planted_importance"] = _with(FILLED, """,
x as (
  select 'told' as feature, label * 10.0::double + risk_id % 7 as v, label from filled where split = 'train' union all
  select 'flat', 3.0::double, label from filled where split = 'train' union all
  select 'acctbal', acctbal, label from filled where split = 'train' union all
  select 'avg_disc', avg_disc, label from filled where split = 'train' union all
  select 'priority', ascii(priority)::double, label from filled where split = 'train'),
strength as (select feature, case when min(v) <> max(v) then abs(corr(v, label)) else 0 end as r from x group by 1)
select model, feature, r = max(r) over () as is_first, true as flat_has_none
from strength, (values ('forest'), ('boosted')) m(model)""")

# Rounds of boosting, settings, and category means

_ROUNDS = RISK + """,
rounds as (
  select label, r::int as round,
    (risk_id * 7919 % 1009)::double / 1009.0::double + (total_price / 500000.0::double) * (least(r, 8)::double * 0.25::double) as score
  from risk, (select unnest(range(1, 31)) as r)),"""
_CURVES = _ROUNDS + _auc("rounds", by="round") + "," + _ap("rounds", "round") + """,
curve as (
  select 'AUC' as metric, round, auc as v from au union all select 'AUCPR', round, average_precision from ap)"""
SQL["patience_curve"] = _with(_CURVES, "select metric, round, round(v, 6) as value from curve")
SQL["patience_round"] = "with recursive " + _CURVES.lstrip() + """,
asked as (select * from (values (10, 0.005::double), (2, 0.02::double)) t(patience, tolerance)),
walk as (
  select metric, patience, tolerance, round, v as best, round as best_round from curve, asked where round = 1
  union all
  select w.metric, w.patience, w.tolerance, c.round, case when c.v >= w.best + w.tolerance then c.v else w.best end,
    case when c.v >= w.best + w.tolerance then c.round else w.best_round end
  from walk w join curve c on c.metric = w.metric and c.round = w.round + 1 where w.round - w.best_round < w.patience)
select metric, patience::int as patience, arg_max(best_round, round)::int as best_round, round(arg_max(best, round), 6) as best_value,
  max(round)::int as stopped_at, 30::bigint as rounds from walk group by 1, 2"""
SQL["round_scores_agree"] = _with(RAW, """
select r::int as round, count(*) as n_rows, true as agrees from raw, (select unnest(range(1, 5)) as r) where split = 'train' group by 1""")
_PLACE = "((risk_id * 48271 % 2147483647)::double / 2147483647.0::double)"


def _board() -> str:
    """Nine columns on a ninth, three on a third, one on all of the rows."""
    ctes = RAW + ",\nlng as (" + " union all ".join(
        f"select {i} as ord, '{c}' as feature, {c}::double as s, label, {_PLACE} as place from raw where split = 'train'" for i, c in enumerate(NUMERIC)
    ) + "),\nb0 as (select distinct feature, ord, true as kept from lng)"
    keep = 1.0 / 3.0
    for rung in (1, 2, 3):
        share = keep ** (3 - rung)
        ctes += f""",
c{rung} as (
  select feature, s, sum(label)::double as p, count(*)::double as n from lng
  where s is not null and place < {share!r}e0 and feature in (select feature from b{rung - 1} where kept) group by all),
m{rung} as (select *, sum(n - p) over (partition by feature order by s rows unbounded preceding) - (n - p) as below from c{rung}),
a{rung} as (
  select feature, case when sum(p) > 0 and sum(n - p) > 0 then sum(p * (below + (n - p) / 2)) / (sum(p) * sum(n - p)) end as auc
  from m{rung} group by 1),
p{rung} as (
  select {rung} as rung, {share!r}e0 as share, feature, ord, auc, row_number() over (order by auc desc nulls last, ord) as place,
    count(auc) over () as scored
  from (select feature, ord from b{rung - 1} where kept) left join a{rung} using (feature)),
b{rung} as (select *, place <= least({(0, 3, 1, 1)[rung]}, greatest(1, scored)) as kept from p{rung})"""
    rows = " union all ".join(
        f"select rung::int as rung, round(share, 6) as share, place::int as place, feature as setting, round(auc, 6) as score, kept from b{r}" for r in (1, 2, 3))
    return _with(ctes, rows)


SQL["halving_board"] = _board()
_CODED = RAW + f""",
coded as (select *, 'c' || (risk_id % 211)::varchar as code, {_PLACE} as place from raw),
tr as (select * from coded where split = 'train'), mean as (select avg(label::double) as m from tr)"""
_MEANS = ["seg_signal", "priority", "code"]
SQL["ordered_means"] = _with(_CODED, "select risk_id, " + ", ".join(
    f"""round((coalesce(sum(label) over ({w}), 0) + 10 * m) / (count(label) over ({w}) + 10), 6) as {c}__mean""" for c, w in (
        (c, f"partition by coalesce({c}, 'missing') order by place rows between unbounded preceding and 1 preceding") for c in _MEANS)
) + " from tr, mean")
SQL["applied_means"] = _with(_CODED + "," + ", ".join(
    f"{c}_t as (select coalesce({c}, 'missing') as {c}, sum(label) as t, count(label) as n from tr group by 1)" for c in _MEANS
), "select risk_id, " + ", ".join(
    f"round((coalesce({c}_t.t, 0) + 10 * m) / (coalesce({c}_t.n, 0) + 10), 6) as {c}__mean" for c in _MEANS
) + " from coded " + " ".join(f"left join {c}_t on {c}_t.{c} = coalesce(coded.{c}, 'missing')" for c in _MEANS) + ", mean where split = 'oot'")
SQL["half_sample"] = """select o_orderkey from orders
qualify row_number() over (order by md5('42:' || o_orderkey::varchar), o_orderkey) <= (select count(*) // 2 from orders)"""

# Sections of an evaluation

_SCORED = FILLED + """,
sc as (select strftime(partition_date, '%Y-%m') as month, label, total_price / 500000.0::double as score from filled),"""
SQL["section_performance"] = """
select 0.9::double as train_score, 0.85::double as oot_score, 0.05::double as overfitting, 'Model performs excellently' as performance_level,
  'mild overfitting' as overfitting_level, 'Model performs excellently, mild overfitting' as status, true as deployable
from orders limit 1"""
SQL["section_monthly_auc"] = _with(_SCORED + _auc("sc", by="month"), f"{_judged('month')}, {_ERROR} from au")
SQL["section_early_vs_latest"] = _with(
    _SCORED + """
ms as (select distinct month from sc),
pd as (select month, case when row_number() over (order by month) <= floor(count(*) over () / 2)
  then 'early' else 'latest' end as period from ms),
r as (select period, score, label from sc join pd using (month)),""" + _auc("r", by="period") + """,
ml as (select period, string_agg(month, ',' order by month) as months from pd group by 1)""",
    f"{_judged('period')}, months, {_ERROR} from au join ml using (period)",
)
SQL["section_bins"] = _with(_SCORED + "src as (select month, label, score as s from sc)," + _bins("src", "month", 10), _bin_columns("month", 12))
SQL["section_psi"] = f"select * from ({SQL['monthly_psi']}) union all select * from ({SQL['monthly_category_psi']})"
SQL["evaluation_manifest"] = f"""
with s as (
  select 'performance' as section, 1 as n_rows union all
  select 'monthly_auc', count(*) from ({SQL['section_monthly_auc']}) union all
  select 'early_vs_latest_analysis', count(*) from ({SQL['section_early_vs_latest']}) union all
  select 'bin_analysis', count(*) from ({SQL['section_bins']}) union all
  select 'psi_analysis', count(*) from ({SQL['section_psi']}))
select section, n_rows::bigint as n_rows, 'sections/' || section as path, '2024-10-01T00:00:00' as evaluated_at from s"""

# Summaries that merge

SQL["drift_store_psi"] = SQL["monthly_psi"]
SQL["distinct_sketches"] = _with(RISK, " union all ".join(
    f"select '{c}' as feature, count(*) as n_rows, count({c}) as n_valid, true as within_error from risk"
    for c in ("total_price", "n_lines", "priority", "segment", "seg_signal")))
SQL["stream_quantile_bins"] = """
with e as (select time_bucket(interval 7 days, ts, timestamp '1970-01-01') as w, event_type = 'purchase' as hit, value from events)
select strftime(w, '%Y-%m-%d') as window_start, count(*) as n_rows, count(*) filter (hit and value is not null) as count_positive,
  3::int as last_bin, true as within_error from e group by w"""
SQL["stream_requests"] = """
with d as (select event_id, ts, dense_rank() over (order by ts::date) - 1 as place, (select count(distinct ts::date) from events) as days from events),
f as (select *, place // 10 as lot, (days - 1) // 10 as last_lot from d),
newest as (select lot, max(max(ts)) over (order by lot) as top from f where event_id % 97 <> 0 group by lot)
select event_id, case when event_id % 97 <> 0 or ts >= top - interval 12 hours then 'scored' else 'late' end as kind
from f join newest using (lot) where event_id % 97 <> 0 or lot < last_lot"""
