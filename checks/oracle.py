"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from checks.housing import HOUSING_CTE
from holdfast import config

ORACLE: dict[str, str] = {}

HEAVY = config.HEAVY_TAILED_COLUMNS
RATIO_SQL = {
    "rooms_per_household": ("total_rooms", "households"),
    "bedrooms_per_room": ("total_bedrooms", "total_rooms"),
    "population_per_household": ("population", "households"),
}


def r(x: str, digits: int = 6) -> str:
    return f"(round(cast({x} as double), {digits}) + 0.0)"


def h(body: str, *ctes: str) -> str:
    """A statement over the housing view ``h``."""
    return "with " + ", ".join([HOUSING_CTE, *ctes]) + " " + body


def band(x: str, edges: list[float]) -> str:
    cases = " ".join(f"when {x} <= {e} then {i + 1}" for i, e in enumerate(edges[1:]))
    return f"(case when {x} is null or {x} <= {edges[0]} then null {cases} else {len(edges)} end)"


INCOME = band("median_income", [0.0, 1.5, 3.0, 4.5, 6.0])
ACCOUNT = band("c_acctbal", [0.0, 1500.0, 3000.0, 4500.0, 6000.0])
DOCS = """docs as (select d.doc_id, d.lang, d.source, d.n_chars, cast(l.quality as double) as quality,
 cast(l.toxic as double) as toxic from documents d left join labels l on d.doc_id = l.doc_id)"""


def safe(a: str, b: str) -> str:
    return f"(case when {a} is null or {b} is null or {b} = 0 then 0.0 else {a} / {b} end)"


# --- split ------------------------------------------------------------------------------


def strata(source: str, band_sql: str, level: str, minimum: int) -> str:
    return f"""k0 as (select *, {level} as lv, concat(coalesce(cast({band_sql} as varchar), '<NA>'), '|', {level}) as fk from {source}),
 k1 as (select fk, lv, count(*) as c from k0 group by fk, lv),
 k2 as (select lv from k1 group by lv having min(c) < {minimum}),
 ks as (select k0.*, case when k2.lv is not null then k0.lv else k0.fk end as stratum from k0 left join k2 on k0.lv = k2.lv)"""


def allocation(source: str = "ks") -> str:
    return f"""a0 as (select stratum, count(*) as c from {source} group by stratum),
 a1 as (select cast(sum(c) as bigint) as n, cast(ceil(0.2 * sum(c)) as bigint) as n_test from a0),
 a2 as (select stratum, c, (c * (n - n_test)) // n as base, (c * (n - n_test)) % n as rest, n - n_test as n_train from a0, a1),
 a3 as (select stratum, c, base, row_number() over (order by rest desc, stratum) as pos,
   n_train - sum(base) over () as spare from a2),
 alloc as (select stratum, c - base - (case when pos <= spare then 1 else 0 end) as take from a3)"""


def sides(key: str, seed: str = "'42'") -> str:
    return f"""sd as (select ks.*, case when row_number() over (partition by ks.stratum
   order by md5(concat_ws('|', {seed}, cast({key} as varchar))), {key}) <= alloc.take then 'test' else 'train' end as side
   from ks join alloc on ks.stratum = alloc.stratum)"""


HOUSE_SPLIT = [strata("h", INCOME, "ocean_proximity", 2), allocation(), sides("id")]
CUSTOMER_SPLIT = [strata("customer", ACCOUNT, "cast(c_nationkey as varchar)", 2), allocation(), sides("c_custkey")]


def seeds_sql(key_cte: str) -> str:
    return h(
        """select cast(sdx.seed as integer) as seed, ocean_proximity, count(*) filter (where not t) as train,
 count(*) filter (where t) as test from sdx group by all""",
        key_cte,
        allocation(),
        """sdx as (select s.seed, ks.*, row_number() over (partition by s.seed, ks.stratum
   order by md5(concat_ws('|', s.seed, cast(id as varchar))), id) <= alloc.take as t
   from ks join alloc on ks.stratum = alloc.stratum, (values ('0'), ('1'), ('7'), ('42'), ('2024')) s(seed))""",
    )


def folds(source: str, key: str, k: int) -> str:
    return f"""fo as (select *, cast(ntile({k}) over (order by md5(concat_ws('|', '42', cast({key} as varchar))), {key}) - 1 as integer) as fold from {source})"""


# --- metrics -------------------------------------------------------------------------------


def metrics(y: str, p: str, digits: int = 5) -> str:
    return f"""{r(f'sqrt(avg(({y} - {p}) * ({y} - {p})))', digits)} as rmse, {r(f'avg(abs({y} - {p}))', digits)} as mae,
 {r(f'''case when count(*) < 2 then null when var_pop({y}) > 0 then 1 - sum(({y} - {p}) * ({y} - {p})) / (count(*) * var_pop({y}))
 when sum(({y} - {p}) * ({y} - {p})) = 0 then 1.0 else 0.0 end''', digits)} as r2, count(*) as n"""


def segment_rows(source: str, p: str, extra: str = "") -> str:
    cens = "(median_house_value >= 500001 or median_house_value <= 14999)"
    inland = "(ocean_proximity = 'INLAND')"
    masks = {"all": "true", "uncensored": f"not {cens}", "censored": cens, "inland": inland, "coastal": f"not {inland}"}
    return " union all ".join(
        f"select {extra} '{s}' as segment, {metrics('median_house_value', p)} from {source} where {m}" for s, m in masks.items()
    )


LINE = "(30000.0::double + 28000.0 * median_income)"
MEAN = "200000.0::double"


# --- sources ----------------------------------------------------------------------------------

ORACLE["src_csv"] = h("select * from h")
ORACLE["src_resolve"] = h("select count(*) as n_rows, 10 as n_columns from h")
ORACLE["sink_record_json"] = h(
    """select 42 as seed, count(*) filter (where side = 'train') as n_train, count(*) filter (where side = 'test') as n_test,
 'dummy,ridge,rf,lgbm,stack' as arms from sd""", *HOUSE_SPLIT
)
ORACLE["compare"] = h(
    f"""select 'mean' as arm, {metrics('median_house_value', MEAN)} from h union all
 select 'line', {metrics('median_house_value', LINE)} from h"""
)
ORACLE["sink_headline_csv"] = ORACLE["compare"]
ORACLE["headline"] = ORACLE["compare"].replace("'mean'", "'flat'")

# --- contract ------------------------------------------------------------------------------------

ORACLE["check_types"] = h(
    """select * from (select 'total_rooms' as "column", count(*) filter (where a is not null and try_cast(a as double) is null) as n_bad from t
 union all select 'population', count(*) filter (where b is not null and try_cast(b as double) is null) from t) where n_bad > 0""",
    """t as (select case when id % 53 = 0 then 'n/a' else cast(total_rooms as varchar) end as a,
 case when id % 71 = 0 then '1,234' else cast(population as varchar) end as b from h)""",
)
_RULES = {"l_quantity": (2.0, 49.0), "l_discount": (0.0, 0.09), "l_tax": (0.0, 1.0), "l_extendedprice": (1000.0, 90000.0)}


def _violations(source: str, rules) -> str:
    parts = " union all ".join(
        f"""select '{c}' as "column", count(*) as n_bad, {r(f'min({c})')} as min_bad, {r(f'max({c})')} as max_bad
 from {source} where {c} < {a}::double or {c} > {b}::double"""
        for c, (a, b) in rules.items()
    )
    return f"select * from ({parts}) where n_bad > 0"


ORACLE["check_ranges"] = _violations("lineitem", _RULES)
ORACLE["check_features_only"] = _violations("customer", {"c_acctbal": (0.0, 9000.0)})
ORACLE["check_log_domain"] = h("select * from (" + " union all ".join(
    f"""select '{c}' as "column", count(*) filter (where {c} <= -1) as n_bad, {r(f'min({c})')} as min_value from h"""
    for c in ("longitude", "total_rooms", "median_income")
) + ") where n_bad > 0")

# --- projections -----------------------------------------------------------------------------------

ORACLE["safe_divide"] = f"select l_orderkey, l_linenumber, {r(safe('l_tax', 'l_discount'))} as ratio from lineitem"
_RATIOS = ", ".join(f"{r(safe(a, b))} as {n}" for n, (a, b) in RATIO_SQL.items())
ORACLE["ratios_only"] = h(f"select id, {_RATIOS} from h")
ORACLE["ratios"] = h("select id, " + ", ".join(f"{r(c)} as {c}" for c in HEAVY) + f", {_RATIOS} from h")
ORACLE["log1p"] = f"select event_id, {r('ln(1 + value)')} as logged from events"
ORACLE["expm1"] = f"select event_id, {r('value')} as back from events"
_X = "(c_acctbal / 1000.0::double)"


def yj(x: str, lam: float) -> str:
    up = f"ln(1 + {x})" if lam == 0 else f"(pow({x} + 1, {lam}) - 1) / {lam}"
    down = f"-ln(1 - {x})" if lam == 2 else f"-(pow(1 - {x}, {2 - lam}) - 1) / {2 - lam}"
    return f"(case when {x} >= 0 then {up} when {x} < 0 then {down} end)"


ORACLE["yeo_johnson_apply"] = "select c_custkey, " + ", ".join(
    f"{r(yj(_X, v))} as yj_{k}" for k, v in {"a": 0.5, "b": 0.0, "c": 2.0, "d": -0.25}.items()
) + " from customer"
ORACLE["clip_apply"] = f"""with {DOCS} select doc_id, cast(case when n_chars < 200 then 200 when n_chars > 5000 then 5000 else n_chars end as double) as n_chars,
 case when quality < 0.25 then 0.25::double when quality > 0.75 then 0.75::double else quality end as quality from docs"""
ORACLE["scale_apply"] = f"select event_id, {r('(value - 50) / 12.5')} as scaled, {r('value - 50')} as unscaled from events"
_P = ("cast(embedding[1] as double)", "cast(embedding[2] as double)")
ORACLE["rbf_similarity"] = "select vec_id, " + ", ".join(
    f"{r(f'exp(-3.0::double * (pow({_P[0]} - ({a}), 2) + pow({_P[1]} - ({b}), 2)))')} as geo_cluster_{i}_similarity"
    for i, (a, b) in enumerate([(0.0, 0.0), (0.1, -0.1), (-0.2, 0.3)])
) + " from embeddings"
ORACLE["income_band"] = f"select c_custkey, {ACCOUNT} as band from customer"
ORACLE["composite_key"] = f"select c_custkey, concat(coalesce(cast({ACCOUNT} as varchar), '<NA>'), '|', cast(c_nationkey as varchar)) as key from customer"
ORACLE["censored_mask"] = "select l_orderkey, l_linenumber, (l_quantity >= 50 or l_quantity <= 1) as censored from lineitem"
ORACLE["category_mask"] = "select doc_id, coalesce(lang = 'en', false) as inside, not coalesce(lang = 'en', false) as outside from documents"
ORACLE["null_flag"] = f"with {DOCS} select doc_id, quality is null as quality_missing from docs"
ORACLE["ordinal_declared"] = """select o_orderkey, case o_orderpriority when '1-URGENT' then 0.0::double when '2-HIGH' then 1.0 when '3-MEDIUM' then 2.0
 when '4-NOT SPECIFIED' then 3.0 else -1.0 end as o_orderpriority from orders"""
ORACLE["select_whitelist"] = h("select id, " + ", ".join(f"{r(c)} as {c}" for c in config.PLAIN_COLUMNS) + " from h")
ORACLE["drop_target"] = h("select * exclude (median_house_value) from h")
ORACLE["fan_out"] = h(f"select id, {r('median_income')} as raw, {r('ln(1 + median_income)')} as logged, {INCOME} as band from h")
ORACLE["sanitise_names"] = h("""select id, cast(ocean_proximity = '<1H OCEAN' as double) as "near (a; b)", cast(ocean_proximity = 'INLAND' as double) as "is lt1H OCEAN",
 cast(ocean_proximity = 'NEAR BAY' as double) as "is gt INLAND", cast(ocean_proximity = 'NEAR OCEAN' as double) as "x_y'z",
 cast(ocean_proximity = 'ISLAND' as double) as rest from h""")


def _unit(tag: str) -> str:
    text = f"substr(md5(concat_ws('|', '42|appraisal{tag}', cast(id as varchar))), 1, 13)"
    return f"((cast(cast('0x' || {text} as ubigint) as double) + 0.5) / 4503599627370496.0::double)"


ORACLE["derive_leaky_column"] = h(
    f"select id, {r(f'median_house_value * 0.98::double + sqrt(-2.0 * ln({_unit(chr(97))})) * cos(2.0 * pi() * {_unit(chr(98))}) * 5000.0', 3)} as appraisal from h"
)

# --- fitted numeric statistics -----------------------------------------------------------------------

for _name, _stat in (("impute_median", "median"), ("impute_mean", "avg")):
    ORACLE[_name] = f"""with {DOCS}, s as (select {_stat}(quality) as q, {_stat}(n_chars) as n from docs)
 select doc_id, {r('coalesce(quality, s.q)')} as quality, {r('coalesce(n_chars, s.n)')} as n_chars from docs, s"""
ORACLE["impute_knn"] = h(
    f"""select h.id, {r('coalesce(h.total_bedrooms, g.v)', 4)} as filled_total_bedrooms from h left join g on h.id = g.id""",
    """p as (select q.id, o.id as donor, o.total_bedrooms as v,
   sqrt(4.0::double / 3.0::double * (pow(q.total_rooms - o.total_rooms, 2) + pow(q.population - o.population, 2) + pow(q.households - o.households, 2))) as d
   from h q, h o where q.total_bedrooms is null and o.total_bedrooms is not null)""",
    "t as (select *, row_number() over (partition by id order by d, cast(donor as varchar)) as k from p qualify k <= 5)",
    "z as (select *, min(d) over (partition by id) as nearest from t)",
    """g as (select id, case when min(nearest) = 0 then avg(v) filter (where d = 0)
   else sum(v / d) / sum(1 / d) end as v from z group by id)""",
)
ORACLE["impute_iterative"] = "with recursive " + ", ".join([
    HOUSING_CTE,
    """m as (select cast(count(*) as double) as n, avg(total_rooms) as mx, avg(total_bedrooms) as my, var_pop(total_rooms) * count(*) as g,
   covar_pop(total_rooms, total_bedrooms) * count(*) as c, var_pop(total_bedrooms) * count(*) as t from h where total_bedrooms is not null)""",
    """it(i, alpha, lam, coef, done) as (select 0, 1 / (t / n + 2.220446049250313e-16), 1.0::double, cast(null as double), false from m
   union all select i + 1, (n - e + 2e-6) / (greatest(t - 2 * b * c + b * b * g, 0) + 2e-6), (e + 2e-6) / (b * b + 2e-6), b,
   coalesce(abs(b - coef) < 1e-3, false) from (select it.*, m.*, c / (g + lam / alpha) as b, alpha * g / (lam + alpha * g) as e
   from it, m where not done and i < 300) x)""",
    "b as (select c / (g + lam / alpha) as b, mx, my from it, m order by i desc limit 1)",
]) + f""" select id, {r('total_rooms', 4)} as total_rooms,
 {r('coalesce(total_bedrooms, b.my + b.b * (total_rooms - b.mx))', 4)} as total_bedrooms from h, b"""
ORACLE["impute_mode"] = """with d as (select doc_id, case when doc_id % 7 <> 0 then lang end as lang from documents),
 m as (select lang from d where lang is not null group by lang order by count(*) desc, lang limit 1)
 select doc_id, coalesce(d.lang, m.lang) as lang from d, m"""
ORACLE["yeo_johnson_fit"] = "with b as (select count(value) as n, sum(sign(value) * ln(1 + abs(value))) as s from events) " + " union all ".join(
    f"""select {i / 4}::double as lam, {r(f"-b.n / 2.0::double * (select ln(var_pop({yj('value', i / 4)})) from events) + ({i / 4} - 1) * b.s", 3)} as loglik from b"""
    for i in range(-4, 9)
)


def _scale(center: str, scale: str) -> str:
    return f"""with e as (select event_id, value, 3.0::double as same from events), s as (select {center} as c, {scale} as k from events)
 select event_id, {r('(value - c) / k')} as value, 0.0::double as same from e, s"""


ORACLE["scale_standard"] = _scale("avg(value)", "stddev_pop(value)")
ORACLE["scale_robust"] = _scale("median(value)", "quantile_cont(value, 0.75) - quantile_cont(value, 0.25)")
ORACLE["scale_minmax"] = _scale("min(value)", "max(value) - min(value)")
ORACLE["scale_none"] = f"select event_id, {r('value')} as value, 3.0::double as same from events"
ORACLE["deskew_none"] = f"select event_id, {r('value')} as value from events"
ORACLE["clip_fit"] = f"""with s as (select quantile_cont(n_chars::double, 0.05) as a, quantile_cont(n_chars::double, 0.95) as b from documents)
 select doc_id, {r('least(greatest(n_chars::double, a), b)')} as n_chars from documents, s"""


def numeric_ctes(names, logged: bool, tag: str) -> list[str]:
    filled = ", ".join(
        f"{'ln(1 + ' if logged else '('}coalesce({c}, (select median({c}) from h))) as {c}" for c in names
    )
    return [
        f"{tag}0 as (select id, {filled} from h)",
        f"{tag}1 as (select " + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in names) + f" from {tag}0)",
    ]


def numeric_out(names, prefix: str, tag: str) -> str:
    return ", ".join(f"{r(f'({tag}0.{c} - m_{c}) / s_{c}')} as {prefix}{c}" for c in names)


ORACLE["numeric_block"] = h(f"select id, {numeric_out(HEAVY, '', 'a')} from a0, a1", *numeric_ctes(HEAVY, True, "a"))
RATIO_CTES = [
    "r0 as (select id, " + ", ".join(f"coalesce({c}, (select median({c}) from h)) as {c}" for c in HEAVY) + " from h)",
    "r1 as (select id, " + ", ".join(f"{safe(a, b)} as {n}" for n, (a, b) in RATIO_SQL.items()) + " from r0)",
    "r2 as (select " + ", ".join(f"quantile_cont({n}, 0.001) as a_{n}, quantile_cont({n}, 0.999) as b_{n}" for n in RATIO_SQL) + " from r1)",
    "r3 as (select id, " + ", ".join(f"least(greatest({n}, a_{n}), b_{n}) as {n}" for n in RATIO_SQL) + " from r1, r2)",
    "r4 as (select " + ", ".join(f"avg({n}) as m_{n}, stddev_pop({n}) as s_{n}" for n in RATIO_SQL) + " from r3)",
]


def ratio_out(prefix: str) -> str:
    return ", ".join(f"{r(f'(r3.{n} - m_{n}) / s_{n}')} as {prefix}{n}" for n in RATIO_SQL)


ORACLE["ratio_block"] = h(f"select id, {ratio_out('')} from r3, r4", *RATIO_CTES)

# --- categories and bins -----------------------------------------------------------------------------------

ORACLE["onehot_infrequent"] = """with c as (select p_brand, count(*) >= 75 as often from part group by p_brand)
 select p_partkey, concat('p_brand_', c.p_brand) as feature, cast(part.p_brand = c.p_brand as double) as value from part, c where often
 union all select p_partkey, 'p_brand_infrequent_sklearn', cast(not often as double) from part join c using (p_brand)
 where exists (select 1 from c where not often)"""


def bin_edge(i: int, parts: int) -> str:
    """Averaged inverted distribution function by integer rank, from a sorted list ``a`` of length ``n``."""
    if i in (0, parts):
        return "a[1]" if i == 0 else "a[n]"
    whole = f"(n * {i}) // {parts}"
    return f"(case when (n * {i}) % {parts} = 0 then (a[{whole}] + a[{whole} + 1]) / 2 else a[{whole} + 1] end)"


ORACLE["bin_quantile"] = "with s as (select list_sort(list(value)) as a, count(value) as n from events) " + " union all ".join(
    f"select {i} as i, {r(bin_edge(i, 12))} as edge from s" for i in range(13)
)
ORACLE["bin_uniform"] = "with s as (select min(value) as a, max(value) as b from events) " + " union all ".join(
    f"select {i} as i, {r(f'a + (b - a) * {i} / 7.0::double')} as edge from s" for i in range(8)
)
ORACLE["bin_kmeans"] = f"""with recursive v as (select cast(value as double) as x from events where value is not null),
 ends as (select min(x) as a, max(x) as b from v),
 it(i, c, done) as (select 0, [a + (b - a) * (j + 0.5) / 5 for j in range(5)], false from ends
  union all
  select any_value(i) + 1, list_sort(list(coalesce(m, c[k]) order by k)), bool_and(abs(coalesce(m, c[k]) - c[k]) <= 1e-12 * abs(c[k])) from (
   select it.i, it.c, ks.k, (select avg(x) from v where (ks.k = 1 or x >= (it.c[ks.k - 1] + it.c[ks.k]) / 2)
    and (ks.k = 5 or x < (it.c[ks.k] + it.c[ks.k + 1]) / 2)) as m from it, range(1, 6) ks(k) where not it.done and it.i < 300) r
  having count(*) > 0),
 f as (select c from it order by i desc limit 1)
select j as i, {r('case j when 0 then a when 5 then b else (c[j] + c[j + 1]) / 2 end')} as edge from f, ends, (select cast(range as integer) as j from range(6))"""
ORACLE["bin_apply"] = """select l_orderkey, l_linenumber, cast((l_quantity >= 10)::int + (l_quantity >= 20)::int + (l_quantity >= 30)::int as double) as bin from lineitem"""
ORACLE["bin_encode"] = """select event_id, cast(value < 10 as double) as bin_0, cast(value >= 10 and value < 50 as double) as bin_1,
 cast(value >= 50 as double) as bin_2 from events"""


def bin_ctes(column: str, parts: int) -> str:
    return f"e_{column} as (select " + ", ".join(
        f"{bin_edge(i, parts)} as e{i}" for i in range(1, parts)
    ) + f" from (select list_sort(list({column})) as a, count({column}) as n from h))"


def bin_code(column: str, parts: int) -> str:
    return "(" + " + ".join(f"({column} >= e_{column}.e{i})::int" for i in range(1, parts)) + ")"


ORACLE["binned_block"] = h(
    "select id, " + ", ".join(f"cast({bin_code(c, 5)} as double) as {c}" for c in config.BINNED_COLUMNS)
    + " from h, " + ", ".join(f"e_{c}" for c in config.BINNED_COLUMNS),
    *[bin_ctes(c, 5) for c in config.BINNED_COLUMNS],
)
ORACLE["ordinal_learned"] = """with s as (select lang, row_number() over (order by lang) - 1 as code from (select distinct lang from documents))
 select doc_id, cast(code as double) as lang from documents join s using (lang)"""
ORACLE["ordinal_learned_wide"] = """with n as (select c_custkey, cast(c_custkey as varchar) as name from customer),
 s as (select name, cast(row_number() over (order by name) - 1 as double) as code from n where c_custkey % 2 = 0)
 select c_custkey, coalesce(code, -1) as name from n left join s using (name)"""
_MODE = ORACLE["impute_mode"].replace("with d as", "d as").split(" select doc_id, coalesce")[0].rstrip()
_FILLED = "f as (select doc_id, coalesce(d.lang, m.lang) as lang from d, m)"
ORACLE["categorical_block"] = f"with {_MODE}, {_FILLED}, c as (select lang, count(*) as n, sum(count(*)) over () as t from f group by lang) " + (
    "select doc_id, cast(lang = 'en' as double) as lang_en, cast(lang in (select lang from c where n < 0.15 * t) as double) as lang_infrequent_sklearn from f"
)
ORACLE["geo_lloyd_round"] = h(
    f"""select {r('sum(w * latitude) / sum(w)')} as latitude, {r('sum(w * longitude) / sum(w)')} as longitude from n group by k""",
    """n as (select *, greatest(population, 1e-9) as w, case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end as k from
 (select *, pow(latitude - 34, 2) + pow(longitude + 118, 2) as d0, pow(latitude - 37.5, 2) + pow(longitude + 122, 2) as d1,
 pow(latitude - 40, 2) + pow(longitude + 120, 2) as d2 from h))""",
)
_LEVELS = {"<1H OCEAN": "lt1H OCEAN", "INLAND": "INLAND", "NEAR BAY": "NEAR BAY", "NEAR OCEAN": "NEAR OCEAN"}
_BRANCHES = (
    f"select h.id, {ratio_out('ratios__')}, {numeric_out(HEAVY, 'heavy__', 'a')}, {numeric_out(config.PLAIN_COLUMNS, 'plain__', 'b')}, "
    + ", ".join(f"""cast(ocean_proximity = '{v}' as double) as "categorical__ocean_proximity_{n}" """ for v, n in _LEVELS.items())
    + ", cast(ocean_proximity = 'ISLAND' as double) as categorical__ocean_proximity_infrequent_sklearn, "
    + ", ".join(
        f"cast({bin_code('h.' + c, 5).replace('e_h.', 'e_')} = {i} as double) as binned__{c}_{i}_0"
        for c in config.BINNED_COLUMNS for i in range(5)
    )
    + " from h join r3 using (id) join a0 using (id) join b0 using (id), r4, a1, "
    + "(select " + ", ".join(f"m_{c}, s_{c}" for c in config.PLAIN_COLUMNS) + " from b1) b1, "
    + ", ".join(f"e_{c}" for c in config.BINNED_COLUMNS)
)
_BRANCH_CTES = [
    *RATIO_CTES, *numeric_ctes(HEAVY, True, "a"), *numeric_ctes(config.PLAIN_COLUMNS, False, "b"), *[bin_ctes(c, 5) for c in config.BINNED_COLUMNS],
]
ORACLE["preprocessor_exact_branches"] = h(_BRANCHES, *_BRANCH_CTES)


def _geo_ctes(start: list[list[float]], rounds: int) -> list[str]:
    """Centres after each round of weighted k-means; cc holds the last ones in order."""
    out = ["c0 as (select * from (values " + ", ".join(f"({i}, {a}::double, {b}::double)" for i, (a, b) in enumerate(start)) + ") v(j, la, lo))"]
    for i in range(rounds):
        out.append(
            f"g{i} as (select h.id, any_value(latitude) as y, any_value(longitude) as x, any_value(greatest(population, 1e-9)) as w, "
            f"arg_min(j, (latitude - la) * (latitude - la) + (longitude - lo) * (longitude - lo)) as k from h, c{i} group by h.id)"
        )
        out.append(f"c{i + 1} as (select k as j, sum(w * y) / sum(w) as la, sum(w * x) / sum(w) as lo from g{i} group by k)")
    return [*out, f"cc as (select cast(row_number() over (order by la, lo) - 1 as integer) as j, la, lo from c{rounds})"]


#: As in the queries.
GEO_START, GEO_ROUNDS = [[33.0 + 0.9 * i, -123.5 + (0.7 * i * i) % 8.0] for i in range(10)], 3
ORACLE["preprocessor"] = h(
    "select e.*, " + ", ".join(
        f"round(exp(-((latitude - la_{i}) * (latitude - la_{i}) + (longitude - lo_{i}) * (longitude - lo_{i}))), 6) + 0.0 as geo__geo_cluster_{i}_similarity"
        for i in range(10)
    ) + f" from ({_BRANCHES}) e join h using (id), cp",
    *_BRANCH_CTES, *_geo_ctes(GEO_START, GEO_ROUNDS),
    "cp as (select " + ", ".join(f"max({v}) filter (where j = {i}) as {v}_{i}" for i in range(10) for v in ("la", "lo")) + " from cc)",
)
ORACLE["geo_centroids"] = h(f"select j as cluster, {r('la')} as latitude, {r('lo')} as longitude from cc", *_geo_ctes(GEO_START, GEO_ROUNDS))
ORACLE["geo_kmeans_fit"] = h(
    f"select k as cluster, count(*) as n, {r('sum(population)', 4)} as population from gg group by k", *_geo_ctes(GEO_START, GEO_ROUNDS),
    """gg as (select h.id, any_value(population) as population, arg_min(j, (latitude - la) * (latitude - la) + (longitude - lo) * (longitude - lo)) as k
 from h, cc group by h.id)""",
)

_NAMES = (
    [f"geo__geo_cluster_{i}_similarity" for i in range(10)]
    + [f"ratios__{n}" for n in RATIO_SQL]
    + [f"heavy__{c}" for c in HEAVY]
    + [f"plain__{c}" for c in config.PLAIN_COLUMNS]
    + [f"categorical__ocean_proximity_{n}" for n in [*_LEVELS.values(), "infrequent_sklearn"]]
    + [f"binned__{c}_{i}_0" for c in config.BINNED_COLUMNS for i in range(5)]
)
ORACLE["feature_names"] = "select * from (values " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(_NAMES)) + ") v(position, name)"

# --- profile ----------------------------------------------------------------------------------------------------

ORACLE["profile_censoring"] = h("""select count(*) filter (where median_house_value = 500001) as at_cap,
 count(*) filter (where median_house_value = 14999) as at_floor, min(median_house_value) as min_value, max(median_house_value) as max_value from h""")


def _histogram(x: str, bins: int) -> str:
    return f"""s as (select min({x})::double as lo, (max({x})::double - min({x})::double) / {bins} as w from SOURCE),
 c as (select least(cast(floor(({x}::double - lo) / w) as bigint), {bins - 1}) as bin, count(*) as n from SOURCE, s where {x} is not null group by 1)"""


def _histogram_out(bins: int) -> str:
    return f"""select g.bin, {r('lo + g.bin * w')} as low, {r('lo + (g.bin + 1) * w')} as high, coalesce(c.n, 0) as n
 from (select range as bin from range({bins})) g left join c on g.bin = c.bin, s"""


ORACLE["histogram"] = h(_histogram_out(120), _histogram("median_house_value", 120).replace("SOURCE", "h"))
ORACLE["histogram_tails"] = "with " + _histogram("n_chars", 60).replace("SOURCE", "documents") + " " + _histogram_out(60)
ORACLE["value_counts"] = "select lang, count(*) as n from documents where lang is not null group by lang"
ORACLE["value_shares"] = f"select event_type, {r('count(*) / sum(count(*)) over ()')} as share from events where event_type is not null group by event_type"
ORACLE["rare_levels"] = "select p_brand, count(*) as n, count(*) < 75 as rare from part where p_brand is not null group by p_brand"
ORACLE["geo_grid"] = h(f"""select cast(floor(longitude / 0.5) as bigint) as lon_cell, cast(floor(latitude / 0.5) as bigint) as lat_cell, count(*) as n,
 {r('avg(median_house_value)', 4)} as avg_value, {r('sum(population)', 4)} as population from h group by 1, 2""")
_NUMERIC = [*config.NUMERIC_COLUMNS, config.TARGET]
ORACLE["corr_matrix"] = h(" union all ".join(
    f"""select '{a}' as "column", '{b}' as other, {r(f'corr({a}, {b})')} as corr from h""" for a in _NUMERIC for b in _NUMERIC
))
ORACLE["missing_by_level"] = h(f"""select ocean_proximity, cast(sum((total_bedrooms is null)::int) as bigint) as missing,
 {r('avg((total_bedrooms is null)::int)')} as share, count(*) as n from h group by rollup (ocean_proximity)""")
ORACLE["null_counts"] = f"""with {DOCS} select * from (select 'quality' as "column", count(*) filter (where quality is null) as nulls from docs
 union all select 'toxic', count(*) filter (where toxic is null) from docs
 union all select 'lang', count(*) filter (where lang is null) from docs
 union all select 'source', count(*) filter (where source is null) from docs
 union all select 'n_chars', count(*) filter (where n_chars is null) from docs) where nulls > 0"""
ORACLE["skew"] = h(" union all ".join(
    f"""select '{c}' as "column", {r(f'skewness({c})')} as skew, {r(f'skewness(ln(1 + {c}))')} as skew_log1p from h""" for c in HEAVY
))
ORACLE["band_shares"] = h(
    f"""select b.band, {r("count(x.bd) / (select count(*) from x)")} as whole,
 {r("count(x.bd) filter (where side = 'train') / (select count(*) from x where side = 'train')")} as train,
 {r("count(x.bd) filter (where side = 'test') / (select count(*) from x where side = 'test')")} as test
 from (values (1), (2), (3), (4), (5)) b(band) left join x on x.bd = b.band group by b.band""",
    *HOUSE_SPLIT, f"x as (select {INCOME} as bd, side from sd where {INCOME} is not null)",
)
ORACLE["row_counts"] = h(
    """select count(*) as n_rows, 11 as n_columns, count(*) filter (where side = 'train') as n_train,
 count(*) filter (where side = 'test') as n_test from sd""", *HOUSE_SPLIT
)
ORACLE["profile_all"] = h("""select * from (values (0, 'censoring', 1), (1, 'target_histogram', 120),
 (2, 'rare_levels', (select count(distinct ocean_proximity) from h)),
 (3, 'geo_grid', (select count(*) from (select distinct floor(longitude / 0.5), floor(latitude / 0.5) from h))),
 (4, 'correlations', 81), (5, 'missing_by_level', (select count(distinct ocean_proximity) + 1 from h)), (6, 'skew', 4),
 (7, 'band_shares', 5), (8, 'coverage', (select count(distinct ocean_proximity) from h))) v(position, profile, n_rows)""")
_HALF = "sum(cast('0x' || substr(md5(t), {at}, 13) as ubigint))"
ORACLE["table_digest"] = f"""select count(*) as n, concat(cast({_HALF.format(at=1)} as varchar), '-', cast({_HALF.format(at=14)} as varchar)) as digest
 from (select concat_ws('|', cast(o_orderkey as varchar), cast(o_custkey as varchar), o_orderstatus,
 cast(cast(round(o_totalprice * 100) as bigint) as varchar), cast(cast(floor(epoch(o_orderdate)) as bigint) as varchar), o_orderpriority) as t from orders)"""

# --- split, folds, samples ------------------------------------------------------------------------------------------

ORACLE["strat_key"] = "with " + strata("customer", ACCOUNT, "cast(c_nationkey as varchar)", 8) + " select c_custkey, stratum from ks"
ORACLE["strat_impossible"] = "with " + strata("customer", ACCOUNT, "cast(c_nationkey as varchar)", 60) + """
 select stratum, count(*) as n from ks group by stratum having count(*) < 60"""
ORACLE["split_stratified"] = h("select id, side from sd", *HOUSE_SPLIT)
ORACLE["split_customer"] = "with " + ", ".join(CUSTOMER_SPLIT) + " select c_custkey, stratum, side from sd"
ORACLE["split_many_strata"] = "with " + ", ".join([
    strata("lineitem", "l_orderkey", "l_returnflag", 1), allocation(),
    """sd as (select ks.*, case when row_number() over (partition by ks.stratum
   order by md5(concat_ws('|', '42', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
   cast(l_partkey as varchar), cast(l_suppkey as varchar)))) <= alloc.take then 'test' else 'train' end as side
   from ks join alloc on ks.stratum = alloc.stratum)""",
]) + " select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, side from sd"
ORACLE["split_partition_check"] = h(
    """select 0 as on_both, 0 as lost, 0 as added, count(*) filter (where side = 'train') as n_train,
 count(*) filter (where side = 'test') as n_test from sd""", *HOUSE_SPLIT
)
ORACLE["coverage_report"] = h(
    """select ocean_proximity, count(*) filter (where side = 'train') as train, count(*) filter (where side = 'test') as test
 from sd group by ocean_proximity""", *HOUSE_SPLIT
)
ORACLE["coverage_by_seed"] = seeds_sql(strata("h", INCOME, "ocean_proximity", 2))
ORACLE["split_naive_band"] = seeds_sql(f"ks as (select *, coalesce(cast({INCOME} as varchar), '<NA>') as stratum from h)")
ORACLE["kfold"] = "with " + folds("customer", "c_custkey", 7) + " select c_custkey, fold from fo"
ORACLE["sample_n"] = """select o_orderkey, o_custkey from orders
 order by md5(concat_ws('|', '42', cast(o_orderkey as varchar))), o_orderkey limit 777"""
ORACLE["top_k"] = f"select c_custkey, {r('c_acctbal')} as c_acctbal from customer order by customer.c_acctbal, c_custkey limit 5"
ORACLE["sort_tables"] = "select p_type, count(*) as n from part where p_type is not null group by p_type order by n desc, p_type"

# --- alignment ---------------------------------------------------------------------------------------------------------

ORACLE["hconcat"] = h(
    f"""select id, {r('(median_income - a) / (b - a)')} as median_income, {r('(coalesce(total_bedrooms, m) - q2) / (q3 - q1)')} as total_bedrooms from h, s, t""",
    "s as (select min(median_income) as a, max(median_income) as b, median(total_bedrooms) as m from h)",
    """t as (select quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as q2, quantile_cont(x, 0.75) as q3
 from (select coalesce(total_bedrooms, m) as x from h, s))""",
)
ORACLE["align_labels"] = h("""select id, median_house_value from h order by md5(concat_ws('|', '42', cast(id as varchar))), id limit 500""")
ORACLE["align_counts"] = """with a as (select p_brand, count(*) as small from part where p_size <= 10 group by p_brand),
 b as (select p_brand, count(*) as dear from part where p_retailprice > 2080 group by p_brand)
 select coalesce(a.p_brand, b.p_brand) as p_brand, coalesce(small, 0) as small, coalesce(dear, 0) as dear from a full join b on a.p_brand = b.p_brand"""
ORACLE["apply_stats"] = h(
    "select id, " + ", ".join(
        f"{r(f'case when {c} < a_{c} then a_{c} when {c} > b_{c} then b_{c} else {c} end', 4)} as {c}" for c in HEAVY
    ) + " from h, s",
    "s as (select " + ", ".join(f"quantile_cont({c}, 0.01) as a_{c}, quantile_cont({c}, 0.99) as b_{c}" for c in HEAVY) + " from h)",
)

# --- metrics and models ----------------------------------------------------------------------------------------------------

ORACLE["regression_metrics"] = h(f"select ocean_proximity, {metrics('median_house_value', LINE)} from h group by ocean_proximity")
ORACLE["regression_metrics_edges"] = f"""with o as (select case when o_orderkey < 1 then 'one' when o_orderkey % 3 = 0 then 'same, exact'
 when o_orderkey % 3 = 1 then 'same, wrong' else 'varied' end as kind,
 case when o_orderkey % 3 < 2 then 5.0::double else o_totalprice end as y,
 case when o_orderkey % 3 = 0 then 5.0::double else 100000.0::double end as p from orders)
 select kind, {metrics('y', 'p')} from o group by kind"""
ORACLE["segment_table"] = h(segment_rows("h", LINE))
_MEDIAN_SPLIT = [*HOUSE_SPLIT, "md as (select median(median_house_value) as p from sd where side = 'train')"]
ORACLE["model_dummy"] = h("select id, p as prediction from sd, md where side = 'test'", *_MEDIAN_SPLIT)
ORACLE["segment_error_of_median"] = h(
    segment_rows("tt", "p"), *_MEDIAN_SPLIT, "tt as (select * from sd, md where side = 'test')"
)
ORACLE["predict"] = h(
    f"select id, {r('(median_income - m) / s')} as median_income, {r('p')} as prediction from sd, md, ms where side = 'test'",
    *_MEDIAN_SPLIT, "ms as (select avg(median_income) as m, stddev_pop(median_income) as s from sd where side = 'train')",
)
ORACLE["model_linear"] = h(
    f"select id, {r('c + b * median_income', 3)} as prediction from h, s",
    "s as (select regr_slope(median_house_value, median_income) as b, regr_intercept(median_house_value, median_income) as c from h)",
)
_SXY = """count(*) as n, avg(median_income) as mx, avg(median_house_value) as my, var_pop(median_income) * count(*) as sxx,
 covar_pop(median_income, median_house_value) * count(*) as sxy"""
ORACLE["model_ridge"] = h(
    f"select id, {r('my + sxy / (sxx + 5000) * (median_income - mx)', 3)} as prediction from sd, s where side = 'test'",
    *HOUSE_SPLIT, f"s as (select {_SXY} from sd where side = 'train')",
)
_FOLDS = folds("h", "id", 5)
_FIVE = "(values (0), (1), (2), (3), (4)) f(i)"
_DUMMY_FOLDS = [
    _FOLDS,
    f"fm as (select i, median(median_house_value) as p from fo, {_FIVE} where fold <> i group by i)",
    """fs as (select i, sqrt(avg(pow(median_house_value - p, 2)) filter (where fold = i)) as rmse,
 sqrt(avg(pow(median_house_value - p, 2)) filter (where fold <> i)) as rmse_t,
 avg(abs(median_house_value - p)) filter (where fold = i) as mae, avg(abs(median_house_value - p)) filter (where fold <> i) as mae_t,
 count(*) filter (where fold = i) as n_test, count(*) filter (where fold <> i) as n_train from fo, fm group by i)""",
]
_SUMMARY = f"""select {r('avg(rmse)', 4)} as rmse, {r('stddev_pop(rmse)', 4)} as rmse_std, {r('avg(rmse_t)', 4)} as rmse_train,
 {r('avg(mae)', 4)} as mae, {r('stddev_pop(mae)', 4)} as mae_std, {r('avg(mae_t)', 4)} as mae_train from fs"""
ORACLE["cv_scores"] = h(_SUMMARY, *_DUMMY_FOLDS)
ORACLE["train_vs_cv"] = h(
    f"select i as fold, {r('rmse_t', 4)} as train_rmse, {r('rmse', 4)} as cv_rmse, n_train, n_test from fs", *_DUMMY_FOLDS
)
_RIDGE_FOLDS = f"fx as (select i, {_SXY} from fo, {_FIVE} where fold <> i group by i)"
ORACLE["cv_scores_ridge"] = h(
    _SUMMARY, _FOLDS, _RIDGE_FOLDS,
    "fp as (select fo.*, i, my + sxy / (sxx + 100) * (median_income - mx) as p from fo, fx)",
    _DUMMY_FOLDS[2].replace("from fo, fm", "from fp"),
)
ORACLE["stack_out_of_fold"] = h(
    f"""select id, fold, {r('my + sxy / (sxx + 1) * (median_income - mx)', 3)} as oof_low,
 {r('my + sxy / (sxx + 100000) * (median_income - mx)', 3)} as oof_high from fo join fx on fo.fold = fx.i""",
    _FOLDS, _RIDGE_FOLDS,
)

_PENALTIES = "(values (1.0::double), (100.0), (10000.0), (30000.0), (100000.0), (1000000.0)) al(alpha)"
ORACLE["leaderboard"] = h(
    f"""select {r('avg(rmse)', 4)} as cv_rmse, {r('stddev_pop(rmse)', 4)} as cv_rmse_std, {r('avg(rmse_t)', 4)} as train_rmse
 from ts group by alpha order by avg(rmse) limit 3""",
    _FOLDS,
    f"""t0 as (select i, avg(median_income) as m1, avg(housing_median_age) as m2, avg(median_house_value) as my,
 var_pop(median_income) * count(*) as s11, var_pop(housing_median_age) * count(*) as s22, covar_pop(median_income, housing_median_age) * count(*) as s12,
 covar_pop(median_income, median_house_value) * count(*) as s1y, covar_pop(housing_median_age, median_house_value) * count(*) as s2y
 from fo, {_FIVE} where fold <> i group by i)""",
    f"""t1 as (select t0.*, alpha, ((s22 + alpha) * s1y - s12 * s2y) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) as w1,
 ((s11 + alpha) * s2y - s12 * s1y) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) as w2 from t0, {_PENALTIES})""",
    "t2 as (select alpha, i, fold, median_house_value - my - w1 * (median_income - m1) - w2 * (housing_median_age - m2) as e from fo, t1)",
    "ts as (select alpha, i, sqrt(avg(e * e) filter (where fold = i)) as rmse, sqrt(avg(e * e) filter (where fold <> i)) as rmse_t from t2 group by alpha, i)",
)
ORACLE["model_leafwise_splits"] = h(
    f"""select h.id, {r('my + leaf', 3)} as prediction from h, s0, s1, s2, lv
 where lv.hi = (housing_median_age > s1.t) and lv.upper = (lv.hi = s2.hi and housing_median_age > s2.t)""",
    "s0 as (select avg(median_house_value) as my from h)",
    "v0 as (select housing_median_age as a, count(*) as n, sum(median_house_value - my) as s from h, s0 group by 1)",
    "v1 as (select a, sum(n) over (order by a) as n, sum(s) over (order by a) as s, sum(n) over () as nn, sum(s) over () as ss from v0)",
    """s1 as (select arg_max(a, s * s / (n + 5) + (ss - s) * (ss - s) / (nn - n + 5)) as t from v1 where n >= 20 and nn - n >= 20)""",
    """v2 as (select a, a > t as hi, sum(n) over (partition by a > t order by a) as n, sum(s) over (partition by a > t order by a) as s,
 sum(n) over (partition by a > t) as nn, sum(s) over (partition by a > t) as ss from v0, s1)""",
    """s2 as (select a as t, hi from v2 where n >= 20 and nn - n >= 20
 order by s * s / (n + 5) + (ss - s) * (ss - s) / (nn - n + 5) - ss * ss / (nn + 5) desc limit 1)""",
    """lv as (select a > s1.t as hi, (a > s1.t) = s2.hi and a > s2.t as upper, sum(s) / (sum(n) + 5) as leaf from v0, s1, s2 group by 1, 2)""",
)

# --- interpretation ------------------------------------------------------------------------------------------------------------


def linear(**over: str) -> str:
    c = {n: over.get(n, n) for n in ("median_income", "latitude", "population", "total_bedrooms", "ocean_proximity")}
    return (
        f"(80000.0::double + 28000.0 * {c['median_income']} - 1200.0 * {c['latitude']} - 2.0 * {c['population']}"
        f" + 5.0 * coalesce({c['total_bedrooms']}, 0) + case when {c['ocean_proximity']} = 'INLAND' then -9000.0 else 0.0 end)"
    )


_TAGS = [*config.NUMERIC_COLUMNS, *config.CATEGORICAL_COLUMNS]
_SWAP = {c: f"case when t.col = '{c}' then a.{c} else b.{c} end" for c in _TAGS}
_IMPORTANCE = [
    "tg as (select col, rep from (values " + ", ".join(f"('{c}')" for c in _TAGS) + ") c(col), range(5) p(rep))",
    "hm as (select *, row_number() over (order by md5(concat_ws('|', '42', cast(id as varchar))), id) as place from h)",
    """aw as (select col, rep, h.*, row_number() over (partition by col, rep
   order by md5(concat_ws('|', '42', col, cast(rep as varchar), cast(id as varchar))), id) as place from h, tg)""",
    f"bs as (select sqrt(avg(pow(median_house_value - {linear()}, 2))) as base from h)",
    "im as (select t.col, t.rep, sqrt(avg(pow(b.median_house_value - "
    + linear(**{c: f"({s})" for c, s in _SWAP.items()})
    + ", 2))) - (select base from bs) as inc from aw a join tg t on a.col = t.col and a.rep = t.rep join hm b on a.place = b.place group by 1, 2)",
]
ORACLE["perm_importance"] = h(
    f"""select col as "column", {r('avg(inc)', 4)} as rmse_increase, {r('stddev_pop(inc)', 4)} as std from im group by col""", *_IMPORTANCE
)
ORACLE["importance_flag"] = h(
    """select col as "column", round(avg(inc), 4) - round(stddev_pop(inc), 4) <= 0 as unsupported from im group by col""", *_IMPORTANCE
)


def _plotting(p: float) -> str:
    aleph = f"(n * {p}::double + 0.4 + 0.2 * {p})"
    return f"(a[cast(floor({aleph}) as bigint)] * (1 - ({aleph} - floor({aleph}))) + a[cast(floor({aleph}) as bigint) + 1] * ({aleph} - floor({aleph})))"


ORACLE["partial_dependence"] = h(
    f"""select 'median_income' as feature, {r('v', 4)} as value, null as level, {r('base + 28000.0 * (v - mi)', 4)} as average from gr, bs
 union all select 'housing_median_age', {r('housing_median_age', 4)}, null, {r('base', 4)} from (select distinct housing_median_age from h), bs
 union all select 'ocean_proximity', null, ocean_proximity, {r("base - inl + case when ocean_proximity = 'INLAND' then -9000.0 else 0.0 end", 4)} from (select distinct ocean_proximity from h), bs""",
    "ls as (select list_sort(list(median_income)) as a, count(median_income) as n from h)",
    f"en as (select {_plotting(0.05)} as lo, {_plotting(0.95)} as hi from ls)",
    "gr as (select lo + (hi - lo) * range / 99 as v from en, range(100))",
    f"""bs as (select avg({linear()}) as base, avg(median_income) as mi,
 avg(case when ocean_proximity = 'INLAND' then -9000.0::double else 0.0 end) as inl from h)""",
)
ORACLE["select_k_best"] = h(
    f"""select "column", {r('c * c / (1 - c * c) * (n - 2)', 4)} as f from k order by c * c desc limit 4""",
    "k as (" + " union all ".join(
        f"""select '{c}' as "column", corr({c}, median_house_value) as c, regr_count({c}, median_house_value) as n from h""" for c in config.NUMERIC_COLUMNS
    ) + ")",
)

ORACLE["impute_median_infinite"] = f"""with e as (select event_id, case when event_id % 50 = 0 then 'inf'::double when event_id % 7 <> 0 then cast(value as double) end as v from events),
 m as (select quantile_cont(v, 0.5) as q from e where v is not null)
select event_id, case when coalesce(v, q) < 'inf'::double then {r('coalesce(v, q)')} end as value from e, m"""

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ORACLE["preprocessor_given"] = f"""with c as (select c_custkey, case when c_custkey % 9 <> 0 then cast(c_acctbal as double) end as raw, cast(c_nationkey as double) as k, c_mktsegment as s
 from customer),
 m as (select median(raw) as q from c),
 f as (select c_custkey, coalesce(raw, q) as b, k, s from c, m),
 z as (select avg(b) as mb, stddev_pop(b) as sb, avg(k) as mk, stddev_pop(k) as sk, list_sort(list(b)) as a, count(*) as n from f),
 e as (select *, {", ".join(f"{bin_edge(i, 4)} as e{i}" for i in range(1, 4))} from z),
 g as (select *, (b >= e1)::int + (b >= e2)::int + (b >= e3)::int as bin from f, e)
select c_custkey, {r('(b - mb) / sb')} as heavy__c_acctbal, {r('(k - mk) / sk')} as plain__c_nationkey,
 {", ".join(f"cast(s = '{level}' as double) as categorical__c_mktsegment_{level}" for level in SEGMENTS)},
 {", ".join(f"cast(bin = {i} as double) as binned__c_acctbal_{i}_0" for i in range(4))} from g"""
