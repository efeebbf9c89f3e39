"""The queries of :mod:`.queries` in SQL, put together from common table expressions."""

from __future__ import annotations

from .config import BASE_COLUMNS, EvaluationSpec, FeatureSpec, all_features

PAIR = "partition by code_agence, code_article order by week_id"


def over(first: str, last: str = "1 preceding", by: str = PAIR) -> str:
    return f"over ({by} rows between {first} and {last})"


BACK = lambda n, to=1: over(f"{n} preceding", f"{to} preceding")
PAST = over("unbounded preceding")
SEASON = over("unbounded preceding", by="partition by code_agence, code_article, num_sem order by annee")

SALES = """
lines as (
  select cast(isoyear(l_shipdate) as integer) as annee, cast(week(l_shipdate) as integer) as num_sem, cast(s_nationkey as bigint) as code_agence,
    cast(regexp_extract(p_brand, '([0-9]+)$', 1) as bigint) as code_article, l_quantity, l_extendedprice, l_discount, l_orderkey, l_shipdate,
    p_partkey, p_type, p_size, p_name
  from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey),
sparse as (
  select annee || '-' || lpad(cast(num_sem as varchar), 2, '0') as semaine, code_agence, code_article, cast(sum(l_quantity) as bigint) as quantite
  from lines group by 1, 2, 3),
dense as (
  select semaine, code_agence, code_article, cast(coalesce(s.quantite, 0) as bigint) as quantite,
    cast(split_part(semaine, '-', 1) as integer) as annee, cast(split_part(semaine, '-', 2) as integer) as num_sem
  from (select distinct code_agence, code_article from sparse) cross join (select distinct semaine from sparse)
    left join sparse s using (semaine, code_agence, code_article)),
ventes as (select *, annee * 100 + num_sem as week_id from dense where semaine <= '2001-22'),
"""

CLEAN = SALES + f"""
stats as (
  select code_agence, code_article, cast(sum(quantite) as bigint) as pair_sum, quantile_disc(quantite, 0.995) as pair_p995, quantile_disc(quantite, 0.5) as pair_median
  from ventes group by 1, 2),
capped as (
  select v.*, cast(pair_sum = 0 as tinyint) as is_dead_pair,
    case when pair_sum = 0 then null else greatest(cast(pair_p995 as double), pair_median * 2.0) end as cap
  from ventes v join stats using (code_agence, code_article)),
flagged as (select *, cast(coalesce(quantite > cap, false) as tinyint) as is_capped, cast(case when quantite > cap then cap else quantite end as double) as v from capped),
based as (select *, quantile_disc(v, 0.5) {BACK(26)} as past from flagged),
cleaned0 as (
  select semaine, annee, num_sem, week_id, code_agence, code_article, quantite as quantite_raw,
    cast(trunc(case when past > 0 and v > past * 10 then past else v end) as bigint) as quantite,
    cast(coalesce(past > 0 and v > past * 10, false) as tinyint) as is_anomaly, is_capped, is_dead_pair from based),
cleaned as (select *, avg(quantite) {BACK(13)} as quantite_smooth from cleaned0),
"""

PANEL = CLEAN + """
unioned as (
  select semaine, annee, num_sem, week_id, code_agence, code_article, quantite_raw, quantite, quantite_smooth, is_anomaly, is_capped, is_dead_pair from cleaned
  union all
  select semaine, annee, num_sem, annee * 100 + num_sem, code_agence, code_article, null, null, null, 0, 0, 0 from dense where semaine between '2001-23' and '2001-44'),
panel as (
  select * exclude (is_anomaly, is_capped, is_dead_pair), cast(is_anomaly as tinyint) as is_anomaly, cast(is_capped as tinyint) as is_capped,
    cast(max(is_dead_pair) over (partition by code_agence, code_article) as tinyint) as is_dead_pair,
    cast(quantite as double) as y, case when quantite = 0 then 1.0 else 0.0 end as z from unioned),
"""

DIMENSIONS = """
articles as (
  select code_agence, code_article, min_by(p_type, p_partkey) as specialite, cast(min_by(p_size, p_partkey) as varchar) as famille, min_by(p_name, p_partkey) as marque,
    code_article % 2 as article_mdd from lines group by code_agence, code_article),
""" + "".join(f"""
codes_{c} as (select {c}, cast(dense_rank() over (order by {c} nulls first) - 1 as integer) as code from (select distinct {c} from articles)),""" for c in ("specialite", "famille", "marque", "article_mdd")) + """
item_codes as (
  select code_agence, code_article, s.code as art_specialite_enc, f.code as art_famille_enc, m.code as art_marque_enc, d.code as art_mdd_enc
  from articles left join codes_specialite s using (specialite) left join codes_famille f using (famille) left join codes_marque m using (marque)
    left join codes_article_mdd d using (article_mdd)),
agences as (select cast(n_nationkey as bigint) as code_agence, r_name as region from nation join region on n_regionkey = r_regionkey),
group_codes as (
  select code_agence, code as ag_region_enc
  from agences join (select region, cast(dense_rank() over (order by region nulls first) - 1 as integer) as code from (select distinct region from agences)) using (region)),
facturation as (
  select code_agence, code_article, cast(year(l_shipdate) as integer) as annee, cast(month(l_shipdate) as integer) as mois, sum(l_extendedprice * (1 - l_discount)) as sum_montant,
    sum(l_quantity) as sum_quantite, count(*) as nb_achats, count(*) filter (where c_mktsegment in ('BUILDING', 'MACHINERY')) as nb_achats_par_professionnels,
    count(distinct o_custkey) as nb_chantiers
  from lines join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1, 2, 3, 4),
lagged as (
  select code_agence, code_article, cast(case when mois > 10 then annee + 1 else annee end as integer) as _join_annee, cast(case when mois > 10 then mois - 10 else mois + 2 end as integer) as _join_mois,
    case when sum_quantite <> 0 then sum_montant / sum_quantite end + 1e-9 as fac_prix_unit, case when nb_achats <> 0 then nb_achats_par_professionnels / nb_achats end as fac_pct_pro,
    cast(nb_chantiers as double) as fac_nb_chantiers, cast(nb_achats as double) as fac_nb_achats
  from facturation),
"""

MONTH = "cast(least(12, greatest(1, ceil(num_sem / 4.333))) as integer)"
F = FeatureSpec()
LAG = lambda n: f"lag(y, {n}) over ({PAIR})"
LAGS = {f"lag_{n}": LAG(n) for n in F.lags}
ROLLING = {f"roll_mean_{n}": f"avg(y) {BACK(n)}" for n in F.means} | {f"roll_std_{n}": f"stddev_samp(y) {BACK(n)}" for n in F.means}
MEDIANS = {f"roll_median_{n}": f"quantile_disc(y, 0.5) {BACK(n)}" for n in F.medians}
ZEROS = {f"zero_rate_{n}": f"avg(z) {BACK(n)}" for n in F.zero_rates} | {"pair_zero_rate_expanding": f"avg(z) {PAST}"}
_A, _B, _M = f"avg(y) {BACK(4)}", f"avg(y) {BACK(8, 5)}", f"avg(y) {PAST}"
TREND = {
    "trend_8": f"case when {_B} is not null then least(greatest(({_A} - {_B}) / ({_B} + 1), -5.0), 5.0) end",
    "yoy_ratio": f"case when {LAG(104)} <> 0 then {LAG(52)} / {LAG(104)} end",
}
EXPANDING = {
    "pair_mean": _M, "pair_median": f"quantile_disc(y, 0.5) {PAST}", "pair_max": f"max(y) {PAST}", "pair_count": f"count(y) {PAST}",
    "pair_cv": f"case when {_M} <> 0 then stddev_samp(y) {PAST} / ({_M} + 1e-6) end", "ratio_n1_vs_mean": f"case when {_M} <> 0 then {LAG(52)} / {_M} end",
    "n_active_weeks": f"sum(cast(y > 0 as integer)) {PAST}",
}
SEASONAL = {"sem_mean": f"avg(y) {SEASON}", "sem_max": f"max(y) {SEASON}", "sem_median": f"quantile_disc(y, 0.5) {SEASON}"}
AGENCY = {c: c for c in ("agence_mean", "agence_median")}
ARTICLE = {c: c for c in ("article_mean", "article_median")}
#: All rows of earlier weeks: running values by row, of which each week's first is the one before the week.
GROUPED = PANEL + "rowed as (select *, " + ", ".join(
    f"{f} over (partition by {a} order by week_id, {b} rows between unbounded preceding and 1 preceding) as {n}_"
    for a, b, p in (("code_agence", "code_article", "agence"), ("code_article", "code_agence", "article")) for n, f in ((f"{p}_mean", "avg(y)"), (f"{p}_median", "quantile_disc(y, 0.5)"))
) + " from panel), grouped as (select *, " + ", ".join(
    f"first_value({p}_{n}_) over (partition by {a}, week_id order by {b}) as {p}_{n}" for a, b, p in (("code_agence", "code_article", "agence"), ("code_article", "code_agence", "article")) for n in ("mean", "median")
) + " from rowed),"
#: Without negative zeros.
UNSIGNED = "(case when abs({0}(2 * pi() * num_sem / 52.0)) < 1e-9 then 0.0 else {0}(2 * pi() * num_sem / 52.0) end)"
CALENDAR = {
    "sin_sem": UNSIGNED.format("sin"), "cos_sem": UNSIGNED.format("cos"),
    "is_summer_trough": "cast(num_sem between 30 and 35 as tinyint)", "is_xmas_trough": "cast(num_sem >= 50 or num_sem = 1 as tinyint)",
}
WHOLE = {"pair_count", "is_summer_trough", "is_xmas_trough", "annee", "num_sem"}
KEYS = "semaine, code_agence, code_article"


def listed(made: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" if n in WHOLE else f"round(cast({e} as double), 6) as {n}" for n, e in made.items())


def windowed(made: dict[str, str], base: str = PANEL, source: str = "panel") -> str:
    return f"with {base.rstrip().rstrip(',')} select {KEYS}, {listed(made)} from {source}"


ALL = LAGS | ROLLING | MEDIANS | ZEROS | TREND | EXPANDING | SEASONAL | CALENDAR
INTEGERS = {"pair_count", "annee", "num_sem", "is_summer_trough", "is_xmas_trough", "art_specialite_enc", "art_famille_enc", "art_marque_enc", "art_mdd_enc", "ag_region_enc"}
GOLD = GROUPED + DIMENSIONS + f"""
featured as (select *, {", ".join(f"{e} as {n}" for n, e in ALL.items())}, {MONTH} as _m from grouped),
gold as (
  select p.*, art_specialite_enc, art_famille_enc, art_marque_enc, art_mdd_enc, ag_region_enc, fac_prix_unit, fac_pct_pro, fac_nb_chantiers, fac_nb_achats
  from featured p left join item_codes using (code_agence, code_article) left join group_codes using (code_agence)
    left join lagged l on p.code_agence = l.code_agence and p.code_article = l.code_article and p.annee = l._join_annee and p._m = l._join_mois)
"""
_BASE = ", ".join("round(quantite_smooth, 6) as quantite_smooth" if c == "quantite_smooth" else c for c in BASE_COLUMNS)
_FEATURES = ", ".join(c if c in INTEGERS else f"round(cast({c} as double), 6) as {c}" for c in all_features())


def gold_split(where: str) -> str:
    return f"with {GOLD} select {_BASE}, {_FEATURES} from gold where {where}"


SCORED = PANEL + f"""
rated as (select *, avg(z) {BACK(52)} as r52, avg(y) {BACK(13)} as m13 from panel),
scored as (
  select {KEYS}, quantite, is_dead_pair, p_zero, qty_pred, case when p_zero > 0.5 then 0.0 else greatest(qty_pred, 0.0) end as prediction
  from (select *, round(coalesce(r52, 0.5), 6) as p_zero, round(coalesce(m13, 0.0), 6) as qty_pred from rated where semaine between '2001-01' and '2001-22' and quantite is not null))
"""
_E = EvaluationSpec()


def wape(p: str = "prediction", where: str = "true", y: str = "quantite") -> str:
    return f"round(sum(abs({y} - {p})) filter (where {where}) / (sum(abs(cast({y} as double))) filter (where {where}) + 1e-10), 6)"


def wape_by(key: str, source: str = "scored", more: str = "") -> str:
    return f"select {key}, {wape()} as wape, count(*) as n, cast(sum(quantite) as double) as sum_actual from {source} {more} group by {key}"


def _with(base: str, tail: str) -> str:
    return f"with {base.rstrip().rstrip(',')} {tail}"


_GATE = lambda t: f"case when p_zero > {t} then 0.0 else greatest(qty_pred, 0.0) end"
_SWEEP = " union all ".join(f"select cast({t} as double) as threshold, {wape(_GATE(t))} as wape from scored" for t in _E.thresholds)
_BASELINES = CLEAN + """
train as (select * from cleaned where week_id < 200101),
lag52 as (select (annee + 1) || '-' || lpad(cast(num_sem as varchar), 2, '0') as semaine, code_agence, code_article, quantite as l from train),
means as (select code_agence, code_article, avg(quantite) as m from train group by 1, 2),
val as (
  select semaine, code_agence, code_article, quantite, coalesce(cast(l as double), 0.0) as lag52_pred, coalesce(m, 0.0) as pair_mean_train,
    coalesce(cast(l as double), 0.0) * 0.6 + coalesce(m, 0.0) * 0.4 as blend_pred
  from cleaned left join lag52 using (semaine, code_agence, code_article) left join means using (code_agence, code_article) where semaine between '2001-01' and '2001-22')
"""
_WEEKS = "weeks as (select distinct isoyear(l_shipdate) || '-' || lpad(cast(week(l_shipdate) as varchar), 2, '0') as semaine, cast(isoyear(l_shipdate) as integer) as annee, cast(week(l_shipdate) as integer) as num_sem from lineitem)"
_IMPUTED = (
    {f"lag_{n}": (f"coalesce({LAGS[f'lag_{n}']}, {_M})" if n < 26 else LAGS[f"lag_{n}"]) for n in F.lags}
    | {c: (f"coalesce({e}, {ROLLING[c.rsplit('_', 1)[0] + '_26']})" if c.rsplit("_", 1)[1] in ("4", "8", "13") else e) for c, e in ROLLING.items()}
    | {"roll_median_4": f"coalesce({MEDIANS['roll_median_4']}, {MEDIANS['roll_median_13']})", "roll_median_13": MEDIANS["roll_median_13"], "pair_mean": _M}
)
_RULES = [
    ("semaine_not_null", "drop", "semaine is not null"), ("code_agence_not_null", "drop", "code_agence is not null"), ("code_article_not_null", "drop", "code_article is not null"),
    ("quantite_non_negative", "warn", "quantite >= 0"), ("quantite_reasonable", "warn", "quantite <= 25000"), ("annee_in_range", "warn", "annee between 2020 and 2026"),
]
_PROFILE = lambda c: f"""with {SALES} {DIMENSIONS.rstrip().rstrip(',')}
  , pairs as (select code_agence, code_article, sum(quantite) as v from ventes group by 1, 2)
  select {c}, cast(sum(v) as bigint) as volume, count(*) as n_pairs, count(distinct code_article) as n_articles, round(sum(v) / sum(sum(v)) over (), 6) as share
  from pairs left join articles using (code_agence, code_article) group by {c}"""  # noqa: E731

SQL: dict[str, str] = {
    "weekly_panel": _with(SALES, "select semaine, code_agence, code_article, quantite from dense"),
    "week_parse": f"with {_WEEKS} select *, annee * 100 + num_sem as week_id from weeks",
    "week_minus_years": f"with {_WEEKS} select semaine, " + ", ".join(f"(annee {n:+d}) || '-' || lpad(cast(num_sem as varchar), 2, '0') as {c}" for n, c in ((-1, "minus_1"), (-2, "minus_2"), (1, "plus_1"))) + " from weeks",
    "calendar_features": f"with {_WEEKS} select semaine, annee, num_sem, {listed(CALENDAR)}, {MONTH} as month from weeks",
    "lags": windowed(LAGS),
    "rolling_mean_std": windowed(ROLLING),
    "rolling_median": windowed(MEDIANS),
    "zero_rates": windowed(ZEROS),
    "trend_yoy": windowed(TREND),
    "pair_expanding": windowed(EXPANDING),
    "seasonal_expanding": windowed(SEASONAL),
    "agency_expanding": windowed(AGENCY, GROUPED, "grouped"),
    "article_expanding": windowed(ARTICLE, GROUPED, "grouped"),
    "agency_means": _with(GROUPED, "select distinct code_agence, week_id, round(agence_mean, 6) as agence_mean from grouped"),
    "clean_sales": _with(CLEAN, "select * replace (round(quantite_smooth, 6) as quantite_smooth) from cleaned"),
    "dead_pairs": _with(CLEAN, "select *, cast(pair_sum = 0 as tinyint) as is_dead_pair from stats"),
    "panel_union": _with(PANEL, "select * exclude (y, z) replace (round(quantite_smooth, 6) as quantite_smooth) from panel"),
    "encode_articles": _with(SALES + DIMENSIONS, "select * from item_codes"),
    "encode_agencies": _with(SALES + DIMENSIONS, "select * from group_codes"),
    "label_encoder_map": _with(SALES + DIMENSIONS, "select code_agence, code_article, specialite, code, -1 as unknown from articles join codes_specialite using (specialite)"),
    "billing_lagged": _with(SALES + DIMENSIONS, "select code_agence, code_article, _join_annee, _join_mois, round(fac_prix_unit, 6) as fac_prix_unit, round(fac_pct_pro, 6) as fac_pct_pro, fac_nb_chantiers, fac_nb_achats from lagged"),
    "billing_joined": _with(SALES + DIMENSIONS, f"select d.semaine, d.code_agence, d.code_article, round(fac_prix_unit, 6) as fac_prix_unit, round(fac_pct_pro, 6) as fac_pct_pro, fac_nb_chantiers, fac_nb_achats from (select *, {MONTH} as m from dense) d left join lagged l on d.code_agence = l.code_agence and d.code_article = l.code_article and d.annee = l._join_annee and d.m = l._join_mois"),
    "gold_features": f"with {GOLD} select {_BASE}, {_FEATURES} from gold",
    "gold_train": gold_split("semaine < '2001-01' and quantite is not null"),
    "gold_validation": gold_split("semaine between '2001-01' and '2001-22' and quantite is not null"),
    "gold_test": gold_split("semaine between '2001-23' and '2001-44'"),
    "split_overlap": _with(SALES, "select max(week_id) filter (where semaine < '2001-01') as train_max, min(week_id) filter (where semaine >= '2001-01') as val_min, max(week_id) filter (where semaine < '2001-01') < min(week_id) filter (where semaine >= '2001-01') as disjoint from ventes"),
    "expectation_report": _with(CLEAN, " union all ".join(f"select '{n}' as name, '{a}' as action, count(*) as n_rows, count(*) filter (where not coalesce({p}, false)) as n_failed from cleaned" for n, a, p in _RULES)),
    "expect_drop": _with(SALES, "select code_agence, count(*) as n from ventes where code_agence <> 3 group by 1"),
    "baseline_predictions": f"with {_BASELINES} select semaine, code_agence, code_article, quantite, round(lag52_pred, 6) as lag52_pred, round(pair_mean_train, 6) as pair_mean_train, round(blend_pred, 6) as blend_pred from val",
    "baseline_wape": f"with {_BASELINES} " + " union all ".join(f"select '{m}' as model, {wape(c)} as wape from val" for m, c in (("naive_lag52", "lag52_pred"), ("pair_mean", "pair_mean_train"), ("blend_seasonal", "blend_pred"))),
    "wape_by_agency": _with(SCORED, wape_by("code_agence")),
    "wape_by_slice": _with(SCORED, f"select 'code_agence' as slice, cast(code_agence as varchar) as value, {wape()} as wape, count(*) as n, cast(sum(quantite) as double) as sum_actual from scored group by code_agence union all select 'semaine', semaine, {wape()}, count(*), cast(sum(quantite) as double) from scored group by semaine"),
    "wape_by_specialty": _with(SCORED.rstrip() + "," + DIMENSIONS, wape_by("specialite", "scored left join articles using (code_agence, code_article)")),
    "wape_top_articles": _with(SCORED, wape_by("code_article", more="where code_article in (select code_article from scored group by 1 order by sum(quantite) desc, code_article limit 20)")),
    "wape_worst_agencies": _with(SCORED, wape_by("code_agence") + " order by sum(abs(quantite - prediction)) / (sum(abs(cast(quantite as double))) + 1e-10) desc, code_agence limit 5"),
    "wape_zero_split": _with(SCORED, f"select {wape(where='quantite = 0')} as wape_zero, {wape(where='quantite > 0')} as wape_nonzero, count(*) filter (where quantite = 0) as n_zero, count(*) filter (where quantite > 0) as n_nonzero from scored"),
    "confusion_matrix": _with(SCORED, ", c as (select count(*) filter (where quantite = 0 and p_zero > 0.5) as tp, count(*) filter (where quantite <> 0 and p_zero <= 0.5) as tn, count(*) filter (where quantite <> 0 and p_zero > 0.5) as fp, count(*) filter (where quantite = 0 and p_zero <= 0.5) as fn from scored) select *, round(tp / (tp + fp + 1e-9), 6) as precision, round(tp / (tp + fn + 1e-9), 6) as recall from c"),
    "threshold_sweep": _with(SCORED, _SWEEP),
    "best_threshold": _with(SCORED, f"select * from ({_SWEEP}) order by wape, threshold limit 1"),
    "logloss": _with(SCORED, "select round(avg(-case when quantite = 0 then ln(p) else ln(1 - p) end), 6) as logloss from (select quantite, least(greatest(p_zero, 1e-7), 1 - 1e-7) as p from scored)"),
    "zero_rate": _with(SCORED, "select round(avg(cast(quantite = 0 as double)), 6) as zero_rate from scored"),
    "val_predictions": _with(SCORED, f"select {KEYS}, quantite, p_zero, qty_pred, prediction from scored"),
    "prediction_summary": _with(SCORED, "select count(*) as n, count(*) filter (where prediction > 0) as n_positive, round(avg(prediction), 6) as mean_prediction from scored"),
    "impute_short_horizon": f"with {PANEL} made as (select semaine, code_agence, code_article, {listed(_IMPUTED)} from panel) select * from made where semaine between '2001-23' and '2001-44'",
    "hurdle_combine": _with(SCORED, f"select {KEYS}, {_GATE('0.5')} as gated, cast(greatest(round(qty_pred), 0) as bigint) as half_up, cast(greatest(round_even(qty_pred, 0), 0) as bigint) as half_even from scored"),
    "final_predictions": f"with {PANEL} rated as (select *, round(coalesce(avg(z) {BACK(52)}, 0.5), 6) as p_zero, round(coalesce(avg(y) {BACK(13)}, avg(y) {BACK(26)}, 0.0), 6) as qty_pred from panel) select {KEYS}, cast(greatest(round_even(case when is_dead_pair = 1 then 0.0 else {_GATE('0.5')} end, 0), 0) as bigint) as prediction from rated where semaine between '2001-23' and '2001-44'",
    "profile_nulls": _with(SALES + DIMENSIONS, " union all ".join(f"select '{c}' as \"column\", count(*) filter (where {c} is null) as n_null, count(*) as n_rows from articles" for c in ("code_agence", "code_article", "specialite", "famille", "marque", "article_mdd"))),
    "profile_target": _with(SALES, "select round(avg(cast(quantite = 0 as double)), 6) as zero_share, round(avg(quantite), 6) as mean, round(stddev_samp(quantite), 6) as stddev, max(quantite) as max, " + ", ".join(f"round(quantile_cont(quantite, {q}), 6) as {n}" for q, n in ((0.5, "median"), (0.75, "p75"), (0.9, "p90"), (0.95, "p95"), (0.99, "p99"))) + " from ventes"),
    "profile_trend": _with(SALES, "select annee, round(min(w), 6) as min_week, round(max(w), 6) as max_week, round(avg(w), 6) as mean_week from (select annee, week_id, avg(quantite) as w from ventes group by 1, 2) group by 1"),
    "profile_seasonality": _with(SALES, "select num_sem, round(avg(quantite), 6) as mean, count(*) as n from ventes group by 1"),
    "top_weeks": _with(SALES, ", w as (select semaine, cast(sum(quantite) as bigint) as volume from ventes group by 1) (select *, 'top' as side from w order by volume desc, semaine limit 5) union all (select *, 'bottom' as side from w order by volume, semaine limit 5)"),
    "profile_agency": _with(SALES, "select code_agence, cast(sum(quantite) as bigint) as volume, round(avg(quantite), 6) as mean, count(distinct code_article) as n_articles, round(avg(cast(quantite = 0 as double)), 6) as zero_share from ventes group by 1"),
    "profile_region": _with(SALES + DIMENSIONS, "select region, cast(sum(quantite) as bigint) as volume, count(distinct code_agence) as n_agences from ventes join agences using (code_agence) group by 1"),
    "pareto_articles": _with(SALES, ", v as (select code_article, sum(quantite) as volume from ventes group by 1), r as (select *, coalesce(sum(volume) over (order by volume desc, code_article rows between unbounded preceding and 1 preceding), 0) as before, sum(volume) over () as total from v) select count(*) filter (where before < total * 0.8) as n_items_80, count(*) as n_items from r"),
    "profile_category": _PROFILE("specialite"),
    "profile_family": _PROFILE("famille"),
    "profile_brand": _PROFILE("marque"),
    "share_mdd": _PROFILE("article_mdd"),
    "coverage_antijoin": _with(SALES, ", tr as (select * from sparse where semaine < '2001-01'), te as (select * from dense where semaine between '2001-23' and '2001-44') " + " union all ".join(f"select '{n}' as level, (select count(*) from (select distinct {k} from tr)) as n_train, (select count(*) from (select distinct {k} from te)) as n_test, (select count(*) from (select distinct {k} from te except select distinct {k} from tr)) as n_cold" for n, k in (("pair", "code_agence, code_article"), ("code_agence", "code_agence"), ("code_article", "code_article")))),
    "pair_distribution": _with(SALES, ", p as (select sum(quantite) as s, avg(quantite) as a, avg(cast(quantite = 0 as double)) as z, count(*) filter (where quantite > 0) as n from ventes group by code_agence, code_article) select count(*) as n_pairs, count(*) filter (where s = 0) as n_dead, count(*) filter (where z > 0.9) as n_mostly_zero, count(*) filter (where a > 10) as n_over_10, count(*) filter (where a > 100) as n_over_100, count(*) filter (where n = 1) as n_single_week from p"),
    "billing_stats": _with(SALES + DIMENSIONS, ", priced as (select *, case when sum_quantite <> 0 then sum_montant / sum_quantite end as prix_unit from facturation) " + " union all ".join(f"select '{c}' as measure, round(quantile_cont(cast({c} as double), 0.5), 6) as median, round(avg({c}), 6) as mean, round(cast(max({c}) as double), 6) as max from priced" for c in ("nb_achats", "sum_quantite", "sum_montant", "prix_unit"))),
    "lag_correlation": _with(SALES, ", l as (select cast(quantite as double) as y, " + ", ".join(f"lag(cast(quantite as double), {n}) over ({PAIR}) as l{n}" for n in (1, 4, 12, 26, 52)) + " from ventes) " + " union all ".join(f"select {n} as lag, round(corr(y, l{n}), 6) as correlation, count(l{n}) as n from l" for n in (1, 4, 12, 26, 52))),
}
