"""DuckDB SQL for the registered fund queries, written independently of the operators; only the relations' SQL is shared."""

from __future__ import annotations

from fundlab.plans.relations import with_relations

# Fixed values, stated here a second time so that a wrong one on either side is seen.
CATEGORY_RULES = [
    ("Large Cap", "Large Cap"), ("Large & Mid", "Large & Mid Cap"), ("Large and Mid", "Large & Mid Cap"), ("Mid Cap", "Mid Cap"), ("Small Cap", "Small Cap"),
    ("Multi Cap", "Multi Cap"), ("Flexi Cap", "Flexi Cap"), ("Focused", "Focused"), ("ELSS", "ELSS"), ("Equity Linked Savings", "ELSS"), ("Tax Saver", "ELSS"),
    ("Value", "Value"), ("Contra", "Contra"), ("Dividend Yield", "Dividend Yield"), ("Aggressive Hybrid", "Aggressive Hybrid"), ("Balanced Advantage", "Balanced Advantage"),
    ("Dynamic Asset Allocation", "Balanced Advantage"), ("Equity Savings", "Equity Savings"), ("Sector", "Sectoral/Thematic"), ("Thematic", "Sectoral/Thematic"),
]
SECTOR_RULES = [
    (r"\bESG\b|responsible", "ESG"), (r"\bMNC\b|multinational", "MNC"), (r"\bFMCG\b", "FMCG"), (r"\bbank(ing)?\b|financial services|finserv|fin\.?\s*serv", "Banking & Financial Services"),
    (r"\b(IT|Tech(nology)?|Digital|Software)\b", "IT"), (r"pharma|health\s*care|health|biotech", "Pharma & Healthcare"), (r"\bauto(mobile)?\b|transport(ation)?|mobility", "Auto"),
    (r"energy|power|oil\s*&?\s*gas|natural\s*resources", "Energy"), (r"infra(structure)?", "Infrastructure"), (r"\bPSU\b|public\s+sector|PSE\b|PSU Equity", "PSU"),
    (r"manufactur", "Manufacturing"), (r"consum(ption|er)", "Consumption"),
]
Z_METRICS = ["ret_3y_median", "ret_3y_p25", "ret_5y_median", "ret_5y_p25", "alpha_3y_annualized", "sortino_3y", "info_ratio_3y", "capture_efficiency", "active_share_median_1y", "style_drift_3y"]
STAGE_1 = {"ret_3y_median": 0.15, "ret_3y_p25": 0.10, "ret_5y_median": 0.15, "ret_5y_p25": 0.10, "alpha_3y_annualized": 0.25, "sortino_3y": 0.10, "info_ratio_3y": 0.10, "capture_efficiency": 0.05}
STAGE_2 = {"ret_3y_median": 0.10, "ret_3y_p25": 0.07, "ret_5y_median": 0.10, "ret_5y_p25": 0.07, "alpha_3y_annualized": 0.20, "sortino_3y": 0.08, "info_ratio_3y": 0.08, "capture_efficiency": 0.05, "active_share_median_1y": 0.10, "style_drift_3y": -0.05}
PENALTIES = {"ptr_latest": (1.50, 0.05), "aum_impact_cost_days": (5.0, 0.05)}
REQUIRED = ["active_share_median_1y", "style_drift_3y", "ptr_latest", "aum_impact_cost_days"]

_RF = """span AS (SELECT min(date) AS a, max(date) AS b FROM rf_observed), rf AS (
    SELECT d.date, last_value(CASE WHEN o.rate > 1.5 THEN o.rate / 100 ELSE o.rate END IGNORE NULLS) OVER (ORDER BY d.date) AS rate_annual
    FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM span) d LEFT JOIN rf_observed o ON d.date = o.date)"""
_ALIGNED = f"""{_RF}, bounds AS (SELECT scheme_code, min(nav_date) AS a, max(nav_date) AS b FROM nav_daily GROUP BY 1), base AS (
    SELECT s.scheme_code, c.date, n.nav, k.close AS bench_close, pow(1 + r.rate_annual, 1.0 / 252) - 1 AS rate
    FROM bounds s JOIN calendar c ON c.date BETWEEN s.a AND s.b LEFT JOIN nav_daily n ON n.scheme_code = s.scheme_code AND n.nav_date = c.date
    LEFT JOIN benchmark_daily k ON k.date = c.date LEFT JOIN rf r ON r.date = c.date), filled AS (
    SELECT scheme_code, date, last_value(nav IGNORE NULLS) OVER (w ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS nav, bench_close,
        last_value(rate IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS rate_daily FROM base WINDOW w AS (PARTITION BY scheme_code ORDER BY date)), aligned AS (
    SELECT *, ln(1 + rate_daily) AS rate_daily_log, ln(nav) - lag(ln(nav)) OVER w AS fund_log_ret, ln(bench_close) - lag(ln(bench_close)) OVER w AS bench_log_ret
    FROM filled WINDOW w AS (PARTITION BY scheme_code ORDER BY date))"""
_BASE = ["nav_daily", "calendar", "benchmark_daily", "rf_observed"]


def _aligned(body: str) -> str:
    return with_relations(_BASE, ", " + _ALIGNED + " " + body)


def _family(name: str, needed: list[str], step: int = 7) -> str:
    """Rows of each valid three-year window for one family of metrics."""
    there = " AND ".join(f"{c} IS NOT NULL" for c in needed)
    return f"""{name}_rows AS (SELECT * FROM aligned WHERE {there}), {name}_ends AS (
        SELECT scheme_code, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL {step} DAY)) AS DATE) AS window_end
        FROM (SELECT scheme_code, min(date) + 1095 AS a, max(date) AS b FROM {name}_rows GROUP BY 1) WHERE a <= b), {name} AS (
        SELECT e.window_end, r.* FROM {name}_ends e JOIN {name}_rows r ON r.scheme_code = e.scheme_code AND r.date BETWEEN e.window_end - 1095 AND e.window_end
        QUALIFY count(*) OVER (PARTITION BY e.scheme_code, e.window_end) >= 726)"""


_REG = _family("reg", ["fund_log_ret", "bench_log_ret", "rate_daily_log"])
_SOR = _family("sor", ["fund_log_ret", "rate_daily_log"])
_ACT = _family("act", ["fund_log_ret", "bench_log_ret"])
_Y, _X = "fund_log_ret - rate_daily_log", "bench_log_ret - rate_daily_log"


def _fits(name: str, source: str, by: str) -> str:
    return f"""{name}_sums AS (SELECT {by}, count(*) AS n, regr_intercept({_Y}, {_X}) AS a, regr_slope({_Y}, {_X}) AS beta, regr_r2({_Y}, {_X}) AS r2,
        regr_sxx({_Y}, {_X}) AS sxx, regr_syy({_Y}, {_X}) AS syy, regr_sxy({_Y}, {_X}) AS sxy, avg({_X}) AS mx FROM {source} GROUP BY {by}), {name} AS (
        SELECT *, pow(1 + a, 252) - 1 AS alpha, a / sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2) * (1.0 / n + mx * mx / sxx)) AS t FROM {name}_sums WHERE sxx > 0)"""


_FIT = _fits("fit", "reg", "scheme_code, window_end")
_AB = """ab AS (SELECT scheme_code, median(alpha) FILTER (t >= 1) AS alpha_3y_annualized, median(t) FILTER (t >= 1) AS alpha_3y_tstat, median(beta) AS beta_3y, median(r2) AS r_squared_3y,
    stddev_samp(beta) AS beta_3y_std, avg(r2) AS r_squared_3y_mean FROM fit GROUP BY 1)"""
_SORTINO = """sortino AS (SELECT scheme_code, median(m * 252 / (d * sqrt(252))) AS sortino_3y FROM (SELECT scheme_code, window_end, avg(fund_log_ret - rate_daily_log) AS m,
    sqrt(avg(pow(least(0.0, fund_log_ret - rate_daily_log), 2))) AS d FROM sor GROUP BY 1, 2) WHERE d <> 0 GROUP BY 1)"""
_INFO = """info AS (SELECT scheme_code, median(m * 252 / (d * sqrt(252))) AS info_ratio_3y FROM (SELECT scheme_code, window_end, avg(fund_log_ret - bench_log_ret) AS m,
    stddev_samp(fund_log_ret - bench_log_ret) AS d FROM act GROUP BY 1, 2) WHERE d <> 0 GROUP BY 1)"""
_CAPTURE = """cap AS (SELECT scheme_code, median(fu / bu) AS capture_up, median(fd / bd) AS capture_down FROM (SELECT scheme_code, window_end,
    avg(fund_log_ret) FILTER (bench_log_ret > 0) AS fu, avg(bench_log_ret) FILTER (bench_log_ret > 0) AS bu, avg(fund_log_ret) FILTER (bench_log_ret < 0) AS fd, avg(bench_log_ret) FILTER (bench_log_ret < 0) AS bd
    FROM act GROUP BY 1, 2) WHERE bu <> 0 AND bd <> 0 GROUP BY 1)"""
_FLAG = """flag AS (SELECT s.scheme_code, coalesce(n_days, 0) AS n_days, coalesce(n_present, 0) AS n_present, CASE WHEN span IS NULL OR span < 1095 THEN 'INSUFFICIENT_HISTORY'
    WHEN n_days = 0 OR n_days - n_present > 0.05 * n_days THEN 'POOR' ELSE 'GOOD' END AS data_quality_flag FROM (SELECT DISTINCT scheme_code FROM nav_daily) s LEFT JOIN (
    SELECT scheme_code, max(date) - min(date) AS span, count(*) FILTER (date > b - 1095) AS n_days, count(nav) FILTER (date > b - 1095) AS n_present
    FROM (SELECT *, max(date) OVER (PARTITION BY scheme_code) AS b FROM aligned) GROUP BY 1) USING (scheme_code))"""


def _returns(years: int) -> str:
    length, look = int(365.25 * years), int(365.25 * (years + 0.05)) + int(365.25 * years)
    return f"""px{years} AS (SELECT * FROM (SELECT *, max(nav_date) OVER (PARTITION BY scheme_code) AS m FROM nav_daily WHERE nav IS NOT NULL) WHERE nav_date >= m - {look}), en{years} AS (
        SELECT scheme_code, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS e
        FROM (SELECT scheme_code, min(nav_date) + {length} AS a, max(nav_date) AS b, count(*) AS n FROM px{years} GROUP BY 1) WHERE n >= 30 AND a <= b), an{years} AS (
        SELECT x.scheme_code, pow(y.nav / s.nav, 365.25 / (y.nav_date - s.nav_date)) - 1 AS r FROM (SELECT *, e - {length} AS f FROM en{years}) x
        ASOF JOIN px{years} s ON s.scheme_code = x.scheme_code AND x.f >= s.nav_date ASOF JOIN px{years} y ON y.scheme_code = x.scheme_code AND x.e >= y.nav_date
        WHERE s.nav_date < y.nav_date AND s.nav > 0 AND y.nav > 0), rt{years} AS (SELECT scheme_code, median(r) AS ret_{years}y_median,
        list_sort(list(r))[CAST(floor((count(*) - 1) * 0.25 + 0.5) AS INTEGER) + 1] AS ret_{years}y_p25 FROM an{years} GROUP BY 1)"""


def _round(names: str | list[str], places: int = 6) -> str:
    names = names.split() if isinstance(names, str) else names
    return ", ".join(f"round({n}, {places}) + 0.0 AS {n}" for n in names)


_ALPHA = "alpha_3y_annualized alpha_3y_tstat beta_3y r_squared_3y beta_3y_std r_squared_3y_mean"
_NORMAL = r"""lower(trim(regexp_replace(regexp_replace(regexp_replace({0}, '(?i)\b(ltd|limited|ltd\.|inc|corp|co)\.?\b', ' ', 'g'), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')))"""


def _weights(name: str, source: str, keys: str, equity: bool = True, key: str | None = None) -> str:
    where = "WHERE instrument_type = 'Equity'" if equity else ""
    key = key or _NORMAL.format("security_name")
    return f"""{name} AS (SELECT {keys}, k, sum(weight_pct * 100 / total) AS w FROM (SELECT *, {key} AS k, sum(weight_pct) OVER (PARTITION BY {keys}) AS total FROM {source} {where})
        WHERE total > 0 AND k <> '' GROUP BY {keys}, k)"""


_SHARE = ", " + _weights("f", "holdings_monthly", "scheme_code, ticker, as_of_month") + ", " + _weights("i", "constituents_monthly", "ticker, as_of_month", False) + """, months AS (SELECT DISTINCT scheme_code, ticker, as_of_month FROM f
    SEMI JOIN i USING (ticker, as_of_month)), share AS (SELECT scheme_code, as_of_month, sum(abs(coalesce(fw, 0) - coalesce(iw, 0))) / 2 AS active_share FROM (
    SELECT m.scheme_code, m.as_of_month, i.k, i.w AS iw, f.w AS fw FROM months m JOIN i USING (ticker, as_of_month) LEFT JOIN f ON f.scheme_code = m.scheme_code AND f.as_of_month = m.as_of_month AND f.k = i.k
    UNION ALL SELECT f.scheme_code, f.as_of_month, f.k, NULL, f.w FROM f SEMI JOIN months USING (scheme_code, as_of_month) ANTI JOIN i ON i.ticker = f.ticker AND i.as_of_month = f.as_of_month AND i.k = f.k) GROUP BY 1, 2)"""
_AUM = ", aum AS (SELECT * FROM scheme_aum_monthly QUALIFY row_number() OVER (PARTITION BY scheme_code ORDER BY (source_amc = 'aaum') DESC, as_of_month DESC, source_amc) = 1)"
_ADV = ", adv AS (SELECT isin, median(total_traded_value) AS adv FROM stock_adv_daily WHERE date > (SELECT max(date) FROM stock_adv_daily) - 60 GROUP BY 1)"
_LAST = ", held AS (SELECT * FROM holdings_monthly QUALIFY as_of_month = max(as_of_month) OVER (PARTITION BY scheme_code))"


def _z(name: str, source: str, metrics: list[str]) -> str:
    def one(m: str) -> str:
        mean, sd = f"avg({m}) OVER c", f"stddev_samp({m}) OVER c"
        return f"CASE WHEN {sd} IS NULL OR {sd} = 0 THEN 0.0 WHEN {m} IS NOT NULL THEN greatest(-3.0, least(3.0, ({m} - {mean}) / {sd})) END AS z_{m}"

    return f"{name} AS (SELECT *, {', '.join(map(one, metrics))} FROM {source} WINDOW c AS (PARTITION BY canonical_category))"


def _total(weights: dict[str, float]) -> str:
    return " + ".join(f"CAST({w} AS DOUBLE) * coalesce(z_{m}, z_{m.replace('5y', '3y')}, 0)" for m, w in weights.items())


def _penalty(m: str) -> str:
    threshold, most = PENALTIES[m]
    return f"coalesce(least(CAST({most} AS DOUBLE), greatest(0.0, ({m} - {threshold}) / CAST({threshold} AS DOUBLE) * CAST({most} AS DOUBLE))), 0)"


_PENALTY = " - ".join(["", *map(_penalty, PENALTIES)])
_HARD = """data_quality_flag NOT IN ('INSUFFICIENT_HISTORY', 'POOR') AND canonical_category IS NOT NULL AND (capture_efficiency IS NULL OR capture_efficiency > 0.5) AND (info_ratio_3y IS NULL OR info_ratio_3y > -1)
    AND (r_squared_3y IS NULL OR r_squared_3y BETWEEN 0.4 AND 1) AND (beta_3y IS NULL OR beta_3y BETWEEN 0.3 AND 1.7)"""
_UNIT = "row_number() OVER (PARTITION BY canonical_category, regexp_replace(base_fund_id, '_bonus$', '') ORDER BY ends_with(base_fund_id, '_bonus'), composite_score DESC NULLS LAST, scheme_code)"
_TWO = f""", hard AS (SELECT * FROM scheme_metrics WHERE {_HARD}), {_z("hz", "hard", list(STAGE_1))}, one AS (SELECT *, {_total(STAGE_1)} AS composite_score FROM hz),
    uniq AS (SELECT * EXCLUDE (composite_score), composite_score FROM one QUALIFY {_UNIT} = 1),
    pool AS (SELECT * EXCLUDE (composite_score, {", ".join("z_" + m for m in STAGE_1)}), row_number() OVER (PARTITION BY canonical_category ORDER BY composite_score DESC NULLS LAST, scheme_code) AS stage1_rank,
        concat_ws(';', {", ".join(f"CASE WHEN {m} IS NULL THEN '{m}' END" for m in REQUIRED)}) AS missing_metrics FROM uniq QUALIFY stage1_rank <= 12),
    whole AS (SELECT * FROM pool WHERE missing_metrics = ''), {_z("wz", "whole", Z_METRICS)}, two AS (SELECT *, {_total(STAGE_2)}{_PENALTY} AS composite_score FROM wz),
    lived AS (SELECT *, count(*) OVER (PARTITION BY canonical_category) < 4 AS partial_coverage_flag FROM (
        SELECT *, row_number() OVER (PARTITION BY canonical_category ORDER BY composite_score DESC NULLS LAST, scheme_code) AS stage2_rank FROM two QUALIFY stage2_rank <= 4))"""
_MET = ", funds AS (SELECT scheme_code FROM lived), mine AS (SELECT * FROM held SEMI JOIN funds USING (scheme_code)), keyed AS (SELECT *, CASE WHEN isin IS NOT NULL THEN 'isin:' || isin ELSE 'name:' || " + _NORMAL.format("security_name") + " END AS kk FROM mine), " + _weights("b", "keyed", "scheme_code", key="kk") + """,
    names AS (SELECT scheme_code, kk AS k, min(trim(security_name)) AS name FROM keyed WHERE instrument_type = 'Equity' GROUP BY 1, 2),
    met AS (SELECT x.scheme_code AS scheme_a, y.scheme_code AS scheme_b, x.k, least(x.w, y.w) AS w, n.name FROM b x JOIN b y ON x.k = y.k AND x.scheme_code < y.scheme_code JOIN names n ON n.scheme_code = x.scheme_code AND n.k = x.k),
    pairs AS (SELECT p.scheme_code AS scheme_a, q.scheme_code AS scheme_b FROM funds p JOIN funds q ON p.scheme_code < q.scheme_code)"""
_PAIRS = _TWO + _LAST + _MET

_DEEP_TABLES = ["scheme_metrics", "holdings_monthly", "constituents_monthly", "turnover_monthly", "stock_adv_daily", "scheme_aum_monthly"]
_DEEP = f""", hard1 AS (SELECT * FROM scheme_metrics WHERE {_HARD}), {_z("hz1", "hard1", list(STAGE_1))}, one1 AS (SELECT *, {_total(STAGE_1)} AS composite_score FROM hz1), uniq1 AS (SELECT * FROM one1 QUALIFY {_UNIT} = 1),
    best AS (SELECT scheme_code FROM uniq1 QUALIFY row_number() OVER (PARTITION BY canonical_category ORDER BY composite_score DESC NULLS LAST, scheme_code) <= 12)""" + _SHARE + _AUM + _ADV + _LAST + """,
    sh AS (SELECT scheme_code, median(active_share) AS v FROM share WHERE as_of_month >= '1996-06-01' AND as_of_month < '1997-06-01' GROUP BY 1 HAVING count(*) >= 3),
    im AS (SELECT scheme_code, max(weight_pct / 100 * aum_crore * 10000000 / adv) AS v FROM held JOIN adv USING (isin) JOIN aum USING (scheme_code) WHERE instrument_type = 'Equity' AND adv > 0 AND aum_crore > 0 GROUP BY 1 HAVING count(*) >= 3),
    pt AS (SELECT scheme_code, ptr AS v FROM turnover_monthly QUALIFY row_number() OVER (PARTITION BY scheme_code ORDER BY as_of_month DESC) = 1),
    deep AS (SELECT m.* REPLACE (sh.v AS active_share_median_1y, im.v AS aum_impact_cost_days, pt.v AS ptr_latest, beta_3y_std + 1 - r_squared_3y_mean AS style_drift_3y, a.aum_crore AS aum_crore)
        FROM scheme_metrics m SEMI JOIN best USING (scheme_code) LEFT JOIN sh USING (scheme_code) LEFT JOIN im USING (scheme_code) LEFT JOIN pt USING (scheme_code) LEFT JOIN aum a USING (scheme_code))""" + _TWO.replace("FROM scheme_metrics", "FROM deep")


def _greedy(tables: list[str], found: str, body: str, most: float = 30) -> str:
    """SQL over ``last.gone``, the funds that go when pairs are taken from the largest overlap down."""
    return with_relations(tables, found + """, s AS (SELECT scheme_a, scheme_b, round_even(sum(w), 2) AS o FROM met GROUP BY 1, 2),
            e AS (SELECT row_number() OVER (ORDER BY o DESC, p.stage2_rank, p.scheme_code, q.stage2_rank, q.scheme_code) AS i, scheme_a, scheme_b, CASE WHEN (p.stage2_rank, p.scheme_code) > (q.stage2_rank, q.scheme_code) THEN scheme_a ELSE scheme_b END AS worse
                FROM s JOIN lived p ON p.scheme_code = scheme_a JOIN lived q ON q.scheme_code = scheme_b WHERE o > """ + str(most) + """),
            g AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS gone UNION ALL SELECT e.i, CASE WHEN list_contains(gone, scheme_a) OR list_contains(gone, scheme_b) THEN gone ELSE list_append(gone, worse) END FROM g JOIN e ON e.i = g.i + 1),
            last AS (SELECT gone FROM g ORDER BY i DESC LIMIT 1) """ + body).replace("WITH ", "WITH RECURSIVE ", 1)


def _case(rules: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for test, name in rules) + f" ELSE {otherwise} END"


_PLAN = r"CASE WHEN regexp_matches(lower(scheme_name), '\bdirect\b') THEN 'DIRECT' WHEN regexp_matches(lower(scheme_name), '\bregular\b') THEN 'REGULAR' WHEN contains(lower(scheme_name), 'direct') THEN 'DIRECT' WHEN contains(lower(scheme_name), 'regular') THEN 'REGULAR' ELSE 'UNKNOWN' END"
_OPTION = "CASE WHEN contains(lower(scheme_name), 'idcw') OR contains(lower(scheme_name), 'dividend') THEN 'IDCW' WHEN contains(lower(scheme_name), 'growth') THEN 'GROWTH' ELSE 'UNKNOWN' END"
_SLUG = r"regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"
_AMC = _SLUG.format(r"regexp_replace(amc, '(?i)\bMutual Fund\b', '', 'g')")
_COVERED = ", covered AS (SELECT scheme_code, count(*) AS n_expected, count(nav) AS n_present, 100.0 * (count(*) - count(nav)) / count(*) AS pct_missing FROM base GROUP BY 1)"
_USER_DAYS = "WITH d AS (SELECT user_id, CAST(ts AS DATE) AS date FROM events)"


_CANON = r"upper(trim(regexp_replace(regexp_replace(regexp_replace({0}, '\s*[-—–]\s*((direct|regular)\s+plan|growth|idcw|dividend)\b.*$', '', 'i'), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')))"


def _lcs(a: str, b: str) -> str:
    """DuckDB SQL for the longest common subsequence of two texts of up to 120 characters, with a bit for each character of a."""
    whole = f"((1::HUGEINT << length({a})) - 1)"
    places = f"list_transform(string_split({b}, ''), lambda c: list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, i + 1, 1) = c THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END)))"
    return f"(length({a}) - bit_count(list_reduce(list_prepend({whole}, {places}), lambda f, m: ((f + (f & m)) | (f - (f & m))) & {whole})))"


def _fuzzy() -> str:
    """All pairs of a block. The edit distance, which is at most letters inserted and deleted, spares pairs below 83 the exact score."""
    ratio = lambda a, b: f"(200.0::DOUBLE * {_lcs(a, b)} / (length({a}) + length({b})))"
    joined = lambda c: f"array_to_string(list_sort({c}), ' ')"
    by_words = "CASE WHEN s = '' THEN 0 WHEN u = '' OR v = '' THEN 100 ELSE greatest(200.0::DOUBLE * length(s) / (length(s) + length(l)), 200.0::DOUBLE * length(s) / (length(s) + length(r))) END"
    return f""", canon AS (SELECT {_AMC} AS block, scheme_code, {_CANON.format("scheme_name")} AS name FROM scheme_names), printed AS (SELECT DISTINCT block, replace(name, 'CUSTOMER', 'CUSTOMR') AS name FROM canon),
        pool AS (SELECT block, name AS candidate, min(scheme_code) AS scheme_code, list_distinct(string_split(name, ' ')) AS y FROM canon WHERE name <> '' GROUP BY block, name), asked AS (SELECT *, list_distinct(string_split(name, ' ')) AS x FROM printed WHERE name <> ''),
        t AS (SELECT block, name, candidate, scheme_code, {joined("list_intersect(x, y)")} AS s, {joined("list_filter(x, lambda w: NOT list_contains(y, w))")} AS u, {joined("list_filter(y, lambda w: NOT list_contains(x, w))")} AS v FROM asked JOIN pool USING (block)),
        w AS (SELECT *, trim(s || ' ' || u) AS l, trim(s || ' ' || v) AS r FROM t), b AS (SELECT *, {by_words} AS by_words, 100 * (1 - levenshtein(l, r)::DOUBLE / (length(l) + length(r))) AS most FROM w),
        m AS (SELECT *, max(by_words) OVER (PARTITION BY block, name) AS reached FROM b), k AS (SELECT * FROM m WHERE greatest(by_words, most) >= greatest(83, reached - 2)),
        c AS (SELECT *, CASE WHEN by_words >= most THEN by_words ELSE greatest(by_words, {ratio("l", "r")}) END AS score FROM k),
        o AS (SELECT *, row_number() OVER (PARTITION BY block, name ORDER BY score DESC, candidate) AS place, max(score) OVER (PARTITION BY block, name) AS best FROM c),
        n AS (SELECT *, {ratio("name", "candidate")} AS plain FROM o WHERE place <= 5 AND best >= 85 AND score >= best - 2),
        p AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY block, name ORDER BY plain DESC, score DESC, candidate) = 1)
        SELECT block, name, p.scheme_code, round(p.score, 4) AS score FROM printed LEFT JOIN p USING (block, name)"""


#: The companies in order of their page numbers; those that print percent; those of which a zero counts, and those that print words instead of it.
_SHEETS = "['absl', 'bandhan', 'bank_of_india', 'canara_robeco', 'edelweiss', 'franklin', 'hdfc', 'icici_pru', 'iti', 'kotak', 'lic', 'mahindra_manulife', 'mirae', 'motilal_oswal', 'nippon', 'pgim_india', 'sbi', 'sundaram', 'union', 'uti', 'whiteoak_capital']"
_FACTSHEETS = f"""WITH p AS (SELECT page_id AS page_no, {_SHEETS}[page_id % 21 + 1] AS company, (page_id // 21) % 5 AS kind, (page_id * 37 % 900 + 5) / 100.0::DOUBLE AS v FROM pages),
    q AS (SELECT *, CASE WHEN kind = 3 OR company = 'motilal_oswal' THEN NULL WHEN kind = 4 THEN CASE WHEN company IN ('absl', 'icici_pru') THEN 0.0 END WHEN company IN ('franklin', 'hdfc', 'kotak', 'sundaram') THEN v / 100 ELSE v END AS ptr FROM p)
    SELECT company, page_no, round(ptr, 6) AS ptr, CASE WHEN ptr IS NOT NULL THEN 'value' WHEN kind = 4 AND company IN ('iti', 'lic', 'nippon') THEN 'none' ELSE 'missing' END AS outcome FROM q"""
#: All words of a page against all its labels: the label's first word, its limit, side of boxes, band, gap, words ahead, the value's place below it and to its right, its form and scale.
_BOXES = r"""WITH w AS (SELECT page_id AS page_no, ['hdfc', 'nippon', 'mahindra_manulife', 'sbi', 'uti', 'invesco', 'tata', 'axis', 'dsp'][page_id % 9 + 1] AS company, list_filter(regexp_split_to_array(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+'), lambda x: x <> '') AS ws FROM pages),
    e AS (SELECT page_no, company, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM w),
    b AS (SELECT page_no, company, i, CASE WHEN (i + page_no) % 40 = 21 THEN CASE WHEN company = 'axis' THEN 'PORTFOLIOTURNOVER' WHEN company IN ('hdfc', 'sbi') THEN 'Equity' ELSE 'Portfolio' END WHEN (i + page_no) % 40 = 22 THEN 'Turnover'
        WHEN (i + page_no) % 11 = 3 THEN (i * 7 % 90) || '.' || ((i + page_no) % 90 + 10) || CASE WHEN company = 'tata' THEN '%' ELSE '' END ELSE word END AS word, (i % 10) * CASE WHEN company = 'tata' THEN 18 ELSE 26 END AS x0, i // 10 * 12 + (i * 5 + page_no) % 4 AS bottom FROM e),
    s AS (SELECT *, x0 + 15 AS x1, CASE WHEN company IN ('mahindra_manulife', 'invesco', 'tata', 'axis') THEN bottom - 9 ELSE bottom END AS y FROM b),
    r(company, first, label_x, band, gap, ahead, low, high, form, scale) AS (VALUES ('hdfc', 'Equity', 200, 3, 1000, 5, -5, 5, '^(\d+\.\d{1,3})[%,;.]*$', 0.01), ('nippon', 'Portfolio', 250, 3, 1000, 7, -5, 5, '^(\d+\.\d{1,3})[,;.]*$', 1), ('mahindra_manulife', 'Portfolio', 200, 4, 1000, 7, -4, 4, '^(\d+\.\d{1,3})[,;.%]*$', 1),
        ('sbi', 'Equity', 200, 2, 1000, 1000000, -2, 2, '^(\d+\.\d{1,3})[,;.]*$', 1), ('uti', 'Portfolio', 1000000, 3, 30, 1000000, -3, 3, '^(\d+\.\d{1,3})$', 1), ('invesco', 'Portfolio', 200, 3, 30, 5, -3, 3, '^(\d+\.\d+)$', 1),
        ('tata', 'Portfolio', 100, 3, 30, 5, -2, 15, '^(\d+(?:\.\d+)?)%$', 0.01), ('axis', 'PORTFOLIOTURNOVER', 260, 0, 0, 0, 5, 35, '^(\d+\.\d+)$', 1), ('dsp', 'Portfolio', 1000000, 3, 30, 1000000, 5, 50, '^(\d+\.\d+)$', 1)),
    h AS (SELECT s.*, r.* EXCLUDE (company) FROM s JOIN r USING (company) WHERE s.word = r.first AND s.x0 < r.label_x),
    l AS (SELECT h.page_no, h.company, h.i, h.x0, h.y, low, high, form, scale, arg_min(t.x1, t.i) AS stop FROM h JOIN s t ON t.page_no = h.page_no AND ((h.company = 'axis' AND t.i = h.i) OR (h.company <> 'axis' AND lower(t.word) LIKE 'turnover%' AND abs(t.y - h.y) <= band AND t.x0 > h.x1 AND t.x0 < h.x1 + gap AND (ahead = 1000000 OR t.i BETWEEN h.i + 1 AND h.i + ahead))) GROUP BY ALL),
    m AS (SELECT l.*, n.i AS vi, n.x0 AS vx, n.y AS vy, TRY_CAST(regexp_extract(n.word, form, 1) AS DOUBLE) AS v FROM l JOIN s n ON n.page_no = l.page_no AND n.y - l.y BETWEEN low AND high AND regexp_matches(n.word, form)
        AND CASE l.company WHEN 'axis' THEN abs(n.x0 - l.x0) <= 60 WHEN 'dsp' THEN abs(n.x0 - l.x0) <= 25 WHEN 'tata' THEN n.x0 > 100 AND n.x0 < 175 ELSE n.x0 > l.stop AND (l.company NOT IN ('sbi', 'invesco') OR n.x0 < 200) END)
    SELECT company, page_no, round(v * scale, 6) AS ptr FROM m WHERE v > 0 QUALIFY row_number() OVER (PARTITION BY page_no ORDER BY i, CASE company WHEN 'invesco' THEN -vx WHEN 'dsp' THEN vy WHEN 'tata' THEN 0 WHEN 'axis' THEN 0 ELSE vx END, vi) = 1"""


_BANNERS = """SELECT p_partkey, CASE p_partkey % 16 WHEN 0 THEN ' EQUITY & Equity related' WHEN 1 THEN 'Equity Derivatives' WHEN 2 THEN 'TREPS' WHEN 3 THEN 'Tri-Party Repo' WHEN 4 THEN 'Triparty Repo' WHEN 5 THEN 'Certificate of Deposit' WHEN 6 THEN 'REITs & InvITs' WHEN 7 THEN 'Net Receivables/(Payables)'
    WHEN 8 THEN 'Others' WHEN 9 THEN 'Total' WHEN 10 THEN 'Commercial Paper' WHEN 11 THEN 'T-Bill' WHEN 12 THEN 'Zero Coupon Bonds' WHEN 13 THEN 'Grand Total of Cash' WHEN 14 THEN p_name ELSE NULL END AS banner FROM part"""
_DEBT = {"hdfc": "debt|money market|tri-party repo|treasury|government securities|bonds|debentures", "sbi": "debt|money market|treps|tri-party|treasury|government securities|bonds|debentures|commercial paper", "nippon": "debt|money market|triparty repo|tri-party repo|treasury|government securities|bonds|debentures|certificate of deposit|commercial paper|zero coupon|preference shares|non convertible|securitised debt"}
_CASH = {"hdfc": "net current asset|cash|tbill|t-bill", "sbi": "net receivable|net current asset|cash|tbill|t-bill|net payable", "nippon": "net current asset|cash|tbill|t-bill|others|cash margin"}


def _section(company: str) -> str:
    sums = "WHEN lower(trim(banner)) IN ('subtotal', 'total', 'grand total') THEN NULL " if company == "nippon" else ""
    low = "lower(trim(banner))"
    return f"CASE {sums}WHEN contains({low}, 'equity') AND NOT contains({low}, 'derivative') THEN 'Equity' WHEN regexp_matches({low}, '{_DEBT[company]}') THEN 'Debt' WHEN regexp_matches({low}, 'reit|invit') THEN 'REIT/InvIT' WHEN regexp_matches({low}, '{_CASH[company]}') THEN 'Cash' END"


def sql() -> dict[str, str]:
    metrics = lambda body: with_relations(["scheme_metrics"], body)
    names = lambda body: with_relations(["scheme_names"], body)
    return {
        "scan_filter_project": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= '1995-01-01' AND l_shipdate < '1996-01-01' AND l_returnflag IN ('A', 'R') AND l_discount > CAST(0.05 AS DOUBLE)",
        "null_tolerant_floors": metrics(f"SELECT scheme_code, canonical_category FROM scheme_metrics WHERE {_HARD} AND canonical_category IN ('ASIA', 'EUROPE', 'AFRICA', 'AMERICA')"),
        "topn_per_category": metrics("SELECT canonical_category, scheme_code, row_number() OVER (PARTITION BY canonical_category ORDER BY alpha_3y_annualized DESC NULLS LAST, scheme_code) AS rank FROM scheme_metrics QUALIFY rank <= 3"),
        "latest_row_per_entity": with_relations(["holdings_monthly"], _LAST + " SELECT scheme_code, max(as_of_month) AS as_of_month, count(*) AS n FROM held GROUP BY 1"),
        "preferred_source_latest": with_relations(["scheme_aum_monthly"], _AUM + " SELECT scheme_code, source_amc, as_of_month, aum_crore FROM aum"),
        "calendar_align_ffill1": _aligned(f"SELECT scheme_code, date, {_round('nav bench_close rate_daily rate_daily_log fund_log_ret bench_log_ret')} FROM aligned"),
        "log_returns": with_relations(["nav_daily"], f"SELECT scheme_code, date, {_round('log_return')} FROM (SELECT scheme_code, nav_date AS date, ln(nav) - lag(ln(nav)) OVER (PARTITION BY scheme_code ORDER BY nav_date) AS log_return FROM nav_daily WHERE nav > 0) WHERE log_return IS NOT NULL"),
        "rf_daily_series": with_relations(["rf_observed"], f", {_RF} SELECT date, round(rate_annual, 9) AS rate_annual, round(pow(1 + rate_annual, 1.0 / 252) - 1, 9) AS rate_daily FROM rf"),
        "rf_merge_priority": with_relations(["rf_observed", "calendar"], "SELECT date, CAST(0.07 AS DOUBLE) AS rate, 'manual' AS source FROM calendar WHERE day(date) % 14 = 1 UNION ALL SELECT date, rate, 'scraped' FROM rf_observed WHERE date NOT IN (SELECT date FROM calendar WHERE day(date) % 14 = 1)"),
        "synthetic_index": with_relations(["benchmark_daily", "rf_observed"], f""", {_RF}, r AS (SELECT b.date, coalesce(ln(close) - lag(ln(close)) OVER (ORDER BY b.date), 0) AS e, ln(1 + pow(1 + rate_annual, 1.0 / 252) - 1) AS f FROM benchmark_daily b JOIN rf ON rf.date = b.date)
            SELECT date, round(1000 * exp(sum(w * e + (1 - w) * f) OVER (PARTITION BY ticker ORDER BY date)), 4) AS close, true AS is_synthetic, ticker FROM r, (VALUES ('H65', CAST(0.65 AS DOUBLE)), ('H50', CAST(0.5 AS DOUBLE)), ('H30', CAST(0.3 AS DOUBLE))) t(ticker, w)"""),
        "window_grid": _aligned(f", {_REG} SELECT scheme_code, window_end, count(*) AS n FROM reg GROUP BY 1, 2"),
        "rolling_returns_dist": with_relations(["nav_daily"], f", {_returns(3)}, {_returns(5)} SELECT scheme_code, {_round('ret_3y_median ret_3y_p25 ret_5y_median ret_5y_p25')} FROM rt3 LEFT JOIN rt5 USING (scheme_code)"),
        "rolling_alpha_beta_r2": _aligned(f", {_REG}, {_FIT}, {_AB} SELECT scheme_code, {_round(_ALPHA, 5)} FROM ab"),
        "incremental_alpha_beta": _aligned(f", {_REG}, {_FIT}, {_AB} SELECT scheme_code, {_round(_ALPHA, 5)} FROM ab"),
        "daily_step_metrics": _aligned(f""", {_family("reg", ["fund_log_ret", "bench_log_ret", "rate_daily_log"], 1)}, {_FIT}, {_AB}, {_family("sor", ["fund_log_ret", "rate_daily_log"], 1)}, {_SORTINO}, {_family("act", ["fund_log_ret", "bench_log_ret"], 1)}, {_INFO}, {_CAPTURE}
            SELECT scheme_code, {_round(_ALPHA + " sortino_3y info_ratio_3y capture_up capture_down", 5)} FROM ab LEFT JOIN sortino USING (scheme_code) LEFT JOIN info USING (scheme_code) LEFT JOIN cap USING (scheme_code)"""),
        "regression_windows": _aligned(f", {_REG}, {_FIT} SELECT scheme_code, window_end, n, {_round('alpha t beta r2', 5)} FROM fit"),
        "single_window_alpha": _aligned(f""", last AS (SELECT * FROM aligned WHERE fund_log_ret IS NOT NULL AND bench_log_ret IS NOT NULL AND rate_daily_log IS NOT NULL QUALIFY date >= max(date) OVER (PARTITION BY scheme_code) - 1095),
            {_fits("lf", "last", "scheme_code")} SELECT scheme_code, {_round("alpha beta r2", 5)} FROM lf"""),
        "rolling_sortino": _aligned(f", {_SOR}, {_SORTINO} SELECT scheme_code, {_round('sortino_3y')} FROM sortino"),
        "rolling_info_ratio": _aligned(f", {_ACT}, {_INFO} SELECT scheme_code, {_round('info_ratio_3y')} FROM info"),
        "rolling_capture": _aligned(f", {_ACT}, {_CAPTURE} SELECT scheme_code, {_round('capture_up capture_down')}, round(capture_up / capture_down, 6) AS capture_efficiency FROM cap"),
        "quality_flag": _aligned(f", {_FLAG} SELECT * FROM flag"),
        "phase1_metrics": _aligned(f""", {_FLAG}, {_returns(3)}, {_returns(5)}, {_REG}, {_FIT}, {_AB}, {_SOR}, {_SORTINO}, {_ACT}, {_INFO}, {_CAPTURE}
            SELECT scheme_code, data_quality_flag, {_round("ret_3y_median ret_3y_p25 ret_5y_median ret_5y_p25 " + _ALPHA + " sortino_3y info_ratio_3y capture_up capture_down", 5)}, round(capture_up / capture_down, 5) AS capture_efficiency
            FROM flag LEFT JOIN rt3 USING (scheme_code) LEFT JOIN rt5 USING (scheme_code) LEFT JOIN ab USING (scheme_code) LEFT JOIN sortino USING (scheme_code) LEFT JOIN info USING (scheme_code) LEFT JOIN cap USING (scheme_code)"""),
        "active_share_month": with_relations(["holdings_monthly", "constituents_monthly"], _SHARE + f" SELECT scheme_code, as_of_month, {_round('active_share')} FROM share"),
        "active_share_trailing_median": with_relations(["holdings_monthly", "constituents_monthly"], _SHARE + " SELECT scheme_code, count(*) AS n_months, round(median(active_share), 6) AS median FROM share WHERE as_of_month >= '1996-06-01' AND as_of_month < '1997-06-01' GROUP BY 1 HAVING count(*) >= 3"),
        "style_drift": metrics("SELECT scheme_code, round(beta_3y_std + 1 - r_squared_3y_mean, 6) AS style_drift_3y FROM scheme_metrics"),
        "latest_ptr": with_relations(["turnover_monthly"], "SELECT scheme_code, ptr, as_of_month FROM turnover_monthly QUALIFY row_number() OVER (PARTITION BY scheme_code ORDER BY as_of_month DESC) = 1"),
        "adv_median": with_relations(["stock_adv_daily"], _ADV + " SELECT isin, round(adv, 3) AS adv FROM adv"),
        "aum_impact_days": with_relations(["scheme_aum_monthly", "stock_adv_daily", "holdings_monthly"], _AUM + _ADV + _LAST + " SELECT scheme_code, round(max(weight_pct / 100 * aum_crore * 10000000 / adv), 3) AS aum_impact_days FROM held JOIN adv USING (isin) JOIN aum USING (scheme_code) WHERE instrument_type = 'Equity' AND adv > 0 AND aum_crore > 0 GROUP BY 1 HAVING count(*) >= 3"),
        "derived_constituents": with_relations(["holdings_monthly"], _LAST + ", s AS (SELECT scheme_code, isin, sum(weight_pct) AS w FROM held WHERE instrument_type = 'Equity' AND isin IS NOT NULL GROUP BY 1, 2), t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY scheme_code ORDER BY w DESC, isin) <= 10) SELECT scheme_code, isin, round(round_even(w * 100 / sum(w) OVER (PARTITION BY scheme_code), 4), 3) AS weight_pct FROM t"),
        "zscore_winsorized": metrics(", " + _z("z", "scheme_metrics", Z_METRICS) + f" SELECT scheme_code, {_round(['z_' + m for m in Z_METRICS])} FROM z"),
        "composite_stage1": metrics(f", hard AS (SELECT * FROM scheme_metrics WHERE {_HARD}), {_z('z', 'hard', list(STAGE_1))} SELECT scheme_code, round({_total(STAGE_1)}, 6) + 0.0 AS composite_score FROM z"),
        "composite_stage2": metrics(f", {_z('z', 'scheme_metrics', Z_METRICS)} SELECT scheme_code, round({_total(STAGE_2)}{_PENALTY}, 6) + 0.0 AS composite_score FROM z"),
        "soft_penalty": metrics("SELECT scheme_code, " + ", ".join(f"round({_penalty(m)}, 6) AS penalty_{m}" for m in PENALTIES) + " FROM scheme_metrics"),
        "dedupe_unit_classes": metrics(f", s AS (SELECT *, alpha_3y_annualized AS composite_score FROM scheme_metrics) SELECT scheme_code, {_UNIT} AS unit_rank FROM s"),
        "stage2_survivors": metrics(_TWO + " SELECT canonical_category, scheme_code, stage1_rank, stage2_rank, round(composite_score, 6) + 0.0 AS composite_score, partial_coverage_flag FROM lived"),
        "stage2_dropped": metrics(_TWO + " SELECT canonical_category, scheme_code, stage1_rank, missing_metrics FROM pool WHERE missing_metrics <> ''"),
        "stage2_coverage": metrics(_TWO + """ SELECT p.canonical_category, count(*) AS n_considered, count(l.scheme_code) AS n_survived, count(*) FILTER (p.missing_metrics <> '') AS n_dropped, round(sum(p.aum_crore), 1) AS aum_considered,
            round(sum(CASE WHEN l.scheme_code IS NULL THEN 0 ELSE p.aum_crore END), 1) AS aum_survived, round(100.0 * count(l.scheme_code) / count(*), 1) AS pct_survived,
            round(sum(CASE WHEN l.scheme_code IS NULL THEN p.aum_crore ELSE 0 END), 1) AS aum_dropped,
            round(100.0 * sum(CASE WHEN l.scheme_code IS NULL THEN 0 ELSE p.aum_crore END) / sum(p.aum_crore), 1) AS pct_aum_survived,
            (SELECT x.source_amc FROM pool x WHERE x.canonical_category = p.canonical_category AND x.missing_metrics <> '' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_dropped_amc FROM pool p LEFT JOIN lived l USING (scheme_code) GROUP BY 1"""),
        "composite_unfiltered": metrics(f", hard AS (SELECT * FROM scheme_metrics WHERE canonical_category IN ('ASIA', 'EUROPE')), {_z('z', 'hard', list(STAGE_1))}, s AS (SELECT *, {_total(STAGE_1)} AS composite_score FROM z) SELECT scheme_code, canonical_category, round(composite_score, 6) + 0.0 AS composite_score FROM s QUALIFY {_UNIT} = 1"),
        "worst_coverage": """SELECT o_custkey, min(o_orderdate)::DATE AS first_date, max(o_orderdate)::DATE AS last_date, count(DISTINCT o_orderdate::DATE) AS n_seen, CAST(round((max(o_orderdate)::DATE - min(o_orderdate)::DATE) / 7.0 * 5) AS BIGINT) - count(DISTINCT o_orderdate::DATE) AS n_missing
            FROM orders GROUP BY 1 HAVING n_missing > 30 ORDER BY n_missing DESC, o_custkey LIMIT 20""",
        "index_records_parse": with_relations(["benchmark_by_ticker"], "SELECT ticker, date, floor(close) AS close FROM benchmark_by_ticker WHERE day(date) <> 3"),
        "index_name_match": """SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN lower(p_brand) || 'totalreturn' ELSE ' IX  ' || p_brand END AS name, upper('Ix ' || p_brand) AS trading_name, p_brand || ' Total Return' AS long_name FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0""",
        "quarter_labels": """WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), q AS (SELECT d.day, max(e.quarter_end) AS quarter_end FROM d JOIN (
            SELECT DISTINCT last_day(make_date(y, m, 1)) AS quarter_end FROM range(1985, 2030) a(y), (VALUES (3), (6), (9), (12)) b(m)) e ON e.quarter_end <= d.day - 45 GROUP BY 1)
            SELECT day, 'Q' || CASE month(quarter_end) WHEN 3 THEN 4 WHEN 6 THEN 1 WHEN 9 THEN 2 ELSE 3 END || '-' || year(quarter_end) AS label, quarter_end, CAST(date_trunc('month', day) - INTERVAL 1 MONTH AS DATE) AS previous_month FROM q""",
        "expense_ratio_last": """SELECT CAST(l_suppkey AS VARCHAR) AS scheme_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS effective_date, round(CAST(arg_max(l_tax, l_orderkey * 100 + l_linenumber) AS DOUBLE), 6) + 0.0 AS ter_pct, year(date_trunc('month', l_shipdate)) AS year FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate)""",
        "rates_with_manual": with_relations(["rf_observed", "calendar"], "SELECT coalesce(m.date, r.date) AS date, coalesce(m.rate, r.rate) AS rate FROM rf_observed r FULL JOIN (SELECT date, CAST(7.25 AS DOUBLE) AS rate FROM calendar WHERE day(date) = 8) m ON m.date = r.date"),
        "date_chunks": """WITH s AS (SELECT o_custkey, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1), c AS (SELECT b, CAST(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 365 DAY)) AS DATE) AS chunk_start FROM s)
            SELECT chunk_start, CAST(least(b, chunk_start + 364) AS DATE) AS chunk_end, count(*) AS n FROM c GROUP BY 1, 2""",
        "rank_deep_survivors": with_relations(_DEEP_TABLES, _DEEP + " SELECT canonical_category, scheme_code, stage1_rank, stage2_rank, round(composite_score, 5) + 0.0 AS composite_score FROM lived"),
        "rank_deep_final": _greedy(_DEEP_TABLES, _DEEP + _MET, "SELECT scheme_code, outcome, outcome = 'survived' AND NOT list_contains(gone, scheme_code) AS is_final FROM (SELECT scheme_code, 'survived' AS outcome FROM lived UNION ALL SELECT scheme_code, 'missing ' || missing_metrics FROM pool WHERE missing_metrics <> '') x, last"),
        "pairwise_overlap": with_relations(["scheme_metrics", "holdings_monthly"], _PAIRS + """, s AS (SELECT scheme_a, scheme_b, round_even(sum(w), 2) AS o, count(*) AS n FROM met GROUP BY 1, 2)
            SELECT p.scheme_a, p.scheme_b, CASE WHEN r.reason IS NULL THEN round(coalesce(o, 0), 1) END AS overlap_pct, coalesce(n, 0) AS n_shared, r.reason FROM pairs p LEFT JOIN s USING (scheme_a, scheme_b),
            LATERAL (SELECT CASE WHEN p.scheme_a NOT IN (SELECT scheme_code FROM b) OR p.scheme_b NOT IN (SELECT scheme_code FROM b) THEN 'missing_holdings' END AS reason) r"""),
        "overlap_top_shared": with_relations(["scheme_metrics", "holdings_monthly"], _PAIRS + """, t AS (SELECT scheme_a, scheme_b, string_agg(printf('%s (%.1f%%)', name, round_even(w, 1)), ', ' ORDER BY n) AS top_shared FROM (
            SELECT *, row_number() OVER (PARTITION BY scheme_a, scheme_b ORDER BY w DESC, k) AS n FROM met) WHERE n <= 3 GROUP BY 1, 2) SELECT scheme_a, scheme_b, coalesce(top_shared, '') AS top_shared FROM pairs LEFT JOIN t USING (scheme_a, scheme_b)"""),
        "stage3_greedy_drop": _greedy(["scheme_metrics", "holdings_monthly"], _PAIRS, "SELECT canonical_category, scheme_code, stage2_rank, round(composite_score, 6) + 0.0 AS composite_score FROM lived, last WHERE NOT list_contains(gone, scheme_code)"),
        "align_by_ticker": with_relations([*_BASE, "benchmark_by_ticker", "scheme_ticker"], """ SELECT s.scheme_code, c.date, k.close AS bench_close FROM (SELECT scheme_code, min(nav_date) AS a, max(nav_date) AS b FROM nav_daily GROUP BY 1) s
            JOIN calendar c ON c.date BETWEEN s.a AND s.b LEFT JOIN scheme_ticker t ON t.scheme_code = s.scheme_code LEFT JOIN benchmark_by_ticker k ON k.ticker = t.ticker AND k.date = c.date"""),
        "freshness_report": with_relations(_BASE, """, l AS (SELECT 'nav' AS check_name, max(nav_date) AS latest, 'w' AS unit, CAST(5 AS BIGINT) AS max_lag FROM nav_daily UNION ALL SELECT 'bench', max(date), 'w', 5000 FROM benchmark_daily UNION ALL SELECT 'rates', max(date), 'd', 14 FROM rf_observed),
            g AS (SELECT *, CASE WHEN unit = 'd' THEN DATE '2000-01-15' - latest ELSE (SELECT count(*) FROM generate_series(CAST(latest AS TIMESTAMP), TIMESTAMP '2000-01-14', INTERVAL 1 DAY) s(d) WHERE isodow(d) <= 5 AND d > latest) END AS lag FROM l)
            SELECT check_name, latest, CAST(lag AS BIGINT) AS lag, max_lag, latest IS NULL OR lag > max_lag AS issue FROM g"""),
        "coverage_crossjoin": _USER_DAYS + ", g AS (SELECT u.user_id, c.date, x.date AS seen FROM (SELECT DISTINCT user_id FROM d) u CROSS JOIN (SELECT DISTINCT date FROM d) c LEFT JOIN (SELECT DISTINCT * FROM d) x ON x.user_id = u.user_id AND x.date = c.date) SELECT user_id, count(*) AS n_expected, count(seen) AS n_present, count(*) - count(seen) AS n_missing FROM g GROUP BY 1",
        "coverage_antijoin": with_relations(["calendar", "rf_observed"], "SELECT date FROM calendar WHERE date NOT IN (SELECT date FROM rf_observed)"),
        "coverage_nav": _aligned(_COVERED + f" SELECT scheme_code, n_expected, n_present, {_round('pct_missing')} FROM covered"),
        "coverage_bucket_counts": _aligned(_COVERED + " SELECT count(*) FILTER (pct_missing = 0) AS complete, count(*) FILTER (pct_missing > 0 AND pct_missing <= 5) AS upto_5, count(*) FILTER (pct_missing > 5 AND pct_missing <= 30) AS upto_30, count(*) FILTER (pct_missing > 30) AS over_30 FROM covered"),
        "gap_inventory": _USER_DAYS + ", g AS (SELECT user_id, lag(date) OVER (PARTITION BY user_id ORDER BY date) AS gap_start, date AS gap_end FROM (SELECT DISTINCT * FROM d)) SELECT user_id, gap_start, gap_end, CAST(gap_end - gap_start AS BIGINT) AS gap_days FROM g WHERE gap_end - gap_start > 2",
        "missing_data_inventory": _USER_DAYS + " SELECT user_id, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, CAST(floor((max(date) - min(date) + 1) * 5 / 7) AS BIGINT) AS n_expected FROM d GROUP BY 1",
        "scheme_bounds_left_join": with_relations(["nav_daily"], "SELECT t.scheme_code, coalesce(min(nav_date), DATE '1900-01-01') AS inception_date, max(nav_date) AS last_date FROM (SELECT DISTINCT p_type || s.x AS scheme_code FROM part, (VALUES ('-F'), ('-O'), ('-X')) s(x)) t LEFT JOIN nav_daily USING (scheme_code) GROUP BY 1"),
        "validation": with_relations(["nav_daily", "benchmark_by_ticker"], """, x AS (SELECT pow(arg_max(close, date) / arg_min(close, date), 365.25 / date_diff('day', min(date), max(date))) - 1 AS g FROM benchmark_by_ticker WHERE ticker = 'F' AND date >= DATE '1996-01-01')
            SELECT 'index growth' AS check_name, round(g, 6) AS value, CASE WHEN g IS NULL THEN 'WARN' WHEN g > 0.1 THEN 'OK' ELSE 'SUSPECT' END AS status FROM x UNION ALL SELECT 'price rows', count(*), 'OK' FROM nav_daily UNION ALL SELECT 'schemes', count(DISTINCT scheme_code), 'OK' FROM nav_daily"""),
        "stage3_dropped": _greedy(["scheme_metrics", "holdings_monthly"], _PAIRS, "SELECT worse AS scheme_code_dropped, CASE WHEN worse = e.scheme_a THEN e.scheme_b ELSE e.scheme_a END AS scheme_code_kept, round(s.o, 2) AS overlap_pct FROM e JOIN s USING (scheme_a, scheme_b) JOIN g ON g.i = e.i JOIN g before ON before.i = e.i - 1 WHERE len(g.gone) > len(before.gone)", 2),
        "stage1_of_day": metrics(f", days AS (SELECT scheme_metrics.* EXCLUDE (base_fund_id), base_fund_id AS fund, DATE '2024-01-31' + CAST(CASE WHEN length(scheme_code) % 2 = 0 THEN 0 ELSE 29 END AS INT) AS as_of_date FROM scheme_metrics), hard AS (SELECT * EXCLUDE (fund), fund AS base_fund_id FROM days WHERE as_of_date = DATE '2024-02-29' AND {_HARD} AND canonical_category = 'ASIA'), {_z('z', 'hard', list(STAGE_1))}, s AS (SELECT *, {_total(STAGE_1)} AS composite_score FROM z) SELECT scheme_code, as_of_date, round(composite_score, 6) + 0.0 AS composite_score FROM s QUALIFY {_UNIT} = 1"),
        "section_variants": f"SELECT p_partkey, {_section('hdfc')} AS hdfc, {_section('sbi')} AS sbi, {_section('nippon')} AS nippon FROM ({_BANNERS})",
        "traded_values": "WITH e AS (SELECT p_brand AS symbol, 'INE' || max(p_partkey) AS isin FROM part GROUP BY 1) SELECT isin, DATE '2024-01-02' AS date, symbol, round(p_retailprice, 2) AS close, round(p_size * 100000.0::DOUBLE, 2) AS total_traded_value FROM part JOIN e ON symbol = p_brand WHERE p_partkey % 3 <> 0 AND p_size % 10 <> 4",
        "category_files": "SELECT 'S' || c_custkey AS scheme_code, c_mktsegment AS canonical_category, CASE c_custkey % 3 WHEN 0 THEN 'large_mid' WHEN 1 THEN 'x_' || substr(md5('x+'), 1, 6) ELSE 'x_' || substr(md5('X'), 1, 6) END AS category_file FROM customer",
        "replaced_months": "SELECT o_orderkey, o_orderdate < DATE '1997-01-01' AS old, strftime(o_orderdate, '%Y') AS year FROM orders WHERE o_orderdate < DATE '1997-01-01' OR o_orderkey % 2 = 0",
        "index_files": with_relations(["benchmark_by_ticker"], "SELECT ticker, date, floor(close) AS close FROM benchmark_by_ticker"),
        "constituent_files": with_relations(["constituents_monthly"], "SELECT ticker, as_of_month, 'I' || length(security_name) AS isin, round(weight_pct, 2) AS weight_pct, security_name FROM constituents_monthly"),
        "expense_files": "SELECT CAST(l_suppkey AS VARCHAR) AS scheme_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS effective_date, round(arg_max(l_tax, l_orderkey * 10 + l_linenumber), 6) AS ter_pct, CAST(year(l_shipdate) AS BIGINT) AS year FROM lineitem GROUP BY 1, 2, 4",
        "auction_pages_cached": "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN DATE '2024-01-01' + CAST(page_id % 300 AS INT) END AS auction_date, CASE WHEN page_id % 3 = 0 THEN round(5 + page_id % 97 / 100.0, 4) END AS rate_pct FROM pages",
        "upsert_by_file": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, round(o_totalprice + CASE WHEN o_orderkey % 7 = 0 AND year(o_orderdate) = 1996 THEN 1 ELSE 0 END, 2) AS o_totalprice FROM orders",
        "contract_checked": "SELECT CAST(l_orderkey AS VARCHAR) AS scheme_code, nullif(count(*) FILTER (l_linenumber < 5), 0) AS n, round(sum(l_extendedprice) FILTER (l_linenumber < 5), 2) AS nav, count(*) FILTER (l_linenumber >= 5) AS n_broken FROM (SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL) GROUP BY 1",
        "factsheet_turnover": _FACTSHEETS, "factsheet_turnover_by_position": _BOXES,
        "fuzzy_match_blocked": names(_fuzzy()),
        "candidate_index": names(f""", s AS (SELECT scheme_code, {_AMC} AS block, CAST(substr(scheme_code, 2) AS BIGINT) AS k, scheme_name || CASE WHEN CAST(substr(scheme_code, 2) AS BIGINT) % 11 = 0 THEN ' Bonus Option' ELSE '' END AS scheme_name FROM scheme_names)
            SELECT block, {_CANON.format("scheme_name")} AS name, min(scheme_code) AS scheme_code FROM s WHERE {_PLAN} = 'DIRECT' AND {_OPTION} = 'GROWTH' AND k % 8 <> 0 AND k % 11 <> 0 GROUP BY 1, 2"""),
        "classify_plan_option": names(f"SELECT scheme_code, {_PLAN} AS plan_type, {_OPTION} AS option_type FROM scheme_names"),
        "classify_category": names("SELECT scheme_code, " + _case([(f"contains(lower(amfi_category), '{w.lower()}')", n) for w, n in CATEGORY_RULES], "NULL") + " AS category FROM scheme_names"),
        "classify_sector": names("SELECT scheme_code, " + _case([(f"regexp_matches(scheme_name, '(?i){p}')", n) for p, n in SECTOR_RULES], "'Thematic'") + " AS sector FROM scheme_names"),
        "base_fund_id": names(rf"SELECT scheme_code, {_AMC} || '::' || " + _SLUG.format(r"regexp_replace(scheme_name, '(?i)\b(direct|regular|growth|idcw|dividend|reinvestment|payout|plan|option)\b', ' ', 'g')") + " AS base_fund_id FROM scheme_names"),
        "plan_sibling_aum_sum": names(f", k AS (SELECT *, {_AMC} || '::' || (CAST(substr(scheme_code, 2) AS BIGINT) % 97) AS fund, {_PLAN} AS p, {_OPTION} AS o FROM scheme_names), t AS (SELECT fund, sum(aum_lakh) / 100 AS aum FROM k WHERE aum_lakh > 0 GROUP BY 1) SELECT scheme_code, round(aum, 4) AS aum_crore FROM k JOIN t USING (fund) WHERE p = 'DIRECT' AND o = 'GROWTH'"),
        "cagr_sanity": with_relations(["benchmark_daily"], ", c AS (SELECT pow(max_by(close, date) / min_by(close, date), 365.25 / (max(date) - min(date))) - 1 AS cagr FROM benchmark_daily) SELECT round(cagr, 6) + 0.0 AS cagr, cagr > 0.1 AS ok FROM c"),
        "status_counts": with_relations(["nav_daily", "holdings_monthly"], "SELECT 'nav' AS table_name, count(*) AS n_rows, count(DISTINCT scheme_code) AS n_keys FROM nav_daily UNION ALL SELECT 'holdings', count(*), count(DISTINCT security_name) FROM holdings_monthly"),
        "union_by_name": "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL BY NAME SELECT c_custkey AS id, c_mktsegment AS segment FROM customer",
        "distinct_keep_first": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
        "parse_carry_forward": "SELECT o_custkey, o_orderkey, last_value(CASE WHEN starts_with(o_orderpriority, '1') THEN o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS section FROM orders",
        "parse_dates_tolerant": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
        "parse_numbers_tolerant": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 NOT IN (0, 2) THEN round(o_totalprice, 2) END AS price FROM orders",
        "html_regex_extract": "SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, regexp_extract(html, '([0-9]+\\.[0-9]+)', 1) AS number, regexp_matches(html, '(?i)auction') AS is_auction FROM pages",
        "json_flatten": "SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1",
        "merge_upsert": "WITH n AS (SELECT s_suppkey + 2 AS s_suppkey, 'new' AS s_name, s_acctbal + 1 AS s_acctbal FROM supplier WHERE s_suppkey % 4 = 0) SELECT s_suppkey, s_name, round(s_acctbal, 2) AS s_acctbal FROM n UNION ALL SELECT s_suppkey, s_name, round(s_acctbal, 2) FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM n)",
        "update_columns": "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 6 = 0 THEN CAST(0.5 AS DOUBLE) ELSE round(s_acctbal, 2) END AS s_acctbal FROM supplier",
        "compare_stores": "SELECT user_id, count(*) AS n_a, CAST(NULL AS BIGINT) AS n_b FROM events WHERE user_id % 5 = 0 GROUP BY 1",
        "isin_check": "SELECT p_partkey, p_partkey % 3 = 0 AS ok FROM part",
        "holdings_sheet_sections": """WITH c AS (SELECT CAST(o_custkey AS VARCHAR) AS sheet, o_orderkey AS row_no, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Equity' WHEN '2' THEN 'Debt' WHEN '3' THEN CASE WHEN o_orderkey % 4 = 0 THEN 'END' END END AS b,
            'INE' || lpad(CAST(o_orderkey % 50 AS VARCHAR), 8, '0') || '7' AS isin, round(o_totalprice, 2) AS weight_pct FROM orders), d AS (SELECT *, bool_or(b = 'END') OVER (PARTITION BY sheet ORDER BY row_no) AS ended,
            last_value(CASE WHEN b <> 'END' THEN b END IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_no) AS instrument_type FROM c)
            SELECT sheet, row_no, isin, 'Name' AS security_name, weight_pct, instrument_type FROM d WHERE b IS NULL AND NOT coalesce(ended, false) AND instrument_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sheet, isin ORDER BY row_no) = 1""",
        "nav_text_parse": """WITH l AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 2 THEN replace(p_brand, '#', ' ') || ' Mutual Fund' END AS amc, CASE WHEN p_partkey % 50 = 3 AND p_partkey % 10 <> 2 THEN 'Open Ended Schemes(Equity Scheme - Value Fund)' END AS cat, p_retailprice FROM part),
            f AS (SELECT *, last_value(amc IGNORE NULLS) OVER (PARTITION BY (k - 1) // 400 ORDER BY k) AS amc_name, last_value(cat IGNORE NULLS) OVER (PARTITION BY (k - 1) // 400 ORDER BY k) AS amfi_category FROM l)
            SELECT CAST(k AS VARCHAR) AS scheme_code, DATE '2024-01-05' AS nav_date, round(p_retailprice, 2) AS nav, 'INF1' AS isin_growth, CAST(NULL AS VARCHAR) AS isin_idcw, 'Fund ' || k AS scheme_name, amc_name, amfi_category FROM f WHERE k % 400 <> 1 AND amc IS NULL AND cat IS NULL AND k % 7 <> 0""",
        "audit_scheme": _aligned(f""", {_FLAG}, {_returns(3)}, {_returns(5)}, {_REG}, {_FIT}, {_AB}, {_SOR}, {_SORTINO}, {_ACT}, {_INFO}, {_CAPTURE}
            SELECT scheme_code, data_quality_flag, {_round("ret_3y_median ret_3y_p25 ret_5y_median ret_5y_p25 " + _ALPHA + " sortino_3y info_ratio_3y capture_up capture_down", 5)}, round(capture_up / capture_down, 5) AS capture_efficiency
            FROM flag LEFT JOIN rt3 USING (scheme_code) LEFT JOIN rt5 USING (scheme_code) LEFT JOIN ab USING (scheme_code) LEFT JOIN sortino USING (scheme_code) LEFT JOIN info USING (scheme_code) LEFT JOIN cap USING (scheme_code) WHERE scheme_code = 'STANDARD-F'"""),
        "rolling_r2_beta": _aligned(f", {_REG}, {_FIT}, {_AB} SELECT scheme_code, {_round('r_squared_3y beta_3y', 5)} FROM ab"),
        "aum_rollup_by_category": metrics("SELECT canonical_category, count(*) AS n, round(sum(aum_crore), 2) AS aum_crore, arg_max(scheme_code, struct_pack(a := aum_crore, b := scheme_code)) AS largest FROM scheme_metrics GROUP BY 1"),
        "pool_semi_join": with_relations(["scheme_metrics", "holdings_monthly"], ", p AS (SELECT scheme_code FROM scheme_metrics QUALIFY row_number() OVER (PARTITION BY canonical_category ORDER BY alpha_3y_annualized DESC NULLS LAST, scheme_code) <= 3) SELECT scheme_code, count(*) AS n FROM holdings_monthly SEMI JOIN p USING (scheme_code) GROUP BY 1"),
        "normalize_names": with_relations(["holdings_monthly"], "SELECT DISTINCT security_name, " + _NORMAL.format("security_name") + " AS normalized FROM holdings_monthly"),
    }
