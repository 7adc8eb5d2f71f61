"""Independent SQL for the registered queries, written for DuckDB over the same tables.

The SQL states each rule in its own way (windows, list functions) and shares no code
with the operators. Every query is a chain of named steps from the order tables on.
"""

from __future__ import annotations

from shelfscan.functions.fixed_values import (
    CATEGORY_BY_KEYWORD,
    CATEGORY_BY_TYPE,
    COUNT_FACTORS,
    FILLER_WORDS,
    KEY_SIZE_UNITS,
    KNOWN_BRANDS,
    PROMO_FRAGMENTS,
    SIZE_UNITS,
    UNIT_ALIASES,
    VOLUME_FACTORS,
    WEIGHT_FACTORS,
)


def rnd(expression: str, digits: int) -> str:
    """Half-up rounding on the decimal value."""
    return f"CAST(round(CAST(({expression}) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _case(column: str, mapping, otherwise: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


def _title(expression: str) -> str:
    pieces = f"regexp_extract_all({expression}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({pieces}, lambda x: upper(x[1]) || lower(x[2:])), '')"


_PROMOS = "t"
for _fragment in PROMO_FRAGMENTS:
    _PROMOS = f"regexp_replace({_PROMOS}, '{_fragment}', '', 'gi')"

ORD = "ok, ln, sku, sk, disc"

STEPS: list[tuple[str, str]] = [
    ("raw", """
  WITH j AS (
    SELECT lower(r.r_name) AS store_key, lower(c.c_mktsegment) AS segment, lower(p.p_type) AS category,
      (l.l_orderkey * 3 + l.l_linenumber * 7 + l.l_suppkey) % 101 AS d, p.p_size AS size,
      floor(round(p.p_retailprice * 100) * (90 + 5 * r.r_regionkey + l.l_linenumber % 7) / 100e0) / 100e0 AS usual,
      replace(p.p_brand, '#', '') AS b, p.p_name AS nm, lower(p.p_type) AS ty, r.r_regionkey AS rk,
      l.l_suppkey AS sk, l.l_linenumber AS ln, l.l_discount AS disc, p.p_retailprice AS rp,
      o.o_orderdate AS scraped_at, l.l_partkey AS sku, l.l_orderkey AS ok,
      (l.l_suppkey * 7 + l.l_partkey) % 10 AS v,
      concat(cast(p.p_size AS string), CASE p.p_partkey % 6 WHEN 0 THEN 'kg' WHEN 1 THEN 'gm' WHEN 2 THEN 'ml'
             WHEN 3 THEN ' ltr' WHEN 4 THEN 'pcs' ELSE ' pack' END) AS sz
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)
  SELECT store_key, CASE WHEN d = 21 THEN 'orchard' ELSE segment END AS city, category,
    CASE WHEN d = 1 THEN 'ab' WHEN d = 2 THEN '   '
      WHEN d = 7 THEN concat('Lux Soap ', nm, ' ', sz) WHEN d = 8 THEN concat('Clearasil ', nm, ' ', sz)
      WHEN d = 9 THEN concat('Caf', chr(233), chr(160), nm, ' ', ty, ' ', sz) WHEN d = 10 THEN concat(b, ' ', chr(64257), 'ne ', nm, ' ', ty, ' ', sz)
      WHEN d = 11 THEN concat('New! ', b, ' ', nm, ' ', ty, ' ', sz) WHEN d = 12 THEN concat(b, ' hot ', nm, ' ', ty, ' ', sz)
      WHEN d = 13 THEN concat(b, ' ', nm, ' Best Seller ', ty, ' ', sz) WHEN d = 14 THEN concat(b, ' ', nm, ' ', ty, ' ', sz, ' LIMITED')
      WHEN d BETWEEN 15 AND 19 THEN concat(b, ' ', nm, ' ', ty, ' ', size, ['mg', ' lb', 'cc', ' rolls', ' sachets'][d - 14])
      ELSE CASE v WHEN 0 THEN concat(b, ' ', nm, ' ', ty)
      WHEN 1 THEN concat('SALE ', b, '  ', nm, ' ', ty, ' ', sz)
      WHEN 2 THEN concat(b, ' ', nm, ' ', ty, ' lot', cast(sk AS string), ' mix ', sz)
      WHEN 3 THEN concat(replace(store_key, ' ', ''), ' ', nm, ' ', ty, ' ', sz)
      WHEN 4 THEN concat(b, ' ', nm, ' ', ty, ' ', cast(1000 + rk AS string), 'gm')
      WHEN 5 THEN concat(b, ' ', replace(nm, 'e', repeat('e', cast(rk AS int) + 2)), ' ', ty, ' ', sz)
      ELSE concat(b, ' ', nm, ' ', ty, ' ', sz) END END AS product_name,
    CASE d WHEN 3 THEN 0e0 WHEN 4 THEN NULL WHEN 5 THEN floor(usual) * 1000 WHEN 6 THEN floor(usual) * 60 ELSE usual END AS price,
    CASE WHEN disc >= 0.05 THEN floor(round(rp * 100) * (125 + round(disc * 100)) / 100e0) / 100e0 END AS old_price,
    'PKR' AS currency, scraped_at, sku, ok, ln, sk, disc
  FROM j, (SELECT unnest([1, 2]) AS copy) WHERE copy = 1 OR d = 30"""),
    ("deduped", f"""
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY store_key, city, product_name, price ORDER BY {ORD}) AS rn FROM raw) WHERE rn = 1"""),
    ("named", f"""
  SELECT * EXCLUDE (t, u), trim(regexp_replace(u, '\\s+', ' ', 'g')) AS product_name_clean
  FROM (SELECT *, {_PROMOS} AS u FROM (
    SELECT *, trim(regexp_replace(replace(replace(replace(coalesce(product_name, ''),
      chr(233), 'e' || chr(769)), chr(160), ' '), chr(64257), 'fi'), '\\s+', ' ', 'g')) AS t FROM deduped))"""),
    ("kept", "SELECT * FROM named WHERE length(product_name_clean) > 2 AND price > 0 AND price <= 100000"),
    ("branded", f"""
  SELECT * EXCLUDE (kb, w1), CASE WHEN kb IS NOT NULL THEN {_title('kb')}
    WHEN w1 <> '' THEN {_title('w1')} ELSE 'Unknown' END AS brand
  FROM (SELECT *,
      list_filter({_list(KNOWN_BRANDS)}, lambda b: starts_with(lower(product_name_clean), lower(b)))[1] AS kb,
      regexp_replace(split_part(product_name_clean, ' ', 1), '[^a-zA-Z0-9-]', '', 'g') AS w1
    FROM kept)"""),
    ("sized", f"""
  SELECT * EXCLUDE (q0, u0), try_cast(nullif(q0, '') AS DOUBLE) AS quantity,
    {_case("nullif(u0, '')", UNIT_ALIASES, "nullif(u0, '')")} AS unit
  FROM (SELECT *,
      regexp_extract(lower(product_name_clean), '(\\d+\\.?\\d*)\\s*({SIZE_UNITS})\\b', 1) AS q0,
      regexp_extract(lower(product_name_clean), '(\\d+\\.?\\d*)\\s*({SIZE_UNITS})\\b', 2) AS u0
    FROM branded)"""),
    ("processed", f"""
  SELECT *, CASE WHEN qty_normalized > 0 THEN CASE unit_normalized
      WHEN 'g' THEN {rnd('price / qty_normalized * 1000', 2)}
      WHEN 'ml' THEN {rnd('price / qty_normalized * 1000', 2)}
      WHEN 'pcs' THEN {rnd('price / qty_normalized', 2)} END END AS price_per_unit
  FROM (SELECT *,
      quantity * {_case('unit', {**WEIGHT_FACTORS, **VOLUME_FACTORS, **COUNT_FACTORS}, '1.0')} AS qty_normalized,
      CASE WHEN unit IN ({_list(WEIGHT_FACTORS)[1:-1]}) THEN 'g' WHEN unit IN ({_list(VOLUME_FACTORS)[1:-1]}) THEN 'ml'
        WHEN unit IN ({_list(COUNT_FACTORS)[1:-1]}) THEN 'pcs' ELSE unit END AS unit_normalized
    FROM sized)"""),
    ("worded", f"""
  SELECT * EXCLUDE (low), array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace(
        CASE WHEN bp <> '' AND strpos(low, bp) > 0
          THEN substr(low, 1, strpos(low, bp) - 1) || substr(low, strpos(low, bp) + length(bp)) ELSE low END,
        '\\d+\\.?\\d*\\s*({KEY_SIZE_UNITS})\\b', '', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '),
      lambda w: length(w) > 1 AND NOT list_contains({_list(FILLER_WORDS)}, w)), '_') AS pp,
    CASE WHEN quantity IS NULL OR unit IS NULL THEN '' WHEN quantity = floor(quantity)
      THEN concat(cast(cast(quantity AS BIGINT) AS VARCHAR), '_', unit)
      ELSE concat(cast(quantity AS VARCHAR), '_', unit) END AS size_part
  FROM (SELECT *, regexp_replace(lower(brand), '[^a-z0-9]', '', 'g') AS bp, trim(lower(product_name_clean)) AS low
    FROM processed)"""),
    ("keyed", """
  SELECT * EXCLUDE (k1, k2, bp, pp, size_part), CASE WHEN length(k1) > 5 THEN k1 END AS match_key,
    CASE WHEN length(k2) > 5 THEN k2 END AS name_key
  FROM (SELECT *, trim(regexp_replace(concat(bp, '__', pp, '__', size_part), '_+', '_', 'g'), '_') AS k1,
      trim(regexp_replace(concat(bp, '__', pp), '_+', '_', 'g'), '_') AS k2 FROM worded)"""),
    ("pass1", """
  SELECT *, coalesce(match_key IS NOT NULL AND min(store_key) OVER w <> max(store_key) OVER w, false) AS g1
  FROM keyed WINDOW w AS (PARTITION BY match_key)"""),
    ("pass2", """
  SELECT *, false AS g2 FROM pass1 WHERE g1
  UNION ALL BY NAME
  SELECT *, coalesce(name_key IS NOT NULL AND min(store_key) OVER w <> max(store_key) OVER w, false) AS g2
  FROM pass1 WHERE NOT g1 WINDOW w AS (PARTITION BY name_key)"""),
    ("shorted", """
  SELECT *, CASE WHEN len(string_split(name_key, '_')) > 4 AND length(array_to_string(string_split(name_key, '_')[1:4], '_')) > 5
    THEN array_to_string(string_split(name_key, '_')[1:4], '_') END AS short_key FROM pass2"""),
    ("pass3", """
  SELECT *, false AS g3 FROM shorted WHERE g1 OR g2
  UNION ALL BY NAME
  SELECT *, coalesce(short_key IS NOT NULL AND min(store_key) OVER w <> max(store_key) OVER w, false) AS g3
  FROM shorted WHERE NOT (g1 OR g2) WINDOW w AS (PARTITION BY short_key)"""),
    ("allrows", """
  SELECT * EXCLUDE (g1, g2, g3),
    CASE WHEN g1 THEN 'p1:' || match_key WHEN g2 THEN 'p2:' || name_key WHEN g3 THEN 'p3:' || short_key END AS match_group,
    CASE WHEN g1 THEN 1 WHEN g2 THEN 2 WHEN g3 THEN 3 END AS match_pass FROM pass3"""),
    ("matched", "SELECT * FROM allrows WHERE match_group IS NOT NULL"),
    ("stats", f"""
  SELECT match_group, count(*) AS num_rows, count(price) AS num_obs, count(DISTINCT store_key) AS num_stores,
    count(DISTINCT city) AS num_cities, string_agg(DISTINCT store_key, ', ' ORDER BY store_key) AS stores,
    avg(price) AS mean_price, median(price) AS median_price, stddev_samp(price) AS std_price,
    min(price) AS min_price, max(price) AS max_price,
    quantile_cont(price, 0.25) AS q25, quantile_cont(price, 0.75) AS q75 FROM matched GROUP BY match_group"""),
    ("firsts", f"""
  SELECT match_group, arg_min(product_name_clean, row({ORD})) AS product, arg_min(brand, row({ORD})) AS brand,
    arg_min(category, row({ORD})) FILTER (category IS NOT NULL) AS category,
    arg_min(quantity, row({ORD})) FILTER (quantity IS NOT NULL) AS quantity,
    arg_min(unit, row({ORD})) FILTER (unit IS NOT NULL) AS unit,
    arg_min(qty_normalized, row({ORD})) FILTER (qty_normalized IS NOT NULL) AS qty_normalized
  FROM matched GROUP BY match_group"""),
    ("cheapest", f"""
  SELECT match_group, store_key AS cheapest_store FROM (SELECT match_group, store_key, row_number() OVER (
    PARTITION BY match_group ORDER BY price, {ORD}) AS rn FROM matched) WHERE rn = 1"""),
    ("groups", f"""
  SELECT s.*, f.* EXCLUDE (match_group), c.cheapest_store, {rnd('s.std_price / s.mean_price * 100', 2)} AS cv,
    {rnd('s.max_price - s.min_price', 2)} AS price_range, {rnd('s.q75 - s.q25', 2)} AS iqr,
    CASE WHEN s.min_price > 0 THEN {rnd('s.max_price / s.min_price', 3)} END AS price_spread_ratio
  FROM stats s JOIN firsts f USING (match_group) JOIN cheapest c USING (match_group)"""),
    ("catmean", "SELECT category, avg(price) AS category_mean FROM matched WHERE category IS NOT NULL GROUP BY category"),
    ("brandmean", "SELECT brand, avg(price) AS brand_mean FROM matched GROUP BY brand"),
    ("tiers", """
  SELECT brand, brand_mean, CASE WHEN brand_mean <= (SELECT quantile_cont(brand_mean, 0.33) FROM brandmean) THEN 'economy'
    WHEN brand_mean <= (SELECT quantile_cont(brand_mean, 0.66) FROM brandmean) THEN 'mid-range' ELSE 'premium' END AS brand_tier
  FROM brandmean"""),
    ("tiered", """
  SELECT g.*, t.brand_tier, CASE t.brand_tier WHEN 'economy' THEN 1 WHEN 'mid-range' THEN 2 ELSE 3 END AS tier_numeric
  FROM groups g JOIN tiers t USING (brand)"""),
]


def chain(sql: str, upto: str, extra: list[tuple[str, str]] = ()) -> str:
    """A statement over the steps up to the named one, plus steps of its own."""
    names = [name for name, _ in STEPS]
    steps = STEPS[: names.index(upto) + 1] + list(extra)
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in steps) + "\n" + sql


_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def _fuzzy() -> str:
    """Most similar name of every later store. Character counts bound what two names share; the similarity is computed where
    the bound is not below the similarity of the pair with the highest bound."""
    counts = ", ".join(f"length(s) - length(replace(s, '{c}', '')) AS c{i}" for i, c in enumerate(_LETTERS))
    rest = "n - (" + " + ".join(f"c{i}" for i in range(len(_LETTERS))) + ")"
    shared = " + ".join(f"least(a.c{i}, b.c{i})" for i in range(len(_LETTERS) + 1))

    def scored(name: str, pairs: str) -> str:
        # longest common subsequence with one addition per character; places of b's characters are bits
        step = "((v + (v & m)) | (v - (v & m))) & ((1::HUGEINT << y.n) - 1)"
        return f"""{name} AS MATERIALIZED (
  SELECT a, b, store_b, 200.0 * (y.n - bit_count(list_reduce(list_select(masks, x.codes), lambda v, m: {step}, (1::HUGEINT << y.n) - 1)))
    / total AS score
  FROM {pairs} p JOIN fz_codes x ON x.k = p.a JOIN fz_sorted y ON y.k = p.b JOIN fz_masks z ON z.k = p.b
)"""

    return rf""", fz_names AS (
  SELECT DISTINCT store_key, product_name_clean AS name FROM allrows WHERE match_group IS NULL AND product_name_clean IS NOT NULL
), fz_sorted AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY name, store_key) AS k, *, length(s) AS n FROM (SELECT *,
    array_to_string(list_sort(list_filter(regexp_split_to_array(name, '\s+'), lambda w: w <> '')), ' ') AS s FROM fz_names)
), fz_counted AS (SELECT *, {counts} FROM fz_sorted),
fz_bags AS MATERIALIZED (SELECT *, {rest} AS c{len(_LETTERS)} FROM fz_counted),
fz_placed AS (SELECT k, unnest(string_split(s, '')) AS letter, unnest(range(0, n)) AS i FROM fz_sorted WHERE n > 0),
fz_letters AS MATERIALIZED (
  SELECT letter, row_number() OVER (ORDER BY letter) AS code FROM (SELECT DISTINCT letter FROM fz_placed)
), fz_codes AS MATERIALIZED (SELECT k, list(code ORDER BY i) AS codes FROM fz_placed JOIN fz_letters USING (letter) GROUP BY k),
fz_bits AS (SELECT k, code, sum(1::HUGEINT << i)::HUGEINT AS bits FROM fz_placed JOIN fz_letters USING (letter) GROUP BY k, code),
fz_masks AS MATERIALIZED (
  SELECT k, list(coalesce(bits, 0)::HUGEINT ORDER BY code) AS masks
  FROM (SELECT k, code FROM fz_sorted, fz_letters) LEFT JOIN fz_bits USING (k, code) GROUP BY k
), fz_bound AS MATERIALIZED (
  SELECT * FROM (
    SELECT a.k AS a, b.k AS b, b.store_key AS store_b, a.n + b.n AS total, 200.0 * ({shared}) / (a.n + b.n) AS bound
    FROM fz_bags a JOIN fz_bags b ON a.store_key < b.store_key WHERE a.n > 0 AND b.n > 0
  ) WHERE bound >= 55
), fz_first AS (SELECT a, arg_max(b, bound) AS b, store_b, arg_max(total, bound) AS total FROM fz_bound GROUP BY a, store_b),
{scored("fz_floor", "fz_first")},
{scored("fz_near", "(SELECT e.* FROM fz_bound e JOIN fz_floor f USING (a, store_b) WHERE e.bound >= f.score - 1e-6)")}
SELECT x.store_key AS store_a, x.name AS name_a, y.store_key AS store_b, y.name AS name_b, {rnd("score", 4)} AS score
FROM (SELECT a, b, score, row_number() OVER (PARTITION BY a, store_b ORDER BY score DESC, b) AS place FROM fz_near WHERE score >= 55)
JOIN fz_sorted x ON x.k = a JOIN fz_sorted y ON y.k = b WHERE place = 1"""


def _corr(x: str, y: str, source: str, metric: str) -> str:
    def safe(a, b):
        return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"

    pearson, spearman = rnd(safe("x", "y"), 4), rnd(safe("rx", "ry"), 4)
    return f"""
  SELECT '{metric}' AS metric, count(*) AS n, CASE WHEN count(*) > 10 THEN {pearson} END AS pearson,
    CASE WHEN count(*) > 10 THEN {spearman} END AS spearman,
    CASE WHEN count(*) > 10 THEN CASE WHEN {pearson} > 0.1 THEN 'positive' WHEN {pearson} < -0.1 THEN 'negative'
      WHEN {pearson} IS NOT NULL THEN 'none' END END AS verdict
  FROM (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
      rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
    FROM (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source}) WHERE x IS NOT NULL AND y IS NOT NULL)"""


_SIZE_CV = _corr("qty_normalized", "cv", "groups", "size_vs_cv")
_COMP = _corr(
    "num_stores",
    "price_range",
    "(SELECT * FROM groups WHERE num_stores IS NOT NULL AND price_range IS NOT NULL AND cv IS NOT NULL AND price_spread_ratio IS NOT NULL)",
    "competitors_vs_spread",
)
_TIER_CV = _corr("tier_numeric", "cv", "tiered", "brand_tier_vs_cv")


def _pairs(dim: str) -> list[tuple[str, str]]:
    return [
        ("dims", f"SELECT match_group, {dim} AS d, {rnd('avg(price)', 6)} AS m FROM matched WHERE {dim} IS NOT NULL GROUP BY match_group, {dim}"),
        ("pairrows", "SELECT x.d AS a, y.d AS b, x.m AS pa, y.m AS pb FROM dims x JOIN dims y ON x.match_group = y.match_group AND x.d < y.d"),
        ("ranked", """SELECT *, rank() OVER (PARTITION BY a, b ORDER BY pa) + (count(*) OVER (PARTITION BY a, b, pa) - 1) / 2.0 AS ra,
      rank() OVER (PARTITION BY a, b ORDER BY pb) + (count(*) OVER (PARTITION BY a, b, pb) - 1) / 2.0 AS rb FROM pairrows"""),
        ("pairs", f"""SELECT a, b, {rnd('covar_pop(pa, pb) / nullif(stddev_pop(pa) * stddev_pop(pb), 0)', 4)} AS pearson,
      {rnd('covar_pop(ra, rb) / nullif(stddev_pop(ra) * stddev_pop(rb), 0)', 4)} AS spearman FROM ranked
    WHERE (SELECT count(*) FROM (SELECT match_group FROM dims GROUP BY match_group HAVING count(*) >= 2)) > 10 GROUP BY a, b"""),
    ]


def _matrix(dim: str, method: str) -> str:
    return chain(
        f"""SELECT a AS {dim}_a, b AS {dim}_b, {method} AS r FROM pairs
  UNION ALL SELECT b, a, {method} FROM pairs UNION ALL SELECT d, d, 1.0 FROM (SELECT a AS d FROM pairs UNION SELECT b FROM pairs)""",
        "matched",
        _pairs("city" if dim == "city" else "store_key"),
    )


def _hist(column: str, where: str = "true") -> str:
    return chain(
        f"""SELECT b.bin AS bin, {rnd('lo + (hi - lo) / 50 * (b.bin - 1)', 6)} AS bin_lo, {rnd('lo + (hi - lo) / 50 * b.bin', 6)} AS bin_hi,
  (SELECT count(*) FROM binned n WHERE n.bin = b.bin) AS num_values, (SELECT {rnd('avg(' + column + ')', 6)} FROM groups) AS mean_value
  FROM span, (SELECT unnest(range(1, 51)) AS bin) b""",
        "groups",
        [
            ("vals", f"SELECT CAST({column} AS DOUBLE) AS v FROM groups WHERE {column} IS NOT NULL AND {where}"),
            ("span", "SELECT min(v) - CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS lo, max(v) + CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS hi FROM vals"),
            ("binned", "SELECT least(50, CAST(floor((v - lo) / (hi - lo) * 50) AS BIGINT) + 1) AS bin FROM vals, span"),
        ],
    )


def _box(source: str, by: str, value: str, upto: str) -> str:
    return chain(
        f"""SELECT {by}, {rnd(f'min({value})', 6)} AS low, {rnd(f'quantile_cont({value}, 0.25)', 6)} AS q25, {rnd(f'median({value})', 6)} AS median,
  {rnd(f'quantile_cont({value}, 0.75)', 6)} AS q75, {rnd(f'max({value})', 6)} AS high, count(*) AS num_values
  FROM {source} WHERE {by} IS NOT NULL AND {value} IS NOT NULL GROUP BY {by}""",
        upto,
    )


def _averages(by: str) -> str:
    return chain(
        f"SELECT {by}, {rnd('avg(price)', 4)} AS avg_price, {rnd('median(price)', 4)} AS median_price, count(price) AS total_products FROM matched GROUP BY {by}",
        "matched",
    )


_ID = "store_key, city, product_name, price"
_LDI = "SELECT cheapest_store AS store_key, count(*) AS n FROM groups GROUP BY 1"
_CATWINS = "SELECT category, cheapest_store AS store_key, count(*) AS n, sum(count(*)) OVER (PARTITION BY category) AS size FROM groups WHERE category IS NOT NULL GROUP BY 1, 2"
_KINDS = ("biscuits", "salt", "flour", "unlisted goods", "Tea & Coffee", "toys", "chicken", "misc")


def _store_city() -> str:
    return chain(
        f"""SELECT k.store_key, k.city, {rnd('i.idx', 4)} AS avg_category_price_index, {rnd('d.dev', 2)} AS median_price_deviation,
  {rnd('v.vol', 2)} AS price_volatility_score, {rnd('v.lead', 2)} AS price_leadership_frequency_pct, k.n AS products_count
  FROM (SELECT store_key, city, count(*) AS n FROM matched GROUP BY 1, 2) k
  JOIN (SELECT store_key, city, avg(m / category_mean) AS idx FROM (SELECT store_key, city, category, avg(price) AS m FROM matched GROUP BY 1, 2, 3)
    JOIN catmean USING (category) GROUP BY 1, 2) i USING (store_key, city)
  JOIN (SELECT store_key, city, median(price - category_mean) AS dev FROM matched JOIN catmean USING (category) GROUP BY 1, 2) d USING (store_key, city)
  JOIN (SELECT store_key, city, avg(cv) AS vol, 100.0 * count(*) FILTER (cheapest_store = store_key) / count(*) AS lead
    FROM (SELECT DISTINCT store_key, city, match_group FROM matched) JOIN groups USING (match_group) GROUP BY 1, 2) v USING (store_key, city)""",
        "catmean",
    )


def statements() -> dict[str, str]:
    out: dict[str, str] = {}
    out["dedup_listings"] = chain(f"SELECT {_ID}, old_price, category, CAST(sku AS BIGINT) AS sku FROM deduped", "deduped")
    out["dedup_policies"] = chain("""
  SELECT store_key, count(*) AS num_rows, count(DISTINCT row(city, product_name, price)) AS listing,
    count(DISTINCT row(city, product_name)) AS listing_any_price, count(DISTINCT row(product_name, price)) AS offer,
    count(DISTINCT sku) AS item FROM raw GROUP BY store_key""", "raw")
    out["clean_listings"] = chain(f"SELECT {_ID}, old_price, category, product_name_clean, brand, quantity, unit, qty_normalized, unit_normalized, price_per_unit FROM processed", "processed")
    out["parse_price_text"] = chain("SELECT store_key, product_name, price, price AS parsed FROM raw", "raw")
    out["extract_size"] = chain("SELECT DISTINCT product_name_clean, quantity, unit FROM sized", "sized")
    out["price_per_unit"] = chain(f"SELECT unit_normalized, count(*) AS num_rows, count(price_per_unit) AS priced, {rnd('sum(CAST(price_per_unit AS DECIMAL(18,2)))', 2)} AS total FROM processed GROUP BY unit_normalized", "processed")
    out["extract_brand"] = chain("SELECT brand, count(*) AS num_rows, count(DISTINCT product_name_clean) AS num_names FROM branded GROUP BY brand", "branded")
    out["match_keys"] = chain("SELECT DISTINCT product_name_clean, match_key, name_key FROM keyed", "keyed")
    for p in (1, 2, 3):
        out[f"match_pass{p}"] = chain(f"SELECT match_group, count(*) AS num_rows, count(DISTINCT store_key) AS num_stores FROM allrows WHERE match_pass = {p} GROUP BY match_group", "allrows")
    out["match_all"] = chain(f"SELECT {_ID}, match_key, name_key, match_group, match_pass FROM allrows", "allrows")
    out["match_coverage"] = chain("SELECT coalesce(match_pass, 0) AS match_pass, count(DISTINCT match_group) AS num_groups, count(*) AS num_rows, count(match_key) AS rows_with_full_key, count(name_key) AS rows_with_name_key FROM allrows GROUP BY 1", "allrows")
    out["match_summary"] = chain(f"SELECT match_group, product AS product_name, brand, quantity, unit, num_stores, stores, min_price, max_price, {rnd('mean_price', 4)} AS avg_price, {rnd('max_price - min_price', 4)} AS price_range, num_rows FROM groups", "groups")
    out["price_dispersion"] = chain(f"""SELECT match_group, product, brand, category, num_stores, num_cities, num_obs, {rnd('mean_price', 4)} AS mean_price,
  {rnd('median_price', 4)} AS median_price, {rnd('std_price', 4)} AS std_price, min_price, max_price, {rnd('q25', 4)} AS q25, {rnd('q75', 4)} AS q75,
  cv, price_range, iqr, price_spread_ratio FROM groups""", "groups")
    out["dispersion_summary"] = chain(f"""SELECT count(*) AS num_groups, {rnd('avg(cv)', 6)} AS mean_cv, {rnd('median(cv)', 6)} AS median_cv, {rnd('avg(price_range)', 6)} AS mean_range,
  max(price_range) AS max_range, {rnd('avg(iqr)', 6)} AS mean_iqr, {rnd('avg(price_spread_ratio)', 6)} AS mean_spread,
  count(*) FILTER (cv > 10) AS groups_cv_over_10, count(*) FILTER (cv > 20) AS groups_cv_over_20 FROM groups""", "groups")
    out["category_dispersion"] = chain(f"SELECT category, {rnd('avg(cv)', 6)} AS avg_cv, {rnd('avg(price_range)', 6)} AS avg_range, count(product) AS num_products FROM groups WHERE category IS NOT NULL GROUP BY category", "groups")
    out["top_price_diffs"] = chain("SELECT product, brand, category, num_stores, min_price, max_price, price_range, cv, iqr, price_spread_ratio FROM groups ORDER BY price_range DESC, match_group LIMIT 20", "groups")
    out["rppi_rows"] = chain(f"SELECT {_ID}, match_group, {rnd('price / category_mean', 4)} AS rppi FROM matched LEFT JOIN catmean USING (category)", "catmean")
    out["rppi_by_store"] = chain(f"SELECT store_key, {rnd('avg(rppi)', 4)} AS rppi_mean, {rnd('median(rppi)', 4)} AS rppi_median, {rnd('stddev_samp(rppi)', 4)} AS rppi_std FROM (SELECT store_key, {rnd('price / category_mean', 4)} AS rppi FROM matched JOIN catmean USING (category)) GROUP BY store_key", "catmean")
    out["store_city_metrics"] = _store_city()
    out["price_index_pivot"] = "SELECT * FROM (PIVOT (SELECT store_key, city, avg_category_price_index AS v FROM (" + _store_city() + ")) ON city IN ('automobile', 'building', 'furniture', 'household', 'machinery', 'orchard') USING first(v) GROUP BY store_key)"
    out["store_averages"] = _averages("store_key")
    out["city_averages"] = _averages("city")
    exact = ", ".join(f"{rnd(f'quantile_cont(price, {p})', 4)} AS exact_{q}, TRUE AS {q}_within_error" for q, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)))
    out["sketched_quartiles"] = chain(f"SELECT store_key, count(price) AS num_values, {exact} FROM matched WHERE store_key IS NOT NULL GROUP BY store_key", "matched")
    out["ldi_basic"] = chain(f"SELECT store_key, n AS lowest_price_count, (SELECT count(*) FROM groups) AS total_matched_groups, {rnd('n / (SELECT count(*) FROM groups)', 4)} AS ldi FROM ({_LDI})", "groups")
    out["ldi_weighted"] = chain(f"SELECT store_key, {rnd('sum(n / size * (size / (SELECT count(category) FROM groups)))', 4)} AS weighted_ldi FROM ({_CATWINS}) GROUP BY store_key", "groups")
    grid = f"""SELECT c.category, s.store_key, coalesce(w.n, 0) AS cheapest_count, CAST(coalesce(w.size, 0) AS BIGINT) AS total_in_category,
  coalesce({rnd('w.n / w.size', 4)}, 0.0) AS category_ldi FROM (SELECT DISTINCT category FROM matched) c CROSS JOIN (SELECT DISTINCT store_key FROM matched) s
  LEFT JOIN ({_CATWINS}) w ON c.category = w.category AND s.store_key = w.store_key"""
    out["ldi_category"] = chain(grid, "groups")
    out["category_ldi_pivot"] = chain(f"""SELECT category, coalesce(max(category_ldi) FILTER (store_key = 'africa'), 0) AS africa, coalesce(max(category_ldi) FILTER (store_key = 'america'), 0) AS america,
  coalesce(max(category_ldi) FILTER (store_key = 'asia'), 0) AS asia, coalesce(max(category_ldi) FILTER (store_key = 'europe'), 0) AS europe,
  coalesce(max(category_ldi) FILTER (store_key = 'middle east'), 0) AS "middle east" FROM ({grid}) GROUP BY category""", "groups")
    out["times_cheapest_rows"] = chain("SELECT c.cheapest_store AS store_key, count(*) AS times_cheapest FROM matched JOIN cheapest c USING (match_group) GROUP BY 1", "cheapest")
    out["corr_size_cv"] = chain(_SIZE_CV, "groups")
    out["corr_competitors_range"] = chain(_COMP, "groups")
    out["corr_brand_tier_cv"] = chain(_TIER_CV, "tiered")
    out["brand_tiers"] = chain(f"SELECT brand, {rnd('brand_mean', 4)} AS brand_mean, brand_tier FROM tiers", "tiers")
    out["tier_statistics"] = chain(f"SELECT brand_tier, {rnd('avg(cv)', 2)} AS mean_cv, {rnd('median(cv)', 2)} AS median_cv, {rnd('stddev_samp(cv)', 2)} AS std_cv FROM tiered GROUP BY brand_tier", "tiered")
    out["city_corr_pearson"] = _matrix("city", "pearson")
    out["city_corr_spearman"] = _matrix("city", "spearman")
    out["store_corr"] = _matrix("store", "pearson")
    sync = f"SELECT {rnd('avg(pearson)', 4)} AS cross_store_sync_score FROM pairs"
    out["sync_score"] = chain(sync, "matched", _pairs("store_key"))
    out["corr_summary"] = chain(f"""SELECT a.pearson AS size_vs_cv_pearson, a.spearman AS size_vs_cv_spearman, b.pearson AS competitors_vs_spread_pearson,
  b.spearman AS competitors_vs_spread_spearman, c.pearson AS brand_tier_vs_cv_pearson, c.spearman AS brand_tier_vs_cv_spearman, s.cross_store_sync_score
  FROM ({_SIZE_CV}) a, ({_COMP}) b, ({_TIER_CV}) c, ({sync}) s""", "tiered", _pairs("store_key"))
    out["cv_histogram"] = _hist("cv")
    out["spread_histogram"] = _hist("price_spread_ratio", "price_spread_ratio < (SELECT quantile_cont(price_spread_ratio, 0.99) FROM groups)")
    out["boxplot_range_by_stores"] = _box("groups", "num_stores", "price_range", "groups")
    out["boxplot_cv_by_tier"] = _box("tiered", "brand_tier", "cv", "tiered")
    out["dq_row_counts"] = chain("""SELECT 'raw' AS layer, count(*) AS num_rows, CASE WHEN count(*) >= 500000 THEN 'OK' ELSE 'WARN' END AS status FROM raw
  UNION ALL SELECT 'processed', count(*), NULL FROM processed UNION ALL SELECT 'all with matches', count(*), NULL FROM allrows
  UNION ALL SELECT 'matched', count(*), NULL FROM matched""", "matched")
    missing = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS total FROM processed"
        for c in ("product_name", "price", "store_key", "city", "category", "brand", "quantity", "unit")
    )
    out["dq_missing"] = chain(f"""SELECT column_name, missing, {rnd('missing * 100.0 / total', 6)} AS missing_pct,
  CASE WHEN missing * 100.0 / total < 5 THEN 'OK' WHEN missing * 100.0 / total < 20 THEN 'WARNING' ELSE 'BAD' END AS status FROM ({missing})""", "processed")
    out["dq_duplicates"] = chain("""SELECT (SELECT count(*) FROM p) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p)) AS exact_duplicates,
  (SELECT count(*) FROM p) - (SELECT count(*) FROM (SELECT DISTINCT store_key, product_name, price FROM p)) AS near_duplicates""",
        "processed", [("p", "SELECT * EXCLUDE (ok, ln, sk, disc) FROM processed")])
    out["dq_names_per_store"] = chain("SELECT store_key, count(DISTINCT product_name) AS unique_names, count(*) AS num_rows FROM processed GROUP BY store_key", "processed")
    sanity = f"""min(price) AS min_price, max(price) AS max_price, {rnd('avg(price)', 4)} AS mean_price, {rnd('median(price)', 4)} AS median_price,
  count(*) FILTER (price <= 0) AS not_positive, count(*) FILTER (price > 50000) AS suspicious FROM processed"""
    out["dq_price_sanity"] = chain(f"SELECT NULL AS store_key, {sanity} UNION ALL SELECT store_key, {sanity} GROUP BY store_key", "processed")
    out["dq_coverage"] = chain("SELECT count(DISTINCT store_key) AS num_stores, count(DISTINCT city) AS num_cities, count(DISTINCT category) AS num_categories FROM processed", "processed")
    out["dq_store_city_rows"] = chain("SELECT store_key, city, count(*) AS num_rows FROM processed GROUP BY 1, 2", "processed")
    out["dq_match_quality"] = chain("SELECT count(DISTINCT match_group) AS num_groups, count(*) AS matched_rows, CASE WHEN count(DISTINCT match_group) >= 10000 THEN 'OK' ELSE 'WARN' END AS status FROM matched", "matched")
    out["dq_group_sizes"] = chain("SELECT num_stores, count(*) AS num_groups, CASE WHEN num_stores >= 4 THEN '4+' ELSE CAST(num_stores AS VARCHAR) END AS bucket FROM stats GROUP BY num_stores", "stats")
    out["dq_matched_rows_per_store"] = chain("SELECT store_key, count(*) AS num_rows FROM matched GROUP BY store_key", "matched")
    out["dq_rejections"] = chain("""SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM raw) - (SELECT count(*) FROM deduped) AS duplicates,
  count(*) FILTER (length(product_name_clean) <= 2) AS empty_names,
  count(*) FILTER (length(product_name_clean) > 2 AND NOT coalesce(price > 0, false)) AS invalid_prices,
  count(*) FILTER (length(product_name_clean) > 2 AND price > 100000) AS prices_too_high,
  count(*) FILTER (length(product_name_clean) > 2 AND price > 0 AND price <= 100000) AS clean_rows FROM named""", "named")
    out["overview_kpis"] = chain(f"""SELECT r.*, g.* FROM (SELECT count(*) AS total_products, count(DISTINCT store_key) AS num_stores, count(DISTINCT city) AS num_cities FROM raw) r,
  (SELECT count(*) AS match_groups, CAST(sum(num_rows) AS BIGINT) AS matched_rows, {rnd('avg(price_range)', 6)} AS avg_price_range, max(price_range) AS max_price_range FROM groups) g""", "groups")
    out["rows_by_dimension"] = chain("SELECT store_key, city, count(*) AS num_rows, CAST(grouping(store_key, city) AS BIGINT) AS level FROM raw GROUP BY GROUPING SETS ((store_key), (city), (store_key, city), ())", "raw")
    out["store_city_crosstab"] = chain("SELECT store_key, " + ", ".join(f"count(*) FILTER (city = '{c}') AS {c}" for c in ("automobile", "building", "furniture", "household", "machinery", "orchard")) + " FROM raw GROUP BY store_key", "raw")
    hits = "FROM processed WHERE regexp_matches(product_name_clean, 'red (widget|gear)', 'i') AND store_key IN ('africa', 'asia', 'europe') AND city IN ('automobile', 'building')"
    out["search_products"] = chain(f"SELECT product_name_clean, brand, price, store_key, city, category {hits} ORDER BY price, {ORD} LIMIT 200", "processed")
    out["search_by_index"] = chain(
        "SELECT product_name_clean, brand, price, store_key, city, category FROM processed WHERE regexp_matches(product_name_clean, '(?i)large gea?r')", "processed"
    )
    out["search_stats"] = chain(f"SELECT store_key, count(*) AS num_hits, {rnd('avg(price)', 4)} AS mean_price, min(price) AS min_price, max(price) AS max_price {hits} GROUP BY store_key", "processed")
    compare = f"""SELECT product AS product_name, brand, stores, num_stores, min_price, max_price, {rnd('max_price - min_price', 4)} AS price_range, {rnd('mean_price', 4)} AS avg_price
  FROM groups WHERE max_price - min_price >= 50 AND num_stores >= 3 ORDER BY max_price - min_price DESC, match_group"""
    out["compare_prices"] = chain(f"{compare} LIMIT 100", "groups")
    out["compare_labels"] = chain(f"SELECT product_name[1:40] AS label, price_range FROM ({compare} LIMIT 15)", "groups")
    out["browse_layer"] = chain(f"SELECT {_ID}, brand FROM processed WHERE store_key = 'asia' ORDER BY {ORD} LIMIT 500", "processed")
    out["top_brands"] = chain("SELECT brand, count(*) AS num_rows FROM processed GROUP BY brand ORDER BY num_rows DESC, brand LIMIT 10", "processed")
    out["extraction_coverage"] = chain("SELECT count(*) AS num_rows, count(*) FILTER (quantity IS NOT NULL AND unit IS NOT NULL) AS with_size, count(price_per_unit) AS with_unit_price FROM processed", "processed")
    out["store_reach"] = chain("SELECT store_key, count(*) AS num_rows, count(DISTINCT city) AS num_cities, count(CASE WHEN old_price IS NOT NULL THEN sku END) AS with_url FROM raw GROUP BY store_key", "raw")
    out["fuzzy_scores"] = chain(_fuzzy(), "allrows")
    out["replicate_cities"] = chain("""SELECT store_key, t.city, product_name, price FROM deduped d, (SELECT unnest(['automobile', 'building', 'lahore', 'karachi']) AS city) t
  WHERE d.city = 'automobile' AND NOT EXISTS (SELECT 1 FROM raw e WHERE e.store_key = d.store_key AND e.city = t.city)""", "deduped")
    out["merge_partition"] = chain(f"""SELECT store_key, product_name, city, price FROM (SELECT *, row_number() OVER (PARTITION BY store_key, product_name, city ORDER BY src, {ORD}) AS rn
  FROM (SELECT *, CASE WHEN old_price IS NULL THEN 0 ELSE 1 END AS src FROM raw)) WHERE rn = 1""", "raw")
    out["layer_round_trip"] = out["merge_partition"]
    out["gather_drift"] = chain(f"""SELECT store_key, city, count(*) AS num_rows, count(price) AS priced, {rnd("CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE)", 2)} AS total,
    count(old_price) FILTER (length(store_key) % 3 <> 1) AS discounted, count(category) FILTER (length(store_key) % 3 <> 1) AS categorised,
    CAST(max(length(CAST(sku AS VARCHAR)) + CASE WHEN length(store_key) % 3 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS longest_sku
  FROM raw GROUP BY store_key, city""", "raw")
    out["raw_duplicates"] = chain("""SELECT CAST((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM raw
    GROUP BY store_key, city, category, product_name, price, old_price, currency, scraped_at, sku)) AS BIGINT) AS exact_duplicates,
  CAST((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM raw GROUP BY store_key, product_name, price)) AS BIGINT) AS near_duplicates""", "raw")
    out["new_names"] = chain(f"""SELECT store_key, product_name, price FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(product_name)) ORDER BY {ORD}) AS rn FROM raw r
  WHERE scraped_at >= DATE '1996-01-01' AND lower(trim(product_name)) NOT IN (SELECT lower(trim(product_name)) FROM raw WHERE scraped_at < DATE '1996-01-01')) WHERE rn = 1""", "raw")
    out["catalogue_keys"] = chain("""SELECT DISTINCT product_name_clean, replace(trim(regexp_replace(regexp_replace(lower(product_name_clean), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')), ' ', '_')
  || CASE WHEN quantity IS NOT NULL AND unit IS NOT NULL THEN '__' || CAST(quantity AS VARCHAR) || '_' || unit ELSE '' END AS catalogue_key FROM processed""", "processed")
    keyword = "CASE " + " ".join(f"WHEN contains(txt, '{k}') THEN '{v}'" for k, v in CATEGORY_BY_KEYWORD.items()) + " ELSE 'general' END"
    kind = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END"
    shop_title = "CASE WHEN p_partkey % 13 = 0 THEN 'x' ELSE p_name || ' ' || p_size || 'g' END"
    out["json_shop_listings"] = f"""
  WITH s AS (SELECT *, {shop_title} AS title, {kind} AS kind, lower(p_type) || CASE WHEN p_partkey % 5 = 0 THEN ', baby' ELSE ', offer' END AS tags FROM part),
  c AS (SELECT *, lower(kind) || ' ' || tags || ' ' || lower(title) AS txt FROM s)
  SELECT title AS product_name, CAST(p_partkey AS VARCHAR) AS sku, p_retailprice AS price,
    CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 50 END AS old_price, p_brand AS brand,
    {_case("lower(kind)", CATEGORY_BY_TYPE, keyword)} AS category, p_partkey % 2 = 0 AS in_stock,
    CASE WHEN p_size % 4 <> 0 THEN p_size || ' g' END AS weight, 'https://shop.example/products/p-' || p_partkey AS product_url
  FROM c WHERE p_partkey % 11 <> 0 AND p_partkey % 17 <> 0 AND length(title) >= 2"""
    out["json_catalogue_listings"] = """
  SELECT p_name AS product_name, lower(p_type) AS category, CASE WHEN p_partkey % 4 = 0 THEN p_retailprice - 100 ELSE p_retailprice END AS price,
    CASE WHEN p_partkey % 4 = 0 THEN p_retailprice END AS old_price, 'Store > ' || p_type || CASE WHEN p_partkey % 3 = 0 THEN ' > ' || p_brand ELSE '' END AS category_hierarchy,
    CAST(p_partkey AS VARCHAR) AS sku, p_size > 25 AS in_stock FROM part WHERE p_partkey % 19 <> 0"""
    out["json_search_listings"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS product_name, p_retailprice AS price, CASE WHEN p_partkey % 5 = 0 THEN p_retailprice + 25 END AS old_price,
    upper(p_type[1]) || lower(p_type[2:]) || ' Aisle' AS category, 'Grocery > ' || p_type AS category_hierarchy,
    'https://market.example/' || lower(p_type) || '-aisle/i' || p_partkey AS product_url, 'https://img.example/' || p_partkey || '.jpg' AS image_url
  FROM part WHERE p_partkey % 23 <> 0"""
    out["json_extra_listings"] = """
  SELECT product_name, price, category FROM (SELECT p_name || ' ' || p_size AS product_name, p_retailprice + 1000 AS price,
      CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'general' END AS category,
      row_number() OVER (PARTITION BY lower(p_name || ' ' || p_size) ORDER BY p_partkey // 40, p_partkey % 40) AS rn
    FROM part WHERE p_partkey % 29 <> 0 AND lower(p_name || ' ' || p_size) NOT IN (SELECT lower(p_name || ' ' || p_size) FROM part WHERE p_type = 'PROMO')) WHERE rn = 1"""
    card = "p_name || ' & ' || p_type || ' ' || p_size || 'gm' AS product_name, floor(p_retailprice * 4) AS price, CASE WHEN p_partkey % 3 = 0 THEN floor(p_retailprice * 4) + 111 END AS old_price"
    out["html_magento"] = f"SELECT {card}, 'https://store.example/p/' || p_partkey || '.html' AS product_url, '/img/' || p_partkey || '.jpg' AS image_url FROM part WHERE p_partkey % 31 <> 0"
    out["html_tolerant"] = f"SELECT {card}, 'https://store.example/p/' || p_partkey || '.html' AS product_url FROM part"
    out["html_tolerant_magento"] = f"SELECT {card}, 'https://store.example/p/' || p_partkey || '.html' AS product_url FROM part WHERE p_partkey % 31 <> 0"
    out["html_text_priced"] = f"SELECT {card}, lower(p_type) AS category, 'https://store.example/product/' || p_partkey AS product_url FROM part"
    out["leaf_categories"] = "SELECT 'p' || p_partkey AS id, p_type || '/' || p_brand AS parent_id, p_name AS category_name FROM part WHERE p_partkey % 7 <> 3"
    out["request_audit"] = """
  WITH tries AS (SELECT user_id, event_type, event_id, value, t.n AS n FROM events, (SELECT unnest([1, 2, 3]) AS n) t
    WHERE t.n <= CASE WHEN event_type <> 'error' THEN 1 WHEN event_id % 3 = 0 THEN 2 ELSE 3 END),
  lines AS (SELECT 'shop' || user_id AS store, CAST(floor(value * 10) AS BIGINT) + n AS ms, event_type = 'error' AND NOT (event_id % 3 = 0 AND n = 2) AS failed FROM tries)
  SELECT store, count(*) AS total_requests, count(*) FILTER (failed) AS failed_requests, """ + rnd("100.0 * count(*) FILTER (failed) / count(*)", 6) + " AS fail_pct, " + rnd("median(ms)", 6) + " AS ms_median, " + rnd("quantile_cont(ms, 0.95)", 6) + " AS ms_p95, (SELECT count(*) FROM events WHERE event_id % 50 = 0) AS unparsed_lines FROM lines GROUP BY store"
    out["failure_streaks"] = """
  WITH r AS (SELECT 'shop' || user_id AS store, ts, event_id, event_type = 'error' AND event_id % 3 <> 0 AS failed FROM events),
  g AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY ts, event_id) - row_number() OVER (PARTITION BY store, failed ORDER BY ts, event_id) AS island FROM r)
  SELECT store, count(*) AS failures, arg_min(event_id, row(ts, event_id)) AS first_event, arg_max(event_id, row(ts, event_id)) AS last_event FROM g WHERE failed GROUP BY store, island HAVING count(*) >= 3"""
    return out
