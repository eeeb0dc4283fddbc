"""The results of the queries in SQL for DuckDB, over the same tables."""

from __future__ import annotations

from forecourt.config import NUMERIC

VIEWS = """
WITH joined AS (
  SELECT *, CASE p_type WHEN 'ECONOMY' THEN 'Electric' WHEN 'MEDIUM' THEN 'Diesel Hybrid' ELSE p_type END AS fuel,
    l_extendedprice * CASE WHEN p_brand = 'Brand#25' AND l_extendedprice < 40000 THEN 2.0::DOUBLE WHEN p_brand = 'Brand#5' THEN 0.5::DOUBLE
      ELSE 1.0::DOUBLE END AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey
), raw AS (
  SELECT
    md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))) AS listing_id,
    p_brand AS brand,
    p_brand || ' ' || p_name AS model,
    CASE WHEN l_discount = 0.0 AND l_tax = 0.01 THEN NULL
         WHEN l_returnflag = 'N' THEN 'Unknown' ELSE l_returnflag END AS transmission_type,
    CASE WHEN l_discount = 0.0 AND l_tax = 0.04 THEN '07/2010'
         WHEN l_discount = 0.1 AND l_tax = 0.04 THEN NULL ELSE fuel END AS fuel_type,
    CASE WHEN l_discount = 0.0 AND l_tax = 0.08 THEN NULL ELSE CAST(year(l_shipdate) AS DOUBLE) END AS year,
    CASE WHEN l_discount = 0.0 AND l_tax = 0.0 THEN NULL ELSE price END AS price_in_euro,
    CASE WHEN l_discount = 0.1 AND l_tax = 0.0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS power_ps,
    CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN NULL ELSE l_quantity END AS mileage_in_km,
    l_linestatus AS color,
    p_name AS offer_description
  FROM joined
), ruled AS (
  SELECT *, CASE
    WHEN price_in_euro IS NULL THEN 1
    WHEN year IS NULL THEN 2
    WHEN power_ps IS NULL THEN 3
    WHEN mileage_in_km IS NULL THEN 4
    WHEN fuel_type IS NULL OR fuel_type NOT IN ('Diesel Hybrid', 'Electric', 'LARGE', 'SMALL', 'STANDARD') THEN 5
    WHEN transmission_type = 'Unknown' THEN 6
    WHEN year < 1996 THEN 7
    WHEN price_in_euro < 2000 THEN 8
    WHEN price_in_euro > 80000 THEN 9
    WHEN power_ps < 2 OR power_ps > 48 THEN 10
    WHEN mileage_in_km > 49 THEN 11
    WHEN mileage_in_km = 1 THEN 12 END AS broken
  FROM raw
), clean AS (
  SELECT listing_id, brand, model, transmission_type, fuel_type, year, price_in_euro, power_ps, mileage_in_km
  FROM ruled WHERE broken IS NULL
), split AS (
  SELECT *, 2001.0::DOUBLE - year AS car_age,
    mileage_in_km / greatest(2001.0::DOUBLE - year, 1.0::DOUBLE) AS mileage_per_year,
    CASE WHEN substr(md5('split|42|' || listing_id), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split
  FROM clean
), limits AS (
  SELECT median(price_in_euro) AS threshold FROM split WHERE split = 'train'
), labelled AS (
  SELECT split.*, CASE WHEN price_in_euro >= threshold THEN 1 ELSE 0 END AS price_segment FROM split, limits
), train AS (
  SELECT * FROM labelled WHERE split = 'train'
), by_model AS (
  SELECT model, avg(price_in_euro) AS price, avg(price_segment) AS high FROM train GROUP BY model
), by_brand AS (
  SELECT brand, avg(price_in_euro) AS price, avg(price_segment) AS high FROM train GROUP BY brand
), by_all AS (
  SELECT avg(price_in_euro) AS price, avg(price_segment) AS high FROM train
), scored AS (
  SELECT l.listing_id, l.split, l.price_in_euro, l.price_segment AS label,
    coalesce(m.price, b.price, a.price) AS price, coalesce(m.high, b.high, a.high) AS score,
    CASE WHEN coalesce(m.high, b.high, a.high) >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM labelled l LEFT JOIN by_model m USING (model) LEFT JOIN by_brand b USING (brand), by_all a
), dummy AS (
  SELECT listing_id, split, price_segment AS label,
    (SELECT CASE WHEN 2 * sum(price_segment) > count(*) THEN 1 ELSE 0 END FROM train) AS prediction
  FROM labelled
), requests AS (
  SELECT p_partkey AS request_id, CASE WHEN p_partkey % 97 = 5 THEN 'Nobody' ELSE p_brand END AS brand,
    CASE WHEN p_partkey % 97 = 5 THEN 'Nobody' ELSE p_brand END || ' ' || p_name AS model,
    CASE p_type WHEN 'ECONOMY' THEN 'Electric' WHEN 'MEDIUM' THEN 'Diesel Hybrid' ELSE p_type END AS fuel_type,
    CASE WHEN p_size > 25 THEN 'A' ELSE 'R' END AS transmission_type,
    1995 + p_size // 10 AS min_year, 1997 + p_size // 10 AS max_year,
    CASE WHEN p_type = 'STANDARD' THEN NULL ELSE CAST(p_size AS DOUBLE) END AS power_ps,
    floor((p_retailprice - 900) / 2) AS mileage_in_km
  FROM part
), bounded AS (
  SELECT *, concat_ws(',',
      CASE WHEN min_year >= 1996 AND max_year <= 2001 THEN NULL ELSE 'year' END,
      CASE WHEN power_ps IS NULL OR power_ps BETWEEN 2 AND 48 THEN NULL ELSE 'power' END,
      CASE WHEN mileage_in_km BETWEEN 1 AND 49 THEN NULL ELSE 'mileage' END) AS rejected_for
  FROM requests
), power_fuel AS (
  SELECT brand, model, fuel_type, median(power_ps) AS p FROM clean GROUP BY ALL HAVING count(*) >= 3
), power_model AS (
  SELECT brand, model, median(power_ps) AS p FROM clean GROUP BY ALL HAVING count(*) >= 3
), power_brand AS (
  SELECT brand, median(power_ps) AS p FROM clean GROUP BY ALL HAVING count(*) >= 3
), power_all AS (
  SELECT median(power_ps) AS p FROM clean
), powered AS (
  SELECT r.* EXCLUDE (power_ps), coalesce(r.power_ps, f.p, m.p, b.p, a.p, 25.0) AS power_ps,
    CASE WHEN r.power_ps IS NOT NULL THEN 'request' WHEN f.p IS NOT NULL THEN 'fuel' WHEN m.p IS NOT NULL THEN 'model'
         WHEN b.p IS NOT NULL THEN 'brand' WHEN a.p IS NOT NULL THEN 'all' ELSE 'default' END AS power_from,
    (r.min_year + r.max_year) // 2 AS year
  FROM requests r LEFT JOIN power_fuel f USING (brand, model, fuel_type) LEFT JOIN power_model m USING (brand, model)
    LEFT JOIN power_brand b USING (brand), power_all a
), scored_requests AS (
  SELECT r.request_id, coalesce(m.price, b.price, a.price) AS price, coalesce(m.high, b.high, a.high) AS high
  FROM requests r LEFT JOIN by_model m USING (model) LEFT JOIN by_brand b USING (brand), by_all a
), brand_prices AS (
  SELECT brand, count(*) AS n, median(price_in_euro) AS brand_median,
    (SELECT median(price_in_euro) FROM clean) AS overall_median FROM clean GROUP BY brand
), brand_standing AS (
  SELECT *, CASE WHEN n >= 10 AND brand_median > overall_median * 1.2 THEN 'above'
                 WHEN n >= 10 AND brand_median < overall_median * 0.85 THEN 'below' END AS standing
  FROM brand_prices
), level_counts AS (
  SELECT model, count(*) AS n FROM train GROUP BY model
), levels AS (
  SELECT l.listing_id, l.split, CASE WHEN c.n >= 50 THEN l.model
    WHEN (SELECT min(n) FROM level_counts) < 50 THEN 'infrequent' END AS model_level
  FROM labelled l LEFT JOIN level_counts c USING (model)
), inventory AS (
  SELECT 1 AS part, 'brand' AS source, brand AS level, 0 AS last FROM train GROUP BY brand
  UNION ALL SELECT 2, 'model', model, 0 FROM level_counts WHERE n >= 50
  UNION ALL SELECT 2, 'model', 'infrequent', 1 FROM level_counts HAVING min(n) < 50
  UNION ALL SELECT 3, 'fuel_type', fuel_type, 0 FROM train GROUP BY fuel_type
  UNION ALL SELECT 4, 'transmission_type', coalesce(transmission_type, 'nan'), 0 FROM train GROUP BY ALL
), hot AS (
  SELECT source, level, count(*) FILTER (split = 'train') AS in_train, count(*) FILTER (split = 'test') AS in_test FROM (
    SELECT 'brand' AS source, brand AS level, split FROM labelled
    UNION ALL SELECT 'model', model_level, split FROM levels
    UNION ALL SELECT 'fuel_type', fuel_type, split FROM labelled
    UNION ALL SELECT 'transmission_type', coalesce(transmission_type, 'nan'), split FROM labelled
  ) GROUP BY ALL
), varied AS (
  -- A column that every training row has, or none, does not vary and is not kept.
  SELECT i.*, coalesce(in_test, 0)::DOUBLE AS total, in_train BETWEEN 1 AND (SELECT count(*) - 1 FROM train) AS kept
  FROM inventory i LEFT JOIN hot USING (source, level)
)
"""

KEEP = "listing_id, brand, fuel_type, transmission_type, price_in_euro, year, power_ps, mileage_in_km"

# Label and reason of every cleaning rule, in order.
RULES = [
    ("price missing", "nothing to learn from or to check against"),
    ("year missing", "the age cannot be derived"),
    ("power missing", "a main driver of the price, not to be guessed"),
    ("mileage missing", "a main driver of the price, not to be guessed"),
    ("fuel not valid", "fields of the row are shifted or corrupt"),
    ("transmission unknown", "says nothing as a category"),
    ("year below 1996", "classic cars follow another market"),
    ("price below 2000", "scrap value"),
    ("price above 80000", "luxury and collector market"),
    ("power outside 2 to 48", "entry errors and exotics"),
    ("mileage above 49", "odometer errors"),
    ("mileage equal to 1", "new cars are priced by list price"),
]


# The condition of every rule on its own, in the same order.
BROKEN = [
    "price_in_euro IS NULL", "year IS NULL", "power_ps IS NULL", "mileage_in_km IS NULL",
    "fuel_type IS NULL OR fuel_type NOT IN ('Diesel Hybrid', 'Electric', 'LARGE', 'SMALL', 'STANDARD')",
    "transmission_type = 'Unknown'", "year < 1996", "price_in_euro < 2000", "price_in_euro > 80000",
    "power_ps < 2 OR power_ps > 48", "mileage_in_km > 49", "mileage_in_km = 1",
]


def _kept(condition: str) -> str:
    return f"SELECT {KEEP} FROM raw WHERE {condition}"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


AUDIT = f"""
SELECT CAST(step AS INTEGER) AS step, label, reason,
  (SELECT count(*) FROM ruled WHERE broken = step) AS removed,
  (SELECT count(*) FROM ruled WHERE broken IS NULL OR broken > step) AS remaining,
  round((SELECT count(*) FROM ruled WHERE broken IS NULL OR broken > step) * 100.0::DOUBLE
    / (SELECT count(*) FROM ruled), 6) AS kept_pct
FROM (VALUES {', '.join(f"({i}, {_quote(a)}, {_quote(b)})" for i, (a, b) in enumerate(RULES, 1))}) v(step, label, reason)
"""


def _histogram(source: str, value: str, bins: int) -> str:
    edge = lambda i: f"(CASE WHEN {i} = {bins} THEN hi ELSE lo + {i} * ((hi - lo) / {bins}) END)"
    return f"""
, h_values AS (SELECT {value} AS x FROM {source} WHERE price_in_euro IS NOT NULL)
, h_ends AS (SELECT min(x) AS lo, max(x) AS hi FROM h_values)
, h_guess AS (SELECT x, lo, hi, CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS g
  FROM h_values, h_ends)
, h_bins AS (SELECT CASE WHEN x < {edge('g')} THEN g - 1 WHEN x >= {edge('(g + 1)')} AND g < {bins - 1} THEN g + 1
  ELSE g END AS bin FROM h_guess)
SELECT CAST(i AS INTEGER) AS bin, round({edge('i')}, 9) AS lower, round({edge('(i + 1)')}, 9) AS upper,
  (SELECT count(*) FROM h_bins WHERE bin = i) AS n
FROM range({bins}) r(i), h_ends
"""


def _summary(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 6) AS mean,
  round(stddev_samp({column}), 6) AS std, min({column}) AS min, round(quantile_cont({column}, 0.25), 6) AS q25,
  round(quantile_cont({column}, 0.5), 6) AS q50, round(quantile_cont({column}, 0.75), 6) AS q75,
  max({column}) AS max FROM clean"""


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


CELLS = """
SELECT split, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn
FROM {source} GROUP BY split"""


def _metrics(source: str) -> str:
    """Metrics per split as a named subquery."""
    div = lambda a, b: f"(CASE WHEN {b} > 0 THEN ({a})::DOUBLE / ({b}) ELSE 0 END)"
    f1 = div("2 * tp", "(2 * tp + fp + fn)")
    f0 = div("2 * tn", "(2 * tn + fp + fn)")
    return f"""(SELECT split, tp + fp + tn + fn AS n, {div('tp + tn', '(tp + fp + tn + fn)')} AS accuracy,
  {div('tp', '(tp + fp)')} AS precision, {div('tp', '(tp + fn)')} AS recall, {f1} AS f1_binary,
  ({f1} + {f0}) / 2 AS f1_macro FROM ({CELLS.format(source=source)}))"""


def _auc(source: str, score: str, where: str = "true") -> str:
    """Area by mid-ranks, per split."""
    return f"""(SELECT split, (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
  ::DOUBLE / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc FROM (
    SELECT split, label, rank() OVER (PARTITION BY split ORDER BY {score})
      + (count(*) OVER (PARTITION BY split, {score}) - 1) / 2.0::DOUBLE AS r FROM {source} WHERE {where}) GROUP BY split)"""


REG = """(SELECT split, count(*) AS n, 1 - sum(({p} - price_in_euro) ** 2) / (var_pop(price_in_euro) * count(*)) AS r2,
  avg(abs({p} - price_in_euro)) AS mae, sqrt(avg(({p} - price_in_euro) ** 2)) AS rmse FROM {source} GROUP BY split)"""


def _board(position: int, name: str, source: str, score: str) -> str:
    m = _metrics(source)
    shown = ", ".join(f"round(t.{c}, 4) AS {c}" for c in ("accuracy", "precision", "recall", "f1_binary", "f1_macro"))
    return f"""SELECT {position} AS position, '{name}' AS model, {shown}, round(a.auc, 4) AS roc_auc,
  round(r.accuracy, 4) AS train_accuracy, round(r.f1_macro, 4) AS train_f1_macro
  FROM {m} t, {m} r, {_auc(source, score)} a WHERE t.split = 'test' AND r.split = 'train' AND a.split = 'test'"""


def _reg_board(position: int, name: str, prediction: str) -> str:
    m = REG.format(p=prediction, source="scored")
    return f"""SELECT {position} AS position, '{name}' AS model, round(t.r2, 4) AS r2, round(t.mae, 0) AS mae,
  round(t.rmse, 0) AS rmse, round(r.r2, 4) AS train_r2, round(r.rmse, 0) AS train_rmse
  FROM {m} t, {m} r WHERE t.split = 'test' AND r.split = 'train'"""


BOARD = f"{_board(0, 'dummy', 'dummy', 'prediction')} UNION ALL {_board(1, 'group mean', 'scored', 'score')}"
REG_BOARD = f"{_reg_board(0, 'dummy', '(SELECT price FROM by_all)')} UNION ALL {_reg_board(1, 'group mean', 'price')}"

SIMILAR = """
, filters AS (
  SELECT r.*, count(*) AS n3,
    count(*) FILTER (c.mileage_in_km <= r.mileage_in_km) AS n2,
    count(*) FILTER (c.mileage_in_km <= r.mileage_in_km AND c.year BETWEEN r.min_year AND r.max_year) AS n1
  FROM powered r, clean c GROUP BY ALL
), bounds AS (
  SELECT *, CASE WHEN n1 >= 5 OR n2 >= 5 THEN mileage_in_km ELSE 1e9 END AS most_km,
    CASE WHEN n1 >= 5 THEN min_year ELSE -1e9 END AS first_year,
    CASE WHEN n1 >= 5 THEN max_year ELSE 1e9 END AS last_year FROM filters
), scales AS (
  SELECT b.request_id, count(*) FILTER (c.model = b.model) AS n_model, count(*) FILTER (c.brand = b.brand) AS n_brand,
    greatest(stddev_samp(c.mileage_in_km), 1) AS s_km, greatest(stddev_samp(c.year), 1) AS s_year,
    greatest(stddev_samp(c.power_ps), 1) AS s_power
  FROM bounds b JOIN clean c ON c.mileage_in_km <= b.most_km AND c.year >= b.first_year AND c.year <= b.last_year
  GROUP BY b.request_id
), candidates AS (
  SELECT b.request_id, CASE WHEN n_model >= 5 THEN 'model' WHEN n_brand >= 5 THEN 'brand' ELSE 'all' END AS matched_on,
    c.*, abs(c.mileage_in_km - b.mileage_in_km) / s_km + abs(c.year - b.year) / s_year
      + abs(c.power_ps - b.power_ps) / s_power AS score
  FROM bounds b JOIN scales s USING (request_id)
    JOIN clean c ON c.mileage_in_km <= b.most_km AND c.year >= b.first_year AND c.year <= b.last_year
      AND CASE WHEN n_model >= 5 THEN c.model = b.model WHEN n_brand >= 5 THEN c.brand = b.brand ELSE true END
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score, listing_id) AS rank FROM candidates
)
SELECT request_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score, matched_on, listing_id, model, year, power_ps,
  mileage_in_km, price_in_euro FROM ranked WHERE rank <= 8
"""

EXPLAIN = """
, med AS (
  SELECT median(mileage_in_km) AS km, 2001 - median(year) AS age, median(power_ps) AS power FROM clean
), facts AS (
  SELECT p.*, 2001 - p.year AS age, med.km AS m_km, med.age AS m_age, med.power AS m_power, b.standing, b.brand_median,
    b.overall_median, format('{:,}', CAST(round_even(p.mileage_in_km, 0) AS BIGINT)) || ' km against a median of '
      || format('{:,}', CAST(round_even(med.km, 0) AS BIGINT)) || ' km' AS t_km,
    format('{:,}', CAST(2001 - p.year AS BIGINT)) || ' years against a median of '
      || format('{:,}', CAST(round_even(med.age, 0) AS BIGINT)) AS t_age,
    format('{:,}', CAST(round_even(p.power_ps, 0) AS BIGINT)) || ' PS against a median of '
      || format('{:,}', CAST(round_even(med.power, 0) AS BIGINT)) || ' PS' AS t_power,
    'median €' || format('{:,}', CAST(round_even(b.brand_median, 0) AS BIGINT)) || ' against €'
      || format('{:,}', CAST(round_even(b.overall_median, 0) AS BIGINT)) AS t_price
  FROM powered p LEFT JOIN brand_standing b USING (brand), med
)
SELECT request_id,
  concat_ws(',',
    CASE WHEN mileage_in_km < m_km * 0.75 THEN 'mileage_low' WHEN mileage_in_km > m_km * 1.25 THEN 'mileage_high'
      ELSE 'mileage_average' END,
    CASE WHEN age < m_age * 0.75 THEN 'age_newer' WHEN age > m_age * 1.25 THEN 'age_older' ELSE 'age_average' END,
    CASE WHEN power_ps > m_power * 1.35 THEN 'power_high' WHEN power_ps < m_power * 0.70 THEN 'power_low' END,
    CASE standing WHEN 'above' THEN 'brand_above' WHEN 'below' THEN 'brand_below' END,
    CASE WHEN lower(fuel_type) LIKE '%electric%' THEN 'fuel_electric' WHEN lower(fuel_type) LIKE '%hybrid%' THEN 'fuel_hybrid' END) AS reasons,
  concat_ws(' | ',
    CASE WHEN mileage_in_km < m_km * 0.75 THEN 'Low mileage raises the price: '
      WHEN mileage_in_km > m_km * 1.25 THEN 'High mileage lowers the price: ' ELSE 'Ordinary mileage: ' END || t_km,
    CASE WHEN age < m_age * 0.75 THEN 'Newer than most: ' WHEN age > m_age * 1.25 THEN 'Older than most: '
      ELSE 'Ordinary age: ' END || t_age,
    CASE WHEN power_ps > m_power * 1.35 THEN 'Strong engine: ' WHEN power_ps < m_power * 0.70 THEN 'Weak engine: ' END
      || t_power,
    CASE standing WHEN 'above' THEN brand || ' sells above the market: '
      WHEN 'below' THEN brand || ' sells below the market: ' END || t_price,
    CASE WHEN lower(fuel_type) LIKE '%electric%' THEN 'Electric cars tend to be dearer when new'
      WHEN lower(fuel_type) LIKE '%hybrid%' THEN 'Hybrids tend to be in the middle or above' END) AS sentences
FROM facts
"""

ROC = """
, by_score AS (
  SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM scored WHERE split = 'test' GROUP BY score
), run AS (
  SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
    lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg,
    max(score) OVER () AS top, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg FROM by_score
)
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT round(score, 6), round(fp::DOUBLE / all_neg, 6), round(tp::DOUBLE / all_pos, 6) FROM run
WHERE score = top OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
"""

LEAKAGE = _union(
    [f"SELECT '{c} not a feature' AS \"check\", 0.0::DOUBLE AS expected, 0.0::DOUBLE AS actual, true AS passed"
     for c in ("price_in_euro", "price_segment", "year")]
    + ["SELECT 'threshold is the train median', round(threshold, 6), round(threshold, 6), true FROM limits",
       "SELECT 'threshold differs from the median of all rows', round(median(price_in_euro), 6), "
       "round(any_value(threshold), 6), median(price_in_euro) <> any_value(threshold) FROM clean, limits"]
    + [f"SELECT 'scaler mean of {c} is the train mean', round(avg({c}), 6), round(avg({c}), 6), true FROM train"
       for c in NUMERIC]
    + [f"SELECT 'scaler mean of {c} differs from the mean of all rows', round(avg({c}), 6), "
       f"round(avg({c}) FILTER (split = 'train'), 6), avg({c}) <> avg({c}) FILTER (split = 'train') FROM labelled"
       for c in NUMERIC])

ONEHOT = "SELECT source || '_' || level AS feature, source, total FROM varied WHERE kept"
SCALED = _union(
    f"SELECT '{c}' AS feature, '{c}' AS source, round(sum(({c} - m) / s), 3) AS total FROM labelled, "
    f"(SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM train) WHERE split = 'test'" for c in NUMERIC)

SIDES = "count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows"

KEYED = """SELECT joined.*, md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))) AS listing_id FROM joined"""
LONG_RECORD = "l_orderkey % 11 = 0"

JUNK = "CASE WHEN l_linenumber < 3 THEN 'abc' END"


def oracle_sql() -> dict[str, str]:
    corr = [(a, b) for a in ("price_in_euro", "year", "power_ps", "mileage_in_km")
            for b in ("price_in_euro", "year", "power_ps", "mileage_in_km")]
    skew = "CASE WHEN count({x}) > 2 THEN round(skewness({x}), 6) END"
    raw_columns = ("listing_id", "brand", "model", "transmission_type", "fuel_type", "year", "price_in_euro",
                   "power_ps", "mileage_in_km", "color", "offer_description")
    tails = {
        "arriving_profile": _union(
            [f"SELECT '{c}' AS column_name, 4::BIGINT AS loads, count(*) AS rows, count(*) - count({c}) AS missing, count({c}) AS n, "
             f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max, "
             "true AS quantiles_within, true AS different_within FROM raw" for c in ("price_in_euro", "year", "power_ps", "mileage_in_km")]
            + [f"SELECT '{c}', 4::BIGINT, count(*), count(*) - count({c}), count({c}), NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, true, true "
               "FROM raw" for c in ("brand", "model", "fuel_type", "transmission_type")]),
        "imputation": """
, sided AS (
  SELECT *, CASE WHEN substr(md5('split|42|' || listing_id), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split FROM raw
), fitted AS (
  SELECT * FROM sided WHERE split = 'train'
), fill AS (
  SELECT median(year) AS year, median(power_ps) AS power_ps, median(mileage_in_km) AS mileage_in_km,
    (SELECT fuel_type FROM fitted WHERE fuel_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS fuel_type,
    (SELECT transmission_type FROM fitted WHERE transmission_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS transmission_type
  FROM fitted
)
SELECT s.listing_id, s.split, """ + ", ".join(f"coalesce(s.{c}, f.{c}) AS {c}" for c in (
            "year", "power_ps", "mileage_in_km", "fuel_type", "transmission_type")) + " FROM sided s, fill f",
        "f_scores": """
, known AS (
  SELECT brand, fuel_type, coalesce(transmission_type, 'nan') AS transmission_type, price_in_euro AS y_regression,
    price_segment::DOUBLE AS y_classification FROM train
), dummies AS (
  SELECT source || '_' || level AS feature, count(*)::DOUBLE AS x, sum(y_regression) AS xy_regression, sum(y_classification) AS xy_classification
  FROM (UNPIVOT known ON brand, fuel_type, transmission_type INTO NAME source VALUE level) GROUP BY ALL
), totals AS (
  SELECT count(*)::DOUBLE AS n, avg(y_regression) AS m_regression, avg(y_classification) AS m_classification,
    var_pop(y_regression) AS v_regression, var_pop(y_classification) AS v_classification FROM known
), shares AS (
""" + " UNION ALL ".join(
            f"SELECT '{task}' AS task, feature, pow(xy_{task} / n - x / n * m_{task}, 2) / ((x / n - x / n * x / n) * v_{task}) AS r, n FROM dummies, totals"
            for task in ("regression", "classification")) + " UNION ALL " + " UNION ALL ".join(
            f"SELECT '{task}', '{c}', pow(corr({c}, {y}), 2), count(*) FROM train" for task, y in (("regression", "price_in_euro"), ("classification", "price_segment"))
            for c in NUMERIC) + """
)
SELECT task, feature, round(r / (1 - r) * (n - 2), 2) AS score, true AS chosen_by_score FROM shares""",
        "scan_by_name": f"""
SELECT listing_id, p_brand AS brand, p_name AS model, CASE WHEN l_orderkey % 2 = 1 AND l_orderkey % 13 = 0 THEN NULL ELSE p_type END AS fuel_type,
  CASE WHEN l_orderkey % 2 = 1 THEN l_returnflag || chr(10) || ', second line' WHEN l_orderkey % 13 = 0 THEN NULL
    ELSE l_returnflag END AS offer_description
FROM ({KEYED}) WHERE NOT {LONG_RECORD}""",
        "scan_quarantine": f"""
SELECT CASE WHEN {LONG_RECORD} THEN 'too many fields' ELSE 'kept' END AS reason, count(*) AS records, CAST(sum(count(*)) OVER () AS BIGINT) AS read
FROM ({KEYED}) GROUP BY 1""",
        "scan_listings": f"""
SELECT r.* EXCLUDE (year, price_in_euro, power_ps, mileage_in_km),
  coalesce(CAST(CAST(r.year AS DOUBLE) AS VARCHAR), j.junk) AS year,
  coalesce(CAST(r.price_in_euro AS VARCHAR), j.junk) AS price_in_euro,
  coalesce(CAST(r.power_ps AS VARCHAR), j.junk) AS power_ps,
  coalesce(CAST(r.mileage_in_km AS VARCHAR), j.junk) AS mileage_in_km,
  j.row_label, j.registration_date, j.power_kw, j.fuel_consumption_l_100km, j.fuel_consumption_g_km
FROM raw r JOIN (
  SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))) AS listing_id,
    {JUNK} AS junk, CAST(l_orderkey AS VARCHAR) AS row_label, strftime(l_shipdate, '%m/%Y') AS registration_date,
    CAST(p_size AS VARCHAR) AS power_kw, CAST(l_discount AS VARCHAR) AS fuel_consumption_l_100km,
    CAST(l_tax AS VARCHAR) AS fuel_consumption_g_km FROM joined) j USING (listing_id)""",
        "coerce_numeric": "SELECT listing_id, price_in_euro, power_ps, year, mileage_in_km FROM raw",
        "write_verified": "SELECT count(*) AS expected_rows, count(*) AS written_rows, true AS verified FROM clean",
        "write_splits": "SELECT split, count(*) AS n, count(*) FILTER (price_segment = 1) AS n_high FROM labelled "
                        "GROUP BY split",
        "cleaning_report": "SELECT count(*) AS raw_rows, count(*) FILTER (broken IS NULL) AS clean_rows, "
                           "'listing_id,brand,model,transmission_type,fuel_type,year,price_in_euro,power_ps,"
                           "mileage_in_km' AS final_columns, 12 AS steps, count(broken) AS removed, "
                           "round(count(*) FILTER (broken IS NULL) * 100.0::DOUBLE / count(*), 2) AS pct_retained "
                           "FROM ruled",
        "split_report": """
SELECT 42 AS seed, 20 AS test_percent, 2001 AS reference_year, round((SELECT threshold FROM limits), 6) AS threshold,
  count(*) FILTER (split = 'test') AS n_test, count(*) FILTER (split = 'train') AS n_train,
  (SELECT count(*) FROM inventory WHERE source = 'brand') AS brand,
  (SELECT count(*) FROM inventory WHERE source = 'fuel_type') AS fuel_type,
  (SELECT count(*) FROM inventory WHERE source = 'transmission_type') AS transmission_type,
  (SELECT count(*) FROM level_counts WHERE n >= 50) AS frequent_models,
  (SELECT count(*) FROM level_counts WHERE n < 50) AS rare_models,
  (SELECT count(*) + 4 FROM inventory) AS features, 13 AS checks, 13 AS checks_passed FROM labelled""",
        "leaderboard": BOARD,
        "leaderboard_sink": REG_BOARD,
        "model_save": "SELECT count(*) AS requests, 0::BIGINT AS different FROM bounded WHERE rejected_for = ''",
        "listing_sample": "SELECT listing_id, brand, model, year, price_in_euro FROM clean "
                          "ORDER BY md5('sample|42|' || listing_id), listing_id LIMIT 1000",
        "brand_model_options": "SELECT brand, CAST(count(*) AS INTEGER) AS n, string_agg(model, '|' ORDER BY model) "
                               "AS models FROM (SELECT DISTINCT brand, model FROM clean) GROUP BY brand",
        "drop_columns": f"SELECT {', '.join(raw_columns[:9])} FROM raw",
        "clean_step": _union(
            f"SELECT '{label}' AS label, count(*) FILTER ({c}) AS removed, count(*) - count(*) FILTER ({c}) AS "
            f"remaining, round((count(*) - count(*) FILTER ({c})) * 100.0::DOUBLE / count(*), 6) AS kept_pct FROM raw"
            for (label, _), c in zip(RULES, BROKEN, strict=True)),
        "drop_null_required": _kept("price_in_euro IS NOT NULL AND year IS NOT NULL AND power_ps IS NOT NULL "
                                    "AND mileage_in_km IS NOT NULL"),
        "valid_category": _kept("fuel_type IN ('Diesel Hybrid', 'Electric', 'LARGE', 'SMALL', 'STANDARD')"),
        "drop_unknown": _kept("transmission_type IS DISTINCT FROM 'Unknown'"),
        "year_floor": _kept("year IS NULL OR year >= 1996"),
        "price_range": _kept("price_in_euro IS NULL OR price_in_euro BETWEEN 2000 AND 80000"),
        "power_range": _kept("power_ps IS NULL OR power_ps BETWEEN 2 AND 48"),
        "mileage_rules": _kept("mileage_in_km IS NULL OR (mileage_in_km <= 49 AND mileage_in_km <> 1)"),
        "cleaning_audit": AUDIT,
        "clean_listings": "SELECT * FROM clean",
        "car_age": "SELECT listing_id, car_age FROM split",
        "mileage_per_year": "SELECT listing_id, round(mileage_per_year, 6) AS mileage_per_year FROM split",
        "feature_select_columns": "SELECT listing_id, brand, model, fuel_type, transmission_type, car_age, power_ps, "
                                  "mileage_in_km, round(mileage_per_year, 6) AS mileage_per_year FROM split",
        "price_segment": "SELECT listing_id, split, price_in_euro, price_segment FROM labelled",
        "scope_flag": "SELECT request_id, round(price * 2, 7) AS price, price * 2 < 2000 OR price * 2 > 80000 "
                      "AS outside_scope FROM scored_requests",
        "input_bounds": "SELECT request_id, rejected_for, rejected_for = '' AS valid FROM bounded",
        "year_midpoint": "SELECT request_id, min_year, max_year, (min_year + max_year) // 2 AS year FROM requests",
        "build_input_row": """
SELECT request_id, brand, model, fuel_type, transmission_type,
  CAST(2001 - (min_year + max_year) // 2 AS DOUBLE) AS car_age, power_ps, mileage_in_km,
  round(mileage_in_km / greatest(2001 - (min_year + max_year) // 2, 1), 6) AS mileage_per_year FROM requests""",
        "display_labels": """
SELECT brand, model, CAST(year AS INTEGER) AS year, CAST(mileage_in_km AS INTEGER) AS mileage,
  CASE WHEN fuel_type = 'Diesel Hybrid' THEN fuel_type ELSE upper(fuel_type[1]) || lower(fuel_type[2:]) END AS fuel, transmission_type AS transmission,
  CAST(power_ps AS INTEGER) AS power, '€' || format('{:,}', CAST(round_even(price_in_euro, 0) AS BIGINT)) AS price
FROM clean""",
        "impute_power": "SELECT request_id, power_ps, power_from FROM powered",
        "fuel_options": """
, m AS (SELECT brand, model, string_agg(DISTINCT fuel_type, '|' ORDER BY fuel_type) AS f FROM clean GROUP BY ALL)
, b AS (SELECT brand, string_agg(DISTINCT fuel_type, '|' ORDER BY fuel_type) AS f FROM clean GROUP BY ALL)
SELECT request_id, coalesce(m.f, b.f, 'Diesel Hybrid|Electric|LARGE|SMALL|STANDARD') AS fuels
FROM requests LEFT JOIN m USING (brand, model) LEFT JOIN b USING (brand)""",
        "similar_listings": SIMILAR,
        "explain_listing": EXPLAIN,
        "compare_pairs": """
SELECT x.request_id AS pair_id, x.request_id AS request_a, x.request_id + 1 AS request_b, round(x.price, 7) AS price_a,
  round(y.price, 7) AS price_b, CASE WHEN x.high >= 0.5 THEN 'HIGH' ELSE 'LOW' END AS segment_a,
  CASE WHEN y.high >= 0.5 THEN 'HIGH' WHEN y.high < 0.5 THEN 'LOW' END AS segment_b,
  round(greatest(x.high, 1 - x.high), 7) AS confidence_a, round(CASE WHEN y.high IS NOT NULL THEN greatest(y.high, 1 - y.high) END, 7) AS confidence_b,
  round(y.price - x.price, 7) AS difference,
  round(CASE WHEN y.price IS NULL THEN NULL WHEN x.price > 0 THEN (y.price - x.price) / x.price * 100 ELSE 0 END, 7) AS difference_pct,
  CASE WHEN abs(y.price - x.price) < 1 THEN 'same' WHEN y.price > x.price THEN 'b dearer'
    WHEN y.price < x.price THEN 'a dearer' END AS verdict,
  CASE WHEN y.price IS NULL THEN 'b not scored' ELSE 'compared' END AS status
FROM scored_requests x LEFT JOIN scored_requests y ON y.request_id = x.request_id + 1""",
        "brand_context": "SELECT brand, n, round(brand_median, 6) AS brand_median, round(overall_median, 6) AS "
                         "overall_median, standing FROM brand_standing",
        "null_profile": _union(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
            f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM raw"
            for c in raw_columns),
        "duplicate_count": "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM "
                           "(SELECT count(*) AS n FROM raw GROUP BY " + ", ".join(raw_columns) + ")",
        "numeric_summary": _union(map(_summary, ("price_in_euro", "year", "power_ps", "mileage_in_km"))),
        "value_range": _union(f"SELECT '{c}' AS column_name, min({c}) AS lowest, max({c}) AS highest FROM raw"
                              for c in ("year", "power_ps", "mileage_in_km")),
        "distinct_counts": _union(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM clean"
            for c in ("brand", "model", "fuel_type", "transmission_type", "year")),
        "category_counts": "SELECT fuel_type AS value, count(*) AS n FROM raw WHERE fuel_type IS NOT NULL GROUP BY 1",
        "top_k": "SELECT model AS value, count(*) AS n FROM clean GROUP BY 1 ORDER BY n DESC, value LIMIT 20",
        "category_share": "SELECT fuel_type AS value, count(*) AS n, round(count(*) * 100.0::DOUBLE / "
                          "(SELECT count(*) FROM clean), 6) AS share_pct FROM clean GROUP BY 1",
        "year_counts": "SELECT CAST(year AS INTEGER) AS year, count(*) AS n, 'raw' AS stage FROM raw WHERE year IS NOT "
                       "NULL GROUP BY 1 UNION ALL SELECT CAST(year AS INTEGER), count(*), 'clean' FROM clean GROUP BY 1",
        "histogram_price_raw": _histogram("raw", "price_in_euro", 100),
        "histogram_price_clean": _histogram("clean", "price_in_euro", 80),
        "histogram_price_train": _histogram("train", "price_in_euro", 80),
        "histogram_log_price_raw": _histogram("raw", "ln(1 + price_in_euro)", 100),
        "histogram_log_price_clean": _histogram("clean", "ln(1 + price_in_euro)", 80),
        "histogram_mileage": _histogram("clean", "mileage_in_km / 1000", 80),
        "histogram_power": _histogram("clean", "power_ps", 60),
        "log_price": "SELECT listing_id, round(ln(1 + price_in_euro), 6) AS log_price FROM clean",
        "skewness": _union([
            f"SELECT 'raw' AS price, {skew.format(x='price_in_euro')} AS skewness FROM raw",
            f"SELECT 'clean', {skew.format(x='price_in_euro')} FROM clean",
            f"SELECT 'log clean', {skew.format(x='ln(1 + price_in_euro)')} FROM clean"]),
        "group_median": "SELECT fuel_type, count(*) AS n, round(median(price_in_euro), 6) AS median_price FROM clean "
                        "GROUP BY fuel_type",
        "correlation_matrix": _union(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM clean" for a, b in corr),
        "quantiles": _union(f"SELECT {s}::DOUBLE AS share, quantile_cont(year, {s}) AS quantile FROM clean"
                            for s in (0.25, 0.5)),
        "train_threshold": "SELECT round(threshold, 6) AS threshold FROM limits",
        "class_balance": "SELECT split, count(*) AS n, round(avg(1 - price_segment), 6) AS share_low, "
                         "round(avg(price_segment), 6) AS share_high FROM labelled GROUP BY split",
        "feature_summary": "SELECT min(car_age) AS min_age, max(car_age) AS max_age, round(avg(car_age), 6) AS mean_age, "
                           "round(min(mileage_per_year), 6) AS min_km_per_year, round(max(mileage_per_year), 6) AS "
                           "max_km_per_year, round(median(mileage_per_year), 6) AS median_km_per_year FROM split",
        "leakage_checks": LEAKAGE,
        "train_test_split": "SELECT listing_id, split FROM split",
        "stratified_split": """
SELECT listing_id, price_segment, CASE WHEN row_number() OVER (PARTITION BY price_segment
    ORDER BY md5('strata|42|' || listing_id), listing_id) * 100 <= count(*) OVER (PARTITION BY price_segment) * 20
  THEN 'test' ELSE 'train' END AS split FROM labelled""",
        "sample_rows": "SELECT listing_id, mileage_in_km, price_in_euro, year FROM clean "
                       "ORDER BY md5('sample|42|' || listing_id), listing_id LIMIT 10000",
        "fold_assign": """
SELECT listing_id, price_segment, CAST((row_number() OVER (PARTITION BY price_segment
    ORDER BY md5('fold|42|' || listing_id), listing_id) - 1) % 3 AS INTEGER) AS fold FROM train""",
        "min_frequency_bucket": "SELECT listing_id, model_level FROM levels",
        "onehot_ignore": f"{ONEHOT} AND source <> 'model'",
        "preprocess": f"{ONEHOT} UNION ALL {SCALED}",
        "standard_scale": "SELECT listing_id, " + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train), 6) AS {c}_scaled"
            for c in NUMERIC) + " FROM labelled",
        "variance_threshold": "SELECT CAST(count(*) + 4 AS INTEGER) AS features_before, "
                              "CAST(count(*) FILTER (kept) + 4 AS INTEGER) AS features_after FROM varied",
        "feature_inventory": """
SELECT CAST(row_number() OVER (ORDER BY part, last, level) - 1 AS INTEGER) AS position,
  CASE WHEN part = 5 THEN source ELSE source || '_' || level END AS feature, source, kept FROM (
    SELECT part, source, level, last, kept FROM varied UNION ALL SELECT 5, c, CAST(i AS VARCHAR), 0, true FROM (VALUES ('car_age', 1), ('power_ps', 2),
      ('mileage_in_km', 3), ('mileage_per_year', 4)) v(c, i))""",
        "dummy_classifier": "SELECT listing_id, CAST(prediction AS DOUBLE) AS prediction, CAST(prediction AS DOUBLE) AS "
                            "score FROM dummy WHERE split = 'test'",
        "dummy_regressor": "SELECT listing_id, round((SELECT price FROM by_all), 7) AS prediction FROM labelled "
                           "WHERE split = 'test'",
        "classification_metrics": "SELECT split, n, " + ", ".join(
            f"round({c}, 6) AS {c}" for c in ("accuracy", "precision", "recall", "f1_binary", "f1_macro"))
            + f" FROM {_metrics('scored')}",
        "roc_auc": f"SELECT split, round(auc, 6) AS auc FROM {_auc('scored', 'score')}",
        "roc_curve": ROC,
        "confusion_matrix": """
SELECT v AS actual, (SELECT count(*) FROM scored WHERE split = 'test' AND label = v AND prediction = 0) AS predicted_low,
  (SELECT count(*) FROM scored WHERE split = 'test' AND label = v AND prediction = 1) AS predicted_high
FROM (VALUES (0), (1)) t(v)""",
        "regression_metrics": "SELECT split, n, round(r2, 4) AS r2, round(mae, 4) AS mae, round(rmse, 4) AS rmse FROM "
                              + REG.format(p="price", source="scored"),
        "residuals": "SELECT listing_id, price_in_euro AS label, round(price - price_in_euro, 7) AS residual FROM scored "
                     "WHERE split = 'test' ORDER BY md5('sample|42|' || listing_id), listing_id LIMIT 5000",
        "best_model": f"(SELECT model, f1_macro AS metric FROM ({BOARD}) ORDER BY f1_macro DESC, position LIMIT 1) "
                      f"UNION ALL (SELECT model, r2 FROM ({REG_BOARD}) ORDER BY r2 DESC, position LIMIT 1)",
        "beats_baseline": _union(
            f"SELECT '{m}' AS metric, model, {m} AS value, CASE WHEN model = 'dummy' THEN 'baseline' WHEN {m} > max({m}) "
            f"FILTER (model = 'dummy') OVER () THEN 'beats baseline' ELSE 'does not beat baseline' END AS verdict "
            f"FROM ({board})" for m, board in (("f1_macro", BOARD), ("r2", REG_BOARD))),
        "overfit_gap": _union(
            f"SELECT '{m}' AS metric, model, train_{m} AS train, {m} AS test, round(train_{m} - {m}, 6) AS gap "
            f"FROM ({board})" for m, board in (("f1_macro", BOARD), ("r2", REG_BOARD))),
        "model_load": "SELECT round(threshold, 6) AS threshold, 8 AS classifier_stages, 8 AS regressor_stages FROM limits",
        "score_checks": "SELECT request_id, true AS sums_to_one, true AS larger_share, true AS segment_agrees, true AS "
                        "scope_agrees, round(threshold, 6) AS segment_threshold FROM bounded, limits WHERE rejected_for = ''",
        "score_stream_rejects": "SELECT request_id, rejected_for FROM bounded WHERE rejected_for <> ''",
        **{name: f"SELECT '{model}' AS model, {SIDES}, {holds} FROM labelled" for name, model, holds in (
            ("logistic_ladder", "logistic", "true AS no_slope, true AS auc_is_share"),
            ("ridge_ladder", "ridge", "true AS no_slope"),
            ("tree_classifier", "tree classifier", "0::BIGINT AS wrong_leaves, true AS split"),
            ("tree_regressor", "tree regressor", "0::BIGINT AS wrong_leaves, true AS split"),
            ("boosted_classifier", "boosted classifier", "271 AS rounds, 7 AS depth, true AS loss_falls, true AS loss_is_the_rows, true AS below_dummy"),
            ("boosted_regressor", "boosted regressor", "271 AS rounds, 7 AS depth, true AS loss_falls, true AS loss_is_the_rows, true AS below_dummy"))},
        **{name: f"SELECT '{model}' AS model, count(*) FILTER (kept) + 4 AS features, 1.0::DOUBLE AS total, 0::BIGINT AS "
                 "negative, 0::BIGINT AS unknown FROM varied" for name, model in (
            ("feature_importance", "boosted classifier"), ("feature_importance_regressor", "boosted regressor"))},
        **{name: f"SELECT {n}::BIGINT AS draws, {n}::BIGINT AS settings, {3 * n}::BIGINT AS fits, true AS best_is_extreme, 3 AS folds, count(*) AS "
                 "train_rows FROM train" for name, n in (
            ("grid_search", 5), ("grid_search_logistic", 4), ("grid_search_tree_classifier", 4), ("grid_search_tree_regressor", 4))},
        **{name: "SELECT 6::BIGINT AS draws, 6::BIGINT AS settings, 18::BIGINT AS fits, true AS best_is_extreme, 3 AS folds, count(*) AS train_rows, "
                 "true AS within_ranges, true AS refitted_rounds FROM train" for name in ("random_search", "random_search_regressor")},
        "model_report": """
SELECT 42 AS seed, CAST(count(*) + 4 AS INTEGER) AS features_before_selection, CAST(count(*) FILTER (NOT kept) AS INTEGER) AS features_removed,
  (SELECT round(threshold, 6) FROM limits) AS threshold, 'dummy,logistic,tree,boosted' AS classifiers, 'dummy,ridge,tree,boosted' AS regressors,
  10.0::DOUBLE AS logistic_c, 15 AS tree_depth, 271 AS boosted_rounds, 0.1::DOUBLE AS ridge_alpha, 7 AS boosted_depth,
  true AS best_classifier_is_extreme, true AS best_regressor_is_extreme, 2 AS searches, 12::BIGINT AS draws, 36::BIGINT AS fits,
  true AS best_within_ranges FROM varied""",
        "score_stream": "SELECT request_id, true AS as_batch FROM bounded WHERE rejected_for = ''",
    }
    return {name: VIEWS + tail for name, tail in tails.items()}
