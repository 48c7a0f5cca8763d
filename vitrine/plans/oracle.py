"""Independent SQL (DuckDB dialect) for every query in the registry.

Written from the operator definitions, not from the Spark plans: cosine by
``list_dot_product`` over the full cross product, top-1 by ``QUALIFY``,
de-duplication by ``row_number``. Tables are the driver's views.
"""

from __future__ import annotations

WS = r"[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>"""

PRODUCTS = """
products AS (
  SELECT coalesce(e.vec_id, p.p_partkey) AS product_id,
         CASE WHEN p.p_partkey IS NOT NULL THEN concat_ws(' ', p.p_name, p.p_brand) END AS title,
         CASE WHEN isnan(p.p_retailprice) THEN NULL ELSE p.p_retailprice END AS price,
         '/p/' || CAST(p.p_partkey AS VARCHAR) AS url,
         CASE WHEN coalesce(e.vec_id, p.p_partkey) % 2 = 0 THEN 'A' ELSE 'B' END AS marketplace,
         p.p_type AS category, e.embedding, p.p_name AS name
  FROM embeddings e FULL JOIN part p ON p.p_partkey = e.vec_id),
src AS (SELECT * FROM products WHERE marketplace = 'A'),
tgt AS (SELECT * FROM products WHERE marketplace = 'B')"""


def _vectors(name: str, table: str) -> str:
    return f"""
{name} AS (
  SELECT product_id, CAST(embedding AS DOUBLE[]) AS v,
         sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS nrm
  FROM {table} WHERE embedding IS NOT NULL)"""


def _scores(name: str, s: str, t: str) -> str:
    return f"""
{name} AS (
  SELECT a.product_id AS source_id, b.product_id AS target_id,
         CASE WHEN a.nrm = 0 OR b.nrm = 0 THEN 0.0::DOUBLE
              ELSE list_dot_product(a.v, b.v) / (a.nrm * b.nrm) END AS similarity
  FROM {s} a, {t} b)"""


BEST = ",".join([
    _vectors("sv", "src"), _vectors("tv", "tgt"), _scores("scores", "sv", "tv"),
    """
best AS (SELECT * FROM scores
         QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY round(similarity, 12) DESC, target_id) = 1)""",
])


def absolute(col: str, base: str) -> str:
    return f"CASE WHEN starts_with({col}, 'http') THEN {col} ELSE '{base}' || {col} END"


def h8(a: str, b: str) -> str:
    return f"CASE WHEN {a} <> 0 AND {b} <> 0 THEN abs({a} - {b}) / (({a} + {b}) / 2) * 100 END"


def level(sim: str, very: float = 0.45, moderate: float = 0.35) -> str:
    return (f"CASE WHEN {sim} IS NULL THEN NULL WHEN {sim} = -1 THEN 'exclusivo' "
            f"WHEN {sim} > {very} THEN 'muito similar' WHEN {sim} >= {moderate} THEN 'moderadamente similar' "
            f"ELSE 'pouco similar' END")


PAIRS = f"""
pairs AS (
  SELECT b.source_id AS pair_id, 0 AS side, s.product_id, s.title, 'A' AS marketplace, s.price,
         {absolute('s.url', 'https://a.example')} AS url, 'não' AS exclusivity, b.similarity,
         {h8('s.price', 't.price')} AS diff_pct, t.price AS partner_price
  FROM best b JOIN src s ON s.product_id = b.source_id JOIN tgt t ON t.product_id = b.target_id
  UNION ALL
  SELECT b.source_id, 1, t.product_id, t.title, 'B', t.price,
         {absolute('t.url', 'https://b.example')}, 'não', b.similarity, {h8('s.price', 't.price')}, s.price
  FROM best b JOIN src s ON s.product_id = b.source_id JOIN tgt t ON t.product_id = b.target_id),
excl AS (
  SELECT NULL::BIGINT AS pair_id, 2 AS side, t.product_id, t.title, 'B' AS marketplace, t.price,
         {absolute('t.url', 'https://b.example')} AS url, 'sim' AS exclusivity, -1.0::DOUBLE AS similarity,
         NULL::DOUBLE AS diff_pct, NULL::DOUBLE AS partner_price
  FROM tgt t WHERE t.embedding IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM best b WHERE b.target_id = t.product_id)),
allrows AS (SELECT * FROM pairs UNION ALL SELECT * FROM excl),
kept AS (SELECT * FROM allrows
         QUALIFY row_number() OVER (PARTITION BY title, marketplace
                                    ORDER BY price NULLS LAST, pair_id NULLS LAST, side, product_id) = 1),
bm AS (SELECT title, marketplace, price, url, exclusivity, similarity, {level('similarity')} AS similarity_level,
              diff_pct, pair_id, product_id, partner_price FROM kept)"""

K1 = """
k1 AS (
  SELECT s.product_id AS source_id, s.title AS source_title,
         CASE WHEN b.similarity >= 0.35 THEN b.target_id END AS target_id,
         CASE WHEN b.similarity >= 0.35 THEN t.title END AS target_title,
         coalesce(b.similarity, 0.0::DOUBLE) AS similarity,
         s.price AS source_price,
         CASE WHEN b.similarity >= 0.35 THEN t.price END AS target_price,
         CASE WHEN b.similarity >= 0.35 AND t.price IS NOT NULL AND t.price <> 0
              THEN (s.price - t.price) / t.price * 100 END AS diff_pct,
         s.url AS source_url,
         NOT coalesce(b.similarity >= 0.35, false) AS is_exclusive
  FROM src s LEFT JOIN best b ON b.source_id = s.product_id LEFT JOIN tgt t ON t.product_id = b.target_id)"""

PERCENT = "CASE WHEN diff_pct IS NULL THEN 'N/A' ELSE printf('%.2f', diff_pct) || '%' END"

K2 = f"""
k2 AS (
  SELECT source_id, 0 AS side, source_title AS title, 'B' AS marketplace, target_price AS price, '' AS url,
         'não' AS exclusivity, {PERCENT} AS diff_pct_text FROM k1 WHERE NOT is_exclusive
  UNION ALL
  SELECT source_id, 1, source_title, 'A', source_price, source_url, 'não', {PERCENT} FROM k1 WHERE NOT is_exclusive
  UNION ALL
  SELECT source_id, 1, source_title, 'A', source_price, source_url, 'sim', 'N/A' FROM k1 WHERE is_exclusive)"""

PAIR_TABLE = f"""
pt0 AS (
  SELECT b.source_id AS pair_id, b.target_id, s.title AS source_title, t.title AS target_title,
         s.price AS source_price, t.price AS target_price, {absolute('s.url', 'https://a.example')} AS source_url,
         {absolute('t.url', 'https://b.example')} AS target_url, b.similarity, {h8('s.price', 't.price')} AS diff_pct,
         {level('b.similarity')} AS similarity_level
  FROM best b JOIN src s ON s.product_id = b.source_id JOIN tgt t ON t.product_id = b.target_id),
pt AS (
  SELECT *, CASE WHEN source_price IS NULL OR target_price IS NULL THEN NULL
                 WHEN target_price < source_price THEN 'B Mais Barata'
                 WHEN target_price > source_price THEN 'A Mais Barata'
                 ELSE 'Preços Iguais' END AS advantage
  FROM pt0)"""


def band(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} <= 100 THEN 'Até R$ 100' "
            f"WHEN {col} <= 500 THEN 'R$ 100 - R$ 500' WHEN {col} <= 1000 THEN 'R$ 500 - R$ 1.000' "
            f"WHEN {col} <= 5000 THEN 'R$ 1.000 - R$ 5.000' ELSE 'Acima de R$ 5.000' END")


def tag_text(col: str) -> str:
    x = f"replace({col}, '&nbsp;', chr(160))"
    x = f"regexp_replace({x}, '{WS}*<[^>]*>{WS}*', '', 'g')"
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")]:
        x = f"replace({x}, '{ent}', '{ch}')"
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


LINKS = f"""
links AS (
  SELECT page_id, CAST(unnest(generate_series(1, len(h))) AS INTEGER) AS pos, unnest(h) AS href, unnest(i) AS inner_html
  FROM (SELECT page_id, regexp_extract_all(html, '{ANCHOR}', 1) AS h,
               regexp_extract_all(html, '{ANCHOR}', 2) AS i FROM pages)),
links2 AS (SELECT page_id, pos, href, {tag_text('inner_html')} AS title FROM links)"""

PAGE_KEYS = """
pk AS (
  SELECT page_id, html,
         regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS category,
         TRY_CAST(regexp_extract(url, '^https?://[^/]+/[^/?#]+/([0-9]+)', 1) AS INTEGER) AS page
  FROM pages)"""


def br(x: str) -> str:
    return f"translate(format('{{:,.2f}}', {x}), ',.', '.,')"


PRICE_TEXTS = f"""
pt_text AS (
  SELECT p_partkey,
    CASE p_size % 6
      WHEN 0 THEN 'R$ ' || {br('p_retailprice * 10')}
      WHEN 1 THEN printf('%.2f', p_retailprice)
      WHEN 2 THEN 'R$ ' || {br('p_retailprice')} || ' ou 3x de R$ ' || {br('p_retailprice / 3')}
      WHEN 3 THEN 'Indisponível'
      WHEN 4 THEN 'Preço: ' || {br('p_retailprice')}
      ELSE '' END AS price_text
  FROM part)"""

DEC = r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"
SDEC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _ndots(x: str) -> str:
    return f"(length({x}) - length(replace({x}, '.', '')))"


H1 = (f"CASE WHEN price_text IS NULL OR price_text = '' OR contains(lower(price_text), 'indisponível') THEN NULL "
      f"WHEN regexp_matches(c1, '{SDEC}') THEN TRY_CAST(c1 AS DOUBLE) END")
H1_FROM = "(SELECT *, replace(regexp_replace(price_text, '[R$\\s.]', '', 'g'), ',', '.') AS c1 FROM pt_text)"
H2_FROM = ("(SELECT *, CASE WHEN " + _ndots("d0") + " > 1 THEN replace(left(d0, length(d0) - strpos(reverse(d0), '.')), '.', '') "
           "|| substr(d0, length(d0) - strpos(reverse(d0), '.') + 1) ELSE d0 END AS c2 FROM "
           "(SELECT *, replace(replace(regexp_replace(price_text, '[^0-9,.]', '', 'g'), '.', ''), ',', '.') AS d0 FROM pt_text))")
H2 = f"coalesce(CASE WHEN regexp_matches(c2, '{DEC}') THEN TRY_CAST(c2 AS DOUBLE) ELSE 0.0::DOUBLE END, 0.0::DOUBLE)"
H3_FROM = ("(SELECT *, CASE WHEN contains(tok, ',') THEN replace(replace(tok, '.', ''), ',', '.') "
           "WHEN " + _ndots("tok") + " > 1 THEN replace(tok, '.', '') ELSE tok END AS c3 FROM "
           "(SELECT *, regexp_extract(price_text, '[0-9][0-9.,]*', 0) AS tok FROM pt_text))")
H3 = f"coalesce(CASE WHEN regexp_matches(c3, '{DEC}') THEN TRY_CAST(c3 AS DOUBLE) ELSE 0.0::DOUBLE END, 0.0::DOUBLE)"


def w(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BM_ALL = w(PRODUCTS, BEST, PAIRS)
ORACLE: dict[str, str] = {}

ORACLE["best_match"] = w(PRODUCTS, BEST) + "SELECT source_id, target_id, round(similarity, 6) AS similarity FROM best"
ORACLE["best_match_blocked"] = ORACLE["best_match"]
ORACLE["best_match_pruned"] = ORACLE["best_match"]
ORACLE["similarity_pairs"] = w(PRODUCTS, BEST) + (
    "SELECT source_id, target_id, round(similarity, 6) AS similarity FROM scores WHERE similarity >= 0.35")
ORACLE["analytical_report"] = w(PRODUCTS, BEST, K1) + (
    "SELECT source_id, source_title, target_id, target_title, round(similarity, 6) AS similarity, source_price, "
    "target_price, round(diff_pct, 6) AS diff_pct, source_url, is_exclusive FROM k1")
ORACLE["business_report"] = w(PRODUCTS, BEST, K1, K2) + "SELECT * FROM k2"

_K3 = """
SELECT source_id, title, price, url,
       CASE WHEN m THEN bt END AS target_id, CASE WHEN m THEN tt END AS target_title,
       CASE WHEN m THEN tp END AS target_price, CASE WHEN m THEN tu END AS target_url,
       round(coalesce(bsim, 0.0::DOUBLE), 6) AS similarity,
       CASE WHEN m THEN 'não' ELSE 'sim' END AS exclusivity,
       round(CASE WHEN m AND tp <> 0 AND NOT isnan((price - tp) / tp) THEN (price - tp) / tp
                  ELSE 0.0::DOUBLE END * 100, 6) AS diff_pct,
       CASE WHEN m AND tt IS NOT NULL THEN 'B' ELSE 'A' END AS marketplace
FROM (
  SELECT s.product_id AS source_id, s.title, s.price, s.url, b.target_id AS bt, b.similarity AS bsim,
         t.title AS tt, t.price AS tp, t.url AS tu, coalesce(b.similarity >= 0.35, false) AS m
  FROM src s LEFT JOIN best b ON b.source_id = s.product_id LEFT JOIN tgt t ON t.product_id = b.target_id
  WHERE s.title IS NOT NULL)"""
_TITLED = PRODUCTS.replace("marketplace = 'B')", "marketplace = 'B' AND title IS NOT NULL)")
ORACLE["match_report"] = w(_TITLED, BEST) + _K3
ORACLE["match_empty_target"] = w(PRODUCTS) + """
SELECT product_id AS source_id, title, price, url, NULL::BIGINT AS target_id, NULL::VARCHAR AS target_title,
       NULL::DOUBLE AS target_price, NULL::VARCHAR AS target_url, 0.0::DOUBLE AS similarity, 'sim' AS exclusivity,
       0.0::DOUBLE AS diff_pct, 'A' AS marketplace
FROM src WHERE title IS NOT NULL"""
ORACLE["pairs_unconditional"] = BM_ALL + (
    "SELECT pair_id, side, product_id, title, marketplace, price, url, exclusivity, round(similarity, 6) AS similarity, "
    "round(diff_pct, 6) AS diff_pct, partner_price FROM pairs")
ORACLE["exclusives_target"] = BM_ALL + "SELECT * FROM excl"
ORACLE["exclusives_source"] = w(PRODUCTS, BEST, K1) + (
    "SELECT source_id, source_title, target_id, target_title, round(similarity, 6) AS similarity, source_price, "
    "target_price, round(diff_pct, 6) AS diff_pct, source_url, is_exclusive FROM k1 WHERE is_exclusive")
ORACLE["benchmark_table"] = BM_ALL + (
    "SELECT title, marketplace, price, url, exclusivity, round(similarity, 6) AS similarity, similarity_level, "
    "round(diff_pct, 6) AS diff_pct, pair_id, product_id, partner_price FROM bm")
ORACLE["final_cleanup"] = BM_ALL + (
    f"SELECT pair_id, side, product_id, title, marketplace, price, url, exclusivity, round(similarity, 6) AS similarity, "
    f"round(diff_pct, 6) AS diff_pct, partner_price, {level('similarity')} AS similarity_level FROM kept")
ORACLE["dedupe_cheapest"] = """
SELECT * FROM (
  SELECT p_partkey AS product_id, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS marketplace,
         p_retailprice AS price FROM part)
QUALIFY row_number() OVER (PARTITION BY title, marketplace ORDER BY price NULLS LAST, product_id) = 1"""
ORACLE["dedupe_exact_match"] = w(
    PRODUCTS, _vectors("av", "products"), _vectors("tv", "tgt"), _scores("sc_all", "av", "tv"),
    """
best_all AS (SELECT * FROM sc_all
             QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY round(similarity, 12) DESC, target_id) = 1),
r AS (SELECT p.product_id, p.name AS title, p.marketplace, p.price, round(b.similarity, 6) AS similarity,
             round(b.similarity, 12) = 1.0 AS exact
      FROM products p JOIN best_all b ON b.source_id = p.product_id)""") + """
SELECT * EXCLUDE (exact) FROM (SELECT * FROM r WHERE exact
               QUALIFY row_number() OVER (PARTITION BY title, marketplace ORDER BY price NULLS LAST, product_id) = 1)
UNION ALL
SELECT * EXCLUDE (exact) FROM r WHERE NOT exact OR exact IS NULL"""
ORACLE["pair_price_diff"] = BM_ALL + "SELECT pair_id, side, product_id, price, round(diff_pct, 6) AS diff_pct FROM pairs"

_PARSE = "SELECT p_partkey, price_text, {expr} AS price FROM {src}"
ORACLE["price_parse_nullable"] = w(PRICE_TEXTS) + _PARSE.format(expr=H1, src=H1_FROM)
ORACLE["price_parse_digits"] = w(PRICE_TEXTS) + _PARSE.format(expr=H2, src=H2_FROM)
ORACLE["price_parse_first_token"] = w(PRICE_TEXTS) + _PARSE.format(expr=H3, src=H3_FROM)

ORACLE["url_prefix"] = w(LINKS) + "SELECT page_id, pos, href, 'https://a.example' || href AS url FROM links"
ORACLE["url_relative"] = w(LINKS) + (
    "SELECT page_id, pos, href, CASE WHEN starts_with(href, '/') THEN 'https://b.example' || href ELSE href END AS url "
    "FROM links")
ORACLE["url_absolute"] = w(LINKS) + f"SELECT page_id, pos, href, {absolute('href', 'https://a.example')} AS url FROM links"
ORACLE["page_links"] = w(LINKS) + (
    "SELECT page_id, pos, href, title, CASE WHEN starts_with(href, '/') THEN 'https://b.example' || href ELSE href END "
    "AS url FROM links2")
ORACLE["similarity_level"] = w(PRODUCTS, BEST) + (
    f"SELECT source_id, round(similarity, 6) AS similarity, {level('similarity')} AS similarity_level FROM best")
ORACLE["level_distribution"] = BM_ALL + "SELECT similarity_level, count(*) AS n FROM bm GROUP BY similarity_level"

_CAT = ("CASE WHEN contains(title, 'Geladeira') THEN 'Eletrodomésticos' WHEN contains(title, 'Fogão') THEN 'Eletrodomésticos' "
        "WHEN contains(title, 'Máquina') THEN 'Eletrodomésticos' WHEN contains(title, 'Smartphone') THEN 'Eletrônicos' "
        "WHEN contains(title, 'Notebook') THEN 'Eletrônicos' WHEN contains(title, 'TV') THEN 'Eletrônicos' "
        "ELSE 'Outros' END")
ORACLE["category_from_title"] = f"""
WITH t AS (
  SELECT 'part' AS kind, p_partkey AS id, concat_ws(' ', p_name, p_brand) AS title FROM part
  UNION ALL
  SELECT 'page', page_id, {tag_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} FROM pages)
SELECT kind, id, title, {_CAT} AS category FROM t"""
ORACLE["price_band"] = f"""
WITH t AS (
  SELECT 'lineitem' AS kind, l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS line, l_extendedprice AS price FROM lineitem
  UNION ALL
  SELECT 'events', event_id, 0::BIGINT, value FROM events)
SELECT kind, id, line, price, {band('price')} AS price_band FROM t"""
ORACLE["pair_analysis"] = w(PRODUCTS, BEST, PAIRS, PAIR_TABLE) + f"""
SELECT * REPLACE (round(similarity, 6) AS similarity, round(diff_pct, 6) AS diff_pct),
       {_CAT.replace('title', 'target_title')} AS category, {band('target_price')} AS price_band FROM pt"""
ORACLE["cheaper_side"] = BM_ALL + """SELECT product_id, pair_id, marketplace, price, partner_price FROM bm"""
ORACLE["report_statistics"] = BM_ALL + """
SELECT count(*) AS total_products,
       count(*) FILTER (WHERE marketplace = 'A') AS source_products,
       count(*) FILTER (WHERE marketplace = 'B') AS target_products,
       count(*) FILTER (WHERE lower(trim(exclusivity)) = 'não') AS paired_products,
       count(*) FILTER (WHERE lower(trim(exclusivity)) = 'sim') AS exclusive_products,
       count(*) FILTER (WHERE similarity_level = 'muito similar') AS very_similar,
       count(*) FILTER (WHERE similarity_level = 'moderadamente similar') AS moderately_similar,
       count(*) FILTER (WHERE similarity_level = 'pouco similar') AS little_similar,
       count(*) FILTER (WHERE similarity_level = 'exclusivo') AS exclusive_level
FROM bm"""

_KPI = """
k AS (
  SELECT count(*) AS total_products,
         count(*) FILTER (WHERE marketplace = 'B') AS total_target,
         count(*) FILTER (WHERE marketplace = 'A') AS total_source,
         count(*) FILTER (WHERE marketplace = 'B' AND exclusivity = 'sim') AS exclusive_target,
         count(*) FILTER (WHERE marketplace = 'A' AND exclusivity = 'sim') AS exclusive_source,
         count(*) FILTER (WHERE exclusivity = 'não') / 2 AS paired_products,
         avg(price) FILTER (WHERE marketplace = 'B') AS avg_price_target,
         avg(price) FILTER (WHERE marketplace = 'A') AS avg_price_source,
         avg(diff_pct) FILTER (WHERE exclusivity = 'não') AS avg_diff_pct,
         count(*) FILTER (WHERE marketplace = 'B' AND exclusivity = 'não' AND price < partner_price) AS target_cheaper,
         count(*) FILTER (WHERE marketplace = 'B' AND exclusivity = 'não' AND price > partner_price) AS source_cheaper,
         count(*) FILTER (WHERE exclusivity = 'não') AS paired_rows,
         count(*) FILTER (WHERE exclusivity = 'sim') AS exclusive_rows,
         count(*) FILTER (WHERE similarity_level = 'muito similar') AS very_similar,
         count(*) FILTER (WHERE similarity_level = 'moderadamente similar') AS moderately_similar,
         count(*) FILTER (WHERE similarity_level = 'pouco similar') AS little_similar,
         avg(diff_pct) FILTER (WHERE marketplace = 'B' AND exclusivity = 'não' AND price < partner_price) AS favourable_gap
  FROM bm),
k2 AS (
  SELECT *, CASE WHEN paired_products = 0 THEN 0.0 ELSE target_cheaper / paired_products END AS share_target_cheaper,
            CASE WHEN paired_products = 0 THEN 0.0 ELSE source_cheaper / paired_products END AS share_source_cheaper,
            coalesce(CASE WHEN avg_price_target = 0 THEN NULL
                          ELSE (avg_price_source - avg_price_target) / avg_price_target END, 0.0) AS avg_price_gap
  FROM k)"""
ORACLE["kpi_row"] = w(PRODUCTS, BEST, PAIRS, _KPI, K1) + """
SELECT total_products, total_target, total_source, exclusive_target, exclusive_source,
       round(paired_products, 6) AS paired_products, round(avg_price_target, 6) AS avg_price_target,
       round(avg_price_source, 6) AS avg_price_source, round(avg_diff_pct, 6) AS avg_diff_pct,
       target_cheaper, source_cheaper, round(share_target_cheaper, 6) AS share_target_cheaper,
       round(share_source_cheaper, 6) AS share_source_cheaper, round(avg_price_gap, 6) AS avg_price_gap,
       round(share_target_cheaper - share_source_cheaper, 6) AS target_advantage,
       paired_rows, exclusive_rows, very_similar, moderately_similar, little_similar,
       round(favourable_gap, 6) AS favourable_gap,
       (SELECT round(coalesce(avg(CASE WHEN is_exclusive THEN 0.0 ELSE 1.0 END), 0.0), 6) FROM k1) AS coverage,
       (SELECT round(coalesce(avg(CASE WHEN similarity > 0.45 THEN 1.0 ELSE 0.0 END), 0.0), 6) FROM k1) AS quality,
       (SELECT count(*) FILTER (WHERE is_exclusive) FROM k1) AS opportunities
FROM k2"""
ORACLE["price_by_marketplace"] = BM_ALL + (
    "SELECT marketplace, round(avg(price), 6) AS avg_price, count(*) AS n FROM bm GROUP BY marketplace")
ORACLE["price_gap"] = w(PRODUCTS, BEST, PAIRS, _KPI) + (
    "SELECT round(avg_price_source, 6) AS avg_price_source, round(avg_price_target, 6) AS avg_price_target, "
    "round(avg_price_gap, 6) AS avg_price_gap FROM k2")
ORACLE["coverage_quality"] = w(PRODUCTS, BEST, K1) + """
SELECT round(coalesce(avg(CASE WHEN is_exclusive THEN 0.0 ELSE 1.0 END), 0.0), 6) AS coverage,
       round(coalesce(avg(CASE WHEN similarity > 0.45 THEN 1.0 ELSE 0.0 END), 0.0), 6) AS quality,
       count(*) FILTER (WHERE is_exclusive) AS opportunities
FROM k1"""
ORACLE["favourable_gap"] = w(PRODUCTS, BEST, PAIRS, PAIR_TABLE) + (
    "SELECT round(avg(diff_pct) FILTER (WHERE target_price < source_price), 6) AS favourable_gap FROM pt")
ORACLE["input_counts"] = w(PRODUCTS) + (
    "SELECT (SELECT count(*) FROM src) AS source_rows, (SELECT count(*) FROM tgt) AS target_rows")
ORACLE["table_scan"] = w(PRODUCTS) + (
    "SELECT title AS title_source, price AS price_source, url AS url_source FROM products WHERE title IS NOT NULL")
ORACLE["export_roundtrip"] = BM_ALL + "SELECT title, marketplace, price, url, exclusivity FROM bm"
ORACLE["top10_gap"] = w(PRODUCTS, BEST, PAIRS, PAIR_TABLE) + """
SELECT pair_id, source_title, target_title, round(diff_pct, 6) AS diff_pct, row_number() OVER (ORDER BY diff_pct DESC, pair_id) AS rank
FROM pt WHERE diff_pct IS NOT NULL ORDER BY diff_pct DESC, pair_id LIMIT 10"""
ORACLE["bottom10_gap"] = w(PRODUCTS, BEST, PAIRS, PAIR_TABLE) + """
SELECT pair_id, source_title, target_title, round(diff_pct, 6) AS diff_pct, row_number() OVER (ORDER BY diff_pct ASC, pair_id) AS rank
FROM pt WHERE diff_pct IS NOT NULL ORDER BY diff_pct ASC, pair_id LIMIT 10"""
ORACLE["very_similar_by_price"] = BM_ALL + """
SELECT title, marketplace, price, url, exclusivity, similarity_level FROM bm
WHERE similarity_level = 'muito similar' ORDER BY price DESC"""
ORACLE["exclusives_by_price"] = BM_ALL + """
SELECT title, marketplace, price, url, exclusivity FROM bm WHERE exclusivity = 'sim' ORDER BY price DESC"""
ORACLE["exclusives_listing"] = w(PRODUCTS, BEST, K1, K2) + "SELECT title, price, url FROM k2 WHERE exclusivity = 'sim'"
ORACLE["exclusives_count"] = w(PRODUCTS, BEST, K1, K2) + (
    "SELECT count(*) FILTER (WHERE exclusivity = 'sim') AS n_exclusive FROM k2")
ORACLE["dimension_levels"] = BM_ALL + "SELECT DISTINCT similarity_level FROM bm"
ORACLE["dimension_marketplaces"] = BM_ALL + "SELECT DISTINCT marketplace FROM bm"
ORACLE["scatter_source"] = w(PRODUCTS, BEST, PAIRS, PAIR_TABLE) + (
    "SELECT pair_id, round(similarity, 6) AS similarity, round(diff_pct, 6) AS diff_pct FROM pt")
ORACLE["advantage_split"] = w(PRODUCTS, BEST, PAIRS, PAIR_TABLE) + (
    "SELECT advantage, count(*) AS n_pairs FROM pt GROUP BY advantage")
ORACLE["level_category_rollup"] = BM_ALL + """
SELECT p.category, b.similarity_level, count(*) AS n,
       CAST(grouping(p.category, b.similarity_level) AS BIGINT) AS level_of_detail
FROM bm b JOIN products p ON p.product_id = b.product_id
GROUP BY ROLLUP (p.category, b.similarity_level)"""
ORACLE["slicer_view"] = BM_ALL + f"""
SELECT * FROM (
  SELECT title, marketplace, price, url, exclusivity, round(similarity, 6) AS similarity, similarity_level,
         round(diff_pct, 6) AS diff_pct, pair_id, product_id, partner_price, {band('price')} AS price_band FROM bm)
WHERE marketplace = 'B' AND similarity_level IN ('muito similar', 'moderadamente similar')
  AND price_band = 'R$ 500 - R$ 1.000'"""
ORACLE["catalog_union"] = w(PRODUCTS) + "SELECT product_id, title, category FROM products"
ORACLE["catalog_filter"] = """
WITH r AS (
  SELECT p_partkey,
         CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 11 = 0 THEN '' ELSE p_name END AS title,
         CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 17 = 0 THEN 0.0::DOUBLE ELSE p_retailprice END AS price,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE '/p/' || CAST(p_partkey AS VARCHAR) END AS link
  FROM part)
SELECT p_partkey, title, price, link,
       (title IS NOT NULL AND title <> '' AND link IS NOT NULL AND link <> '' AND coalesce(price > 0, false)) AS valid_strict,
       (title IS NOT NULL AND title <> '' AND link IS NOT NULL AND link <> '') AS valid_lenient,
       (title IS NOT NULL AND link IS NOT NULL) AS valid_tag,
       (price IS NOT NULL AND NOT isnan(price)) AS has_price,
       coalesce(nullif(trim(title), ''), nullif(trim(CAST(price AS VARCHAR)), ''), nullif(trim(link), '')) IS NOT NULL
         AS not_empty
FROM r"""
ORACLE["catalog_prepare"] = w(PRODUCTS) + f"""
SELECT product_id, 'A' AS marketplace, {H3.replace('c3', 'c')} AS price FROM (
  SELECT *, CASE WHEN contains(tok, ',') THEN replace(replace(tok, '.', ''), ',', '.')
                 WHEN {_ndots('tok')} > 1 THEN replace(tok, '.', '') ELSE tok END AS c
  FROM (SELECT product_id, embedding, regexp_extract('R$ ' || {br('price')}, '[0-9][0-9.,]*', 0) AS tok FROM products))
WHERE embedding IS NOT NULL"""
ORACLE["crawl_plan"] = w(PAGE_KEYS) + """
SELECT category, CAST(page AS INTEGER) AS page, replace('https://shop.example/' || category || '/?page={}', '{}', CAST(page AS VARCHAR)) AS page_url
FROM (SELECT category, unnest(generate_series(1, CAST(count(*) AS INTEGER))) AS page FROM pk GROUP BY category)"""
ORACLE["first_empty_page"] = w(PAGE_KEYS) + f"""
, st AS (
  SELECT page_id, category, page,
         CAST(len(regexp_extract_all(html, '{ANCHOR}', 1)) AS INTEGER) AS n_cards,
         (html IS NULL OR html = '') AS failed
  FROM pk),
cut AS (SELECT category, min(page) FILTER (WHERE n_cards = 0 OR failed) AS c FROM st GROUP BY category)
SELECT st.page_id, st.category, st.page, st.n_cards FROM st JOIN cut ON cut.category IS NOT DISTINCT FROM st.category
WHERE cut.c IS NULL OR st.page IS NULL OR st.page < cut.c"""
ORACLE["gap_trend"] = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS period, event_type, round(avg(value), 6) AS avg_value, count(*) AS n
FROM events GROUP BY 1, 2"""
ORACLE["ingest_pages"] = w(PAGE_KEYS) + f"""
, st AS (
  SELECT page_id, category, page, len(regexp_extract_all(html, '{ANCHOR}', 1)) AS n_cards FROM pk),
cut AS (SELECT category, min(page) FILTER (WHERE n_cards = 0) AS c FROM st GROUP BY category),
kept AS (SELECT pk.* FROM pk JOIN st USING (page_id) JOIN cut ON cut.category IS NOT DISTINCT FROM pk.category
         WHERE cut.c IS NULL OR pk.page IS NULL OR pk.page < cut.c),
l AS (
  SELECT page_id, category, CAST(unnest(generate_series(1, len(h))) AS INTEGER) AS pos, unnest(h) AS href,
         unnest(i) AS inner_html
  FROM (SELECT page_id, category, regexp_extract_all(html, '{ANCHOR}', 1) AS h,
               regexp_extract_all(html, '{ANCHOR}', 2) AS i FROM kept))
SELECT page_id, pos, {tag_text('inner_html')} AS title,
       CASE WHEN starts_with(href, '/') THEN 'https://a.example' || href ELSE href END AS url, category
FROM l"""


def _encoded(name: str, table: str, key: str) -> str:
    """Titles of ``table`` as hashed trigram vectors of 64 buckets."""
    return f"""
{name}_pad AS (SELECT {key} AS k, title, ' ' || lower(title) || ' ' AS p FROM {table}),
{name}_gram AS (SELECT k, p, unnest(generate_series(1, length(p) - 2)) AS i FROM {name}_pad WHERE p IS NOT NULL),
{name}_n AS (
  SELECT k, CAST('0x' || substr(md5(substr(p, i, 1) || ' ' || substr(p, i + 1, 1) || ' ' || substr(p, i + 2, 1)), 1, 8)
              AS BIGINT) % 64 AS b, count(*) AS n
  FROM {name}_gram GROUP BY ALL),
{name}_v AS (
  SELECT k, map(list(b), list(n)) AS counts, sqrt(sum(n * n)::DOUBLE) AS norm FROM {name}_n GROUP BY k),
{name} AS (
  SELECT e.k, e.title, CASE WHEN e.p IS NOT NULL THEN list_transform(generate_series(0, 63),
      lambda x: CAST(coalesce(v.counts[x], 0) / coalesce(v.norm, 1.0::DOUBLE) AS FLOAT)) END AS embedding
  FROM {name}_pad e LEFT JOIN {name}_v v ON v.k = e.k)"""


ORACLE["encode_titles"] = w(
    "t AS (SELECT p_partkey, concat_ws(' ', p_name, p_brand) AS title FROM part)", _encoded("enc", "t", "p_partkey")
) + "SELECT k AS p_partkey, title, embedding FROM enc"
ORACLE["match_encoded"] = w(
    PRODUCTS, _encoded("enc", "products", "product_id"),
    "se AS (SELECT k AS product_id, embedding FROM enc WHERE k % 2 = 0)",
    "te AS (SELECT k AS product_id, embedding FROM enc WHERE k % 2 <> 0)",
    _vectors("sv", "se"), _vectors("tv", "te"), _scores("scores", "sv", "tv"), """
best AS (SELECT * FROM scores
         QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY round(similarity, 12) DESC, target_id) = 1)""",
) + "SELECT source_id, target_id, round(similarity, 6) AS similarity FROM best"

_TODAY = PRODUCTS.replace("marketplace = 'A'", "marketplace = 'A' AND product_id % 13 <> 0").replace(
    "marketplace = 'B'", "marketplace = 'B' AND product_id % 13 <> 0")
ORACLE["refresh_match"] = w(_TODAY, BEST) + "SELECT source_id, target_id, round(similarity, 6) AS similarity FROM best"
ORACLE["benchmark_refreshed"] = ORACLE["benchmark_table"].replace(PRODUCTS, _TODAY)
ORACLE["versioned_table"] = """
SELECT 1 AS version, doc_id, source, NULL::VARCHAR AS place FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT 2, doc_id, NULL, concat_ws('/', lang, source) FROM documents"""
ORACLE["category_table"] = f"""
WITH t AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS lang,
                  {tag_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages),
k AS (SELECT lang, unnest(string_split(title, ' ')) AS keyword FROM t WHERE page_id % 2 = 0),
r AS (SELECT keyword, min(lang) AS category, count(*) AS priority FROM k GROUP BY keyword),
f AS (SELECT page_id, r.category FROM t JOIN r ON contains(t.title, r.keyword)
      QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY priority, keyword) = 1)
SELECT t.page_id, title, coalesce(category, 'Outros') AS category FROM t LEFT JOIN f USING (page_id)"""
ORACLE["csv_lines"] = "SELECT doc_id, text, source FROM documents WHERE doc_id IS NOT NULL"
ORACLE["match_encoded_pruned"] = ORACLE["match_encoded"]
ORACLE["similarity_pairs_bounded"] = ORACLE["match_encoded"].rpartition("SELECT source_id")[0] + (
    "SELECT source_id, target_id, round(similarity, 6) AS similarity FROM scores WHERE similarity >= 0.85")

ORACLE["ingest_cards"] = w(PAGE_KEYS) + f"""
, st AS (SELECT page_id, url, CAST(unnest(range(1, len(c) + 1)) AS INTEGER) AS pos, unnest(c) AS card
         FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<article[\\s>].*?</article>') AS c FROM pages)),
t AS (SELECT page_id, pos, url, {tag_text("regexp_extract(card, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS title FROM st),
cut AS (SELECT category, min(page) FILTER (WHERE html IS NULL OR html = '' OR NOT regexp_matches(html, '(?i)<article')) AS c
        FROM pk GROUP BY category)
SELECT t.page_id, t.pos, t.title, NULL::DOUBLE AS price,
       CASE WHEN starts_with(t.url, '/') THEN 'https://a.example' || t.url ELSE t.url END AS url, pk.category
FROM t JOIN pk USING (page_id) JOIN cut ON cut.category IS NOT DISTINCT FROM pk.category
WHERE t.title <> '' AND t.url <> '' AND (cut.c IS NULL OR pk.page IS NULL OR pk.page < cut.c)"""
ORACLE["export_full"] = BM_ALL + """
SELECT title || CASE product_id % 4 WHEN 0 THEN ' 55"' WHEN 1 THEN ',' || chr(10) || ' 2 "x"' WHEN 2 THEN '  ' ELSE '' END
         AS title, marketplace, price, url, exclusivity, round(similarity, 6) AS similarity, similarity_level,
       round(diff_pct, 6) AS diff_pct
FROM bm"""
ORACLE["feed_scan"] = """
SELECT p_partkey AS id_tabela, p_name AS titulo_tabela, CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS DOUBLE) AS preco_tabela,
       '/p/' || CAST(p_partkey AS VARCHAR) AS url_tabela
FROM part WHERE p_size % 7 <> 0 AND p_size % 5 > 2"""
ORACLE["rows_not_empty"] = """
SELECT p_name AS title, CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS price,
       '/p/' || CAST(p_partkey AS VARCHAR) AS link
FROM part WHERE p_size % 7 <> 0 AND p_size % 11 <> 0"""
ORACLE["category_keywords"] = f"""
WITH t AS (
  SELECT p_partkey, CASE WHEN p_size % 10 <> 0 THEN p_name || ' ' ||
    CASE p_partkey % 9 WHEN 0 THEN 'Geladeira' WHEN 1 THEN 'Fogão' WHEN 2 THEN 'Máquina' WHEN 3 THEN 'Smartphone'
      WHEN 4 THEN 'Notebook' WHEN 5 THEN 'TV' WHEN 6 THEN 'Suporte TV Notebook' WHEN 7 THEN 'geladeira' ELSE '' END
    || ' ' || p_brand END AS title FROM part)
SELECT p_partkey, title, {_CAT} AS category FROM t"""

# the same chain with a threshold on the pairs and the sources that it leaves alone
_BEST_AT = BEST.replace("best AS (SELECT * FROM scores", "top AS (SELECT * FROM scores") + """,
best AS (SELECT * FROM top WHERE similarity >= 0.35)"""
_PAIRS_BOTH = PAIRS.replace("allrows AS (SELECT * FROM pairs UNION ALL SELECT * FROM excl)", f"""
excl_src AS (
  SELECT NULL::BIGINT AS pair_id, 2 AS side, s.product_id, s.title, 'A' AS marketplace, s.price,
         {absolute('s.url', 'https://a.example')} AS url, 'sim' AS exclusivity, -1.0::DOUBLE AS similarity,
         NULL::DOUBLE AS diff_pct, NULL::DOUBLE AS partner_price
  FROM src s WHERE s.embedding IS NOT NULL AND NOT EXISTS (SELECT 1 FROM best b WHERE b.source_id = s.product_id)),
allrows AS (SELECT * FROM pairs UNION ALL SELECT * FROM excl UNION ALL SELECT * FROM excl_src)""")
ORACLE["benchmark_symmetric"] = w(PRODUCTS, _BEST_AT, _PAIRS_BOTH) + (
    "SELECT title, marketplace, price, url, exclusivity, round(similarity, 6) AS similarity, similarity_level, "
    "round(diff_pct, 6) AS diff_pct, pair_id, product_id, partner_price FROM bm")
# The cards of these pages are counted by their start tags, and the price is made from the number it was written from.
_SHOP = f"""
WITH sp AS (
  SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS category, CAST(page_id % 1000 AS INTEGER) AS page, url, html,
         page_id % 211 IN (207, 208) OR html IS NULL OR html = '' AS failed,
         CAST(CASE WHEN page_id % 211 IN (207, 208, 209) THEN 0
              ELSE coalesce((length(html) - length(replace(lower(html), '<article', ''))) // 8, 0) END AS INTEGER) AS n_cards
  FROM pages),
sc AS (SELECT category, min(page) FILTER (WHERE failed OR n_cards = 0) AS c FROM sp GROUP BY category),
sk AS (SELECT sp.* FROM sp JOIN sc ON sc.category IS NOT DISTINCT FROM sp.category WHERE sc.c IS NULL OR sp.page < sc.c)"""
ORACLE["crawl_cut"] = _SHOP + " SELECT page_id, category, page, n_cards FROM sk"
ORACLE["ingest_priced_cards"] = _SHOP + f"""
SELECT page_id, 1 AS pos, {tag_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS title,
       page_id * 37 % 9000 + 10.25::DOUBLE AS price,
       CASE WHEN starts_with(url, '/') THEN 'https://a.example' || url ELSE url END AS url, category
FROM sk WHERE page_id % 4 > 1"""
ORACLE["crawl_stream"] = ORACLE["crawl_cut"]
ORACLE["trend_runs"] = """
WITH h AS (SELECT doc_id, doc_id % 40 AS day, source, (doc_id // 40) % 2 AS attempt, n_chars % 1000 / 8 AS diff, doc_id % 7 <> 0 AS paired FROM documents),
l AS (SELECT *, max(attempt) OVER (PARTITION BY day, source) AS last FROM h),
o AS (SELECT max(day) AS top FROM h)
SELECT DATE '2024-01-01' + day::INTEGER AS period, round(avg(diff) FILTER (WHERE paired), 6) AS avg_diff_pct, count(*) FILTER (WHERE paired) / 2 AS pairs
FROM l, o WHERE attempt = last AND (day + 1) * 24 <= top * 24 + 8 - 48 GROUP BY day"""
ORACLE["cube_slices"] = BM_ALL + f"""
SELECT {band('bm.price')} AS price_band, p.category, count(*) AS rows, count(*) FILTER (WHERE exclusivity = 'sim') AS exclusive,
       round(avg(bm.price), 6) AS avg_price
FROM bm JOIN products p ON p.product_id = bm.product_id
WHERE bm.marketplace = 'B' AND similarity_level IN ('muito similar', 'exclusivo') GROUP BY 1, 2"""
ORACLE["cube_kpis"] = w(PRODUCTS, BEST, PAIRS, _KPI) + """
SELECT total_products, total_target, total_source, exclusive_target, exclusive_source,
       round(paired_products, 6) AS paired_products, round(avg_price_target, 6) AS avg_price_target,
       round(avg_price_source, 6) AS avg_price_source, round(avg_diff_pct, 6) AS avg_diff_pct,
       target_cheaper, source_cheaper, round(share_target_cheaper, 6) AS share_target_cheaper,
       round(share_source_cheaper, 6) AS share_source_cheaper, round(avg_price_gap, 6) AS avg_price_gap,
       round(share_target_cheaper - share_source_cheaper, 6) AS target_advantage,
       paired_rows, exclusive_rows, very_similar, moderately_similar, little_similar, round(favourable_gap, 6) AS favourable_gap
FROM k2"""
ORACLE["embed_table"] = w(
    f"""t AS (SELECT page_id, {tag_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, url,
        regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS categoria FROM pages)""", _encoded("enc", "t", "page_id")
) + "SELECT enc.title, NULL::VARCHAR AS price, url, categoria, embedding FROM enc JOIN t ON t.page_id = enc.k"
ORACLE["partner_prices"] = w(PRODUCTS, BEST, PAIRS, PAIR_TABLE) + "SELECT pair_id, source_price, source_title, target_price, target_title FROM pt"
ORACLE["partner_lookup"] = BM_ALL + """
SELECT a.product_id, a.pair_id, a.marketplace, b.price AS partner_price
FROM bm a LEFT JOIN bm b ON b.pair_id = a.pair_id AND b.marketplace <> a.marketplace"""
ORACLE["pair_pivot"] = BM_ALL + f"""
, p AS (SELECT pair_id, max(price) FILTER (WHERE marketplace = 'B') AS target_price, max(price) FILTER (WHERE marketplace = 'A') AS source_price,
               max(url) FILTER (WHERE marketplace = 'B') AS target_url, max(url) FILTER (WHERE marketplace = 'A') AS source_url,
               round(max(similarity) FILTER (WHERE marketplace = 'B'), 6) AS similarity,
               max(similarity_level) FILTER (WHERE marketplace = 'B') AS similarity_level,
               round(max(diff_pct) FILTER (WHERE marketplace = 'B'), 6) AS diff_pct
        FROM bm WHERE exclusivity = 'não' GROUP BY pair_id)
SELECT *, CASE WHEN source_price IS NULL OR target_price IS NULL THEN NULL WHEN target_price < source_price THEN 'B Mais Barata'
               WHEN target_price > source_price THEN 'A Mais Barata' ELSE 'Preços Iguais' END AS advantage,
       {band('target_price')} AS price_band
FROM p"""
