"""The same results in plain SQL, written from the definitions and not from the Spark plans.

VIEWS are named subqueries; a query names the ones it needs with {view}.
"""

from __future__ import annotations

import re

RANGE = "date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"
AS_OF = "DATE '1998-06-15'"
MOMENT = "TIMESTAMP '1998-01-01 00:00:00'"
LOAD_TIME = "TIMESTAMP '2001-01-01 00:00:00'"

VIEWS: dict[str, str] = {}
SQL: dict[str, str] = {}

# --- extracts ------------------------------------------------------------------------

VIEWS["overview"] = """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol,
       CASE WHEN s_acctbal >= 1000 THEN s_name END AS short_name,
       CASE WHEN s_acctbal >= 5000 THEN 'HOSE' ELSE 'HNX' END AS exchange,
       CASE WHEN s_acctbal BETWEEN 1000 AND 2000 THEN '' ELSE n_name END AS industry,
       r_name AS sector,
       CASE WHEN s_acctbal >= 500 THEN CAST(ROUND(s_acctbal * 100) AS BIGINT) END AS market_cap,
       CAST(FLOOR(s_acctbal / 10) AS BIGINT) AS no_employees,
       s_acctbal * 1000 AS outstanding_share
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE s_acctbal >= 0
UNION ALL
SELECT 'C' || CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, n_name, r_name,
       CAST(ROUND(c_acctbal * 100) AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["listing"] = "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, 'UPCOM' AS exchange FROM supplier"

VIEWS["raw_prices"] = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_shipdate AS time,
       l_extendedprice AS open, l_extendedprice * 2 AS high, l_extendedprice / 2 AS low,
       CASE WHEN l_discount > 0 THEN l_extendedprice END AS close, CAST(l_quantity AS BIGINT) AS volume,
       l_orderkey AS seq1, l_linenumber AS seq2
FROM lineitem
"""

VIEWS["prices"] = """
SELECT symbol, date, COALESCE(open, 0) AS open, COALESCE(high, 0) AS high, COALESCE(low, 0) AS low,
       COALESCE(close, 0) AS close, COALESCE(volume, 0) AS volume, seq1, seq2
FROM {raw_prices}
"""

VIEWS["ratios"] = """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS year,
       CAST(EXTRACT(QUARTER FROM o_orderdate) AS INT) AS quarter, o_orderpriority AS metric,
       o_totalprice AS value, o_orderkey AS seq
FROM orders
"""

VIEWS["wide_ratios"] = """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS year,
       CAST(EXTRACT(QUARTER FROM o_orderdate) AS INT) AS quarter,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS pe,
       CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS roe,
       CASE WHEN o_orderstatus = 'P' THEN ' ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' ' END AS eps,
       o_orderpriority AS note, o_orderkey AS seq
FROM orders
"""

VIEWS["statements"] = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       CASE l_returnflag WHEN 'R' THEN 'balance_sheet' WHEN 'A' THEN 'income_statement' ELSE 'cash_flow' END
         AS statement_type,
       period, CAST(EXTRACT(YEAR FROM l_shipdate) AS INT) AS year,
       CASE WHEN period = 'quarter' THEN CAST(EXTRACT(QUARTER FROM l_shipdate) AS INT) END AS quarter,
       l_linestatus || CAST(l_linenumber AS VARCHAR) AS metric,
       CASE WHEN l_discount > 0 THEN l_extendedprice END AS value, l_orderkey AS seq1, l_linenumber AS seq2
FROM lineitem, (VALUES ('quarter'), ('year')) p(period)
"""

VIEWS["officers"] = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       CASE WHEN p_size <= 2 THEN '' ELSE p_brand END AS officer_name, p_type AS officer_position,
       l_discount * 100 AS officer_own_percent, l_orderkey AS seq1, l_linenumber AS seq2
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

VIEWS["trades"] = """
SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
"""

VIEWS["shareholders"] = """
SELECT CASE WHEN l_returnflag = 'R' THEN 'C' || CAST(o_custkey AS VARCHAR)
            ELSE 'S' || CAST(l_suppkey AS VARCHAR) END AS symbol,
       CASE l_returnflag WHEN 'R' THEN s_name WHEN 'A' THEN c_name ELSE p_brand END AS share_holder,
       l_discount * 100 AS share_own_percent, l_orderkey AS seq1, l_linenumber AS seq2
FROM {trades}
"""

VIEWS["subsidiaries"] = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS parent_symbol,
       CASE WHEN l_tax = 0 THEN '' WHEN l_linestatus = 'F' THEN 'P' || CAST(l_partkey AS VARCHAR)
            ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS sub_organ_code,
       CASE WHEN l_linestatus = 'F' THEN p_name ELSE c_name END AS organ_name,
       l_tax * 100 AS ownership_percent, p_type AS type, l_orderkey AS seq1, l_linenumber AS seq2
FROM {trades}
"""

VIEWS["order_facts"] = """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS subject, 'ORDER_STATUS' AS predicate, o_orderstatus AS object,
       o_orderdate AS valid_at, o_orderkey AS seq
FROM orders
"""

VIEWS["docs"] = """
SELECT 'doc' || CAST(doc_id AS VARCHAR) AS name, text AS body, lang, source AS source_description FROM documents
"""

# --- graph tables --------------------------------------------------------------------

VIEWS["defaults"] = """
SELECT symbol, COALESCE(NULLIF(short_name, ''), symbol) AS name, COALESCE(exchange, '') AS exchange,
       COALESCE(market_cap, 0) AS market_cap, COALESCE(no_employees, 0) AS no_employees,
       '' AS established_year, '' AS website, COALESCE(outstanding_share, 0) AS outstanding_share,
       CAST(0 AS DOUBLE) AS foreign_percent
FROM {overview}
"""

# The master's symbols are unique, so its rows are the nodes.
VIEWS["master"] = "SELECT * FROM {defaults}"

VIEWS["links"] = "SELECT DISTINCT symbol, industry FROM {overview} WHERE industry <> ''"

VIEWS["latest_prices"] = """
SELECT symbol, date, open, high, low, close, volume FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, date ORDER BY seq1 DESC, seq2 DESC, open DESC, high DESC,
                               low DESC, close DESC, volume DESC) AS place
  FROM {prices}) WHERE place = 1
"""

VIEWS["stock_prices"] = "SELECT * FROM {latest_prices} WHERE symbol IN (SELECT symbol FROM {master})"

VIEWS["statement_values"] = """
SELECT symbol, statement_type, period, year, quarter, metric, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, statement_type, period, year, quarter, metric
                               ORDER BY seq1 DESC, seq2 DESC, value DESC NULLS LAST) AS place
  FROM (SELECT * REPLACE (COALESCE(quarter, 0) AS quarter) FROM {statements})) WHERE place = 1
AND symbol IN (SELECT symbol FROM {master})
"""

VIEWS["statement_keys"] = "SELECT DISTINCT symbol, statement_type, period, year, quarter FROM {statement_values}"

VIEWS["indicators"] = """
SELECT symbol, metric, year, quarter, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, metric, year, quarter ORDER BY seq DESC) AS place
  FROM {ratios} WHERE value IS NOT NULL) WHERE place = 1 AND symbol IN (SELECT symbol FROM {master})
"""

VIEWS["led_by"] = """
SELECT symbol, officer_name, position, own_percent FROM (
  SELECT symbol, officer_name, officer_position AS position, officer_own_percent AS own_percent,
         ROW_NUMBER() OVER (PARTITION BY symbol, officer_name ORDER BY seq1 DESC, seq2 DESC,
                            officer_position DESC, officer_own_percent DESC) AS place
  FROM {officers} WHERE officer_name <> '') WHERE place = 1 AND symbol IN (SELECT symbol FROM {master})
"""

VIEWS["child_rows"] = """
SELECT child, parent, ownership_percent, relation_type, child_name FROM (
  SELECT sub_organ_code AS child, parent_symbol AS parent, ownership_percent, type AS relation_type,
         organ_name AS child_name,
         ROW_NUMBER() OVER (PARTITION BY sub_organ_code, parent_symbol ORDER BY seq1 DESC, seq2 DESC,
                            ownership_percent DESC, type DESC, organ_name DESC) AS place
  FROM {subsidiaries} WHERE sub_organ_code <> '') WHERE place = 1 AND parent IN (SELECT symbol FROM {master})
"""

VIEWS["child_stubs"] = """
SELECT child AS symbol, child_name AS name FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY child ORDER BY parent) AS place FROM {child_rows})
WHERE place = 1 AND child NOT IN (SELECT symbol FROM {master})
"""

VIEWS["named"] = "SELECT symbol, name FROM {master} UNION ALL SELECT symbol, name FROM {child_stubs}"

VIEWS["resolved"] = """
SELECT COALESCE(n.symbol, h.holder_name) AS holder, h.target, h.stake_percent, h.holder_name,
       n.symbol IS NOT NULL AS resolved
FROM (SELECT share_holder AS holder_name, symbol AS target, share_own_percent AS stake_percent,
             ROW_NUMBER() OVER (PARTITION BY share_holder, symbol ORDER BY seq1 DESC, seq2 DESC,
                                share_own_percent DESC) AS place
      FROM {shareholders} WHERE share_holder <> '') h
LEFT JOIN {named} n ON n.name = h.holder_name
WHERE h.place = 1 AND h.target IN (SELECT symbol FROM {master})
"""

VIEWS["stakes"] = """
SELECT holder, target, stake_percent FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY holder, target ORDER BY holder_name DESC, stake_percent DESC) AS place
  FROM {resolved}) WHERE place = 1
"""

VIEWS["stubs"] = """
SELECT symbol, name FROM {child_stubs}
UNION ALL
SELECT DISTINCT holder, holder FROM {resolved} WHERE NOT resolved AND holder NOT IN (SELECT symbol FROM {named})
"""

VIEWS["company"] = """
SELECT * FROM {master}
UNION ALL
SELECT symbol, name, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM {stubs}
"""

VIEWS["sector_pairs"] = "SELECT DISTINCT industry, sector FROM {overview} WHERE industry <> '' AND sector <> ''"

VIEWS["officer_nodes"] = """
SELECT officer_name, position, own_percent FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY officer_name ORDER BY symbol DESC) AS place FROM {led_by}) WHERE place = 1
"""

VIEWS["relations"] = """
SELECT symbol AS subject, 'BELONGS_TO_INDUSTRY' AS predicate, industry AS object FROM {links}
UNION ALL SELECT industry, 'INDUSTRY_IN_SECTOR', sector FROM {sector_pairs}
UNION ALL SELECT child, 'SUBSIDIARY_OF', parent FROM {child_rows}
UNION ALL SELECT holder, 'HOLDS_STAKE_IN', target FROM {stakes}
UNION ALL SELECT symbol, 'LED_BY', officer_name FROM {led_by}
"""

VIEWS["measurements"] = """
SELECT symbol AS subject, 'HAS_PRICE' AS predicate, CAST(date AS VARCHAR) AS object,
       CAST(date AS TIMESTAMP) AS valid_at FROM {stock_prices}
UNION ALL SELECT symbol, 'HAS_STATEMENT', CONCAT_WS(' ', statement_type, period, year, quarter), NULL
FROM {statement_keys}
UNION ALL SELECT symbol, 'HAS_INDICATOR', CONCAT_WS(' ', metric, year, quarter), NULL FROM {indicators}
"""

_FACTS = """
SELECT sha256(subject || '|' || predicate || '|' || object) AS uuid, subject, predicate, object,
       CASE WHEN s.name <> s.symbol THEN s.name || ' (' || s.symbol || ')' ELSE subject END || ' ' ||
       CASE predicate WHEN 'BELONGS_TO_INDUSTRY' THEN 'belongs to industry'
                      WHEN 'INDUSTRY_IN_SECTOR' THEN 'is an industry in sector'
                      WHEN 'SUBSIDIARY_OF' THEN 'is a subsidiary of'
                      WHEN 'HOLDS_STAKE_IN' THEN 'holds a stake in'
                      WHEN 'LED_BY' THEN 'is led by'
                      WHEN 'HAS_PRICE' THEN 'has a price on'
                      WHEN 'HAS_STATEMENT' THEN 'has a statement'
                      ELSE 'has the indicator' END || ' ' ||
       CASE WHEN o.name <> o.symbol THEN o.name || ' (' || o.symbol || ')' ELSE object END AS fact,
       valid_at, CAST(NULL AS TIMESTAMP) AS invalid_at, 'load:' || lower(predicate) AS episode_name
FROM (%s) r LEFT JOIN {company} s ON s.symbol = subject LEFT JOIN {company} o ON o.symbol = object
"""

VIEWS["all_edges"] = (
    "SELECT *, CAST(NULL AS TIMESTAMP) AS valid_at FROM {relations} UNION ALL SELECT * FROM {measurements}"
)

VIEWS["all_facts"] = _FACTS % "SELECT * FROM {all_edges}"

VIEWS["validity"] = """
SELECT *, LEAD(valid_at) OVER (PARTITION BY subject, predicate ORDER BY valid_at, seq) AS invalid_at
FROM {order_facts}
"""

VIEWS["both_ways"] = """
SELECT DISTINCT src, dst FROM (SELECT subject AS src, object AS dst FROM {all_edges}
                               UNION ALL SELECT object, subject FROM {all_edges}) WHERE src <> dst
"""

VIEWS["entities"] = """
SELECT sha256('Company|' || symbol) AS uuid, name,
       CONCAT_WS(' ', 'Company', symbol, NULLIF(exchange, '')) AS summary FROM {company}
UNION ALL SELECT DISTINCT sha256('Industry|' || industry), industry, 'Industry' FROM {overview} WHERE industry <> ''
UNION ALL SELECT DISTINCT sha256('Sector|' || sector), sector, 'Sector' FROM {overview} WHERE sector <> ''
UNION ALL SELECT sha256('Officer|' || officer_name), officer_name, CONCAT_WS(' ', 'Officer', position)
FROM {officer_nodes}
UNION ALL SELECT sha256(CONCAT_WS('|', 'StockPrice', symbol, date)), CONCAT_WS(' ', symbol, date), 'StockPrice'
FROM {stock_prices}
UNION ALL SELECT sha256(CONCAT_WS('|', 'FinancialStatement', symbol, statement_type, period, year, quarter)),
                 CONCAT_WS(' ', symbol, statement_type, period, year, quarter), 'FinancialStatement' FROM {statement_keys}
UNION ALL SELECT sha256(CONCAT_WS('|', 'FinancialIndicator', symbol, metric, year, quarter)),
                 CONCAT_WS(' ', symbol, metric, year, quarter), 'FinancialIndicator' FROM {indicators}
"""


def _words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\p{{{{L}}}}\\p{{{{N}}}}]+')"


def _bm25(prefix: str, corpus: str, queries: str) -> None:
    """Views of a BM25 ranking: {prefix}_scores over (item, text) and (query_id, text)."""
    VIEWS[f"{prefix}_asked"] = f"SELECT DISTINCT query_id, unnest({_words('text')}) AS word FROM {{{queries}}}"
    VIEWS[f"{prefix}_items"] = f"SELECT item, {_words('text')} AS words FROM {{{corpus}}}"
    VIEWS[f"{prefix}_size"] = f"SELECT count(*) AS n, avg(len(words)) AS mean FROM {{{prefix}_items}}"
    VIEWS[f"{prefix}_tf"] = (
        f"SELECT item, length, word, count(*) AS tf FROM "
        f"(SELECT item, len(words) AS length, unnest(words) AS word FROM {{{prefix}_items}}) "
        f"WHERE word IN (SELECT word FROM {{{prefix}_asked}}) GROUP BY ALL"
    )
    VIEWS[f"{prefix}_idf"] = (
        f"SELECT word, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf "
        f"FROM (SELECT word, count(*) AS df FROM {{{prefix}_tf}} GROUP BY word), {{{prefix}_size}}"
    )
    VIEWS[f"{prefix}_scores"] = (
        f"SELECT query_id, item, round(sum(idf * tf * 2.2 / "
        f"(tf + 1.2 * (0.25 + CAST(0.75 AS DOUBLE) * length / mean))), 6) AS score "
        f"FROM {{{prefix}_tf}} JOIN {{{prefix}_asked}} USING (word) JOIN {{{prefix}_idf}} USING (word), "
        f"{{{prefix}_size}} GROUP BY query_id, item"
    )


def _ranks(scores: str) -> str:
    """The whole list, not cut."""
    return f"SELECT query_id, item, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, item) AS rank FROM {{{scores}}}"


def _shared_ranks(scores: str, kind: str) -> str:
    return f"SELECT query_id, item, {kind}() OVER (PARTITION BY query_id ORDER BY score DESC) AS rank FROM {{{scores}}}"


def _top(scores: str, k: int, item: str = "item") -> str:
    return (
        f"SELECT query_id, {item}, score, CAST(rank AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER "
        f"(PARTITION BY query_id ORDER BY score DESC, {item}) AS rank FROM {{{scores}}}) WHERE rank <= {k}"
    )


def _cosine(a: str, b: str) -> str:
    return f"round(list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), 6)"


def _fused(*ranked: str) -> str:
    rows = " UNION ALL ".join(f"SELECT query_id, item, rank FROM {{{r}}}" for r in ranked)
    return f"SELECT query_id, item, round(sum(CAST(1 AS DOUBLE) / (60 + rank)), 6) AS score FROM ({rows}) GROUP BY ALL"


VIEWS["bench_texts"] = "SELECT item_id AS query_id, text FROM benchmark"
VIEWS["doc_texts"] = "SELECT doc_id AS item, text FROM documents"
VIEWS["questions"] = (
    "SELECT item_id AS query_id, text, embedding FROM benchmark JOIN embeddings ON item_id = vec_id"
)
_bm25("bench", "doc_texts", "bench_texts")
_bm25("hybrid", "doc_texts", "questions")
VIEWS["vector_scores"] = (
    f"SELECT query_id, vec_id AS item, {_cosine('e.embedding', 'q.embedding')} AS score "
    "FROM embeddings e, {questions} q"
)
VIEWS["hybrid_text_ranks"] = _ranks("hybrid_scores")
VIEWS["hybrid_vector_ranks"] = _ranks("vector_scores")
VIEWS["hybrid_fused"] = _fused("hybrid_text_ranks", "hybrid_vector_ranks")

VIEWS["node_questions"] = """
SELECT n_name AS query_id, n_name || ' ' || r_name AS text FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT DISTINCT c_mktsegment, c_mktsegment FROM customer
UNION ALL SELECT DISTINCT o_orderpriority, o_orderpriority FROM orders
"""
VIEWS["entity_texts"] = "SELECT uuid AS item, name || ' ' || summary AS text FROM {entities}"
_bm25("entity", "entity_texts", "node_questions")
VIEWS["entity_ranks"] = _top("entity_scores", 10)

VIEWS["company_vectors"] = "SELECT 'C' || CAST(vec_id AS VARCHAR) AS node, embedding FROM embeddings"
VIEWS["fact_seeds"] = """
SELECT sector, symbol AS seed, short_name, embedding
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sector ORDER BY market_cap DESC, symbol DESC) AS place
      FROM {overview} JOIN {company_vectors} ON symbol = node WHERE market_cap IS NOT NULL) WHERE place = 1
"""
VIEWS["fact_questions"] = """
SELECT sector AS query_id, seed, CONCAT_WS(' ', 'subsidiary or stake or indicator of', seed, short_name) AS text, embedding
FROM {fact_seeds}
UNION ALL SELECT sector || ' prices', seed, 'price on 1998-06-15', embedding FROM {fact_seeds}
"""
VIEWS["fact_texts"] = "SELECT uuid AS item, fact AS text FROM {all_facts}"
_bm25("fact", "fact_texts", "fact_questions")
VIEWS["fact_text_ranks"] = _shared_ranks("fact_scores", "RANK")
VIEWS["fact_reached"] = """
SELECT query_id, seed AS node, 0 AS distance FROM {fact_questions}
UNION ALL SELECT query_id, dst, 1 FROM {fact_questions} JOIN {both_ways} ON src = seed
"""
VIEWS["fact_near"] = """
SELECT query_id, item, -CAST(min(distance) AS DOUBLE) AS score FROM (
  SELECT query_id, uuid AS item, distance FROM {fact_reached} JOIN {all_facts} ON node = subject
  UNION ALL SELECT query_id, uuid, distance FROM {fact_reached} JOIN {all_facts} ON node = object) GROUP BY query_id, item
"""
VIEWS["fact_near_ranks"] = _shared_ranks("fact_near", "DENSE_RANK")
VIEWS["fact_subjects"] = (
    f"SELECT query_id, node AS item, {_cosine('v.embedding', 'q.embedding')} AS score "
    "FROM {company_vectors} v, {fact_questions} q WHERE node IN (SELECT subject FROM {all_facts})"
)
VIEWS["fact_subject_ranks"] = _shared_ranks("fact_subjects", "RANK")
VIEWS["fact_similar_ranks"] = (
    "SELECT query_id, uuid AS item, rank FROM {all_facts} JOIN {fact_subject_ranks} s ON subject = s.item"
)
VIEWS["fact_fused"] = _fused("fact_text_ranks", "fact_near_ranks", "fact_similar_ranks")
VIEWS["fact_hits"] = _top("fact_fused", 10)

# --- queries: scans ------------------------------------------------------------------

SQL["scan_symbols"] = "SELECT symbol FROM {overview}"
SQL["scan_overview"] = """
SELECT symbol, exchange, industry, CAST(NULL AS BIGINT) AS no_shareholders, CAST(NULL AS DOUBLE) AS foreign_percent,
       outstanding_share, CAST(NULL AS DOUBLE) AS issue_share, CAST(NULL AS VARCHAR) AS established_year, no_employees,
       short_name, CAST(NULL AS VARCHAR) AS website, market_cap FROM {overview}
"""
SQL["scan_price_range"] = (
    f"SELECT symbol, date, open, high, low, close, volume FROM {{raw_prices}} WHERE {RANGE} ORDER BY symbol, date"
)
SQL["scan_ratios"] = "SELECT * FROM {ratios} ORDER BY symbol, year DESC, quarter DESC"
SQL["scan_officers"] = "SELECT symbol, officer_name, officer_position, officer_own_percent FROM {officers}"
SQL["scan_shareholders"] = "SELECT share_holder, symbol, share_own_percent FROM {shareholders}"
SQL["scan_stats"] = (
    "SELECT seq AS id, symbol, pe, roe, CAST(NULL AS BIGINT) AS eps, "
    + ", ".join(
        f"CAST(NULL AS DOUBLE) AS {c}"
        for c in "roa ev_ebitda dividend_yield gross_margin net_margin doe alpha beta pb ps ev rsi14".split()
    )
    + " FROM {wide_ratios}"
)
SQL["scan_statement"] = (
    "SELECT * FROM {statements} WHERE statement_type = 'balance_sheet' AND period = 'quarter' "
    "ORDER BY symbol, year DESC, quarter DESC"
)
SQL["decimal_to_double"] = "SELECT * REPLACE (CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value) FROM {ratios}"
SQL["project_schema"] = """
SELECT CAST(NULL AS INT) AS id, symbol, year, quarter, metric, value, CAST(NULL AS TIMESTAMP) AS updated_at FROM {ratios}
"""
SQL["scan_extract_prices"] = "SELECT symbol, date, open, high, low, close, volume FROM {prices}"
SQL["optional_source_empty"] = SQL["scan_extract_prices"]

# --- projections and filters ---------------------------------------------------------

SQL["filter_symbols"] = "SELECT * FROM {overview} WHERE symbol IN (SELECT symbol FROM {prices})"
SQL["normalise_prices"] = "SELECT symbol, time AS date, open, high, low, close, volume, seq1, seq2 FROM {raw_prices}"
SQL["inject_symbol"] = (
    "SELECT 'VNINDEX' AS symbol, time AS date, open, high, low, close, volume, seq1, seq2 FROM {raw_prices}"
)
SQL["company_defaults"] = "SELECT * FROM {defaults}"
SQL["drop_blank_keys"] = "SELECT * FROM {subsidiaries} WHERE sub_organ_code IS NOT NULL AND sub_organ_code <> ''"
SQL["indicator_try_cast"] = """
SELECT symbol, seq, TRY_CAST(pe AS DOUBLE) AS pe, TRY_CAST(trim(eps) AS DOUBLE) AS eps,
       TRY_CAST(note AS DOUBLE) AS note FROM {wide_ratios}
"""
SQL["coerce_prices"] = "SELECT * FROM {prices}"
SQL["price_day_key"] = """
SELECT symbol AS ticker, seq1, seq2, date AS of_time, date AS of_text, date AS of_day FROM {raw_prices}
"""
SQL["statement_quarter"] = """
SELECT symbol, statement_type, period, year, COALESCE(quarter, 0) AS quarter, count(*) AS rows
FROM {statements} GROUP BY ALL
"""
SQL["price_history_range"] = f"SELECT * FROM {{stock_prices}} WHERE {RANGE} ORDER BY symbol, date"
SQL["price_lookback"] = f"SELECT * FROM {{prices}} WHERE date BETWEEN {AS_OF} - INTERVAL 730 DAY AND {AS_OF}"
SQL["price_as_of_day"] = f"SELECT * FROM {{prices}} WHERE date = {AS_OF}"
SQL["statement_payload"] = "SELECT * FROM {statement_values} WHERE value IS NOT NULL"

# --- joins ---------------------------------------------------------------------------

SQL["prices_known_companies"] = "SELECT * FROM {prices} WHERE symbol IN (SELECT symbol FROM {master})"
_PEERS = """
SELECT a.symbol, b.symbol AS peer_symbol, c.name AS peer_name, c.market_cap,
       CAST(ROW_NUMBER() OVER (PARTITION BY a.symbol ORDER BY c.market_cap DESC, b.symbol) AS INT) AS rank
FROM {links} a JOIN {links} b ON a.industry = b.industry AND a.symbol <> b.symbol JOIN {company} c ON c.symbol = b.symbol
"""
SQL["peers"] = f"SELECT * FROM ({_PEERS}) WHERE rank <= 20"
SQL["peers_one"] = f"""
SELECT peer_symbol AS symbol, peer_name AS name, market_cap FROM ({_PEERS})
WHERE rank <= 20 AND symbol = (SELECT symbol FROM {{company}} ORDER BY market_cap DESC NULLS LAST, symbol LIMIT 1)
ORDER BY market_cap DESC, symbol
"""
SQL["subsidiaries"] = """
SELECT parent AS symbol, child AS sub_symbol, name AS sub_name, ownership_percent AS ownership_pct,
       relation_type AS rel_type
FROM {child_rows} JOIN {company} ON symbol = child
"""
SQL["shareholders"] = """
SELECT target AS symbol, name AS holder_name, holder AS holder_symbol, stake_percent AS stake_pct
FROM {stakes} JOIN {company} ON symbol = holder ORDER BY target, stake_pct DESC
"""
SQL["price_history"] = "SELECT * FROM {stock_prices} ORDER BY symbol, date"
SQL["indicators"] = "SELECT symbol, metric, value, year, quarter FROM {indicators} ORDER BY symbol, year DESC, quarter DESC"
SQL["indicators_latest"] = """
SELECT symbol, metric, value, year, quarter FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, metric ORDER BY year DESC, quarter DESC) AS place
  FROM {indicators}) WHERE place = 1
"""
for _name in ("subsidiaries", "shareholders", "price_history", "indicators"):
    _rows = SQL[_name].split("ORDER BY")[0]
    SQL[f"{_name}_one"] = f"SELECT * FROM ({_rows}) WHERE symbol = (SELECT min(symbol) FROM ({_rows}))"
SQL["extract_officers"] = SQL["scan_officers"] + " WHERE officer_own_percent > 0"
SQL["extract_shareholders"] = SQL["scan_shareholders"]
SQL["extract_subsidiaries"] = """
SELECT parent_symbol, CAST(NULL AS VARCHAR) AS id, sub_organ_code, ownership_percent, organ_name, type FROM {subsidiaries}
"""
SQL["extract_listing"] = "SELECT symbol, exchange FROM {listing}"
SQL["extract_overview"] = SQL["scan_overview"].replace("market_cap FROM", "market_cap, sector FROM")
SQL["extract_statement"] = """
SELECT symbol, statement_type, period, year, quarter, metric, value FROM {statement_values}
WHERE statement_type = 'balance_sheet' AND period = 'quarter' AND value IS NOT NULL
"""
SQL["cross_shareholding"] = """
SELECT a.holder AS symbol_a, a.target AS symbol_b, a.stake_percent AS a_holds_b_pct, b.stake_percent AS b_holds_a_pct
FROM {stakes} a JOIN {stakes} b ON a.holder = b.target AND a.target = b.holder
WHERE a.holder <> a.target ORDER BY symbol_a, symbol_b LIMIT 50
"""
_HOSE = "(SELECT symbol FROM {overview} WHERE exchange = 'HOSE')"
SQL["fallback_prices"] = f"""
SELECT *, CASE WHEN symbol IN {_HOSE} THEN 'primary' ELSE 'secondary' END AS origin FROM {{prices}}
"""
SQL["fallback_overview"] = "SELECT symbol, exchange FROM {overview}"
SQL["source_chain"] = """
SELECT * FROM (
  SELECT symbol, exchange, 1 AS priority FROM {overview} WHERE exchange = 'HOSE'
  UNION ALL SELECT symbol, 'ASIA', 2 FROM {overview} WHERE sector = 'ASIA'
  UNION ALL SELECT symbol, exchange, 3 FROM {listing})
QUALIFY priority = min(priority) OVER (PARTITION BY symbol)
"""
SQL["resolve_holders"] = "SELECT * FROM {resolved}"
SQL["stub_companies"] = "SELECT * FROM {stubs}"

# --- aggregation and reshaping -------------------------------------------------------

_STATS = """
SELECT (SELECT count(*) FROM {company}) AS companies, (SELECT count(*) FROM {stock_prices}) AS stock_prices,
       (SELECT count(DISTINCT symbol) FROM {stock_prices}) AS stock_price_symbols,
       (SELECT count(*) FROM {statement_keys}) AS financial_statements,
       (SELECT count(*) FROM {indicators}) AS financial_indicators
"""
SQL["graph_stats"] = _STATS
SQL["statement_pivot"] = (
    "SELECT symbol, statement_type, period, year, quarter, "
    + ", ".join(f"max(value) FILTER (metric = '{s}{n}') AS {s}{n}" for s in "FO" for n in range(1, 8))
    + " FROM {statement_values} GROUP BY ALL"
)
SQL["ratio_unpivot"] = """
SELECT symbol, year, quarter, seq, 'pe' AS metric, pe AS value FROM {wide_ratios} WHERE pe IS NOT NULL
UNION ALL SELECT symbol, year, quarter, seq, 'roe', roe FROM {wide_ratios} WHERE roe IS NOT NULL
UNION ALL SELECT symbol, year, quarter, seq, 'eps', CAST(trim(eps) AS DOUBLE) FROM {wide_ratios} WHERE eps IS NOT NULL
"""
SQL["extract_ratios"] = f"SELECT symbol, year, quarter, metric, value FROM ({SQL['ratio_unpivot']})"
SQL["upsert_last_wins"] = "SELECT * FROM {latest_prices}"
SQL["industries"] = "SELECT DISTINCT industry AS name FROM {overview} WHERE industry <> ''"
SQL["ingest_audit"] = """
SELECT a.symbol, CAST(COALESCE(p.n, 0) AS BIGINT) AS prices, CAST(COALESCE(s.n, 0) AS BIGINT) AS statements,
       CAST(COALESCE(r.n, 0) AS BIGINT) AS ratios, CAST(COALESCE(o.n, 0) AS BIGINT) AS officers,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS subsidiaries, CAST(COALESCE(h.n, 0) AS BIGINT) AS shareholders,
       a.symbol IN (SELECT symbol FROM {master}) AS known
FROM (SELECT symbol FROM {listing} UNION SELECT symbol FROM {overview}) a
LEFT JOIN (SELECT symbol, count(*) AS n FROM {prices} GROUP BY 1) p ON p.symbol = a.symbol
LEFT JOIN (SELECT symbol, count(DISTINCT (statement_type, period, year, COALESCE(quarter, 0))) AS n
           FROM {statements} GROUP BY 1) s ON s.symbol = a.symbol
LEFT JOIN (SELECT symbol, count(*) AS n FROM {ratios} GROUP BY 1) r ON r.symbol = a.symbol
LEFT JOIN (SELECT symbol, count(*) AS n FROM {officers} GROUP BY 1) o ON o.symbol = a.symbol
LEFT JOIN (SELECT parent_symbol, count(*) AS n FROM {subsidiaries} GROUP BY 1) c ON c.parent_symbol = a.symbol
LEFT JOIN (SELECT symbol, count(*) AS n FROM {shareholders} GROUP BY 1) h ON h.symbol = a.symbol
"""
SQL["rejected_rows"] = """
SELECT 'officers' AS extract, 'officer_name' AS missing, count(*) AS rows FROM {officers} WHERE officer_name = ''
HAVING count(*) > 0
UNION ALL
SELECT 'subsidiaries', 'sub_organ_code', count(*) FROM {subsidiaries} WHERE sub_organ_code = '' HAVING count(*) > 0
"""
SQL["loaded_symbols"] = "SELECT DISTINCT symbol FROM {prices} WHERE trim(symbol) <> ''"
SQL["price_tail"] = """
SELECT symbol, date, open, high, low, close, volume FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date DESC) AS place FROM {stock_prices}) WHERE place <= 30
"""

# --- graph tables --------------------------------------------------------------------

SQL["company_nodes"] = "SELECT * FROM {company}"
SQL["industry_links"] = "SELECT * FROM {links}"
SQL["sectors"] = "SELECT DISTINCT sector AS name FROM {overview}"
SQL["industry_in_sector"] = "SELECT * FROM {sector_pairs}"
SQL["stock_prices"] = "SELECT * FROM {stock_prices}"
VIEWS["statement_texts"] = """
SELECT symbol, statement_type, period, year, quarter,
       COALESCE(string_agg(metric || '=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY metric)
                FILTER (value IS NOT NULL), '') AS payload
FROM {statement_values} GROUP BY ALL
"""
SQL["statement_nodes"] = """
SELECT symbol, statement_type, period, year, quarter, CAST(count(value) AS INT) AS metrics,
       COALESCE(string_agg(metric || '=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY metric)
                FILTER (value IS NOT NULL), '') AS payload
FROM {statement_values} GROUP BY ALL
"""
SQL["indicator_nodes"] = "SELECT * FROM {indicators}"
SQL["indicator_nodes_wide"] = f"""
SELECT symbol, metric, year, quarter, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, metric, year, quarter ORDER BY seq DESC) AS place
  FROM ({SQL["ratio_unpivot"]})) WHERE place = 1 AND symbol IN (SELECT symbol FROM {{master}})
"""
SQL["officer_nodes"] = "SELECT * FROM {officer_nodes}"
SQL["led_by"] = "SELECT * FROM {led_by}"
SQL["subsidiary_edges"] = "SELECT child, parent, ownership_percent, relation_type FROM {child_rows}"
SQL["stake_edges"] = "SELECT * FROM {stakes}"

# --- load flows ----------------------------------------------------------------------

SQL["resolve_symbols"] = "SELECT DISTINCT symbol FROM {listing}"
SQL["daily_upsert"] = f"""
SELECT * FROM {{stock_prices}} WHERE date <> {AS_OF}
UNION ALL
SELECT symbol, date, open, high, low, close, volume FROM (
  SELECT * REPLACE (high AS close), ROW_NUMBER() OVER (PARTITION BY symbol, date ORDER BY seq1 DESC, seq2 DESC,
    open DESC, high DESC, low DESC, close DESC, volume DESC) AS place FROM {{prices}} WHERE date = {AS_OF})
WHERE place = 1 AND symbol IN (SELECT symbol FROM {{master}})
"""
SQL["graph_merge"] = f"""
SELECT symbol, date, open, high, low, CASE WHEN symbol IN {_HOSE} THEN high ELSE close END AS close, volume
FROM {{stock_prices}}
"""
SQL["rejected_measures"] = """
SELECT 'prices' AS extract, 'volume' AS missing, seq1, seq2 FROM {raw_prices} WHERE close IS NULL
"""
SQL["stream_graph"] = """
WITH lines AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS open,
         l_extendedprice * 2 AS high, l_extendedprice / 2 AS low, CAST(l_quantity AS BIGINT) AS volume,
         l_linenumber % 3 AS file, l_orderkey AS seq1, l_linenumber AS seq2
  FROM lineitem WHERE l_returnflag = 'R'),
streamed AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, date ORDER BY file DESC, seq1 DESC, seq2 DESC, open DESC, high DESC,
                                 low DESC, volume DESC) AS place
    FROM lines WHERE symbol IN (SELECT symbol FROM {master})) WHERE place = 1)
SELECT symbol, date, open, high, low, high AS close, volume FROM streamed
UNION ALL SELECT * FROM {stock_prices} p WHERE NOT EXISTS (
  SELECT 1 FROM streamed s WHERE s.symbol = p.symbol AND s.date = p.date)
"""
SQL["stream_upsert"] = "SELECT * FROM {stock_prices}"

# --- episodes, facts, search ---------------------------------------------------------

SQL["episodes_text"] = f"""
SELECT name, body, 'text' AS source, {LOAD_TIME} AS reference_time, source_description, 'market_facts' AS group_id
FROM {{docs}}
"""
SQL["episodes_stored"] = f"""
SELECT e.*, load_id FROM ({SQL["episodes_text"]}) e, (VALUES ('first'), ('second')) t(load_id)
"""
SQL["episodes_json"] = f"""
SELECT symbol AS name, {LOAD_TIME} AS reference_time, 'market' AS source_description, 'market_facts' AS group_id,
       name AS title, exchange, market_cap FROM {{company}}
"""
SQL["edge_facts"] = "SELECT * FROM {all_facts}"
SQL["fact_validity"] = "SELECT * FROM {validity}"
SQL["validity_merge"] = SQL["fact_validity"]
SQL["facts_at_moments"] = """
SELECT l_orderkey, l_linenumber, 'C' || CAST(o_custkey AS VARCHAR) AS subject, l_shipdate AS moment, f.object, f.valid_at, f.seq
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
ASOF LEFT JOIN (SELECT * FROM {order_facts} QUALIFY row_number() OVER (PARTITION BY subject, valid_at ORDER BY seq DESC) = 1) f
  ON f.subject = 'C' || CAST(o_custkey AS VARCHAR) AND f.valid_at <= l_shipdate
"""
SQL["facts_as_of"] = f"""
SELECT * FROM {{validity}} WHERE valid_at <= {MOMENT} AND (invalid_at IS NULL OR {MOMENT} < invalid_at)
"""
SQL["fact_provenance"] = f"""
SELECT sha256(name || '|' || lang) AS uuid, source_description AS subject, 'WRITTEN_IN' AS predicate, lang AS object,
       name AS episode_name, 'text' AS episode_source, {LOAD_TIME} AS reference_time, source_description,
       sha256(body) AS body
FROM {{docs}}
"""
SQL["bm25_topk"] = f"SELECT query_id, item AS item_id, score, rank FROM ({_top('bench_scores', 10)})"
SQL["vector_topk"] = f"SELECT query_id, item AS item_id, score, rank FROM ({_top('vector_scores', 10)})"
SQL["bm25_stored"] = SQL["bm25_topk"]
SQL["vector_index_topk"] = SQL["vector_topk"]
SQL["hybrid_topk"] = f"SELECT query_id, item AS item_id, score, rank FROM ({_top('hybrid_fused', 10)})"
SQL["khop"] = """
WITH seeds AS (
  SELECT symbol AS seed FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY sector ORDER BY market_cap DESC, symbol DESC) AS place
    FROM {overview} WHERE market_cap IS NOT NULL) WHERE place = 1),
one AS (SELECT seed, dst AS node FROM seeds JOIN {both_ways} ON src = seed),
two AS (SELECT seed, dst AS node FROM one JOIN {both_ways} ON src = node)
SELECT seed, node, CAST(min(distance) AS INT) AS distance FROM (
  SELECT seed, seed AS node, 0 AS distance FROM seeds
  UNION ALL SELECT seed, node, 1 FROM one UNION ALL SELECT DISTINCT seed, node, 2 FROM two) GROUP BY seed, node
"""
SQL["node_search"] = """
SELECT query_id, rank, uuid, name, summary, score FROM {entity_ranks} JOIN {entities} ON uuid = item
"""
SQL["fact_search"] = """
SELECT query_id, rank, fact, strftime(valid_at, '%Y-%m-%dT%H:%M:%S') AS valid_at,
       strftime(invalid_at, '%Y-%m-%dT%H:%M:%S') AS invalid_at, uuid, score
FROM {fact_hits} JOIN {all_facts} ON uuid = item
"""

# The subset load is the full one over extracts of some symbols.
_SUBSET = {
    "overview": "symbol",
    "raw_prices": "symbol",
    "ratios": "symbol",
    "statements": "symbol",
    "officers": "symbol",
    "shareholders": "symbol",
    "subsidiaries": "parent_symbol",
}

_NAME = re.compile(r"\{([a-z_0-9]+)\}")


def _needed(sql: str, views: dict[str, str]) -> list[str]:
    """The views a query stands on, each after those it uses itself."""
    done: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name not in done:
                visit(views[name])
                if name not in done:
                    done.append(name)

    visit(sql)
    return done


def _plain(sql: str) -> str:
    return _NAME.sub(lambda m: f"v_{m.group(1)}", sql).replace("{{", "{").replace("}}", "}")


def expand(sql: str, views: dict[str, str] = VIEWS) -> str:
    names = _needed(sql, views)
    if not names:
        return _plain(sql).strip()
    ctes = ",\n".join(f"v_{n} AS MATERIALIZED ({_plain(views[n]).strip()})" for n in names)
    return f"WITH {ctes}\nSELECT * FROM (\n{_plain(sql).strip()}\n)"


def _subset_views() -> dict[str, str]:
    views = dict(VIEWS)
    views["hose"] = "SELECT symbol FROM {all_overview} WHERE exchange = 'HOSE'"
    for name, key in _SUBSET.items():
        views[f"all_{name}"] = VIEWS[name]
        views[name] = f"SELECT * FROM {{all_{name}}} WHERE {key} IN (SELECT symbol FROM {{hose}})"
    return views


# --- two loads, the second of one exchange's companies with other values ---------------------------------

_SECOND = {
    "raw_prices": "close",
    "officers": "officer_own_percent",
    "shareholders": "share_own_percent",
}
_CHANGED = {"raw_prices": "high", "officers": "officer_own_percent + 1", "shareholders": "share_own_percent / 2"}


def _second_views() -> dict[str, str]:
    """All views, and those of the second load under names with `second_` in front."""
    views = dict(VIEWS)
    second = lambda sql: _NAME.sub(lambda m: f"{{second_{m.group(1)}}}", sql)
    for name, sql in VIEWS.items():
        views[f"second_{name}"] = second(sql)
    for name, key in _SUBSET.items():
        rows = f"SELECT * FROM {{{name}}} WHERE {key} IN {_HOSE}"
        if name in _SECOND:
            rows = f"SELECT * REPLACE ({_CHANGED[name]} AS {_SECOND[name]}) FROM ({rows})"
        views[f"second_{name}"] = rows
    return views


_CENTS = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"
# view, key columns, value of each stored table
_TABLES = {
    "company": ("{company}", ("symbol",), "CAST(market_cap AS VARCHAR)"),
    "industry": ("(SELECT DISTINCT industry AS name FROM {overview} WHERE industry <> '')", ("name",), "''"),
    "sector": ("(SELECT DISTINCT sector AS name FROM {overview} WHERE sector <> '')", ("name",), "''"),
    "stock_price": (
        "{stock_prices}", ("symbol", "date"), f"CONCAT_WS(' ', {_CENTS.format('close')}, CAST(volume AS VARCHAR))",
    ),
    "financial_statement": (
        "{statement_texts}", ("symbol", "statement_type", "period", "year", "quarter"), "payload",
    ),
    "financial_indicator": ("{indicators}", ("symbol", "metric", "year", "quarter"), _CENTS.format("value")),
    "officer": ("{officer_nodes}", ("officer_name",), f"CONCAT_WS(' ', position, {_CENTS.format('own_percent')})"),
    "belongs_to_industry": ("{links}", ("symbol", "industry"), "''"),
    "industry_in_sector": ("{sector_pairs}", ("industry", "sector"), "''"),
    "subsidiary_of": (
        "{child_rows}", ("child", "parent"), f"CONCAT_WS(' ', {_CENTS.format('ownership_percent')}, relation_type)",
    ),
    "holds_stake_in": ("{stakes}", ("holder", "target"), _CENTS.format("stake_percent")),
    "led_by": ("{led_by}", ("symbol", "officer_name"), f"CONCAT_WS(' ', position, {_CENTS.format('own_percent')})"),
}


def _stored_twice() -> str:
    parts = []
    for table, (view, keys, value) in _TABLES.items():
        key = f"CONCAT_WS('|', {', '.join(keys)})"
        stub = "exchange IS NULL" if table == "company" else "FALSE"
        for load, of in ((1, view), (2, _NAME.sub(lambda m: f"{{second_{m.group(1)}}}", view))):
            parts.append(
                f"SELECT '{table}' AS \"table\", {key} AS key, COALESCE({value}, '') AS value, {load} AS load, {stub} AS stub FROM {of}"
            )
    return (
        " UNION ALL ".join(parts).join(("SELECT * FROM (", ")"))
        + ' QUALIFY row_number() OVER (PARTITION BY "table", key ORDER BY stub, CASE WHEN stub THEN -load ELSE load END DESC) = 1'
    )


# An edge is of the second load if that has its key.
_FACT_LOADS = f"""
SELECT sha256(subject || '|' || predicate || '|' || object) AS uuid, subject, predicate, object,
       'load:' || CAST(load AS VARCHAR) AS episode_name,
       CASE load WHEN 1 THEN {LOAD_TIME} ELSE TIMESTAMP '2001-02-01 00:00:00' END AS reference_time
FROM (SELECT subject, predicate, object, max(load) AS load FROM (
        SELECT subject, predicate, object, 1 AS load FROM {{all_edges}}
        UNION ALL SELECT subject, predicate, object, 2 FROM {{second_all_edges}}) GROUP BY ALL)
"""


def oracle_sql() -> dict[str, str]:
    found = {name: expand(sql) for name, sql in SQL.items()}
    found["subset_load"] = expand(_STATS, _subset_views())
    views = _second_views() | {"stored_twice": _stored_twice()}
    found["graph_merge_tables"] = expand('SELECT "table", key, value FROM {stored_twice}', views)
    found["edge_fact_loads"] = expand(_FACT_LOADS, views)
    return found
