"""SQL twins of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

from quarterdeck.functions import report
from quarterdeck.functions.text import EMAIL_MARK, EMAIL_PATTERN, PHONE_MARK, PHONE_PATTERN, WHITESPACE
from quarterdeck.params import BLOCKED_TOPICS, RETRIEVAL_QUERIES
from quarterdeck.plans.bindings import LETTERS, MARKET_SEGMENTS, RIVALS, THEMES, TONE


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def money(column: str) -> str:
    """Exact sum of the amounts as written; a direct cast of a double here misses its last digits."""
    return f"CAST(sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL(28, 10))) AS DOUBLE)"


SEGMENT_LIST = ", ".join(q(s) for s in MARKET_SEGMENTS)
YEAR_QUARTERS = [*(f"{y}-Q{n}" for y in range(1995, 2001) for n in range(1, 5)), "2001-Q1", "2001-Q2", "2001-Q3"]

# Twins of the functions in ``bindings``.
VIEWS = {
    "sales": """
        SELECT CAST(o_orderdate AS DATE) AS order_date, c_mktsegment AS segment, p_brand AS product,
               r_name AS region, n_name AS subregion,
               l_extendedprice * (1 - l_discount) AS sales,
               l_extendedprice * (CAST(0.05 AS DOUBLE) - l_discount) AS profit,
               CAST(l_quantity AS INTEGER) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey""",
    "bookings": """
        SELECT o_orderkey AS opportunity_id, c_mktsegment AS segment,
               CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
               o_totalprice AS booked_arr, CAST(o_orderkey % 13 AS DOUBLE) AS benchmark_growth_pct,
               CAST(o_custkey % 14 AS DOUBLE) AS actual_growth_pct
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "opps": f"""
        SELECT o_orderkey AS opportunity_id, c_mktsegment AS segment, c_name AS account_name, o_totalprice AS arr,
               CASE o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'P' THEN 'Closed Lost' ELSE 'Proposal' END AS stage,
               CASE WHEN o_orderstatus = 'F' THEN 'Won on product fit'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'Lost due to missing feature'
                    WHEN o_orderstatus = 'P' THEN ' Lost to '
                      || [{", ".join(q(r) for r in RIVALS)}][CAST(o_orderkey % 4 + 1 AS INTEGER)] || ' on '
                      || [{", ".join(q(t) for t in THEMES)}][CAST((o_orderkey // 4) % 2 + 1 AS INTEGER)]
               END AS win_loss_reason
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "benchmarks": """
        SELECT c_mktsegment AS segment,
               round(sum(CAST(round(c_acctbal * 100) AS BIGINT)) / CAST(count(*) AS DOUBLE) / CAST(100000 AS DOUBLE), 2)
                 AS benchmark_growth_pct
        FROM customer GROUP BY 1""",
    "deal_rows": """
        SELECT 'DEAL-' || CAST(o_custkey AS VARCHAR) AS deal_id, o_orderstatus AS stage,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS close_date, CAST(trunc(o_totalprice) AS BIGINT) AS arr,
               o_orderpriority AS rep_name, 'Account ' || CAST(o_custkey AS VARCHAR) AS account_name,
               o_orderkey AS ordinal
        FROM orders""",
    "activity": """
        SELECT 'DEAL-' || CAST(user_id AS VARCHAR) AS deal_id, event_type AS activity_type,
               CAST(ts AS DATE) - CAST(user_id % 30 AS INTEGER) AS activity_date
        FROM events""",
    "transcripts": """
        SELECT 'DEAL-' || CAST(conv_id AS VARCHAR) AS deal_id,
               CAST(DATE '2024-01-01' + CAST((turn // 2 + 1) * 7 AS INTEGER) AS VARCHAR) AS call_date,
               CAST(turn // 2 + 1 AS INTEGER) AS call_num, CAST(turn % 2 + 1 AS INTEGER) AS turn_num,
               CASE role WHEN 'user' THEN 'Kim (Buyer)' WHEN 'assistant' THEN 'Lee (Rep)' ELSE 'System' END AS speaker,
               text AS turn_text, turn AS ordinal
        FROM conversations""",
    "emails": """
        SELECT 'DEAL-' || CAST(doc_id // 10 AS VARCHAR) AS deal_id, text AS body,
               CASE WHEN doc_id % 17 <> 0
                    THEN CAST(DATE '2024-01-01' + CAST(doc_id % 40 AS INTEGER) AS VARCHAR) || ' 09:00:00' END AS sent_text,
               CASE WHEN doc_id % 17 <> 0 THEN DATE '2024-01-01' + CAST(doc_id % 40 AS INTEGER) END AS sent,
               doc_id AS ordinal
        FROM documents""",
    "chunks": """
        SELECT 'C' || CAST(vec_id AS VARCHAR) AS chunk_id, 'DEAL-' || CAST(label AS VARCHAR) AS deal_id,
               'chunk ' || CAST(vec_id AS VARCHAR) AS document, embedding, vec_id AS ordinal
        FROM embeddings""",
    "asked": """
        SELECT deal_id, CAST(row_number() OVER (PARTITION BY deal_id ORDER BY ordinal) - 1 AS INTEGER) AS query_no,
               embedding
        FROM chunks QUALIFY row_number() OVER (PARTITION BY deal_id ORDER BY ordinal) <= 3""",
    "hits": """
        SELECT 'query ' || CAST(page_id // 25 AS VARCHAR) AS query, page_id AS ordinal,
               CASE WHEN page_id % 5 <> 0 THEN 'Page ' || CAST(page_id AS VARCHAR) ELSE '' END AS title,
               CASE WHEN page_id % 7 <> 0 THEN url ELSE '' END AS url,
               DATE '2024-01-31' - CAST(page_id % 300 AS INTEGER) AS published,
               CASE WHEN page_id % 3 = 0 THEN url || ' seen' ELSE html END AS snippet
        FROM pages""",
    # Steps shared by several queries.
    "requested": """
        SELECT deal_id, min(ordinal) AS first_seen, arg_max(stage, ordinal) AS stage,
               arg_max(close_date, ordinal) AS close_date, arg_max(arr, ordinal) AS arr,
               arg_max(rep_name, ordinal) AS rep_name, arg_max(account_name, ordinal) AS account_name
        FROM deal_rows GROUP BY 1""",
    "counts": """
        SELECT deal_id, count(*) AS activity_count, max(activity_date) AS last_activity_date
        FROM activity GROUP BY 1""",
    "signals": """
        SELECT r.deal_id, activity_count, last_activity_date,
               date_diff('day', last_activity_date, DATE '2024-01-31') AS days_since_last,
               (SELECT max(activity_count) FROM counts JOIN requested USING (deal_id)) AS max_count
        FROM requested r LEFT JOIN counts USING (deal_id)""",
    "engaged": """
        SELECT deal_id,
               CASE WHEN activity_count IS NULL THEN CAST(0 AS DOUBLE)
                    ELSE least(1, greatest(0, 0.5::DOUBLE * greatest(0, 1 - days_since_last / 28::DOUBLE)
                                              + 0.5::DOUBLE * (activity_count / max_count::DOUBLE))) END
                 AS engagement_score,
               coalesce(days_since_last > 14, true) AS activity_gap_flag, last_activity_date, days_since_last,
               coalesce(activity_count, 0) AS activity_count
        FROM signals""",
    "buyer": "SELECT * FROM transcripts WHERE contains(lower(speaker), 'buyer')",
    "calls": """
        SELECT deal_id, call_num, row_number() OVER (PARTITION BY deal_id ORDER BY call_num) - 1 AS call_rank,
               count(*) OVER (PARTITION BY deal_id) AS call_count
        FROM (SELECT DISTINCT deal_id, call_num FROM buyer)""",
    "halves": """
        SELECT *, CASE WHEN call_count = 1 THEN 'early,late' WHEN call_rank < call_count // 2 THEN 'early'
                       ELSE 'late' END AS halves
        FROM calls""",
    "cutoffs": "SELECT deal_id, max(CAST(call_date AS DATE)) AS cutoff FROM transcripts GROUP BY 1",
    "mail_halves": """
        SELECT e.*, CASE WHEN cutoff IS NULL OR sent IS NULL OR sent > cutoff THEN 'late' ELSE 'early' END AS half
        FROM emails e LEFT JOIN cutoffs USING (deal_id)""",
    "pieces": """
        SELECT deal_id, 'early' AS half, 0 AS source, call_date, call_num, turn_num, ordinal, turn_text AS piece
        FROM buyer JOIN halves USING (deal_id, call_num) WHERE contains(halves, 'early')
        UNION ALL
        SELECT deal_id, 'late', 0, call_date, call_num, turn_num, ordinal, turn_text
        FROM buyer JOIN halves USING (deal_id, call_num) WHERE contains(halves, 'late')
        UNION ALL
        SELECT deal_id, half, 1, '', 0, 0, ordinal, body FROM mail_halves""",
    "texts": """
        SELECT deal_id, half,
               lower(string_agg(piece, ' ' ORDER BY source, call_date, call_num, turn_num, ordinal)) AS text
        FROM pieces GROUP BY 1, 2""",
}


def word_count(text: str, words) -> str:
    return " + ".join(
        f"(length({text}) - length(replace({text}, {q(w.lower())}, ''))) // {len(w)}" for w in words
    )


def balance(text: str) -> str:
    pos, neg = f"({word_count(text, TONE.positive)})", f"({word_count(text, TONE.negative)})"
    return f"(CASE WHEN {pos} + {neg} = 0 THEN 0::DOUBLE ELSE ({pos} - {neg}) / ({pos} + {neg})::DOUBLE END)"


VIEWS |= {
    "tone_halves": f"SELECT deal_id, half, {balance('text')} AS score FROM texts",
    "tone_pairs": """
        SELECT deal_id, coalesce(max(score) FILTER (half = 'early'), 0::DOUBLE) AS early,
               coalesce(max(score) FILTER (half = 'late'), 0::DOUBLE) AS late
        FROM tone_halves GROUP BY 1""",
    "spans": """
        SELECT deal_id, sum(t) AS buyer_turn_count, sum(m) AS email_count, 0 AS unplaced_turn_count,
               min(seen) AS first_signal_at, max(seen) AS last_signal_at
        FROM (SELECT deal_id, call_date AS seen, 1 AS t, 0 AS m FROM buyer
              UNION ALL SELECT deal_id, sent_text, 0, 1 FROM emails)
        GROUP BY 1""",
    "toned": f"""
        SELECT r.deal_id, coalesce(late, 0) AS sentiment_score, coalesce(late, 0) - coalesce(early, 0) AS tone_trajectory,
               coalesce(late, 0) - coalesce(early, 0) < {TONE.decline_threshold}::DOUBLE AS sentiment_decline_flag,
               2 AS window_count, coalesce(buyer_turn_count, 0) AS buyer_turn_count,
               coalesce(email_count, 0) AS email_count, 0 AS unplaced_turn_count, first_signal_at, last_signal_at
        FROM requested r LEFT JOIN tone_pairs USING (deal_id) LEFT JOIN spans USING (deal_id)""",
    "distances": """
        SELECT c.deal_id, query_no, chunk_id, document,
               list_sum(list_transform(list_zip(c.embedding, a.embedding),
                 lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS distance
        FROM chunks c JOIN asked a USING (deal_id)""",
    "nearest": """
        SELECT *, row_number() OVER (PARTITION BY deal_id, query_no ORDER BY distance, chunk_id) AS hit_rank
        FROM distances QUALIFY hit_rank <= 5""",
    "merged": """
        SELECT deal_id, chunk_id, document, distance,
               row_number() OVER (PARTITION BY deal_id ORDER BY distance, met_query, met_rank) AS context_rank
        FROM (SELECT *, first_value(query_no) OVER w AS met_query, first_value(hit_rank) OVER w AS met_rank,
                     row_number() OVER (PARTITION BY deal_id, chunk_id ORDER BY distance, query_no) AS best
              FROM nearest WINDOW w AS (PARTITION BY deal_id, chunk_id ORDER BY query_no, hit_rank))
        WHERE best = 1""",
    "contexts": """
        SELECT deal_id, string_agg(document, chr(10) || chr(10) ORDER BY context_rank) AS context_block
        FROM merged GROUP BY 1""",
    "scored": """
        SELECT r.*, e.* EXCLUDE (deal_id), t.* EXCLUDE (deal_id), context_block,
               least(1, greatest(0, 0.40::DOUBLE * engagement_score + 0.35::DOUBLE * ((sentiment_score + 1) / 2)
                                    + 0.25::DOUBLE * (CASE WHEN activity_gap_flag THEN 0 ELSE 1 END)))
                 AS deal_health_score,
               least(1, greatest(0, 1 - deal_health_score)) AS slip_risk_score,
               slip_risk_score > 0.65::DOUBLE AS handoff_triggered
        FROM requested r JOIN engaged e USING (deal_id) JOIN toned t USING (deal_id)
        LEFT JOIN contexts USING (deal_id)""",
    "quarterly": f"SELECT segment, quarter, round({money('booked_arr')}, 2) AS booked_arr FROM bookings GROUP BY 1, 2",
    "growth": """
        SELECT segment, quarter AS reference_quarter, prior_quarter, booked_arr AS current_arr, prior_quarter_arr,
               first_quarter_arr, round((booked_arr - prior_quarter_arr) / prior_quarter_arr * 100, 2) AS qoq_growth_pct,
               round((booked_arr - first_quarter_arr) / first_quarter_arr * 100, 2) AS yoy_growth_pct
        FROM (SELECT *, lag(quarter) OVER w AS prior_quarter, lag(booked_arr) OVER w AS prior_quarter_arr,
                     first_value(booked_arr) OVER w AS first_quarter_arr,
                     row_number() OVER (PARTITION BY segment ORDER BY quarter DESC) AS back
              FROM quarterly WINDOW w AS (PARTITION BY segment ORDER BY quarter))
        WHERE back = 1""",
    "gaps": """
        SELECT segment, 'crm_sync' AS segments_source, benchmark_growth_pct, yoy_growth_pct AS internal_yoy_growth_pct,
               round(yoy_growth_pct - benchmark_growth_pct, 2) AS gap_pp,
               abs(round(yoy_growth_pct - benchmark_growth_pct, 2)) >= 5 AS flagged
        FROM growth LEFT JOIN benchmarks USING (segment)""",
    "summary": f"""
        SELECT segment, count(*) AS "count", count(*) FILTER (stage = 'Closed Won') AS closed_won,
               count(*) FILTER (stage = 'Closed Lost') AS closed_lost, round({money('arr')}, 2) AS total_pipeline_arr
        FROM opps WHERE segment IS NOT NULL GROUP BY 1""",
    "context": """
        SELECT segment, current_arr, qoq_growth_pct, yoy_growth_pct, "count", closed_won, closed_lost,
               total_pipeline_arr, benchmark_growth_pct, gap_pp, flagged
        FROM growth LEFT JOIN summary USING (segment)
        LEFT JOIN (SELECT segment, benchmark_growth_pct, gap_pp, flagged FROM gaps) USING (segment)""",
    "losses": """
        SELECT opportunity_id, arr, trim(regexp_extract(trim(win_loss_reason), '^Lost to (.+?) on (.+)$', 1)) AS name,
               trim(regexp_extract(trim(win_loss_reason), '^Lost to (.+?) on (.+)$', 2)) AS theme
        FROM opps WHERE stage = 'Closed Lost' AND regexp_matches(trim(win_loss_reason), '^Lost to (.+?) on (.+)$')""",
    "stats": f"""
        SELECT name, count(*) AS loss_count, {money('arr')} AS lost_arr,
               string_agg(DISTINCT theme, ',' ORDER BY theme) AS loss_themes
        FROM losses GROUP BY 1""",
    "ranked": """
        SELECT row_number() OVER (ORDER BY lost_arr DESC, loss_count DESC, name) AS competitor_rank, name, loss_count,
               round(lost_arr, 2) AS lost_arr, loss_themes
        FROM stats QUALIFY competitor_rank <= 3""",
    "snippets": """
        SELECT query, ordinal, title, url, snippet FROM hits
        WHERE published >= DATE '2024-01-31' - 180
        QUALIFY row_number() OVER (PARTITION BY query ORDER BY ordinal) <= 8""",
    "signal_fields": """
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'positive' ELSE 'mixed' END AS g2_sentiment,
               CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS g2_summary,
               CASE WHEN doc_id % 3 = 1 THEN lang ELSE '' END AS pricing_signal,
               CASE WHEN doc_id % 3 = 0 THEN 'high' ELSE 'medium' END AS threat_level,
               CASE WHEN doc_id % 3 = 0 THEN 'h' || CAST(doc_id AS VARCHAR) ELSE '' END AS headline,
               CASE WHEN doc_id % 3 = 0 THEN 'a,' || CAST(doc_id AS VARCHAR) ELSE '' END AS recent_launches,
               doc_id % 3 < 2 AS ok
        FROM documents""",
    "signalled": f"""
        SELECT ranked.*, threat_level, headline, g2_sentiment, pricing_signal
        FROM ranked LEFT JOIN (
          SELECT [{", ".join(q(r) for r in RIVALS)}][CAST(doc_id % 4 + 1 AS INTEGER)] AS name,
                 arg_max(threat_level, doc_id) AS threat_level, arg_max(headline, doc_id) AS headline,
                 arg_max(g2_sentiment, doc_id) AS g2_sentiment, arg_max(pricing_signal, doc_id) AS pricing_signal
          FROM signal_fields WHERE ok GROUP BY 1) USING (name)""",
}


_COUNTS = ", ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in LETTERS)


def _letter_vectors(source: str) -> str:
    """Twin of the letter encoder over a table with a text column ``t``."""
    return f"""
        SELECT * EXCLUDE (n), CASE WHEN list_sum(n) = 0 THEN list_transform(n, lambda x: x::FLOAT)
               ELSE list_transform(n, lambda x: (x / sqrt(list_sum(list_transform(n, lambda y: y * y))))::FLOAT) END AS v
        FROM (SELECT *, list_transform([{_COUNTS}], lambda x: x::DOUBLE) AS n FROM ({source}))"""


_QUESTION_ROWS = ", ".join(f"({i}, {q(text)})" for i, text in enumerate(RETRIEVAL_QUERIES))
VIEWS |= {
    "corpus": """
        SELECT deal_id || ':' || source || ':'
                 || CAST(row_number() OVER (PARTITION BY deal_id, source ORDER BY ordinal) - 1 AS VARCHAR) AS chunk_id,
               deal_id, document
        FROM (SELECT deal_id, 'transcript' AS source, ordinal, turn_text AS document FROM transcripts
              UNION ALL SELECT deal_id, 'email', ordinal, body FROM emails)""",
    "letter_chunks": _letter_vectors("SELECT chunk_id, deal_id, document, document AS t FROM corpus"),
    "letter_questions": _letter_vectors(f"SELECT * FROM (VALUES {_QUESTION_ROWS}) asked_texts(query_no, t)"),
    "letter_nearest": """
        SELECT *, row_number() OVER (PARTITION BY deal_id, query_no ORDER BY distance, chunk_id) AS hit_rank
        FROM (SELECT deal_id, query_no, chunk_id, document,
                     list_sum(list_transform(list_zip(c.v, a.v),
                       lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS distance
              FROM letter_chunks c JOIN letter_questions a ON true)
        QUALIFY hit_rank <= 5""",
    "letter_merged": """
        SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY distance, met_query, met_rank) AS context_rank
        FROM (SELECT *, first_value(query_no) OVER w AS met_query, first_value(hit_rank) OVER w AS met_rank,
                     row_number() OVER (PARTITION BY deal_id, chunk_id ORDER BY distance, query_no) AS best
              FROM letter_nearest WINDOW w AS (PARTITION BY deal_id, chunk_id ORDER BY query_no, hit_rank))
        WHERE best = 1""",
}


def _needed(sql: str) -> list[str]:
    """Views the statement names, each after those it builds on."""
    import re

    found: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def sql(statement: str) -> str:
    names = _needed(statement)
    if not names:
        return statement
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names) + "\n" + statement


def _quality(check: str) -> str:
    allowed = "'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'"
    return f"""
        SELECT {check} FROM (
          SELECT count(*) AS "rows", count(*) FILTER (sales IS NULL) AS null_sales,
                 count(*) FILTER (sales <= 0) AS nonpositive,
                 count(*) FILTER (NOT coalesce(segment IN ({allowed}), false)) AS invalid_segment
          FROM sales)"""


_CHECKS = (
    (1, "row_count_minimum", '"rows" >= 1000', """'count=' || "rows" || ', min=1000'"""),
    (2, "sales_column_exists", "true", "'''Sales'' present=True'"),
    (
        3,
        "sales_null_rate",
        """coalesce(null_sales / "rows"::DOUBLE < 0.05, false)""",
        """'rate=' || printf('%.5f', null_sales / "rows"::DOUBLE) || ', max=0.05'""",
    ),
    (4, "sales_positive_nonnull", "nonpositive = 0", "'nonpositive_nonnull=' || nonpositive"),
    (5, "segment_allowed_nonnull", "invalid_segment = 0", "'invalid_or_null=' || invalid_segment"),
)
_REPORT = " UNION ALL ".join(
    _quality(f"{n} AS position, {q(name)} AS name, {passed} AS passed, {detail} AS detail")
    for n, name, passed, detail in _CHECKS
)


def _kpi(name: str, key: str, select: str) -> str:
    return f"SELECT {q(name)} AS figure, {key} AS key, sales AS value FROM ({select})"


_TOTALS = f"{money('sales')} AS sales, {money('profit')} AS profit"
_PRODUCTS = f"SELECT product, {_TOTALS} FROM sales GROUP BY 1 ORDER BY sales DESC, product LIMIT 5"
_REGIONS = f"SELECT region, {_TOTALS} FROM sales GROUP BY 1 ORDER BY sales DESC, region LIMIT 5"
_MONTHS = f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {_TOTALS}, count(*) AS orders
              FROM sales GROUP BY 1"""
_CROSS = f"""SELECT segment, region, subregion, {money('sales')} AS sales, count(*) AS orders FROM sales
             GROUP BY 1, 2, 3 ORDER BY sales DESC, segment, region, subregion LIMIT 10"""
_PERFORMANCE = f"""
    SELECT segment, count(*) AS total_orders, {money('sales')} AS total_sales, {money('profit')} AS total_profit,
           {money('sales')} / count(sales) AS avg_deal_size,
           {money('profit')} / nullif({money('sales')}, 0) AS profit_margin
    FROM sales GROUP BY 1"""
_FACTS = f"""
    SELECT order_date, segment, product, region, subregion, {money('sales')} AS total_sales,
           {money('profit')} AS total_profit, count(*) AS order_count, {money('sales')} / count(sales) AS avg_deal_size
    FROM sales GROUP BY 1, 2, 3, 4, 5"""
_BOUNDS = """
    SELECT segment, min(arr) AS min_arr, max(arr) AS max_arr,
           CASE segment WHEN 'AUTOMOBILE' THEN min(arr) >= 1000
                WHEN 'BUILDING' THEN min(arr) >= 50000 AND max(arr) <= 200000
                ELSE max(arr) < 600000 END AS passed
    FROM opps WHERE segment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') GROUP BY 1"""
_MEANS = f"""
    SELECT segment, round(avg(benchmark_growth_pct), 9) AS benchmark_growth_pct,
           round(avg(actual_growth_pct), 9) AS actual_growth_pct,
           round(avg(actual_growth_pct) - avg(benchmark_growth_pct), 9) AS gap
    FROM bookings GROUP BY 1"""
_VARIATION = f"""SELECT min(gap) AS min_gap, max(gap) AS max_gap, min(gap) < 0 AND max(gap) > 0 AS passed FROM ({_MEANS})"""
_QUARTERS = ", ".join(q(y) for y in YEAR_QUARTERS)


def _domain(view: str, column: str, expected: list[str]) -> str:
    values = ", ".join(f"({i}, {q(v)})" for i, v in enumerate(expected))
    listed = ", ".join(q(v) for v in expected)
    return f"""
        SELECT unexpected_rows, unseen_values, unexpected_rows = 0 AND unseen_values = '' AS passed FROM (
          SELECT (SELECT count(*) FROM {view} WHERE NOT coalesce({column} IN ({listed}), false)) AS unexpected_rows,
                 (SELECT coalesce(string_agg(v, ',' ORDER BY i), '') FROM (VALUES {values}) t(i, v)
                  WHERE v NOT IN (SELECT {column} FROM {view} WHERE {column} IS NOT NULL)) AS unseen_values)"""


_TOPIC = "CASE " + " ".join(
    f"WHEN contains(lower(coalesce(text, '')), {q(t.lower())}) THEN {q(t)}" for t in BLOCKED_TOPICS
) + " END"
_MAIL = f"regexp_replace(text, {q(EMAIL_PATTERN)}, {q(EMAIL_MARK)}, 'g')"


def _phone(text: str) -> str:
    return f"regexp_replace({text}, {q(PHONE_PATTERN)}, {q(PHONE_MARK)}, 'g')"



def _fixed(part: int, lines: list[str]) -> str:
    rows = ", ".join(f"({part}, {i}, {q(line)})" for i, line in enumerate(lines))
    return f"SELECT * FROM (VALUES {rows}) lines{part}(part, place, value)"


def _flag(column: str) -> str:
    return f"CASE WHEN {column} THEN 'True' ELSE 'False' END"


def _two(column: str) -> str:
    return f"CAST(round({column}, 2) + 0 AS VARCHAR)"


_TOP = [
    report.REPORT_TITLE,
    "",
    "Generated: 2024-01-31 00:00 UTC",
    "Query: Assess deal health",
    "",
    report.REPORT_SUMMARY,
    "",
    report.REPORT_HEADER,
    report.REPORT_RULE,
]

STATEMENTS = {
    # sources and sinks
    "csv_landing": _PERFORMANCE,
    "crm_csv_read": """SELECT CAST(opportunity_id AS VARCHAR) AS opportunity_id, segment, account_name, arr, stage,
                              trim(win_loss_reason) AS win_loss_reason FROM opps""",
    "json_array_read": "SELECT * EXCLUDE (ordinal) FROM transcripts",
    "raw_table_scan": _quality("*"),
    "mart_tables": _FACTS,
    "chunk_upsert": """
        SELECT chunk_id, deal_id, document FROM chunks WHERE ordinal % 2 = 1 OR ordinal > 2 * (SELECT max(ordinal) FROM chunks)
        UNION ALL SELECT 'C' || CAST(ordinal * 2 AS VARCHAR), deal_id, 'new ' || document FROM chunks""",
    "run_log": f"""
        SELECT (SELECT reference_quarter FROM growth WHERE segment = {q(MARKET_SEGMENTS[0])}) AS reference_quarter,
               2026 AS search_year, narrative, '[]' AS actions_json,
               coalesce(string_agg(segment, ',' ORDER BY segment) FILTER (flagged), '') AS flagged_segments,
               count(*) AS gap_segments, string_agg(segment, ',' ORDER BY segment) AS segments,
               string_agg(CAST(CAST(round(gap_pp * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY segment) AS gap_points,
               string_agg(CAST(coalesce(flagged, false) AS VARCHAR), ',' ORDER BY segment) AS flags
        FROM gaps JOIN (VALUES ('first'), ('second')) runs(narrative) ON true GROUP BY narrative""",
    # contracts
    "key_contract": """
        SELECT count(*) AS "rows", count(*) FILTER (deal_id IS NULL) AS null_keys,
               count(*) FILTER (trim(deal_id) = '') AS blank_keys,
               count(*) FILTER (deal_id IS NULL OR trim(deal_id) = '') = 0 AS passed FROM deal_rows""",
    "quality_checks": _REPORT,
    "quality_gate": f"""
        SELECT bool_and(passed) AS passed,
               coalesce(string_agg(name, ', ' ORDER BY position) FILTER (NOT passed), '') AS failed_checks
        FROM ({_REPORT})""",
    "id_differences": """
        SELECT coalesce(o.id, l.id) AS id, o.id IS NOT NULL AS in_left, l.id IS NOT NULL AS in_right
        FROM (SELECT DISTINCT o_orderkey AS id FROM orders) o
        FULL JOIN (SELECT DISTINCT l_orderkey AS id FROM lineitem) l ON o.id = l.id
        WHERE o.id IS NULL OR l.id IS NULL""",
    "segment_domain": _domain("opps", "segment", [*MARKET_SEGMENTS, "SMB"]),
    "quarter_domain": _domain("bookings", "quarter", YEAR_QUARTERS),
    "reason_nulls": """SELECT count(*) FILTER (win_loss_reason IS NULL) AS null_rows,
                              count(*) FILTER (win_loss_reason IS NULL) = 0 AS passed FROM opps""",
    "arr_bounds": _BOUNDS,
    "growth_means": _MEANS,
    "growth_variation": _VARIATION,
    "activity_dates": """SELECT count(*) AS "rows", count(*) FILTER (activity_date IS NULL) AS invalid_dates,
                                count(*) FILTER (activity_date IS NULL) = 0 AS passed FROM activity""",
    "segment_coverage": f"""
        SELECT segment, CAST(place - 1 AS INTEGER) AS position, count(quarter) AS quarters, count(quarter) >= 2 AS passed
        FROM (SELECT unnest([{SEGMENT_LIST}, 'SMB']) AS segment, generate_subscripts([{SEGMENT_LIST}, 'SMB'], 1) AS place)
        LEFT JOIN quarterly USING (segment) GROUP BY 1, 2""",
    "contract_audit": f"""
        SELECT 'same_ids' AS contract, true AS passed
        UNION ALL SELECT 'opportunity_columns', true UNION ALL SELECT 'booking_columns', true
        UNION ALL SELECT 'segment_domain', bool_and(coalesce(segment IN ({SEGMENT_LIST}), false))
                         AND count(DISTINCT segment) = {len(MARKET_SEGMENTS)} FROM opps
        UNION ALL SELECT 'arr_bounds', bool_and(passed) FROM ({_BOUNDS})
        UNION ALL SELECT 'reason_present', bool_and(win_loss_reason IS NOT NULL) FROM opps
        UNION ALL SELECT 'quarter_domain', bool_and(coalesce(quarter IN ({_QUARTERS}), false))
                         AND count(DISTINCT quarter) = {len(YEAR_QUARTERS)} FROM bookings
        UNION ALL SELECT 'growth_variation', passed FROM ({_VARIATION})""",
    # marts and key figures
    "staged_sales": "SELECT * FROM sales",
    "revenue_facts": _FACTS,
    "segment_performance": _PERFORMANCE,
    "grand_totals": f"""
        SELECT {money('total_sales')} AS total_sales, {money('total_profit')} AS total_profit,
               sum(order_count) AS total_orders, round(avg(avg_deal_size), 6) AS avg_deal_size,
               {money('total_sales')} / sum(order_count) AS weighted_deal_size
        FROM ({_FACTS})""",
    "top_products": _PRODUCTS,
    "top_regions": _REGIONS,
    "monthly_trend": _MONTHS,
    "segment_regions": _CROSS,
    "sales_key_figures": " UNION ALL ".join(
        (
            _kpi("revenue_totals", "'all'", f"SELECT {_TOTALS} FROM sales"),
            _kpi("segment_performance", "segment", f"SELECT segment, {_TOTALS} FROM sales GROUP BY 1"),
            _kpi("top_products", "product", _PRODUCTS),
            _kpi("top_regions", "region", _REGIONS),
            _kpi("monthly_trend", "CAST(month AS VARCHAR)", _MONTHS),
            _kpi("segment_by_region", "segment || '/' || region || '/' || subregion", _CROSS),
        )
    ),
    # deals
    "normalized_deals": "SELECT * FROM deal_rows",
    "latest_deals": "SELECT * FROM requested",
    "deal_order": "SELECT deal_id, first_seen FROM requested",
    "requested_keys": "SELECT event_id, event_type AS deal_id FROM events WHERE event_type <> 'error'",
    "activity_counts": "SELECT * FROM counts",
    "max_activity": "SELECT coalesce(max(activity_count), 0) AS max_count FROM counts JOIN requested USING (deal_id)",
    "activity_signals": "SELECT * REPLACE (round(engagement_score, 6) AS engagement_score) FROM engaged",
    # sentiment
    "buyer_turns": "SELECT * FROM buyer",
    "turn_positions": """
        SELECT deal_id, call_num, turn_num,
               row_number() OVER (PARTITION BY deal_id ORDER BY call_date, call_num, turn_num, ordinal) - 1 AS position
        FROM buyer""",
    "call_halves": "SELECT * FROM halves",
    "email_halves": "SELECT deal_id, ordinal, half FROM mail_halves",
    "tone_scores": f"SELECT doc_id, round({balance('t')}, 6) AS score FROM (SELECT doc_id, lower(text) AS t FROM documents)",
    "signal_span": "SELECT * FROM spans",
    "deal_sentiment": """
        SELECT * REPLACE (round(sentiment_score, 6) AS sentiment_score, round(tone_trajectory, 6) AS tone_trajectory)
        FROM toned""",
    # guardrails
    "email_redaction": f"SELECT doc_id, {_MAIL} AS text FROM documents",
    "phone_redaction": f"SELECT doc_id, {_phone('text')} AS text FROM documents",
    "pii_redaction": f"""
        SELECT doc_id, sanitized_text, mailed <> text OR sanitized_text <> mailed AS redacted,
               concat_ws(',', CASE WHEN mailed <> text THEN 'email' END, CASE WHEN sanitized_text <> mailed THEN 'phone' END)
                 AS pii_types
        FROM (SELECT doc_id, text, mailed, {_phone('mailed')} AS sanitized_text
              FROM (SELECT doc_id, text, {_MAIL} AS mailed FROM documents))""",
    "topic_screen": f"SELECT doc_id, {_TOPIC} AS matched_topic, {_TOPIC} IS NULL AS allowed FROM documents",
    # retrieval
    "corpus_deals": "SELECT deal_id FROM transcripts UNION SELECT deal_id FROM emails",
    "corpus_chunks": "SELECT * FROM corpus",
    "corpus_index": r"""
        SELECT chunk_id, deal_id, md5(document) AS document, 256 AS dimensions,
               CASE WHEN regexp_matches(document, '[\pL\pM\p{Nd}\p{Pc}]') THEN 1::DOUBLE ELSE 0::DOUBLE END AS norm
        FROM corpus""",
    "text_retrieval": f"""
        SELECT deal_id, true AS retrieval_ok,
               string_agg(trim(document, {q(WHITESPACE)}), chr(10) || chr(10) ORDER BY context_rank)
                 FILTER (document <> '') AS context_block
        FROM letter_merged WHERE deal_id IN (SELECT deal_id FROM transcripts) GROUP BY 1""",
    "stored_retrieval": f"""
        SELECT deal_id, true AS retrieval_ok,
               string_agg(trim(document, {q(WHITESPACE)}), chr(10) || chr(10) ORDER BY context_rank)
                 FILTER (document <> '') AS context_block
        FROM letter_merged
        WHERE deal_id IN (SELECT DISTINCT deal_id FROM transcripts ORDER BY deal_id LIMIT 5) GROUP BY 1""",
    "query_distances": "SELECT deal_id, query_no, chunk_id, round(distance, 6) AS distance FROM distances",
    "nearest_chunks": "SELECT * REPLACE (round(distance, 6) AS distance) FROM nearest",
    "merged_hits": "SELECT * REPLACE (round(distance, 6) AS distance) FROM merged",
    "context_blocks": "SELECT * FROM contexts",
    "retrieval_status": f"""
        SELECT CASE WHEN event_type = 'error' THEN ' ' ELSE event_type END AS deal_id,
               event_type <> 'error' AS retrieval_ok, {len(RETRIEVAL_QUERIES)} AS query_count
        FROM (SELECT DISTINCT event_type FROM events)""",
    # health
    "deal_health": """
        SELECT deal_id, first_seen, stage, arr, round(engagement_score, 6) AS engagement_score, activity_gap_flag,
               round(sentiment_score, 6) AS sentiment_score, round(tone_trajectory, 6) AS tone_trajectory,
               round(deal_health_score, 6) AS deal_health_score, round(slip_risk_score, 6) AS slip_risk_score,
               handoff_triggered, true AS deal_intel_ok, length(coalesce(context_block, '')) AS context_chars
        FROM scored""",
    "deal_assembly": """
        SELECT deal_id, round(e.engagement_score, 6) AS engagement_score, e.activity_gap_flag,
               round(0.40::DOUBLE * coalesce(e.engagement_score, 0) + 0.35::DOUBLE * 0.5
                     + 0.25::DOUBLE * (CASE WHEN coalesce(e.activity_gap_flag, true) THEN 0 ELSE 1 END), 6)
                 AS deal_health_score,
               false AS deal_intel_ok, '' AS rag_summary_redacted
        FROM requested r LEFT JOIN (SELECT * FROM engaged WHERE activity_count > 0) e USING (deal_id)""",
    "health_report": f"""
        {_fixed(0, _TOP)}
        UNION ALL
        SELECT 1, first_seen, '| ' || concat_ws(' | ', deal_id, account_name, stage,
               printf('%.2f', deal_health_score), printf('%.2f', slip_risk_score), {_flag('activity_gap_flag')},
               {_flag('sentiment_decline_flag')}, {_flag('handoff_triggered')}) || ' |' FROM scored
        UNION ALL {_fixed(2, ['', report.REPORT_ADJUSTMENTS, ''])}
        UNION ALL {_fixed(3, [report.REPORT_NO_HANDOFFS])}""",
    "forecast_prompts": f"""
        SELECT deal_id, concat_ws(chr(10), 'deal_id: ' || deal_id,
               'slip_risk_score: ' || {_two('slip_risk_score')} || ' (handoff threshold: 0.65)',
               'account: ' || account_name || ' | stage: ' || stage,
               'close_date: ' || close_date || ' | arr: ' || arr || ' | rep: ' || rep_name,
               'engagement_score: ' || {_two('engagement_score')} || ' | activity_gap_flag: '
                 || {_flag('activity_gap_flag')},
               'sentiment_score: ' || {_two('sentiment_score')} || ' | tone_trajectory: ' || {_two('tone_trajectory')},
               'sentiment_decline_flag: ' || {_flag('sentiment_decline_flag')},
               'rag_summary:', coalesce(context_block, ''), {q(report.FORECAST_PROMPT[-1])}) AS prompt
        FROM scored WHERE handoff_triggered""",
    "handoffs": "SELECT deal_id, round(slip_risk_score, 6) AS slip_risk_score FROM scored WHERE handoff_triggered",
    "batch_counts": "SELECT count(*) AS scored, count(*) FILTER (handoff_triggered) AS handed_off FROM scored",
    # growth
    "quarterly_arr": "SELECT * FROM quarterly",
    "quarter_maps": """
        SELECT segment, string_agg(quarter || '=' || CAST(CAST(booked_arr AS DECIMAL(18, 2)) AS VARCHAR), ',' ORDER BY quarter)
                 AS quarterly_arr
        FROM quarterly GROUP BY 1""",
    "segment_growth": "SELECT * FROM growth",
    "reference_quarters": f"SELECT reference_quarter, prior_quarter FROM growth WHERE segment = {q(MARKET_SEGMENTS[0])}",
    "opportunity_summary": "SELECT * FROM summary",
    "opportunity_totals": "SELECT count(*) AS total_opportunities FROM opps",
    "segment_source": f"""
        SELECT segment, 'crm_sync' AS segments_source, 'found' AS "case" FROM growth
        UNION ALL SELECT unnest([{SEGMENT_LIST}]), 'config', 'none'""",
    "benchmark_gaps": "SELECT * FROM gaps",
    "flagged_segments": """
        SELECT coalesce(string_agg(segment, ',' ORDER BY segment) FILTER (flagged), '') AS flagged_segments FROM gaps""",
    "benchmark_prompts": """
        SELECT segment, segment || ' SaaS ARR growth rate benchmark 2026' AS query,
               'Find the benchmark.' || chr(10) || chr(10) || 'Segment: ' || segment || chr(10) || 'Year: 2026' || chr(10)
               || 'Preferred sources: SEC filings, Earnings call transcripts, Industry analyst reports' || chr(10)
               || 'Query focus: ' || segment || ' SaaS ARR growth rate benchmark 2026' AS prompt
        FROM growth""",
    "segment_review": "SELECT * FROM context",
    "synthesis_context": f"""
        SELECT (SELECT string_agg(segment, ',' ORDER BY segment) FROM gaps WHERE flagged) AS flagged_segments,
               (SELECT reference_quarter FROM growth WHERE segment = {q(MARKET_SEGMENTS[0])}) AS reference_quarter,
               '3' AS gtm_actions_count, {q(MARKET_SEGMENTS[0])} AS first_segment,
               (SELECT CAST("count" AS VARCHAR) FROM summary WHERE segment = {q(MARKET_SEGMENTS[0])}) AS first_count,
               {q(MARKET_SEGMENTS[-1])} AS last_segment,
               (SELECT name FROM ranked WHERE competitor_rank = 1) AS top_competitor,
               (SELECT CAST(loss_count AS VARCHAR) FROM ranked WHERE competitor_rank = 3) AS third_losses,
               (SELECT threat_level FROM signalled WHERE competitor_rank = 1) AS top_threat_level,
               (SELECT headline FROM signalled WHERE competitor_rank = 2) AS second_headline""",
    "booking_allocation": f"""
        SELECT opportunity_id, segment, quarter, round(booked_arr * arr / weights, 2) AS booked_arr
        FROM opps JOIN (SELECT segment, {money('arr')} AS weights FROM opps GROUP BY 1) USING (segment)
        JOIN quarterly USING (segment)""",
    "segment_head": """
        SELECT segment, opportunity_id FROM opps
        QUALIFY row_number() OVER (PARTITION BY segment ORDER BY opportunity_id) <= 5""",
    "sampled_bookings": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
        WHERE l_orderkey IN (SELECT opportunity_id FROM opps
                             QUALIFY row_number() OVER (PARTITION BY segment ORDER BY opportunity_id) <= 5)""",
    # competitors
    "competitor_losses": "SELECT opportunity_id, name, theme FROM losses",
    "competitor_stats": "SELECT * FROM stats",
    "competitor_ranking": "SELECT * FROM ranked",
    "competitor_queries": "SELECT name, name || ' G2 reviews pricing product launch SaaS' AS query FROM ranked",
    "search_snippets": "SELECT * FROM snippets",
    "snippet_blobs": """
        SELECT query, string_agg('Title: ' || title || chr(10) || 'URL: ' || url || chr(10) || 'Snippet: ' || snippet,
                                 chr(10) || chr(10) ORDER BY ordinal) AS blob,
               coalesce(string_agg(url, ',' ORDER BY ordinal) FILTER (url <> ''), '') AS sources
        FROM snippets GROUP BY 1""",
    "competitor_signals": "SELECT * FROM signalled",
    "threat_summary": """
        SELECT string_agg(name, ',' ORDER BY competitor_rank) AS top_threats,
               coalesce(nullif(arg_min(coalesce(headline, ''), competitor_rank), ''),
                        'Top threat: ' || arg_min(name, competitor_rank)) AS headline,
               string_agg(name, ',' ORDER BY competitor_rank) AS recommended_watchlist
        FROM signalled""",
    # model answers
    "benchmark_answers": """
        SELECT doc_id, CASE WHEN doc_id % 5 < 2 THEN CAST(doc_id % 30 AS DOUBLE) END AS benchmark_growth_pct,
               CASE WHEN doc_id % 5 < 3 THEN source ELSE '' END AS source_summary,
               CASE WHEN doc_id % 5 = 0 THEN 'high' ELSE 'low' END AS confidence,
               CASE WHEN doc_id % 5 < 2 THEN '' WHEN doc_id % 5 = 2 THEN 'benchmark_growth_pct missing'
                    ELSE 'no JSON object found' END AS error,
               doc_id % 5 < 2 AS ok
        FROM documents""",
    "action_answers": """
        SELECT doc_id, CASE WHEN doc_id % 6 = 5 THEN 0 WHEN doc_id % 6 = 2 THEN 1 ELSE 3 END AS action_count,
               CASE WHEN doc_id % 6 < 2 THEN '' WHEN doc_id % 6 = 2 THEN 'expected 3 actions, got 1'
                    WHEN doc_id % 6 = 5 THEN 'no JSON object found' ELSE 'narrative missing or empty' END AS error,
               doc_id % 6 < 2 AS ok,
               CASE WHEN doc_id % 6 < 2 THEN '[{"rank":1,"segment":"' || lang || '"},{"rank":2,"segment":"' || lang
                    || '"},{"rank":3,"segment":"' || lang || '"}]' END AS actions_json,
               CASE WHEN doc_id % 6 < 2 THEN 'about ' || source END AS narrative
        FROM documents""",
    "signal_answers": "SELECT * FROM signal_fields",
}

ORACLES = {name: sql(statement) for name, statement in STATEMENTS.items()}
