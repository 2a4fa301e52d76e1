"""DuckDB SQL that states each registered query's expected result.

The driver runs these against the raw parquet tables (pre-registered views
``events``, ``conversations`` …), so every derived feed is spelled out here
as a CTE.  ``sql(body, *needs)`` prepends the CTEs ``body`` depends on, in
dependency order.
"""

from __future__ import annotations

# name -> (dependencies, select text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], text: str) -> None:
    CTES[name] = (deps, text)


def sql(body: str, *needs: str, local: str = "") -> str:
    """``body`` preceded by the CTEs it needs; ``local`` adds query-own CTEs
    (``"name AS (...), ..."``) after them."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    if local:
        parts.append(local.strip())
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


cte("v_base", (), """
SELECT event_id, ts, user_id, event_type, value, props,
       CAST(props->>'$.k' AS INT) AS k,
       CASE WHEN (event_id * 104729) % 1000 < 50
            THEN 155520 + ((event_id * 7919) % 1000) * 99
            ELSE ((event_id * 7919) % 1000) * 21 END AS delay_s
FROM events""")

_CUSTOMER = """'C' || CAST(user_id AS VARCHAR) AS customer_id,
       'Cust_' || CAST(user_id AS VARCHAR) AS customer_name,
       CASE user_id % 3 WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'SMB' ELSE 'Startup' END AS segment"""
_TICKET = "'T' || CAST(user_id AS VARCHAR) || '-' || CAST(k % 20 AS VARCHAR)"

cte("v_tickets_cdc", ("v_base",), f"""
SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       {_TICKET} AS ticket_id,
       event_id AS cdc_seq,
       ts AS event_time,
       ts + to_seconds(delay_s) AS _ingested_at,
       'app.tickets' AS _source,
       {_CUSTOMER},
       CASE WHEN k < 40 THEN CAST(event_id % 4 + 1 AS VARCHAR)
            WHEN k < 80 THEN CASE event_id % 4 WHEN 0 THEN 'urgent' WHEN 1 THEN 'High'
                                               WHEN 2 THEN ' medium ' ELSE 'low' END
            ELSE CASE event_id % 8 WHEN 0 THEN 'P1' WHEN 1 THEN 'P2' WHEN 2 THEN '0'
                                   WHEN 3 THEN '5' WHEN 4 THEN '-1' WHEN 5 THEN ''
                                   WHEN 6 THEN NULL ELSE 'unknown' END END AS priority_raw,
       event_type AS category,
       CASE event_id % 3 WHEN 0 THEN 'chat' WHEN 1 THEN 'email' ELSE 'voice' END AS channel,
       CASE event_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'pending' WHEN 2 THEN 'resolved'
                         ELSE 'closed' END AS status,
       CAST(event_id % 5 + 1 AS INT) AS csat,
       CAST(event_id % 1400 + 60 AS INT) AS first_response_sec,
       event_type || ' #' || CAST(event_id AS VARCHAR) AS subject,
       props AS body
FROM v_base""")

cte("v_events", ("v_base",), f"""
SELECT event_id,
       {_TICKET} AS ticket_id,
       {_CUSTOMER},
       event_type,
       CASE event_id % 3 WHEN 0 THEN 'model-s' WHEN 1 THEN 'model-m' ELSE 'model-l' END AS model,
       CAST(floor(value * 10) AS INT) AS latency_ms,
       CAST(event_id % 3000 + 200 AS INT) AS tokens_in,
       CAST(event_id % 900 + 40 AS INT) AS tokens_out,
       event_type = 'error' AS is_escalated,
       ts AS event_time,
       ts + to_seconds(delay_s) AS _ingested_at,
       'agent-events' AS _topic
FROM v_base""")

cte("v_transcripts", (), """
SELECT conv_id AS transcript_id,
       'T' || CAST(conv_id % 150 AS VARCHAR) || '-' || CAST(conv_id % 20 AS VARCHAR) AS ticket_id,
       CASE WHEN conv_id % 10 = 0 THEN 'vi' ELSE 'en' END AS lang,
       list(text ORDER BY turn, text) AS turns,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(conv_id % 720 AS BIGINT)) AS event_time,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(conv_id % 720 AS BIGINT))
           + INTERVAL 11 MINUTE AS _ingested_at,
       'store.transcripts' AS _source
FROM conversations
GROUP BY conv_id""")

cte("v_events_dup", ("v_events",), """
SELECT * FROM v_events
UNION ALL
SELECT * REPLACE (_ingested_at + INTERVAL 1 HOUR AS _ingested_at)
FROM v_events WHERE event_id % 10 = 0""")

cte("silver_events", ("v_events_dup",), """
SELECT * EXCLUDE (_topic),
       CAST(event_time AS DATE) AS event_date,
       CAST(_ingested_at AS DATE) AS ingested_date
FROM v_events_dup
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at) = 1""")

# Strict integer parse + label map: the Silver validity rule.
# The labels and the numbers they stand for.
LABELS = "(VALUES ('urgent', 1), ('high', 2), ('medium', 3), ('low', 4)) AS label(word, number)"
NORMALIZE = f"""coalesce(
    (SELECT number FROM {LABELS} WHERE word = lower(trim({{c}}))),
    (SELECT i FROM range(1, 5) AS valid(i)
     WHERE regexp_matches({{c}}, '^\\s*[+-]?\\d+\\s*$') AND i = try_cast({{c}} AS INTEGER)))"""

REASON = """CASE
    WHEN {c} IS NULL THEN 'priority is null'
    WHEN trim({c}) = '' THEN 'priority is blank'
    WHEN regexp_matches({c}, '^\\s*[+-]?\\d+\\s*$') THEN 'priority number outside 1..4'
    ELSE 'priority not mappable to 1..4' END"""

cte("cdc_clean", ("v_tickets_cdc",), f"""
SELECT *, CAST({NORMALIZE.format(c='priority_raw')} AS INTEGER) AS priority_clean FROM v_tickets_cdc""")

cte("current_state", ("cdc_clean",), """
SELECT * FROM cdc_clean WHERE priority_clean IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY event_time DESC, cdc_seq DESC) = 1""")

cte("silver_tickets", ("current_state",), """
SELECT ticket_id, customer_id, customer_name, segment, priority_clean AS priority,
       category, channel, status, csat, first_response_sec, subject, body,
       event_time AS updated_at, _ingested_at
FROM current_state WHERE op <> 'd'""")

cte("quarantine", ("cdc_clean",), f"""
SELECT ticket_id, cdc_seq, op, event_time, _ingested_at, priority_raw,
       {REASON.format(c='priority_raw')} AS reject_reason,
       customer_id, customer_name, category, status
FROM cdc_clean WHERE priority_clean IS NULL""")

cte("training_set", ("silver_tickets",), """
SELECT ticket_id, customer_id, customer_name, segment, priority, category, channel, status,
       csat, first_response_sec,
       CAST(length(subject) + length(body) AS INT) AS text_len,
       CASE WHEN status IN ('resolved', 'closed') THEN 1 ELSE 0 END AS label_resolved,
       updated_at, _ingested_at
FROM silver_tickets""")

cte("doc_chunks", ("v_transcripts",), """
SELECT CAST(transcript_id AS VARCHAR) || '#' || CAST(chunk_index AS VARCHAR) AS chunk_id,
       transcript_id, ticket_id, lang, CAST(chunk_index AS BIGINT) AS chunk_index,
       chunk_text, CAST(length(chunk_text) AS INT) AS n_chars, event_time
FROM (SELECT transcript_id, ticket_id, lang, event_time,
             unnest(turns) AS chunk_text, unnest(range(len(turns))) AS chunk_index
      FROM v_transcripts)""")

FEATURE_MEASURES = """count(*) AS n_events,
       count(DISTINCT ticket_id) AS n_tickets,
       CAST(sum(CASE WHEN is_escalated THEN 1 ELSE 0 END) AS BIGINT) AS n_escalated,
       round(avg(latency_ms), 2) AS avg_latency_ms,
       CAST(round_even(round(quantile_cont(latency_ms, 0.95), 6), 0) AS INT) AS p95_latency_ms,
       CAST(sum(tokens_in) AS BIGINT) AS tokens_in,
       CAST(sum(tokens_out) AS BIGINT) AS tokens_out"""

cte("feature_daily", ("silver_events",), f"""
SELECT event_date, customer_id, customer_name, segment,
       {FEATURE_MEASURES}
FROM silver_events GROUP BY 1, 2, 3, 4""")


def features_over(source: str, where: str = "TRUE") -> str:
    """The daily-feature aggregation over ``source`` rows matching ``where``."""
    return (f"SELECT event_date, customer_id, customer_name, segment,\n       {FEATURE_MEASURES}\n"
            f"FROM {source} WHERE {where} GROUP BY 1, 2, 3, 4")


def silver_tickets_before(cutoff: str) -> str:
    """Silver tickets rebuilt from change records that arrived before ``cutoff``."""
    return f"""SELECT ticket_id, customer_id, customer_name, segment, priority_clean AS priority,
       category, channel, status, csat, first_response_sec, subject, body,
       event_time AS updated_at, _ingested_at
FROM (SELECT * FROM cdc_clean
      WHERE priority_clean IS NOT NULL AND _ingested_at < TIMESTAMP '{cutoff} 00:00:00'
      QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY event_time DESC, cdc_seq DESC) = 1)
WHERE op <> 'd'"""


TRAINING_PROJECTION = """ticket_id, customer_id, customer_name, segment, priority, category, channel, status,
       csat, first_response_sec,
       CAST(length(subject) + length(body) AS INT) AS text_len,
       CASE WHEN status IN ('resolved', 'closed') THEN 1 ELSE 0 END AS label_resolved,
       updated_at, _ingested_at"""

# End state of replaying every arrival day: a record updates the training set
# on its arrival day iff no record arrived by then ranks above it; the last
# such non-tombstone record per ticket is what stays.
cte("training_set_incremental", ("cdc_clean",), f"""
SELECT {TRAINING_PROJECTION}
FROM (
    SELECT *, priority_clean AS priority, event_time AS updated_at
    FROM (
        SELECT *, CAST(_ingested_at AS DATE) AS arr FROM cdc_clean WHERE priority_clean IS NOT NULL
        QUALIFY coalesce(min(CAST(_ingested_at AS DATE)) OVER (
                    PARTITION BY ticket_id ORDER BY event_time DESC, cdc_seq DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > arr, TRUE))
    WHERE op <> 'd'
    QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY arr DESC) = 1)""")

# End state of replaying every arrival day with a 3-day lookback anchored on
# the target's newest event_date.
cte("feature_runs", ("silver_events",), """
SELECT run_date, m, lag(m) OVER (ORDER BY run_date) AS m_before
FROM (SELECT CAST(r AS DATE) AS run_date,
             (SELECT max(event_date) FROM silver_events s WHERE s.ingested_date <= CAST(r AS DATE)) AS m
      FROM generate_series((SELECT min(ingested_date) FROM silver_events)::TIMESTAMP,
                           (SELECT max(ingested_date) FROM silver_events)::TIMESTAMP,
                           INTERVAL 1 DAY) AS t(r))""")

cte("feature_last_run", ("feature_runs", "silver_events"), """
SELECT d.event_date, max(r.run_date) AS last_run
FROM (SELECT DISTINCT event_date FROM silver_events) d
JOIN (SELECT run_date,
             CASE WHEN run_date = (SELECT min(run_date) FROM feature_runs WHERE m IS NOT NULL)
                  THEN DATE '0001-01-01'
                  ELSE CAST(m_before - INTERVAL 3 DAY AS DATE) END AS t
      FROM feature_runs
      WHERE run_date >= (SELECT min(run_date) FROM feature_runs WHERE m IS NOT NULL)) r
  ON r.t <= d.event_date
GROUP BY 1""")

cte("feature_daily_incremental", ("feature_last_run", "silver_events"),
    features_over("silver_events s JOIN feature_last_run l USING (event_date)",
                  "s.ingested_date <= l.last_run"))
