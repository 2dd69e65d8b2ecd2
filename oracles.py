"""SQL twins of the registered queries, for DuckDB over the same source tables."""

from __future__ import annotations

from agentlake.example_queries import SUITE_COLUMNS

RAW_EVENTS = """
keyed AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
typed AS (
  SELECT *,
    CASE event_type
      WHEN 'signup' THEN 'turn_start' WHEN 'click' THEN 'llm_request' WHEN 'view' THEN 'llm_response'
      WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'tool_call' ELSE 'tool_result' END
      ELSE CASE event_id % 4
        WHEN 0 THEN 'condense' WHEN 1 THEN 'todo_update' WHEN 2 THEN 'delegate' ELSE 'error' END
    END AS et
  FROM keyed),
raw_events AS (
  SELECT strftime(ts, '%Y-%m-%d') AS dt, 'app-' || user_id AS app_id,
    'conv-' || user_id || '-' || (event_id % 3) AS session_id, event_id,
    date_trunc('second', ts) AS ts, et AS event_type,
    CAST(CASE WHEN k = 50 THEN 5 WHEN k = 99 THEN 0 END AS BIGINT) AS turn_index,
    'agent' || (k % 2) AS agent_id, 'r' || (event_id // 4) AS request_id,
    'model' || (k % 3) AS model, 'provider' || (k % 2) AS provider,
    CASE WHEN et = 'llm_request' THEN k * 10 END AS input_tokens,
    CASE WHEN et = 'llm_response' THEN k END AS output_tokens,
    CASE WHEN et = 'llm_request' AND k % 2 = 0 THEN k END AS cache_tokens,
    CASE WHEN et = 'llm_response' AND k % 5 <> 0 THEN k * 3 END AS ttft_ms,
    CASE WHEN et = 'llm_response' AND k % 11 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS latency_ms,
    CASE WHEN et = 'tool_call' THEN 'tool' || (k % 7) END AS tool_name,
    CASE WHEN et = 'tool_result' THEN k * 9 END AS tool_latency_ms,
    CASE WHEN et = 'tool_result' AND k % 4 <> 0 THEN k % 3 END AS exit_code,
    CASE WHEN et = 'error' THEN 'E' || (k % 5) END AS error_type,
    CASE WHEN et = 'error' THEN 'C' || (k % 9) END AS error_code,
    CASE WHEN et = 'delegate' AND k % 6 <> 0 THEN '{"content":{"args":{"agent":"agent' || (k % 6) || '"}}}'
         WHEN et = 'delegate' THEN '{"content":{"args":{"agent":null}}}' ELSE '{}' END AS payload,
    'u' || user_id AS user_id, 'impl' || (event_id % 2) AS agent_impl,
    CASE WHEN k % 5 <> 0 THEN 'v' || (k % 3) END AS agent_version
  FROM typed)"""

GENERATION_STATUS = """
generation_status AS (
  SELECT 'app-' || o_custkey AS app_id,
    CASE WHEN o_custkey % 50 <> 0 THEN max(o_orderstatus) END AS app_status,
    min(o_orderpriority) AS app_type,
    CAST(sum(COALESCE(l_quantity, 0)) AS DOUBLE) AS duration_s,
    CAST(sum(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS react_rounds
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey)"""

CONVERSATION_META = """
conversation_meta AS (
  SELECT 'app-' || o_custkey AS app_id, 'conv-' || o_orderkey AS session_id, o_orderpriority AS llm_model,
    CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS total_tokens,
    CAST(floor(o_totalprice / 2) AS BIGINT) AS prompt_tokens,
    CAST(floor(o_totalprice / 4) AS BIGINT) AS completion_tokens,
    CASE WHEN o_orderkey % 17 = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(floor(o_totalprice / 100) AS DOUBLE) END AS accumulated_cost
  FROM orders)"""

# Turn starts counted within the session.
NUMBERED = """
numbered AS (
  SELECT * REPLACE (
    CAST(NULLIF(count(*) FILTER (WHERE event_type = 'turn_start') OVER so_far, 0) AS BIGINT) AS turn_index)
  FROM raw_events
  WINDOW so_far AS (PARTITION BY session_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))"""

# Explicit indexes open a segment; starts without one are counted inside it.
CARRIED = """
segmented AS (
  SELECT *, count(turn_index) OVER (PARTITION BY session_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seg
  FROM raw_events),
counted AS (
  SELECT *, max(turn_index) OVER (PARTITION BY session_id, seg) AS base,
    count(*) FILTER (WHERE turn_index IS NULL AND event_type = 'turn_start')
      OVER (PARTITION BY session_id, seg ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS starts
  FROM segmented),
carried AS (
  SELECT * EXCLUDE (seg, base, starts)
    REPLACE (CAST(CASE WHEN base IS NOT NULL THEN base + starts WHEN starts > 0 THEN starts END AS BIGINT) AS turn_index)
  FROM counted)"""

TURNS = """
turns AS (
  SELECT dt, app_id, session_id, turn_index, min(ts) AS start_ts, max(ts) AS end_ts,
    CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / CAST(1000 AS DOUBLE) AS duration_ms,
    CAST(NULL AS BIGINT) AS user_msg_event_id, CAST(NULL AS VARCHAR) AS query_level, CAST(NULL AS VARCHAR) AS mmu,
    CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'fail' ELSE 'success' END AS status,
    CAST(NULL AS VARCHAR) AS finish_event_type,
    count(*) FILTER (WHERE event_type = 'llm_request') AS react_iters,
    count(*) FILTER (WHERE event_type = 'llm_request') AS model_spans_count,
    count(*) FILTER (WHERE event_type = 'tool_call') AS tool_calls_count,
    count(*) FILTER (WHERE event_type = 'condense') AS condense_count,
    count(*) FILTER (WHERE event_type = 'todo_update') AS todo_update_count,
    count(*) FILTER (WHERE event_type = 'error') AS error_count,
    CAST(COALESCE(sum(input_tokens), 0) AS BIGINT) AS input_tokens,
    CAST(COALESCE(sum(output_tokens), 0) AS BIGINT) AS output_tokens,
    CAST(COALESCE(sum(cache_tokens), 0) AS BIGINT) AS cache_tokens,
    avg(ttft_ms) AS avg_ttft_ms, CAST(NULL AS DOUBLE) AS avg_otps
  FROM numbered WHERE turn_index IS NOT NULL GROUP BY dt, app_id, session_id, turn_index)"""

FIRST_ERROR = """
first_error AS (
  SELECT session_id, turn_index AS first_error_turn, error_type AS first_error_type
  FROM numbered WHERE event_type = 'error'
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY turn_index NULLS LAST, ts, event_id) = 1)"""

SESSION_META = """
session_meta AS (
  SELECT session_id, user_id, agent_impl, agent_version FROM raw_events
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) = 1)"""

TURNS_COMPACT = """
turns_compact AS (
  SELECT dt, app_id, session_id, turn_index,
    count(*) FILTER (WHERE event_type = 'llm_request') AS react_iters,
    count(*) FILTER (WHERE event_type = 'error') AS error_count,
    CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'fail' ELSE 'success' END AS status
  FROM carried WHERE turn_index IS NOT NULL GROUP BY dt, app_id, session_id, turn_index)"""

LABELS = """
labels AS (
  SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN concat_ws(' ', tool_name, 'e\u0301 a\u0308 Z\u030c', agent_id) END AS label
  FROM raw_events)"""

SESSIONS_COMPACT = """
SELECT dt, app_id, session_id, count(*) AS turns_count, count(*) FILTER (WHERE status = 'fail') AS error_turns
FROM turns_compact GROUP BY dt, app_id, session_id"""

# All sessions in one app; only some of them were treated.
TREATMENTS = """
treated AS (
  SELECT DISTINCT session_id, CASE right(session_id, 1) WHEN '0' THEN 'control' ELSE 'condense' END AS variant
  FROM raw_events WHERE right(session_id, 1) <> '2'),
app_turns AS (
  SELECT dt, 'app-all' AS app_id, session_id, turn_index, start_ts, end_ts, duration_ms, user_msg_event_id,
    query_level, mmu, status, finish_event_type, react_iters, model_spans_count, tool_calls_count, condense_count,
    todo_update_count, error_count, input_tokens, output_tokens, cache_tokens, avg_ttft_ms, avg_otps
  FROM turns),
impact AS (
  SELECT variant, avg(react_iters) AS avg_react_iters, avg(duration_ms) AS avg_turn_ms,
    avg(input_tokens) AS avg_in_tokens
  FROM app_turns JOIN treated USING (session_id)
  WHERE dt BETWEEN '2024-01-05' AND '2024-01-25' GROUP BY variant)"""

TOKEN_SUMMARY = """
SELECT app_id, session_id, llm_model, total_tokens, prompt_tokens, completion_tokens, accumulated_cost
FROM conversation_meta"""

ACTION_DISTRIBUTION = """
SELECT app_id, event_type, count(*) AS event_count FROM raw_events
WHERE event_type IS NOT NULL GROUP BY app_id, event_type"""

DURATION_SUMMARY = """
SELECT app_id, app_status, app_type, duration_s, react_rounds,
  CASE WHEN duration_s > 0 THEN round(duration_s / NULLIF(react_rounds, 0), 2) END AS seconds_per_round
FROM generation_status"""

THROUGHPUT = """
SELECT app_id, duration_s, most_out AS completion_tokens, most_in AS prompt_tokens,
  CASE WHEN duration_s > 0 THEN round(most_out / duration_s, 2) END AS output_tokens_per_sec,
  CASE WHEN duration_s > 0 THEN round((COALESCE(most_out, 0) + COALESCE(most_in, 0)) / duration_s, 2) END
    AS total_tokens_per_sec
FROM generation_status LEFT JOIN (
  SELECT app_id, session_id, max(output_tokens) AS most_out, max(input_tokens) AS most_in
  FROM raw_events WHERE output_tokens IS NOT NULL GROUP BY app_id, session_id) USING (app_id)"""

COST_EFFICIENCY = """
SELECT app_id, session_id, accumulated_cost, total_tokens, react_rounds, duration_s,
  CASE WHEN react_rounds > 0 THEN round(accumulated_cost / react_rounds, 2) END AS cost_per_round,
  CASE WHEN accumulated_cost > 0 THEN round(total_tokens / accumulated_cost, 2) END AS tokens_per_cost_unit
FROM conversation_meta LEFT JOIN generation_status USING (app_id)"""

AGENT_DELEGATION = """
SELECT app_id, session_id, delegated_agent, count(*) AS delegation_count
FROM (SELECT app_id, session_id, json_extract_string(payload, '$.content.args.agent') AS delegated_agent
      FROM raw_events WHERE event_type = 'delegate')
WHERE delegated_agent IS NOT NULL GROUP BY app_id, session_id, delegated_agent"""

TOOL_USAGE = """
SELECT tool_name, count(*) AS call_count, count(DISTINCT session_id) AS sessions_used
FROM raw_events WHERE tool_name IS NOT NULL GROUP BY tool_name"""

# Action and observation of the nested test events, and the type they map to.
VERBS = """
verbs AS (
  SELECT *,
    ['run', 'read', 'write', 'edit', 'call_tool_mcp', 'mcp', 'delegate', 'message', 'think', 'finish',
     'agent_state_changed', 'browse', '', NULL][k % 14 + 1] AS action,
    [NULL, '', 'run_output', 'run', 'read', 'write', 'edit', 'call_tool_mcp', 'mcp', 'delegate', 'message',
     'think', 'finish', 'agent_state_changed', 'browse', '', NULL][event_id % 17 + 1] AS observation
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
mapped AS (
  SELECT *, COALESCE(
    CASE WHEN action IN ('run', 'read', 'write', 'edit', 'call_tool_mcp', 'mcp') THEN 'tool_call'
         WHEN action IN ('delegate', 'message', 'think', 'finish', 'agent_state_changed') THEN action END,
    CASE WHEN observation IN ('run', 'read', 'write', 'edit', 'call_tool_mcp', 'mcp') THEN 'tool_call'
         WHEN observation IN ('delegate', 'message', 'think', 'finish', 'agent_state_changed') THEN observation END,
    NULLIF(observation, ''), NULLIF(action, ''), 'unknown') AS mapped_type,
    event_id % 11 <> 0 AS has_content, event_id % 7 <> 0 AS has_ext, k % 4 <> 0 AND event_id % 11 <> 0 AS has_llm
  FROM verbs),
flattened AS (
  SELECT 'app-' || user_id AS app_dir, 'conv-' || user_id || '-' || (event_id % 3) AS conv_dir,
    CASE WHEN has_content AND k % 10 <> 0 THEN strftime(ts, '%Y-%m-%d') ELSE '1970-01-01' END AS dt,
    CASE WHEN has_ext AND k % 3 = 2 THEN 'own-app' ELSE 'app-' || user_id END AS app_id,
    CASE WHEN k % 5 <> 0 THEN 's-' || user_id ELSE 'conv-' || user_id || '-' || (event_id % 3) END AS session_id,
    CAST(CASE WHEN event_id % 9 <> 0 THEN event_id ELSE 0 END AS BIGINT) AS event_id,
    CASE WHEN has_content AND k % 10 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS ts,
    CASE WHEN has_content THEN mapped_type ELSE 'unknown' END AS event_type,
    CASE WHEN has_content AND k % 4 = 0 THEN 'user' WHEN has_content AND k % 4 = 1 THEN 'agent'
         WHEN has_ext AND k % 2 = 0 THEN 'ext-source' END AS source,
    CASE WHEN has_ext THEN 'agent' || (k % 3) END AS agent_id,
    CAST(NULL AS VARCHAR) AS request_id, CAST(NULL AS VARCHAR) AS provider,
    CASE WHEN has_llm THEN k * 10 END AS input_tokens, CASE WHEN has_llm THEN k END AS output_tokens,
    CASE WHEN has_llm AND k % 2 = 0 THEN k + 1 END AS cache_tokens,
    CAST(NULL AS DOUBLE) AS ttft_ms, CAST(NULL AS DOUBLE) AS latency_ms,
    CASE WHEN has_content AND action IN ('run', 'read', 'write', 'edit', 'call_tool_mcp', 'mcp') THEN action END
      AS tool_name,
    CAST(NULL AS DOUBLE) AS tool_latency_ms, CAST(NULL AS INTEGER) AS exit_code,
    CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS error_code,
    CASE WHEN has_llm THEN CAST(k AS DOUBLE) / 4 END AS accumulated_cost,
    CASE WHEN event_id % 9 <> 0 THEN event_id END AS payload_event_id,
    CASE WHEN user_id % 7 <> 0 THEN 'model-' || (event_id % 3) || '-1' END AS own_model
  FROM mapped)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


_INDEXED = "SELECT dt, app_id, session_id, event_id, ts, event_type, turn_index FROM "
_FLAT = "SELECT * EXCLUDE (app_dir, conv_dir, own_model)"
#: Events of three crowded sessions.
_CROWDED = RAW_EVENTS.replace("raw_events AS", "all_events AS") + """,
raw_events AS (SELECT * REPLACE ('hot-' || (event_id % 3) AS session_id) FROM all_events)"""


def _suite() -> str:
    """Every row of every report: its key columns, and the sum of its numbers in hundredths."""
    parts = []
    for report, tables in SUITE_COLUMNS.items():
        for name, (keys, numbers) in tables.items():
            query = ORACLES["condense_join_rows" if name == "condense_rows" else name]
            total = " + ".join(f"COALESCE(CAST(round(100 * CAST({n} AS DOUBLE)) AS BIGINT), 0)" for n in numbers)
            parts.append(f"SELECT '{report}' AS report, '{name}' AS table_name, "
                         f"concat_ws('|', '', {', '.join(keys) or 'NULL'}) AS row_key, {total} AS hundredths FROM ({query})")
    return "\nUNION ALL\n".join(parts)


def _in_other_folders(flattened: str) -> str:
    """The nested events with an app for each 50 users and a conversation for each 5000 events."""
    for old, new in (
        ("'conv-' || user_id || '-' || (event_id % 3)", "'conv-' || (event_id // 5000)"),
        ("'app-' || user_id", "'app-' || (user_id % 50)"),
        ("user_id % 7", "(user_id % 50) % 7"),
        ("'model-' || (event_id % 3) || '-1'", "'model-' || (event_id // 5000) || '-1'"),
        ("AS payload_event_id", "AS payload_event_id, CASE WHEN has_content THEN action END AS payload_action,"
         " row_number() OVER (PARTITION BY user_id % 50, event_id // 5000 ORDER BY event_id) - 1 AS position"),
    ):
        assert old in flattened
        flattened = flattened.replace(old, new)
    return flattened


ORACLES: dict[str, str] = {
    "turn_index": _with(RAW_EVENTS, NUMBERED, select=_INDEXED + "numbered"),
    "turn_index_explicit": _with(RAW_EVENTS, CARRIED, select=_INDEXED + "carried"),
    "turn_index_cut": _with(_CROWDED, NUMBERED, select=_INDEXED + "numbered"),
    "turn_index_explicit_cut": _with(_CROWDED, CARRIED, select=_INDEXED + "carried"),
    "model_spans": _with(RAW_EVENTS, select="""
        SELECT q.dt, q.app_id, q.session_id, q.turn_index, q.request_id AS span_id,
          CAST(NULL AS VARCHAR) AS parent_span_id, q.agent_id, q.model, q.provider,
          q.ts AS start_ts, a.ts AS end_ts, a.ttft_ms, a.latency_ms, q.input_tokens, a.output_tokens, q.cache_tokens,
          CAST(a.output_tokens AS DOUBLE) * CAST(1000 AS DOUBLE)
            / CAST(CASE WHEN a.latency_ms < 1 THEN 1 ELSE a.latency_ms END AS DOUBLE) AS otps,
          CAST(NULL AS BIGINT) AS tool_intents_count, false AS malformed_tool_call
        FROM raw_events q JOIN raw_events a ON q.request_id = a.request_id
        WHERE q.event_type = 'llm_request' AND a.event_type = 'llm_response'"""),
    "tool_calls": _with(RAW_EVENTS, select="""
        SELECT q.dt, q.app_id, q.session_id, q.turn_index, q.request_id AS tool_call_id,
          CAST(NULL AS VARCHAR) AS parent_span_id, q.agent_id, q.tool_name,
          q.ts AS start_ts, a.ts AS end_ts, a.tool_latency_ms,
          CASE WHEN COALESCE(a.exit_code, 0) = 0 THEN 'ok' ELSE 'error' END AS status, a.exit_code, a.error_type,
          CAST(NULL AS BOOLEAN) AS patch_applied, CAST(NULL AS VARCHAR) AS patch_reject_reason,
          CAST(NULL AS DOUBLE) AS read_accuracy_score, CAST(NULL AS VARCHAR) AS artifacts
        FROM raw_events q JOIN raw_events a ON q.request_id = a.request_id
        WHERE q.event_type = 'tool_call' AND a.event_type = 'tool_result'"""),
    "turns": _with(RAW_EVENTS, NUMBERED, TURNS, select="SELECT * FROM turns"),
    "sessions": _with(RAW_EVENTS, NUMBERED, TURNS, FIRST_ERROR, SESSION_META, select="""
        SELECT s.dt, s.app_id, s.session_id, m.user_id, m.agent_impl, m.agent_version, s.start_ts, s.end_ts,
          CAST(epoch_us(s.end_ts) - epoch_us(s.start_ts) AS DOUBLE) / CAST(1000 AS DOUBLE) AS duration_ms,
          'success' AS status, CAST(NULL AS VARCHAR) AS success_reason, s.turns_count, s.model_spans_count,
          s.tool_calls_count, s.total_input_tokens, s.total_output_tokens, s.total_cache_tokens,
          CAST(NULL AS DOUBLE) AS total_cost_usd, e.first_error_turn, e.first_error_type
        FROM (
          SELECT dt, app_id, session_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts,
            count(turn_index) AS turns_count, CAST(sum(model_spans_count) AS BIGINT) AS model_spans_count,
            CAST(sum(tool_calls_count) AS BIGINT) AS tool_calls_count,
            CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens,
            CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens,
            CAST(sum(cache_tokens) AS BIGINT) AS total_cache_tokens
          FROM turns GROUP BY dt, app_id, session_id) s
        LEFT JOIN first_error e ON e.session_id = s.session_id
        LEFT JOIN session_meta m ON m.session_id = s.session_id"""),
    "first_error": _with(RAW_EVENTS, NUMBERED, FIRST_ERROR, select="SELECT * FROM first_error"),
    "session_meta": _with(RAW_EVENTS, SESSION_META, select="SELECT * FROM session_meta"),
    "turns_compact": _with(RAW_EVENTS, CARRIED, TURNS_COMPACT, select="SELECT * FROM turns_compact"),
    "errors": _with(RAW_EVENTS, CARRIED, select="""
        SELECT dt, app_id, session_id, turn_index, error_type, error_code FROM carried
        WHERE event_type = 'error' AND turn_index IS NOT NULL"""),
    "sessions_compact": _with(RAW_EVENTS, CARRIED, TURNS_COMPACT, select=SESSIONS_COMPACT),
    "token_summary": _with(CONVERSATION_META, select=TOKEN_SUMMARY),
    "token_distribution": _with(CONVERSATION_META, select="""
        SELECT min(total_tokens) AS min_total_tokens, quantile_cont(total_tokens, 0.25) AS q1_total_tokens,
          quantile_cont(total_tokens, 0.5) AS median_total_tokens, avg(total_tokens) AS mean_total_tokens,
          quantile_cont(total_tokens, 0.75) AS q3_total_tokens, max(total_tokens) AS max_total_tokens,
          min(prompt_tokens) AS min_prompt_tokens, quantile_cont(prompt_tokens, 0.5) AS median_prompt_tokens,
          avg(prompt_tokens) AS mean_prompt_tokens, max(prompt_tokens) AS max_prompt_tokens,
          min(completion_tokens) AS min_completion_tokens,
          quantile_cont(completion_tokens, 0.5) AS median_completion_tokens,
          avg(completion_tokens) AS mean_completion_tokens, max(completion_tokens) AS max_completion_tokens,
          min(accumulated_cost) AS min_cost, quantile_cont(accumulated_cost, 0.5) AS median_cost,
          avg(accumulated_cost) AS mean_cost, max(accumulated_cost) AS max_cost
        FROM conversation_meta"""),
    "model_breakdown": _with(CONVERSATION_META, select="""
        SELECT llm_model, count(*) AS conversation_count, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
          CAST(sum(prompt_tokens) AS BIGINT) AS total_prompt_tokens,
          CAST(sum(completion_tokens) AS BIGINT) AS total_completion_tokens, sum(accumulated_cost) AS total_cost,
          avg(total_tokens) AS avg_tokens_per_conv, avg(accumulated_cost) AS avg_cost_per_conv
        FROM conversation_meta GROUP BY llm_model"""),
    "duration_summary": _with(GENERATION_STATUS, select=DURATION_SUMMARY),
    "action_distribution": _with(RAW_EVENTS, select=ACTION_DISTRIBUTION),
    "throughput": _with(RAW_EVENTS, GENERATION_STATUS, select=THROUGHPUT),
    "success_summary": _with(GENERATION_STATUS, select="""
        SELECT app_status, count(*) AS app_count,
          round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM generation_status), 2) AS pct
        FROM generation_status GROUP BY app_status"""),
    "react_analysis": _with(GENERATION_STATUS, select="""
        SELECT app_id, app_status, react_rounds, duration_s,
          CASE WHEN react_rounds > 0 THEN round(duration_s / react_rounds, 2) END AS seconds_per_round,
          min_rounds, avg_rounds, max_rounds
        FROM generation_status, (SELECT min(react_rounds) AS min_rounds, avg(react_rounds) AS avg_rounds,
          max(react_rounds) AS max_rounds FROM generation_status)"""),
    "tool_usage": _with(RAW_EVENTS, select=TOOL_USAGE),
    "cost_efficiency": _with(GENERATION_STATUS, CONVERSATION_META, select=COST_EFFICIENCY),
    "agent_delegation": _with(RAW_EVENTS, select=AGENT_DELEGATION),
    "condense_impact": _with(RAW_EVENTS, NUMBERED, TURNS, TREATMENTS, select="SELECT * FROM impact"),
    "condense_join_rows": _with(RAW_EVENTS, NUMBERED, TURNS, TREATMENTS, select="""
        SELECT * FROM app_turns JOIN treated USING (session_id)"""),
    "event_type_map": _with(VERBS, select="SELECT event_id, mapped_type AS event_type FROM mapped"),
    "flatten_event": _with(VERBS, select=f"{_FLAT} FROM flattened"),
    "attach_model": _with(VERBS, select="""
        SELECT app_dir, conv_dir, event_id, event_type, own_model AS model FROM flattened"""),
    "event_files": _with(VERBS, select=f"""
        {_FLAT}, 'model-x' AS model FROM flattened, range(2) AS copies(n)""".replace(
            "own_model)", "own_model, n)")),
    **{name: _with(_in_other_folders(VERBS), select="""
        SELECT * EXCLUDE (app_dir, conv_dir, own_model), own_model AS model FROM flattened""") for name in ("log_tree", "log_tree_ranges")},
    "nested_rounds_sum": """
        SELECT CASE WHEN o_orderkey % 3 <> 0 THEN 'order-' || o_orderkey ELSE 'app-' || o_custkey END AS app_id,
          o_orderstatus AS app_status, o_orderpriority AS app_type,
          CASE WHEN o_orderkey % 7 <> 0 THEN 2 * floor(o_totalprice) ELSE CAST(0 AS DOUBLE) END AS duration_s,
          CAST(CASE WHEN o_orderkey % 7 <> 0 THEN 2 * (o_orderkey % 5) + 1 ELSE 0 END AS BIGINT) AS react_rounds,
          'first' AS first_query
        FROM orders""",
    "conversation_files": """
        SELECT CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 THEN 'own-' || o_custkey
                    ELSE 'app-' || o_custkey END AS app_id,
          'conv-' || o_orderkey AS session_id, o_orderpriority AS llm_model,
          CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS total_tokens,
          CAST(floor(o_totalprice / 2) AS BIGINT) AS prompt_tokens,
          CAST(floor(o_totalprice / 4) AS BIGINT) AS completion_tokens,
          floor(o_totalprice) / CAST(8 AS DOUBLE) AS accumulated_cost,
          strftime(o_orderdate, '%Y-%m-%d') AS created_at
        FROM orders""",
    "flat_events": _with(RAW_EVENTS, select="""
        SELECT dt, session_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, event_type, request_id, model, provider,
          input_tokens, output_tokens, cache_tokens, CAST(ttft_ms AS DOUBLE) AS ttft_ms,
          CAST(latency_ms AS DOUBLE) AS latency_ms, tool_name, CAST(tool_latency_ms AS DOUBLE) AS tool_latency_ms,
          exit_code
        FROM raw_events"""),
    "write_roundtrip": _with(RAW_EVENTS, select="SELECT * FROM raw_events"),
    "read_pruned": _with(RAW_EVENTS, select="""
        SELECT dt, session_id, event_id, event_type FROM raw_events
        WHERE dt BETWEEN '2024-01-05' AND '2024-01-25'"""),
    "read_partitions": _with(RAW_EVENTS, select="""
        SELECT dt, 'app-' || right(app_id, 1) AS app_id, count(*) AS events, count(DISTINCT session_id) AS sessions FROM raw_events
        WHERE (dt BETWEEN '2024-01-05' AND '2024-01-25' AND right(app_id, 1) IN ('2', '5')) OR (dt = '2024-01-28' AND right(app_id, 1) = '3')
        GROUP BY ALL"""),
    "snapshot_writes": _with(RAW_EVENTS, select="""
        SELECT CAST(version AS INTEGER) AS version, dt, event_type, count(*) AS events,
          CAST(sum(event_id) AS BIGINT) AS event_ids, CAST(sum(input_tokens) AS BIGINT) AS input_tokens
        FROM raw_events JOIN (VALUES (1, 0), (2, 1), (3, 1), (3, 2), (4, 1), (4, 2)) AS held(version, rest) ON event_id % 3 = rest
        GROUP BY version, dt, event_type"""),
    "equality_filter": _with(RAW_EVENTS, select="""
        SELECT event_id, agent_id, event_type, output_tokens FROM raw_events
        WHERE event_type = 'llm_response' AND agent_id = 'agent1' AND tool_name IS NULL"""),
    "sql_params": _with(RAW_EVENTS, select="""
        SELECT app_id, count(*) AS large_requests, max(input_tokens) AS largest FROM raw_events
        WHERE input_tokens >= 100 AND dt BETWEEN '2024-01-05' AND '2024-01-25' GROUP BY app_id"""),
    "report_json": _with(GENERATION_STATUS, select=DURATION_SUMMARY),
    "apply_single": _with(RAW_EVENTS, CARRIED, TURNS_COMPACT, select=SESSIONS_COMPACT),
    "apply_multi": _with(RAW_EVENTS, CARRIED, TURNS_COMPACT, select="""
        SELECT dt, app_id, session_id, turn_index, 'turn' AS output, status AS value FROM turns_compact
        UNION ALL
        SELECT dt, app_id, session_id, turn_index, 'error' AS output, error_type AS value FROM carried
        WHERE event_type = 'error' AND turn_index IS NOT NULL"""),
    "batch_arrow": _with(RAW_EVENTS, LABELS, select="SELECT event_id, nfc_normalize(label) AS label FROM labels"),
    "batch_arrow_multi": _with(RAW_EVENTS, select="""
        SELECT event_id, input_tokens AS tokens, CAST(NULL AS BIGINT) AS latency_ms FROM raw_events
        WHERE event_type = 'llm_request'
        UNION ALL
        SELECT event_id, CAST(NULL AS BIGINT) AS tokens, latency_ms FROM raw_events
        WHERE event_type = 'llm_response'"""),
    "batch_pandas": _with(RAW_EVENTS, LABELS, select="SELECT event_id, strip_accents(label) AS label FROM labels"),
    "batch_sessions": _with(RAW_EVENTS.replace("raw_events AS (", "plain_events AS ("), """
        raw_events AS (
          SELECT * REPLACE (CASE WHEN event_id % 4 = 0 THEN 'hot' ELSE session_id END AS session_id) FROM plain_events)""",
        CARRIED, TURNS_COMPACT, """
        in_turns AS (
          SELECT dt, app_id, session_id, turn_index, count(*) AS errors, min(error_type) AS first_type, max(error_code) AS last_code
          FROM carried WHERE event_type = 'error' AND turn_index IS NOT NULL GROUP BY ALL)""", select="""
        SELECT dt, app_id, session_id, turn_index, react_iters, error_count, errors, first_type, last_code
        FROM turns_compact LEFT JOIN in_turns USING (dt, app_id, session_id, turn_index)"""),
    "batch_sql": _with(RAW_EVENTS, select="""
        SELECT event_type, count(*) AS events, max(input_tokens) AS largest FROM raw_events GROUP BY event_type"""),
}
ORACLES["agent_delegation_parsed"] = ORACLES["agent_delegation"]
ORACLES["tool_usage_numbered"] = ORACLES["tool_usage"]
ORACLES["sessions_bucketed"] = ORACLES["sessions"]
ORACLES["report_suite"] = _suite()
