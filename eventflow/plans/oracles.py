"""The same results in SQL for DuckDB, over the same tables. Written from the operators' definitions,
with joins, list functions and plain windows where the Spark side avoids them."""

from __future__ import annotations

_VIEWS = {
    "ev": """
      SELECT event_id, ts, user_id, event_type, value,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "bus": """
      SELECT CAST(event_id AS VARCHAR) AS id, ts AS time,
        concat('u', CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS traceid,
        user_id, k, value,
        CASE event_type
          WHEN 'signup' THEN CASE k % 4 WHEN 0 THEN 'UpgradeRequestedEvent'
            WHEN 1 THEN 'AccountDeactivationRequestedEvent' ELSE 'SignupRequestedEvent' END
          WHEN 'purchase' THEN 'PaymentReceivedEvent'
          WHEN 'error' THEN CASE k % 4 WHEN 0 THEN 'PaymentRefundedEvent'
            WHEN 1 THEN 'PaymentRefundFailedEvent' ELSE 'PaymentFailedEvent' END
          WHEN 'view' THEN CASE WHEN k % 10 = 0 THEN 'ProcessStartFailedEvent' ELSE 'AccountActivatedEvent' END
          ELSE 'NotificationSentEvent' END AS type,
        CASE WHEN event_type = 'click' THEN CASE k % 7 WHEN 0 THEN 'AccountActivationFailedEvent'
          WHEN 1 THEN 'SignupValidationFailedEvent' WHEN 2 THEN 'TechnicalError'
          WHEN 3 THEN 'PaymentReceivedEvent' WHEN 4 THEN 'UpgradeCompletedEvent'
          WHEN 5 THEN 'AccountDeactivatedEvent' ELSE 'SomethingUnknown' END END AS notification_type,
        CASE k % 4 WHEN 0 THEN 'free' WHEN 1 THEN 'PRO' WHEN 2 THEN 'Enterprise' ELSE 'GOLD' END AS tier,
        CAST(CASE WHEN event_type IN ('purchase', 'error') THEN CASE k % 4 WHEN 1 THEN 1900
          WHEN 2 THEN 9900 ELSE 0 END END AS BIGINT) AS payment_amount,
        CASE WHEN event_type = 'purchase' AND k % 9 <> 0
          THEN concat('tx-', CAST(event_id AS VARCHAR)) END AS transaction_id,
        (k % 2 = 1) AS retry_payment
      FROM ev""",
    "accounts": """
      SELECT c_custkey AS user_id,
        CASE WHEN c_custkey % 25 = 0 THEN '  ' ELSE c_name END AS name,
        CASE c_custkey % 10 WHEN 0 THEN 'invalid-email' WHEN 1 THEN '@example.com' WHEN 2 THEN 'user@'
          ELSE concat('u', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'gold' WHEN 'MACHINERY' THEN 'Pro'
          WHEN 'AUTOMOBILE' THEN 'ENTERPRISE' ELSE 'free' END AS tier
      FROM customer""",
    "deliveries": """
      SELECT CAST(l_linenumber % 3 + 1 AS INT) AS rf,
        CASE l_returnflag WHEN 'A' THEN 'all' WHEN 'R' THEN '1' ELSE '0' END AS acks,
        CASE l_linestatus WHEN 'F' THEN 'FAULT' ELSE 'BASELINE' END AS phase,
        CAST(l_orderkey % 4 AS INT) AS part, concat('c', CAST(l_suppkey % 2 AS VARCHAR)) AS consumer,
        (l_discount > 0) AS acked, (l_tax > 0) AS consumed,
        CAST(l_quantity AS BIGINT) AS latency_ms, l_shipdate AS cb_ts
      FROM lineitem""",
    "probes": """
      SELECT concat(l_returnflag, l_linestatus) AS label, CAST(l_quantity AS BIGINT) AS latency_ms,
        (l_discount > 0) AS ok, l_shipdate AS cb_ts, l_linenumber AS threads, (l_tax > 0) AS consumed
      FROM lineitem""",
    "samples": """
      SELECT user_id % 5 AS run, ts,
        CASE WHEN k % 7 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(k AS DOUBLE) / 100 END AS cpu_load,
        k * 1048576 + user_id AS heap_used, CAST(536870912 AS BIGINT) AS heap_max
      FROM ev""",
    "cluster_obs": """
      SELECT 't' AS topic, CAST(user_id % 3 AS INT) AS "partition", event_id AS obs_id, ts AS observed_at,
        CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k % 3 AS INT) END AS leader,
        CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN '1' WHEN 2 THEN '1,2' ELSE '2,1' END AS isr_text
      FROM ev""",
    "prices": "SELECT event_type AS symbol, ts, value AS price FROM events",
    "posts": """
      SELECT event_id AS post_id, ts, event_type AS topic,
        CASE WHEN k < 33 THEN -1 WHEN k < 66 THEN 0 ELSE 1 END AS score
      FROM ev WHERE k % 5 <> 0""",
    "attempts": """
      SELECT concat('s', CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS start_id,
        event_id, ts, (k % 3 = 0) AS ok,
        CASE WHEN k % 4 = 0 THEN ' ' ELSE concat('err', CAST(k % 3 AS VARCHAR)) END AS reason
      FROM ev""",
    "state": """
      SELECT traceid, CASE
        WHEN bool_or(type = 'ProcessStartFailedEvent') THEN 'START_FAILED'
        WHEN bool_or(coalesce(notification_type = 'SignupValidationFailedEvent', false)) THEN 'VALIDATION_FAILED'
        WHEN bool_or(coalesce(notification_type = 'AccountActivationFailedEvent', false)) THEN CASE
          WHEN bool_or(type = 'PaymentRefundedEvent') THEN 'COMPENSATED'
          WHEN bool_or(type = 'PaymentRefundFailedEvent') THEN 'REFUND_FOLLOW_UP'
          WHEN bool_or(type = 'PaymentReceivedEvent') THEN 'COMPENSATION_MISSING'
          ELSE 'ACTIVATION_FAILED_NO_CHARGE' END
        WHEN bool_or(type = 'AccountActivatedEvent') THEN CASE
          WHEN bool_or(type = 'PaymentFailedEvent') AND NOT bool_or(type = 'PaymentReceivedEvent')
          THEN 'ACTIVATED_UNPAID' ELSE 'ACTIVE' END
        WHEN bool_or(coalesce(notification_type = 'TechnicalError', false)) THEN 'TECHNICAL_ERROR'
        WHEN bool_or(type = 'PaymentReceivedEvent') THEN 'CHARGED_PENDING'
        WHEN bool_or(type = 'PaymentFailedEvent') THEN 'PAYMENT_FAILED'
        WHEN bool_or(type = 'SignupRequestedEvent') THEN 'PENDING'
        ELSE 'NO_REQUEST' END AS state
      FROM bus GROUP BY traceid""",
    "pay": """
      SELECT *, row_number() OVER (PARTITION BY traceid ORDER BY time, id) AS attempt,
        row_number() OVER (PARTITION BY traceid ORDER BY time DESC, id DESC) AS back
      FROM bus WHERE type IN ('PaymentReceivedEvent', 'PaymentFailedEvent')""",
    "starts": """
      SELECT start_id, count(*) AS attempts,
        CASE WHEN bool_or(ok) THEN 'started' WHEN count(*) >= 3 THEN 'dead_letter' ELSE 'retry' END AS outcome,
        CASE WHEN NOT bool_or(ok) AND count(*) >= 3 THEN
          CASE WHEN trim(arg_max(reason, (ts, event_id))) = '' THEN 'unknown'
            ELSE arg_max(reason, (ts, event_id)) END END AS reason,
        max(ts) AS last_at
      FROM attempts GROUP BY start_id""",
    "results": """
      SELECT rf, acks, phase, attempted, sent, failed, consumed, lost,
        CASE WHEN attempted > 0 THEN lost * 100.0::DOUBLE / attempted ELSE 0 END AS loss_rate,
        CASE WHEN attempted > 0 THEN consumed * 100.0::DOUBLE / attempted ELSE 100 END AS delivery_rate,
        CASE WHEN lost > 0 THEN 'DATA LOSS' WHEN failed > 0 THEN 'SURVIVED' ELSE 'PERFECT' END AS verdict
      FROM (SELECT *, greatest(CASE phase WHEN 'FAULT' THEN attempted ELSE sent END - consumed, 0) AS lost
        FROM (SELECT rf, acks, phase, count(*) AS attempted, count_if(acked) AS sent,
          count_if(NOT acked) AS failed, count_if(consumed) AS consumed
          FROM deliveries GROUP BY rf, acks, phase))""",
    "seen": """
      SELECT topic, "partition", obs_id, observed_at, coalesce(leader, -1) AS new_leader,
        lag(coalesce(leader, -1)) OVER w AS old_leader, isr_text AS new_isr, lag(isr_text) OVER w AS old_isr
      FROM cluster_obs WINDOW w AS (PARTITION BY topic, "partition" ORDER BY observed_at, obs_id)""",
    "changes": """
      SELECT symbol, ts, price, count(*) AS copies, min(base_price) AS base_price,
        CASE WHEN min(base_price) <> 0
          THEN (price - min(base_price)) / min(base_price) * 100.0::DOUBLE END AS change_percent
      FROM (SELECT symbol, ts, price, first_value(price) OVER (PARTITION BY symbol ORDER BY ts
        RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS base_price FROM prices)
      GROUP BY symbol, ts, price""",
    "windows": """
      SELECT topic, (epoch_us(ts) // 7200000000 - i) * 7200000000 AS window_start_us, count(*) AS posts
      FROM posts, range(3) AS r(i) GROUP BY ALL""",
    "means": """
      SELECT topic, epoch_us(ts) // 21600000000 * 21600000000 AS window_start_us,
        count(*) AS posts, avg(score) AS mean_score FROM posts GROUP BY ALL""",
    "spikes": """
      SELECT * FROM (SELECT *, lag(mean_score) OVER (PARTITION BY topic ORDER BY window_start_us) AS previous_mean
        FROM means) WHERE abs(mean_score - previous_mean) > 0.3""",
    "words": """
      SELECT doc_id, source, CAST(sum(CASE w WHEN 'the' THEN 1 WHEN 'this' THEN 1 WHEN 'from' THEN 1
        WHEN 'was' THEN -1 WHEN 'that' THEN -1 ELSE 0 END) AS BIGINT) AS score
      FROM (SELECT doc_id, source, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS w FROM documents)
      GROUP BY doc_id, source""",
    "ticks": """
      SELECT label, epoch_ms(cb_ts) AS ms, ok,
        min(epoch_ms(cb_ts)) OVER (PARTITION BY label) AS start_ms FROM probes""",
}
_NEEDS = {
    "bus": ["ev"], "samples": ["ev"], "cluster_obs": ["ev"], "posts": ["ev"], "attempts": ["ev"], "state": ["bus"],
    "pay": ["bus"], "starts": ["attempts"], "results": ["deliveries"], "seen": ["cluster_obs"],
    "changes": ["prices"], "windows": ["posts"], "means": ["posts"], "spikes": ["means"], "ticks": ["probes"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for view in [*_closure(_NEEDS.get(name, [])), name]:
            if view not in out:
                out.append(view)
    return out


def _sql(views: str, body: str, recursive: str = "") -> str:
    ctes = [f"{v} AS ({_VIEWS[v]})" for v in _closure(views.split())]
    if recursive:
        ctes.append(recursive)
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {body}" if ctes else body


def _summary(label: str, table: str, failed_too: bool = False) -> str:
    ok = "true" if failed_too else "ok"
    el = "((epoch_ms(max(cb_ts)) - epoch_ms(min(cb_ts))) / 1000.0::DOUBLE)"
    pct = ", ".join(
        f"coalesce(quantile_disc(latency_ms, {p / 100}) FILTER (WHERE {ok}), 0) AS p{p}" for p in (50, 95, 99)
    )
    return f"""SELECT {label}, count_if(ok) AS sent, count_if(NOT ok) AS failed, {el} AS elapsed_s,
      CASE WHEN {el} > 0 THEN count_if(ok) / {el} ELSE 0 END AS throughput,
      coalesce(CAST(sum(latency_ms) FILTER (WHERE {ok}) AS BIGINT) // count(latency_ms) FILTER (WHERE {ok}), 0) AS avg_ms,
      min(latency_ms) FILTER (WHERE {ok}) AS min_ms, max(latency_ms) FILTER (WHERE {ok}) AS max_ms, {pct}"""


def _floor(values: str, p: float) -> str:
    n = f"len({values})"
    return f"list_sort({values})[CAST(least(floor({n} * CAST({p} AS DOUBLE)), {n} - 1) AS BIGINT) + 1]"


_MESSAGE = "coalesce(notification_type, type)"
_OK_TEMPLATES = """CASE m WHEN 'SignupRequestedEvent' THEN 'signup' WHEN 'PaymentReceivedEvent' THEN 'payment_received'
  WHEN 'PaymentFailedEvent' THEN 'payment_failed' WHEN 'PaymentRefundedEvent' THEN 'refunded'
  WHEN 'PaymentRefundFailedEvent' THEN 'refund_failed' WHEN 'TechnicalError' THEN 'technical_error'
  WHEN 'SignupValidationFailedEvent' THEN 'validation_failed' WHEN 'AccountActivationFailedEvent' THEN 'activation_failed'
  WHEN 'UpgradeRequestedEvent' THEN 'upgrade_requested' WHEN 'UpgradeCompletedEvent' THEN 'upgrade_completed'
  WHEN 'UpgradePaymentFailedEvent' THEN 'upgrade_payment_failed'
  WHEN 'AccountDeactivationRequestedEvent' THEN 'deactivation_requested'
  WHEN 'AccountDeactivatedEvent' THEN 'deactivated' END"""

_ACCOUNT_STATE = _sql("bus", """SELECT 'u' || user_id AS account,
        coalesce(upper(arg_max(tier, (time, id)) FILTER (WHERE opened OR upgraded)), '') AS tier,
        arg_max(opened, (time, id)) FILTER (WHERE opened OR closed) AS active, epoch_us(max(time)) AS updated_at_us
      FROM (SELECT *, type = 'AccountActivatedEvent' AS opened,
          coalesce(notification_type = 'UpgradeCompletedEvent', false) AS upgraded,
          coalesce(notification_type = 'AccountDeactivatedEvent', false) AS closed FROM bus)
      WHERE opened OR upgraded OR closed GROUP BY user_id""")

ORACLES: dict[str, str] = {
    "outcome_summary": _sql("state", """SELECT state, count(*) AS traces,
      round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM state GROUP BY state"""),
    "trace_state": _sql("state", "SELECT traceid, state FROM state"),
    "trace_timeline": _sql("bus", """SELECT traceid, row_number() OVER (PARTITION BY traceid ORDER BY time, id) AS seq,
      id, type, epoch_us(time) AS time_us FROM bus"""),
    "payment_state": _sql("bus pay", """SELECT * FROM (SELECT t.traceid, CASE
        WHEN bool_or(t.type = 'PaymentReceivedEvent') THEN 'RECEIVED'
        WHEN bool_or(coalesce(t.notification_type = 'TechnicalError', false)) THEN 'ERROR'
        WHEN any_value(l.type) = 'PaymentFailedEvent' THEN
          CASE WHEN any_value(l.attempt) >= 3 OR NOT any_value(l.retry_payment) THEN 'CANCELLED' ELSE 'RETRYING' END
        END AS state, coalesce(any_value(l.attempt), 0) AS attempts
      FROM bus t LEFT JOIN (SELECT * FROM pay WHERE back = 1) l ON l.traceid = t.traceid
      GROUP BY t.traceid) WHERE state IS NOT NULL"""),
    "upgrade_state": _sql("bus", """SELECT traceid, CASE
        WHEN bool_or(coalesce(notification_type = 'UpgradeCompletedEvent', false)) THEN 'APPLIED'
        WHEN bool_or(coalesce(notification_type = 'UpgradePaymentFailedEvent', false)) THEN 'PAYMENT_FAILED'
        WHEN NOT bool_or(type = 'PaymentReceivedEvent') THEN
          CASE WHEN bool_or(type = 'PaymentFailedEvent') THEN 'PAYMENT_FAILED' ELSE 'REQUESTED' END
        WHEN upper(arg_max(tier, (time, id)) FILTER (WHERE type = 'UpgradeRequestedEvent'))
          IN ('PRO', 'ENTERPRISE') THEN 'PAID' ELSE 'STUCK' END AS state
      FROM bus GROUP BY traceid HAVING bool_or(type = 'UpgradeRequestedEvent')"""),
    "deactivation_state": _sql("bus", """SELECT traceid,
        CASE WHEN bool_or(coalesce(notification_type = 'AccountDeactivatedEvent', false))
          THEN 'DEACTIVATED' ELSE 'REQUESTED' END AS state
      FROM bus GROUP BY traceid HAVING bool_or(type = 'AccountDeactivationRequestedEvent')"""),
    "parallel_ready": _sql("bus", """SELECT traceid, n IS NOT NULL AS notification_done, e IS NOT NULL AS eligibility_done,
        n IS NOT NULL AND e IS NOT NULL AS ready,
        CASE WHEN n IS NOT NULL AND e IS NOT NULL THEN epoch_us(greatest(n, e)) END AS ready_at_us
      FROM (SELECT traceid, min(time) FILTER (WHERE type = 'NotificationSentEvent') AS n,
          min(time) FILTER (WHERE type LIKE 'Payment%' OR type = 'AccountActivatedEvent') AS e
        FROM bus GROUP BY traceid HAVING bool_or(type = 'SignupRequestedEvent'))"""),
    "ingress_routes": _sql("bus", """SELECT id,
        CASE WHEN k % 6 = 0 THEN sha256('trace:' || id) ELSE traceid END AS traceid,
        CASE type WHEN 'SignupRequestedEvent' THEN 'signup-process' WHEN 'UpgradeRequestedEvent'
          THEN 'upgrade-process' ELSE 'deactivation-process' END AS process_id,
        CASE WHEN k % 5 = 0 THEN sha256('user:' || id) ELSE 'u' || user_id END AS user_id,
        'User ' || user_id AS name, 'u' || user_id || '@example.com' AS email, tier,
        CASE WHEN type = 'UpgradeRequestedEvent' THEN 'free' END AS current_tier,
        CASE WHEN type = 'UpgradeRequestedEvent' THEN tier END AS target_tier,
        CASE WHEN type = 'AccountDeactivationRequestedEvent' THEN
          CASE WHEN k % 3 = 0 THEN '' ELSE 'r' || k END END AS reason,
        CASE WHEN type = 'SignupRequestedEvent' THEN k % 3 = 1 END AS force_activation_failure,
        CASE WHEN type = 'SignupRequestedEvent' THEN k % 4 = 2 END AS force_payment_failure,
        CASE WHEN type = 'SignupRequestedEvent' THEN k % 7 <> 0 END AS force_payment_error
      FROM bus WHERE type LIKE '%RequestedEvent'"""),
    "notification_routes": _sql("bus", """SELECT id, 'log' AS channel, CASE type WHEN 'SignupRequestedEvent' THEN 'signup'
          WHEN 'PaymentReceivedEvent' THEN 'payment_received' WHEN 'PaymentFailedEvent' THEN 'payment_failed'
          WHEN 'PaymentRefundedEvent' THEN 'refunded' ELSE 'refund_failed' END AS template,
        CAST(NULL AS BOOLEAN) AS sent, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS outcome_type
      FROM bus WHERE type = 'SignupRequestedEvent' OR type LIKE 'Payment%'
      UNION ALL
      SELECT id, 'command', CASE k % 7 WHEN 0 THEN 'activation_failed' WHEN 1 THEN 'validation_failed'
          WHEN 2 THEN 'technical_error' WHEN 3 THEN 'payment_received' WHEN 4 THEN 'upgrade_completed'
          WHEN 5 THEN 'deactivated' END,
        k % 7 <> 6 AND k % 10 <> 0,
        CASE WHEN k % 7 = 6 THEN 'unknown-notification-type' WHEN k % 10 = 0
          THEN 'notification-dispatch-failed' ELSE '' END,
        CASE WHEN k % 7 = 6 THEN NULL WHEN k % 10 = 0 THEN 'NotificationFailedEvent'
          ELSE 'NotificationSentEvent' END
      FROM bus WHERE notification_type IS NOT NULL"""),
    "message_classes": _sql("bus", f"""SELECT m.message, m.messages, d.kind, d.mechanism, d.kind IS NOT NULL AS classified
      FROM (SELECT {_MESSAGE} AS message, count(*) AS messages FROM bus GROUP BY 1) m
      LEFT JOIN (SELECT unnest(['SignupRequestedEvent', 'UpgradeRequestedEvent', 'AccountDeactivationRequestedEvent',
        'PaymentReceivedEvent', 'PaymentFailedEvent', 'PaymentRefundedEvent', 'PaymentRefundFailedEvent',
        'NotificationSentEvent', 'NotificationFailedEvent', 'AccountActivatedEvent', 'MarketAlertEvent',
        'SocialTrendEvent', 'ProcessStartFailedEvent']) AS message, 'Event' AS kind, 'log' AS mechanism) d
      USING (message)"""),
    "envelope_roundtrip": _sql("bus", """SELECT id, type, k % 50 = 0 AS type_mismatch,
        CASE WHEN k % 6 = 0 THEN ' ' ELSE traceid END AS traceid, epoch_us(time) AS time_us, 'tests' AS source,
        'application/json' AS datacontenttype, '1.0' AS specversion, CAST(NULL AS VARCHAR) AS correlationid,
        'events' AS event_group, 'User ' || user_id AS name,
        CASE WHEN k % 5 <> 0 THEN 'u' || user_id END AS user_id FROM bus"""),
    "events_by_type": _sql("bus", "SELECT type, count(*) AS events FROM bus GROUP BY type"),
    "scalar_functions": _sql("bus", """SELECT id, CASE WHEN k % 6 = 0 THEN sha256('trace:' || id) ELSE traceid END AS traceid,
        CASE WHEN k % 5 = 0 THEN sha256('user:' || id) ELSE 'u' || user_id END AS user_id,
        CASE WHEN k % 9 = 0 THEN 'data' ELSE '' END AS missing,
        ['true', 'true', '1', ' true ', '', '', 'TRUE', '12.7'][k % 8 + 1] AS text,
        ['true', 'true', '1', ' true ', 'none', 'none', 'TRUE', '12.7'][k % 8 + 1] AS text_or,
        k % 8 <= 3 AS lenient, k % 8 IN (0, 1, 6) AS parsed, k % 8 = 0 AS strict,
        CAST(CASE WHEN k % 8 = 2 THEN 1 ELSE 0 END AS BIGINT) AS whole,
        coalesce(payment_amount, 0) AS amount FROM bus"""),
    "validate_accounts": _sql("accounts", """SELECT user_id, CASE WHEN trim(name) = '' THEN 'name-missing'
        WHEN NOT regexp_full_match(email, '[^@](.*[^@])?') OR NOT contains(email, '@') THEN 'email-invalid'
        WHEN upper(tier) NOT IN ('FREE', 'PRO', 'ENTERPRISE') THEN 'tier-unsupported' END AS validation_error,
        upper(tier) AS tier FROM accounts"""),
    "price_accounts": _sql("accounts", """SELECT user_id, lower(tier) IN ('pro', 'enterprise') AS payment_required,
        CAST(CASE lower(tier) WHEN 'pro' THEN 1900 WHEN 'enterprise' THEN 9900 ELSE 0 END AS BIGINT) AS price_cents,
        CASE WHEN lower(tier) IN ('pro', 'enterprise') THEN 'paid' ELSE 'free' END AS branch FROM accounts"""),
    "upgrade_plan": _sql("accounts", """SELECT user_id, lower(tier) IN ('pro', 'enterprise') AS upgrade_applied,
        CASE WHEN lower(tier) NOT IN ('pro', 'enterprise') THEN 'UPGRADE_ERROR' END AS upgrade_error,
        CASE WHEN lower(tier) IN ('pro', 'enterprise') THEN upper(tier) END AS tier FROM accounts"""),
    "render_notifications": _sql("bus accounts", f"""SELECT id, template, CASE template
        WHEN 'signup' THEN '[EMAIL] Welcome to Example! | To: ' || email || ' | Dear ' || name || ', your ' || tier
          || ' signup is being processed.'
        WHEN 'payment_received' THEN '[EMAIL] Payment Confirmed! | To: ' || email || ' | Dear ' || name || ', your '
          || tier || ' subscription is now active.'
        WHEN 'payment_failed' THEN '[EMAIL] Payment Failed | To: ' || email || ' | Dear ' || name
          || ', we could not process payment for ' || tier || ' tier. Please try again or contact support.'
        WHEN 'technical_error' THEN '[EMAIL] Temporary Technical Issue | To: ' || email || ' | Dear ' || name
          || ', we hit a technical issue processing your ' || tier || ' signup. Our team has been notified.'
        WHEN 'validation_failed' THEN '[EMAIL] Signup Validation Failed | To: ' || email || ' | Dear ' || name
          || ', we could not validate your ' || tier || ' signup. Reason: '
          || CASE WHEN k % 2 = 0 THEN 'email-invalid' ELSE 'unknown' END
        WHEN 'activation_failed' THEN '[EMAIL] Account Activation Failed | To: ' || email || ' | Dear ' || name
          || ', we could not activate your ' || tier || ' account. '
          || CASE WHEN k % 5 = 0 THEN 'No charge was captured, so no refund was needed.'
             WHEN k % 5 <= 2 THEN 'Your payment was refunded successfully. Refund Transaction: rtx-' || id
             ELSE 'Refund is pending manual support follow-up.' END
        WHEN 'refunded' THEN '[EMAIL] Refund Completed | To: ' || email || ' | Your ' || tier
          || ' payment was refunded. Refund Transaction: rtx-' || id
        WHEN 'refund_failed' THEN '[EMAIL] Refund Pending Manual Follow-up | To: ' || email
          || ' | Automatic refund for your ' || tier || ' payment failed. Support will follow up manually.'
        WHEN 'upgrade_requested' THEN '[EMAIL] Upgrade Requested | To: ' || email || ' | Dear '
          || coalesce(name, 'user') || ', upgrade request FREE -> ' || target || ' is being processed.'
        WHEN 'upgrade_completed' THEN '[EMAIL] Upgrade Completed | To: ' || email || ' | Dear '
          || coalesce(name, 'user') || ', your plan was upgraded from FREE to ' || target || '.'
        WHEN 'deactivation_requested' THEN '[EMAIL] Deactivation Requested | To: ' || email || ' | Dear '
          || coalesce(name, 'user') || ', your deactivation request was received. Reason: '
          || CASE WHEN k % 3 = 0 THEN 'not-provided' ELSE 'r' || k END
        WHEN 'deactivated' THEN '[EMAIL] Account Deactivated | To: ' || email || ' | Dear '
          || coalesce(name, 'user') || ', your account has been deactivated at '
          || CASE WHEN k % 4 = 0 THEN 'unknown-time' ELSE '2024-02-01T00:00:00Z' END || '.'
        END || ' | Trace: ' || traceid AS text
      FROM (SELECT b.id, b.k, b.traceid, a.email, a.tier, CASE WHEN k % 11 <> 0 THEN a.name END AS name,
          CASE WHEN k % 13 <> 0 THEN 'PRO' ELSE 'UNKNOWN' END AS target, {_OK_TEMPLATES} AS template
        FROM (SELECT *, {_MESSAGE} AS m FROM bus) b JOIN accounts a USING (user_id))
      WHERE template IS NOT NULL"""),
    "chat_messages": _sql("bus", """SELECT id, kind AS chat_kind, CASE kind
        WHEN 'success' THEN '✅ *Payment succeeded*' || head || amount || nl || 'Transaction: ' || transaction_id
        WHEN 'failed' THEN '⚠️ *Payment failed (signup cancelled)*' || head || amount || nl
          || 'Notification: PaymentFailedEvent'
        ELSE '🚨 *Payment process error*' || nl || 'Trace ID: ' || traceid || nl || 'User ID: u' || user_id || rest
          || 'Payment amount: ' || coalesce(amount, '0') || nl || 'Context: payment-processing error (boundary)'
        END AS chat_text
      FROM (SELECT *, nl || 'Trace ID: ' || traceid || rest || 'Amount: ' AS head
        FROM (SELECT *, nl || 'Email: u' || user_id || '@example.com' || nl || 'Name: User ' || user_id || nl
            || 'Tier: ' || tier || nl AS rest
          FROM (SELECT *, chr(10) AS nl, CAST(payment_amount AS VARCHAR) AS amount,
            CASE WHEN type = 'PaymentReceivedEvent' THEN 'success' WHEN type = 'PaymentFailedEvent' THEN 'failed'
              WHEN notification_type = 'TechnicalError' THEN 'error' END AS kind FROM bus)))
      WHERE kind IS NOT NULL"""),
    "refund_plan": _sql("bus", """SELECT id, amount AS payment_amount, CASE WHEN skip THEN 'skip' ELSE 'refund' END AS refund_action,
        skip AS refund_skipped, skip OR ok AS refund_success,
        CASE WHEN NOT skip AND ok THEN sha256('refund:' || transaction_id) ELSE '' END AS refund_transaction_id,
        CASE WHEN skip THEN NULL WHEN ok THEN 'PaymentRefundedEvent' ELSE 'PaymentRefundFailedEvent' END AS event_type
      FROM (SELECT *, amount <= 0 OR transaction_id IS NULL AS skip, k % 10 <> 3 AS ok
        FROM (SELECT *, CASE WHEN k % 5 <= 1 THEN 0 ELSE payment_amount END AS amount
          FROM bus WHERE type = 'PaymentReceivedEvent'))"""),
    "domain_events": _sql("bus accounts", """SELECT sha256('shop:event:' || type || ':' || id) AS event_id, type, traceid,
        'shop' AS source, epoch_us(time) AS time_us, email, tier, payment_amount, transaction_id,
        CASE WHEN payment_amount IS NULL THEN '{}' ELSE '{"paymentAmount":' || payment_amount
          || coalesce(',"transactionId":"' || transaction_id || '"', '') || '}' END AS present
      FROM (SELECT id, traceid, time, email, tier, price AS payment_amount,
          CASE WHEN paid THEN 'PaymentReceivedEvent' ELSE 'PaymentFailedEvent' END AS type,
          CASE WHEN paid AND price > 0 THEN 'tx-' || id END AS transaction_id
        FROM (SELECT b.*, a.email, CAST(CASE b.tier WHEN 'Enterprise' THEN 9900 ELSE 0 END AS BIGINT) AS price,
            CASE WHEN k % 11 = 0 THEN false WHEN b.tier <> 'Enterprise' THEN true ELSE k % 3 <> 0 END AS paid
          FROM bus b JOIN accounts a USING (user_id) WHERE type = 'SignupRequestedEvent' AND k % 7 <> 0)
        UNION ALL
        SELECT b.id, traceid, time, a.email, b.tier, NULL, 'AccountActivatedEvent', NULL
        FROM bus b JOIN accounts a USING (user_id) WHERE type = 'SignupRequestedEvent' AND k % 10 <> 3)"""),
    "account_closures": _sql("bus", """SELECT id, false AS account_active, epoch_us(time) AS deactivated_at_us,
        CASE WHEN k % 3 = 0 THEN '' ELSE 'r' || k END AS deactivation_reason
      FROM bus WHERE type = 'AccountDeactivationRequestedEvent'"""),
    "payment_gates": _sql("bus", """SELECT CASE type WHEN 'PaymentReceivedEvent' THEN 'succeeded' WHEN 'PaymentFailedEvent'
          THEN 'failed' ELSE 'neither' END AS payment_branch,
        CASE tier WHEN 'PRO' THEN 'paid' ELSE 'neither' END AS tier_branch_v1,
        CASE WHEN tier IN ('PRO', 'Enterprise') THEN 'paid' ELSE 'free' END AS tier_branch,
        CASE WHEN k % 2 = 1 AND k % 5 < 3 THEN 'retry' ELSE 'cancel' END AS retry_branch,
        count(*) AS rows_in_branch FROM bus GROUP BY ALL"""),
    "request_outcome": _sql("bus pay", """SELECT r.traceid, r.id, r.type, coalesce(o.type, 'TIMEOUT') AS outcome,
        o.id AS outcome_id, epoch_us(o.time) AS outcome_time_us
      FROM bus r LEFT JOIN (
        SELECT r.id AS rid, arg_min(p, (p.time, p.id)) AS o FROM bus r JOIN pay p ON p.traceid = r.traceid
          AND p.time >= r.time AND p.time <= r.time + INTERVAL 6 HOURS
        WHERE r.type LIKE '%RequestedEvent' GROUP BY r.id) f ON f.rid = r.id
      WHERE r.type LIKE '%RequestedEvent'"""),
    "compensations": _sql("bus pay", """SELECT p.traceid, p.id AS payment_id, p.payment_amount, p.transaction_id,
        CASE WHEN p.payment_amount <= 0 OR p.transaction_id IS NULL THEN 'skip' ELSE 'refund' END AS refund_action
      FROM (SELECT *, row_number() OVER (PARTITION BY traceid ORDER BY time DESC, id DESC) AS r FROM bus
        WHERE type = 'PaymentReceivedEvent') p
      WHERE r = 1 AND EXISTS (SELECT 1 FROM bus f WHERE f.traceid = p.traceid
          AND f.notification_type = 'AccountActivationFailedEvent')
        AND NOT EXISTS (SELECT 1 FROM bus f WHERE f.traceid = p.traceid AND f.type LIKE 'PaymentRefund%')"""),
    "charged_not_activated": _sql("bus", """SELECT traceid, count(*) AS payments,
        CAST(sum(payment_amount) AS BIGINT) AS captured_cents, epoch_us(min(time)) AS first_paid_at_us
      FROM bus p WHERE type = 'PaymentReceivedEvent' AND NOT EXISTS (SELECT 1 FROM bus f WHERE f.traceid = p.traceid
        AND (f.type = 'AccountActivatedEvent' OR f.type LIKE 'PaymentRefund%')) GROUP BY traceid"""),
    "activated_unpaid": _sql("bus", """SELECT traceid, count(*) AS failed_payments FROM bus f
      WHERE type = 'PaymentFailedEvent'
        AND EXISTS (SELECT 1 FROM bus a WHERE a.traceid = f.traceid AND a.type = 'AccountActivatedEvent'
          AND a.tier IN ('PRO', 'Enterprise'))
        AND NOT EXISTS (SELECT 1 FROM bus p WHERE p.traceid = f.traceid AND p.type = 'PaymentReceivedEvent')
      GROUP BY traceid"""),
    "refund_follow_up": _sql("bus", """SELECT traceid, id AS refund_event_id, epoch_us(time) AS failed_at_us FROM (
        SELECT *, row_number() OVER (PARTITION BY traceid ORDER BY time DESC, id DESC) AS r FROM bus
        WHERE type = 'PaymentRefundFailedEvent') f
      WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM bus s WHERE s.traceid = f.traceid AND s.type = 'PaymentRefundedEvent'
        AND (s.time, s.id) > (f.time, f.id))"""),
    "payment_attempts": _sql("pay", """SELECT traceid, id, type, attempt, CASE WHEN type = 'PaymentFailedEvent' THEN
        CASE WHEN retry_payment AND attempt < 3 THEN 'retry' ELSE 'cancel' END END AS decision FROM pay"""),
    "retries_exhausted": _sql("pay", """SELECT traceid, attempt AS attempts, id AS last_id FROM pay
      WHERE back = 1 AND type = 'PaymentFailedEvent' AND attempt >= 3"""),
    "start_or_dead_letter": _sql("starts", """SELECT start_id, attempts, outcome, reason, epoch_us(last_at) AS last_at_us
      FROM starts"""),
    "dead_letter_events": _sql("starts", """SELECT sha256('ingress:event:ProcessStartFailedEvent:' || start_id) AS event_id,
        'ProcessStartFailedEvent' AS type, start_id AS traceid, 'SignupRequestedEvent' AS original_type, reason,
        '{"id":"' || start_id || '"}' AS original_message, epoch_us(last_at) AS failed_at_us
      FROM starts WHERE outcome = 'dead_letter'"""),
    "account_state": _ACCOUNT_STATE,
    "revenue_by_tier": _sql("bus", """SELECT upper(tier) AS tier,
        CAST(coalesce(sum(payment_amount) FILTER (WHERE type = 'PaymentReceivedEvent'), 0) AS BIGINT) AS captured_cents,
        CAST(coalesce(sum(payment_amount) FILTER (WHERE type = 'PaymentRefundedEvent'), 0) AS BIGINT) AS refunded_cents,
        CAST(sum(CASE type WHEN 'PaymentReceivedEvent' THEN payment_amount ELSE -payment_amount END) AS BIGINT) AS net_cents
      FROM bus WHERE type IN ('PaymentReceivedEvent', 'PaymentRefundedEvent') GROUP BY 1"""),
    "notification_audit": _sql("bus", """SELECT c.traceid, c.notification_type, c.commands, coalesce(o.outcomes, 0) AS outcomes,
        o.outcomes IS NULL AS missing
      FROM (SELECT traceid, type AS notification_type, count(*) AS commands FROM bus
        WHERE type LIKE '%RequestedEvent' OR type IN ('PaymentReceivedEvent', 'PaymentFailedEvent') GROUP BY ALL) c
      LEFT JOIN (SELECT traceid, notification_type, count(*) AS outcomes FROM bus
        WHERE type = 'NotificationSentEvent' GROUP BY ALL) o USING (traceid, notification_type)"""),
    "dead_letter_recovery": _sql("bus", """SELECT traceid, count(*) AS failures, 'SignupRequestedEvent' AS original_type,
        arg_max('err' || (k % 3), (time, id)) AS reason,
        EXISTS (SELECT 1 FROM bus p WHERE p.traceid = f.traceid AND p.time > max(f.time)
          AND p.type IN ('PaymentReceivedEvent', 'PaymentFailedEvent', 'AccountActivatedEvent')) AS recovered
      FROM bus f WHERE type = 'ProcessStartFailedEvent' GROUP BY traceid"""),
    "best_effort_loss": _sql("bus", """SELECT traceid, 'PaymentReceivedEvent' AS missing_type, count(*) AS successes
      FROM bus s WHERE notification_type IN ('PaymentReceivedEvent', 'AccountActivationFailedEvent')
        AND NOT EXISTS (SELECT 1 FROM bus p WHERE p.traceid = s.traceid AND p.type = 'PaymentReceivedEvent')
      GROUP BY traceid"""),
    "lost_orders": """SELECT o_orderkey, count(*) AS sends FROM orders o
      WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) GROUP BY o_orderkey""",
    "outbox_pending": _sql("bus", """SELECT id, type, traceid FROM bus
      WHERE type IN ('ProcessStartFailedEvent', 'AccountActivatedEvent') AND k % 2 = 0"""),
    "delivery_report": _sql("results", """SELECT c.rf, c.acks, c.phase, coalesce(attempted, 0) AS attempted,
        coalesce(sent, 0) AS sent, coalesce(failed, 0) AS failed, coalesce(consumed, 0) AS consumed,
        coalesce(lost, 0) AS lost, coalesce(loss_rate, 0) AS loss_rate,
        coalesce(delivery_rate, 100) AS delivery_rate, verdict, verdict IS NOT NULL AS tested
      FROM (VALUES (3, 'all', 'BASELINE'), (3, '1', 'BASELINE'), (3, '0', 'BASELINE'), (2, 'all', 'BASELINE'),
        (2, '1', 'BASELINE'), (2, '0', 'BASELINE'), (1, '1', 'BASELINE'), (1, '0', 'BASELINE'), (3, 'all', 'FAULT'),
        (3, '0', 'FAULT'), (1, '1', 'FAULT'), (1, '0', 'FAULT')) c(rf, acks, phase)
      LEFT JOIN results r ON r.rf = c.rf AND r.acks = c.acks AND r.phase = c.phase"""),
    "phase_comparison": _sql("results", """SELECT f.rf, f.acks, f.consumed AS fault_consumed, f.lost AS fault_lost,
        f.verdict AS fault_verdict, b.consumed AS base_consumed, b.lost AS base_lost, b.verdict AS base_verdict
      FROM results f JOIN results b ON b.rf = f.rf AND b.acks = f.acks AND b.phase = 'BASELINE'
      WHERE f.phase = 'FAULT'"""),
    "delivery_latency": _sql("deliveries results", f"""SELECT r.rf, r.acks, r.phase, r.attempted, r.sent, r.failed, r.consumed,
        r.lost, CASE WHEN el > 0 THEN r.sent / el ELSE 0 END AS throughput, l.max_ms, l.p50, l.p95, l.p99, r.verdict
      FROM results r JOIN (SELECT rf, acks, phase,
          (epoch_ms(max(cb_ts)) - epoch_ms(min(cb_ts))) / 1000.0::DOUBLE AS el,
          max(latency_ms) FILTER (WHERE acked) AS max_ms,
          {', '.join(f"coalesce({_floor('list(latency_ms) FILTER (WHERE acked)', p)}, 0) AS p{n}" for n, p in ((50, 0.5), (95, 0.95), (99, 0.99)))}
        FROM deliveries GROUP BY rf, acks, phase) l ON l.rf = r.rf AND l.acks = r.acks AND l.phase = r.phase"""),
    "offset_reset": _sql("bus", """SELECT 'earliest' AS policy, count_if(time <= TIMESTAMP '2024-01-16') AS sent_while_down,
        count(*) AS received, CAST(0 AS BIGINT) AS lost FROM bus
      UNION ALL SELECT 'latest', count_if(time <= TIMESTAMP '2024-01-16'), count_if(time > TIMESTAMP '2024-01-16'),
        count_if(time <= TIMESTAMP '2024-01-16') FROM bus"""),
    "partition_distribution": _sql("deliveries", """SELECT consumer, part, count(*) AS records FROM deliveries
      GROUP BY consumer, part"""),
    "group_totals": _sql("deliveries", """SELECT phase AS consumer_group, consumer, count(*) AS records FROM deliveries
      GROUP BY phase, consumer"""),
    "run_summary": _sql("probes", f"{_summary('label', 'probes')} FROM probes GROUP BY label"),
    "setting_comparison": _sql("probes", f"{_summary('label', 'probes', True)} FROM probes GROUP BY label"),
    "load_scaling": _sql("probes", f"""{_summary('threads', 'probes')}, count_if(consumed) AS consumed,
      CAST(count_if(consumed) AS DOUBLE) / count(*) AS verified_ratio FROM probes GROUP BY threads"""),
    "floor_percentiles": _sql("probes", f"""SELECT label, {', '.join(
        f"{_floor('list(latency_ms)', p)} AS p{n}" for n, p in ((50, 0.5), (95, 0.95), (99, 0.99)))}
      FROM probes WHERE ok GROUP BY label"""),
    "latency_since_start": _sql("ticks", f"""{_summary('label', 'ticks')} FROM (SELECT label, ok, ms - start_ms AS latency_ms,
      epoch_ms(ms) AS cb_ts FROM ticks) GROUP BY label"""),
    "throughput_buckets": _sql("ticks", """SELECT label, (ms - start_ms) // 2592000000 AS bucket, count(*) AS acks
      FROM ticks WHERE ok GROUP BY ALL"""),
    "throughput_stats": _sql("ticks", """, b AS (SELECT label, (ms - start_ms) // 86400000 AS bucket, count(*) AS acks
        FROM ticks WHERE ok GROUP BY ALL),
      d AS (SELECT s.label, coalesce(b.acks, 0) AS acks FROM (SELECT label, unnest(range(max(bucket) + 1)) AS bucket
        FROM b GROUP BY label) s LEFT JOIN b ON b.label = s.label AND b.bucket = s.bucket)
      SELECT label, count(*) AS buckets, avg(acks) AS avg_acks, min(acks) AS min_acks, max(acks) AS max_acks,
        false AS dense FROM b GROUP BY label
      UNION ALL SELECT label, count(*), avg(acks), min(acks), max(acks), true FROM d GROUP BY label"""),
    "send_counts": _sql("probes", """SELECT label, threads, count_if(ok) AS sent, count_if(NOT ok) AS failed FROM probes
      GROUP BY label, threads"""),
    "success_rate": _sql("probes", """SELECT label, count_if(ok) AS sent, count_if(NOT ok) AS failed,
      count_if(ok) * 100.0::DOUBLE / count(*) AS success_rate FROM probes GROUP BY label"""),
    "resource_summary": _sql("samples", """SELECT run, count(*) AS samples,
        round(coalesce(avg(cpu_load) FILTER (WHERE cpu_load >= 0), 0), 6) AS avg_cpu,
        coalesce(max(cpu_load) FILTER (WHERE cpu_load >= 0), 0) AS peak_cpu,
        CAST(sum(heap_used) AS BIGINT) // count(*) // 1048576 AS avg_heap_mb, max(heap_used) // 1048576 AS peak_heap_mb,
        arg_min(heap_max, ts) // 1048576 AS max_heap_mb FROM samples GROUP BY run"""),
    "progress": _sql("probes", """SELECT label, slot AS sampled_at_us, n AS processed,
        CAST(sum(n) OVER (PARTITION BY label ORDER BY slot) AS BIGINT) AS total
      FROM (SELECT label, (epoch_us(cb_ts) // 2592000000000 + 1) * 2592000000000 AS slot, count(*) AS n
        FROM probes GROUP BY ALL)"""),
    "progress_marks": _sql("probes", """SELECT label, epoch_us(cb_ts) AS at_us, record FROM (
        SELECT label, cb_ts, row_number() OVER (PARTITION BY label ORDER BY cb_ts) AS record FROM probes)
      WHERE record = 1 OR record % 1000 = 0"""),
    "consumer_lag": _sql("probes", """SELECT label, slot AS at_us, produced, processed, produced - processed AS lag FROM (
        SELECT label, slot, CAST(sum(sum(p)) OVER w AS BIGINT) AS produced, CAST(sum(sum(c)) OVER w AS BIGINT) AS processed
        FROM (SELECT label, (epoch_us(t) // 2592000000000 + 1) * 2592000000000 AS slot, p, c FROM (
          SELECT label, cb_ts AS t, 1 AS p, 0 AS c FROM probes
          UNION ALL SELECT label, cb_ts + to_hours(latency_ms), 0, 1 FROM probes WHERE consumed))
        GROUP BY label, slot WINDOW w AS (PARTITION BY label ORDER BY slot))"""),
    "event_type_counts": _sql("bus", """SELECT type, CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS events
      FROM bus GROUP BY ALL"""),
    "leader_changes": _sql("seen", """SELECT topic, "partition", obs_id, epoch_us(observed_at) AS observed_at_us, old_leader, new_leader
      FROM seen WHERE old_leader <> new_leader"""),
    "isr_changes": _sql("seen", """SELECT topic, "partition", obs_id, old_isr, new_isr FROM seen
      WHERE old_isr <> new_isr"""),
    "isr_set_changes": _sql("seen", """SELECT topic, "partition", obs_id, replace(old_isr, '2,1', '1,2') AS old_isr,
        replace(new_isr, '2,1', '1,2') AS new_isr FROM seen
      WHERE replace(old_isr, '2,1', '1,2') <> replace(new_isr, '2,1', '1,2')"""),
    "failover_time": _sql("seen", """SELECT topic, "partition", obs_id, epoch_us(observed_at) // 1000
        - lag(epoch_us(observed_at) // 1000) OVER (PARTITION BY topic, "partition" ORDER BY observed_at, obs_id) AS gap_ms
      FROM seen WHERE old_leader <> new_leader"""),
    "cluster_state": _sql("cluster_obs", """SELECT topic, "partition", epoch_us(observed_at) AS observed_at_us,
        coalesce(CAST(leader AS VARCHAR), 'NONE') AS leader, isr_text AS isr
      FROM cluster_obs QUALIFY row_number() OVER (PARTITION BY topic, "partition" ORDER BY observed_at DESC, obs_id DESC) = 1"""),
    "price_change": _sql("changes", """SELECT symbol, epoch_us(ts) AS ts_us, price, copies, base_price, change_percent
      FROM changes"""),
    "price_alerts": _sql("changes", """SELECT symbol, epoch_us(ts) AS ts_us,
        CASE WHEN change_percent < 0 THEN 'PRICE_DROP' ELSE 'PRICE_SPIKE' END AS alert_type, change_percent
      FROM changes WHERE symbol IN ('purchase', 'view') AND (change_percent < -3 OR change_percent > 5)"""),
    "volatility": _sql("prices", """SELECT DISTINCT symbol, epoch_us(ts) AS ts_us, prices, round(sd, 6) AS volatility FROM (
        SELECT symbol, ts, count(price) OVER w AS prices, stddev_samp(price) OVER w AS sd FROM prices
        WINDOW w AS (PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW))
      WHERE sd > 50"""),
    "alert_events": _sql("changes", """SELECT 'MarketAlertEvent' AS type, 'market_alert' AS template, 'scanner' AS source,
        epoch_us(ts) AS time_us, symbol, CASE WHEN change_percent < 0 THEN 'PRICE_DROP' ELSE 'PRICE_SPIKE' END AS alert_type,
        price, change_percent, true AS described FROM changes WHERE change_percent < -3 OR change_percent > 5"""),
    "rate_limited_alerts": _sql("posts", "SELECT topic, t AS ts_us FROM passed", recursive="""passed AS (
        SELECT topic, min(epoch_us(ts)) AS t FROM posts GROUP BY topic
        UNION ALL SELECT a.topic, min(epoch_us(p.ts)) FROM passed a JOIN posts p
          ON p.topic = a.topic AND epoch_us(p.ts) >= a.t + 21600000000 GROUP BY a.topic)"""),
    "topic_counts": _sql("windows", "SELECT topic, window_start_us, posts FROM windows"),
    "trending": _sql("windows", "SELECT topic, window_start_us, posts FROM windows WHERE posts > 3"),
    "sentiment_spike": _sql("spikes", """SELECT topic, window_start_us, posts, round(mean_score, 6) AS mean_score,
      round(previous_mean, 6) AS previous_mean FROM spikes"""),
    "trend_events": _sql("spikes", """SELECT 'SocialTrendEvent' AS type, 'social_trend' AS template, window_start_us AS time_us,
        '[ALERT] Social Trend: SENTIMENT_SPIKE | Topic: ' || topic || ' | Posts: ' || posts || ' | Sentiment: '
        || CASE WHEN mean_score > 0 THEN 'POSITIVE' WHEN mean_score < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END
        || ' | SENTIMENT_SPIKE on ''' || topic || ''' (' || posts || ' posts) | Trace: '
        || sha256('scanner:trace:SENTIMENT_SPIKE:' || topic || ':' || window_start_us) AS text FROM spikes"""),
    "keyword_match": """SELECT doc_id, keyword FROM documents, (SELECT unnest(['thre', 'ble', 'from']) AS keyword)
      WHERE contains(lower(text), keyword)""",
    "sentiment": _sql("words", """SELECT doc_id, score, CASE WHEN score > 0 THEN 'POSITIVE' WHEN score < 0 THEN 'NEGATIVE'
      ELSE 'NEUTRAL' END AS sentiment FROM words"""),
    "topic_sentiment": _sql("words", """SELECT source, count(*) AS posts, round(avg(score), 6) AS mean_score,
      CASE WHEN avg(score) > 0 THEN 'POSITIVE' WHEN avg(score) < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment
      FROM words GROUP BY source"""),
    "probe_payload": """SELECT l_orderkey AS seq, CASE WHEN l_linenumber % 4 <> 3 THEN l_partkey END AS sent_ms,
        CASE WHEN l_linenumber % 4 = 3 THEN CAST(l_linenumber AS BIGINT) END AS thread,
        CASE WHEN l_linenumber % 4 = 0 THEN l_linenumber END AS rf,
        CASE WHEN l_linenumber % 4 = 0 THEN 'all' END AS acks FROM lineitem""",
    "dedup_events": _sql("bus", "SELECT id, type, traceid, epoch_us(time) AS time_us FROM bus"),
    "tumbling_alerts": _sql("posts", """SELECT topic, min(epoch_us(ts)) AS ts_us FROM posts
      GROUP BY topic, epoch_us(ts) // 21600000000"""),
    "retry_branches": _sql("bus", """SELECT type, CASE WHEN retry_payment AND k % 5 < 3 THEN 'retry' ELSE 'cancel' END AS branch,
        count(*) AS payments FROM bus GROUP BY 1, 2"""),
    "notification_events": _sql("bus", """SELECT CASE WHEN k % 10 = 0 THEN 'NotificationFailedEvent' ELSE 'NotificationSentEvent' END AS type,
        notification_type, '' AS email, k % 10 <> 0 AS success, count(*) AS events
      FROM bus WHERE notification_type IS NOT NULL AND k % 7 <> 6 GROUP BY 1, 2, 3, 4"""),
    "landed_log": _sql("bus", """SELECT policy, type, count(*) AS events, (SELECT count(*) FROM bus) AS moved
      FROM (SELECT 'earliest' AS policy, type FROM bus UNION ALL
        SELECT 'latest', type FROM bus WHERE time > TIMESTAMP '2024-01-16') GROUP BY policy, type"""),
    "accepted_and_dead": _sql("bus", """SELECT 'good' AS side, count_if(k % 9 <> 0) AS records FROM bus
      UNION ALL SELECT 'dead', count_if(k % 9 = 0) FROM bus UNION ALL SELECT 'again', count_if(k % 9 = 0) FROM bus
      UNION ALL SELECT 'seen', count(*) FROM bus"""),
    "landed_requests": _sql("accounts", """SELECT 'SignupRequestedEvent' AS type, 'u' || user_id AS user_id, trim(name) AS name,
        CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END AS events, CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END AS traces FROM accounts"""),
    "split_payments": _sql("bus", """SELECT CASE type WHEN 'PaymentReceivedEvent' THEN 'succeeded' ELSE 'failed' END AS branch,
        count(*) AS payments, CAST(sum(payment_amount) AS BIGINT) AS cents FROM bus
      WHERE type IN ('PaymentReceivedEvent', 'PaymentFailedEvent') GROUP BY 1"""),
    "accepted_signups": _sql("accounts", """SELECT user_id, tier, CASE WHEN e IS NULL THEN sha256('shop:user:' || user_id) END AS new_id, e AS validation_error
      FROM (SELECT user_id, upper(tier) AS tier, CASE WHEN trim(name) = '' THEN 'name-missing'
        WHEN NOT regexp_full_match(email, '[^@](.*[^@])?') OR NOT contains(email, '@') THEN 'email-invalid'
        WHEN upper(tier) NOT IN ('FREE', 'PRO', 'ENTERPRISE') THEN 'tier-unsupported' END AS e FROM accounts)"""),
    "whole_numbers": _sql("bus", """SELECT CAST(id AS BIGINT) % 100 AS part, CAST(sum(CAST(w AS DECIMAL(38,0))) AS DOUBLE) AS total, count_if(w = 0) AS zeros
      FROM (SELECT id, CAST(CASE WHEN v IS NULL THEN 0 WHEN v >= 9223372036854775807 THEN 9223372036854775807
          WHEN v <= -9223372036854775808 THEN -9223372036854775808 ELSE CAST(trunc(v) AS BIGINT) END AS BIGINT) AS w
        FROM (SELECT id, CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN value * 1e18 WHEN 2 THEN value * -1e18 ELSE value - 50 END AS v FROM bus))
      GROUP BY 1"""),
    "demuxed_requests": _sql("bus", "SELECT type, tier, count(*) AS requests FROM bus WHERE type LIKE '%RequestedEvent' GROUP BY ALL"),
    "latest_log": _sql("bus", "SELECT type, count(*) AS events FROM bus WHERE k % 3 = 0 GROUP BY type"),
    "landed_requests_stream": _sql("accounts", """SELECT CAST(sum(n) AS BIGINT) AS moved, CAST(sum(n) AS BIGINT) AS ids, CAST(sum(n) AS BIGINT) AS in_both
      FROM (SELECT CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END AS n FROM accounts)"""),
    "outbox_relayed": _sql("bus", """SELECT type, count(*) AS records, count(*) AS events, CAST(3 AS INTEGER) AS relays FROM bus
      WHERE type IN ('ProcessStartFailedEvent', 'AccountActivatedEvent') GROUP BY type"""),
    "repeated_json_keys": _sql("bus", """SELECT type, CASE type WHEN 'SignupRequestedEvent' THEN 'signup-process'
          WHEN 'UpgradeRequestedEvent' THEN 'upgrade-process' ELSE 'deactivation-process' END AS process_id,
        CASE WHEN type = 'UpgradeRequestedEvent' THEN '' ELSE tier END AS tier,
        count(*) AS messages, count(*) AS ids, count(DISTINCT user_id) AS users
      FROM bus WHERE type LIKE '%RequestedEvent' GROUP BY ALL"""),
    "late_rows_stream": _sql("bus", """SELECT count_if(NOT late) AS kept, count_if(late) AS late FROM (SELECT time < TIMESTAMP '2024-01-16'
        AND epoch_us(time) <= (SELECT max(epoch_ms(time)) FROM bus WHERE time >= TIMESTAMP '2024-01-16') * 1000 - 20 * 86400000000 AS late FROM bus)"""),
    "events_by_type_stream": _sql("bus", """SELECT CASE WHEN type LIKE '%RequestedEvent' THEN type ELSE 'other' END AS type,
        type AS original_type, count(*) AS events FROM bus GROUP BY ALL"""),
    "signup_final_stream": _sql("bus state", """SELECT s.traceid, any_value(s.state) AS state, epoch_us(max(b.time)) AS last_at_us,
        CASE WHEN any_value(s.state) IN ('START_FAILED', 'VALIDATION_FAILED', 'COMPENSATED', 'REFUND_FOLLOW_UP', 'ACTIVATION_FAILED_NO_CHARGE',
          'ACTIVATED_UNPAID', 'ACTIVE', 'TECHNICAL_ERROR') THEN 'settled' ELSE 'idle' END AS ended
      FROM state s JOIN bus b ON b.traceid = s.traceid GROUP BY s.traceid"""),
    "written_report": _sql("results", """SELECT rf, acks, phase, attempted, sent, failed AS sendFailed, consumed, lost AS dropped
      FROM results"""),
    "started_requests": _sql("bus", """SELECT id, type, CASE WHEN k % 10 = 3 THEN 'dead letter' ELSE 'started' END AS outcome
      FROM bus WHERE type LIKE '%RequestedEvent'"""),
    "saga_state_stream": _sql("state", "SELECT traceid, state FROM state"),
    "account_state_stream": _ACCOUNT_STATE,
    "topic_counts_stream": _sql("windows", "SELECT topic, window_start_us, posts FROM windows"),
    "dedup_stream": _sql("bus", "SELECT id, type, traceid, epoch_us(time) AS time_us FROM bus"),
    # The stream answers are those of the batch: every request, every alert, every trace.
    "payment_timeouts_stream": _sql("bus pay", """SELECT r.traceid, r.id, r.type, coalesce(o.type, 'TIMEOUT') AS outcome,
        o.id AS outcome_id
      FROM bus r LEFT JOIN (
        SELECT r.id AS rid, arg_min(p, (p.time, p.id)) AS o FROM bus r JOIN pay p ON p.traceid = r.traceid
          AND p.time >= r.time AND p.time <= r.time + INTERVAL 6 HOURS
        WHERE r.type LIKE '%RequestedEvent' GROUP BY r.id) f ON f.rid = r.id
      WHERE r.type LIKE '%RequestedEvent'"""),
    "rate_limited_alerts_stream": _sql("posts", "SELECT topic, t AS ts_us FROM passed",
        recursive="""passed AS (
        SELECT topic, min(epoch_us(ts)) AS t FROM posts GROUP BY topic
        UNION ALL SELECT a.topic, min(epoch_us(p.ts)) FROM passed a JOIN posts p
          ON p.topic = a.topic AND epoch_us(p.ts) >= a.t + 21600000000 GROUP BY a.topic)"""),
    "sentiment_spike_stream": _sql("spikes", """SELECT topic, window_start_us, posts, round(mean_score, 6) AS mean_score,
      round(previous_mean, 6) AS previous_mean FROM spikes"""),
    # A trace covers one day, so it is one session.
    "signup_sessions_stream": _sql("bus state", """SELECT s.traceid, epoch_us(min(b.time)) AS first_at_us,
        epoch_us(max(b.time)) + 86400000000 AS closed_at_us, any_value(s.state) AS state
      FROM state s JOIN bus b ON b.traceid = s.traceid GROUP BY s.traceid"""),
    "choreography_stream": _sql("bus", """SELECT sha256('shop:event:' || e.type || ':' || e.id) AS event_id, e.type, e.traceid,
        'u' || user_id || '@example.com' AS email, tier, epoch_us(time) AS time_us
      FROM (SELECT b.id, b.traceid, b.user_id, b.tier, b.time,
          CASE WHEN n % 2 = 0 THEN 'PaymentReceivedEvent' ELSE 'PaymentFailedEvent' END AS type
        FROM bus b JOIN (SELECT traceid, count(*) AS n FROM bus GROUP BY traceid) d ON d.traceid = b.traceid
        WHERE b.type = 'SignupRequestedEvent' AND b.k % 6 <> 0) e"""),
}
