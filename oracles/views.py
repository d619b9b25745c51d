"""The input tables as SQL over the test tables ``events`` and ``nation`` (see FIXTURES.md).

Written apart from ``trialmetrics.sources.fixtures``, so that the comparison covers both.
"""

from __future__ import annotations

import re

VIEWS = {
    "v_assignment": """SELECT user_id, 'exp_a' AS experiment_id,
        CAST((user_id + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END) % 2 AS INT) AS variation_id,
        ts AS timestamp_assigned, CAST(ts AS DATE) AS event_date FROM events WHERE event_type IN ('signup', 'view')""",
    "v_first_visit": """SELECT user_id, MIN(CAST(ts AS DATE)) AS first_visit_date FROM events
        WHERE event_type = 'signup' GROUP BY user_id""",
    "v_active": """SELECT user_id, CAST(ts AS DATE) AS active_date,
        MAX(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS keep_alive_flag
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "v_subscribe": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, value AS revenue,
        (event_id % 3 = 0) AS new_subscription, (event_id % 5 <> 0) AS new_product_subscription
        FROM events WHERE event_type = 'purchase' AND event_id % 2 = 0""",
    "v_currency": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, value AS revenue,
        CASE WHEN event_id % 4 = 1 THEN 1 ELSE 0 END AS is_first_flux
        FROM events WHERE event_type = 'purchase' AND event_id % 2 = 1""",
    "v_all_purchase": """SELECT user_id, event_date, revenue, 'subscription' AS type FROM v_subscribe
        UNION ALL SELECT user_id, event_date, revenue,
        CASE WHEN event_id % 10 = 1 THEN 'gift' ELSE 'currency' END AS type FROM v_currency""",
    "v_ads": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, value / 1000 AS ad_revenue
        FROM events WHERE event_type = 'error'""",
    "v_session": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, value * 60000 AS duration FROM events""",
    "v_geo": """SELECT DISTINCT user_id, CAST(ts AS DATE) AS event_date, n_name AS country
        FROM events JOIN nation ON n_nationkey = user_id % 25 WHERE user_id % 10 <> 9""",
    "v_chat": """SELECT event_id, user_id, ts AS ingest_timestamp, CAST(ts AS DATE) AS event_date,
        user_id * 1000 + event_id % 7 AS conversation_id, event_id % 5 AS prompt_id,
        CASE event_id % 6 WHEN 0 THEN 'edit' WHEN 1 THEN 'continue' WHEN 2 THEN 'regenerate'
        WHEN 3 THEN 'generate' WHEN 4 THEN 'send' END AS method,
        CASE WHEN event_id % 3 = 0 THEN 'tag:Explore' ELSE 'home' END AS source
        FROM events WHERE event_type = 'click'""",
    "v_bot_view": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, event_id % 5 AS bot_id,
        CASE WHEN event_id % 3 = 0 THEN 'tag:Explore' ELSE 'home' END AS source
        FROM events WHERE event_type = 'view'""",
    "v_show_card": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, 'home' AS current_page,
        CASE WHEN event_id % 2 = 0 THEN 'Explore' ELSE 'Following' END AS tab_name
        FROM events WHERE event_type IN ('view', 'error')""",
    "v_follow": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date FROM events
        WHERE event_type = 'signup' AND event_id % 2 = 0""",
    "v_reset": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date FROM events
        WHERE event_type = 'error' AND event_id % 3 = 0""",
    "v_image": """SELECT event_id, user_id, CAST(ts AS DATE) AS event_date FROM events
        WHERE event_type = 'click' AND event_id % 4 = 0""",
    "v_apple": """SELECT user_id, event_id % 2 AS order_id, CAST(ts AS DATE) AS sub_date,
        CASE event_id % 3 WHEN 0 THEN 'SUBSCRIBED' WHEN 1 THEN 'DID_RENEW' ELSE 'DID_CHANGE_RENEWAL_STATUS' END
        AS notification_type, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS new_subscription
        FROM events WHERE event_type IN ('purchase', 'signup') AND user_id % 2 = 0""",
    "v_google": """SELECT user_id, event_id % 2 AS order_id, CAST(ts AS DATE) AS sub_date,
        CASE event_id % 3 WHEN 0 THEN '2' WHEN 1 THEN '4' ELSE '3' END AS notification_type,
        CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS new_subscription
        FROM events WHERE event_type IN ('purchase', 'signup') AND user_id % 2 = 1""",
    "v_business_user": """SELECT user_id, first_visit_date AS first_active_date FROM v_first_visit""",
    "v_daily_revenue": """SELECT user_id, CAST(ts AS DATE) AS event_date,
        SUM(CASE WHEN event_type = 'error' THEN value / 1000 END) AS ad_revenue,
        SUM(CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN value END) AS subscribe_revenue,
        SUM(CASE WHEN event_type = 'purchase' AND event_id % 2 = 1 THEN value END) AS flux_revenue
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "v_app_event": """SELECT user_id, CASE WHEN user_id % 10 = 9 THEN '{}'
        ELSE CONCAT('{"country":"', n_name, '"}') END AS geo FROM events JOIN nation ON n_nationkey = user_id % 25""",
    "v_user_aov": """SELECT user_id, CAST(user_id % 2 AS INT) AS variation_id, AVG(value) AS user_aov
        FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
}


HARD_EVENTS = """SELECT event_id, ts, CASE WHEN event_id % 29 <> 0 THEN user_id END AS user_id, event_type, value
    FROM events CROSS JOIN (VALUES (1), (2)) copies(n) WHERE n = 1 OR event_id % 7 = 0"""
HARD_VIEWS = {
    "v_assignment": """SELECT user_id, 'exp_a' AS experiment_id, CASE WHEN event_id % 31 = 0 THEN NULL
        WHEN CAST(ts AS DATE) > DATE '2024-01-28' THEN 3
        ELSE CAST((user_id + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END) % 3 AS INT) END AS variation_id,
        ts AS timestamp_assigned, CAST(ts AS DATE) AS event_date FROM events WHERE event_type IN ('signup', 'view')""",
    "v_chat": VIEWS["v_chat"].replace("event_id % 5 AS prompt_id", "event_id % 40 AS prompt_id"),
    "v_bot_view": VIEWS["v_bot_view"].replace("event_id % 5 AS bot_id", "event_id % 40 AS bot_id"),
}


def on_hard_events(sql: str) -> str:
    """The same SQL over events with repeated deliveries, NULLs, more variations and more bots."""
    for name, text in HARD_VIEWS.items():
        sql = sql.replace(VIEWS[name], text)
    if not sql.startswith("WITH "):
        raise ValueError("views are expected in front")
    return f"WITH hard_events AS ({HARD_EVENTS}), " + re.sub(r"\bevents\b", "hard_events", sql[len("WITH "):])


def with_views(body: str, **named: str) -> str:
    """``body`` behind the views it needs and the ``named`` common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    for text in (*named.values(), body):
        visit(text)
    parts = [f"{name} AS ({VIEWS[name]})" for name in needed]
    parts += [f"{name} AS ({text})" for name, text in named.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
