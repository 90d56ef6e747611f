"""Streaming plans replayed over the events table; each stream's result equals the batch one."""

from pyspark.sql import functions as F

from ..streaming import jobs as J
from ..streaming import timed as T
from .tables import events

QUERIES = {
    "stream_windows": (
        lambda s, d: J.replayed(s, d, lambda e: J.window_sums(e, "1 day", "0 seconds"), "append").where("event_type <> 'close'").select("day", "event_type", "n", F.round("total", 4).alias("total")),
        "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    ),
    "stream_sessions": (
        lambda s, d: J.replayed(s, d, lambda e: J.sessions(e, "30 minutes"), "append").where("user_id >= 0"),
        """WITH l AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 1800000000 THEN 1 ELSE 0 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        k AS (SELECT user_id, ts, sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM l) SELECT user_id, min(ts) AS started, count(*) AS n FROM k GROUP BY user_id, s""",
    ),
    "stream_count_flush": (
        lambda s, d: J.replayed(s, d, lambda e: J.count_flush(e, 20), "update").groupBy("user_id", "flush").agg(F.max("n").alias("n")),
        "WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, unnest(range(0, n // 20)) AS flush, CAST(20 AS BIGINT) AS n FROM c",
    ),
    "stream_dedup": (
        lambda s, d: J.replayed(s, d, lambda e: J.once(e.unionByName(e), "event_id", "400 days").select("event_id", "event_type"), "append").where("event_type <> 'close'"),
        "SELECT event_id, event_type FROM events",
    ),
    "stream_late": (
        lambda s, d: J.replayed(s, d, lambda e: J.window_sums(e, "1 day", "2 days"), "append", late="event_id % 10 = 0 and ts < timestamp_ntz'2024-01-05 00:00:00'").where("event_type <> 'close'").select("day", "event_type", "n"),
        "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events WHERE NOT (event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-05 00:00:00') GROUP BY ALL",
    ),
    "stream_asof": (
        lambda s, d: J.replayed(s, d, lambda e: J.nearest_merge(e, "click", "view"), "append"),
        """WITH n AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us, max(CASE WHEN event_type = 'view' THEN (epoch_us(ts), event_id) END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
        min(CASE WHEN event_type = 'view' THEN (epoch_us(ts), event_id) END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM events WHERE event_type IN ('click', 'view'))
        SELECT user_id, event_id, CASE WHEN us - b[1] < a[1] - us THEN b[2] ELSE a[2] END AS other, least(coalesce(us - b[1], a[1] - us), a[1] - us) AS gap_us FROM n WHERE event_type = 'click' AND a IS NOT NULL""",
    ),
    "stream_timeout": (
        lambda s, d: J.replayed(s, d, lambda e: J.releases(e, "value < 40", 2), "append"),
        """WITH o AS (SELECT user_id, event_id, ts, value < 40 AS bad, sum(CASE WHEN value < 40 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM events)
        SELECT user_id, event_id FROM o WHERE bad QUALIFY row_number() OVER (PARTITION BY user_id, run ORDER BY ts) = 3""",
    ),
    "ready_to_join": (
        lambda s, d: J.ready_to_join(events(s, d).where("event_type = 'click'"), events(s, d).where("event_type = 'view'"), ["user_id"], "ts", 40000.0),
        "SELECT user_id, coalesce(max(epoch_us(ts)) FILTER (event_type = 'view') >= max(epoch_us(ts)) FILTER (event_type = 'click') - 40000000000, false) AS ready FROM events GROUP BY ALL HAVING count(*) FILTER (event_type = 'click') > 0",
    ),
    "stream_ledger": (
        lambda s, d: J.ledger(s, d),
        "SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'view')",
    ),
    "stream_marked_sessions": (
        lambda s, d: J.replayed(s, d, lambda e: T.marked_sessions(e, ["signup"], ["purchase", "error"], 2 * T.DAY), "append"),
        """WITH o AS (SELECT *, CASE WHEN event_type = 'signup' OR lag(event_type) OVER w IN ('purchase', 'error') OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 172800000000 THEN 1 ELSE 0 END AS fresh,
        lead(ts) OVER w AS following FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM o),
        k AS (SELECT user_id, session, min_by(event_type, ts) AS first, max_by(event_type, ts) AS last, min(ts) AS started, max(ts) AS ended, max(coalesce(following, TIMESTAMP '2999-01-01')) AS following, count(*) AS n FROM g GROUP BY user_id, session)
        SELECT user_id, epoch_us(started) AS started, CASE WHEN last IN ('purchase', 'error') THEN epoch_us(ended) WHEN epoch_us(following) - epoch_us(ended) <= 172800000000 THEN epoch_us(following) ELSE epoch_us(ended) + 172800000000 END AS ended,
        n - CASE WHEN last IN ('purchase', 'error') THEN 2 ELSE 1 END AS n, CASE WHEN last IN ('purchase', 'error') THEN 'stopped' WHEN epoch_us(following) - epoch_us(ended) <= 172800000000 THEN 'restarted' ELSE 'silent' END AS how
        FROM k WHERE first = 'signup'""",
    ),
    "stream_silence": (
        lambda s, d: J.replayed(s, d, lambda e: T.silences(e, T.DAY), "append"),
        """SELECT user_id, event_id, epoch_us(ts) + 86400000000 AS released FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following FROM events)
        WHERE following IS NULL OR epoch_us(following) - epoch_us(ts) > 86400000000""",
    ),
    "stream_asof_bounded": (
        lambda s, d: J.replayed(s, d, lambda e: T.nearest_within(e, "click", "view", T.DAY // 2), "append"),
        """WITH n AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us, max(CASE WHEN event_type = 'view' THEN (epoch_us(ts), event_id) END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
        min(CASE WHEN event_type = 'view' THEN (epoch_us(ts), event_id) END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM events WHERE event_type IN ('click', 'view')),
        q AS (SELECT user_id, event_id, CASE WHEN us - b[1] <= 43200000000 THEN us - b[1] END AS back, CASE WHEN a[1] - us <= 43200000000 THEN a[1] - us END AS ahead, b[2] AS earlier, a[2] AS later FROM n WHERE event_type = 'click')
        SELECT user_id, event_id, CASE WHEN ahead IS NULL OR back < ahead THEN earlier ELSE later END AS other, least(back, ahead) AS gap_us FROM q WHERE back IS NOT NULL OR ahead IS NOT NULL""",
    ),
    "stream_timed_flush": (
        lambda s, d: J.replayed(s, d, lambda e: T.timed_flush(e, 5, T.DAY), "append"),
        """WITH o AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 86400000000 THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM o),
        r AS (SELECT *, (row_number() OVER (PARTITION BY user_id, run ORDER BY ts) - 1) // 5 AS part FROM g)
        SELECT user_id, min(epoch_us(ts)) AS started, count(*) AS n FROM r GROUP BY user_id, run, part""",
    ),
}
