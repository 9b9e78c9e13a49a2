"""The registered queries in plain SQL, by other means: self-joins instead of windows.

``events`` and tables without zone are UTC. ``epoch_us // 1000`` gives whole milliseconds.
"""

from __future__ import annotations

import math

HOUR = 3_600_000
DAY = 24 * HOUR
LINE_RATE = math.log(2) / (1000 * HOUR)
EVENT_RATE = math.log(2) / (6 * HOUR)
SHORT_RATE = math.log(2) / (HOUR // 6)
BLOCK = 256


def _weight(column: str) -> str:
    return (
        f"CAST(CASE {column} WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 3 "
        "ELSE 0 END AS DOUBLE)"
    )


_EVENT_TYPE = (
    "CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 "
    "WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS INTEGER)"
)

EVENT_ACTIONS = f"""
SELECT user_id, {_EVENT_TYPE} AS action_type,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS creation_id,
       epoch_us(ts) // 1000 AS action_ts, epoch_us(ts) AS arrival_us,
       event_id AS arrival_seq, CAST(0 AS BIGINT) AS pos
FROM events"""


def _line_actions(arrival: str = "shipping") -> str:
    clock = (
        "epoch_us(l_shipdate)"
        if arrival == "shipping"
        else "(883612800000 + l_orderkey * 60000) * 1000"
    )
    return f"""
SELECT l_suppkey AS user_id, CAST(l_linenumber AS INTEGER) AS action_type,
       l_partkey AS creation_id, epoch_us(l_shipdate) // 1000 AS action_ts,
       {clock} AS arrival_us, l_orderkey * 100 + l_linenumber AS arrival_seq,
       epoch_us(l_shipdate) // 1000 AS pos
FROM lineitem"""


def _versions(first: str, again: str) -> str:
    return f"""
SELECT p_partkey AS creation_id, p_type AS category,
       epoch_us(TIMESTAMP '{first}') AS arrival_us, p_partkey AS arrival_seq FROM part
UNION ALL
SELECT p_partkey, p_brand, epoch_us(TIMESTAMP '{again}'), p_partkey
FROM part WHERE p_size > 25"""


EVENT_VERSIONS = _versions("2024-01-03", "2024-01-15")
LINE_VERSIONS = _versions("1998-01-02", "1998-01-05")

# CTEs that expect `actions` and, where they enrich, `versions`.
_ENRICHED = """
enriched AS (
  SELECT a.*, v.category FROM actions a ASOF JOIN versions v
  ON a.creation_id = v.creation_id AND a.arrival_us >= v.arrival_us)"""


def _scored_by_event(source: str, rate: float) -> str:
    """Sum over every action not later in event order."""
    return f"""
scored AS (
  SELECT a.*, s.score FROM {source} a JOIN (
    SELECT x.creation_id, x.action_ts, x.arrival_us, x.arrival_seq, x.pos,
           sum({_weight('y.action_type')} * exp(-{rate!r} * (x.action_ts - y.action_ts))) AS score
    FROM {source} x JOIN {source} y
    ON x.creation_id = y.creation_id
       AND (y.action_ts, y.arrival_us, y.arrival_seq, y.pos)
           <= (x.action_ts, x.arrival_us, x.arrival_seq, x.pos)
    GROUP BY ALL) s
  USING (creation_id, action_ts, arrival_us, arrival_seq, pos))"""


def _scored_by_arrival(source: str, rate: float) -> str:
    """Decay clock from the forward steps, then a sum over every earlier arrival."""
    return f"""
steps AS (
  SELECT *, greatest(0, coalesce(action_ts - lag(action_ts) OVER w, 0)) AS step,
         row_number() OVER w AS place
  FROM {source}
  WINDOW w AS (PARTITION BY creation_id ORDER BY arrival_us, arrival_seq, pos)),
clocked AS (
  SELECT *, CAST(sum(step) OVER (PARTITION BY creation_id ORDER BY place) AS BIGINT) AS clock
  FROM steps),
scored AS (
  SELECT a.*, s.score FROM clocked a JOIN (
    SELECT x.creation_id, x.place,
           sum({_weight('y.action_type')} * exp(-{rate!r} * (x.clock - y.clock))) AS score
    FROM clocked x JOIN clocked y ON x.creation_id = y.creation_id AND y.place <= x.place
    GROUP BY ALL) s
  USING (creation_id, place))"""


def _latest(size: int) -> str:
    return f"""
latest AS (
  SELECT *, arrival_us // 1000 // {size} * {size} AS window_start,
         (arrival_us // 1000 // {size} + 1) * {size} AS window_end
  FROM scored
  QUALIFY row_number() OVER (
    PARTITION BY creation_id, arrival_us // 1000 // {size}
    ORDER BY action_ts DESC, arrival_us DESC, arrival_seq DESC, pos DESC) = 1)"""


def _windowed(rate: float) -> str:
    return f"""
windowed AS (
  SELECT creation_id, category,
         round(score * exp(-{rate!r} * greatest(0, window_end - action_ts)), 6) AS score,
         action_ts AS last_action_ts, window_start, window_end
  FROM latest)"""


_TOP = """
newest AS (
  SELECT * FROM windowed WHERE category IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY category, creation_id ORDER BY window_end DESC) = 1)
SELECT category, creation_id, score, window_end,
       CAST(row_number() OVER best AS INTEGER) AS rank
FROM newest
WINDOW best AS (PARTITION BY category ORDER BY score DESC, CAST(creation_id AS VARCHAR) DESC)
QUALIFY row_number() OVER best <= 100"""


def _board(n: int) -> str:
    """Board after writing one window after the other, trimmed to ``n`` each time."""
    return f"""
numbered AS (
  SELECT category, creation_id, score, window_end,
         CAST(dense_rank() OVER (ORDER BY window_end) AS BIGINT) AS step
  FROM windowed WHERE category IS NOT NULL),
board AS (
  SELECT CAST(1 AS BIGINT) AS step, category, creation_id, score, window_end
  FROM (SELECT * FROM numbered WHERE step = 1)
  QUALIFY row_number() OVER (
    PARTITION BY category ORDER BY score DESC, CAST(creation_id AS VARCHAR) DESC) <= {n}
  UNION ALL
  SELECT step, category, creation_id, score, window_end FROM (
    SELECT max(step) AS step, category, creation_id,
           arg_max(score, fresh) AS score, arg_max(window_end, fresh) AS window_end
    FROM (
      SELECT step + 1 AS step, category, creation_id, score, window_end, 0 AS fresh FROM board
      UNION ALL
      SELECT step, category, creation_id, score, window_end, 1 FROM numbered
      WHERE step = (SELECT max(step) + 1 FROM board))
    WHERE step <= (SELECT max(step) FROM numbered)
    GROUP BY category, creation_id)
  QUALIFY row_number() OVER (
    PARTITION BY category ORDER BY score DESC, CAST(creation_id AS VARCHAR) DESC) <= {n})
SELECT category, creation_id, score, window_end,
       CAST(row_number() OVER (
         PARTITION BY category ORDER BY score DESC, CAST(creation_id AS VARCHAR) DESC
       ) AS INTEGER) AS rank
FROM board WHERE step = (SELECT max(step) FROM numbered)"""


def _with(*ctes: str, recursive: bool = False) -> str:
    *named, last = ctes
    word = "WITH RECURSIVE" if recursive else "WITH"
    # The last piece may open with CTEs of its own.
    return f"{word} " + ",\n".join([*named, last])


def _select(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _cte(name: str, body: str) -> str:
    return f"{name} AS ({body})"


_SCORES = "SELECT creation_id, arrival_seq, action_ts AS last_action_ts, round(score, 6) AS score FROM scored"
_WINDOWED_COLUMNS = "creation_id, score, last_action_ts, window_start, window_end"

_UNCATEGORISED = """
SELECT a.*, p.category FROM actions a JOIN (
  SELECT p_partkey AS creation_id,
         CASE p_brand WHEN 'Brand#1' THEN NULL WHEN 'Brand#2' THEN '' ELSE p_type END AS category
  FROM part) p USING (creation_id)"""
_BY_TYPE = """
SELECT a.*, p.p_type AS category FROM actions a JOIN part p ON p.p_partkey = a.creation_id"""

_EVENT_WINDOWS = [
    _cte("actions", EVENT_ACTIONS),
    _cte("versions", EVENT_VERSIONS),
    _ENRICHED,
    _scored_by_arrival("enriched", EVENT_RATE),
    _latest(DAY),
    _windowed(EVENT_RATE),
]

_LINE_WINDOWS = [
    _cte("actions", _line_actions("ordering")),
    _scored_by_arrival("actions", LINE_RATE),
    _latest(DAY),
]

# Messages reach the engine batch by batch: all of a batch at its latest time, batches of one
# time by partition and offset, and the actions of a batch in their own order.
_MESSAGE_ACTIONS = f"""
SELECT user_id, action_type, creation_id, action_ts,
       max(arrival_us) OVER batch AS arrival_us,
       (user_id % 4) * 17592186044416 + arrival_seq // {BLOCK} * 1000000 + user_id AS arrival_seq,
       row_number() OVER (batch ORDER BY arrival_seq) - 1 AS pos
FROM ({EVENT_ACTIONS})
WINDOW batch AS (PARTITION BY user_id, arrival_seq // {BLOCK})"""

_PLACES = f"""
SELECT *, row_number() OVER (batch ORDER BY arrival_seq) - 1 AS place, count(*) OVER batch AS n
FROM ({EVENT_ACTIONS})
WINDOW batch AS (PARTITION BY user_id, arrival_seq // {BLOCK})"""

# Four files by arrival, those of every seventh user one file too late. A file's rows are late when
# they arrive no later than anything sound in the files before it.
_LATE_PLACES = f"""
WITH placed AS (
  SELECT m.*, user_id % 5 = 3 AS spoilt,
         least(3, CAST(arrival_us >= epoch_us(TIMESTAMP '2024-01-08') AS INT)
           + CAST(arrival_us >= epoch_us(TIMESTAMP '2024-01-15') AS INT)
           + CAST(arrival_us >= epoch_us(TIMESTAMP '2024-01-22') AS INT)
           + CAST(user_id % 7 = 0 AS INT)) AS part
  FROM ({_MESSAGE_ACTIONS}) m
), marks AS (
  SELECT part, max(max(arrival_us)) OVER (
           ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) // 1000 * 1000 AS mark
  FROM (SELECT part, arrival_us FROM placed WHERE NOT spoilt
        UNION ALL
        SELECT CAST(arrival_us >= epoch_us(TIMESTAMP '2024-01-08') AS INT)
           + CAST(arrival_us >= epoch_us(TIMESTAMP '2024-01-15') AS INT)
           + CAST(arrival_us >= epoch_us(TIMESTAMP '2024-01-22') AS INT), arrival_us
        FROM ({EVENT_VERSIONS}))
  GROUP BY part
)
SELECT p.* EXCLUDE (part), arrival_us <= coalesce(mark, 0) AS late
FROM placed p LEFT JOIN marks USING (part)"""

# Creations forgotten after twelve quiet hours: an island of rows counts as a key of its own.
_ISLANDS = f"""
times AS (
  SELECT DISTINCT creation_id, arrival_us
  FROM (SELECT creation_id, arrival_us FROM versions UNION ALL SELECT creation_id, arrival_us FROM actions)),
gaps AS (
  SELECT *, arrival_us - lag(arrival_us) OVER (PARTITION BY creation_id ORDER BY arrival_us) AS gap
  FROM times),
islands AS (
  SELECT creation_id, arrival_us,
         CAST(sum(CASE WHEN gap >= {12 * HOUR * 1000} THEN 1 ELSE 0 END)
              OVER (PARTITION BY creation_id ORDER BY arrival_us) AS BIGINT) AS island
  FROM gaps),
enriched AS (
  SELECT a.* EXCLUDE (island) REPLACE (a.creation_id * 1000000 + a.island AS creation_id), v.category
  FROM (SELECT * FROM actions JOIN islands USING (creation_id, arrival_us)) a
  ASOF JOIN (SELECT * FROM versions JOIN islands USING (creation_id, arrival_us)) v
  ON a.creation_id = v.creation_id AND a.island = v.island AND a.arrival_us >= v.arrival_us)"""

_EXPIRING = (
    _cte("versions", EVENT_VERSIONS),
    _cte("actions", EVENT_ACTIONS),
    _ISLANDS,
    _scored_by_arrival("enriched", EVENT_RATE).replace("scored AS", "of_islands AS"),
    _cte("scored", "SELECT * REPLACE (creation_id // 1000000 AS creation_id) FROM of_islands"),
    _latest(DAY),
    _windowed(EVENT_RATE),
)

ORACLES = {
    "decode_creations": """
SELECT p_partkey AS creation_id, CAST(p_size AS BIGINT) AS user_id, p_type AS category,
       CAST(1 AS INTEGER) AS status FROM part""",
    "decode_quarantine_counts": r"""
SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN json_valid(text) AND json_type(text) = 'OBJECT' THEN 'null_creation_id'
              ELSE 'malformed_json' END AS outcome
  FROM documents WHERE regexp_matches(text, '[^\x00-\x20]') AND trim(text) <> 'null'
  UNION ALL SELECT 'accepted' FROM documents
  UNION ALL
  SELECT CASE WHEN source IS NULL THEN 'null_creation_id'
              WHEN TRY_CAST(source AS BIGINT) IS NULL THEN 'bad_field'
              ELSE 'accepted' END FROM documents
  UNION ALL SELECT 'null_creation_id' FROM documents)
GROUP BY outcome""",
    "split_action_batches": f"""
SELECT user_id, action_type, creation_id, action_ts FROM ({EVENT_ACTIONS})""",
    "split_ragged_batches": _select(
        _cte("places", _PLACES),
        select="""
SELECT user_id, place AS pos,
       CASE WHEN user_id % 7 = 2 AND place = 0 THEN NULL ELSE action_type END AS action_type,
       CASE WHEN user_id % 7 = 0 AND place = n - 1 THEN NULL ELSE creation_id END AS creation_id,
       CASE WHEN user_id % 7 = 1 AND place = n - 1 THEN NULL ELSE action_ts END AS action_ts,
       CASE WHEN user_id % 7 = 0 AND place = n - 1 THEN 'missing_element'
            WHEN user_id % 7 = 1 AND place = n - 1 THEN 'surplus'
            WHEN user_id % 7 = 2 AND place = 0 THEN 'bad_number' END AS reason
FROM places""",
    ),
    "action_weights": f"""
SELECT action_type, count(*) AS n, sum({_weight('action_type')}) AS weight
FROM ({EVENT_ACTIONS}) GROUP BY action_type""",
    "creation_latest": f"""
SELECT creation_id, category, CAST(1 AS INTEGER) AS status FROM ({EVENT_VERSIONS})
QUALIFY row_number() OVER (PARTITION BY creation_id ORDER BY arrival_us DESC) = 1""",
    "enrich_as_of": _select(
        _cte("actions", EVENT_ACTIONS),
        _cte("versions", EVENT_VERSIONS),
        _ENRICHED,
        select="SELECT user_id, action_type, creation_id, action_ts, category FROM enriched",
    ),
    "enrich_latest": f"""
SELECT a.user_id, a.action_type, a.creation_id, a.action_ts,
       CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS category
FROM ({_line_actions()}) a JOIN part ON p_partkey = a.creation_id""",
    "running_score_event_order": _select(
        _cte("actions", _line_actions()),
        _scored_by_event("actions", LINE_RATE),
        select=_SCORES,
    ),
    "running_score_arrival_order": _select(
        _cte("actions", _line_actions("ordering")),
        _scored_by_arrival("actions", LINE_RATE),
        select=_SCORES,
    ),
    "running_score_long_gap": _select(
        _cte("actions", EVENT_ACTIONS),
        _scored_by_event("actions", SHORT_RATE),
        select=_SCORES,
    ),
    "window_latest": _select(
        *_LINE_WINDOWS,
        select="SELECT creation_id, round(score, 6) AS score, action_ts AS last_action_ts, "
        "window_start, window_end FROM latest",
    ),
    "window_decayed_score": _select(
        *[piece.replace("SELECT a.*, s.score", "SELECT a.*, NULL AS category, s.score")
          for piece in _LINE_WINDOWS],
        _windowed(LINE_RATE),
        select=f"SELECT {_WINDOWED_COLUMNS} FROM windowed",
    ),
    "window_scores_event_time": _select(
        _cte("actions", EVENT_ACTIONS),
        _cte("enriched", _BY_TYPE),
        _scored_by_event("enriched", EVENT_RATE),
        _latest(DAY),
        _windowed(EVENT_RATE),
        select="SELECT * FROM windowed",
    ),
    "hot_top100": _with(
        _cte("actions", _line_actions()),
        _cte("enriched", _UNCATEGORISED),
        _scored_by_event("enriched", LINE_RATE),
        _latest(7 * DAY),
        _windowed(LINE_RATE),
        _TOP,
    ),
    "hot_ranking_flagship": _with(
        _cte("actions", _line_actions()),
        _cte("enriched", _BY_TYPE),
        _scored_by_event("enriched", LINE_RATE),
        _latest(7 * DAY),
        _windowed(LINE_RATE),
        _TOP,
    ),
    "hot_ranking_arrival_order": _with(
        _cte("actions", _line_actions("ordering")),
        _cte("versions", LINE_VERSIONS),
        _ENRICHED,
        _scored_by_arrival("enriched", LINE_RATE),
        _latest(DAY),
        _windowed(LINE_RATE),
        _TOP,
    ),
    "hot_ranking_from_messages": _select(
        _cte("actions", _MESSAGE_ACTIONS),
        _cte("versions", EVENT_VERSIONS),
        _ENRICHED,
        _scored_by_arrival("enriched", EVENT_RATE),
        _latest(DAY),
        _windowed(EVENT_RATE),
        select="""
SELECT category, creation_id, score, window_end FROM windowed WHERE category IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY category, creation_id ORDER BY window_end DESC) = 1""",
    ),
    "leaderboard_replay": _with(
        _cte("actions", _line_actions()),
        _cte("enriched", _BY_TYPE),
        _scored_by_event("enriched", LINE_RATE),
        _latest(90 * DAY),
        _windowed(LINE_RATE),
        _board(100),
        recursive=True,
    ),
    "windowed_with_expiry": _select(*_EXPIRING, select="SELECT * FROM windowed"),
    "stream_micro_batches": _select(*_EXPIRING, select="SELECT * FROM windowed"),
    "stream_equals_batch": _select(*_EVENT_WINDOWS, select="SELECT * FROM windowed"),
    "stream_board": _with(*_EVENT_WINDOWS, _board(3), recursive=True),
    "intake_quarantine": f"""
WITH p AS ({_LATE_PLACES})
SELECT 'action_batch' AS source, 'late' AS reason, count(*) AS n FROM p WHERE late AND NOT spoilt
UNION ALL
SELECT 'action_batch', 'malformed_json', count(*)
FROM (SELECT DISTINCT user_id, arrival_seq FROM p WHERE spoilt)""",
    "intake_windows": _select(
        _cte("actions", f"SELECT * EXCLUDE (late, spoilt) FROM ({_LATE_PLACES}) WHERE NOT (late OR spoilt)"),
        _cte("versions", EVENT_VERSIONS),
        _ENRICHED,
        _scored_by_arrival("enriched", EVENT_RATE),
        _latest(DAY),
        _windowed(EVENT_RATE),
        select="SELECT * FROM windowed",
    ),
    "job_from_messages": _with(
        _cte("actions", _MESSAGE_ACTIONS),
        _cte("versions", EVENT_VERSIONS),
        _ENRICHED,
        _scored_by_arrival("enriched", EVENT_RATE),
        _latest(DAY),
        _windowed(EVENT_RATE),
        _board(3),
        recursive=True,
    ),
}
