"""The registered queries as DuckDB SQL over the same tables, written independently of them."""

from __future__ import annotations

_DAY = 86_400_000

_CHAT = """
m AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(user_id % 3 AS INTEGER) AS part,
         epoch_us(ts) // 1000 - {shift} AS ms,
         CASE event_type WHEN 'purchase' THEN '今天天气真不错！' WHEN 'signup' THEN '很高兴能和大家一起工作。'
              WHEN 'error' THEN '太难过了' WHEN 'click' THEN '工作压力不好' ELSE '需要进一步优化。' END AS message
  FROM events
), s AS (
  SELECT *, CASE label WHEN 'Positive' THEN 0.8::DOUBLE WHEN 'Negative' THEN -0.6::DOUBLE ELSE 0::DOUBLE END AS score
  FROM (
    SELECT *, CASE
        WHEN contains(lower(message), '开心') OR contains(lower(message), '高兴')
          OR contains(lower(message), '不错') OR contains(lower(message), '好') THEN 'Positive'
        WHEN contains(lower(message), '难过') OR contains(lower(message), '沮丧')
          OR contains(lower(message), '不好') OR contains(lower(message), '糟') THEN 'Negative'
        ELSE 'Neutral' END AS label
    FROM m)
)"""

_ON_TIME = _CHAT.format(shift="0")
_HELD_BACK = _CHAT.format(shift=f"CASE WHEN event_id % 7 = 0 THEN {3 * _DAY} ELSE 0 END")


def _round(value: str) -> str:
    return f"CASE WHEN abs({value}) < 0.0000005 THEN 0::DOUBLE ELSE round({value}, 6) END"


def _windows(size: int, advance: int, source: str = "s") -> str:
    return f"""
w AS (
  SELECT {source}.*, ms - ms % {advance} - k * {advance} AS ws, ms - ms % {advance} - k * {advance} + {size} AS we
  FROM {source} CROSS JOIN range({size} // {advance}) AS steps(k)
  WHERE ms - ms % {advance} - k * {advance} >= 0
)"""


_DAY_WINDOWS = f"{_ON_TIME}, {_windows(_DAY, _DAY // 2)}"
_TOTALS = "t AS (SELECT user_id, ws, we, sum(score) AS total, count(*) AS n FROM w GROUP BY user_id, ws, we)"
_MEANS = f"WITH {_DAY_WINDOWS}, {_TOTALS}"
_MEAN_COLUMNS = f"user_id, ws AS window_start, we AS window_end, n, {_round('total / n')} AS average_score"
_ALERT_COLUMNS = f"user_id, we AS window_end, {_round('total / n')} AS average_score, '用户情绪持续低落' AS alert_message"
_RECORD_COLUMNS = """user_id, we AS window_end_ts,
  CAST(CAST(total / n AS DECIMAL(10, 6)) AS DOUBLE) AS average_score, '用户情绪持续低落' AS alert_message,
  TIMESTAMP '2024-02-01 00:00:00' AS created_at"""

# Stream time per partition, then the (row, window) pairs it has not closed.
_REPLAY = f"""WITH {_HELD_BACK}, st AS (
  SELECT *, max(ms) OVER (PARTITION BY part ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS stream_time FROM s
), {_windows(_DAY, _DAY // 2, "st")}, kept AS (SELECT * FROM w WHERE we + {_DAY // 2} > stream_time)"""
_RUNNING = f"""{_REPLAY}, r AS (
  SELECT *, sum(score) OVER g AS total, count(*) OVER g AS n FROM kept
  WINDOW g AS (PARTITION BY user_id, ws ORDER BY event_id ROWS UNBOUNDED PRECEDING)
)"""
_UPDATE_COLUMNS = 'user_id, ws AS window_start, we AS window_end, event_id AS "offset"'
_SETTLED = f"SELECT {_UPDATE_COLUMNS}, 1 AS seq, n, {_round('total / n')} AS average_score FROM r"
_HALFWAY = (
    f"SELECT {_UPDATE_COLUMNS}, 0 AS seq, n - 1 AS n, {_round('total / (n - 1)')} AS average_score FROM r WHERE n > 1"
)

_SENT = """'{"userId":"' || user_id || '","timestamp":' || CAST(ms AS VARCHAR) || ',"message":"' || message || '"}'"""


def _text_mood(text: str, columns: str, source: str) -> str:
    return f"""SELECT {columns}, CASE label WHEN 'Positive' THEN 0.8::DOUBLE WHEN 'Negative' THEN -0.6::DOUBLE
        ELSE 0::DOUBLE END AS sentiment_score, label AS sentiment_label
      FROM (SELECT *, CASE
        WHEN regexp_matches(lower({text}), 'great|best|gut |bueno|bien') THEN 'Positive'
        WHEN regexp_matches(lower({text}), 'hate|sad|nicht|pas |sin ') THEN 'Negative'
        ELSE 'Neutral' END AS label FROM {source})"""


def _large(columns: str, source: str) -> str:
    """The first in the alphabet of all runs of five letters or more in the documents that a text holds; of those with
    the same seven letters at the beginning, the long ones first. Such a term lies within a run of the text, so
    it is looked for once in every different run."""
    return f"""WITH terms AS (
        SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{5,}}')) AS term FROM documents
      ), texts AS MATERIALIZED (
        SELECT row_number() OVER () AS row, {columns}, list_distinct(regexp_extract_all(lower(text), '[a-z]{{5,}}')) AS runs
        FROM {source} WHERE text IS NOT NULL
      ), held AS (SELECT row, unnest(runs) AS run FROM texts),
      places AS (SELECT run, unnest(range(1, length(run) - 3)) AS place FROM (SELECT DISTINCT run FROM held)),
      best AS (
        SELECT run, min(left(term, 7) || CASE WHEN length(term) > 8 THEN '+' ELSE '-' END) AS first
        FROM places JOIN terms ON substr(run, place, 5) = left(term, 5) AND substr(run, place, length(term)) = term GROUP BY run
      ), hits AS (SELECT row, min(first) AS first FROM held JOIN best USING (run) GROUP BY row)
      SELECT {columns}, CASE right(first, 1) WHEN '+' THEN 0.8::DOUBLE WHEN '-' THEN -0.6::DOUBLE ELSE 0::DOUBLE END AS sentiment_score,
             CASE right(first, 1) WHEN '+' THEN 'Positive' WHEN '-' THEN 'Negative' ELSE 'Neutral' END AS sentiment_label
      FROM texts LEFT JOIN hits USING (row)"""


_DOUBTFUL = """d AS (
  SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 7 <> 0 THEN event_type END AS message,
         value / 100 - 1 AS score
  FROM events
), e AS (
  SELECT *, list_filter([
      CASE WHEN message IS NULL OR message = '' THEN '3000' END,
      CASE WHEN score < -1 OR score > 1 THEN '3001' END,
      CASE WHEN user_id IS NULL THEN '3002' END,
      CASE WHEN message = 'signup' THEN '9001' END], lambda code: code IS NOT NULL) AS errors
  FROM d
)"""

_NAMED = "event_id % 11 <> 0"
_REPLAY_NAMED = _REPLAY.replace("FROM s\n)", f"FROM s WHERE {_NAMED}\n)")
_RUNNING_NAMED = _RUNNING.replace(_REPLAY, _REPLAY_NAMED)
_KEPT_TOTALS = _TOTALS.replace("FROM w", "FROM kept")
# Eight files by event id, one a micro-batch. A batch drops what the watermark of the batch before last,
# the highest time so far less the grace, has closed.
_LATE_STREAM = f"""WITH {_HELD_BACK}, f AS (
  SELECT s.*, (event_id - first) * 8 // (last - first + 1) AS file
  FROM s CROSS JOIN (SELECT min(event_id) AS first, max(event_id) AS last FROM events)
), b AS (SELECT file, max(ms) AS top FROM f GROUP BY file),
mark AS (SELECT file, max(top) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS mark FROM b),
{_windows(_DAY, _DAY // 2, "f")},
kept AS (SELECT w.* FROM w JOIN mark USING (file) WHERE mark IS NULL OR we + {_DAY // 2} > mark), {_KEPT_TOTALS}"""

# The windows that a stream's state still holds after a micro-batch: of the rows up to it, those that the watermark
# left by the files up to another has not closed.
_SLICED = f"""WITH {_ON_TIME}, f AS (
  SELECT s.*, (event_id - first) * 8 // (last - first + 1) AS file
  FROM s CROSS JOIN (SELECT min(event_id) AS first, max(event_id) AS last FROM events)
), {_windows(_DAY, _DAY // 2, "f")}"""


def _open(upto: int, closed_by: int) -> str:
    kept = f"kept AS (SELECT * FROM w WHERE file <= {upto} AND we + {_DAY // 2} > (SELECT max(ms) FROM f WHERE file <= {closed_by}))"
    return f"{_SLICED}, {kept}, {_KEPT_TOTALS} SELECT {_MEAN_COLUMNS} FROM t"


SQL: dict[str, str] = {
    "src_chat_messages": f"""WITH {_ON_TIME}
      SELECT user_id AS key, part AS "partition", event_id AS "offset", user_id, ms AS "timestamp", message FROM m""",
    "src_scores": f"""WITH {_ON_TIME}
      SELECT user_id AS key, event_id AS "offset", user_id, ms AS "timestamp", score AS sentiment_score,
             label AS sentiment_label FROM s""",
    "json_decode": """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
             CAST(NULL AS VARCHAR) AS error_code FROM events""",
    "json_decode_malformed": f"""WITH {_ON_TIME}, c AS (
        SELECT *, CASE WHEN event_id % 11 = 0 THEN '2002' WHEN event_id % 13 = 0 THEN '3000' END AS error_code FROM m)
      SELECT event_id AS "offset", CASE WHEN error_code IS NULL THEN user_id END AS user_id,
             CASE WHEN error_code IS NULL THEN ms END AS "timestamp",
             CASE WHEN error_code IS NULL THEN message END AS message, error_code FROM c""",
    "json_encode": f"""WITH {_ON_TIME} SELECT event_id AS "offset", user_id AS key, {_SENT} AS value FROM m""",
    "sentiment_scores": f"""WITH {_ON_TIME}
      SELECT event_id AS "offset", user_id, ms AS "timestamp", score AS sentiment_score, label AS sentiment_label
      FROM s""",
    "sentiment_label_counts": f"""WITH {_ON_TIME}
      SELECT label AS sentiment_label, count(*) AS n, round(avg(score), 6) AS mean_score FROM s GROUP BY label""",
    "negation_first_label_counts": f"""WITH {_ON_TIME}
      SELECT CASE WHEN contains(message, '不好') THEN 'Negative' ELSE label END AS sentiment_label, count(*) AS n
      FROM s GROUP BY 1""",
    "document_sentiment": _text_mood("text", "doc_id", "documents"),
    "conversation_sentiment": _text_mood("text", "conv_id, turn, role", "conversations"),
    "negative_messages": f"""WITH {_ON_TIME} SELECT user_id, score AS sentiment_score, message FROM s
      WHERE score < 0""",
    "validate_not_null": f"""WITH {_DOUBTFUL}
      SELECT event_id, CASE WHEN user_id IS NULL THEN '3002' END AS error_code FROM d""",
    "validate_not_empty": f"""WITH {_DOUBTFUL}
      SELECT event_id, CASE WHEN message IS NULL OR length(message) = 0 THEN '3000' END AS error_code FROM d""",
    "validate_array": """SELECT vec_id, CASE WHEN embedding IS NULL OR len(list_filter(embedding, lambda x: x > 0.25)) = 0
             THEN '1001' END AS error_code FROM embeddings""",
    "validate_map": """SELECT event_id, CASE WHEN NOT coalesce(CAST(json_extract(props, '$.k') AS INTEGER) >= 50, false)
             THEN '1001' END AS error_code FROM events""",
    "validate_range": """SELECT event_id, CASE WHEN value < 0 OR (value > 100 AND NOT isnan(value)) THEN '1001' END
             AS error_code FROM events""",
    "valid_rows": f"""WITH {_DOUBTFUL}
      SELECT event_id, user_id, message, {_round('score')} AS sentiment_score FROM e WHERE len(errors) = 0""",
    "quarantine": f"""WITH {_DOUBTFUL}
      SELECT event_id, array_to_string(errors, ',') AS errors FROM e WHERE len(errors) > 0""",
    "error_summary": f"""WITH {_DOUBTFUL}, f AS (SELECT unnest(errors) AS code FROM e)
      SELECT CASE code WHEN '9001' THEN '1000' ELSE code END AS code, count(*) AS n,
             CASE code WHEN '9001' THEN 'system' ELSE 'business' END AS family,
             CASE code WHEN '9001' THEN '系统内部错误' WHEN '3000' THEN '聊天消息无效'
                       WHEN '3001' THEN '情感分析失败' ELSE '预警生成失败' END AS message
      FROM f GROUP BY f.code""",
    "hopping_assign": f"""WITH {_DAY_WINDOWS}
      SELECT event_id AS "offset", user_id, ws AS window_start, we AS window_end FROM w""",
    "hopping_sum": f"""{_MEANS}
      SELECT user_id, ws AS window_start, we AS window_end, {_round('total')} AS score_sum FROM t""",
    "hopping_count": f"""{_MEANS} SELECT user_id, ws AS window_start, we AS window_end, n FROM t""",
    "hopping_avg": f"""{_MEANS} SELECT {_MEAN_COLUMNS} FROM t""",
    "hopping_avg_60s": f"""WITH {_ON_TIME}, {_windows(60_000, 30_000)}, {_TOTALS} SELECT {_MEAN_COLUMNS} FROM t""",
    "sum_count_join": f"""WITH {_DAY_WINDOWS},
      a AS (SELECT user_id, ws, we, sum(score) AS total FROM w GROUP BY user_id, ws, we),
      b AS (SELECT user_id, ws, we, count(*) AS n FROM w GROUP BY user_id, ws, we)
      SELECT {_MEAN_COLUMNS} FROM a JOIN b USING (user_id, ws, we)""",
    "warning_alerts": f"""{_MEANS} SELECT {_ALERT_COLUMNS} FROM t""",
    "low_mood_alerts": f"""{_MEANS} SELECT {_ALERT_COLUMNS} FROM t WHERE total / n < -0.0003""",
    "alert_sink_key": f"""{_MEANS}
      SELECT user_id, we AS window_end, hex(user_id) || upper(printf('%016x', ws)) AS sink_key FROM t""",
    "alert_records": f"""{_MEANS} SELECT {_RECORD_COLUMNS} FROM t""",
    "alert_metrics": f"""{_MEANS}, a AS (SELECT {_ALERT_COLUMNS} FROM t)
      SELECT count(*) AS alerts, count(*) FILTER (average_score < 0) AS low_alerts, min(average_score) AS min_average,
             max(average_score) AS max_average, max(window_end) AS last_window_end FROM a""",
    "late_drop": f"""{_REPLAY}
      SELECT user_id, part AS "partition", event_id AS "offset", ws AS window_start FROM kept""",
    "late_rows": f"""{_REPLAY}
      SELECT user_id, part AS "partition", event_id AS "offset", ws AS window_start, stream_time
      FROM w WHERE we + {_DAY // 2} <= stream_time""",
    "late_drop_alerts": f"""{_REPLAY}, {_TOTALS.replace("FROM w", "FROM kept")} SELECT {_ALERT_COLUMNS} FROM t""",
    "alert_changelog": f"""{_RUNNING} {_SETTLED}""",
    "alert_changelog_transient": f"""{_RUNNING} {_SETTLED} UNION ALL {_HALFWAY}""",
    "alert_current": f"""{_REPLAY}, {_TOTALS.replace("FROM w", "FROM kept")} SELECT {_MEAN_COLUMNS} FROM t""",
    "alerts_stream_update": f"""{_MEANS} SELECT {_RECORD_COLUMNS} FROM t""",
    "alerts_stream_upsert": f"""{_MEANS} SELECT {_RECORD_COLUMNS} FROM t""",
    "alerts_stream_final": f"""{_MEANS}
      SELECT {_ALERT_COLUMNS} FROM t WHERE we + {_DAY // 2} <= (SELECT max(ms) FROM s)""",
    "alerts_through_topics": f"""{_MEANS}
      SELECT {_ALERT_COLUMNS} FROM t WHERE we + {_DAY // 2} <= (SELECT max(ms) FROM s)""",
    "lexicon_any_case": _text_mood("text", "conv_id, turn, role", "conversations"),
    "late_drop_bucketed": f"""{_REPLAY_NAMED}
      SELECT user_id, part AS "partition", event_id AS "offset", ws AS window_start FROM kept""",
    "alert_changelog_bucketed": f"""{_RUNNING_NAMED} {_SETTLED} UNION ALL {_HALFWAY}""",
    "alert_changelog_in_order": f"""{_RUNNING_NAMED.replace(_HELD_BACK, _ON_TIME)} {_SETTLED}""",
    "alert_current_bucketed": f"""{_REPLAY_NAMED}, {_KEPT_TOTALS} SELECT {_MEAN_COLUMNS} FROM t""",
    "late_drop_record_time": f"""{_REPLAY}
      SELECT user_id, part AS "partition", event_id AS "offset", ws AS window_start FROM kept""",
    "alert_changelog_record_time": f"""{_RUNNING} {_SETTLED}""",
    "alerts_by_record_key": f"""WITH {_DAY_WINDOWS}, {_TOTALS.replace("FROM w", f"FROM w WHERE {_NAMED}")}
      SELECT {_ALERT_COLUMNS} FROM t""",
    "topic_mixed_writes": f"""WITH {_ON_TIME}
      SELECT part AS "partition", count(*) AS n, min(event_id) AS first_offset, max(event_id) AS last_offset
      FROM m GROUP BY part""",
    "topic_without_origin": f"""{_MEANS} SELECT {_ALERT_COLUMNS} FROM t""",
    "stream_quarantine": f"""WITH {_ON_TIME}
      SELECT part AS "partition", event_id AS "offset", CASE WHEN event_id % 11 = 0 THEN '2002'
             WHEN event_id % 13 = 0 THEN '3000' END AS error_code FROM m""",
    "observed_metrics": f"""{_MEANS}, a AS (SELECT {_ALERT_COLUMNS} FROM t)
      SELECT count(*) AS alerts, count(*) FILTER (average_score < 0) AS low_alerts, min(average_score) AS min_average,
             max(average_score) AS max_average, max(window_end) AS last_window_end FROM a""",
    "alerts_stream_late": f"""{_LATE_STREAM} SELECT {_RECORD_COLUMNS} FROM t""",
    "alerts_fused_stream": f"""{_MEANS}
      SELECT {_ALERT_COLUMNS} FROM t WHERE we + {_DAY // 2} <= (SELECT max(ms) FROM s)""",
    "alert_changelog_stream": f"""{_RUNNING} {_SETTLED}""",
    "late_rows_stream": f"""{_REPLAY}
      SELECT user_id, part AS "partition", event_id AS "offset", ws AS window_start, stream_time
      FROM w WHERE we + {_DAY // 2} <= stream_time""",
    "late_drop_alerts_stream": f"""{_REPLAY}, {_KEPT_TOTALS} SELECT {_ALERT_COLUMNS} FROM t""",
    "alerts_stream_joined": f"""{_MEANS}
      SELECT {_ALERT_COLUMNS} FROM t WHERE we + {_DAY // 2} <= (SELECT max(ms) FROM s)""",
    "alerts_stream_once": f"""{_MEANS}
      SELECT {_ALERT_COLUMNS} FROM t WHERE we + {_DAY // 2} <= (SELECT max(ms) FROM s)""",
    "alerts_once": f"""{_MEANS} SELECT {_ALERT_COLUMNS} FROM t""",
    "alert_state_current": _open(7, 7),
    "alert_state_earlier": _open(4, 3),
    "hopping_decayed_avg": f"""WITH {_DAY_WINDOWS}, a AS (SELECT *, pow(0.5::DOUBLE, (we - ms) / {_DAY // 4}) AS worth FROM w)
      SELECT user_id, ws AS window_start, we AS window_end, {_round('sum(score * worth) / sum(worth)')} AS decayed_score
      FROM a GROUP BY user_id, ws, we""",
    "hopping_avg_keyed": f"""{_MEANS} SELECT {_MEAN_COLUMNS} FROM t""",
    "sum_count_join_keyed": f"""{_MEANS} SELECT {_MEAN_COLUMNS} FROM t""",
    "document_sentiment_large": _large("doc_id", "documents"),
    "conversation_sentiment_large": _large("conv_id, turn, role", "conversations"),
    "fused_stream_accounts": f"""WITH {_ON_TIME}
      SELECT count(*) AS records, count(*) FILTER (bad) AS rejected, count(*) FILTER (NOT bad) AS messages,
             count(*) FILTER (NOT bad AND score < 0) AS negative_messages, count(*) FILTER (bad) AS kept
      FROM (SELECT *, event_id % 11 = 0 OR event_id % 13 = 0 AS bad FROM s)""",
    "score_topic_quarantine": f"""WITH {_ON_TIME}
      SELECT part AS "partition", event_id AS "offset", CASE WHEN event_id % 11 = 0 THEN '2002' END AS error_code FROM m""",
}
