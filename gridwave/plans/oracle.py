"""DuckDB SQL for each registered query (same column names as the Spark side).

Views ``events``, ``customer``, ``nation``, ``region``, ``embeddings`` ... are
registered by the caller.  The CTEs below restate the events -> recordings
mapping of ``gridwave.sources.testdata`` in SQL.
"""

from __future__ import annotations

CHANNEL_CASE = ("CASE event_type WHEN 'click' THEN 'IA' WHEN 'view' THEN 'IB' "
                "WHEN 'error' THEN 'IC' ELSE event_type END")

LONG = f"""long AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS filename, ts AS "timestamp",
         epoch_us(ts) AS time_us, {CHANNEL_CASE} AS analog_channel_names,
         value AS analog, event_id
  FROM events)"""

PATH = ("'file:///recordings/' || event_type || '.d/u' || CAST(user_id AS VARCHAR) || '/' "
        "|| CAST(event_id AS VARCHAR) || '.cfg'")

RAW = f"""raw AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS filename, ts AS "timestamp",
         epoch_us(ts) AS time_us, event_id,
         CASE WHEN {CHANNEL_CASE} = 'IA' THEN value END AS IA,
         CASE WHEN {CHANNEL_CASE} = 'IB' THEN value END AS IB,
         CASE WHEN {CHANNEL_CASE} = 'IC' THEN value END AS IC,
         CAST(regexp_matches({PATH}, 'error') AS INTEGER) AS is_fault
  FROM events)"""


def _pivot(keys: str) -> str:
    return f"""SELECT {keys},
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'IA') AS IA,
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'IB') AS IB,
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'IC') AS IC
FROM long WHERE analog_channel_names IN ('IA', 'IB', 'IC')
GROUP BY {keys}"""


PHASES = f"""phases AS ({_pivot('filename, "timestamp", time_us')})"""

FRAME_LABELS = f"""{RAW},
idx AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY time_us, event_id) AS rn
        FROM raw),
fl AS (SELECT filename, (rn - 1) // 16 AS frame, arg_min(is_fault, rn) AS is_fault,
              count(*) AS n
       FROM idx GROUP BY 1, 2 HAVING count(*) = 16),
frames AS (SELECT filename, frame, is_fault FROM fl)"""

SHUFFLED = f"""{FRAME_LABELS},
ranked AS (SELECT *, row_number() OVER (
             ORDER BY md5('42:' || filename || '|' || CAST(frame AS VARCHAR)), filename, frame)
             AS shuffle_rank,
           count(*) OVER () AS n_total FROM frames),
cut AS (SELECT *, floor(n_total * 0.7::DOUBLE) AS n_train FROM ranked),
split AS (SELECT filename, frame, is_fault, shuffle_rank,
            CASE WHEN shuffle_rank <= n_train THEN 'train'
                 WHEN shuffle_rank <= n_train + floor((n_total - n_train) * 0.5::DOUBLE) THEN 'val'
                 ELSE 'test' END AS split
          FROM cut)"""

METADATA = """meta_samples AS (
  SELECT 'u' || CAST(e.user_id AS VARCHAR) AS filename, e.ts AS "timestamp", e.event_id,
         CASE WHEN r.r_name = 'AMERICA' THEN 60.0::DOUBLE ELSE 50.0::DOUBLE END AS frequency,
         n.n_name AS station_name, json_extract_string(e.props, '$.k') AS rec_dev_id
  FROM events e
  LEFT JOIN (customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
             JOIN region r ON n.n_regionkey = r.r_regionkey) ON e.user_id = c.c_custkey),
meta AS (
  SELECT filename,
         arg_min(frequency, ("timestamp", event_id)) AS frequency,
         arg_min(station_name, ("timestamp", event_id)) AS station_name,
         arg_min(rec_dev_id, ("timestamp", event_id)) AS rec_dev_id
  FROM meta_samples GROUP BY filename)"""


SQL: dict[str, str] = {
    "filter_channels": f"""WITH {LONG}
SELECT * FROM long WHERE analog_channel_names IN ('IA', 'IB', 'IC')""",

    "pivot_phases": f"""WITH {LONG}
{_pivot('filename, "timestamp"')}""",

    "pivot_discover": f"""WITH {LONG}
SELECT filename, "timestamp",
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'IA') AS IA,
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'IB') AS IB,
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'IC') AS IC,
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'purchase') AS purchase,
  arg_min(analog, event_id) FILTER (WHERE analog_channel_names = 'signup') AS signup
FROM long GROUP BY filename, "timestamp\"""",

    "gather_waveform": f"""WITH {LONG}, {PHASES},
idx AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY time_us) AS rn FROM phases)
SELECT filename, (rn - 1) // 726 AS frame, count(*) AS n_samples, count(*) = 726 AS length_ok,
       list(time_us ORDER BY time_us) AS sample_times,
       list([IA, IB, IC] ORDER BY time_us) AS waveform
FROM idx GROUP BY 1, 2""",

    "metadata_first": f"""WITH {METADATA}
SELECT * FROM meta""",

    "enrich_metadata": f"""WITH {LONG}, {METADATA}
SELECT l.*, m.frequency, m.station_name, m.rec_dev_id
FROM long l LEFT JOIN meta m USING (filename)
WHERE l.analog_channel_names IN ('IA', 'IB', 'IC')""",

    "distinct_recordings": f"""WITH {LONG}
SELECT DISTINCT filename FROM long""",

    "one_recording": f"""WITH {RAW}
SELECT * FROM raw WHERE filename = (SELECT min(filename) FROM raw)""",

    "frame_waveforms": f"""WITH {RAW},
idx AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY time_us, event_id) AS rn
        FROM raw)
SELECT filename, (rn - 1) // 16 AS frame, list([IA, IB, IC] ORDER BY rn) AS signal,
       arg_min(is_fault, rn) AS is_fault
FROM idx GROUP BY 1, 2 HAVING count(*) = 16""",

    "frame_labels": f"""WITH {FRAME_LABELS}
SELECT * FROM frames""",

    "shuffle_order": f"""WITH {SHUFFLED}
SELECT filename, frame, is_fault, shuffle_rank FROM ranked""",

    "train_val_test_split": f"""WITH {SHUFFLED}
SELECT * FROM split""",

    "split_sizes": f"""WITH {SHUFFLED}
SELECT split, count(*) AS n_waveforms FROM split GROUP BY split""",

    "union_train_val": f"""WITH {SHUFFLED}
SELECT * FROM split WHERE split IN ('train', 'val')""",

    "interval_join": """WITH c AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS f, ts AS t, event_id AS id
           FROM events WHERE event_type = 'click'),
d AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS f, ts AS t, event_id AS id
      FROM events WHERE event_type = 'view')
SELECT c.f AS filename, c.id AS cfg_event_id, d.id AS dat_event_id,
       c.t AS cfg_mod_time, d.t AS dat_mod_time
FROM c JOIN d ON c.f = d.f AND abs(epoch_us(c.t) - epoch_us(d.t)) <= 300000000""",

    "pair_key": f"""WITH p AS (SELECT event_id, {PATH} AS path FROM events)
SELECT event_id, path, regexp_replace(path, '\\.[^./]+$', '') AS pair_key,
       regexp_extract(path, '([^/]+?)(\\.[^./]+)?$', 1) AS base_name,
       split_part(path, '.', 1) AS first_dot_key
FROM p""",

    "label_by_pattern": f"""SELECT event_id, {PATH} AS path,
       CAST(regexp_matches({PATH}, 'error') AS INTEGER) AS is_fault FROM events""",

    "raw_time_micros": """SELECT event_id, epoch_us(ts) / 1e6 AS "time",
       CAST(trunc(epoch_us(ts) / 1e6 * 1e6) AS BIGINT) AS time_us FROM events""",

    "sample_times": """WITH s AS (SELECT user_id, min(ts) AS start FROM events GROUP BY user_id),
j AS (SELECT e.event_id, epoch_us(s.start) AS su,
             (epoch_us(e.ts) - epoch_us(s.start)) / 1e6 AS sec
      FROM events e JOIN s USING (user_id))
SELECT event_id, su + CAST(round(sec * 1e6) AS BIGINT) AS time_us,
       make_timestamp(su + CAST(round(sec * 1e6) AS BIGINT)) AS sample_time FROM j""",

    "json_parse": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.missing') AS missing FROM events""",

    "json_render": """SELECT event_id, to_json({'event_type': event_type, 'user_id': user_id})::VARCHAR AS json
FROM events""",
}


CAPTURES = f"""cap_rows AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS time_us, value,
         {CHANNEL_CASE} AS ch,
         row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS pos
  FROM events),
geo AS (SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey),
cap AS (SELECT cr.*, 'u' || CAST(cr.user_id AS VARCHAR) || '_' || CAST((cr.pos - 1) // 726 AS VARCHAR)
               AS filename, (cr.pos - 1) % 726 + 1 AS n_in_cap,
               CASE WHEN g.r_name = 'AMERICA' THEN 60.0::DOUBLE ELSE 50.0::DOUBLE END AS frequency,
               g.n_name AS station_name
        FROM cap_rows cr LEFT JOIN geo g ON cr.user_id = g.c_custkey),
captures AS (
  SELECT filename,
    list([CASE WHEN ch = 'IA' THEN value END, CASE WHEN ch = 'IB' THEN value END,
          CASE WHEN ch = 'IC' THEN value END] ORDER BY pos) AS analog,
    ['A', 'A', 'A'] AS analog_units,
    list([CAST(event_type = 'purchase' AS DOUBLE), CAST(event_type = 'signup' AS DOUBLE)]
         ORDER BY pos) AS status,
    ['IA', 'IB', 'IC'] AS analog_channel_names,
    ['purchase', 'signup'] AS status_channel_names,
    arg_min(frequency, pos) AS frequency,
    CAST(CAST(('0x' || substr(md5(filename), 1, 8)) AS BIGINT) % 10000 AS VARCHAR) AS rec_dev_id,
    arg_min(station_name, pos) AS station_name,
    list(time_us ORDER BY pos) AS microseconds,
    count(*) AS n, min(time_us) AS start_us
  FROM cap GROUP BY filename)"""


# A value as each body type gives it back: ASCII as it is, int16 on its channel's scale.
_TEXT_VALUE = "round(value + 0.0, 6)"
_INT_VALUE = ("round(CASE WHEN lo < hi THEN ((hi / 2 - lo / 2) / 32767.0::DOUBLE) * k + (lo / 2 + hi / 2) "
              "ELSE value END + 0.0, 6)")
_TEXT_TIME, _INT_TIME = "time_us", "start_us + ((time_us - start_us) // tick) * tick"


def _decoded(value: str, time_expr: str) -> str:
    return f"""SELECT filename,
  list([CASE WHEN ch = 'IA' THEN {value} END, CASE WHEN ch = 'IB' THEN {value} END,
        CASE WHEN ch = 'IC' THEN {value} END] ORDER BY pos) AS analog,
  ['A', 'A', 'A'] AS analog_units,
  list([CAST(event_type = 'purchase' AS DOUBLE), CAST(event_type = 'signup' AS DOUBLE)]
       ORDER BY pos) AS status,
  ['IA', 'IB', 'IC'] AS analog_channel_names, ['purchase', 'signup'] AS status_channel_names,
  arg_min(frequency, pos) AS frequency,
  CAST(CAST(('0x' || substr(md5(filename), 1, 8)) AS BIGINT) % 10000 AS VARCHAR) AS rec_dev_id,
  arg_min(station_name, pos) AS station_name,
  list({time_expr} ORDER BY pos) AS microseconds
FROM capt GROUP BY filename"""


# Samples with their file's start and tick, and their channel's least and greatest
# value; k is the count an int16 body holds.
_CAP_START = """capt0 AS (SELECT cap.*, min(time_us) OVER (PARTITION BY filename) AS start_us,
    greatest(1, ceil((max(time_us) OVER (PARTITION BY filename) - min(time_us) OVER (PARTITION BY filename))
                     / 4294967294.0::DOUBLE))::BIGINT AS tick,
    min(value) OVER (PARTITION BY filename, ch) AS lo, max(value) OVER (PARTITION BY filename, ch) AS hi FROM cap),
capt AS (SELECT *, CASE WHEN lo < hi
    THEN round((value - (lo / 2 + hi / 2)) / ((hi / 2 - lo / 2) / 32767.0::DOUBLE)) ELSE 0 END AS k FROM capt0),
scale AS (SELECT filename, any_value(tick) AS tick,
    any_value(lo) FILTER (WHERE ch = 'IA') AS lo_a, any_value(hi) FILTER (WHERE ch = 'IA') AS hi_a,
    any_value(lo) FILTER (WHERE ch = 'IB') AS lo_b, any_value(hi) FILTER (WHERE ch = 'IB') AS hi_b,
    any_value(lo) FILTER (WHERE ch = 'IC') AS lo_c, any_value(hi) FILTER (WHERE ch = 'IC') AS hi_c
    FROM capt GROUP BY filename)"""


def _text_of(x: str) -> str:
    """Decimal text of a double, whole numbers without a point."""
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


def _scale_text(ch: str) -> str:
    lo, hi = f"lo_{ch}", f"hi_{ch}"
    a = f"CASE WHEN {lo} < {hi} THEN ({hi} / 2 - {lo} / 2) / 32767.0::DOUBLE ELSE 1.0::DOUBLE END"
    b = f"coalesce(CASE WHEN {lo} < {hi} THEN {lo} / 2 + {hi} / 2 ELSE {lo} END, 0.0::DOUBLE)"
    return f"({_text_of(f'({a})')}) || ',' || ({_text_of(f'({b})')})"


_ANALOG_LINES = ("'1,IA,A,I,A,' || {a} || ',0,-500,500,1,1,P' || chr(10) || "
                 "'2,IB,B,I,A,' || {b} || ',0,-500,500,1,1,P' || chr(10) || "
                 "'3,IC,C,I,A,' || {c} || ',0,-500,500,1,1,P' || chr(10) || "
                 "'1,purchase,,,0' || chr(10) || '2,signup,,,0' || chr(10)")


def _cfg_text(ft: str) -> str:
    unit = dict.fromkeys("abc", "'1,0'")
    lines = _ANALOG_LINES.format(**(unit if ft == "ASCII" else {ch: _scale_text(ch) for ch in "abc"}))
    mult = "'1'" if ft == "ASCII" else "CAST(tick AS VARCHAR)"
    return (f"station_name || ',' || rec_dev_id || ',1999' || chr(10) || '5,3A,2D' || chr(10) || "
            f"{lines} || CAST(frequency AS VARCHAR) || chr(10) || '0' || chr(10) "
            f"|| '0,' || CAST(n AS VARCHAR) || chr(10) || "
            f"strftime(make_timestamp(start_us), '%d/%m/%Y,%H:%M:%S.%f') || chr(10) || "
            f"strftime(make_timestamp(start_us + 20000), '%d/%m/%Y,%H:%M:%S.%f') || chr(10) || "
            f"'{ft}' || chr(10) || {mult} || chr(10)")


def _count(ch: str) -> str:
    return f"coalesce(CASE WHEN ch = '{ch}' THEN {_text_of('value')} END, '')"


def _le(x: str, digits: int) -> str:
    """Little-endian hex of an unsigned number."""
    h = f"lpad(lower(to_hex(CAST({x} AS BIGINT))), {digits}, '0')"
    return " || ".join(f"substr({h}, {i}, 2)" for i in range(digits - 1, 0, -2))


def _int16(ch: str) -> str:
    return _le(f"CASE WHEN ch = '{ch}' AND value IS NOT NULL THEN (CAST(k AS BIGINT) + 65536) % 65536 ELSE 32768 END", 4)


SQL.update({
    "encode_recordings": f"""WITH {CAPTURES}, {_CAP_START},
body AS (SELECT filename,
  string_agg(CAST(n_in_cap AS VARCHAR) || ',' || CAST(time_us - start_us AS VARCHAR) || ',' ||
             {_count('IA')} || ',' || {_count('IB')} || ',' || {_count('IC')} || ',' ||
             CAST(CAST(event_type = 'purchase' AS INTEGER) AS VARCHAR) || ',' ||
             CAST(CAST(event_type = 'signup' AS INTEGER) AS VARCHAR), chr(10) ORDER BY pos)
  || chr(10) AS body
  FROM capt GROUP BY filename)
SELECT c.filename, substr(md5(c.filename), 1, 12) AS file_id,
       {_cfg_text('ASCII')} AS config_content,
       md5(b.body) AS dat_md5, octet_length(encode(b.body)) AS n_bytes
FROM captures c JOIN body b USING (filename)""",

    "decode_ascii": f"""WITH {CAPTURES}, {_CAP_START}
{_decoded(_TEXT_VALUE, _TEXT_TIME)}""",

    "decode_binary": f"""WITH {CAPTURES}, {_CAP_START}
{_decoded(_INT_VALUE, _INT_TIME)}""",

    "flatten_long": f"""WITH {CAPTURES}
SELECT filename, time_us AS microseconds, n_in_cap - 1 AS sample_index, j - 1 AS channel_index,
       ['IA', 'IB', 'IC'][j] AS analog_channel_names,
       CASE WHEN ch = ['IA', 'IB', 'IC'][j] THEN value END AS analog
FROM cap, range(1, 4) AS r(j)""",

    "flatten_status": f"""WITH {CAPTURES}
SELECT filename, time_us AS microseconds, n_in_cap - 1 AS sample_index, j - 1 AS channel_index,
       ['IA', 'IB', 'IC'][j] AS analog_channel_names,
       CASE WHEN ch = ['IA', 'IB', 'IC'][j] THEN value END AS analog, 'analog' AS channel_type
FROM cap, range(1, 4) AS r(j)
UNION ALL
SELECT filename, time_us, n_in_cap - 1, j - 1, ['purchase', 'signup'][j],
       CAST(event_type = ['purchase', 'signup'][j] AS DOUBLE), 'status'
FROM cap, range(1, 3) AS r(j)""",

    "waveform_matrix": f"""WITH {CAPTURES}
SELECT filename, analog AS waveform FROM captures""",

    "transpose_channels": f"""WITH {CAPTURES}
SELECT filename,
  [list(CASE WHEN ch = 'IA' THEN value END ORDER BY pos),
   list(CASE WHEN ch = 'IB' THEN value END ORDER BY pos),
   list(CASE WHEN ch = 'IC' THEN value END ORDER BY pos)] AS channel_major
FROM cap GROUP BY filename""",

    "channel_attributes": f"""WITH {CAPTURES}
SELECT filename, ['A', 'A', 'A'] AS analog_units, ['IA', 'IB', 'IC'] AS analog_ids,
       ['A', 'B', 'C'] AS analog_phases, ['purchase', 'signup'] AS status_ids
FROM captures""",

    "channel_alias": f"""SELECT 'u' || CAST(user_id AS VARCHAR) AS filename, ts AS "timestamp",
       {CHANNEL_CASE} AS analog_channel_names, value AS analog, event_id FROM events""",
})


_ASCII_BODY = f"""abody AS (SELECT filename,
  string_agg(CAST(n_in_cap AS VARCHAR) || ',' || CAST(time_us - start_us AS VARCHAR) || ',' ||
             {_count('IA')} || ',' || {_count('IB')} || ',' || {_count('IC')} || ',' ||
             CAST(CAST(event_type = 'purchase' AS INTEGER) AS VARCHAR) || ',' ||
             CAST(CAST(event_type = 'signup' AS INTEGER) AS VARCHAR), chr(10) ORDER BY pos)
  || chr(10) AS body
  FROM capt GROUP BY filename)"""

FILES = f"""{CAPTURES}, {_CAP_START}, {_ASCII_BODY},
files AS (
  SELECT 'ascii.v1' AS folder, c.filename, {_cfg_text('ASCII')} AS config_content,
         octet_length(encode(b.body)) AS n_bytes
  FROM captures c JOIN abody b USING (filename)
  UNION ALL
  SELECT 'binary.v1', c.filename, {_cfg_text('BINARY')}, c.n * 16
  FROM captures c JOIN scale USING (filename))"""

SQL.update({
    "file_inventory": f"""WITH {FILES}
SELECT folder, filename || '.cfg' AS file, octet_length(encode(config_content)) AS length FROM files
UNION ALL
SELECT folder, filename || '.dat', n_bytes FROM files""",

    "scan_cfg": f"""WITH {FILES}
SELECT folder, filename, config_content FROM files""",

    "scan_dat": f"""WITH {FILES}
SELECT folder, filename, n_bytes FROM files""",

    "pair_join": f"""WITH {FILES}
SELECT folder, filename, config_content, n_bytes FROM files""",

    "decode_files": f"""WITH {CAPTURES}, {_CAP_START}
SELECT 'ascii.v1' AS folder, * FROM ({_decoded(_TEXT_VALUE, _TEXT_TIME)})
UNION ALL
SELECT 'binary.v1' AS folder, * FROM ({_decoded(_INT_VALUE, _INT_TIME)})""",

    "scan_raw_csv": f"""SELECT 'u' || CAST(user_id AS VARCHAR) AS recording, epoch_us(ts) / 1e6 AS "time",
       CASE WHEN {CHANNEL_CASE} = 'IA' THEN value END AS IA,
       CASE WHEN {CHANNEL_CASE} = 'IB' THEN value END AS IB,
       CASE WHEN {CHANNEL_CASE} = 'IC' THEN value END AS IC,
       CAST(event_type = 'error' AS INTEGER) AS is_fault
FROM events""",
})


SQL.update({
    "waveform_features": f"""WITH {RAW},
idx AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY time_us, event_id) AS rn
        FROM raw)
SELECT filename, (rn - 1) // 16 AS frame, arg_min(is_fault, rn) AS is_fault,
       list_transform(flatten(list([IA, IB, IC] ORDER BY rn)), lambda v: coalesce(v, 0.0::DOUBLE))
         AS features
FROM idx GROUP BY 1, 2 HAVING count(*) = 16""",
})


def _both_folders(select: str) -> str:
    """Rows for the ASCII and BINARY copies of every capture with their own
    values and sample times."""
    ascii_ = select.format(folder="ascii.v1", v=_TEXT_VALUE, ts=_TEXT_TIME)
    binary = select.format(folder="binary.v1", v=_INT_VALUE, ts=_INT_TIME)
    return f"{ascii_}\nUNION ALL\n{binary}"


_STREAM_BASE = f"{CAPTURES}, {_CAP_START}"

SQL.update({
    "stream_scan_cfg": SQL["scan_cfg"],
    "stream_scan_dat": SQL["scan_dat"],
    "stream_interval_join": SQL["pair_join"],
    "stream_decode": SQL["decode_files"],

    "stream_metadata": f"""WITH {CAPTURES}
SELECT 'ascii.v1' AS folder, filename, frequency, station_name, rec_dev_id FROM captures
UNION ALL
SELECT 'binary.v1', filename, frequency, station_name, rec_dev_id FROM captures""",

    "stream_flatten": f"""WITH {_STREAM_BASE}
""" + _both_folders("""SELECT '{folder}' AS folder, filename, make_timestamp({ts}) AS "timestamp",
       n_in_cap - 1 AS sample_index, j - 1 AS channel_index,
       ['IA', 'IB', 'IC'][j] AS analog_channel_names,
       CASE WHEN ch = ['IA', 'IB', 'IC'][j]
            THEN {v} END AS analog
FROM capt, range(1, 4) AS r(j)"""),

    "stream_pivot": f"""WITH {_STREAM_BASE}
""" + _both_folders("""SELECT '{folder}' AS folder, filename, make_timestamp({ts}) AS "timestamp",
       CASE WHEN ch = 'IA' THEN {v} END AS IA,
       CASE WHEN ch = 'IB' THEN {v} END AS IB,
       CASE WHEN ch = 'IC' THEN {v} END AS IC
FROM capt"""),

    "stream_gather": f"""WITH {_STREAM_BASE}
""" + _both_folders("""SELECT '{folder}' AS folder, filename, (n_in_cap - 1) // 16 AS frame,
       count(*) AS n_samples, count(*) = 16 AS length_ok,
       list([CASE WHEN ch = 'IA' THEN {v} END,
             CASE WHEN ch = 'IB' THEN {v} END,
             CASE WHEN ch = 'IC' THEN {v} END]
            ORDER BY pos) AS waveform
FROM capt GROUP BY filename, (n_in_cap - 1) // 16"""),

    "stream_pipeline": f"""WITH {CAPTURES},
k AS (SELECT count(*) AS caps, sum(n) AS samples, sum((n + 15) // 16) AS frames FROM captures)
SELECT 'config_files_bronze' AS table_name, 2 * caps AS n_rows FROM k
UNION ALL SELECT 'dat_files_bronze', 2 * caps FROM k
UNION ALL SELECT 'joined_files_bronze', 2 * caps FROM k
UNION ALL SELECT 'recordings_silver', 2 * caps FROM k
UNION ALL SELECT 'metadata_silver', 2 * caps FROM k
UNION ALL SELECT 'flattened_silver', 2 * 3 * samples FROM k
UNION ALL SELECT 'pivoted_current_silver', 2 * samples FROM k
UNION ALL SELECT 'fault_detection_gold', 2 * frames FROM k""",

    "stream_table_write": f"""WITH {CAPTURES},
k AS (SELECT count(*) AS caps, sum(n) AS samples, sum((n + 15) // 16) AS frames FROM captures)
SELECT table_name, comment, quality, n_rows FROM k, LATERAL (VALUES
  ('config_files_bronze', 'One row per header file, with its text', 'bronze', 2 * caps),
  ('dat_files_bronze', 'One row per body file, with its bytes', 'bronze', 2 * caps),
  ('joined_files_bronze', 'Header and body of each recording', 'bronze', 2 * caps),
  ('recordings_silver', 'One row per recording, samples as arrays', 'silver', 2 * caps),
  ('metadata_silver', 'Station, device and line frequency by recording', 'silver', 2 * caps),
  ('flattened_silver', 'One row per sample and channel', 'silver', 2 * 3 * samples),
  ('pivoted_current_silver', 'One row per sample, a column per phase', 'silver', 2 * samples),
  ('fault_detection_gold', 'Fault probability of each waveform', 'gold', 2 * frames)
) t(table_name, comment, quality, n_rows)""",

    "stream_table_read": f"""WITH {CAPTURES}
SELECT 'ascii.v1' AS folder, filename, n AS n_samples FROM captures
UNION ALL
SELECT 'binary.v1', filename, n FROM captures""",
})


SQL["stream_late"] = """SELECT event_id, user_id, ts FROM events
WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-15'"""


SQL["decode_ascii_lines"] = f"""WITH {CAPTURES}
SELECT 'ascii.v1' AS folder, filename, n_in_cap AS sample_number,
       make_timestamp(time_us) AS "timestamp",
       CASE WHEN ch = 'IA' THEN {_TEXT_VALUE} END AS IA,
       CASE WHEN ch = 'IB' THEN {_TEXT_VALUE} END AS IB,
       CASE WHEN ch = 'IC' THEN {_TEXT_VALUE} END AS IC
FROM cap"""


SQL["encode_binary_recordings"] = f"""WITH {CAPTURES}, {_CAP_START}
SELECT filename, md5(unhex(string_agg({_le('n_in_cap', 8)} || {_le('(time_us - start_us) // tick', 8)} ||
         {_int16('IA')} || {_int16('IB')} || {_int16('IC')} ||
         {_le("CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END", 4)}, '' ORDER BY pos))) AS dat_md5,
       count(*) * 16 AS n_bytes
FROM capt GROUP BY filename"""

_WHICH = "CAST(('0x' || substr(md5(filename), 1, 8)) AS BIGINT)"

# A blank frequency line gives a null frequency; every other dialect changes nothing.
SQL["decode_dialects"] = f"""WITH {CAPTURES}, {_CAP_START}
SELECT * REPLACE (CASE WHEN {_WHICH} % 6 = 2 THEN NULL ELSE frequency END AS frequency)
FROM ({_decoded(_TEXT_VALUE, _TEXT_TIME)})"""

SQL["header_problems"] = f"""WITH {CAPTURES}
SELECT filename, CASE {_WHICH} % 9 WHEN 1 THEN 'unknown file type: BINARY64'
                                   WHEN 2 THEN 'unreadable time of the first sample'
                                   WHEN 3 THEN 'unreadable channel counts'
                                   WHEN 4 THEN 'unreadable factor or offset of channel IB'
                                   WHEN 5 THEN 'unreadable time multiplier'
                                   WHEN 6 THEN 'unreadable sampling rates'
                                   ELSE 'unreadable line frequency' END AS problem
FROM captures WHERE {_WHICH} % 9 BETWEEN 1 AND 7"""

SQL["convert_raw_text"] = f"""WITH s AS (
  SELECT event_type || '_u' || CAST(user_id AS VARCHAR) AS stem, epoch_us(ts) AS t,
         CASE WHEN {CHANNEL_CASE} = 'IA' THEN value END AS a, CASE WHEN {CHANNEL_CASE} = 'IB' THEN value END AS b,
         CASE WHEN {CHANNEL_CASE} = 'IC' THEN value END AS c FROM events),
i AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY t, [a, b, c]) AS rn FROM s)
SELECT stem || '_' || CAST((rn - 1) // 726 AS VARCHAR) AS filename, stem AS station_name,
       ['IA', 'IB', 'IC'] AS analog_channel_names,
       list([round(a, 6), round(b, 6), round(c, 6)] ORDER BY rn) AS analog, list(t ORDER BY rn) AS microseconds
FROM i GROUP BY stem, (rn - 1) // 726"""

SQL["json_roundtrip"] = f"""WITH {CAPTURES} SELECT filename, analog, analog_units, status, analog_channel_names,
       status_channel_names, frequency, rec_dev_id, station_name, microseconds FROM captures"""

SQL["stream_join_backfill"] = f"""WITH {FILES}
SELECT CASE WHEN CAST(regexp_extract(filename, '^u([0-9]+)_', 1) AS BIGINT) % 2 = 1 THEN 'old' ELSE 'new' END AS folder,
       filename, config_content, n_bytes FROM files WHERE folder = 'ascii.v1'"""

SQL["file_inventory_wide"] = SQL["file_inventory"]

SQL["stream_scan_marked"] = f"""WITH {FILES}
SELECT CASE WHEN CAST(regexp_extract(filename, '^u([0-9]+)_', 1) AS BIGINT) % 2 = 1
            THEN '2024-01-02' ELSE '2024-01-01' END AS folder, filename, config_content
FROM files WHERE folder = 'ascii.v1'"""

SQL["stream_pair_pending"] = f"""WITH {FILES}
SELECT filename, CAST(regexp_extract(filename, '^u([0-9]+)_', 1) AS BIGINT) % 3 AS paired_in_run, config_content, n_bytes
FROM files WHERE folder = 'ascii.v1'"""

_FIXED = f"""{RAW},
idx AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY time_us, event_id) AS rn FROM raw),
f AS (SELECT filename, (rn - 1) // 16 AS frame, arg_min(is_fault, rn) AS is_fault,
             list_transform(flatten(list([IA, IB, IC] ORDER BY rn)), lambda v: coalesce(v, 0.0::DOUBLE)) AS x
      FROM idx GROUP BY 1, 2 HAVING count(*) = 16),
p AS (SELECT filename, frame, is_fault,
             1 / (1 + exp(-list_sum(list_transform(x, lambda v, i: v * ((i - 1) % 5 - 2) / 100.0::DOUBLE)))) AS p FROM f)"""

SQL["score_fixed"] = f"""WITH {_FIXED}
SELECT filename, frame, is_fault, round(p, 6) AS fault_score FROM p"""

SQL["score_tensor"] = SQL["score_fixed"]

_EXACT_INT = ("(CASE WHEN lo < hi THEN ((hi / 2 - lo / 2) / 32767.0::DOUBLE) * k + (lo / 2 + hi / 2) ELSE value END)")
_FRAME = """SELECT '{folder}' AS folder, filename, (n_in_cap - 1) // 16 AS frame, count(*) AS n,
    list_transform(flatten(list([CASE WHEN ch = 'IA' THEN {v} END, CASE WHEN ch = 'IB' THEN {v} END,
      CASE WHEN ch = 'IC' THEN {v} END] ORDER BY pos)), lambda x: coalesce(x, 0.0::DOUBLE)) AS x
  FROM capt GROUP BY filename, (n_in_cap - 1) // 16"""
SQL["stream_gold_recordings"] = f"""WITH {_STREAM_BASE},
f AS ({_FRAME.format(folder="ascii.v1", v="value")} UNION ALL {_FRAME.format(folder="binary.v1", v=_EXACT_INT)}),
p AS (SELECT folder, filename, CASE WHEN n = 16 THEN
        1 / (1 + exp(-list_sum(list_transform(x, lambda v, i: v * ((i - 1) % 5 - 2) / 100.0::DOUBLE)))) END AS p FROM f)
SELECT folder, filename, count(*) AS frames, count(p) AS scored_frames, round(max(p), 6) AS fault_score
FROM p GROUP BY folder, filename"""

SQL["model_transitions"] = f"""WITH {SHUFFLED}
SELECT 'fault_detection' AS name, version, stage, (SELECT count(*) FROM split WHERE split = 'test') AS n_test
FROM (VALUES (1, 'Archived'), (2, 'Production')) v(version, stage)"""

SQL["eval_fixed"] = f"""WITH {_FIXED},
e AS (SELECT *, least(greatest(p, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE) AS q FROM p)
SELECT round(avg(-(is_fault * ln(q) + (1 - is_fault) * ln(1 - q))), 6) AS loss,
       round(coalesce(sum(is_fault) FILTER (WHERE p >= 0.5) / nullif(count(*) FILTER (WHERE p >= 0.5), 0), 0), 6) AS precision,
       round(coalesce(sum(is_fault) FILTER (WHERE p >= 0.5) / nullif(sum(is_fault), 0), 0), 6) AS recall,
       count(*) AS n FROM e"""

# Feature j is kernel j mod 4 over phase (j mod 12) // 4 at sample j // 12; pad has a sample of zeros on either side.
SQL["kernel_features"] = f"""WITH {_FIXED}
SELECT filename, frame, is_fault, list_transform(range(16 * 3 * 4), lambda j:
         CASE WHEN pad[j // 12 * 3 + j % 12 // 4 + 1] * ((7 + 3 * (j % 4)) % 5 - 2)
                 + pad[j // 12 * 3 + j % 12 // 4 + 4] * ((9 + 4 * (j % 4)) % 5 - 2)
                 + pad[j // 12 * 3 + j % 12 // 4 + 7] * ((11 + 5 * (j % 4)) % 5 - 2)
                 > j % 4 % 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS features
FROM (SELECT *, list_concat([0, 0, 0]::DOUBLE[], x, [0, 0, 0]::DOUBLE[]) AS pad FROM f)"""

SQL["loss_curve"] = f"""WITH RECURSIVE {SHUFFLED},
waves AS (SELECT filename, (rn - 1) // 16 AS frame,
                 list_transform(flatten(list([IA, IB, IC] ORDER BY rn)), lambda v: coalesce(v, 0.0::DOUBLE) * 0.01::DOUBLE) AS x
          FROM idx GROUP BY 1, 2 HAVING count(*) = 16),
data AS MATERIALIZED (SELECT is_fault::DOUBLE AS y, split = 'train' AS train, x
                      FROM waves JOIN split USING (filename, frame) WHERE split <> 'test'),
steps AS (
  SELECT 0 AS epoch, list_transform(range(48), lambda j: 0.0::DOUBLE) AS w, 0.0::DOUBLE AS b
  UNION ALL
  SELECT epoch + 1, [{", ".join(f"any_value(w)[{j}] - 2 * sum(off * x[{j}]) / count(*)" for j in range(1, 49))}],
         any_value(b) - 2 * sum(off) / count(*)
  FROM (SELECT epoch, w, b, x, 1 / (1 + exp(-(list_dot_product(x, w) + b))) - y AS off
        FROM steps, data WHERE train AND epoch < 64) GROUP BY epoch),
q AS (SELECT epoch, train, y, least(greatest(1 / (1 + exp(-(list_dot_product(x, w) + b))), 1e-7::DOUBLE),
                                    1 - 1e-7::DOUBLE) AS p FROM steps, data)
SELECT epoch, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))) FILTER (WHERE train), 6) AS train_loss,
       round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))) FILTER (WHERE NOT train), 6) AS val_loss
FROM q GROUP BY epoch"""

SQL["stream_ingest_clock"] = f"""WITH {CAPTURES}
SELECT folder, filename, true AS has_clock FROM captures, (VALUES ('ascii.v1'), ('binary.v1')) v(folder)"""

_KEYED = _both_folders("""SELECT '{folder}' AS folder, filename, {ts} AS t,
       any_value({v}) FILTER (WHERE ch = 'IA') AS IA, any_value({v}) FILTER (WHERE ch = 'IB') AS IB,
       any_value({v}) FILTER (WHERE ch = 'IC') AS IC
FROM capt GROUP BY filename, {ts}""")

SQL["stream_keyed_pivot"] = f"""WITH {_STREAM_BASE}, keyed AS ({_KEYED})
SELECT folder, filename, make_timestamp(t) AS "timestamp", IA, IB, IC FROM keyed"""

SQL["stream_keyed_gather"] = f"""WITH {_STREAM_BASE}, keyed AS ({_KEYED})
SELECT folder, filename, count(*) AS n_samples, list([IA, IB, IC] ORDER BY t) AS waveform
FROM keyed GROUP BY folder, filename"""


SQL["decode_binary_ranges"] = f"""WITH {CAPTURES}, {_CAP_START}
SELECT 'binary.v1' AS folder, filename, n_in_cap AS sample_number, make_timestamp({_INT_TIME}) AS "timestamp",
       CASE WHEN ch = 'IA' THEN {_INT_VALUE} END AS IA, CASE WHEN ch = 'IB' THEN {_INT_VALUE} END AS IB,
       CASE WHEN ch = 'IC' THEN {_INT_VALUE} END AS IC
FROM capt"""
