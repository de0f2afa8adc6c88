"""DuckDB SQL equivalent to each registered query (the correctness oracle).

The SQL runs on the raw test tables (events, customer, nation as views) and
derives the same inputs as ``sources.fixtures``.  It is written the plain
way: whole-video windows, ``lag``/running max islands, a recursive CTE for
the reference session fold, a range join for segments.
"""

from __future__ import annotations

from framecut.params import CONTEXT_MS, GAP_MS, MIN_CLIP_MS, PAD_MS, TOP_K

OFFSET = "CAST(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS BIGINT)"
ORD = "ORDER BY b, detection_id"
ROW_ORD = ORD + ", source"
FIRST_ATTRS = ", ".join(f"first({c} {ROW_ORD}) AS {c}" for c in
                        ("class2_name", "class_type_id", "ad_seat_img", "detection_id", "source"))

BASE = f"""
det AS (
  SELECT CAST(user_id AS VARCHAR) AS media_id,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                              WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS class_id,
         {OFFSET} AS time_start,
         {OFFSET} + CAST(floor(value * 1000) AS BIGINT) AS time_end,
         concat('img_', CAST(event_id AS VARCHAR), '.jpg') AS object_img,
         CAST(event_id AS BIGINT) AS detection_id,
         CASE event_id % 4 WHEN 0 THEN 'behavior' WHEN 1 THEN 'face' WHEN 2 THEN 'object' ELSE 'scene' END AS source
  FROM events),
lab AS (
  SELECT CAST(class_id AS BIGINT) AS class_id, class_type, class1_name, class2_name
  FROM (VALUES (1, '1', 'thing', 'click'), (2, '2', 'place', 'error'), (3, '3', 'deed', 'purchase'),
               (4, '4', 'person', 'signup'), (5, '1', 'thing', 'view'))
       AS t(class_id, class_type, class1_name, class2_name)),
vid AS (
  SELECT CAST(c_custkey AS VARCHAR) AS videoId, c_name AS videoName, c_mktsegment AS category,
         concat('style_', CAST(c_custkey % 3 AS VARCHAR)) AS classify, n_name AS area, '2024' AS releaseTime,
         concat('http://v/', CAST(c_custkey AS VARCHAR),
                CASE WHEN c_custkey % 7 = 0 THEN '.ts' ELSE '.mp4' END) AS originalUrl
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
scn AS (
  SELECT media_id, CAST(k AS BIGINT) * 432000 AS story_start, (CAST(k AS BIGINT) + 1) * 432000 AS story_end
  FROM (SELECT media_id, unnest(range(6)) AS k
        FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS media_id FROM events))),
tsk AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS video_id,
         CAST(CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS status
  FROM events),
nar AS (
  SELECT d.media_id AS video_id, l.class1_name AS class2_name, l.class_type AS class_type_id,
         l.class2_name AS class3_name, d.time_start AS ad_seat_b_time, d.time_end AS ad_seat_e_time,
         d.object_img AS ad_seat_img, d.detection_id, d.source
  FROM det d JOIN lab l ON d.class_id = l.class_id
  WHERE d.media_id IS NOT NULL AND d.time_start IS NOT NULL
    AND d.time_end IS NOT NULL AND d.time_end >= d.time_start
    AND d.media_id IN (SELECT videoId FROM vid)),
enr AS (
  SELECT d.media_id AS video_id, v.videoName AS media_name, v.category AS drama_name,
         v.classify AS drama_type_name, v.area AS media_area_name,
         l.class1_name AS class2_name, l.class_type AS class_type_id, l.class2_name AS class3_name,
         d.time_start AS ad_seat_b_time, d.time_end AS ad_seat_e_time, d.object_img AS ad_seat_img,
         d.detection_id, d.source
  FROM det d JOIN lab l ON d.class_id = l.class_id JOIN vid v ON v.videoId = d.media_id)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join((BASE,) + ctes) + "\n"


def merge_cte(name: str, src: str, gap: int, pad_ms: int, reach: str) -> str:
    """Islands per (video, label) in (begin, detection_id) order."""
    b = f"greatest(ad_seat_b_time - {pad_ms}, 0)" if pad_ms else "ad_seat_b_time"
    e = f"ad_seat_e_time + {pad_ms}" if pad_ms else "ad_seat_e_time"
    part = f"PARTITION BY video_id, class3_name {ROW_ORD}"
    prev = (f"lag(e) OVER ({part})" if reach == "last"
            else f"max(e) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    end = f"last(e {ROW_ORD})" if reach == "last" else "max(e)"
    return f"""
{name}_p AS (
  SELECT video_id, class3_name, {b} AS b, {e} AS e, class2_name, class_type_id, ad_seat_img, detection_id, source
  FROM {src}),
{name}_f AS (SELECT *, {prev} AS pe FROM {name}_p),
{name}_i AS (
  SELECT *, sum(CASE WHEN pe IS NULL OR b - pe > {gap} THEN 1 ELSE 0 END)
              OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl
  FROM {name}_f),
{name} AS (
  SELECT video_id, class3_name, min(b) AS ad_seat_b_time, {end} AS ad_seat_e_time, {FIRST_ATTRS},
         CAST(count(*) AS BIGINT) AS n_detections
  FROM {name}_i GROUP BY video_id, class3_name, isl)"""


def sessions_cte(name: str, src: str, gap: int, reach: str) -> str:
    """``{name}`` = rows of ``src`` with b, e and their cluster id ``cs``."""
    cols = ("video_id, ad_seat_b_time AS b, ad_seat_e_time AS e, detection_id, class3_name, "
            "class2_name, class_type_id, ad_seat_img")
    if reach == "last":
        return f"""
{name}_r AS (
  SELECT {cols}, row_number() OVER (PARTITION BY video_id {ORD}) AS rn FROM {src}),
{name}_rec AS (
  SELECT video_id, rn, b AS cs, e AS reach FROM {name}_r WHERE rn = 1
  UNION ALL
  SELECT r.video_id, r.rn,
         CASE WHEN r.b - c.reach <= {gap} THEN c.cs ELSE r.b END,
         CASE WHEN r.b - c.reach <= {gap} THEN greatest(r.b, c.reach) ELSE r.e END
  FROM {name}_rec c JOIN {name}_r r ON r.video_id = c.video_id AND r.rn = c.rn + 1),
{name} AS (SELECT r.*, c.cs FROM {name}_r r JOIN {name}_rec c ON r.video_id = c.video_id AND r.rn = c.rn)"""
    return f"""
{name}_x AS (
  SELECT {cols}, max(ad_seat_e_time) OVER (PARTITION BY video_id ORDER BY ad_seat_b_time, detection_id
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
  FROM {src}),
{name} AS (
  SELECT *, sum(CASE WHEN pm IS NULL OR b - pm > {gap} THEN 1 ELSE 0 END)
              OVER (PARTITION BY video_id {ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs
  FROM {name}_x)"""


SESSION_SUMMARY = f"""
SELECT video_id, min(b) AS cluster_b, max(e) AS cluster_e, CAST(count(*) AS BIGINT) AS n_members,
       string_agg(class3_name, '|' {ORD}) AS labels
FROM s GROUP BY video_id, cs"""

HEADER = """c.video_id AS string_vid, v.videoName AS media_name, v.category AS string_drama_name,
       v.classify AS string_drama_type_name, v.area AS string_media_area_name"""

TYPED = (("man", "4"), ("object", "1"), ("action", "3"), ("sence", "2"))


def single_sql(typed: bool = False, video_filter: str = "") -> str:
    ctes = [merge_cte("m", "nar", 0, PAD_MS, "last"), f"""
cl AS (
  SELECT video_id, greatest(ad_seat_b_time - {CONTEXT_MS}, 0) AS b, ad_seat_e_time + {CONTEXT_MS} AS e,
         class3_name, class2_name, class_type_id, ad_seat_img
  FROM m)"""]
    cols = [HEADER,
            "concat_ws('_', CAST(c.b AS VARCHAR), CAST(c.e AS VARCHAR)) AS string_time",
            "CAST(c.e - c.b AS VARCHAR) AS string_time_long",
            "coalesce(c.class3_name, '') AS string_class3_list",
            "coalesce(c.class2_name, '') AS string_class2_list",
            "coalesce(c.ad_seat_img, '') AS string_class_img_list",
            "concat_ws('=', c.class3_name, c.ad_seat_img) AS string_class3_to_img",
            "coalesce(c.ad_seat_img, '') AS string_frame_img_list"]
    if typed:
        cols += [f"CASE WHEN c.class_type_id = '{code}' THEN coalesce(c.class3_name, '') ELSE '' END "
                 f"AS string_{name}_list" for name, code in TYPED]
        cols.append("'1' AS resourceId")
    where = f"c.e - c.b >= {MIN_CLIP_MS}" + (f" AND {video_filter}" if video_filter else "")
    return with_(*ctes) + "SELECT " + ",\n       ".join(cols) + \
        f"\nFROM cl c JOIN vid v ON v.videoId = c.video_id\nWHERE {where}"


def _agg(col: str, cond: str | None = None) -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    return f"coalesce(string_agg({col}, '|' {ORD}){f}, '')"


def multi_sql(version: int) -> str:
    aggs = []
    if version == 1:
        aggs += [_agg("class3_name", f"class_type_id = '{code}'") + f" AS string_{n}_list" for n, code in TYPED]
        aggs += [_agg("class2_name", f"class_type_id = '{code}'") + f" AS string_{n}2_list" for n, code in TYPED]
        aggs += [_agg("ad_seat_img", f"class_type_id = '{code}'") + f" AS string_{n}_img_list" for n, code in TYPED]
    else:
        aggs += [_agg("class3_name") + " AS string_class3_list",
                 _agg("class2_name") + " AS string_class2_list",
                 _agg("ad_seat_img") + " AS string_class_img_list"]
        if version == 3:
            aggs += [_agg("class3_name", f"class_type_id = '{code}'") + f" AS string_{n}_list" for n, code in TYPED]
    ctes = [merge_cte("m", "nar", GAP_MS, 0, "last"), sessions_cte("s", "m", GAP_MS, "last"), f"""
cl AS (
  SELECT video_id, cs, min(b) AS b, max(e) AS e, {", ".join(aggs)}
  FROM s GROUP BY video_id, cs HAVING max(e) - min(b) >= {MIN_CLIP_MS})"""]
    names = [a.rsplit(" AS ", 1)[1] for a in aggs]
    cols = [HEADER,
            "concat_ws('_', CAST(c.b AS VARCHAR), CAST(c.e AS VARCHAR)) AS string_time",
            "CAST(c.e - c.b AS VARCHAR) AS string_time_long"] + [f"c.{n}" for n in names]
    if version in (2, 3):
        cols.append("'1' AS resourceId")
    return with_(*ctes) + "SELECT " + ",\n       ".join(cols) + \
        "\nFROM cl c JOIN vid v ON v.videoId = c.video_id"


CONTAIN = """
sc AS (
  SELECT n.video_id, s.story_start, s.story_end, n.detection_id, n.class3_name, n.ad_seat_b_time,
         n.ad_seat_e_time, n.class_type_id, n.class2_name, n.ad_seat_img
  FROM nar n JOIN scn s ON s.media_id = n.video_id
   AND n.ad_seat_b_time > s.story_start AND n.ad_seat_e_time < s.story_end
  WHERE s.story_end > s.story_start)"""

SCREEN = """
st AS (
  SELECT video_id, story_start, story_end, class_type_id, class3_name, class2_name,
         CAST(sum(ad_seat_e_time - ad_seat_b_time) AS BIGINT) AS totaltime,
         CAST(count(*) AS BIGINT) AS n_detections,
         first(ad_seat_img ORDER BY ad_seat_b_time, detection_id) AS ad_seat_img,
         first(ad_seat_b_time ORDER BY ad_seat_b_time, detection_id) AS ad_seat_b_time,
         first(ad_seat_e_time ORDER BY ad_seat_b_time, detection_id) AS ad_seat_e_time,
         CAST(sum(ad_seat_e_time - ad_seat_b_time) AS DOUBLE) / CAST(story_end - story_start AS DOUBLE) AS appear_rate
  FROM sc GROUP BY video_id, story_start, story_end, class_type_id, class3_name, class2_name)"""


def topk_cte(k: int, scope: str) -> str:
    part = "story_start, story_end" if scope == "scene" else "video_id, story_start, story_end"
    return f"""
tk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {part}
                                 ORDER BY totaltime DESC, video_id NULLS FIRST, class_type_id NULLS FIRST,
                                          class3_name NULLS FIRST, class2_name NULLS FIRST) AS rank
    FROM st) WHERE rank <= {k})"""


def scene_sql(tagged: bool) -> str:
    ctes = [CONTAIN, SCREEN, topk_cte(TOP_K, "scene"), """
tg AS (SELECT DISTINCT video_id, story_start, story_end, class_type_id AS t, class3_name AS n FROM tk
       WHERE class3_name IS NOT NULL),
tl AS (
  SELECT video_id, story_start, story_end,
         coalesce(string_agg(n, '|' ORDER BY t NULLS FIRST, n), '') AS string_class3_list,
""" + ",\n".join(f"         coalesce(string_agg(n, '|' ORDER BY n) FILTER (WHERE t = '{code}'), '') AS string_{nm}_list"
                 for nm, code in TYPED) + """
  FROM tg GROUP BY video_id, story_start, story_end),
ol AS (
  SELECT video_id, story_start, story_end,
         coalesce(string_agg(DISTINCT class2_name, '|' ORDER BY class2_name), '') AS string_class2_list,
         coalesce(string_agg(DISTINCT ad_seat_img, '|' ORDER BY ad_seat_img), '') AS string_class_img_list
  FROM tk GROUP BY video_id, story_start, story_end)"""]
    cols = [HEADER,
            "concat_ws('_', CAST(c.story_start AS VARCHAR), CAST(c.story_end AS VARCHAR)) AS string_time",
            "CAST(c.story_end - c.story_start AS VARCHAR) AS string_long",
            "coalesce(t.string_class3_list, '') AS string_class3_list"]
    cols += [f"coalesce(t.string_{nm}_list, '') AS string_{nm}_list" for nm, _ in TYPED]
    cols += ["c.string_class2_list", "c.string_class_img_list"]
    if tagged:
        cols.append("'2' AS resourceId")
    return with_(*ctes) + "SELECT " + ",\n       ".join(cols) + """
FROM ol c JOIN vid v ON v.videoId = c.video_id
LEFT JOIN tl t ON t.video_id = c.video_id AND t.story_start = c.story_start AND t.story_end = c.story_end"""


def _wrap(sql: str, name: str) -> str:
    """Turn a full ``WITH ... SELECT`` into a CTE body usable in a union."""
    return f"({sql}) AS {name}"


def all_sql() -> str:
    parts = [("single", single_sql(True), "string_class3_list"),
             ("multi", multi_sql(3), "string_class3_list"),
             ("scene", scene_sql(True), "string_class3_list")]
    sels = []
    for kind, sql, labels in parts:
        lab = f"coalesce(replace({labels}, '|', chr(30)), '')"
        sels.append(f"""SELECT '{kind}' AS kind,
       sha256(concat_ws(chr(31), '{kind}', string_vid, string_time, {lab})) AS clip_id,
       string_vid, string_time, {labels} AS labels, resourceId
FROM {_wrap(sql, kind + '_docs')}""")
    return "\nUNION ALL\n".join(sels)


def _q(*ctes: str, select: str) -> str:
    return with_(*ctes) + select


ENR = "SELECT * FROM enr"

ORACLE_SQL: dict[str, str] = {
    "detections_union": _q(select="SELECT * FROM det"),
    "detections_enriched": _q(select=ENR),
    "detections_pending": _q(select=ENR + " WHERE video_id IN (SELECT video_id FROM tsk WHERE status = 0)"),
    "detections_exclude_suffix": _q(select=ENR + " e WHERE NOT EXISTS (SELECT 1 FROM vid v WHERE v.videoId = "
                                    "e.video_id AND v.originalUrl LIKE '%.ts')"),
    "detections_known_types": _q(select=ENR + " WHERE class_type_id IN ('1', '2', '3', '4')"),
    "detections_for_video": _q(select=ENR + " WHERE video_id IN (SELECT videoId FROM vid "
                                            "WHERE category = 'AUTOMOBILE')"),
    "pad_intervals": _q(select=f"SELECT video_id, class3_name, detection_id, "
                               f"greatest(ad_seat_b_time - {PAD_MS}, 0) AS ad_seat_b_time, "
                               f"ad_seat_e_time + {PAD_MS} AS ad_seat_e_time FROM nar"),
    "merge_touching_last": _q(merge_cte("m", "nar", 0, PAD_MS, "last"), select="SELECT * FROM m"),
    "merge_touching_max": _q(merge_cte("m", "nar", 0, PAD_MS, "max"), select="SELECT * FROM m"),
    "merge_near_last": _q(merge_cte("m", "nar", GAP_MS, 0, "last"), select="SELECT * FROM m"),
    "merge_near_max": _q(merge_cte("m", "nar", GAP_MS, 0, "max"), select="SELECT * FROM m"),
    "clips_single": single_sql(),
    "clips_single_typed": single_sql(typed=True),
    "clips_for_videos": single_sql(video_filter="v.category = 'AUTOMOBILE'"),
    "sessions_last": _q(merge_cte("m", "nar", GAP_MS, 0, "last"), sessions_cte("s", "m", GAP_MS, "last"),
                        select=SESSION_SUMMARY),
    "sessions_max": _q(merge_cte("m", "nar", GAP_MS, 0, "max"), sessions_cte("s", "m", GAP_MS, "max"),
                       select=SESSION_SUMMARY),
    "sessions_window": _q(merge_cte("m", "nar", GAP_MS, 0, "max"), sessions_cte("s", "m", GAP_MS, "max"),
                          select=SESSION_SUMMARY),
    "clips_multi_v1": multi_sql(1),
    "clips_multi_v2": multi_sql(2),
    "clips_multi_v3": multi_sql(3),
    "scene_containment": _q(CONTAIN, select="SELECT video_id, story_start, story_end, detection_id, class3_name, "
                                            "ad_seat_b_time, ad_seat_e_time FROM sc"),
    "scene_screen_time": _q(CONTAIN, SCREEN, select="SELECT * FROM st"),
    "scene_topk": _q(CONTAIN, SCREEN, topk_cte(TOP_K, "scene"),
                     select="SELECT video_id, story_start, story_end, class_type_id, class3_name, class2_name, "
                            "totaltime, CAST(rank AS BIGINT) AS rank FROM tk"),
    "scene_topk_per_video": _q(CONTAIN, SCREEN, topk_cte(3, "video_scene"),
                               select="SELECT video_id, story_start, story_end, class_type_id, class3_name, "
                                      "class2_name, totaltime, CAST(rank AS BIGINT) AS rank FROM tk"),
    "clips_scene": scene_sql(False),
    "clips_scene_tagged": scene_sql(True),
    "clips_all": all_sql(),
    "clip_counts": f"SELECT kind, CAST(count(*) AS BIGINT) AS n_clips FROM ({all_sql()}) GROUP BY kind",
    "tasks_after_round": _q(select="SELECT video_id, CAST(CASE WHEN status = 0 THEN 1 ELSE status END AS INTEGER) "
                                   "AS status FROM tsk"),
}

SEGMENTS = """
pts AS (SELECT DISTINCT video_id, t FROM (SELECT video_id, ad_seat_b_time AS t FROM m
                                          UNION ALL SELECT video_id, ad_seat_e_time FROM m)),
fr AS (SELECT video_id, t AS frag_b, lead(t) OVER (PARTITION BY video_id ORDER BY t) AS frag_e FROM pts),
sg AS (
  SELECT f.video_id, f.frag_b, f.frag_e, m.class3_name, m.detection_id, m.ad_seat_img
  FROM fr f JOIN m ON m.video_id = f.video_id AND m.ad_seat_b_time <= f.frag_b AND m.ad_seat_e_time >= f.frag_e
  WHERE f.frag_e IS NOT NULL AND m.ad_seat_e_time > m.ad_seat_b_time)"""

ORACLE_SQL["segments"] = _q(merge_cte("m", "nar", 0, PAD_MS, "last"), SEGMENTS, select="""
SELECT video_id, frag_b, frag_e, CAST(count(*) AS BIGINT) AS n_active,
       string_agg(class3_name, '|' ORDER BY class3_name, detection_id) AS labels
FROM sg GROUP BY video_id, frag_b, frag_e""")
ORACLE_SQL["segment_labels"] = _q(merge_cte("m", "nar", 0, PAD_MS, "last"), SEGMENTS, select="SELECT * FROM sg")


# --- clips_json: the JSON text of every document of clips_all ---------------
# Spark's to_json leaves null fields out and writes keys in column order; the
# union puts the single-clip columns first and appends the scene-only
# ``string_long`` at the end.  concat_ws skips a NULL field the same way.
_HEAD = ["string_vid", "media_name", "string_drama_name", "string_drama_type_name",
         "string_media_area_name", "string_time"]
_TYPED_LISTS = [f"string_{n}_list" for n, _ in TYPED]
_JSON_FIELDS = {
    "single": _HEAD + ["string_time_long", "string_class3_list", *_TYPED_LISTS, "string_class2_list",
                       "string_class_img_list", "string_class3_to_img", "string_frame_img_list", "resourceId"],
    "multi": _HEAD + ["string_time_long", "string_class3_list", *_TYPED_LISTS, "string_class2_list",
                      "string_class_img_list", "resourceId"],
    "scene": _HEAD + ["string_class3_list", *_TYPED_LISTS, "string_class2_list", "string_class_img_list",
                      "resourceId", "string_long"],
}
_SCALARS = {"string_vid", "media_name", "string_drama_name", "string_drama_type_name", "string_media_area_name",
            "string_time", "string_time_long", "resourceId", "string_long"}


def _json_value(col: str) -> str:
    if col in _SCALARS:
        return f"CAST(to_json({col}) AS VARCHAR)"
    if col == "string_class3_to_img":  # one label per single clip: 'label=image'
        return (f"CASE WHEN {col} = '' THEN '{{}}' ELSE CAST(to_json(map([split_part({col}, '=', 1)], "
                f"[split_part({col}, '=', 2)])) AS VARCHAR) END")
    return f"CASE WHEN {col} = '' THEN '[]' ELSE CAST(to_json(string_split({col}, '|')) AS VARCHAR) END"


def json_sql() -> str:
    sels = []
    for kind, sql in (("single", single_sql(True)), ("multi", multi_sql(3)), ("scene", scene_sql(True))):
        parts = ", ".join(f"'\"{c}\":' || {_json_value(c)}" for c in _JSON_FIELDS[kind])
        sels.append(f"SELECT '{{' || concat_ws(',', {parts}) || '}}' AS json FROM {_wrap(sql, kind + '_docs')}")
    return "\nUNION ALL\n".join(sels)


ORACLE_SQL["clips_json"] = json_sql()


def _dirty(sql: str) -> str:
    """A query over the dirty fixtures: the same SQL with other ``det`` and ``lab``."""
    sql = sql.replace("det AS (", "det0 AS (", 1).replace("lab AS (", """det AS (
  SELECT CASE WHEN detection_id % 19 = 0 THEN NULL ELSE media_id END AS media_id,
         CAST(CASE WHEN detection_id % 11 = 0 THEN 6 WHEN detection_id % 29 = 0 THEN 7 ELSE class_id END AS BIGINT)
           AS class_id,
         CAST(CASE WHEN detection_id % 13 = 0 THEN -1000 ELSE time_start END AS BIGINT) AS time_start,
         CAST(CASE WHEN detection_id % 17 = 0 THEN -2000 WHEN detection_id % 23 = 0 THEN NULL ELSE time_end END
           AS BIGINT) AS time_end,
         object_img, detection_id // 4 AS detection_id, source
  FROM det0),
lab AS (""", 1)
    return sql.replace("(5, '1', 'thing', 'view'))", "(5, '1', 'thing', 'view'), (6, '2', 'place', NULL), (7, '9', 'odd', 'odd'))", 1)


ORACLE_SQL["clips_multi_dirty"] = _dirty(ORACLE_SQL["clips_multi_v2"])
ORACLE_SQL["clips_scene_dirty"] = _dirty(ORACLE_SQL["clips_scene"])
ORACLE_SQL["clips_single_dirty"] = _dirty(ORACLE_SQL["clips_single"]).replace(
    "    AND d.media_id IN (SELECT videoId FROM vid)),", "    AND l.class2_name IS NOT NULL AND d.media_id IN (SELECT videoId FROM vid)),", 1)
ORACLE_SQL["rejected_counts"] = _dirty(with_()) + """
SELECT reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN media_id IS NULL THEN 'null_video' WHEN time_start IS NULL OR time_end IS NULL THEN 'null_offset'
              WHEN time_end < time_start THEN 'ends_before_begin' END AS r, class2_name, class_type,
         unnest([r, CASE WHEN r IS NULL AND class2_name IS NULL THEN 'null_label' END,
                 CASE WHEN r IS NULL AND class_type NOT IN ('1', '2', '3', '4') THEN 'unknown_type' END]) AS reason
  FROM det JOIN lab USING (class_id))
WHERE reason IS NOT NULL GROUP BY reason"""

ORACLE_SQL["clips_union_v2"] = (
    f"SELECT kind, clip_id, string_vid, string_time FROM ({all_sql()}) WHERE kind IN ('single', 'multi')")
ORACLE_SQL["clips_all_for_videos"] = (
    f"SELECT kind, clip_id, string_vid, string_time FROM ({all_sql()}) WHERE string_vid IN "
    "(SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'AUTOMOBILE')")

#: the same documents, however their videos arrive or repeat
ORACLE_SQL["clips_scene_rounds"] = ORACLE_SQL["clips_scene_tagged"]
ORACLE_SQL["merge_rounds"] = ORACLE_SQL["merge_near_last"]
ORACLE_SQL["sessions_last_stream"] = ORACLE_SQL["sessions_last"]
ORACLE_SQL["clips_duplicate_videos"] = ORACLE_SQL["clips_single"]
ORACLE_SQL["duplicate_videos"] = """
SELECT CAST(c_custkey AS VARCHAR) AS "videoId", CAST(2 AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS n_different
FROM customer"""

STRANGE = """strange AS (
  SELECT CASE WHEN n % 37 = 0 THEN 'nobody' WHEN n % 19 = 0 THEN NULL ELSE media_id END AS media_id,
         CASE WHEN n % 31 = 0 THEN 99 WHEN n % 11 = 0 THEN 6 WHEN n % 29 = 0 THEN 7 ELSE class_id END AS class_id,
         CASE WHEN n % 13 = 0 THEN -1000 ELSE time_start END AS b,
         CASE WHEN n % 17 = 0 THEN -2000 WHEN n % 23 = 0 THEN NULL ELSE time_end END AS e
  FROM (SELECT *, detection_id AS n FROM det))"""
LABELS = """labels2 AS (
  SELECT class_id, class_type, class2_name, true AS known FROM lab
  UNION ALL SELECT * FROM (VALUES (6, '2', NULL, true), (7, '9', 'odd', true)))"""
ORACLE_SQL["rejected_counts_all"] = with_(STRANGE, LABELS) + """
SELECT reason, count(*) AS n_rows FROM (
  SELECT unnest([own, CASE WHEN own IS NULL AND known IS NULL THEN 'unknown_class' END,
                 CASE WHEN ok AND class2_name IS NULL THEN 'null_label' END,
                 CASE WHEN ok AND class_type NOT IN ('1', '2', '3', '4') THEN 'unknown_type' END,
                 CASE WHEN ok AND media_id NOT IN (SELECT videoId FROM vid) THEN 'unknown_video' END]) AS reason
  FROM (SELECT *, own IS NULL AND known IS NOT NULL AS ok FROM (
    SELECT s.media_id, l.*, CASE WHEN media_id IS NULL THEN 'null_video' WHEN b IS NULL OR e IS NULL THEN 'null_offset'
                                 WHEN e < b THEN 'ends_before_begin' END AS own
    FROM strange s LEFT JOIN labels2 l USING (class_id))))
WHERE reason IS NOT NULL GROUP BY reason"""
ORACLE_SQL["known_types_dirty"] = _dirty(ORACLE_SQL["detections_known_types"])
