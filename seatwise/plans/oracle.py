"""The same results as plain SQL over the driver's tables, for checking.

Written apart from the Spark side: only column names are shared.
"""

from __future__ import annotations

from seatwise.schemas import COUNTERS

_PAIRS = {
    "total_docgeneration_acceptedfiles": (
        "docgeneration_acceptedfileupdates + docgeneration_acceptedfilescreations"
    ),
    "total_docgeneration_acceptedlines": (
        "docgeneration_acceptedlineadditions + docgeneration_acceptedlineupdates"
    ),
    "total_docgeneration_rejectedfiles": (
        "docgeneration_rejectedfilecreations + docgeneration_rejectedfileupdates"
    ),
    "total_docgeneration_rejectedlines": (
        "docgeneration_rejectedlineadditions + docgeneration_rejectedlineupdates"
    ),
    "total_inlinechat_acceptedlines": (
        "inlinechat_acceptedlineadditions + inlinechat_acceptedlinedeletions"
    ),
    "total_inlinechat_rejectedlines": (
        "inlinechat_rejectedlineadditions + inlinechat_rejectedlinedeletions"
    ),
}



def _user(key: str) -> str:
    return f"'u' || CASE WHEN {key} % 10 = 0 THEN {key} + 1000000000000 ELSE {key} END"


_paired = {name for pair in _PAIRS.values() for name in pair.split(" + ")}
_SINGLE_SQL = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS total_{c}" for c in COUNTERS if c not in _paired
)
_PAIR_SQL = ", ".join(f"CAST(sum({e}) AS BIGINT) AS {name}" for name, e in _PAIRS.items())
_RATIO_SQL = """
  CAST(sum(codefix_acceptedlines) // nullif(sum(codefix_generatedlines), 0) AS BIGINT)
    AS codefix_acceptance_ratio,
  CAST(sum(dev_acceptedlines) // nullif(sum(dev_generatedlines), 0) AS BIGINT)
    AS dev_acceptance_ratio,
  CAST(sum(testgeneration_acceptedtests) // nullif(sum(testgeneration_generatedtests), 0)
    AS BIGINT) AS test_acceptance_ratio"""
_FRACTION_SQL = """
  CAST(sum(codefix_acceptedlines) AS DOUBLE) / nullif(sum(codefix_generatedlines), 0)
    AS codefix_acceptance_fraction,
  CAST(sum(dev_acceptedlines) AS DOUBLE) / nullif(sum(dev_generatedlines), 0)
    AS dev_acceptance_fraction,
  CAST(sum(testgeneration_acceptedtests) AS DOUBLE)
    / nullif(sum(testgeneration_generatedtests), 0) AS test_acceptance_fraction"""


def _counter(i: int, name: str) -> str:
    off = " * CASE WHEN user_id % 25 = 0 THEN 0 ELSE 1 END"
    zeroed = name.endswith("generatedlines") or name.endswith("generatedtests")
    value = f"(k * {i}) % 50{off if zeroed else ''}"
    return f"CASE WHEN (event_id + {i}) % 7 <> 0 THEN CAST({value} AS INTEGER) END AS {name}"


_VIEWS = {
    "usage": f"""
  SELECT CASE WHEN event_id % 2 = 0 THEN '"' || {_user("user_id")} || '"'
    ELSE {_user("user_id")} END AS userid,
    CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%m-%d-%Y') END AS act_date,
    {", ".join(_counter(i, c) for i, c in enumerate(COUNTERS, 1))}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "latest": """
  SELECT DISTINCT replace(userid, '"', '') AS user_id, latest_activity_date
  FROM (SELECT userid, CAST(max(strptime(act_date, '%m-%d-%Y')) AS DATE) AS latest_activity_date
        FROM usage GROUP BY userid)""",
    "log": f"""
  SELECT CASE WHEN event_id % 2 = 0 THEN '"' || {_user("user_id")} || '"'
    ELSE {_user("user_id")} END AS userid,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 89 = 0 THEN '13-' || strftime(ts, '%d-%Y')
         WHEN event_id % 83 = 0 THEN ''
         ELSE strftime(ts, '%-m-%-d-%Y') END AS data
  FROM events""",
    "people": """
  SELECT 'u' || c_custkey AS user_id, c_name AS user_name,
    CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment || ' ' || c_name END AS display_name,
    split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
    CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS emails,
    CASE WHEN c_custkey % 4 >= 2 THEN 'a' || c_custkey || '@x.test' END AS first_email,
    CASE WHEN c_custkey % 4 = 3 THEN 'b' || c_custkey || '@x.test' ELSE '' END AS primary_email,
    c_custkey
  FROM customer""",
    "known": """
  SELECT user_id, user_name, first_email AS email, display_name
  FROM people WHERE emails IS NULL OR emails > 0""",
    "group_names": """
  SELECT 'n' || n_nationkey AS group_id, n_name AS group_name FROM nation
  UNION ALL SELECT DISTINCT 's' || c_mktsegment, c_mktsegment FROM customer
  UNION ALL SELECT 'empty', 'EMPTY'""",
    "members": f"""
  SELECT 'n' || c_nationkey AS group_id, CAST(c_custkey // 100 AS INTEGER) AS page,
    CAST(c_custkey % 100 AS INTEGER) AS pos, {_user("c_custkey")} AS user_id
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL
  SELECT 's' || c_mktsegment, CAST(c_custkey // 100 AS INTEGER),
    CAST(c_custkey % 100 AS INTEGER), {_user("c_custkey")}
  FROM customer""",
    "assigned": f"""
  SELECT 1 AS page, CAST(c_custkey AS INTEGER) AS pos, 'USER' AS principal_type,
    {_user("c_custkey")} AS principal_id
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT 2, CAST(c_custkey AS INTEGER), 'USER', {_user("c_custkey")}
  FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 3 = 0
  UNION ALL SELECT 3, n_nationkey, 'GROUP', 'n' || n_nationkey
  FROM nation WHERE n_regionkey IN (1, 2)
  UNION ALL SELECT 4, 0, 'GROUP', 'sHOUSEHOLD'
  UNION ALL SELECT 4, 1, 'GROUP', 'empty'
  UNION ALL SELECT 4, 2, 'GROUP', 'n' || min(n_nationkey) FROM nation WHERE n_regionkey = 1""",
    "token_pages": """
  SELECT group_id AS g, CASE WHEN page > 0 THEN substr(sha256(group_id || '/' || page), 1, 12)
      ELSE '' END AS token,
    coalesce(CASE WHEN kind = 4 AND again = 1 THEN substr(sha256(group_id || '/9'), 1, 12)
         WHEN kind = 5 AND page = last THEN substr(sha256(group_id || '/2'), 1, 12)
         WHEN kind = 6 AND page = 5 THEN substr(sha256(group_id || '/3'), 1, 12)
         WHEN kind = 6 AND page = 2 THEN NULL
         WHEN page < last THEN substr(sha256(group_id || '/' || (page + 1)), 1, 12) END, '') AS nxt
  FROM (SELECT *, unnest(CASE WHEN kind IN (3, 4) AND page = 4 THEN [0, 1] ELSE [0] END) AS again
        FROM (SELECT DISTINCT group_id, page, max(page) OVER (PARTITION BY group_id) AS last,
                (length(group_id) * 3 + ascii(substr(group_id, 2, 1))) % 7 AS kind FROM members))
  WHERE NOT (kind = 1 AND page = 0) AND NOT (kind = 2 AND page = 5)""",
    "backs": """
  SELECT n.g, n.token, CASE WHEN n.token <> '' THEN b.before END AS before
  FROM (SELECT DISTINCT g, token FROM token_pages) n LEFT JOIN
    (SELECT g, nxt, min(token) AS before FROM token_pages WHERE nxt <> '' GROUP BY g, nxt) b
    ON b.g = n.g AND b.nxt = n.token""",
    "walked(g, token, start, steps)": """
  SELECT g, token, token, 0 FROM backs WHERE before IS NULL
  UNION ALL
  SELECT b.g, b.token, w.start, w.steps + 1 FROM walked w JOIN backs b
    ON b.g = w.g AND b.before = w.token""",
    "landings": """
  SELECT p.*, l.day, l.whole, l.gone, l.name FROM (SELECT *, c_custkey AS n FROM people) p, LATERAL (
    SELECT * FROM (VALUES
      ('2025-03-01', true, n % 10 <> 9, false, user_name),
      ('2025-03-02', false, n % 3 = 0, false, user_name || '@2'),
      ('2025-03-03', false, n % 7 = 0, true, NULL),
      ('2025-03-04', false, n % 21 = 0, false, user_name || '@4'),
      ('2025-03-05', true, n % 11 <> 0, false, user_name),
      ('2025-03-05', false, n % 5 = 0, false, user_name || '@5'),
      ('2025-03-06', false, n % 10 = 0, n % 20 = 0, user_name || '@6'),
      ('2025-03-08', false, n % 2 = 0, true, NULL)) v(day, whole, held, gone, name)
    WHERE held) l""",
    "standing": """
  SELECT d.day AS asked, l.*,
    row_number() OVER (PARTITION BY d.day, user_id ORDER BY l.day DESC, whole) AS place
  FROM (SELECT unnest(['2025-03-01', '2025-03-03', '2025-03-05', '2025-03-06', '2025-03-07',
          '2025-03-09']) AS day) d
  JOIN landings l ON l.day <= d.day AND l.day >= CASE WHEN d.day >= '2025-03-05'
    THEN '2025-03-05' ELSE '2025-03-01' END""",
    "roster": """
  SELECT a.page, a.pos, a.principal_id AS group_id, g.group_name, m.page AS member_page,
    m.pos AS member_pos, k.user_id, k.user_name, k.email, k.display_name
  FROM assigned a JOIN group_names g ON g.group_id = a.principal_id
  JOIN members m ON m.group_id = a.principal_id JOIN known k ON k.user_id = m.user_id
  WHERE a.principal_type = 'GROUP'""",
    "summary": """
  SELECT a.page, a.pos, a.principal_id AS group_id, g.group_name, count(r.user_id) AS user_count
  FROM assigned a JOIN group_names g ON g.group_id = a.principal_id
  LEFT JOIN roster r ON r.page = a.page AND r.pos = a.pos
  WHERE a.principal_type = 'GROUP' GROUP BY ALL""",
    "report": """
  SELECT CAST(NULL AS INTEGER) AS page, CAST(NULL AS INTEGER) AS pos, 0 AS part,
    unnest([0, 1, 2, 3, 4, 5]) AS major, 0 AS minor,
    unnest(['', 'Group Access Summary:', repeat('-', 39),
      'Total Users Across All Groups: ' || (SELECT count(*) FROM roster),
      '', 'Group Details:']) AS line
  UNION ALL
  SELECT page, pos, unnest([1, 1, 1, 1, 1, 1, 3]), unnest([0, 1, 2, 3, 4, 5, 0]), 0,
    unnest(['', 'Group Name: ' || group_name, 'Group ID: ' || group_id,
      'Number of Users: ' || user_count, '', 'Users in this group:', repeat('-', 39)])
  FROM summary
  UNION ALL
  SELECT page, pos, 2, member_page, member_pos,
    '- ' || coalesce(display_name, 'None') || ' (' || coalesce(email, 'None') || ')'
  FROM roster""",
}

_ROSTER_VIEWS = ("people", "known", "group_names", "members", "assigned", "roster")
_ENRICHED = """
  SELECT l.user_id, k.user_name, k.email, k.display_name,
    CASE WHEN k.user_id IS NOT NULL THEN l.{date} END AS last_activity_date
  FROM {source} l LEFT JOIN known k ON k.user_id = l.user_id"""
_DIRECT = """
  SELECT DISTINCT p.user_id, p.user_name, p.primary_email AS email, p.first_name, p.last_name,
    coalesce(p.display_name, '') AS display_name
  FROM assigned a JOIN people p ON p.user_id = a.principal_id WHERE a.principal_type = 'USER'"""


def _sql(body: str, *views: str) -> str:
    named = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in views)
    return f"WITH RECURSIVE {named}\n{body}" if views else body


_ROLLUP = f"""SELECT userid, count(DISTINCT act_date) AS active_days, {_SINGLE_SQL}, {_PAIR_SQL},
        {_RATIO_SQL}, {_FRACTION_SQL} FROM usage GROUP BY userid ORDER BY active_days DESC"""

ORACLE: dict[str, str] = {
    "usage_rollup": _sql(_ROLLUP, "usage"),
    "usage_rollup_folded": _sql(_ROLLUP, "usage"),
    "usage_rollup_table": _sql(_ROLLUP, "usage"),
    "latest_activity_table": _sql("SELECT * FROM latest", "usage", "latest"),
    "conversion_losses": _sql(
        f"""WITH lines AS (
          SELECT n % 11 = 0 AS short, n % 11 <> 0 AND n % 13 = 0 AS long,
            n % 5 = 0 AS many, n % 11 <> 0 AND n % 7 = 0 AS big
          FROM (SELECT CAST(substr(replace(userid, '"', ''), 2) AS BIGINT) AS n FROM usage))
        SELECT unnest(['rows', 'short rows', 'missing fields', 'rows with surplus',
            'surplus fields', 'failed', 'failed', 'failed', 'failed']) AS measure,
          unnest([NULL, NULL, NULL, NULL, NULL, {", ".join(f"'{c}'" for c in COUNTERS[:4])}])
            AS column,
          CAST(unnest([count(*), count_if(short), 3 * count_if(short), count_if(long),
            2 * count_if(long), count_if(many), 0, 0, count_if(big)]) AS BIGINT) AS n
        FROM lines""",
        "usage",
    ).replace("\nWITH lines AS", ", lines AS", 1),
    "active_days": _sql(
        "SELECT userid, count(DISTINCT act_date) AS active_days FROM usage GROUP BY userid",
        "usage",
    ),
    "usage_pair_sums": _sql(f"SELECT userid, {_PAIR_SQL} FROM usage GROUP BY userid", "usage"),
    "acceptance_ratio": _sql(f"SELECT userid, {_RATIO_SQL} FROM usage GROUP BY userid", "usage"),
    "acceptance_fraction": _sql(
        f"SELECT userid, {_FRACTION_SQL} FROM usage GROUP BY userid", "usage"
    ),
    "latest_activity": _sql("SELECT * FROM latest", "usage", "latest"),
    "latest_activity_normalized": _sql(
        "SELECT user_id, max(latest_activity_date) AS latest_activity_date "
        "FROM latest GROUP BY user_id",
        "usage",
        "latest",
    ),
    "latest_activity_lenient": _sql(
        """SELECT DISTINCT replace(userid, '"', '') AS user_id, latest_activity_date
        FROM (SELECT userid, CAST(max(try_strptime(data, '%m-%d-%Y')) AS DATE)
                AS latest_activity_date
              FROM log GROUP BY userid)""",
        "log",
    ),
    "latest_activity_sql": _sql(
        "SELECT user_id, CAST(latest_activity_date AS TIMESTAMP) AS latest_activity_date "
        "FROM latest",
        "usage",
        "latest",
    ),
    "bad_days": _sql(
        "SELECT count(*) AS rejected FROM log WHERE data IS NOT NULL "
        "AND try_strptime(data, '%m-%d-%Y') IS NULL",
        "log",
    ),
    "sample_rows": "SELECT least(count(*), 100) AS returned, CAST(0 AS BIGINT) AS foreign FROM events",
    "parsed_patterns": """
      SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS packed,
        date_trunc('day', ts)::TIMESTAMP AS short_name,
        date_trunc('day', ts)::TIMESTAMP AS long_name, date_trunc('second', ts) AS exact,
        date_trunc('minute', ts) AS one_digit, date_trunc('second', ts) AS half_days,
        date_trunc('minute', ts) AS quoted
      FROM events""",
    "incomplete_landings": _sql(
        """SELECT group_id AS "GroupId", min(page) AS first_page, max(page) AS last_page,
          count(*) AS pages,
          CASE WHEN min(page) > 1 THEN 'first page missing'
               WHEN count(DISTINCT page) <= max(page) - min(page) THEN 'page missing'
               WHEN count(*) > count(DISTINCT page) THEN 'page repeated'
               WHEN max(page) < max(last) THEN 'last page missing' END AS problem
        FROM (SELECT *, unnest(range(CASE WHEN kind = 3 AND page = 1 THEN 2 ELSE 1 END)) AS copy
              FROM (SELECT DISTINCT group_id, page,
                      max(page) OVER (PARTITION BY group_id) AS last,
                      (length(group_id) + ascii(substr(group_id, 2, 1))) % 5 AS kind
                    FROM members)
              WHERE NOT (kind = 1 AND page = 0) AND NOT (kind = 2 AND page = last))
        GROUP BY group_id HAVING problem IS NOT NULL""",
        "members",
    ),
    "page_order": _sql(
        """SELECT g AS "GroupId", token, CAST(steps + 1 AS INTEGER) AS page
        FROM walked WHERE start = ''""",
        "members",
        "token_pages",
        "backs",
        "walked(g, token, start, steps)",
    ),
    "chain_problems": _sql(
        """SELECT g AS "GroupId", problem, min(token) AS token, count(*) AS pages FROM (
          SELECT g, token, 'page repeated' AS problem FROM
            (SELECT g, token, nxt, count(*) AS c FROM token_pages GROUP BY ALL)
          GROUP BY g, token HAVING max(c) > 1
          UNION ALL
          SELECT g, token, 'fork' FROM token_pages GROUP BY g, token HAVING count(DISTINCT nxt) > 1
          UNION ALL
          SELECT g, nxt, 'token repeated' FROM token_pages WHERE nxt <> ''
          GROUP BY g, nxt HAVING count(DISTINCT token) > 1
          UNION ALL
          SELECT DISTINCT g, nxt, 'gap' FROM token_pages p WHERE nxt <> '' AND NOT EXISTS
            (SELECT 1 FROM token_pages q WHERE q.g = p.g AND q.token = p.nxt)
          UNION ALL
          SELECT g, token, 'cut off' FROM walked WHERE steps = 0 AND token <> ''
          UNION ALL
          SELECT g, token, 'cycle' FROM backs b WHERE NOT EXISTS
            (SELECT 1 FROM walked w WHERE w.g = b.g AND w.token = b.token)
          UNION ALL
          SELECT g, min(token), 'first page missing' FROM backs GROUP BY g HAVING min(token) <> '')
        GROUP BY g, problem""",
        "members",
        "token_pages",
        "backs",
        "walked(g, token, start, steps)",
    ),
    "direct_users": _sql(_DIRECT, "people", "assigned"),
    "direct_user_count": _sql(
        """SELECT count(DISTINCT a.principal_id) AS assigned_users,
          count(DISTINCT p.user_id) AS known_users
        FROM assigned a LEFT JOIN people p ON p.user_id = a.principal_id
        WHERE a.principal_type = 'USER'""",
        "people",
        "assigned",
    ),
    "enrich_activity": _sql(
        _ENRICHED.format(
            date="act_date",
            source="(SELECT replace(userid, '\"', '') AS user_id, act_date FROM usage)",
        ),
        "usage",
        "people",
        "known",
    ),
    "activity_with_profile": _sql(
        _ENRICHED.format(date="latest_activity_date", source="latest"),
        "usage",
        "latest",
        "people",
        "known",
    ),
    "activity_with_profile_table": _sql(
        _ENRICHED.format(date="latest_activity_date", source="latest"),
        "usage",
        "latest",
        "people",
        "known",
    ),
    "effective_users": _sql(
        """SELECT i.user_id, k.user_name, k.email, k.display_name
        FROM (SELECT principal_id AS user_id FROM assigned WHERE principal_type = 'USER'
              UNION
              SELECT m.user_id FROM members m WHERE m.group_id IN
                (SELECT principal_id FROM assigned WHERE principal_type = 'GROUP')) i
        LEFT JOIN known k ON k.user_id = i.user_id""",
        "people",
        "known",
        "members",
        "assigned",
    ),
    "group_roster": _sql("SELECT * EXCLUDE (member_page, member_pos) FROM roster", *_ROSTER_VIEWS),
    "group_summary": _sql("SELECT * FROM summary", *_ROSTER_VIEWS, "summary"),
    "group_totals": _sql(
        "SELECT count(*) AS total_users, count(DISTINCT user_id) AS distinct_users FROM roster",
        *_ROSTER_VIEWS,
    ),
    "group_nested": _sql(
        """SELECT r.page, r.pos, s.group_id, s.group_name, s.user_count,
          CAST(member_page // 4 AS BIGINT) AS chunk,
          CAST(to_json(list({'user_id': user_id, 'user_name': user_name, 'email': email,
            'display_name': display_name} ORDER BY member_page, member_pos, user_id))
            AS VARCHAR) AS users
        FROM roster r JOIN summary s ON s.page = r.page AND s.pos = r.pos
        GROUP BY ALL
        UNION ALL
        SELECT page, pos, group_id, group_name, user_count, 0, '[]'
        FROM summary WHERE user_count = 0""",
        *_ROSTER_VIEWS,
        "summary",
    ),
    "group_report": _sql("SELECT * FROM report", *_ROSTER_VIEWS, "summary", "report"),
    "group_report_places": _sql(
        """SELECT *, row_number() OVER place AS line_number,
          CAST(sum(strlen(line) + 1) OVER place - strlen(line) - 1 AS BIGINT) AS byte_offset,
          strlen(line) + 1 AS byte_length
        FROM report
        WINDOW place AS (ORDER BY page NULLS FIRST, pos NULLS FIRST, part, major, minor, line
          ROWS UNBOUNDED PRECEDING)""",
        *_ROSTER_VIEWS,
        "summary",
        "report",
    ),
    "publish_manifest": _sql(
        """SELECT CAST(unnest([1, 2]) AS BIGINT) AS version,
          CAST(unnest([count(*) FILTER (line LIKE '- %'), count(*)]) AS BIGINT) AS rows,
          CAST(unnest([sum(strlen(line) + 1) FILTER (line LIKE '- %'), sum(strlen(line) + 1)])
            AS BIGINT) AS bytes
        FROM report""",
        *_ROSTER_VIEWS,
        "summary",
        "report",
    ),
    "directory_as_of": _sql(
        """SELECT user_id, name AS user_name, display_name, emails FROM standing
        WHERE asked = '2025-03-06' AND place = 1 AND NOT gone""",
        "people",
        "landings",
        "standing",
    ),
    "directory_landings": _sql(
        """SELECT asked AS day, count(*) AS users,
          CAST(count_if(name LIKE '%@%') AS BIGINT) AS renamed
        FROM standing WHERE place = 1 AND NOT gone AND asked <> '2025-03-06' GROUP BY asked""",
        "people",
        "landings",
        "standing",
    ),
    "first_store": """
      SELECT 'd-' || lpad(CAST(97 - n_nationkey AS VARCHAR), 3, '0') AS identity_store_id
      FROM nation ORDER BY n_regionkey DESC, n_nationkey LIMIT 1""",
    "snk_published": _sql("SELECT * FROM latest", "usage", "latest"),
    "effective_users_by_application": _sql(
        """SELECT a.app AS application_arn, a.user_id, k.user_name, k.email, k.display_name
        FROM (SELECT DISTINCT app, coalesce(m.user_id, principal_id) AS user_id
              FROM (SELECT 'app' || page AS app, * FROM assigned
                    UNION ALL
                    SELECT 'app2', * FROM assigned WHERE principal_type = 'GROUP' AND pos % 2 = 0) s
              LEFT JOIN members m ON s.principal_type = 'GROUP' AND m.group_id = s.principal_id
              WHERE s.principal_type = 'USER' OR m.user_id IS NOT NULL) a
        LEFT JOIN known k ON k.user_id = a.user_id WHERE a.app IN ('app2', 'app3')""",
        "people",
        "known",
        "members",
        "assigned",
    ),
    "email_primary": _sql("SELECT user_id, primary_email AS email FROM people", "people"),
    "email_first": _sql("SELECT user_id, email FROM known", "people", "known"),
    "uri_parts": """
      SELECT page_id, split_part(rest, '/', 1) AS bucket,
        CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/') + 1) END AS key
      FROM (SELECT page_id, regexp_replace(url, '^https?://', '') AS rest FROM pages)""",
    "export_stamp": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events",
    "src_usage_text": _sql("SELECT * FROM usage", "usage"),
    "src_activity_text": _sql("SELECT * FROM log", "log"),
    "src_usage_parquet": _sql(
        "SELECT *, replace(userid, '\"', '') AS user_id FROM usage", "usage"
    ),
    "src_user_list": _sql(
        "SELECT userid AS user_id, replace(act_date, '-', ', \"') AS last_activity_date FROM usage",
        "usage",
    ),
    "src_user_list_multiline": """
      SELECT 'u' || user_id || CASE WHEN event_id % 3 = 0 THEN chr(10) || chr(10) ELSE '' END
          || 'x"y' AS user_id,
        CASE WHEN event_id % 4 <> 0 THEN strftime(ts, '%m-%d-%Y')
          || CASE WHEN event_id % 5 = 0 THEN chr(10) || '"late",' || chr(10) ELSE '' END
        END AS last_activity_date
      FROM events""",
    "src_assignments": _sql(
        """SELECT 'arn:test:application/main' AS application_arn, page,
          CAST(row_number() OVER (PARTITION BY page ORDER BY pos) - 1 AS INTEGER) AS pos,
          principal_type, principal_id
        FROM (SELECT CAST((pos // 100) * 10 + page AS INTEGER) AS page, pos, principal_type,
                principal_id FROM assigned WHERE page <> 2)""",
        "assigned",
    ),
    "src_memberships": _sql(
        """SELECT group_id, page,
          CAST(row_number() OVER (PARTITION BY group_id, page ORDER BY pos) - 1 AS INTEGER) AS pos,
          user_id
        FROM members WHERE page % 5 <> 0""",
        "members",
    ),
    "src_memberships_by_token": _sql(
        """SELECT group_id,
          CAST(dense_rank() OVER (PARTITION BY group_id ORDER BY page) AS INTEGER) AS page,
          CAST(row_number() OVER (PARTITION BY group_id, page ORDER BY pos) - 1 AS INTEGER) AS pos,
          user_id
        FROM members""",
        "members",
    ),
    "src_directory": _sql(
        """SELECT user_id, user_name, display_name, first_name, last_name,
          emails, first_email, primary_email
        FROM people WHERE c_custkey % 3 = 0""",
        "people",
    ),
    "src_groups": _sql("SELECT * FROM group_names", "group_names"),
    "snk_csv_roundtrip": _sql("SELECT * FROM latest", "usage", "latest"),
    "snk_user_export": _sql(
        f"""SELECT user_id AS "UserId", user_name AS "Username", nullif(email, '') AS "Email",
          first_name AS "FirstName", last_name AS "LastName",
          nullif(display_name, '') AS "DisplayName"
        FROM ({_DIRECT})""",
        "people",
        "assigned",
    ),
    "snk_activity_export": _sql(
        f"""SELECT user_id AS "UserId", user_name AS "Username", email AS "Email",
          display_name AS "DisplayName", CAST(last_activity_date AS VARCHAR) AS "LastActivityDate"
        FROM ({_ENRICHED.format(date="latest_activity_date", source="latest")})""",
        "usage",
        "latest",
        "people",
        "known",
    ),
    "snk_report_text": _sql("SELECT line FROM report", *_ROSTER_VIEWS, "summary", "report"),
}
