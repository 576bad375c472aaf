"""Registered queries for page extraction (pages table) and metric rules (events table)."""
from __future__ import annotations

from pyspark.sql import functions as F

from jobsift.plans import fixtures as fx
from jobsift.plans import metrics, pages
from jobsift.plans import sqltext as S
from jobsift.plans.registry import register

# ---------------------------------------------------------------- SQL restatement of the HTML rules

_WS = r"[ \t\n\r\f]"
CLEAN = r"""regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g')"""


def _decode(x: str) -> str:
    from jobsift.plans.sqltext import ENTITIES
    out = x
    for ent, ch in ENTITIES:
        out = f"replace({out}, {S.q(ent)}, {S.q(ch)})"
    return out


def _strip(x: str) -> str:
    return f"regexp_replace({_decode(x)}, '^{_WS}+|{_WS}+$', '', 'g')"


def _node_text(frag: str) -> str:
    return (f"array_to_string(list_filter(list_transform(regexp_split_to_array({frag}, '<[^>]*>'), "
            f"lambda t: {_strip('t')}), lambda t: t <> ''), '')")


def _first_match(pattern: str) -> str:
    return (f"COALESCE(list_filter(list_transform(regexp_split_to_array({CLEAN}, '<[^>]*>'), lambda t: {_strip('t')}), "
            f"lambda t: regexp_matches(t, {S.q(pattern)}))[1], '')")


def _blocks() -> str:
    contents = (f"list_transform(regexp_split_to_array({CLEAN}, '(?i)<(?:p|li)(?:\\s[^>]*)?>')[2:], "
                f"lambda p: regexp_split_to_array(p, '(?i)</(?:p|li|article)>|<(?:ul|ol)(?:\\s[^>]*)?>|</(?:ul|ol)>')[1])")
    return f"list_transform({contents}, lambda c: {_node_text('c')})"


def _body(blocks: str = "[1:50]") -> str:
    keep = f"list_filter({_blocks()}, lambda t: length(t) > 30 AND NOT contains(lower(t), 'cookie'))"
    return f"array_to_string({keep}{blocks}, chr(10))"


def _icon(alt: str) -> str:
    return _strip(f"regexp_extract({CLEAN}, '(?is)<img[^>]*alt=\"{alt}\"[^>]*>([^<]*)', 1)")


_ORIGIN = "regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
LINK_FRAGMENT = "/"   # the test pages link to site-relative paths


@register("extract_links", f"""
WITH h AS (SELECT page_id, url, list_filter(regexp_extract_all({CLEAN}, '(?is)<a\\s[^>]*href="([^"]*)"', 1),
                  lambda x: contains(x, {S.q(LINK_FRAGMENT)}) AND x <> '') AS hrefs FROM pages),
l AS (SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS i FROM h),
a AS (SELECT page_id, CASE WHEN starts_with(href, 'http') THEN href ELSE {_ORIGIN} || href END AS link, i FROM l),
f AS (SELECT page_id, link, MIN(i) AS first_i FROM a GROUP BY 1, 2)
SELECT page_id, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY first_i) - 1 AS INTEGER) AS position, link FROM f""")
def q_extract_links(spark, d):
    return pages.extract_links(fx.load(spark, d, "pages"), LINK_FRAGMENT)


_CONTRACT_SQL = "(?i)(^|[^\\p{L}\\p{N}_])(" + "|".join(pages.CONTRACT_WORDS) + ")([^\\p{L}\\p{N}_]|$)"
_ANCHORS = f"regexp_extract_all({CLEAN}, '(?is)<a\\s[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>', 0)"
_COMPANY = (f"COALESCE({_node_text(f'''regexp_extract(list_filter({_ANCHORS}, lambda a: contains(regexp_extract(a, 'href=\"([^\"]*)\"', 1), {S.q(pages.COMPANY_LINK_FRAGMENT)}))[1], '(?is)^<a[^>]*>(.*)</a>$', 1)''')}, '')")


def _fields(body: str) -> str:
    return f"""
SELECT page_id, {_node_text(f"regexp_extract({CLEAN}, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1)")} AS title,
       {_COMPANY} AS company,
       COALESCE(NULLIF({_icon('location')}, ''), {_first_match(pages.LOCATION_FALLBACK)}) AS location,
       {_icon('remote')} AS remote, {_first_match(_CONTRACT_SQL)} AS contract_type,
       {_first_match(pages.SALARY_HINT)} AS salary, url, {body} AS description
FROM pages"""


@register("extract_page_fields", _fields(_body()))
def q_extract_page_fields(spark, d):
    return pages.extract_page_fields(fx.load(spark, d, "pages"), max_blocks=pages.REFERENCE_BLOCKS)


@register("extract_page_fields_whole", _fields(_body("")))
def q_extract_page_fields_whole(spark, d):
    return pages.extract_page_fields(fx.load(spark, d, "pages"))


@register("extract_body_text", f"""
SELECT page_id, {_body()} AS description, CAST(len(list_filter({_blocks()}, lambda t: length(t) > 30)) AS INTEGER) AS n_long_blocks
FROM pages""")
def q_extract_body_text(spark, d):
    return pages.extract_body_text(fx.load(spark, d, "pages"), max_blocks=pages.REFERENCE_BLOCKS)


@register("extract_body_text_whole", f"""
SELECT page_id, {_body("")} AS description, CAST(len(list_filter({_blocks()}, lambda t: length(t) > 30)) AS INTEGER) AS n_long_blocks
FROM pages""")
def q_extract_body_text_whole(spark, d):
    return pages.extract_body_text(fx.load(spark, d, "pages"))


_KNOWN = ("SELECT c_custkey AS page_id, c_name AS title, 'Ets ' || c_name || ' &Fils' AS company, c_custkey % 90000 + 10000 || ' Ville, France' AS location, "
          "'Télétravail ' || c_mktsegment AS remote, 'Contrat : CDI' AS contract_type, c_custkey % 90 + 10 || ' k€ par an' AS salary, "
          "'https://board.example/fr/job/' || c_custkey AS url, "
          "'Description « ' || c_name || ' » assez longue pour compter.' || chr(10) || 'Deuxième bloc du segment ' || c_mktsegment || ', sans paragraphe.' AS description")


@register("extract_page_fields_known", _KNOWN + " FROM customer")
def q_extract_page_fields_known(spark, d):
    """Pages written from known fields, with what real pages do: text in an element beside the icon, a contract word in
    the page title, all kinds of quotes, numeric and named entities, paragraphs that are never closed."""
    c = fx.load(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    html = F.format_string(
        "<html><head><title>Offre Stage | Board</title></head><body><h1>%1$s</h1><a class=x href='/organization/%2$s'>Ets %1$s &amp; <b>Fils</b></a>"
        "<div><img src=a.png alt='location'><span>%3$s Ville, France</span></div><p><img alt=remote><i>T&eacute;l&#233;travail %4$s</i></p>"
        "<span>Contrat&nbsp;: CDI</span><em>%5$s k&euro; par an</em><p>Description &laquo; %1$s &raquo; assez longue pour compter."
        "<ul><li>court<li>Deuxi&#xe8;me bloc du segment %4$s, sans paragraphe.</ul><p>Nous utilisons des cookies sur ce site de test.</p></body></html>",
        F.col("c_name"), F.col("c_custkey").cast("string"), (F.col("c_custkey") % 90000 + 10000).cast("string"), F.col("c_mktsegment"),
        (F.col("c_custkey") % 90 + 10).cast("string"))
    rows = c.select(F.col("c_custkey").alias("page_id"), F.concat(F.lit("https://board.example/fr/job/"), "c_custkey").alias("url"), html.alias("html"))
    out = pages.extract_page_fields(rows)
    plain = lambda n: F.translate(n, "\u00a0", " ").alias(n)
    return out.select("page_id", "title", "company", "location", "remote", plain("contract_type"), "salary", "url", "description")


# ---------------------------------------------------------------- metrics on events

_INC = """
s AS (SELECT event_id, user_id, event_type, props, epoch_us(ts) AS us, CAST(ROUND(value * 100) AS BIGINT) AS c FROM events),
p AS (SELECT *, LAG(c) OVER (PARTITION BY user_id ORDER BY us) AS pc, LAG(us) OVER (PARTITION BY user_id ORDER BY us) AS pus FROM s),
i AS (SELECT *, CASE WHEN pc IS NULL THEN NULL WHEN c >= pc THEN c - pc ELSE c END AS inc FROM p)"""
_RATE_WIN = "(PARTITION BY user_id ORDER BY us RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW)"


@register("counter_rate", "WITH " + _INC.strip() + f"""
SELECT event_id, user_id, CAST(rate_cents AS BIGINT) AS rate_cents, rate_cents / 30000 AS rate FROM (
  SELECT event_id, user_id, COALESCE(SUM(inc) OVER w, 0) - COALESCE(FIRST_VALUE(inc) OVER w, 0) AS rate_cents
  FROM i WINDOW w AS {_RATE_WIN})""")
def q_counter_rate(spark, d):
    ev = fx.load(spark, d, "events")
    return metrics.counter_rate(ev, scale=2)


@register("counter_rate_by_label", "WITH " + _INC.strip() + f""",
r AS (SELECT event_type, COALESCE(SUM(inc) OVER w, 0) - COALESCE(FIRST_VALUE(inc) OVER w, 0) AS rate_cents
      FROM i WINDOW w AS {_RATE_WIN})
SELECT event_type, CAST(SUM(rate_cents) AS DOUBLE) / (COUNT(*) * 30000) AS mean_rate FROM r GROUP BY event_type""")
def q_counter_rate_by_label(spark, d):
    ev = fx.load(spark, d, "events")
    return metrics.rate_by_label(metrics.counter_rate(ev, carry=("event_type",), scale=2), "event_type", scale=2)


@register("counter_rate_by_label_over_time", "WITH " + _INC.strip() + f""",
r AS (SELECT event_type, us, COALESCE(SUM(inc) OVER w, 0) - COALESCE(FIRST_VALUE(inc) OVER w, 0) AS rate_cents
      FROM i WINDOW w AS {_RATE_WIN})
SELECT event_type, date_trunc('hour', make_timestamp(us)) AS step_start, CAST(SUM(rate_cents) AS DOUBLE) / (COUNT(*) * 30000) AS mean_rate
FROM r GROUP BY 1, 2""")
def q_counter_rate_by_label_over_time(spark, d):
    """One rate per label and hour, from many ranges: windows reach over several of them."""
    ev = fx.load(spark, d, "events")
    rates = metrics.counter_rate(ev, carry=("event_type", "ts"), scale=2, ranges=61)
    return metrics.rate_by_label_over_time(rates, "event_type", scale=2)


@register("usage_ratio", """
SELECT user_id, step_start, (1 - available / total) * 100 AS usage_pct FROM (
  SELECT user_id, date_trunc('day', ts) AS step_start, MAX(CASE WHEN event_type = 'view' THEN value END) AS available,
         MAX(CASE WHEN event_type = 'click' THEN value END) AS total FROM events GROUP BY 1, 2)
WHERE available IS NOT NULL AND total > 0""")
def q_usage_ratio(spark, d):
    return metrics.usage_ratio(fx.load(spark, d, "events"), "view", "click", step="day")


THRESHOLD, FOR_SECONDS = 25.0, 300
MAX_GAP = 3600


@register("sustained_threshold", f"""
WITH s AS (SELECT user_id, ts, value, CAST(value <= {THRESHOLD} AS INTEGER) AS ok FROM events),
r AS (SELECT *, SUM(ok) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s)
SELECT user_id, MIN(ts) AS start, MAX(ts) AS "end", COUNT(*) AS n, 'critical' AS severity FROM r WHERE ok = 0
GROUP BY user_id, run HAVING epoch_us(MAX(ts)) - epoch_us(MIN(ts)) >= {FOR_SECONDS * 1_000_000}""")
def q_sustained_threshold(spark, d):
    return metrics.sustained_threshold(fx.load(spark, d, "events"), THRESHOLD, FOR_SECONDS, "critical")


@register("sustained_threshold_gap", f"""
WITH s AS (SELECT user_id, ts, value <= {THRESHOLD} AS ok, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
b AS (SELECT *, CAST(ok OR COALESCE(epoch_us(ts) - epoch_us(prev) > {MAX_GAP * 1_000_000}, FALSE) AS INTEGER) AS brk FROM s),
r AS (SELECT *, SUM(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM b)
SELECT user_id, MIN(ts) AS start, MAX(ts) AS "end", COUNT(*) AS n, 'critical' AS severity FROM r WHERE NOT ok
GROUP BY user_id, run HAVING epoch_us(MAX(ts)) - epoch_us(MIN(ts)) >= {FOR_SECONDS * 1_000_000}""")
def q_sustained_threshold_gap(spark, d):
    return metrics.sustained_threshold(fx.load(spark, d, "events"), THRESHOLD, FOR_SECONDS, "critical", max_gap_seconds=MAX_GAP)


# The rule chain "rate of an idle counter -> 100 - x -> above a limit for some time -> severity".
BUSY_LIMIT, BUSY_FOR = 90.0, 300


@register("alert_rule_cpu", "WITH " + _INC.strip() + f""",
q AS (SELECT user_id, us, COALESCE(SUM(inc) OVER w, 0) - COALESCE(FIRST_VALUE(inc) OVER w, 0) AS rate_cents FROM i WINDOW w AS {_RATE_WIN}),
bz AS (SELECT user_id, us, CAST(100.0 - (rate_cents / 30000) * 100 <= {BUSY_LIMIT} AS INTEGER) AS ok FROM q),
r AS (SELECT *, SUM(ok) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM bz),
g AS (SELECT user_id, run, us, MIN(us) OVER (PARTITION BY user_id, run) AS start_us FROM r WHERE ok = 0)
SELECT CAST(user_id AS VARCHAR) AS series, make_timestamp(start_us) AS start, make_timestamp(MIN(us)) AS fired_at, 'critical' AS severity
FROM g WHERE us - start_us >= {BUSY_FOR * 1_000_000} GROUP BY user_id, run, start_us""")
def q_alert_rule_cpu(spark, d):
    ev = fx.load(spark, d, "events")
    busy = metrics.busy_percent(metrics.counter_rate(ev, carry=("ts",), scale=2))
    return metrics.fired_alerts(busy, BUSY_LIMIT, BUSY_FOR, "critical", value="busy_pct")


@register("alert_rule_memory", f"""
WITH u AS (SELECT user_id, step_start, (1 - available / total) * 100 AS pct FROM (
  SELECT user_id, date_trunc('day', ts) AS step_start, MAX(CASE WHEN event_type = 'view' THEN value END) AS available,
         MAX(CASE WHEN event_type = 'click' THEN value END) AS total FROM events GROUP BY 1, 2) WHERE available IS NOT NULL AND total > 0),
r AS (SELECT *, SUM(CAST(pct <= 50 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY step_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM u),
g AS (SELECT user_id, run, step_start, MIN(step_start) OVER (PARTITION BY user_id, run) AS start FROM r WHERE pct > 50)
SELECT CAST(user_id AS VARCHAR) AS series, start, MIN(step_start) AS fired_at, 'warning' AS severity
FROM g WHERE epoch_us(step_start) - epoch_us(start) >= 86400000000 GROUP BY user_id, run, start""")
def q_alert_rule_memory(spark, d):
    """The memory rule: a usage ratio above its limit for some time (here above half for a day of daily steps)."""
    use = metrics.usage_ratio(fx.load(spark, d, "events"), "view", "click", step="day")
    return metrics.fired_alerts(use, 50.0, 86400, "warning", ts="step_start", value="usage_pct")


def _fired_sql(rows: str, series: str, at: str, value: str, limit: float, seconds: int, severity: str) -> str:
    """When a rule fires over the rows of a CTE: at the first row at which a run above the limit has lasted."""
    return f"""
r AS (SELECT *, SUM(CAST({value} <= {limit} AS INTEGER)) OVER (PARTITION BY {series} ORDER BY {at} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM {rows}),
g AS (SELECT {series}, run, {at} AS seen, MIN({at}) OVER (PARTITION BY {series}, run) AS start FROM r WHERE {value} > {limit})
SELECT CAST({series} AS VARCHAR) AS series, start, MIN(seen) AS fired_at, '{severity}' AS severity
FROM g WHERE epoch_us(seen) - epoch_us(start) >= {seconds * 1_000_000} GROUP BY {series}, run, start"""


AVERAGE_BUSY = 99.9


@register("alert_rule_cpu_average", "WITH " + _INC.strip() + f""",
q AS (SELECT event_type, us, COALESCE(SUM(inc) OVER w, 0) - COALESCE(FIRST_VALUE(inc) OVER w, 0) AS rate_cents FROM i WINDOW w AS {_RATE_WIN}),
a AS (SELECT event_type, date_trunc('hour', make_timestamp(us)) AS step_start, CAST(SUM(rate_cents) AS DOUBLE) / (COUNT(*) * 30000) AS mean_rate FROM q GROUP BY 1, 2),
bz AS (SELECT event_type, step_start, 100.0 - mean_rate * 100 AS busy FROM a),""" + _fired_sql("bz", "event_type", "step_start", "busy", AVERAGE_BUSY, 7200, "critical"))
def q_alert_rule_cpu_average(spark, d):
    """The CPU rule as written: rates of all idle counters are averaged (here by label and hour) before the limit applies."""
    ev = fx.load(spark, d, "events")
    rates = metrics.rate_by_label_over_time(metrics.counter_rate(ev, carry=("event_type", "ts"), scale=2), "event_type", scale=2)
    return metrics.fired_alerts(metrics.busy_percent(rates, "mean_rate"), AVERAGE_BUSY, 7200, "critical", series="event_type", ts="step_start", value="busy_pct")


@register("alert_rule_disk", f"""
WITH u AS (SELECT user_id, step_start, (1 - available / total) * 100 AS pct FROM (
  SELECT user_id, date_trunc('day', ts) AS step_start, MAX(CASE WHEN event_type = 'purchase' THEN value END) AS available,
         MAX(CASE WHEN event_type = 'signup' THEN value END) AS total FROM events GROUP BY 1, 2) WHERE available IS NOT NULL AND total > 0),"""
          + _fired_sql("u", "user_id", "step_start", "pct", 30.0, 120, "critical"))
def q_alert_rule_disk(spark, d):
    """The disk rule: free over whole size, above its limit for two minutes (here of daily steps)."""
    use = metrics.usage_ratio(fx.load(spark, d, "events"), "purchase", "signup", step="day")
    return metrics.fired_alerts(use, 30.0, 120, "critical", ts="step_start", value="usage_pct")


@register("alert_rule_container", """
WITH u AS (SELECT user_id, ts, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) > 0
             THEN CAST(ROUND(value * 100) AS BIGINT) / CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0.0 END AS pct FROM events),"""
          + _fired_sql("u", "user_id", "ts", "pct", 90.0, 180, "warning"))
def q_alert_rule_container(spark, d):
    """The container rule: used over limit, above 90 % for three minutes."""
    use = metrics.usage_percent(fx.load(spark, d, "events"), "value", F.get_json_object("props", "$.k").cast("bigint"), carry=("user_id", "ts"))
    return metrics.fired_alerts(use, 90.0, 180, "warning", value="mem_pct")


@register("delta_percent", "WITH " + _INC.strip() + """
SELECT event_id, user_id, CASE WHEN pus IS NOT NULL AND us - pus > 0 AND c - pc >= 0
       THEN ((c - pc) * 1000000 * CAST(json_extract_string(props, '$.k') AS BIGINT)) / (us - pus) ELSE 0.0 END AS cpu_pct
FROM i""")
def q_delta_percent(spark, d):
    ev = fx.load(spark, d, "events")
    return metrics.delta_percent(ev, cpus=F.get_json_object("props", "$.k"), scale=2)


@register("usage_percent", """
SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) > 0
         THEN CAST(ROUND(value * 100) AS BIGINT) / CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0.0 END AS mem_pct,
       CAST(list_sum(CAST(json_extract(props, '$.*') AS BIGINT[])) AS BIGINT) AS net_total
FROM events""")
def q_usage_percent(spark, d):
    ev = fx.load(spark, d, "events")
    limit = F.get_json_object("props", "$.k").cast("bigint")
    nets = F.map_values(F.from_json("props", "map<string,bigint>"))
    return metrics.usage_percent(ev, "value", limit, nets)
