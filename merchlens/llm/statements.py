"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

# Moves a table of counts (k bad of n) and its parents' posteriors (pa, pb) to its own posteriors, as the operator does.
SHRUNK = """
{name}_placed AS (SELECT *, pa + pb - n AS others, (pa - k) / (pa + pb - n) AS m FROM {name}_parents),
{name}_level AS (
    SELECT greatest(1.0, least(1000.0, CASE WHEN scale > 0 AND excess > 0 THEN scale / excess - 1 WHEN scale > 0 THEN 1000.0 ELSE 1.0 END)) AS level
    FROM (SELECT sum((k - n * m) * (k - n * m) - n * m * (1 - m)) AS excess, sum((n - 1) * n * m * (1 - m)) AS scale FROM {name}_placed)
),
{name} AS (
    SELECT {key}, least(level, others) * m + k AS a, least(level, others) * (1 - m) + n - k AS b FROM {name}_placed, {name}_level
)"""

# A url's host and path; the name is the host without user, port and trailing dots.
HOST = "coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
PATH = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
NAME = "regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), '([^:\\[]):[0-9]*$', '\\1'), '\\.+$', '')"
OPENING = "regexp_replace(regexp_extract({}, '^\\s*(\\S+(?:\\s+\\S+){{0,2}})', 1), '\\s+', ' ', 'g')"


def _title() -> str:
    title = "coalesce(regexp_extract(html, '<title>([^<]*)', 1), '')"
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
        title = f"replace({title}, '{entity}', '{character}')"
    return title


def _fits(rule: str) -> str:
    name, _, rest = rule.partition("/")
    return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"


def host_reputation(rules: tuple[tuple[str, str], ...]) -> str:
    """Verdicts per page: the longest rule, else block where the lower bound of the host's posterior reaches one half."""
    longest = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    rule = "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in longest) + " END"
    listed = "CASE " + " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in longest) + " END"
    address = "(regexp_full_match(name, '(?:[0-9]{1,3}\\.){3}[0-9]{1,3}') OR starts_with(name, '['))"
    return f"""
WITH judged AS (
    SELECT DISTINCT d.doc_id, {OPENING.format("text")} AS opening,
        CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END AS bad
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
),
shown AS (
    SELECT page_id, try_cast(nullif(regexp_extract({PATH}, '/([0-9]+)(?:\\.html)?/?$', 1), '') AS BIGINT) AS doc_id, {OPENING.format(_title())} AS title FROM pages
),
worst AS (
    SELECT page_id, max(bad) AS bad FROM shown JOIN judged USING (doc_id)
    WHERE title <> '' AND starts_with(opening || ' ', title || ' ') AND bad IS NOT NULL GROUP BY page_id
),
located AS (SELECT page_id, {HOST} AS host, {PATH} AS path FROM pages),
hosts AS (
    SELECT host, {NAME} AS name, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k
    FROM located LEFT JOIN worst USING (page_id) GROUP BY host
),
placed AS (
    SELECT host, n, k, CASE WHEN {address} THEN name ELSE regexp_extract(name, '[^.]*(?:\\.[^.]*)?$') END AS domain,
        CASE WHEN {address} THEN '(address)' ELSE regexp_extract(name, '[^.]*$') END AS suffix
    FROM hosts
),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM placed GROUP BY ALL),
ends AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
top_parents AS (SELECT suffix, n, k, 0.5 + sum(k) OVER () AS pa, 0.5 + sum(n - k) OVER () AS pb FROM ends),
{SHRUNK.format(name="top", key="suffix")},
middle_parents AS (SELECT domain, n, k, a AS pa, b AS pb FROM domains JOIN top USING (suffix)),
{SHRUNK.format(name="middle", key="domain")},
low_parents AS (SELECT host, n, k, a AS pa, b AS pb FROM placed JOIN middle USING (domain)),
{SHRUNK.format(name="low", key="host")},
ruled AS (SELECT *, {rule} AS rule FROM located)
SELECT page_id, host, path, rule, coalesce({listed}, CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN low USING (host)
"""


def chat_format(probe: str, controls: tuple[str, ...], markup: dict[str, int]) -> str:
    """Digests of conversations. `markup` has the lengths of the template's begin, after_role, between and end."""

    def escaped(text: str) -> str:
        for control in controls:
            first, rest = ("".join(c if c.isalnum() else f"\\{c}" for c in part) for part in (control[0], control[1:]))
            text = f"regexp_replace({text}, '({first}\\\\*)({rest})', '\\1\\\\\\2', 'g')"
        return text

    block = markup["begin"] + markup["after_role"] + markup["end"]
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{probe}'), (-1, 1, 'assistant', '{probe}')
),
quoted AS (SELECT *, {escaped("role")} AS role_out, {escaped("text")} AS text_out FROM turns),
placed AS (
    SELECT *, row_number() OVER w AS place, lag(role_out) OVER w IS DISTINCT FROM role_out AS starts FROM quoted
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role_out, text_out)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(text_out) + CASE WHEN starts THEN length(role_out) + {block} ELSE {markup["between"]} END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
