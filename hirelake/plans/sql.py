"""SQL expressions and tables the SQL counterparts of the queries are put together from.

This dialect's regular expressions know no look-around, so edges are consumed
instead, and a negative look-ahead becomes a replacement before the test.
"""

import re

from hirelake.functions import fixed
from hirelake.functions.skills import SKILLS
from hirelake.plans.postings import RAW_POSTINGS_SQL

W = r"\p{L}\p{N}_"
SP = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def matches(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {q(pattern)})"


def any_of(patterns) -> str:
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


def title_ok(expr: str) -> str:
    e = f"coalesce({expr}, '')"
    return f"({matches(e, any_of(fixed.TECH_INCLUDE))} AND NOT {matches(e, any_of(fixed.TECH_EXCLUDE))})"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {q(f'^[{SP}]+|[{SP}]+$')}, '', 'g')"


def clean(expr: str, more_entities: dict[str, str] = {}) -> str:
    entities = {**more_entities, "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
    for entity, char in entities.items():
        expr = f"replace({expr}, {q(entity)}, {q(char)})"
    expr = f"regexp_replace({expr}, '<[^>]+>', ' ', 'g')"
    expr = f"regexp_replace({expr}, {q(f'(?i)(https?://[^{SP}]+|www[.][^{SP}]+)')}, ' ', 'g')"
    return f"coalesce(trim(regexp_replace({expr}, {q(f'[{SP}]+')}, ' ', 'g')), '')"


def lookup(expr: str, mapping: dict) -> str:
    def lit(v):
        return q(v) if isinstance(v, str) else str(v)

    return f"CASE {expr} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " END"


def work_type(remote: str, title: str, description: str) -> str:
    text = f"(coalesce({title}, '') || ' ' || coalesce({description}, ''))"
    text = f"regexp_replace({text}, {q(rf'(?i)\bhybrid\s+(?:{fixed.NOT_HYBRID_WORK})')}, ' ', 'g')"
    hybrid = matches(text, r"(?i)\bhybrid\b")
    is_remote = f"(coalesce({remote} = 1, false) OR {matches(f'coalesce({title}, {q('')})', r'(?i)\bremote\b')})"
    return f"CASE WHEN {hybrid} THEN 'hybrid' WHEN {is_remote} THEN 'remote' ELSE 'on-site' END"


_STATE_CODES = {name.lower(): code for code, name in fixed.US_STATES.items()}


def state_code(expr: str) -> str:
    return lookup(f"lower(regexp_replace({strip(expr)}, {q(rf'(?i)[{SP}]+(metropolitan area|area)$')}, ''))", _STATE_CODES)


EDGE_L = rf"(^|[^{W}+#])"
EDGE_R = rf"($|[^{W}+#.]|\.($|[^{W}]))"


def skill_matches(expr: str, name: str, pattern: str, case_sensitive: bool) -> str:
    flag = "" if case_sensitive else "(?i)"

    def whole(p: str, text: str = expr, f: str = flag) -> str:
        return matches(text, f"{f}{EDGE_L}(?:{p}){EDGE_R}")

    followed = re.fullmatch(r"(.*?)\(\?=(.*)\)", pattern)
    if name == "Java":
        return whole("java", rf"regexp_replace({expr}, '(?i)java\s+script', 'javascript', 'g')")
    if name == "React":
        t = rf"regexp_replace({expr}, 'React(?:\.?js)?\s*Native', 'ReactNative_', 'g')"
        verb = r"React(?:\.?js)?\s+(?:to|quickly|promptly|swiftly|appropriately|accordingly)\b"
        t = f"regexp_replace({t}, {q(verb)}, 'React_', 'g')"
        return f"({whole(r'React(?:\.?js)?', t)} OR {whole('reactjs', expr, '(?i)')})"
    if name == "Go":
        spaced = r"Go(?:\s*(?:/|,|\))|\s+(?:and|or)\s+[A-Z]|\s+programming|\s+language)"
        return f"({whole('golang')} OR {matches(expr, EDGE_L + spaced)})"
    if name == "R":
        spaced = r"R(?:\s*(?:,|/|\))|\s+(?:and|or)\s+(?:Python|SQL|SAS)|\s+programming|\s+studio)"
        return f"({whole('rstudio', expr, '(?i)')} OR {matches(expr, EDGE_L + spaced)})"
    if followed:
        return matches(expr, f"{flag}{EDGE_L}(?:{followed[1]})(?:{followed[2]})")
    return whole(pattern.replace(r"\w*", rf"[{W}]*"))


def skill_list(expr: str) -> str:
    """List of the names of all skills in a text, in dictionary order."""
    tests = [
        f"CASE WHEN {skill_matches(expr, e.name, e.pattern, e.case_sensitive)} THEN {q(e.name)} END" for e in SKILLS
    ]
    return f"[x FOR x IN [{', '.join(tests)}] IF x IS NOT NULL]"


SKILL_VALUES = ", ".join(f"({i}, {q(e.name)}, {q(e.category)})" for i, e in enumerate(SKILLS))


def years(expr: str) -> str:
    # Without looking ahead: the character behind the unit, and up to 59 more before the last word.
    pattern = "(?i)" + fixed.YEARS_PATTERN.replace(r"\s", f"[{SP}]") + r"[^.;\na-z][^.;\n]{0,59}?experience"
    found = f"regexp_extract_all({expr}, {q(pattern)}, 1)"
    as_int = f"coalesce(try_cast(x AS INTEGER), {lookup('lower(x)', fixed.NUMBER_WORDS)})"
    return (
        f"CAST(list_min([v FOR v IN [{as_int} FOR x IN {found}] IF v <= {fixed.MAX_REASONABLE_YEARS}]) AS DOUBLE)"
    )


def word_count(expr: str) -> str:
    return f"CAST(len(regexp_extract_all({expr}, {q(f'[^{SP}]+')})) AS INTEGER)"


def flag(expr: str, pattern: str) -> str:
    return f"CAST({matches(expr, '(?i)' + pattern)} AS INTEGER)"


def remove_company(text: str, company: str) -> str:
    """Company names of the derived postings are plain words, so no quoting is needed."""
    name = strip(company)
    # An edge is consumed on the left only; the right edge is put back.
    pattern = f"{q(f'(?i)(^|[^{W}])')} || {name} || {q(f'($|[^{W}])')}"
    once = f"regexp_replace({text}, {pattern}, '\\1 \\2', 'g')"
    return f"CASE WHEN length({name}) >= 2 THEN regexp_replace({once}, {pattern}, '\\1 \\2', 'g') ELSE {text} END"


TOKEN = rf"(?:^|[^{W}])([a-z][a-z0-9+#]*(?:\.[a-z]+)?)"


def tokens(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), {q(TOKEN)}, 1)"


def stop_filter(tokens_expr: str, stop_words) -> str:
    return f"[t FOR t IN {tokens_expr} IF t NOT IN ({', '.join(q(w) for w in stop_words)})]"


def bigrams(words: str) -> str:
    return f"[{words}[i] || ' ' || {words}[i + 1] FOR i IN generate_series(1, len({words}) - 1)]"


def share(count: str, total: str, places: int = 1) -> str:
    return f"round({count} * 100.0::DOUBLE / {total}, {places})"


# Tables by name, each written over the ones before it.
TABLES: dict[str, str] = {
    "raw_postings": RAW_POSTINGS_SQL,
    "skill_dictionary": f"SELECT * FROM (VALUES {SKILL_VALUES}) AS t(skill_id, skill, category)",
    "tech": f"SELECT * FROM raw_postings WHERE {title_ok('title')}",
    "cleaned": f"""SELECT * FROM (
        SELECT * REPLACE ({clean('title')} AS title), {clean('description')} AS description_clean FROM tech
    ) WHERE length(description_clean) > 0""",
    "deduped": f"""SELECT * FROM cleaned QUALIFY row_number() OVER (
        PARTITION BY lower({strip('title')}), lower({strip("coalesce(company_name, '')")}), lower(description_clean)
        ORDER BY job_id) = 1""",
    "yearly": f"""SELECT *, coalesce(med_year, (salary_min + salary_max) / 2) AS salary_yearly FROM (
        SELECT *, min_usd * factor AS salary_min, max_usd * factor AS salary_max, med_usd * factor AS med_year FROM (
            SELECT *, {lookup('upper(pay_period)', {k: float(v) for k, v in fixed.PAY_PERIODS.items()})}::DOUBLE AS factor,
                CASE WHEN coalesce(currency, 'USD') = 'USD' THEN min_salary END AS min_usd,
                CASE WHEN coalesce(currency, 'USD') = 'USD' THEN med_salary END AS med_usd,
                CASE WHEN coalesce(currency, 'USD') = 'USD' THEN max_salary END AS max_usd
            FROM deduped))""",
    "fences": """SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
        SELECT quantile_cont(salary_yearly, 0.25) AS q1, quantile_cont(salary_yearly, 0.75) AS q3 FROM yearly)""",
    "salaried": """SELECT y.* REPLACE (
        CASE WHEN salary_yearly BETWEEN low AND high THEN salary_min END AS salary_min,
        CASE WHEN salary_yearly BETWEEN low AND high THEN salary_max END AS salary_max,
        CASE WHEN salary_yearly BETWEEN low AND high THEN salary_yearly END AS salary_yearly)
        FROM yearly y, fences""",
    "parsed": f"""SELECT * EXCLUDE (parts, n, p1, p2, p3),
        CASE location_level WHEN 'city' THEN p1 END AS city,
        CASE WHEN location_level = 'city' AND n = 2 THEN upper(p2)
             WHEN location_level = 'city' THEN {state_code('p2')}
             WHEN location_level = 'state' AND n = 2 AND p2 = 'United States' THEN {state_code('p1')}
             WHEN location_level = 'state' AND n = 2 THEN {state_code('p2')}
             WHEN location_level = 'state' THEN {state_code('p1')} END AS state
        FROM (SELECT *, CASE
            WHEN coalesce(location, '') IN ('', 'United States') THEN 'country'
            WHEN n = 2 AND upper(p2) IN ({', '.join(q(c) for c in fixed.US_STATES)}) THEN 'city'
            WHEN n = 2 AND p2 = 'United States' THEN 'state'
            WHEN n = 2 AND ({state_code('p2')}) IS NOT NULL THEN 'state'
            WHEN n = 3 AND p3 = 'United States' THEN 'city'
            WHEN n = 1 AND ({state_code('p1')}) IS NOT NULL THEN 'state'
            ELSE 'other' END AS location_level
        FROM (SELECT *, len(parts) AS n, trim(parts[1]) AS p1, trim(parts[2]) AS p2, trim(parts[3]) AS p3
        FROM (SELECT *, string_split(coalesce(location, ''), ',') AS parts FROM salaried)))""",
    "city_states": """SELECT city, state, total FROM (
        SELECT city, state, count(*) AS n, sum(count(*)) OVER (PARTITION BY city) AS total
        FROM parsed WHERE city IS NOT NULL AND state IS NOT NULL GROUP BY city, state)
        QUALIFY row_number() OVER (PARTITION BY city ORDER BY n DESC, state) = 1""",
    "metros": r"""SELECT location, city, state FROM (
        SELECT l.location, c.city, c.state, row_number() OVER (PARTITION BY l.location
            ORDER BY strpos(l.location, c.city), -length(c.city), c.city) AS rn
        FROM (SELECT DISTINCT location FROM parsed WHERE location_level = 'other') l
        JOIN city_states c ON c.total >= 5 AND regexp_matches(l.location, '\b' || regexp_escape(c.city) || '\b'))
        WHERE rn = 1""",
    "jobs": f"""SELECT p.job_id, p.title, p.description AS description_raw, p.description_clean, p.company_id, p.company_name,
        p.formatted_experience_level AS experience_level,
        {lookup('p.formatted_experience_level', fixed.SENIORITY)} AS seniority,
        p.formatted_work_type AS employment_type,
        {work_type('p.remote_allowed', 'p.title', 'p.description_clean')} AS work_type,
        p.location,
        coalesce(m.city, p.city) AS city, coalesce(m.state, p.state) AS state,
        CASE WHEN m.city IS NOT NULL THEN 'metro' ELSE p.location_level END AS location_level,
        p.pay_period, p.salary_min, p.salary_max, p.salary_yearly,
        epoch_ms(p.listed_time) AS listed_date, epoch_ms(p.original_listed_time) AS original_listed_date,
        p.views, p.applies, CAST(p.job_id % 10 AS INTEGER) AS cluster
        FROM parsed p LEFT JOIN metros m ON p.location_level = 'other' AND m.location = p.location""",
    "job_skill_list": f"SELECT job_id, {skill_list('t')} AS skills FROM (SELECT job_id, title || ' ' || description_clean AS t FROM jobs)",
    "job_skill": "SELECT job_id, unnest(skills) AS skill FROM job_skill_list",
}


def with_tables(sql: str) -> str:
    """Put the tables a statement names, and those they name, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(body)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in TABLES.items() if n in needed) + "\n" + sql
