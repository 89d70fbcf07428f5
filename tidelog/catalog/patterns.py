"""Sequence patterns per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.catalog.registry import Inputs, query
from tidelog.operators.cep import Pattern, match_pattern, sequence_json, sequence_rows
from tidelog.sources.sinks import run_available_now
from tidelog.streaming import stateful

USERS = ["user_id"]


def kind(name: str):
    return F.col("event_type") == name


def funnel(strategy: str, seconds: float | None = None) -> Pattern:
    """A view, a click and a purchase."""
    p = Pattern.select("seen").where(kind("view"))
    for name, event in (("clicked", "click"), ("bought", "purchase")):
        p = getattr(p.then(name), strategy)().where(kind(event))
    return p.within(seconds) if seconds else p


def ids(matches: DataFrame, *names: str) -> DataFrame:
    """Single-row stages as plain id columns."""
    return matches.select("user_id", *[F.col(n)[0].alias(n) for n in names])


def found(i: Inputs, pattern: Pattern) -> DataFrame:
    return match_pattern(i.events, pattern, USERS, "ts", "event_id")


LEADS_SQL = """l AS (SELECT *, lead(event_id) OVER w AS id2, lead(event_type) OVER w AS type2, lead(value) OVER w AS value2,
  lead(event_id, 2) OVER w AS id3, lead(event_type, 2) OVER w AS type3, lead(ts, 2) OVER w AS ts3
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
STRICT_SQL = f"""WITH {LEADS_SQL}
SELECT user_id, event_id AS seen, id2 AS clicked, id3 AS bought FROM l
WHERE event_type = 'view' AND type2 = 'click' AND type3 = 'purchase'"""
NEXT_SQL = """n AS (SELECT v.user_id, v.event_id AS seen, v.ts,
  (SELECT min(c.event_id) FROM events c WHERE c.user_id = v.user_id AND c.event_type = 'click' AND c.event_id > v.event_id) AS clicked
  FROM events v WHERE v.event_type = 'view'),
m AS (SELECT *, (SELECT min(p.event_id) FROM events p WHERE p.user_id = n.user_id AND p.event_type = 'purchase'
  AND p.event_id > n.clicked) AS bought FROM n)"""


@query("cep_strict", STRICT_SQL)
def cep_strict(i: Inputs) -> DataFrame:
    return ids(found(i, funnel("strict_contiguity")), "seen", "clicked", "bought")


@query("cep_skip_next", f"""WITH {NEXT_SQL}
SELECT user_id, seen, clicked, bought FROM m WHERE bought IS NOT NULL""")
def cep_skip_next(i: Inputs) -> DataFrame:
    return ids(found(i, funnel("skip_till_next_match")), "seen", "clicked", "bought")


@query("cep_skip_any", """
SELECT v.user_id, v.event_id AS seen, c.event_id AS clicked, p.event_id AS bought
FROM events v JOIN events c ON c.user_id = v.user_id AND c.event_id > v.event_id
JOIN events p ON p.user_id = v.user_id AND p.event_id > c.event_id
WHERE v.event_type = 'view' AND c.event_type = 'click' AND p.event_type = 'purchase'
  AND p.ts - v.ts <= INTERVAL 2 DAY""")
def cep_skip_any(i: Inputs) -> DataFrame:
    return ids(found(i, funnel("skip_till_any_match", 2 * 86400)), "seen", "clicked", "bought")


@query("cep_within", f"""WITH {NEXT_SQL}
SELECT m.user_id, seen, clicked, bought FROM m JOIN events p ON p.event_id = bought
WHERE p.ts - m.ts <= INTERVAL 1 DAY""")
def cep_within(i: Inputs) -> DataFrame:
    return ids(found(i, funnel("skip_till_next_match", 86400)), "seen", "clicked", "bought")


@query("cep_strict_within", f"{STRICT_SQL} AND ts3 - ts <= INTERVAL 2 DAY")
def cep_strict_within(i: Inputs) -> DataFrame:
    return ids(found(i, funnel("strict_contiguity", 2 * 86400)), "seen", "clicked", "bought")


@query("cep_predicates", f"""WITH {LEADS_SQL}
SELECT user_id, event_id AS a, id2 AS b FROM l
WHERE (event_type = 'view' OR (value > 50 AND event_type <> 'error'))
  AND NOT type2 IN ('error', 'signup') AND value2 < 30 AND user_id % 2 = 0""")
def cep_predicates(i: Inputs) -> DataFrame:
    first = kind("view") | ((F.col("value") > 50) & ~kind("error"))
    pattern = (
        Pattern.select("a").where(first).and_(F.col("user_id") % 2 == 0)
        .then("b").where(~F.col("event_type").isin("error", "signup")).and_(F.col("value") < 30)
    )
    return ids(found(i, pattern), "a", "b")


@query("cep_overlap", f"""WITH {LEADS_SQL}
SELECT user_id, event_id AS a, id2 AS b, id3 AS c FROM l
WHERE event_type <> 'error' AND type2 <> 'error' AND type3 <> 'error'""")
def cep_overlap(i: Inputs) -> DataFrame:
    """Matches begin on every row while others are open."""
    fine = ~kind("error")
    pattern = Pattern.select("a").where(fine).then("b").where(fine).then("c").where(fine)
    return ids(found(i, pattern), "a", "b", "c")


def clicks_between(seconds: float | None) -> Pattern:
    p = (
        Pattern.select("seen").where(kind("view"))
        .then("clicks").one_or_more().where(kind("click"))
        .then("bought").where(kind("purchase"))
    )
    return p.within(seconds) if seconds else p


# A view, then only clicks up to the next other row, which is a purchase.
KLEENE_SQL = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
n AS (SELECT v.user_id, v.event_id AS seen, v.rn, v.ts,
  (SELECT min(x.rn) FROM r x WHERE x.user_id = v.user_id AND x.rn > v.rn AND x.event_type <> 'click') AS til
  FROM r v WHERE v.event_type = 'view')
SELECT n.user_id, seen, til - n.rn - 1 AS clicks, p.event_id AS bought
FROM n JOIN r p ON p.user_id = n.user_id AND p.rn = n.til
WHERE p.event_type = 'purchase' AND til - n.rn > 1 AND p.ts - n.ts <= INTERVAL 5 DAY"""


def _kleene(matches: DataFrame) -> DataFrame:
    return matches.select(
        "user_id", F.col("seen")[0].alias("seen"), F.size("clicks").cast("bigint").alias("clicks"),
        F.col("bought")[0].alias("bought"),
    )


@query("cep_kleene", KLEENE_SQL)
def cep_kleene(i: Inputs) -> DataFrame:
    return _kleene(found(i, clicks_between(5 * 86400)))


@query("cep_kleene_open", KLEENE_SQL[: KLEENE_SQL.index(" AND p.ts - n.ts")])
def cep_kleene_open(i: Inputs) -> DataFrame:
    """No bound on time: a match may be as long as its key."""
    return _kleene(found(i, clicks_between(None)))


@query("cep_stage_bounds", f"""WITH {NEXT_SQL}
SELECT m.user_id, seen, clicked, bought FROM m JOIN events c ON c.event_id = clicked JOIN events p ON p.event_id = bought
WHERE c.ts - m.ts <= INTERVAL 6 HOUR AND p.ts - m.ts <= INTERVAL 2 DAY""")
def cep_stage_bounds(i: Inputs) -> DataFrame:
    """A click soon after the view, a purchase later."""
    pattern = (
        Pattern.select("seen").where(kind("view"))
        .then("clicked").skip_till_next_match().where(kind("click")).within(6 * 3600)
        .then("bought").skip_till_next_match().where(kind("purchase")).within(2 * 86400)
    )
    return ids(found(i, pattern), "seen", "clicked", "bought")


@query("cep_stream", KLEENE_SQL)
def cep_stream(i: Inputs) -> DataFrame:
    late = i.late("events", "ts")
    matches = stateful.cep_stream(
        i.stream("events"), clicks_between(5 * 86400), USERS, "ts", "event_id", late
    )
    return _kleene(run_available_now(matches, "append", "cep", late.end))


@query("cep_fold", """
SELECT user_id, seen, topped FROM (
  SELECT v.user_id, v.event_id AS seen, v.ts, (SELECT min(c.event_id) FROM events c WHERE c.user_id = v.user_id
    AND c.event_id > v.event_id AND c.event_type = 'click' AND c.value > v.value) AS topped
  FROM events v WHERE v.event_type = 'view') m
JOIN events c ON c.event_id = m.topped AND c.user_id = m.user_id
WHERE c.ts - m.ts <= INTERVAL 2 DAY""".replace("SELECT user_id, seen", "SELECT m.user_id, seen"))
def cep_fold(i: Inputs) -> DataFrame:
    """The next click with a higher value than the view it follows."""
    pattern = (
        Pattern.select("seen").where(kind("view"))
        .fold("level", lambda row, current: row["value"])
        .then("topped").skip_till_next_match().where(kind("click"))
        .and_(lambda row, state: row["value"] > state["level"])
        .within(2 * 86400)
    )
    return ids(found(i, pattern), "seen", "topped")


@query("cep_sequence_rows", f"""WITH s AS ({STRICT_SQL}),
e AS (SELECT user_id, seen || '|' || clicked || '|' || bought AS match_id,
  unnest([struct_pack(stage := 'seen', e := seen), struct_pack(stage := 'clicked', e := clicked),
          struct_pack(stage := 'bought', e := bought)]) AS x FROM s)
SELECT user_id, match_id, x.stage AS stage, CAST(x.e AS VARCHAR) AS events FROM e""")
def cep_sequence_rows(i: Inputs) -> DataFrame:
    pattern = funnel("strict_contiguity")
    rows = sequence_rows(found(i, pattern), pattern, USERS)
    return rows.withColumn("events", F.array_join(F.col("events").cast("array<string>"), ","))


@query("cep_sequence_json", f"""WITH s AS ({STRICT_SQL})
SELECT user_id, '{{"seen":[' || seen || '],"clicked":[' || clicked || '],"bought":[' || bought || ']}}' AS json FROM s""")
def cep_sequence_json(i: Inputs) -> DataFrame:
    pattern = funnel("strict_contiguity")
    return sequence_json(found(i, pattern), pattern).select("user_id", "json")
