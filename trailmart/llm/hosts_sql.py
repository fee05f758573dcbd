"""DuckDB SQL for the URL filter: the same rules and links, and rounds enough to settle any scores."""

from __future__ import annotations

from collections.abc import Sequence

from trailmart.llm.hosts import DAMPING, LOWER, THRESHOLD, UPPER, Rule

#: 0.7 to this power is below 1e-15.
ROUNDS = 100


def judge_sql(rules: Sequence[Rule], rounds: int = ROUNDS, damping: float = DAMPING) -> str:
    ordered = sorted(rules, key=lambda r: (len(r.text), len(r.host), r), reverse=True)
    fits = lambda r: (
        f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"
    )
    pick = lambda field: "case " + " ".join(
        f"when {fits(r)} then '{field(r)}'" for r in ordered
    ) + " end"
    steps = [
        f"""r{k} as materialized (
  select s.host, {1 - damping!r} * s.trust0 + {damping!r} * coalesce(m.t, 0) trust,
         {1 - damping!r} * s.distrust0 + {damping!r} * coalesce(m.d, 0) distrust
  from seeds s left join (
    select x.dst host, sum(x.t * p.trust) t, sum(x.d * p.distrust) d
    from steps x join r{k - 1} p on p.host = x.src group by x.dst) m on m.host = s.host)"""
        for k in range(1, rounds + 1)
    ]
    return rf"""
with u as (
  select page_id, html,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}'), '') host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') path
  from pages),
v as (select *, {pick(lambda r: r.text)} rule, {pick(lambda r: r.verdict)} said from u),
c as (select host, count(*) n, count(*) filter (where said = 'allow') good,
             count(*) filter (where said = 'block') bad from v where host <> '' group by host),
seeds as materialized (
  select host, good / greatest((select sum(good) from c), 1) trust0,
         bad / greatest((select sum(bad) from c), 1) distrust0,
         n / (select sum(n) from c) share from c),
links as (
  select host src, translate(l, '{UPPER}', '{LOWER}') dst, count(*) w from (
    select host, unnest(list_distinct(regexp_extract_all(html,
      'href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1, 'i'))) l
    from v where host <> '')
  where host <> translate(l, '{UPPER}', '{LOWER}') group by all),
ups as (
  select host, k, array_to_string(list_slice(string_split(host, '.'), k::int, len(string_split(host, '.'))), '.') parent
  from (select host, unnest(range(2, len(string_split(host, '.')) + 1)) k from c)),
near as (select host, arg_min(parent, k) parent from ups
         where parent in (select host from c) group by host),
e as materialized (
  select src, dst, sum(w) w from (
    select src, dst, w from links where dst in (select host from c)
    union all select host, parent, 1 from near union all select parent, host, 1 from near)
  group by src, dst),
steps as materialized (
  select src, dst, w / sum(w) over (partition by src) t, 0.0::double d from e
  union all select dst, src, 0.0, w / sum(w) over (partition by dst) from e),
r0 as (select host, trust0 trust, distrust0 distrust from seeds),
{", ".join(steps)},
z as (select r.host from r{rounds} r join seeds s on s.host = r.host
      where round(r.distrust, 12) > 0 and round(r.distrust, 12) >= {THRESHOLD!r} * (
        round(r.distrust, 12) + round(r.trust, 12) + round(s.share, 12)))
select page_id, host, path, rule,
  coalesce(said, case when host in (select host from z) then 'block' else 'allow' end) verdict
from v"""
