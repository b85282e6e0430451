"""The quality rules as SQL."""

from __future__ import annotations

from hirestream.llm import quality_rules as R


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _numbers(values: list[float]) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]::double[]"


def _distance(counts: str, reference: list[float]) -> str:
    """Jensen-Shannon distance of a list of counts and a list of shares."""
    shares = f"list_transform({counts}, lambda v: v / list_sum({counts}))"
    ref = f"list_transform({_numbers(reference)}, lambda v: v / list_sum({_numbers(reference)}))"
    part = "case when {a} > 0 then {a} * log2(2 * {a} / ({a} + {b})) else 0 end"
    terms = f"{part.format(a='z[1]', b='z[2]')} + {part.format(a='z[2]', b='z[1]')}"
    return f"sqrt(greatest(list_sum(list_transform(list_zip({shares}, {ref}), lambda z: {terms})) / 2, 0))"


def quality_rules_sql(rules: R.Rules = R.Rules()) -> str:
    every = R.all_words(R.COMMON_WORDS)
    refs = R.references(R.COMMON_WORDS, R.CHAR_SHARES, R.COMMON_SHARE)
    common = ", ".join(f"len(list_filter(w, lambda x: x = {_text(x)}))" for x in every)
    nearest = ", ".join(_distance("common", refs[lang]) for lang in sorted(refs))
    ws = r"[^\x20\x09-\x0D]"
    return rf"""
with t as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{ws}+') as w from documents),
g as (
  select doc_id, i, count(*) over (partition by doc_id, g) as c from (
    select doc_id, unnest(range(1, len(w) - {rules.window - 2})) as i,
      unnest(list_transform(range(1, len(w) - {rules.window - 2}), lambda i: array_to_string(w[i:i + {rules.window - 1}], ' '))) as g
    from t where len(w) >= {rules.window})),
r as (
  select doc_id, sum(least({rules.window}, i - coalesce(p, i - {rules.window}))) as n from (
    select doc_id, i, lag(i) over (partition by doc_id order by i) as p from g where c > 1) group by doc_id),
m as (
  select t.*, coalesce(r.n, 0) as n_repeat, length(array_to_string(w, '')) as word_chars,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{ws}')) as lines,
    regexp_replace(t, '[a-zß-öø-ÿ\x20\x09-\x0D]+', '', 'g') as rest from t left join r using (doc_id)),
c as (
  select *, length(t) as n, length(t) - word_chars as space, len(regexp_extract_all(rest, '\p{{Lu}}')) as up,
    len(regexp_extract_all(rest, '[0-9]')) as dig, length(rest) - length(translate(rest, {_text(R.MARKS)}, '')) as mark,
    length(rest) - length(translate(rest, {_text(R.SYMBOLS)}, '')) as sym,
    length(t) - length(rest) - (length(t) - word_chars) + len(regexp_extract_all(rest, '\p{{Ll}}')) as low,
    [{common}] as found from m),
d as (
  select *, [low, up, dig, space, mark, sym, n - low - up - dig - space - mark - sym]::double[] as chars,
    list_append(found, len(w) - list_sum(found)::bigint)::double[] as common,
    len(w) < {rules.min_words} or 100 * n_repeat > {rules.max_repeat_percent} * len(w) as failed from c)
select doc_id, len(w) as n_words, word_chars, sym as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
  n_repeat::bigint as n_repeat_words, failed as base_failed,
  not failed and case when n >= {rules.min_chars} then {_distance('chars', [R.CHAR_SHARES[c] for c in R.CLASSES])} else 0 end
      <= {rules.max_char_distance}
    and case when len(w) >= {rules.min_histogram_words} then least({nearest}) else 0 end <= {rules.max_word_distance} as kept
from d
"""
