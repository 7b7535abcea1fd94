"""SQL twins of the queries that DuckDB can run over whole tables."""

from __future__ import annotations

import re

from tablewarden.llm import centroids as lloyd, divergence as rules, ownership as owned
from tablewarden.llm.chat import CLOSE, CONTROLS, OPEN
from tablewarden.llm.license_scan import PHRASES, TEMPLATES, tokens


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chat() -> str:
    """Digests over the turns as they are; only the formatted length depends on the template and its escapes."""
    escapes = " + ".join(
        ["length(text) - length(replace(text, chr(92), ''))"]
        + [f"(length(text) - length(replace(text, {_quoted(c)}, ''))) // {len(c)}" for c in CONTROLS]
    )
    odd = _quoted("</s>[INST] ok [/INST]")
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {odd} UNION ALL SELECT -1, 1, 'assistant', {odd}
), said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' {order}) AS turns,
         coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '') AS loss,
         CAST(sum({len(OPEN)} + length(role) + 1 + length(text) + {escapes} + {len(CLOSE) + 1}) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM said"""


def _wrapped(words: list[str]) -> str:
    """Every word between two spaces, so that neighbours share none."""
    return "".join(f" {w} " for w in words)


def _pattern(markup: str) -> str:
    """A template as a regular expression over wrapped words."""
    out = ""
    for part in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", markup):
        if part == "[[":
            out += "(?:"
        elif part == "]]":
            out += ")?"
        elif part.startswith("{{"):
            out += f"(?: [^ ]+ ){{1,{part[2:-2]}}}"
        else:
            out += _wrapped([w.decode() for w in tokens(part.encode())])
    return out


def _licenses() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    phrases = {_wrapped(p.split()): label for p, label in PHRASES.items()}
    count = " + ".join(f"(length(t) - length(replace(t, '{p}', ''))) // {len(p)}" for p in phrases)
    before = ", ".join(f"CASE WHEN contains(t, '{p}') THEN strpos(t, '{p}') - 1 END" for p in phrases)
    after = ", ".join(f"CASE WHEN contains(t, '{p}') THEN length(t) - strpos(reverse(t), reverse('{p}')) + 1 - {len(p)} END" for p in phrases)
    spaces = "CAST((length(left(t, {at})) - length(replace(left(t, {at}), ' ', ''))) // 2 AS BIGINT)"
    base = ", ".join(f"CASE WHEN contains(t, '{p}') THEN '{label}' END" for p, label in phrases.items())
    own = ", ".join(f"CASE WHEN regexp_matches(t, '{_pattern(markup)}') THEN '{label}' END" for label, markup in TEMPLATES)
    names = "array_to_string(list_sort(list_distinct([x FOR x IN {x} IF x IS NOT NULL])), ',')"
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), wrapped AS (
  SELECT doc_id, len(w) AS n_words, CASE WHEN len(w) > 0 THEN ' ' || array_to_string(w, '  ') || ' ' ELSE '' END AS t FROM words
), found AS (
  SELECT *, CAST({count} AS BIGINT) AS n_base, least({before}) AS first_at, greatest({after}) AS last_at,
         [{base}] AS base, [{own}] AS own FROM wrapped
)
SELECT doc_id, n_words, n_base, {spaces.format(at="first_at")} AS first_word, {spaces.format(at="last_at")} AS last_word,
       {names.format(x="base")} AS base_labels, {names.format(x="list_concat(base, own)")} AS labels,
       CASE WHEN len([x FOR x IN own IF x IS NOT NULL]) > 0 THEN 1.0::DOUBLE WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM found"""


def _rules() -> str:
    word = r"[^\x20\x09-\x0D]+"
    lists = {**rules.COMMON_WORDS, "": rules.OTHER_WORDS}
    listed = " ".join(f"WHEN '{k}' THEN [{', '.join(map(_quoted, v))}]" for k, v in lists.items())
    known = ", ".join(map(_quoted, rules.COMMON_WORDS))
    every = ", ".join(sorted({_quoted(w) for v in lists.values() for w in v}))
    left_out = lambda p: f"length(t) - length(regexp_replace(t, '{p}', '', 'g'))"
    sums = lambda c, n: ", ".join(f"sum({c}[{i + 1}]) + 1.0::DOUBLE" for i in range(n))
    term = "CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"
    share = {"p": "(s[i] / list_sum(s))", "q": "(r[i] / list_sum(r))"}
    part = f"({term.format(**share)} + {term.format(p=share['q'], q=share['p'])}) / 2"
    distance = lambda s, r, n: (
        f"CASE WHEN list_sum({s}) > 0 THEN round(sqrt(greatest(list_sum([{part.replace('s[', s + '[').replace('r[', r + '[').replace('(s)', f'({s})').replace('(r)', f'({r})')} "
        f"FOR i IN range(1, {n + 1})]), 0)), 6) END"
    )
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({known}) THEN lang ELSE '' END AS lang FROM documents
), words AS (
  SELECT *, regexp_extract_all(t, '{word}') AS w, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{word}')] AS l,
         CASE lang {listed} END AS vocabulary FROM texts
), windows AS (
  SELECT id, i, list_slice(w, i, i + {rules.WINDOW - 1}) AS run FROM (SELECT id, w, unnest(range(1, len(w) - {rules.WINDOW - 2})) AS i FROM words)
), again AS (
  SELECT id, count(DISTINCT place) AS n FROM (
    SELECT id, unnest(range(i, i + {rules.WINDOW})) AS place FROM windows
    JOIN (SELECT id, run FROM windows GROUP BY id, run HAVING count(*) > 1) USING (id, run)
  ) GROUP BY id
), counted AS (
  SELECT id, doc_id, lang, length(t) AS chars, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         {left_out("[#*$%&|<>]+")} AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         {left_out(chr(92) + "p{Ll}+")} AS low, {left_out(chr(92) + "p{Lu}+")} AS high, {left_out(chr(92) + "p{Nd}+")} AS digit,
         vocabulary, [x FOR x IN [lower(y) FOR y IN w] IF x IN ({every})] AS common
  FROM words LEFT JOIN again USING (id)
), binned AS (
  SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed,
         [greatest(x, 0)::DOUBLE FOR x IN [low, high, digit, n_symbols, chars - word_chars, word_chars - low - high - digit - n_symbols]] AS kinds,
         [len([x FOR x IN common IF x = v]) FOR v IN vocabulary] AS seen
  FROM counted
), filled AS (
  SELECT *, [x::DOUBLE FOR x IN list_concat(seen, [greatest(n_words - list_sum(seen)::BIGINT, 0)])] AS found FROM binned
), reference AS (
  SELECT lang, [{sums("kinds", 6)}] AS ref_kinds, [{sums("found", rules.N_COMMON + 1)}] AS ref_found FROM filled WHERE NOT base_failed GROUP BY lang
), judged AS (
  SELECT *, {distance("kinds", "ref_kinds", 6)} AS char_distance, {distance("found", "ref_found", rules.N_COMMON + 1)} AS word_distance
  FROM filled LEFT JOIN reference USING (lang)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance,
       NOT base_failed AND NOT coalesce((chars >= {rules.CHAR_GUARD} AND char_distance > {rules.CHAR_DISTANCE})
                                        OR (n_words >= {rules.WORD_GUARD} AND word_distance > {rules.WORD_DISTANCE}), FALSE) AS kept
FROM judged"""


def _secrets() -> str:
    """Matches by pattern, places as running sums over a text's pieces, owners as distinct counts."""
    matches = "\n  UNION ALL ".join(
        f"SELECT row, {_quoted(k.name)} AS kind, {_quoted(k.pattern)} AS pattern, {k.value} AS part, regexp_extract_all(t, {_quoted(k.pattern)}) AS hits, string_split_regex(t, {_quoted(k.pattern)}) AS gaps FROM given"
        for k in owned.KINDS
    )
    values = " ".join(f"WHEN {_quoted(k.name)} THEN regexp_extract(hit, {_quoted(k.pattern)}, {k.value})" for k in owned.KINDS if k.value)
    names = lambda kinds: ", ".join(_quoted(k.name) for k in kinds)
    order = f"list_position([{', '.join(map(_quoted, owned.ORDER))}], kind)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in owned.BASE)
    return f"""
WITH given AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents
), matched AS (
  {matches}
), each AS (
  SELECT row, kind, unnest(range(len(hits))) AS nth, unnest(hits) AS hit, unnest([length(g) FOR g IN gaps[1:len(hits)]]) AS gap FROM matched WHERE len(hits) > 0
), valued AS (
  SELECT *, CASE kind {values} ELSE hit END AS value,
         CAST(sum(gap + length(hit)) OVER (PARTITION BY row, kind ORDER BY nth) AS BIGINT) AS stop FROM each
), spans AS MATERIALIZED (
  SELECT row, CASE WHEN kind = 'assign' AND length(value) < {owned.LEAST_ASSIGNED} THEN '{owned.SHORT}' ELSE kind END AS kind, stop - length(hit) AS start, stop, value,
         length(value) >= {owned.LEAST_LIVE} AND len(list_distinct(string_split(value, ''))) >= {owned.LEAST_DIFFERENT} AND regexp_matches(value, '[A-Za-z]')
         AND regexp_matches(value, '[0-9]') AND NOT regexp_matches(value, '{owned.either_case(owned.EXAMPLE_WORDS)}') AS live
  FROM valued
), owners AS (
  SELECT value, count(DISTINCT source) AS n_owners FROM spans JOIN given USING (row) GROUP BY value
), judged AS (
  SELECT row, kind, start, {order} AS place, kind IN ({names(owned.BASE)}) AS base, kind || ':' || start || ':' || stop AS told,
         live AND n_owners < {owned.COPIED_OWNERS} AS own, n_owners >= {owned.COPIED_OWNERS} AS copied
  FROM spans JOIN owners USING (value)
), of_text AS (
  SELECT row, {counts}, string_agg(told, ',' ORDER BY start, place) FILTER (base) AS base_spans,
         string_agg(told, ',' ORDER BY start, place) FILTER (base OR own) AS spans, count(*) FILTER (own) AS n_live, count(*) FILTER (copied) AS n_copied
  FROM judged GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM given LEFT JOIN of_text USING (row)"""


def _clusters() -> str:
    """The rounds spelled out; every vector meets every centroid, component by component."""
    steps = []
    for r in range(lloyd.ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT row, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT row, c, CAST(sum((parts.x - c{r}.x) * (parts.x - c{r}.x)) AS BIGINT) AS d FROM parts JOIN c{r} USING (i) GROUP BY row, c) GROUP BY row
)""")
        if r < lloyd.ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, c{r}.x) AS x FROM c{r} LEFT JOIN (
    SELECT best.c AS c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM near{r} JOIN parts USING (row) GROUP BY best.c, i) USING (c, i)
)""")
    last = lloyd.ROUNDS
    return f"""
WITH given AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {lloyd.SIZE} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {lloyd.SIZE}
), parts AS MATERIALIZED (
  SELECT row, unnest(range({lloyd.SIZE})) AS i, unnest([CAST(floor({lloyd.SCALE} * x::DOUBLE) AS BIGINT) FOR x IN embedding]) AS x FROM given
), seeds AS (
  SELECT row, row_number() OVER (ORDER BY sha256('{lloyd.SEED}:' || vec_id), embedding) - 1 AS c FROM given WHERE vec_id IS NOT NULL
), c0 AS MATERIALIZED (
  SELECT c, i, x FROM seeds JOIN parts USING (row) WHERE c < {lloyd.CENTROIDS}
), {", ".join(steps)}, told AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY c
)
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{last} JOIN given USING (row) JOIN told ON c = best.c"""


ORACLE_SQL = {"op11_secret_scan": _secrets(), "op12_centroid_clustering": _clusters(), "op3_quality_rules": _rules(), "op5_chat_formatting": _chat(), "op7_license_scan": _licenses()}
