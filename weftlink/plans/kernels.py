"""DuckDB statements of the sound key and the string kernels, which the queries are checked against.

Strings of up to 126 characters: rows of the longest common subsequence are bits of a 128-bit integer.
"""

from __future__ import annotations

_SOFT = "('E', 'I', 'Y')"
_VOWELS = "('A', 'E', 'I', 'O', 'U')"


def sound_key(word: str) -> str:
    """The sound key of a word: letters A-Z, the beginning put right, then a code for every place by its neighbours."""
    upper = f"regexp_replace(upper({word}), '[^A-Z]', '', 'g')"
    begun = f"regexp_replace(regexp_replace(regexp_replace({upper}, '^[AGKPW]([ENR])', CASE WHEN substr({upper}, 1, 2) IN ('AE', 'GN', 'KN', 'PN', 'WR') THEN '\\1' ELSE '\\0' END), '^X', 'S'), '^WH', 'W')"
    p = f"(' ' || {begun} || '    ')"
    at = lambda k: f"substr({p}, i + {k}, 1)"
    before, here, after, third = (at(k) for k in range(4))
    starts = lambda *words: " OR ".join(f"starts_with(substr({p}, i + 1), '{w}')" for w in words)
    return f"""array_to_string(list_transform(range(1, length({begun}) + 1), lambda i: CASE
        WHEN {here} = {before} AND {here} <> 'C' THEN ''
        WHEN {here} IN {_VOWELS} THEN CASE WHEN i = 1 THEN {here} ELSE '' END
        WHEN {here} = 'B' AND {before} = 'M' AND {after} = ' ' THEN ''
        WHEN {here} IN ('B', 'F', 'J', 'L', 'M', 'N', 'R') THEN {here}
        WHEN {here} = 'Q' THEN 'K' WHEN {here} = 'V' THEN 'F' WHEN {here} = 'Z' THEN 'S' WHEN {here} = 'X' THEN 'KS'
        WHEN {here} = 'C' THEN CASE WHEN {starts('CIA')} THEN 'X' WHEN {after} = 'H' THEN CASE WHEN {before} = 'S' THEN 'K' ELSE 'X' END
            WHEN {after} IN {_SOFT} THEN CASE WHEN {before} = 'S' THEN '' ELSE 'S' END ELSE 'K' END
        WHEN {here} = 'D' THEN CASE WHEN {after} = 'G' AND {third} IN {_SOFT} THEN 'J' ELSE 'T' END
        WHEN {here} = 'G' THEN CASE WHEN {after} = 'H' THEN CASE WHEN {third} IN {_VOWELS} THEN 'K' ELSE '' END
            WHEN {after} = 'N' AND ({third} = ' ' OR trim(substr({p}, i + 2)) = 'NED') THEN '' WHEN {before} = 'D' AND {after} IN {_SOFT} THEN ''
            WHEN {after} IN {_SOFT} AND {before} <> 'G' THEN 'J' ELSE 'K' END
        WHEN {here} = 'H' THEN CASE WHEN {after} IN {_VOWELS} AND {before} NOT IN ('C', 'S', 'P', 'T', 'G') THEN 'H' ELSE '' END
        WHEN {here} = 'K' THEN CASE WHEN {before} = 'C' THEN '' ELSE 'K' END
        WHEN {here} = 'P' THEN CASE WHEN {after} = 'H' THEN 'F' ELSE 'P' END
        WHEN {here} = 'S' THEN CASE WHEN {after} = 'H' OR {starts('SIO', 'SIA')} THEN 'X' ELSE 'S' END
        WHEN {here} = 'T' THEN CASE WHEN {starts('TIA', 'TIO')} THEN 'X' WHEN {after} = 'H' THEN '0' WHEN {starts('TCH')} THEN '' ELSE 'T' END
        ELSE CASE WHEN {after} IN {_VOWELS} THEN {here} ELSE '' END END), '')"""


def _full(a: str) -> str:
    return f"((1::HUGEINT << length({a})::HUGEINT) - 1)"


def _masks(a: str, b: str) -> str:
    """For every character of b the bits of the places where a has it."""
    return f"list_transform(string_split({b}, ''), lambda c: coalesce(list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, i + 1, 1) = c THEN 1::HUGEINT << i::HUGEINT ELSE 0::HUGEINT END)), 0)::HUGEINT)"


def _common(a: str, masks: str, full: str) -> str:
    return f"(length({a}) - bit_count(list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})))"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 2 * {_common(a, _masks(a, b), _full(a))} / (length({a}) + length({b}))::DOUBLE END"


def ctes(name: str, pairs: str, only_token_set: bool = False) -> str:
    """CTEs that end in `name`(a, b, token_set, and the other kernels): one row for each two texts a, b of the relation `pairs`."""
    words = lambda c: f"list_distinct(list_filter(string_split({c}, ' '), lambda t: t <> ''))"
    ordered = lambda c: f"array_to_string(list_sort({c}), ' ')"
    sort = lambda c: ordered(f"list_filter(string_split({c}, ' '), lambda t: t <> '')")
    joint = "(length(middle) + (middle <> '')::INT)"
    rest = "CASE WHEN ours = '' OR theirs = '' THEN 0 ELSE " + _common("ours", _masks("ours", "theirs"), _full("ours")) + " END"
    more, windows = "", ""
    if not only_token_set:
        windows = f", {name}3 AS (SELECT *, {_full('short')} AS every, {_masks('short', 'long')} AS masks FROM (SELECT *, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS short, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS long, {sort('a')} AS sa, {sort('b')} AS sb FROM {name}2))"
        window = "masks[greatest(0, i) + 1 : least(i + length(short), length(long))]"
        best = f"list_max(list_transform(range(1 - length(short), length(long)), lambda i: 2 * {_common('short', window, 'every')} / (length(short) + len({window}))::DOUBLE))"
        more = f""", {_ratio('a', 'b')} AS ratio, {_ratio('sa', 'sb')} AS token_sort, CASE WHEN a = b THEN 1.0::DOUBLE ELSE jaro_winkler_similarity(a, b) END AS jaro_winkler,
        CASE WHEN short = '' THEN (long = '')::INT::DOUBLE WHEN contains(long, short) THEN 1.0::DOUBLE ELSE {best} END AS partial"""
    return f"""{name}0 AS (SELECT a, b, {words('a')} AS x, {words('b')} AS y FROM (SELECT DISTINCT a, b FROM {pairs})),
{name}1 AS (SELECT *, {ordered('list_intersect(x, y)')} AS middle, {ordered('list_filter(x, lambda t: NOT list_contains(y, t))')} AS ours, {ordered('list_filter(y, lambda t: NOT list_contains(x, t))')} AS theirs FROM {name}0),
{name}2 AS (SELECT *, 2 * ({joint} + {rest}) / (2 * {joint} + length(ours) + length(theirs))::DOUBLE AS whole FROM {name}1){windows},
{name} AS (SELECT a, b, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0::DOUBLE WHEN middle <> '' AND (ours = '' OR theirs = '') THEN 1.0::DOUBLE WHEN middle = '' THEN whole
    ELSE greatest(whole, 2 * length(middle) / (2 * length(middle) + 1 + length(ours))::DOUBLE, 2 * length(middle) / (2 * length(middle) + 1 + length(theirs))::DOUBLE) END AS token_set{more} FROM {name}{2 if only_token_set else 3})"""
