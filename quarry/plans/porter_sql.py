"""The published suffix rules of the Porter stemmer as SQL, one CTE per step.

A second derivation of the stems, for the DuckDB twins: rules are CASE branches,
longest suffix first, and the measure is a count over a consonant/vowel string.
Words of fewer than 3 or more than 64 bytes are left alone.
"""

from __future__ import annotations

# suffix=replacement of steps 2 and 3, suffixes of step 4.
_STEP2 = ("ational=ate tional=tion enci=ence anci=ance izer=ize bli=ble alli=al entli=ent eli=e ousli=ous ization=ize "
          "ation=ate ator=ate alism=al iveness=ive fulness=ful ousness=ous aliti=al iviti=ive biliti=ble logi=log")
_STEP3 = "icate=ic ative= alize=al iciti=ic ical=ic ful= ness="
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _shape(x: str) -> str:
    """1 for a vowel, 0 for a consonant; y is a vowel after a consonant, and a
    character of several bytes is several consonants."""
    y = rf"regexp_replace(regexp_replace({x}, '(^|[aeiou])y', '\1Y', 'g'), 'yy', 'yY', 'g')"
    return rf"regexp_replace(regexp_replace(regexp_replace({y}, '[^\x00-\x7f]', '00', 'g'), '[^aeiouy]', '0', 'g'), '[aeiouy]', '1', 'g')"


def _measure(x: str) -> str:
    s = _shape(x)
    return f"((length({s}) - length(replace({s}, '10', ''))) / 2)"


def _ends(x: str, suffix: str) -> str:
    return f"(length({x}) > {len(suffix)} AND ends_with({x}, '{suffix}'))"


def _cut(x: str, n: int) -> str:
    return f"left({x}, length({x}) - {n})"


def _short(x: str) -> str:
    """Ends consonant, vowel, consonant, the last not w, x or y."""
    return f"(ends_with({_shape(x)}, '010') AND right({x}, 1) NOT IN ('w', 'x', 'y'))"


def _double(x: str) -> str:
    return f"(length({x}) >= 2 AND right({x}, 1) = substr({x}, length({x}) - 1, 1) AND ends_with({_shape(x)}, '0') AND ord(right({x}, 1)) < 128)"


def _rules(x: str, rules: str) -> str:
    cases = [r.split("=") for r in sorted(rules.split(), key=lambda r: -len(r.split("=")[0]))]
    return "CASE " + " ".join(
        f"WHEN {_ends(x, s)} THEN CASE WHEN {_measure(_cut(x, len(s)))} > 0 THEN {_cut(x, len(s))} || '{r}' ELSE {x} END"
        for s, r in cases) + f" ELSE {x} END"


def _step4(x: str) -> str:
    out = []
    for s in sorted(_STEP4.split(), key=len, reverse=True):
        stem = _cut(x, len(s))
        extra = f" AND right({stem}, 1) IN ('s', 't')" if s == "ion" else ""
        out.append(f"WHEN {_ends(x, s)} THEN CASE WHEN {_measure(stem)} > 1{extra} THEN {stem} ELSE {x} END")
    return "CASE " + " ".join(out) + f" ELSE {x} END"


def stem_ctes(vocabulary: str = "vocab", stems: str = "stems") -> str:
    """CTEs from ``vocabulary(token)`` to ``stems(token, term)``."""
    steps = [
        f"CASE WHEN {_ends('w', 'sses')} OR {_ends('w', 'ies')} THEN {_cut('w', 2)} WHEN {_ends('w', 'ss')} THEN w "
        f"WHEN {_ends('w', 's')} THEN {_cut('w', 1)} ELSE w END",
        # step 1b leaves a mark when it has cut, which the next step looks at
        f"CASE WHEN {_ends('w', 'eed')} THEN CASE WHEN {_measure(_cut('w', 3))} > 0 THEN {_cut('w', 1)} ELSE w END "
        f"WHEN {_ends('w', 'ed')} AND contains({_shape(_cut('w', 2))}, '1') THEN {_cut('w', 2)} || '#' "
        f"WHEN {_ends('w', 'ing')} AND contains({_shape(_cut('w', 3))}, '1') THEN {_cut('w', 3)} || '#' ELSE w END",
        f"CASE WHEN NOT ends_with(w, '#') THEN w WHEN regexp_matches(w, '(at|bl|iz)#$') THEN {_cut('w', 1)} || 'e' "
        f"WHEN {_double(_cut('w', 1))} AND substr(w, length(w) - 1, 1) NOT IN ('l', 's', 'z') THEN {_cut('w', 2)} "
        f"WHEN {_measure(_cut('w', 1))} = 1 AND {_short(_cut('w', 1))} THEN {_cut('w', 1)} || 'e' ELSE {_cut('w', 1)} END",
        f"CASE WHEN {_ends('w', 'y')} AND contains({_shape(_cut('w', 1))}, '1') THEN {_cut('w', 1)} || 'i' ELSE w END",
        _rules("w", _STEP2), _rules("w", _STEP3), _step4("w"),
        f"CASE WHEN {_ends('w', 'e')} AND ({_measure(_cut('w', 1))} > 1 OR {_measure(_cut('w', 1))} = 1 AND NOT {_short(_cut('w', 1))}) "
        f"THEN {_cut('w', 1)} ELSE w END",
        f"CASE WHEN {_measure('w')} > 1 AND {_double('w')} AND ends_with(w, 'l') THEN {_cut('w', 1)} ELSE w END",
    ]
    ctes = [f"porter0 AS (SELECT DISTINCT token, token AS w FROM {vocabulary} WHERE strlen(token) BETWEEN 3 AND 64)"]
    ctes += [f"porter{i} AS MATERIALIZED (SELECT token, {step} AS w FROM porter{i - 1})" for i, step in enumerate(steps, start=1)]
    return ",\n".join(ctes) + f""",
{stems} AS (SELECT token, w AS term FROM porter{len(steps)}
          UNION ALL SELECT DISTINCT token, token FROM {vocabulary} WHERE strlen(token) NOT BETWEEN 3 AND 64)"""
