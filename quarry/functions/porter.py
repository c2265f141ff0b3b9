"""Porter (1980) stemming of ASCII-folded tokens, as a small per-term helper.

Written from the published algorithm (M.F. Porter, "An algorithm for suffix
stripping", Program 14(3), 1980). Spark calls it from an Arrow-batched pandas
UDF that stems each batch's distinct words once (with a per-task cache).

Like the full-text tokenizer it stands in for, it works on the UTF-8 bytes
of a token: tokens shorter than 3 or longer than 64 bytes are left alone,
and any byte other than a, e, i, o, u (and y after a consonant) is a
consonant.
"""

from __future__ import annotations

MIN_BYTES, MAX_BYTES = 3, 64


def _cv(w: str) -> str:
    """Consonant/vowel pattern of ``w`` ('c'/'v' per character). A prefix of
    ``w`` has the prefix of this pattern, so it is computed once per word."""
    out, prev_c = [], True
    for i, ch in enumerate(w):
        if ch in "aeiou":
            c = False
        elif ch == "y":
            c = i == 0 or not prev_c
        else:
            c = True
        out.append("c" if c else "v")
        prev_c = c
    return "".join(out)


def _m(cv: str) -> int:
    """Measure: the number of VC sequences in [C](VC)^m[V]."""
    return cv.count("vc")


def _double_cons(w: str, cv: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and cv[-1] == "c"


def _cvc(w: str, cv: str) -> bool:
    """*o: ends consonant-vowel-consonant, the last not w, x or y."""
    return len(w) >= 3 and cv.endswith("cvc") and w[-1] not in "wxy"


# The suffix rules of steps 2, 3 and 4 (suffix, replacement).
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


def _by_last(rules):
    out = {}
    for r in rules:
        key, rep = (r, "") if isinstance(r, str) else r
        out.setdefault(key[-1], []).append((key, rep))
    for v in out.values():
        v.sort(key=lambda kr: -len(kr[0]))  # longest first
    return out


_INDEX = {}


def _longest(w: str, suffixes):
    """The longest rule suffix that ends ``w`` (one rule per step)."""
    idx = _INDEX.get(id(suffixes))
    if idx is None:
        idx = _INDEX[id(suffixes)] = _by_last(suffixes)
    for key, rep in idx.get(w[-1:], ()):
        if _ends(w, key):
            return key, rep
    return None


def _ends(w: str, suf: str) -> bool:
    """A suffix matches only when something is left in front of it."""
    return len(w) > len(suf) and w.endswith(suf)


def _step1ab(w: str) -> str:
    if _ends(w, "sses"):
        w = w[:-2]
    elif _ends(w, "ies"):
        w = w[:-2]
    elif _ends(w, "ss"):
        pass
    elif _ends(w, "s"):
        w = w[:-1]
    if _ends(w, "eed"):
        if _m(_cv(w)[:-3]) > 0:
            w = w[:-1]
        return w
    for suf in ("ed", "ing"):
        if _ends(w, suf):
            cv = _cv(w)[:-len(suf)]
            if "v" not in cv:
                continue
            w = w[:-len(suf)]
            if w.endswith(("at", "bl", "iz")):
                return w + "e"
            if _double_cons(w, cv) and w[-1] not in "lsz":
                return w[:-1]
            if _m(cv) == 1 and _cvc(w, cv):
                return w + "e"
            return w
    return w


def _stem_ascii(w: str) -> str:
    w = _step1ab(w)
    if _ends(w, "y") and "v" in _cv(w)[:-1]:
        w = w[:-1] + "i"
    for rules in (STEP2, STEP3):
        hit = _longest(w, rules)
        if hit and _m(_cv(w)[:-len(hit[0])]) > 0:
            w = w[:-len(hit[0])] + hit[1]
    hit = _longest(w, STEP4)
    if hit:
        stem = w[:-len(hit[0])]
        if _m(_cv(w)[:len(stem)]) > 1 and (hit[0] != "ion" or stem.endswith(("s", "t"))):
            w = stem
    if _ends(w, "e"):
        stem = w[:-1]
        cv = _cv(stem)
        m = _m(cv)
        if m > 1 or (m == 1 and not _cvc(stem, cv)):
            w = stem
    cv = _cv(w)
    if _m(cv) > 1 and _double_cons(w, cv) and w.endswith("l"):
        w = w[:-1]
    return w


def stem(token: str) -> str:
    """Stem one (already ASCII-lower-cased) token."""
    if token is None:
        return None
    b = token.encode("utf-8")
    if len(b) < MIN_BYTES or len(b) > MAX_BYTES:
        return token
    # one character per byte, so non-ASCII bytes are consonants
    out = _stem_ascii(b.decode("latin-1"))
    # a suffix rule can cut a multi-byte character; what is left of it becomes
    # U+FFFD in documents and queries alike, so that the stem stays valid text
    return out.encode("latin-1").decode("utf-8", errors="replace")
