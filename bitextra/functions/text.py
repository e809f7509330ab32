"""Text functions over Columns. All are JVM expressions except `html_unescape`."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from . import constants as K
from .arrays import let


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(K.WS_CHARS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(K.WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """Every whitespace run becomes one space; ends are stripped."""
    return strip(F.regexp_replace(c, K.WS + "+", " "))


def words(c: Column) -> Column:
    """Whitespace-separated words, no empty ones."""
    return F.array_remove(F.split(c, K.WS + "+"), "")


def space_tokens(c: Column) -> Column:
    """Split the stripped text on single spaces; keeps empty tokens, as profiles count them."""
    return F.split(strip(c), " ")


def non_empty(c: Column) -> Column:
    return F.coalesce(strip(c) != "", F.lit(False))


def has_content(c: Column) -> Column:
    """True when a character outside whitespace and ASCII punctuation exists."""
    return F.coalesce(c.rlike(f"[^{K.WS_SET}{K.EMPTY_IGNORED}]"), F.lit(False))


def allowed_length(c: Column, allowed: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{allowed}]", ""))


def without_roman_numerals(c: Column) -> Column:
    pattern = rf"(?i)(?<![\p{{L}}\p{{N}}_]){K.ROMAN}(?![\p{{L}}\p{{N}}_])"
    return strip(F.regexp_replace(c, pattern, ""))


def without_trailing_latin(c: Column, script: str = K.GEORGIAN_BLOCK) -> Column:
    """Drop Latin words that come after the last character of `script`.

    The text is cut once behind that character, so the cost is linear in its length.
    """
    head = F.regexp_extract(c, rf"(?s)^(.*[{script}])", 1)
    tail = F.substr(c, F.length(head) + 1)
    tail = F.regexp_replace(tail, rf"{K.WS}*[A-Za-z]+(?:(?![\p{{L}}\p{{N}}_])|_)", "")
    return strip(F.concat(head, tail))


def normalize(c: Column) -> Column:
    return F.replace(F.translate(c, K.NORMALIZE_FROM, K.NORMALIZE_TO), F.lit(K.ELLIPSIS), F.lit("..."))


def squeeze_spaces(c: Column) -> Column:
    for pattern, to in ((" {2,}", " "), ("\n{2,}", "\n"), ("\t+", " ")):
        c = F.regexp_replace(c, pattern, to)
    return strip(c)


def drop_brackets(c: Column, kinds: list[str]) -> Column:
    for kind in kinds:
        if kind in K.BRACKETS:
            c = F.regexp_replace(c, K.BRACKETS[kind], "")
    return strip(F.regexp_replace(c, " {2,}", " "))


def repair_encoding(c: Column) -> Column:
    for bad, good in K.ENCODING_REPAIRS:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return collapse_ws(F.translate(c, K.ZERO_WIDTH, ""))


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def html_unescape(c: Column) -> Column:
    """Decode HTML entities; only texts holding a '&' travel to Python."""
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def strip_html(c: Column) -> Column:
    return collapse_ws(html_unescape(F.regexp_replace(c, K.HTML_TAG, " ")))


# --- end punctuation ---------------------------------------------------------------------

_TRAILING = K.WS_CHARS + K.TRAILING_EXTRAS


def end_mark(c: Column, marks: str = K.END_MARKS) -> Column:
    """Last mark before closing quotes, brackets and spaces; '' when there is none."""
    last = F.right(F.rtrim(c, F.lit(_TRAILING)), F.lit(1))
    return F.when((last != "") & F.contains(F.lit(marks), last), last).otherwise(F.lit(""))


def with_end_mark(c: Column, mark: Column, marks: str = K.END_MARKS) -> Column:
    """Put `mark` in place of the end mark, or add it, in front of closing quotes."""
    body = rstrip(c)
    core = F.rtrim(body, F.lit(_TRAILING))
    tail = F.substr(body, F.length(core) + 1)
    bare = F.when(end_mark(c, marks) != "", F.left(core, F.length(core) - 1)).otherwise(core)
    return F.when(c == "", c).otherwise(F.concat(bare, mark, tail))


# --- British to American spelling ----------------------------------------------------------

_OUR = (
    "arb arm behavi cand clam col demean enam endeav fav ferv flav harb hon hum lab neighb od "
    "parl ranc rig rum sav savi splend succ tum val vap vig"
).split()
_ISE = (
    "agon apolog author capital categor central character civil colon computer critic crystal "
    "custom digital econom emphas equal energ familiar fertil final formal general global harmon "
    "hospital human ideal immun industrial initial legal local magnet maxim mechan memor mobil "
    "minim modern monopol natural neutral normal optim organ patron penal personal polar popular "
    "prior privat public random rational real recogn revolution satir social special stabil "
    "standard steril summar symbol sympath synchron terror theor urban util vapor victim vandal "
    "visual"
).split()
_YSE = "anal catal paral".split()
_RE = "calib cent fib lit lust meag met och reconnoit sab scept somb spect theat".split()
_OGUE = "anal catal dial epil monol prol".split()
_ENCE = "def lic off pret".split()
_LL = (
    "cancel channel counsel dial duel enamel equal fuel funnel grovel jewel label level "
    "marvel model panel pedal quarrel signal snorkel spiral total travel tunnel"
).split()


def _any(stems: list[str]) -> str:
    return "(?:" + "|".join(stems) + ")"


_ANY_CASE = r"(?i)\b"
# (pattern, replacement with $n groups); tried in order, letter case of kept letters stays.
AMERICAN_RULES = [
    (rf"(?i)\b((?:dis|un|mis)?{_any(_OUR)}o)u(r(?:s|ed|er|ers|ing|ite|ites|able|ful|less|ist|hood|hoods|ly|al|ally)?)\b", "$1$2"),
    (rf"(?i)\b((?:dis|re|de|un)?{_any(_ISE)}i)(?-i:s)(e|es|ed|er|ers|ing|ation|ations|able|ational)\b", "$1z$2"),
    (rf"(?i)\b((?:dis|re|de|un)?{_any(_ISE)}I)(?-i:S)(E|ES|ED|ER|ERS|ING|ATION|ATIONS|ABLE|ATIONAL)\b", "$1Z$2"),
    (rf"(?i)\b({_any(_YSE)}y)(?-i:s)(e|es|ed|er|ers|ing)\b", "$1z$2"),
    (rf"(?i)\b({_any(_YSE)}Y)(?-i:S)(E|ES|ED|ER|ERS|ING)\b", "$1Z$2"),
    (rf"(?i)\b((?:kilo|centi|milli|epi|amphi)?{_any(_RE)})(r)(e)(s?)\b", "$1$3$2$4"),
    (rf"(?i)\b({_any(_OGUE)}og)ue(s?)\b", "$1$2"),
    (rf"(?i)\b({_any(_ENCE)}en)(?-i:c)(e|es|eless)\b", "$1s$2"),
    (rf"(?i)\b({_any(_LL)})l(ed|ing|er|ers)\b", "$1$2"),
    (r"(?i)\b(gr)(?-i:e)(y(?:s|er|est|ish)?)\b", "$1a$2"),
    (r"\b(t)y(res?)\b", "$1i$2"),
    (r"(?i)\b(program)me(s?)\b", "$1$2"),
    (r"(?i)\b(alumin)i(um)\b", "$1$2"),
    (r"(?i)\b(jewel)le(ry)\b", "$1$2"),
    (r"(?i)\b(m)o(ust(?:ache|aches))\b", "$1$2"),
    (r"(?i)\b(an)a(esthetics?|esthesia|emia|emic)\b", "$1$2"),
    (r"(?i)\b(p)a(ediatric|ediatrics|ediatrician)\b", "$1$2"),
    (r"(?i)\b(mo)u(ld(?:s|ed|ing|y)?)\b", "$1$2"),
    (r"(?i)\b(f)o(et(?:us|uses|al))\b", "$1$2"),
    (r"(?i)\b(h)a(em(?:oglobin|orrhages?|orrhaged|orrhaging|orrhoids?|atology|ophilia|ophiliacs?))\b", "$1$2"),
    (r"(?i)\b((?:mis)?judg|acknowledg|abridg)e(ments?)\b", "$1$2"),
    # letters change or are added: lower case behind the first letter only
    (r"\b([Cc]he)que(s?|books?)\b", "$1ck$2"),
    (r"\b([Cc]he)quer(ed|s?)\b", "$1cker$2"),
    (r"\b([Mm]an)oeuvre(s?)\b", "$1euver$2"),
    (r"\b([Mm]an)oeuvr(ed|ing|able)\b", "$1euver$2"),
    (r"\b([Aa])ero(planes?)\b", "$1ir$2"),
    (r"\b([Ss])c(eptic(?:s|al|ally|ism)?)\b", "$1k$2"),
    (r"\b([Pp]lo)ugh(s|ed|ing|man|men|shares?|)\b", "$1w$2"),
    (r"\b([Pp])y(jamas?)\b", "$1a$2"),
    (r"\b([Ee]nrol|[Ff]ulfil|[Dd]istil)(ments?|s?)\b", "$1l$2"),
    (r"\b([Ii]nstal)(ments?)\b", "$1l$2"),
    (r"\b([Ss]kil|[Ww]il)(ful(?:ly|ness)?)\b", "$1l$2"),
    (r"\b([Aa]rt)e(facts?)\b", "$1i$2"),
    (r"\b([Pp]racti)s(e|es|ed|ing)\b", "$1c$2"),
]


#: Any of the rules, all of which start at a word: one pass tells the texts that no rule touches. All start
#: with a letter, so the ends of words are passed by.
ANY_AMERICAN_RULE = r"\b(?=[A-Za-z])(?:" + "|".join(
    f"(?i:{p.removeprefix(_ANY_CASE)})" if p.startswith(_ANY_CASE) else p.removeprefix(r"\b") for p, _ in AMERICAN_RULES
) + ")"


def to_american(c: Column) -> Column:
    """American spelling by rules, for texts in which one of them applies."""

    def change(c: Column) -> Column:
        changed = c
        for pattern, to in AMERICAN_RULES:
            changed = F.regexp_replace(changed, pattern, to)
        return F.when(F.rlike(c, F.lit(ANY_AMERICAN_RULE)), changed).otherwise(c)

    return let(collapse_ws(c), change)
