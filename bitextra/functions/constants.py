"""Fixed values. They must stay as they are for results to agree with earlier corpora."""

# Whitespace as Python's str.strip / str.split / re see it (fixed value).
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The same set as the inside of a character class; Java and RE2 both read it.
WS_SET = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_SET}]"

# Characters ignored by the empty-content test, besides whitespace (fixed value).
EMPTY_IGNORED = r"""\[\]{};:'",<.>/?!@#$%\^&*()_+\-=|\\`~"""

# Georgian letters and the other characters a Georgian text may hold (fixed values).
GEORGIAN_LETTERS = r"\x{10d0}-\x{10f0}\x{1c90}-\x{1cb0}"
GEORGIAN_BLOCK = r"\x{10a0}-\x{10ff}"
PURITY_EXTRAS = (
    r"\p{Nd}" + WS_SET + r"""~`!@#$%\^&*()\-_=+\[{\]}|'";:/?.,<>"""
    r"\x{2013}\x{2014}\x{b4}\x{201e}\x{2026}"
)

# Roman numerals, lower case (fixed value).
ROMAN = r"m{0,4}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"

# One-to-one character normalisation, then the ellipsis (fixed values).
NORMALIZE_FROM = "–—−‐‑`´ʻʼ„«»‟"
NORMALIZE_TO = "-----''''\"\"\"\""
ELLIPSIS = "\u2026"

# Repairs of wrongly decoded text and HTML entities, applied in this order (fixed values).
ENCODING_REPAIRS = [
    ("â€™", "'"),
    ("â€œ", '"'),
    ("â€", ""),
    ('â€"', "–"),
    ("Ã¡", "á"),
    ("Ã©", "é"),
    ("Ã\xad", "í"),
    ("Ã³", "ó"),
    ("Ãº", "ú"),
    ("Ã±", "ñ"),
    ("Ã¼", "ü"),
    ("Ã¤", "ä"),
    ("Ã¶", "ö"),
    ("Ã§", "ç"),
    ("Ã¨", "è"),
    ("Ã ", "à"),
    ("â€¦", "..."),
    ("Â", ""),
    ("Ââ", ""),
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
]
ZERO_WIDTH = "﻿​‌‍‎‏‪‫‬‭‮"

# HTML tags that are removed (fixed value; \s spelled out).
HTML_TAG = rf"</?[A-Za-z][A-Za-z0-9]*(?:{WS}[^<>]*?)?/?>"

# End punctuation and what may follow it (fixed values).
END_MARKS = ".!?;:,"
TRAILING_EXTRAS = "'\"”’»)]}"

# Bracket kinds and what is removed for each (fixed values).
BRACKETS = {
    "()": r"\([^)]*\)",
    "[]": r"\[[^\]]*\]",
    "{}": r"\{[^}]*\}",
    "<>": r"<[^>]*>",
}

# Templates of the number-copying rows, (English, Georgian) (fixed values).
NUMBER_TEMPLATES = [
    ("The number is {number}.", "რიცხვი არის {number}."),
    ("Value: {number}", "მნიშვნელობა: {number}"),
    ("Result equals {number}", "შედეგი ტოლია {number}"),
    ("Count: {number}", "რაოდენობა: {number}"),
    ("Total: {number}", "სრული: {number}"),
    ("Amount: {number}", "თანხა: {number}"),
    ("Score: {number}", "ქულა: {number}"),
    ("Price: ${number}", "ფასი: ${number}"),
    ("Year: {number}", "წელი: {number}"),
    ("ID: {number}", "ID: {number}"),
    ("Temperature: {number}°C", "ტემპერატურა: {number}°C"),
    ("Distance: {number} km", "მანძილი: {number} კმ"),
    ("Weight: {number} kg", "წონა: {number} კგ"),
    ("Speed: {number} km/h", "სიჩქარე: {number} კმ/სთ"),
    ("Percentage: {number}%", "პროცენტი: {number}%"),
]

# Informal spellings, replaced in this order without regard to case (fixed values).
INFORMAL = [
    ("and", "&"),
    ("you are", "you're"),
    ("do not", "don't"),
    ("cannot", "can't"),
    ("will not", "won't"),
    ("it is", "it's"),
    ("that is", "that's"),
    ("I am", "I'm"),
]
# Articles that casual writing drops (fixed value).
ARTICLES = ["a", "an", "the"]

# English function words left out of TF-IDF vocabularies (fixed value).
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being "
    "below between both but by can cannot could did do does doing down during each few for from "
    "further had has have having he her here hers herself him himself his how i if in into is it "
    "its itself just me more most my myself no nor not now of off on once only or other ought our "
    "ours ourselves out over own same she should so some such than that the their theirs them "
    "themselves then there these they this those through to too under until up very was we were "
    "what when where which while who whom why will with would you your yours yourself yourselves"
).split()

# ASCII punctuation, split from word edges by chrF (fixed value).
ASCII_PUNCT = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
